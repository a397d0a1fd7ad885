import re

import cases
import pytest

from weatherlake.llm import queries, surrogates

KEY = "secret"


def replaced(spark, texts, key=KEY):
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], cases.SCHEMA)
    rows = surrogates.replace_entities(docs, key).selectExpr("row.doc_id", "*").collect()
    return {row.doc_id: row for row in rows}


PRIVATE = [
    "Write to Jane.Doe77@mail.example.org or call +1 (521) 555-6210 now.",
    "jane.doe77@mail.example.org was here; also +1-521-555-6210, from 152.143.123.131.",
    "card 4785 3805 9239 1139 and 4785380592391139, number 123-45-6789",
    'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"### end',
    "Mr. John Smith met Anna Smith and Иван Петров yesterday.",
]


def test_private_data_is_replaced_in_its_format(spark):
    got = replaced(spark, PRIVATE)
    texts = [got[i].text for i in range(len(PRIVATE))]
    for old in ("Jane.Doe77", "555-6210", "152.143.123.131", "123-45-6789", "24be64439e3e", "John", "Anna", "Smith", "Петров"):
        assert old not in "\n".join(texts), old
    assert re.fullmatch(r"Write to [A-Z][a-z]{3}\.[A-Z][a-z]{2}\d\d@[a-z]{4}\.[a-z]{7}\.org or call \+1 \(\d{3}\) \d{3}-\d{4} now\.", texts[0])
    assert re.fullmatch(r"card \d{4} \d{4} \d{4} \d{4} and \d{16}, number \d{3}-\d{2}-\d{4}", texts[2])
    assert re.fullmatch(r'token = "[0-9a-f]{40}"### end', texts[3])
    assert re.fullmatch(r"Mr\. [A-Z][a-z]+ [A-Z][a-z]+ met [A-Z][a-z]+ [A-Z][a-z]+ and [А-Я][а-я]+ [А-Я][а-я]+ yesterday\.", texts[4])
    assert [got[i].n_entities for i in range(5)] == [2, 3, 3, 1, 6]


def test_one_entity_has_one_surrogate_in_all_spellings(spark):
    got = replaced(spark, PRIVATE)
    mail = lambda text: re.search(r"\S+@\S+", text)[0].lower()
    assert mail(got[0].text) == mail(got[1].text)
    digits = lambda text: re.sub(r"\D", "", text)
    assert digits(re.search(r"\+[\d() -]+", got[0].text)[0]) == digits(re.search(r"\+[\d-]+", got[1].text)[0])
    spaced, solid = re.findall(r"\d{4}(?: \d{4}){3}|\d{16}", got[2].text)
    assert digits(spaced) == solid
    smiths = re.findall(r"[A-Z][a-z]+ ([A-Z][a-z]+)", got[4].text.removeprefix("Mr. "))
    assert smiths[0] == smiths[1]


def test_gender_and_script_of_names(spark):
    got = replaced(spark, ["John Brown, Mary Brown, Иван Орлов, Анна Орлова"])[0].text
    john, mary, ivan, anna = (part.split()[0] for part in got.split(", "))
    for name, group in ((john, "latin male"), (mary, "latin female"), (ivan, "cyrillic male"), (anna, "cyrillic female")):
        assert name in surrogates.GIVEN_NAMES[group]


def test_the_key_decides(spark):
    first, same, other = (replaced(spark, PRIVATE, key)[0].text for key in (KEY, KEY, "other"))
    assert first == same != other
    with pytest.raises(ValueError):
        replaced(spark, PRIVATE, "")


def luhn(digits):
    values = [int(d) for d in reversed(digits)]
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(values)) % 10 == 0


def test_check_digits_stay_true_or_false(spark):
    got = replaced(spark, ["4539148803436467", "4539148803436468"])
    assert luhn("4539148803436467") and luhn(got[0].text)
    assert not luhn(got[1].text)


def test_collisions_are_settled(spark):
    """With addresses of one digit each in a small space, many first choices are equal or real."""
    names = [f"{a}@{b}.org" for a in "012345" for b in "01"]
    got = replaced(spark, [f"mail {name} end" for name in names])
    new = [got[i].text.split()[1] for i in range(len(names))]
    assert len(set(new)) == len(names)
    assert not set(new) & set(names)
    again = replaced(spark, [" and ".join(names[:3]), f"mail {names[1]}"])
    assert again[1].text.split()[1] == again[0].text.split(" and ")[1]


def test_texts_without_entities_are_unchanged(spark):
    clean = ["Version 2.0 of 1999, page 12345678, at 10:30 on 2024-01-05.", "a" * 300, "C. Brown and Dr. No; 1.2.3 and 3.14159265", "", None]
    got = replaced(spark, clean)
    assert got[0].text == clean[0] and got[1].text == clean[1] and got[3].text == "" and got[4].text is None
    assert [got[i].n_entities for i in (0, 1, 3, 4)] == [0, 0, 0, 0]


@pytest.mark.parametrize("table", [cases.edge, cases.clashing])
def test_edge_rows(spark, table):
    docs = table(spark)
    rows = surrogates.replace_entities(docs, KEY).collect()
    assert sorted(repr((r.row.doc_id, r.text)) for r in rows) == sorted(repr((r.doc_id, r.text)) for r in docs.collect())


def test_empty_table(spark):
    assert surrogates.replace_entities(cases.empty(spark), KEY).count() == 0


def test_query_leaves_no_private_data(spark):
    folder = "/root/testdata/sf0.01"
    private = re.compile(r"[\w.]+@mail\d\.example\.com|\+1 \(\d{3}\) 555-\d{4}|\b(?:\d{1,3}\.){3}\d{1,3}\b|\b\d{16}\b|\b[0-9a-f]{40}\b")
    old = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = {m for text in old.values() for m in private.findall(text)}
    assert len(found) > 50
    for row in queries.op4_surrogates(spark, folder).collect():
        assert not any(m in row.text for m in private.findall(old[row.doc_id]))
        if not private.search(old[row.doc_id]) and not row.n_entities:
            assert row.text == old[row.doc_id]


SCRIPTS = {
    "han": "用户名字@例子公司.中国", "armenian": "Dr Արմեն", "greek": "Dr Νίκος", "greek capitals": "ΝΙΚΟΣ@ΠΑΡΑΔΕΙΓΜΑ.org", "polish": "Mr Łukasiewicz",
    "czech": "Herr Šč", "georgian": "სახელი@მაგალითი.org", "hebrew": "שלום@דוגמה.org", "arabic": "اسم@مثال.org", "thai": "ทดสอบ@ตัวอย่าง.org",
    "hangul": "이름@예시.org", "ethiopic": "ሰላም@ምሳሌ.org", "katakana": "ナマエ@レイ.org", "devanagari": "नाम@उदाहरण.org", "digits": "٣٤٥@٣٤٥٦.org",
    "cherokee": "Dr Ꭰꭱꭲ", "deseret": "Dr 𐐀𐐨𐐩",
}


def test_every_script_has_surrogates(spark):
    texts = [f"Write to {entity} now" for entity in SCRIPTS.values()]
    got = replaced(spark, texts)
    new = [got[i].text.removeprefix("Write to ").removesuffix(" now") for i in range(len(texts))]
    assert all(got[i].n_entities == 1 for i in range(len(texts)))
    for (script, old), surrogate in zip(SCRIPTS.items(), new):
        assert surrogate != old and len(surrogate) >= len(old), (script, surrogate)
        name = old.split("@")[0].split(" ")[-1]
        assert name not in surrogate, (script, surrogate)
    assert len(set(new)) == len(new)
    assert re.fullmatch(r"Dr [Ա-Ֆ][ա-ֆև]{4}", new[1]) and re.fullmatch(r"Dr [\u0370-\u03ff]{5}", new[2])
    assert re.fullmatch(r"[\u4e00-\u4f00]{4}@[\u4e00-\u4f00]{4}\.中国", new[0])


def test_more_short_names_than_there_are_surrogates_of_their_length(spark):
    """All 676 two-letter names: none of that length is free, so surrogates grow."""
    names = [f"{a}{b}" for a in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" for b in "abcdefghijklmnopqrstuvwxyz"]
    got = replaced(spark, [f"Dr {name} came" for name in names])
    new = [got[i].text.split()[1] for i in range(len(names))]
    assert len(set(new)) == len(names) and not set(new) & set(names)
    assert all(re.fullmatch(r"[A-Z][a-z]{2,}", name) for name in new)


def test_an_entity_without_a_free_surrogate_is_masked(spark, monkeypatch):
    monkeypatch.setattr(surrogates, "LAST_ATTEMPT", 0)
    names = [f"{a}{b}" for a in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" for b in "abcdefghijklmnopqrstuvwxyz"]
    got = replaced(spark, [f"Dr {name} came" for name in names])
    new = [re.fullmatch(r"Dr (.+) came", got[i].text)[1] for i in range(len(names))]
    assert len(set(new)) == len(names) and all(re.fullmatch(r"\[name [0-9a-f]{32}\]", name) for name in new)


def test_gender_endings_and_spoken_names(spark):
    got = replaced(spark, ["Иван Петров и Анна Петрова; John Smith"])[0].text
    assert re.fullmatch(r"[А-Я][а-я]+ [А-Я][а-яёѐ-џ]+ов и [А-Я][а-я]+ [А-Я][а-яёѐ-џ]+ова; [A-Z][a-z]+ [A-Z][a-z]{4}", got)
    assert re.fullmatch(r"[^AEIOUY][^aeiouy][aeiouy][^aeiouy]{2}", got.split()[-1])


ENTITY_ROWS = [
    (1, PRIVATE[0], None, None, None), (None, PRIVATE[0], "en", "a", 1), (None, PRIVATE[1], "en", "a", 1), (1, PRIVATE[0], "en", "a", 1),
    (2, PRIVATE[4] + " " + cases.LONG + " " + PRIVATE[2], "en", "b", 1), (3, None, "en", "b", 1), (4, "", None, "b", 1),
    *[(10 + i, f"mail {a}@{b}.org end", "en", "s", 1) for i, (a, b) in enumerate((a, b) for a in "012345" for b in "01")],
]


def test_rows_with_entities_equal_a_plain_replacement(spark):
    """Brute force: cut each text by Python's reading of the patterns and put in the surrogate of each entity, found from the result."""
    docs = spark.createDataFrame(ENTITY_ROWS, cases.SCHEMA).selectExpr("*", "'x' AS attempts", "'y' AS digest0", "'z' AS found")
    rows = surrogates.replace_entities(docs, KEY).collect()
    assert len(rows) == len(ENTITY_ROWS)
    by_text = {}
    for row in rows:
        assert by_text.setdefault(row.row.text, row.text) == row.text
    entities = {r.match: (r.kind, r.entity) for r in surrogate_table(spark, docs)}
    new = {}
    for old, text in by_text.items():
        if not old:
            assert text == old
            continue
        cut = re.split("(" + "|".join(re.escape(m) for m in sorted(entities, key=len, reverse=True)) + ")", old)
        plain, at = cut[::2], 0
        assert text.startswith(plain[0]) and text.endswith(plain[-1])
        pattern = "(.+?)".join(re.escape(part) for part in plain)
        got = re.fullmatch(pattern, text, re.S)
        assert got, (old[:80], text[:80])
        for match, surrogate in zip(cut[1::2], got.groups()):
            kind, entity = entities[match]
            spelled = re.sub(r"\D", "", surrogate) if kind in surrogates.DIGIT_KINDS else surrogate.lower() if kind == "email" else surrogate
            assert new.setdefault((kind, entity), spelled) == spelled
            assert match.lower() != surrogate.lower()
    for kind in {k for k, _ in new}:
        own = [surrogate for (k, _), surrogate in new.items() if k == kind]
        assert len(set(own)) == len(own)
        if kind != "given":
            assert not set(own) & {entity for k, entity in new if k == kind}


def surrogate_table(spark, docs):
    from pyspark.sql import functions as F

    matches = docs.select(F.explode(surrogates.matches_in(F.col("text"))).alias("match")).distinct()
    kinds = matches.withColumn("kind", surrogates.kind_of(F.col("match")))
    return kinds.withColumn("entity", surrogates.entity_of(F.col("kind"), F.col("match"))).collect()
