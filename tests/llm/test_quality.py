import math
import re

import cases
import oracle
import pytest

from weatherlake.llm import quality, queries


def brute(text):
    words, text = cases.words(text), text or ""
    starts = {}
    for i in range(len(words) - 4):
        starts.setdefault(tuple(words[i : i + 5]), []).append(i)
    covered = {p for at in starts.values() if len(at) > 1 for i in at for p in range(i, i + 5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if cases.words(line):
            dup += line in seen
            seen.add(line)
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": dup,
        "n_repeat_words": len(covered),
        "base_failed": len(words) < 10 or 100 * len(covered) > 20 * len(words),
    }


@pytest.mark.parametrize("table", [cases.edge, cases.documents, cases.clashing])
def test_base_counts_equal_brute_force(spark, table):
    docs = table(spark)
    texts = [row.text for row in docs.select("text").collect()]
    got = cases.rows(quality.score(docs))
    assert len(got) == len(texts)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    key = lambda row: repr([row[name] for name in names])
    assert sorted(map(key, got)) == sorted(key(brute(text)) for text in texts)
    assert all(not row["kept"] for row in got if row["base_failed"])


def test_repeats_that_overlap_and_touch(spark):
    texts = ["a b c d e a b c d e x y", "a a a a a a a", "a b c d e f g h i j k a b c d e f z", "x " * 9]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], cases.SCHEMA)
    got = cases.by_id(quality.score(docs))
    assert [got[i]["n_repeat_words"] for i in range(4)] == [brute(t)["n_repeat_words"] for t in texts] == [10, 7, 12, 9]


def test_windows_of_one_hash_are_compared(spark, monkeypatch):
    docs = spark.createDataFrame([(0, "a b c d e f g h i j", "en", "s", 1), (1, "a b c d e x a b c d e y", "en", "s", 1)], cases.SCHEMA)
    monkeypatch.setattr(quality.F, "xxhash64", lambda *columns: quality.F.lit(7).cast("long"))
    got = cases.by_id(quality.score(docs))
    assert [got[i]["n_repeat_words"] for i in range(2)] == [0, 10]


def test_empty_table(spark):
    assert quality.score(cases.empty(spark)).count() == 0
    assert quality.keep_good(cases.empty(spark)).columns == cases.empty(spark).columns


def test_distance_is_jensen_shannon(spark):
    row = spark.sql("SELECT array(3L, 1L, 0L) AS a, 4L AS n, array(10L, 0L, 30L) AS b, 40L AS m, array(0L) AS z, 0L AS o")
    got = row.select(
        quality.jensen_shannon("a", "n", "b", "m"), quality.jensen_shannon("a", "n", "a", "n"), quality.jensen_shannon("z", "o", "b", "m")
    ).first()
    p, q = [0.75, 0.25, 0], [0.25, 0, 0.75]
    middle = [(x + y) / 2 for x, y in zip(p, q)]
    part = lambda d: sum(x * math.log2(x / m) for x, m in zip(d, middle) if x)
    assert got[0] == pytest.approx(math.sqrt((part(p) + part(q)) / 2))
    assert got[1] == 0 and got[2] is None


def test_far_texts_go_and_short_ones_are_not_judged(spark):
    good = [(i, f"{cases.PROSE} It is number {i} of the many that are written for this test, and so on.", "en", "s", 1) for i in range(60)]
    junk = " ".join(f"{i:x}$$$ ###%% {i}&&|" for i in range(60))
    docs = spark.createDataFrame([*good, (100, junk, "en", "s", 1), (101, "a$ b# c% d& e$ f# g% h& i$ j#", "en", "s", 1)], cases.SCHEMA)
    got = cases.by_id(quality.score(docs))
    assert not got[100]["kept"] and not got[100]["base_failed"]
    assert got[101]["kept"] and got[101]["class_distance"] is None
    assert all(got[i]["kept"] for i in range(60))
    assert {row.doc_id for row in quality.keep_good(docs).collect()} == {*range(60), 101}


def test_good_documents_are_kept_and_bad_ones_are_often_not(spark):
    folder = "/root/testdata/sf0.01"
    kept = queries.op1_quality_rules(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    found = {(row.quality, row.kept): row["count"] for row in kept.where("not base_failed").groupBy("quality", "kept").count().collect()}
    assert found.get((1, False), 0) == 0
    assert found[0, False] >= found[0, True]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, sf):
    folder = f"/root/testdata/{sf}"
    got = oracle.rows_of_spark(queries.op1_quality_rules(spark, folder))
    want = oracle.rows_of_duckdb(oracle.connect(folder), queries.SQL["op1_quality_rules"])
    assert oracle.difference(got, want) is None


def test_keep_good_equals_score(spark):
    docs = cases.documents(spark)
    scored = {row.doc_id for row in quality.score(docs).where("kept").collect()}
    good = quality.keep_good(docs)
    assert good.columns == docs.columns and {row.doc_id for row in good.collect()} == scored


def test_wrong_language_and_no_common_words_are_far_by_words_alone(spark):
    docs = cases.documents(spark)
    good = {row.lang: row.text for row in docs.where("n_chars > 1500 and lang in ('en', 'de')").orderBy("doc_id", ascending=False).collect()}
    without = " ".join(w for w in good["en"].split() if not set(re.findall(r"[^\W_]+", w.lower())) & set(quality.COMMON_WORDS["en"]))
    more = spark.createDataFrame([(-1, good["de"], "en", "s", 1), (-2, without, "en", "s", 1), (-3, good["en"], "en", "s", 1)], cases.SCHEMA)
    got = cases.by_id(quality.score(docs.unionByName(more)))
    assert all(not got[i]["base_failed"] and got[i]["class_distance"] <= quality.MAX_CLASS_DISTANCE for i in (-1, -2, -3))
    assert [got[i]["kept"] for i in (-1, -2, -3)] == [False, False, True]


def test_word_limit_follows_the_language(spark):
    def text(seed, n, common):
        made = lambda k: "".join(chr(97 + k // 26**digit % 26) for digit in range(5))
        return " ".join("the" if common and i % 12 == 0 else made(1009 * seed + 31 * i) for i in range(n))

    # Common words are a twelfth of this language's words: 240 words should have 20, 120 words 10.
    good = [(i, text(i, 240, True), "en", "s", 1) for i in range(60)]
    docs = spark.createDataFrame([*good, (100, text(100, 240, False), "en", "s", 1), (101, text(101, 120, False), "en", "s", 1)], cases.SCHEMA)
    got = cases.by_id(quality.score(docs))
    assert all(got[i]["kept"] for i in range(60))
    assert not got[100]["kept"] and got[100]["word_distance"] < 0.3 and not got[100]["base_failed"]
    assert got[101]["kept"] and got[101]["word_distance"] is None
