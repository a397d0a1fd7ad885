import random
import re
from collections import Counter, defaultdict

import cases
import duckdb
import numpy as np
import pyarrow as pa
import pytest

from weatherlake.llm import queries, source_audit, sql

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(cases.lower(text))


def expected(rows, least=3, ranks=200):
    """(lang, source, part, item, value, rank) by plain counting."""
    rows = [(row["lang"] or "", row["source"] or "", terms(row["text"])) for row in rows]
    docs, counts = defaultdict(Counter), defaultdict(lambda: defaultdict(Counter))
    for lang, source, found in rows:
        docs[lang].update(set(found))
        counts[lang][source].update(found)
    out = []
    for lang, by_source in counts.items():
        kept = [term for term, n in docs[lang].items() if n >= least]
        vocabulary = len(kept)

        def shares(own):
            total = sum(own[term] for term in kept)
            return {term: 1 + 10**9 * (own[term] + 1) // (total + vocabulary) for term in kept}

        p = {source: shares(own) for source, own in by_source.items()}
        q = shares(sum(by_source.values(), Counter()))
        for source, own in by_source.items():
            pairs = [(sum((p[source][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in by_source if o != source]
            high = [((p[source][t] - q[t]) ** 2 // q[t], t) for t in kept if own[t] and p[source][t] > q[t]]
            for part, items, limit in (("pair", pairs, None), ("term", high, ranks)):
                items.sort(key=lambda item: (-item[0], item[1].encode()))
                out += [(lang, source, part, name, value, i + 1) for i, (value, name) in enumerate(items[:limit])]
    return sorted(out)


def rows_of(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("table", [cases.edge, cases.clashing, cases.documents, cases.empty])
@pytest.mark.parametrize("least", [1, 3])
def test_equals_plain_counts(spark, table, least):
    docs = table(spark)
    assert rows_of(source_audit.audit(docs, least_documents=least)) == expected(docs.collect(), least)


def mixed(spark):
    """Terms of every length around the word bounds, in several scripts, over few and many sources."""
    rng = random.Random(11)
    vocabulary = ["a" * n for n in (1, 7, 8, 9, 15, 16, 17, 18, 31, 200)] + ["Ab", "aB", "é", "É", "中文字", "中文字中文字", "ж" * 9, "naïve", "zebra", "zebrb", "😀", "x" * 17, "x" * 16 + "y"]
    rows = []
    for i in range(400):
        text = rng.choice([" ", ".", "\n", "_", "1"]).join(rng.choice(vocabulary) for _ in range(rng.randint(0, 40)))
        rows.append((i, text, rng.choice(["en", "de", None]), rng.choice([None, "", *[f"s{k}" for k in range(12)], "ü"])))
    return spark.createDataFrame([*rows, (None, None, "empty", "one"), (1, "123", "empty", "two")], "doc_id LONG, text STRING, lang STRING, source STRING")


def test_lengths_scripts_and_sources(spark):
    docs = mixed(spark)
    got = rows_of(source_audit.audit(docs))
    assert got == expected(docs.collect())
    assert ("empty", "one", "pair", "two", 0, 1) in got


def test_few_ranks(spark):
    docs = mixed(spark)
    assert rows_of(source_audit.audit(docs, term_ranks=4)) == expected(docs.collect(), ranks=4)


def test_query_equals_its_sql(spark):
    folder = "/root/testdata/sf0.01"
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
        want = sorted(map(tuple, db.sql(sql.SOURCE_AUDIT).fetchall()))
    assert rows_of(queries.op13_source_audit(spark, folder)) == want


def test_counts_of_random_bytes():
    rng = random.Random(2)
    alphabet = "aZ.é中 \n😀b"
    for _ in range(200):
        texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(rng.randint(1, 6))]
        groups = np.array([rng.randint(0, 2) for _ in texts])
        skipped = rng.randint(0, len(texts) - 1)
        array = pa.array(texts).slice(skipped)
        texts, own = texts[skipped:], groups[skipped:]
        want, in_texts = Counter(), Counter()
        for text, group in zip(texts, own):
            want.update((group, term) for term in terms(text))
            in_texts.update((group, term) for term in set(terms(text)))
        got = {}
        for of, found, counts, docs in source_audit.count_runs(*source_audit.text_bytes(array), own):
            for group, term, n, m in zip(of, found, counts, docs):
                assert (group, term.decode()) not in got
                got[group, term.decode()] = (n, m)
        assert got == {key: (n, in_texts[key]) for key, n in want.items()}


def test_radix_order_is_stable():
    rng = np.random.default_rng(3)
    words = [rng.integers(0, 3, 5000).astype(np.uint64), rng.integers(0, 1 << 63, 5000).astype(np.uint64) >> np.uint64(40)]
    assert source_audit.radix_order(words).tolist() == np.lexsort(words[::-1]).tolist()


def test_shares_are_exact_beyond_64_bits(spark):
    row = spark.range(1).selectExpr("9000000000000L AS n", "90000000000000L AS total", "7L AS vocabulary")
    got = row.select(source_audit.share(row.n, row.total, row.vocabulary)).first()[0]
    assert got == 1 + 10**9 * 9000000000001 // 90000000000007
