import hashlib
from collections import defaultdict

import cases
import oracle
import pytest
from pyspark.sql import functions as F

from weatherlake.llm import exact_dedup, queries


def brute(rows):
    groups = defaultdict(list)
    for key, text in rows:
        groups[cases.lower(text)].append(key)
    top = lambda keys: max((k for k in keys if k is not None), default=None)
    return {
        (key, hashlib.sha256(norm.encode()).hexdigest(), top(keys), len(keys))
        for norm, keys in groups.items()
        for key in keys
    }


def check(docs, **options):
    rows = [(row.doc_id, row.text) for row in docs.select("doc_id", "text").collect()]
    marked = exact_dedup.mark_copies(docs, **options)
    got = [(r.doc_id, r.text_sha256, r.keep_id, r.group_size, r.kept) for r in marked.select("row.doc_id", "text_sha256", "keep_id", "group_size", "kept").collect()]
    assert len(got) == len(rows)
    assert {r[:4] for r in got} == brute(rows)
    kept = [r for r in got if r[4]]
    assert len({r[1] for r in kept}) == len(kept) == len({r[1] for r in got})
    assert all(r[0] == r[2] for r in kept)


@pytest.mark.parametrize("table", [cases.edge, cases.documents, cases.clashing])
def test_equals_brute_force(spark, table):
    check(table(spark))


def test_colliding_hashes_are_told_apart_by_bytes(spark):
    check(cases.edge(spark), hash_of=lambda text: F.unhex(F.substring(F.md5(text), 1, 1).substr(1, 1)))
    check(cases.documents(spark), hash_of=lambda text: F.lit(b"same"))


def test_a_group_of_a_third_of_the_rows(spark):
    docs = spark.range(6000).selectExpr(
        "id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'Copy' ELSE concat('text ', id) END AS text", "'en' AS lang", "'s' AS source", "1L AS n_chars"
    )
    check(docs)


def test_empty_table_and_columns(spark):
    assert exact_dedup.mark_copies(cases.empty(spark)).count() == 0
    docs = cases.clashing(spark)
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns and kept.count() == len({cases.lower(r.text) for r in docs.collect()})


def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.01"
    got = oracle.rows_of_spark(queries.op7_exact_dedup(spark, folder))
    want = oracle.rows_of_duckdb(oracle.connect(folder), queries.SQL["op7_exact_dedup"])
    assert oracle.difference(got, want) is None


def test_groups_too_many_to_be_sent(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "FEW_GROUPS", 1)
    for table in (cases.edge, cases.documents):
        check(table(spark))
    check(spark.range(4000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'Copy' ELSE concat('text ', id DIV 2) END AS text"))


def test_rows_that_repeat_id_and_text(spark):
    docs = spark.range(3000).selectExpr("CASE WHEN id % 2 = 0 THEN 7 ELSE id END AS doc_id", "CASE WHEN id % 2 = 0 THEN 'Same' ELSE concat('text ', id) END AS text")
    check(docs)
    check(docs.selectExpr("CASE WHEN doc_id = 7 THEN NULL ELSE doc_id END AS doc_id", "text"))


def test_no_text_of_a_single_row_is_moved(spark):
    docs = cases.documents(spark)
    plan = exact_dedup.mark_copies(docs).select("row.doc_id", "keep_id", "kept")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
