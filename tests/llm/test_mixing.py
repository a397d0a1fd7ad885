import cases
import pytest

from weatherlake.llm import mixing, queries


def brute_targets(sizes, cap=3):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(cap * sizes[s] for s in full)
        free = sum(weight[s] for s in sizes if s not in full)
        goal = {s: cap * sizes[s] if s in full else rest * weight[s] / free for s in sizes}
        over = {s for s in sizes if s not in full and goal[s] > cap * sizes[s]}
        if not over:
            return goal
        full |= over


@pytest.mark.parametrize("table", [cases.edge, cases.documents, cases.clashing])
def test_sizes_targets_and_what_is_taken(spark, table):
    docs = table(spark)
    sizes = {}
    for row in docs.collect():
        sizes[row.source] = sizes.get(row.source, 0) + len(cases.words(row.text))
    goal = brute_targets(sizes)
    got = mixing.mixed(docs).collect()
    assert len(got) == docs.count()
    taken, largest = {}, {}
    for row in got:
        assert row["size"] == len(cases.words(row.row.text))
        assert row.source_size == sizes[row.source] and row.target == pytest.approx(goal[row.source])
        assert 0 <= row.times <= 3
        taken[row.source] = taken.get(row.source, 0) + row["size"] * row.times
        largest[row.source] = max(largest.get(row.source, 0), row["size"])
    for source, want in goal.items():
        assert abs(taken[source] - want) <= largest[source]


def test_reruns_and_the_mixed_table_agree(spark):
    docs = cases.documents(spark)
    first = {row.row.doc_id: row.times for row in mixing.mixed(docs).collect()}
    again = {row.row.doc_id: row.times for row in mixing.mixed(docs.repartition(7)).collect()}
    assert first == again
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    counts = {row.doc_id: row["count"] for row in mixed.groupBy("doc_id").count().collect()}
    assert counts == {key: n for key, n in first.items() if n}


def test_a_larger_budget_holds_the_smaller(spark):
    docs = spark.range(2000).selectExpr("id AS doc_id", "repeat('w ', int(1 + id % 50)) AS text", "'s' AS source")
    rows = mixing.sized(docs).select("source", "hash", "size")
    size = rows.groupBy().sum("size").first()[0]
    below = []
    for share in (0.0, 0.1, 0.5, 0.51, 0.999):
        wanted = spark.createDataFrame([("s", size, share * size)], "source STRING, source_size LONG, target DOUBLE")
        cut = mixing.thresholds(rows, wanted, mixing.histogram(rows, 0)).first()
        taken = rows.where(f"hash < {cut.below}").groupBy().sum("size").first()[0] or 0
        assert abs(taken - share * size) <= 25
        below.append(cut.below)
    assert below == sorted(below)


def test_empty_table(spark):
    assert mixing.mixed(cases.empty(spark)).count() == 0 and mixing.mix(cases.empty(spark)).columns == cases.empty(spark).columns


def test_tables_without_words(spark):
    docs = spark.createDataFrame([(1, None, "en", "a", 1), (2, " ", "en", None, 1)], cases.SCHEMA)
    assert [(row["size"], row.target) for row in mixing.mixed(docs).collect()] == [(0, 0.0), (0, 0.0)]


def test_query_columns(spark):
    got = queries.op10_mixing(spark, "/root/testdata/sf0.001")
    assert {"doc_id", "size", "source_size", "target", "taken"} <= set(got.columns)
    assert got.where("taken > 3 * size").isEmpty()
