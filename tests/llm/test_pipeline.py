import cases
import pyarrow as pa

import __spark_entry__ as driver
import corpus_pipeline
from weatherlake.llm import common, exact_dedup, mixing, near_dedup, piece_bpe, quality
from weatherlake.llm.queries import PIECE_TOKENIZER, tokenizer_path

FOLDER = "/root/testdata/sf0.001"


def test_each_stage_is_its_operator_on_what_the_one_before_kept(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    operators = [
        quality.keep_good,
        exact_dedup.drop_copies,
        near_dedup.drop_near_copies,
        mixing.mix,
        lambda d: piece_bpe.encode_documents(d, tokenizer_path(PIECE_TOKENIZER)),
    ]
    assert len(corpus_pipeline.STAGES) == len(operators)
    sizes = [docs.count()]
    for i, ((_, stage), operator) in enumerate(zip(corpus_pipeline.STAGES, operators)):
        got = stage(spark, docs, FOLDER)
        got.write.parquet(str(tmp_path / str(i)))
        want = operator(docs)
        got = spark.read.parquet(str(tmp_path / str(i)))
        assert got.columns == (docs.columns if i < 4 else want.columns)
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
        docs = got
        sizes.append(docs.count())
    assert sizes[0] > sizes[1] > sizes[2] >= sizes[3] and sizes[4] == sizes[5]
    assert corpus_pipeline.run(spark, FOLDER).exceptAll(docs).isEmpty()


def test_edge_rows_pass_all_stages(spark):
    docs = cases.clashing(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
    assert docs.count() > 0


def test_an_empty_table_passes_all_stages(spark):
    docs = cases.empty(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
    assert docs.count() == 0


def test_queries_are_registered():
    names = set(driver.queries())
    assert "pipeline" in names
    assert all(any(name.startswith(f"op{n}_") for name in names) for n in range(1, 11))


def test_tasks_work_on_parts_of_a_batch(monkeypatch):
    monkeypatch.setattr(common, "PART_ROWS", 1000)
    batch = pa.record_batch({"doc_id": pa.array(range(2500), pa.int64())})
    parts = [*common.in_parts(iter([batch.slice(0, 0), batch, batch.slice(0, 1000)]))]
    assert [part.num_rows for part in parts] == [1000, 1000, 500, 1000]
    assert pa.Table.from_batches(parts[:3])["doc_id"].to_pylist() == [*range(2500)]


def test_sets_are_made_for_parts_of_a_batch(spark, monkeypatch):
    """No batch of sets that a task hands on has more rows than a part, whatever it reads at once."""
    docs = spark.createDataFrame([(i, f"a b c d e {i}") for i in range(2500)], "doc_id LONG, text STRING").coalesce(1)
    seen = []

    def caught(self, work, ddl):
        seen.extend(b.num_rows for b in work(iter([pa.record_batch({"node": ids, "text": texts})])))
        return self

    ids, texts = pa.array(range(2500), pa.int64()), pa.array([f"a b c d e {i}" for i in range(2500)])
    monkeypatch.setattr(type(docs), "mapInArrow", caught)
    near_dedup.shingle_sets(docs, docs.select(docs.doc_id.alias("node")), "doc_id", "text")
    assert seen == [1000, 1000, 500]
