"""The pipeline's stages against what each operator says, over a whole table."""

import collections

import pyarrow as pa
import pytest

import corpus_pipeline
from tradewind.llm import decontaminate, language, neardup, quality
from tradewind.session import scratch
from tradewind.sources.files import names

SF = "/root/testdata/sf0.001"


def test_each_stage_takes_effect_on_what_the_one_before_kept(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, ids = docs.columns, {r["doc_id"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.stored(stage(spark, docs, SF))
        kept = {r["doc_id"] for r in out.select("doc_id").collect()}
        assert out.columns == columns and kept <= ids and out.count() == len(kept)
        if name == "near_duplicates":
            again = neardup.near_duplicates(docs, neardup.Settings(shingle=5))
            assert kept == {r["doc_id"] for r in again.where("kept").collect()}
        if name == "decontamination":
            items = spark.read.parquet(f"{SF}/benchmark.parquet")
            assert ids - kept == {r["doc_id"] for r in decontaminate.contaminations(docs, items).collect()}
        docs, ids = out, kept
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r["doc_id"] for r in rows} == ids
    held = collections.Counter()
    for r in rows:
        held[r["sequence_id"]] += r["length"]
    assert max(held.values()) <= 4096


def test_stages_of_odd_rows(spark):
    rows = [(None, None, None, None, None), (1, "", None, "", 0), (2, "a b c", "en", "s", 5), (2, "a b c", "en", "s", 5), (3, "word " * 40_000, "en", None, -1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for table in (docs, docs.where("false")):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, table, SF)
            assert out.count() <= max(table.count(), 60)
    assert {r["doc_id"] for r in corpus_pipeline.keep_language(spark, docs, SF).collect()} == {2, 3}
    assert sorted(str(r["doc_id"]) for r in corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()) == ["1", "2", "3", "None"]


def test_names_and_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "language", "near_duplicates", "decontamination", "packing"]
    assert language.UNKNOWN == "und" and 0 < corpus_pipeline.LEAST_QUALITY < 1 and quality.PASSAGE > 0


def test_stages_run_in_small_batches(spark, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "AT_ONCE", 7)

    @corpus_pipeline.in_small_batches
    def sizes(spark, docs, sf_dir):
        return docs.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"rows": [len(b)]}) for b in batches), "rows long")

    before = spark.conf.get(corpus_pipeline.BATCH_ROWS)
    found = [r["rows"] for r in sizes(spark, spark.range(100), "").collect()]
    assert sum(found) == 100 and max(found) <= 7 and spark.conf.get(corpus_pipeline.BATCH_ROWS) == before
    assert all(hasattr(stage, "__wrapped__") for _, stage in corpus_pipeline.STAGES)


def test_packing_in_small_batches_is_the_same(spark, monkeypatch):
    docs = spark.createDataFrame([(k, f"some words {k} " * (k % 50)) for k in range(200)], "doc_id long, text string")
    whole = sorted(map(tuple, corpus_pipeline.pack_sequences(spark, docs, "").select("doc_id", "start", "length", "ids_crc32").collect()))
    monkeypatch.setattr(corpus_pipeline, "AT_ONCE", 9)
    packed = corpus_pipeline.pack_sequences(spark, docs, "").select("doc_id", "start", "length", "ids_crc32")
    assert sorted(map(tuple, packed.collect())) == whole


def test_stages_leave_no_more_than_their_results(spark, tmp_path):
    copied, docs = {}, spark.read.parquet(f"{SF}/documents.parquet")
    with scratch(spark, str(tmp_path)) as own:
        for name, stage in corpus_pipeline.STAGES:
            before = set(names(spark, own))
            found = stage(spark, docs, SF)
            left = set(names(spark, own)) - before
            assert len(left) == 1
            copied[name] = "text" in spark.read.parquet(f"{own}/{left.pop()}").columns
            rows, docs = found.count(), found
            assert rows > 0
    # What near_duplicates keeps is read where it was.
    assert copied == {"quality": True, "language": True, "near_duplicates": False, "decontamination": True, "packing": False}


def test_the_pipeline_leaves_its_last_result_only(spark, tmp_path):
    with scratch(spark, str(tmp_path)) as own:
        packed = corpus_pipeline.run(spark, SF)
        assert len(names(spark, own)) == 1 and packed.count() > 0 and "ids_crc32" in packed.columns


def test_a_stage_that_fails_leaves_nothing(spark, tmp_path):
    @corpus_pipeline.in_small_batches
    def broken(spark, docs, sf_dir):
        corpus_pipeline.stored(docs)
        raise ValueError("broken")

    with scratch(spark, str(tmp_path)) as own:
        with pytest.raises(ValueError, match="broken"):
            broken(spark, spark.range(3), "")
        assert names(spark, own) == []
