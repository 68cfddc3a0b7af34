"""The corpus pipeline, stage by stage, against plain Python."""

from __future__ import annotations

import brute
import pytest
from test_corpus import check_packing

import __spark_entry__ as entry
import corpus_pipeline

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows that every stage returned, each stage fed with the one before."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, SMALL).write.parquet(path)
        docs = out[name] = spark.read.parquet(path)
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_keep_the_columns(stages):
    columns = stages["documents"].columns
    for name in ("quality", "lines", "near_duplicates", "privacy"):
        assert stages[name].columns == columns


def test_quality(stages):
    given = texts(stages["documents"])
    assert texts(stages["quality"]) == {i: t for i, t in given.items() if brute.quality_kept(t)}


def test_lines(stages):
    want = {i: t for i, _, _, t in brute.line_dedup_texts(list(texts(stages["quality"]).items()))}
    assert texts(stages["lines"]) == want


def test_near_duplicates(stages):
    given = texts(stages["lines"])
    groups = brute.jaccard_components(list(given.items()))
    assert texts(stages["near_duplicates"]) == {i: t for i, t in given.items() if groups[i][1] == i}


def test_privacy(stages):
    given, got = texts(stages["near_duplicates"]), texts(stages["privacy"])
    assert set(given) == set(got)
    for i, t in given.items():
        if sum(brute.pii(t)[:4]):
            assert not sum(brute.pii(got[i])[:4]) and got[i] != t
        else:
            assert got[i] == t


def test_pack(stages):
    check_packing(stages["pack"].collect(), texts(stages["privacy"]))


def test_run_is_registered_and_equals_the_stages(spark, stages):
    rows = entry.queries()["pipeline"](spark, SMALL)
    assert rows.columns == stages["pack"].columns
    key = ["doc_id", "start", "length", "ids_crc32"]
    assert rows.agg({"doc_tokens": "sum", "length": "sum"}).collect()[0]["sum(length)"] == \
        stages["pack"].agg({"length": "sum"}).collect()[0][0]
    assert {r.doc_id for r in rows.select("doc_id").collect()} == {r.doc_id for r in stages["pack"].select(*key).collect()}


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
        assert docs.count() == 0
        if docs.columns[0] != "doc_id":
            break


def test_pack_leaves_no_chunks_in_its_worker(spark):
    """Between tasks a worker keeps the tokenizer, but none of the chunks it has encoded."""
    import pyarrow as pa

    from stratum.llm import packing, tokens
    path = tokens.default_path()
    docs = spark.createDataFrame([(i, f"words of document {i} " * 50) for i in range(200)], "doc_id long, text string").coalesce(1)
    assert packing.pack(docs).count()

    def held(batches):
        for batch in batches:
            cache = tokens._LIBRARY.get(path)
            n = -1 if cache is None else len(cache.chunks.known) + len(cache.chunks.older)
            yield pa.RecordBatch.from_arrays([pa.array([n] * batch.num_rows, pa.int64())], ["n"])

    # Idle workers are taken in turn, so these tasks meet the one that has packed.
    found = {r.n for r in spark.range(0, 64, 1, 64).mapInArrow(held, "n long").collect()} - {-1}
    assert found == {0}


def test_tidy_gives_memory_back_and_forgets(monkeypatch):
    import pyarrow as pa

    from stratum.llm import common
    said = []
    monkeypatch.setattr(common, "give_back", lambda: said.append("given back"))
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2])], ["x"])
    run = common.tidy(lambda batches: (b for b in batches), lambda: said.append("forgotten"))
    assert [b.num_rows for b in run(iter([batch, batch]))] == [2, 2] and said == ["forgotten", "given back"]

    def fails(batches):
        yield next(batches)
        raise ValueError

    with pytest.raises(ValueError):
        list(common.tidy(fails)(iter([batch])))
    assert said[-1] == "given back" and len(said) == 3
