"""The pipeline as a whole against plain decisions, its stages on awkward rows, and the contract."""

import hashlib
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from airledger.llm import language, quality, queries
from tests.llm.test_simhash import brute

DATA = "/root/testdata/sf0.001"


def test_rows_that_come_out(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    tongue = language.train(docs)
    rows = [r for r in docs.collect()]
    names, scores = tongue.classify([r.text or "" for r in rows])
    rows = [r for r, n, s in zip(rows, names, scores) if n != "und"]
    kept = spark.createDataFrame(rows, docs.schema)
    judge = quality.train(kept, spark.read.parquet(f"{DATA}/labels.parquet"))
    rows = [r for r, s in zip(rows, judge.scores([r.text for r in rows])) if s >= quality.THRESHOLD]
    firsts = {c for _, _, c in brute([(r.doc_id, r.text) for r in rows])}
    items = [r.text.lower() for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    rows = [r for r in rows if r.doc_id in firsts and not any(i in r.text.lower() for i in items)]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {}
    for row in rows:
        ids = library.encode(row.text, add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want[row.doc_id] = (
            len(ids), *(hashlib.sha256(t.encode()).hexdigest() for t in (" ".join(map(str, ids)), decoded))
        )
    got = corpus_pipeline.run(spark, DATA).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == want
    assert len(got) == len(want) < docs.count()


@pytest.mark.parametrize("number", range(5))
def test_stages_on_awkward_rows(spark, odd, empty, number):
    name, stage = corpus_pipeline.STAGES[number]
    for frame in (odd, empty):
        got = stage(spark, frame, DATA)
        rows = got.collect()
        assert len(rows) <= frame.count()
        if number < 4:
            assert got.columns == frame.columns
            assert not Counter(map(str, rows)) - Counter(map(str, frame.collect()))
    assert stage(spark, empty, DATA).count() == 0


def test_each_stage_decides(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    blank = docs.withColumn("text", F.when(F.col("doc_id") < 5, "123 ...").otherwise(F.col("text")))
    assert corpus_pipeline.language_id(spark, blank, DATA).filter("doc_id < 5").count() == 0
    for stage in (corpus_pipeline.quality_filter, corpus_pipeline.near_duplicates, corpus_pipeline.decontamination):
        assert 0 < stage(spark, docs, DATA).count() < docs.count()


def test_contract():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "quality", "near_duplicates", "decontamination", "tokens"
    ]
    registered = contract.queries()
    assert set(queries.QUERIES) <= set(registered)
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)} | {"pipeline"}
    assert set(queries.ORACLE_SQL) <= set(contract.oracle_sql())


def test_nothing_else_imports_the_package():
    import pathlib
    import re

    root = pathlib.Path(contract.__file__).parent
    for path in [*root.glob("airledger/**/*.py"), *root.glob("tests/*.py"), root / "bench.py"]:
        if "llm" not in path.parts:
            assert not re.search(r"^\s*(from|import) .*\bllm\b", path.read_text(), re.M), path


def test_the_language_stage_rejects_exactly_the_unknown(spark, monkeypatch):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    unsure = language.train(docs)
    unsure.weights, unsure.bias = unsure.weights * 0, unsure.bias * 0  # every score is that of a guess
    monkeypatch.setattr(language, "train", lambda docs: unsure)
    mixed = docs.withColumn("text", F.when(F.col("doc_id") < 5, "123 ...").when(F.col("doc_id") < 9, "Ωμέγα και άλφα").otherwise(F.col("text")))
    known = language.predict(mixed, unsure).filter("lang_pred <> 'und'")
    got = corpus_pipeline.language_id(spark, mixed, DATA)
    assert sorted(r.doc_id for r in got.collect()) == sorted(r.doc_id for r in known.collect())
    assert 0 < known.count() < docs.count() and known.filter("doc_id < 5").count() == 0
