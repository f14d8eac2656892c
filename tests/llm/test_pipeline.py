"""The pipeline against its stages done by hand."""

import hashlib
import os

import pytest
from fixtures import components, odd_docs, symbol_words
from tokenizers import Tokenizer

import corpus_pipeline
import public_tokenizers
from nearspark.llm import quality

FOLDER = "/root/testdata/sf0.001"


def contaminated(text, items):
    joined = f" {' '.join(symbol_words(text.lower()))} "
    return any(f" {' '.join(symbol_words(i.lower()))} " in joined for i in items)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not here")
def test_run(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    items = [r["text"] for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    kept = {r["doc_id"] for r in quality.judge(docs).filter("kept").collect()}
    rows = [(r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] in kept]
    first = {c for _, _, c in components(rows)}
    left = [(i, t) for i, t in rows if i in first and not contaminated(t, items)]
    assert 0 < len(left) < len(first) < len(rows) < docs.count()
    plain = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    expected = []
    for i, t in left:
        ids = plain.encode(t, add_special_tokens=False).ids
        expected.append((i, len(ids), hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in ids)).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    assert sorted(map(tuple, corpus_pipeline.run(spark, FOLDER).collect())) == sorted(expected)


def test_stages_on_odd_and_empty_tables(spark, tmp_path):
    spark.createDataFrame([(1, "w1 w2"), (2, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for rows in (None, []):
        docs = odd_docs(spark, rows)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            result = stage(spark, docs, str(tmp_path))
            assert result.columns == docs.columns
            docs_left = result.count()
            assert docs_left <= docs.count() and (rows is None or docs_left == 0)
        assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == docs.count()
