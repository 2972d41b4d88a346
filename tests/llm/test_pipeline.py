"""The corpus pipeline beside plain versions of its stages, on a small corpus with planted cases."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import corpus_pipeline  # noqa: E402
from test_llm_operators import SCHEMA, fixture_rows, jaccard_naive, lines_naive, text_of  # noqa: E402

from metforge.llm import decontaminate, mixing, quality_rules  # noqa: E402


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """A folder with documents and a benchmark; ids are unique here, as in the tables of the pipeline."""
    path = str(tmp_path_factory.mktemp("corpus"))
    rows = list({r[0]: r for r in fixture_rows()}.values())
    leak = " ".join(text_of(60, 4242).split()[10:30])
    rows += [(100, text_of(60, 4242), "en", "s1", 0), (101, "Prefix words here. " + text_of(50, 4243), "en", "s2", 0)]
    items = [(1, leak), (2, "never seen words of a clean item that no document holds at all")]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, rows, items


def test_run_beside_plain_stages(spark, corpus):
    path, rows, items = corpus
    docs = spark.read.parquet(f"{path}/documents.parquet")
    good = {r.doc_id for r in quality_rules.quality_rules(docs).collect() if r.kept}
    kept = {r[0]: r for r in rows if r[0] in good}
    lines = lines_naive([kept[i] for i in kept])
    text = {i: lines[i][3] for i in kept if not 0 < lines[i][0] == lines[i][1]}
    groups = jaccard_naive(list(text.items()))
    text = {i: t for i, t in text.items() if groups[i][1] == i}
    text = {i: t for i, t in text.items() if not decontaminate.naive(t, items)[1]}
    left = spark.createDataFrame([(i, t, kept[i][3]) for i, t in text.items()], "doc_id bigint, text string, source string")
    copies = {r.doc_id: r.copies for r in mixing.mix(left).collect() if r.copies}

    out = corpus_pipeline.run(spark, path)
    assert out.columns == [*docs.columns, "copies"]
    got = {r.doc_id: r for r in out.collect()}
    assert {i: r.copies for i, r in got.items()} == copies
    assert all(r.text == text[i] for i, r in got.items())
    assert 100 not in got  # holds a benchmark passage
    assert all(r.n_chars == len(r.text) for i, r in got.items() if lines[i][1])


def test_stages_return_the_columns_of_documents(spark, corpus):
    path, _, _ = corpus
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, path)
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]


def test_empty_corpus(spark, corpus):
    path, _, _ = corpus
    docs = spark.read.parquet(f"{path}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, path).collect() == []
