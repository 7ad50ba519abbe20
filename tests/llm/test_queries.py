"""Registered queries against their SQL, and the pipeline against brute force."""

import hashlib

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from reportloom.llm import quality
from reportloom.llm.registry import ORACLES
from tests.compare import compare

from .brute import contained, cut, near


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, sf_dir, name):
    assert compare(spark, sf_dir, name) is None


def test_all_operators_are_registered():
    named = entry.queries()
    assert all(sum(q.startswith(f"op{n}_") for q in named) == 1 for n in range(1, 14)) and "pipeline" in named


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    good = {r.doc_id for r in quality.score(docs, labels).filter("predicted = 1").collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id in good]
    group = near(rows, 80)
    rows = [(d, t) for d, t in rows if group[d][1] == d]
    kept = cut(rows, 100)
    rows = [(d, kept[k][4].decode("utf-8", "ignore")) for k, (d, _) in enumerate(rows)]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    leaks = {d for d, _ in contained(rows, items)}
    want = {d: hashlib.sha256(t.encode()).hexdigest() for d, t in rows if d not in leaks}
    assert {r.doc_id: r.decoded_sha256 for r in corpus_pipeline.run(spark, sf_dir).collect()} == want


def test_stages_take_odd_rows(spark, sf_dir):
    rows = [(1, "a b c d e f", "en", None, 11), (2, None, None, "s", None), (None, "x y", "en", "s", 3), (3, "", "en", "s", 0), (3, "", "en", "s", 0), (4, "a b c d e f", "en", "s", 11)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for df in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, df, sf_dir).columns == docs.columns
            stage(spark, df, sf_dir).collect()
        corpus_pipeline.STAGES[-1][1](spark, df, sf_dir).collect()
    kept = corpus_pipeline.keep_one_of_each(spark, docs, sf_dir)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3]
