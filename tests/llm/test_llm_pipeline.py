"""The pipeline against a plain version of each stage, each on its own input."""

import re

import __spark_entry__ as contract
import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from tests.llm.edges import CLASHES, awkward, empty
from tests.llm.test_llm_contamination import brute as brute_leaks
from tests.llm.test_llm_simhash import brute_print, brute_roots
from tests.llm.test_llm_tokens import check_packing
from trustlake.llm.quality import Features, fit, score_text
from trustlake.session import lineage_cut


@pytest.fixture(scope="module")
def small_run(spark, small):
    """What goes into every stage, and what comes out of the last."""
    frames = [spark.read.parquet(f"{small}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        frames.append(lineage_cut(stage(spark, frames[-1], small)))
    return frames


def rows_of(frame):
    return [(r.doc_id, r.text) for r in frame.collect()]


def test_stages_keep_the_columns_of_documents(small_run):
    for frame in small_run[1:-1]:
        assert frame.schema == small_run[0].schema


def test_classifier_stage(spark, small, small_run):
    weights = fit(small_run[0], spark.read.parquet(f"{small}/labels.parquet"))
    features = Features()
    good = [r for r in rows_of(small_run[0]) if score_text(weights, features.of(r[1].encode())) >= 0.7]
    assert sorted(rows_of(small_run[1])) == sorted(good)
    assert 0.7 * small_run[0].count() < len(good) < small_run[0].count()


def test_exact_stage(small_run):
    best = {}
    for ident, text in rows_of(small_run[1]):
        content = re.sub(r"[\x20\x09-\x0D]+", "", text)
        best[content] = min(best.get(content, (0, ident)), (-len(text), ident)) if content in best else (-len(text), ident)
    assert sorted(i for i, _ in rows_of(small_run[2])) == sorted(i for _, i in best.values())


def test_near_stage(small_run):
    prints = {i: brute_print(t) for i, t in rows_of(small_run[2])}
    roots = brute_roots(set(prints.values()))
    first = {}
    for ident, value in prints.items():
        first[roots[value]] = min(ident, first.get(roots[value], ident))
    assert sorted(i for i, _ in rows_of(small_run[3])) == sorted(first.values())


def test_decontamination_stage(spark, small, small_run):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    leaking = {i for i, *_ in brute_leaks(rows_of(small_run[3]), items)}
    assert sorted(i for i, _ in rows_of(small_run[4])) == sorted(i for i, _ in rows_of(small_run[3]) if i not in leaking)


def test_packing_stage(small_run):
    check_packing(rows_of(small_run[4]), small_run[5].collect(), 2048)


def test_run_is_registered(spark, small, small_run):
    assert contract.queries()["pipeline"] is corpus_pipeline.run
    pieces = ["doc_id", "piece", "start", "length", "ids_crc32"]
    found = corpus_pipeline.run(spark, small).select(pieces).collect()
    assert sorted(found) == sorted(small_run[5].select(pieces).collect())


def test_awkward_documents(spark, small):
    for docs in (awkward(spark), empty(spark)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = lineage_cut(stage(spark, docs.withColumn("text", F.col("text")), small))
            assert docs.columns == ["doc_id", "text", *CLASHES]
        corpus_pipeline.best_fit_packing(spark, docs, small).collect()
