import zlib

import numpy as np
import pytest

from tests.llm.edges import CLASHES, ROWS, awkward, empty
from trustlake.llm.quality import BIAS, Features, classify_quality, fit, good_documents, learn, logistic, score_text, sparse, weights_of


@pytest.fixture(scope="module")
def docs(spark, small):
    return spark.read.parquet(small.replace("sf0.001", "sf0.01") + "/documents.parquet").cache()


@pytest.fixture(scope="module")
def labels(spark, small):
    return spark.read.parquet(small.replace("sf0.001", "sf0.01") + "/labels.parquet").cache()


@pytest.fixture(scope="module")
def weights(docs, labels):
    return fit(docs, labels)


def test_held_out_accuracy(docs, labels, weights):
    scored = classify_quality(docs, weights).join(labels, "doc_id").filter("held_out").collect()
    good = [r.score for r in scored if r.quality == 1]
    bad = [r.score for r in scored if r.quality == 0]
    assert len(good) > 50 and len(bad) > 5
    assert np.mean([r.predicted == r.quality for r in scored]) > 0.95
    assert np.mean([g > b for g in good for b in bad]) > 0.98


def test_scores_are_sparse_dot_products(docs, weights):
    """Against a per-n-gram sum, and no matter how the rows are dealt."""
    scored = {r.doc_id: r for r in classify_quality(docs.repartition(7), weights).collect()}
    features = Features()
    for row in docs.limit(40).collect():
        place, value = sparse(features.of(row.text.encode()))
        assert scored[row.doc_id].score == pytest.approx(logistic(float(weights[place].astype(float) @ value)), abs=1e-6)
        assert scored[row.doc_id].held_out == (zlib.crc32(str(row.doc_id).encode()) % 4 == 2)
        assert scored[row.doc_id].predicted == (scored[row.doc_id].score >= 0.7)


def test_a_fit_does_not_depend_on_partitions_or_held_out_labels(spark, docs, labels, weights):
    turned = labels.selectExpr("doc_id", "CASE WHEN crc32(cast(cast(doc_id AS string) AS binary)) % 4 = 2 THEN 1 - quality ELSE quality END AS quality")
    assert np.allclose(fit(docs.repartition(5), turned.repartition(3)), weights, atol=1e-6)


def test_updates_follow_the_regularised_leader():
    """The closed form against the definition: per coordinate, the minimiser of the linearised loss plus penalties."""
    rng = np.random.default_rng(1)
    z, n = np.zeros(4), np.zeros(4)
    slopes, rates, seen = np.zeros(4), np.zeros(4), []
    for _ in range(50):
        value, label = rng.random(4), int(rng.integers(2))
        weight = weights_of(z, n)
        slope = (logistic(weight @ value) - label) * value
        sigma = (np.sqrt(n + slope**2) - np.sqrt(n)) / 5.0
        slopes, rates = slopes + slope, rates + sigma
        seen.append((sigma, weight))
        learn(z, n, [(np.arange(4), value, label)])
    pull = slopes - sum(s * w for s, w in seen)
    for i in range(4):
        grid = np.linspace(-8, 8, 200_001)
        cost = pull[i] * grid + 0.01 * abs(grid) + ((1.0 / 5.0 + 0.001) / 2 + rates[i] / 2) * grid**2
        assert weights_of(z, n)[i] == pytest.approx(grid[cost.argmin()], abs=1e-3)


def test_awkward_rows(spark, docs, labels, weights):
    scored = classify_quality(awkward(spark), weights).collect()
    assert sorted((r.doc_id for r in scored), key=repr) == sorted((i for i, _ in ROWS), key=repr)
    nothing = logistic(float(weights[BIAS]))
    assert {r.score for r in scored if r.doc_id in (2, 3, 4)} == {nothing}
    assert all(r.held_out is False for r in scored if r.doc_id is None)
    assert classify_quality(empty(spark), weights).count() == 0


def test_no_labels(spark):
    none = spark.createDataFrame([(1, None), (None, 1), (3, 0), (3, 1)], "doc_id bigint, quality int")
    assert fit(awkward(spark), none) is None
    assert {r.score for r in classify_quality(awkward(spark), None).collect()} == {0.5}
    assert good_documents(awkward(spark), None).count() == len(ROWS)
    assert fit(empty(spark), none) is None


def test_accepted_documents_stay_whole(spark, weights):
    kept = good_documents(awkward(spark), weights)
    assert kept.columns == ["doc_id", "text", *CLASHES]
    features = Features()
    good = [r for r in ROWS if score_text(weights, features.of((r[1] or "").encode())) >= 0.7]
    assert sorted((tuple(r[:2]) for r in kept.collect()), key=repr) == sorted(good, key=repr)
