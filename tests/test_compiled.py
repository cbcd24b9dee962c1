"""Models as expressions against Spark ML's own transformers, plain Python and another engine."""

import math

import duckdb
import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tests.conftest import plan_of
from trustlake.operators.categories import known_categories
from trustlake.operators.compiled import CompiledModel, compile_model, tree_of
from trustlake.operators.models import apply_model, apply_to_vectors, classifier, exact_medians, preparation
from trustlake.queries.modelling import GIVEN_LINEAR, GIVEN_TREES

KINDS = ["plain", "it's", 'a "b"', "back\\slash", "`x`", None, "ünï"]


@pytest.fixture(scope="module")
def rows(spark):
    dice = np.random.default_rng(4)
    data = [
        (
            i,
            KINDS[int(dice.integers(len(KINDS)))],
            ["x", "y"][int(dice.integers(2))],
            None if dice.random() < 0.1 else float(dice.normal(5, 3)),
            math.nan if dice.random() < 0.1 else float(dice.lognormal()),
            1.0,
            int(dice.random() < 0.3),
        )
        for i in range(600)
    ]
    frame = spark.createDataFrame(data, "id long, kind string, other string, a double, `b c` double, one double, is_fraud int")
    return frame.withColumn("is_fraud", F.when(F.col("a") > 6, 1).otherwise(F.col("is_fraud"))).cache()


@pytest.fixture(scope="module", params=["logistic_regression", "gradient_boosting"])
def fitted(request, rows):
    numbers = ["a", "b c", "one"]
    stages = preparation(known_categories(rows, ["kind", "other"]), exact_medians(rows, numbers), 600)
    few = {"max_iter": 12, "max_depth": 5}
    model = [*stages, *classifier(request.param, 600.0, few, ["kind", "other"], numbers)]
    marked = rows.withColumns({"_weight": F.lit(1.0) + F.col("is_fraud"), "_validation": F.col("id") % 10 == 0})
    return Pipeline(stages=model).fit(marked)


def test_the_expression_gives_the_pipeline_s_scores(spark, rows, fitted):
    odd = spark.createDataFrame([(1001, "never seen", None, None, math.nan, None, 0), (1002, None, "x", -1e300, 1e300, 0.0, 0)], rows.schema)
    every = rows.unionByName(odd)
    by_vectors = {r.id: r.p for r in apply_to_vectors(fitted, every, "p").collect()}
    scored = apply_model(fitted, every, "p")
    assert scored.columns == [*every.columns, "p"]
    assert {r.id: r.p for r in scored.collect()} == pytest.approx(by_vectors, abs=1e-9)
    assert len({round(p, 6) for p in by_vectors.values()}) > 5
    plan = plan_of(scored)
    assert "Python" not in plan and "UDF" not in plan


def test_stored_and_run_by_another_engine(rows, fitted):
    model = compile_model(fitted)
    again = CompiledModel.from_json(model.to_json())
    assert again == model
    sql = again.ansi_sql("frame", ["id"], "p")
    connection = duckdb.connect()
    connection.register("frame", rows.toArrow())
    here = {r.id: r.p for r in apply_model(model, rows, "p").collect()}
    assert dict(connection.execute(sql).fetchall()) == pytest.approx(here, abs=1e-9)


def plain_score(model: CompiledModel, row: dict) -> float:
    """By the definition, one row at a time."""
    places = [float(row[c] == k) for c, known in model.categories for k in known]
    for column, fill, off, factor in model.numbers:
        value = fill if row[column] is None or math.isnan(row[column]) else row[column]
        places.append((value - off) * factor)

    def walk(node):
        if isinstance(node, float):
            return node
        place, threshold, low, high = node
        return walk(low if places[place] <= threshold else high)

    margin = model.intercept + sum(w * p for w, p in zip(model.weights, places, strict=False))
    margin += sum(weight * walk(root) for weight, root in model.trees)
    return 1 / (1 + math.exp(-model.slope * margin))


@pytest.mark.parametrize("model", [GIVEN_LINEAR, GIVEN_TREES])
def test_given_models_by_the_definition(spark, model):
    dice = np.random.default_rng(5)
    names = [c for c, _ in model.categories] + [c for c, *_ in model.numbers]
    data = [
        tuple([*(dice.choice([*known, "other"]).item() for _, known in model.categories),
               *(None if dice.random() < 0.2 else float(dice.normal(fill, fill)) for _, fill, _, _ in model.numbers)])
        for _ in range(200)
    ]
    frame = spark.createDataFrame(data, ", ".join(f"{n} {'string' if i < len(model.categories) else 'double'}" for i, n in enumerate(names)))
    for row in apply_model(model, frame, "p").collect():
        assert row.p == pytest.approx(plain_score(model, row.asDict()), abs=1e-12)
    assert not model.weights or len(model.weights) == sum(len(k) for _, k in model.categories) + len(model.numbers)


def test_printed_trees():
    text = """DecisionTreeRegressionModel: uid=x, depth=2, numNodes=5, numFeatures=9
  If (feature 3 in {1.0})
   If (feature 8 <= -1.5E-4)
    Predict: -0.25
   Else (feature 8 > -1.5E-4)
    Predict: 1.0E10
  Else (feature 3 not in {1.0})
   Predict: 0.5
"""
    assert tree_of(text) == (3, 0.5, 0.5, (8, -1.5e-4, -0.25, 1e10))
    assert tree_of("x\n  Predict: 0.125\n") == 0.125


def test_many_trees_are_one_flat_expression(spark):
    root = (0, 0.5, (1, 0.5, (2, 0.5, 0.1, 0.2), 0.3), (2, 0.25, (1, 0.1, 0.4, 0.5), 0.6))
    model = CompiledModel((("k", ("x",)),), (("a", 0.0, 0.0, 1.0), ("b", 0.0, 0.0, 1.0)), trees=((0.01, root),) * 300, slope=2.0)
    frame = spark.range(2000).selectExpr("CASE id % 2 WHEN 0 THEN 'x' END AS k", "rand(1) AS a", "rand(2) AS b")
    rows = apply_model(model, frame, "p").collect()
    assert all(r.p == pytest.approx(plain_score(model, r.asDict()), abs=1e-9) for r in rows)


def test_exact_medians(spark):
    frame = spark.createDataFrame([(1.0, None, None), (2.0, math.nan, None), (4.0, 3.0, None), (10.0, 9.0, math.nan)], "a double, b double, c double")
    assert exact_medians(frame, ["a", "b", "c"]) == {"a": 3.0, "b": 6.0, "c": 0.0}


def test_a_pipeline_without_a_model(rows):
    with pytest.raises(ValueError, match="no fitted model"):
        compile_model(Pipeline(stages=[VectorAssembler(inputCols=["one"], outputCol="v")]).fit(rows))
