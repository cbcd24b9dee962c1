import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of, text_frame
from trustlake.functions.cleaning import Clean, as_double, clean, is_finite, require_columns, safe_cast
from trustlake.functions.hashing import chosen, keyed_hash, share_cut
from trustlake.functions.measures import days_between, logistic_score, money_avg, money_sum, month_of, ratio


@pytest.mark.parametrize(
    ("text", "kind", "value"),
    [
        ("40.0", "int", None),
        (" 41 ", "int", 41),
        ("1200d", "double", 1200.0),
        ("1e3", "double", 1000.0),
        ("1,200", "double", None),
        ("abc", "double", None),
        ("", "double", None),
        ("2023", "date", datetime.date(2023, 1, 1)),
        ("2023-02-10 10:00:00", "date", datetime.date(2023, 2, 10)),
        ("2023-13-45", "date", None),
        ("not-a-date", "date", None),
    ],
)
def test_bad_text_becomes_null(spark, text, kind, value):
    frame = text_frame(spark, ["v"], [(text,)])
    assert frame.select(safe_cast("v", kind)).first()[0] == value


def test_nan_and_infinity_survive_the_cast_and_need_their_own_rule(spark):
    frame = text_frame(spark, ["v"], [("NaN",), ("Infinity",), ("5",)]).select(safe_cast("v", "double").alias("v"))
    assert frame.filter("v > 0").count() == 3
    assert [r.v for r in frame.filter(is_finite("v")).collect()] == [5.0]


def test_clean_is_one_projection_with_defaults_and_blanks(spark):
    columns = (
        Clean("a", "folded", default="unknown"),
        Clean("b", "folded", default="unknown", blank_is_null=True, source="a"),
        Clean("n", "int"),
    )
    frame = text_frame(spark, ["a", "n"], [(" WEB ", "1"), ("  ", "x"), (None, None)])
    assert [tuple(r) for r in clean(frame, columns).collect()] == [
        ("web", "web", 1),
        ("", "unknown", None),
        ("unknown", "unknown", None),
    ]


def test_trim_strips_spaces_only(spark):
    assert clean(text_frame(spark, ["a"], [(" auto\t ",)]), [Clean("a")]).first()[0] == "auto\t"


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="facts lacks the columns b, c"):
        require_columns(text_frame(spark, ["a"], []), ["c", "a", "b"], "facts")


def test_as_double(spark):
    frame = as_double(spark.range(1).withColumn("t", F.lit("x")), ["id"])
    assert dict(frame.dtypes) == {"id": "double", "t": "string"}


def test_choice_depends_on_the_key_only(spark):
    rows = spark.range(20_000)
    first = rows.filter(chosen("s", 0.1, "id"))
    second = rows.repartition(7).filter(chosen("s", 0.1, "id"))
    assert first.exceptAll(second).count() == 0
    assert 1800 < first.count() < 2200
    assert rows.filter(chosen("s", 1, "id")).count() == 20_000
    assert rows.filter(chosen("s", 0, "id")).count() == 0
    assert rows.select(F.count_distinct(keyed_hash("s", "id"))).first()[0] == 20_000
    with pytest.raises(ValueError, match="share"):
        share_cut(1.5)


def test_measures(spark):
    frame = spark.createDataFrame(
        [(1.005, 0.0, datetime.date(2023, 2, 10), datetime.date(2023, 1, 31))], "a double, z double, d date, e date"
    )
    row = frame.select(
        ratio("a", "z").alias("none"),
        ratio("a", F.lit(1), 2).alias("up"),
        days_between("d", "e").alias("days"),
        month_of("d").alias("month"),
    ).first()
    assert tuple(row) == (None, 1.01, 10, datetime.date(2023, 2, 1))


def test_money_does_not_depend_on_order(spark):
    frame = spark.range(10_000).select((F.col("id") * 0.01).alias("m"))
    first = frame.agg(money_sum("m"), money_avg("m")).first()
    second = frame.repartition(13).agg(money_sum("m"), money_avg("m")).first()
    assert tuple(first) == tuple(second) == (499950.0, 50.0)


def test_logistic_score_ignores_unknown_conditions(spark):
    score = logistic_score([("id = 0", 2.0), ("CAST(NULL AS BOOLEAN)", 9.0)], -2.0)
    assert [round(r[0], 6) for r in spark.range(2).select(score).collect()] == [0.5, 0.119203]


def test_cleaning_stays_in_generated_code(spark, small):
    orders = spark.read.parquet(f"{small}/orders.parquet").select(F.col("o_orderpriority").alias("a"))
    assert "*(1) Project" in plan_of(clean(orders, [Clean("a", "double")]))
