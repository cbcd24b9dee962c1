"""Class-weighted classifiers on the feature table, fitted and applied by Spark ML."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import ElementwiseProduct, OneHotEncoder, SQLTransformer, StandardScaler, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustlake.functions.cleaning import as_double, require_columns
from trustlake.functions.hashing import chosen
from trustlake.functions.measures import ratio
from trustlake.operators.categories import known_categories
from trustlake.operators.compiled import CompiledModel, compile_model, filled_sql
from trustlake.operators.gold import CATEGORICAL, MEDIAN, NUMERIC, TARGET, group_medians, with_group_statistic
from trustlake.operators.metrics import evaluate, review_threshold
from trustlake.operators.selection import group_quantile, stratified_split
from trustlake.session import lineage_cut, shared_dir, work_dir

DEFAULT_REVIEW_RATE = 0.05
WEIGHT = "_weight"
VALIDATION = "_validation"
SCORE = "fraud_score"

# The settings of the two model families. Trees are grown level by level here, so 15 leaves become a
# depth of 4. Boosting ends early once a tenth of the training rows, set aside, no longer profits from another tree.
MODEL_PARAMS: dict[str, dict] = {
    "logistic_regression": {"C": 1.0, "max_iter": 1000},
    "gradient_boosting": {
        "learning_rate": 0.05,
        "max_iter": 300,
        "max_depth": 4,
        "seed": 42,
        "validation_share": 0.1,
        "validation_tol": 1e-4,
    },
}


def prepare_features(
    df: DataFrame, categorical: Sequence[str] = CATEGORICAL, numeric: Sequence[str] = NUMERIC
) -> DataFrame:
    """Check the columns and make every number a double; rows keep no order, nothing downstream depends on one."""
    require_columns(df, [*categorical, *numeric, TARGET], "fraud_features")
    return as_double(df, numeric).withColumn(TARGET, F.col(TARGET).cast("int"))


def class_weights(df: DataFrame, label: str = TARGET) -> dict[int, float]:
    """Balanced weights ``rows / (classes * rows of the class)``; a binary label gives at most two rows."""
    counts = {row[label]: row["count"] for row in df.groupBy(label).count().limit(3).collect()}
    if set(counts) != {0, 1}:
        raise ValueError(f"{label} must hold both 0 and 1 and nothing else, got {sorted(map(str, counts))}")
    total = sum(counts.values())
    return {value: total / (2 * n) for value, n in counts.items()}


def with_weight(df: DataFrame, weights: Mapping[int, float], label: str = TARGET) -> DataFrame:
    return df.withColumn(WEIGHT, F.when(F.col(label) == 1, F.lit(weights[1])).otherwise(F.lit(weights[0])))


def exact_medians(df: DataFrame, numeric: Sequence[str]) -> dict[str, float]:
    """The median of the known values of each number, exactly; 0 where none is known."""
    if not numeric:
        return {}
    known = [F.struct(F.lit(c).alias("name"), F.nanvl(F.col(c).cast("double"), F.lit(None)).alias("value")) for c in numeric]
    rows = df.select(F.explode(F.array(*known)).alias("v")).select("v.name", "v.value")
    found = {row["name"]: row["median"] for row in group_quantile(rows, ["name"], "value", 0.5, "median").collect()}
    return {c: found.get(c, 0.0) for c in numeric}


def preparation(categorical: Mapping[str, Sequence[str]], numeric: Mapping[str, float], rows: int) -> list:
    """Stages that turn the columns into vectors: one 0/1 place per known category (none for an unknown one), numbers with
    missing ones replaced by the median, and numbers as distances from the mean in population standard deviations.

    ``categorical`` has the known categories of each column, see ``known_categories``; ``numeric`` the value that stands for a
    missing one, see ``exact_medians``. ``rows`` is the number of rows that the stages are fitted on: Spark's scaler divides by the sample deviation, which the
    factor after it turns into the population's.
    """
    codes, hot = [f"{c}_code" for c in categorical], [f"{c}_hot" for c in categorical]
    filled = [f"{c}_filled" for c in numeric]
    stages: list = []
    if categorical:
        stages += [
            *(
                StringIndexerModel.from_labels(list(known), column, f"{column}_code", handleInvalid="keep")
                for column, known in categorical.items()
            ),
            # the slot dropped is the one for unknown values
            OneHotEncoder(inputCols=codes, outputCols=hot, dropLast=True),
        ]
    if numeric:
        factor = (rows / (rows - 1)) ** 0.5 if rows > 1 else 1.0
        stages += [
            SQLTransformer(
                statement="SELECT *, " + ", ".join(f"{filled_sql(c, v)} AS `{c}_filled`" for c, v in numeric.items()) + " FROM __THIS__"
            ),
            VectorAssembler(inputCols=filled, outputCol="numbers"),
            StandardScaler(inputCol="numbers", outputCol="in_sample_deviations", withMean=True, withStd=True),
            ElementwiseProduct(
                inputCol="in_sample_deviations", outputCol="scaled", scalingVec=Vectors.dense([factor] * len(numeric))
            ),
        ]
    return stages


def classifier(
    name: str,
    weight_sum: float,
    params: Mapping | None = None,
    categorical: Sequence[str] = CATEGORICAL,
    numeric: Sequence[str] = NUMERIC,
) -> list:
    """The stages from the prepared vectors to scores."""
    if name not in MODEL_PARAMS:
        raise ValueError(f"no model family is called {name}; there are {', '.join(MODEL_PARAMS)}")
    settings = {**MODEL_PARAMS[name], **(params or {})}
    hot = [f"{c}_hot" for c in categorical]
    if name == "logistic_regression":
        return [
            VectorAssembler(inputCols=[*hot, *(["scaled"] if numeric else [])], outputCol="features"),
            LogisticRegression(
                labelCol=TARGET,
                weightCol=WEIGHT,
                maxIter=settings["max_iter"],
                elasticNetParam=0.0,
                # a penalty per row weight, whereas C weighs the sum of the losses
                regParam=1.0 / (settings["C"] * weight_sum),
                standardization=False,
            ),
        ]
    return [
        VectorAssembler(inputCols=[*hot, *(["numbers"] if numeric else [])], outputCol="features"),
        GBTClassifier(
            labelCol=TARGET,
            weightCol=WEIGHT,
            stepSize=settings["learning_rate"],
            maxIter=settings["max_iter"],
            maxDepth=settings["max_depth"],
            maxBins=255,
            minInstancesPerNode=20,
            seed=settings["seed"],
            validationIndicatorCol=VALIDATION,
            validationTol=settings["validation_tol"],
        ),
    ]


def without_summary(model: PipelineModel, path: str) -> PipelineModel:
    """The model as it comes back from storage.

    A freshly fitted linear model drags its training summary, and with it the whole session, into every task; a session
    that has observed a write cannot be sent there.
    """
    stages = []
    for stage in model.stages:
        if isinstance(stage, LogisticRegressionModel):
            stage.write().save(path)
            stage = LogisticRegressionModel.load(path)
        stages.append(stage)
    return PipelineModel(stages)


def apply_model(model: PipelineModel | CompiledModel, df: DataFrame, out: str = SCORE) -> DataFrame:
    """Add the probability of class 1, by the model's expression over the plain feature columns."""
    return (model if isinstance(model, CompiledModel) else compile_model(model)).apply(df, out)


def apply_to_vectors(model: PipelineModel, df: DataFrame, out: str = SCORE) -> DataFrame:
    """Add the probability of class 1 to rows that have the preparation's vectors already."""
    scored = model.transform(df).withColumn(out, vector_to_array("probability")[1])
    return scored.select(*df.columns, out)


@dataclass
class Trained:
    """A fitted model with everything needed to use it and to compare it."""

    name: str
    model: PipelineModel | CompiledModel
    threshold: float
    metrics: dict[str, float]
    n_train: int
    n_test: int
    medians: DataFrame
    fingerprint: dict = field(default_factory=dict)
    n_unlabelled: int = 0


def fingerprint(df: DataFrame) -> dict:
    """Row count and an order-independent checksum of the content; a NULL counts as a value of its place."""
    whole = F.xxhash64(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}))
    row = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(whole.cast("decimal(38,0)")).alias("checksum")).first()
    return {"rows": row["rows"], "checksum": str(row["checksum"] if row["checksum"] is not None else 0)}


def relative_to(features: DataFrame, medians: DataFrame, group: str, amount: str) -> DataFrame:
    """The feature table with its ratio to the group median taken from other medians."""
    known = with_group_statistic(features, medians, group)
    return known.withColumn("amount_vs_product_median", ratio(amount, MEDIAN)).drop(MEDIAN)


def train(
    features: DataFrame,
    names: Sequence[str] = tuple(MODEL_PARAMS),
    review_rate: float = DEFAULT_REVIEW_RATE,
    params: Mapping[str, Mapping] | None = None,
    categorical: Sequence[str] = CATEGORICAL,
    numeric: Sequence[str] = NUMERIC,
    seed: object = 42,
    test_size: float = 0.2,
    key: str = "claim_id",
    group: str = "product",
    amount: str = "claim_amount",
    stats_from: str = "all",
) -> dict[str, Trained]:
    """Fit each model on the same split, take the threshold from its training scores, evaluate on the held-out rows.

    ``stats_from``: medians over ``all`` rows, as in the gold table, or over the ``train`` rows only; the ratio to the
    median is then computed anew, so that training and serving use the same medians.

    Rows without a label are left out and counted. The preparation is fitted once and its vectors are stored; every model
    is fitted on those, one vector a row and model.
    """
    if stats_from not in ("all", "train"):
        raise ValueError(f"stats_from must be all or train, got {stats_from!r}")
    for name in names:
        classifier(name, 1.0)
    spark = features.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:  # boosting cuts its own lineage there
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    data = prepare_features(features, categorical, numeric)
    source = fingerprint(data)
    labelled = data.filter(F.col(TARGET).isNotNull())
    split = lineage_cut(stratified_split(labelled, TARGET, key, test_size, seed))
    in_training = split if stats_from == "all" else split.filter("NOT is_test")
    medians = lineage_cut(group_medians(in_training, group, amount))
    if stats_from == "train":
        split = lineage_cut(relative_to(split, medians, group, amount))
    train_rows = split.filter("NOT is_test")
    weights = class_weights(train_rows)
    sizes = split.agg(F.count_if(~F.col("is_test")).alias("a"), F.count_if("is_test").alias("b")).first()

    known, fills = known_categories(train_rows, categorical), exact_medians(train_rows, numeric)
    prepared = Pipeline(stages=preparation(known, fills, sizes["a"])).fit(train_rows)
    stages = {name: classifier(name, float(sizes["a"]), (params or {}).get(name), categorical, numeric) for name in names}
    vectors = with_weight(prepared.transform(split), weights)
    for name, (assembler, _) in stages.items():
        vectors = assembler.transform(vectors).withColumnRenamed(assembler.getOutputCol(), f"{name}_vector")
    vectors = lineage_cut(vectors.select(key, *(f"{name}_vector" for name in stages), TARGET, WEIGHT, "is_test"))
    result = {}
    for name, (assembler, estimator) in stages.items():
        share = {**MODEL_PARAMS[name], **((params or {}).get(name) or {})}.get("validation_share", 0.0)
        own = vectors.select(key, F.col(f"{name}_vector").alias(assembler.getOutputCol()), TARGET, WEIGHT, "is_test")
        marked = own.withColumn(VALIDATION, chosen(f"{seed}|validation", share, key))
        fitted = without_summary(Pipeline(stages=[estimator]).fit(marked.filter("NOT is_test")), work_dir(spark, name))
        # every row is scored once; threshold and metrics read the stored scores
        scored = lineage_cut(apply_to_vectors(fitted, own, SCORE).select(SCORE, TARGET, "is_test"))
        threshold = review_threshold(scored.filter("NOT is_test"), SCORE, review_rate)
        metrics = evaluate(scored.filter("is_test"), SCORE, TARGET, threshold).first().asDict()
        model = PipelineModel([*prepared.stages, assembler, *fitted.stages])
        unlabelled = source["rows"] - sizes["a"] - sizes["b"]
        result[name] = Trained(name, model, threshold, metrics, sizes["a"], sizes["b"], medians, source, unlabelled)
    return result
