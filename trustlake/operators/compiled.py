"""Fitted models as column expressions.

A pipeline of the preparation's stages and a linear or boosted model becomes one expression over the plain feature columns:
0/1 values per known category, missing numbers filled in, then a weighted sum or the sum of the trees as nested CASEs.
Scoring with it runs in generated code, needs no vectors, and the expression is SQL that other engines can run, too.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, LogisticRegressionModel
from pyspark.ml.feature import ElementwiseProduct, SQLTransformer, StandardScalerModel, StringIndexerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Terms that are added up within one pair of brackets, so that expressions stay flat.
TERMS = 16


def number(value: float) -> str:
    """A double in SQL, exactly; with an exponent no engine takes it for a decimal."""
    return f"{value:.17e}"


def spark_text(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def ansi_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def spark_name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def ansi_name(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def filled_sql(name: str, fill: float, quoted=spark_name) -> str:
    """A number, or ``fill`` where it is missing."""
    return f"CASE WHEN {quoted(name)} IS NULL OR isnan({quoted(name)}) THEN {number(fill)} ELSE {quoted(name)} END"


_FILLED = re.compile(r"CASE WHEN `((?:[^`]|``)+)` IS NULL OR isnan\(`(?:[^`]|``)+`\) THEN (\S+) ELSE ")


def fills_in(statement: str) -> dict[str, float]:
    """Column and value of every ``filled_sql`` in a statement."""
    return {name.replace("``", "`"): float(value) for name, value in _FILLED.findall(statement)}


def _added(terms: Sequence[str]) -> str:
    """The terms' sum, in a tree of brackets."""
    terms = list(terms) or [number(0.0)]
    while len(terms) > 1:
        terms = ["(" + " + ".join(terms[i : i + TERMS]) + ")" for i in range(0, len(terms), TERMS)]
    return terms[0]


@dataclass(frozen=True)
class CompiledModel:
    """Everything a score depends on. Places count the categories of all columns first, then the numbers."""

    #: column and its categories, in the order of the places
    categories: tuple[tuple[str, tuple[str, ...]], ...]
    #: column, fill value, what is taken off, what it is multiplied with
    numbers: tuple[tuple[str, float, float, float], ...]
    intercept: float = 0.0
    #: one per place, for a linear model
    weights: tuple[float, ...] = ()
    #: weight and root of each tree; a node is its value, or (place, threshold, node up to it, node above it)
    trees: tuple[tuple[float, object], ...] = ()
    #: what the sum is multiplied with inside the logistic function
    slope: float = 1.0

    def prepared(self, quoted=spark_name, text=spark_text) -> dict[str, str]:
        """A name and its SQL for every place."""
        values = [
            f"CASE WHEN {quoted(column)} = {text(category)} THEN {number(1.0)} ELSE {number(0.0)} END"
            for column, known in self.categories
            for category in known
        ]
        for column, fill, off, factor in self.numbers:
            filled = filled_sql(column, fill, quoted)
            values.append(filled if (off, factor) == (0.0, 1.0) else f"(({filled}) - {number(off)}) * {number(factor)}")
        return {f"_place{i}": value for i, value in enumerate(values)}

    def _tree(self, node) -> str:
        if not isinstance(node, (list, tuple)):
            return number(float(node))
        place, threshold, low, high = node
        return f"CASE WHEN _place{place} <= {number(threshold)} THEN {self._tree(low)} ELSE {self._tree(high)} END"

    def probability(self) -> str:
        """SQL of the probability of class 1, over the names of ``prepared``."""
        terms = [f"{number(w)} * _place{i}" for i, w in enumerate(self.weights) if w != 0.0]
        terms += [f"{number(weight)} * {self._tree(root)}" for weight, root in self.trees]
        return f"1e0 / (1e0 + exp({number(-self.slope)} * ({number(self.intercept)} + {_added(terms)})))"

    def ansi_sql(self, rows: str, keep: Sequence[str], out: str) -> str:
        """A query for other engines: ``keep`` and the probability of every row of ``rows`` (a table, or a query in brackets)."""
        inner = ", ".join(f"{sql} AS {name}" for name, sql in self.prepared(ansi_name, ansi_text).items())
        columns = ", ".join(keep)
        return f"SELECT {columns}, {self.probability()} AS {out} FROM (SELECT *, {inner} FROM {rows})"

    def apply(self, df: DataFrame, out: str) -> DataFrame:
        """Add the probability of class 1 to every row."""
        places = self.prepared()
        scored = df.withColumns({name: F.expr(sql) for name, sql in places.items()}).withColumn(out, F.expr(self.probability()))
        return scored.drop(*places)

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> CompiledModel:
        found = json.loads(text)
        return cls(
            tuple((column, tuple(known)) for column, known in found["categories"]),
            tuple((column, *map(float, rest)) for column, *rest in found["numbers"]),
            float(found["intercept"]),
            tuple(map(float, found["weights"])),
            tuple((float(weight), _frozen(root)) for weight, root in found["trees"]),
            float(found["slope"]),
        )


def _frozen(node):
    return (node[0], node[1], _frozen(node[2]), _frozen(node[3])) if isinstance(node, list) else node


_SPLIT = re.compile(r"(If|Else) \(feature (\d+) (<=|>|in|not in) (.+)\)")


def tree_of(description: str):
    """The nodes of a tree from its printed form."""
    lines = iter([line.strip() for line in description.splitlines() if re.match(r"\s*(If|Else|Predict)", line)])

    def read():
        line = next(lines)
        if line.startswith("Predict"):
            return float(line.split(":")[1])
        _, place, sign, value = _SPLIT.fullmatch(line).groups()
        first = read()
        next(lines)  # the Else line says the opposite
        second = read()
        if sign == "<=":
            return int(place), float(value), first, second
        # a 0/1 value: the left side has the zeros, the ones, or both
        sides = {float(v) for v in value.strip("{}").split(",")}
        if sign == "not in":
            first, second = second, first
        zero, one = (first if v in sides else second for v in (0.0, 1.0))
        return int(place), 0.5, zero, one

    return read()


def compile_model(model: PipelineModel) -> CompiledModel:
    """The expression of a fitted pipeline of ``preparation`` and ``classifier``."""
    categories, fills, off, factor = (), {}, {}, {}
    for stage in model.stages:
        if isinstance(stage, StringIndexerModel):
            columns = [stage.getInputCol()] if stage.isSet("inputCol") else stage.getInputCols()
            categories += tuple((c, tuple(known)) for c, known in zip(columns, stage.labelsArray, strict=True))
        elif isinstance(stage, SQLTransformer):
            fills = fills_in(stage.getStatement())
        elif isinstance(stage, StandardScalerModel):
            off = dict(zip(fills, map(float, stage.mean), strict=True))
            factor = {c: 1.0 / s if s else 0.0 for c, s in zip(fills, map(float, stage.std), strict=True)}
        elif isinstance(stage, ElementwiseProduct):
            factor = {c: factor[c] * f for c, f in zip(fills, map(float, stage.getScalingVec()), strict=True)}
        elif isinstance(stage, LogisticRegressionModel):
            numbers = tuple((c, fill, off[c], factor[c]) for c, fill in fills.items())
            weights = tuple(map(float, stage.coefficients.toArray()))
            return CompiledModel(categories, numbers, float(stage.intercept), weights)
        elif isinstance(stage, GBTClassificationModel):
            numbers = tuple((c, fill, 0.0, 1.0) for c, fill in fills.items())
            trees = tuple(
                (float(w), tree_of(tree.toDebugString)) for w, tree in zip(stage.treeWeights, stage.trees, strict=True)
            )
            # boosting fits twice the margin's log odds
            return CompiledModel(categories, numbers, trees=trees, slope=2.0)
    raise ValueError("the pipeline has no fitted model of a known family")
