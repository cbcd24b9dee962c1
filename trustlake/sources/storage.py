"""Where the layers live: folders or catalog tables, plain or versioned."""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from trustlake.operators.bounded import few_rows
from trustlake.operators.rules import FAILED, is_valid
from trustlake.sources.raw import MALFORMED

OUTCOME = "_outcome"
GOOD, BAD = "valid", "quarantine"
FORMATS = ("parquet", "delta")


@dataclass(frozen=True)
class Storage:
    """Names a table by (layer, name) and overwrites it as a whole.

    ``path``: folders ``<base>/<layer>/<name>``. ``table``: tables ``<catalog>.<schema>.<layer>_<name>``.
    """

    mode: str
    base: str
    fmt: str = "parquet"

    def __post_init__(self) -> None:
        if self.mode not in ("path", "table"):
            raise ValueError(f"mode must be path or table, got {self.mode!r}")
        if self.mode == "table" and not re.fullmatch(r"[^.\s]+\.[^.\s]+", self.base):
            raise ValueError(f"a table base is catalog.schema, got {self.base!r}")
        if self.fmt not in FORMATS:
            raise ValueError(f"format must be one of {FORMATS}, got {self.fmt!r}")

    def location(self, layer: str, name: str) -> str:
        if self.mode == "path":
            return "/".join((self.base.rstrip("/"), layer, name))
        return f"{self.base}.{layer}_{name}"

    def write(self, df: DataFrame, layer: str, name: str) -> None:
        """Replace the table and, where the columns changed, its schema."""
        target = self.location(layer, name)
        if self.mode == "path":
            df.write.format(self.fmt).mode("overwrite").save(target)
        else:
            df.write.option("overwriteSchema", "true").mode("overwrite").saveAsTable(target)

    def read(self, spark: SparkSession, layer: str, name: str) -> DataFrame:
        target = self.location(layer, name)
        return spark.read.format(self.fmt).load(target) if self.mode == "path" else spark.table(target)

    def append(self, df: DataFrame, layer: str, name: str) -> None:
        target = self.location(layer, name)
        if self.mode == "path":
            df.write.format(self.fmt).mode("append").save(target)
        else:
            df.write.mode("append").saveAsTable(target)


def create_namespace(spark: SparkSession, name: str, location: str | None = None, comment: str | None = None) -> None:
    """Create the schema if it does not exist yet; safe to repeat."""
    statement = f"CREATE SCHEMA IF NOT EXISTS {name}"
    if comment:
        statement += " COMMENT '" + comment.replace("'", "\\'") + "'"
    if location:
        statement += f" LOCATION '{location}'"
    spark.sql(statement)


def list_tables(spark: SparkSession, namespace: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {namespace}").select("namespace", "tableName")


@dataclass(frozen=True)
class Staged:
    """A checked dataset, written once with the outcome as its partition column, not yet visible as a layer."""

    name: str
    target: str
    schema: StructType

    def pick(self, frame: DataFrame, outcome: str) -> DataFrame:
        picked = frame.filter(F.col(OUTCOME) == outcome).drop(OUTCOME)
        return picked.drop(FAILED, MALFORMED) if outcome == GOOD else picked


def outcome() -> Column:
    return F.when(is_valid(), F.lit(GOOD)).otherwise(F.lit(BAD)).alias(OUTCOME)


def _staged_schema(frame: DataFrame) -> StructType:
    """As written: the partition column comes back last."""
    fields = [f for f in frame.schema.fields if f.name != OUTCOME]
    return StructType([*fields, frame.schema[OUTCOME]])


LOG_SCHEMA = (
    "layer string, name string, version long, path string, outcome string, columns string, run_id string, "
    "written_at string"
)


class Snapshots:
    """Versioned layers in one folder: data is written beside the old version, then one log row makes it current.

    Readers never see half a write, a failed job leaves the old version current, and old versions stay readable. The
    log expects one writer per table at a time.
    """

    def __init__(self, spark: SparkSession, base: str) -> None:
        self.spark = spark
        self.base = base.rstrip("/")
        self._log = f"{self.base}/_versions"
        # create the log unless there is one
        few_rows(spark, [], LOG_SCHEMA).write.mode("ignore").json(self._log)

    # -- plain layers --

    def write(self, df: DataFrame, layer: str, name: str, run_id: str = "") -> int:
        path = f"{self.base}/{layer}/{name}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return self._record(layer, name, path, "", df.schema, run_id)

    def append(self, df: DataFrame, layer: str, name: str) -> None:
        """Logs and reports grow and have no versions."""
        df.write.mode("append").parquet(f"{self.base}/{layer}/{name}")

    def read_appended(self, layer: str, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.base}/{layer}/{name}")

    def read(self, layer: str, name: str, version: int | None = None) -> DataFrame:
        """The current version, or the one asked for (versions count from 0)."""
        entries = self.history(layer, name)
        if version is not None:
            entries = entries.filter(F.col("version") == version)
        entry = entries.orderBy(F.desc("version")).limit(1).first()
        if entry is None:
            raise LookupError(f"no such table or version: {layer}.{name} {'' if version is None else version}".rstrip())
        schema = StructType.fromJson(json.loads(entry["columns"]))
        frame = self.spark.read.schema(schema).parquet(entry["path"])
        if entry["outcome"]:
            return Staged(name, entry["path"], schema).pick(frame, entry["outcome"])
        return frame

    def history(self, layer: str, name: str) -> DataFrame:
        """One row per version of a table."""
        return self._entries().filter((F.col("layer") == layer) & (F.col("name") == name))

    # -- checked datasets --

    def stage(self, checked: DataFrame, name: str, run_id: str = "") -> Staged:
        """Write the checked frame once; the outcome becomes a folder level."""
        frame = checked.withColumn(OUTCOME, outcome())
        path = f"{self.base}/staged/{name}/{uuid.uuid4().hex}"
        frame.write.partitionBy(OUTCOME).parquet(path)
        schema = _staged_schema(frame)
        self._record("staged", name, path, "", schema, run_id)
        return Staged(name, path, schema)

    def staged(self, handle: Staged, outcome: str) -> DataFrame:
        return handle.pick(self.spark.read.schema(handle.schema).parquet(handle.target), outcome)

    def publish(self, handle: Staged, run_id: str = "") -> None:
        """Make the staged rows the current silver and quarantine tables; no data is copied."""
        self._record("silver", handle.name, handle.target, GOOD, handle.schema, run_id)
        self._record("quarantine", handle.name, handle.target, BAD, handle.schema, run_id)

    # -- the log --

    def _entries(self) -> DataFrame:
        return self.spark.read.schema(LOG_SCHEMA).json(self._log)

    def _record(self, layer: str, name: str, path: str, outcome: str, schema: StructType, run_id: str) -> int:
        last = self.history(layer, name).agg(F.max("version")).first()[0]
        version = 0 if last is None else last + 1
        written_at = datetime.now(UTC).isoformat()
        row = (layer, name, version, path, outcome, schema.json(), run_id, written_at)
        few_rows(self.spark, [row], LOG_SCHEMA).write.mode("append").json(self._log)
        return version


class CatalogLayers:
    """The same layers as catalog tables. Checked datasets are one table per run; silver and quarantine are views."""

    def __init__(self, spark: SparkSession, base: str) -> None:
        self.spark = spark
        self.storage = Storage("table", base)

    def write(self, df: DataFrame, layer: str, name: str, run_id: str = "") -> None:
        self.storage.write(df, layer, name)

    def append(self, df: DataFrame, layer: str, name: str) -> None:
        self.storage.append(df, layer, name)

    def read_appended(self, layer: str, name: str) -> DataFrame:
        return self.read(layer, name)

    def read(self, layer: str, name: str) -> DataFrame:
        return self.storage.read(self.spark, layer, name)

    def stage(self, checked: DataFrame, name: str, run_id: str = "") -> Staged:
        frame = checked.withColumn(OUTCOME, outcome())
        target = self.storage.location("staged", f"{name}_{uuid.uuid4().hex[:12]}")
        frame.write.partitionBy(OUTCOME).saveAsTable(target)
        return Staged(name, target, _staged_schema(frame))

    def staged(self, handle: Staged, outcome: str) -> DataFrame:
        return handle.pick(self.spark.table(handle.target), outcome)

    def publish(self, handle: Staged, run_id: str = "") -> None:
        """Point the two views at the new table; each switch is one catalog operation."""
        for layer, outcome in (("silver", GOOD), ("quarantine", BAD)):
            columns = ", ".join(f"`{c}`" for c in self.staged(handle, outcome).columns)
            view = self.storage.location(layer, handle.name)
            self.spark.sql(
                f"CREATE OR REPLACE VIEW {view} AS SELECT {columns} FROM {handle.target} WHERE {OUTCOME} = '{outcome}'"
            )
