"""Row-level quality gates: rows that fail a rule go to quarantine, and a share of them stops the run.

One pass tags every row of a table with the rules it fails and writes the rows
once, split into accepted and rejected ones.  The rules are the data checks of
``operators.quality`` put to rows: a declared column whose value its type can't hold
(``type:<column>``), a critical column without a value (``null:<column>``), a negative
payment (``negative:payment_value``) and, for files, a line that has not the header's
number of fields (``malformed``).  A row that fails several rules counts for each.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.functions.common import materialized_folder
from mercato.operators.quality import _compatible
from mercato.sources.inference import CsvText, read_csv_text
from mercato.sources.readers import MULTI_LINE
from mercato.sources.schemas import CANONICAL_SCHEMAS, CRITICAL_COLUMNS

NOT_NEGATIVE: dict[str, list[str]] = {"payments": ["payment_value"]}
MALFORMED = "malformed"


class DataQualityError(RuntimeError):
    """A table has more rejected rows than its run accepts."""


@dataclass(frozen=True)
class Quarantine:
    """The two halves of a table: ``accepted`` has its rows, ``rejected`` a ``row`` struct and ``failed_rules``."""

    name: str
    accepted: DataFrame
    rejected: DataFrame
    rules: list[str]

    def report(self) -> DataFrame:
        """``table_name, rule, rows``: a row for each rule, also those that no row fails."""
        failed = self.rejected.select(F.explode("failed_rules").alias("rule")).groupBy("rule").agg(F.count(F.lit(1)).alias("_rows"))
        every = self.rejected.sparkSession.createDataFrame([(r,) for r in self.rules], "rule string")
        return every.join(failed, "rule", "left").select(
            F.lit(self.name).alias("table_name"), "rule", F.coalesce("_rows", F.lit(0)).alias("rows")
        )

    def check(self, max_rejected: float) -> "Quarantine":
        """Raises when more than this share of the rows was rejected."""
        bad, good = self.rejected.count(), self.accepted.count()
        if bad > max_rejected * (bad + good):
            raise DataQualityError(f"{self.name}: {bad} of {bad + good} rows rejected, more than {max_rejected:.4%}")
        return self


def table_rules(name: str, df: DataFrame) -> dict[str, Column]:
    """The rules of a table by name; each column is true for the rows that fail."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    missing = [f.name for f in CANONICAL_SCHEMAS[name].fields if f.name not in actual]
    if missing:
        raise DataQualityError(f"{name}: required columns are missing: {missing}")
    out: dict[str, Column] = {}
    for f in CANONICAL_SCHEMAS[name].fields:
        as_text = isinstance(actual[f.name], T.StringType) and not isinstance(f.dataType, T.StringType)
        if as_text or not _compatible(f.dataType, actual[f.name]):
            out[f"type:{f.name}"] = F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()
    for c in CRITICAL_COLUMNS.get(name, []):
        out[f"null:{c}"] = F.col(c).isNull()
    for c in NOT_NEGATIVE.get(name, []):
        out[f"negative:{c}"] = F.coalesce(F.col(c).try_cast("double") < 0, F.lit(False))
    return out


def quarantine(name: str, df: DataFrame, rules: Mapping[str, Column] | None = None) -> Quarantine:
    """Split a table by its rules (``table_rules`` by default); the input is computed once."""
    rules = dict(table_rules(name, df) if rules is None else rules)
    failed = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(r)) for r, c in rules.items()])) if rules else F.array().cast("array<string>")
    # The row stays a struct, so no column of its own can clash with the tags.
    tagged = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), failed.alias("failed_rules"))
    tagged = tagged.withColumn("rejected", F.size("failed_rules") > 0)
    path = f"{materialized_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    tagged.write.partitionBy("rejected").parquet(path)
    both = df.sparkSession.read.schema(tagged.schema).parquet(path)  # each half reads its own folder
    return Quarantine(name, both.where("not rejected").select("row.*"), both.where("rejected").select("row", "failed_rules"), list(rules))


def quarantine_tables(tables: Mapping[str, DataFrame], max_rejected: float | None = None) -> dict[str, Quarantine]:
    """Every table split; with ``max_rejected`` the first table beyond that share stops the run."""
    out = {}
    for name in tables:
        out[name] = quarantine(name, tables[name])
        if max_rejected is not None:
            out[name].check(max_rejected)
    return out


def report(split: Mapping[str, Quarantine]) -> DataFrame:
    out = None
    for q in split.values():
        out = q.report() if out is None else out.unionByName(q.report())
    return out


def quarantine_csv(name: str, text: CsvText) -> Quarantine:
    """A CSV table as text, split; accepted rows have the declared types, malformed lines are rejected as ``raw``."""
    split = quarantine(name, text.rows)
    typed = split.accepted.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in CANONICAL_SCHEMAS[name].fields])
    held = split.rejected.select(F.to_json("row").alias("row"), "failed_rules")
    lines = text.malformed.select(F.col("raw").alias("row"), F.array(F.lit(MALFORMED)).alias("failed_rules"))
    return Quarantine(name, typed, held.unionByName(lines), [*split.rules, MALFORMED])


def load_csv_gated(spark: SparkSession, files: Mapping[str, str], max_rejected: float) -> dict[str, Quarantine]:
    """The CSV files the caller names, split by all rules; a table beyond the share stops the run."""
    unknown = set(files) - set(CANONICAL_SCHEMAS)
    if unknown:
        raise ValueError(f"unknown tables {sorted(unknown)}")
    return {n: quarantine_csv(n, read_csv_text(spark, path, n in MULTI_LINE)).check(max_rejected) for n, path in files.items()}
