"""Daily snapshots whose records change shape: days are read as VARIANT, the types
each column has on each day are folded into one, and what does not fit is named.

What becomes of a record:

- a number or truth value where text is wanted is read as its text, on that day or in
  that record only (`7` is `"7"`; a decimal loses trailing zeros);
- a column under another name is read if `aliases` gives that name;
- a column nobody knows is reported and left out, one that is absent is null;
- a day on which a wanted column is absent from every record while unknown ones
  appear has a column renamed: its records are rejected, with both names;
- a list or object where text is wanted, or anything but a list of plain
  values where a list is wanted, rejects its record; so does text that is no JSON,
  or JSON that is no object.
"""

from __future__ import annotations

from datetime import date
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from leafline.functions.dates import lookback_days
from leafline.session import broadcast_if_small, materialize
from leafline.sources.snapshots import BACK, date_of_path, load_days

_NESTED = "^(ARRAY|OBJECT)"


class Days(NamedTuple):
    """rows: the schema's columns and snapshot_date. rejects: snapshot_date, reason,
    record (text). report: snapshot_date, name, column (null: unknown),
    kinds (types and their counts), n (records that have it)."""

    rows: DataFrame
    rejects: DataFrame
    report: DataFrame


def _names(field: StructField, aliases: dict[str, list[str]]) -> list[str]:
    return [field.name, *aliases.get(field.name, [])]


def _value(field: StructField, aliases: dict[str, list[str]]) -> Column:
    """The column's value as VARIANT, under the first of its names that the record has."""
    return F.coalesce(*[F.element_at("fields", F.lit(n)) for n in _names(field, aliases)])


def _kind(v: Column) -> Column:
    """The type of a value; decimals of any precision are one type."""
    return F.regexp_replace(F.schema_of_variant(v), r"\(\d+,\d+\)", "")


def _elements(v: Column) -> Column:
    return F.try_variant_get(v, "$", "array<variant>")


def _unfit(field: StructField, v: Column) -> Column:
    """The type of a value that cannot be read as the field's, else null."""
    if isinstance(field.dataType, ArrayType):
        nested = F.exists(_elements(v), lambda e: F.coalesce(F.schema_of_variant(e).rlike(_NESTED), F.lit(False)))
        bad = (F.schema_of_variant(v) != "VOID") & F.coalesce(nested, F.lit(True))
    else:
        bad = F.schema_of_variant(v).rlike(_NESTED)
    return F.when(v.isNotNull() & bad, F.concat(F.lit(f"{field.name} is "), _kind(v)))


def _read(field: StructField, v: Column) -> Column:
    if isinstance(field.dataType, ArrayType):
        return F.transform(_elements(v), lambda e: F.try_variant_get(e, "$", "string"))
    return F.try_variant_get(v, "$", "string")


def records_of(lines: DataFrame) -> DataFrame:
    """(snapshot_date, record, fields) from (snapshot_date, value): a line holds one
    record or an array of them. `fields` is null where there is no record."""
    parsed = lines.where("trim(value) <> ''").withColumn("v", F.try_parse_json("value"))
    each = F.coalesce(_elements(F.col("v")), F.array("v"))
    one = parsed.select("snapshot_date", "value", F.explode(each).alias("v"))
    record = F.coalesce(F.to_json("v"), F.col("value"))
    return one.select("snapshot_date", record.alias("record"), F.try_variant_get("v", "$", "map<string,variant>").alias("fields"))


def column_report(records: DataFrame, schema: StructType, aliases: dict[str, list[str]] | None = None) -> DataFrame:
    """(snapshot_date, name, column, kinds, n): the types of every name on every day.
    Counted in each task first; a day has as many rows here as it has names."""
    wanted = {n: f.name for f in schema for n in _names(f, aliases or {})}
    column = F.create_map(*[F.lit(x) for pair in wanted.items() for x in pair])
    seen = records.select("snapshot_date", F.explode("fields").alias("name", "v"))
    kinds = seen.groupBy("snapshot_date", "name", _kind(F.col("v")).alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    out = kinds.groupBy("snapshot_date", "name").agg(
        F.sort_array(F.collect_list(F.struct("kind", "n"))).alias("kinds"), F.sum("n").alias("n")
    )
    return out.select("snapshot_date", "name", F.element_at(column, F.col("name")).alias("column"), "kinds", "n")


def renamed_days(report: DataFrame, schema: StructType) -> DataFrame:
    """(snapshot_date, renamed) of days that lack a wanted column and have an unknown one."""
    day = report.groupBy("snapshot_date").agg(
        F.collect_set("column").alias("has"), F.sort_array(F.collect_set(F.when(F.col("column").isNull(), F.col("name")))).alias("unknown")
    )
    missing = F.array_except(F.array(*[F.lit(f.name) for f in schema]), "has")
    text = F.concat(F.lit("missing "), F.array_join(missing, ", "), F.lit("; unknown "), F.array_join("unknown", ", "))
    return day.where((F.size(missing) > 0) & (F.size("unknown") > 0)).select("snapshot_date", text.alias("renamed"))


def fold_days(records: DataFrame, schema: StructType, aliases: dict[str, list[str]] | None = None) -> Days:
    """The records of all days in one schema. Every record is in `rows` or in
    `rejects`, once."""
    aliases = aliases or {}
    report = materialize(column_report(records, schema, aliases), "column-report")
    marked = records.join(broadcast_if_small(renamed_days(report, schema)), "snapshot_date", "left")
    unfit = F.concat_ws("; ", *[_unfit(f, _value(f, aliases)) for f in schema])
    reason = F.when(F.col("fields").isNull(), F.lit("no record")).otherwise(F.coalesce("renamed", F.nullif(unfit, F.lit(""))))
    marked = marked.withColumn("reason", reason)
    rows = marked.where("reason IS NULL").select(
        *[_read(f, _value(f, aliases)).cast(f.dataType).alias(f.name) for f in schema], "snapshot_date"
    )
    return Days(rows, marked.where("reason IS NOT NULL").select("snapshot_date", "reason", "record"), report)


def scan_drifting(
    spark: SparkSession, base: str, schema: StructType, anchor: date, style: str, back: int = BACK,
    aliases: dict[str, list[str]] | None = None,
) -> Days:
    """`scan_lookback` for days whose records differ in shape. The files are read
    twice, once for the types alone."""
    lines = load_days(spark.read.text, base, lookback_days(anchor, back), style)
    return fold_days(records_of(lines.select("value", date_of_path(style).alias("snapshot_date"))), schema, aliases)
