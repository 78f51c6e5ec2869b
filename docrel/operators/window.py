"""Positional operators: ordinals, neighbours, carried headers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.products import document_kind
from ..store import stage


def ordinal(df: DataFrame, key: list[str], *order: Column | str, keep: Column | None = None, name: str = "ordinal") -> DataFrame:
    """Number of a row in its key, from 1, once rows that are not kept have gone."""
    rows = df if keep is None else df.where(keep)
    return rows.withColumn(name, F.row_number().over(W.partitionBy(*key).orderBy(*order)))


def priority(file: Column) -> Column:
    """Price documents first, then technical ones."""
    kind = document_kind(file)
    return F.when(kind == "economico", 0).when(kind == "tecnico", 1).otherwise(2)


def by_priority(files: DataFrame, key: list[str]) -> DataFrame:
    """Rank of a file in its key by kind, then by name without case."""
    return ordinal(files, key, priority(F.col("file")), F.lower("file"), "file", name="rank")


def carry_forward(rows: DataFrame, key: list[str], order: list[str], value: str, name: str = "header") -> DataFrame:
    """The last value that is not null up to each row."""
    w = W.partitionBy(*key).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    return rows.withColumn(name, F.last(value, ignorenulls=True).over(w))


def context(rows: DataFrame, targets: DataFrame, key: list[str], line: str = "line_no", span: int = 2) -> DataFrame:
    """The rows around each target row of a key: an equality join on the few line numbers that lie near."""
    near = targets.select(*key, F.col(line).alias("target"), F.explode(F.sequence(F.col(line) - span, F.col(line) + span)).alias(line))
    return near.join(rows, [*key, line])


def placed(rows: DataFrame, *order: str, name: str = "place") -> DataFrame:
    """rows with their place, from 0, in a total order, without sorting all of them in one task.

    Rows are dealt and sorted by ranges; a row's place is its place in its range and the number of rows in the ranges before, of which there are a few. Columns of
    order must tell rows apart.
    """
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    kept = stage(dealt.select("*", F.shiftright("_id", 33).alias("_range"), F.col("_id").bitwiseAND((1 << 33) - 1).alias("_at")).drop("_id"))
    sizes = kept.groupBy("_range").agg(F.count("*").alias("_n"))
    before = sizes.select("_range", (F.sum("_n").over(W.orderBy("_range")) - F.col("_n")).alias("_before"))  # one row a range
    return kept.join(F.broadcast(before), "_range").withColumn(name, F.col("_before") + F.col("_at")).select(*rows.columns, name)
