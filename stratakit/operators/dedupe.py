"""Duplicate and contained sheets of one record, found by joins instead of pairwise array comparison.

A sheet's rows get a rank. Each sheet is looked for by its anchor, the row that is rarest in the record: where another sheet has
an equal row, the difference of ranks is the offset at which the first would lie in it. A candidate counts when all rows meet there at
that offset, which one equality join on (sheet, rank) tells. Rows that a record repeats over and over are never paired with one
another, and no sheet is ever held in one row.

Modes: ``exact`` (same rows), ``prefix`` (offset 0) and ``contiguous`` (any offset). A sheet that lies in several others goes for the
longest, then the first. Rows that are all zero or null are left out before comparison; a sheet without other rows vanishes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratakit.operators.conditioning import CHUNK, READINGS, nonzero_rows
from stratakit.session import cut, salted_join


def ranked_rows(df: DataFrame, sheet: str, seq: str, columns: Sequence[str] = READINGS) -> DataFrame:
    """Rows with their 0-based rank in the sheet, counted in chunks of the sequence and then across chunks."""
    rows = df.withColumn("__chunk", F.floor(F.col(seq) / CHUNK))
    inner = F.row_number().over(Window.partitionBy(sheet, "__chunk").orderBy(seq, *columns))
    sizes = rows.groupBy(sheet, "__chunk").agg(F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.partitionBy(sheet).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.withColumn("__before", before).drop("__n")
    return rows.withColumn("__r", inner).join(offsets, [sheet, "__chunk"]).withColumn("rank", F.col("__before") + F.col("__r") - 1).drop("__chunk", "__r", "__before")


def contained_sheets(df: DataFrame, record: str, sheet: str, seq: str, mode: str = "contiguous", columns: Sequence[str] = READINGS) -> DataFrame:
    """(record, sheet, kept_in): sheets that duplicate, or lie in, another sheet of the record.

    Of equal sheets the smallest stays. ``kept_in`` may itself lie in a longer sheet only if that one contains both.
    """
    if mode not in ("exact", "prefix", "contiguous"):
        raise ValueError(f"unknown mode: {mode}")
    live = nonzero_rows(df.where(F.col(record).isNotNull() & F.col(sheet).isNotNull()), columns).select(record, sheet, seq, *columns)
    several = live.select(record, sheet).distinct().groupBy(record).count().where("count > 1").select(record)
    rows = ranked_rows(live.join(several, record, "left_semi"), sheet, seq, columns)
    rows = rows.withColumn("h", F.xxhash64(*[x for c in columns for x in (F.col(c) + F.lit(0.0), F.col(c).isNull())]))
    rows = cut(rows.select(record, sheet, "rank", "h", *columns))
    sizes = rows.groupBy(record, sheet).agg(F.count("*").alias("n"))
    counts = rows.groupBy(record, "h").agg(F.count("*").alias("f"))
    anchors = salted_join(rows.select(record, sheet, "rank", "h"), counts, [record, "h"], "inner", ["rank"])
    anchors = anchors.groupBy(record, sheet).agg(F.min_by(F.struct("rank", "h"), F.struct("f", "rank")).alias("a"), F.count("*").alias("nx"))
    anchors = anchors.select(record, F.col(sheet).alias("x"), "nx", F.col("a.rank").alias("a_rank"), F.col("a.h").alias("h"))
    there = rows.select(record, F.col(sheet).alias("y"), "rank", "h")
    met = anchors.join(there, [record, "h"]).where("x <> y").withColumn("at", F.col("rank") - F.col("a_rank")).where("at >= 0")
    met = met.join(sizes.select(record, F.col(sheet).alias("y"), F.col("n").alias("ny")), [record, "y"])
    met = met.where("at + nx <= ny and (nx < ny or y < x)")
    if mode == "exact":
        met = met.where("nx = ny")
    if mode != "contiguous":
        met = met.where("at = 0")
    candidates = cut(met.select(record, "x", "y", "at", "nx", "ny").distinct())
    asked = salted_join(rows.withColumnRenamed(sheet, "x").drop("h"), candidates, [record, "x"], "inner", ["rank"])
    s, l = asked.withColumn("rank", F.col("rank") + F.col("at")).alias("s"), rows.withColumnRenamed(sheet, "y").alias("l")
    same = (F.col(f"s.{record}") == F.col(f"l.{record}")) & (F.col("s.y") == F.col("l.y")) & (F.col("s.rank") == F.col("l.rank"))
    for c in columns:
        same = same & F.col(f"s.{c}").eqNullSafe(F.col(f"l.{c}"))
    whole = s.join(l, same).groupBy(*[F.col(f"s.{c}").alias(c) for c in (record, "x", "y", "at", "nx", "ny")]).agg(F.count("*").alias("met")).where("met = nx")
    best = F.min_by("y", F.struct(-F.col("ny"), "y")).alias("kept_in")
    return whole.groupBy(record, F.col("x").alias(sheet)).agg(best)
