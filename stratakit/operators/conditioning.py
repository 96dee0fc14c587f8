"""Conditioning of soundings: row hygiene, truncation, unit repair.

Every operator works on the long table of all soundings, keyed by a sheet and ordered by a sequence column, and needs no window
over a whole sheet: verdicts on a sheet are aggregates that are joined back, so a sheet that holds a tenth of all rows is spread
like any other.

Edge cases: placeholders for missing readings count in no statistic and pass through unchanged; nulls count in the denominators
of shares; a sheet with fewer than two depths has step 1.0, and so has one whose median step is 0 among distinct depths too;
in ``strict`` mode the sleeve-friction share is compared with 10 per cent, and placeholders are looked for after depths were made
positive.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratakit import constants as K
from stratakit.functions.numbers import median_of_counts, nearest_power_of_ten, real
from stratakit.session import broadcast_if_small, chunked_lag, salted_join

READINGS = ("depth", "qc", "fs", "u2")
#: Rows per chunk of the sequence when a lag is taken.
CHUNK = 10_000


def count_numbers(columns: Sequence[str] = READINGS) -> Column:
    return sum((F.col(c).isNotNull().cast("int") for c in columns), F.lit(0))


def numeric_rows(df: DataFrame, columns: Sequence[str] = READINGS, surplus: int = K.MIN_ROW_SURPLUS) -> DataFrame:
    """Rows with at least ``surplus`` more numbers than texts among the columns (typed columns hold no texts)."""
    return df.where(count_numbers(columns) >= surplus)


def nonzero_rows(df: DataFrame, columns: Sequence[str] = READINGS) -> DataFrame:
    """Rows that are not all zero or null."""
    return df.where(sum((F.coalesce((F.col(c) != 0).cast("int"), F.lit(0)) for c in columns), F.lit(0)) > 0)


def truncate_after(df: DataFrame, sheet: str, seq: str, bad: Column) -> DataFrame:
    """The rows of each sheet before its first bad row."""
    first = df.where(bad).groupBy(sheet).agg(F.min(seq).alias("__stop"))
    joined = salted_join(df, first, [sheet], "left", [seq])
    return joined.where(F.col("__stop").isNull() | (F.col(seq) < F.col("__stop"))).drop("__stop")


def positive_depth(df: DataFrame, depth: str = "depth", strict: bool = False) -> DataFrame:
    """Depths without sign; placeholders keep theirs unless ``strict``."""
    c = F.col(depth)
    return df.withColumn(depth, F.abs(c) if strict else F.when(c.isin(*K.PLACEHOLDERS), c).otherwise(F.abs(c)))


def _scaled(c: Column, factor: Column) -> Column:
    return F.when(c.isin(*K.PLACEHOLDERS) | factor.isNull(), c).otherwise(c * factor)


def explicit_conversions(df: DataFrame, sheet: str, names: DataFrame, spread: str) -> DataFrame:
    """Divide by 100 where a depth name says cm, by 1000 where another name says kPa, and log what was done.

    ``names``: sheet, depth_name, qc_name, fs_name, u2_name (null when unknown).
    """
    says = {"depth": ("cm", 100.0, "m"), **{c: ("kpa", 1000.0, "MPa") for c in ("qc", "fs", "u2")}}
    joined = salted_join(df, names, [sheet], "left", [spread])
    logs = []
    for c, (word, by, unit) in says.items():
        hit = F.lower(f"{c}_name").contains(word)
        joined = joined.withColumn(c, F.when(hit & ~F.col(c).isin(*K.PLACEHOLDERS), F.col(c) / by).otherwise(F.col(c)))
        logs.append(F.when(hit, F.concat(F.col(f"{c}_name"), F.lit(f" was converted from {word} to {unit}"))))
    joined = joined.withColumn("explicit_unit_conversions", F.concat_ws("_AND_", *logs))
    return joined.drop(*[f"{c}_name" for c in says])


def shares_over(df: DataFrame, sheet: str) -> DataFrame:
    """Per sheet the percentages of readings beyond the limits that suggest another unit."""
    d, q, f, u = (real(F.col(c)) for c in READINGS)
    share = lambda cond: F.lit(100.0) * F.count_if(cond) / F.count("*")
    return df.groupBy(sheet).agg(
        share((d > K.CM_LIMIT) & (d < K.MM_LIMIT)).alias("pct_cm"), share(d > K.MM_LIMIT).alias("pct_mm"),
        share(q > K.QC_LIMIT).alias("pct_qc"), share(f > K.FS_LIMIT).alias("pct_fs"), share(F.abs(u) > K.U_LIMIT).alias("pct_u"),
    )


def depth_steps(df: DataFrame, sheet: str, seq: str, depth: str = "depth") -> DataFrame:
    """(sheet, step): median difference of consecutive depths, to a millionth; among distinct depths where it would be 0."""
    rows = df.select(sheet, seq, F.abs(real(F.col(depth))).alias("d")).where("d is not null")
    rows = rows.groupBy(sheet, seq).agg(F.min("d").alias("d"))
    once = rows.groupBy(sheet, "d").agg(F.min(seq).alias(seq))
    chunk = F.floor(F.col(seq) / CHUNK)

    def median_step(of: DataFrame, name: str) -> DataFrame:
        lagged = chunked_lag(of, [sheet], seq, chunk, F.col("d"), "before").where("before is not null")
        counted = lagged.groupBy(sheet, F.round(F.col("d") - F.col("before"), 6).alias("s")).agg(F.count("*").alias("n"))
        return median_of_counts(counted, [sheet], "s", "n", name)

    all_ = df.select(sheet).distinct()
    both = all_.join(median_step(rows, "m"), sheet, "left").join(median_step(once, "m2"), sheet, "left")
    step = F.when(F.col("m") != 0, F.col("m")).when((F.col("m") == 0) & (F.col("m2") != 0), F.col("m2")).otherwise(1.0)
    return both.select(sheet, step.alias("step"))


def inferred_factors(df: DataFrame, sheet: str, seq: str, strict: bool = False) -> DataFrame:
    """(sheet, f_depth, f_qc, f_fs, f_u2): what each column must be multiplied by, null where nothing."""
    facts = shares_over(df, sheet).join(depth_steps(df, sheet, seq), sheet)
    limit = F.lit(K.PERCENT_LIMIT)
    depth = (
        F.when(F.col("pct_cm") > limit, F.lit(0.01))
        .when(F.col("pct_mm") > limit, F.lit(0.001))
        .when(F.col("step") < K.SMALLEST_STEP, nearest_power_of_ten(F.lit(K.TYPICAL_STEP) / F.col("step")))
    )
    over = lambda c, most: F.when(F.col(c) > most, F.lit(0.001))
    return facts.select(
        sheet, depth.alias("f_depth"), over("pct_qc", limit).alias("f_qc"),
        over("pct_fs", F.lit(K.FS_LIMIT) if strict else limit).alias("f_fs"), over("pct_u", limit).alias("f_u2"),
    )


def inferred_conversions(df: DataFrame, sheet: str, seq: str, strict: bool = False) -> DataFrame:
    """Apply :func:`inferred_factors` and log them in ``inferred_unit_conversions``."""
    joined = salted_join(df, inferred_factors(df, sheet, seq, strict), [sheet], "left", [seq])
    log = F.concat_ws("_AND_", *[F.when(F.col(f"f_{c}").isNotNull(), F.concat(F.lit(f"{c} was scaled by "), F.col(f"f_{c}").cast("string"))) for c in READINGS])
    out = joined.withColumn("inferred_unit_conversions", log)
    for c in READINGS:
        out = out.withColumn(c, _scaled(F.col(c), F.col(f"f_{c}")))
    return out.drop(*[f"f_{c}" for c in READINGS])


def condition(df: DataFrame, sheet: str, seq: str, names: DataFrame, strict: bool = False) -> DataFrame:
    """Positive depth, explicit conversions, inferred conversions, in this order."""
    return inferred_conversions(explicit_conversions(positive_depth(df, strict=strict), sheet, names, seq), sheet, seq, strict)


def names_by_sheet(reports: DataFrame, headers: DataFrame, terms: DataFrame, columns: Mapping[str, str] | None = None) -> DataFrame:
    """(cpt_id, depth_name, qc_name, fs_name, u2_name) from the header cells of each report's file."""
    columns = columns or {"depth": "depth", "qc": "qc", "fs": "fs", "u": "u2"}
    known = broadcast_if_small(terms.groupBy("search_term").agg(F.min("quantity").alias("quantity")))
    names = headers.join(known, "search_term").groupBy("file_path").agg(
        *[F.min_by(F.when(F.col("quantity") == q, F.col("matched_string")), F.when(F.col("quantity") == q, F.col("col_index_in_line"))).alias(f"{c}_name") for q, c in columns.items()]
    )
    sheets = reports.where("cpt_id is not null").groupBy("cpt_id").agg(F.min("source_file").alias("file_path"))
    return sheets.join(names, "file_path").drop("file_path")
