"""Relational load: dimensions, encodings, keys, upserts, back-references.

Edge cases: a null key matches no dimension row and encodes to null; of several rows for one key the last by order wins, ties by
the row's content; surrogate keys follow a total order, so a rerun on the same rows gives the same keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratakit import constants as K
from stratakit.schemas import KEYS, conform
from stratakit.session import broadcast_if_small, cut, salted_join


def constant_dimension(spark: SparkSession, mapping: Mapping[str, int], value: str = "value") -> DataFrame:
    return spark.createDataFrame([(i, v) for v, i in mapping.items()], f"id int, {value} string")


def dimension_keys(df: DataFrame, value: str) -> DataFrame:
    """(id, value): the distinct non-null values in order, numbered from 1, in range partitions and never in one task."""
    values = df.select(F.col(value).alias("value")).where("value is not null").distinct()
    return surrogate_ids(values, ["value"], "id").select(F.col("id").cast("int").alias("id"), "value")


def fixed_dimensions(spark: SparkSession) -> dict[str, DataFrame]:
    """The store's dimensions with fixed ids: (id, value), soils (id, name)."""
    fixed = {
        "type": K.INVESTIGATION_TYPES, "terminationreason": K.TERMINATION_REASONS, "cptgroundwaterlevelmethod": K.GWL_METHODS,
        "spttovs30hammertype": K.HAMMER_TYPES, "cpttovscorrelation": K.CPT_TO_VS, "spttovscorrelation": K.SPT_TO_VS, "vstovs30correlation": K.VS_TO_VS30,
    }
    return {n: constant_dimension(spark, m) for n, m in fixed.items()} | {"soiltypes": constant_dimension(spark, K.SOIL_TYPES, "name")}


def encode(df: DataFrame, column: str, dimension: DataFrame, name: str) -> DataFrame:
    """Add ``name``: the dimension's id of ``column``; null where there is none."""
    ids = dimension.select(F.col("value").alias(column), F.col("id").alias(name))
    return df.join(broadcast_if_small(ids), column, "left")


def unknown_values(df: DataFrame, column: str, dimension: DataFrame) -> DataFrame:
    """Non-null values that the dimension lacks."""
    known = dimension.select(F.col("value").alias(column))
    return df.where(F.col(column).isNotNull()).join(broadcast_if_small(known), column, "left_anti").select(column).distinct()


def type_by_membership(df: DataFrame, key: str, members: DataFrame, name: str = "type_id") -> DataFrame:
    """1 where the key is among ``members``, else 2."""
    flags = members.select(F.col(members.columns[0]).alias(key)).where(F.col(key).isNotNull()).distinct().withColumn("__in", F.lit(True))
    return salted_join(df, flags, [key], "left", df.columns).withColumn(name, F.when(F.col("__in"), 1).otherwise(2)).drop("__in")


def last_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the last by ``order``; equal ones by their whole content. Pre-aggregates before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in sorted(rest)])
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("__row"))
    return picked.select(*keys, "__row.*").select(*df.columns)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order, *sorted(rest))).alias("__row"))
    return picked.select(*keys, "__row.*").select(*df.columns)


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``old`` with the rows of ``new`` put over it by key; a replaced row is replaced whole."""
    fresh = last_wins(new, keys, order)
    return old.join(fresh.select(*keys), list(keys), "left_anti").unionByName(fresh, allowMissingColumns=True)


def insert_new(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``old`` with those rows of ``new`` whose key it lacks; the first of equals stays."""
    fresh = first_per_key(new, keys, [])
    return old.unionByName(fresh.join(old.select(*keys), list(keys), "left_anti"), allowMissingColumns=True)


def update_matched(df: DataFrame, changes: DataFrame, key: str, columns: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Overwrite ``columns`` where ``changes`` has the key; keys that only ``changes`` has are ignored."""
    fresh = last_wins(changes.select(key, *columns, *[c for c in order if c not in columns and c != key]), [key], order)
    fresh = fresh.select(key, *[F.col(c).alias(f"__{c}") for c in columns], F.lit(True).alias("__hit"))
    out = salted_join(df, fresh, [key], "left", df.columns)
    for c in columns:
        out = out.withColumn(c, F.when(F.col("__hit"), F.col(f"__{c}")).otherwise(F.col(c)))
    return out.drop("__hit", *[f"__{c}" for c in columns])


def surrogate_ids(df: DataFrame, order: Sequence[str], name: str, first: int = 1) -> DataFrame:
    """A running integer over a total order, without a single-partition window: rows are range-partitioned by the order, and each
    partition starts after the rows of those before it."""
    parts = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__p", F.spark_partition_id())
    parts = cut(parts.withColumn("__at", F.monotonically_increasing_id()))
    sizes = parts.groupBy("__p").agg(F.count("*").alias("__n"), F.min("__at").alias("__low"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("__p", "__low", before.alias("__before"))  # one row per partition
    numbered = parts.join(F.broadcast(offsets), "__p")
    return numbered.withColumn(name, F.col("__before") + (F.col("__at") - F.col("__low")) + first).drop("__p", "__at", "__low", "__before")


def ordinal_in_record(df: DataFrame, record: str, order: Sequence[str], name: str = "investigation_number") -> DataFrame:
    """0-based number of each sheet in its record; ``df`` has one row per sheet."""
    return df.withColumn(name, F.dense_rank().over(Window.partitionBy(record).orderBy(*order)) - 1)


def residual(extracted: Column, model: Column) -> Column:
    return extracted - model


def sheet_key_parts(key: Column) -> Column:
    """(nzgd_id, file_name, sheet_name) of a key ``id_AND_file_AND_sheet``; null unless it has exactly three parts."""
    parts = F.split(key, "_AND_")
    return F.when(F.size(parts) == 3, F.struct(parts[0].try_cast("int").alias("nzgd_id"), parts[1].alias("file_name"), parts[2].alias("sheet_name")))


def cpt_reports(
    mapping: DataFrame, measurements: DataFrame, models: DataFrame, reasons: DataFrame, methods: DataFrame, flags: DataFrame, duplicates: DataFrame | None = None
) -> DataFrame:
    """One row per mapped sounding: depth range, data flag, encoded reason and method, level residual, conversion flags.

    ``mapping``: cpt_id, nzgd_id, termination_reason, ground_water_level, gwl_method, tip_net_area_ratio, source_file. ``models``: nzgd_id,
    model_gwl (the first per record counts). ``flags``: cpt_id and the two conversion logs. ``duplicates``: cpt_id, duplicate_of, see
    :func:`back_references`. A sounding without rows has no data; when it was removed as a duplicate, it names the sounding that was
    kept and takes over its depth range. No flag means no conversion.
    """
    depth = measurements.where("cpt_id is not null").groupBy("cpt_id").agg(F.min("depth").alias("min_depth"), F.max("depth").alias("max_depth"))
    model = models.where("nzgd_id is not null").groupBy("nzgd_id").agg(F.min("model_gwl").alias("model_gwl"))
    some = lambda c: F.max((F.length(c) > 0).cast("int"))
    done = flags.groupBy("cpt_id").agg(
        some("explicit_unit_conversions").alias("did_explicit_unit_conversion"), some("inferred_unit_conversions").alias("did_inferred_unit_conversion")
    )
    if duplicates is None:
        duplicates = mapping.sparkSession.createDataFrame([], "cpt_id long, duplicate_of long")
    kept = duplicates.groupBy("cpt_id").agg(F.min("duplicate_of").alias("kept"))
    of_kept = depth.select(F.col("cpt_id").alias("kept"), F.col("min_depth").alias("kept_min"), F.col("max_depth").alias("kept_max"))
    kept = salted_join(kept, of_kept, ["kept"], "left", ["cpt_id"])
    rows = encode(encode(mapping, "termination_reason", reasons, "termination_reason_id"), "gwl_method", methods, "gwl_method_id")
    rows = rows.join(depth.withColumn("has", F.lit(1)), "cpt_id", "left").join(done, "cpt_id", "left").join(kept, "cpt_id", "left")
    rows = salted_join(rows, model, ["nzgd_id"], "left", ["cpt_id"])
    bare = F.col("has").isNull()
    return rows.select(
        "cpt_id", "nzgd_id", F.when(bare, F.col("kept_max")).otherwise(F.col("max_depth")).alias("max_depth"),
        F.when(bare, F.col("kept_min")).otherwise(F.col("min_depth")).alias("min_depth"), F.col("ground_water_level").alias("extracted_gwl"), "gwl_method_id",
        residual(F.col("ground_water_level"), F.col("model_gwl")).alias("gwl_residual"), "tip_net_area_ratio", "termination_reason_id",
        F.coalesce("has", F.lit(0)).alias("has_cpt_data"), F.when(bare, F.col("kept")).alias("cpt_data_duplicate_of_cpt_id"),
        F.coalesce("did_explicit_unit_conversion", F.lit(0)).alias("did_explicit_unit_conversion"),
        F.coalesce("did_inferred_unit_conversion", F.lit(0)).alias("did_inferred_unit_conversion"), "source_file",
    )


def cpt_measurements(mapping: DataFrame, extracted: DataFrame) -> DataFrame:
    """Store rows of the mapped soundings: measurement_id, cpt_id, depth, qc, fs, u2, numbered by sounding and order in the sheet.

    ``mapping``: cpt_id, sheet_key (``id_AND_file_AND_sheet``). ``extracted``: nzgd_id, file_name, sheet_name, seq, depth, qc, fs, u. A key
    without its three parts, or without rows, gives nothing.
    """
    keys = mapping.select("cpt_id", sheet_key_parts(F.col("sheet_key")).alias("k")).where("k is not null").select("cpt_id", "k.*").distinct()
    rows = salted_join(extracted, keys, ["nzgd_id", "file_name", "sheet_name"], "inner", ["seq"])
    rows = rows.select("cpt_id", "seq", "depth", "qc", "fs", F.col("u").alias("u2"))
    return conform(surrogate_ids(rows, ["cpt_id", "seq", "depth", "qc", "fs", "u2"], "measurement_id"), "cptmeasurements")


def investigation_records(metadata: DataFrame, places: Mapping[str, DataFrame], cpt: DataFrame, spt: DataFrame) -> DataFrame:
    """Store rows of the records that have a sounding or a borehole: the last metadata row of each, places encoded, type by membership.

    ``metadata``: see :func:`stratakit.sources.metadata.read_metadata`. ``places``: a dimension for each of region, district, city, suburb.
    ``cpt`` and ``spt``: nzgd_id. A record of both kinds is a sounding (type 1); unknown places are null.
    """
    known = cpt.select("nzgd_id").union(spt.select("nzgd_id")).distinct()
    rows = last_wins(salted_join(metadata, known, ["nzgd_id"], "left_semi", metadata.columns), ["nzgd_id"], ["line"])
    for place in ("region", "district", "city", "suburb"):
        rows = encode(rows, place, places[place], f"{place}_id")
    return conform(type_by_membership(rows, "nzgd_id", cpt.select("nzgd_id")), "nzgdrecord")


def back_references(removed: DataFrame, sheets: DataFrame) -> DataFrame:
    """(cpt_id, duplicate_of): resolves ``removed_duplicates`` lists (``id_AND_file_AND_sheet`` joined by ``___``) to sounding ids.

    ``removed``: duplicate_of, removed_duplicates. ``sheets``: cpt_id, sheet_key.
    """
    keys = removed.where("removed_duplicates <> ''").select("duplicate_of", F.explode(F.split("removed_duplicates", "___")).alias("sheet_key"))
    return salted_join(keys, sheets.select("sheet_key", "cpt_id").distinct(), ["sheet_key"], "inner", ["duplicate_of"]).select("cpt_id", "duplicate_of").distinct()


def missing_references(df: DataFrame, column: str, target: DataFrame, key: str) -> DataFrame:
    """Rows whose non-null reference has no target: the foreign-key check."""
    return df.where(F.col(column).isNotNull()).join(target.select(F.col(key).alias(column)).distinct(), column, "left_anti")


def write_store(df: DataFrame, path: str, name: str, mode: str = "overwrite") -> None:
    """Write a store table sorted by its key inside files, so that Parquet statistics prune."""
    key = [k for k in KEYS.get(name, ["id"]) if k in df.columns]
    df.repartitionByRange(*key).sortWithinPartitions(*key).write.mode(mode).parquet(f"{path}/{name}") if key else df.write.mode(mode).parquet(f"{path}/{name}")


def write_extractions(measurements: DataFrame, failures: DataFrame, path: str, buckets: int = 64) -> None:
    """Both outputs of the sheet pipeline, in hash buckets of the record id instead of one file per record."""
    for df, name in ((measurements, "extracted_data_per_record"), (failures, "extraction_failures_per_record")):
        bucket = F.pmod(F.xxhash64("nzgd_id"), F.lit(buckets))
        df.withColumn("bucket", bucket).repartition("bucket").sortWithinPartitions("nzgd_id").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/{name}")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def borehole_json(spt: DataFrame, key: str) -> DataFrame:
    """(key, document): one JSON document per borehole, counts sorted by depth. A borehole's counts are one document by definition."""
    return spt.groupBy(key).agg(F.to_json(F.struct(F.array_sort(F.collect_list(F.struct("depth", "n"))).alias("measurements"))).alias("document"))
