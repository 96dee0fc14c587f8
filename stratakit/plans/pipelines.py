"""End-to-end pipelines from folders of files to tables; each returns DataFrames and writes nothing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratakit.operators import boreholes, conditioning, dedupe, load, mining, sheets
from stratakit.session import cut
from stratakit.sources import ags, excel, text

def _key(path: str, sheet: Column) -> Column:
    return F.concat(F.col(path), F.lit("\n"), sheet)


def grids(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(lines: sheet_key, row, cells; failures; all files) of all text files and workbooks below ``path``; refused files are not opened."""
    listed = text.list_files(spark, path)
    files = listed.join(text.refused(listed.drop("content")).select("path"), "path", "left_anti")
    lines, unsplit = text.grid(text.file_lines(files))
    flat = lines.select(_key("path", F.lit("0")).alias("sheet_key"), "row", "cells")
    cells, broken = excel.workbook_grids(files)
    all_ = flat.unionByName(cells.select(_key("path", F.col("sheet")).alias("sheet_key"), "row", "cells"))
    empty = files.where(F.col("suffix").isin(".csv", ".txt") & (F.col("length") == 0)).select("path", F.lit("no_data").alias("category"), F.lit("empty file").alias("details"))
    failures = unsplit.unionByName(empty).select(_key("path", F.lit("0")).alias("sheet_key"), "category", "details")
    return all_, failures.unionByName(broken.select(_key("path", F.col("sheet")).alias("sheet_key"), "category", "details")), listed


def soundings(spark: SparkSession, path: str, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(measurements, failures) of every sounding below ``path``, one directory per record: scan, choose columns, truncate, condition, drop
    contained sheets, number the rest."""
    lines, unread, files = grids(spark, path)
    opened = files.join(text.refused(files.drop("content")).select("path"), "path", "left_anti")
    texts = cut(opened.where("suffix = '.ags'").select("path", text.decode(F.col("content")).alias("text")))
    files = cut(files.drop("content"))
    good, failed, chosen = sheets.extract_named(cut(lines), "sheet_key", F.col("sheet_key").rlike(r"(?i)\.xlsx?\n"))
    good = good.select("sheet_key", F.col("row").cast("long").alias("seq"), "depth", "qc", "fs", F.col("u").alias("u2"))
    names = chosen.groupBy("sheet_key").agg(*[F.max(F.when(F.col("parameter") == p, F.col("name"))).alias(f"{c}_name") for p, c in (("depth", "depth"), ("qc", "qc"), ("fs", "fs"), ("u", "u2"))])
    cone, cone_names, cone_failed = ags.cone_tests(texts)
    key = _key("path", F.lit("0")).alias("sheet_key")
    cone = cone.where(conditioning.count_numbers(["depth", "qc", "fs", "u"]) >= 3)
    good = good.unionByName(cone.select(key, F.col("row").cast("long").alias("seq"), "depth", "qc", "fs", F.col("u").alias("u2")))
    names = names.unionByName(cone_names.select(key, "depth_name", "qc_name", "fs_name", F.col("u_name").alias("u2_name")))
    failed = failed.unionByName(unread).unionByName(cone_failed.select(key, "category", "details"))

    done = cut(conditioning.condition(good, "sheet_key", "seq", names, strict))
    origin = files.select("path", "nzgd_id", "file_name", "record")
    file_of = F.split("sheet_key", "\n")[0]
    owned = done.withColumn("path", file_of).join(origin.select("path", "nzgd_id", "file_name"), "path").withColumn("sheet_name", F.split("sheet_key", "\n")[1])
    twice = cut(dedupe.contained_sheets(owned, "nzgd_id", "sheet_key", "seq", "prefix" if strict else "contiguous"))
    gone = twice.join(owned.select("sheet_key", "file_name", "sheet_name").distinct(), "sheet_key")
    label = F.concat_ws("_AND_", F.col("nzgd_id").cast("string"), "file_name", "sheet_name")
    removed = gone.groupBy(F.col("kept_in").alias("sheet_key")).agg(F.array_join(F.sort_array(F.collect_list(label)), "___").alias("removed_duplicates"))
    live = conditioning.nonzero_rows(owned).select("sheet_key").distinct()
    kept = owned.join(twice.select("sheet_key"), "sheet_key", "left_anti").join(live, "sheet_key", "left_semi").join(removed, "sheet_key", "left")
    order = load.ordinal_in_record(kept.select("nzgd_id", "sheet_key").distinct(), "nzgd_id", ["sheet_key"])
    out = kept.join(order.drop("nzgd_id"), "sheet_key").select(
        "nzgd_id", "file_name", "sheet_name", "seq", "depth", "qc", "fs", F.col("u2").alias("u"), "explicit_unit_conversions", "inferred_unit_conversions",
        F.coalesce("removed_duplicates", F.lit("")).alias("removed_duplicates"), "investigation_number",
    )
    listed = text.listing_failures(files).select(F.col("record").alias("record_name"), "file_name", F.lit("").alias("sheet_name"), "category", "details")
    failures = failed.withColumn("path", file_of).join(origin, "path", "left").select(
        F.col("record").alias("record_name"), "file_name", F.split("sheet_key", "\n")[1].alias("sheet_name"), "category", "details"
    )
    return out, load.ordinal_in_record(failures.unionByName(listed), "record_name", ["file_name", "sheet_name", "category", "details"], "failed_extraction_index")


def scalar_candidates(spark: SparkSession, path: str) -> DataFrame:
    """Every candidate for a level, an area ratio or a termination reason in the sheets below ``path``."""
    lines = cut(grids(spark, path)[0])
    seen = sheets.candidates(lines)
    found = sum(((F.size(p) > 0).cast("int") for p in ("depth", "qc", "fs", "u")), F.lit(0))
    top = cut(mining.above_header(lines, mining.first_full_header(seen, "sheet_key", found), "sheet_key"))
    hits = mining.neighbours(mining.term_matches(top, "sheet_key"), top, "sheet_key")
    return mining.search_candidates(hits, mining.orientation(top, "sheet_key"), "sheet_key")


def scalars(spark: SparkSession, path: str) -> DataFrame:
    """(nzgd_id, file_name, sheet_name, termination_reason, ground_water_level, gwl_method, tip_net_area_ratio), one row per sheet with any."""
    found = cut(scalar_candidates(spark, path))
    numbers = mining.resolve_numbers(found, "sheet_key")
    level, ratio = F.col("quantity") == "ground_water_level", F.col("quantity") == "tip_net_area_ratio"
    wide = numbers.groupBy("sheet_key").agg(
        F.max(F.when(level, F.col("value"))).alias("ground_water_level"), F.max(F.when(level, F.col("method"))).alias("gwl_method"), F.max(F.when(ratio, F.col("value"))).alias("tip_net_area_ratio")
    )
    endings = found.where(F.col("search_term").isin(mining.K.TERMINATION_TERMS)).select("sheet_key", mining.classify_ending(F.col("value"), F.col("field_label")).alias("termination_reason"))
    reasons = mining.prior_ending(endings.where("termination_reason is not null"), "sheet_key", "termination_reason")
    both = wide.join(reasons, "sheet_key", "full")
    named = F.split(F.split("sheet_key", "\n")[0], "/")
    return both.select(
        F.regexp_extract(F.element_at(named, -2), r"^[^_]*_(\d+)", 1).try_cast("int").alias("nzgd_id"), F.element_at(named, -1).alias("file_name"), F.split("sheet_key", "\n")[1].alias("sheet_name"),
        "termination_reason", "ground_water_level", "gwl_method", "tip_net_area_ratio",
    )


def ags_boreholes(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(counts, soils, efficiency, water strikes) of the AGS files below ``path``."""
    texts = cut(text.list_files(spark, path, "*.[aA][gG][sS]").select("path", text.decode(F.col("content")).alias("text")))
    return (*ags.borehole_groups(texts), ags.water_strikes(texts))


def box_boreholes(boxes: DataFrame) -> DataFrame:
    """Counts, soils, efficiencies and failures of printed logs; see :mod:`stratakit.operators.boreholes`."""
    return boreholes.analyse(boxes)
