"""AGS exchange files as long tables, parsed with built-in expressions; a file is one row until its lines are exploded.

AGS4: lines of quoted cells that start with GROUP, HEADING, UNIT, TYPE or DATA. Failures are rows: ags_duplicate_headers,
no_ags_data_tables, ags_missing_table, ags_missing_columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratakit.functions import text as X
from stratakit.functions.numbers import to_number

#: Headings of the cone-test group, in the order depth, qc, fs, u.
CONE = {"depth": "SCPT_DPTH", "qc": "SCPT_RES", "fs": "SCPT_FRES", "u": "SCPT_PWP2"}


def _cells(line: Column) -> Column:
    return F.transform(F.regexp_extract_all(line, F.lit('"((?:[^"]|"")*)"'), F.lit(1)), lambda x: F.replace(x, F.lit('""'), F.lit('"')))


def groups(files: DataFrame) -> DataFrame:
    """(path, row, group, kind, cells): every line of every group. ``files``: path, text."""
    lines = files.select("path", F.posexplode(F.split(F.regexp_replace("text", "\r\n?", "\n"), "\n")).alias("row", "line")).where(F.trim("line") != "")
    cut = lines.withColumn("all", _cells(F.col("line"))).withColumn("kind", F.upper(F.try_element_at("all", F.lit(1))))
    named = F.when(F.col("kind") == "GROUP", F.try_element_at("all", F.lit(2)))
    group = F.last(named, ignorenulls=True).over(Window.partitionBy("path").orderBy("row").rowsBetween(Window.unboundedPreceding, 0))
    return cut.select("path", "row", group.alias("group"), "kind", F.slice("all", F.lit(2), F.greatest(F.size("all") - 1, F.lit(0))).alias("cells"))


def headings(rows: DataFrame) -> DataFrame:
    """(path, group, heading, unit): names and units of each group's columns."""
    one = rows.groupBy("path", "group").agg(
        F.min_by("cells", F.when(F.col("kind") == "HEADING", F.col("row"))).alias("heading"), F.min_by("cells", F.when(F.col("kind") == "UNIT", F.col("row"))).alias("unit")
    )
    return one.where("heading is not null")


def values(rows: DataFrame, group: str, wanted: list[str]) -> DataFrame:
    """(path, row, one text column per wanted heading): the data lines of a group; headings it lacks are null."""
    head = headings(rows).where(F.col("group") == group).select("path", "heading")
    data = rows.where((F.col("group") == group) & (F.col("kind") == "DATA")).join(head, "path")
    at = lambda h: F.array_position("heading", h).cast("int")
    return data.select("path", "row", *[F.when(at(h) > 0, F.try_element_at("cells", at(h))).alias(h) for h in wanted])


def cone_tests(files: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(measurements, names, failures): path, row, depth, qc, fs, u; per file the column names with their units; failure rows."""
    rows = groups(files)
    head = headings(rows)
    twice = head.where(F.size(F.array_distinct("heading")) < F.size("heading")).select("path", F.lit("ags_duplicate_headers").alias("category"), F.col("group").alias("details"))
    bad = twice.select("path").distinct()
    tables = head.groupBy("path").agg(F.collect_set("group").alias("groups"))
    all_ = files.select("path").join(bad, "path", "left_anti").join(tables, "path", "left")
    none = all_.where("groups is null").select("path", F.lit("no_ags_data_tables").alias("category"), F.lit("").alias("details"))
    lacks = all_.where("groups is not null and not array_contains(groups, 'SCPT')").select("path", F.lit("ags_missing_table").alias("category"), F.lit("SCPT").alias("details"))
    cone = head.where("group = 'SCPT'").join(bad, "path", "left_anti")
    gap = F.coalesce(*[F.when(~F.array_contains("heading", h), F.lit(h)) for h in CONE.values()])
    missing = cone.where(gap.isNotNull()).select("path", F.lit("ags_missing_columns").alias("category"), gap.alias("details"))
    good = cone.where(gap.isNull())
    label = {"depth": "Depth", "qc": "qc", "fs": "fs", "u": "u"}
    unit = lambda h: F.coalesce(F.try_element_at("unit", F.array_position("heading", h).cast("int")), F.lit(""))
    names = good.select("path", *[F.concat(F.lit(label[p] + " "), unit(h)).alias(f"{p}_name") for p, h in CONE.items()])
    data = values(rows, "SCPT", list(CONE.values())).join(good.select("path"), "path", "left_semi")
    measured = data.select("path", "row", *[to_number(F.col(h)).alias(p) for p, h in CONE.items()])
    return measured, names, twice.unionByName(none).unionByName(lacks).unionByName(missing)


def borehole_groups(files: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(counts, soils, efficiency) of AGS boreholes: path, depth, n; path, top_depth, soil_types; path, efficiency.

    Counts are dropped for a file in which all are empty; soil rows without a known soil are left out; a file without a percentage
    near a label has a null efficiency.
    """
    rows = groups(files)
    spt = values(rows, "ISPT", ["ISPT_TOP", "ISPT_MAIN"])
    some = spt.where(F.coalesce("ISPT_MAIN", F.lit("")) != "").select("path").distinct()
    counts = spt.join(some, "path", "left_semi").select("path", to_number(F.col("ISPT_TOP")).alias("depth"), F.col("ISPT_MAIN").alias("n"))
    geol = values(rows, "GEOL", ["GEOL_TOP", "GEOL_DESC"])
    soils = geol.select("path", to_number(F.col("GEOL_TOP")).alias("top_depth"), X.soil_types(F.col("GEOL_DESC")).alias("soil_types")).where("size(soil_types) > 0")
    return counts, soils, files.select("path", X.percentage_near_label(F.col("text")).alias("efficiency"))


def water_strikes(files: DataFrame) -> DataFrame:
    """(path, strikes, median): depths of the first section that holds WSTG, AGS3 (``**``) or AGS4 (``"GROUP",``)."""
    split_at = F.when(F.col("text").contains("**"), F.split("text", r"\*\*")).otherwise(F.split("text", '"GROUP",'))
    section = F.try_element_at(F.filter(split_at, lambda s: s.contains("WSTG")), F.lit(1))
    lines = F.split(F.regexp_replace(section, "\r\n?", "\n"), "\n")
    column = F.array_position(F.transform(F.split(F.try_element_at(lines, F.lit(2)), ","), lambda c: F.contains(c, F.lit("WSTG_DPTH"))), True)
    cells = F.transform(F.slice(lines, F.lit(4), F.greatest(F.size(lines) - 3, F.lit(0))), lambda x: F.try_element_at(F.split(x, ","), column.cast("int")))
    numbers = F.filter(F.transform(cells, lambda c: to_number(F.trim(c, F.lit(' "')))), lambda v: v.isNotNull())
    found = files.select("path", F.when(column > 0, numbers).alias("strikes"))
    ordered = F.sort_array("strikes")
    n = F.size("strikes")
    mid = (F.try_element_at(ordered, F.floor((n + 1) / 2).cast("int")) + F.try_element_at(ordered, F.floor((n + 2) / 2).cast("int"))) / 2
    return found.withColumn("median", F.when(n > 0, mid))
