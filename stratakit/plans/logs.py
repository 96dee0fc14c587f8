"""Queries over exchange files, workbooks and printed logs that are written from the tables, so that SQL can tell what must be read back.

Each order stands for one exchange file, each supplier for one workbook or report; their lines stand for the readings.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratakit import constants as K
from stratakit.operators import boreholes
from stratakit.plans.registry import Registry
from stratakit.session import cut, table
from stratakit.sources import ags, excel

registry = Registry()


def _order() -> Column:
    return F.col("l_orderkey")


def _supplier() -> Column:
    return F.col("l_suppkey")


def _lines(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus")


def _quoted(*cells: Column | str) -> Column:
    parts = [F.lit(f'"{c}"') if isinstance(c, str) else F.concat(F.lit('"'), F.coalesce(c.cast("string"), F.lit("")), F.lit('"')) for c in cells]
    return F.concat_ws(",", *parts)


def _per_order(lines: DataFrame, *texts: Column) -> DataFrame:
    """(l_orderkey, one text per argument): the order's lines joined in order. An order has a handful of lines."""
    joined = [F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", t.alias("t")))), lambda x: x["t"]), "\n") for t in texts]
    return lines.groupBy("l_orderkey").agg(*[j.alias(f"t{k}") for k, j in enumerate(joined)])


# ---------------------------------------------------------------- cone tests in exchange files


def _cone_files(spark: SparkSession, d: str) -> DataFrame:
    """Of five files two are sound, and one each lacks a column, lacks the group, or names a column twice."""
    u = F.when(F.col("l_returnflag") != "N", F.col("l_tax"))
    data = _per_order(_lines(spark, d), _quoted("DATA", F.col("l_linenumber") * 0.5, F.col("l_quantity"), F.col("l_discount"), u))
    kind = _order() % 5
    last = F.when(kind == 2, "SCPT_XXX").when(kind == 4, "SCPT_DPTH").otherwise("SCPT_PWP2")
    head = F.concat(F.lit('"GROUP","'), F.when(kind == 3, "ABBR").otherwise("SCPT"), F.lit('"\r\n"HEADING","SCPT_DPTH","SCPT_RES","SCPT_FRES","'), last, F.lit('"\r\n"UNIT","m","MPa","kPa","kPa"\r\n'))
    return data.select(_order().cast("string").alias("path"), F.concat(head, "t0").alias("text"))


@registry.query("""SELECT l_orderkey, l_linenumber * 0.5::DOUBLE AS depth, l_quantity AS qc, l_discount AS fs, CASE WHEN l_returnflag <> 'N' THEN l_tax END AS u
  FROM lineitem WHERE l_orderkey % 5 < 2""")
def ags_cone_tests(spark: SparkSession, d: str) -> DataFrame:
    """SC12: cone tests read back from exchange files."""
    rows = ags.cone_tests(cut(_cone_files(spark, d)))[0]
    return rows.select(F.col("path").cast("long").alias("l_orderkey"), "depth", "qc", "fs", "u")


@registry.query("""SELECT DISTINCT l_orderkey, CASE l_orderkey % 5 WHEN 2 THEN 'ags_missing_columns' WHEN 3 THEN 'ags_missing_table' ELSE 'ags_duplicate_headers' END AS category,
  CASE l_orderkey % 5 WHEN 2 THEN 'SCPT_PWP2' ELSE 'SCPT' END AS details FROM lineitem WHERE l_orderkey % 5 >= 2""")
def ags_failures(spark: SparkSession, d: str) -> DataFrame:
    """SC12: exchange files that cannot be used, with the reason."""
    rows = ags.cone_tests(cut(_cone_files(spark, d)))[2]
    return rows.select(F.col("path").cast("long").alias("l_orderkey"), "category", "details")


# ---------------------------------------------------------------- boreholes in exchange files


def _borehole_files(spark: SparkSession, d: str) -> DataFrame:
    count = F.when(F.col("l_linestatus") == "O", F.col("l_quantity").cast("int"))
    soil = F.when(F.col("l_returnflag") == "A", "Brown CLAY, with SAND").when(F.col("l_returnflag") == "R", "GRAVEL").otherwise("fill")
    strike = F.when(F.col("l_discount") > 0.02, F.col("l_quantity")).cast("string")
    texts = _per_order(
        _lines(spark, d), _quoted("DATA", F.col("l_linenumber") * 1.5, count), _quoted("DATA", F.col("l_linenumber") * 2.0, soil),
        _quoted("DATA", F.coalesce(strike, F.lit("dry"))),
    )
    note = F.concat(F.lit('"GROUP","HORN"\n"HEADING","T"\n"DATA","Hammer energy ratio '), _order() % 100, F.lit('%"\n'))
    text = F.concat(
        F.lit('"GROUP","ISPT"\n"HEADING","ISPT_TOP","ISPT_MAIN"\n"UNIT","m",""\n'), F.col("t0"), F.lit('\n"GROUP","GEOL"\n"HEADING","GEOL_TOP","GEOL_DESC"\n'), F.col("t1"), F.lit("\n"), note,
        F.lit('"GROUP","WSTG"\n"HEADING","WSTG_DPTH"\n"UNIT","m"\n'), F.col("t2"),
    )
    return texts.select(_order().cast("string").alias("path"), text.alias("text"))


@registry.query("""WITH counted AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_linestatus = 'O'),
  spt AS (SELECT l_orderkey, 'count' AS kind, l_linenumber * 1.5::DOUBLE AS depth, CASE WHEN l_linestatus = 'O' THEN floor(l_quantity)::INT::VARCHAR ELSE '' END AS "value" FROM lineitem JOIN counted USING (l_orderkey)),
  geol AS (SELECT l_orderkey, 'soil', l_linenumber * 2.0::DOUBLE, unnest(CASE l_returnflag WHEN 'A' THEN ['CLAY', 'SAND'] WHEN 'R' THEN ['GRAVEL'] ELSE [] END) FROM lineitem)
  SELECT * FROM spt UNION ALL SELECT * FROM geol UNION ALL SELECT DISTINCT l_orderkey, 'efficiency', NULL::DOUBLE, ((l_orderkey % 100)::DOUBLE)::VARCHAR FROM lineitem""")
def ags_boreholes(spark: SparkSession, d: str) -> DataFrame:
    """SC13, V15, 2.10: counts, soils and efficiencies of boreholes; a file with nothing but empty counts has none."""
    counts, soils, efficiency = ags.borehole_groups(cut(_borehole_files(spark, d)))
    order = F.col("path").cast("long").alias("l_orderkey")
    rows = counts.select(order, F.lit("count").alias("kind"), "depth", F.col("n").alias("value"))
    rows = rows.unionByName(soils.select(order, F.lit("soil").alias("kind"), F.col("top_depth").alias("depth"), F.explode("soil_types").alias("value")))
    return rows.unionByName(efficiency.select(order, F.lit("efficiency").alias("kind"), F.lit(None).cast("double").alias("depth"), F.col("efficiency").cast("string").alias("value")))


@registry.query("""SELECT l_orderkey, count(*) FILTER (WHERE l_discount > 0.02) AS strikes, median(l_quantity) FILTER (WHERE l_discount > 0.02) AS level FROM lineitem GROUP BY l_orderkey""")
def ags_water_strikes(spark: SparkSession, d: str) -> DataFrame:
    """SC14, SK3, A8: water strikes of each file and their median."""
    rows = ags.water_strikes(cut(_borehole_files(spark, d)))
    return rows.select(F.col("path").cast("long").alias("l_orderkey"), F.size("strikes").cast("long").alias("strikes"), F.col("median").alias("level"))


# ---------------------------------------------------------------- printed logs


def _log_boxes(spark: SparkSession, d: str) -> DataFrame:
    """A page per supplier: a wide depth label with left-aligned numbers under it, counts and soils beside it, a stray number elsewhere.

    Of nine reports one has no label, one no scale, one no count and one a count far below the hole.
    """
    lines = _lines(spark, d)
    kind = _supplier() % 9
    box = lambda text, y, x0, x1: F.struct(
        F.lit(0).alias("page"), y.cast("double").alias("y0"), (y + 8).cast("double").alias("y1"), F.lit(float(x0)).alias("x0"), F.lit(float(x1)).alias("x1"), text.alias("text")
    )
    at = lambda depth: F.lit(700.0) - depth * 20.0
    deep = F.when(kind == 3, 200.0).otherwise(0.0)
    count = F.when(kind == 2, "none").otherwise(F.concat(F.lit("N = "), F.col("l_quantity").cast("int")))
    soil = F.when(F.col("l_returnflag") == "A", "Brown CLAY with SAND").when(F.col("l_returnflag") == "R", "GRAVEL").otherwise("fill")
    own = F.array(box(count, at(F.col("l_linenumber") * 0.75 + deep), 300, 330), box(soil, at(F.col("l_linenumber") * 0.75), 200, 280))
    label = F.array(
        box(F.when(kind == 0, "Level").otherwise("Depth (m)"), F.lit(760.0), 100, 160), box(F.lit("77"), F.lit(610.0), 420, 430),
        box(F.concat(F.lit("Hammer efficiency "), _supplier() % 100, F.lit("%")), F.lit(790.0), 300, 400),
        *[box(F.when(kind == 1, "x").otherwise(str(k)), at(F.lit(float(k))), 101, 108) for k in range(0, 6)],
    )
    all_ = lines.select("l_suppkey", F.inline(own)).unionByName(lines.select("l_suppkey").distinct().select("l_suppkey", F.inline(label)))
    return all_.withColumn("report", _supplier().cast("string")).drop("l_suppkey")


_LOG = """ok AS (SELECT * FROM lineitem WHERE l_suppkey % 9 > 3),
  found AS (SELECT l_suppkey, 'spt' AS kind, round_even(l_linenumber * 0.75::DOUBLE / 0.25, 0) * 0.25::DOUBLE AS depth, floor(l_quantity)::INT AS n, NULL::VARCHAR AS soils, NULL::DOUBLE AS efficiency, NULL::VARCHAR AS category FROM ok
  UNION ALL SELECT l_suppkey, 'soil', l_linenumber * 0.75::DOUBLE, NULL, CASE l_returnflag WHEN 'A' THEN 'CLAY SAND' ELSE 'GRAVEL' END, NULL, NULL FROM ok WHERE l_returnflag <> 'N'
  UNION ALL SELECT DISTINCT l_suppkey, 'efficiency', NULL::DOUBLE, NULL::INT, NULL, (l_suppkey % 100)::DOUBLE, NULL FROM ok
  UNION ALL SELECT DISTINCT l_suppkey, 'failure', NULL::DOUBLE, NULL::INT, NULL, NULL::DOUBLE,
    CASE l_suppkey % 9 WHEN 0 THEN 'no_depth_label' WHEN 1 THEN 'no_depth_scale' WHEN 2 THEN 'no_spt_values' ELSE 'depth_out_of_range' END FROM lineitem WHERE l_suppkey % 9 <= 3)"""


@registry.query(f"WITH {_LOG} SELECT * FROM found")
def box_logs(spark: SparkSession, d: str) -> DataFrame:
    """Counts, soils, efficiency or failure of every printed log."""
    rows = boreholes.analyse(_log_boxes(spark, d))
    return rows.select(
        F.col("report").cast("long").alias("l_suppkey"), "kind", F.round("depth", 6).alias("depth"), "n", F.array_join(F.array_sort("soil_types"), " ").alias("soils"), "efficiency", "category"
    )


@registry.query(f"""WITH {_LOG} SELECT (row_number() OVER (ORDER BY l_suppkey, depth, n))::BIGINT AS measurement_id, l_suppkey::INT AS borehole_id, depth, n FROM found WHERE kind = 'spt'""")
def store_spt_measurements(spark: SparkSession, d: str) -> DataFrame:
    """The counts of all logs as store rows."""
    return _store(spark, d)["sptmeasurements"]


@registry.query(f"""WITH {_LOG} SELECT report_id, count(*) AS soils, sum(k)::BIGINT AS links, min(top) AS highest FROM (SELECT l_suppkey::INT AS report_id, round(depth, 6) AS top,
  CASE soils WHEN 'GRAVEL' THEN 1 ELSE 2 END AS k FROM found WHERE kind = 'soil') GROUP BY report_id""")
def store_soils(spark: SparkSession, d: str) -> DataFrame:
    """B5, J3, SK6: soil rows of all logs and their links to the soil types."""
    store = _store(spark, d)
    links = store["soilmeasurementsoiltype"].groupBy(F.col("soil_measurement_id").alias("measurement_id")).agg(F.count("*").alias("k"))
    rows = cut(store["soilmeasurements"]).join(links, "measurement_id")
    return rows.groupBy("report_id").agg(F.count("*").alias("soils"), F.sum("k").alias("links"), F.round(F.min("top_depth"), 6).alias("highest"))


@registry.query("SELECT DISTINCT l_suppkey::INT AS borehole_id, l_suppkey::INT AS nzgd_id, (l_suppkey % 100)::DOUBLE AS efficiency, l_suppkey::VARCHAR AS source_file FROM lineitem WHERE l_suppkey % 9 > 3")
def store_spt_reports(spark: SparkSession, d: str) -> DataFrame:
    """One store row per log that could be read."""
    return _store(spark, d)["sptreport"].select("borehole_id", "nzgd_id", "efficiency", "source_file")


def _store(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    found = cut(boreholes.analyse(_log_boxes(spark, d)))
    ids = found.select("report").distinct().withColumn("borehole_id", F.col("report").cast("int"))
    return boreholes.store_reports(spark, found, ids)


# ---------------------------------------------------------------- workbooks


def _workbooks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        content = [b"broken" if k % 7 == 0 else excel.write_xlsx("Sheet-1", [["Depth", None, "qc"], *map(list, rows)]) for k, rows in zip(pdf["l_suppkey"], pdf["rows"])]
        yield pd.DataFrame({"path": pdf["l_suppkey"].astype(str), "suffix": ".xlsx", "content": content})


@registry.query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_linenumber, l_quantity, l_tax)::INT AS row FROM lineitem WHERE l_suppkey % 7 <> 0)
  SELECT l_suppkey, 'Sheet_1' AS sheet, row, 0 AS col, l_linenumber::VARCHAR AS raw FROM r UNION ALL SELECT l_suppkey, 'Sheet_1', row, 2, l_quantity::VARCHAR FROM r
  UNION ALL SELECT DISTINCT l_suppkey, 'Sheet_1', 0, 0, 'Depth' FROM r UNION ALL SELECT DISTINCT l_suppkey, 'Sheet_1', 0, 2, 'qc' FROM r
  UNION ALL SELECT DISTINCT l_suppkey, '', -1, -1, 'invalid_excel_file' FROM lineitem WHERE l_suppkey % 7 = 0""")
def workbook_cells(spark: SparkSession, d: str) -> DataFrame:
    """SC10, SC11: cells of all sheets of all workbooks, and the workbooks that cannot be opened."""
    rows = _lines(spark, d).groupBy("l_suppkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_quantity", "l_tax"))).alias("r"))
    rows = rows.select("l_suppkey", F.transform("r", lambda x: F.array(x["l_linenumber"].cast("string"), F.lit(None).cast("string"), x["l_quantity"].cast("string"))).alias("rows"))
    files = cut(rows.mapInPandas(_workbooks, "path string, suffix string, content binary"))
    cells, failed = excel.workbook_grids(files)
    supplier = F.col("path").cast("long").alias("l_suppkey")
    good = cells.select(supplier, "sheet", "row", F.posexplode("cells").alias("col", "raw")).where("raw is not null")
    return good.unionByName(failed.select(supplier, "sheet", F.lit(-1).alias("row"), F.lit(-1).alias("col"), F.col("category").alias("raw")))


@registry.query("SELECT DISTINCT value_id, CASE WHEN v BETWEEN 0 AND 60 THEN v END AS depth FROM (SELECT value_id, ground_water_level AS v FROM extractedsinglevalues)")
def depth_labels(spark: SparkSession, d: str) -> DataFrame:
    """Texts of depth labels as depths between 0 and the deepest log."""
    from stratakit.functions.numbers import depth_text

    text = F.concat(F.lit(" "), F.col("ground_water_level").cast("string"), F.lit(" m\n"))
    return table(spark, d, "extractedsinglevalues").select("value_id", depth_text(text, K.MAX_SPT_DEPTH).alias("depth")).distinct()
