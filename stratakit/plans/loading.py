"""Queries of the relational load."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratakit import constants as K
from stratakit.functions.text import level_method
from stratakit.operators import load as L
from stratakit.plans.miners import spt_by_depth
from stratakit.plans.registry import Registry
from stratakit.session import salted_join, table
from stratakit.sources.text import refused, with_names

registry = Registry()

_RECORD = "type_id, latitude, longitude, region_id, district_id"


def _case(column: str, mapping: dict[str, int]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{v}' THEN {i}" for v, i in mapping.items()) + " END"


@registry.query("SELECT row_number() OVER (ORDER BY p_brand)::INT AS id, p_brand AS value FROM (SELECT DISTINCT p_brand FROM part WHERE p_brand IS NOT NULL)")
def dim_keys(spark: SparkSession, d: str) -> DataFrame:
    """A dimension numbered in order."""
    return L.dimension_keys(table(spark, d, "part"), "p_brand")


@registry.query("""SELECT DISTINCT r.nzgd_id, a.district_name, a.region_name, coalesce(k.id, -1) AS region_key FROM nzgdrecord r LEFT JOIN districtarea a USING (district_id)
  LEFT JOIN (SELECT region_name, row_number() OVER (ORDER BY region_name)::INT AS id FROM (SELECT DISTINCT region_name FROM districtarea)) k ON k.region_name = a.region_name""")
def dim_encode_left(spark: SparkSession, d: str) -> DataFrame:
    """J1, PR18: place names of each record and the key of its region in a fresh dimension."""
    areas = table(spark, d, "districtarea").select("district_id", "district_name", "region_name")
    named = table(spark, d, "nzgdrecord").select("nzgd_id", "district_id").join(L.broadcast_if_small(areas), "district_id", "left")
    keyed = L.encode(named, "region_name", L.dimension_keys(areas, "region_name"), "region_key")
    return keyed.select("nzgd_id", "district_name", "region_name", "region_key").fillna(-1, ["region_key"]).distinct()


@registry.query(f"""SELECT DISTINCT value_id, {_case('m', K.GWL_METHODS)} AS gwl_method_id FROM (SELECT value_id, CASE WHEN contains(n, 'collapse') OR contains(n, 'collapase') THEN 'collapsed'
  WHEN contains(n, 'estimate') THEN 'estimated' WHEN contains(n, 'assume') THEN 'assumed' WHEN contains(n, 'derive') AND NOT contains(n, 'not') THEN 'derived' WHEN contains(n, 'dip') THEN 'dipper'
  WHEN contains(n, 'measure') AND NOT contains(n, 'not') THEN 'measured' END AS m FROM (SELECT value_id, lower(ground_water_level_note) AS n FROM extractedsinglevalues)) WHERE m IS NOT NULL""")
def constant_encode(spark: SparkSession, d: str) -> DataFrame:
    """J2, SK10: how each level was found, and the fixed id of that method."""
    rows = table(spark, d, "extractedsinglevalues").select("value_id", level_method(F.col("ground_water_level_note")).alias("m")).where("m is not null").distinct()
    return L.encode(rows, "m", L.fixed_dimensions(spark)["cptgroundwaterlevelmethod"], "gwl_method_id").select("value_id", "gwl_method_id")


@registry.query("SELECT * FROM (VALUES " + ", ".join(f"('{n}', {i}, '{v}')" for n, m in (
    ("type", K.INVESTIGATION_TYPES), ("terminationreason", K.TERMINATION_REASONS), ("cptgroundwaterlevelmethod", K.GWL_METHODS), ("spttovs30hammertype", K.HAMMER_TYPES),
    ("cpttovscorrelation", K.CPT_TO_VS), ("spttovscorrelation", K.SPT_TO_VS), ("vstovs30correlation", K.VS_TO_VS30), ("soiltypes", K.SOIL_TYPES)) for v, i in m.items()) + ") t(name, id, value)")
def fixed_dimensions(spark: SparkSession, d: str) -> DataFrame:
    """SK10, SK11: every dimension with fixed ids."""
    parts = [f.toDF("id", "value").select(F.lit(n).alias("name"), "id", "value") for n, f in L.fixed_dimensions(spark).items()]
    return reduce(DataFrame.unionByName, parts)


@registry.query("SELECT DISTINCT r.nzgd_id, CASE WHEN c.nzgd_id IS NOT NULL THEN 1 ELSE 2 END AS type_id FROM nzgdrecord r LEFT JOIN (SELECT DISTINCT nzgd_id FROM cptreport) c ON c.nzgd_id = r.nzgd_id")
def type_by_membership(spark: SparkSession, d: str) -> DataFrame:
    """1 for records with soundings, else 2."""
    ids = table(spark, d, "nzgdrecord").select("nzgd_id").distinct()
    return L.type_by_membership(ids, "nzgd_id", table(spark, d, "cptreport").select("nzgd_id"))


@registry.query("SELECT DISTINCT measurement_id, cpt_id FROM cptmeasurements m WHERE EXISTS (SELECT 1 FROM cptreport r WHERE r.cpt_id = m.cpt_id AND r.termination_reason_id = 1)")
def semi_filter(spark: SparkSession, d: str) -> DataFrame:
    """Measurements of soundings that met refusal."""
    refused = table(spark, d, "cptreport").where("termination_reason_id = 1").select("cpt_id")
    return table(spark, d, "cptmeasurements").select("measurement_id", "cpt_id").join(refused, "cpt_id", "left_semi").distinct()


@registry.query("SELECT DISTINCT cpt_id, source_file FROM cptreport r WHERE NOT EXISTS (SELECT 1 FROM cptmeasurements m WHERE m.cpt_id = r.cpt_id)")
def anti_filter(spark: SparkSession, d: str) -> DataFrame:
    """Soundings without measurements."""
    reports = table(spark, d, "cptreport").select("cpt_id", "source_file").distinct()
    return reports.join(table(spark, d, "cptmeasurements").select("cpt_id"), "cpt_id", "left_anti")


@registry.query("""SELECT nzgd_id, type_id, latitude, longitude, original_investigation_name, loaded_at FROM (SELECT *, row_number() OVER (PARTITION BY nzgd_id ORDER BY loaded_at DESC) AS k FROM nzgdrecord) WHERE k = 1""")
def upsert_last_wins(spark: SparkSession, d: str) -> DataFrame:
    """SK5: one row per record, the last delivered."""
    rows = table(spark, d, "nzgdrecord").select("nzgd_id", "type_id", "latitude", "longitude", "original_investigation_name", "loaded_at")
    return L.last_wins(rows, ["nzgd_id"], ["loaded_at"])


@registry.query("""WITH p AS (SELECT nzgd_id, arg_max(model_gwl_westerhoff_2018, loaded_at) AS model_gwl_westerhoff_2018 FROM nzgdrecord GROUP BY nzgd_id),
  r AS (SELECT nzgd_id, max(extracted_gwl) AS extracted_gwl FROM cptreport WHERE nzgd_id IS NOT NULL GROUP BY nzgd_id)
  SELECT r.nzgd_id, CASE WHEN p.nzgd_id IS NOT NULL THEN p.model_gwl_westerhoff_2018 ELSE r.extracted_gwl END AS extracted_gwl FROM r LEFT JOIN p USING (nzgd_id)""")
def update_matched(spark: SparkSession, d: str) -> DataFrame:
    """SK8, J8: levels overwritten where a change has the key."""
    changes = table(spark, d, "nzgdrecord").select("nzgd_id", F.col("model_gwl_westerhoff_2018").alias("extracted_gwl"), "loaded_at")
    levels = table(spark, d, "cptreport").where("nzgd_id is not null").groupBy("nzgd_id").agg(F.max("extracted_gwl").alias("extracted_gwl"))
    return L.update_matched(levels, changes, "nzgd_id", ["extracted_gwl"], ["loaded_at"])


@registry.query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate,
  row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate) AS measurement_id FROM lineitem""")
def surrogate_ids(spark: SparkSession, d: str) -> DataFrame:
    """W8, SK6: a running id over a total order."""
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate"]
    return L.surrogate_ids(table(spark, d, "lineitem").select(*order), order, "measurement_id")


@registry.query("""SELECT nzgd_id, cpt_id, source_file, dense_rank() OVER (PARTITION BY nzgd_id ORDER BY source_file, cpt_id) - 1 AS investigation_number
  FROM (SELECT DISTINCT nzgd_id, cpt_id, source_file FROM cptreport WHERE nzgd_id IS NOT NULL)""")
def investigation_number(spark: SparkSession, d: str) -> DataFrame:
    """Soundings numbered within their record."""
    rows = table(spark, d, "cptreport").where("nzgd_id is not null").select("nzgd_id", "cpt_id", "source_file").distinct()
    return L.ordinal_in_record(rows, "nzgd_id", ["source_file", "cpt_id"])


_LAST = "r AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cpt_id ORDER BY loaded_at DESC) AS k FROM cptreport WHERE cpt_id IS NOT NULL) WHERE k = 1)"


@registry.query(f"""WITH m AS (SELECT cpt_id, min(depth) AS lo, max(depth) AS hi FROM cptmeasurements GROUP BY cpt_id),
  g AS (SELECT nzgd_id, min(model_gwl_westerhoff_2018) AS g FROM nzgdrecord GROUP BY nzgd_id), {_LAST}
  SELECT r.cpt_id, r.nzgd_id, CASE WHEN m.cpt_id IS NULL THEN o.hi ELSE m.hi END AS max_depth, CASE WHEN m.cpt_id IS NULL THEN o.lo ELSE m.lo END AS min_depth, extracted_gwl, gwl_method_id, extracted_gwl - g AS gwl_residual,
    tip_net_area_ratio, termination_reason_id, CASE WHEN m.cpt_id IS NOT NULL THEN 1 ELSE 0 END AS has_cpt_data, CASE WHEN m.cpt_id IS NULL THEN cpt_data_duplicate_of_cpt_id END AS cpt_data_duplicate_of_cpt_id,
    coalesce(did_explicit_unit_conversion, 0) AS did_explicit_unit_conversion, coalesce(did_inferred_unit_conversion, 0) AS did_inferred_unit_conversion, source_file
  FROM r LEFT JOIN m USING (cpt_id) LEFT JOIN g ON g.nzgd_id = r.nzgd_id LEFT JOIN m o ON o.cpt_id = r.cpt_data_duplicate_of_cpt_id""")
def residual_and_minmax(spark: SparkSession, d: str) -> DataFrame:
    """SK13: J1, J4, J5, J6, A5, A6, PR19 - reports with depth ranges, inherited ones too, level residuals, encoded names and conversion flags."""
    last = L.last_wins(table(spark, d, "cptreport").where("cpt_id is not null"), ["cpt_id"], ["loaded_at"])
    dims = L.fixed_dimensions(spark)
    name = lambda mapping, c: F.create_map(*[F.lit(x) for v, i in mapping.items() for x in (i, v)])[F.col(c)]
    log = lambda c: F.when(F.col(c) == 1, "noted").otherwise("")
    reports = last.select(
        "cpt_id", "nzgd_id", F.col("extracted_gwl").alias("ground_water_level"), "tip_net_area_ratio", "source_file",
        name(K.TERMINATION_REASONS, "termination_reason_id").alias("termination_reason"), name(K.GWL_METHODS, "gwl_method_id").alias("gwl_method"),
    )
    flags = last.select("cpt_id", log("did_explicit_unit_conversion").alias("explicit_unit_conversions"), log("did_inferred_unit_conversion").alias("inferred_unit_conversions"))
    duplicates = last.where("cpt_data_duplicate_of_cpt_id is not null").select("cpt_id", F.col("cpt_data_duplicate_of_cpt_id").alias("duplicate_of"))
    models = table(spark, d, "nzgdrecord").select("nzgd_id", F.col("model_gwl_westerhoff_2018").alias("model_gwl"))
    return L.cpt_reports(reports, table(spark, d, "cptmeasurements"), models, dims["terminationreason"], dims["cptgroundwaterlevelmethod"], flags, duplicates)


@registry.query(f"""WITH {_LAST}, m AS (SELECT DISTINCT * FROM cptmeasurements)
  SELECT row_number() OVER (ORDER BY r.cpt_id, m.measurement_id, depth, qc, fs, u2) AS measurement_id, r.cpt_id, depth, qc, fs, u2 FROM r JOIN m USING (cpt_id) WHERE r.nzgd_id IS NOT NULL AND source_file IS NOT NULL""")
def store_cpt_measurements(spark: SparkSession, d: str) -> DataFrame:
    """SK14, PR20: measurements of the mapped soundings under running ids."""
    last = L.last_wins(table(spark, d, "cptreport").where("cpt_id is not null"), ["cpt_id"], ["loaded_at"]).select("cpt_id", "nzgd_id", "source_file")
    sheet = F.col("cpt_id").cast("string")
    mapping = last.select("cpt_id", F.concat(F.col("nzgd_id").cast("string"), F.lit("_AND_"), "source_file", F.lit("_AND_"), sheet).alias("sheet_key"))
    rows = salted_join(table(spark, d, "cptmeasurements").distinct(), last, ["cpt_id"], "inner", ["measurement_id"])
    extracted = rows.select("nzgd_id", F.col("source_file").alias("file_name"), sheet.alias("sheet_name"), F.col("measurement_id").alias("seq"), "depth", "qc", "fs", F.col("u2").alias("u"))
    return L.cpt_measurements(mapping, extracted)


@registry.query("""WITH l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY nzgd_id ORDER BY loaded_at DESC) AS k FROM nzgdrecord) WHERE k = 1),
  dk AS (SELECT district_name, row_number() OVER (ORDER BY district_name)::INT AS id FROM (SELECT DISTINCT district_name FROM districtarea)),
  rk AS (SELECT region_name, row_number() OVER (ORDER BY region_name)::INT AS id FROM (SELECT DISTINCT region_name FROM districtarea)),
  v AS (SELECT DISTINCT nzgd_id FROM extractedsinglevalues), c AS (SELECT DISTINCT nzgd_id FROM cptreport)
  SELECT l.nzgd_id, CASE WHEN c.nzgd_id IS NOT NULL THEN 1 ELSE 2 END AS type_id, latitude, longitude, original_investigation_name, rk.id AS region_id, dk.id AS district_id FROM l LEFT JOIN districtarea a USING (district_id)
  LEFT JOIN dk USING (district_name) LEFT JOIN rk USING (region_name) LEFT JOIN c ON c.nzgd_id = l.nzgd_id WHERE c.nzgd_id IS NOT NULL OR l.nzgd_id IN (SELECT nzgd_id FROM v)""")
def store_records(spark: SparkSession, d: str) -> DataFrame:
    """SK12, SC16, J7, J9: records that have a sounding or a scalar value, the last delivered of each, with places and type."""
    areas = table(spark, d, "districtarea").select("district_id", F.col("district_name").alias("district"), F.col("region_name").alias("region"))
    rows = table(spark, d, "nzgdrecord").drop("region_id", "type_id", "city_id", "suburb_id").join(L.broadcast_if_small(areas), "district_id", "left").drop("district_id")
    none = F.lit(None).cast("string")
    meta = rows.withColumns({"line": F.col("loaded_at"), "city": none, "suburb": none})
    empty = spark.createDataFrame([], "id int, value string")
    places = {"region": L.dimension_keys(areas, "region"), "district": L.dimension_keys(areas, "district"), "city": empty, "suburb": empty}
    out = L.investigation_records(meta, places, table(spark, d, "cptreport"), table(spark, d, "extractedsinglevalues"))
    return out.select("nzgd_id", "type_id", "latitude", "longitude", "original_investigation_name", "region_id", "district_id")


@registry.query("""WITH r AS (SELECT DISTINCT cpt_id, nzgd_id, source_file FROM cptreport WHERE nzgd_id IS NOT NULL),
  f AS (SELECT nzgd_id, min(cpt_id) AS duplicate_of FROM r GROUP BY nzgd_id) SELECT r.cpt_id, f.duplicate_of FROM r JOIN f USING (nzgd_id) WHERE r.cpt_id <> f.duplicate_of""")
def back_reference_split(spark: SparkSession, d: str) -> DataFrame:
    """J6, A14, PR20: joined key lists split again and resolved to ids (each record's first sounding names the others)."""
    r = table(spark, d, "cptreport").where("nzgd_id is not null").select("cpt_id", "nzgd_id", "source_file").distinct()
    key = F.concat_ws("_AND_", F.col("nzgd_id").cast("string"), "source_file", F.col("cpt_id").cast("string"))
    keyed = r.withColumn("sheet_key", key)
    first = r.groupBy("nzgd_id").agg(F.min("cpt_id").alias("duplicate_of"))
    # lists are cut into bounded pieces, so no record's list grows with the record
    others = keyed.join(first, "nzgd_id").where("cpt_id <> duplicate_of").withColumn("piece", F.pmod(F.xxhash64("cpt_id"), F.lit(64)))
    removed = others.groupBy("duplicate_of", "piece").agg(F.array_join(F.sort_array(F.collect_list("sheet_key")), "___").alias("removed_duplicates"))
    return L.back_references(removed.select("duplicate_of", "removed_duplicates"), keyed)


@registry.query("""WITH r AS (SELECT DISTINCT cpt_id, cpt_data_duplicate_of_cpt_id AS t FROM cptreport) SELECT cpt_id, t AS cpt_data_duplicate_of_cpt_id FROM r WHERE t IS NOT NULL
  AND t NOT IN (SELECT cpt_id FROM cptreport)""")
def missing_references(spark: SparkSession, d: str) -> DataFrame:
    """1.4: references without a target."""
    reports = table(spark, d, "cptreport")
    rows = reports.select("cpt_id", "cpt_data_duplicate_of_cpt_id").distinct()
    return L.missing_references(rows, "cpt_data_duplicate_of_cpt_id", reports, "cpt_id").select("cpt_id", "cpt_data_duplicate_of_cpt_id")


@registry.query("""SELECT nzgd_id, arg_max(cpt_id, (coalesce(max_depth, -1e300), -cpt_id)) AS deepest FROM cptreport WHERE nzgd_id IS NOT NULL GROUP BY nzgd_id""")
def top1_by_key(spark: SparkSession, d: str) -> DataFrame:
    """The deepest sounding of each record, the smaller id on ties."""
    rows = table(spark, d, "cptreport").where("nzgd_id is not null")
    return rows.groupBy("nzgd_id").agg(F.max_by("cpt_id", F.struct(F.coalesce("max_depth", F.lit(-1e300)), -F.col("cpt_id"))).alias("deepest"))


@registry.query("SELECT nzgd_id, -1::BIGINT AS cpt_id, 'record' AS kind FROM nzgdrecord UNION ALL SELECT nzgd_id, cpt_id, 'report' FROM cptreport")
def union_by_name(spark: SparkSession, d: str) -> DataFrame:
    """Union with missing columns (-1: none)."""
    a = table(spark, d, "nzgdrecord").select("nzgd_id", F.lit("record").alias("kind"))
    return a.unionByName(table(spark, d, "cptreport").select("cpt_id", "nzgd_id", F.lit("report").alias("kind")), allowMissingColumns=True).fillna(-1, ["cpt_id"])


@registry.query("SELECT nzgd_id FROM nzgdrecord UNION SELECT nzgd_id FROM cptreport")
def set_union(spark: SparkSession, d: str) -> DataFrame:
    """U2."""
    return table(spark, d, "nzgdrecord").select("nzgd_id").union(table(spark, d, "cptreport").select("nzgd_id")).distinct()


@registry.query("SELECT nzgd_id FROM nzgdrecord EXCEPT SELECT nzgd_id FROM cptreport")
def set_except(spark: SparkSession, d: str) -> DataFrame:
    """U3."""
    return table(spark, d, "nzgdrecord").select("nzgd_id").subtract(table(spark, d, "cptreport").select("nzgd_id"))


@registry.query("SELECT nzgd_id FROM nzgdrecord INTERSECT SELECT nzgd_id FROM cptreport")
def set_intersect(spark: SparkSession, d: str) -> DataFrame:
    """U4."""
    return table(spark, d, "nzgdrecord").select("nzgd_id").intersect(table(spark, d, "cptreport").select("nzgd_id"))


@registry.query("SELECT district_id, median(model_gwl_westerhoff_2018) AS level FROM nzgdrecord WHERE district_id IS NOT NULL AND model_gwl_westerhoff_2018 IS NOT NULL GROUP BY district_id")
def median_level(spark: SparkSession, d: str) -> DataFrame:
    """Median level per district, over counted distinct values."""
    from stratakit.functions.numbers import median_of_counts

    counted = table(spark, d, "nzgdrecord").where("district_id is not null").groupBy("district_id", F.col("model_gwl_westerhoff_2018").alias("v")).agg(F.count("*").alias("n"))
    return median_of_counts(counted, ["district_id"], "v", "n", "level")


@registry.query("""WITH c AS (SELECT region_id, district_id, count(*) AS records, count(latitude) AS located FROM nzgdrecord GROUP BY ROLLUP (region_id, district_id))
  SELECT coalesce(region_id, -1) AS region_id, coalesce(district_id, -1) AS district_id, records, located FROM c""")
def rollup_counts(spark: SparkSession, d: str) -> DataFrame:
    """Records and located records per district, region and in all (-1: all or unknown)."""
    out = table(spark, d, "nzgdrecord").rollup("region_id", "district_id").agg(F.count("*").alias("records"), F.count("latitude").alias("located"))
    return out.fillna(-1, ["region_id", "district_id"])


@registry.query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_scalar(spark: SparkSession, d: str) -> DataFrame:
    """SK4, inverse."""
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"))


@registry.query(r"""WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents), x AS (SELECT doc_id, unnest(ls) AS t FROM l),
  s AS (SELECT DISTINCT doc_id, try_cast(regexp_extract(t, '\bNc?\s*(=|>)\s*(\d+)', 2) AS INT) AS n, try_cast(regexp_extract(t, 'at (\d+\.\d+) m', 1) AS DOUBLE) AS depth FROM x WHERE regexp_matches(t, '\bNc?\s*(=|>)\s*(\d+)'))
  SELECT doc_id, '{"measurements":[' || string_agg('{"depth":' || depth::VARCHAR || CASE WHEN n IS NULL THEN '' ELSE ',"n":' || n END || '}', ',' ORDER BY depth, n NULLS FIRST) || ']}' AS document FROM s WHERE depth IS NOT NULL GROUP BY doc_id""")
def borehole_json(spark: SparkSession, d: str) -> DataFrame:
    """SK4: penetration counts of each text as one JSON document."""
    return L.borehole_json(spt_by_depth(spark, d), "doc_id")


@registry.query("""SELECT file_path, lower(regexp_extract(file_path, '(\\.[^.]+)$', 1)) AS suffix, CASE lower(regexp_extract(file_path, '(\\.[^.]+)$', 1)) WHEN '.ags' THEN 'ags' WHEN '.pdf' THEN 'nondata'
  WHEN '.cpt' THEN 'nondata' WHEN '.xlsx' THEN 'spreadsheet' WHEN '.xls' THEN 'spreadsheet' WHEN '.csv' THEN 'spreadsheet' WHEN '.txt' THEN 'spreadsheet' ELSE 'unknown' END AS kind,
  try_cast(regexp_extract(file_path, '^[^_]*_(\\d+)', 1) AS INT) AS nzgd_id FROM (SELECT DISTINCT file_path FROM searchforcolresults)""".replace("\\\\", "\\"))
def file_kinds(spark: SparkSession, d: str) -> DataFrame:
    """SC1, SC2, SC4, V7: files by suffix and record."""
    files = table(spark, d, "searchforcolresults").select("file_path").distinct()
    named = with_names(files.select(F.col("file_path").alias("path"), F.lit(0).cast("long").alias("length"), F.lit(b"").alias("content")))
    return named.select(F.col("path").alias("file_path"), "suffix", "kind", "nzgd_id")


@registry.query("""WITH f AS (SELECT DISTINCT CASE WHEN length(file_path) % 3 = 0 THEN replace(file_path, '_', '-') ELSE file_path END AS p FROM searchforcolresults)
  SELECT regexp_extract(p, '([^/]+)$', 1) AS file_name, 'bad_file_name_format' AS category FROM f WHERE NOT contains(regexp_extract(p, '([^/]+)$', 1), '_')
    AND regexp_matches(lower(p), '[.](csv|txt|xls|xlsx|ags)$')""")
def refused_files(spark: SparkSession, d: str) -> DataFrame:
    """SC4, V7: files whose names do not follow the format (every third by length has its ``_`` replaced) are refused."""
    files = table(spark, d, "searchforcolresults").select("file_path").distinct()
    odd = F.when(F.length("file_path") % 3 == 0, F.replace(F.col("file_path"), F.lit("_"), F.lit("-"))).otherwise(F.col("file_path"))
    named = with_names(files.select(odd.alias("path"), F.lit(0).cast("long").alias("length"), F.lit(b"").alias("content")))
    return refused(named).select("file_name", "category")
