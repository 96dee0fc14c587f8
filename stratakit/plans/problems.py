"""Queries of the general data-preparation problems: failed rows, drift, units, places."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratakit.operators import drift, rowparse, spatial, units
from stratakit.plans.registry import Registry
from stratakit.session import table

registry = Registry()

# ---------------------------------------------------------------- 1: rows that fail to parse

_KINDS = """
kinds AS (
  SELECT file_path, col_index_in_line AS i, coalesce(max(CASE cell_type WHEN 'double' THEN 'd' WHEN 'int' THEN 'i'
    WHEN 'date' THEN 't' WHEN 'string' THEN 's' END), 's') AS k FROM searchforcolresults GROUP BY ALL),
width AS (SELECT file_path, max(i) + 1 AS w FROM kinds GROUP BY file_path),
line AS (SELECT DISTINCT line_id, file_path, delimiter AS d, extraction AS x FROM sheetextractionresult WHERE line_no <> 1),
read AS (
  SELECT *, CASE d WHEN ',' THEN regexp_full_match(x, '(?s)(?:"(?:[^"]|"")*"|[^",]*)(?:,(?:"(?:[^"]|"")*"|[^",]*))*')
    WHEN ';' THEN regexp_full_match(x, '(?s)(?:"(?:[^"]|"")*"|[^";]*)(?:;(?:"(?:[^"]|"")*"|[^";]*))*')
    ELSE regexp_full_match(x, '(?s)(?:"(?:[^"]|"")*"|[^"\\t]*)(?:\\t(?:"(?:[^"]|"")*"|[^"\\t]*))*') END AS sound,
  CASE d WHEN ',' THEN regexp_extract_all(d || x, '(?s),("(?:[^"]|"")*"|[^",]*)', 1)
    WHEN ';' THEN regexp_extract_all(d || x, '(?s);("(?:[^"]|"")*"|[^";]*)', 1)
    ELSE regexp_extract_all(d || x, '(?s)\\t("(?:[^"]|"")*"|[^"\\t]*)', 1) END AS raw FROM line),
cell AS (
  SELECT line_id, d, unnest(raw) AS r, file_path, generate_subscripts(raw, 1) - 1 AS i FROM read WHERE sound),
plain AS (SELECT *, CASE WHEN r LIKE '"%' THEN replace(substr(r, 2, length(r) - 2), '""', '"') ELSE r END AS c FROM cell),
bad AS (
  SELECT DISTINCT line_id FROM plain JOIN kinds USING (file_path, i) WHERE c <> '' AND NOT CASE k
    WHEN 'd' THEN regexp_full_match(CASE d WHEN ';' THEN replace(c, ',', '.') ELSE c END,
      '[ \\t]*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?[ \\t]*')
    WHEN 'i' THEN regexp_full_match(c, '[ \\t]*[+-]?[0-9]+[ \\t]*')
    WHEN 't' THEN regexp_full_match(c, '[0-9]{4}-[0-9]{2}-[0-9]{2}') AND try_cast(c AS DATE) IS NOT NULL ELSE true END),
verdict AS (
  SELECT line_id, file_path, CASE WHEN NOT sound THEN 'quoting' WHEN len(raw) <> w THEN 'column_count'
    WHEN bad.line_id IS NOT NULL THEN 'value' END AS reason FROM read LEFT JOIN width USING (file_path) LEFT JOIN bad USING (line_id))
""".replace("\\t", "\t")


def _parsed(spark: SparkSession, d: str) -> DataFrame:
    return rowparse.error_parse(table(spark, d, "sheetextractionresult"), table(spark, d, "searchforcolresults"))


@registry.query(f"WITH {_KINDS} SELECT DISTINCT line_id, reason FROM verdict WHERE reason IS NOT NULL")
def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return rowparse.rejected(_parsed(spark, d)).select("line_id", "reason").distinct()


@registry.query(f"""WITH {_KINDS} SELECT file_path, coalesce(reason, 'loaded') AS outcome, count(*) AS n
  FROM verdict GROUP BY ALL""")
def p1_outcome_per_file(spark: SparkSession, d: str) -> DataFrame:
    """Lines per file and outcome; every line is either loaded or rejected."""
    parsed = _parsed(spark, d)
    return parsed.groupBy("file_path", F.coalesce("reason", F.lit("loaded")).alias("outcome")).agg(F.count("*").alias("n"))


@registry.query()
def p1_repairs(spark: SparkSession, d: str) -> DataFrame:
    """The cheapest edits that would make each rejected line readable."""
    return rowparse.rejected(_parsed(spark, d))


@registry.query()
def p1_loaded(spark: SparkSession, d: str) -> DataFrame:
    """The lines that load, split into their fields."""
    return rowparse.loaded(_parsed(spark, d))


@registry.query(f"""WITH {_KINDS} SELECT plain.line_id, i::INT AS col, c AS cell FROM plain JOIN verdict USING (line_id) WHERE reason IS NULL""")
def p1_loaded_cells(spark: SparkSession, d: str) -> DataFrame:
    """Every cell of the lines that load."""
    return p1_loaded(spark, d).select("line_id", F.posexplode("fields").alias("col", "cell"))


# ---------------------------------------------------------------- 2: schemas that drift between files

_QUANTITIES = [*drift.CORE, *drift.PROMOTABLE]

_SCHEMAS = """
file AS (SELECT DISTINCT file_path, feed, created_at FROM searchforcolresults),
step AS (SELECT file_path, lag(file_path) OVER (PARTITION BY feed ORDER BY created_at) AS old_path FROM file),
cell AS (SELECT file_path, quantity, min(matched_string) AS name, min(cell_type) AS cell_type
  FROM searchforcolresults JOIN searchterm USING (search_term) GROUP BY ALL),
quantity AS (SELECT DISTINCT quantity FROM searchterm),
pair AS (SELECT s.file_path, q.quantity, a.name AS a, b.name AS b, a.cell_type AS ta, b.cell_type AS tb
  FROM step s CROSS JOIN quantity q LEFT JOIN cell a ON a.file_path = s.file_path AND a.quantity = q.quantity
  LEFT JOIN cell b ON b.file_path = s.old_path AND b.quantity = q.quantity WHERE s.old_path IS NOT NULL)
"""


def _schemas(spark: SparkSession, d: str) -> DataFrame:
    """Every file's schema after rescue, promotion and replay."""
    cells = drift.header_cells(table(spark, d, "searchforcolresults"), table(spark, d, "searchterm"))
    return drift.promote_schemas(drift.observed_schemas(cells), list(drift.PROMOTABLE))


@registry.query(rf"""WITH {_SCHEMAS}
  SELECT file_path, quantity, 'added' AS change FROM pair WHERE a IS NOT NULL AND b IS NULL
  UNION ALL SELECT file_path, quantity, 'removed' FROM pair WHERE a IS NULL AND b IS NOT NULL
  UNION ALL SELECT file_path, quantity, 'renamed' FROM pair
    WHERE lower(regexp_replace(a, '\s', '', 'g')) <> lower(regexp_replace(b, '\s', '', 'g'))
  UNION ALL SELECT file_path, quantity, 'retyped' FROM pair WHERE a IS NOT NULL AND b IS NOT NULL AND ta <> tb""")
def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return drift.schema_changes(_schemas(spark, d), _QUANTITIES)


def _ingested(spark: SparkSession, d: str) -> DataFrame:
    cells = drift.header_cells(table(spark, d, "searchforcolresults"), table(spark, d, "searchterm"))
    return drift.ingest_lines(rowparse.loaded(_parsed(spark, d)), drift.layouts(cells, list(drift.CORE)))


@registry.query()
def p2_rescued(spark: SparkSession, d: str) -> DataFrame:
    """All loading lines in the core schema, everything else in the rescue column."""
    return _ingested(spark, d)


@registry.query()
def p2_table(spark: SparkSession, d: str) -> DataFrame:
    """All loading lines in one consistent table after promotion and replay."""
    return drift.promote_lines(_ingested(spark, d))


_NUMERIC = ["depth", "qc", "fs", "u", "inclination", "speed", "temperature"]


@registry.query(f"""WITH {_KINDS},
  lay AS (SELECT file_path, quantity, min(i) AS i FROM (SELECT file_path, col_index_in_line AS i, arg_min(search_term, received_at) AS search_term FROM searchforcolresults
    WHERE col_index_in_line >= 0 GROUP BY file_path, col_index_in_line) JOIN searchterm USING (search_term) GROUP BY file_path, quantity),
  held AS (SELECT p.line_id, quantity, c, trim(CASE d WHEN ';' THEN replace(c, ',', '.') ELSE c END, ' ') AS t FROM plain p JOIN lay l ON l.file_path = p.file_path AND l.i = p.i WHERE c <> ''),
  typed AS (SELECT *, CASE WHEN regexp_full_match(t, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?') THEN t::DOUBLE END AS num,
    CASE WHEN regexp_full_match(c, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN try_cast(c AS DATE) END AS day FROM held)
  SELECT v.line_id, {', '.join(f"max(num) FILTER (WHERE quantity = '{q}') AS {q}" for q in _NUMERIC)}, max(c) FILTER (WHERE quantity = 'remark') AS remark,
    (max(day) FILTER (WHERE quantity = 'logged_on'))::VARCHAR AS logged_on FROM verdict v LEFT JOIN typed USING (line_id) WHERE reason IS NULL GROUP BY v.line_id""")
def p2_values(spark: SparkSession, d: str) -> DataFrame:
    """The typed columns of the one consistent table."""
    return p2_table(spark, d).select("line_id", *_NUMERIC, "remark", F.col("logged_on").cast("string").alias("logged_on"))


# ---------------------------------------------------------------- 3: quantities recorded in different units

_CODES = "(" + ", ".join(map(str, units.MISSING_CODES)) + ")"


def _shares(column: str, *limits: float) -> str:
    value = f"abs({column})"
    ok = f"filter(WHERE {column} NOT IN {_CODES}"
    return ", ".join([f"count({column}) {ok}) AS n_{column}", *[f"count(*) {ok} AND {value} > {x}) AS {column}_{i}" for i, x in enumerate(limits)]])


_UNITS = rf"""
share AS (SELECT cpt_id, {_shares("depth", 31, 105, 3100)}, {_shares("qc", 70, 770)}, {_shares("fs", 0.8, 8.8)},
  {_shares("u2", 0.8, 8.8)} FROM cptmeasurements GROUP BY cpt_id),
head AS (SELECT DISTINCT file_path, quantity, lower(matched_string) AS h FROM searchforcolresults JOIN searchterm USING (search_term)),
said AS (SELECT file_path, quantity, CASE WHEN regexp_matches(h, '[^a-z]bars?[^a-z]*$') THEN 'bar'
  WHEN regexp_matches(h, '(tsf|ton/ft2)[^a-z]*$') THEN 'tsf' WHEN regexp_matches(h, 'kgf?/cm[2²][^a-z]*$') THEN 'kgf_cm2'
  WHEN regexp_matches(h, '[^a-z](ft|feet|foot)[^a-z]*$') THEN 'ft' END AS unit FROM head),
cpt AS (SELECT DISTINCT cpt_id, source_file FROM cptreport),
one AS (SELECT s.*, d.unit AS sd, q.unit AS sq, f.unit AS sf, u.unit AS su FROM share s LEFT JOIN cpt USING (cpt_id)
  LEFT JOIN said d ON d.file_path = source_file AND d.quantity = 'depth' LEFT JOIN said q ON q.file_path = source_file AND q.quantity = 'qc'
  LEFT JOIN said f ON f.file_path = source_file AND f.quantity = 'fs' LEFT JOIN said u ON u.file_path = source_file AND u.quantity = 'u'),
long AS (
  SELECT cpt_id, 'depth' AS quantity, CASE WHEN n_depth = 0 THEN NULL WHEN depth_2 >= 0.1 * n_depth THEN 'mm' WHEN depth_1 >= 0.5 * n_depth THEN 'cm'
    WHEN sd = 'ft' OR depth_0 >= 0.5 * n_depth THEN 'ft' END AS unit FROM one
  UNION ALL SELECT cpt_id, 'qc', CASE WHEN n_qc = 0 THEN NULL WHEN sq IS NOT NULL AND qc_1 < 0.5 * n_qc THEN sq WHEN qc_0 >= 0.5 * n_qc THEN 'kpa' END FROM one
  UNION ALL SELECT cpt_id, 'fs', CASE WHEN n_fs = 0 THEN NULL WHEN sf IS NOT NULL AND fs_1 < 0.5 * n_fs THEN sf WHEN fs_0 >= 0.5 * n_fs THEN 'kpa' END FROM one
  UNION ALL SELECT cpt_id, 'u', CASE WHEN n_u2 = 0 THEN NULL WHEN su IS NOT NULL AND u2_1 < 0.5 * n_u2 THEN su WHEN u2_0 >= 0.5 * n_u2 THEN 'kpa' END FROM one),
level AS (SELECT DISTINCT value_id, abs(ground_water_level) AS v, regexp_replace(lower(ground_water_level_note),
  '(?:collar|casing)\s+[0-9.]+\s*[a-z]+|[0-9.]+\s*[a-z]+\s*(?:pipe|tube|cap|up)\b', ' ', 'g') AS n FROM extractedsinglevalues WHERE ground_water_level IS NOT NULL),
num AS (SELECT value_id, v, unnest(regexp_extract_all(n, '([0-9]+(?:[.][0-9]+)?)\s*[a-z]+')) AS t FROM level),
own AS (SELECT value_id, min(regexp_extract(t, '[a-z]+')) AS t FROM num WHERE regexp_extract(t, '^[0-9.]+')::DOUBLE = v
  AND regexp_matches(t, '[0-9]\s*(m|metres?|mtr|cm|centimetres?|mm|millimetres?|ft|feet)$') GROUP BY value_id),
bare AS (SELECT value_id, regexp_extract(n, '(?:\bin|[\[(])\s*(m|metres?|mtr|cm|centimetres?|mm|millimetres?|ft|feet)(?:[^a-z]|$)', 1) AS t FROM level),
lu AS (SELECT value_id, coalesce(own.t, nullif(bare.t, '')) AS t FROM bare LEFT JOIN own USING (value_id))
"""


def _sounding_units(spark: SparkSession, d: str) -> DataFrame:
    names = ("cptreport", "cptmeasurements", "searchforcolresults", "searchterm")
    return units.sounding_units(spark, *[table(spark, d, n) for n in names])


@registry.query(rf"""WITH {_UNITS}
  SELECT 'cptreport' AS record_kind, cpt_id AS record_id, quantity, unit AS recorded_unit FROM long WHERE unit IS NOT NULL
  UNION ALL SELECT 'extractedsinglevalues', value_id, 'ground_water_level', CASE WHEN t LIKE 'c%' THEN 'cm' WHEN t LIKE 'f%' THEN 'ft' ELSE 'mm' END
    FROM lu WHERE t NOT IN ('m', 'metre', 'metres', 'mtr')
  UNION ALL SELECT DISTINCT 'extractedsinglevalues', value_id, 'tip_net_area_ratio', 'percent' FROM extractedsinglevalues WHERE tip_net_area_ratio > 1.5""")
def p3_found(spark: SparkSession, d: str) -> DataFrame:
    values = table(spark, d, "extractedsinglevalues")
    return units.foreign_units(_sounding_units(spark, d), units.level_units(spark, values), units.ratio_units(values))


_SAID_ALL = r"""
every AS (SELECT file_path, quantity, CASE WHEN regexp_matches(h, '[^a-z](kpa|kn/m[2²]|kilopascals?)[^a-z]*$') THEN 'kpa'
  WHEN regexp_matches(h, '[^a-z](mpa|mn/m[2²]|n/mm[2²]|megapascals?)[^a-z]*$') THEN 'mpa' WHEN regexp_matches(h, '[^a-z]bars?[^a-z]*$') THEN 'bar'
  WHEN regexp_matches(h, '(tsf|ton/ft[2²]|tons/ft[2²]|t/ft[2²])[^a-z]*$') THEN 'tsf' WHEN regexp_matches(h, 'kgf?/cm\^?[2²][^a-z]*$') THEN 'kgf_cm2'
  WHEN regexp_matches(h, '[^a-z](ft|feet|foot)[^a-z]*$') THEN 'ft' WHEN regexp_matches(h, '[^a-z](cm|centimet(re|er)s?)[^a-z]*$') THEN 'cm'
  WHEN regexp_matches(h, '[^a-z](mm|millimet(re|er)s?)[^a-z]*$') THEN 'mm' WHEN regexp_matches(h, '[^a-z](m|met(re|er)s?|mtrs?)[^a-z]*$') THEN 'm' END AS unit FROM head),
ask AS (SELECT s.*, q.quantity AS q, e.unit AS said FROM share s LEFT JOIN cpt USING (cpt_id)
  CROSS JOIN (VALUES ('depth'), ('qc'), ('fs'), ('u')) q(quantity) LEFT JOIN every e ON e.file_path = source_file AND e.quantity = q.quantity),
seen AS (SELECT q, said, CASE q WHEN 'depth' THEN n_depth WHEN 'qc' THEN n_qc WHEN 'fs' THEN n_fs ELSE n_u2 END AS n,
  CASE q WHEN 'depth' THEN 0 WHEN 'qc' THEN qc_1 WHEN 'fs' THEN fs_1 ELSE u2_1 END AS far,
  CASE WHEN q = 'depth' THEN CASE WHEN depth_2 >= 0.1 * n_depth THEN 'mm' WHEN depth_1 >= 0.5 * n_depth THEN 'cm' WHEN depth_0 >= 0.5 * n_depth THEN 'ft' ELSE 'm' END
    WHEN (q = 'qc' AND qc_0 >= 0.5 * n_qc) OR (q = 'fs' AND fs_0 >= 0.5 * n_fs) OR (q = 'u' AND u2_0 >= 0.5 * n_u2) THEN 'kpa' ELSE 'mpa' END AS shown FROM ask),
settled AS (SELECT *, coalesce(said = shown OR (said = 'ft' AND shown = 'm') OR (said IN ('bar', 'tsf', 'kgf_cm2') AND q <> 'depth' AND far < 0.5 * n), false) AS holds FROM seen WHERE n > 0)
"""


@registry.query(f"""WITH {_UNITS}, {_SAID_ALL}
  SELECT q AS quantity, CASE WHEN holds THEN said ELSE shown END AS recorded_unit, CASE WHEN holds THEN 'header' WHEN said IS NOT NULL THEN 'values against the header'
    WHEN shown IN ('m', 'mpa') THEN 'default' ELSE 'values' END AS basis, count(*) AS n FROM settled GROUP BY ALL""")
def p3_basis(spark: SparkSession, d: str) -> DataFrame:
    """How many soundings have each unit by header, by values, by values against the header, or by default."""
    return units.unit_basis(_sounding_units(spark, d))


_FACTOR = "CASE {u} " + " ".join(f"WHEN '{u}' THEN {f}::DOUBLE" for u, f in units.FACTORS.items()) + " END"


def _common(column: str, quantity: str, common: str) -> str:
    unit = f"max(CASE WHEN quantity = '{quantity}' THEN coalesce(unit, '{common}') END)"
    return f"{_FACTOR.format(u=unit)} AS f_{column}"


@registry.query(rf"""WITH {_UNITS}, f AS (SELECT cpt_id, {_common('depth', 'depth', 'm')}, {_common('qc', 'qc', 'mpa')}, {_common('fs', 'fs', 'mpa')}, {_common('u2', 'u', 'mpa')} FROM long GROUP BY cpt_id)
  SELECT measurement_id, cpt_id, abs(CASE WHEN depth NOT IN {_CODES} THEN depth * f_depth END) AS depth, {', '.join(f"CASE WHEN {c} NOT IN {_CODES} THEN {c} * f_{c} END AS {c}" for c in ('qc', 'fs', 'u2'))}
  FROM cptmeasurements LEFT JOIN f USING (cpt_id)""")
def p3_measurements(spark: SparkSession, d: str) -> DataFrame:
    """Every measurement in m and MPa."""
    return units.convert_soundings(table(spark, d, "cptmeasurements"), _sounding_units(spark, d))


# ---------------------------------------------------------------- 5: points near other points or regions

WINDOW = (165.0, -48.0, 179.0, -33.0)
NEAR_M = 30.0

_PLACES = r"""
place AS (SELECT DISTINCT nzgd_id, latitude AS lat, longitude AS lon, floor(latitude * 2000)::BIGINT AS i, floor(longitude * 2000)::BIGINT AS j
  FROM nzgdrecord WHERE latitude BETWEEN -48 AND -33 AND longitude BETWEEN 165 AND 179),
around AS (SELECT p.*, i + a.d AS bi, j + b.d AS bj FROM place p, (VALUES (-1), (0), (1)) a(d), (VALUES (-1), (0), (1)) b(d)),
near AS (SELECT DISTINCT least(p.nzgd_id, q.nzgd_id) AS a, greatest(p.nzgd_id, q.nzgd_id) AS b FROM around p JOIN place q
  ON q.i = p.bi AND q.j = p.bj AND p.nzgd_id <> q.nzgd_id
  WHERE 2 * 6371008.8 * asin(sqrt(least(1, power(sin(radians(q.lat - p.lat) / 2), 2)
    + cos(radians(p.lat)) * cos(radians(q.lat)) * power(sin(radians(q.lon - p.lon) / 2), 2)))) <= 30),
ring AS (SELECT district_id, unnest(regexp_extract_all(area_wkt, '[(]([^()]+)[)]', 1)) AS r FROM districtarea),
pts AS (SELECT district_id, row_number() OVER () AS ring_id, string_split(r, ',') AS p FROM ring),
vertex AS (SELECT district_id, ring_id, generate_subscripts(p, 1) AS k, trim(unnest(p)) AS v, len(p) AS n FROM pts),
corner AS (SELECT district_id, ring_id, k, n, string_split(v, ' ')[1]::DOUBLE AS x, string_split(v, ' ')[2]::DOUBLE AS y FROM vertex),
edge AS (SELECT a.district_id, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2 FROM corner a JOIN corner b
  ON a.ring_id = b.ring_id AND b.k = a.k % a.n + 1 WHERE a.y <> b.y),
hit AS (SELECT p.nzgd_id, p.lat, p.lon, e.district_id FROM place p JOIN edge e ON (e.y1 > p.lat) <> (e.y2 > p.lat)
  AND p.lon < (e.x2 - e.x1) * (p.lat - e.y1) / (e.y2 - e.y1) + e.x1 GROUP BY ALL HAVING count(*) % 2 = 1),
wrong AS (SELECT DISTINCT h.nzgd_id, h.district_id FROM hit h JOIN nzgdrecord r ON r.nzgd_id = h.nzgd_id AND r.latitude = h.lat
  AND r.longitude = h.lon WHERE r.district_id IS NULL OR r.district_id <> h.district_id)
"""


@registry.query(f"""WITH {_PLACES} SELECT 'near' AS case_kind, a::BIGINT AS id_a, b::BIGINT AS id_b FROM near
  UNION ALL SELECT 'district', nzgd_id, district_id FROM wrong""")
def p5_found(spark: SparkSession, d: str) -> DataFrame:
    records = table(spark, d, "nzgdrecord")
    positions = spatial.usable_positions(records, WINDOW)
    near = spatial.near_records(positions, WINDOW, NEAR_M).select(
        F.lit("near").alias("case_kind"), F.col("id_a").cast("long"), F.col("id_b").cast("long")
    )
    areas = table(spark, d, "districtarea").select(F.col("district_id").alias("region"), F.col("area_wkt").alias("wkt"))
    found = spatial.misplaced(records, positions, spatial.containing_regions(positions, areas, WINDOW))
    district = found.select(F.lit("district").alias("case_kind"), F.col("nzgd_id").cast("long").alias("id_a"), F.col("region").cast("long").alias("id_b"))
    return near.unionByName(district)


@registry.query(f"""WITH {_PLACES}, site AS (SELECT lon, lat, count(DISTINCT nzgd_id) AS n_records FROM place GROUP BY ALL),
  cell AS (SELECT *, floor(lat * 2000)::BIGINT AS i, floor(lon * 2000)::BIGINT AS j FROM site),
  grown AS (SELECT c.*, i + a.d AS bi, j + b.d AS bj FROM cell c, (VALUES (-1), (0), (1)) a(d), (VALUES (-1), (0), (1)) b(d))
  SELECT p.lon, p.lat, p.n_records, sum(q.n_records)::BIGINT AS n_near FROM grown p JOIN cell q ON q.i = p.bi AND q.j = p.bj
  WHERE 2 * 6371008.8 * asin(sqrt(least(1, power(sin(radians(q.lat - p.lat) / 2), 2)
    + cos(radians(p.lat)) * cos(radians(q.lat)) * power(sin(radians(q.lon - p.lon) / 2), 2)))) <= 30 GROUP BY ALL""")
def p5_neighbour_counts(spark: SparkSession, d: str) -> DataFrame:
    """Per site the number of its records and of the records within reach, without writing pairs."""
    positions = spatial.usable_positions(table(spark, d, "nzgdrecord"), WINDOW)
    return spatial.near_counts(positions, WINDOW, NEAR_M).drop("site")
