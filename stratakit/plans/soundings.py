"""Queries over measured soundings: row hygiene, truncation, unit repair, duplicates.

Sheet stands for ``cpt_id``, order for ``measurement_id``; delivered repeats of a row count once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratakit import constants as K
from stratakit.functions.numbers import nearest_power_of_ten, real, round_to_quarter
from stratakit.operators import conditioning as C
from stratakit.operators import dedupe
from stratakit.plans.registry import Registry
from stratakit.session import salted_join, table

registry = Registry()

_PH = "(" + ", ".join(map(str, K.PLACEHOLDERS)) + ")"
_BASE = "m AS (SELECT DISTINCT * FROM cptmeasurements)"
_REAL = {c: f"CASE WHEN {c} NOT IN {_PH} THEN {c} END" for c in C.READINGS}
_STEP = f"""{_BASE},
d AS (SELECT cpt_id, measurement_id, min(abs({_REAL['depth']})) AS d FROM m WHERE ({_REAL['depth']}) IS NOT NULL GROUP BY ALL),
o AS (SELECT cpt_id, d, min(measurement_id) AS measurement_id FROM d GROUP BY ALL),
s1 AS (SELECT cpt_id, median(s) AS m FROM (SELECT cpt_id, round(d - lag(d) OVER (PARTITION BY cpt_id ORDER BY measurement_id), 6) AS s FROM d) GROUP BY cpt_id),
s2 AS (SELECT cpt_id, median(s) AS m2 FROM (SELECT cpt_id, round(d - lag(d) OVER (PARTITION BY cpt_id ORDER BY measurement_id), 6) AS s FROM o) GROUP BY cpt_id),
step AS (SELECT cpt_id, CASE WHEN m <> 0 THEN m WHEN m = 0 AND m2 <> 0 THEN m2 ELSE 1.0 END AS step
  FROM (SELECT DISTINCT cpt_id FROM m) LEFT JOIN s1 USING (cpt_id) LEFT JOIN s2 USING (cpt_id)),
pct AS (SELECT cpt_id, 100.0::DOUBLE * count(*) FILTER (WHERE r_d > 99 AND r_d < 999) / count(*) AS pct_cm, 100.0::DOUBLE * count(*) FILTER (WHERE r_d > 999) / count(*) AS pct_mm,
  100.0::DOUBLE * count(*) FILTER (WHERE r_q > 100) / count(*) AS pct_qc, 100.0::DOUBLE * count(*) FILTER (WHERE r_f > 10) / count(*) AS pct_fs,
  100.0::DOUBLE * count(*) FILTER (WHERE abs(r_u) > 5) / count(*) AS pct_u
  FROM (SELECT cpt_id, {_REAL['depth']} AS r_d, {_REAL['qc']} AS r_q, {_REAL['fs']} AS r_f, {_REAL['u2']} AS r_u FROM m) GROUP BY cpt_id)"""


def soundings(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "cptmeasurements").distinct()


@registry.query(f"WITH {_BASE} SELECT * FROM m WHERE (depth IS NOT NULL)::INT + (qc IS NOT NULL)::INT + (fs IS NOT NULL)::INT + (u2 IS NOT NULL)::INT >= 3")
def numeric_surplus_filter(spark: SparkSession, d: str) -> DataFrame:
    """V1: rows with three or more numbers."""
    return C.numeric_rows(soundings(spark, d))


@registry.query(f"WITH {_BASE} SELECT * FROM m WHERE coalesce(depth, 0) <> 0 OR coalesce(qc, 0) <> 0 OR coalesce(fs, 0) <> 0 OR coalesce(u2, 0) <> 0")
def nonzero_rows(spark: SparkSession, d: str) -> DataFrame:
    """V3: rows that are not all zero or null."""
    return C.nonzero_rows(soundings(spark, d))


@registry.query(f"""WITH {_BASE}, b AS (SELECT cpt_id, min(measurement_id) AS stop FROM m WHERE qc IS NULL OR qc IN {_PH} GROUP BY cpt_id)
  SELECT m.* FROM m LEFT JOIN b USING (cpt_id) WHERE stop IS NULL OR measurement_id < stop""")
def truncate_after_first_bad(spark: SparkSession, d: str) -> DataFrame:
    """The rows of each sheet before the first that is no data."""
    return C.truncate_after(soundings(spark, d), "cpt_id", "measurement_id", real(F.col("qc")).isNull())


@registry.query(f"WITH {_BASE} SELECT measurement_id, cpt_id, CASE WHEN depth IN {_PH} THEN depth ELSE abs(depth) END AS depth FROM m")
def positive_depth(spark: SparkSession, d: str) -> DataFrame:
    """Depths without sign, placeholders untouched."""
    return C.positive_depth(soundings(spark, d)).select("measurement_id", "cpt_id", "depth")


_NAMES = """
nm AS (SELECT file_path, min_by(matched_string, col_index_in_line) FILTER (WHERE quantity = 'depth') AS dn, min_by(matched_string, col_index_in_line) FILTER (WHERE quantity = 'qc') AS qn,
  min_by(matched_string, col_index_in_line) FILTER (WHERE quantity = 'fs') AS fn, min_by(matched_string, col_index_in_line) FILTER (WHERE quantity = 'u') AS un
  FROM searchforcolresults JOIN searchterm USING (search_term) GROUP BY file_path),
sheet AS (SELECT cpt_id, min(source_file) AS file_path FROM cptreport GROUP BY cpt_id),
n AS (SELECT cpt_id, dn, qn, fn, un FROM sheet JOIN nm USING (file_path))"""


def _explicit(c: str, name: str, word: str, by: str) -> str:
    return f"CASE WHEN contains(lower({name}), '{word}') AND {c} NOT IN {_PH} THEN {c} / {by} ELSE {c} END AS {c}"


def _names(spark: SparkSession, d: str) -> DataFrame:
    return C.names_by_sheet(*[table(spark, d, n) for n in ("cptreport", "searchforcolresults", "searchterm")])


@registry.query(f"""WITH {_BASE}, {_NAMES} SELECT measurement_id, cpt_id, {_explicit('depth', 'dn', 'cm', '100.0::DOUBLE')}, {_explicit('qc', 'qn', 'kpa', '1000.0::DOUBLE')},
  {_explicit('fs', 'fn', 'kpa', '1000.0::DOUBLE')}, {_explicit('u2', 'un', 'kpa', '1000.0::DOUBLE')},
  concat_ws('_AND_', CASE WHEN contains(lower(dn), 'cm') THEN dn || ' was converted from cm to m' END, CASE WHEN contains(lower(qn), 'kpa') THEN qn || ' was converted from kpa to MPa' END,
  CASE WHEN contains(lower(fn), 'kpa') THEN fn || ' was converted from kpa to MPa' END, CASE WHEN contains(lower(un), 'kpa') THEN un || ' was converted from kpa to MPa' END)
  AS explicit_unit_conversions FROM m LEFT JOIN n USING (cpt_id)""")
def explicit_units(spark: SparkSession, d: str) -> DataFrame:
    """Conversions that the column names ask for, with their log."""
    return C.explicit_conversions(soundings(spark, d), "cpt_id", _names(spark, d), "measurement_id")


@registry.query(f"WITH {_STEP} SELECT * FROM pct")
def unit_infer_pct(spark: SparkSession, d: str) -> DataFrame:
    """A3: shares of readings beyond the limits."""
    return C.shares_over(soundings(spark, d), "cpt_id")


@registry.query(f"WITH {_STEP} SELECT * FROM step")
def depth_step_median(spark: SparkSession, d: str) -> DataFrame:
    """Median depth step per sheet."""
    return C.depth_steps(soundings(spark, d), "cpt_id", "measurement_id")


def _infer(c: str, f: str) -> str:
    return f"CASE WHEN {f} IS NULL OR {c} IN {_PH} THEN {c} ELSE {c} * {f} END AS {c}"


_FACTORS = f"""{_STEP}, f AS (SELECT cpt_id, CASE WHEN pct_cm > 75 THEN 0.01::DOUBLE WHEN pct_mm > 75 THEN 0.001::DOUBLE WHEN step < 0.001::DOUBLE AND step <> 0
  THEN pow(10.0::DOUBLE, round_even(log10(abs(0.01::DOUBLE / step)), 0)) END AS fd, CASE WHEN pct_qc > 75 THEN 0.001::DOUBLE END AS fq,
  CASE WHEN pct_fs > 75 THEN 0.001::DOUBLE END AS ff, CASE WHEN pct_u > 75 THEN 0.001::DOUBLE END AS fu FROM pct JOIN step USING (cpt_id))"""


@registry.query(f"""WITH {_FACTORS} SELECT measurement_id, cpt_id, {_infer('depth', 'fd')}, {_infer('qc', 'fq')}, {_infer('fs', 'ff')}, {_infer('u2', 'fu')}
  FROM m JOIN f USING (cpt_id)""")
def inferred_units(spark: SparkSession, d: str) -> DataFrame:
    """Conversions that the values suggest."""
    out = C.inferred_conversions(soundings(spark, d), "cpt_id", "measurement_id")
    return out.select("measurement_id", "cpt_id", *C.READINGS)


@registry.query()
def conditioned_soundings(spark: SparkSession, d: str) -> DataFrame:
    """The whole conditioning of every sounding."""
    return C.condition(soundings(spark, d), "cpt_id", "measurement_id", _names(spark, d))


@registry.query(f"""WITH {_BASE} SELECT measurement_id, qc, CASE WHEN qc = 0 THEN 0.0::DOUBLE WHEN qc IS NOT NULL
  THEN pow(10.0::DOUBLE, round_even(log10(abs(nullif(qc, 0))), 0)) END AS p10 FROM m""")
def pow10_round(spark: SparkSession, d: str) -> DataFrame:
    """A10: nearest power of ten."""
    return soundings(spark, d).select("measurement_id", "qc", nearest_power_of_ten(F.col("qc")).alias("p10"))


@registry.query(f"WITH {_BASE} SELECT measurement_id, round_even(depth / 0.25::DOUBLE, 0) * 0.25::DOUBLE AS quarter FROM m")
def round_quarter(spark: SparkSession, d: str) -> DataFrame:
    """2.10: depths to the nearest quarter metre, half to even."""
    return soundings(spark, d).select("measurement_id", round_to_quarter(F.col("depth")).alias("quarter"))


@registry.query(f"""WITH {_BASE} SELECT cpt_id, round(regr_slope(qc, depth), 6) AS slope, round(regr_intercept(qc, depth), 4) AS intercept
  FROM m WHERE depth NOT IN {_PH} AND qc NOT IN {_PH} GROUP BY cpt_id HAVING max(depth) > min(depth) AND count(qc) > 2""")
def depth_trend_fit(spark: SparkSession, d: str) -> DataFrame:
    """Least-squares line of the cone resistance over depth, per sheet."""
    rows = soundings(spark, d).where(real(F.col("depth")).isNotNull() & real(F.col("qc")).isNotNull())
    fit = rows.groupBy("cpt_id").agg(
        F.round(F.regr_slope("qc", "depth"), 6).alias("slope"), F.round(F.regr_intercept("qc", "depth"), 4).alias("intercept"),
        F.min("depth").alias("lo"), F.max("depth").alias("hi"), F.count("qc").alias("n"),
    )
    return fit.where("hi > lo and n > 2").select("cpt_id", "slope", "intercept")


_SHEETS = f"""{_BASE}, own AS (SELECT cpt_id, min(nzgd_id) AS nzgd_id FROM cptreport GROUP BY cpt_id),
b AS (SELECT cpt_id, min(measurement_id) AS lo, max(measurement_id) AS hi FROM m GROUP BY cpt_id),
e AS (SELECT m.*, (hi - lo) // 3 AS third, lo, hi FROM m JOIN b USING (cpt_id)),
again AS (SELECT cpt_id, measurement_id, depth, qc, fs, u2 FROM m
  UNION ALL SELECT cpt_id + 1000000000, measurement_id, depth, qc, fs, u2 FROM e WHERE cpt_id % 3 = 0 OR cpt_id % 3 = 1 AND measurement_id < hi - third
    OR cpt_id % 3 = 2 AND measurement_id BETWEEN lo + third AND hi - third),
v AS (SELECT nzgd_id, again.cpt_id, measurement_id, coalesce(depth::VARCHAR, 'x') || '|' || coalesce(qc::VARCHAR, 'x') || '|' || coalesce(fs::VARCHAR, 'x') || '|' || coalesce(u2::VARCHAR, 'x') AS r
  FROM again JOIN own ON own.cpt_id = again.cpt_id % 1000000000 WHERE nzgd_id IS NOT NULL AND (coalesce(depth, 0) <> 0 OR coalesce(qc, 0) <> 0 OR coalesce(fs, 0) <> 0 OR coalesce(u2, 0) <> 0)),
a AS (SELECT nzgd_id, cpt_id, ';' || string_agg(r, ';' ORDER BY measurement_id) || ';' AS t, count(*) AS n FROM v GROUP BY ALL),
p AS (SELECT s.nzgd_id, s.cpt_id, l.cpt_id AS y, s.n AS nx, l.n AS ny FROM a s JOIN a l ON s.nzgd_id = l.nzgd_id AND s.cpt_id <> l.cpt_id
  AND (s.n < l.n OR s.n = l.n AND l.cpt_id < s.cpt_id) AND MEET)
SELECT nzgd_id, cpt_id, arg_min(y, (-ny, y)) AS kept_in FROM p GROUP BY ALL"""


def _contained(spark: SparkSession, d: str, mode: str) -> DataFrame:
    """Every sounding and, as further sheets of its record, each once more: whole, without its last third, or its middle third."""
    record = table(spark, d, "cptreport").where("cpt_id is not null").groupBy("cpt_id").agg(F.min("nzgd_id").alias("nzgd_id"))
    rows = soundings(spark, d)
    ends = rows.groupBy("cpt_id").agg(F.min("measurement_id").alias("lo"), F.max("measurement_id").alias("hi"), F.expr("(max(measurement_id) - min(measurement_id)) div 3").alias("third"))
    known = salted_join(rows, ends.join(record, "cpt_id"), ["cpt_id"], "inner", ["measurement_id"])
    kind, at = F.col("cpt_id") % 3, F.col("measurement_id")
    part = known.where((kind == 0) | ((kind == 1) & (at < F.col("hi") - F.col("third"))) | ((kind == 2) & at.between(F.col("lo") + F.col("third"), F.col("hi") - F.col("third"))))
    both = known.unionByName(part.withColumn("cpt_id", F.col("cpt_id") + 1_000_000_000)).drop("lo", "hi", "third")
    return dedupe.contained_sheets(both, "nzgd_id", "cpt_id", "measurement_id", mode)


@registry.query("WITH " + _SHEETS.replace("MEET", "s.t = l.t"))
def dedupe_exact(spark: SparkSession, d: str) -> DataFrame:
    """Sheets equal to an earlier sheet of their record."""
    return _contained(spark, d, "exact")


@registry.query("WITH " + _SHEETS.replace("MEET", "starts_with(l.t, s.t)"))
def dedupe_prefix(spark: SparkSession, d: str) -> DataFrame:
    """C5, observed form: sheets that another of their record begins with."""
    return _contained(spark, d, "prefix")


@registry.query("WITH " + _SHEETS.replace("MEET", "contains(l.t, s.t)"))
def dedupe_contiguous(spark: SparkSession, d: str) -> DataFrame:
    """C5, intended form: sheets that lie in another of their record."""
    return _contained(spark, d, "contiguous")
