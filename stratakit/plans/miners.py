"""Queries of the scalar and text miners."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratakit import constants as K
from stratakit.functions import text as X
from stratakit.operators import mining as M
from stratakit.operators import sheets as S
from stratakit.plans.grids import _CELL, _HIT, _lines
from stratakit.plans.registry import Registry
from stratakit.session import cut, table

registry = Registry()

_NUM = r"-?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?"
_NOTE = "v AS (SELECT DISTINCT value_id, ground_water_level_note AS n FROM extractedsinglevalues WHERE ground_water_level_note IS NOT NULL)"


def _notes(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "extractedsinglevalues").select("value_id", F.col("ground_water_level_note").alias("n"))
    return rows.where("n is not null").distinct()


@registry.query(rf"""WITH {_NOTE} SELECT value_id, abs(try_cast(regexp_extract(n, '{_NUM}') AS DOUBLE)) AS plain,
  abs(CASE WHEN regexp_matches(regexp_extract(n, '{_NUM}\s*[cC]?[mM]?'), '[cC][mM]$') THEN try_cast(regexp_extract(n, '{_NUM}') AS DOUBLE) / 100.0::DOUBLE
    ELSE try_cast(regexp_extract(n, '{_NUM}') AS DOUBLE) END) AS metres FROM v""")
def numeric_value(spark: SparkSession, d: str) -> DataFrame:
    """2.10: the first number of a note, and the same after a "cm" check."""
    n = F.col("n")
    return _notes(spark, d).select("value_id", X.numeric_value(n).alias("plain"), X.numeric_value(n, check_cm=True).alias("metres"))


@registry.query(rf"""WITH t AS (SELECT doc_id, unnest(regexp_extract_all(text, '{_NUM}')) AS number FROM documents)
  SELECT doc_id, number, count(*) AS n FROM t GROUP BY ALL""")
def numbers_in_text(spark: SparkSession, d: str) -> DataFrame:
    """Every number in every text."""
    docs = table(spark, d, "documents")
    return docs.select("doc_id", F.explode(X.numbers_in(F.col("text"))).alias("number")).groupBy("doc_id", "number").agg(F.count("*").alias("n"))


@registry.query(r"""WITH p AS (SELECT doc_id, instr(lower(text), 'water') - 1 AS pos, text FROM documents WHERE contains(lower(text), 'water')),
  s AS (SELECT doc_id, pos, string_split_regex(text, '\d+\.?\d*') AS gap, regexp_extract_all(text, '\d+\.?\d*') AS tok FROM p),
  k AS (SELECT doc_id, pos, tok[i] AS token, (list_sum([length(g) for g in gap[1:i]]) + coalesce(list_sum([length(t) for t in tok[1:i - 1]]), 0))::BIGINT AS start
    FROM (SELECT *, unnest(generate_series(1, len(tok))) AS i FROM s))
  SELECT doc_id, arg_min(token, (abs(start - pos), start)) AS token FROM k GROUP BY doc_id""")
def number_nearest_keyword(spark: SparkSession, d: str) -> DataFrame:
    """2.10, M5: the digits nearest to the word "water" in every text that has it."""
    docs = table(spark, d, "documents").where(F.lower("text").contains("water"))
    at = F.instr(F.lower("text"), "water") - 1
    return docs.select("doc_id", X.closest_digits(F.col("text"), at).alias("token")).where("token is not null")


@registry.query(f"""WITH {_NOTE} SELECT value_id, CASE WHEN contains(lower(n), 'collapse') OR contains(lower(n), 'collapase') THEN 'collapsed' WHEN contains(lower(n), 'estimate') THEN 'estimated'
  WHEN contains(lower(n), 'assume') THEN 'assumed' WHEN contains(lower(n), 'derive') AND NOT contains(lower(n), 'not') THEN 'derived' WHEN contains(lower(n), 'dip') THEN 'dipper'
  WHEN contains(lower(n), 'measure') AND NOT contains(lower(n), 'not') THEN 'measured' END AS method FROM v""")
def method_flag_case(spark: SparkSession, d: str) -> DataFrame:
    """2.10: how each level was found."""
    return _notes(spark, d).select("value_id", X.level_method(F.col("n")).alias("method"))


_REFUSED = ", ".join("'" + w.lower() + "'" for w in [*K.REFUSED, K.MAX_THRUST, *K.TARGET_MISSED])
_REACHED = ", ".join("'" + w.lower() + "'" for w in K.TARGET_REACHED)


@registry.query(f"""WITH v AS (SELECT nzgd_id, lower(termination_reason) AS t FROM extractedsinglevalues WHERE nzgd_id IS NOT NULL),
  c AS (SELECT nzgd_id, CASE WHEN t IN ({_REFUSED}) OR contains(t, 'refus') THEN 'refusal' WHEN t IN ({_REACHED}) OR contains(t, 'target') OR contains(t, 'reached') THEN 'target_depth' END AS r FROM v)
  SELECT nzgd_id, CASE WHEN bool_or(r = 'refusal') THEN 'refusal' ELSE max(r) END AS reason FROM c GROUP BY nzgd_id""")
def termination_priority(spark: SparkSession, d: str) -> DataFrame:
    """One ending per record, refusal first."""
    rows = table(spark, d, "extractedsinglevalues").where("nzgd_id is not null").select("nzgd_id", M.classify_ending(F.col("termination_reason")).alias("reason"))
    return M.prior_ending(rows, "nzgd_id", "reason")


@registry.query("""SELECT DISTINCT value_id, CASE WHEN abs(ground_water_level) BETWEEN 0 AND 40 THEN abs(ground_water_level) END AS level,
  CASE WHEN tip_net_area_ratio BETWEEN 0.2 AND 1.0 THEN tip_net_area_ratio END AS ratio FROM extractedsinglevalues""")
def value_ranges(spark: SparkSession, d: str) -> DataFrame:
    """Levels and ratios inside their accepted ranges."""
    level, ratio = F.abs("ground_water_level"), F.col("tip_net_area_ratio")
    return table(spark, d, "extractedsinglevalues").select(
        "value_id", F.when(level.between(*K.GWL_RANGE), level).alias("level"), F.when(ratio.between(*K.RATIO_RANGE), ratio).alias("ratio")
    ).distinct()


def _text_lines(spark: SparkSession, d: str) -> DataFrame:
    """Texts as grids: a line per line of text, a cell per tab-separated part."""
    docs = table(spark, d, "documents").where("text is not null")
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("row", "line"))
    return lines.select("doc_id", "row", F.transform(F.split("line", "\t"), lambda x: F.when(F.trim(x) != "", F.trim(x))).alias("cells"))


_TERMS = ", ".join("('" + t + "')" for t in K.TERM_QUANTITY)
_TEXT_CELLS = r"""l AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
r AS (SELECT doc_id, (generate_subscripts(ls, 1) - 1)::INT AS row, string_split(unnest(ls), chr(9)) AS cs FROM l),
c AS (SELECT * FROM (SELECT doc_id, row, (generate_subscripts(cs, 1) - 1)::INT AS col, trim(unnest(cs), ' ') AS raw FROM r) WHERE raw <> '')"""


@registry.query(rf"""WITH {_TEXT_CELLS}, t(term) AS (VALUES {_TERMS}) SELECT doc_id, row, col, term FROM c, t WHERE contains(lower(raw), term)
  AND regexp_matches(lower(raw), '(?:^|\s)' || term || '(?:\s|$|:|=|\()') AND NOT (term = 'a factor' AND regexp_matches(lower(raw), 'alpha factor|beta factor'))""")
def term_cross_match(spark: SparkSession, d: str) -> DataFrame:
    """Every search term in every cell of every text."""
    return M.term_matches(_text_lines(spark, d), "doc_id").select("doc_id", "row", "col", "term")


@registry.query(f"""WITH {_CELL}, h AS (SELECT file_path, row, col, raw FROM cell WHERE regexp_matches(lower(raw), 'tip|cone|qc')),
  p AS (SELECT h.file_path, h.row, h.col, arg_min(c.raw, c.col) FILTER (WHERE c.row = h.row AND c.col BETWEEN h.col + 1 AND h.col + 4) AS "right",
    arg_max(c.raw, c.col) FILTER (WHERE c.row = h.row AND c.col BETWEEN h.col - 4 AND h.col - 1) AS "left",
    arg_min(c.raw, c.row) FILTER (WHERE c.col = h.col AND c.row BETWEEN h.row + 1 AND h.row + 4) AS below,
    arg_max(c.raw, c.row) FILTER (WHERE c.col = h.col AND c.row BETWEEN h.row - 4 AND h.row - 1) AS above
    FROM h LEFT JOIN cell c ON c.file_path = h.file_path AND (c.row = h.row OR c.col = h.col) GROUP BY ALL) SELECT * FROM p""")
def neighbour_within_4(spark: SparkSession, d: str) -> DataFrame:
    """The nearest nonblank cells around each cell that names the cone."""
    lines = cut(_lines(spark, d))
    hits = lines.select("file_path", "row", F.posexplode("cells").alias("col", "raw"), "cells").where(F.lower("raw").rlike("tip|cone|qc"))
    return M.neighbours(hits, lines, "file_path").select("file_path", "row", "col", "right", "left", "below", "above")


@registry.query(f"""WITH {_CELL}, {_HIT}, f AS (SELECT file_path, row, count(DISTINCT parameter) AS n FROM hit WHERE NOT neg GROUP BY ALL)
  SELECT file_path, coalesce(min(row) FILTER (WHERE n = 4 AND row > 1), -1) AS header_row FROM (SELECT DISTINCT file_path FROM line) LEFT JOIN f USING (file_path) GROUP BY file_path""")
def first_header_line(spark: SparkSession, d: str) -> DataFrame:
    """The first line beyond the second that names all four parameters (-1: none)."""
    seen = S.candidates(_lines(spark, d))
    found = sum(((F.size(p) > 0).cast("int") for p in K.PARAMETERS), F.lit(0))
    return M.first_full_header(seen, "file_path", found).fillna(-1, ["header_row"])


@registry.query(f"""WITH {_CELL}, a AS (SELECT file_path, max(n) AS tall FROM (SELECT file_path, col, count(*) AS n FROM cell GROUP BY ALL) GROUP BY file_path),
  b AS (SELECT file_path, max(n) AS wide FROM (SELECT file_path, row, count(*) AS n FROM cell GROUP BY ALL) GROUP BY file_path)
  SELECT file_path, CASE WHEN tall > wide THEN 'columns' ELSE 'rows' END AS orientation FROM a JOIN b USING (file_path)""")
def sheet_orientation(spark: SparkSession, d: str) -> DataFrame:
    """Whether labels run down a column or along a row."""
    return M.orientation(_lines(spark, d), "file_path")


@registry.query()
def mined_scalars(spark: SparkSession, d: str) -> DataFrame:
    """M1-M5, M7: levels and ratios mined from the texts, one per text and quantity."""
    lines = cut(_text_lines(spark, d))
    hits = M.neighbours(M.term_matches(lines, "doc_id"), lines, "doc_id")
    return M.resolve_numbers(M.search_candidates(hits, M.orientation(lines, "doc_id"), "doc_id"), "doc_id")


_SOILS = ", ".join("'" + s + "'" for s in K.SOIL_TYPES)


@registry.query(rf"""WITH w AS (SELECT DISTINCT doc_id, trim(unnest(string_split_regex(text, '\s+')), ',.;') AS soil FROM documents) SELECT doc_id, soil FROM w WHERE soil IN ({_SOILS})""")
def keyword_intersection(spark: SparkSession, d: str) -> DataFrame:
    """2.10, U4, J3: the soils each text names."""
    return table(spark, d, "documents").select("doc_id", F.explode(X.soil_types(F.col("text"))).alias("soil"))


@registry.query(r"""SELECT doc_id, try_cast(nullif(regexp_extract(text, '\bNc?\s*(=|>)\s*(\d+)', 2), '') AS INTEGER) AS n FROM documents
  WHERE regexp_matches(text, '\bNc?\s*(=|>)\s*(\d+)')""")
def spt_values(spark: SparkSession, d: str) -> DataFrame:
    """2.10: the first penetration count of each text that has one."""
    return table(spark, d, "documents").where(F.col("text").rlike(K.SPT_VALUE)).select("doc_id", X.spt_value(F.col("text")).alias("n"))


@registry.query(r"""WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents), x AS (SELECT doc_id, unnest(ls) AS t FROM l),
  s AS (SELECT doc_id, t, try_cast(regexp_extract(t, '\bNc?\s*(=|>)\s*(\d+)', 2) AS INT) AS n, try_cast(regexp_extract(t, 'at (\d+\.\d+) m', 1) AS DOUBLE) AS depth FROM x WHERE regexp_matches(t, '\bNc?\s*(=|>)\s*(\d+)'))
  SELECT doc_id, n, depth, count(*) AS times FROM s WHERE depth IS NOT NULL GROUP BY ALL""")
def spt_by_depth(spark: SparkSession, d: str) -> DataFrame:
    """O3, SK4 input: penetration counts with the depth named in the same line."""
    lines = table(spark, d, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("t")).where(F.col("t").rlike(K.SPT_VALUE))
    depth = F.regexp_extract("t", r"at (\d+\.\d+) m", 1).try_cast("double")
    rows = lines.select("doc_id", X.spt_value(F.col("t")).alias("n"), depth.alias("depth")).where("depth is not null")
    return rows.groupBy("doc_id", "n", "depth").agg(F.count("*").alias("times"))


@registry.query()
def ratio_near_label(spark: SparkSession, d: str) -> DataFrame:
    """2.10: the percentage nearest to a ratio or efficiency label, per line of text."""
    lines = table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("row", "t")).where(F.col("t").rlike(K.RATIO_LABEL))
    return lines.select("doc_id", "row", X.percentage_near_label(F.col("t")).alias("percent")).where("percent is not null")
