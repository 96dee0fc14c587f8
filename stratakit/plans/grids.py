"""Queries over raw sheet lines: cells, header search, column candidates and choice."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratakit import constants as K
from stratakit.operators import sheets as S
from stratakit.plans.registry import Registry
from stratakit.session import cut, salted_join, table

registry = Registry()

_LINE = "line AS (SELECT DISTINCT file_path, line_no, extraction AS x FROM sheetextractionresult)"
_NUM = r"regexp_full_match(raw, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?')"
_DELIM = rf"""{_LINE},
c AS (SELECT file_path, sum(len(regexp_extract_all(x, ',')))::BIGINT AS comma, sum(len(regexp_extract_all(x, ';')))::BIGINT AS sem, sum(len(regexp_extract_all(x, '\t')))::BIGINT AS tab,
  sum(len(regexp_extract_all(x, '\s+')))::BIGINT AS blanks FROM line GROUP BY file_path),
delim AS (SELECT file_path, greatest(comma, sem, tab, blanks - tab) AS total, CASE WHEN greatest(comma, sem, tab, blanks - tab) <= 0 THEN NULL
  WHEN comma = greatest(comma, sem, tab, blanks - tab) THEN ',' WHEN sem = greatest(sem, tab, blanks - tab) THEN ';'
  WHEN tab = greatest(tab, blanks - tab) THEN chr(9) ELSE ' ' END AS delimiter FROM c)"""
_CELL = rf"""{_DELIM},
quoted AS (SELECT file_path, line_no, delimiter, CASE WHEN delimiter IN (',', ';') THEN array_to_string(list_transform(string_split_regex(x, '"[^"]*"|''[^'']*'''),
  lambda g, i: g || coalesce(replace(replace(q[i], delimiter, ''), '"', ''), '')), '') ELSE x END AS x
  FROM (SELECT *, regexp_extract_all(x, '"[^"]*"|''[^'']*''') AS q FROM line) JOIN delim USING (file_path)),
parts AS (SELECT file_path, line_no AS row, CASE WHEN delimiter = ' ' THEN string_split_regex(CASE WHEN regexp_matches(x, '^\s') THEN 'placeholder' ELSE '' END || x, '\s+')
  ELSE string_split(x, delimiter) END AS p FROM quoted),
cell AS (SELECT file_path, row, col, raw, CASE WHEN {_NUM} THEN raw::DOUBLE END AS num FROM (
  SELECT file_path, row, (generate_subscripts(p, 1) - 1)::INT AS col, trim(unnest(p), ' ') AS raw FROM parts) WHERE raw <> '')"""


def _any(name: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({name}, '{w}')" for w in words) + ")"


_HIT = "hit AS (" + " UNION ALL ".join(
    f"""SELECT file_path, row, {k} AS o, '{p}' AS parameter, col, lower(raw) AS name, {_any('lower(raw)', K.NEGATING[p])} AS neg FROM cell
  WHERE {_any('lower(raw)', K.PART_NAMES[p])} OR (lower(raw) IN ({', '.join(f"'{e}'" for e in K.EXACT_NAMES[p])})
    AND col = (SELECT min(c2.col) FROM cell c2 WHERE c2.file_path = cell.file_path AND c2.row = cell.row AND lower(c2.raw) = lower(cell.raw)))"""
    for k, p in enumerate(K.PARAMETERS)
) + ")"
_COUNT = f"""cnt AS (SELECT file_path, row, count(*) FILTER (WHERE num IS NOT NULL AND NOT contains(lower(raw), 'nan')) AS nn,
  count(*) FILTER (WHERE num IS NULL AND NOT contains(lower(raw), 'nan')) AS nt FROM cell GROUP BY ALL),
counted AS (SELECT file_path, row, coalesce(nn, 0) AS nn, coalesce(nt, 0) AS nt FROM (SELECT DISTINCT file_path, line_no AS row FROM quoted) LEFT JOIN cnt USING (file_path, row))"""
_HEADER = f"""{_CELL}, {_HIT}, {_COUNT},
found AS (SELECT file_path, row, count(DISTINCT parameter) AS found FROM hit WHERE NOT neg GROUP BY ALL),
fact AS (SELECT file_path, arg_min(row, (nn - nt, row)) AS start, min(row) AS low, max(row) AS high FROM counted GROUP BY file_path),
ring AS (SELECT file_path, row, found, ((row - start) % greatest(high - low, 1) + greatest(high - low, 1)) % greatest(high - low, 1) AS turn FROM found JOIN fact USING (file_path) WHERE row < high),
head AS (SELECT file_path, r.row AS header_row, coalesce(r.found, 0)::INT AS n_found, (high - low + 1)::INT AS n_lines FROM fact
  LEFT JOIN (SELECT file_path, arg_min(row, (-found, turn, row)) AS row, arg_min(found, (-found, turn, row)) AS found FROM ring GROUP BY file_path) r USING (file_path)),
own AS (SELECT file_path, header_row, nt AS texts, low, high FROM head JOIN fact USING (file_path) JOIN counted c USING (file_path) WHERE c.row = header_row),
span AS (SELECT o.file_path, o.header_row, coalesce(max(c.row) FILTER (WHERE c.row < header_row AND nt <> texts) + 1, min(low)) AS "first",
  greatest(o.header_row, least(coalesce(min(c.row) FILTER (WHERE c.row > header_row AND nt <= nn) - 1, max(high)), max(high) - 1)) AS "last"
  FROM own o JOIN counted c ON c.file_path = o.file_path GROUP BY o.file_path, o.header_row)"""
_CHOSEN = f"""{_HEADER},
name AS (SELECT c.file_path, col, lower(string_agg(raw, '_' ORDER BY row)) AS name FROM cell c JOIN span s USING (file_path) WHERE row BETWEEN "first" AND "last" GROUP BY ALL),
body AS (SELECT c.* FROM cell c JOIN span s USING (file_path) WHERE row > "last"),
lines AS (SELECT file_path, row, p FROM parts JOIN span USING (file_path) WHERE row > "last"),
full_cell AS (SELECT file_path, row, (generate_subscripts(p, 1) - 1)::INT AS col, nullif(trim(unnest(p), ' '), '') AS raw FROM lines),
steps AS (SELECT file_path, col, num >= lag(num) OVER (PARTITION BY file_path, col ORDER BY row) AS up FROM body WHERE num IS NOT NULL),
rising AS (SELECT file_path, col, bool_and(coalesce(up, true)) AS rising FROM steps GROUP BY ALL),
facts AS (SELECT f.file_path, f.col, count(*) FILTER (WHERE raw IS NOT NULL AND {_NUM}) AS n_numbers,
  bool_and(coalesce(regexp_full_match(raw, '[+-]?[0-9]+'), false)) AND coalesce(any_value(rising), false) AS index_like FROM full_cell f LEFT JOIN rising USING (file_path, col) GROUP BY ALL),
opt AS (""" + " UNION ALL ".join(
    f"""SELECT file_path, col, name, '{p}' AS parameter, {k} AS o FROM name WHERE NOT {_any('name', K.NEGATING[p])} AND ({_any('name', K.PART_NAMES[p])}
    OR (name IN ({', '.join(f"'{e}'" for e in K.EXACT_NAMES[p])}) AND col = (SELECT min(n2.col) FROM name n2 WHERE n2.file_path = name.file_path AND n2.name = name.name)))"""
    for k, p in enumerate(K.PARAMETERS)
) + """),
one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY file_path, parameter, name ORDER BY n_numbers DESC, col) AS k FROM opt JOIN facts USING (file_path, col))
  WHERE k = 1 AND n_numbers > 3 AND NOT index_like),
free AS (SELECT * FROM (SELECT *, min(o) OVER (PARTITION BY file_path, name) AS claim FROM one) WHERE o = claim),
chosen AS (SELECT file_path, parameter, min(col) AS col, arg_min(name, col) AS name FROM free GROUP BY ALL)"""


def _lines(spark: SparkSession, d: str) -> DataFrame:
    """(file_path, row, cells) of all delivered lines, cut at each file's own delimiter."""
    raw = table(spark, d, "sheetextractionresult").select("file_path", F.col("line_no").alias("row"), "extraction").distinct()
    known = raw.join(S.delimiter_counts(raw, "file_path", "extraction"), "file_path").where("delimiter is not null")
    clean = F.when(F.col("delimiter").isin(",", ";"), S.without_quoted_delimiters(F.col("extraction"), F.col("delimiter"))).otherwise(F.col("extraction"))
    return known.select("file_path", "row", S.split_cells(clean, F.col("delimiter")).alias("cells"))


@registry.query(f"WITH {_DELIM} SELECT * FROM delim")
def delimiter_argmax(spark: SparkSession, d: str) -> DataFrame:
    """SC6, O6: the delimiter of each file."""
    raw = table(spark, d, "sheetextractionresult").select("file_path", "line_no", "extraction").distinct()
    return S.delimiter_counts(raw, "file_path", "extraction").select("file_path", "total", "delimiter")


@registry.query(f"WITH {_CELL} SELECT * FROM cell")
def lines_cells(spark: SparkSession, d: str) -> DataFrame:
    """SC7, SC8: every nonblank cell with its number."""
    return S.explode_cells(_lines(spark, d), "file_path")


@registry.query(f"""WITH {_CELL} SELECT file_path, coalesce(row, -1) AS row, coalesce(col, -1) AS col, count(num) AS n_numbers, count(num) - (count(*) - count(num)) AS surplus
  FROM cell GROUP BY GROUPING SETS ((file_path, row), (file_path, col), (file_path))""")
def type_profile_grouping_sets(spark: SparkSession, d: str) -> DataFrame:
    """A1: numbers and texts per line, column and sheet (-1 stands for all)."""
    return S.cell_profile(S.explode_cells(_lines(spark, d), "file_path"), "file_path").fillna(-1, ["row", "col"])


@registry.query(f"WITH {_CELL}, {_COUNT} SELECT file_path, row, nn::INT AS n_number, nt::INT AS n_text FROM counted")
def text_numeric_per_line(spark: SparkSession, d: str) -> DataFrame:
    """A2: texts and numbers per line."""
    return S.line_counts(_lines(spark, d)).select("file_path", "row", "n_number", "n_text")


def _flat(lines: DataFrame) -> DataFrame:
    arrays = F.concat(*[F.transform(p, _tagged(p)) for p in K.PARAMETERS])
    return lines.select("file_path", "row", F.inline(arrays))


def _tagged(p: str):
    return lambda c: F.struct(F.lit(p).alias("parameter"), c["col"].alias("col"), c["name"].alias("name"))


@registry.query(f"WITH {_CELL}, {_HIT} SELECT file_path, row, parameter, col, name FROM hit WHERE NOT neg")
def header_candidates(spark: SparkSession, d: str) -> DataFrame:
    """PR1-PR6: cells that may name a parameter."""
    return _flat(S.candidates(_lines(spark, d)))


@registry.query(f"""WITH {_CELL}, {_HIT} SELECT file_path, row, parameter, col, name FROM (SELECT *, bool_or(neg) OVER (PARTITION BY file_path, row, parameter ORDER BY col) AS off FROM hit) WHERE NOT off""")
def takewhile_negated(spark: SparkSession, d: str) -> DataFrame:
    """PR5, observed form: candidates up to the first negated one."""
    return _flat(S.candidates(_lines(spark, d), sticky=True))


@registry.query(f"""WITH {_CELL}, {_HIT} SELECT file_path, row, parameter, col, name FROM hit h WHERE NOT neg AND NOT EXISTS (
  SELECT 1 FROM hit e WHERE e.file_path = h.file_path AND e.row = h.row AND e.name = h.name AND NOT e.neg AND e.o < h.o)""")
def column_greedy_claim(spark: SparkSession, d: str) -> DataFrame:
    """PR7: candidates after names were claimed in the order of the parameters."""
    return _flat(S.claimed(S.candidates(_lines(spark, d))))


@registry.query(f"WITH {_HEADER} SELECT file_path, header_row, n_found, n_lines FROM head")
def header_detect(spark: SparkSession, d: str) -> DataFrame:
    """The header line of each sheet."""
    return S.header_rows(S.line_facts(_lines(spark, d), "file_path"), "file_path")


@registry.query(f'WITH {_HEADER} SELECT file_path, header_row, "first", "last" FROM span')
def header_span(spark: SparkSession, d: str) -> DataFrame:
    """The lines that belong to the header."""
    facts = S.line_facts(_lines(spark, d), "file_path")
    return S.header_spans(facts, S.header_rows(facts, "file_path"), "file_path")


@registry.query(f"""WITH {_CHOSEN} SELECT file_path, col, name, CASE WHEN k > 1 THEN name || '_' || k ELSE name END AS unique_name
  FROM (SELECT *, row_number() OVER (PARTITION BY file_path, name ORDER BY col) AS k FROM name)""")
def unique_column_names(spark: SparkSession, d: str) -> DataFrame:
    """PR8-PR10: merged header names, repeats numbered."""
    lines = cut(_lines(spark, d))
    facts = S.line_facts(lines, "file_path")
    spans = S.header_spans(facts, S.header_rows(facts, "file_path"), "file_path")
    return S.unique_names(S.merged_names(lines, spans, "file_path"), "file_path")


def _selection(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    lines = cut(_lines(spark, d))
    known = S.line_facts(lines, "file_path")
    spans = cut(S.header_spans(known, S.header_rows(known, "file_path"), "file_path"))
    names = S.merged_names(lines, spans, "file_path")
    body = salted_join(lines, spans.select("file_path", "last"), ["file_path"], "inner", ["row"]).where("row > last").drop("last")
    facts = S.column_facts(body, "file_path")
    return spans, body, facts, S.chosen_columns(S.parameter_columns(names, "file_path"), facts, "file_path")


@registry.query(f"WITH {_CHOSEN} SELECT file_path, col, n_numbers, index_like FROM facts")
def index_like_columns(spark: SparkSession, d: str) -> DataFrame:
    """PR13: numeric cells per column, and columns that only count up."""
    return _selection(spark, d)[2]


@registry.query(f"WITH {_CHOSEN} SELECT file_path, parameter, col, name FROM chosen")
def chosen_columns(spark: SparkSession, d: str) -> DataFrame:
    """PR11, PR12, PR14: the column taken for each parameter."""
    return _selection(spark, d)[3]


@registry.query(f"""WITH {_CHOSEN}, p AS (SELECT unnest(['depth', 'qc', 'fs', 'u']) AS parameter, unnest([0, 1, 2, 3]) AS o)
  SELECT s.file_path, 'missing_columns' AS category, string_agg(p.parameter, ' & ' ORDER BY p.o) AS details FROM span s CROSS JOIN p
  LEFT JOIN chosen c ON c.file_path = s.file_path AND c.parameter = p.parameter WHERE c.col IS NULL GROUP BY s.file_path""")
def missing_columns(spark: SparkSession, d: str) -> DataFrame:
    """Sheets that lack a parameter, as failure rows."""
    spans, _, _, chosen = _selection(spark, d)
    return S.missing_parameters(spans, chosen, "file_path")


@registry.query(f"""WITH {_CHOSEN}, pick AS (SELECT file_path, max(col) FILTER (WHERE parameter = 'depth') AS a, max(col) FILTER (WHERE parameter = 'qc') AS b,
  max(col) FILTER (WHERE parameter = 'fs') AS c, max(col) FILTER (WHERE parameter = 'u') AS e FROM chosen GROUP BY file_path),
  w AS (SELECT l.file_path, l.row, max(num) FILTER (WHERE col = a) AS depth, max(num) FILTER (WHERE col = b) AS qc, max(num) FILTER (WHERE col = c) AS fs, max(num) FILTER (WHERE col = e) AS u, max(raw) FILTER (WHERE col = a) AS t
    FROM lines l JOIN pick USING (file_path) LEFT JOIN cell x ON x.file_path = l.file_path AND x.row = l.row WHERE a IS NOT NULL AND b IS NOT NULL AND c IS NOT NULL AND e IS NOT NULL GROUP BY ALL)
  , stop AS (SELECT file_path, min(row) AS stop FROM w WHERE t IS NOT NULL AND depth IS NULL OR coalesce(depth, qc, fs, u) IS NULL GROUP BY file_path)
  SELECT w.* EXCLUDE (t) FROM w LEFT JOIN stop USING (file_path) WHERE (stop IS NULL OR row < stop) AND (depth IS NOT NULL)::INT + (qc IS NOT NULL)::INT + (fs IS NOT NULL)::INT + (u IS NOT NULL)::INT >= 3""")
def sheet_measurements(spark: SparkSession, d: str) -> DataFrame:
    """PR14, PR15, V1: every sheet's four columns, rows with three or more numbers."""
    return S.extract(cut(_lines(spark, d)), "file_path")[0]
