"""Grids to soundings: cells, headers, column candidates, column choice.

A sheet is a set of lines (sheet, row, cells). What concerns one line is an expression over its cell array and needs no
shuffle. What concerns a sheet (where the header is, how far it spans, which columns are numeric) is an aggregate per sheet or per
(sheet, column), joined back; no sheet is gathered into one task.

Edge cases: blank cells are null; cells that hold "nan" anywhere are neither text nor number in header counts; a sheet without
any candidate has no header row; the last line is never a header; ties go to the line first met from the line with most text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratakit import constants as K
from stratakit.functions.numbers import to_number
from stratakit.operators.conditioning import CHUNK, truncate_after
from stratakit.session import chunked_lag, cut, salted_join

DELIMITERS = {",": ",", ";": ";", "\t": "\t", " ": r"\s+"}


# ---------------------------------------------------------------- text to cells


def delimiter_counts(lines: DataFrame, sheet: str, text: str) -> DataFrame:
    """(sheet, delimiter, total): the most frequent of comma, semicolon, tab and other blanks; ties in this order.

    A sheet with none of them has a null delimiter (``no_delimiter_found``).
    """
    c = F.col(text)
    counts = lines.groupBy(sheet).agg(
        F.sum(F.regexp_count(c, F.lit(","))).alias("comma"), F.sum(F.regexp_count(c, F.lit(";"))).alias("semicolon"),
        F.sum(F.regexp_count(c, F.lit("\t"))).alias("tab"), F.sum(F.regexp_count(c, F.lit(r"\s+"))).alias("blanks"),
    )
    blanks = F.col("blanks") - F.col("tab")
    most = F.greatest("comma", "semicolon", "tab", blanks)
    pick = F.when(most <= 0, None).when(F.col("comma") == most, ",").when(F.col("semicolon") == most, ";").when(F.col("tab") == most, "\t").otherwise(" ")
    return counts.select(sheet, pick.alias("delimiter"), most.alias("total"))


#: Fixed value: a stretch between double or between single quotes.
_QUOTED = r"\"[^\"]*\"|'[^']*'"


def without_quoted_delimiters(text: Column, delimiter: Column) -> Column:
    """Delete the delimiter between double or single quotes, and the double quotes around it; an unmatched quote stays as it is."""
    quoted = F.regexp_extract_all(text, F.lit(_QUOTED), F.lit(0))
    clean = F.transform(quoted, lambda q: F.replace(F.replace(q, delimiter, F.lit("")), F.lit('"'), F.lit("")))
    joined = F.array_join(F.transform(F.split(text, _QUOTED, -1), lambda gap, i: F.concat(gap, F.coalesce(F.get(clean, i), F.lit("")))), "")
    return F.when(text.contains('"') | text.contains("'"), joined).otherwise(text)


def split_cells(text: Column, delimiter: Column) -> Column:
    """The cells of a line, blank ones null. A line indented before blank-separated cells gets ``placeholder`` in front."""
    indented = F.concat(F.when(text.rlike(r"^\s"), F.lit("placeholder")).otherwise(F.lit("")), text)
    cells = (
        F.when(delimiter == ",", F.split(text, ","))
        .when(delimiter == ";", F.split(text, ";"))
        .when(delimiter == "\t", F.split(text, "\t"))
        .otherwise(F.split(indented, r"\s+"))
    )
    return F.transform(cells, lambda x: F.when(F.trim(x) != "", F.trim(x)))


def explode_cells(lines: DataFrame, sheet: str) -> DataFrame:
    """(sheet, row, col, raw, num), one row per nonblank cell. ``lines``: sheet, row, cells."""
    cells = lines.select(sheet, "row", F.posexplode("cells").alias("col", "raw")).where("raw is not null")
    return cells.withColumn("num", to_number(F.col("raw")))


def cell_profile(cells: DataFrame, sheet: str) -> DataFrame:
    """Numbers and numbers-minus-texts per row, per column and per sheet, in one pass of grouping sets."""
    number = F.count_if(F.col("num").isNotNull())
    surplus = number - F.count_if(F.col("num").isNull())
    sets = [[F.col(sheet), F.col("row")], [F.col(sheet), F.col("col")], [F.col(sheet)]]
    return cells.groupingSets(sets, sheet, "row", "col").agg(number.alias("n_numbers"), surplus.alias("surplus"))


# ---------------------------------------------------------------- header search


def line_counts(lines: DataFrame) -> DataFrame:
    """Adds n_text and n_number; cells that hold "nan" count as neither."""
    plain = F.filter("cells", lambda x: x.isNotNull() & ~F.lower(x).contains("nan"))
    numbers = F.size(F.filter(plain, lambda x: to_number(x).isNotNull()))
    return lines.withColumn("n_number", numbers).withColumn("n_text", F.size(plain) - F.col("n_number"))


_EXACT = sorted({e for names in K.EXACT_NAMES.values() for e in names})


def _named(lines: DataFrame) -> DataFrame:
    """Adds ``__at``: per cell its column, its lower-case name, and whether it is the line's first use of an exact name."""
    low = lines.withColumn("__low", F.transform("cells", lambda x: F.lower(x)))
    first = lambda x, i: F.when(x.isin(_EXACT), F.array_position("__low", x) == i + 1).otherwise(False)
    return low.withColumn("__at", F.transform("__low", lambda x, i: F.struct(i.alias("col"), x.alias("name"), first(x, i).alias("first"))))


def _has_part(parameter: str, name: Column) -> Column:
    hit = F.lit(False)
    for s in K.PART_NAMES[parameter]:
        hit = hit | name.contains(s)
    return hit


def _hits(parameter: str) -> Column:
    """Columns of a line that may be ``parameter``: exact names once each, parts of names everywhere; ascending."""
    match = lambda c: c["name"].isNotNull() & (_has_part(parameter, c["name"]) | (c["first"] & c["name"].isin(K.EXACT_NAMES[parameter])))
    return F.transform(F.filter("__at", match), lambda c: F.struct(c["col"].alias("col"), c["name"].alias("name")))


def _negated(parameter: str, name: Column) -> Column:
    hit = F.lit(False)
    for w in K.NEGATING[parameter]:
        hit = hit | name.contains(w)
    return hit


def candidates(lines: DataFrame, sticky: bool = False) -> DataFrame:
    """Adds one array of (col, name) per parameter. ``sticky``: a negated candidate also ends the list."""
    out = _named(lines)
    for p in K.PARAMETERS:
        out = out.withColumn(p, _hits(p))
        if sticky:
            first = F.array_position(_flags(p), True)
            out = out.withColumn(p, F.when(first > 0, F.slice(p, F.lit(1), first.cast("int") - 1)).otherwise(F.col(p)))
        else:
            out = out.withColumn(p, _kept(p))
    return out.drop("__low", "__at")


def _flags(p: str) -> Column:
    return F.transform(p, lambda c: _negated(p, c["name"]))


def _kept(p: str) -> Column:
    return F.filter(p, lambda c: ~_negated(p, c["name"]))


def claimed(lines: DataFrame) -> DataFrame:
    """Candidates after parameters claimed names in order: a name taken by an earlier parameter is gone for later ones."""
    out = lines
    taken: Column = F.array().cast("array<string>")
    for p in K.PARAMETERS:
        out = out.withColumn("__taken", taken).withColumn(p, _unclaimed(p))
        taken = F.concat(F.col("__taken"), F.transform(p, lambda c: c["name"]))
        out = out.withColumn("__taken", taken)
        taken = F.col("__taken")
    return out.drop("__taken")


def _unclaimed(p: str) -> Column:
    return F.filter(p, lambda c: ~F.array_contains("__taken", c["name"]))


def line_facts(lines: DataFrame, sheet: str) -> DataFrame:
    """(sheet, row, n_text, n_number, found): what the header search needs of each line; ``found`` counts the parameters it names.

    One narrow row per line, written out once and read by every later step.
    """
    counted = line_counts(lines).withColumn("__low", F.transform("cells", lambda x: F.lower(x)))

    def named(p: str) -> Column:
        part = F.exists("__low", lambda x: F.coalesce(_has_part(p, x) & ~_negated(p, x), F.lit(False)))
        whole = [e for e in K.EXACT_NAMES[p] if not any(w in e for w in K.NEGATING[p])]
        return part | F.coalesce(F.arrays_overlap(F.array_compact("__low"), F.array(*[F.lit(e) for e in whole]).cast("array<string>")), F.lit(False))

    found = sum((named(p).cast("int") for p in K.PARAMETERS), F.lit(0))
    return cut(counted.select(sheet, "row", "n_text", "n_number", found.alias("found")))


def header_rows(facts: DataFrame, sheet: str) -> DataFrame:
    """(sheet, header_row, n_found, n_lines): the line that names most parameters, searched from the line with most text on.

    ``facts``: see :func:`line_facts`.
    """
    seen = facts.withColumn("surplus", F.col("n_text") - F.col("n_number"))
    ends = seen.groupBy(sheet).agg(
        F.min_by("row", F.struct(-F.col("surplus"), "row")).alias("start"), F.min("row").alias("low"), F.max("row").alias("high")
    )
    ring = salted_join(seen.where("found > 0"), ends, [sheet], "inner", ["row"]).where("row < high")
    turn = F.pmod(F.col("row") - F.col("start"), F.greatest(F.col("high") - F.col("low"), F.lit(1)))
    best = ring.groupBy(sheet).agg(
        F.min_by(F.struct("row", "found"), F.struct(-F.col("found"), turn, "row")).alias("b")
    )
    return ends.join(best, sheet, "left").select(
        sheet, F.col("b.row").alias("header_row"), F.coalesce("b.found", F.lit(0)).alias("n_found"), (F.col("high") - F.col("low") + 1).alias("n_lines")
    )


def header_spans(facts: DataFrame, headers: DataFrame, sheet: str) -> DataFrame:
    """(sheet, header_row, first, last): the header's lines. Upward while the text count stays the same, downward while texts prevail,
    never into the last line. ``facts``: see :func:`line_facts`."""
    counts = facts.select(sheet, "row", "n_text", "n_number")
    known = headers.where("header_row is not null")
    own = salted_join(counts, known, [sheet], "inner", ["row"])
    texts = own.groupBy(sheet).agg(
        F.max(F.when(F.col("row") == F.col("header_row"), F.col("n_text"))).alias("texts"), F.min("header_row").alias("header_row"),
        F.min("row").alias("low"), F.max("row").alias("high"),
    )
    near = salted_join(counts, texts, [sheet], "inner", ["row"])
    ends = near.groupBy(sheet, "header_row", "low", "high").agg(
        F.max(F.when((F.col("row") < F.col("header_row")) & (F.col("n_text") != F.col("texts")), F.col("row"))).alias("above"),
        F.min(F.when((F.col("row") > F.col("header_row")) & (F.col("n_text") <= F.col("n_number")), F.col("row"))).alias("below"),
    )
    first = F.coalesce(F.col("above") + 1, F.col("low"))
    last = F.greatest("header_row", F.least(F.coalesce(F.col("below") - 1, F.col("high")), F.col("high") - 1))
    return ends.select(sheet, "header_row", first.alias("first"), last.alias("last"))


def merged_names(lines: DataFrame, spans: DataFrame, sheet: str, workbook: Column | None = None) -> DataFrame:
    """(sheet, col, name): names of the header's lines in lower case, joined from top to bottom with ``_``; in sheets of a ``workbook``
    the lowest line's name comes first, and blanks join."""
    top = salted_join(lines, spans, [sheet], "inner", ["row"]).where(F.col("row").between(F.col("first"), F.col("last")))
    cells = top.select(sheet, "row", F.posexplode("cells").alias("col", "raw")).where("raw is not null")
    parts = cells.groupBy(sheet, "col").agg(F.transform(F.array_sort(F.collect_list(F.struct("row", "raw"))), lambda x: x["raw"]).alias("p"))
    name = F.array_join("p", "_")
    if workbook is not None:
        name = F.when(workbook, F.array_join(F.concat(F.slice("p", F.size("p"), F.lit(1)), F.slice("p", F.lit(1), F.size("p") - 1)), " ")).otherwise(name)
    return parts.select(sheet, "col", F.lower(name).alias("name"))


def unique_names(names: DataFrame, sheet: str) -> DataFrame:
    """Second and later uses of a name in a sheet get ``_2``, ``_3`` and so on."""
    k = F.row_number().over(Window.partitionBy(sheet, "name").orderBy("col"))
    return names.withColumn("k", k).withColumn("unique_name", F.when(F.col("k") > 1, F.concat("name", F.lit("_"), "k")).otherwise(F.col("name"))).drop("k")


# ---------------------------------------------------------------- choosing columns


def column_facts(body: DataFrame, sheet: str) -> DataFrame:
    """(sheet, col, n_numbers, index_like): numeric cells of each column below the header, and whether it only counts up in
    whole numbers. ``body``: sheet, row, cells."""
    cells = body.select(sheet, "row", F.posexplode("cells").alias("col", "raw"))
    whole = F.coalesce(F.col("raw").rlike(r"^[+-]?\d+$"), F.lit(False))
    plain = cut(cells.groupBy(sheet, "col").agg(F.count(to_number(F.col("raw"))).alias("n_numbers"), F.bool_and(whole).alias("whole")))
    # only columns of whole numbers need their order looked at
    asked = salted_join(cells, plain.where("whole").select(sheet, "col"), [sheet, "col"], "left_semi", ["row"])
    ordered = asked.groupBy(sheet, "col", "row").agg(F.max(to_number(F.col("raw"))).alias("num"))
    steps = chunked_lag(ordered, [sheet, "col"], "row", F.floor(F.col("row") / CHUNK), F.col("num"), "before")
    rising = steps.groupBy(sheet, "col").agg(F.bool_and(F.coalesce(F.col("num") >= F.col("before"), F.lit(True))).alias("rising"))
    out = plain.join(rising, [sheet, "col"], "left")
    return out.select(sheet, "col", "n_numbers", (F.col("whole") & F.coalesce("rising", F.lit(False))).alias("index_like"))


def parameter_columns(names: DataFrame, sheet: str) -> DataFrame:
    """(sheet, col, name, parameter): each named column with every parameter it may be; negated names are left out."""
    names = names.withColumn("__first", F.min("col").over(Window.partitionBy(sheet, "name")))
    options = []
    low = F.col("name")
    for p in K.PARAMETERS:
        hit = F.lit(False)
        for s in K.PART_NAMES[p]:
            hit = hit | low.contains(s)
        exact = low.isin(K.EXACT_NAMES[p]) & (F.col("col") == F.col("__first"))
        options.append(F.when((hit | exact) & ~_negated(p, low), F.lit(p)))
    return names.withColumn("parameter", F.explode(F.array_compact(F.array(*options)))).drop("__first")


def chosen_columns(options: DataFrame, facts: DataFrame, sheet: str, avoid: str | None = None) -> DataFrame:
    """(sheet, parameter, col, name): per parameter the first column that has more than three numbers, does not look like an index and
    was not claimed by an earlier parameter; of equal names the one with most numbers counts. Names that contain ``avoid`` come last."""
    rich = options.join(facts, [sheet, "col"])
    of_name = Window.partitionBy(sheet, "parameter", "name").orderBy(F.desc("n_numbers"), "col")
    one = rich.withColumn("k", F.row_number().over(of_name)).where("k = 1").where(f"n_numbers > {K.MIN_POINTS} and not index_like")
    order = F.array_position(F.array(*[F.lit(p) for p in K.PARAMETERS]), F.col("parameter"))
    ranked = one.withColumn("o", order)
    claim = F.min("o").over(Window.partitionBy(sheet, "name"))
    free = ranked.withColumn("claim", claim).where("o = claim")
    return free.groupBy(sheet, "parameter").agg(
        F.min_by(F.struct("col", "name"), F.struct(F.col("name").contains(avoid) if avoid else F.lit(False), "col")).alias("c")
    ).select(sheet, "parameter", "c.col", "c.name")


def missing_parameters(sheets: DataFrame, chosen: DataFrame, sheet: str) -> DataFrame:
    """(sheet, category, details): the failure of every sheet for which a parameter has no column."""
    have = chosen.groupBy(sheet).agg(F.collect_set("parameter").alias("have"))
    gaps = sheets.select(sheet).distinct().join(have, sheet, "left").withColumn(
        "gap", F.array_except(F.array(*[F.lit(p) for p in K.PARAMETERS]), F.coalesce("have", F.array().cast("array<string>")))
    )
    return gaps.where("size(gap) > 0").select(sheet, F.lit("missing_columns").alias("category"), F.array_join("gap", " & ").alias("details"))


def measurements(body: DataFrame, chosen: DataFrame, sheet: str, required: Sequence[str] = tuple(K.PARAMETERS)) -> DataFrame:
    """(sheet, row, depth, qc, fs, u, bad): the chosen columns of every sheet that has all required parameters.

    ``bad`` rows hold text where the depth should be, or nothing at all: data ends there.
    """
    wide = chosen.groupBy(sheet).agg(*[F.max(F.when(F.col("parameter") == p, F.col("col"))).alias(f"c_{p}") for p in K.PARAMETERS])
    for p in required:
        wide = wide.where(F.col(f"c_{p}").isNotNull())
    joined = salted_join(body, wide, [sheet], "inner", ["row"])
    value = lambda p: to_number(F.try_element_at("cells", F.col(f"c_{p}") + 1)).alias(p)
    out = joined.select(sheet, "row", *[value(p) for p in K.PARAMETERS], F.try_element_at("cells", F.col("c_depth") + 1).alias("__text"))
    text = F.col("__text").isNotNull() & F.col("depth").isNull()
    return out.withColumn("bad", text | F.coalesce(*[F.col(p) for p in K.PARAMETERS]).isNull()).drop("__text")


def extract(lines: DataFrame, sheet: str) -> tuple[DataFrame, DataFrame]:
    """(measurements, failures), see :func:`extract_named`."""
    good, failed, _ = extract_named(lines, sheet)
    return good, failed


def extract_named(lines: DataFrame, sheet: str, workbook: Column | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(measurements, failures, chosen columns) of every sheet: header search, merging, column choice, rows up to the first that is no
    data, of these the ones with three or more numbers.

    ``lines``: sheet, row, cells. ``workbook`` tells the sheets of workbooks from texts, see :func:`merged_names`. Failure categories:
    no_header_row, missing_columns, no_numeric_data.
    """
    known = line_facts(lines, sheet)
    found = cut(header_rows(known, sheet))
    spans = cut(header_spans(known, found, sheet))
    options = parameter_columns(merged_names(lines, spans, sheet, workbook), sheet)
    body = salted_join(lines, spans.select(sheet, "last"), [sheet], "inner", ["row"]).where("row > last").drop("last")
    chosen = cut(chosen_columns(options, column_facts(body, sheet), sheet))
    rows = truncate_after(measurements(body, chosen, sheet), sheet, "row", F.col("bad")).drop("bad")
    numbers = sum((F.col(p).isNotNull().cast("int") for p in K.PARAMETERS), F.lit(0))
    good = rows.where(numbers >= K.MIN_ROW_SURPLUS)
    headless = found.where("header_row is null").select(sheet, F.lit("no_header_row").alias("category"), F.lit("").alias("details"))
    missing = missing_parameters(spans, chosen, sheet)
    complete = chosen.groupBy(sheet).agg(F.count("*").alias("n")).where(F.col("n") == len(K.PARAMETERS)).select(sheet)
    empty = complete.join(good.select(sheet), sheet, "left_anti").select(sheet, F.lit("no_numeric_data").alias("category"), F.lit("").alias("details"))
    return good, headless.unionByName(missing).unionByName(empty), chosen
