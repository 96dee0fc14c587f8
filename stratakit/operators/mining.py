"""Scalar values from cells: term search, neighbouring cells, one value per sheet and quantity.

Grids are lines (sheet, row, cells). Term search joins cells with a fixed list of terms as literal patterns, so each pattern is
compiled once. The neighbours of a matched cell are looked up by position: left and right inside the line's array, above
and below by an equality join on (sheet, row, column), not by a window over the sheet.

Edge cases: blank cells are skipped up to four times; without a neighbour there is no candidate; values that are no number or
outside the accepted range are dropped; ties go to the first in search order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratakit import constants as K
from stratakit.functions import text as X

#: Cells looked at in each direction from a matched one.
STEPS = K.MAX_BLANKS


def first_full_header(lines: DataFrame, sheet: str, found: Column) -> DataFrame:
    """(sheet, header_row): first line beyond the second that names all four parameters; null without one."""
    return lines.groupBy(sheet).agg(F.min(F.when((found == 4) & (F.col("row") > 1), F.col("row"))).alias("header_row"))


def above_header(lines: DataFrame, headers: DataFrame, sheet: str) -> DataFrame:
    joined = lines.join(headers, sheet)
    return joined.where(F.col("header_row").isNull() | (F.col("row") < F.col("header_row"))).drop("header_row")


def orientation(lines: DataFrame, sheet: str) -> DataFrame:
    """(sheet, orientation): ``columns`` when some column holds more texts than any row does, else ``rows``."""
    cells = lines.select(sheet, "row", F.posexplode("cells").alias("col", "raw")).where("raw is not null")
    tall = cells.groupBy(sheet, "col").agg(F.count("*").alias("n")).groupBy(sheet).agg(F.max("n").alias("tall"))
    wide = cells.groupBy(sheet, "row").agg(F.count("*").alias("n")).groupBy(sheet).agg(F.max("n").alias("wide"))
    return tall.join(wide, sheet).select(sheet, F.when(F.col("tall") > F.col("wide"), "columns").otherwise("rows").alias("orientation"))


def _ahead(cells: Column, col: Column, steps: int = STEPS) -> Column:
    """The first nonblank cell after ``col`` within ``steps``; the array is addressed from 0."""
    return F.coalesce(*[F.try_element_at(cells, (col + 1 + k).cast("int")) for k in range(1, steps + 1)])


def _from_left(cells: Column, col: Column, strict: bool) -> Column:
    """Nearest nonblank cell before ``col`` within the steps; ``strict``: among the line's first cells, from its start."""
    if strict:
        return F.coalesce(*[F.when(F.lit(k) < col, F.try_element_at(cells, F.lit(k + 1))) for k in range(STEPS)])
    return F.coalesce(*[F.when(col - k >= 0, F.try_element_at(cells, F.greatest(col - k + 1, F.lit(1)).cast("int"))) for k in range(1, STEPS + 1)])


def neighbours(hits: DataFrame, lines: DataFrame, sheet: str, strict: bool = False) -> DataFrame:
    """``hits`` (sheet, row, col, cells, …) with columns left, right, above and below: nearest nonblank cells.

    Above and below come from one join: every hit asks for the eight places around it, and places of one hit are bounded.
    """
    keyed = hits.withColumn("__id", F.xxhash64(sheet, "row", "col"))
    asked = keyed.select(sheet, "row", "col", "__id").distinct().select(
        sheet, "__id", "col", F.explode(F.array(*[F.lit(k) for k in (*range(-STEPS, 0), *range(1, STEPS + 1))])).alias("k"), F.col("row").alias("__row")
    ).withColumn("row", F.col("__row") + F.col("k"))
    cells = lines.select(sheet, "row", F.posexplode("cells").alias("col", "raw")).where("raw is not null")
    met = asked.join(cells, [sheet, "row", "col"]).groupBy("__id").agg(
        F.max_by("raw", F.when(F.col("k") < 0, F.col("k"))).alias("above"), F.min_by("raw", F.when(F.col("k") > 0, F.col("k"))).alias("below")
    )
    out = keyed.join(met, "__id", "left").drop("__id")
    return out.withColumn("right", _ahead(F.col("cells"), F.col("col"))).withColumn("left", _from_left(F.col("cells"), F.col("col"), strict))


def term_matches(lines: DataFrame, sheet: str, terms: list[str] | None = None) -> DataFrame:
    """(sheet, row, col, raw, term, cells): each cell with every search term that stands in it as a word."""
    terms = list(K.TERM_QUANTITY) if terms is None else terms
    cells = lines.select(sheet, "row", F.posexplode("cells").alias("col", "raw"), "cells").where("raw is not null")
    hit = []
    for t in terms:
        found = F.lower("raw").contains(t) & X.whole_term(F.col("raw"), t)
        if t == "a factor":
            found = found & ~F.lower("raw").rlike("alpha factor|beta factor")
        hit.append(F.when(found, F.lit(t)))
    any_term = F.lower("raw").rlike("|".join(sorted(terms)))
    return cells.where(any_term).withColumn("term", F.explode(F.array_compact(F.array(*hit))))


def search_candidates(matches: DataFrame, oriented: DataFrame, sheet: str) -> DataFrame:
    """The three readings of a matched cell as candidates.

    ``matches`` needs the neighbour columns. ``standalone``: the cell holds a pattern itself. ``value``: it is a value whose field name is
    beside it. ``field``: it is a field name whose value is beside or below it. ``ord`` keeps the search order.
    """
    known = matches.join(oriented, sheet, "left")
    patterns = K.search_patterns()

    def any_of(kind: str, text: Column) -> Column:
        hit = F.lit(False)
        for term, by in patterns.items():
            if by.get(kind):
                hit = hit | ((F.col("term") == term) & text.rlike("(?i)" + "|".join(f"(?:{p})" for p in by[kind])))
        return F.coalesce(hit, F.lit(False))

    term_order = F.array_position(F.array(*[F.lit(t) for t in K.TERM_QUANTITY]), F.col("term"))

    def rows(kind: str, number: int, direction: str | None, label: Column, value: Column, tested: Column) -> DataFrame:
        return known.where(any_of(kind, tested)).select(
            F.struct(term_order.alias("t"), F.col("row").alias("r"), F.col("col").alias("c"), F.lit(number).alias("k")).alias("ord"), sheet,
            F.col("orientation").alias("likely_orientation"), F.col("term").alias("search_term"), F.lit(kind).alias("search_assumption"),
            F.lit(direction).cast("string").alias("assumed_orientation"), label.alias("field_label"), value.alias("value"),
        )

    raw = F.col("raw")
    none = F.lit(None).cast("string")
    out = rows("standalone", 0, None, none, raw, raw)
    for n, (direction, beside) in enumerate((("columns", F.col("left")), ("rows", F.col("above")))):
        out = out.unionByName(rows("value", 1 + n, direction, beside, raw, beside))
    for n, (direction, beside) in enumerate((("columns", F.col("right")), ("rows", F.col("below")))):
        out = out.unionByName(rows("field", 3 + n, direction, raw, beside, beside))
    return out


def number_for_term(value: Column, term: Column) -> Column:
    """The number nearest to the term inside the value, else the first number; magnitude."""
    at = F.instr(F.lower(value), term) - 1
    near = X.closest_digits(value, at).try_cast("double")
    return F.when(F.lower(value).contains(term), near).otherwise(X.numeric_value(value))


def resolve_numbers(candidates: DataFrame, sheet: str) -> DataFrame:
    """(sheet, quantity, value, method): per sheet the first accepted level and area ratio.

    Candidates in the sheet's likely orientation, or without an assumed one, come first.
    """
    quantity = F.create_map(*[F.lit(x) for kv in K.TERM_QUANTITY.items() for x in kv])[F.col("search_term")]
    rows = candidates.withColumn("quantity", quantity).where(F.col("quantity").isin("ground_water_level", "tip_net_area_ratio") & F.col("value").rlike(K.NUMBER))
    number = number_for_term(F.col("value"), F.col("search_term"))
    rows = rows.withColumn("number", number).withColumn("method", F.coalesce(X.level_method(F.col("field_label")), X.level_method(F.col("value"))))
    ok = F.when(F.col("quantity") == "ground_water_level", F.col("number").between(*K.GWL_RANGE)).otherwise(F.col("number").between(*K.RATIO_RANGE))
    later = ~(F.col("assumed_orientation").isNull() | (F.col("assumed_orientation") == F.col("likely_orientation")))
    best = rows.where(ok).groupBy(sheet, "quantity").agg(F.min_by(F.struct("number", "method"), F.struct(F.coalesce(later, F.lit(True)).alias("l"), "ord")).alias("b"))
    return best.select(sheet, "quantity", F.col("b.number").alias("value"), F.col("b.method").alias("method"))


def classify_ending(value: Column, label: Column | None = None) -> Column:
    """``refusal`` or ``target_depth`` by the words of a remark, refusal first; null for neither."""
    low = F.lower(value)
    refused = low.isin([w.lower() for w in [*K.REFUSED, K.MAX_THRUST, *K.TARGET_MISSED]]) | low.contains("refus")
    reached = low.isin([w.lower() for w in K.TARGET_REACHED]) | low.contains("target") | low.contains("reached")
    out = F.when(refused, "refusal").when(reached, "target_depth")
    if label is not None:
        out = F.coalesce(out, F.when(F.lower(label).isin(K.TARGET_FIELDS) & low.rlike("^(?:" + "|".join(K.DEPTH_VALUES) + ")$"), "target_depth"))
    return out


def prior_ending(rows: DataFrame, sheet: str, reason: str) -> DataFrame:
    """One reason per sheet: refusal beats target depth."""
    return rows.groupBy(sheet).agg(F.coalesce(F.max(F.when(F.col(reason) == "refusal", F.col(reason))), F.max(reason)).alias(reason))
