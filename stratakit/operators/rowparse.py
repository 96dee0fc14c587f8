"""Rows that fail to parse: a minimum-cost error parse that separates them, with the reason, from the rows that load.

A line is read by an automaton with four states (field start, bare text, inside quotes, just after a quote). Beside
its free moves the automaton may, at a price, insert or delete a quote and insert a separator or demote one to text.
Dynamic programming over (state, fields so far) finds the cheapest reading that yields the header's width. Quote edits
cost more than any number of separator edits, so the first non-zero part of the cost names the first reason:

* quote edits             -> ``quoting``
* separator edits         -> ``column_count``
* cells of the wrong type -> ``value``
* no cost at all          -> the line loads.

Most lines never need an edit: for them the cost-zero layer of the programme is a plain left-to-right run.

Edge cases: a null line is read as the empty line; the empty line has one empty field; a null delimiter is read as a
comma; a line whose file has no header row gets a null width, is never ``column_count`` and has untyped columns.
"""

from __future__ import annotations

import datetime
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratakit.session import salted_join

#: Price of one quote edit, in separator edits: a quote edit outweighs every separator edit of one line.
QUOTE_PRICE = 1 << 40

PARSED = T.StructType([
    T.StructField("reason", T.StringType()),
    T.StructField("quote_edits", T.IntegerType()),
    T.StructField("separator_edits", T.IntegerType()),
    T.StructField("bad_cells", T.IntegerType()),
    T.StructField("edits", T.StringType()),
    T.StructField("fields", T.ArrayType(T.StringType())),
])

_NUMBER = re.compile(r"[ \t]*[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?[ \t]*")
_NUMBER_COMMA = re.compile(r"[ \t]*[+-]?(?:[0-9]+[.,]?[0-9]*|[.,][0-9]+)(?:[eE][+-]?[0-9]+)?[ \t]*")
_INT = re.compile(r"[ \t]*[+-]?[0-9]+[ \t]*")
_DATE = re.compile(r"([0-9]{4})-([0-9]{2})-([0-9]{2})")

START, BARE, QUOTED, AFTER = range(4)
_TOKENS = {d: re.compile(f'"|{re.escape(d)}|[^"{re.escape(d)}]+') for d in ",;\t|"}


def _tokens(line: str, delimiter: str) -> list[str]:
    if delimiter not in _TOKENS:
        _TOKENS[delimiter] = re.compile(f'"|{re.escape(delimiter)}|[^"{re.escape(delimiter)}]+')
    return _TOKENS[delimiter].findall(line)


def free_run(tokens: list[str], delimiter: str) -> list[str] | None:
    """The cost-zero layer: the fields of a well-formed line, or None when the automaton gets stuck."""
    fields: list[str] = []
    state, text = START, []
    for t in tokens:
        if state == QUOTED:
            if t == '"':
                state = AFTER
            else:
                text.append(t)
        elif t == delimiter:
            fields.append("".join(text))
            state, text = START, []
        elif t == '"':
            if state == BARE:
                return None
            if state == AFTER:
                text.append('"')
            state = QUOTED
        elif state == AFTER:
            return None
        else:
            text.append(t)
            state = BARE
    if state == QUOTED:
        return None
    fields.append("".join(text))
    return fields


def cheapest_edits(tokens: list[str], delimiter: str, width: int | None) -> tuple[int, int, str]:
    """(quote edits, separator edits, edit list) of the cheapest reading with ``width`` fields (None: any number)."""
    cap = width if width is not None else sum(t == delimiter for t in tokens) + 1
    # layer: (state, fields begun) -> (cost, chain of edits as nested pairs)
    layer: dict[tuple[int, int], tuple[int, tuple | None]] = {(START, 1): (0, None)}

    def put(into: dict, key: tuple[int, int], cost: int, chain: tuple | None) -> None:
        if key not in into or cost < into[key][0]:
            into[key] = (cost, chain)

    def with_quote(state: int) -> int | None:
        return {START: QUOTED, QUOTED: AFTER, AFTER: QUOTED}.get(state)

    at = 0
    for t in tokens:
        # a quote may be inserted in front of any token
        opened = dict(layer)
        for (state, n), (cost, chain) in layer.items():
            if (after := with_quote(state)) is not None:
                put(opened, (after, n), cost + QUOTE_PRICE, (chain, f"insert quote at {at}"))
        fresh: dict[tuple[int, int], tuple[int, tuple | None]] = {}
        for (state, n), (cost, chain) in opened.items():
            if t == '"':
                if (after := with_quote(state)) is not None:
                    put(fresh, (after, n), cost, chain)
                put(fresh, (state, n), cost + QUOTE_PRICE, (chain, f"delete quote at {at}"))
            elif t == delimiter and state != QUOTED:
                if n < cap:
                    put(fresh, (START, n + 1), cost, chain)
                else:
                    put(fresh, (START, n), cost + 1, (chain, f"delete separator at {at}"))
            elif state != AFTER:
                put(fresh, (QUOTED if state == QUOTED else BARE, n), cost, chain)
        layer = fresh
        at += len(t)
    best: tuple[int, tuple | None] | None = None
    for (state, n), (cost, chain) in layer.items():
        if state == QUOTED:
            cost, chain = cost + QUOTE_PRICE, (chain, f"insert quote at {at}")
        if width is not None and n < width:
            cost, chain = cost + width - n, (chain, f"insert {width - n} separators at {at}")
        if best is None or cost < best[0]:
            best = cost, chain
    cost, chain = best  # type: ignore[misc]
    said = []
    while chain:
        chain, edit = chain
        said.append(edit)
    return cost // QUOTE_PRICE, cost % QUOTE_PRICE, "; ".join(reversed(said))


def fits(cell: str, kind: str, delimiter: str) -> bool:
    """Whether a nonempty cell can be read as its column's type: d(ouble), i(nt), t (date) or anything else."""
    if kind == "d":
        return (_NUMBER_COMMA if delimiter == ";" else _NUMBER).fullmatch(cell) is not None
    if kind == "i":
        return _INT.fullmatch(cell) is not None
    if kind == "t":
        m = _DATE.fullmatch(cell)
        if not m:
            return False
        try:
            datetime.date(*map(int, m.groups()))
        except ValueError:
            return False
    return True


def parse_line(line: str | None, delimiter: str | None, kinds: str | None) -> tuple:
    """One line as a ``PARSED`` tuple; ``kinds`` has a letter per header column, or is None without a header."""
    line, delimiter = line or "", delimiter or ","
    if '"' in line:
        tokens = _tokens(line, delimiter)
        fields = free_run(tokens, delimiter)
    else:
        tokens, fields = None, line.split(delimiter)
    width = None if kinds is None else len(kinds)
    if fields is None or (width is not None and len(fields) != width):
        quotes, separators, edits = cheapest_edits(_tokens(line, delimiter) if tokens is None else tokens, delimiter, width)
        return "quoting" if quotes else "column_count", quotes, separators, 0, edits, None
    bad = [i for i, (c, k) in enumerate(zip(fields, kinds or "")) if c and k != "s" and not fits(c, k, delimiter)]
    if bad:
        return "value", 0, 0, len(bad), "; ".join(f"replace cell {i}" for i in bad), fields
    return None, 0, 0, 0, "", fields


@F.pandas_udf(PARSED)
def _parse(line: pd.Series, delimiter: pd.Series, kinds: pd.Series) -> pd.DataFrame:
    rows = [parse_line(a, b, c) for a, b, c in zip(line, delimiter, kinds)]
    return pd.DataFrame(rows, columns=PARSED.names)


#: Not to be evaluated again for each use of a field of its result.
_parse_once = _parse.asNondeterministic()


def kind_letter(cell_type: Column) -> Column:
    return (
        F.when(cell_type == "double", "d").when(cell_type == "int", "i").when(cell_type == "date", "t").otherwise("s")
    )


def header_kinds(headers: DataFrame) -> DataFrame:
    """(file_path, kinds): one letter per column position of each file. Repeated deliveries count once.

    ``headers``: file_path, col_index_in_line, cell_type. Positions without a row are untyped; when deliveries of a
    position disagree, a known type wins. Rows with a null file or position are ignored. A file's columns are the
    only thing gathered, after reduction to one row per (file, position).
    """
    cells = (
        headers.where("file_path is not null and col_index_in_line >= 0")
        .groupBy("file_path", "col_index_in_line")
        .agg(F.coalesce(F.max(F.when(F.col("cell_type").isNotNull(), kind_letter(F.col("cell_type")))), F.lit("s")).alias("k"))
    )
    packed = cells.groupBy("file_path").agg(
        F.map_from_entries(F.collect_list(F.struct("col_index_in_line", "k"))).alias("m"), F.max("col_index_in_line").alias("top")
    )
    letters = F.transform(F.sequence(F.lit(0), F.col("top")), lambda i: F.coalesce(F.col("m")[i.cast("int")], F.lit("s")))
    return packed.select("file_path", F.array_join(letters, "").alias("kinds"))


def error_parse(lines: DataFrame, headers: DataFrame) -> DataFrame:
    """Every distinct delivered line with the outcome of its minimum-cost parse in the columns of ``PARSED``.

    ``lines``: line_id, file_path, line_no, delimiter, extraction (extra columns are dropped, whatever their names).
    A line delivered again with the same content appears once. Header lines (``line_no`` 1) are left out.
    """
    body = (
        lines.where("line_no is null or line_no <> 1")
        .select("line_id", "file_path", "line_no", "delimiter", "extraction")
    )
    joined = salted_join(body, header_kinds(headers), ["file_path"], "left", ["line_id"], keep=True)
    once = joined.dropDuplicates([*body.columns, "__salt"])
    parsed = once.withColumn("p", _parse_once("extraction", "delimiter", "kinds"))
    return parsed.select(*body.columns, "p.*")


def rejected(parsed: DataFrame) -> DataFrame:
    """The lines set apart: line_id, reason and the edits that would repair them."""
    return parsed.where("reason is not null").select("line_id", "reason", "quote_edits", "separator_edits", "bad_cells", "edits")


def loaded(parsed: DataFrame) -> DataFrame:
    """The lines that load: line_id, file_path, line_no, delimiter and fields."""
    return parsed.where("reason is null").select("line_id", "file_path", "line_no", "delimiter", "fields")
