"""Schemas that drift between files: rescue-column ingestion and a change report.

A target schema of quantities is enforced on every file. What the schema does not know, or what cannot be cast, is kept
as JSON in a rescue column. Approving more quantities promotes them: their rescued values are replayed into typed
columns and leave the JSON. The same routine works on header cells (one row per file) and on data lines.

Edge cases: repeated deliveries of a header cell count once; a header cell without position is ignored; a term that
the term list lacks has no quantity and stays in the rescue column; when a file has several columns of one quantity the
leftmost is the quantity's column and the others stay rescued; files without feed or creation time come out in the
tables but cannot be compared; the first file of a feed reports no change.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratakit.session import broadcast_if_small, chunked_lag, salted_join

#: Quantities enforced from the start, and those that may be promoted, with their types.
CORE = {"depth": "double", "qc": "double", "fs": "double", "u": "double"}
PROMOTABLE = {"inclination": "double", "speed": "double", "temperature": "double", "remark": "string", "logged_on": "date"}

_CELL = "struct<pos:int,quantity:string,name:string,cell_type:string>"
_RAW = "struct<pos:int,quantity:string,name:string,raw:string>"


def _rank_in_quantity() -> Column:
    return F.row_number().over(Window.partitionBy("file_path", "quantity").orderBy("pos"))


def header_cells(headers: DataFrame, terms: DataFrame) -> DataFrame:
    """One row per header cell of a file, with the quantity its search term stands for (null when unknown)."""
    cells = headers.where("file_path is not null and col_index_in_line >= 0").groupBy(
        "file_path", F.col("col_index_in_line").alias("pos")
    ).agg(
        F.min("feed").alias("feed"),
        F.min("created_at").alias("created_at"),
        F.min_by("search_term", "received_at").alias("search_term"),
        F.min_by("matched_string", "received_at").alias("name"),
        F.min_by("cell_type", "received_at").alias("cell_type"),
    )
    known = terms.where("search_term is not null").groupBy("search_term").agg(F.min("quantity").alias("quantity"))
    return cells.join(broadcast_if_small(known), "search_term", "left")


def _entry_of(quantity: str) -> Column:
    """The first rescued entry of a quantity, or null."""
    return F.try_element_at(F.filter("_entries", lambda e: e["quantity"] == quantity), F.lit(1))


def observed_schemas(cells: DataFrame, core: Sequence[str] = tuple(CORE)) -> DataFrame:
    """One row per file: a (name, cell_type) column per enforced quantity, everything else as JSON in ``_rescued``."""
    ranked = cells.withColumn("leftmost", F.col("quantity").isin(*core) & (_rank_in_quantity() == 1))
    cell = F.struct("name", "cell_type")
    entry = F.struct("pos", "quantity", "name", "cell_type")
    return ranked.groupBy("file_path").agg(
        F.min("feed").alias("feed"),
        F.min("created_at").alias("created_at"),
        *[F.max(F.when(F.col("leftmost") & (F.col("quantity") == q), cell)).alias(q) for q in core],
        F.to_json(F.array_sort(F.collect_list(F.when(~F.coalesce("leftmost", F.lit(False)), entry)))).alias("_rescued"),
    )


def promote_schemas(schemas: DataFrame, approved: Sequence[str]) -> DataFrame:
    """Replay approved quantities from ``_rescued`` into columns; what remains stays in the JSON."""
    entries = F.from_json("_rescued", f"array<{_CELL}>")
    out = schemas.withColumn("_entries", entries)
    for q in approved:
        hit = _entry_of(q)
        out = out.withColumn(q, F.when(hit.isNotNull(), F.struct(hit["name"].alias("name"), hit["cell_type"].alias("cell_type"))))
    known = lambda e, i: F.coalesce(e["quantity"].isin(*approved), F.lit(False))
    taken = lambda e: F.array_position(F.transform("_entries", lambda x: x["quantity"]), e["quantity"])
    left = F.filter("_entries", lambda e, i: ~(known(e, i) & (taken(e) == i + 1)))
    return out.withColumn("_rescued", F.to_json(left)).drop("_entries")


def schema_changes(schemas: DataFrame, quantities: Sequence[str]) -> DataFrame:
    """(file_path, quantity, change) of each file against the one before it in its feed, by time and then by name."""
    now = schemas.where("feed is not null and created_at is not null")
    now = now.select("file_path", "feed", "created_at", F.struct("created_at", "file_path").alias("_at"), F.struct(*quantities).alias("cur"))
    seen = chunked_lag(now, ["feed"], "_at", F.to_date("created_at"), F.col("cur"), "old").where("old is not null")
    pairs = F.array(*[
        F.struct(F.lit(q).alias("quantity"), F.col("cur")[q].alias("a"), F.col("old")[q].alias("b")) for q in quantities
    ])
    flat = seen.select("file_path", F.inline(pairs))
    return flat.select("file_path", "quantity", F.explode(_changes(F.col("a"), F.col("b"))).alias("change")).distinct()


def _changes(now: Column, old: Column) -> Column:
    look = lambda c: F.lower(F.regexp_replace(F.coalesce(c["name"], F.lit("")), r"(?U)\s+", ""))
    both = now.isNotNull() & old.isNotNull()
    return F.array_compact(F.array(
        F.when(now.isNotNull() & old.isNull(), "added"),
        F.when(now.isNull() & old.isNotNull(), "removed"),
        F.when(both & (look(now) != look(old)), "renamed"),
        F.when(both & (now["cell_type"] != old["cell_type"]), "retyped"),
    ))


def layouts(cells: DataFrame, core: Sequence[str]) -> DataFrame:
    """(file_path, slots): every header cell of a file as (pos, quantity when it is the leftmost one, name)."""
    slot = F.struct("pos", F.when(F.col("rank") == 1, F.col("quantity")).alias("quantity"), "name")
    return cells.withColumn("rank", _rank_in_quantity()).groupBy("file_path").agg(F.array_sort(F.collect_list(slot)).alias("slots"))


def cast_cell(raw: Column, kind: str, delimiter: Column) -> Column:
    """``raw`` as ``kind`` or null; only plain decimal notation counts as a number."""
    if kind == "double":
        text = F.trim(F.when(delimiter == ";", F.regexp_replace(raw, ",", ".")).otherwise(raw))
        return F.when(text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), text.try_cast("double"))
    if kind == "date":
        return F.when(raw.rlike(r"^\d{4}-\d{2}-\d{2}$"), raw.try_cast("date"))
    return raw.try_cast(kind)


def ingest_lines(lines: DataFrame, layout: DataFrame, core: Mapping[str, str] = CORE) -> DataFrame:
    """Parsed lines in the target schema: a typed column per core quantity, and ``_rescued`` (null when empty).

    ``lines``: line_id, file_path, line_no, delimiter, fields. An empty cell is null and is not rescued; a cell beyond
    the known header is rescued without a name.
    """
    lines = lines.select("line_id", "file_path", "line_no", "delimiter", "fields")
    joined = salted_join(lines, layout, ["file_path"], "left", ["line_id"])
    named = F.transform(
        F.coalesce("fields", F.array().cast("array<string>")),
        lambda raw, i: F.struct(
            i.alias("pos"),
            F.try_element_at(F.filter("slots", lambda s: s["pos"] == i), F.lit(1))["quantity"].alias("quantity"),
            F.try_element_at(F.filter("slots", lambda s: s["pos"] == i), F.lit(1))["name"].alias("name"),
            raw.alias("raw"),
        ),
    )
    full = joined.select("line_id", "file_path", "line_no", "delimiter", F.filter(named, lambda e: e["raw"] != "").alias("_entries"))
    return _typed(full, core)


def promote_lines(ingested: DataFrame, approved: Mapping[str, str] = PROMOTABLE) -> DataFrame:
    """Replay rescued values of approved quantities into typed columns; uncastable values stay in the JSON."""
    full = ingested.withColumn("_entries", F.coalesce(F.from_json("_rescued", f"array<{_RAW}>"), F.array().cast(f"array<{_RAW}>")))
    return _typed(full.drop("_rescued"), approved)


def _typed(full: DataFrame, wanted: Mapping[str, str]) -> DataFrame:
    out = full
    for q, kind in wanted.items():
        raw = _entry_of(q)["raw"]
        out = out.withColumn(q, cast_cell(raw, kind, F.col("delimiter")))
    fit = F.array_compact(F.array(*[F.when(F.col(q).isNotNull(), F.lit(q)) for q in wanted]))
    left = F.filter("_entries", lambda e: ~F.coalesce(F.array_contains("_fit", e["quantity"]), F.lit(False)))
    out = out.withColumn("_fit", fit).withColumn("_left", left)
    return out.withColumn("_rescued", F.when(F.size("_left") > 0, F.to_json("_left"))).drop("_entries", "_fit", "_left")
