"""Quantities recorded in different units.

Unit spellings are gathered from header cells and notes, reduced to the distinct ones, and mapped to known units through
an inverted index of character bigrams with a weighted edit-distance check. The resulting alias dictionary is joined to
all rows. For soundings the spelled unit holds where the values permit it; the values have the last word: shares of
readings beyond what a unit allows overrule a spelling that is off by orders of magnitude, and decide where none is spelled.
The ``basis`` of every unit (header, values against the header, values, default) comes out beside it.

Edge cases: a quantity without readings has no recorded unit; missing-reading codes are left out of the shares and
become null on conversion; a null note is a note without units; a null level or ratio gives no unit.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratakit.session import broadcast_if_small, salted_join

#: Spellings of each unit.
SPELLINGS = {
    "m": ["m", "metre", "metres", "meter", "meters", "mtr", "mtrs"],
    "cm": ["cm", "centimetre", "centimetres", "centimeter", "centimeters"],
    "mm": ["mm", "millimetre", "millimetres", "millimeter", "millimeters"],
    "ft": ["ft", "foot", "feet"],
    "mpa": ["mpa", "mn/m2", "n/mm2", "megapascal", "megapascals"],
    "kpa": ["kpa", "kn/m2", "kilopascal", "kilopascals"],
    "bar": ["bar", "bars"],
    "tsf": ["tsf", "ton/ft2", "tons/ft2", "t/ft2"],
    "kgf_cm2": ["kgf/cm2", "kg/cm2", "kgf/cm^2"],
    "percent": ["%", "percent", "pct"],
}

#: One unit in terms of the common one (m, MPa, fraction).
FACTORS = {
    "m": 1.0, "cm": 0.01, "mm": 0.001, "ft": 0.3048, "mpa": 1.0, "kpa": 0.001, "bar": 0.1, "tsf": 0.0957605,
    "kgf_cm2": 0.0980665, "percent": 0.01, "fraction": 1.0,
}

#: Codes that stand for a missing reading.
MISSING_CODES = [
    9999.0, -8.888, -9.999, -7.7777, -7.777, -777.0, -1944.2234, -2592.1785, -3888.4823, -4999.4882, -5832.7411,
    -5184.5892, -7777.0, -7776.9999, -7776.995, -8888.0, -9999.0, -9999.0027, -7.752,
]

#: Most that a reading in MPa can be, and most that a depth in m, ft and cm can be.
MOST_MPA = {"qc": 70.0, "fs": 0.8, "u": 0.8}
MOST_M, MOST_FT, MOST_CM = 31.0, 105.0, 3100.0
#: Readings beyond a limit count as a verdict from this share on.
SHARE, SHARE_MM = 0.5, 0.1

_LENGTH = ["m", "cm", "mm", "ft"]
_SPELLING = r"[A-Za-z%][A-Za-z0-9/^]*\.?"


def plain_spelling(text: Column) -> Column:
    """A spelling without case, blanks, full stops and raised digits."""
    return F.regexp_replace(F.translate(F.lower(text), "²³", "23"), r"[\s.]+", "")


# ---------------------------------------------------------------- the alias dictionary

#: Least that one edit costs in the weighted distance.
CHEAPEST_EDIT = 0.5

def _weighted_distance(a: str, b: str) -> float:
    """Edit distance in which vowels, plural s and adjacent swaps are cheap and the first letter is dear."""
    price = lambda c, i: 2.0 if i == 0 else 0.5 if c in "aeious" else 1.0
    before2: list[float] = []
    before = [0.0]
    for j, c in enumerate(b):
        before.append(before[-1] + price(c, j))
    for i, x in enumerate(a):
        row = [before[0] + price(x, i)]
        for j, y in enumerate(b):
            swap = 0.0 if x == y else max(price(x, i), price(y, j))
            best = min(before[j] + swap, before[j + 1] + price(x, i), row[j] + price(y, j))
            if i and j and x == b[j - 1] and a[i - 1] == y and x != y:
                best = min(best, before2[j - 1] + 0.5)
            row.append(best)
        before2, before = before, row
    return before[-1]


@F.pandas_udf(T.DoubleType())
def weighted_distance(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else _weighted_distance(x, y) for x, y in zip(a, b)], dtype="float64")


def _bigrams(text: Column) -> Column:
    padded = F.concat(F.lit("^"), text, F.lit("$"))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(padded) - 1), lambda i: F.substring(padded, i, F.lit(2))))


def alias_dictionary(spark: SparkSession, spellings: DataFrame) -> DataFrame:
    """(spelling, unit) for every distinct plain spelling that means a known unit.

    ``spellings``: one column ``spelling``. A spelling matches a known one when the weighted distance is at most a fifth of
    the known one's length beyond its third letter, so that short units must be exact. Ties go to the nearest, then
    the alphabetically first unit. An edit costs a half at least, so this bound limits the edits, and with them the lengths
    and the bigrams (three an edit) by which a match may differ: the index loses none.
    """
    known = spark.createDataFrame([(u, s) for u, all_ in SPELLINGS.items() for s in all_], "unit string, known string")
    bound = F.greatest(F.length("known") - 3, F.lit(0)) * 0.2
    known = known.withColumn("bound", bound).withColumn("edits", F.floor(F.col("bound") / CHEAPEST_EDIT + 1e-9).cast("int"))
    known = known.withColumn("grams", _bigrams(F.col("known"))).withColumn("least", F.size("grams") - 3 * F.col("edits"))
    index = known.withColumn("gram", F.explode("grams")).drop("grams")
    asked = spellings.where("spelling <> ''").distinct()
    hits = (
        asked.where(F.length("spelling") <= max(len(k) + int((len(k) - 3) * 0.2 / CHEAPEST_EDIT) for all_ in SPELLINGS.values() for k in all_))
        .select("spelling", F.explode(_bigrams(F.col("spelling"))).alias("gram"))
        .join(F.broadcast(index), "gram")
        .where(F.abs(F.length("spelling") - F.length("known")) <= F.col("edits"))
        .groupBy("spelling", "unit", "known", "bound", "least")
        .agg(F.count("*").alias("shared"))
        .where("shared >= least")
    )
    near = hits.withColumn("far", weighted_distance("spelling", "known")).where("far <= bound")
    return near.groupBy("spelling").agg(F.min_by("unit", F.struct("far", "unit")).alias("unit"))


# ---------------------------------------------------------------- soundings


def header_unit_text(name: Column) -> Column:
    """The part of a header cell where a unit may stand: in brackets, after a separator, or after the word "in"."""
    return plain_spelling(F.regexp_extract(name, r"(?i)^.*?(?:[\[(_,;:]|\s/|\sin\s|[a-z.]/(?=[a-z]))\s*(.*?)\s*[\])]?\s*$", 1))


def header_units(spark: SparkSession, headers: DataFrame, terms: DataFrame) -> DataFrame:
    """(file_path, quantity, unit) as the header cells spell it; unit is null where none is spelled."""
    known = terms.groupBy("search_term").agg(F.min("quantity").alias("quantity"))
    cells = (
        headers.select("file_path", "search_term", "matched_string", "col_index_in_line", "received_at")
        .join(broadcast_if_small(known), "search_term")
        .where(F.col("quantity").isin("depth", "qc", "fs", "u") & F.col("file_path").isNotNull())
        .groupBy("file_path", "quantity")
        .agg(F.min_by("matched_string", F.struct("col_index_in_line", "received_at")).alias("name"))
        .withColumn("spelling", F.coalesce(header_unit_text(F.col("name")), F.lit("")))
    )
    aliases = alias_dictionary(spark, cells.select("spelling"))
    return salted_join(cells, aliases, ["spelling"], "left", ["file_path"]).select("file_path", "quantity", "unit")


def reading(c: Column) -> Column:
    """A reading without codes for missing ones."""
    return F.when(~c.isin(*MISSING_CODES) & ~F.isnan(c), c)


def reading_shares(measurements: DataFrame) -> DataFrame:
    """Per cpt_id and quantity the count of readings and the counts beyond the limits; one partial aggregate, no sort."""
    d = F.abs(reading(F.col("depth")))
    over = lambda c, most: F.count_if(c > most)
    counts = [F.count(d).alias("n_depth"), *[over(d, v).alias(f"depth_{k}") for k, v in (("m", MOST_M), ("ft", MOST_FT), ("cm", MOST_CM))]]
    for q, column in (("qc", "qc"), ("fs", "fs"), ("u", "u2")):
        v = F.abs(reading(F.col(column)))
        counts += [F.count(v).alias(f"n_{q}"), over(v, MOST_MPA[q]).alias(f"{q}_mpa"), over(v, MOST_MPA[q] * 11).alias(f"{q}_far")]
    return measurements.where("cpt_id is not null").groupBy("cpt_id").agg(*counts)


def sounding_units(spark: SparkSession, reports: DataFrame, measurements: DataFrame, headers: DataFrame, terms: DataFrame) -> DataFrame:
    """(cpt_id, depth_unit, qc_unit, fs_unit, u_unit and a ``_basis`` of each); both are null when the column has no readings."""
    spelled = (
        header_units(spark, headers, terms)
        .groupBy("file_path")
        .agg(*[F.max(F.when(F.col("quantity") == q, F.col("unit"))).alias(f"said_{q}") for q in ("depth", "qc", "fs", "u")])
    )
    sheets = reports.where("cpt_id is not null").groupBy("cpt_id").agg(F.min("source_file").alias("file_path"))
    known = sheets.join(spelled, "file_path", "left")
    shares = reading_shares(measurements).join(known, "cpt_id", "left")
    n, said = F.col("n_depth"), F.col("said_depth")
    shown = F.when(F.col("depth_cm") >= n * SHARE_MM, "mm").when(F.col("depth_ft") >= n * SHARE, "cm").when(F.col("depth_m") >= n * SHARE, "ft").otherwise("m")
    # metres and feet differ too little for the values to deny feet
    out = _settled("depth", n, said, shown, (said == shown) | ((said == "ft") & (shown == "m")))
    for q in ("qc", "fs", "u"):
        said, n = F.col(f"said_{q}"), F.col(f"n_{q}")
        shown = F.when(F.col(f"{q}_mpa") >= n * SHARE, "kpa").otherwise("mpa")
        # bar, tsf and kgf/cm2 lie between: the values deny them only beyond ten times the limit in MPa
        out += _settled(q, n, said, shown, (said == shown) | (said.isin("bar", "tsf", "kgf_cm2") & (F.col(f"{q}_far") < n * SHARE)))
    return shares.select("cpt_id", *out)


def _settled(q: str, n: Column, said: Column, shown: Column, permitted: Column) -> list[Column]:
    """Unit and basis of a quantity from the spelled unit, the unit that the values show, and whether they permit the spelled one."""
    holds = F.coalesce(permitted, F.lit(False))
    own = F.when(shown.isin("m", "mpa"), "default").otherwise("values")
    basis = F.when(holds, "header").when(said.isNotNull(), "values against the header").otherwise(own)
    return [F.when(n > 0, F.when(holds, said).otherwise(shown)).alias(f"{q}_unit"), F.when(n > 0, basis).alias(f"{q}_basis")]


def unit_basis(soundings: DataFrame) -> DataFrame:
    """(quantity, recorded_unit, basis, n): how many soundings have each unit, and on what ground."""
    each = F.array(*[F.struct(F.lit(q).alias("quantity"), F.col(f"{q}_unit").alias("recorded_unit"), F.col(f"{q}_basis").alias("basis")) for q in ("depth", "qc", "fs", "u")])
    return soundings.select(F.inline(each)).where("recorded_unit is not null").groupBy("quantity", "recorded_unit", "basis").agg(F.count("*").alias("n"))


def factor(unit: Column) -> Column:
    """The factor that turns a value in ``unit`` into the common unit."""
    out = F
    for u, f in FACTORS.items():
        out = out.when(unit == u, F.lit(f))
    return out


def convert_soundings(measurements: DataFrame, units: DataFrame) -> DataFrame:
    """All measurements in m and MPa: depth made positive, missing-reading codes made null, repeated rows kept."""
    rows = measurements.select("measurement_id", "cpt_id", "depth", "qc", "fs", "u2")
    rows = salted_join(rows, units, ["cpt_id"], "left", ["measurement_id"])
    value = lambda c, u: reading(F.col(c)) * factor(F.col(u))
    return rows.select(
        "measurement_id", "cpt_id", F.abs(value("depth", "depth_unit")).alias("depth"), value("qc", "qc_unit").alias("qc"),
        value("fs", "fs_unit").alias("fs"), value("u2", "u_unit").alias("u2"),
    )


# ---------------------------------------------------------------- scalar values with notes

#: A measure in a note: a number and what follows it, or a unit alone in brackets or after "in".
_MEASURE = rf"(\d+(?:\.\d+)?)\s*({_SPELLING})"
#: Sizes of other things: they name no level, even where the number happens to equal it.
_SIZES = rf"(?:collar|casing)\s+\d+(?:\.\d+)?\s*{_SPELLING}|\d+(?:\.\d+)?\s*{_SPELLING}\s*(?:pipe|tube|cap|up)\b"
_BARE = rf"(?i)(?:\bin|level in|[\[(])\s*({_SPELLING})"


def level_units(spark: SparkSession, values: DataFrame) -> DataFrame:
    """(value_id, unit) of each stored ground-water level.

    A measure whose number equals the level names its unit; else a unit that stands without a number; else metres.
    Numbers that differ from the level are sizes of other things.
    """
    rows = values.where("ground_water_level is not null and value_id is not null").select(
        "value_id", F.abs("ground_water_level").alias("level"), F.regexp_replace(F.lower("ground_water_level_note"), _SIZES, " ").alias("note")
    ).distinct()
    found = rows.select(
        "value_id",
        "level",
        F.explode(
            F.concat(
                F.transform(
                    F.regexp_extract_all("note", F.lit(_MEASURE), F.lit(0)),
                    lambda x: F.struct(F.regexp_extract(x, _MEASURE, 1).try_cast("double").alias("number"), F.regexp_extract(x, _MEASURE, 2).alias("text")),
                ),
                F.transform(
                    F.regexp_extract_all("note", F.lit(_BARE), F.lit(1)),
                    lambda x: F.struct(F.lit(None).cast("double").alias("number"), x.alias("text")),
                ),
            )
        ).alias("m"),
    ).select("value_id", "level", "m.number", plain_spelling(F.col("m.text")).alias("spelling"))
    own = found.where(F.col("number").isNull() | (F.abs(F.col("number") - F.col("level")) < 1e-9 * (1 + F.col("level"))))
    named = salted_join(own, alias_dictionary(spark, own.select("spelling")), ["spelling"], "inner", ["value_id"])
    named = named.where(F.col("unit").isin(*_LENGTH))
    best = named.groupBy("value_id").agg(F.min_by("unit", F.struct(F.col("number").isNull(), "unit")).alias("unit"))
    return rows.select("value_id").distinct().join(best, "value_id", "left").withColumn("unit", F.coalesce("unit", F.lit("m")))


def ratio_units(values: DataFrame) -> DataFrame:
    """(value_id, unit): an area ratio above 1.5 is in percent."""
    rows = values.where("tip_net_area_ratio is not null and value_id is not null")
    unit = F.when(F.abs("tip_net_area_ratio") > 1.5, "percent").otherwise("fraction")
    return rows.select("value_id", unit.alias("unit")).distinct()


def foreign_units(soundings: DataFrame, levels: DataFrame, ratios: DataFrame) -> DataFrame:
    """(record_kind, record_id, quantity, recorded_unit) of everything stored in another unit than the common one."""
    cpt = soundings.select(
        F.lit("cptreport").alias("record_kind"),
        F.col("cpt_id").alias("record_id"),
        F.inline(F.array(*[F.struct(F.lit(q).alias("quantity"), F.col(f"{q}_unit").alias("recorded_unit")) for q in ("depth", "qc", "fs", "u")])),
    )
    scalar = lambda df, q: df.select(
        F.lit("extractedsinglevalues").alias("record_kind"), F.col("value_id").alias("record_id"), F.lit(q).alias("quantity"), F.col("unit").alias("recorded_unit")
    )
    all_ = cpt.unionByName(scalar(levels, "ground_water_level")).unionByName(scalar(ratios, "tip_net_area_ratio"))
    return all_.where("recorded_unit is not null and recorded_unit not in ('m', 'mpa', 'fraction')")
