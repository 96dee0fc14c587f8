"""Text column functions of the miners."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratakit import constants as K


def numeric_value(text: Column, check_cm: bool = False) -> Column:
    """Magnitude of the first number; divided by 100 when ``check_cm`` and "cm" follows it."""
    first = F.regexp_extract(text, rf"({K.NUMBER})\s*((?i:cm)?)", 1).try_cast("double")
    if not check_cm:
        return F.abs(first)
    cm = F.lower(F.regexp_extract(text, rf"({K.NUMBER})\s*((?i:cm)?)", 2)) == "cm"
    return F.abs(F.when(cm, first / 100.0).otherwise(first))


def numbers_in(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(K.NUMBER), F.lit(0))


def digit_spans(text: Column, pattern: str = K.DIGITS) -> Column:
    """Array of (start, token) of every match, starts counted from 0. ``pattern`` must not look around."""
    tokens = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern)
    # the k-th match starts after the first k+1 pieces and k matches
    return F.transform(tokens, lambda t, k: F.struct(
        (F.aggregate(F.slice(pieces, F.lit(1), k + 1), F.lit(0), lambda a, x: a + F.length(x))
         + F.aggregate(F.slice(tokens, F.lit(1), k), F.lit(0), lambda a, x: a + F.length(x))).alias("start"), t.alias("token")))


def closest_digits(text: Column, at: Column) -> Column:
    """The digits whose start is nearest to ``at`` (from 0); the first of equals; null without digits."""
    ranked = F.transform(digit_spans(text), lambda s: F.struct(F.abs(s["start"] - at).alias("far"), s["start"].alias("start"), s["token"].alias("token")))
    return F.array_min(ranked)["token"]


def level_method(label: Column) -> Column:
    """How a ground-water level was found, by the words of its label, in fixed precedence."""
    low = F.lower(label)
    positive = ~low.contains("not")
    return (
        F.when(low.contains("collapse") | low.contains("collapase"), "collapsed")
        .when(low.contains("estimate"), "estimated")
        .when(low.contains("assume"), "assumed")
        .when(low.contains("derive") & positive, "derived")
        .when(low.contains("dip"), "dipper")
        .when(low.contains("measure") & positive, "measured")
    )


def soil_types(description: Column) -> Column:
    """Soil words in upper case among the blank-separated words, without the punctuation around them; distinct."""
    words = F.transform(F.split(description, r"(?U)\s+"), lambda w: F.trim(w, F.lit(",.;")))
    return F.array_intersect(F.array(*[F.lit(s) for s in K.SOIL_TYPES]), words)


def spt_value(text: Column) -> Column:
    return F.regexp_extract(text, K.SPT_VALUE, 2).try_cast("int")


def borehole_id(path: Column) -> Column:
    """The number between underscores in a file's stem; null where there is none."""
    stem = F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")
    return F.regexp_extract(stem, r"_(\d+)_", 1).try_cast("int")


def whole_term(text: Column, term: str) -> Column:
    """Whether ``term`` stands in the text as a word of its own."""
    quoted = "".join(c if c.isalnum() or c == " " else "\\" + c for c in term)
    return F.lower(text).rlike(rf"(?:^|\s){quoted}(?:\s|$|:|=|\()")


def percentage_near_label(text: Column) -> Column:
    """The percentage whose start or end is nearest to the first ratio or efficiency label; null without either."""
    percents = digit_spans(text, r"\d{1,3}(?:\.\d+)?\s*%")
    label = F.regexp_extract(text, r"(?i)\b(?:ratio|efficien(?:t|cy)|hammer\s+energy)\b", 0)
    start = F.instr(text, label) - 1
    end = start + F.length(label)
    ranked = F.transform(percents, lambda p: F.struct(
        F.greatest(F.abs(p["start"] - start), F.abs(p["start"] + F.length(p["token"]) - end)).alias("far"), p["start"].alias("start"), p["token"].alias("token")))
    best = F.regexp_extract(F.array_min(ranked)["token"], r"(\d{1,3}(?:\.\d+)?)", 1).try_cast("double")
    return F.when(F.length(label) > 0, best)
