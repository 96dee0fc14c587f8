"""Mapping free-entered values to a canonical list by a partition-based pigeonhole join, in built-in expressions only.

A reference string that may differ by k edits is cut into k+1 segments. If the edits number k at most, one segment stands
unchanged in the value, shifted by k positions at most. So values and references meet in an equality join on
(segment text, position), and the built-in ``levenshtein`` verifies what meets.

Two rounds use that join. The first compares the letters of a value with whole entries, in every order of their words and with one
word left out; what comes first is the fewest edits. An entry may stand anywhere in a value, so every run of consecutive words is
such a text, its letters run together: whatever stands beside the entry (a remark, a measure, a prefix) takes no part, and no list
of such words is needed. The second takes what the first leaves open (words cut short, several words missing or torn apart) and
matches the words of the value with the words of the entries, by the share of the entry's letters that are found again. What
neither matches is reported by an anti-join as entry 0. Entries of more than ``ALL_ORDERS`` words are compared only as rotations,
reversed and with the ends swapped.

Edge cases: a null value gives no row; an empty or blank value means no entry; a value spelled exactly as an entry of its field
gives no row; a value of any length is split whole, and only words too long for any entry are skipped; ties go to the fewest
edits and then to the smallest entry; null reference entries are ignored; with an empty list every value is unmatched.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratakit.session import broadcast_if_small, cut, salted_join

#: Share of an entry's letters that must be found again by words, share of them that must stand when all there is is one word cut
#: short and misspelled, and share of letters that must stand unedited in a run of words.
COVERED, STANDING, ALIKE = 0.5, 0.45, 0.66
#: Shortest word that may be cut short.
SHORTEST_CUT = 4
#: Most words of an entry whose run-together letters are formed in every order.
ALL_ORDERS = 5

#: Letters with marks and their plain forms.
_MARKED, _PLAIN = "àáâãäåāçèéêëēìíîïīñòóôõöōùúûüūýÿ", "aaaaaaaceeeeeiiiiinoooooouuuuuyy"


def plain(value: Column) -> Column:
    """Lower case without marks; separators become blanks."""
    return F.regexp_replace(F.translate(F.lower(value), _MARKED, _PLAIN), r"[_\-\s]+", " ")


def _segments(text: Column, k: Column) -> Column:
    """Array of (segment text, position) for every cut and every shift a match may show; positions count from 1."""
    size = F.length(text)
    start = lambda i: F.floor(i * size / (k + 1)).cast("int")
    per_cut = F.transform(F.sequence(F.lit(0), k), lambda i: F.struct(start(i).alias("at"), (start(i + 1) - start(i)).alias("n")))
    shifted = F.flatten(F.transform(per_cut, lambda s: F.transform(
        F.sequence(-k, k), lambda d: F.struct(F.substring(text, s["at"] + 1, s["n"]).alias("part"), (s["at"] + 1 + d).alias("pos"))
    )))
    return F.filter(shifted, lambda x: (x["pos"] >= 1) & (F.length(x["part"]) > 0))


def _no_parts() -> Column:
    return F.array().cast("array<struct<part:string,pos:int>>")


def _substrings(text: Column, n: int) -> Column:
    """All substrings of length n with their positions."""
    parts = F.transform(
        F.sequence(F.lit(1), F.length(text) - (n - 1)),
        lambda i: F.struct(F.substring(text, i, F.lit(n)).alias("part"), i.alias("pos")),
    )
    return F.when(F.length(text) >= n, parts).otherwise(_no_parts())


def pigeonhole(values: DataFrame, value: str, refs: DataFrame, ref: str, k: str, also: Sequence[str] = ()) -> DataFrame:
    """Pairs of distinct values and references at most ``k`` edits apart and equal in the columns ``also``, with ``edits``.

    ``refs`` must be small; its row count is checked before it is broadcast. The lengths of its segments, a handful of
    numbers, decide which substrings of the values are formed.
    """
    keyed = cut(refs.withColumn("__p", F.explode(_segments(F.col(ref), F.col(k)))).select("*", "__p.part", "__p.pos").drop("__p"))
    facts = keyed.agg(F.collect_set(F.length("part")).alias("sizes"), F.max(F.length(ref) + F.col(k)).alias("longest")).head()
    sizes, longest = sorted(facts["sizes"]), facts["longest"] or 0
    text = F.col(value)
    grams = F.flatten(F.array(*[_substrings(text, n) for n in sizes])) if sizes else _no_parts()
    fit = values.where((F.length(text) > 0) & (F.length(text) <= longest))
    probes = fit.withColumn("__g", F.explode(grams)).select("*", F.col("__g.part").alias("part"), F.col("__g.pos").alias("pos")).drop("__g")
    met = probes.join(broadcast_if_small(keyed), [*also, "part", "pos"]).where(F.abs(F.length(text) - F.length(ref)) <= F.col(k))
    near = met.drop("part", "pos").distinct().withColumn("edits", F.levenshtein(text, F.col(ref)))
    return near.where(F.col("edits") <= F.col(k))


def _runs(tokens: Column, most: int, longest: int) -> Column:
    """Run-together letters of every run of at most ``most`` consecutive words, as far as ``longest`` letters."""
    n = F.size(tokens)
    ends = lambda i: F.sequence(F.lit(1), F.least(F.lit(most), n - i))
    every = F.flatten(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.transform(ends(i), lambda w: F.array_join(F.slice(tokens, i + 1, w), ""))))
    return F.when(n > 0, F.array_distinct(F.filter(every, lambda x: F.length(x) <= longest)))


def _word_refs(entries: DataFrame) -> DataFrame:
    """Words of the entries, whole and cut short, with the edits each may differ by and the letters it stands for; a cut costs one more."""
    words = entries.select("field", "entry_id", F.posexplode(F.split("plain", " ")).alias("w", "word")).where("word <> ''")
    n = F.length("word")
    whole = F.when(n <= 3, 0).when(n <= 5, 1).when(n <= 6, 2).otherwise(3)
    cuts = F.when(n > SHORTEST_CUT, F.transform(F.sequence(F.lit(SHORTEST_CUT), n - 1), lambda i: F.struct(
        F.substring(F.col("word"), F.lit(1), i).alias("form"), F.when(i < 5, 1).otherwise(2).alias("k"), F.lit(1).alias("loss")))
    ).otherwise(F.array().cast("array<struct<form:string,k:int,loss:int>>"))
    forms = F.concat(F.array(F.struct(F.col("word").alias("form"), whole.alias("k"), F.lit(0).alias("loss"))), cuts)
    return words.select("field", "entry_id", "w", n.alias("letters"), F.explode(forms).alias("f")).select("field", "entry_id", "w", "letters", "f.*")


def _permutations(words: Column) -> Column:
    """Every order of an array of words: each word in turn is put at every place of the orders so far."""
    none = F.array(F.array().cast("array<string>"))
    put = lambda order, w: F.transform(
        F.sequence(F.lit(0), F.size(order)), lambda i: F.concat(F.slice(order, F.lit(1), i), F.array(w), F.slice(order, i + 1, F.size(order) + 1))
    )
    return F.aggregate(words, none, lambda orders, w: F.flatten(F.transform(orders, lambda order: put(order, w))))


def _letter_refs(entries: DataFrame) -> DataFrame:
    """Entries as run-together letters in every order, each also with one word left out; long ones in the orders named above.

    ``loss`` are the letters left out.
    """
    words = F.filter(F.split("plain", " "), lambda w: w != "")
    size = F.size("words")
    rotations = F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.concat(
        F.slice("words", i + 1, size), F.when(i > 0, F.slice("words", F.lit(1), i)).otherwise(F.array().cast("array<string>"))))
    swapped = F.when(size > 2, F.concat(F.slice("words", size, F.lit(1)), F.slice("words", F.lit(2), size - 2), F.slice("words", F.lit(1), F.lit(1)))).otherwise(F.col("words"))
    some = F.concat(rotations, F.array(F.reverse(F.col("words")), swapped))
    orders = F.when(size <= ALL_ORDERS, _permutations(F.col("words"))).otherwise(some)
    full = entries.withColumn("words", words).where("size(words) > 0").select("field", "entry_id", F.explode(F.array_distinct(orders)).alias("words"))
    short = full.where("size(words) > 2").select("field", "entry_id", F.inline(F.transform(
        F.sequence(F.lit(0), F.size("words") - 1), lambda i: F.struct(F.filter("words", lambda w, j: j != i).alias("words"), F.length(F.get("words", i)).alias("loss")))))
    letters = full.withColumn("loss", F.lit(0)).unionByName(short)
    letters = letters.select("field", "entry_id", "loss", F.array_join("words", "").alias("form")).groupBy("field", "entry_id", "form").agg(F.min("loss").alias("loss"))
    n = F.length("form")
    return letters.withColumn("k", F.floor(n * (1 - ALIKE)).cast("int")).where("k > 0 or loss = 0")


def canonical(values: DataFrame, reference: DataFrame) -> DataFrame:
    """(value_id, field, entry_id) of every non-null value that is not spelled exactly as an entry of its field.

    ``values``: value_id, field, value. ``reference``: entry_id, field, entry. Unmatched values get entry 0.
    """
    known = reference.where("entry is not null and field is not null").groupBy("field", "entry").agg(F.min("entry_id").alias("entry_id"))
    entries = known.withColumn("plain", F.trim(F.regexp_replace(plain(F.col("entry")), "[^a-z ]+", " ")))
    rows = values.where("value is not null").select("value_id", "field", "value").distinct()
    loose = rows.join(broadcast_if_small(known.select("field", F.col("entry").alias("value"))), ["field", "value"], "left_anti")
    meant = cut(_meanings(cut(loose.select("field", "value").distinct()), entries))
    found = salted_join(loose, meant, ["field", "value"], "inner", ["value_id"]).select("value_id", "field", "entry_id")
    none = salted_join(loose, meant, ["field", "value"], "left_anti", ["value_id"]).select("value_id", "field", F.lit(0).alias("entry_id"))
    return found.unionByName(none).distinct()


def _meanings(spelled: DataFrame, entries: DataFrame) -> DataFrame:
    """(field, value, entry_id) for the distinct values that mean an entry."""
    text = spelled.withColumn("tokens", F.regexp_extract_all(plain(F.col("value")), F.lit("[a-z]+"), F.lit(0)))
    forms = cut(_letter_refs(entries))
    size = forms.agg(F.max(F.length("form") + F.col("k")).alias("longest")).head()
    words = entries.agg(F.max(F.size(F.split("plain", " "))).alias("most")).head()
    longest, most = size["longest"] or 0, 2 * (words["most"] or 0)  # a word may be torn in two
    runs = cut(text.select("field", "value", F.explode(_runs(F.col("tokens"), max(most, 1), longest)).alias("letters")))
    alike = pigeonhole(runs.select("field", "letters").distinct(), "letters", forms, "form", "k", ["field"])
    closest = alike.groupBy("field", "letters", "entry_id").agg(F.min(F.struct(F.col("edits") + F.col("loss"), "loss")).alias("e"))
    met = runs.join(closest, ["field", "letters"])
    # fewest edits and letters left out, then the longest run
    first = cut(met.groupBy("field", "value").agg(F.min_by("entry_id", F.struct("e", -F.length("letters"), "entry_id")).alias("entry_id")))
    tokens = text.select("field", "value", F.explode(F.array_distinct("tokens")).alias("token")).join(first, ["field", "value"], "left_anti")
    by_word = pigeonhole(tokens.select("field", "token").distinct(), "token", _word_refs(entries), "form", "k", ["field"])
    lost = F.struct((F.col("edits") + F.col("loss")).alias("lost"), ((F.col("loss") > 0) & (F.col("edits") > 0)).alias("weak"), (F.col("edits") - F.length("form")).alias("gone"))
    best_form = by_word.groupBy("token", "field", "entry_id", "w", "letters").agg(F.min(lost).alias("l")).select("*", "l.*")
    covered = (
        tokens.join(best_form, ["field", "token"])
        .groupBy("field", "value", "entry_id", "w", "letters")
        .agg(F.min(F.struct("lost", "weak", "gone")).alias("l"))
        .groupBy("field", "value", "entry_id")
        .agg(
            F.sum(F.greatest(F.col("letters") - F.col("l.lost"), F.lit(0))).alias("kept"), F.sum("l.lost").alias("lost"),
            (F.bool_and("l.weak") & (F.count("*") == 1)).alias("alone"), F.sum(-F.col("l.gone")).alias("standing"),
        )
        .join(broadcast_if_small(entries.select("entry_id", "field", F.length(F.regexp_replace("plain", " ", "")).alias("size"))), ["field", "entry_id"])
        .withColumn("score", F.col("kept") / F.col("size"))
    )
    rank = F.struct(-F.col("score"), "lost", "entry_id")
    enough = (F.col("score") >= COVERED) & (~F.col("alone") | (F.col("standing") >= F.col("size") * STANDING))
    second = covered.where(enough).groupBy("field", "value").agg(F.min_by("entry_id", rank).alias("entry_id"))
    return first.unionByName(second)
