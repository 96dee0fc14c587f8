"""Long exact spans shared between records, by automata over recurring passages.

1. Every text is winnowed: of each run of 137 consecutive 64-character windows the one with the least hash is marked. Two texts
   with a common run of 200 characters mark the same window inside it. Marks found in two texts or more are the recurring
   passages.
2. The passages are compiled into sharded Aho-Corasick automata of bounded size. Texts are cut into overlapping pieces, and every
   piece that carries a mark of a shard is streamed through that shard's automaton, which locates every occurrence; every place
   of a long run holds a mark, so what carries none has no long run. A text costs what its marked pieces cost, however many
   shards there are, and a very long text is spread over many blocks.
3. An occurrence keeps its surroundings, as far as a run of the wanted length can reach. Equal surroundings are one
   class. Classes of a passage are compared in pairs while they are few; for a passage with many classes, every stretch of the
   wanted length around it becomes a join key instead, so no group is ever paired out to find what does not match. Both ways
   are exact and give the same rows; ``FEW`` only chooses the cheaper one.

Edge cases: null, empty and shorter texts take part in nothing; characters are code points; repeats inside one text are no case;
rows with equal ids are one record whose texts are looked at apart; null ids are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from stratakit.session import broadcast_if_small, cut

PASSAGE, RUN = 64, 200
#: Passages per automaton, characters of text per block, places per piece of a text, and classes of a passage that are still
#: compared in pairs.
SHARD, BLOCK_CHARS, PIECE, FEW = 20_000, 8_000_000, 1024, 32

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


_POWERS = [np.empty(0, np.uint64), np.empty(0, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, kept from text to text."""
    if len(_POWERS[0]) < n:
        size = max(n, 1 << 16)
        _POWERS[0] = np.cumprod(np.full(size, _BASE, np.uint64), dtype=np.uint64)
        _POWERS[1] = np.cumprod(np.full(size, _INVERSE, np.uint64), dtype=np.uint64)
    return _POWERS[0][:n], _POWERS[1][:n]


def window_hashes(points: np.ndarray, size: int) -> np.ndarray:
    """64-bit polynomial hash of every window of ``size`` code points."""
    n = len(points)
    if n < size:
        return np.empty(0, np.uint64)
    c = (points.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    c ^= c >> np.uint64(29)
    up, down = _powers(n)
    prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(c * down, dtype=np.uint64)])
    h = (prefix[size:] - prefix[:-size]) * up[: n - size + 1]
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    m, span = h, 1
    while span * 2 <= width:
        m = np.minimum(m[:-span], m[span:])
        span *= 2
    rest = width - span
    return np.minimum(m[: len(m) - rest], m[rest:]) if rest else m


def marks(text: str, passage: int = PASSAGE, run: int = RUN, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, positions) of the windows that winnowing marks; of equal hashes in one piece of the text only the first."""
    h = window_hashes(code_points(text), passage)
    width = run - passage + 1
    if len(h) < width:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    low = _sliding_min(h, width)
    border = np.zeros(width - 1, np.uint64)
    reached = ~_sliding_min(~np.concatenate([border, low, border]), width)
    at = np.flatnonzero(h <= reached)
    values = h[at].view(np.int64)
    order = np.lexsort((at, values, at // piece))
    at, values = at[order], values[order]
    fresh = np.ones(len(at), bool)
    fresh[1:] = (values[1:] != values[:-1]) | (at[1:] // piece != at[:-1] // piece)
    return values[fresh], at[fresh]


def _mark_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        found = [marks(t) for t in pdf["text"]]
        if found:
            h, at = (np.concatenate(part) for part in zip(*found))
            ids, version = (np.repeat(pdf[c].to_numpy(), [len(x) for x, _ in found]) for c in ("doc_id", "version"))
            yield pd.DataFrame({"doc_id": ids, "version": version, "h": h, "pos": at})


def _texts(documents: DataFrame) -> DataFrame:
    """(doc_id, version, text) of the texts long enough; ``version`` tells the texts of one id apart."""
    long = documents.where((F.col("doc_id").isNotNull()) & (F.length("text") >= RUN))
    return long.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("version"), "text")


def _pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The pieces of each text that a shard must see, with the surroundings that runs at their borders can reach."""
    side = RUN - PASSAGE
    names = ["shard", "doc_id", "start", "skip", "text"]
    for pdf in batches:
        out, size = [], 0
        for i, text, wanted in zip(pdf["doc_id"], pdf["text"], pdf["wanted"]):
            for w in wanted:
                start = w["piece"] * PIECE
                low = max(0, start - side)
                out.append((w["shard"], i, start, start - low, text[low : start + PIECE + PASSAGE - 1 + side]))
                size += 1
                if size == 4000:
                    yield pd.DataFrame(out, columns=names)
                    out, size = [], 0
        if out:
            yield pd.DataFrame(out, columns=names)


def occurrences(documents: DataFrame) -> DataFrame:
    """(doc_id, passage, left, around, positions): every recurring passage in every text with its surroundings.

    ``positions`` count from 0 and are all those in one piece of the text with the same surroundings; ``left`` characters of
    ``around`` come before the passage.
    """
    texts = _texts(documents)
    found = cut(texts.mapInPandas(_mark_batches, "doc_id long, version long, h long, pos long"))
    recurring = found.groupBy("h").agg(
        F.max("doc_id").alias("other"), F.min(F.struct("doc_id", "pos", "version")).alias("first")
    )
    recurring = cut(recurring.select("h", "first.*", "other").where("doc_id <> other").drop("other"))
    shards = max(1, -(-recurring.count() // SHARD))
    shard = F.pmod("h", F.lit(shards)).cast("int")
    # the text of a passage, from the first record that carries it, and there from the text that was marked
    lines = recurring.join(texts, ["doc_id", "version"]).select("h", F.expr(f"substring(text, cast(pos as int) + 1, {PASSAGE})").alias("passage"))
    lines = lines.groupBy("h").agg(F.min("passage").alias("passage")).withColumn("shard", shard)
    asked = found.join(recurring.select("h"), "h", "left_semi").select("doc_id", "version", shard.alias("shard"), F.floor(F.col("pos") / PIECE).alias("piece"))
    asked = cut(asked.distinct())
    sizes = asked.groupBy("shard").agg(F.ceil(F.count("*") * (PIECE + 2 * RUN) / BLOCK_CHARS).cast("int").alias("blocks"))
    sizes = broadcast_if_small(cut(sizes))  # one row per shard
    carriers = asked.groupBy("doc_id", "version").agg(F.collect_list(F.struct("shard", "piece")).alias("wanted"))
    load = texts.join(carriers, ["doc_id", "version"]).select("doc_id", "text", "wanted")
    load = load.mapInPandas(_pieces, "shard int, doc_id long, start long, skip int, text string")
    placed = load.join(sizes, "shard").withColumn("block", F.pmod(F.xxhash64("doc_id", "start"), "blocks").cast("int")).drop("blocks")
    copies = lines.join(sizes, "shard").select("shard", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "h", "passage")
    return placed.groupBy("shard", "block").cogroup(copies.groupBy("shard", "block")).applyInPandas(
        _locate, "doc_id long, passage long, left int, around string, positions array<long>"
    )


def _locate(pieces: pd.DataFrame, passages: pd.DataFrame) -> pd.DataFrame:
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for h, p in zip(passages["h"], passages["passage"]):
        automaton.add_word(p, h)
    out = []
    side = RUN - PASSAGE
    if len(passages):
        automaton.make_automaton()
        for i, begin, skip, text in zip(pieces["doc_id"], pieces["start"], pieces["skip"], pieces["text"]):
            alike: dict[tuple[int, int, str], list[int]] = {}
            for end, h in automaton.iter(text):
                at = end - PASSAGE + 1
                if skip <= at < skip + PIECE:
                    start = max(0, at - side)
                    alike.setdefault((h, at - start, text[start : end + 1 + side]), []).append(begin - skip + at)
            out += [(i, *key, where) for key, where in alike.items()]
    return pd.DataFrame(out, columns=["doc_id", "passage", "left", "around", "positions"])


_REACH = T.StructType([T.StructField("left", T.IntegerType()), T.StructField("right", T.IntegerType())])


def _common_start(a: str, b: str) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if a[:mid] == b[:mid] else (low, mid)
    return low


@F.pandas_udf(_REACH)
def _reach(left_a: pd.Series, a: pd.Series, left_b: pd.Series, b: pd.Series) -> pd.DataFrame:
    """How far two surroundings agree to the left and to the right of their passage."""
    rows = [(_common_start(x[:i][::-1], y[:j][::-1]), _common_start(x[i:], y[j:]) - PASSAGE) for i, x, j, y in zip(left_a, a, left_b, b)]
    return pd.DataFrame(rows, columns=["left", "right"])


def _class_id() -> Column:
    return F.xxhash64("passage", "left", "around")


def class_links(places: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links (x, y, left, right) of classes of surroundings, and the stretches (key, x, left, low, high) of crowded passages.

    A link says that the common run of x <= y is long enough and how far it reaches; ``x = y`` stands for a class by itself.
    Passages with more than ``FEW`` classes get stretches instead of links between classes: ``key`` is one stretch of the wanted
    length, ``low`` and ``high`` are the least and the greatest record among all that carry it.
    """
    classes = places.groupBy("passage", "left", "around").agg(F.min("doc_id").alias("one"), F.max("doc_id").alias("two"))
    classes = cut(classes.withColumn("x", _class_id()).withColumn("several", F.col("one") != F.col("two")))
    counts = classes.groupBy("passage").agg(F.count("*").alias("n"))
    alone = classes.where(F.col("several") & (F.length("around") >= RUN)).select(
        "x", F.col("x").alias("y"), "left", (F.length("around") - F.col("left") - PASSAGE).alias("right")
    )
    few = classes.join(counts.where(f"n between 2 and {FEW}").select("passage"), "passage", "left_semi")
    a, b = few.alias("a"), few.alias("b")
    pairs = a.join(b, (F.col("a.passage") == F.col("b.passage")) & (F.col("a.x") < F.col("b.x")))
    reach = _reach.asNondeterministic()(F.col("a.left"), F.col("a.around"), F.col("b.left"), F.col("b.around"))
    linked = pairs.select(F.col("a.x").alias("x"), F.col("b.x").alias("y"), reach.alias("r")).where(F.col("r.left") + F.col("r.right") + PASSAGE >= RUN)
    linked = linked.select("x", "y", "r.left", "r.right")
    many = classes.join(counts.where(f"n > {FEW}").select("passage"), "passage", "left_semi")
    starts = F.sequence(F.lit(0), F.length("around") - RUN)
    stretch = many.where(F.length("around") >= RUN).select("passage", "x", "left", "around", "one", "two", F.explode(starts).alias("s"))
    stretch = stretch.select(
        "passage", "x", "one", "two", (F.col("left") - F.col("s")).alias("left"), F.substring(F.col("around"), F.col("s") + 1, F.lit(RUN)).alias("t")
    ).where(f"left between 0 and {RUN - PASSAGE}")
    keyed = stretch.withColumn("key", F.xxhash64("passage", "left", "t")).select("key", "x", "left", "one", "two")
    carriers = keyed.groupBy("key").agg(F.min("one").alias("low"), F.max("two").alias("high"))
    stretches = keyed.select("key", "x", "left").join(carriers.where("low <> high"), "key")
    return alone.unionByName(linked), stretches


def sharing_pairs(places: DataFrame) -> DataFrame:
    """(doc_id_a, doc_id_b), a < b: every pair of records with a common run of at least ``RUN`` characters."""
    links, stretches = class_links(places)
    members = places.select(_class_id().alias("x"), "doc_id").distinct()
    a = members.withColumnRenamed("doc_id", "p")
    b = members.select(F.col("x").alias("y"), F.col("doc_id").alias("q"))
    direct = links.select("x", "y").distinct().join(a, "x").join(b, "y").select("p", "q")
    # passages with many classes: records that carry the same stretch
    carried = stretches.select("key", "x").join(a, "x").select("key", "p").distinct()
    again = carried.select("key", F.col("p").alias("q"))
    shared = carried.join(again, "key").where("p < q").select("p", "q")
    both = direct.unionByName(shared).where("p <> q")
    return both.select(F.least("p", "q").alias("doc_id_a"), F.greatest("p", "q").alias("doc_id_b")).distinct()


def shared_cover(documents: DataFrame, places: DataFrame) -> DataFrame:
    """(doc_id, n_chars, shared_chars, share): how much of each text lies in runs that other records have too.

    Every record comes out; a null text has length 0. A run that only the record itself repeats does not count.
    """
    links, stretches = class_links(places)
    both = links.select("x", "y", "left", "right").unionByName(links.select(F.col("y").alias("x"), F.col("x").alias("y"), "left", "right"))
    owners = places.select(_class_id().alias("x"), "doc_id").distinct().groupBy("x").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    partner = both.distinct().join(owners.select(F.col("x").alias("y"), "low", "high"), "y")
    at = places.select(_class_id().alias("x"), "doc_id", "positions")
    here = at.join(partner, "x").where("low <> doc_id or high <> doc_id")
    # a stretch of two records or more counts at each of its places; those of a class all hold the passage, so their union is one run
    reach = stretches.groupBy("x").agg(F.max("left").alias("left"), (F.lit(RUN - PASSAGE) - F.min("left")).alias("right"))
    here = here.select("doc_id", "positions", "left", "right").unionByName(at.join(reach, "x").select("doc_id", "positions", "left", "right"))
    here = here.select("doc_id", F.explode("positions").alias("pos"), "left", "right")
    spans = here.select("doc_id", (F.col("pos") - F.col("left")).alias("s"), (F.col("pos") + PASSAGE + F.col("right")).alias("e")).distinct()
    order = Window.partitionBy("doc_id").orderBy("s", "e")
    ahead = spans.withColumn("done", F.coalesce(F.max("e").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    fresh = F.greatest(F.col("e") - F.greatest("s", "done"), F.lit(0))
    covered = ahead.withColumn("fresh", fresh).groupBy("doc_id").agg(F.sum("fresh").alias("shared_chars"))
    base = documents.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.coalesce(F.max(F.length("text")), F.lit(0)).cast("long").alias("n_chars"))
    out = base.join(covered, "doc_id", "left").withColumn("shared_chars", F.coalesce("shared_chars", F.lit(0)))
    return out.withColumn("share", F.when(F.col("n_chars") > 0, F.col("shared_chars") / F.col("n_chars")).otherwise(0.0))
