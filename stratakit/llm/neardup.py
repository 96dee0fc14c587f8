"""Near-duplicate records by Golay-code fuzzy hashing.

A record is the set of its rows. Its fingerprint has ``SEGMENTS`` segments. A segment holds 23 bits, bit k of which is one bit of
the k-th minimum hash over the rows, so that two records with similarity J differ in about (1-J)/2 of them, and an *anchor*, one
more minimum hash, which similar records share with probability J. The 23 bits are decoded to the nearby Golay codeword
indices, several keys each; a key is segment, anchor and index.

What the code contributes. Words at most two bits apart share an index for certain, but at J = 0.6 a segment has 4.6 errors on average,
too many for any pigeonhole over 23-bit segments; it then shares an index with probability 0.43 (0.60 at 0.7, 0.81 at 0.8). An index
alone has twelve bits: two unrelated words share one with probability 0.007, so candidates would grow with the square of the
records. The anchor therefore carries the selection, and the indices prune what it lets meet. Over 20 segments a pair is missed with
probability 0.003 (J = 0.6), 0.0002 (0.65), under 0.00002 (0.7 and up). Candidates are verified with exact row counts.

Scale: records with equal row sets are one class before any key is made. A record with very many rows (``hot``) is reduced to
partial minima where its rows are read and never gathered. Keys are joined, never grouped into lists. A key that more than ``CROWD``
classes share (a row that very many records have as their minimum) is not paired out: its members meet again under that key
together with each of their other anchors. A similar pair shares none of these with probability 0.4^19 or less at J = 0.6. Only
classes that have two minima of 20 in common, and so are likely to be similar, are then paired whatever their number.

Edge cases: rows compare null-safe, 0.0 equals -0.0 and NaN equals NaN; repeated rows count once; a record without rows is
no record; rows with a null record id are ignored; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratakit.llm import golay
from stratakit.session import broadcast_if_small, cut

SEGMENTS = 20
#: A record is hot from this many rows on, or from a 5,000th of all rows, whichever is more: at most 5,000 are.
HOT_ROWS, HOT_SHARE = 200_000, 5_000

_FUNCTIONS = SEGMENTS * (golay.LENGTH + 1)
_RNG = np.random.default_rng(20_240_229)
_FACTORS = _RNG.integers(0, 1 << 31, _FUNCTIONS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_OFFSETS = _RNG.integers(0, 1 << 32, _FUNCTIONS, dtype=np.uint32)
#: Classes that share a key and are still paired directly; larger groups are refined by a further anchor.
CROWD = 200
#: Rows hashed at a time; bounds the working memory of a task.
_STEP = 4096


def row_hash(columns: Sequence[str], types: dict[str, str]) -> Column:
    """64-bit hash of a row that tells nulls apart from values."""
    parts: list[Column] = []
    for c in columns:
        v = F.col(c) + F.lit(0.0) if types[c] in ("double", "float") else F.col(c)
        parts += [v, F.col(c).isNull()]
    return F.xxhash64(*parts)


def minima(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Minimum of every hash function over each run of rows; runs begin at ``starts`` (starts[0] == 0)."""
    folded = (hashes.view(np.uint64) >> np.uint64(32)).astype(np.uint32) ^ hashes.view(np.uint64).astype(np.uint32)
    out = np.empty((len(starts), _FUNCTIONS), dtype=np.uint32)
    ends = np.append(starts[1:], len(folded))
    at = 0
    while at < len(starts):
        # as many whole runs as fit into a step, at least one
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + _STEP, side="right")))
        x = folded[starts[at] : ends[to - 1]]
        best = None
        for k in range(0, len(x), _STEP):
            h = x[k : k + _STEP, None] * _FACTORS + _OFFSETS
            h ^= h >> np.uint32(15)
            if to - at == 1:
                m = h.min(axis=0)
                best = m if best is None else np.minimum(best, m)
            else:
                out[at:to] = np.minimum.reduceat(h, starts[at:to] - starts[at], axis=0)
        if best is not None:
            out[at] = best
        at = to
    return out


def fingerprint_keys(mins: np.ndarray) -> list[np.ndarray]:
    """Per record the join keys: segment (5 bits), anchor (32 bits), codeword index (12 bits)."""
    n = len(mins)
    anchor = mins[:, :SEGMENTS].astype(np.int64)
    bits = (mins[:, SEGMENTS:] * np.uint32(0x9E3779B1)) >> np.uint32(31)
    words = (bits.reshape(n, SEGMENTS, golay.LENGTH) << np.arange(golay.LENGTH, dtype=np.uint32)).sum(axis=2, dtype=np.uint32)
    index, fresh = golay.keys(words)
    key = (np.arange(SEGMENTS, dtype=np.int64)[None, :, None] << 44) | (anchor[:, :, None] << 12) | index.astype(np.int64)
    return [k[f] for k, f in zip(key.reshape(n, -1), fresh.reshape(n, -1))]


_SKETCH = "id long, n long, x1 long, x2 long, mins binary"
_KEYED = "id long, n long, x1 long, x2 long, keys array<long>"


def _second(hashes: np.ndarray) -> np.ndarray:
    """Another 64-bit hash of the same row, to tell classes apart by 128 bits."""
    z = hashes.view(np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
    z ^= z >> np.uint64(27)
    z *= np.uint64(0x94D049BB133111EB)
    return (z ^ (z >> np.uint64(31))).view(np.int64)


def _runs(ids: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct rows of sorted input, summed up per id: (ids, n, x1, x2, minima)."""
    fresh = np.ones(len(ids), dtype=bool)
    fresh[1:] = (ids[1:] != ids[:-1]) | (hashes[1:] != hashes[:-1])
    ids, hashes = ids[fresh], hashes[fresh]
    starts = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
    n = np.diff(np.append(starts, len(ids)))
    return ids[starts], n, np.bitwise_xor.reduceat(hashes, starts), np.bitwise_xor.reduceat(_second(hashes), starts), minima(hashes, starts)


def _key_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (id, h) rows to keyed records; the last id of a batch waits for the next batch."""
    wait_i, wait_h = np.empty(0, np.int64), np.empty(0, np.int64)

    def out(ids: np.ndarray, hashes: np.ndarray) -> pa.RecordBatch:
        i, n, x1, x2, m = _runs(ids, hashes)
        keys = fingerprint_keys(m)
        offsets = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(keys)))
        return pa.RecordBatch.from_arrays([pa.array(i), pa.array(n), pa.array(x1), pa.array(x2), lists], ["id", "n", "x1", "x2", "keys"])

    for b in batches:
        ids = np.concatenate([wait_i, b.column(0).to_numpy(zero_copy_only=False)])
        hashes = np.concatenate([wait_h, b.column(1).to_numpy(zero_copy_only=False)])
        if not len(ids):
            continue
        last = int(np.searchsorted(ids, ids[-1]))
        if last:
            yield out(ids[:last], hashes[:last])
        wait_i, wait_h = ids[last:], hashes[last:]
    if len(wait_i):
        yield out(wait_i, wait_h)


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct (id, h) rows in any order to partial sketches, one per id and task."""
    kept: dict[int, list] = {}
    for b in batches:
        ids, hashes = b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)
        if not len(ids):
            continue
        order = np.lexsort((hashes, ids))
        for i, n, x1, x2, m in zip(*_runs(ids[order], hashes[order])):
            old = kept.get(int(i))
            kept[int(i)] = [n, x1, x2, m] if old is None else [old[0] + n, old[1] ^ x1, old[2] ^ x2, np.minimum(old[3], m)]
    if kept:
        cols = list(zip(*kept.values()))
        mins = pa.array([m.tobytes() for m in cols[3]], pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(kept), pa.int64()), *[pa.array([int(v) for v in c], pa.int64()) for c in cols[:3]], mins],
            ["id", "n", "x1", "x2", "mins"],
        )


def _merge_sketches(pdf: pd.DataFrame) -> pd.DataFrame:
    mins = np.minimum.reduce([np.frombuffer(m, np.uint32) for m in pdf["mins"]])
    return pd.DataFrame({
        "id": pdf["id"].iloc[:1], "n": [pdf["n"].sum()], "x1": [np.bitwise_xor.reduce(pdf["x1"].to_numpy())],
        "x2": [np.bitwise_xor.reduce(pdf["x2"].to_numpy())], "keys": fingerprint_keys(mins[None])[:1],
    })


def fingerprints(rows: DataFrame, record: str, columns: Sequence[str]) -> DataFrame:
    """One row per record: id, n distinct rows, x1 and x2 (128 bits that name its set of rows) and its keys."""
    hashed = rows.where(F.col(record).isNotNull()).select(F.col(record).cast("long").alias("id"), row_hash(columns, dict(rows.dtypes)).alias("h"))
    counts = cut(hashed.groupBy("id").agg(F.count("*").alias("rows")))
    total = counts.agg(F.sum("rows")).head()[0] or 0
    hot_ids = counts.where(F.col("rows") >= max(HOT_ROWS, total // HOT_SHARE)).select("id")
    cold = hashed.join(F.broadcast(hot_ids), "id", "left_anti").repartition("id").sortWithinPartitions("id", "h")
    keyed = cold.mapInArrow(_key_batches, _KEYED)
    if hot_ids.isEmpty():
        return keyed
    warm = hashed.join(F.broadcast(hot_ids), "id", "left_semi").distinct()
    return keyed.unionByName(warm.mapInArrow(_sketch_batches, _SKETCH).groupBy("id").applyInPandas(_merge_sketches, _KEYED))


def classes_of(prints: DataFrame) -> DataFrame:
    """(id, rep, n): the records with the class they fall into, named by its smallest id; equal row sets are one class."""
    reps = prints.groupBy("n", "x1", "x2").agg(F.min("id").alias("rep"))
    return prints.select("id", "n", "x1", "x2").join(reps, ["n", "x1", "x2"]).select("id", "rep", "n")


def candidates(prints: DataFrame, threshold: float) -> DataFrame:
    """Distinct pairs (a, b), a < b, of class representatives that share a key and whose sizes allow the threshold."""
    reps = prints.groupBy("n", "x1", "x2").agg(F.min_by("keys", "id").alias("keys"), F.min("id").alias("rep"))
    together = Window.partitionBy("key")
    met = reps.select("rep", "n", F.explode("keys").alias("key")).withColumn("members", F.count("*").over(together))
    met = cut(met.where("members > 1"))
    few, crowded = met.where(F.col("members") <= CROWD), met.where(F.col("members") > CROWD)
    if crowded.isEmpty():
        return _pairs_of(few, threshold).distinct()
    # the anchors of a record are in its keys, each with its segment: both without the codeword index
    anchor = lambda key: F.shiftrightunsigned(key, golay.DATA_BITS)
    anchors = reps.select("rep", F.array_distinct(F.transform("keys", anchor)).alias("anchors"))
    again = crowded.select("rep", "n", "key").join(anchors, "rep").select("rep", "n", "key", F.explode("anchors").alias("anchor"))
    again = again.where(F.col("anchor") != anchor(F.col("key"))).select("rep", "n", F.xxhash64("key", "anchor").alias("key"))
    return _pairs_of(few, threshold).unionByName(_pairs_of(again, threshold)).distinct()


def _pairs_of(met: DataFrame, threshold: float) -> DataFrame:
    a, b = met.alias("a"), met.alias("b")
    size_fits = (F.col("a.n") >= F.col("b.n") * threshold) & (F.col("b.n") >= F.col("a.n") * threshold)
    pairs = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.rep") < F.col("b.rep")) & size_fits)
    return pairs.select(F.col("a.rep").alias("a"), F.col("b.rep").alias("b"), F.col("a.n").alias("na"), F.col("b.n").alias("nb"))


def verify(rows: DataFrame, record: str, columns: Sequence[str], pairs: DataFrame, threshold: float) -> DataFrame:
    """(a, b, similarity) of the pairs (a, b, na, nb) whose exact row sets reach the threshold."""
    asked = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    types = dict(rows.dtypes)
    clean = [(F.col(c) + F.lit(0.0) if types[c] in ("double", "float") else F.col(c)).alias(f"v{k}") for k, c in enumerate(columns)]
    kept = rows.where(F.col(record).isNotNull()).select(F.col(record).cast("long").alias("id"), *clean)
    kept = kept.join(broadcast_if_small(asked), "id", "left_semi").distinct()
    left = kept.join(broadcast_if_small(pairs), F.col("id") == F.col("a")).drop("id").alias("l")
    right = kept.alias("r")
    same = F.col("r.id") == F.col("l.b")
    for k in range(len(columns)):
        same = same & F.col(f"l.v{k}").eqNullSafe(F.col(f"r.v{k}"))
    common = left.join(right, same).groupBy("l.a", "l.b", "l.na", "l.nb").agg(F.count("*").alias("common"))
    similarity = F.col("common") / (F.col("na") + F.col("nb") - F.col("common"))
    return common.select("a", "b", similarity.alias("similarity")).where(F.col("similarity") >= threshold)


def similar_classes(rows: DataFrame, record: str, columns: Sequence[str], threshold: float) -> tuple[DataFrame, DataFrame]:
    """(membership: id, rep, n; links: a, b, similarity between class representatives)."""
    prints = cut(fingerprints(rows, record, columns))
    pairs = cut(candidates(prints, threshold))
    return classes_of(prints), verify(rows, record, columns, pairs, threshold)


def similar_records(membership: DataFrame, links: DataFrame) -> DataFrame:
    """(id_a, id_b), id_a < id_b: every pair of records whose classes are linked or equal."""
    x = membership.select(F.col("id").alias("x"), F.col("rep").alias("a"))
    y = membership.select(F.col("id").alias("y"), F.col("rep").alias("b"))
    across = links.select("a", "b").join(x, "a").join(y, "b").select("x", "y")
    within = x.join(y, (F.col("a") == F.col("b")) & (F.col("x") < F.col("y"))).select("x", "y")
    return across.unionByName(within).select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"))


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable over links (a, b) from each node (id).

    Alternates large-star and small-star steps over the edges until nothing changes; each step is one shuffle by node
    with no list per node, and lineage is cut after every round.
    """
    edges = cut(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        tied = large.join(low, "u")
        small = tied.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(tied.select("u", F.col("m").alias("v")))
        edges = cut(small.where("u <> v").distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head()
        if now == before:
            break
        before = now
    return nodes.join(edges.select(F.col("u").alias("id"), F.col("v").alias("component")), "id", "left").withColumn("component", F.coalesce("component", "id"))
