"""Filling containers of fixed capacity by swap-based local search.

Items larger than the capacity are split into full pieces, each a container of its own, and a rest. Everything else is packed
in random blocks of bounded size, so the work is spread over any number of tasks. A block starts with every item in a container
of its own and local search does all the rest: the fullest container with room takes an item from another, or, when none fits,
exchanges one for one, two for one or one for two, whenever that raises the sum of squared fills. It takes what leaves it least
room, from the emptiest container that has it, until no such exchange exists between any two containers of the block; containers
that run empty are gone. The neighbourhood is whole: items and sums of two are found by size, so no partner and no item is left
out. Containers that stay underfull after a round are dissolved and packed again in blocks mixed anew.

Edge cases: an item of size zero goes with the others of its block at no cost; a null size counts as zero; a null id is an id
like any other; repeated items are separate items; a capacity that is null or below one takes nothing.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratakit.session import cut

#: Items per block, and the fill below which a container is packed again in the next round.
BLOCK_ITEMS, KEEP_FILL, ROUNDS = 4000, 0.995, 3
#: Kinds of container in one call; each item is packed once for each.
MOST_KINDS = 100
#: Most items of a container whose sums of two are listed; those of a larger one are searched by two pointers, with the same result.
LISTED = 64


class _BySize:
    """Entries (container, item, ...) found by size, the largest size up to a bound first."""

    def __init__(self) -> None:
        self.entries: dict[int, set[tuple[int, ...]]] = {}
        self.sizes: list[int] = []

    def add(self, size: int, entry: tuple[int, ...]) -> None:
        there = self.entries.get(size)
        if there is None:
            self.entries[size] = {entry}
            insort(self.sizes, size)
        else:
            there.add(entry)

    def remove(self, size: int, entry: tuple[int, ...]) -> None:
        there = self.entries[size]
        there.remove(entry)
        if not there:
            del self.entries[size]
            del self.sizes[bisect_left(self.sizes, size)]


class Bins:
    """Containers of one block. Those with room are listed by the sizes of their items and by the sums of any two."""

    def __init__(self, sizes: np.ndarray, capacity: int) -> None:
        self.capacity = capacity
        self.size = [int(s) for s in sizes]
        self.items: list[set[int]] = [{i} for i, s in enumerate(self.size) if s]
        self.fill = [s for s in self.size if s]
        self.one, self.two = _BySize(), _BySize()
        self.large: set[int] = set()  # containers whose sums are not listed
        for b in range(len(self.fill)):
            self._list(b)

    def _list(self, b: int) -> None:
        inside = sorted(self.items[b])
        for i in inside:
            self.one.add(self.size[i], (b, i))
        if len(inside) > LISTED:
            self.large.add(b)
            return
        for i, j in combinations(inside, 2):
            self.two.add(self.size[i] + self.size[j], (b, i, j))

    def _unlist(self, b: int) -> None:
        inside = sorted(self.items[b])
        for i in inside:
            self.one.remove(self.size[i], (b, i))
        if b in self.large:
            self.large.remove(b)
            return
        for i, j in combinations(inside, 2):
            self.two.remove(self.size[i] + self.size[j], (b, i, j))

    def _put(self, b: int, i: int) -> None:
        self.one.add(self.size[i], (b, i))
        if b not in self.large:
            for j in self.items[b]:
                self.two.add(self.size[i] + self.size[j], (b, *sorted((i, j))))
        self.items[b].add(i)
        self.fill[b] += self.size[i]

    def _take(self, b: int, i: int) -> None:
        self.items[b].remove(i)
        self.fill[b] -= self.size[i]
        self.one.remove(self.size[i], (b, i))
        if b not in self.large:
            for j in self.items[b]:
                self.two.remove(self.size[i] + self.size[j], (b, *sorted((i, j))))

    def _largest(self, listed: _BySize, a: int, given: int, least: int) -> tuple[int, tuple[int, ...]] | None:
        """(gain, entry) of the largest entry that ``a`` can take for ``given``, gaining more than ``least`` and raising the squared fill.

        An exchange of gain d with a donor b raises it exactly when ``a`` ends fuller than b was.
        """
        fill, full, sizes = self.fill, self.fill[a], listed.sizes
        at = bisect_right(sizes, given + self.capacity - full) - 1
        while at >= 0 and (gain := sizes[at] - given) > least:
            donor = min(((fill[e[0]], e) for e in listed.entries[sizes[at]] if e[0] != a and fill[e[0]] < full + gain), default=None)
            if donor is not None:
                return gain, donor[1]
            at -= 1
        return None

    def _largest_two(self, a: int, given: int, least: int) -> tuple[int, tuple[int, ...]] | None:
        """The same for two items of a container whose sums are not listed."""
        best: tuple[int, tuple[int, ...]] | None = None
        most = given + self.capacity - self.fill[a]
        for b in sorted(self.large - {a}, key=lambda b: (self.fill[b], b)):
            by = sorted((self.size[i], i) for i in self.items[b])
            low, high = 0, len(by) - 1
            while low < high:
                both = by[low][0] + by[high][0]
                if both > most:
                    high -= 1
                    continue
                gain = both - given
                if gain > (best[0] if best else least) and self.fill[b] < self.fill[a] + gain:
                    best = gain, (b, by[low][1], by[high][1])
                low += 1
        return best

    def best_exchange(self, a: int) -> tuple[int, tuple[int, ...], tuple[int, ...]] | None:
        """(gain, donor and its items, items handed to it): the best move if there is one, else the best exchange; None if nothing
        raises the squared fill."""
        if found := self._largest(self.one, a, 0, 0):
            return *found, ()
        size, free = self.size, self.capacity - self.fill[a]
        best: tuple[int, tuple[int, ...], tuple[int, ...]] | None = None
        own = {size[i]: (i,) for i in sorted(self.items[a], reverse=True)}
        hand = sorted(own.items())
        pairs: dict[int, tuple[int, ...]] = {}

        def offers() -> Iterator[tuple[tuple[int, tuple[int, ...]] | None, tuple[int, ...]]]:
            least = lambda: best[0] if best else 0
            for given, giving in hand:
                yield self._largest(self.one, a, given, least()), giving
            for given, giving in [(0, ()), *hand]:
                yield self._largest(self.two, a, given, least()), giving
            for i, j in combinations(sorted(self.items[a]), 2):
                pairs.setdefault(size[i] + size[j], (i, j))
            for given, giving in pairs.items():
                yield self._largest(self.one, a, given, least()), giving
            if self.large - {a}:
                for given, giving in [(0, ()), *hand]:
                    yield self._largest_two(a, given, least()), giving

        for found, giving in offers():
            if found:
                best = *found, giving
                if best[0] == free:
                    break
        return best

    def exchange(self, a: int, entry: tuple[int, ...], giving: tuple[int, ...]) -> None:
        b, *taken = entry
        for i in taken:
            self._take(b, i)
        for i in giving:
            self._take(a, i)
            self._put(b, i)
        for i in taken:
            self._put(a, i)
        if self.fill[a] == self.capacity:
            self._unlist(a)
        for x in (a, b):  # a container has grown beyond what is listed, or shrunk below
            if self.fill[x] < self.capacity and (len(self.items[x]) > LISTED) != (x in self.large):
                self._unlist(x)
                self._list(x)

    def improve(self) -> None:
        """Local search: the fullest containers with room first, until no exchange raises the squared fill."""
        changed = True
        while changed:
            changed = False
            for a in sorted((b for b in range(len(self.fill)) if 0 < self.fill[b] < self.capacity), key=lambda b: (-self.fill[b], b)):
                while 0 < self.fill[a] < self.capacity and (found := self.best_exchange(a)):
                    self.exchange(a, found[1], found[2])
                    changed = True

    def where(self) -> np.ndarray:
        """Container per item; items of size zero go to the first that holds anything."""
        first = next((b for b, f in enumerate(self.fill) if f), 0)
        out = np.full(len(self.size), first, dtype=np.int64)
        for b, inside in enumerate(self.items):
            out[list(inside)] = b
        return out


def pack_block(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(container per item, fill per container) for one block."""
    bins = Bins(sizes, capacity)
    bins.improve()
    return bins.where(), np.array(bins.fill or [0], dtype=np.int64)


def _packer(round_: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["item", "piece"], kind="stable")
        where, fill = pack_block(pdf["tokens"].to_numpy(), int(pdf["capacity_tokens"].iloc[0]))
        name = f"{pdf['container'].iloc[0]}-{round_}-{pdf['block'].iloc[0]}-"
        kept = pdf[["container", "capacity_tokens", "item", "doc_id", "piece", "tokens"]]
        return kept.assign(bin=[name + str(b) for b in where], fill=fill[where])

    return pack


_ITEM = "container string, capacity_tokens int, item long, doc_id long, piece int, tokens long, bin string, fill long"


def pack(items: DataFrame, containers: DataFrame) -> DataFrame:
    """(container, capacity_tokens, doc_id, piece, tokens, bin, fill): every piece of every item, once per kind of container.

    ``items``: doc_id, tokens. ``containers``: container, capacity_tokens (at most ``MOST_KINDS``; every item is
    packed once for each).
    """
    kinds = containers.where("capacity_tokens >= 1").select("container", F.col("capacity_tokens").cast("int")).distinct().head(MOST_KINDS + 1)
    if len(kinds) > MOST_KINDS:
        raise ValueError(f"more than {MOST_KINDS} kinds of container")
    sizes = cut(items.select("doc_id", F.coalesce(F.col("tokens"), F.lit(0)).cast("long").alias("tokens")))
    # rows are items whatever their ids; the written table's partitions give them numbers of their own
    sizes = cut(sizes.withColumn("item", F.monotonically_increasing_id()))
    choices = F.array(*[F.struct(F.lit(c).cast("string").alias("container"), F.lit(n).alias("capacity_tokens")) for c, n in sorted(kinds, key=str)])
    if not kinds:
        choices = F.array().cast("array<struct<container:string,capacity_tokens:int>>")
    per_kind = sizes.select("item", "doc_id", "tokens", F.inline(choices))
    cap = F.col("capacity_tokens")
    pieces = per_kind.withColumn("piece", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("tokens") / cap), F.lit(1)) - 1).cast("array<int>")))
    pieces = pieces.withColumn("tokens", F.least(F.col("tokens") - F.col("piece") * cap, cap.cast("long")))
    pieces = pieces.select("container", cap, "item", "doc_id", "piece", "tokens")
    name = F.concat_ws("-", "container", F.lit("full"), "item", "piece")
    done = pieces.where(F.col("tokens") == cap).withColumn("bin", name).withColumn("fill", cap.cast("long"))
    rest = pieces.where(F.col("tokens") < cap)
    for r in range(ROUNDS):
        blocks = max(1, -(-rest.count() // (BLOCK_ITEMS * max(1, len(kinds)))))
        spread = rest.withColumn("block", F.pmod(F.xxhash64("item", "piece", F.lit(r)), F.lit(blocks)).cast("int"))
        packed = cut(spread.groupBy("container", "block").applyInPandas(_packer(r), _ITEM))
        last = r == ROUNDS - 1 or blocks == 1
        kept = packed if last else packed.where(F.col("fill") >= F.col("capacity_tokens") * KEEP_FILL)
        done = done.unionByName(kept)
        if last:
            break
        rest = packed.where(F.col("fill") < F.col("capacity_tokens") * KEEP_FILL).drop("bin", "fill")
    return done.drop("item")


def summary(packed: DataFrame) -> DataFrame:
    """Per container: bins, pieces, tokens, mean fill, the fewest bins that could hold them, and the squared fill (fills as shares of the
    capacity) before the search, with every piece alone, and after it."""
    square = lambda c: F.sum(F.pow(F.col(c) / F.col("capacity_tokens"), F.lit(2)))
    kind = ["container", "capacity_tokens"]
    per_bin = packed.groupBy(*kind, "bin").agg(
        F.sum("tokens").alias("held"), F.count("*").alias("pieces"), square("tokens").alias("alone")
    )
    return per_bin.groupBy(*kind).agg(
        F.count("*").alias("bins"), F.sum("pieces").alias("pieces"), F.sum("held").alias("tokens"),
        (F.sum("held") / (F.count("*") * F.col("capacity_tokens"))).alias("mean_fill"),
        F.ceil(F.sum("held") / F.col("capacity_tokens")).alias("fewest_bins"), F.max("held").alias("fullest"),
        F.sum("alone").alias("squared_before"), square("held").alias("squared_after"),
    )


def violations(packed: DataFrame, items: DataFrame) -> DataFrame:
    """Per container: items, and how many containers are overfull, items incomplete, and items split although they fit.

    For items with distinct ids; the three last are zero in a sound packing.
    """
    kind = ["container", "capacity_tokens"]
    per_bin = packed.groupBy(*kind, "bin").agg(F.sum("tokens").alias("held"))
    over = per_bin.groupBy(*kind).agg(F.count_if(F.col("held") > F.col("capacity_tokens")).alias("overfull"))
    whole = packed.groupBy(*kind, "doc_id").agg(F.sum("tokens").alias("packed"), F.count("*").alias("pieces"))
    sizes = items.select(F.col("doc_id").alias("of"), F.coalesce("tokens", F.lit(0)).alias("size"))
    seen = whole.join(sizes, F.col("doc_id").eqNullSafe(F.col("of")), "full")
    fewest = F.greatest(F.ceil(F.col("size") / F.col("capacity_tokens")), F.lit(1))
    items_ = seen.groupBy(*kind).agg(
        F.count("*").alias("items"), F.count_if(~F.col("packed").eqNullSafe(F.col("size"))).alias("incomplete"),
        F.count_if(F.col("pieces") > fewest).alias("split_needlessly"),
    )
    return items_.join(over, kind, "full")
