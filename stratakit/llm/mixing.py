"""Mixing sources to target weights by weighted fair queueing.

Every source's records are put in a shuffled order. A record's virtual finish time is the tokens its source has sent up to and
including it, divided by the source's weight; a further pass over a source goes on where the last ended. Sorting all
records by finish time interleaves the sources in proportion, and one running total over this order, cut at the budget, leaves
each source within one record of its share. A pass is a use, so no record is used more often than the source allows. A source
that has used up its passes sends no more; the others go on, and the report names the shortfall.

Without a given budget it is the largest at which no source runs dry: the least, over the sources that have tokens, of tokens
times uses over weight. The scarcest source so bounds the whole mixture; ``shares`` names it and the text it keeps out. Sources
without tokens cannot contribute: their weight is shared out in proportion and the report says so.

Scale: the order is a range sort, running totals are taken within its partitions and then over one row per partition. Only uses that can
come before the cut are formed: they finish by the virtual time at which the sources have sent the budget and one more record each.

Edge cases: records with a null source, a source without target, or no tokens are left out; a target that is null or not above
zero, or fewer than one use, takes nothing; with no usable source the mixture is empty; repeated targets of a source add up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratakit.session import broadcast_if_small, cut

#: Records per stretch of a source's shuffled order; running totals are taken within stretches and then over them.
STRETCH = 50_000
#: Most target sources; their supplies, one row each, are read on the driver.
MOST_SOURCES = 100_000


def supplies(records: DataFrame, targets: DataFrame) -> DataFrame:
    """Per target source: weight among the sources that have tokens (null for the others), supply, uses allowed."""
    wanted = targets.where("source is not null and target_share > 0 and max_repeats >= 1").groupBy("source").agg(
        F.sum("target_share").alias("target_share"), F.min("max_repeats").alias("uses")
    )
    have = records.where("tokens > 0").groupBy("source").agg(F.sum("tokens").alias("supply"), F.count("*").alias("n"), F.max("tokens").alias("longest"))
    both = wanted.join(have, "source", "left")
    present = both.agg(F.sum(F.when(F.col("supply") > 0, F.col("target_share")))).head()[0]
    return both.withColumn("weight", F.when(F.col("supply") > 0, F.col("target_share") / F.lit(present)))


def full_budget(supply: DataFrame) -> float:
    """The largest budget at which every source that has tokens can meet its weight."""
    least = supply.agg(F.min(F.col("supply") * F.col("uses") / F.col("weight"))).head()[0]
    return float(least or 0.0)


def latest_finish(usable: list, budget: float) -> float:
    """The virtual time by which the sources (weight, supply, uses, longest) have sent the budget, whatever the order inside each.

    A source sends its weight per unit of time until it runs dry; up to one record of each may be under way.
    """
    wanted = budget + sum(r["longest"] for r in usable)
    sent, now, rate = 0.0, 0.0, sum(r["weight"] for r in usable)
    for r in sorted(usable, key=lambda r: r["supply"] * r["uses"] / r["weight"]):
        dry = r["supply"] * r["uses"] / r["weight"]
        if sent + rate * (dry - now) >= wanted:
            break
        sent, now, rate = sent + rate * (dry - now), dry, rate - r["weight"]
    return now + max(0.0, wanted - sent) / rate if rate > 1e-12 else now


def mix(records: DataFrame, targets: DataFrame, budget: float | None = None, seed: int = 17) -> DataFrame:
    """(position, doc_id, source, use, tokens, finish) in the order of the mixture. ``records``: doc_id, source, tokens."""
    known = cut(records.select("doc_id", "source", F.col("tokens").cast("long").alias("tokens")).where("tokens > 0 and source is not null"))
    supply = cut(supplies(known, targets))
    limit = full_budget(supply) if budget is None else float(budget)
    usable = supply.where("weight is not null").select("source", "weight", "supply", "uses", "n", "longest")
    few = usable.head(MOST_SOURCES + 1)
    if len(few) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} target sources")
    stretches = F.greatest(F.ceil(F.col("n") / STRETCH), F.lit(1)).cast("int")
    placed = known.join(broadcast_if_small(usable), "source").withColumn("h", F.xxhash64("doc_id", F.lit(seed)))
    # stretches follow the order of h: its upper 31 bits, scaled to the number of stretches
    upper = F.shiftrightunsigned("h", 33)
    placed = placed.withColumn("stretch", F.shiftright(upper * stretches, 31).cast("int"))
    within = Window.partitionBy("source", "stretch").orderBy(F.shiftrightunsigned("h", 1), "doc_id", "tokens").rowsBetween(Window.unboundedPreceding, 0)
    sums = placed.groupBy("source", "stretch").agg(F.sum("tokens").alias("t"))
    before = sums.withColumn(
        "before", F.coalesce(F.sum("t").over(Window.partitionBy("source").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).drop("t")
    summed = placed.withColumn("run", F.sum("tokens").over(within)).join(before, ["source", "stretch"])
    sent = F.col("run") + F.col("before")
    latest = F.lit(latest_finish(few, limit))
    passes = F.least(F.floor((latest * F.col("weight") - sent) / F.col("supply")) + 1, F.col("uses")).cast("int")
    used = summed.withColumn("sent", sent).withColumn("passes", passes).where("passes >= 1")
    used = used.withColumn("use", F.explode(F.sequence(F.lit(1), F.col("passes"))))
    finish = (F.col("sent") + (F.col("use") - 1) * F.col("supply")) / F.col("weight")
    order = ["finish", "source", "doc_id", "use", "sent"]
    ordered = used.select("doc_id", "source", "use", "tokens", finish.alias("finish"), "sent").repartitionByRange(*order)
    ordered = cut(ordered.withColumn("part", F.spark_partition_id()))
    running = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    parts = ordered.groupBy("part").agg(F.sum("tokens").alias("t"), F.count("*").alias("k"))  # one row per partition
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("part", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in ("t", "k")])
    summed = ordered.withColumn("total", F.sum("tokens").over(running)).withColumn("place", F.row_number().over(running))
    summed = summed.join(broadcast_if_small(offsets), "part")
    kept = summed.where(F.col("total") + F.col("t_before") <= F.lit(limit + 1e-6))
    return kept.select((F.col("place") + F.col("k_before")).alias("position"), "doc_id", "source", "use", "tokens", "finish").orderBy("position")


def shares(mixed: DataFrame, targets: DataFrame, records: DataFrame, budget: float | None = None) -> DataFrame:
    """Per target source the target and actual share, tokens, records and uses in the mixture, and what kept it from its share.

    ``budget`` is that of the mixture. ``supply`` and ``unused_tokens`` count a source's text once: all of it, and what no use
    has taken; ``shortfall`` is what the source lacks of its share of the budget. ``limits_budget`` marks the sources that run dry
    first and so set the default budget.
    """
    total = mixed.agg(F.sum("tokens")).head()[0]
    per = mixed.groupBy("source").agg(
        F.sum("tokens").alias("tokens"), F.count("*").alias("records"), F.max("use").alias("most_uses"), F.sum(F.when(F.col("use") == 1, F.col("tokens"))).alias("taken")
    )
    supply = cut(supplies(records.where("source is not null"), targets))
    full = full_budget(supply)
    limits = F.coalesce(F.col("supply") * F.col("uses") / F.col("weight") <= F.lit(full), F.lit(False)) if budget is None else F.lit(False)
    asked = full if budget is None else float(budget)
    out = supply.join(per, "source", "left")
    return out.select(
        "source", "target_share", (F.coalesce("tokens", F.lit(0)) / F.lit(total)).alias("actual_share"), F.coalesce("tokens", F.lit(0)).alias("tokens"),
        F.coalesce("records", F.lit(0)).alias("records"), F.coalesce("most_uses", F.lit(0)).alias("most_uses"), F.col("uses").alias("uses_allowed"),
        F.coalesce("supply", F.lit(0)).alias("supply"), (F.coalesce("supply", F.lit(0)) - F.coalesce("taken", F.lit(0))).alias("unused_tokens"),
        F.greatest(F.col("target_share") * F.lit(asked) - F.coalesce("tokens", F.lit(0)), F.lit(0.0)).alias("shortfall"), F.lit(asked).alias("budget"), limits.alias("limits_budget"),
        F.when(F.col("weight").isNull(), "no tokens in this source").when(limits, "runs dry first and limits the budget").when(
            F.col("supply") * F.col("uses") < F.col("weight") * F.lit(asked), "runs dry before its share of the budget").alias("remark"),
    )


def violations(mixed: DataFrame, targets: DataFrame, records: DataFrame) -> DataFrame:
    """Per target source the uses allowed and its records with tokens, and how often a rule is broken: records used more often than
    allowed, and uses of texts of another size or source. Both are zero in a sound mixture."""
    wanted = targets.where("source is not null and target_share > 0 and max_repeats >= 1").groupBy("source").agg(F.min("max_repeats").alias("uses_allowed"))
    known = records.where("tokens > 0").groupBy("doc_id", "source", "tokens").agg(F.count("*").alias("copies"))
    used = mixed.groupBy("doc_id", "source", "tokens").agg(F.count("*").alias("uses"))
    both = known.join(used, ["doc_id", "source", "tokens"], "full").join(broadcast_if_small(wanted), "source", "left")
    per = both.groupBy("source").agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("records"), F.count_if(F.col("uses") > F.col("uses_allowed") * F.col("copies")).alias("overused"),
        F.count_if(F.col("copies").isNull()).alias("unknown"),
    )
    out = wanted.join(per, "source", "left")
    return out.select("source", "uses_allowed", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("records", "overused", "unknown")])
