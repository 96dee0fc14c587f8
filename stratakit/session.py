"""Session helpers shared by every operator: table access, lineage cuts, skew-safe joins, distributed lag."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

#: Most rows, and most bytes of them, that ``broadcast_if_small`` sends to every executor.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 64 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` below ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, or a scratch one of this process when running in local mode without any."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if where:
        return where
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="stratakit-")
    atexit.register(shutil.rmtree, made, ignore_errors=True)
    return made


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder and forget its lineage, so a lost executor costs no recomputation."""
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(os.path.join(_shared_dir(df.sparkSession), "checkpoints"))
    return df.checkpoint(eager=True)


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint when it has at most ``limit`` rows and ``BROADCAST_BYTES`` bytes; otherwise unchanged, so the planner
    shuffles.

    ``df`` should be the result of :func:`cut` or a table, because its rows are measured here. The count stops one
    past the limit.
    """
    fixed = 16 * len(df.columns)
    wide = [F.octet_length(F.to_json(F.struct(F.col(f"`{f.name}`"))) if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)) else F.col(f"`{f.name}`")) for f in df.schema.fields
            if isinstance(f.dataType, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType))]
    width = sum((F.coalesce(w, F.lit(0)) for w in wide), F.lit(fixed))
    n, size = df.limit(limit + 1).agg(F.count("*"), F.coalesce(F.sum(width), F.lit(0))).head()
    return F.broadcast(df) if n <= limit and size <= BROADCAST_BYTES else df


def salted_join(
    big: DataFrame, small: DataFrame, on: Sequence[str], how: str, spread: Sequence[str], salts: int = 8, keep: bool = False
) -> DataFrame:
    """Equi-join that spreads any hot key of ``big`` over ``salts`` partitions.

    ``small`` is replicated ``salts`` times (it should hold one row per key); every row of ``big`` goes to the replica
    that the hash of its ``spread`` columns names, so a retried task salts its rows as before. ``how``: ``inner``,
    ``left``, ``left_semi`` or ``left_anti``. Null keys match nothing. ``keep`` leaves the column ``__salt``: rows
    equal in ``on`` and ``spread`` are then already in one partition, and a later grouping by both needs no shuffle.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported salted join: {how}")
    left = big.withColumn("__salt", F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))
    right = small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    out = left.join(right, [*on, "__salt"], how)
    return out if keep else out.drop("__salt")


def chunked_lag(df: DataFrame, keys: Sequence[str], order: str, chunk: Column, value: Column, name: str) -> DataFrame:
    """``lag(value)`` over ``keys`` by ``order`` without putting a whole key into one task.

    ``chunk`` must be monotone in ``order`` (for example its day). Inside a chunk an ordinary window applies; the
    first row of a chunk takes the last row of the chunk before, looked up in a table with one row per
    (key, chunk). ``order`` must be free of ties within ``keys`` and not null; ``value`` must not be null.
    """
    rows = df.withColumn("__chunk", chunk).withColumn("__value", value)
    inner = Window.partitionBy(*keys, "__chunk").orderBy(order)
    rows = rows.withColumn("__inner", F.lag("__value").over(inner))
    last = rows.groupBy(*keys, "__chunk").agg(F.max_by("__value", order).alias("__last"))
    last = last.withColumn("__before", F.lag("__last").over(Window.partitionBy(*keys).orderBy("__chunk"))).drop("__last")
    out = rows.join(last, [*keys, "__chunk"], "left")
    return out.withColumn(name, F.coalesce("__inner", "__before")).drop("__chunk", "__value", "__inner", "__before")
