"""Repeatable shuffles, samples, shards and minibatches.

A global position normally needs one total order, hence one task. Here the order key is an md5 hash, so its
first hex digits cut the rows into even ranges known in advance, one per shuffle partition. Each partition sorts and
numbers its own rows and is shifted by the row count of the partitions before it. The counts table has one row per
partition, at most 65,536 whatever the data size, which is why it may be summed in one task and broadcast.

Key columns must identify a row.

What is dealt out again and again, such as once per epoch, is written in order once (write_in_order); from then on a new order is a
permutation of the places, computed from a place alone.
"""

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

PREFIXES = 65536  # values of the four leading hex digits
ROW_BITS = (1 << 33) - 1  # monotonically_increasing_id keeps the place in the partition in its lower 33 bits


def order_key(keys, seed=42, epoch=0):
    """32 hex digits that depend only on (seed, epoch, row key)."""
    return F.md5(F.concat_ws(":", F.lit(seed), F.lit(epoch), *[F.col(k).cast("string") for k in keys]))


def sample_k(df, keys, k=10, seed=42):
    """k rows without replacement, or all rows if there are fewer. Planned as a top-k, not a full sort."""
    return df.withColumn("_key", order_key(keys, seed)).orderBy("_key", *keys).limit(k).drop("_key")


def epoch_order(df, keys, seed=42, epoch=0, pos="pos", total=None, parts=None):
    """Add each row's place (from 0) in the shuffled order of this epoch; optionally also the row count.

    Places do not depend on the number of partitions, `parts` (by default the session's shuffle partitions). One
    of more than 2 ** 33 rows fails the job.
    """
    parts = min(PREFIXES, parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    hashed = _hashed(df, keys, seed, epoch, parts)
    offsets = _offsets(hashed.groupBy("_part").agg(F.count("*").alias("_n")))
    placed = _numbered(hashed, keys, parts).join(F.broadcast(offsets), "_part").withColumn(
        pos, F.col("_before") + F.col("_inside"))
    if total:
        placed = placed.withColumn(total, F.col("_total"))
    return placed.drop("_key", "_part", "_inside", "_before", "_total")


def _hashed(df, keys, seed, epoch, parts):
    prefix = F.conv(F.substring("_key", 1, 4), 16, 10).cast("bigint")
    return (
        df.withColumn("_key", order_key(keys, seed, epoch))
        .withColumn("_part", F.call_function("div", prefix * F.lit(parts), F.lit(PREFIXES)).cast("int"))
    )


def _offsets(counts):
    """Rows before each part and rows in total, from the rows _n of each part."""
    counts = counts.withColumn("_n", F.when(F.col("_n") <= ROW_BITS, F.col("_n")).otherwise(
        F.raise_error(F.lit("a partition has too many rows, give more parts")).cast("bigint")))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(
        "_part",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy()).alias("_total"),
    )


def _numbered(hashed, keys, parts):
    """Rows in their parts, each with its place inside its part."""
    return hashed.repartitionById(parts, F.col("_part")).sortWithinPartitions("_key", *keys).withColumn(
        "_inside", F.monotonically_increasing_id().bitwiseAND(F.lit(ROW_BITS)))


def write_in_order(df, keys, folder, seed=42, parts=None):
    """Write the rows in the shuffled order of epoch_order, a range of places per file, without the keys.

    df is read once; the row counts that turn places inside a file into places in the whole are taken from the written rows.
    """
    parts = min(PREFIXES, parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = _numbered(_hashed(df, keys, seed, 0, parts), keys, parts).drop("_key", *keys)
    rows.write.mode("overwrite").parquet(folder)


def read_in_order(spark, folder, columns):
    """What write_in_order has written, with its place `pos` from 0 on, and the number of rows. columns: DDL of the written columns.

    The counts of the files, at most PREFIXES, pass through the driver.
    """
    rows = spark.read.schema(f"{columns}, _part int, _inside bigint").parquet(folder)
    counts, before = sorted((r._part, r.n) for r in rows.groupBy("_part").agg(F.count("*").alias("n")).collect()), 0
    offsets = []
    for part, n in counts:
        if n > ROW_BITS:
            raise ValueError("a partition has too many rows, give more parts")
        offsets.append((part, before))
        before += n
    table = spark.createDataFrame(offsets, "_part int, _before bigint")
    placed = rows.join(F.broadcast(table), "_part").withColumn("pos", F.col("_before") + F.col("_inside"))
    return placed.drop("_part", "_inside", "_before"), before


#: Rounds of the permutation, and how often a place outside the rows is permuted again.
ROUNDS, WALKS = 6, 64


def permuted(pos, n, seed=42, epoch=0):
    """Place in 0..n-1 of each place in 0..n-1 under a permutation that depends on (n, seed, epoch) only; no sort, no shuffle.

    A place is written with two digits of base ceil(sqrt(n)). A round swaps them and adds to one the leading hex digits of an md5 of the other, which loses
    nothing; so the rounds permute all two-digit numbers. A result beyond n - 1 is permuted again until it lies within. At most
    2 sqrt(n) numbers lie beyond, so that happens seldom; more than WALKS times, with a chance below 1e-60 a row, is an error.
    """
    side = math.isqrt(max(n, 1) - 1) + 1
    rounds = F.lit([f"{seed}:{epoch}:{i}:" for i in range(ROUNDS)])

    def added(key, digit):
        return F.conv(F.substring(F.md5(F.concat(key, digit.cast("string"))), 1, 8), 16, 10).cast("bigint")

    def once(place):
        digits = F.struct(F.call_function("div", place, F.lit(side)).alias("a"), F.pmod(place, F.lit(side)).cast("bigint").alias("b"))
        return F.aggregate(rounds, digits, lambda d, key: F.struct(
            d["b"].alias("a"), F.pmod(d["a"] + added(key, d["b"]), F.lit(side)).cast("bigint").alias("b")),
            lambda d: d["a"] * F.lit(side) + d["b"])

    walked = F.aggregate(F.sequence(F.lit(1), F.lit(WALKS)), once(pos), lambda p, _: F.when(p < n, p).otherwise(once(p)))
    return F.when(walked < n, walked).otherwise(F.raise_error(F.lit("no place within the rows")).cast("bigint"))


def deal(placed, n, world, seed=42, epoch=0):
    """Deal n rows with places `pos` to ranks as shard does, with padding, by a permutation of their places: rank, pos_in_rank."""
    last = -(-n // world) * world - 1
    return (
        placed.select("*", F.explode(F.sequence(permuted(F.col("pos"), n, seed, epoch), F.lit(last).cast("bigint"), F.lit(max(n, 1)).cast("bigint"))).alias("_place"))
        .withColumn("rank", F.pmod("_place", F.lit(world)).cast("int"))
        .withColumn("pos_in_rank", F.call_function("div", F.col("_place"), F.lit(world)))
        .drop("_place", "pos")
    )


def shard(df, keys, world, seed=42, epoch=0, mode="split", pad=True):
    """Deal the shuffled rows to `world` ranks.

    mode="split": place p goes to rank p % world. With pad, the order is repeated from its head until its
    length is a multiple of world, so every rank gets the same number of rows (more than one repeat when
    there are fewer rows than ranks). mode="replicate": every rank gets every row.
    """
    placed = epoch_order(df, keys, seed, epoch, pos="pos", total="_rows")
    if mode == "replicate":
        return placed.drop("_rows").select(
            "*",
            F.explode(F.sequence(F.lit(0), F.lit(world - 1))).alias("rank"),
            F.col("pos").alias("pos_in_rank"),
            F.lit(False).alias("is_padding"),
        )
    if mode != "split":
        raise ValueError(f"unknown mode {mode!r}")
    if pad:
        last = F.call_function("div", F.col("_rows") + F.lit(world - 1), F.lit(world)) * F.lit(world) - F.lit(1)
        # Places pos, pos + rows, pos + 2 * rows ... that fall inside the padded length.
        placed = placed.select("*", F.explode(F.sequence("pos", last, F.col("_rows"))).alias("_place"))
    else:
        placed = placed.withColumn("_place", F.col("pos"))
    return (
        placed.withColumn("is_padding", F.col("_place") >= F.col("_rows"))
        .withColumn("pos", F.col("_place"))
        .withColumn("rank", F.pmod("pos", F.lit(world)).cast("int"))
        .withColumn("pos_in_rank", F.call_function("div", F.col("pos"), F.lit(world)))
        .drop("_place", "_rows")
    )


def minibatch(sharded, size=64):
    """Cut each rank's rows into batches of `size`; the short last batch is kept."""
    return (
        sharded.withColumn("batch_idx", F.call_function("div", F.col("pos_in_rank"), F.lit(size)))
        .withColumn("slot", F.pmod("pos_in_rank", F.lit(size)).cast("int"))
    )
