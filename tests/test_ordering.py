import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gridloom.operators import ordering


def rows(spark, n, parts=4):
    return spark.range(0, n, 1, parts).withColumnRenamed("id", "idx")


def places(df):
    return {r.idx: r.pos for r in df.collect()}


def expected(n, seed, epoch):
    key = lambda i: hashlib.md5(f"{seed}:{epoch}:{i}".encode()).hexdigest()
    return {i: p for p, i in enumerate(sorted(range(n), key=key))}


@pytest.mark.parametrize("n", [0, 1, 1000])
def test_positions_are_the_rank_of_the_hash(spark, n):
    assert places(ordering.epoch_order(rows(spark, n), ["idx"], 7, 3)) == expected(n, 7, 3)


def test_order_depends_on_seed_and_epoch_only(spark):
    base = places(ordering.epoch_order(rows(spark, 300), ["idx"], 1, 0))
    assert base == places(ordering.epoch_order(rows(spark, 300, 1).repartition(13), ["idx"], 1, 0))
    assert base != places(ordering.epoch_order(rows(spark, 300), ["idx"], 1, 1))
    assert base != places(ordering.epoch_order(rows(spark, 300), ["idx"], 2, 0))


@pytest.mark.parametrize("partitions", ["1", "7", "300"])
def test_order_does_not_depend_on_the_number_of_partitions(spark, partitions):
    base = ordering.epoch_order(rows(spark, 2000), ["idx"])
    want = places(base)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df = ordering.epoch_order(rows(spark, 2000), ["idx"])
        assert df.rdd.getNumPartitions() == int(partitions)
        assert places(df) == want == expected(2000, 42, 0)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_places_survive_what_is_planned_on_top(spark):
    """Joins and aggregations above must not remove the sort below the numbering."""
    placed = ordering.epoch_order(rows(spark, 500), ["idx"])
    want = expected(500, 42, 0)
    joined = placed.join(rows(spark, 500).withColumn("x", F.col("idx") * 2), "idx")
    assert places(joined) == want
    sums = placed.groupBy((F.col("idx") % 3).alias("g")).agg(F.sum("pos").alias("s")).collect()
    assert {r.g: r.s for r in sums} == {g: sum(p for i, p in want.items() if i % 3 == g) for g in range(3)}
    assert [r.idx for r in placed.orderBy("pos").limit(5).collect()] == sorted(want, key=want.get)[:5]


def test_no_window_sees_all_rows(spark):
    """The only single-partition exchange carries the counts, not the rows."""
    df = ordering.epoch_order(rows(spark, 100).withColumn("payload", F.lit("x")), ["idx"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    single = plan.index("SinglePartition")
    assert plan.count("SinglePartition") == 1 and "payload" not in plan[single:]


@pytest.mark.parametrize("n, world", [(10, 4), (12, 4), (3, 8), (1, 5), (100, 1)])
def test_shards_follow_the_dealing_rule(spark, n, world):
    order = sorted(expected(n, 42, 0), key=expected(n, 42, 0).get)
    total = -(-n // world) * world
    padded = (order * (total // n + 1))[:total]
    got = ordering.shard(rows(spark, n), ["idx"], world).collect()
    assert {(r.rank, r.pos_in_rank): r.idx for r in got} == {
        (p % world, p // world): i for p, i in enumerate(padded)
    }
    assert len(got) == total and sum(r.is_padding for r in got) == total - n
    assert set(Counter(r.rank for r in got).values()) == {total // world}


def test_shards_without_padding_hold_every_row_once(spark):
    got = ordering.shard(rows(spark, 10), ["idx"], 4, pad=False).collect()
    assert sorted(r.idx for r in got) == list(range(10))


def test_replicated_shards(spark):
    got = ordering.shard(rows(spark, 10), ["idx"], 3, mode="replicate").collect()
    assert Counter(r.rank for r in got) == {0: 10, 1: 10, 2: 10}
    assert Counter(r.idx for r in got) == {i: 3 for i in range(10)}


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        ordering.shard(rows(spark, 1), ["idx"], 1, mode="other")


def test_minibatches_keep_the_short_last_batch(spark):
    batches = ordering.minibatch(ordering.shard(rows(spark, 20), ["idx"], 2), 4).collect()
    assert Counter((r.rank, r.batch_idx) for r in batches) == {
        (0, 0): 4, (0, 1): 4, (0, 2): 2, (1, 0): 4, (1, 1): 4, (1, 2): 2
    }
    assert all(r.slot == r.pos_in_rank % 4 for r in batches)


def test_sample_is_cut_to_the_row_count_and_repeatable(spark):
    take = lambda n, k, seed=1: [r.idx for r in ordering.sample_k(rows(spark, n), ["idx"], k, seed).collect()]
    assert sorted(take(5, 10)) == list(range(5)) and take(0, 10) == []
    assert len(set(take(1000, 10))) == 10 and take(1000, 10) == take(1000, 10) != take(1000, 10, 2)


@pytest.mark.parametrize("n", [1, 2, 3, 10, 50, 99, 101, 1000, 5000])
def test_permuted_places_are_a_permutation_that_changes_with_the_epoch(spark, n):
    first, second = (
        [r.p for r in spark.range(n).orderBy("id").select(ordering.permuted(F.col("id"), n, 3, epoch).alias("p")).collect()] for epoch in (0, 1))
    assert sorted(first) == sorted(second) == list(range(n))
    if n > 50:
        assert sum(a == b for a, b in zip(first, second)) < n / 10 and sum(a + 1 == b for a, b in zip(first, first[1:])) < n / 10


def test_rows_written_in_order_have_the_places_of_the_epoch_order(spark, tmp_path):
    df = spark.range(500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    ordering.write_in_order(df, ["k"], str(tmp_path / "a"), seed=9)
    rows, n = ordering.read_in_order(spark, str(tmp_path / "a"), "v bigint")
    want = {r.v: r.pos for r in ordering.epoch_order(df, ["k"], seed=9).collect()}
    assert n == 500 and {r.v: r.pos for r in rows.collect()} == want
    ordering.write_in_order(df.limit(0), ["k"], str(tmp_path / "b"))
    assert ordering.read_in_order(spark, str(tmp_path / "b"), "v bigint")[1] == 0


@pytest.mark.parametrize("n, world", [(10, 3), (9, 3), (2, 8), (1, 1), (100, 7)])
def test_deal_gives_every_rank_the_same_number_of_rows(spark, n, world):
    rows = ordering.deal(spark.range(n).withColumn("pos", F.col("id")), n, world, 5, 2).collect()
    per = -(-n // world)
    assert sorted((r.rank, r.pos_in_rank) for r in rows) == [(k, i) for k in range(world) for i in range(per)]
    by_place = {r.pos_in_rank * world + r.rank: r.id for r in rows}
    assert {by_place[i] for i in range(n)} == set(range(n)) and all(by_place[i] == by_place[i - n] for i in range(n, per * world))
