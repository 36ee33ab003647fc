"""Running figures over training logs.

A plain window over (run, rank) would put one rank's whole log into one task. The helpers below cut the order
column into spans, run the window inside a span and add the totals of the spans before it, so a rank that holds
a third of all rows still spreads over many tasks. The span totals are small: one row per SPAN rows or less.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPAN = 65536
RANK = ["run_id", "rank"]


def _by_span(df, keys, order, sums, restart=None, span=SPAN):
    """Rows with running sums, the span totals, and the columns that join the two.

    `order` ends with a whole-number column that is unique within the columns before it. `sums` maps an output
    name to the Column to add up. A name in `restart` starts again with every new value of the given leading
    order columns; all other sums run through a key.
    """
    restart = restart or {}
    cut = list(order[:-1]) + ["_span"]
    group = list(keys) + cut
    last = order[-1]
    rows = df.withColumn("_span", F.call_function("div", F.col(last), F.lit(span)))
    totals = rows.groupBy(*group).agg(
        F.max(last).alias("_last"), *[F.sum(value).alias(f"_t_{n}") for n, value in sums.items()]
    )
    for n in sums:
        again = restart.get(n, [])
        earlier = (
            Window.partitionBy(*keys, *again).orderBy(*[c for c in cut if c not in again])
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        totals = totals.withColumn(f"_o_{n}", F.sum(f"_t_{n}").over(earlier))
    inside = Window.partitionBy(*group).orderBy(last).rowsBetween(Window.unboundedPreceding, 0)
    local = rows.select(
        *df.columns, "_span", *[F.sum(value).over(inside).alias(f"_l_{n}") for n, value in sums.items()]
    )
    return local, totals, group


def _running(name):
    """Total before the span plus total inside it; the first span has nothing before it."""
    before, inside = F.col(f"_o_{name}"), F.col(f"_l_{name}")
    return F.when(before.isNull(), inside).otherwise(before + inside).alias(name)


def running_totals(df, keys, order, sums, restart=None, span=SPAN):
    """Add the running sums of `_by_span` to the rows."""
    local, totals, group = _by_span(df, keys, order, sums, restart, span)
    offsets = totals.select(*group, *[f"_o_{n}" for n in sums])
    return local.join(offsets, group).select(*df.columns, *[_running(n) for n in sums])


def _correct():
    return {"cum_correct": F.col("n_correct").cast("long"), "cum_samples": F.col("n_samples").cast("long")}


def _percent():
    return F.lit(100.0) * F.col("cum_correct") / F.col("cum_samples")


def running_accuracy(log, span=SPAN):
    """Percent of correct samples so far; starts again at every epoch."""
    totals = running_totals(log, RANK + ["epoch"], ["batch_idx"], _correct(), span=span)
    return totals.withColumn("accuracy", _percent())


def running_loss(log, span=SPAN):
    """Total loss and number of batches of a rank over all epochs so far."""
    return running_totals(
        log, RANK, ["epoch", "batch_idx"],
        {"total_loss": F.col("loss"), "total_batches": F.lit(1).cast("long")}, span=span,
    )


def smooth_loss(log, alpha=0.1, span=SPAN):
    """Exponential smoothing s = alpha * loss + (1 - alpha) * s per (run, rank), from s = 0.

    Rows are cut into spans of batch numbers inside an epoch, which are shuffled once. A span's own recurrence runs from 0 in one task; it
    ends with a state and passes on (1 - alpha) ** rows of the state before it. The states before the spans come from one row per span, so
    nothing is left out, however old: a NaN or an infinite loss stays.
    """
    if not 0.0 < alpha < 1.0:
        raise ValueError("alpha must lie between 0 and 1")
    decay, keys = 1.0 - alpha, RANK + ["epoch", "_span"]
    rows = log.withColumn("_span", F.call_function("div", F.col("batch_idx"), F.lit(min(span, SPAN))))

    def fold(table):
        table = table.sort_by("batch_idx")
        return table, recurrence(alpha * table.column("loss").to_numpy(zero_copy_only=False), decay)

    def inside(table):
        table, s = fold(table)
        return table.append_column("_s", pa.array(s)).append_column("_i", pa.array(np.arange(1.0, len(s) + 1)))

    def end(table):
        first, s = table.select(keys).slice(0, 1), fold(table)[1]
        return first.append_column("_n", pa.array([len(s)], pa.int64())).append_column("_end", pa.array(s[-1:]))

    def carry(table):
        table, state, before = table.sort_by([("epoch", "ascending"), ("_span", "ascending")]), 0.0, []
        for n, own in zip(table.column("_n").to_pylist(), table.column("_end").to_pylist()):
            before.append(state)
            state = own + _left_of(state, decay ** n)
        return table.select(keys).append_column("_before", pa.array(before, pa.float64()))

    key_types = [next(f for f in rows.schema.fields if f.name == k) for k in keys]
    double = [T.StructField(n, T.DoubleType()) for n in ("_s", "_i")]
    # both read the same groups of the same columns, so Spark shuffles the rows for the first and uses that again
    groups = rows.groupBy(*keys)
    local = groups.applyInArrow(inside, T.StructType(rows.schema.fields + double))
    ends = groups.applyInArrow(end, T.StructType(key_types + [T.StructField("_n", T.LongType()), T.StructField("_end", T.DoubleType())]))
    # one row per span of up to SPAN rows
    states = ends.groupBy(*RANK).applyInArrow(carry, T.StructType(key_types + [T.StructField("_before", T.DoubleType())]))
    left = F.when(F.abs("_before") == float("inf"), F.col("_before")).otherwise(F.col("_before") * F.pow(F.lit(decay), F.col("_i")))
    return local.join(states, keys).select(*log.columns, (F.col("_s") + left).alias("smoothed"))


#: Values that one matrix row of the recurrence covers.
STRIDE = 64


def recurrence(x, decay):
    """s[i] = x[i] + decay * s[i - 1] from s = 0, without a step per value.

    The values are cut into rows of STRIDE. A product with the triangle of powers of decay gives every row as if it began at 0; the rows' last
    values follow the same recurrence with decay ** STRIDE, and what each hands on is added. An infinite value never
    fades, and NaN or both infinities give NaN from there on; products would spread them to earlier values, so they are put in last.
    """
    x = np.asarray(x, np.float64)
    whole = np.isfinite(x)
    powers = decay ** np.arange(STRIDE + 1)
    if len(x) <= STRIDE:
        s = _triangle(powers, len(x)) @ np.where(whole, x, 0.0)
    else:
        rows = np.zeros((-(-len(x) // STRIDE), STRIDE))
        rows.ravel()[:len(x)] = np.where(whole, x, 0.0)
        own = rows @ _triangle(powers, STRIDE).T
        before = np.concatenate([[0.0], recurrence(own[:, -1], powers[-1])[:-1]])
        s = (own + before[:, None] * powers[1:]).ravel()[:len(x)]
    if whole.all():
        return s
    plus, minus = (np.logical_or.accumulate(x == sign) for sign in (np.inf, -np.inf))
    broken = np.logical_or.accumulate(np.isnan(x)) | (plus & minus)
    return np.where(broken, np.nan, np.where(plus, np.inf, np.where(minus, -np.inf, s)))


def _triangle(powers, n):
    """powers[i - j] at (i, j) for j <= i, else 0."""
    gap = np.subtract.outer(np.arange(n), np.arange(n))
    return np.where(gap >= 0, powers[np.abs(gap)], 0.0)


def _left_of(state, weight):
    """What is left of a state; an infinite one never fades."""
    return state if math.isinf(state) else state * weight


def curves(log, repeat_epoch_point=False, span=SPAN):
    """Loss and accuracy points of every rank in drawing order, one row per point (`point` counts from 0).

    repeat_epoch_point adds one more accuracy point after each epoch that repeats the epoch's last value; its
    loss is null and its batch_idx one past the last. One row per point rather than one list per rank, because
    a list would gather a rank in one task.
    """
    local, totals, group = _by_span(
        log.select(*RANK, "epoch", "batch_idx", "loss", "n_correct", "n_samples"), RANK, ["epoch", "batch_idx"],
        _correct() | {"_n": F.lit(1).cast("long")},
        restart={"cum_correct": ["epoch"], "cum_samples": ["epoch"]}, span=span,
    )
    epochs = Window.partitionBy(*RANK).orderBy("epoch")
    offsets = totals.select(
        *group, "_o_cum_correct", "_o_cum_samples", "_o__n",
        (F.dense_rank().over(epochs) - 1).cast("long").alias("_epochs_before"),
        F.max("_last").over(Window.partitionBy(*RANK, "epoch")).alias("_epoch_end"),
    )
    points = local.join(offsets, group).select(
        *RANK, "epoch", "batch_idx", "loss", _running("cum_correct"), _running("cum_samples"), _running("_n"),
        "_epochs_before", "_epoch_end",
    ).withColumn("accuracy", _percent())
    if not repeat_epoch_point:
        return points.select(
            *RANK, "epoch", "batch_idx", "loss", "accuracy", F.lit("batch").alias("kind"),
            (F.col("_n") - 1).alias("point"),
        )
    place = F.col("_n") - 1 + F.col("_epochs_before")

    def point(kind, batch_idx, loss, at):
        return F.struct(
            F.lit(kind).alias("kind"), batch_idx.alias("batch_idx"), loss.alias("loss"), at.alias("point")
        )

    batch = point("batch", F.col("batch_idx"), F.col("loss"), place)
    repeat = point("epoch", F.col("batch_idx") + 1, F.lit(None).cast("double"), place + 1)
    both = F.when(F.col("batch_idx") == F.col("_epoch_end"), F.array(batch, repeat)).otherwise(F.array(batch))
    return points.select(*RANK, "epoch", "accuracy", F.inline(both))


def progress_rows(log, k=50):
    """Every k-th batch of a rank and epoch."""
    return log.filter(F.pmod("batch_idx", F.lit(k)) == 0)
