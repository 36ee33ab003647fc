"""Label counts, accuracy, confusion counts and run summaries. All aggregate on the map side first."""

from pyspark.sql import functions as F


def label_histogram(df, label="label"):
    return df.groupBy(label).agg(F.count("*").alias("n"))


def split_summary(df, px="px"):
    return df.groupBy("split").agg(
        F.count("*").alias("n_rows"),
        F.min(F.size(px)).alias("min_size"),
        F.max(F.size(px)).alias("max_size"),
        F.count_distinct("label").alias("n_labels"),
    )


def accuracy(pred, unit="percent", by=(), label="label", predicted="pred"):
    """Share of right predictions, as percent or as fraction."""
    if unit not in ("percent", "fraction"):
        raise ValueError(f"unknown unit {unit!r}")
    right = F.sum(F.when(F.col(label) == F.col(predicted), 1).otherwise(0))
    scale = 100.0 if unit == "percent" else 1.0
    return pred.groupBy(*by).agg(
        F.count("*").alias("n_rows"), right.alias("n_correct"),
        (F.lit(scale) * right / F.count("*")).alias("accuracy"),
    )


OUTSIDE = -1  # cell of rows whose truth or prediction is null or no class


def folded_cells(pred, k, label="label", predicted="pred", by=()):
    """Per group one map `_cells` from truth * k + predicted (or OUTSIDE) to the row count; every row is in one cell.

    Beside it `_rows`, all rows of the group, and `_right`, those with truth = prediction, class or not.
    """
    truth, guess = F.col(label).cast("int"), F.col(predicted).cast("int")
    inside = truth.between(0, k - 1) & guess.between(0, k - 1)
    cell = F.when(inside, truth * F.lit(k) + guess).otherwise(F.lit(OUTSIDE))
    right = F.sum(F.when(F.col(label) == F.col(predicted), 1).otherwise(0))
    counts = pred.groupBy(*by, cell.alias("_cell")).agg(F.count("*").alias("_n"), right.alias("_hit"))
    return counts.groupBy(*by).agg(
        F.map_from_entries(F.collect_list(F.struct("_cell", "_n"))).alias("_cells"),
        F.sum("_n").alias("_rows"), F.sum("_hit").alias("_right"),
    )


def confusion_matrix(pred, k=10, pivot=False, label="label", predicted="pred", by=(), outside="fail"):
    """Counts for every (truth, predicted) pair of classes 0..k-1, zero cells included.

    A row whose truth or prediction is null or not in 0..k-1 has no cell. outside="fail" stops the job at one,
    outside="count" adds the column `n_outside`, the number of such rows in the group.

    After the aggregation a group has at most k*k + 1 counts; they are folded into one map per group, from which
    all cells are read back. So the empty cells cost neither a join nor a second scan.
    """
    if outside not in ("fail", "count"):
        raise ValueError(f"unknown rule {outside!r} for rows outside the classes")
    by = list(by)
    folded = folded_cells(pred, k, label, predicted, by)
    lost = F.coalesce(F.try_element_at("_cells", F.lit(OUTSIDE)), F.lit(0).cast("long"))
    if outside == "fail":
        said = F.format_string("%d rows outside the classes 0..%d", lost, F.lit(k - 1))
        folded = folded.withColumn(
            "_cells", F.when(lost == 0, F.col("_cells")).otherwise(F.raise_error(said).cast("map<int,bigint>")))
    else:
        folded = folded.withColumn("n_outside", lost)
        by = by + ["n_outside"]
    every = folded.select(
        *by, "_cells", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("truth")
    )

    def cell(guess):
        return F.coalesce(F.try_element_at("_cells", F.col("truth") * F.lit(k) + guess), F.lit(0).cast("long"))

    if pivot:
        return every.select(*by, "truth", *[cell(F.lit(c)).alias(f"predicted_{c}") for c in range(k)])
    return every.select(
        *by, "truth", "_cells", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("predicted")
    ).select(*by, "truth", "predicted", cell(F.col("predicted")).alias("n"))


def epoch_loss(log):
    """Plain mean over batches, whatever their size."""
    return log.groupBy("run_id", "rank", "epoch").agg(
        F.count("*").alias("n_batches"), F.avg("loss").alias("epoch_loss")
    )


def epoch_accuracy(log):
    correct, samples = F.sum("n_correct"), F.sum("n_samples")
    return log.groupBy("run_id", "rank", "epoch").agg(
        correct.alias("n_correct"), samples.alias("n_samples"),
        (F.lit(100.0) * correct / samples).alias("epoch_accuracy"),
    )


def reduce_ranks(log):
    """Sums over all ranks of a run."""
    return log.groupBy("run_id").agg(
        F.count_distinct("rank").alias("world"),
        F.count("*").alias("n_batches"),
        F.sum("loss").alias("total_loss"),
        F.sum("n_correct").alias("n_correct"),
        F.sum("n_samples").alias("n_samples"),
    )


def run_summary(log):
    """Closing figures of each run.

    final_accuracy      plain mean over ranks of the last epoch's accuracy
    loss_by_rank0       all losses over the number of batches of rank 0 (grows with the number of ranks)
    loss_last_by_world  losses of the last epoch over the number of ranks
    loss_mean           true mean over all batches
    """
    per_rank = log.groupBy("run_id", "epoch", "rank").agg(
        F.sum("loss").alias("_loss"), F.count("*").alias("_batches"),
        (F.lit(100.0) * F.sum("n_correct") / F.sum("n_samples")).alias("_acc"),
    )
    per_epoch = per_rank.groupBy("run_id", "epoch").agg(
        F.sum("_loss").alias("_loss"), F.sum("_batches").alias("_batches"),
        F.sum(F.when(F.col("rank") == 0, F.col("_batches")).otherwise(0)).alias("_rank0"),
        F.count("*").alias("_ranks"), F.avg("_acc").alias("_acc"),
    )
    return per_epoch.groupBy("run_id").agg(
        F.max("epoch").alias("last_epoch"),
        F.max_by("_acc", "epoch").alias("final_accuracy"),
        F.try_divide(F.sum("_loss"), F.sum("_rank0")).alias("loss_by_rank0"),
        (F.max_by("_loss", "epoch") / F.max_by("_ranks", "epoch")).alias("loss_last_by_world"),
        (F.sum("_loss") / F.sum("_batches")).alias("loss_mean"),
    )


def run_duration(log):
    """Seconds between the first and the last record of a run."""
    return log.groupBy("run_id").agg(
        F.min("ts").alias("started"), F.max("ts").alias("ended")
    ).withColumn(
        "seconds", F.timestamp_diff("MICROSECOND", F.col("started"), F.col("ended")) / F.lit(1000000.0)
    )


def latest_checkpoint(checkpoints):
    """Newest checkpoint of each run, with the epoch to go on from; a missing loss counts as 0."""
    newest = checkpoints.groupBy("run_id").agg(
        F.max("epoch").alias("saved_epoch"),
        F.max_by(F.coalesce(F.col("loss"), F.lit(0.0)), "epoch").alias("loss"),
    )
    return newest.withColumn("start_epoch", F.col("saved_epoch") + 1)
