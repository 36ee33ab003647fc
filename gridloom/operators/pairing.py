"""Join two sequences by position."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from gridloom.session import shared_dir


def pair_by_position(images, labels, keys=("split", "idx"), strict=True):
    """One row per position with the image and its label.

    Positions come from the readers, so no numbering pass is needed and a hot label cannot skew the join.
    strict: an image without a label, a label without an image and a position that occurs twice on one side are errors, and fail the job.
    They are seen in the join itself: it keeps unmatched rows of both sides, and each side counts its rows per position under the
    partitioning that the join needs anyway. Otherwise rows without a partner are left out and repeated positions give every combination.

    Tables of write_by_position with equal `buckets` are paired without any shuffle.
    """
    keys = list(keys)
    if not strict:
        return images.join(labels, keys)
    at = Window.partitionBy(*keys)
    both = images.withColumn("_i", F.count("*").over(at)).join(labels.withColumn("_l", F.count("*").over(at)), keys, "full_outer")
    what = F.when(F.col("_i").isNull(), "label without image at ").when(F.col("_l").isNull(), "image without label at ")
    said = F.concat(what.otherwise("repeated position "), F.concat_ws("/", *[F.col(k).cast("string") for k in keys]))
    fine = F.coalesce((F.col("_i") == 1) & (F.col("_l") == 1), F.lit(False))
    return both.filter(F.when(fine, True).otherwise(F.raise_error(said).cast("boolean"))).drop("_i", "_l")


def write_by_position(df, name, buckets, keys=("split", "idx"), path=None):
    """Write df as table `name` (files under `path`, by default in the shared folder), cut into buckets by position and sorted by it
    inside them; returns the table."""
    spark, keys = df.sparkSession, list(keys)
    writer = df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys)
    writer.mode("overwrite").option("path", path or f"{shared_dir(spark)}/tables/{name}").saveAsTable(name)
    return spark.table(name)


def with_file_position(df, group="split", out="idx"):
    """Number the rows of a file scan in file order, from 0 within each value of `group`.

    Needs the hidden columns of a file source. Rows of one input block share (path, block start) and are read
    in order, so a count per block is enough: the numbering of a block starts where the blocks before it end.
    Only the counts (one row per block) are ordered. Their join with the rows is left to the planner, which broadcasts them
    if they are small, so that the rows themselves are not shuffled.
    """
    tagged = df.select(
        "*",
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_mid"),
    )
    blocks = tagged.groupBy(group, "_path", "_start").agg(
        F.count("*").alias("_n"), F.min("_mid").alias("_first")
    )
    before = Window.partitionBy(group).orderBy("_path", "_start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    return (
        tagged.join(offsets, [group, "_path", "_start"])
        .withColumn(out, F.col("_before") + F.col("_mid") - F.col("_first"))
        .drop("_path", "_start", "_mid", "_first", "_before")
    )
