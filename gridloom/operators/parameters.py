"""Checks and sums over parameter tables (one row per tensor, or one per tensor and rank)."""

from pyspark.sql import functions as F


def replica_check(params, atol=1e-4, rtol=1e-5):
    """Per parameter: do all ranks agree with rank 0, element by element, within atol + rtol * |value|?

    Arrays are compared whole, each with rank 0's of the same name, so one row per array is joined and grouped, not one per element.
    A name without a rank 0, or with arrays of another length, is not consistent.
    """
    base = params.filter("rank = 0").select("name", F.col("vals").cast("array<double>").alias("_base"))
    both = params.select("name", F.col("vals").cast("array<double>").alias("_v")).join(base, "name", "left")
    gaps = F.zip_with("_v", "_base", lambda v, b: F.abs(b - v))
    allowed = F.transform("_v", lambda v: F.lit(atol) + F.lit(rtol) * F.abs(v))
    near = F.forall(F.zip_with(gaps, allowed, lambda g, most: F.coalesce(g <= most, F.lit(False))), lambda ok: ok)
    return both.groupBy("name").agg(
        F.max(F.size("_v")).cast("long").alias("n_elements"),
        F.count("*").alias("n_replicas"),
        F.max(F.array_max(gaps)).alias("max_gap"),
        F.bool_and(F.coalesce(near & (F.size("_v") == F.size("_base")), F.lit(False))).alias("consistent"),
    )


def param_summary(params):
    """Number of tensors and of elements per name, and in total (name is null); the shape too if there is one."""
    shape = []
    if "shape" in params.columns:
        shape = [F.when(F.grouping("name") == 0, F.max("shape")).alias("shape")]
    return params.rollup("name").agg(
        *shape, F.count("*").alias("n_tensors"), F.sum(F.size("vals")).alias("n_params")
    )
