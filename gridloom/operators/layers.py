"""Convolution, pooling and dense layers over array columns, class sums and batch-norm statistics.

These run as NumPy steps on Arrow batches, because array lambdas are interpreted cell by cell: on 28x28 images the
pooling below is about five times faster than the same rule as a column expression, scan included. Element-wise
steps (activations, batch-norm, dropout) are column expressions in functions/scores.py.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.training import kernels


ROWS_AT_ONCE = 64  # a convolution unfolds every row to nine times its size; this many stay in cache
ELEMENTS = {
    "int": (pa.int32(), T.IntegerType()), "bigint": (pa.int64(), T.LongType()),
    "float": (pa.float32(), T.FloatType()), "double": (pa.float64(), T.DoubleType()),
}


def to_matrix(column, width=None):
    """Arrow list column to a 2-D array without a Python object per cell."""
    if column.null_count:
        raise ValueError("null array")
    n = len(column)
    flat = column.flatten()
    if flat.null_count:
        raise ValueError("null value in an array")
    flat = flat.to_numpy(zero_copy_only=False)
    lengths = np.diff(column.offsets.to_numpy())
    width = width or (int(lengths[0]) if n else 0)
    if n and (lengths != width).any():
        raise ValueError(f"array of {int(lengths[lengths != width][0])} values, expected {width}")
    return flat.reshape(n, width)


def to_lists(matrix, arrow_type):
    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * (matrix.shape[1] if matrix.ndim > 1 else 1)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(matrix).ravel(), arrow_type))


def map_arrays(df, fn, source, out, element, width=None):
    """Append `out` = fn(matrix of `source`), one row in, one row out, ROWS_AT_ONCE rows at a time."""
    arrow_type, element_type = ELEMENTS[element]
    at = df.columns.index(source)

    def run(batches):
        for batch in batches:
            if len(batch):
                x = to_matrix(batch.column(at), width)
                parts = [fn(x[i:i + ROWS_AT_ONCE]) for i in range(0, len(x), ROWS_AT_ONCE)]
                result = to_lists(np.concatenate(parts), arrow_type)
                yield pa.RecordBatch.from_arrays(batch.columns + [result], names=batch.schema.names + [out])

    schema = T.StructType(df.schema.fields + [T.StructField(out, T.ArrayType(element_type, False))])
    return df.mapInArrow(run, schema)


def _exact(arrays):
    """Whole-number weights keep whole-number results."""
    return all(np.issubdtype(np.asarray(a).dtype, np.integer) for a in arrays)


def _flat(images):
    """(row, height, width, channel) to flat channel-first rows."""
    return images.transpose(0, 3, 1, 2).reshape(len(images), -1)


def conv2d(df, weights, bias, height, width, pad=0, source="px", out="conv"):
    """3x3-style convolution, stride 1. weights: out x in x k x k; the image is flat, channel first."""
    weights, bias = np.asarray(weights), np.asarray(bias)
    exact = _exact([weights, bias])
    dtype = np.int64 if exact else np.float64
    w, b, channels = weights.astype(dtype), bias.astype(dtype), weights.shape[1]

    def run(x):
        images = x.astype(dtype).reshape(-1, channels, height, width).transpose(0, 2, 3, 1)
        return _flat(kernels.conv(images, w, b, pad)[0])

    return map_arrays(df, run, source, out, "bigint" if exact else "double", channels * height * width)


def max_pool2d(df, height, width, channels=1, source="px", out="pooled"):
    """2x2 pooling with stride 2 of a flat channel-first image; an odd last row or column is dropped."""
    element = df.schema[source].dataType.elementType.simpleString()

    def run(x):
        return _flat(kernels.pool(x.reshape(-1, channels, height, width).transpose(0, 2, 3, 1)))

    return map_arrays(df, run, source, out, element, channels * height * width)


def dense(df, weights, bias, source="px", out="dense"):
    """weights (out x in) times the vector, plus bias."""
    weights, bias = np.asarray(weights), np.asarray(bias)
    exact = _exact([weights, bias])
    dtype = np.int64 if exact else np.float64
    w, b = weights.astype(dtype), bias.astype(dtype)
    return map_arrays(
        df, lambda x: x.astype(dtype) @ w.T + b, source, out, "bigint" if exact else "double", w.shape[1]
    )


def batch_norm_fit(df, channels, area, source="x"):
    """Mean and population variance per channel over all rows and all places of the channel.

    A task hands over (count, mean, squared deviations) per channel and batch; the aggregation joins them.
    """
    def run(batches):
        for batch in batches:
            x = to_matrix(batch.column(0), channels * area).astype(np.float64).reshape(-1, channels, area)
            if not len(x):
                continue
            mean = x.mean(axis=(0, 2))
            spread = ((x - mean[:, None]) ** 2).sum(axis=(0, 2))
            yield pa.RecordBatch.from_pydict({
                "channel": pa.array(range(channels), pa.int32()), "n": pa.array([len(x) * area] * channels, pa.int64()),
                "m": pa.array(mean), "s": pa.array(spread),
            })

    parts = df.select(source).mapInArrow(run, "channel int, n bigint, m double, s double")
    means = parts.groupBy("channel").agg((F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("mean"))
    # one row per channel; deviations of the batch means, as a difference of squares would cancel
    apart = F.col("m") - F.col("mean")
    return parts.join(F.broadcast(means), "channel").groupBy("channel", "mean").agg(
        (F.sum(F.col("s") + F.col("n") * apart * apart) / F.sum("n")).alias("variance")
    )


def class_sums(df, source="px", label="label"):
    """Per label: row count and element-wise sum of whole-number arrays, as (label, pos, total, n).

    Every task adds up its rows with one matrix product per batch and hands over one vector per label it saw,
    so the shuffle carries labels x pixels numbers per task instead of every pixel of every row.
    """
    def run(batches):
        sums, counts = {}, {}
        for batch in batches:
            x = to_matrix(batch.column(0)).astype(np.int64)
            y = batch.column(1).to_numpy(zero_copy_only=False)
            for c in np.unique(y):
                hit = y == c
                sums[c] = sums.get(c, 0) + x[hit].sum(axis=0)
                counts[c] = counts.get(c, 0) + int(hit.sum())
        if sums:
            order = sorted(sums)
            yield pa.RecordBatch.from_arrays(
                [pa.array(order, pa.int32()), pa.array([counts[c] for c in order], pa.int64()),
                 to_lists(np.stack([sums[c] for c in order]), pa.int64())],
                names=["label", "n", "sums"],
            )

    parts = df.select(source, F.col(label).cast("int").alias("label")).mapInArrow(
        run, "label int, n bigint, sums array<bigint>"
    )
    return parts.select("label", "n", F.posexplode("sums").alias("pos", "s")).groupBy("label", "pos").agg(
        F.sum("s").alias("total"), F.sum("n").alias("n")
    )
