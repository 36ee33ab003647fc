"""Whitening of embeddings by a covariance weighted with multiplicities.

Entries become whole numbers x = floor(scale * c) + shift, so equal vectors are found by equality. Equal vectors are one group with its number
of rows as weight. Sums of the groups are exact; the covariance is a weighted matrix product of centred vectors, one d x d matrix a task,
added up by row of the matrix. Every different vector is whitened once, and the rows get the result back by a join.

A vector that a third of all rows hold is counted in SALTS shares before it becomes a group, and its rows meet the result by share. Only the
covariance (d x d numbers) comes to the driver, whatever the number of rows.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from gridloom.llm.common import lists, read, written

SCALE, SHIFT = 1024, 100_000
#: Shares that the rows of one vector are dealt into.
SALTS = 64
#: Entries beyond this in size become null vectors: floor(1024 c) + 100000 of larger ones is no long.
LARGEST = float((1 << 63) // SCALE - SHIFT)
#: Rows centred and multiplied at once.
ROWS_AT_ONCE = 4096


def whole_vectors(df, id_col, vector_col):
    """vec_id, key (32 bytes that name the vector), salt and x of the rows whose vector is complete: no null, no null or non-finite entry,
    at least one entry and none beyond the range of a long."""
    source = df.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    clean = source.filter(F.size("v") > 0).filter(F.forall("v", lambda c: F.coalesce(F.abs(c) < LARGEST, F.lit(False))))

    def run(batches):
        for batch in batches:
            column = batch.column("v")
            flat = np.floor(column.flatten().to_numpy(zero_copy_only=False) * SCALE).astype(np.int64) + SHIFT
            ends = np.cumsum(np.diff(column.offsets.to_numpy()))
            keys = [hashlib.blake2b(x.tobytes(), digest_size=32).digest() for x in np.split(flat, ends[:-1])] if len(batch) else []
            x = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(keys, pa.binary()), x], ["vec_id", "key", "x"])

    kind = clean.schema["vec_id"].dataType.simpleString()
    rows = clean.mapInArrow(run, f"vec_id {kind}, key binary, x array<long>")
    # a share by row, not by id: ids may be null or equal
    return rows.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))


def widest(groups):
    """Number of entries that most rows have, the larger of equals; None without rows."""
    sizes = groups.groupBy(F.size("x").alias("d")).agg(F.sum("w").alias("n"))
    return sizes.agg(F.max_by("d", F.struct("n", "d")).alias("d")).first().d


def totals(groups, weight):
    """Rows n as an int and sums S as Python ints, both exact."""
    sums = groups.select(weight.alias("w"), F.posexplode("x").alias("j", "x")).groupBy("j").agg(
        F.sum(F.col("x").cast("decimal(38,0)") * F.col("w")).alias("s"), F.sum("w").alias("n"))
    found = sums.orderBy("j").collect()  # one row for each dimension
    return found[0].n, [int(r.s) for r in found]


def covariance(rows, width, centre, n):
    """width x width covariance of the vectors in column x with weights w, about `centre`, divisor n; the vectors are centred first.

    Each task hands over one matrix, by its rows; these are added up in Spark, so the driver gets one matrix.
    """
    shared = rows.sparkSession.sparkContext.broadcast(np.asarray(centre, np.float64))

    def run(batches):
        total = None
        for batch in batches:
            if len(batch):
                x = matrix(batch.column("x"), width) - shared.value
                w = batch.column("w").to_numpy(zero_copy_only=False).astype(np.float64)
                for i in range(0, len(x), ROWS_AT_ONCE):
                    part = x[i:i + ROWS_AT_ONCE]
                    product = (part * w[i:i + ROWS_AT_ONCE, None]).T @ part
                    total = product if total is None else total + product
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(width), pa.int32()), lists(total.ravel(), [width] * width, pa.float64())], ["i", "row"])

    def add(table):
        rows = np.add.reduce([v.values.to_numpy() for v in table.column("row")])
        return pa.table({"i": table.column("i").slice(0, 1), "row": lists(rows, [width], pa.float64())})

    parts = rows.select("w", "x").mapInArrow(run, "i int, row array<double>")
    found = parts.groupBy("i").applyInArrow(add, "i int, row array<double>").toArrow().sort_by("i")
    shared.unpersist()
    return np.stack([v.values.to_numpy() for v in found.column("row")]) / n


def matrix(column, width):
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def principal(v, most):
    """Up to `most` components of a covariance: eigenvalues, falling, and unit eigenvectors as columns.

    A component's largest entry is positive. Eigenvalues below the rounding error of the largest count as zero."""
    values, vectors = np.linalg.eigh((v + v.T) / 2)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    signs = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(vectors.shape[1])])
    return np.where(values > len(v) * np.finfo(float).eps * max(values[0], 0), values, 0.0), vectors * signs


def deviations(x, n, sums):
    """Sum over dimensions of (n x - S)^2 of every row, exactly; None where it is no long."""
    about = np.abs(n * x.astype(np.float64) - np.asarray(sums, np.float64))
    size = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums))
    if len(x) and size < 1 << 62 and about.max() ** 2 * x.shape[1] < 1 << 62:
        gaps = n * x - np.asarray(sums, np.int64)
        return (gaps * gaps).sum(1).tolist()
    exact = [sum((n * c - s) ** 2 for c, s in zip(row, sums)) for row in x.tolist()]
    return [e if e < 1 << 63 else None for e in exact]


def whiten(df, id_col="vec_id", vector_col="embedding", components=8, fit="counts"):
    """One row for each complete vector and component: id_col, component, n, deviation, whitened, explained, identity_error.

    fit: weight of a group of equal vectors, its number of rows ("counts") or one ("one"). n is the sum of the weights, S that of the vectors
    x, deviation the sum over dimensions of (n x - S)^2 (null where it is no long); whitened is x - S/n projected on the component over the root of its
    eigenvalue, explained the eigenvalue's share of the trace, identity_error the largest absolute entry of (covariance of whitened) - identity.

    Left out: rows whose vector is null or empty, holds a null, NaN or infinite entry or one beyond a long, or has another number of entries
    than most rows. Null and repeated ids are kept as they are. There are at most as many components as dimensions. A component without variance has whitened
    null and explained 0 (null if nothing varies) and takes no part in identity_error, which is null if no component has any.
    An empty table gives no rows. Other columns are left out.
    """
    if fit not in ("counts", "one"):
        raise ValueError(f"unknown fit {fit!r}")
    rows = written(whole_vectors(df, id_col, vector_col), "vectors")
    # equal keys have equal vectors, so any of them will do
    shares = rows.groupBy("key", "salt").agg(F.count("*").alias("w"), F.first("x").alias("x"))
    groups = written(shares.groupBy("key").agg(F.sum("w").alias("w"), F.first("x").alias("x")), "vector-groups")
    kind = rows.schema["vec_id"].dataType.simpleString()
    result = f"{id_col} {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    width = widest(groups)
    if width is None:
        return df.sparkSession.createDataFrame([], result)
    groups = groups.filter(F.size("x") == width)
    weight = F.col("w") if fit == "counts" else F.lit(1).cast("long")
    n, sums = totals(groups, weight)
    centre = [s / n for s in sums]
    weighted = groups.select("key", weight.alias("w"), "x")
    v = covariance(weighted, width, centre, n)
    values, vectors = principal(v, min(components, width))
    trace = float(np.trace(v))
    real = values > 0
    shares_of = [float(e / trace) if trace > 0 else None for e in values]
    shared = df.sparkSession.sparkContext.broadcast((np.asarray(centre), vectors / np.sqrt(np.where(real, values, 1.0)), real, n, sums))

    def project(batches):
        centre, axes, real, n, sums = shared.value
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(centre))
            z = (x - centre) @ axes
            holes = np.broadcast_to(~real, z.shape).ravel()
            flat = pa.array(z.ravel(), pa.float64(), mask=holes)
            offsets = pa.array((np.arange(len(x) + 1) * len(real)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("w"), pa.array(deviations(x, n, sums), pa.int64()), pa.ListArray.from_arrays(offsets, flat)],
                ["key", "w", "deviation", "z"])

    done = written(weighted.mapInArrow(project, "key binary, w long, deviation long, z array<double>"), "vectors-white")
    error = _identity_error(done, n, int(real.sum()))
    # a row of each share of a vector, at most SALTS, so that no key of the join holds a third of the rows
    named = rows.filter(F.size("x") == width).select("vec_id", "key", "salt")
    shares = named.groupBy("key", "salt").agg(F.count("*").alias("rows")).join(done.select("key", "deviation", "z"), "key")
    back = named.join(shares.select("key", "salt", "deviation", "z"), ["key", "salt"])
    out = back.select(F.col("vec_id").alias(id_col), "deviation", F.posexplode("z").alias("c", "whitened"))
    explained = F.get(F.array(*[F.lit(s).cast("double") for s in shares_of]), F.col("c"))
    return out.select(
        id_col, (F.col("c") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        explained.alias("explained"), F.lit(error).cast("double").alias("identity_error"))


def _identity_error(done, n, real):
    """Largest absolute entry of the covariance of the whitened vectors minus the identity, over the components with variance."""
    if not real:
        return None
    z = done.select("w", F.slice("z", 1, real).alias("x"))
    sums = z.select("w", F.posexplode("x").alias("j", "x")).groupBy("j").agg(F.sum(F.col("x") * F.col("w")).alias("s"))
    means = [r.s / n for r in sums.orderBy("j").collect()]  # one row for each component
    return float(np.abs(covariance(z, real, means, n) - np.eye(real)).max())


def op13(spark, sf_dir):
    """Whitened vectors of all embeddings."""
    return whiten(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
