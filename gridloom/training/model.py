"""Batch prediction, evaluation and frozen feature extraction."""

import hashlib
import mmap
import uuid

import numpy as np
from pyspark.sql import functions as F

from gridloom.functions import pixels
from gridloom.operators import layers, metrics
from gridloom.session import locate, shared_dir
from gridloom.training import kernels

ALIGN = 64


class SharedArrays:
    """Groups of named arrays in one file of the shared folder.

    Where the folder is mounted (no scheme or file:), tasks map the file, so all workers of a machine share its pages and a model
    needs its memory once, whatever its size; elsewhere a task reads it. The arrays are read-only.
    """

    def __init__(self, path, index):
        self.path, self.index, self._held = path, index, None

    def __getstate__(self):
        return {"path": self.path, "index": self.index, "_held": None}

    @property
    def value(self):
        if self._held is None:
            data = self._data()
            self._held = {group: {} for group in self.index}
            for group, arrays in self.index.items():
                for name, dtype, shape, at in arrays:
                    count = int(np.prod(shape))
                    self._held[group][name] = np.frombuffer(data, dtype, count, at).reshape(shape) if count else np.empty(shape, dtype)
        return self._held

    def _data(self):
        from pyarrow import fs

        system, inner = locate(self.path)
        if isinstance(system, fs.LocalFileSystem):
            with open(inner, "rb") as f:
                return mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        with system.open_input_file(inner) as f:
            return f.read()

    def unpersist(self):
        """Delete the file; for arrays that nothing reads any more."""
        self._held = None
        system, inner = locate(self.path)
        system.delete_file(inner)


def share_arrays(spark, arrays, kept=False):
    """Write groups of arrays to the shared folder for tasks to read.

    kept: the file is named after its content, so that a model which is shared again and again is written once; it stays in the folder, since
    results that are not computed yet need it.
    """
    index, at = {}, 0
    for group, named in arrays.items():
        index[group] = []
        for name, a in named.items():
            index[group].append((name, a.dtype.str, a.shape, at))
            at += -(-a.nbytes // ALIGN) * ALIGN

    def pieces():
        for named in arrays.values():
            for a in named.values():
                yield np.ascontiguousarray(a).ravel().view(np.uint8)
                yield np.zeros(-a.nbytes % ALIGN, np.uint8)
        yield np.zeros(ALIGN, np.uint8)  # an empty file cannot be mapped

    digest = hashlib.sha256(repr(index).encode())
    if kept:
        for piece in pieces():
            digest.update(piece)
    name = digest.hexdigest() if kept else uuid.uuid4().hex
    path = f"{shared_dir(spark)}/models/{name}"
    system, inner = locate(path)
    if not kept or system.get_file_info(inner).type.name == "NotFound":
        system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
        part = f"{inner}.{uuid.uuid4().hex}"
        with system.open_output_stream(part) as out:
            for piece in pieces():
                out.write(piece)
        system.move(part, inner)
    return SharedArrays(path, index)


def _forward(df, net, params, source, out, denom, element, n_layers=None):
    shared = share_arrays(df.sparkSession, {"model": params}, kept=True)
    steps = net.layers[:n_layers]
    dtype = next(iter(params.values())).dtype
    shape = (-1, net.channels, net.height, net.width)

    def run(x):
        images = x.astype(dtype).reshape(shape) / dtype.type(denom)
        return kernels.forward(steps, shared.value["model"], images)[0]

    return layers.map_arrays(df, run, source, out, element, net.channels * net.height * net.width)


def predict(df, net, params, source="px", denom=255.0, element="float"):
    """Add `scores` and `pred` (arg-max, lowest class on ties). Evaluation mode; the model is not changed.

    Workers map the model from the shared folder, so it may be larger than a broadcast.
    """
    scored = _forward(df, net, params, source, "scores", denom, element)
    return scored.withColumn("pred", pixels.argmax(F.col("scores")))


def featurize(df, net, params, n_layers, source="px", denom=255.0):
    """Run the first n_layers of a frozen network, ending with a flat layer; adds `features`."""
    return _forward(df, net, params, source, "features", denom, "float", n_layers)


def evaluate(pred, k=10):
    """Per split: confusion counts with the split's row count and accuracy (percent) beside them.

    n_rows and accuracy count every row; n_outside is the number of rows without a cell, because truth or
    prediction is null or not in 0..k-1. Predictions are read once, and what is read back are k*k + 1 counts.
    """
    folded = metrics.folded_cells(pred, k, by=["split"])

    def count(cell):
        return F.coalesce(F.try_element_at("_cells", cell), F.lit(0).cast("long"))

    classes = F.sequence(F.lit(0), F.lit(k - 1))
    rows = folded.select("*", F.explode(classes).alias("truth")).select("*", F.explode(classes).alias("predicted"))
    return rows.select(
        "split", "truth", "predicted", count(F.col("truth") * F.lit(k) + F.col("predicted")).alias("n"),
        F.col("_rows").alias("n_rows"), (F.lit(100.0) * F.col("_right") / F.col("_rows")).alias("accuracy"),
        count(F.lit(metrics.OUTSIDE)).alias("n_outside"),
    )
