"""Checkpoints, published versions and training logs as parquet folders on a shared file system.

Every run has a folder root/<run_id>, so opening a run never lists the others. A save is one parquet file under
<run folder>/checkpoint/epoch=E/save_id=S: a manifest row and one row per tensor. The file appears as a whole when
its write job commits, so a save is either there or not.
"""

import uuid
from datetime import datetime, timezone

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from gridloom import schemas
from gridloom.operators.running import SPAN

SAVE = pa.schema([
    ("kind", pa.string()), ("name", pa.string()), ("shape", pa.list_(pa.int32())), ("vals", pa.list_(pa.float32())),
    ("loss", pa.float64()), ("seed", pa.int64()), ("saved_at", pa.timestamp("us", tz="UTC")),
])
SAVE_DDL = (
    "kind string, name string, shape array<int>, vals array<float>, loss double, seed bigint, saved_at timestamp"
)
KEYS_DDL = "epoch int, save_id string"


def _tensors(kind, arrays):
    return [
        {"kind": kind, "name": name, "shape": list(a.shape), "vals": a.astype(np.float32).ravel()}
        for name, a in arrays.items()
    ]


def _write_save(spark, folder, params, opt, loss, seed):
    manifest = {
        "kind": "manifest", "loss": None if loss is None else float(loss), "seed": int(seed),
        "saved_at": datetime.now(timezone.utc),
    }
    rows = [manifest] + _tensors("model", params) + _tensors("optimizer", opt)
    table = pa.Table.from_pylist(rows, schema=SAVE)
    spark.createDataFrame(table).coalesce(1).write.mode("overwrite").parquet(folder)


def save_checkpoint(spark, root, run_id, epoch, params, opt=None, loss=0.0, seed=42, save_id=None):
    """Write model and optimizer arrays, loss and seed. Returns the id of this save.

    Saving an epoch again adds a newer save; readers take the newest.
    """
    save_id = save_id or uuid.uuid4().hex
    _write_save(
        spark, f"{root}/{run_id}/checkpoint/epoch={epoch}/save_id={save_id}", params, opt or {}, loss, seed
    )
    return save_id


def _saves(spark, root, run_id):
    """Rows of all saves of a run, or None if nothing was ever saved."""
    try:
        return spark.read.schema(f"{SAVE_DDL}, {KEYS_DDL}").parquet(f"{root}/{run_id}/checkpoint")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def checkpoints(spark, root, run_id):
    """One row per save (run_id, epoch, save_id, loss, seed, saved_at), or None if nothing was ever saved."""
    saves = _saves(spark, root, run_id)
    return saves and saves.filter(F.col("kind") == "manifest").select(
        F.lit(run_id).alias("run_id"), "epoch", "save_id", "loss", "seed", "saved_at"
    )


def load_checkpoint(spark, root, run_id):
    """Where to go on: start_epoch (saved epoch + 1), loss, seed, params and optimizer arrays.

    Without a checkpoint: start_epoch 0, loss 0.0, seed None and no arrays.
    """
    newest = None
    saves = _saves(spark, root, run_id)
    if saves is not None:
        newest = saves.filter(F.col("kind") == "manifest").agg(
            F.max_by(F.struct("epoch", "save_id", "loss", "seed"), F.struct("epoch", "saved_at")).alias("c")
        ).first().c
    if newest is None:
        return {"start_epoch": 0, "loss": 0.0, "seed": None, "params": None, "opt": None, "save_id": None}
    tensors = saves.filter(
        (F.col("epoch") == newest.epoch) & (F.col("save_id") == newest.save_id)
        & F.col("kind").isin("model", "optimizer")
    ).select("kind", "name", "shape", "vals").toArrow()
    arrays = {"model": {}, "optimizer": {}}
    for kind, name, shape, vals in zip(*(tensors.column(i) for i in range(4))):
        values = vals.values.to_numpy(zero_copy_only=False)
        arrays[kind.as_py()][name.as_py()] = values.reshape(shape.as_py()).copy()
    return {
        "start_epoch": newest.epoch + 1, "loss": newest.loss if newest.loss is not None else 0.0,
        "seed": newest.seed, "params": arrays["model"], "opt": arrays["optimizer"], "save_id": newest.save_id,
    }


def read_params(spark, root, run_id, epoch, kind="model"):
    """The arrays of an epoch's newest save as a table (name, shape, vals)."""
    saves = _saves(spark, root, run_id).filter(F.col("epoch") == epoch)
    newest = saves.filter(F.col("kind") == "manifest").agg(F.max_by("save_id", "saved_at").alias("s")).first().s
    return saves.filter((F.col("save_id") == newest) & (F.col("kind") == kind)).select("name", "shape", "vals")


def publish_version(spark, root, run_id, at=None, prefix="model_checkpoint"):
    """Copy the newest checkpoint to a time-stamped folder. Returns its path, or None if there is no checkpoint.

    The checkpoint itself stays, so a published run can still be resumed. A folder of that name, as of a version published
    in the same second, is an error: two versions would be read as one.
    """
    latest = load_checkpoint(spark, root, run_id)
    if latest["params"] is None:
        print(f"run {run_id} has no checkpoint, nothing to publish")
        return None
    stamp = (at or datetime.now(timezone.utc)).strftime("%Y%m%d_%H%M%S")
    target = f"{root}/versions/{prefix}_{stamp}"
    try:
        spark.read.parquet(target)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
    else:
        raise FileExistsError(target)
    folder = f"{target}/run_id={run_id}/epoch={latest['start_epoch'] - 1}"
    _write_save(spark, folder, latest["params"], latest["opt"], latest["loss"], latest["seed"])
    return target


def append_train_log(log, path):
    """Append batch records, one folder per run and rank.

    Rows are brought together by folder and span of batches: few files, and a long rank still has many writers.
    """
    span = F.call_function("div", F.col("batch_idx"), F.lit(SPAN))
    log.repartition("run_id", "rank", span).write.partitionBy("run_id", "rank").mode("append").parquet(path)


def read_train_log(spark, path):
    return spark.read.schema(schemas.TRAIN_LOG).parquet(path)
