import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom import schemas
from gridloom.operators import parameters
from gridloom.sinks import store

PARAMS = {"w": np.arange(6, dtype=np.float32).reshape(2, 3), "b": np.array([0.5], np.float32)}


def test_round_trip_and_resume_point(spark, tmp_path):
    root = str(tmp_path)
    store.save_checkpoint(spark, root, "a", 0, PARAMS, {"momentum/w": PARAMS["w"] + 1}, 0.25, 7)
    store.save_checkpoint(spark, root, "a", 1, {"w": PARAMS["w"] * 2}, {}, 0.125, 7)
    store.save_checkpoint(spark, root, "b", 5, PARAMS, None, None, 8)
    a, b = store.load_checkpoint(spark, root, "a"), store.load_checkpoint(spark, root, "b")
    assert (a["start_epoch"], a["loss"], a["seed"]) == (2, 0.125, 7)
    assert (a["params"]["w"] == PARAMS["w"] * 2).all() and a["params"]["w"].shape == (2, 3)
    assert (b["start_epoch"], b["loss"], b["seed"]) == (6, 0.0, 8)


def test_saved_parameters_as_a_table(spark, tmp_path):
    root = str(tmp_path)
    store.save_checkpoint(spark, root, "a", 0, PARAMS)
    store.save_checkpoint(spark, root, "a", 0, PARAMS, {"momentum/w": PARAMS["w"]})
    rows = parameters.param_summary(store.read_params(spark, root, "a", 0)).collect()
    assert {(r.name, tuple(r.shape or ()), r.n_params) for r in rows} == {("w", (2, 3), 6), ("b", (1,), 1), (None, (), 7)}


def test_no_checkpoint_starts_from_scratch(spark, tmp_path):
    got = store.load_checkpoint(spark, str(tmp_path / "nothing"), "a")
    assert (got["start_epoch"], got["loss"], got["params"]) == (0, 0.0, None)


def test_saving_an_epoch_again_replaces_it(spark, tmp_path):
    root = str(tmp_path)
    store.save_checkpoint(spark, root, "a", 0, PARAMS, loss=1.0)
    store.save_checkpoint(spark, root, "a", 0, PARAMS, loss=2.0)
    assert store.load_checkpoint(spark, root, "a")["loss"] == 2.0
    assert store.checkpoints(spark, root, "a").count() == 2


def test_an_unfinished_save_does_not_count(spark, tmp_path):
    root = str(tmp_path)
    store.save_checkpoint(spark, root, "a", 0, PARAMS, loss=1.0)
    (tmp_path / "a" / "checkpoint" / "epoch=1" / "save_id=x" / "_temporary").mkdir(parents=True)
    assert store.load_checkpoint(spark, root, "a")["start_epoch"] == 1


def test_publishing_keeps_the_run_resumable(spark, tmp_path):
    root = str(tmp_path)
    store.save_checkpoint(spark, root, "a", 3, PARAMS, loss=1.0)
    path = store.publish_version(spark, root, "a", dt.datetime(2024, 2, 3, 4, 5, 6))
    assert path.endswith("/versions/model_checkpoint_20240203_040506")
    rows = {r.name: r.vals for r in spark.read.parquet(path).filter("kind = 'model'").collect()}
    assert rows["w"] == PARAMS["w"].ravel().tolist()
    assert store.load_checkpoint(spark, root, "a")["start_epoch"] == 4


def test_publishing_twice_in_a_second_is_refused(spark, tmp_path):
    store.save_checkpoint(spark, str(tmp_path), "a", 0, PARAMS, loss=1.0)
    at = dt.datetime(2024, 2, 3, 4, 5, 6)
    store.publish_version(spark, str(tmp_path), "a", at)
    with pytest.raises(FileExistsError):
        store.publish_version(spark, str(tmp_path), "a", at)


def test_publishing_nothing_is_no_error(spark, tmp_path, capsys):
    assert store.publish_version(spark, str(tmp_path), "a") is None
    assert "nothing to publish" in capsys.readouterr().out


def test_train_log_is_appended_per_rank(spark, tmp_path):
    path = str(tmp_path / "log")
    now = dt.datetime(2024, 1, 1)
    for epoch in (0, 1):
        rows = [("a", r, epoch, 0, 64, 32, 0.5, now) for r in (0, 1)]
        store.append_train_log(spark.createDataFrame(rows, schemas.TRAIN_LOG), path)
    back = store.read_train_log(spark, path)
    assert back.count() == 4 and back.filter("rank = 1").count() == 2
    plan = back.filter(F.col("rank") == 1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(rank" in plan
