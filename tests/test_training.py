"""Training on generated separable images: the class decides which block of the image is bright."""

import shutil

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gridloom.operators import metrics, parameters
from gridloom.training import arch, fit, kernels, model

CLASSES = 4


@pytest.fixture(scope="module")
def examples(spark):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(480):
        label = i % CLASSES
        image = rng.integers(0, 80, (8, 8))
        r, c = divmod(label, 2)
        image[r * 4:r * 4 + 4, c * 4:c * 4 + 4] += 150
        rows.append(("test" if i % 5 == 0 else "train", i, label, image.ravel().tolist()))
    return spark.createDataFrame(rows, "split string, idx bigint, label int, px array<int>").repartition(4).cache()


@pytest.fixture(scope="module")
def train(examples):
    return examples.filter("split = 'train'")


def net(name):
    return arch.arch(name, 8, 8, CLASSES)


def same(a, b, **tolerance):
    return a.keys() == b.keys() and all(np.allclose(a[k], b[k], **tolerance) for k in a)


def test_step_sync_with_two_ranks_equals_one_rank_with_the_double_batch(train):
    """384 rows divide evenly, so both runs see the same rows in every step."""
    two = fit.fit(train, net("B"), world=2, batch=32, sync="step")
    one = fit.fit(train, net("B"), world=1, batch=64, sync="epoch")
    assert same(two.params, one.params, atol=1e-5)


def test_step_sync_in_blocks_gives_the_same(train, monkeypatch):
    whole = fit.fit(train, net("softmax"), world=2, sync="step")
    monkeypatch.setattr(fit, "BLOCK_STEPS", 2)
    cut = fit.fit(train, net("softmax"), world=2, sync="step")
    assert same(whole.params, cut.params, rtol=0, atol=0) and cut.log.count() == whole.log.count() == 6


@pytest.mark.parametrize("sync", ["epoch", "step"])
def test_averaging_level_by_level_gives_the_same(train, monkeypatch, sync):
    flat = fit.fit(train, net("C"), world=5, batch=20, sync=sync)
    monkeypatch.setattr(fit, "FAN", 2)
    monkeypatch.setattr(fit, "CHUNK", 1000)
    tree = fit.fit(train, net("C"), world=5, batch=20, sync=sync)
    assert same(flat.params, tree.params, rtol=0, atol=1e-6)
    rows = [sorted((r.rank, r.batch_idx, r.n_samples, r.n_correct) for r in done.log.collect()) for done in (flat, tree)]
    assert rows[0] == rows[1] and len(rows[0]) == 20 and {r[0] for r in rows[0]} == set(range(5))


@pytest.mark.parametrize("sync", ["epoch", "step"])
def test_gradients_over_pieces_equal_those_of_whole_minibatches(train, monkeypatch, sync):
    whole = fit.fit(train, net("B"), world=2, batch=50, sync=sync)
    monkeypatch.setattr(fit, "PIECE_BYTES", 7 * 64 * 4)
    cut = fit.fit(train, net("B"), world=2, batch=50, sync=sync)
    assert same(whole.params, cut.params, atol=1e-5)
    logs = [sorted((r.rank, r.batch_idx, r.n_samples, r.n_correct, round(r.loss, 4)) for r in x.log.collect()) for x in (whole, cut)]
    assert logs[0] == logs[1] and len(logs[0]) == 8


def test_a_minibatch_too_large_for_batch_norm_is_refused(train):
    with pytest.raises(ValueError, match="batch-norm"):
        fit.fit(train, net("C"), batch=1 << 30)


def test_pieces_depend_on_the_minibatch_only():
    import pyarrow as pa

    x = np.arange(46, dtype=np.uint8).reshape(23, 2)
    for cuts in ([0, 23], [0, 1, 4, 9, 23], list(range(24))):
        batches = [
            pa.RecordBatch.from_arrays([pa.array([3] * (j - i), pa.int32()), fit._byte_rows(x[i:j]), pa.array(x[i:j, 0].astype(np.int32))], ["rank", "x", "y"])
            for i, j in zip(cuts, cuts[1:])]
        got = list(fit._pieces(batches, 10, 4, 2))
        assert [len(y) for _, _, y, _ in got] == [4, 4, 2, 4, 4, 2, 3] and [last for *_, last in got] == [False, False, True] * 2 + [True]
        assert (np.concatenate([p[1] for p in got]) == x).all() and {p[0] for p in got} == {3}


def test_values_beyond_a_byte_keep_their_size():
    import pyarrow as pa

    for x in ([[0, 255]], [[-1, 7]], [[0, 256]]):
        assert (fit._unpacked(fit._byte_rows(np.array(x)), 2) == np.array(x)).all()
    assert (fit._unpacked(fit._byte_rows(np.array([[0.5, -3.0]])), 2) == [[0.5, -3.0]]).all()
    mixed = pa.concat_arrays([fit._byte_rows(np.array([[1, 2]])), fit._byte_rows(np.array([[0.5, 2.0]]))])
    assert (fit._unpacked(mixed, 2) == [[1, 2], [0.5, 2]]).all()


def test_a_run_reads_its_source_once_and_leaves_no_copy(spark, train, tmp_path):
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(len(batch))
            yield batch

    source = train.mapInArrow(counted, train.schema)
    fit.fit(source, net("softmax"), world=3, epochs=3, root=str(tmp_path), run_id="a")
    assert reads.value == train.count()
    assert not (tmp_path / "a" / "rows").exists()
    left = {p.parent.parent.name for p in (tmp_path / "a" / "epochs").glob("epoch=*/save_id=*/kind=model")}
    assert left == {"epoch=2"}
    assert fit.fit_log(spark, str(tmp_path), "a").select("epoch").distinct().count() == 3


def test_an_epoch_shuffles_its_rows_once_and_a_step_reads_its_own_minibatches(spark, train, tmp_path):
    from gridloom.operators import ordering

    fit.write_rows(train, ["split", "idx"], str(tmp_path / "rows"), 64, CLASSES, "px", "label", 1)
    placed, n = ordering.read_in_order(spark, str(tmp_path / "rows"), "y int, x binary")
    dealt = ordering.deal(placed, n, 4, 1, 0).repartitionById(4, F.col("rank"))
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") - plan.count("BroadcastExchange") == 1
    cfg = fit.Settings(net("softmax"), arch.sgd(), 16, 1, 0, 255.0, None)
    packed = fit._kept_row_by_row(fit._packed_minibatches(cfg, ordering.deal(placed, n, 4, 1, 0), 4))
    assert packed.count() == 4 * 6
    step = packed.filter("step = 2")
    assert step.count() == 4
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = packed.filter("step = 2")._jdf.queryExecution().executedPlan()
        plan.execute().count()
        assert plan.collectLeaves().head().metrics().get("numOutputRows").get().value() == 4
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    packed.unpersist()


def test_result_does_not_depend_on_partitions(train):
    a = fit.fit(train, net("C"), world=2)
    b = fit.fit(train.repartition(11), net("C"), world=2)
    assert same(a.params, b.params, rtol=0, atol=0)


@pytest.mark.parametrize("name, opt", [("softmax", arch.sgd(0.05)), ("D", arch.adam(0.003)), ("A", arch.sgd(0.02))])
def test_loss_falls_and_held_out_accuracy_is_high(examples, train, name, opt):
    done = fit.fit(train, net(name), world=2, batch=16, epochs=3, opt=opt)
    losses = {r.epoch: r.l for r in done.log.groupBy("epoch").agg(F.avg("loss").alias("l")).collect()}
    assert losses[2] < 0.5 * losses[0]
    rows = model.evaluate(model.predict(examples, net(name), done.params), CLASSES).collect()
    by_split = {r.split: (r.n_rows, r.accuracy) for r in rows}
    assert by_split["test"][0] == 96 and by_split["test"][1] > 90
    assert sum(r.n for r in rows if r.split == "test") == 96


def test_log_covers_every_padded_row(train):
    log = fit.fit(train, net("softmax"), world=5, batch=16).log
    assert {r["rank"]: r.n for r in log.groupBy("rank").agg(F.sum("n_samples").alias("n")).collect()} == {
        r: 77 for r in range(5)
    }
    assert metrics.epoch_loss(log).count() == 5


def test_replicas_differ_by_what_each_rank_saw(spark, train, tmp_path):
    done = fit.fit(train, net("softmax"), world=3, root=str(tmp_path), run_id="a")
    rows = {r.name: r for r in parameters.replica_check(fit.replicas(spark, str(tmp_path), "a", 0)).collect()}
    assert rows["fc.weight/0"].n_replicas == 3 and not rows["fc.weight/0"].consistent
    one = fit.fit(train, net("softmax"), world=1, root=str(tmp_path), run_id="b")
    rows = parameters.replica_check(fit.replicas(spark, str(tmp_path), "b", 0)).collect()
    assert all(r.consistent for r in rows) and done.params.keys() == one.params.keys()


def test_replicas_leave_out_a_lost_attempt(spark, train, tmp_path):
    fit.fit(train, net("softmax"), world=4, root=str(tmp_path), run_id="a")
    lost = tmp_path / "a" / "epochs" / "epoch=0"
    done = next(lost.glob("save_id=*"))
    fit.fit(train, net("softmax"), world=2, root=str(tmp_path), run_id="b")
    shutil.copytree(done, tmp_path / "b" / "epochs" / "epoch=0" / "save_id=lost")
    rows = parameters.replica_check(fit.replicas(spark, str(tmp_path), "b", 0)).collect()
    assert {r.n_replicas for r in rows} == {2}


def test_wrong_labels_and_no_rows_are_refused(train):
    with pytest.raises(Exception, match="label not in"):
        fit.fit(train.withColumn("label", F.when(F.col("idx") == 3, -1).otherwise(F.col("label"))), net("softmax"), world=2)
    with pytest.raises(ValueError, match="no rows"):
        fit.fit(train.limit(0), net("softmax"))


def test_more_ranks_than_rows(train):
    done = fit.fit(train.orderBy("idx").limit(3), net("softmax"), world=8, batch=4)
    assert done.log.agg(F.sum("n_samples")).first()[0] == 8


@pytest.mark.parametrize("sync", ["epoch", "step"])
def test_resume_equals_an_uninterrupted_run(train, tmp_path, sync):
    whole = fit.fit(train, net("C"), world=2, epochs=2, sync=sync, root=str(tmp_path), run_id="whole", seed=3)
    fit.fit(train, net("C"), world=2, epochs=1, sync=sync, root=str(tmp_path), run_id="cut", seed=3)
    resumed = fit.fit(train, net("C"), world=2, epochs=2, sync=sync, root=str(tmp_path), run_id="cut", seed=99)
    assert same(whole.params, resumed.params, rtol=0, atol=0)
    assert resumed.log.select("epoch").distinct().count() == 2


def test_resuming_a_finished_run_does_nothing(train, tmp_path):
    first = fit.fit(train, net("softmax"), root=str(tmp_path), run_id="a")
    again = fit.fit(train, net("softmax"), root=str(tmp_path), run_id="a")
    assert same(first.params, again.params, rtol=0, atol=0) and again.log.count() == first.log.count()


def test_frozen_parameters_stay(train):
    start = arch.init_params(net("C"), 42)
    done = fit.fit(train, net("C"), train_only=("fc2", "bn"))
    changed = {k for k in start if not np.array_equal(start[k], done.params[k])}
    assert {"fc2.weight", "fc2.bias", "bn1.weight"} <= changed
    assert not {k for k in changed if k.startswith(("conv", "fc1"))}


def test_head_on_frozen_features(examples, train):
    frozen = net("C")
    params = arch.init_params(frozen)
    upto = [layer[0] for layer in frozen.layers].index("flatten") + 1
    head, done = fit.fit_head(train, frozen, params, upto, classes=CLASSES, world=2, epochs=3, batch=16, opt=arch.adam(0.01))
    features = model.featurize(examples.filter("split = 'test'"), frozen, params, upto)
    predicted = model.predict(features, head, done.params, source="features", denom=1.0)
    assert metrics.accuracy(predicted).first().accuracy > 90


def test_prediction_equals_the_plain_forward_pass_and_leaves_the_model_alone(examples):
    layout, params = net("D"), arch.init_params(net("D"), 1)
    before = {k: v.copy() for k, v in params.items()}
    got = {r.idx: r for r in model.predict(examples, layout, params).collect()}
    for r in examples.limit(20).collect():
        x = np.array(r.px, np.float32).reshape(1, 1, 8, 8) / np.float32(255)
        want = kernels.forward(layout.layers, params, x)[0][0]
        assert np.allclose(got[r.idx].scores, want, atol=1e-5) and got[r.idx].pred == want.argmax()
    assert same(before, params, rtol=0, atol=0)


def test_prediction_refuses_the_wrong_image_size(examples):
    wrong = arch.arch("softmax", 7, 7, CLASSES)
    with pytest.raises(PySparkException, match="expected 49"):
        model.predict(examples, wrong, arch.init_params(wrong)).collect()


def test_rows_do_not_pass_through_one_task(train):
    """Training rows are shuffled by range and by rank only."""
    from gridloom.operators import ordering

    plan = ordering.shard(train, ["split", "idx"], 4)._jdf.queryExecution().executedPlan().toString()
    assert "px" not in plan[plan.index("SinglePartition"):].split("InMemoryTableScan")[0]


def test_unknown_sync(train):
    with pytest.raises(ValueError):
        fit.fit(train, net("softmax"), sync="never")


def test_shared_arrays_are_mapped_read_only_and_written_once(spark):
    arrays = {"model": {"a": np.arange(5, dtype=np.float32), "b": np.ones((2, 3)), "none": np.empty((0, 4), np.int64)}, "empty": {}}
    first, again = (model.share_arrays(spark, arrays, kept=True) for _ in range(2))
    other = model.share_arrays(spark, {"model": {"a": np.arange(1, 6, dtype=np.float32)}})
    assert first.path == again.path != other.path
    assert same(first.value["model"], arrays["model"], rtol=0, atol=0) and first.value["empty"] == {}
    with pytest.raises(ValueError):
        first.value["model"]["a"][0] = 1
    other.unpersist()
    with pytest.raises(FileNotFoundError):
        other.value
    read = spark.range(4, numPartitions=4).mapInPandas(lambda parts: (p.assign(x=first.value["model"]["b"].sum()) for p in parts), "id long, x double")
    assert {r.x for r in read.collect()} == {6.0}


def test_a_model_of_more_than_two_gigabytes_is_mapped(spark, tmp_path):
    """A file with holes stands for the model, so that the test needs no room."""
    path, size = tmp_path / "model", (2 << 30) + 4096
    with open(path, "wb") as f:
        f.truncate(size)
        f.seek(size - 4)
        f.write(np.float32(7).tobytes())
    shared = model.SharedArrays(str(path), {"model": [("w", "<f4", (size // 4,), 0)]})
    got = spark.range(2, numPartitions=2).mapInPandas(lambda parts: (p.assign(x=float(shared.value["model"]["w"][-1])) for p in parts), "id long, x double")
    assert {r.x for r in got.collect()} == {7.0}


def test_step_sync_sends_no_gradients_or_parameters_to_the_driver(train, monkeypatch):
    """Steps are averaged and applied in tasks; before, every step brought the averaged gradient to the driver through toArrow."""
    one = fit.fit(train, net("B"), world=1, batch=64, sync="epoch")

    def refused(self):
        raise AssertionError("a step sent its rows to the driver")

    monkeypatch.setattr(type(train), "toArrow", refused)
    two = fit.fit(train, net("B"), world=2, batch=32, sync="step")
    assert same(two.params, one.params, atol=1e-5) and two.log.count() == 12


def _jobs(spark, group, run):
    spark.sparkContext.setJobGroup(group, group)
    try:
        done = run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return done, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_step_sync_takes_as_many_jobs_for_many_steps_as_for_few(spark, train):
    """Before, every step was a job of its own, so the time grew by a job's start-up with every minibatch."""
    few, jobs = _jobs(spark, "few", lambda: fit.fit(train, net("softmax"), world=2, batch=96, sync="step"))
    many, same_jobs = _jobs(spark, "many", lambda: fit.fit(train, net("softmax"), world=2, batch=8, sync="step"))
    assert few.log.count() == 4 and many.log.count() == 48 and jobs == same_jobs


@pytest.mark.parametrize("options", [{"opt": arch.adam(), "epochs": 2}, {"train_only": ("fc2", "bn")}, {"opt": arch.sgd(weight_decay=0.1), "batch": 50}])
def test_step_sync_in_one_job_equals_a_job_for_each_step(train, monkeypatch, tmp_path, options):
    def run(name):
        return fit.fit(train, net("C"), world=3, **({"batch": 32} | options), sync="step", root=str(tmp_path), run_id=name)

    one = run("one")
    monkeypatch.setattr(fit, "barrier_slots", lambda spark: 2)
    each = run("each")
    assert same(one.params, each.params, rtol=0, atol=0) and same(one.opt, each.opt, rtol=0, atol=0)
    logs = [sorted(tuple(r) for r in done.log.drop("run_id", "ts").collect()) for done in (one, each)]
    assert logs[0] == logs[1] and len(logs[0]) >= 9
    assert not [p for name in ("one", "each") for p in (tmp_path / name).glob("steps/*/*")]
    assert not list((tmp_path / "one").glob("epochs/*/*/kind=[!l]*"))


def test_a_rank_that_fails_starts_the_epoch_again(train, monkeypatch, tmp_path):
    whole = fit.fit(train, net("C"), world=2, batch=32, sync="step")
    mean, failed = fit.Ranks.mean, str(tmp_path / "failed")

    def once(self, step, grads, stats):
        import os

        if self.rank == 1 and step == 3 and not os.path.exists(failed):
            open(failed, "w").close()
            raise OSError("lost")
        return mean(self, step, grads, stats)

    monkeypatch.setattr(fit.Ranks, "mean", once)
    again = fit.fit(train, net("C"), world=2, batch=32, sync="step")
    assert (tmp_path / "failed").exists() and again.log.count() == whole.log.count() == 12
    assert same(whole.params, again.params, rtol=0, atol=0) and same(whole.opt, again.opt, rtol=0, atol=0)
