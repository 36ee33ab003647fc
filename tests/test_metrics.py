import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridloom.operators import metrics, parameters
from gridloom.training import model


def predictions(spark, pairs):
    return spark.createDataFrame([("test", a, b) for a, b in pairs], "split string, label int, pred int")


PAIRS = [(0, 0), (0, 1), (1, 1), (2, 0), (2, 2), (2, 2)]


def test_histogram_with_a_hot_label_combines_before_the_shuffle(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5).alias("label"))
    counts = metrics.label_histogram(df)
    assert counts.agg(F.sum("n")).first()[0] == 3000
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan


@pytest.mark.parametrize("unit, value", [("percent", 100 * 4 / 6), ("fraction", 4 / 6)])
def test_accuracy(spark, unit, value):
    row = metrics.accuracy(predictions(spark, PAIRS), unit).first()
    assert (row.n_rows, row.n_correct) == (6, 4) and row.accuracy == pytest.approx(value)


def test_accuracy_of_nothing_is_null(spark):
    assert metrics.accuracy(predictions(spark, []), "percent").first().accuracy is None


def test_confusion_counts_keep_zero_cells_and_agree_with_accuracy(spark):
    cells = {(r.truth, r.predicted): r.n for r in metrics.confusion_matrix(predictions(spark, PAIRS), 3).collect()}
    assert len(cells) == 9 and sum(cells.values()) == 6
    assert cells[(2, 2)] == 2 and cells[(1, 0)] == 0
    assert sum(n for (a, b), n in cells.items() if a == b) == 4


def test_confusion_has_no_cell_for_classes_beyond_k(spark):
    cells = metrics.confusion_matrix(predictions(spark, PAIRS + [(5, 0), (0, 9)]), 3, outside="count")
    assert cells.agg(F.sum("n")).first()[0] == 6


ODD = PAIRS + [(12, 12), (11, 0), (0, None), (None, 0), (3, -1)]


def test_rows_outside_the_classes_are_counted_or_refused(spark):
    df = predictions(spark, ODD)
    cells = metrics.confusion_matrix(df, 3, outside="count").collect()
    assert {r.n_outside for r in cells} == {5} and sum(r.n for r in cells) == 6 and len(cells) == 9
    with pytest.raises(Exception, match="5 rows outside the classes"):
        metrics.confusion_matrix(df, 3).collect()
    only = metrics.confusion_matrix(predictions(spark, [(7, 7)]), 2, outside="count").collect()
    assert [(r.n, r.n_outside) for r in only] == [(0, 1)] * 4


def test_evaluation_counts_every_row(spark):
    df = predictions(spark, ODD)
    rows, whole = model.evaluate(df, 3).collect(), metrics.accuracy(df).first()
    assert {(r.n_rows, r.accuracy, r.n_outside) for r in rows} == {(11, whole.accuracy, 5)} and whole.n_correct == 5
    assert sum(r.n for r in rows) == 6


def test_confusion_of_nothing_is_all_zero(spark):
    rows = metrics.confusion_matrix(predictions(spark, []), 2).collect()
    assert len(rows) == 4 and {r.n for r in rows} == {0}


def test_confusion_pivot(spark):
    rows = metrics.confusion_matrix(predictions(spark, PAIRS), 3, pivot=True).orderBy("truth").collect()
    assert [tuple(r) for r in rows] == [(0, 1, 1, 0), (1, 0, 1, 0), (2, 1, 0, 2)]


T0 = dt.datetime(2024, 1, 1)
# run, rank, epoch, batch, samples, correct, loss: rank 0 has two batches per epoch, rank 1 too, the last one short.
LOG = [
    ("r", 0, 0, 0, 4, 1, 8.0), ("r", 0, 0, 1, 2, 1, 6.0), ("r", 1, 0, 0, 4, 2, 4.0), ("r", 1, 0, 1, 2, 0, 2.0),
    ("r", 0, 1, 0, 4, 4, 1.0), ("r", 0, 1, 1, 2, 1, 3.0), ("r", 1, 1, 0, 4, 2, 5.0), ("r", 1, 1, 1, 2, 2, 7.0),
]


@pytest.fixture(scope="module")
def log(spark):
    rows = [(*r, T0 + dt.timedelta(seconds=1.5 * i)) for i, r in enumerate(LOG)]
    return spark.createDataFrame(
        rows, "run_id string, rank int, epoch int, batch_idx bigint, n_samples int, n_correct int, loss double, ts timestamp"
    )


def test_epoch_loss_is_not_weighted_by_batch_size(log):
    got = {(r["rank"], r.epoch): r.epoch_loss for r in metrics.epoch_loss(log).collect()}
    assert got == {(0, 0): 7.0, (1, 0): 3.0, (0, 1): 2.0, (1, 1): 6.0}


def test_epoch_accuracy_is_weighted_by_samples(log):
    got = {(r["rank"], r.epoch): r.epoch_accuracy for r in metrics.epoch_accuracy(log).collect()}
    assert got[(0, 0)] == pytest.approx(100 * 2 / 6) and got[(0, 1)] == pytest.approx(100 * 5 / 6)


def test_run_summary_variants(log):
    row = metrics.run_summary(log).first()
    assert row.final_accuracy == pytest.approx((100 * 5 / 6 + 100 * 4 / 6) / 2)
    # All losses over rank 0's four batches is twice the true mean, because two ranks are added up.
    assert row.loss_by_rank0 == 36 / 4 and row.loss_mean == 36 / 8
    assert row.loss_last_by_world == 16 / 2


def test_accuracy_is_divided_by_the_world_size_once(log):
    assert metrics.run_summary(log).first().final_accuracy > 100 / 4


def test_reduce_and_duration(log):
    row = metrics.reduce_ranks(log).first()
    assert (row.world, row.n_batches, row.total_loss, row.n_correct, row.n_samples) == (2, 8, 36.0, 13, 24)
    assert metrics.run_duration(log).first().seconds == 10.5


def test_latest_checkpoint(spark):
    saved = spark.createDataFrame([("a", 0, 1.0), ("a", 3, None), ("b", 1, 0.5)], "run_id string, epoch int, loss double")
    rows = {r.run_id: (r.saved_epoch, r.start_epoch, r.loss) for r in metrics.latest_checkpoint(saved).collect()}
    assert rows == {"a": (3, 4, 0.0), "b": (1, 2, 0.5)}


# --- parameters ----------------------------------------------------------------------------------------------

def tensors(spark, rows):
    return spark.createDataFrame(rows, "name string, rank int, vals array<float>")


def test_replica_check_finds_the_rank_that_differs(spark):
    df = tensors(spark, [
        ("same", 0, [1.0, 2.0]), ("same", 1, [1.0, 2.00005]), ("same", 2, [1.0, 2.0]),
        ("off", 0, [1.0, 2.0]), ("off", 1, [1.0, 2.0]), ("off", 2, [1.0, 2.1]),
    ])
    rows = {r.name: r for r in parameters.replica_check(df).collect()}
    assert rows["same"].consistent and not rows["off"].consistent
    assert rows["off"].max_gap == pytest.approx(0.1, abs=1e-6) and rows["off"].n_replicas == 3


def test_replica_check_allows_a_relative_gap(spark):
    df = tensors(spark, [("w", 0, [1000.0]), ("w", 1, [1000.005]), ("w", 2, [999.995])])
    assert parameters.replica_check(df).first().consistent
    assert not parameters.replica_check(df, rtol=0.0).first().consistent


def test_replica_check_without_rank_zero_is_not_consistent(spark):
    assert not parameters.replica_check(tensors(spark, [("w", 1, [1.0])])).first().consistent


def test_param_summary(spark):
    df = tensors(spark, [("a", 0, [1.0, 2.0]), ("b", 0, [3.0])])
    assert {r.name: r.n_params for r in parameters.param_summary(df).collect()} == {"a": 2, "b": 1, None: 3}
