"""Running figures against plain loops, with spans and chunks far shorter than the log and one hot rank."""

import random

import numpy as np
import pytest

from gridloom.operators import running

SCHEMA = "run_id string, rank int, epoch int, batch_idx bigint, n_samples int, n_correct int, loss double"


@pytest.fixture(scope="module")
def records():
    rnd = random.Random(5)
    rows = []
    for rank, batches in ((0, 120), (1, 30), (2, 1)):  # rank 0 holds most rows
        for epoch in range(3):
            numbers = sorted(rnd.sample(range(500), batches))
            rows += [("r", rank, epoch, b, 8, rnd.randrange(9), rnd.random() * 5) for b in numbers]
    return rows


@pytest.fixture(scope="module")
def log(spark, records):
    shuffled = records[:]
    random.Random(1).shuffle(shuffled)
    return spark.createDataFrame(shuffled, SCHEMA).repartition(6)


def by_key(df, *values):
    return {(r["rank"], r.epoch, r.batch_idx): tuple(r[v] for v in values) for r in df.collect()}


def loop(records, step):
    """Feed each rank's records in order to a fresh step(); collect what it returns."""
    out = {}
    for rank in {r[1] for r in records}:
        feed = step()
        for r in sorted((r for r in records if r[1] == rank), key=lambda r: (r[2], r[3])):
            out[(r[1], r[2], r[3])] = feed(r)
    return out


@pytest.mark.parametrize("span", [1, 7, 64, 65536])
def test_running_accuracy(log, records, span):
    def step():
        state = {"epoch": None}

        def feed(r):
            if r[2] != state["epoch"]:
                state.update(epoch=r[2], n=0, c=0)
            state["n"] += r[4]
            state["c"] += r[5]
            return (100.0 * state["c"] / state["n"],)
        return feed

    assert by_key(running.running_accuracy(log, span), "accuracy") == loop(records, step)


@pytest.mark.parametrize("span", [1, 7, 65536])
def test_running_loss_goes_on_over_epochs(log, records, span):
    def step():
        total = [0.0, 0]

        def feed(r):
            total[0] += r[6]
            total[1] += 1
            return tuple(total)
        return feed

    got, want = by_key(running.running_loss(log, span), "total_loss", "total_batches"), loop(records, step)
    assert got.keys() == want.keys()
    for k in want:
        assert got[k][0] == pytest.approx(want[k][0]) and got[k][1] == want[k][1]


@pytest.mark.parametrize("alpha, chunk", [(0.1, None), (0.1, 5), (0.9, 3), (0.001, 16)])
def test_smoothing(log, records, alpha, chunk, monkeypatch):
    if chunk:
        monkeypatch.setattr(running, "SPAN", chunk)

    def step():
        s = [0.0]

        def feed(r):
            s[0] = alpha * r[6] + (1 - alpha) * s[0]
            return (s[0],)
        return feed

    got, want = by_key(running.smooth_loss(log, alpha, span=50), "smoothed"), loop(records, step)
    assert got.keys() == want.keys()
    for k in want:
        assert got[k][0] == pytest.approx(want[k][0], rel=1e-9)


@pytest.mark.parametrize("value, later", [(float("nan"), "nan"), (float("inf"), "inf"), (1e300, None)])
def test_smoothing_never_forgets(spark, value, later):
    """One odd loss at the start of 20,000 batches, against the recurrence itself."""
    rows = spark.range(20_000).selectExpr(
        "'r' AS run_id", "0 AS rank", "cast(id div 10000 AS int) AS epoch", "id % 10000 AS batch_idx",
        f"CASE WHEN id = 3 THEN double('{value}') ELSE 0.0D END AS loss")
    got = {r.epoch * 10_000 + r.batch_idx: r.smoothed for r in running.smooth_loss(rows, 0.1, span=1000).collect()}
    s = 0.0
    for i in range(20_000):
        s = 0.1 * (value if i == 3 else 0.0) + 0.9 * s
        assert str(got[i]) == later if later and i >= 3 else got[i] == pytest.approx(s, rel=1e-6, abs=1e-320)


def test_smoothing_needs_a_proper_weight(log):
    with pytest.raises(ValueError):
        running.smooth_loss(log, 1.0)


@pytest.mark.parametrize("repeat", [False, True])
@pytest.mark.parametrize("span", [7, 65536])
def test_curves(log, records, repeat, span):
    want = []
    for rank in (0, 1, 2):
        point = 0
        for epoch in range(3):
            n = c = 0
            for r in sorted((r for r in records if r[1:3] == (rank, epoch)), key=lambda r: r[3]):
                n, c = n + r[4], c + r[5]
                want.append((rank, point, "batch", r[6], 100.0 * c / n))
                point += 1
            if repeat:
                want.append((rank, point, "epoch", None, 100.0 * c / n))
                point += 1
    got = [
        (r["rank"], r.point, r.kind, r.loss, r.accuracy) for r in running.curves(log, repeat, span).collect()
    ]
    assert sorted(got, key=lambda r: r[:2]) == want


def test_progress_rows(log, records):
    got = by_key(running.progress_rows(log, 50), "loss")
    assert got == {(r[1], r[2], r[3]): (r[6],) for r in records if r[3] % 50 == 0}


def test_no_task_holds_a_whole_rank(log):
    """Rows are only ever shuffled by (run, rank, epoch, span); the per-rank windows see span totals."""
    plan = running.running_loss(log)._jdf.queryExecution().executedPlan().toString()
    wide = [line for line in plan.splitlines() if "Exchange hashpartitioning(run_id" in line and "_span" not in line]
    assert len(wide) == 1  # the totals


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 5000])
@pytest.mark.parametrize("odd", [{}, {0.3: "nan"}, {0.2: "inf"}, {0.1: "-inf", 0.7: "inf"}, {0.5: "-inf"}])
def test_blocked_recurrence_equals_a_loop(n, odd):
    x = np.random.default_rng(n).normal(size=n)
    for place, value in odd.items():
        if n:
            x[int(place * n)] = float(value)
    for decay in (0.9, 1e-5, 0.99999):
        want, s = [], 0.0
        for v in x.tolist():
            s = v + decay * s
            want.append(s)
        assert np.allclose(running.recurrence(x, decay), want, rtol=1e-12, atol=1e-12, equal_nan=True)


def test_smoothing_shuffles_its_rows_once(spark):
    log = spark.range(100).selectExpr("'a' AS run_id", "0 AS rank", "0 AS epoch", "id AS batch_idx", "1.0D AS loss", "'long text' AS note")
    done = running.smooth_loss(log)
    done.collect()
    plan = done._jdf.queryExecution().executedPlan().toString()
    final = plan.split("Initial Plan")[0]
    assert final.count("ReusedExchange") == 1 and final.count("FlatMapGroupsInArrow") == 3
