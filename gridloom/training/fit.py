"""Data-parallel training as Spark jobs.

The source is read once a run: its rows are written in a shuffled order, with their values packed into bytes. An epoch's order is a
permutation of the places in that order, so dealing the rows to `world` ranks is one shuffle of packed rows and nothing else.

sync="epoch"  One job per epoch. Each rank's rows go to one partition and stream through mapInArrow; the ranks' parameters are averaged
              once per epoch. Tasks are independent and a lost one is simply run again. The form for large clusters.
sync="step"   One job per epoch, a barrier stage of one task for each rank: every rank computes the gradient of its minibatch, the ranks
              average them through files in the shared folder and every rank takes the same update. Exact data-parallel steps, at the
              price of a few small files each; a lost task starts the epoch again. Where a barrier stage can't run, as with fewer slots
              than ranks or with dynamic allocation, each step is a job of its own with the same results: the epoch's rows are kept as
              packed minibatches, one row per rank and step, of which a step reads its own only.

Gradients of a minibatch are added up over pieces of at most PIECE_BYTES, so its size does not bound memory. Batch-norm needs a whole
minibatch at once; one of more than WHOLE_BYTES is refused there.

Between jobs, parameters and gradients of the ranks are averaged in Spark, chunk by chunk, FAN ranks at a time, level by level; what
comes to the driver is one model an epoch. Rows never reach the driver.
"""

import time
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  pa.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.operators import layers, ordering
from gridloom.session import barrier_slots, is_written, locate, remove, shared_dir
from gridloom.sinks import store
from gridloom.training import kernels
from gridloom.training.arch import Arch, init_params, n_classes, sgd
from gridloom.training.model import featurize, share_arrays

CHUNK = 16384
FAN = 32
BLOCK_STEPS = 128  # log records of so many steps are written together
PIECE_BYTES = 1 << 20
WHOLE_BYTES = 256 << 20

OUTPUT = (
    "kind string, rank int, batch_idx bigint, n_samples int, n_correct int, loss double, ts timestamp, "
    "name string, shape array<int>, chunk int, vals array<float>"
)
ARROW_OUTPUT = pa.schema([
    ("kind", pa.string()), ("rank", pa.int32()), ("batch_idx", pa.int64()), ("n_samples", pa.int32()),
    ("n_correct", pa.int32()), ("loss", pa.float64()), ("ts", pa.timestamp("us", tz="UTC")),
    ("name", pa.string()), ("shape", pa.list_(pa.int32())), ("chunk", pa.int32()), ("vals", pa.list_(pa.float32())),
])
LOG_COLUMNS = ["kind", "rank", "batch_idx", "n_samples", "n_correct", "loss", "ts"]


@dataclass
class FitResult:
    run_id: str
    params: dict
    opt: dict
    log: DataFrame
    root: str


@dataclass(frozen=True)
class Settings:
    """What a task needs besides its rows and the shared parameters."""
    net: Arch
    opt: dict
    batch: int
    seed: int
    epoch: int
    denom: float
    train_only: tuple | None


def _record(kind, rank, step, n, correct, loss):
    return {
        "kind": kind, "rank": rank, "batch_idx": step, "n_samples": n, "n_correct": correct, "loss": loss,
        "ts": datetime.now(timezone.utc),
    }


def _chunks(kind, rank, arrays):
    for name, a in arrays.items():
        flat = a.astype(np.float32).ravel()
        for c, at in enumerate(range(0, len(flat), CHUNK)):
            yield {
                "kind": kind, "rank": rank, "name": name, "shape": list(a.shape), "chunk": c,
                "vals": flat[at:at + CHUNK],
            }


def _batch_norm(net):
    return any(layer[0] == "batch_norm" for layer in net.layers)


def _piece_rows(net, batch):
    """Rows of a minibatch that are held at once."""
    row = 4 * net.channels * net.height * net.width
    if not _batch_norm(net):
        return max(1, PIECE_BYTES // row)
    if batch * row > WHOLE_BYTES:
        raise ValueError(f"batch-norm needs all {batch} rows of a minibatch at once, more than {WHOLE_BYTES} bytes")
    return batch


class Minibatch:
    """Loss, gradients and batch-norm statistics of one minibatch, added up piece by piece."""

    def __init__(self, cfg, params, rank, step):
        self.cfg, self.params, self.rank, self.step = cfg, params, rank, step
        self.rng = np.random.default_rng([cfg.seed, cfg.epoch, rank, step])
        self.n, self.right, self.loss, self.sums, self.stats = 0, 0, 0.0, {}, {}

    def add(self, x, y):
        net = self.cfg.net
        x = x.astype(np.float32).reshape(-1, net.channels, net.height, net.width) / np.float32(self.cfg.denom)
        scores, tape, self.stats = kernels.forward(net.layers, self.params, x, self.rng)
        loss, g = kernels.cross_entropy(scores, y)
        grads = kernels.backward(net.layers, self.params, tape, g)
        self.n, self.right, self.loss = self.n + len(y), self.right + int((scores.argmax(axis=1) == y).sum()), self.loss + loss * len(y)
        for name, v in grads.items():
            if not self.cfg.train_only or name.startswith(self.cfg.train_only):
                self.sums[name] = self.sums.get(name, 0) + v * np.float32(len(y))

    def record(self):
        return _record("log", self.rank, self.step, self.n, self.right, self.loss / self.n)

    def gradients(self):
        return {name: v / np.float32(self.n) for name, v in self.sums.items()}


def _mix_statistics(params, stats):
    """Running figures take a tenth of the new value; the variance in its unbiased form."""
    for name, (mean, var, n) in stats.items():
        for key, new in (("running_mean", mean), ("running_var", var * (n / max(n - 1, 1)))):
            old = params[f"{name}.{key}"]
            params[f"{name}.{key}"] = (0.9 * old + 0.1 * new).astype(old.dtype)


# --- packed rows ---------------------------------------------------------------------------------------------

def _byte_rows(x):
    """Each row of a matrix as bytes: one byte a value if all are whole numbers from 0 to 255, else four."""
    small = np.issubdtype(x.dtype, np.integer) and (not x.size or (x.min() >= 0 and x.max() <= 255))
    x = np.ascontiguousarray(x, np.uint8 if small else np.float32)
    offsets = np.arange(len(x) + 1, dtype=np.int64) * (x.shape[1] * x.itemsize)
    return pa.Array.from_buffers(pa.large_binary(), len(x), [None, pa.py_buffer(offsets), pa.py_buffer(x)]).cast(pa.binary())


def _unpacked(column, width):
    """Matrix of a column of packed rows."""
    rows = column.to_pylist()
    sizes = {len(r) for r in rows}
    if sizes == {width}:
        return np.frombuffer(b"".join(rows), np.uint8).reshape(-1, width)
    if sizes == {4 * width}:
        return np.frombuffer(b"".join(rows), np.float32).reshape(-1, width)
    return np.stack([np.frombuffer(r, np.uint8 if len(r) == width else np.float32).astype(np.float32) for r in rows])


def write_rows(examples, keys, folder, width, classes, source, label, seed):
    """Pack x and y of all rows and write them in shuffled order; reads the source once."""
    y = F.col(label).cast("int")
    known = F.when(y.between(0, classes - 1), y).otherwise(F.raise_error(F.concat(
        F.lit(f"label not in 0..{classes - 1}: "), F.coalesce(F.col(label).cast("string"), F.lit("null")))).cast("int"))
    needed = examples.select(*keys, known.alias("y"), F.col(source).alias("x"))

    def pack(batches):
        for batch in batches:
            packed = _byte_rows(layers.to_matrix(batch.column("x"), width))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], packed], names=batch.schema.names)

    fields = needed.schema.fields[:-1]
    packed = needed.mapInArrow(pack, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", x binary")
    ordering.write_in_order(packed, list(keys), folder, seed)


# --- one job per epoch ---------------------------------------------------------------------------------------

def _pieces(batches, size, most, width):
    """(rank, matrix, labels, last) of at most `most` rows each; `last` ends a minibatch of `size` rows. Where a minibatch is cut
    depends on its own rows only."""
    xs, ys, held, done, rank = [], [], 0, 0, None
    for batch in batches:
        if not len(batch):
            continue
        ranks = batch.column(0).to_numpy(zero_copy_only=False)
        if (ranks != (ranks[0] if rank is None else rank)).any():
            raise RuntimeError("a partition holds rows of more than one rank")
        rank = int(ranks[0])
        x, y = _unpacked(batch.column(1), width), batch.column(2).to_numpy(zero_copy_only=False)
        while len(y):
            take = min(most - held, size - done - held, len(y))
            xs.append(x[:take])
            ys.append(y[:take])
            held, x, y = held + take, x[take:], y[take:]
            if held == most or done + held == size:
                done = (done + held) % size
                yield rank, np.concatenate(xs), np.concatenate(ys), done == 0
                xs, ys, held = [], [], 0
    if held:
        yield rank, np.concatenate(xs), np.concatenate(ys), True
    elif done:
        yield rank, None, None, True


def _rank_task(cfg, shared, folder=None, n_steps=None):
    """Train on one rank's stream of rows; emit the log, then the final parameters.

    folder: where the ranks average their gradients at every one of n_steps steps; all end with the same parameters, and rank 0 emits them.
    """
    width = cfg.net.channels * cfg.net.height * cfg.net.width

    def run(batches):
        ranks = Ranks(folder) if folder else None
        params = {n: a.copy() for n, a in shared.value["model"].items()}
        state = {n: a.copy() for n, a in shared.value["optimizer"].items()}
        rank, log, step, now = None, [], 0, None
        for rank, x, y, last in _pieces(batches, cfg.batch, _piece_rows(cfg.net, cfg.batch), width):
            now = now or Minibatch(cfg, params, rank, step)
            if x is not None:
                now.add(x, y)
            if not last:
                continue
            if ranks and (rank != ranks.rank or step >= n_steps):
                raise RuntimeError(f"minibatch {step} of rank {rank} is not one of the {n_steps} of rank {ranks.rank}")
            grads, stats = ranks.mean(step, now.gradients(), now.stats) if ranks else (now.gradients(), now.stats)
            kernels.update(cfg.opt, params, grads, state)
            _mix_statistics(params, stats)
            record = now.record()
            log.append(record)
            step, now = step + 1, None
            if len(log) == 1000:
                yield pa.RecordBatch.from_pylist(log, schema=ARROW_OUTPUT)
                log = []
        if ranks and step != n_steps:  # the others would wait for ever
            raise RuntimeError(f"rank {ranks.rank} has {step} minibatches instead of {n_steps}")
        if rank is None:
            return
        if ranks and rank:
            yield pa.RecordBatch.from_pylist(log, schema=ARROW_OUTPUT)
            return
        last = {"kind": "last", "rank": rank, "name": "loss", "shape": [], "chunk": 0, "loss": record["loss"], "vals": []}
        yield pa.RecordBatch.from_pylist(log + [last], schema=ARROW_OUTPUT)
        for kind, arrays in (("model", params), ("optimizer", state)):
            for row in _chunks(kind, rank, arrays):
                yield pa.RecordBatch.from_pylist([row], schema=ARROW_OUTPUT)

    return run


def _sum_chunk(table):
    """Sum over some ranks of one chunk, in rank order; the other columns are those of the lowest rank."""
    table = table.sort_by("rank")
    vals = pa.array([np.add.reduce([v.values.to_numpy() for v in table.column("vals")])], pa.list_(pa.float64()))
    first = table.slice(0, 1)
    first = first.set_column(first.schema.get_field_index("vals"), "vals", vals)
    return first.set_column(first.schema.get_field_index("n"), "n", pa.array([sum(table.column("n").to_pylist())], pa.int32()))


def _average(rows, world, fan=None):
    """Mean over ranks of every parameter chunk, as arrays by kind and name, plus all other rows.

    Ranks are added up `fan` at a time, then those sums, until one is left for each chunk: that one comes to the driver.
    """
    fan = fan or FAN
    rows = rows.withColumn("vals", F.col("vals").cast("array<double>")).withColumn("n", F.lit(1))
    while world > 1:
        rows = rows.withColumn("rank", F.call_function("div", F.col("rank"), F.lit(fan)).cast("int")) if world > fan else rows
        by = ["kind", "name", "chunk", "rank"] if world > fan else ["kind", "name", "chunk"]
        rows = rows.groupBy(*by).applyInArrow(_sum_chunk, rows.schema)
        world = -(-world // fan) if world > fan else 1
    table = rows.toArrow().sort_by([("name", "ascending"), ("chunk", "ascending")])
    chunks, others = {}, []
    for r, vals in zip(table.drop_columns("vals").to_pylist(), table.column("vals")):
        if r["kind"] in ("model", "optimizer", "gradient"):
            chunks.setdefault((r["kind"], r["name"], tuple(r["shape"])), []).append((vals.values.to_numpy() / r["n"]).astype(np.float32))
        else:
            others.append(r | {"vals": vals.values.to_numpy() if vals.is_valid else None})
    arrays = {}
    for (kind, name, shape), means in chunks.items():
        arrays.setdefault(kind, {})[name] = np.concatenate(means).reshape(shape)
    return arrays, others


def _by_rank(dealt, world):
    """A partition per rank, in order."""
    return (
        dealt.select("rank", "pos_in_rank", "x", "y").repartitionById(world, F.col("rank"))
        .sortWithinPartitions("pos_in_rank").select("rank", "x", "y")
    )


def _epoch_job(spark, cfg, dealt, world, state, out):
    shared = share_arrays(spark, state)
    # Written out because both the log and the parameters are read from it.
    _by_rank(dealt, world).mapInArrow(_rank_task(cfg, shared), OUTPUT).write.partitionBy("kind").parquet(out)
    shared.unpersist()
    written = spark.read.schema(OUTPUT).parquet(out).filter(F.col("kind") != "log")
    averaged, lasts = _average(written.select("kind", "rank", "name", "shape", "chunk", "loss", "vals"), world)
    loss = min((r for r in lasts if r["kind"] == "last"), key=lambda r: r["rank"])["loss"]
    return {"model": averaged["model"], "optimizer": averaged.get("optimizer", {})}, loss


# --- one barrier stage per epoch -----------------------------------------------------------------------------

class Ranks:
    """The ranks of a barrier stage, one task each, seen from one of them; they hand their gradients on in a folder of the shared folder.

    A rank writes its gradient, averages its own slice of all ranks' gradients and reads the other ranks' slices. So it reads and writes
    about two gradients each a step, however many ranks there are. The sums are taken in rank order.

    A barrier stage runs all its tasks at once and ends them together, so a rank may wait for a file of another. It looks for the file
    itself: a call of BarrierTaskContext.barrier takes a second at least.
    """

    def __init__(self, folder):
        from pyspark import BarrierTaskContext

        context = BarrierTaskContext.get()
        self.rank = context.partitionId()
        # a folder for each attempt: tasks of a lost one may still write
        names = context.allGather(uuid.uuid4().hex)
        self.world = len(names)
        self.system, inner = locate(folder)
        self.folder = f"{inner}/{names[0]}"
        self.system.create_dir(self.folder, recursive=True)

    def _write(self, name, a):
        with self.system.open_output_stream(f"{self.folder}/{name}.part") as out:
            out.write(a.astype(np.float32).tobytes())
        self.system.move(f"{self.folder}/{name}.part", f"{self.folder}/{name}")

    def _read(self, name, at=0, end=None):
        pause = 0.0005
        while self.system.get_file_info(f"{self.folder}/{name}").type.name == "NotFound":
            time.sleep(pause)
            pause = min(1.2 * pause, 0.1)
        with self.system.open_input_file(f"{self.folder}/{name}") as f:
            end = f.size() // 4 if end is None else end
            return np.frombuffer(f.read_at(4 * (end - at), 4 * at), np.float32)

    def mean(self, step, grads, stats):
        """Gradients averaged over the ranks, and the batch-norm statistics of rank 0."""
        flat = np.concatenate([np.zeros(0, np.float32), *[g.ravel() for g in grads.values()]])
        cuts = [len(flat) * r // self.world for r in range(self.world + 1)]
        at, end = cuts[self.rank:self.rank + 2]
        self._write(f"gradient-{step}-{self.rank}", flat)
        total = np.zeros(end - at)
        for r in range(self.world):
            total += self._read(f"gradient-{step}-{r}", at, end)
        own = [total / self.world] + [v for mean, var, _ in stats.values() for v in (mean, var) if not self.rank]
        self._write(f"mean-{step}-{self.rank}", np.concatenate(own))
        if step:  # whoever has written a gradient has read the means of the step before
            self.system.delete_file(f"{self.folder}/mean-{step - 1}-{self.rank}")
        means = [self._read(f"mean-{step}-{r}") for r in range(self.world)]
        self.system.delete_file(f"{self.folder}/gradient-{step}-{self.rank}")  # whoever has written a mean has read the gradients
        means[0], first = np.split(means[0], [cuts[1]])
        flat, at, averaged, mixed = np.concatenate(means), 0, {}, {}
        for name, g in grads.items():
            averaged[name], at = flat[at:at + g.size].reshape(g.shape), at + g.size
        for name, (mean, _, n) in stats.items():
            new, first = first[:2 * len(mean)].astype(np.float64), first[2 * len(mean):]
            mixed[name] = (*np.split(new, 2), n)
        return averaged, mixed


def _step_job(spark, cfg, dealt, n, world, state, out):
    """All steps of an epoch over n rows in one job; gradients and parameters stay in its tasks and the shared folder."""
    shared = share_arrays(spark, state)
    folder = out.replace("/epochs/", "/steps/", 1)
    n_steps = -(-(-(-n // world)) // cfg.batch)  # of every rank
    trained = _by_rank(dealt, world).mapInArrow(_rank_task(cfg, shared, folder, n_steps), OUTPUT, barrier=True)
    # Shuffled before it is written: Spark runs a barrier stage again only if it is not the one that writes.
    trained.repartition(world, "kind", "rank").write.partitionBy("kind").parquet(out)
    shared.unpersist()
    remove(spark, folder)
    last = spark.read.schema(OUTPUT).parquet(f"{out}/kind=last").select("loss").first().loss
    params, opt_state = _read_chunks(out), _read_chunks(out, "optimizer")
    remove(spark, f"{out}/kind={{model,optimizer,last}}")
    return {"model": params, "optimizer": opt_state}, last


# --- one job per step ----------------------------------------------------------------------------------------

PACKED = "rank int, step bigint, piece int, n int, x binary, y binary"


def _packed_minibatches(cfg, dealt, world):
    """One row per rank and step, or a few where a minibatch is cut into pieces; a partition per rank, in order."""
    net = cfg.net
    width = net.channels * net.height * net.width
    most = _piece_rows(net, cfg.batch)
    batch = cfg.batch

    def run(batches):
        step, piece = 0, 0
        for rank, x, y, last in _pieces(batches, batch, most, width):
            if x is not None:
                yield pa.RecordBatch.from_pydict({
                    "rank": pa.array([rank], pa.int32()), "step": pa.array([step], pa.int64()), "piece": pa.array([piece], pa.int32()),
                    "n": pa.array([len(y)], pa.int32()), "x": pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()),
                    "y": pa.array([y.astype(np.int32).tobytes()], pa.binary())})
            step, piece = (step + 1, 0) if last else (step, piece + 1)

    return _by_rank(dealt, world).mapInArrow(run, PACKED)


def _step_task(cfg, model_path):
    """Gradient of one minibatch; a partition holds one rank's pieces of the step. The model is read from the shared folder."""
    width = cfg.net.channels * cfg.net.height * cfg.net.width

    def run(batches):
        now = None
        for batch in batches:
            for r in batch.to_pylist():
                now = now or Minibatch(cfg, _read_chunks(model_path), r["rank"], r["step"])
                kind = np.uint8 if len(r["x"]) == r["n"] * width else np.float32
                now.add(np.frombuffer(r["x"], kind).reshape(-1, width), np.frombuffer(r["y"], np.int32))
        if now is None:
            return
        rows = [now.record() | {"name": f"log {now.rank}", "chunk": 0, "vals": []}]
        rows += _chunks("gradient", now.rank, now.gradients())
        if now.rank == 0:
            # keyed by the running figure they go into, with the number of rows as its shape
            for name, (mean, var, n) in now.stats.items():
                for key, vals in (("running_mean", mean), ("running_var", var)):
                    rows.append({"kind": "statistics", "rank": now.rank, "name": f"{name}.{key}", "shape": [n], "chunk": 0, "vals": vals})
        yield pa.RecordBatch.from_pylist(rows, schema=ARROW_OUTPUT)

    return run


def _write_chunks(path, kind, arrays):
    """Arrays as chunk rows of one parquet file in the shared folder, written where the driver holds them."""
    import pyarrow.parquet as pq

    system, inner = locate(f"{path}/kind={kind}")
    system.create_dir(inner, recursive=True)
    rows = list(_chunks(kind, 0, arrays))
    pq.write_table(pa.Table.from_pylist(rows, schema=ARROW_OUTPUT).select(["name", "shape", "chunk", "vals"]), f"{inner}/part-0.parquet",
                   filesystem=system)


def _read_chunks(path, kind="model"):
    """Arrays by name from the chunk rows of a folder in the shared folder."""
    import pyarrow.parquet as pq

    system, inner = locate(f"{path}/kind={kind}")
    if system.get_file_info(inner).type.name == "NotFound":
        return {}
    table = pq.read_table(inner, filesystem=system, columns=["name", "shape", "chunk", "vals"])
    table = table.sort_by([("name", "ascending"), ("chunk", "ascending")])
    parts = {}
    for name, shape, vals in zip(table.column("name").to_pylist(), table.column("shape").to_pylist(), table.column("vals")):
        parts.setdefault(name, (shape, []))[1].append(vals.values.to_numpy(zero_copy_only=False))
    return {name: np.concatenate(v).astype(np.float32).reshape(shape) for name, (shape, v) in parts.items()}


def _update_task(opt, t):
    """Mean gradient of one parameter chunk over the ranks, then the optimizer step and the running figures of that chunk.

    Gets the chunk's model row, its optimizer rows, its gradients (sums over groups of ranks, with their number) and its statistics;
    a log row passes through. t: the optimizer's step count before this step.
    """
    def run(table):
        kinds = table.column("kind").to_pylist()
        if "model" not in kinds:
            return table.select(UPDATED.names).cast(UPDATED)
        rows = {k: table.filter(pa.compute.equal(table.column("kind"), k)) for k in set(kinds)}
        model = rows["model"].slice(0, 1)
        name = model.column("name")[0].as_py()
        params = {name: model.column("vals")[0].values.to_numpy(zero_copy_only=False).astype(np.float32)}
        state = {"step": np.array([t], np.float32)}
        if "optimizer" in rows:
            for r, vals in zip(rows["optimizer"].column("name").to_pylist(), rows["optimizer"].column("vals")):
                state[r] = vals.values.to_numpy(zero_copy_only=False).astype(np.float32)
        grads = {}
        if "gradient" in rows:
            summed = _sum_chunk(rows["gradient"])
            grads[name] = (summed.column("vals")[0].values.to_numpy() / summed.column("n")[0].as_py()).astype(np.float32)
        kernels.update(opt, params, grads, state)
        if "statistics" in rows:
            stat = rows["statistics"].slice(0, 1)
            new, n = stat.column("vals")[0].values.to_numpy().astype(np.float64), stat.column("shape")[0].as_py()[0]
            if name.endswith(".running_var"):
                new = new * (n / max(n - 1, 1))
            params[name] = (0.9 * params[name] + 0.1 * new).astype(params[name].dtype)
        out = [("model", name, params[name])] + [("optimizer", k, v) for k, v in state.items() if k != "step"]
        return pa.Table.from_pylist([
            {"kind": kind, "rank": 0, "name": k, "shape": model.column("shape")[0].as_py(), "chunk": model.column("chunk")[0].as_py(),
             "vals": v.astype(np.float64)} for kind, k, v in out], schema=UPDATED)

    return run


def _kept_row_by_row(df):
    """Persist with statistics for each row, so that a filter on the step skips all other rows.

    The number of rows that share statistics is taken from the session when a table is marked for keeping; it is put back at once.
    """
    spark, name = df.sparkSession, "spark.sql.inMemoryColumnarStorage.batchSize"
    before = spark.conf.get(name)
    spark.conf.set(name, "1")
    try:
        return df.persist()
    finally:
        spark.conf.set(name, before)


UPDATED = pa.schema([
    ("kind", pa.string()), ("rank", pa.int32()), ("batch_idx", pa.int64()), ("n_samples", pa.int32()), ("n_correct", pa.int32()),
    ("loss", pa.float64()), ("ts", pa.timestamp("us", tz="UTC")), ("name", pa.string()), ("shape", pa.list_(pa.int32())),
    ("chunk", pa.int32()), ("vals", pa.list_(pa.float64())),
])


def _step_jobs(spark, cfg, dealt, world, state, out):
    """All steps of an epoch over its packed minibatches, which are kept in memory or on the executors' disks.

    A step is one job: the ranks' gradients are added up in Spark, and the tasks that hold a parameter chunk's sum also take the
    optimizer step for it; the new model, optimizer state and log go to a folder of the step in the shared folder, from which the next
    step's tasks read the model. Neither gradients nor parameters come to the driver between the steps.
    """
    packed = _kept_row_by_row(_packed_minibatches(cfg, dealt, world))
    n_steps = packed.agg(F.max("step").alias("n")).first().n + 1
    base = float(state["optimizer"].get("step", np.zeros(1))[0])
    steps = out.replace("/epochs/", "/steps/", 1)
    _write_chunks(f"{steps}/step=start", "model", state["model"])
    _write_chunks(f"{steps}/step=start", "optimizer", {k: v for k, v in state["optimizer"].items() if k != "step"})
    before = f"{steps}/step=start"
    for step in range(n_steps):
        found = packed.filter(F.col("step") == step).mapInArrow(_step_task(cfg, before), OUTPUT)
        rows = found.withColumn("vals", F.col("vals").cast("array<double>")).withColumn("n", F.lit(1))
        level = world
        while level > FAN:
            rows = rows.withColumn("rank", F.call_function("div", F.col("rank"), F.lit(FAN)).cast("int"))
            rows = rows.groupBy("kind", "name", "chunk", "rank").applyInArrow(_sum_chunk, rows.schema)
            level = -(-level // FAN)
        held = spark.read.schema("name string, shape array<int>, chunk int, vals array<float>").parquet(f"{before}/kind={{model,optimizer}}")
        held = held.select(
            F.when(F.col("name").contains("/"), "optimizer").otherwise("model").alias("kind"), F.lit(0).alias("rank"), "name", "shape",
            "chunk", F.col("vals").cast("array<double>").alias("vals"), F.lit(1).alias("n"))
        rows = rows.unionByName(held, allowMissingColumns=True)
        # optimizer rows are named slot/parameter; a log row is its own group
        param = F.element_at(F.split("name", "/"), -1)
        updated = rows.groupBy(param.alias("param"), "chunk").applyInArrow(
            _update_task(cfg.opt, base + step), OUTPUT.replace("vals array<float>", "vals array<double>"))
        here = f"{steps}/step={step}"
        updated.select(*[F.col(c).cast("array<float>") if c == "vals" else F.col(c) for c in UPDATED.names]).write.partitionBy(
            "kind").parquet(here)
        remove(spark, f"{before}/kind={{model,optimizer}}")
        before = here
    packed.unpersist()
    logged = spark.read.schema(OUTPUT).parquet(f"{steps}/step=*/kind=log").withColumn("kind", F.lit("log"))
    logged = logged.withColumn("rank", F.regexp_extract("name", r"^log (\d+)$", 1).cast("int"))
    logged.select(*ARROW_OUTPUT.names).write.partitionBy("kind").mode("append").parquet(out)
    last = logged.filter(F.col("batch_idx") == n_steps - 1).orderBy("rank").select("loss").first().loss
    params, opt_state = _read_chunks(before), _read_chunks(before, "optimizer")
    opt_state["step"] = np.array([base + n_steps], np.float32)
    remove(spark, steps)
    return {"model": params, "optimizer": opt_state}, last


# --- runs ----------------------------------------------------------------------------------------------------

def fit(
    examples, net, *, keys=("split", "idx"), world=1, batch=64, epochs=1, opt=None, seed=42, sync="epoch",
    denom=255.0, source="px", label="label", root=None, run_id=None, params=None, train_only=None,
):
    """Train `net` and return its parameters and the per-batch log.

    A checkpoint is saved after every epoch under root; calling fit again with the same run_id goes on after the
    last finished epoch, and does nothing if all epochs are done. A resumed run keeps the seed and, if its packed rows are still
    there, the rows it was started with; a finished run deletes them. What every rank ended an epoch with (`replicas`) stays for the
    newest epoch only. A label outside the classes of the last layer fails the job; no rows are an error. Workers map the
    model from the shared folder. train_only: name prefixes of the parameters to train; the others stay frozen.
    """
    if sync not in ("epoch", "step"):
        raise ValueError(f"unknown sync {sync!r}")
    _piece_rows(net, batch)
    spark = examples.sparkSession
    root = root or f"{shared_dir(spark)}/runs"
    run_id = run_id or uuid.uuid4().hex
    opt = opt or sgd()

    saved = store.load_checkpoint(spark, root, run_id)
    if saved["params"] is not None:
        state, seed = {"model": saved["params"], "optimizer": saved["opt"]}, saved["seed"]
    else:
        state = {"model": params or init_params(net, seed), "optimizer": {}}

    folder = f"{root}/{run_id}/rows"
    if saved["start_epoch"] < epochs:
        if not is_written(spark, folder):
            write_rows(examples, keys, folder, net.channels * net.height * net.width, n_classes(net), source, label, seed)
        placed, n = ordering.read_in_order(spark, folder, "y int, x binary")
        if not n:
            raise ValueError("no rows to train on")
    for epoch in range(saved["start_epoch"], epochs):
        save_id = uuid.uuid4().hex
        out = f"{root}/{run_id}/epochs/epoch={epoch}/save_id={save_id}"
        cfg = Settings(net, opt, batch, seed, epoch, denom, tuple(train_only) if train_only else None)
        dealt = ordering.deal(placed, n, world, seed, epoch)
        if sync == "epoch":
            state, loss = _epoch_job(spark, cfg, dealt, world, state, out)
        elif world <= barrier_slots(spark):
            state, loss = _step_job(spark, cfg, dealt, n, world, state, out)
        else:
            state, loss = _step_jobs(spark, cfg, dealt, world, state, out)
        store.save_checkpoint(spark, root, run_id, epoch, state["model"], state["optimizer"], loss, seed, save_id)
        if epoch:
            remove(spark, f"{root}/{run_id}/epochs/epoch={epoch - 1}/save_id=*/kind={{model,optimizer,last}}")
    remove(spark, folder)
    return FitResult(run_id, state["model"], state["optimizer"], fit_log(spark, root, run_id), root)


def fit_log(spark, root, run_id):
    """Per-batch records of a run, from finished epochs only."""
    written = spark.read.schema(f"{OUTPUT}, {store.KEYS_DDL}").parquet(
        f"{root}/{run_id}/epochs"
    ).filter(F.col("kind") == "log")
    finished = store.checkpoints(spark, root, run_id).groupBy("epoch").agg(
        F.max_by("save_id", "saved_at").alias("save_id")
    )
    return written.join(finished, ["epoch", "save_id"], "left_semi").select(
        F.lit(run_id).alias("run_id"), "rank", "epoch", "batch_idx", "n_samples", "n_correct", "loss", "ts"
    )


def replicas(spark, root, run_id, epoch):
    """What every rank ended the run's newest epoch with, before averaging (sync="epoch" only): name, rank, vals.

    Long parameters come in chunks, `name/chunk`. Made for parameters.replica_check. Only the epoch's newest finished
    save counts; what an attempt left that was lost before its checkpoint does not.
    """
    written = spark.read.schema(f"{OUTPUT}, {store.KEYS_DDL}").parquet(f"{root}/{run_id}/epochs")
    finished = store.checkpoints(spark, root, run_id).groupBy("epoch").agg(
        F.max_by("save_id", "saved_at").alias("save_id")
    )
    written = written.join(F.broadcast(finished), ["epoch", "save_id"], "left_semi")  # one row per epoch
    return written.filter((F.col("epoch") == epoch) & (F.col("kind") == "model")).select(
        F.concat_ws("/", "name", "chunk").alias("name"), "rank", "vals"
    )


def fit_head(
    examples, net, params, n_layers, *, keys=("split", "idx"), label="label", classes=10, source="px", denom=255.0,
    root=None, run_id=None, head_params=None, **options,
):
    """Transfer learning: frozen features are computed once, written out and reused by every epoch of the head.

    head_params: first values of the head, by default random. Returns the head's layout and its FitResult.
    """
    spark = examples.sparkSession
    root = root or f"{shared_dir(spark)}/runs"
    run_id = run_id or uuid.uuid4().hex
    folder = f"{root}/{run_id}/features"
    featurize(
        examples.select(*keys, label, source), net, params, n_layers, source, denom
    ).select(*keys, label, "features").write.mode("overwrite").parquet(folder)
    probe = np.zeros((1, net.channels, net.height, net.width), np.float32)
    width = kernels.forward(net.layers[:n_layers], params, probe)[0].size
    head = Arch((("flatten",), ("dense", "fc", classes)), 1, width)
    options.setdefault("opt", sgd(lr=0.001))
    return head, fit(
        spark.read.parquet(folder), head, keys=keys, label=label, source="features", denom=1.0, root=root,
        run_id=run_id, params=head_params, **options,
    )
