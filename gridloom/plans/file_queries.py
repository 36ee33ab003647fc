"""Registered queries that write the test tables in a file format first and read them back, with their SQL."""

import uuid

import numpy as np
from pyspark.sql import functions as F

from gridloom.operators import layers, ordering, pairing
from gridloom.plans.views import HEADER, IMAGES_SQL, LOG_SQL, SIDE, images, text_lines, train_log
from gridloom.session import shared_dir
from gridloom.sinks import store
from gridloom.sources import idx, logs, tables

QUERIES, ORACLE = {}, {}
N = SIDE * SIDE


def query(name, sql):
    def add(fn):
        QUERIES[name], ORACLE[name] = fn, sql
        return fn
    return add


def _folder(spark, kind):
    return f"{shared_dir(spark)}/queries/{uuid.uuid4().hex}/{kind}"


def _write_csv(spark, data, label_first=False):
    """One column per pixel and the label; every part file starts with the header line."""
    folder = _folder(spark, "csv")
    cells = [F.get("px", F.lit(i)).alias(f"p{i}") for i in range(N)]
    wide = data.select("label", *cells) if label_first else data.select(*cells, "label")
    wide.write.option("header", True).csv(folder)
    return folder


def _in_order(data):
    return data.repartitionByRange("idx").sortWithinPartitions("idx")


#: The images numbered inside each split, as files written in order number them.
NUMBERED_SQL = f"""{IMAGES_SQL},
numbered AS (SELECT split, row_number() OVER (PARTITION BY split ORDER BY idx) - 1 AS idx, label, px FROM img)"""


@query("q_csv_read", f"WITH {IMAGES_SQL} SELECT label, px FROM img")
def q_csv_read(spark, sf):
    return tables.read_labeled_csv(spark, _write_csv(spark, images(spark, sf)), side=SIDE)


def _read_csv_splits(spark, sf):
    data = _in_order(images(spark, sf))
    folders = {split: _write_csv(spark, data.filter(F.col("split") == split)) for split in ("train", "test")}
    return tables.read_splits(lambda path: tables.read_labeled_csv(spark, path, side=SIDE), **folders)


@query("q_csv_splits", f"WITH {NUMBERED_SQL} SELECT * FROM numbered")
def q_csv_splits(spark, sf):
    return _read_csv_splits(spark, sf)


@query("q_csv_batches", f"""WITH {NUMBERED_SQL},
placed AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY md5('7:0:' || split || ':' || idx)) - 1 AS p FROM numbered
           WHERE split = 'train')
SELECT CAST(p % 4 AS INTEGER) AS rank, p // 4 // 64 AS batch_idx, count(*) AS n, CAST(sum(label) AS BIGINT) AS labels,
       CAST(sum(list_sum(px)) AS BIGINT) AS cells FROM placed GROUP BY ALL""")
def q_csv_batches(spark, sf):
    """From CSV files to the minibatches of four ranks."""
    train = _read_csv_splits(spark, sf).filter("split = 'train'")
    dealt = ordering.minibatch(ordering.shard(train, ["split", "idx"], 4, 7, pad=False), 64)
    cells = F.aggregate("px", F.lit(0).cast("bigint"), lambda a, v: a + v)
    return dealt.groupBy("rank", "batch_idx").agg(F.count("*").alias("n"), F.sum("label").alias("labels"), F.sum(cells).alias("cells"))


@query("q_idx_read", f"WITH {IMAGES_SQL} SELECT 'train' AS split, row_number() OVER (ORDER BY idx) - 1 AS idx, label, px FROM img")
def q_idx_read(spark, sf):
    """IDX files written by the tasks, read back paired."""
    pixels, labels = _folder(spark, "idx"), _folder(spark, "idx")
    idx.write_idx(_in_order(images(spark, sf)), pixels, labels, file_records=200)
    return idx.read_idx(spark, pixels, labels=labels, range_bytes=100 * N)


@query("q_idx_split", f"WITH {NUMBERED_SQL} SELECT * FROM numbered")
def q_idx_split(spark, sf):
    """The four parts of a data set folder."""
    folder, data = _folder(spark, "idx"), _in_order(images(spark, sf))
    for split, (pixels, labels) in idx.FILES.items():
        idx.write_idx(data.filter(F.col("split") == split), f"{folder}/{pixels}", f"{folder}/{labels}")
    return idx.read_idx_split(spark, folder)


@query("q_text_read", f"WITH {IMAGES_SQL} SELECT label, px FROM img")
def q_text_read(spark, sf):
    folder = _folder(spark, "text")
    text_lines(spark, sf).select("value").write.text(folder)
    return tables.read_labeled_text(spark, folder, "contains_label", n_pixels=N)


@query("q_drop_skipped", f"WITH {IMAGES_SQL} SELECT label, px FROM img")
def q_drop_skipped(spark, sf):
    """Header lines are marked as skipped by the parser and dropped afterwards."""
    folder = _folder(spark, "text")
    text_lines(spark, sf).select("value").write.text(folder)
    parsed = tables.read_labeled_text(spark, folder, "none", n_pixels=N, mode="quarantine")
    return tables.drop_skipped(parsed).select("label", "px")


@query("q_rows_per_file", " UNION ALL ".join(
    f"SELECT '{t}.parquet' AS name, count(*) AS n FROM {t}" for t in ("orders", "lineitem", "customer")))
def q_rows_per_file(spark, sf):
    """Rows of each file of several tables, by the file they come from."""
    parts = [
        spark.read.parquet(f"{sf}/{t}.parquet").select(F.lit(f"{t}.parquet").alias("name"), F.col("_metadata.file_path").alias("file"))
        for t in ("orders", "lineitem", "customer")
    ]
    files = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("name", "file").agg(F.count("*").alias("n"))
    return files.groupBy("name").agg(F.sum("n").alias("n"))


@query("q_pair_written_tables", f"WITH {IMAGES_SQL} SELECT split, idx, px, label FROM img")
def q_pair_written_tables(spark, sf):
    """Images and labels as tables in buckets of positions, paired without a shuffle."""
    data, run = images(spark, sf), uuid.uuid4().hex
    written = [
        pairing.write_by_position(data.select("split", "idx", column), f"by_position_{column}_{run}", 8) for column in ("px", "label")]
    return pairing.pair_by_position(*written)


@query("q_file_inventory", f"""WITH {IMAGES_SQL}
SELECT label, CAST(sum(length(array_to_string(px, ',')) + 1) AS BIGINT) AS bytes FROM img GROUP BY label""")
def q_file_inventory(spark, sf):
    """Bytes of the listed text files that hold the images, by the label in their folder's name."""
    folder = _folder(spark, "listed")
    images(spark, sf).select(F.array_join("px", ",").alias("value"), "label").write.partitionBy("label").text(folder)
    files = tables.file_inventory(spark, folder).filter(F.col("name").startswith("part-"))
    return files.groupBy(F.regexp_extract("path", "label=([0-9]+)", 1).cast("int").alias("label")).agg(F.sum("length").alias("bytes"))


@query("q_text_read_first_line", f"""WITH {IMAGES_SQL}
SELECT label, list_transform(px, lambda v: CAST(v AS FLOAT)) AS px FROM img""")
def q_text_read_first_line(spark, sf):
    return tables.read_labeled_text(spark, _write_csv(spark, images(spark, sf), label_first=True), "first_line", n_pixels=N, values="float")


@query("q_text_read_small_header", f"WITH {IMAGES_SQL} SELECT label, px FROM img")
def q_text_read_small_header(spark, sf):
    """The header line alone in the first and smallest file."""
    folder = _folder(spark, "text")
    header = spark.createDataFrame([(HEADER,)], "value string").coalesce(1)
    header.union(text_lines(spark, sf).filter("idx >= 0").select("value")).write.text(folder)
    return tables.read_labeled_text(spark, folder, "first_line", n_pixels=N)


@query("q_file_position", """
SELECT 'train' AS split, event_id AS idx, event_type || ' ' || event_id AS value FROM events""")
def q_file_position(spark, sf):
    folder = _folder(spark, "text")
    lines = spark.read.parquet(f"{sf}/events.parquet").repartitionByRange("event_id").sortWithinPartitions("event_id")
    lines.select(F.concat_ws(" ", "event_type", "event_id").alias("value")).write.text(folder)
    return pairing.with_file_position(spark.read.text(folder).withColumn("split", F.lit("train")))


@query("q_log_read", f"""WITH {LOG_SQL}
SELECT 'batch' AS kind, rank, epoch, batch_idx, n_samples, loss, NULL::DOUBLE AS accuracy FROM log""")
def q_log_read(spark, sf):
    folder = _folder(spark, "log")
    log = train_log(spark, sf)
    log.select(F.format_string(
        "Rank %d, PID 1 with %d samples, Epoch %d, Batch %d, Loss %s", "rank", "n_samples", "epoch", "batch_idx",
        F.col("loss").cast("string"),
    ).alias("value")).write.text(folder)
    return logs.read_training_log(spark, folder)


@query("q_train_log_store", f"WITH {LOG_SQL} SELECT * FROM log")
def q_train_log_store(spark, sf):
    folder = _folder(spark, "train_log")
    store.append_train_log(train_log(spark, sf).withColumn("ts", F.col("ts").cast("timestamp")), folder)
    return store.read_train_log(spark, folder).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


CLASS_SUMS_SQL = f"""WITH {IMAGES_SQL}, cells AS (SELECT label, unnest(px) AS v, unnest(range({N})) AS pos FROM img)
SELECT 'class ' || label AS name, CAST(pos AS INTEGER) AS pos, CAST(sum(v) AS FLOAT) AS v FROM cells GROUP BY ALL"""


def _save_class_sums(spark, sf, root):
    """Two saves of one run; the second holds the class sums as its parameters."""
    arrays = {}
    for r in layers.class_sums(images(spark, sf)).collect():
        arrays.setdefault(f"class {r.label}", np.zeros(N, np.float32))[r.pos] = r.total
    store.save_checkpoint(spark, root, "sums", 0, {n: a * 0 for n, a in arrays.items()})
    store.save_checkpoint(spark, root, "sums", 1, arrays)


@query("q_checkpoint_store", CLASS_SUMS_SQL)
def q_checkpoint_store(spark, sf):
    root = _folder(spark, "runs")
    _save_class_sums(spark, sf, root)
    saved = store.read_params(spark, root, "sums", store.load_checkpoint(spark, root, "sums")["start_epoch"] - 1)
    return saved.select("name", F.posexplode("vals").alias("pos", "v"))


@query("q_publish_version", CLASS_SUMS_SQL)
def q_publish_version(spark, sf):
    root = _folder(spark, "runs")
    _save_class_sums(spark, sf, root)
    published = spark.read.parquet(store.publish_version(spark, root, "sums"))
    return published.filter(F.col("kind") == "model").select("name", F.posexplode("vals").alias("pos", "v"))
