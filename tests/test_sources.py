import struct

import numpy as np
import pytest
from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gridloom.operators import pairing
from gridloom.sources import idx, logs, tables

JOB_FAILED = (PySparkException, Py4JError)
SIDE = 4
N = SIDE * SIDE
HEADER = ",".join(["label"] + [f"p{i}" for i in range(N)])


def lines(n, start=0):
    return [",".join(map(str, [i % 10] + [(i * 7 + j) % 256 for j in range(N)])) for i in range(start, start + n)]


def write(path, rows):
    path.write_text("\n".join(rows) + "\n")
    return str(path)


# --- CSV and text --------------------------------------------------------------------------------------------

def test_csv(spark, tmp_path):
    df = tables.read_labeled_csv(spark, write(tmp_path / "a.csv", [HEADER] + lines(20)), side=SIDE)
    rows = df.collect()
    assert len(rows) == 20 and sorted({r.label for r in rows}) == list(range(10))
    assert sorted(r.px for r in rows) == sorted([(i * 7 + j) % 256 for j in range(N)] for i in range(20))


def test_csv_reads_only_the_label_when_only_the_label_is_used(spark, tmp_path):
    df = tables.read_labeled_csv(spark, write(tmp_path / "a.csv", [HEADER] + lines(3)), side=SIDE)
    plan = df.select("label")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<label:int>" in plan


def test_csv_bad_cell_fails(spark, tmp_path):
    df = tables.read_labeled_csv(spark, write(tmp_path / "a.csv", [HEADER, lines(1)[0] + "x"]), side=SIDE)
    with pytest.raises(JOB_FAILED):
        df.collect()


def test_csv_label_is_found_by_name(spark, tmp_path):
    names = HEADER.split(",")
    moved = [",".join(names[1:] + names[:1])] + [",".join(x.split(",")[1:] + x.split(",")[:1]) for x in lines(20)]
    want = tables.read_labeled_csv(spark, write(tmp_path / "a.csv", [HEADER] + lines(20)), side=SIDE)
    got = tables.read_labeled_csv(spark, write(tmp_path / "b.csv", moved), side=SIDE)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_csv_without_the_label_or_with_another_width_is_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="expected one column"):
        tables.read_labeled_csv(spark, write(tmp_path / "a.csv", [HEADER] + lines(2)), side=SIDE, label="class")
    with pytest.raises(ValueError, match="expected one column"):
        tables.read_labeled_csv(spark, write(tmp_path / "a.csv", [HEADER] + lines(2)), side=SIDE + 1)


def test_csv_files_with_different_headers_fail(spark, tmp_path):
    names = HEADER.split(",")
    write(tmp_path / "a.csv", [HEADER] + lines(3))
    write(tmp_path / "b.csv", [",".join(names[1:] + names[:1])] + lines(3))
    with pytest.raises(JOB_FAILED):
        tables.read_labeled_csv(spark, str(tmp_path), side=SIDE).collect()


@pytest.mark.parametrize("cell", [0, 3])
def test_csv_empty_cell_fails(spark, tmp_path, cell):
    row = lines(1)[0].split(",")
    row[cell] = ""
    df = tables.read_labeled_csv(spark, write(tmp_path / "a.csv", [HEADER, ",".join(row)]), side=SIDE)
    with pytest.raises(JOB_FAILED, match="empty"):
        df.collect()


def test_header_comes_from_the_first_file_by_name(spark, tmp_path):
    write(tmp_path / "a.csv", [HEADER])
    write(tmp_path / "b.csv", lines(40))
    assert tables.read_labeled_text(spark, str(tmp_path), "first_line", N).count() == 40


def test_empty_file_gives_no_rows(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("")
    assert tables.read_labeled_text(spark, str(path)).count() == 0


def test_first_line_rule_drops_every_copy_of_the_header(spark, tmp_path):
    path = write(tmp_path / "a.csv", [HEADER] + lines(5) + [HEADER] + lines(5, 5))
    assert tables.read_labeled_text(spark, path, "first_line", N).count() == 10


def test_contains_rule_also_drops_a_data_line_with_the_word(spark, tmp_path):
    path = write(tmp_path / "a.csv", [HEADER] + lines(5) + ["3,label" + ",1" * (N - 1)])
    assert tables.read_labeled_text(spark, path, "contains_label", N).count() == 5
    with pytest.raises(JOB_FAILED):
        tables.read_labeled_text(spark, path, "first_line", N).collect()


def test_decimal_cells_need_the_float_form(spark, tmp_path):
    path = write(tmp_path / "a.csv", ["1,1.5" + ",2" * (N - 1)])
    assert tables.read_labeled_text(spark, path, "none", N, "float").first().px[:2] == [1.5, 2.0]
    with pytest.raises(JOB_FAILED):
        tables.read_labeled_text(spark, path, "none", N, "int").collect()


@pytest.mark.parametrize("column", ["label", "px"])
def test_wrong_width_fails_whichever_column_is_used(spark, tmp_path, column):
    path = write(tmp_path / "a.csv", lines(2) + ["1,2,3"])
    with pytest.raises(JOB_FAILED, match="expected 17 fields"):
        tables.read_labeled_text(spark, path, "none", N).select(column).collect()


def test_quarantine_names_what_is_wrong(spark, tmp_path):
    bad = ["1,2", "x" + ",1" * N, "1,y" + ",1" * (N - 1)]
    path = write(tmp_path / "a.csv", lines(4) + bad)
    rows = tables.read_labeled_text(spark, path, "none", N, mode="quarantine").collect()
    assert sum(r.error is None for r in rows) == 4
    assert {(r.error, r.bad_line) for r in rows if r.error} == {("width", bad[0]), ("label", bad[1]), ("pixel", bad[2])}
    kept = tables.drop_skipped(tables.read_labeled_text(spark, path, "none", N, mode="quarantine"))
    assert kept.count() == 4


def test_file_position_follows_files_and_lines(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    for f in range(3):
        write(folder / f"part{f}.csv", [f"{f}-{i:04d}-" + "z" * 50 for i in range(400)])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = pairing.with_file_position(spark.read.text(str(folder)).withColumn("split", F.lit("train")))
        assert df.rdd.getNumPartitions() > 1
        rows = sorted((r.idx, r.value) for r in df.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [i for i, _ in rows] == list(range(1200))
    assert "hashpartitioning(split#" not in df._jdf.queryExecution().executedPlan().toString().split("BroadcastExchange")[0]
    assert [v for _, v in rows] == sorted(v for _, v in rows)


def test_inventory_lists_files_without_content(spark, tmp_path):
    write(tmp_path / "a.csv", lines(2))
    df = tables.file_inventory(spark, str(tmp_path))
    row = df.first()
    assert row.name == "a.csv" and row.length == (tmp_path / "a.csv").stat().st_size
    assert "content" not in df._jdf.queryExecution().executedPlan().toString()


def test_preview_is_ordered(spark):
    assert [r.id for r in tables.preview(spark.range(100).repartition(8), ["id"], 3).collect()] == [0, 1, 2]


# --- logs ----------------------------------------------------------------------------------------------------

def test_log_shapes(spark):
    text = [
        "INFO:root:Rank 3, Epoch 1, Batch 50, Loss 2.5e-05",
        "Rank 0, PID 77 with 64 samples, Epoch 2, Batch 100, Loss 0.25 ",
        "2024-01-01 00:00:00,000 - INFO - Rank 1 - Epoch 4, Loss 0.1234, Accuracy 97.50%",
        "Rank 1 - Epoch 4 starts.", "nothing here",
    ]
    rows = logs.parse_training_log(spark.createDataFrame([(t,) for t in text], "value string")).collect()
    assert [tuple(r) for r in rows] == [
        ("batch", 3, 1, 50, None, 2.5e-05, None),
        ("batch", 0, 2, 100, 64, 0.25, None),
        ("epoch", 1, 4, None, None, 0.1234, 97.5),
    ]


def test_log_file(spark, tmp_path):
    path = write(tmp_path / "rank_0.txt", ["Rank 0, Epoch 0, Batch 0, Loss nan", "x"])
    assert logs.read_training_log(spark, path).count() == 1


# --- IDX -----------------------------------------------------------------------------------------------------

def idx_images(path, n, record=9, magic=2051, cut=0, promised=None):
    cells = np.arange(n * record, dtype=np.int64).astype(np.uint8).tobytes()
    side = int(record ** 0.5)
    path.write_bytes(struct.pack(">iiii", magic, promised or n, side, side) + cells[:len(cells) - cut])
    return str(path)


def idx_labels(path, n, magic=2049):
    path.write_bytes(struct.pack(">ii", magic, n) + bytes(i % 10 for i in range(n)))
    return str(path)


@pytest.mark.parametrize("n, range_bytes", [(7, 1 << 20), (1000, 9 * 130)])
def test_idx_images_keep_order_and_sign(spark, tmp_path, n, range_bytes):
    df = idx.read_idx(spark, idx_images(tmp_path / "img", n), range_bytes=range_bytes)
    assert df.rdd.getNumPartitions() == -(-n * 9 // range_bytes)
    rows = sorted(df.collect(), key=lambda r: r.idx)
    assert [r.idx for r in rows] == list(range(n))
    assert [r.px for r in rows] == [[(i * 9 + j) % 256 for j in range(9)] for i in range(n)]


def test_idx_bytes_are_unsigned(spark, tmp_path):
    path = tmp_path / "img"
    path.write_bytes(struct.pack(">iiii", 2051, 1, 2, 2) + bytes([0, 127, 128, 255]))
    assert idx.read_idx(spark, str(path)).first().px == [0, 127, 128, 255]


def test_idx_labels(spark, tmp_path):
    rows = idx.read_idx(spark, idx_labels(tmp_path / "lab", 25), "labels", split="test").collect()
    assert sorted((r.split, r.idx, r.label) for r in rows) == [("test", i, i % 10) for i in range(25)]


def test_idx_file_url(spark, tmp_path):
    assert idx.read_idx(spark, "file://" + idx_labels(tmp_path / "lab", 3), "labels").count() == 3


@pytest.mark.parametrize("broken, message", [
    (dict(magic=2049), "magic"), (dict(cut=4), "promises"), (dict(promised=9), "promises"),
])
def test_idx_refuses_broken_files(spark, tmp_path, broken, message):
    with pytest.raises(JOB_FAILED, match=message):
        idx.read_idx(spark, idx_images(tmp_path / "img", 7, **broken)).collect()


def test_idx_refuses_a_cut_header(spark, tmp_path):
    (tmp_path / "img").write_bytes(b"\0\0\x08\x03")
    with pytest.raises(JOB_FAILED, match="header"):
        idx.read_idx(spark, str(tmp_path / "img")).collect()


def test_idx_pairs_without_a_shuffle(spark, tmp_path):
    df = idx.read_idx(spark, idx_images(tmp_path / "img", 1000), labels=idx_labels(tmp_path / "lab", 1000), range_bytes=900)
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    assert all(r.label == r.idx % 10 and r.px[0] == r.idx * 9 % 256 for r in df.collect())


def test_idx_written_by_tasks_reads_back_in_order(spark, tmp_path):
    rows = spark.range(1000).selectExpr("id AS idx", "cast(id % 10 AS int) AS label", "transform(array(0, 1, 2, 3), v -> cast((id + 50 * v) % 256 AS int)) AS px")
    pixels, labels = str(tmp_path / "px"), str(tmp_path / "label")
    idx.write_idx(rows.repartitionByRange(7, "idx").sortWithinPartitions("idx"), pixels, labels, file_records=64)
    assert len([p for p in (tmp_path / "px").iterdir() if p.name[0] not in "._"]) >= 16 and not list((tmp_path / "px").glob("_*"))
    got = idx.read_idx(spark, pixels, labels=labels, range_bytes=100)
    assert sorted((r.idx, r.label, r.px) for r in got.collect()) == [(r.idx, r.label, r.px) for r in rows.collect()]


@pytest.mark.parametrize("px, message", [([1, 256], "between"), ([1, None], "null"), ([1, 2], "square")])
def test_idx_refuses_what_it_cannot_write(spark, tmp_path, px, message):
    with pytest.raises(JOB_FAILED, match=message):
        idx.write_idx(spark.createDataFrame([(px, 1)], "px array<int>, label int"), str(tmp_path / "p"), str(tmp_path / "l"))
    assert not list(tmp_path.glob("*/part*"))


def test_splits_are_numbered_on_their_own(spark, tmp_path):
    for name, n in (("train", 30), ("test", 7)):
        (tmp_path / name).mkdir()
        write(tmp_path / name / "b.csv", [HEADER] + lines(n))
        write(tmp_path / name / "a.csv", [HEADER] + lines(2))
    for read in (lambda p: tables.read_labeled_csv(spark, p, side=SIDE), lambda p: tables.read_labeled_text(spark, p, "first_line", N)):
        got = tables.read_splits(read, train=str(tmp_path / "train"), test=str(tmp_path / "test")).collect()
        assert sorted((r.split, r.idx) for r in got) == [("test", i) for i in range(9)] + [("train", i) for i in range(32)]
        assert all(r.label == (r.idx if r.idx < 2 else r.idx - 2) % 10 for r in got)


def test_idx_pairing_refuses_unequal_counts(spark, tmp_path):
    with pytest.raises(JOB_FAILED, match="cannot pair 7 images with 6 labels"):
        idx.read_idx(spark, idx_images(tmp_path / "img", 7), labels=idx_labels(tmp_path / "lab", 6)).collect()


def test_idx_folders_follow_one_another(spark, tmp_path):
    for kind in ("img", "lab"):
        (tmp_path / kind).mkdir()
    for f, n in enumerate((30, 5, 12)):
        idx_images(tmp_path / "img" / f"part-{f}", n)
        idx_labels(tmp_path / "lab" / f"part-{f}", n)
    (tmp_path / "img" / "_SUCCESS").write_text("")
    df = idx.read_idx(spark, str(tmp_path / "img"), labels=str(tmp_path / "lab"), range_bytes=90)
    rows = sorted(df.collect(), key=lambda r: r.idx)
    assert [r.idx for r in rows] == list(range(47))
    assert [r.label for r in rows] == [i % 10 for n in (30, 5, 12) for i in range(n)]
    listed = ",".join(str(tmp_path / "img" / f"part-{f}") for f in (2, 0))
    assert idx.read_idx(spark, listed).count() == 42
    with pytest.raises(JOB_FAILED, match="cannot pair 2 image files with 3 label files"):
        idx.read_idx(spark, listed, labels=str(tmp_path / "lab")).collect()


def test_idx_many_small_files_are_planned_from_their_lengths(spark, tmp_path, monkeypatch):
    sizes = [i % 4 for i in range(300)]
    for name, make in (("px", idx_images), ("lab", idx_labels)):
        (tmp_path / name).mkdir()
        for i, n in enumerate(sizes):
            make(tmp_path / name / f"{i:04d}", n)
    opened = []
    monkeypatch.setattr(idx, "_open", lambda path, own=idx._open: opened.append(path) or own(path))
    paired = idx.IdxReader({"images": str(tmp_path / "px"), "labels": str(tmp_path / "lab")}, "train", 1 << 22)
    assert len(paired.partitions()) == 5 and opened == []
    alone = idx.IdxReader({"images": str(tmp_path / "px")}, "train", 1 << 22).partitions()
    assert len(alone) == 5 and len(opened) == 1
    df = idx.read_idx(spark, str(tmp_path / "px"), labels=str(tmp_path / "lab"), range_bytes=1 << 22)
    rows = sorted(df.collect(), key=lambda r: r.idx)
    assert [r.idx for r in rows] == list(range(sum(sizes)))
    assert [r.label for r in rows] == [i for n in sizes for i in range(n)]
    assert [r.px[0] for r in rows] == [i * 9 % 256 for n in sizes for i in range(n)]


def test_idx_images_of_several_sizes(spark, tmp_path):
    for name in ("px", "lab"):
        (tmp_path / name).mkdir()
    for i, (n, record) in enumerate([(4, 9), (3, 16)]):
        idx_images(tmp_path / "px" / str(i), n, record)
        idx_labels(tmp_path / "lab" / str(i), n)
    rows = sorted(idx.read_idx(spark, str(tmp_path / "px"), labels=str(tmp_path / "lab")).collect(), key=lambda r: r.idx)
    assert [len(r.px) for r in rows] == [9] * 4 + [16] * 3
    with pytest.raises(JOB_FAILED, match="another size"):
        idx.read_idx(spark, str(tmp_path / "px")).collect()


def test_a_filter_on_the_split_leaves_the_other_files_alone(spark, tmp_path):
    images, labels = idx.FILES["train"]
    idx_images(tmp_path / images, 5)
    idx_labels(tmp_path / labels, 5)
    both = idx.read_idx_split(spark, str(tmp_path))
    assert both.filter("split = 'train'").count() == 5
    with pytest.raises(JOB_FAILED):
        both.collect()
    assert "Union" not in both.filter("split = 'train'")._jdf.queryExecution().optimizedPlan().toString()


def test_idx_without_records(spark, tmp_path):
    assert idx.read_idx(spark, idx_labels(tmp_path / "lab", 0), "labels").collect() == []


def test_idx_split(spark, tmp_path):
    for (images, labels), n in zip(idx.FILES.values(), (60, 10)):
        idx_images(tmp_path / images, n)
        idx_labels(tmp_path / labels, n)
    counts = {r.split: r["count"] for r in idx.read_idx_split(spark, str(tmp_path)).groupBy("split").count().collect()}
    assert counts == {"train": 60, "test": 10}


def test_idx_split_with_a_missing_file(spark, tmp_path):
    with pytest.raises(JOB_FAILED):
        idx.read_idx_split(spark, str(tmp_path)).collect()


# --- pairing -------------------------------------------------------------------------------------------------

def numbered(spark, n, name):
    return spark.range(n).select(F.lit("train").alias("split"), F.col("id").alias("idx"), (F.col("id") % 7).alias(name))


def test_pairing_joins_equal_positions(spark):
    rows = pairing.pair_by_position(numbered(spark, 50, "px").repartition(5), numbered(spark, 50, "label")).collect()
    assert len(rows) == 50 and all(r.px == r.label for r in rows)


@pytest.mark.parametrize("images, labels, message", [(5, 4, "image without label at train/4"), (4, 5, "label without image")])
def test_strict_pairing_refuses_unmatched_rows(spark, images, labels, message):
    paired = pairing.pair_by_position(numbered(spark, images, "px"), numbered(spark, labels, "label"))
    with pytest.raises(JOB_FAILED, match=message):
        paired.count()


@pytest.mark.parametrize("twice", ["px", "label"])
def test_strict_pairing_refuses_repeated_positions(spark, twice):
    sides = {n: numbered(spark, 5, n) for n in ("px", "label")}
    sides[twice] = sides[twice].union(sides[twice].limit(1))
    with pytest.raises(JOB_FAILED, match="repeated position train/"):
        pairing.pair_by_position(sides["px"], sides["label"]).count()


def test_loose_pairing_leaves_unmatched_rows_out(spark):
    assert pairing.pair_by_position(numbered(spark, 5, "px"), numbered(spark, 4, "label"), strict=False).count() == 4


def test_tables_written_by_position_are_paired_without_a_shuffle(spark):
    from gridloom.operators import pairing

    images = spark.range(500).selectExpr("if(id % 5 = 0, 'test', 'train') AS split", "id AS idx", "array(id, id + 1) AS px")
    labels = images.selectExpr("split", "idx", "cast(idx % 7 AS int) AS label")
    a, b = pairing.write_by_position(images, "paired_px", 4), pairing.write_by_position(labels, "paired_label", 4)
    try:
        paired = pairing.pair_by_position(a, b)
        assert "Exchange" not in paired._jdf.queryExecution().executedPlan().toString()
        got = sorted((r.split, r.idx, r.px[0], r.label) for r in paired.collect())
        assert got == sorted(("test" if i % 5 == 0 else "train", i, i, i % 7) for i in range(500))
        plan = pairing.pair_by_position(images, labels)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2
    finally:
        spark.sql("DROP TABLE paired_px")
        spark.sql("DROP TABLE paired_label")
