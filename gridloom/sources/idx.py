"""IDX binary files as a Spark data source.

All records of an IDX file have the same size, so a file is cut into record ranges and every task reads only
its own bytes; ranges of small files share a task. A read is planned from the listing alone: lengths give the counts, and each task checks
the headers of the files it opens. Of image files without label files beside them one header is opened for the size of an image. The row number is the record's place in the file (files of a folder or of a comma-separated list
follow one another by name); no numbering pass is needed. Given label files beside the image files, a task reads the
same record range from both, which pairs them by position without a join or a shuffle.

    spark.dataSource.register(IdxDataSource)
    spark.read.format("idx").option("kind", "images").load(path)
    spark.read.format("idx").option("labels", label_path).load(image_path)

Writing makes files of at most FILE_RECORDS records from the tasks, in the order of the partitions and of their rows; readers
give the rows their places in that order. Files get their names when the whole job commits.

    df.write.format("idx").option("labels", label_folder).mode("append").save(image_folder)
"""

import struct
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from gridloom.session import locate

# Fixed values of the format: magic number per kind; the big-endian header is 16 or 8 bytes long.
MAGIC = {"images": 2051, "labels": 2049}
HEADER = {"images": 16, "labels": 8}

# Fixed file names of a data set folder.
FILES = {
    "train": ("train-images-idx3-ubyte", "train-labels-idx1-ubyte"),
    "test": ("t10k-images-idx3-ubyte", "t10k-labels-idx1-ubyte"),
}

RANGE_BYTES = 64 << 20
FILE_RECORDS = 65_536
BATCH_BYTES = 1 << 20
OPEN_BYTES = 1 << 16  # what opening a file counts for when ranges are put together


def _open(path):
    system, inner = locate(path)
    return system.open_input_file(inner)


def _files(paths):
    """(file, bytes) of a comma-separated list of files and folders; a folder's files are sorted by name and listed in one go."""
    from pyarrow import fs

    found = []
    for path in paths.split(","):
        system, inner = locate(path)
        info = system.get_file_info(inner)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(path)
        if info.type != fs.FileType.Directory:
            found.append((path, info.size))
            continue
        listed = sorted(
            (f.base_name, f.size) for f in system.get_file_info(fs.FileSelector(inner)) if f.type == fs.FileType.File
        )
        found += [(f"{path.rstrip('/')}/{name}", size) for name, size in listed if name[0] not in "._"]
    return found


def _header(f, path, kind):
    """(records, bytes per record) of an open file after checking magic number and file length."""
    head = f.read(HEADER[kind])
    if len(head) < HEADER[kind]:
        raise ValueError(f"{path}: header cut off")
    magic, count, *dims = struct.unpack(f">{HEADER[kind] // 4}i", head)
    if magic != MAGIC[kind]:
        raise ValueError(f"{path}: magic number {magic}, expected {MAGIC[kind]} for {kind}")
    record = int(np.prod(dims)) if dims else 1
    if f.size() != HEADER[kind] + count * record:
        raise ValueError(f"{path}: header promises {count} records of {record} bytes, file has {f.size()} bytes")
    return count, record


def _bytes(f, kind, record, first, n):
    """n records from `first` on, as int32 (Spark's byte is signed)."""
    f.seek(HEADER[kind] + first * record)
    return np.frombuffer(f.read(n * record), np.uint8).astype(np.int32)


class RecordRange:
    """Records first..last-1 of a file (of an image file and its label file) of `count`; row numbers start at `base`."""

    def __init__(self, files, base, first, last, count):
        self.files, self.base, self.first, self.last, self.count = files, base, first, last, count


class RecordRanges(InputPartition):
    """What one task reads."""

    def __init__(self, ranges):
        self.ranges = ranges


class IdxReader(DataSourceReader):
    """`paths` maps kind to path: images, labels, or both."""

    def __init__(self, paths, split, range_bytes):
        self.paths, self.split, self.range_bytes = paths, split, range_bytes

    def _counted(self):
        """Files that belong together, their records and the bytes of one, from the lengths of the files."""
        lists = {kind: _files(path) for kind, path in self.paths.items()}
        if len({len(files) for files in lists.values()}) > 1:
            raise ValueError(f"cannot pair {len(lists['images'])} image files with {len(lists['labels'])} label files")
        for kind, files in lists.items():
            for path, size in files:
                if size < HEADER[kind]:
                    raise ValueError(f"{path}: header cut off")
        record = 0
        for row in zip(*lists.values()):
            files, sizes = ({kind: f[i] for kind, f in zip(lists, row)} for i in (0, 1))
            if "labels" in sizes:
                count = sizes["labels"] - HEADER["labels"]
                record = max(1, (sizes["images"] - HEADER["images"]) // max(count, 1)) if "images" in sizes else 1
            else:
                if not record:
                    with _open(files["images"]) as f:
                        record = _header(f, files["images"], "images")[1]
                count = (sizes["images"] - HEADER["images"]) // max(record, 1)
            yield files, count, max(record, 1)

    def partitions(self):
        tasks, held, size, base = [], [], 0, 0
        for files, count, record in self._counted():
            step = max(1, self.range_bytes // record)
            for first in range(0, max(count, 1), step):
                last = min(first + step, count)
                if held and size + (last - first) * record + OPEN_BYTES > self.range_bytes:
                    tasks.append(RecordRanges(held))
                    held, size = [], 0
                held.append(RecordRange(files, base, first, last, count))
                size += (last - first) * record + OPEN_BYTES
            base += count
        return tasks + [RecordRanges(held)]

    def read(self, part):
        for one in part.ranges:
            yield from self._range(one)

    def _range(self, part):
        handles = {kind: _open(path) for kind, path in part.files.items()}
        try:
            headers = {kind: _header(f, part.files[kind], kind) for kind, f in handles.items()}
            counts = {kind: count for kind, (count, _) in headers.items()}
            if len(set(counts.values())) > 1:
                raise ValueError(f"cannot pair {counts['images']} images with {counts['labels']} labels")
            count, record = headers.get("images") or headers["labels"]
            if count != part.count:
                raise ValueError(f"{part.files['images']}: images of {record} bytes, others have another size; read them apart")
            per_batch = max(1, BATCH_BYTES // max(record, 1))
            for first in range(part.first, part.last, per_batch):
                n = min(per_batch, part.last - first)
                columns = {
                    "split": pa.array([self.split] * n, pa.string()),
                    "idx": pa.array(np.arange(part.base + first, part.base + first + n, dtype=np.int64)),
                }
                if "labels" in handles:
                    columns["label"] = pa.array(_bytes(handles["labels"], "labels", 1, first, n))
                if "images" in handles:
                    cells = _bytes(handles["images"], "images", record, first, n)
                    offsets = np.arange(n + 1, dtype=np.int32) * record
                    columns["px"] = pa.ListArray.from_arrays(pa.array(offsets), pa.array(cells))
                yield pa.RecordBatch.from_pydict(columns)
        finally:
            for f in handles.values():
                f.close()


class Written(WriterCommitMessage):
    """Names of the files that a task has left in the staging folders."""

    def __init__(self, names):
        self.names = names


class IdxWriter(DataSourceArrowWriter):
    """`folders` maps kind to folder. Values must be whole numbers from 0 to 255, images square and of one size."""

    def __init__(self, folders, file_records):
        self.folders, self.file_records, self.job = folders, file_records, uuid.uuid4().hex

    def _staging(self, kind):
        return f"{self.folders[kind].rstrip('/')}/_staging-{self.job}"

    def write(self, iterator):
        from pyspark import TaskContext

        part, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex[:8]
        held, size, names = {kind: [] for kind in self.folders}, 0, []

        def flush():
            name = f"part-{part:06d}-{len(names):06d}"
            for kind in self.folders:
                self._write_file(f"{self._staging(kind)}/{name}.{attempt}", kind, np.concatenate(held[kind]))
                held[kind] = []
            names.append(f"{name}.{attempt}")

        for batch in iterator:
            start = 0
            while start < batch.num_rows:
                rows = batch.slice(start, self.file_records - size)
                for kind in self.folders:
                    held[kind].append(self._cells(rows, kind))
                start, size = start + rows.num_rows, size + rows.num_rows
                if size == self.file_records:
                    flush()
                    size = 0
        if size:
            flush()
        return Written(names)

    @staticmethod
    def _cells(rows, kind):
        column = rows.column("px" if kind == "images" else "label")
        values = column.flatten() if kind == "images" else column
        if column.null_count or values.null_count:
            raise ValueError("a null cannot be written")
        cells = values.to_numpy(zero_copy_only=False)
        if len(cells) and (cells.min() < 0 or cells.max() > 255):
            raise ValueError("values must lie between 0 and 255")
        return cells.astype(np.uint8).reshape(rows.num_rows, -1)

    def _write_file(self, path, kind, cells):
        dims = [len(cells)]
        if kind == "images":
            side = round(cells.shape[1] ** 0.5)
            if side * side != cells.shape[1]:
                raise ValueError(f"{cells.shape[1]} values make no square image")
            dims += [side, side]
        system, inner = locate(path)
        system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
        with system.open_output_stream(inner) as f:
            f.write(struct.pack(f">{1 + len(dims)}i", MAGIC[kind], *dims))
            f.write(cells.tobytes())

    def commit(self, messages):
        names = [n for m in messages if m is not None for n in m.names]
        for kind in self.folders:
            system, target = locate(self.folders[kind].rstrip("/"))
            _, staged = locate(self._staging(kind))
            system.create_dir(target, recursive=True)
            for name in names:
                system.move(f"{staged}/{name}", f"{target}/{name.split('.')[0]}")
        self.abort(messages)

    def abort(self, messages):
        from pyarrow import fs

        for kind in self.folders:
            system, staged = locate(self._staging(kind))
            if system.get_file_info(staged).type == fs.FileType.Directory:
                system.delete_dir(staged)


class IdxDataSource(DataSource):
    """Options: kind ("images" or "labels"), labels (path of the label file to pair with), split, rangeBytes, fileRecords."""

    @classmethod
    def name(cls):
        return "idx"

    def _paths(self):
        kind = self.options.get("kind", "images")
        if kind not in MAGIC:
            raise ValueError(f"unknown kind {kind!r}")
        paths = {kind: self.options["path"]}
        if self.options.get("labels"):
            paths["labels"] = self.options["labels"]
        return paths

    def schema(self):
        paths = self._paths()
        return (
            "split string, idx bigint"
            + (", label int" if "labels" in paths else "") + (", px array<int>" if "images" in paths else "")
        )

    def writer(self, schema, overwrite):
        if overwrite:
            raise ValueError("IDX files are not overwritten, give a new folder")
        return IdxWriter(self._paths(), int(self.options.get("fileRecords", FILE_RECORDS)))

    def reader(self, schema):
        return IdxReader(
            self._paths(), self.options.get("split", "train"), int(self.options.get("rangeBytes", RANGE_BYTES))
        )


def _qualified(spark, paths):
    """Comma-separated paths with scheme and host of the file system that Spark resolves them on."""
    conf = spark._jsc.hadoopConfiguration()

    def full(path):
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(conf).makeQualified(p).toString().replace("s3a://", "s3://", 1)

    return ",".join(map(full, paths.split(",")))


def write_idx(df, images, labels, file_records=FILE_RECORDS):
    """Writes px and label of every row as IDX files in two folders, in the order of partitions and rows."""
    spark = df.sparkSession
    spark.dataSource.register(IdxDataSource)
    writer = df.select("px", "label").write.format("idx").option("labels", _qualified(spark, labels))
    writer.option("fileRecords", file_records).mode("append").save(_qualified(spark, images))


def read_idx(spark, path, kind="images", labels=None, split="train", range_bytes=RANGE_BYTES):
    """split, idx and label, px or both of IDX files.

    The split is a constant beside the scan, so a filter that it does not meet leaves the files unlisted and unopened.
    """
    spark.dataSource.register(IdxDataSource)
    source = spark.read.format("idx").option("kind", kind).option("rangeBytes", range_bytes)
    if labels:
        source = source.option("labels", _qualified(spark, labels))
    rows = source.load(_qualified(spark, path))
    return rows.select(F.lit(split).alias("split"), *rows.columns[1:])


def read_idx_split(spark, folder, range_bytes=RANGE_BYTES):
    """All four files of a data set folder as (split, idx, label, px); a filter on the split opens the files of that split only."""
    train, test = (
        read_idx(spark, f"{folder}/{images}", labels=f"{folder}/{labels}", split=split, range_bytes=range_bytes)
        for split, (images, labels) in FILES.items()
    )
    return train.unionByName(test)
