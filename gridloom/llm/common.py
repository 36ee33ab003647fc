"""Reading, slicing and numbering shared by the text operators."""

import itertools
import mmap
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs

from gridloom.session import locate, shared_dir

#: Bytes of text that a task handles at once.
SLICE = 2 << 20


def read(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df, kind):
    """df as a table in the shared folder: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm/{kind}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def save_arrays(path, arrays):
    """Write named arrays to one file of the shared folder, from a task; returns what mapped() needs."""
    system, inner = locate(path)
    system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    index, at = [], 0
    with system.open_output_stream(inner) as out:
        for name, a in arrays.items():
            data = np.ascontiguousarray(a).tobytes()
            index.append((name, a.dtype.str, a.shape, at))
            out.write(data + bytes(-len(data) % 64))
            at += -(-len(data) // 64) * 64
        out.write(bytes(64))  # an empty file cannot be mapped
    return path, index


def mapped(saved):
    """The arrays of a file, read-only; mapped where the folder is mounted, else read."""
    path, index = saved
    system, inner = locate(path)
    if isinstance(system, pa.fs.LocalFileSystem):
        with open(inner, "rb") as f:
            data = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
    else:
        with system.open_input_file(inner) as f:
            data = f.read()
    out = {}
    for name, dtype, shape, at in index:
        out[name] = np.ndarray(shape, np.dtype(dtype), data, at)
    return out


def slices(batches, text="text", most=SLICE):
    """Record batches cut so that their texts hold at most `most` bytes, or a single row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends, start = np.cumsum(sizes, dtype=np.int64), 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def texts(batch, name="text"):
    """Python strings; null counts as empty."""
    return pc.fill_null(batch.column(name), "").to_pylist()


def quantiles(df, parts, column="doc_id"):
    """At most parts - 1 ascending values that cut the column into about even ranges; a frequent one comes several times.

    Reads that column only. The values are whole numbers near the quantiles and need not occur: beyond 2^53 quantiles are rounded.
    """
    cuts = df.approxQuantile(column, [i / parts for i in range(1, parts)], 0.1 / parts)
    return sorted(min(int(x), (1 << 63) - 1) for x in cuts)


def even_bounds(df, parts, column="doc_id"):
    """The different values among the quantiles."""
    return sorted(set(quantiles(df, parts, column)))


def lists(flat, counts, kind):
    """Arrow list array from concatenated values and the length of each list."""
    offsets = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))


def ranges(starts, lengths):
    """Indices starts[0], starts[0]+1, ... lengths[0] of them, then those of the next start, and so on."""
    lengths = np.asarray(lengths, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.repeat(np.asarray(starts, np.int64) - before, lengths) + np.arange(lengths.sum())


def by_words(rows, encode):
    """Ids of rows of words, in order, and their number per row; encode gets each different word once."""
    place = {w: i for i, w in enumerate(dict.fromkeys(itertools.chain.from_iterable(rows)))}
    flat, n = encode(list(place))
    starts = np.cumsum(n) - n
    per = np.fromiter(map(len, rows), np.int64, len(rows))
    of = np.fromiter(map(place.__getitem__, itertools.chain.from_iterable(rows)), np.int64, per.sum())
    total = np.concatenate([[0], np.cumsum(n[of])])
    ends = np.cumsum(per)
    return flat[ranges(starts[of], n[of])], total[ends] - total[ends - per]


class Pieces:
    """Ids of text pieces, remembered inside one task; forgets all once `most` pieces are held."""

    def __init__(self, encode, most=400_000):
        self.encode, self.most = encode, most
        self._clear()

    def _clear(self):
        self.place, self.flat = {}, np.empty(1 << 16, np.int32)
        self.starts, self.sizes, self.used = [], [], 0

    def _add(self, new):
        flat, sizes = self.encode(new)
        need = self.used + len(flat)
        if need > len(self.flat):
            self.flat = np.concatenate([self.flat[: self.used], np.empty(max(need, len(self.flat)), np.int32)])
        self.flat[self.used:need] = flat
        starts = self.used + np.cumsum(sizes) - sizes
        for i, piece in enumerate(new, len(self.place)):
            self.place[piece] = i
        self.starts.append(starts)
        self.sizes.append(sizes)
        self.used = need

    def ids(self, rows):
        """rows: a list of pieces per text. All ids in order, and their number per text."""
        if len(self.place) > self.most:
            self._clear()
        n = np.fromiter(map(len, rows), np.int64, len(rows))
        pieces = list(itertools.chain.from_iterable(rows))
        if not pieces:
            return np.empty(0, np.int32), np.zeros(len(rows), np.int64)
        at = np.fromiter(map(self.place.get, pieces, itertools.repeat(-1)), np.int64, len(pieces))
        unknown = np.flatnonzero(at < 0)
        if len(unknown):
            missing = [pieces[i] for i in unknown.tolist()]
            self._add(list(dict.fromkeys(missing)))
            at[unknown] = np.fromiter(map(self.place.__getitem__, missing), np.int64, len(missing))
        self.starts, self.sizes = [np.concatenate(self.starts)], [np.concatenate(self.sizes)]
        lengths = self.sizes[0][at]
        total = np.concatenate([[0], np.cumsum(lengths)])
        ends = np.cumsum(n)
        return self.flat[ranges(self.starts[0][at], lengths)], total[ends] - total[ends - n]
