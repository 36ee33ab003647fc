"""Substring deduplication by prefix-partitioned suffix trees over words.

1. Copies: of equal texts only the one with the smallest id goes on; the others lose every word a window covers.
2. Prefixes: every window of `length` words holds one anchor, the word run of least hash among its runs of `prefix` words, at a
   place that only its words decide. Suffixes start at anchors; anchors that occur in one document only are leaves
   at the root and drop out.
3. Groups: suffixes are split by their prefix, at first the anchor. Where one document has many suffixes with one anchor, the prefix
   is lengthened for all documents: windows whose places differ little share more words, which lead the group's suffixes,
   in the end all words of one window. A suffix that a document repeats is kept once, with its places. A prefix that still has more
   suffixes than fit in memory, now of many documents, is split by a hash of the document; such groups also report each window's
   first document, and these firsts are compared by window.
4. Subtrees: a group's suffixes, sorted, with the common length of neighbours are its tree; so are the words before the anchor, read
   backwards. Nodes deep enough on both sides together hold the occurrences of one window.
5. Windows that occur in a smaller document cover words; those words are removed.
"""

import hashlib
import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Window
from pyspark.sql import functions as F

from gridloom.llm.common import ranges, read, slices, texts, written
from gridloom.llm.words import SPACES, Words, combine, mix

#: Bits of a place in the key that finds a window's anchor.
PLACE = 30


def anchors_of(values, first, counts, length, prefix):
    """Anchors of the texts with `length` words or more: text, word place, and first and last window, counted from the text.

    values: the words of all texts, first and counts: where each text's words lie.
    """
    long = np.flatnonzero(counts >= length)
    span = length - prefix + 1
    runs = combine(values, prefix)
    empty = np.empty(0, np.int64)
    if not len(long):
        return empty, empty, empty, empty, runs
    order = mix(runs ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(PLACE) << np.uint64(PLACE)
    key = order | np.arange(len(runs), dtype=np.uint64)
    # least key of `span` neighbours, by doubling
    least, width = key, 1
    while width * 2 <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < span:
        least = np.minimum(least[:len(key) - span + 1], least[span - width:span - width + len(key) - span + 1])
    windows = counts[long] - length + 1
    at = ranges(first[long], windows)
    text = np.repeat(long, windows)
    anchor = (least[at] & np.uint64((1 << PLACE) - 1)).astype(np.int64)
    new = np.ones(len(at), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    begin = np.flatnonzero(new)
    last = np.append(begin[1:], len(at)) - 1
    text = text[begin]
    return text, anchor[begin] - first[text], at[begin] - first[text], at[last] - first[text], runs


def covered(n_words, windows, length):
    """Which words lie in a removed window. windows: places and a mask whose bit o stands for the windows that start o words before them."""
    change = np.zeros(n_words + 1, np.int64)
    for places, mask in windows:
        back = np.flatnonzero(mask >> np.arange(63) & 1)
        starts = (np.asarray(places, np.int64)[:, None] - back).ravel()
        np.add.at(change, starts, 1)
        np.add.at(change, starts + length, -1)
    return np.cumsum(change[:-1]) > 0


def pieces(start, mark, values, length, prefix):
    """Suffixes of one anchor: key of the prefix, words before the anchor, and the words of the windows.

    Windows are dealt by how many words they start before the anchor, `width` neighbouring numbers together: these share all words but width - 1,
    which are the prefix.
    """
    at, before, after, width = mark["spot"] >> 16, mark["spot"] >> 8 & 255, mark["spot"] & 255, mark["width"]
    at += start
    if width > length - prefix:
        yield mark["g"], before, values[at - before:at - after + length].tobytes()
        return
    for low in range(after // width * width, before + 1, width):
        high = min(low + width - 1, length - prefix)
        first, last = min(before, high), max(after, low)
        core = hashlib.blake2b(values[at - low:at - high + length].tobytes() + bytes([low]), digest_size=8).digest()
        yield int.from_bytes(core, "little", signed=True), first, values[at - first:at - last + length].tobytes()


class Subtrees:
    """Suffix trees of whole groups, side by side. Rows: group, doc, place, before and after (words before and from the anchor)."""

    def __init__(self, group, before, after, length):
        self.length, n = length, len(group)
        self.n_before = np.fromiter(map(len, before), np.int64, n)
        self.n_after = np.fromiter(map(len, after), np.int64, n)
        self.after, self.after_shared, self.after_order = self._tree(group, after, length)
        self.before, self.before_shared, self.before_order = self._tree(group, [b[::-1] for b in before], length)

    @staticmethod
    def _tree(group, rows, width):
        """Words as a matrix (zeros behind the end), order of the suffixes, and how many words each shares with the one before."""
        sizes = np.fromiter(map(len, rows), np.int64, len(rows))
        words = np.zeros((len(rows), width + 1), ">u8")
        words[:, 0] = group
        words[np.repeat(np.arange(len(rows)), sizes), 1 + ranges(np.zeros(len(rows)), sizes)] = np.concatenate(rows)
        order = np.argsort(words.view(f"S{8 * (width + 1)}").ravel(), kind="stable")
        same = words[order[1:]] == words[order[:-1]]
        shared = np.where(same.all(1), width + 1, same.argmin(1))
        return words, np.concatenate([[0], shared]), order

    @staticmethod
    def _nodes(shared, order, depth):
        """For every row its node at a depth (the group counts as one more word)."""
        node = np.empty(len(order), np.int64)
        node[order] = np.cumsum(shared < depth + 1)
        return node

    def first_docs(self, doc, back):
        """Rows that have the window starting `back` words before their anchor, and the smallest doc that has the same one."""
        rows = np.flatnonzero((self.n_before >= back) & (self.n_after >= self.length - back))
        node = self._nodes(self.after_shared, self.after_order, self.length - back) << 32
        node |= self._nodes(self.before_shared, self.before_order, back)
        order = rows[np.lexsort((doc[rows], node[rows]))]
        new = np.ones(len(order), bool)
        new[1:] = np.diff(node[order]) != 0
        head = order[new]
        return order, doc[head][np.cumsum(new) - 1]


def repeated_windows(batches, length):
    """Local verdicts: doc_id, h, places, mask of removed windows; and for split groups windows that were first in their group."""
    names = ["doc_id", "h", "places", "mask", "w1", "w2"]
    for rows in _whole_groups(batches, ["g", "salt"]):
        doc, g, salt = (rows.column(c).to_numpy() for c in ("doc_id", "g", "salt"))
        places, split = rows.column("places").combine_chunks(), rows.column("parts").to_numpy() > 1
        place = pc.list_element(places, 0).to_numpy()
        words = [np.frombuffer(x, np.uint64) for x in rows.column("words").to_pylist()]
        n_before = rows.column("n_before").to_numpy()
        group = np.cumsum(np.concatenate([[1], (np.diff(g) != 0) | (np.diff(salt) != 0)]))
        trees = Subtrees(group, [w[:b] for w, b in zip(words, n_before)], [w[b:] for w, b in zip(words, n_before)], length)
        mask, firsts = np.zeros(len(doc), np.int64), []
        for back in range(int(n_before.max(initial=0)) + 1):
            order, least = trees.first_docs(doc, back)
            mask[order[doc[order] > least]] |= np.int64(1 << back)
            mine = order[(doc[order] == least) & split[order]]
            firsts += [(i, back) for i in mine.tolist()]
        hit = np.flatnonzero(mask)
        h = rows.column("h").to_numpy()
        unique = mix(doc[hit].view(np.uint64) ^ mix(h[hit].view(np.uint64) + place[hit].astype(np.uint64)))
        yield pa.RecordBatch.from_arrays([pa.array(doc[hit]), pa.array(h[hit]), places.take(pa.array(hit)), *map(pa.array, (
            mask[hit], unique.view(np.int64), np.zeros(len(hit), np.int64)))], names)
        if firsts:
            at, back = np.array(firsts).T
            values = np.stack([words[i][n_before[i] - o:n_before[i] - o + length] for i, o in firsts])
            w1, w2 = (_fold(values, base) for base in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F))
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc[at]), pa.array(h[at]), places.take(pa.array(at)), *map(pa.array, (-1 - back, w1, w2 | 1))], names)


def _fold(values, base):
    out = np.zeros(len(values), np.uint64)
    for column in values.T:
        out = mix(out * np.uint64(base) + column)
    return out.view(np.int64)


def _whole_groups(batches, keys, enough=8192):
    """Tables of whole groups, of at least `enough` rows but for the last, from batches sorted by the keys."""
    held, size = [], 0
    for batch in batches:
        held.append(pa.Table.from_batches([batch]))
        size += batch.num_rows
        if size < enough:
            continue
        table = pa.concat_tables(held).combine_chunks()
        cut = np.flatnonzero(np.any([np.diff(table.column(k).to_numpy()) != 0 for k in keys], axis=0))
        done = int(cut[-1]) + 1 if len(cut) else 0
        for start in _starts(table, keys, done, enough):
            yield table.slice(*start)
        held, size = [table.slice(done)], table.num_rows - done
    if size:
        yield pa.concat_tables(held).combine_chunks()


def _starts(table, keys, done, enough):
    """Slices of whole groups that end before row `done`."""
    cut = np.flatnonzero(np.any([np.diff(table.column(k).to_numpy()[:done]) != 0 for k in keys], axis=0)) + 1 if done else []
    start = 0
    for stop in [*list(cut), done]:
        if stop - start >= enough or stop == done and stop > start:
            yield start, int(stop) - start
            start = int(stop)


def remove_repeats(docs, id_col="doc_id", text_col="text", length=50, prefix=12, group=4096):
    """id_col, n_words, n_removed and kept (the kept words joined by one space) of every row.

    A word is removed if a window of `length` consecutive words covers it whose words also start in a row with a smaller id.
    Words end at ASCII white space and stay as they are. Null, empty and shorter texts keep all words. Rows with one id are not
    smaller than each other; a row with a null id keeps all words and takes none from others. group: about the most
    suffixes in one subtree; results do not depend on it. Memory: a row with its places, and some groups. Other columns are left out.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return _remove(source, length, prefix, group).select(F.col("doc_id").alias(id_col), "n_words", "n_removed", "kept")


def without_repeats(docs, id_col="doc_id", text_col="text", length=50, prefix=12, group=4096):
    """docs with its columns, where a text that lost words is its kept words joined by one space; other texts stay as they are."""
    source = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
        F.struct(*[c for c in docs.columns if c != text_col]).alias("row"))
    kept = _remove(source, length, prefix, group)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text")).alias(text_col)
    return kept.select("row.*", text).select(docs.columns)


def _remove(source, length, prefix, group):
    """source (doc_id, text and perhaps row) with n_words, n_removed and kept."""
    if not 0 < prefix <= length or length - prefix > 62:
        raise ValueError("prefix must be at most length and at least length - 62")
    columns = source.columns
    source = source.withColumn("h", F.xxhash64("text"))
    # the one shuffle of texts: three steps below read the same exchange
    rows = source.filter("doc_id IS NOT NULL")
    keys = rows.select("doc_id", "h", F.xxhash64(F.lit(1), "text").alias("h2"))
    first = keys.groupBy("h", "h2").agg(F.min("doc_id").alias("rep"))
    copies = keys.join(first, ["h", "h2"]).filter("doc_id > rep").select("doc_id", "h", F.lit(True).alias("copy")).distinct()
    row = ["doc_id", "h"]

    def place(batches):
        for part in slices(batches):
            w = Words(texts(part), SPACES)
            text, at, lo, hi, runs = anchors_of(w.values, w.first, w.counts, length, prefix)
            keep = ~pc.fill_null(part.column("copy"), False).to_numpy(zero_copy_only=False)[text]
            text, at, lo, hi = text[keep], at[keep], lo[keep], hi[keep]
            g = runs[w.first[text] + at].view(np.int64)
            spot = at << 16 | (at - lo) << 8 | (at - hi)
            yield pa.RecordBatch.from_arrays(
                [pa.array(g), part.column("doc_id").take(pa.array(text)), part.column("h").take(pa.array(text)), pa.array(spot),
                 pa.array(_times(text, g), pa.int32())], ["g", *row, "spot", "times"])

    anchors = rows.join(copies, row, "left").select(*columns, "h", "copy").mapInArrow(
        place, "g long, doc_id long, h long, spot long, times int")
    shared = anchors.groupBy("g").agg(
        F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count("*").alias("n"), F.max("times").alias("times"))
    # the prefix grows with the most suffixes that one text has with it
    some = max(1, round((length - prefix + 1) ** 0.5))
    width = F.when(F.col("times") <= group // 2, length - prefix + 1).when(F.col("times") <= 8 * group, some).otherwise(1)
    shared = shared.filter("lo < hi").select("g", F.ceil(F.col("n") / group).cast("int").alias("parts"), width.cast("int").alias("width"))
    # a table of its own, so that the join can split a frequent anchor's rows
    marked = anchors.drop("times").join(written(shared, "prefixes"), "g")
    marked = marked.groupBy(*row).agg(F.collect_set(F.struct("g", "spot", "parts", "width")).alias("marks"))

    def cut_out(batches):
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.binary()]
        names = ["g", "salt", "parts", *row, "places", "n_before", "words"]
        for part in slices(batches):
            w = Words(texts(part), SPACES)
            out = [[] for _ in kinds]
            for doc, h, marks, start in zip(*(part.column(c).to_pylist() for c in (*row, "marks")), w.first):
                salt = int(mix(np.array([doc]).view(np.uint64))[0] >> np.uint64(1))
                found = {}
                for m in marks:
                    for key, before, words in pieces(start, m, w.values, length, prefix):
                        found.setdefault((key, m["parts"], before, words), []).append(m["spot"] >> 16)
                for (key, parts, before, words), places in found.items():
                    for column, value in zip(out, (key, salt % parts, parts, doc, h, places, before, words)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)

    suffixes = rows.join(marked, row).select(*columns, "h", "marks").mapInArrow(
        cut_out, "g long, salt long, parts int, doc_id long, h long, places array<long>, n_before int, words binary")
    grouped = suffixes.repartition("g", "salt").sortWithinPartitions("g", "salt")
    local = grouped.mapInArrow(
        lambda b: repeated_windows(b, length), "doc_id long, h long, places array<long>, mask long, w1 long, w2 long")
    # of a split group's firsts, those with a smaller one in another part go too; mask < 0 stands for one window
    least = F.min("doc_id").over(Window.partitionBy("w1", "w2"))
    final = local.withColumn("least", least).filter("mask > 0 OR doc_id > least")
    mask = F.when(F.col("mask") > 0, F.col("mask")).otherwise(F.expr("shiftleft(1L, cast(-1 - mask AS int))"))
    gone = final.groupBy(*row).agg(F.collect_set(F.struct("places", mask.alias("mask"))).alias("gone"))

    def strip(batches):
        for part in slices(batches):
            n, removed, kept = [], [], []
            for text, copy, windows in zip(texts(part), *(part.column(c).to_pylist() for c in ("copy", "gone"))):
                words = text.encode("utf-8").split()
                n.append(len(words))
                if copy and len(words) >= length:
                    words = []
                elif windows:
                    cover = covered(len(words), [(x["places"], x["mask"]) for x in windows], length)
                    words = list(itertools.compress(words, ~cover))
                removed.append(n[-1] - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in columns), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string())], [*columns, "n_words", "n_removed", "kept"])

    joined = rows.join(copies.join(gone, row, "full"), row, "left").select(*columns, "copy", "gone")
    nobody = source.filter("doc_id IS NULL").select(*columns, F.lit(None).cast("boolean").alias("copy"), F.lit(None).cast(
        "array<struct<places:array<bigint>,mask:bigint>>").alias("gone"))
    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in source.schema if f.name != "h"]
    return joined.unionByName(nobody).mapInArrow(strip, ", ".join([*kinds, "n_words long, n_removed long, kept string"]))


def _times(text, g):
    """For each anchor, how many its text has with the same words."""
    order = np.lexsort((g, text))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(g[order]) != 0) | (np.diff(text[order]) != 0)
    size = np.diff(np.append(np.flatnonzero(new), len(order)))
    out = np.empty(len(order), np.int64)
    out[order] = np.repeat(size, size)
    return out


def op10(spark, sf_dir):
    """What repeated passages leave of all documents."""
    kept = remove_repeats(read(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
