"""Benchmark decontamination with suffix arrays over the training text.

Each slice of documents is a shard. Its suffix array holds the places where a window can start, sorted by the next words; every
suffix of a benchmark item is looked up in it by binary search. That gives all verbatim occurrences of its window with
their places, and the longest verbatim match.

The benchmark's windows are built in tasks, in blocks of bounded size, and written to the shared folder as arrays that the
workers of a machine map together. The documents are read once, neither shuffled nor rewritten: a shard goes through all blocks, one after another.
"""

import ast
import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from gridloom.llm.common import mapped, ranges, read, save_arrays, slices, texts
from gridloom.llm.words import NO_WORD, Words
from gridloom.session import shared_dir


class Windows:
    """Suffixes of benchmark items, each with the words of its window.

    A window is `length` consecutive words; an item of fewer, but not none, is one window.
    """

    def __init__(self, items, item_texts, length=13):
        words = Words(item_texts, NO_WORD, lower=True)
        self.vocabulary = np.unique(words.values)
        ids = np.concatenate([np.searchsorted(self.vocabulary, words.values) + 1, np.zeros(length, np.int64)]).astype(np.uint32)
        n = words.counts
        suffixes = np.where(n >= length, n - length + 1, (n > 0).astype(n.dtype))
        at = ranges(words.first, suffixes)
        sizes = np.repeat(np.minimum(n, length), suffixes)
        rows = ids[at[:, None] + np.arange(length)] if len(at) else np.zeros((0, length), np.uint32)
        rows[np.arange(length) >= sizes[:, None]] = 0
        self.length, self.shortest = length, int(sizes.min(initial=length))
        keys = keys_of(rows)
        self.keys, self.which = np.unique(keys, return_inverse=True)  # equal windows are looked up once
        self.size = np.zeros(len(self.keys), np.int64)
        self.size[self.which] = sizes
        last = rows.copy()
        last[np.arange(length) >= sizes[:, None]] = 0xFFFFFFFF
        self.last = np.empty(len(self.keys), keys.dtype)
        self.last[self.which] = keys_of(last)
        # the suffixes (item, place in the item) of each window, one after another
        self.order = np.argsort(self.which, kind="stable")
        self.per = np.bincount(self.which, minlength=len(self.keys))
        self.begin = np.cumsum(self.per) - self.per
        self.item = np.repeat(np.arange(len(items)), suffixes)
        self.place = at - np.repeat(words.first, suffixes)
        self.items = np.asarray(items, np.int64)

    def save(self, path):
        """Write the arrays to a file; returns what load() needs to find it."""
        arrays = {name: a for name, a in vars(self).items() if isinstance(a, np.ndarray)}
        return {"arrays": save_arrays(path, arrays), "length": self.length, "shortest": self.shortest}

    @classmethod
    def load(cls, saved):
        """The windows of a file; where the shared folder is mounted, its pages are mapped and not copied."""
        out = cls.__new__(cls)
        vars(out).update(mapped(saved["arrays"]), length=saved["length"], shortest=saved["shortest"])
        return out


def keys_of(rows):
    """Rows of word numbers as byte strings that sort like them."""
    rows = np.ascontiguousarray(rows, ">u4")
    return rows.view(f"S{4 * rows.shape[1]}").ravel() if len(rows) else np.empty(0, f"S{4 * rows.shape[1]}")


def occurrences(windows, words):
    """Occurrences of windows in a shard: the window and the word at which it starts."""
    values, length = words.values, windows.length
    none = np.empty(0, np.int64), np.empty(0, np.int64)
    if not len(values) or not len(windows.keys):
        return none
    near = np.searchsorted(windows.vocabulary, values)
    near[near == len(windows.vocabulary)] = 0
    ids = np.where(windows.vocabulary[near] == values, near + 1, 0).astype(np.uint32)
    # a window needs so many benchmark words in a row inside one text
    stops = np.flatnonzero(ids == 0)
    stops = np.union1d(stops, words.first[words.first > 0])
    at = np.flatnonzero(ids)
    k = np.searchsorted(stops, at, side="right")
    end = np.append(stops, len(ids))[k]
    keep = end - at >= windows.shortest
    at, end = at[keep], end[keep]
    if not len(at):
        return none
    place = at[:, None] + np.arange(length)
    rows = np.where(place < end[:, None], np.append(ids, np.zeros(length, np.uint32))[place], 0)
    keys = keys_of(rows)
    suffix_array = np.argsort(keys, kind="stable")
    keys = keys[suffix_array]
    low = np.searchsorted(keys, windows.keys, side="left")
    high = np.searchsorted(keys, windows.last, side="right")
    found = np.flatnonzero(high > low)
    n = (high - low)[found]
    return np.repeat(found, n), at[suffix_array[ranges(low[found], n)]]


def matches(windows, words):
    """What a shard holds of the windows: covered words, items per text, and per text the longest match, its item and place."""
    window, at = occurrences(windows, words)
    n_texts = len(words.counts)
    change = np.zeros(len(words.values) + 1, np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at + windows.size[window], -1)
    items = [np.empty(0, np.int64)] * n_texts
    longest, longest_item, longest_at = np.zeros(n_texts, np.int64), np.full(n_texts, -1), np.full(n_texts, -1)
    if len(at):
        suffix = windows.order[ranges(windows.begin[window], windows.per[window])]
        at, size = np.repeat(at, windows.per[window]), np.repeat(windows.size[window], windows.per[window])
        item, text = windows.item[suffix], words.text_of(at)
        for t, group in _groups(np.unique(np.stack([text, item], 1), axis=0)):
            items[t] = windows.items[group]
        # windows that follow each other in item and text are one match
        diagonal = at - windows.place[suffix]
        order = np.lexsort((at, diagonal, item))
        text, item, at, size, diagonal = (x[order] for x in (text, item, at, size, diagonal))
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(item) != 0) | (np.diff(diagonal) != 0) | (np.diff(at) != 1) | (np.diff(text) != 0)
        start = np.flatnonzero(new)
        run = np.diff(np.append(start, len(at))) + size[start] - 1
        best = np.lexsort((at[start], windows.items[item[start]], -run, text[start]))
        t, where = np.unique(text[start][best], return_index=True)
        best = best[where]
        longest[t], longest_item[t] = run[best], windows.items[item[start][best]]
        longest_at[t] = at[start][best] - words.first[t]
    return np.cumsum(change[:-1]) > 0, items, longest, longest_item, longest_at


def _groups(pairs):
    cut = np.flatnonzero(np.diff(pairs[:, 0])) + 1
    for group in np.split(pairs, cut):
        yield group[0, 0], group[:, 1]


#: Bytes of benchmark text whose windows make one block; a task that builds it needs some 60 times as much for a while.
BLOCK = 4 << 20


def blocks(benchmark, item_col, text_col, length, most=None):
    """Files with the windows of the benchmark, each of at most `most` (BLOCK) bytes of text or one item, written by tasks.

    About two files for each `most` bytes at the most, however many partitions the benchmark has. The driver gets one short row for each
    file. Files of tasks that ran twice are not in the list and stay unread.
    """
    folder, most = f"{shared_dir(benchmark.sparkSession)}/llm/windows-{uuid.uuid4().hex}", most or BLOCK
    items = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(text_col).cast("string").alias("text"))
    items = items.filter("item IS NOT NULL AND length(text) > 0")
    tasks = -(-(items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // most)

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for part in slices([batch], most=most):
                if held and size + part.nbytes > most:
                    yield written(held)
                    held, size = [], 0
                held.append(part)
                size += part.nbytes
        if held:
            yield written(held)

    def written(held):
        table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        path = f"{folder}/{uuid.uuid4().hex}"
        saved = Windows(table.column("item").to_pylist(), texts(table), length).save(path)
        return pa.RecordBatch.from_arrays([pa.array([repr(saved)])], ["saved"])

    found = items.coalesce(max(1, tasks)).mapInArrow(run, "saved string").collect()
    return [ast.literal_eval(r.saved) for r in found]


def decontaminate(docs, benchmark, id_col="doc_id", text_col="text", item_col="item_id", item_text_col="text", length=13, share=20):
    """Verdict on every document: how many of its words lie in a verbatim benchmark window, and which items those are of.

    Words: A-Z lower-cased, runs of digits, letters and non-ASCII. Null or empty texts have no words and no hits; null items and null
    item texts count as no item; equal items are each counted. contaminated: at least 1 of `share` words is hit. longest: words
    of the longest verbatim match with its item and first word (0, -1, -1 without one; ties: smallest item, first place). Repeated
    rows are judged each; other columns are left out. An empty benchmark leaves every document clean.
    """
    rows = docs.select(F.struct(F.col(id_col).cast("long").alias(id_col)).alias("row"), F.col(text_col).cast("string").alias("text"))
    found = _over(rows, benchmark, item_col, item_text_col, length, share, VERDICT)
    return found.select(f"row.{id_col}", *[c for c in found.columns if c != "row"])


def clean(docs, benchmark, text_col="text", item_col="item_id", item_text_col="text", length=13, share=20):
    """The rows of docs that decontaminate() does not call contaminated, with their columns; without a shuffle."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(text_col).cast("string").alias("text"))
    return _over(rows, benchmark, item_col, item_text_col, length, share, CLEAN).select("row.*")


#: What is returned behind the column row: the verdict, or nothing, for clean rows only.
VERDICT = (
    ", n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, items array<long>, "
    "longest long, longest_item long, longest_at long")
CLEAN = ""


def _over(rows, benchmark, item_col, item_text_col, length, share, wanted):
    """One pass over rows (row, text), each slice of them against all blocks of the benchmark."""
    saved = blocks(benchmark, item_col, item_text_col, length)
    names = [x.split()[0] for x in wanted.split(", ")[1:]]

    def run(batches):
        windows = [Windows.load(s) for s in saved]
        for part in slices(batches):
            words = Words(texts(part), NO_WORD, lower=True)
            cover, items, longest = over_blocks(windows, words)
            ends = words.first + words.counts
            total = np.concatenate([[0], np.cumsum(cover)])
            n_hit = total[ends] - total[words.first]
            bad = (n_hit > 0) & (share * n_hit >= words.counts)
            if wanted == CLEAN:
                yield part.select(["row"]).filter(pa.array(~bad))
                continue
            digest = [hashlib.sha256(",".join(sorted(map(str, x.tolist()))).encode()).hexdigest() for x in items]
            found = dict(zip(("longest", "longest_item", "longest_at"), map(pa.array, longest))) | {
                "n_words": pa.array(words.counts), "n_hit": pa.array(n_hit), "n_items": pa.array([len(x) for x in items]),
                "items": pa.array([x.tolist() for x in items], pa.list_(pa.int64())),
                "items_sha256": pa.array(digest, pa.string()), "contaminated": pa.array(bad)}
            yield pa.RecordBatch.from_arrays([part.column("row"), *(found[x] for x in names)], ["row", *names])

    return rows.mapInArrow(run, "row " + rows.schema["row"].dataType.simpleString() + wanted)


def over_blocks(blocks, words):
    """matches() over all blocks: covered words, distinct items per text, and the longest match with its item and place."""
    n_texts = len(words.counts)
    cover, items = np.zeros(len(words.values), bool), [np.empty(0, np.int64)] * n_texts
    longest = [np.zeros(n_texts, np.int64), np.full(n_texts, -1), np.full(n_texts, -1)]
    for windows in blocks:
        hit, more, *best = matches(windows, words)
        cover |= hit
        items = [np.append(a, b) if len(b) else a for a, b in zip(items, more)]
        better = (best[0] > longest[0]) | ((best[0] == longest[0]) & (best[1] < longest[1]))
        longest = [np.where(better, a, b) for a, b in zip(best, longest)]
    return cover, [np.unique(x) for x in items], longest


def op2(spark, sf_dir):
    """Verdict on all documents against all benchmark items."""
    return decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).drop("items")
