"""Byte-level BPE encoding and decoding inside each partition.

Inside a task, each pre-token not met before is contracted as tiktoken does: its adjacent pair of lowest rank, the leftmost of equal
ones, is merged until no pair has a rank. Short words are scanned directly; longer ones keep their pairs in a heap, so that a
word of n bytes costs n log n. Decoding gathers the bytes of all ids of a slice with numpy.

No shuffle: a document is encoded where it is read. Memory is bounded by the slice of text at hand, the remembered pieces
and the longest single text.
"""

import base64
import heapq
import itertools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from gridloom.llm.common import Pieces, by_words, lists, read, slices, texts

#: Words longer than this keep their pairs in a heap.
LONG = 64

#: A run of white space with the run of other characters behind it; U+001C to U+001F are no white space here.
PIECE = re.compile(r"[^\S\x1c-\x1f]*[\S\x1c-\x1f]+|[^\S\x1c-\x1f]+")


def read_ranks(path):
    """Token bytes to rank, from a file of base64 token and rank per line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Encoder:
    """Ids of words by the ranks of a rank file."""

    def __init__(self, ranks, pattern):
        import regex

        self.pattern = regex.compile(pattern)
        self.ranks = ranks
        self.of_byte = [bytes([i]) for i in range(256)]

    def word(self, word):
        """Ids of one word: the pair of lowest rank, leftmost first, is merged until none has a rank."""
        ranks = self.ranks
        if len(word) > LONG:
            return _merged_long(word, ranks)
        parts = [self.of_byte[b] for b in word]
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = ranks.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[p] for p in parts]

    def words(self, words):
        """Ids of all words in order and their number per word."""
        ids = [self.word(w) for w in words]
        n = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(itertools.chain.from_iterable(ids), np.int32, int(n.sum())), n

    def pieces(self, pieces):
        """Ids of text pieces: each is cut by the pattern, equal words are encoded once."""
        rows = [self.pattern.findall(p) for p in pieces]
        return by_words(rows, lambda words: self.words([w.encode("utf-8") for w in words]))


def _merged_long(word, ranks):
    """The same contraction over a linked list of parts, with the candidate pairs in a heap by (rank, start)."""
    n = len(word)
    end = list(range(1, n + 1))  # a part starting at i ends before end[i]
    nxt, prev, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    heap = []

    def push(i):
        j = nxt[i]
        if j < n:
            r = ranks.get(word[i:end[j]])
            if r is not None:
                heap.append((r, i, end[j]))

    for i in range(n - 1):
        push(i)
    heapq.heapify(heap)
    while heap:
        r, i, stop = heapq.heappop(heap)
        j = nxt[i] if alive[i] else n
        if j >= n or end[j] != stop:
            continue  # the pair changed since it was pushed
        end[i], alive[j] = stop, False
        nxt[i] = nxt[j]
        if nxt[i] < n:
            prev[nxt[i]] = i
        for k in (prev[i], i):
            if k >= 0:
                j = nxt[k]
                if j < n:
                    q = ranks.get(word[k:end[j]])
                    if q is not None:
                        heapq.heappush(heap, (q, k, end[j]))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i:end[i]]])
        i = nxt[i]
    return out


def encode(docs, vocabulary, pattern, id_col="doc_id", text_col="text"):
    """id_col and `ids`, the token ids of the whole text; null and empty texts have none.

    vocabulary: path of a rank file that every machine has. Each match of pattern is encoded on its own; no
    special tokens. Repeated rows are encoded as often as they occur; other columns are left out.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        known = Pieces(Encoder(read_ranks(vocabulary), pattern).pieces)
        for part in slices(batches):
            flat, n = known.ids([PIECE.findall(t) for t in texts(part)])
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists(flat, n, pa.int32())], ["doc_id", "ids"])

    return source.mapInArrow(run, "doc_id long, ids array<int>").withColumnRenamed("doc_id", id_col)


def decode(encoded, vocabulary, id_col="doc_id", ids_col="ids", most=1 << 20):
    """The columns of encoded and `bytes`, what the ids stand for; null or no ids give no bytes.

    An id outside the vocabulary is an error. At most `most` ids, or one row, are decoded at once.
    """
    source = encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))

    def run(batches):
        given = read_ranks(vocabulary)
        size = max(given.values()) + 1
        known = np.zeros(size, bool)
        width = np.zeros(size, np.int64)
        for token, rank in given.items():
            known[rank], width[rank] = True, len(token)
        at = np.cumsum(width) - width
        data = np.empty(int(width.sum()), np.uint8)
        for token, rank in given.items():
            data[at[rank]:at[rank] + len(token)] = np.frombuffer(token, np.uint8)
        for batch in batches:
            rows = batch.column("ids")
            sizes = np.asarray(rows.value_lengths().fill_null(0))
            ends, start = np.cumsum(sizes, dtype=np.int64), 0
            while start < batch.num_rows:
                base = ends[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
                yield _decoded(batch.slice(start, stop - start), sizes[start:stop], known, width, at, data)
                start = stop

    def _decoded(part, sizes, known, width, at, data):
        flat = np.asarray(part.column("ids").flatten(), np.int64)
        if len(flat) and (flat.min() < 0 or flat.max() >= len(known) or not known[flat].all()):
            raise ValueError("an id is not in the vocabulary")
        n = width[flat]
        taken = data[np.repeat(at[flat] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
        total = np.concatenate([[0], np.cumsum(n)])
        offsets = total[np.concatenate([[0], np.cumsum(sizes)])].astype(np.int32)
        back = pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(taken.tobytes())])
        return pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("ids"), back], ["doc_id", "ids", "bytes"])

    return source.mapInArrow(run, "doc_id long, ids array<int>, bytes binary").withColumnRenamed("doc_id", id_col)


def op1(spark, sf_dir):
    """Encodes and decodes every document."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = decode(encode(read(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN), path)
    return docs.select("doc_id", *digests())


def digests():
    """Number and digests of ids and of decoded bytes, from the columns ids and bytes."""
    return [
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("bytes"), 256).alias("decoded_sha256"),
    ]
