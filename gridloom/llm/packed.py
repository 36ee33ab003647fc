"""Token ids in files of fixed-width bit fields.

A block is one binary value: a header, the documents' ids and offsets, then all token ids in the fewest bits
that hold the vocabulary. Any document can be read alone: its offset times the width is its first bit. Blocks are rows of a
Parquet table in ascending document order, so writing has Spark's commit protocol and reading survives lost executors.

Layout of a block, little-endian: magic 'GLTB', version u16, width u16, documents u32, documents without id u32, tokens u64; then per
document its id i64 and per document and one more its offset u64; then the bit fields, least significant bit first. Documents without
id come first; their place among the ids holds 0.
"""

import json
import os
import struct
import unicodedata
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Window
from pyspark.sql import functions as F

from gridloom.llm.common import even_bounds, lists, ranges, read, slices, texts
from gridloom.llm.words import Words
from gridloom.session import shared_dir

MAGIC, VERSION, HEAD = b"GLTB", 2, "<4sHHIIQ"
BLOCK = "part int, block int, before long, first_doc long, last_doc long, n_docs int, n_tokens long, payload binary"


def width_of(vocabulary_size):
    """Fewest bits that hold every id."""
    return max(1, int(vocabulary_size - 1).bit_length())


def pack(ids, width):
    """Bit fields of ids, least significant bit first."""
    ids = np.asarray(ids, np.uint32)
    if width < 32 and len(ids) and int(ids.max()) >> width:
        raise ValueError(f"an id needs more than {width} bits")
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    out = [np.packbits((ids[i:i + 65_536, None] >> np.arange(width, dtype=np.uint32)) & 1, bitorder="little", axis=None)
           for i in range(0, len(ids), 65_536)]  # 65,536 fields fill whole bytes
    return b"".join(x.tobytes() for x in out)


def unpack(data, width, start, count):
    """Ids start, start+1, ..., start+count-1 of the bit fields."""
    if width in (8, 16, 32):
        return np.frombuffer(data, f"<u{width // 8}", count, start * width // 8).astype(np.uint32)
    first = np.arange(start, start + count, dtype=np.int64) * width
    wide = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(8, np.uint8)])
    low = first >> 3
    word = np.zeros(count, np.uint64)
    for i in range((width + 14) // 8):
        word |= wide[low + i].astype(np.uint64) << np.uint64(8 * i)
    return ((word >> (first & 7).astype(np.uint64)) & np.uint64((1 << width) - 1)).astype(np.uint32)


def make_block(doc_ids, counts, ids, width):
    """doc_ids: a list, None for no id; those come first."""
    nulls = sum(d is None for d in doc_ids)
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype("<u8")
    head = struct.pack(HEAD, MAGIC, VERSION, width, len(doc_ids), nulls, len(ids))
    return head + np.asarray([0] * nulls + list(doc_ids[nulls:]), "<i8").tobytes() + offsets.tobytes() + pack(ids, width)


class Block:
    """Reads a block; doc(i) unpacks the ids of its i-th document only. The first `nulls` documents have no id."""

    def __init__(self, payload):
        size = struct.calcsize(HEAD)
        magic, version, self.width, n, self.nulls, self.n_tokens = struct.unpack_from(HEAD, payload)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a block of token ids")
        self.doc_ids = np.frombuffer(payload, "<i8", n, size)
        self.offsets = np.frombuffer(payload, "<u8", n + 1, size + 8 * n).astype(np.int64)
        self.fields = memoryview(payload)[size + 8 * (2 * n + 1):]
        if len(self.fields) != (self.n_tokens * self.width + 7) // 8:
            raise ValueError("a block is cut off")

    def doc(self, i):
        return unpack(self.fields, self.width, int(self.offsets[i]), int(self.offsets[i + 1] - self.offsets[i]))

    def all(self):
        return unpack(self.fields, self.width, 0, self.n_tokens)


#: The pattern that WordEncoder splits by, a fixed value.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SPACE, LETTER, NUMBER, OTHER = range(4)
ENDINGS = (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d")


def kind_of(char):
    if char.isspace() and char not in "\x1c\x1d\x1e\x1f":
        return SPACE
    return {"L": LETTER, "N": NUMBER}.get(unicodedata.category(char)[0], OTHER)


class LatinWords(Words):
    """Matches of SPLIT in texts of characters up to U+00FF, one byte a character."""

    def _edges(self, raw, separators):
        kind = np.array([kind_of(chr(i)) for i in range(256)], np.uint8)[raw]
        begins = np.ones(len(raw), bool)
        begins[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER)
        quotes = np.flatnonzero(raw == ord("'"))
        for i in quotes[(quotes == 0) | (kind[quotes - 1] != OTHER)].tolist():
            for ending in ENDINGS:
                after = i + 1 + len(ending)
                if self.data[i + 1:after] == ending:
                    # a quote at the start of a word takes its ending along
                    begins[i + 1] = False
                    begins[after] = True
                    break
        begins |= kind == SPACE
        at = np.flatnonzero(begins)
        word = kind[at] != SPACE
        return at[word], np.append(at[1:], len(raw))[word]


class WordEncoder:
    """Ids of a text by a tokenizer file, from ids of its different words.

    Holds only for tokenizers that drop white space, lower-case character by character, split by a pattern and mark word
    ends, which is checked. Texts of
    characters up to U+00FF are lower-cased by Python; others, and texts with the name of an added token, go through the
    library as a whole.
    """

    def __init__(self, path):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            given = json.load(f)
        splits = [x["pattern"]["Regex"] for x in given["pre_tokenizer"]["pretokenizers"] if x["type"] == "Split"]
        suffix = given["model"]["end_of_word_suffix"]
        if splits != [SPLIT] or not suffix:
            raise ValueError("the tokenizer must split by SPLIT and mark word ends")
        # the same model for words that are lower-cased and split already
        steps = [x for x in given["pre_tokenizer"]["pretokenizers"] if x["type"] != "Split"]
        bare = given | {"normalizer": None, "added_tokens": [], "pre_tokenizer": {
            "type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, *steps]}}
        self.bare = Tokenizer.from_str(json.dumps(bare))
        vocabulary = self.library.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        probe = "It's a  Test\nÉTÉ, 42 (x) y"
        parts = [i for p in probe.lower().split() for i in self.library.encode(p, add_special_tokens=False).ids]
        if self.library.encode(probe, add_special_tokens=False).ids != parts:
            raise ValueError("the tokenizer does not work on white-space separated pieces")
        added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.odd = ["\x1c", "\x1d", "\x1e", "\x1f", *added]
        self._forget()

    def _forget(self):
        self.values = self.place = self.starts = self.sizes = np.empty(0, np.int64)
        self.values, self.flat = self.values.astype(np.uint64), np.empty(0, np.int32)

    def _learn(self, values, words):
        """Remembers the ids of words, found again by their 64-bit values."""
        flat, n = self._words(words)
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(n) - n])
        self.sizes = np.concatenate([self.sizes, n])
        self.flat = np.concatenate([self.flat, flat])
        values = np.concatenate([self.values, values])
        place = np.concatenate([self.place, np.arange(len(self.place), len(values))])
        order = np.argsort(values)
        self.values, self.place = values[order], place[order]

    def _known(self, words):
        """Ids of all words of a Words, in order, and their number per text."""
        if len(self.values) > 1_000_000:
            self._forget()
        distinct, example, of = np.unique(words.values, return_index=True, return_inverse=True)
        at = np.searchsorted(self.values, distinct)
        new = np.flatnonzero(np.append(self.values, np.uint64(0))[at] != distinct)
        new = np.union1d(new, np.flatnonzero(at == len(self.values)))
        if len(new):
            k = example[new]
            self._learn(distinct[new], [words.data[a:b].decode("latin-1") for a, b in zip(words.starts[k].tolist(), words.ends[k].tolist())])
            at = np.searchsorted(self.values, distinct)
        place = self.place[at][of]
        lengths = self.sizes[place]
        total = np.concatenate([[0], np.cumsum(lengths)])
        return self.flat[ranges(self.starts[place], lengths)], total[words.first + words.counts] - total[words.first]

    def _words(self, words, most=4096):
        """The words go through the library as one text; each ends with a token that ends a word."""
        flat, sizes = [np.empty(0, np.int32)], [np.empty(0, np.int64)]
        for i in range(0, len(words), most):
            part = words[i:i + most]
            ids = np.asarray(self.bare.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, np.int32)
            sizes.append(np.diff(np.flatnonzero(self.ends_word[ids]), prepend=-1))
            if len(sizes[-1]) != len(part):
                raise ValueError("the tokenizer's words are not the pattern's")
            flat.append(ids)
        return np.concatenate(flat), np.concatenate(sizes)

    def plain(self, text):
        """The lower-cased text, one byte a character, if its words' ids are the text's; None if the library must see it."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return None
        return None if any(x in text for x in self.odd) else text.lower().encode("latin-1")

    def ids(self, texts, end):
        """Ids of all texts, each with end behind it, and their number per text."""
        rows = [self.plain(t) for t in texts]
        flat, n = self._known(LatinWords([r or b"" for r in rows]))
        whole = [i for i, r in enumerate(rows) if r is None]
        ends = np.cumsum(n)
        parts, sizes = [], n + 1
        encoded = dict(zip(whole, self.library.encode_batch([texts[i] for i in whole], add_special_tokens=False)))
        last = np.asarray([end], np.int32)
        for i, stop in enumerate(ends):
            mine = np.asarray(encoded[i].ids, np.int32) if i in encoded else flat[stop - n[i]:stop]
            sizes[i] = len(mine) + 1
            parts += [mine, last]
        return (np.concatenate(parts) if parts else np.empty(0, np.int32)), sizes


def encode(docs, tokenizer_path, end_id, id_col="doc_id", text_col="text"):
    """doc_id and ids: the ids of each whole text with end_id behind them. Null and empty texts have end_id only."""
    return _source(docs, id_col, text_col).mapInArrow(_encoding(tokenizer_path, end_id), "doc_id long, ids array<int>")


def _source(docs, id_col, text_col):
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def _encoding(tokenizer_path, end_id):
    def run(batches):
        encoder = WordEncoder(tokenizer_path)
        for part in slices(batches):
            flat, n = encoder.ids(texts(part), end_id)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists(flat, n, pa.int32())], ["doc_id", "ids"])

    return run


def _narrowing(width, bounds):
    """doc_id and ids to part, doc_id, n and the packed ids; bounds cut doc_ids into parts."""
    bounds = np.asarray(bounds, np.int64)

    def run(batches):
        for batch in batches:
            rows = batch.column("ids")
            n = np.asarray(rows.value_lengths().fill_null(0))
            flat = np.asarray(rows.flatten(), np.int32)
            data = [pack(flat[e - k:e], width) for e, k in zip(np.cumsum(n), n)]
            docs = batch.column("doc_id")
            part = np.searchsorted(bounds, pc.fill_null(docs, 0).to_numpy(), side="right").astype(np.int32)
            part[docs.is_null().to_numpy(zero_copy_only=False)] = 0  # a row without id comes first
            yield pa.RecordBatch.from_arrays(
                [pa.array(part), docs, pa.array(n, pa.int32()), pa.array(data, pa.binary())],
                ["part", "doc_id", "n", "packed"])

    return run


PACKED = "part int, doc_id long, n int, packed binary"


def write(encoded, path, width, bounds, block_tokens=1 << 18):
    """Writes doc_id and ids as blocks in ascending doc_id order; rows of one doc_id, or without one, are ordered by length and ids.

    Ids are packed before the only shuffle, which deals them by the ranges that the ascending doc_ids in bounds cut. Rows
    without a doc_id come first. part numbers the ranges, block the blocks inside one, before counts the part's tokens in earlier
    blocks; a block ends after the document that fills it.
    """
    _write(encoded.mapInArrow(_narrowing(width, bounds), PACKED), path, width, len(bounds) + 1, block_tokens)


def write_texts(docs, path, tokenizer_path, end_id, width, bounds, id_col="doc_id", text_col="text", block_tokens=1 << 18):
    """encode() and write() in one pass over the texts."""
    encoding, narrowing = _encoding(tokenizer_path, end_id), _narrowing(width, bounds)
    packed = _source(docs, id_col, text_col).mapInArrow(lambda batches: narrowing(encoding(batches)), PACKED)
    _write(packed, path, width, len(bounds) + 1, block_tokens)


def _write(packed, path, width, parts, block_tokens):
    def block(batches):
        part, number, before, held, ids, counts, flat = None, 0, 0, 0, [], [], []

        def flush():
            payload = make_block(ids, counts, np.concatenate(flat), width)
            row = [[part], [number], [before], [ids[0]], [ids[-1]], [len(ids)], [held], [payload]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(row, kinds)], [x.split()[0] for x in BLOCK.split(", ")])

        for batch in batches:
            for now, doc, n, data in zip(*(batch.column(c).to_pylist() for c in ("part", "doc_id", "n", "packed"))):
                if ids and (held >= block_tokens or now != part):
                    yield flush()
                    number, before = (number + 1, before + held) if now == part else (0, 0)
                    held, ids, counts, flat = 0, [], [], []
                part, held = now, held + n
                ids.append(doc)
                counts.append(n)
                flat.append(unpack(data, width, 0, n))
        if ids:
            yield flush()

    dealt = packed.repartitionById(parts, "part").sortWithinPartitions("part", F.asc_nulls_first("doc_id"), "n", "packed")
    dealt.mapInArrow(block, BLOCK).write.parquet(path)


def read_back(spark, path):
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32 of every document in the blocks.

    A document without an id has a null doc_id again.
    """
    blocks = spark.read.schema(BLOCK).parquet(path)
    sizes = blocks.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    # one row per part: as many as the writer was given bounds, however many documents there are
    earlier = F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("part", F.coalesce(earlier, F.lit(0)).alias("earlier"))
    placed = blocks.select("part", "before", "payload").join(F.broadcast(sizes), "part")
    placed = placed.select((F.col("earlier") + F.col("before")).alias("base"), "payload")

    def digest(batches):
        for batch in batches:
            for base, payload in zip(batch.column("base").to_pylist(), batch.column("payload")):
                b = Block(payload.as_py())
                ids = b.all().astype("<u4")
                docs = pa.array(b.doc_ids, mask=np.arange(len(b.doc_ids)) < b.nulls)
                crc = [zlib.crc32(ids[i:j]) for i, j in zip(b.offsets[:-1], b.offsets[1:])]
                yield pa.RecordBatch.from_arrays(
                    [docs, pa.array(base + b.offsets[:-1]), pa.array(np.diff(b.offsets)), pa.array(crc, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"])

    return placed.mapInArrow(digest, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op8(spark, sf_dir):
    """Writes all documents' ids as packed blocks and reads them back."""
    import public_tokenizers
    import tokenizers

    path, model, end = f"{shared_dir(spark)}/llm/tokens-{uuid.uuid4().hex}", public_tokenizers.path("word_bpe_49k.json"), 2
    width = width_of(1 + max(end, *tokenizers.Tokenizer.from_file(model).get_vocab().values()))
    docs = read(spark, sf_dir, "documents")
    bounds = even_bounds(docs, int(spark.conf.get("spark.sql.shuffle.partitions")))
    write_texts(docs, path, model, end, width, bounds)
    return read_back(spark, path)
