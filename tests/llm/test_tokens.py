"""BPE, token counts and packed ids against the libraries."""

import base64
import random
import zlib

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")

from gridloom.llm import bpe, packed, token_counts  # noqa: E402
from gridloom.llm.common import even_bounds  # noqa: E402

ODD = [
    None, "", " ", "a", "  two  spaces ", "line\nend\n\n  x", "tab\there", "It's we'll I'D 'tis", "é ü ñ ß œ", "İstanbul ΣΑΣ ς", "日本語のテキスト 漢字",
    "🙂🙂 mixed🙂text", "\x1c\x1d a\x1cb $\x1c", "\x85 a\xa0b", "\0nul", "<|endoftext|> <|startoftext|>x", "<s> </s> <0x0A> ▁a▁▁b", "1234567 3.14 x2y",
    "a" * 3000, "=" * 1500 + " " * 700, "ab" * 900, "The cat.The cat,the CAT " * 50, "e\u0301 combining", "ﬁ ligature ①",
]


def rows():
    rng = random.Random(3)
    letters = "abcde ABé\n.,'’ \t0123日"
    more = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 300))) for _ in range(150)]
    return [(i, t) for i, t in enumerate(ODD + more)] + [(5, "line\nend\n\n  x")]


@pytest.fixture(scope="module")
def docs(spark):
    named = [(i, t, "x", [1], b"y", 7) for i, t in rows()]
    return spark.createDataFrame(named, "doc_id long, text string, tok string, ids array<int>, bytes binary, n_tokens int")


def tiktoken_encoding(name):
    import tiktoken

    ranks = bpe.read_ranks(P.path(name))
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library_and_decodes(spark, docs):
    name = "byte_bpe_multi_50k.tiktoken"
    got = bpe.decode(bpe.encode(docs, P.path(name), P.PATTERN), P.path(name)).collect()
    library = tiktoken_encoding(name)
    want = sorted((i, library.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows())
    assert sorted((r.doc_id, list(r.ids), bytes(r.bytes)) for r in got) == want


def test_bpe_of_an_empty_table_and_an_unknown_id(spark, docs):
    path = P.path("byte_bpe_multi_50k.tiktoken")
    assert bpe.decode(bpe.encode(docs.limit(0), path, P.PATTERN), path).collect() == []
    with pytest.raises(Exception, match="not in the vocabulary"):
        bpe.decode(spark.createDataFrame([(1, [999_999])], "doc_id long, ids array<int>"), path).collect()
    assert bpe.decode(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>"), path).first().bytes == b""


def test_equal_pairs_may_be_contracted_together():
    """Each token's last merge joins older tokens, so no merge makes a pair of lower rank."""
    ranks = bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken_encoding("byte_bpe_multi_50k.tiktoken")
    encoder = bpe.Encoder(ranks, P.PATTERN)
    words = [("xyz" * 200).encode(), b"a" * 777, ("straße" * 90).encode(), b"-" * 301, b"q"]
    flat, n = encoder.words(words)
    ends = np.cumsum(n)
    assert [flat[e - k:e].tolist() for e, k in zip(ends, n)] == [library._encode_single_piece(w) for w in words]
    for token, rank in list(ranks.items())[::37]:
        parts = [token[i:i + 1] for i in range(len(token))]
        while len(parts) > 1:
            best = min((ranks.get(parts[i] + parts[i + 1], 1 << 40), i) for i in range(len(parts) - 1))
            if best[0] == 1 << 40:
                break
            if len(parts) == 2:
                assert all(len(p) == 1 or ranks[p] < rank for p in parts)
            parts[best[1]:best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]


def test_token_counts_equal_the_library(spark, docs):
    import sentencepiece

    path = P.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    got = token_counts.token_counts(docs, path, sample_rows=20, entries=50).collect()
    want = sorted((i, len((t or "").encode()), len(library.encode(t or ""))) for i, t in rows())
    assert sorted(map(tuple, got)) == want
    assert token_counts.token_counts(docs.limit(0), path).collect() == []


def test_packed_blocks_give_back_what_the_library_encodes(spark, docs, tmp_path):
    import tokenizers

    path = P.path("word_bpe_49k.json")
    library = tokenizers.Tokenizer.from_file(path)
    unique = docs.filter("tok = 'x'").dropDuplicates(["doc_id"])
    bounds = even_bounds(unique, 5)
    out = str(tmp_path / "blocks")
    packed.write_texts(unique, out, path, 2, 16, bounds, block_tokens=200)
    want, start = [], 0
    for i, t in sorted(dict(rows()).items()):
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, packed.read_back(spark, out).collect())) == want
    apart = str(tmp_path / "apart")
    packed.write(packed.encode(unique, path, 2), apart, 17, bounds)
    assert sorted(map(tuple, packed.read_back(spark, apart).collect())) == want
    block = packed.Block(bytes(spark.read.parquet(apart).first().payload))
    assert block.all()[block.offsets[1]:block.offsets[2]].tolist() == block.doc(1).tolist()
    empty = str(tmp_path / "empty")
    packed.write_texts(docs.limit(0), empty, path, 2, 16, [])
    assert packed.read_back(spark, empty).collect() == []


def test_packed_rows_without_an_id_come_first(spark, tmp_path):
    import tokenizers

    path = P.path("word_bpe_49k.json")
    library = tokenizers.Tokenizer.from_file(path)
    rows = [(3, "c d e"), (None, "the same"), (-(1 << 63), "low"), (1, None), (None, "the same"), (0, "a b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for name, bounds, block_tokens in (("one", [], 1 << 18), ("more", [-(1 << 63), 1], 3)):
        out = str(tmp_path / name)
        packed.write_texts(docs, out, path, 2, 16, bounds, block_tokens=block_tokens)
        want, start = [], 0
        for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
            ids = library.encode(t or "", add_special_tokens=False).ids + [2]
            want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            start += len(ids)
        assert sorted(map(tuple, packed.read_back(spark, out).collect()), key=lambda r: r[1]) == want
        first = spark.read.parquet(out).orderBy("part", "block").first()
        assert packed.Block(bytes(first.payload)).nulls >= 1 and first.first_doc is None


def test_packed_rows_of_one_id_do_not_depend_on_their_order(spark, tmp_path):
    rows = [(1, t) for t in ("b b b", "a", "c d", "a", None, "long " * 20)] + [(None, "x y"), (None, "x"), (0, "z")]
    found = []
    for name, some in (("one", rows), ("two", rows[::-1]), ("three", rows[4:] + rows[:4])):
        docs = spark.createDataFrame(some, "doc_id long, text string").repartition(3)
        packed.write_texts(docs, str(tmp_path / name), P.path("word_bpe_49k.json"), 2, 16, [1])
        found.append(sorted(map(tuple, packed.read_back(spark, str(tmp_path / name)).collect()), key=lambda r: r[1]))
    assert len(found[0]) == len(rows) and found[0] == found[1] == found[2]


@pytest.mark.parametrize("width", [1, 3, 8, 13, 16, 17, 31, 32])
def test_bit_fields_round_trip(width):
    rng = np.random.default_rng(width)
    ids = rng.integers(0, 1 << width, 70_001, dtype=np.uint64).astype(np.uint32)
    data = packed.pack(ids, width)
    assert len(data) == (len(ids) * width + 7) // 8
    for start, count in ((0, len(ids)), (1, 1), (777, 300), (len(ids), 0), (len(ids) - 1, 1)):
        assert (packed.unpack(data, width, start, count) == ids[start:start + count]).all()
    assert packed.width_of(49_408) == 16 and packed.width_of(1) == 1
    if width < 32:
        with pytest.raises(ValueError):
            packed.pack([1 << width], width)


def test_rank_files_are_read(tmp_path):
    (tmp_path / "r").write_bytes(base64.b64encode(b"ab") + b" 5\n\n")
    assert bpe.read_ranks(tmp_path / "r") == {b"ab": 5}


def test_words_of_latin_texts_are_those_of_the_library():
    import tokenizers

    path = P.path("word_bpe_49k.json")
    library, encoder = tokenizers.Tokenizer.from_file(path), packed.WordEncoder(path)
    rng = random.Random(9)
    texts = ["".join(rng.choice("aStTrelvdDmM''''\"-12² \t\n\x85\xa0éÉß½ªµ\x1c\x7f") for _ in range(rng.randint(0, 25))) for _ in range(3000)]
    flat, n = encoder.ids(texts, 2)
    ends = np.cumsum(n)
    for text, k, e in zip(texts, n, ends):
        assert flat[e - k:e].tolist() == library.encode(text, add_special_tokens=False).ids + [2], repr(text)


def test_bpe_runs_without_a_database_in_the_task():
    """Encoding and decoding merge in the task itself: no DuckDB database is opened next to the Python worker."""
    import subprocess
    import sys

    code = """
import sys, numpy as np, pyarrow as pa, public_tokenizers as P
from gridloom.llm import bpe
path = P.path("byte_bpe_multi_50k.tiktoken")
enc = bpe.Encoder(bpe.read_ranks(path), P.PATTERN)
flat, n = enc.pieces(["Hello world, " * 50, "", "ab" * 300])
assert n.tolist()[1] == 0 and flat.size == n.sum()
assert "duckdb" not in sys.modules
"""
    root = __file__.rsplit("/tests/", 1)[0]
    assert subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True).returncode == 0


def test_long_words_merge_as_the_library():
    ranks = bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken_encoding("byte_bpe_multi_50k.tiktoken")
    encoder = bpe.Encoder(ranks, P.PATTERN)
    words = [bytes(range(256)) * 3, ("ab" * 40 + "c").encode(), " ".encode() * 65, "日本語のテキスト".encode() * 9, b"x" * 65]
    for w in words:
        assert encoder.word(w) == library._encode_single_piece(w)
