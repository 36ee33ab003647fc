"""Stages of the pipeline one by one on odd tables, and its end result against plain versions of the stages."""

import random
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))

import brute  # noqa: E402

import corpus_pipeline  # noqa: E402

STAGES = dict(corpus_pipeline.STAGES)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def corpus():
    """Documents with exact and near copies, a passage that several share, benchmark text, toxic ones, nulls and repeated rows; labels; items."""
    rng = random.Random(11)
    word = lambda: "w%d" % rng.randrange(3000)
    text = lambda n: [word() for _ in range(n)]
    shared, items = text(70), [(i, " ".join(text(25))) for i in range(6)]
    out = [text(rng.randint(60, 120)) for _ in range(60)]
    out += [list(out[0]) for _ in range(4)]
    for i in range(1, 6):
        near = list(out[i])
        near[30] = "changed"
        out.append(near)
    out += [text(80) + shared + text(40) for _ in range(5)]
    out += [text(50) + t.split() + text(50) for _, t in items[:3]]
    toxic = [text(30) + ["vile", "scum", "hateful"] * 6 + text(30) for _ in range(25)]
    rows = [(i, " ".join(w)) for i, w in enumerate(out + toxic)]
    labels = [(i, int(i >= len(out))) for i, _ in rows]
    odd = [(None, None), (500, None), (501, ""), (502, " \t"), (503, "one"), (3, " ".join(out[3]))]
    return [(i, t, "en", None, len(t or "")) for i, t in rows + odd], labels, items


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rows, labels, items = corpus()
    folder = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, SCHEMA).repartition(5).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, labels, items


def texts(rows):
    """Ids and texts in an order that nulls do not disturb."""
    return sorted(((r[0], r[1]) for r in rows), key=repr)


def without(rows, gone):
    return [r for r in rows if r[0] not in gone]


def expected(rows, toxic, items):
    """The rows that are left before the last stage, with their texts; toxic: the ids that the first stage rejects."""
    rows = without(rows, toxic)
    known = dict(r for r in ((i, t) for i, t, *_ in rows) if r[0] is not None)
    rows = without(rows, {i for i, _, _, kept in brute.near_duplicates(list(known.items())) if not kept})
    cut = {i: (gone, sha) for i, _, gone, sha in brute.repeats([(i, t) for i, t in known.items() if i in {r[0] for r in rows}])}
    rows = [(i, cut[i][1] if i is not None and cut[i][0] else t) for i, t, *_ in rows]
    bad = {i for i, *_, hit in brute.contamination([r for r in rows if r[0] is not None], items) if hit}
    return texts(without(rows, bad))


def test_end_result_equals_plain_stages(spark, tables):
    import public_tokenizers
    import tiktoken

    folder, rows, labels, items = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = STAGES["toxicity"](spark, docs, folder)
    assert kept.columns == COLUMNS
    toxic = {r[0] for r in rows} - {r.doc_id for r in kept.collect()}
    assert toxic == {i for i, label in labels if label}
    want = expected(rows, toxic, items)
    assert 40 < len(want) < len(rows) - len(toxic)

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    from gridloom.llm import bpe
    library = tiktoken.Encoding("multi", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    got = corpus_pipeline.run(spark, folder).select("doc_id", "ids", "n_tokens", "decoded_sha256").collect()
    ids = [(i, library.encode_ordinary(t or "")) for i, t in want]
    assert sorted([tuple(r) for r in got], key=repr) == sorted(
        [(i, x, len(x), brute.sha((t or "").encode())) for (i, t), (_, x) in zip(want, ids)], key=repr)


@pytest.mark.parametrize("name", [n for n in STAGES if n != "byte-level BPE"])
def test_stages_keep_columns_repeated_rows_and_odd_texts(spark, tables, name):
    """Null ids, null and empty texts stay, rows with one id stay together, and columns named like a stage's own come through."""
    folder, rows, _, _ = tables
    extra = ["kept", "row", "score", "ids", "n_hit", "rep", "root", "window", "g"]
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("*", *[F.lit(c).alias(c) for c in extra])
    got = STAGES[name](spark, docs, folder)
    assert got.columns == COLUMNS + extra
    found = got.collect()
    for row in found:
        assert [row[c] for c in extra] == extra and row.lang == "en" and row.source is None
        assert row.n_chars == len(row.text or "")
    assert {(r.doc_id, r.text) for r in found} >= {(None, None), (500, None), (501, ""), (502, " \t"), (503, "one")}
    assert sum(r.doc_id == 3 for r in found) in (0, 2)


@pytest.mark.parametrize("name", list(STAGES))
def test_stages_of_an_empty_table(spark, tables, name):
    folder = tables[0]
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    got = STAGES[name](spark, docs, folder)
    assert got.collect() == [] and (name == "byte-level BPE" or got.columns == COLUMNS)
