"""Counts and votes against plain Python, and the estimation against a plain one."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gridloom.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    words = WORD.findall(text)
    lines = [s for s in text.split("\n") if WORD.search(s)]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    times, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered.update(range(i, i + 8))
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "n_lines": len(lines),
        "n_closed": sum(s.rstrip(" \t\n\x0b\x0c\r")[-1] in ".!?" for s in lines), "n_lettered": sum(any(c.isalpha() for c in w) for w in words),
        "n_letters": sum(c.isalpha() for c in text), "n_distinct": len(set(words)),
    }


TEXTS = [
    "", " \t\n", "one", "a b c d e f g h a b c d e f g h", "x " * 40, "a b c d e f g h i\n" * 3 + "end.", "# | $ <> 5% 12 é ß 語言 " * 7,
    "line one. \n\nline one. \nline two!\x0b\n line one. ", "p q r s t u v w x p q r s t u v w y q r s t u v w x",
    " ".join(f"w{i}" for i in range(30_000)) + " " + " ".join(f"w{i}" for i in range(9)), "\U0001F600\U0001F600   a",
]


def test_counts_equal_plain_python(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "id int, text string")
    for r in quality.counts(df).collect():
        want = plain_counts(TEXTS[r.id])
        assert {k: r[k] for k in want} == want, TEXTS[r.id][:60]


def plain_estimate(rows, steps):
    k = len(quality.NAMES)
    p, on_good, on_bad = quality.START["good"], [quality.START["on_good"]] * k, [quality.START["on_bad"]] * k
    for _ in range(steps):
        shares = []
        for v in rows:
            good, bad = p, 1 - p
            for i in range(k):
                good *= {1: on_good[i], -1: 1 - on_good[i], 0: 1}[v[i]]
                bad *= {-1: on_bad[i], 1: 1 - on_bad[i], 0: 1}[v[i]]
            shares.append(good / (good + bad))
        p = min(max(sum(shares) / len(rows), 0.01), 0.99)
        for i in range(k):
            voted = [(v[i], q) for v, q in zip(rows, shares) if v[i]]
            right = sum(q for x, q in voted if x == 1), sum(1 - q for x, q in voted if x == -1)
            every = sum(q for _, q in voted), sum(1 - q for _, q in voted)
            on_good[i], on_bad[i] = (
                min(max((r + quality.PRIOR_RIGHT) / (e + quality.PRIOR_VOTES), lo), hi)
                for r, e, (lo, hi) in zip(right, every, (quality.GOOD_BOUNDS, quality.BAD_BOUNDS)))
    return [p, *on_good, *on_bad]


def test_estimation_equals_a_plain_one_over_single_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    voted = quality.votes(quality.counts(docs)).filter("n_words > 0")
    named = [f"v_{n}" for n in quality.NAMES]
    rows = [tuple(r) for r in voted.select(*named).collect()]
    patterns = voted.groupBy(*named).agg(F.count("*").alias("n"))
    got = quality._flat(quality.estimate(patterns, 4))
    assert all(math.isclose(a, b, rel_tol=1e-9) for a, b in zip(got, plain_estimate(rows, 4)))


def test_labelled_rows_are_told_apart(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    got = {(r.quality, r.kept): r.n for r in quality.op11(spark, sf_dir).filter("n_words >= 20").join(labels, "doc_id")
           .groupBy("quality", "kept").agg(F.count("*").alias("n")).collect()}
    assert got[1, True] >= 0.97 * (got[1, True] + got.get((1, False), 0))
    assert got[0, False] >= 0.95 * (got[0, False] + got.get((0, True), 0))


def test_nulls_repeats_other_columns_and_empty_tables(spark):
    text = "Plain words make up this line of prose, and it ends with a stop.\n" * 1 + "Another line follows that says something else entirely, again closed.\n" * 1
    rows = [(None, None, 1, True), (1, text, 2, None), (1, text, 2, None), (None, text, 3, False), (2, "", None, None), (3, "$ $ $ " * 30, 5, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int, kept boolean")
    got = sorted(((r.doc_id, r.n_words, r.base_failed, r.kept) for r in quality.judge(docs).collect()), key=str)
    assert got == sorted([(None, 0, True, False), (1, 24, False, True), (1, 24, False, True), (None, 24, False, True), (2, 0, True, False), (3, 90, True, False)], key=str)
    assert quality.judge(docs.limit(0)).collect() == []
    assert quality.judge(docs.filter("text IS NULL")).first().kept is False


@pytest.mark.parametrize("n", [8, 9, 15, 16, 17])
def test_windows_at_the_edges(spark, n):
    text = " ".join(["w"] * n)
    assert quality.counts(spark.createDataFrame([(text,)], "text string")).first().n_repeat_words == (n if n > 8 else 0)
