"""Near duplicates, repeated passages, contamination and fingerprints against plain versions."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))

import brute  # noqa: E402

from gridloom.llm import contamination, fingerprints, near_dup, substrings  # noqa: E402
from gridloom.llm.words import Words, combine  # noqa: E402

ODD = [(900, None), (901, ""), (902, " \t\n"), (903, "one"), (904, "One"), (905, "one two three"), (906, "ONE two\tthree"), (907, "x" * 5000), (908, "é ü " * 30)]


def passages(seed=1):
    """Documents with copies, near copies, a passage that many share, a chain of overlapping ones and short ones."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 5)))
    text = lambda n: [word() for _ in range(n)]
    shared, base, out = text(70), text(120), []
    for _ in range(40):
        out.append(text(rng.randint(0, 90)) + (shared if rng.random() < 0.5 else []) + text(rng.randint(1, 90)))
    for _ in range(60):
        near = list(base)
        for _ in range(rng.randint(0, 3)):
            near[rng.randrange(len(near))] = word()
        out.append(near)
    long = text(1000)
    out += [long[i:i + 100] for i in range(0, 900, 5)]
    out += [list(rng.choice(out)) for _ in range(40)]
    out += [text(rng.randint(1, 4)) for _ in range(5)] + [["same"] * 130, ["same"] * 131, ["a", "b"] * 80]
    rng.shuffle(out)
    return [(i, rng.choice([" ", "\n"]).join(w)) for i, w in enumerate(out)] + ODD


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", [2], 0) for i, t in rows], "doc_id long, text string, n int, rep string, sig array<int>, root int")


def test_near_duplicates_equal_brute_force(spark):
    docs = passages()
    got = near_dup.near_duplicates(frame(spark, docs)).collect()
    assert sorted(map(tuple, got)) == brute.near_duplicates(docs)


def test_near_duplicates_of_repeated_rows_null_ids_and_nothing(spark):
    words = " ".join(map(str, range(60)))
    rows = [(5, words), (5, words), (7, words), (None, words), (3, "other text")]
    got = sorted(map(tuple, near_dup.near_duplicates(frame(spark, rows)).collect()), key=str)
    assert got == sorted([(5, 56, 5, True), (5, 56, 5, True), (7, 56, 5, False), (None, 56, None, True), (3, 1, 3, True)], key=str)
    assert near_dup.near_duplicates(frame(spark, rows).limit(0)).collect() == []


def joined(roots, links):
    """For each class the smallest class that its component and the links reach."""
    top = {}

    def find(x):
        while top.get(x, x) != x:
            x = top[x]
        return x

    for x, y in [(("r", int(r)), i) for i, r in enumerate(roots)] + [tuple(p) for p in links]:
        top[find(x)] = find(y)
    first = {}
    for i in range(len(roots)):
        first.setdefault(find(i), i)
    return [first[find(i)] for i in range(len(roots))]


def test_lists_are_compared_across_components_in_blocks(spark):
    """All that true links join is joined, by true links only and by fewer of them than a block has rows, whatever the number of blocks."""
    rng, n = np.random.default_rng(5), 3 * near_dup.BLOCK // 2
    base = rng.choice(10_000, 40, replace=False)
    sets = [np.unique(np.where(rng.random(40) < rng.choice([0.03, 0.12, 0.2]), rng.integers(10_000, 10**6, 40), base)).astype(np.uint64) for _ in range(n)]
    wide = np.zeros((n, 8), np.uint16)
    wide[rng.random((n, 8)) < 0.1] = 1
    root = np.where(rng.random(n) < 0.2, 0, np.arange(n) // 2)
    rows = [(t, i, int(root[i]), wide[i].tobytes(), [1, 3] if i % 3 else [1], sets[i].tobytes()) for i in range(n) for t in ([1, 3] if i % 3 else [1])]
    rows += [(2, 1000 + i, 0, wide[0].tobytes(), [2], sets[0].tobytes()) for i in range(5)]
    lists = spark.createDataFrame(rows, "token long, rep long, root long, wide binary, mine array<long>, runs binary")
    classes = lists.select("rep", "wide", "runs", "mine").distinct()
    got = [tuple(r) for r in near_dup.across(lists.select("token", "rep", "root"), classes, 6, 75).collect()]

    def alike(i, j):
        both = len(np.intersect1d(sets[i], sets[j]))
        return 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both) and (wide[i] == wide[j]).sum() >= 6

    want = [(i, j) for i in range(n) for j in range(i + 1, n) if root[i] != root[j] and alike(i, j)]
    assert got and all(i < j and root[i] != root[j] and alike(i, j) for i, j in got)
    assert joined(root, got) == joined(root, want) and len(got) < 3 * n < len(want)


def test_components_are_the_smallest_reachable(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(7, 100), (300, 301), (301, 300)]
    got = {r.vertex: r.root for r in near_dup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {v: 0 for v in [*range(1, 41), *range(100, 160)]} | {301: 300}
    assert {v: r for v, r in got.items() if v != r} == want


@pytest.mark.parametrize("group", [4096, 7])
def test_repeats_equal_brute_force(spark, group):
    docs = passages(2)
    got = substrings.remove_repeats(frame(spark, docs), group=group).collect()
    assert sorted(map(tuple, got)) == brute.repeats(docs)


def test_repeats_with_short_windows_and_odd_rows(spark):
    rng = random.Random(4)
    docs = [(i, " ".join(rng.choice("abc") for _ in range(rng.randint(0, 40)))) for i in range(150)]
    got = substrings.remove_repeats(frame(spark, docs), length=6, prefix=3, group=5).collect()
    assert sorted(map(tuple, got)) == brute.repeats(docs, 6)
    words = " ".join(map(str, range(80)))
    rows = [(5, words), (5, words), (7, words + " end"), (None, words), (None, None)]
    got = sorted(map(tuple, substrings.remove_repeats(frame(spark, rows)).collect()), key=str)
    assert got == sorted([(5, 80, 0, words), (5, 80, 0, words), (7, 81, 80, "end"), (None, 80, 0, words), (None, 0, 0, "")], key=str)
    assert substrings.remove_repeats(frame(spark, rows).limit(0)).collect() == []
    whole = substrings.without_repeats(frame(spark, rows))
    assert whole.columns == frame(spark, rows).columns
    assert sorted((r.doc_id, r.text) for r in whole.filter("doc_id IS NOT NULL").collect()) == [(5, words), (5, words), (7, "end")]


@pytest.mark.parametrize("group", [4096, 40, 3])
def test_a_long_text_that_repeats_one_phrase(spark, group):
    """Phrases repeated with equal and with changing words between them, held by other documents too; several rows of one id."""
    rng = random.Random(12)
    phrase, other = [f"p{i}" for i in range(14)], [f"q{i}" for i in range(60)]
    word = lambda: rng.choice("uvwxyz")
    changing = [x for _ in range(120) for x in (*phrase, *(word() for _ in range(rng.randint(0, 40))))]
    docs = [(1, other * 30), (2, changing), (3, changing[500:900] + other), (4, phrase * 60), (5, ["a", "b"] * 300), (6, ["b"] + ["a", "b"] * 40),
            (7, changing[:70] + phrase * 9 + other * 3), (8, changing[1000:1400] + ["end"]), (9, other[30:] + other[:30])]
    docs = [(i, " ".join(w)) for i, w in docs]
    got = substrings.remove_repeats(frame(spark, docs), group=group).collect()
    assert sorted(map(tuple, got)) == brute.repeats(docs)
    rows = [(2, docs[1][1]), (2, docs[1][1]), (2, docs[0][1]), (1, docs[6][1]), (3, docs[7][1])]
    got = sorted(map(tuple, substrings.remove_repeats(frame(spark, rows), group=group).collect()))
    assert got == brute.repeats(rows)


def test_contamination_equals_brute_force(spark, monkeypatch):
    docs = passages(3) + [(910, "the cat sat"), (911, "a b " * 30), (912, "cat the CAT. sat")]
    rng = random.Random(6)
    texts = [t for _, t in docs if t and len(t.split()) > 40]
    items = [(i, " ".join(rng.choice(texts).split()[3:3 + rng.randint(1, 30)])) for i in range(30)]
    items += [(40, "The CAT"), (41, "the cat"), (42, None), (43, ""), (44, "a b " * 9), (7, "sat"), (45, "é ü é ü")]
    names = "n_words n_hit n_items items_sha256 contaminated".split()
    want = brute.contamination(docs, [x for x in items if x[1]])
    bench = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, row int")
    found = contamination.decontaminate(frame(spark, docs), bench)
    assert sorted(tuple(r) for r in found.select("doc_id", *names).collect()) == want
    spare = {r.doc_id for r in contamination.clean(frame(spark, docs), bench).collect()}
    assert spare == {w[0] for w in want if not w[5]}
    assert len(contamination.blocks(bench, "item_id", "text", 13, most=150)) > 5
    assert len(contamination.blocks(bench.repartition(40), "item_id", "text", 13)) == 1
    monkeypatch.setattr(contamination, "BLOCK", 150)
    again = contamination.decontaminate(frame(spark, docs), bench)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, found.collect()))
    none = contamination.decontaminate(frame(spark, docs), bench.limit(0))
    assert none.agg(F.sum("n_hit")).first()[0] == 0


def test_longest_match_and_its_place(spark):
    words = [f"w{i}" for i in range(60)]
    docs = spark.createDataFrame([(1, "x y " + " ".join(words[5:45]) + " z"), (2, "nothing")], "doc_id long, text string")
    bench = spark.createDataFrame([(9, " ".join(words))], "item_id long, text string")
    got = {r.doc_id: (r.longest, r.longest_item, r.longest_at) for r in contamination.decontaminate(docs, bench).collect()}
    assert got == {1: (40, 9, 2), 2: (0, -1, -1)}


def test_fingerprints_are_alike_as_the_texts_are(spark):
    docs = passages(4)
    got = {r.doc_id: r for r in fingerprints.fingerprints(frame(spark, docs), parts=7).collect()}
    order = sorted((i, t or "") for i, t in docs)
    edited_error, next_error = [], []
    for k, (i, t) in enumerate(order):
        following, half = order[(k + 1) % len(order)][1], len(t) // 2
        edited = t[:len(t) - half] + following[:half]
        r = got[i]
        assert r.n_chars == len(t) and r.edited_sha256 == brute.sha(edited.encode())
        edited_error.append(r.near_edited - brute.jaccard(t, edited))
        next_error.append(r.near_next - brute.jaccard(t, following))
    assert abs(np.mean(edited_error)) < 0.03 and np.std(edited_error) < 0.12
    assert abs(np.mean(next_error)) < 0.03 and np.std(next_error) < 0.12
    by_text = {}
    for i, t in order:
        assert by_text.setdefault(t, got[i].fingerprint) == got[i].fingerprint


@pytest.mark.parametrize("near", [[], [(1 << 63) - k for k in range(1, 30)]])
def test_fingerprints_of_64_bit_ids_follow_the_next_document(spark, near):
    rng = random.Random(8)
    ids = [rng.randrange(-(1 << 62), 1 << 62) for _ in range(60)] + [(1 << 62) + k for k in range(1, 40)] + near
    docs = [(i, " ".join(rng.choice("abcdefgh") for _ in range(20))) for i in [*ids, None]]
    got = {r.doc_id: r for r in fingerprints.fingerprints(spark.createDataFrame(docs, "doc_id long, text string"), parts=7).collect()}
    order = sorted(docs, key=lambda d: (d[0] is not None, d[0]))
    assert len(got) == len(docs)
    for k, (i, t) in enumerate(order):
        half = len(t) // 2
        assert got[i].edited_sha256 == brute.sha((t[:len(t) - half] + order[(k + 1) % len(order)][1][:half]).encode())
        assert got[i].near_edited > 0


def test_fingerprints_of_few_rows(spark):
    one = fingerprints.fingerprints(spark.createDataFrame([(4, "a b c d")], "doc_id long, text string")).first()
    assert one.near_next == 1.0 and one.edited_sha256 == brute.sha(b"a b a b")
    rows = [(None, "x y"), (1, None), (1, "b c d"), (1, "b c d")]
    got = fingerprints.fingerprints(spark.createDataFrame(rows, "doc_id long, text string"), parts=3).collect()
    assert len(got) == 4 and [r.near_next for r in got if r.n_chars == 0] == [0.0]
    assert fingerprints.fingerprints(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_a_frequent_id_is_spread_over_ranges(spark):
    rows = [(None, f"text {i} of many") for i in range(400)] + [(i, f"other {i}") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = fingerprints.fingerprints(docs, parts=20)
    sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 10 and max(sizes) < 100
    got = found.collect()
    again = fingerprints.fingerprints(docs.repartition(3), parts=3).collect()
    assert len(got) == 500 and sorted(got, key=str) == sorted(again, key=str)


def test_equal_words_have_equal_values():
    w = Words(["a bb ccc", "", "ccc  bb", "x" * 3000 + " a"], most=16)
    assert w.counts.tolist() == [3, 0, 2, 2]
    assert w.values[2] == w.values[3] and w.values[1] == w.values[4] and w.values[0] == w.values[6]
    assert len(set(w.values.tolist())) == 4
    assert combine(w.values, 2)[0] != combine(w.values[::-1].copy(), 2)[0]
