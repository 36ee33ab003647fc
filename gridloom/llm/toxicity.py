"""Toxic passages as maximum-scoring segments.

Learning: log-odds of words between toxic and other labelled rows, with an informative Dirichlet prior and shrunk by their standard
error; words with log-odds left get them as score, all others a small negative score. Scoring: one linear scan finds every
maximal scoring segment of a text. A segment's score is turned into the expected number of such segments in a clean text of
that length (extreme-value law); the evidence of all segments is added up and calibrated to a chance of label 1.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from gridloom.llm.common import read, slices, texts, written
from gridloom.llm.words import NO_WORD, Words, mix, shingle_sets


@dataclass
class Model:
    """Scores of the known words (sorted by value), score of all others, extreme-value law and calibration."""

    values: np.ndarray
    scores: np.ndarray
    other: float
    rate: float
    factor: float
    slope: float
    base: float

    def word_scores(self, values):
        if not len(self.values):
            return np.full(len(values), self.other)
        at = np.minimum(np.searchsorted(self.values, values), len(self.values) - 1)
        return np.where(self.values[at] == values, self.scores[at], self.other)

    def evidence(self, segments, n):
        """Sum over segments of -ln(expected number of segments as good among n clean words), where above zero."""
        return sum(max(0.0, self.rate * s - np.log(self.factor * max(n, 1))) for _, _, s in segments)

    def chance(self, evidence):
        return 1 / (1 + np.exp(-(self.base + self.slope * np.log1p(np.asarray(evidence)))))


def segments(scores):
    """All maximal scoring segments (start, end, score), in order.

    One pass over the positive scores; what lies between two of them counts by its sum. A segment is
    never extended if that would lower its score, and segments do not overlap.
    """
    at = np.flatnonzero(scores > 0)
    total = np.concatenate([[0.0], np.cumsum(scores)])
    kept = []  # start, end, sum before start, sum at end, and the last earlier one with a smaller sum before it
    for i in at.tolist():
        start, end, left, right = i, i + 1, total[i], total[i + 1]
        while True:
            j = len(kept) - 1
            while j >= 0 and kept[j][2] >= left:
                j = kept[j][4]
            if j < 0 or kept[j][3] >= right:
                kept.append((start, end, left, right, j))
                break
            start, left = kept[j][0], kept[j][2]
            del kept[j:]
    return [(s, e, r - l) for s, e, l, r, _ in kept]


def law(scores, weights):
    """Rate and factor of the extreme-value law for segment scores of words drawn with the given weights.

    The rate solves E[exp(rate * score)] = 1, the factor is the chance that a word starts a segment.
    """
    weights = weights / weights.sum()
    if not (scores > 0).any():
        return 1.0, 1.0
    low, high = 1e-9, 1.0
    while (weights * np.exp(high * scores)).sum() < 1 and high < 64:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if (weights * np.exp(mid * scores)).sum() < 1 else (low, mid)
    return low, max(weights[scores > 0].sum(), 1e-12)


def is_held_out(column):
    """Rows that only judge: crc32 of the id as text, modulo 4, is 2."""
    return F.crc32(column.cast("string").cast("binary")) % 4 == 2


def learn(docs, labels, id_col="doc_id", text_col="text", label_col="toxic", sample_rows=20_000, strength=0.1,
          other=-0.2, most_words=4_000_000):
    """The model, from at most about sample_rows labelled rows that are not held out.

    The sample is drawn by a hash of the id, so it is the same in every run. Of rows that are near copies of each other
    (a common smallest value in one of four hashes of word runs) one counts. Three quarters of the rows give word counts, the others the
    calibration. strength: weight of the prior against the rows. No word is left out for being rare: its log-odds less their standard
    error is its score, and what many weak words are worth is up to the extreme-value law and the calibration. A model of more
    than most_words words is refused, never cut; the words of sample_rows rows are far fewer, unless the rows are very long. Rows with a null id or label are left out; a
    repeated labelled id counts as toxic if any of its rows is. Without any labelled row every text gets 0.5; with one class only,
    that class's share.
    """
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("toxic")).dropna()
    known = known.filter(~is_held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    source = source.join(F.broadcast(sample), "doc_id")

    def prepare(batches):
        for part in slices(batches):
            words = Words(texts(part), NO_WORD, lower=True)
            sketch, own = [], []
            for runs, a, n in zip(shingle_sets(words), words.first, words.counts):
                sketch.append([int((mix(runs ^ np.uint64(k)) >> np.uint64(1)).min(initial=(1 << 63) - 1)) for k in range(4)] if len(runs) else [])
                own.append(words.values[a:a + n].view(np.int64))
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), part.column("toxic"), pa.array(sketch, pa.list_(pa.int64())),
                pa.array(own, pa.list_(pa.int64()))], ["doc_id", "toxic", "sketch", "words"])

    rows = written(source.mapInArrow(prepare, "doc_id long, toxic int, sketch array<long>, words array<long>"), "toxicity")
    posted = rows.select("doc_id", F.posexplode("sketch").alias("k", "v"))
    later = posted.join(posted.groupBy("k", "v").agg(F.min("doc_id").alias("first")), ["k", "v"]).filter("doc_id > first").select("doc_id").distinct()
    rows = rows.join(later, "doc_id", "left_anti")
    fit, judge = F.pmod(F.xxhash64("doc_id"), F.lit(4)) != 0, F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    n = rows.filter(fit).agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("t")).first()
    n_toxic, n_clean = n.t, n.n - n.t
    counts = (
        rows.filter(fit).select("toxic", F.explode(F.array_distinct("words")).alias("w"))
        .groupBy("w").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
    )
    # documents that hold a word, with the prior strength * (rows that hold it) added to either class
    prior = strength * (F.col("t") + F.col("c"))
    t, c = F.col("t") + prior, F.col("c") + prior
    add = strength * n.n
    odds = F.log(t / (n_toxic + add * 2 - t)) - F.log(c / (n_clean + add * 2 - c))
    shrunk = F.signum(odds) * F.greatest(F.abs(odds) - F.sqrt(1 / t + 1 / c), F.lit(0.0))
    scored = counts.select("w", "t", "c", shrunk.alias("score"))
    chosen = scored.filter("score != 0") if n_toxic and n_clean else scored.limit(0)
    table = chosen.limit(most_words + 1).toPandas().sort_values("w", ignore_index=True)
    if len(table) > most_words:
        raise ValueError(f"more than {most_words} words tell toxic rows from others; raise most_words or learn from fewer sample_rows")
    values, scores = table["w"].to_numpy(np.int64).view(np.uint64), table["score"].to_numpy(float)
    order = np.argsort(values)
    model = Model(values[order], scores[order], other, 1.0, 1.0, 0.0, 0.0)
    clean = (table["c"].to_numpy(float) + strength * (table["t"] + table["c"]).to_numpy(float)) / max(1.0, n_clean)
    per_text = rows.filter(fit & (F.col("toxic") == 0)).agg(F.avg(F.size("words")).alias("m")).first().m or 1.0
    weights = np.append(clean, max(per_text - clean.sum(), 1.0))
    model.rate, model.factor = law(np.append(scores, other), weights)
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    def weigh(batches):
        m = Model(**shared.value)
        for batch in batches:
            rows = batch.column("words").to_pylist()
            found = [np.asarray(r or [], np.int64).view(np.uint64) for r in rows]
            e = [m.evidence(segments(m.word_scores(v)), len(v)) for v in found]
            yield pa.RecordBatch.from_arrays([pa.array(e, pa.float64()), batch.column("toxic")], ["evidence", "toxic"])

    judged = rows.filter(judge).select("words", "toxic").mapInArrow(weigh, "evidence double, toxic int").toPandas()
    model.slope, model.base = calibrate(judged["evidence"].to_numpy(float), judged["toxic"].to_numpy(float))
    return model


def calibrate(evidence, toxic):
    """Slope and base of a logistic curve over ln(1 + evidence), by Newton steps; the slope is never negative."""
    x = np.stack([np.log1p(evidence), np.ones(len(evidence))], 1)
    # half a row of either label at either end keeps the curve finite
    far = max(1.0, x[:, 0].max(initial=0.0))
    x = np.concatenate([x, [[0, 1], [0, 1], [far, 1], [far, 1]]])
    y, weight = np.append(toxic, [0, 1, 0, 1]), np.append(np.ones(len(toxic)), [0.25] * 4)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (weight * (y - p)) - 1e-6 * w)
        w = w + np.clip(step, -2, 2)
    return max(0.0, float(w[0])), float(w[1])


def score(docs, model, id_col="doc_id", text_col="text", threshold=0.3, keep=False):
    """held_out, score, predicted and the significant passages of every row; null and empty texts count as clean text.

    passages: (first word, word behind the last, score) of each segment expected less than once in a clean text of that
    length. Repeated rows are scored each. keep=True returns only the rows with predicted = 0, with the columns of docs instead.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    def verdicts(part):
        m, words = Model(**shared.value), Words(texts(part, text_col), NO_WORD, lower=True)
        scores = m.word_scores(words.values)
        found = [segments(scores[a:a + n]) for a, n in zip(words.first, words.counts)]
        e = np.array([m.evidence(f, n) for f, n in zip(found, words.counts)])
        real = [[f for f in fs if m.rate * f[2] > np.log(m.factor * max(n, 1))] for fs, n in zip(found, words.counts)]
        return m.chance(e), real

    if keep:
        def clean(batches):
            for part in slices(batches, text_col):
                yield part.filter(pa.array(verdicts(part)[0] < threshold))

        return docs.mapInArrow(clean, docs.schema)

    def run(batches):
        for part in slices(batches, text_col):
            chance, real = verdicts(part)
            spans = pa.array(
                [[{"first": a, "end": b, "score": s} for a, b, s in r] for r in real],
                pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])))
            yield pa.RecordBatch.from_arrays(
                [part.column(id_col), pa.array(chance), pa.array((chance >= threshold).astype(np.int32)), spans],
                ["doc_id", "score", "predicted", "passages"])

    source = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias(text_col))
    out = source.mapInArrow(
        run, "doc_id long, score double, predicted int, passages array<struct<first:long,end:long,score:double>>")
    held = F.coalesce(is_held_out(F.col("doc_id")), F.lit(False)).alias("held_out")
    return out.select(F.col("doc_id").alias(id_col), held, "score", "predicted", "passages")


def op5(spark, sf_dir):
    """Toxicity of all documents by a model learned from the labels that are not held out."""
    docs = read(spark, sf_dir, "documents")
    return score(docs, learn(docs, read(spark, sf_dir, "labels")))
