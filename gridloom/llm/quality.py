"""Quality rules by weak supervision, in SQL expressions only.

Every rule reads a few counts of a text and votes good (1), bad (-1) or abstains (0). No rule decides alone: expectation
maximisation over all texts estimates how often each rule is right on good and on bad texts and how many texts are good, without
labels, and a text is kept if its posterior probability of being good is high enough.

1. Counts and votes of every text are made in one pass over the texts and written as a narrow table; no text is shuffled.
2. Texts with equal votes are one pattern. There are at most 3 ** len(RULES) patterns whatever the number of texts, so a step of
   the estimation reads that table only and brings back two sums for each rule and vote.
3. The posterior is an expression of a text's own votes with the estimated figures as constants; nothing is joined.
"""

import math

from pyspark.sql import functions as F

from gridloom.llm.common import read, written

#: Name, (bad if), (good if) of each rule over the counts; a condition that is null counts as false, and bad goes first.
RULES = [
    ("length", "n_words < 20", "n_words >= 50"),
    ("word_length", "word_chars < 3 * n_words OR word_chars > 10 * n_words", "word_chars BETWEEN 4 * n_words AND 7 * n_words"),
    ("symbols", "10 * n_symbols > n_words", "n_symbols = 0"),
    ("lettered_words", "10 * n_lettered < 8 * n_words", "10 * n_lettered > 9 * n_words"),
    ("letters", "10 * n_letters < 8 * word_chars", "10 * n_letters > 9 * word_chars"),
    ("repeated_lines", "10 * n_dup_lines > 3 * n_lines", "n_dup_lines = 0 AND n_lines > 1"),
    ("repeated_words", "10 * n_repeat_words > 2 * n_words", "n_repeat_words = 0 AND n_words >= 50"),
    ("closed_lines", "2 * n_closed < n_lines", "10 * n_closed > 9 * n_lines"),
    ("distinct_words", "10 * n_distinct < 3 * n_words AND n_words <= 2000", "2 * n_distinct > n_words"),
]
NAMES = [name for name, _, _ in RULES]

#: Bounds of a rule's accuracy on good and on bad texts. A rule seldom votes against a good text, but every kind of bad
#: text trips only some of them; without the bounds one common kind of bad text becomes the bad class and all others good.
GOOD_BOUNDS = (0.98, 0.999)
BAD_BOUNDS = (0.3, 0.95)
#: First values and steps of the estimation.
START = {"good": 0.8, "on_good": 0.98, "on_bad": 0.5}
STEPS = 30
STILL = 1e-6
#: Votes that each estimate starts from, so that a rule that never votes keeps a defined accuracy.
PRIOR_RIGHT, PRIOR_VOTES = 8, 10

WHITE = "\t\n\x0b\x0c\r "
WINDOW = 8


def let(value, use):
    """use(value) with the value computed once, also when `use` names it inside a lambda."""
    return F.element_at(F.transform(F.array(value), use), 1)


def solid(text):
    """The text without ASCII white space."""
    return F.translate(text, WHITE, "")


def words(text):
    """Runs without ASCII white space."""
    return F.filter(F.split(F.translate(text, WHITE[:-1], " " * (len(WHITE) - 1)), " "), lambda w: w != "")


def repeated(hashes, length=WINDOW):
    """Number of words that lie in a window of `length` words which occurs twice or more in the text; hashes: a lambda's variable."""
    n = F.size(hashes)

    def covered(places):
        gaps = F.transform(places, lambda p, j: F.least(F.coalesce(F.get(places, j + 1) - p, F.lit(length)), F.lit(length)))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda total, x: total + x)

    def found(windows):
        def doubles(ordered):
            again = F.filter(ordered, lambda x, j: F.coalesce(x["h"] == F.get(ordered, j - 1)["h"], F.lit(False))
                             | F.coalesce(x["h"] == F.get(ordered, j + 1)["h"], F.lit(False)))
            return let(F.sort_array(F.transform(again, lambda x: x["at"])), covered)

        ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(let(ordered, doubles))

    whole = F.slice(hashes, 1, n - (length - 1))
    windows = F.transform(whole, lambda h, i: F.xxhash64(h, *[F.get(hashes, i + j) for j in range(1, length)]))
    return F.when(n > length, let(windows, found)).otherwise(F.lit(0).cast("long"))


def counts(docs, text_col="text"):
    """The rows with the counts that the rules read: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (named as in op11),
    n_lines (lines with a word), n_closed (of those, lines that end with . ! or ?), n_lettered (words with a letter), n_letters, n_distinct."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))

    def of_lines(lines):
        closed = F.filter(lines, lambda s: F.substring(F.rtrim(s, F.lit(WHITE)), -1, 1).isin(".", "!", "?"))
        return F.struct(
            F.size(lines).cast("long").alias("n_lines"), F.size(closed).cast("long").alias("n_closed"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"))

    def of_hashes(hashes):
        return F.struct(
            F.size(hashes).cast("long").alias("n_words"), F.size(F.array_distinct(hashes)).cast("long").alias("n_distinct"),
            repeated(hashes).alias("n_repeat_words"))

    lines = F.filter(F.split(text, "\n"), lambda s: solid(s) != "")
    made = docs.select(
        "*", F.length(solid(text)).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        F.regexp_count(text, F.lit(r"\p{L}[^\x20\x09-\x0D]*")).cast("long").alias("n_lettered"),
        F.length(F.regexp_replace(text, r"[^\p{L}]+", "")).cast("long").alias("n_letters"),
        let(lines, of_lines).alias("_lines"), let(F.transform(words(text), lambda w: F.xxhash64(w)), of_hashes).alias("_words"))
    return made.select(*docs.columns, "_lines.*", "_words.*", "word_chars", "n_symbols", "n_lettered", "n_letters")


def votes(counted):
    """Adds one column a rule, v_<name>: 1, -1 or 0."""
    for name, bad, good in RULES:
        counted = counted.withColumn(f"v_{name}", F.when(F.expr(bad), -1).when(F.expr(good), 1).otherwise(0).cast("tinyint"))
    return counted


def posterior(figures):
    """Probability of being good as an expression of a row's votes. figures: good, and on_good and on_bad by rule.

    The figures are array constants, not numbers, so that every step of the estimation runs the same compiled code.
    """
    up = F.lit([math.log(g) - math.log1p(-b) for g, b in zip(figures["on_good"], figures["on_bad"])])
    down = F.lit([math.log1p(-g) - math.log(b) for g, b in zip(figures["on_good"], figures["on_bad"])])
    odds = F.get(F.lit([math.log(figures["good"]) - math.log1p(-figures["good"])]), F.lit(0))
    for i, name in enumerate(NAMES):
        vote = F.col(f"v_{name}")
        odds = odds + F.when(vote == 1, F.get(up, F.lit(i))).when(vote == -1, F.get(down, F.lit(i))).otherwise(0.0)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))


def clipped(x, bounds):
    return min(max(x, bounds[0]), bounds[1])


def estimate(patterns, steps=STEPS):
    """Figures of expectation maximisation over a table of vote columns with their number n of texts: after `steps` rounds, or when a
    round moves none by more than STILL. Without texts the first values stay."""
    k = len(NAMES)
    figures = {"good": START["good"], "on_good": [START["on_good"]] * k, "on_bad": [START["on_bad"]] * k}
    given = F.array(*[F.col(f"v_{name}") for name in NAMES])
    for _ in range(steps):
        shares = patterns.select("n", posterior(figures).alias("p"), F.posexplode(given).alias("rule", "vote"))
        sums = shares.groupBy("rule", "vote").agg(F.sum(F.col("n") * F.col("p")).alias("good"), F.sum(F.col("n") * (1 - F.col("p"))).alias("bad"))
        found = {(r.rule, r.vote): (r.good, r.bad) for r in sums.collect()}
        if not found:
            return figures
        good, bad = (sum(found.get((0, v), (0, 0))[side] for v in (-1, 0, 1)) for side in (0, 1))

        def accuracy(i, side, right):
            hits, misses = (found.get((i, v), (0.0, 0.0))[side] for v in (right, -right))
            return (hits + PRIOR_RIGHT) / (hits + misses + PRIOR_VOTES)

        before, figures = figures, {
            "good": clipped(good / (good + bad), (0.01, 0.99)),
            "on_good": [clipped(accuracy(i, 0, 1), GOOD_BOUNDS) for i in range(k)],
            "on_bad": [clipped(accuracy(i, 1, -1), BAD_BOUNDS) for i in range(k)]}
        if max(abs(x - y) for x, y in zip(_flat(before), _flat(figures))) < STILL:
            break
    return figures


def _flat(figures):
    return [figures["good"], *figures["on_good"], *figures["on_bad"]]


def judge(docs, text_col="text", least=0.5, steps=STEPS):
    """The rows without the text, with counts, votes, base_failed, quality (the posterior) and kept.

    Null and empty texts and texts of white space have no words: they fail the base rules and take no part in the estimation. Repeated
    rows count as often as they occur. A row of the input is a row of the result, whatever its other columns hold; input columns that are
    named like a count, a vote or one of the result's are left out. An empty table gives no rows.
    """
    own = {name for name, *_ in counts(docs.sparkSession.createDataFrame([], "text string")).dtypes} | {f"v_{n}" for n in NAMES}
    others = [c for c in docs.columns if c != text_col and c not in own | {"base_failed", "quality", "kept"}]
    rows = docs.select(*others, F.col(text_col).alias("text"))
    voted = written(votes(counts(rows)).drop("text"), "votes")
    named = [f"v_{name}" for name in NAMES]
    patterns = written(voted.filter("n_words > 0").groupBy(*named).agg(F.count("*").alias("n")), "patterns")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    quality = posterior(estimate(patterns, steps))
    return voted.select("*", failed.alias("base_failed"), F.when(F.col("n_words") > 0, quality).otherwise(0.0).alias("quality")).withColumn(
        "kept", ~F.col("base_failed") & (F.col("quality") >= least))


def op11(spark, sf_dir):
    """Base counts and the verdict of weak supervision for all documents."""
    judged = judge(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _sql():
    """The same counts, votes and steps as DuckDB SQL."""
    k = len(NAMES)
    vote = ", ".join(f"CASE WHEN {bad} THEN -1 WHEN {good} THEN 1 ELSE 0 END" for _, bad, good in RULES)
    odds = " + ".join(
        f"CASE v[{i}] WHEN 1 THEN ln(g[{i}]) - ln(1 - b[{i}]) WHEN -1 THEN ln(1 - g[{i}]) - ln(b[{i}]) ELSE 0 END" for i in range(1, k + 1))

    def accuracy(right, weight, bounds):
        return "[" + ", ".join(
            f"least(greatest((sum(CASE WHEN v[{i}] = {right} THEN {weight} ELSE 0 END) + {PRIOR_RIGHT}) / "
            f"(sum(CASE WHEN v[{i}] <> 0 THEN {weight} ELSE 0 END) + {PRIOR_VOTES}), {bounds[0]}::DOUBLE), {bounds[1]}::DOUBLE)"
            for i in range(1, k + 1)) + "]"

    first = f"list_transform(range({k}), lambda i: {START['on_good']}::DOUBLE), list_transform(range({k}), lambda i: {START['on_bad']}::DOUBLE)"
    p = f"1 / (1 + exp(-(ln(p) - ln(1 - p) + {odds})))"
    return rf"""WITH RECURSIVE src AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
parts AS (
  SELECT r, doc_id, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w,
         list_filter(string_split(t, chr(10)), lambda s: regexp_matches(s, '[^\x20\x09-\x0D]')) AS lines FROM src),
win AS (SELECT r, i, array_to_string(w[i:i + 7], ' ') AS h FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM parts)),
twice AS (SELECT r, i FROM win QUALIFY count(*) OVER (PARTITION BY r, h) > 1),
again AS (SELECT r, count(DISTINCT i + o.range) AS n FROM twice, range(8) o GROUP BY r),
cnt AS (
  SELECT r, doc_id, len(w)::BIGINT AS n_words, len(array_to_string(w, ''))::BIGINT AS word_chars,
         len(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words, len(lines) AS n_lines,
         len(list_filter(lines, lambda s: regexp_matches(s, '[.!?][\x20\x09-\x0D]*$'))) AS n_closed,
         len(list_filter(w, lambda x: regexp_matches(x, '\p{{L}}'))) AS n_lettered, len(regexp_replace(t, '[^\p{{L}}]+', '', 'g')) AS n_letters,
         len(list_distinct(w)) AS n_distinct
  FROM parts LEFT JOIN again USING (r)),
voted AS (SELECT *, [{vote}] AS v FROM cnt),
pat AS (SELECT v, count(*)::DOUBLE AS n FROM voted WHERE n_words > 0 GROUP BY v),
em AS (
  SELECT 0 AS step, {START['good']}::DOUBLE AS p, {first.replace('), list', ') AS g, list')} AS b
  UNION ALL
  SELECT step + 1, least(greatest(sum(n * q) / sum(n), 0.01::DOUBLE), 0.99::DOUBLE), {accuracy(1, 'n * q', GOOD_BOUNDS)}, {accuracy(-1, 'n * (1 - q)', BAD_BOUNDS)}
  FROM (SELECT step, v, n, {p} AS q FROM em, pat WHERE step < {STEPS}) GROUP BY step),
fin AS (SELECT * FROM em ORDER BY step DESC LIMIT 1)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND n_words > 0 AND {p} >= 0.5 AS kept
FROM voted, fin"""


OP11_SQL = _sql()
