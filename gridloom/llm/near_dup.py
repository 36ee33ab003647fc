"""Near-duplicate documents by an inverted join over MinHash coordinates, confirmed on full shingle sets.

1. Each text gets its set of word runs and a signature of `size` smallest values. Equal sets become one class.
2. Classes are posted under each coordinate's value. Two sets that are linked agree, but for a chance of some 1e-5, in
   `match` coordinates or more; so a class counts only values it shares, needs `match` of them, and is kept under
   its rarest ones only (the prefix): two classes with `match` common values meet in at least one.
3. Every posting list is first compared with its smallest class only. What that links is one component. In lists whose classes
   are not yet one component all classes are then compared across components, in blocks that hold the full sets; a pair is looked at in one
   of its common lists only. Inside a block a link joins two components at once, and what is in one component is not compared any more. A block
   returns the links that joined components, fewer than it has rows; pairs that are refused never leave it.
4. A pair is a candidate if its sets' sizes allow a link and it agrees in `wide_match` of `wide` coordinates, of which 16 bits are kept (linked
   sets fail that with a chance of some 1e-5), and a link if the full sets are similar enough.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from gridloom.llm.common import read, slices, texts, written
from gridloom.llm.words import SPACES, Words, mix, numbers, shingle_sets

#: Classes of a posting list that are at home in one block.
BLOCK = 512


def signed(values):
    return np.ascontiguousarray(values, np.uint64).view(np.int64)


def signatures(docs, size, wide, length, id_col, text_col):
    """doc_id, n (runs), d1 and d2 (digest of the set), sig (a value for each of size coordinates) and wide of every row."""
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        times, plus = numbers(11, wide) | np.uint64(1), numbers(12, wide)
        for part in slices(batches):
            sets = shingle_sets(Words(texts(part), SPACES, lower=True), length)
            least = [_least(s, times, plus) if len(s) else np.empty(0, np.uint64) for s in sets]
            d1, d2 = (signed([mix(s ^ np.uint64(salt)).sum(dtype=np.uint64) for s in sets]) for salt in (1, 2))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(d1), pa.array(d2),
                 pa.array([signed(x[:size]) for x in least], pa.list_(pa.int64())),
                 pa.array([x.astype("<u2").tobytes() for x in least], pa.binary())], ["doc_id", "n", "d1", "d2", "sig", "wide"])

    return source.mapInArrow(run, "doc_id long, n long, d1 long, d2 long, sig array<long>, wide binary")


def _least(values, times, plus, most=1 << 12):
    """Smallest value of each coordinate's hash over a set, a bounded part of the set at a time."""
    parts = [(values[i:i + most, None] * times + plus).min(0) for i in range(0, len(values), most)]
    return np.minimum.reduce(parts)


def postings(classes, match):
    """token, rep: each class under its rarest shared values, as many as it needs to meet every class with `match` of them."""
    posted = classes.select("rep", F.explode("sig").alias("token"))
    shared = posted.join(posted.groupBy("token").agg(F.count("*").alias("n")).filter("n > 1"), "token")
    rare = shared.groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("t"))
    rare = rare.filter(F.size("t") >= match)
    return rare.select("rep", F.explode(F.slice("t", 1, F.size("t") - (match - 1))).alias("t")).select("t.token", "rep")


def full_sets(docs, ids, length, id_col, text_col):
    """rep and runs, the sorted set values, of the rows whose id is in ids."""
    source = docs.select(F.col(id_col).cast("long").alias("rep"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        for part in slices(batches):
            sets = shingle_sets(Words(texts(part), SPACES, lower=True), length)
            yield pa.RecordBatch.from_arrays([part.column("rep"), pa.array([s.tobytes() for s in sets], pa.binary())], ["rep", "runs"])

    return source.join(ids, "rep", "left_semi").dropDuplicates(["rep"]).mapInArrow(run, "rep long, runs binary")


def confirm(pairs, sets, percent):
    """Those pairs (a, b) whose sets have percent of their union in common, or more."""

    def run(batches):
        for part in slices(batches, "runs_a"):
            a, b = ([np.frombuffer(x, np.uint64) for x in part.column(c).to_pylist()] for c in ("runs_a", "runs_b"))
            both = np.fromiter((_common(x, y) for x, y in zip(a, b)), np.int64, len(a))
            union = np.fromiter(map(len, a), np.int64, len(a)) + np.fromiter(map(len, b), np.int64, len(b)) - both
            yield part.select(["a", "b"]).filter(pa.array(100 * both >= percent * union))

    left = sets.select(F.col("rep").alias("a"), F.col("runs").alias("runs_a"))
    right = sets.select(F.col("rep").alias("b"), F.col("runs").alias("runs_b"))
    return pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "runs_a", "runs_b").mapInArrow(run, "a long, b long")


def _common(x, y):
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return int((y[at] == x).sum()) if len(y) else 0


def components(edges):
    """v and root: the smallest vertex that each vertex of the edges (a, b) reaches; roots stand for themselves.

    Alternates two steps until nothing changes: every vertex sends its smallest neighbour to its larger ones, then
    to its smaller ones and itself. Vertices only travel as minima, so a hub's edges are never in one place.
    """
    now, before = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "edges"), None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return now.select(F.col("u").alias("vertex"), F.col("v").alias("root"))
        before = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        now = written(small.unionByName(least.withColumnRenamed("m", "v")).distinct(), "edges")


def likely(pairs, wide, match):
    """Those pairs (a, b) that agree in `match` wide coordinates or more."""

    def run(batches):
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16) for c in ("wa", "wb"))
            agree = (a == b).reshape(batch.num_rows, -1).sum(1) if batch.num_rows else np.empty(0, int)
            yield batch.select(["a", "b"]).filter(pa.array(agree >= match))

    left, right = wide.toDF("a", "wa"), wide.toDF("b", "wb")
    return pairs.join(left, "a").join(right, "b").select("a", "b", "wa", "wb").mapInArrow(run, "a long, b long")


class Block:
    """Classes at home in a block of a posting list, and which of the components that meet there are linked so far."""

    def __init__(self, token, percent, match):
        self.token, self.percent, self.match = token, percent, match
        self.rows, self.parent, self.links = [], {}, []

    def find(self, root):
        top = root
        while self.parent.get(top, top) != top:
            top = self.parent[top]
        while self.parent.get(root, root) != top:
            self.parent[root], root = top, self.parent[root]
        return top

    def settle(self):
        """All classes at home are there: arrays for the comparisons, and those that ask are compared with the others."""
        self.rep = np.array([r["rep"] for r in self.rows], np.int64)
        self.wide = np.frombuffer(b"".join(r["wide"] for r in self.rows), np.uint16).reshape(len(self.rows), -1)
        self.component = np.array([r["root"] for r in self.rows], np.int64)
        self.runs = [np.frombuffer(r["runs"], np.uint64) for r in self.rows]
        self.sizes = np.array([len(x) for x in self.runs], np.int64)
        self.before = [self._before(r) for r in self.rows]
        for i, r in enumerate(self.rows):
            if r["asks"]:
                self.ask(r, self.wide[i], self.runs[i], self.before[i])
        self.rows = None

    def _before(self, row):
        """Tokens before this one under which the class is posted: a pair with one of them in common is looked at there."""
        return {t for t in row["mine"] if t < self.token}

    def visit(self, row):
        self.ask(row, np.frombuffer(row["wide"], np.uint16), np.frombuffer(row["runs"], np.uint64), self._before(row))

    def ask(self, row, wide, runs, before):
        mine, n = self.find(row["root"]), len(runs)
        k = np.flatnonzero(
            (self.component != mine) & (100 * np.minimum(self.sizes, n) >= self.percent * np.maximum(self.sizes, n)))
        agree = (self.wide[k] == wide).sum(1)
        for at in np.argsort(-agree, kind="stable"):
            if agree[at] < self.match:
                return
            j = k[at]
            if self.component[j] == mine or not before.isdisjoint(self.before[j]):
                continue
            both = _common(runs, self.runs[j])
            if 100 * both >= self.percent * (n + self.sizes[j] - both):
                self.links.append((min(row["rep"], self.rep[j]), max(row["rep"], self.rep[j])))
                other = self.component[j]
                self.parent[other] = mine
                self.component[self.component == other] = mine


def across(lists, classes, match, percent):
    """Links between classes of one posting list, but of different components, as far as they join components inside a block.

    lists: token, rep, root. classes: rep, wide, runs (the full set), mine (the ascending tokens of all lists that rep is in); they are joined
    when the blocks are known, so the sets travel once. Long lists are cut into blocks. A list's largest component needs no comparison with
    itself: its classes stay in their block, all others visit every block and are compared with what is at home there; visitors are read
    one by one. A pair is looked at only under the smallest token that both have.
    """
    parts = lists.groupBy("token", "root").agg(F.count("*").alias("c"))
    sizes = parts.groupBy("token").agg(F.sum("c").alias("s"), F.max_by("root", F.struct("c", "root")).alias("main"))
    cut = lists.join(sizes, "token").withColumn("n", F.ceil(F.col("s") / BLOCK).cast("int"))
    cut = cut.withColumn("own", F.pmod(F.xxhash64("rep"), F.col("n")).cast("int"))
    visits = F.when(F.col("root") == F.col("main"), F.array("own")).otherwise(F.sequence(F.lit(0), F.col("n") - 1))
    cut = cut.select("token", F.explode(visits).alias("block"), "own", "rep", "root", (F.col("root") != F.col("main")).alias("asks"))
    groups = cut.join(classes, "rep").repartition("token", "block").sortWithinPartitions("token", "block", F.expr("own <> block"), "rep")

    def run(batches):
        key, now, settled = None, None, False

        def links():
            if not settled:
                now.settle()
            a, b = np.array(now.links, np.int64).reshape(-1, 2).T
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            for row in batch.to_pylist():
                if key != (row["token"], row["block"]):
                    if now is not None:
                        yield links()
                    key, now, settled = (row["token"], row["block"]), Block(row["token"], percent, match), False
                if row["own"] == row["block"]:
                    now.rows.append(row)
                    continue
                if not settled:
                    now.settle()
                    settled = True
                now.visit(row)
        if now is not None:
            yield links()

    return groups.mapInArrow(run, "a long, b long").distinct()


def near_duplicates(docs, id_col="doc_id", text_col="text", length=5, percent=75, size=32, match=14, wide=256, wide_match=164):
    """id_col, n_shingles, component_id and kept of every row.

    A row's set: its distinct runs of `length` words (A-Z lower-cased, words end at ASCII white space); with fewer words the whole
    sequence. Null, empty and word-free texts have no set and are linked with nothing. Rows with percent of their sets' union in
    common are linked; component_id is the smallest id reachable, kept marks the rows that have it as id. Rows with
    one id count as one document, of which the classes use one row for each different set; a null id is kept as null
    and linked with nothing (kept = true). Other columns are left out.
    """
    rows = written(signatures(docs, size, wide, length, id_col, text_col), "signatures")
    # rows without an id or a set stay out
    full = rows.filter("n > 0 AND doc_id IS NOT NULL")
    smallest = full.groupBy("d1", "d2", "n").agg(F.min("doc_id").alias("rep"), F.min("sig").alias("sig"), F.min("wide").alias("wide"))
    classes = written(smallest, "classes")
    posted = written(postings(classes, match), "postings")
    leaders = posted.groupBy("token").agg(F.min("rep").alias("a"), F.count("*").alias("s")).filter("s > 1").drop("s")
    pairs = posted.join(leaders, "token").filter("rep > a").select("a", F.col("rep").alias("b")).distinct()
    bits = classes.select("rep", "wide")
    pairs = likely(pairs, bits, wide_match)
    met = posted.join(leaders, "token", "left_semi").select("rep").distinct()
    sets = written(full_sets(docs, met, length, id_col, text_col), "sets")
    links = written(confirm(pairs, sets, percent), "links")
    roots = components(links)
    named = posted.join(roots, posted.rep == roots.vertex, "left").select("token", "rep", F.coalesce("root", "rep").alias("root"))
    mixed = named.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi").select("token")
    lists = written(named.join(mixed, "token", "left_semi"), "lists")
    mine = lists.groupBy("rep").agg(F.sort_array(F.collect_list("token")).alias("mine"))
    found = written(across(lists, mine.join(bits, "rep").join(sets, "rep"), wide_match, percent), "links")
    if not found.isEmpty():
        ends = lists.select("rep", "root").distinct()
        ends = found.join(ends.toDF("a", "ra"), "a").join(ends.toDF("b", "rb"), "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
        merged = components(ends)
        old = roots.join(merged.select(F.col("vertex").alias("root"), F.col("root").alias("to")), "root", "left")
        old = old.select("vertex", F.coalesce("to", "root").alias("root"))
        roots = written(old.unionByName(merged.join(roots, "vertex", "left_anti").select("vertex", "root")), "roots")
    by_class = classes.join(roots, classes.rep == roots.vertex, "left").select("d1", "d2", "n", F.coalesce("root", "rep").alias("root"))
    out = rows.join(by_class, ["d1", "d2", "n"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id"))
    return out.select(
        F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def op6(spark, sf_dir):
    """Near-duplicate components of all documents."""
    return near_duplicates(read(spark, sf_dir, "documents"))
