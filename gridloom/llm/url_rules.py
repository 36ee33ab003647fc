"""URL rules by cascades of Bloom filters, exact over the corpus's keys without a join.

A rule is a host and the start of a path; a URL's keys are the combinations of its host's suffixes and its path's
prefixes in the shapes (labels, characters) that some rule has. Each verdict has a cascade. Its level one holds the verdict's
listed keys. Keys of the corpus that level one takes wrongly go into level two, listed keys that level two takes wrongly into
level three, and so on until a level takes nothing wrongly: every key of the corpus then has one definite answer.
Level one is sized so that about as many keys are taken wrongly as are listed, so each level has a proven size. Tasks get the filters
and the shapes but no rule: the cascades alone decide, and a rule's text is the key that was found.
"""

from collections import namedtuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import functions as F

from gridloom.llm.common import read

Rule = namedtuple("Rule", "verdict host path")

RULES = [
    Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/"),
]


class Bloom:
    """A Bloom filter for n keys (bytes) with about `rate` false positives."""

    def __init__(self, keys, rate, salt):
        self.salt, self.hashes = salt, max(1, round(-np.log2(rate)))
        self.size = max(64, int(np.ceil(max(1, len(keys)) * -np.log(rate) / np.log(2) ** 2)))
        bits = np.zeros(-(-self.size // 8) * 8, bool)
        bits[self._places(keys)] = True
        self.bits = np.packbits(bits)

    def _places(self, keys):
        digests = b"".join([xxhash.xxh3_128_digest(k, self.salt) for k in keys])
        a, b = np.frombuffer(digests, ">u8").astype(np.uint64).reshape(-1, 2).T
        return ((a[:, None] + np.arange(self.hashes, dtype=np.uint64) * (b | np.uint64(1))[:, None]) % np.uint64(self.size)).astype(np.int64)

    def has(self, keys):
        """Whether the filter takes each key."""
        at = self._places(keys)
        return (self.bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).all(axis=1)


class Cascade:
    """Bloom filters in turn for listed keys and for the other keys taken wrongly by the level before."""

    def __init__(self, levels):
        self.levels = levels

    def has(self, keys):
        """Whether each key is listed; exact for listed keys and for the corpus's keys."""
        out, left = np.zeros(len(keys), bool), np.arange(len(keys))
        for depth, level in enumerate(self.levels):
            taken = level.has([keys[i] for i in left])
            out[left[~taken]] = depth % 2 == 1
            left = left[taken]
        out[left] = len(self.levels) % 2 == 1
        return out


def first_level(listed, universe_size):
    """Level one for distinct listed keys; universe_size: an upper bound of the corpus's keys."""
    return Bloom(listed, min(0.5, max(1, len(listed)) / max(1, universe_size)), 1)


def build(listed, level, wrong):
    """The cascade over level one; wrong: the distinct unlisted keys of the corpus that level one takes."""
    levels, yes, no = [level], list(listed), sorted(wrong)
    while no:
        levels.append(Bloom(no, 0.5, len(levels) + 1))
        taken = levels[-1].has(yes)
        yes, no = no, [k for k, t in zip(yes, taken) if t]
    return Cascade(levels)


def host_path(url):
    """Columns host and path of a URL column; both empty for null and without '://'."""
    after = F.when(F.locate("://", url) > 0, F.expr("substring(url, locate('://', url) + 3)")).otherwise("")
    host = F.translate(F.regexp_extract(after, r"(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host.alias("host"), F.regexp_extract(after, r"(?s)^[^/?#]*([^?#]*)", 1).alias("path")


def keys_of(batch, shapes):
    """For each shape that some URL of the batch has: its size, rows with the shape, their host suffix and their key as a dictionary array.

    Host suffixes are cut once for each different host, and a key occurs once in the dictionary.
    """
    hosts = pc.dictionary_encode(batch.column("host"))
    labels = [h.split(".") for h in hosts.dictionary.to_pylist()]
    sizes = pc.utf8_length(batch.column("path")).to_numpy(zero_copy_only=False)
    of, most = hosts.indices.to_numpy(zero_copy_only=False), np.fromiter(map(len, labels), np.int64, len(labels))
    for n, size in shapes:
        rows = np.flatnonzero((most[of] >= n) & (sizes >= size)) if len(labels) else []
        if len(rows):
            suffixes = pa.array([".".join(x[-n:]) for x in labels], pa.string()).take(pa.array(of[rows]))
            starts = pc.utf8_slice_codeunits(batch.column("path").take(pa.array(rows)), 0, size)
            yield size, rows, suffixes, pc.dictionary_encode(pc.binary_join_element_wise(suffixes, starts, "\n"))


def judge(pages, rules, id_col="page_id", url_col="url", otherwise="allow"):
    """id_col, host, path, rule (host and path of the longest rule that fits, else null) and verdict of every URL.

    No rule fits a null URL or one without '://'; those and all unlisted URLs get `otherwise`. Of two rules of equal
    length the one with the longer host wins, of two rules with one host and path the later one. Repeated rows are judged each;
    other columns are left out. To the driver come the keys that a first level takes, about two for each rule.
    """
    source = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"))
    source = source.select("page_id", *host_path(F.col("url")))
    listed = {}
    for key, verdict in {f"{r.host}\n{r.path}".encode(): r.verdict for r in rules}.items():
        listed.setdefault(verdict, []).append(key)
    shapes = sorted({(r.host.count(".") + 1, len(r.path)) for r in rules})
    verdicts, universe = list(listed), source.count() * len(shapes)
    firsts = [first_level(listed[v], universe) for v in verdicts]

    def find(batches):
        for batch in batches:
            for _, _, _, keys in keys_of(batch, shapes):
                known = [k.encode() for k in keys.dictionary.to_pylist()]
                for i, level in enumerate(firsts):
                    taken = keys.dictionary.filter(pa.array(level.has(known)))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(taken), i, np.int32)), taken], ["i", "key"])

    taken = source.select("host", "path").mapInArrow(find, "i int, key string").distinct().collect() if shapes else []
    wrong = [{r.key.encode() for r in taken if r.i == i}.difference(listed[v]) for i, v in enumerate(verdicts)]
    cascades = [build(listed[v], level, no) for v, level, no in zip(verdicts, firsts, wrong)]

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            length, suffix = np.full(n, -1), np.zeros(n, np.int64)  # of the rule found so far, and of its host
            rule, verdict = np.full(n, None, object), np.full(n, otherwise, object)
            for size, rows, suffixes, keys in keys_of(batch, shapes):
                known = [k.encode() for k in keys.dictionary.to_pylist()]
                found = np.full(len(known), -1)
                for i, cascade in enumerate(cascades):
                    left = np.flatnonzero(found < 0)
                    found[left[cascade.has([known[k] for k in left])]] = i
                key = keys.indices.to_numpy(zero_copy_only=False)
                host = pc.utf8_length(suffixes).to_numpy(zero_copy_only=False).astype(np.int64)
                better = (host + size > length[rows]) | ((host + size == length[rows]) & (host > suffix[rows]))
                win = np.flatnonzero((found[key] >= 0) & better)
                at, key = rows[win], key[win]
                length[at], suffix[at] = host[win] + size, host[win]
                rule[at] = np.array([k.decode().replace("\n", "", 1) for k in known], object)[key]
                verdict[at] = np.array(verdicts, object)[found[key]]
            yield pa.RecordBatch.from_arrays([
                *(batch.column(c) for c in ("page_id", "host", "path")), pa.array(rule, pa.string()), pa.array(verdict, pa.string())],
                ["page_id", "host", "path", "rule", "verdict"])

    out = source.mapInArrow(run, "page_id long, host string, path string, rule string, verdict string")
    return out.withColumnRenamed("page_id", id_col)


def op9(spark, sf_dir):
    """Verdict on the URLs of all pages by the fixed rules."""
    return judge(read(spark, sf_dir, "pages"), RULES)


OP9_SQL = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
ruled AS (
  SELECT page_id, host, path, CASE
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule FROM parts)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM ruled"""
