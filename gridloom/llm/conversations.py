"""Repair of conversation structure by weighted interval parsing (CYK).

The grammar in Chomsky normal form. A nonterminal N(p, q) stands for the output that leads from position p of the wanted role pattern
`(s?(ua)+)?` to position q: 0 at its start, 1 after s, 2 after u, 3 after a. Its rules are N(p, q) -> N(p, r) N(r, q), and N(p, q) -> a row under
one edit: K(eep) with its own role, R(erole) to user or assistant, D(elete), which stays at p. Insertions are rules without a
row; their closure (the cheapest insertions from p to q) is put around every row's cell. The start symbols are N(0, 0) and N(0, 3).

A cell keeps the least (cost, audit) of its span and nonterminal. Two audits of one span with equal cost never are a
prefix of one another, because each has a letter for every row and each insertion costs; so the least audit of a whole is made of least
audits of its parts. Every split of a span gives the same cell, since a piece between positions p and q may be cut at any row, whatever the
position there. So spans are combined bottom-up with lengths that double: n rows need 2n cells instead of n * n.

1. Copies of a row are counted before anything is dealt out; the first of all rows with one role and text is found by an aggregation.
   Both lists together are cut into ranges of (conversation, order of its rows), so the turns of one conversation may lie in many tasks.
2. A task parses what it holds in blocks of at most BLOCK rows. A conversation that lies in one block is finished there.
3. Blocks of the other conversations are combined by fours and more, level by level, from their cells alone. At the end one task for each of
   these conversations reads its blocks in order for the digest of the repaired text, one block in memory at a time.
"""

import hashlib

import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm.common import read, written

#: Rows parsed as one block.
BLOCK = 512
#: Neighbouring spans combined by one group of a level.
FAN = 64
#: Costs of the edits, and of a cut-off text that is not deleted.
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 3, 4, 3, 3
#: Steps of the role pattern: from position, role initial, to position.
STEPS = [(0, "s", 1), (0, "u", 2), (1, "u", 2), (2, "a", 3), (3, "u", 2)]
ENDS = (0, 3)
NAMES = {"u": "user", "a": "assistant"}
FINE = {"su", "ua", "au"}

WHITE = "\t\n\x0b\x0c\r "


def damaged(rows):
    """conv, turn, role, text and n of the rows of a conversation table after the damage; rows that it drops keep n = 0.

    crc32(conv_id:turn) % 20 of a row decides: 0 drops it, 1 empties its text, 2 removes . ! ? from it, 3 doubles it, 4 makes it a user's. A null
    role or text is one space, and so is a null conv_id or turn in that key.
    """
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = rows.withColumn("kind", F.crc32(key) % 20)
    text, kind = F.coalesce("text", space), F.col("kind")
    return rows.select(
        "conv", "turn", F.when(kind == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("n"))


def ordered(rows, parts):
    """Rows by (conv, turn, role, text) in ranges of that order: one for each different row with its number n, and beside it, once for
    each role and text of a conversation, the text of the first such row (mark 1).

    Rows of one turn are ordered by role, the first 64 characters of their text, and a digest of role and text.
    """
    digest = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")))
    last = F.substring(F.rtrim(F.col("text"), F.lit(WHITE)), -1, 1)
    named = rows.select(
        "conv", "turn", "role", F.substring("text", 1, 64).alias("head"), digest.alias("digest"), "n", "text",
        (F.translate("text", WHITE, "") == "").alias("blank"), (~last.isin(".", "!", "?")).alias("cut"))
    whole = ["role", "head", "digest", "blank", "cut"]
    light = named.groupBy("conv", "turn", *whole).agg(F.sum("n").alias("n"))
    light = light.select("conv", "turn", *whole, "n", F.lit(0).alias("mark"), F.lit(None).cast("string").alias("text"))
    # a null turn comes first, and min leaves nulls out
    first = named.filter("n > 0").groupBy("conv", *whole, "text").agg(F.min("turn").alias("least"), F.max(F.isnull("turn")).alias("none"))
    first = first.select(
        "conv", F.when(~F.col("none"), F.col("least")).alias("turn"), *whole, F.lit(0).cast("long").alias("n"), F.lit(1).alias("mark"),
        F.when(~F.col("blank"), F.col("text")).alias("text"))
    order = ["conv", F.asc_nulls_first("turn"), "role", "head", "digest"]
    return light.unionByName(first).repartitionByRange(parts, *order).sortWithinPartitions(*order, F.desc("mark"))


def _closure():
    """Cheapest insertions from one position to another."""
    cells = {(p, p): (0, "") for p in range(4)}
    for _ in range(3):
        for (p, q), (cost, audit) in list(cells.items()):
            for a, symbol, b in STEPS:
                if a == q and symbol in NAMES:
                    new = (cost + INSERT, audit + "I")
                    cells[p, b] = min(cells.get((p, b), new), new)
    return cells


def combine(left, right):
    """Cells of a span from those of its two halves."""
    cells = {}
    for (p, r), (cost, audit) in left.items():
        for (s, q), (more, rest) in right.items():
            if r == s:
                total = cost + more
                old = cells.get((p, q))
                if old is None or total < old[0] or total == old[0] and audit + rest < old[1]:
                    cells[p, q] = (total, audit + rest)
    return cells


INSERTIONS = _closure()


def row_cells(initial, fault):
    """Cells of one row with insertions around it. fault: blank, duplicate, truncated or None."""
    cells = {(p, p): (DELETE, "D") for p in range(4)}
    if fault not in ("blank", "duplicate"):
        more = CUT_OFF if fault == "truncated" else 0
        for p, symbol, q in STEPS:
            if symbol == initial:
                cells[p, q] = min(cells.get((p, q), (KEEP + more, "K")), (KEEP + more, "K"))
            elif symbol in NAMES:
                cells[p, q] = min(cells.get((p, q), (REROLE + more, "R")), (REROLE + more, "R"))
    return combine(combine(INSERTIONS, cells), INSERTIONS)


def parse(spans):
    """Cells of neighbouring spans together, by lengths that double."""
    spans = list(spans)
    while len(spans) > 1:
        joined = [combine(a, b) for a, b in zip(spans[::2], spans[1::2])]
        spans = joined + spans[len(joined) * 2:]
    return spans[0] if spans else INSERTIONS


def best(cells):
    """Least (cost, audit) of a whole conversation."""
    return min(cells[0, q] for q in ENDS)


def repaired(audit, rows, place=0, odd=None):
    """`role:text` of what the edits leave. rows: (role, text) of each K, R or D of the audit.

    The role of a new or changed row follows from its place in the result (`place` rows come before) and from whether the whole
    result has an odd number of rows, that is, begins with s.
    """
    odd = sum(c != "D" for c in audit) % 2 if odd is None else odd
    rows = iter(rows)
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        if edit != "K":
            role = NAMES["ua"[(place - odd) % 2]]
        place += 1
        yield f"{role}:{text}"


class Block:
    """Neighbouring rows of one conversation and what is counted in them."""

    def __init__(self, conv, seq):
        self.conv, self.seq, self.rows, self.faults, self.turns = conv, seq, [], [], []

    def add(self, turn, role, text, fault):
        self.rows.append((role, text))
        self.faults.append(fault)
        self.turns.append(turn)

    def summary(self):
        initials = [role[:1] for role, _ in self.rows]
        turns = [t for t in self.turns if t is not None]
        return {
            "rows": len(self.rows), "blank": self.faults.count("blank"), "duplicate": self.faults.count("duplicate"),
            "truncated": self.faults.count("truncated"), "illegal": sum(a + b not in FINE for a, b in zip(initials, initials[1:])),
            "first": initials[0] if initials else None, "last": initials[-1] if initials else None,
            "low": turns[0] if turns else None, "high": turns[-1] if turns else None,
            "turns": sum(a != b for a, b in zip(turns, turns[1:])) + bool(turns),
        }

    def cells(self, known):
        keys = [(role[:1], fault) for (role, _), fault in zip(self.rows, self.faults)]
        return parse([known.get(k) or known.setdefault(k, row_cells(*k)) for k in keys])


COUNTS = "rows long, blank long, duplicate long, truncated long, illegal long, first string, last string, low long, high long, turns long"
CELLS = "cells array<struct<p: int, q: int, cost: long, audit: string>>"


def added(a, b):
    """Summary of two neighbouring spans."""
    if not a["rows"] or not b["rows"]:
        return a if a["rows"] else b
    out = {k: a[k] + b[k] for k in ("rows", "blank", "duplicate", "truncated", "illegal", "turns")}
    out["illegal"] += a["last"] + b["first"] not in FINE
    out["turns"] -= a["high"] is not None and a["high"] == b["low"]
    return out | {
        "first": a["first"], "last": b["last"], "low": a["low"] if a["low"] is not None else b["low"],
        "high": b["high"] if b["high"] is not None else a["high"]}


def _listed(cells):
    return [{"p": p, "q": q, "cost": cost, "audit": audit} for (p, q), (cost, audit) in cells.items()]


def _cells(listed):
    return {(c["p"], c["q"]): (c["cost"], c["audit"]) for c in listed}


def _entries(batches):
    """(conv, turn, role, text or None, blank, cut, number of rows, first) of the merged lists."""
    held, first = None, None
    for batch in batches:
        for r in batch.to_pylist():
            if r["mark"]:
                first = r
                continue
            key = (r["conv"], r["turn"], r["role"], r["digest"])
            own = first is not None and (first["conv"], first["turn"], first["role"], first["digest"]) == key
            held = first["text"] if own else None
            first = None
            yield r, held, own


def _blocks(entries, block):
    """Blocks in order, each with whether its conversation has ended; the first and the last conversation of a task may go on elsewhere."""
    now, seq, whole, known = None, 0, True, False
    for r, text, first in entries:
        if now is None or not known or now.conv != r["conv"]:
            if now is not None:
                yield now, True
            now, seq, known = Block(r["conv"], 0), 0, True
        for i in range(r["n"]):
            if len(now.rows) == block:
                yield now, False
                seq += 1
                now = Block(r["conv"], seq)
            fault = "blank" if r["blank"] else "duplicate" if i or not first else "truncated" if r["cut"] else None
            now.add(r["turn"], r["role"], text if not i and first else None, fault)
    if now is not None:
        yield now, None


def blocks_of(rows, block, conv_type):
    """One row for each block: conv, part, seq, the counts, done (whether it is a whole conversation), cost, audit and digest if it is, else
    its cells and rows."""
    schema = T.StructType([T.StructField("conv", conv_type), *T._parse_datatype_string(
        f"part int, seq int, done boolean, {COUNTS}, cost long, audit string, sha string, {CELLS}, roles array<string>, texts array<string>").fields])
    arrow = _arrow(schema)

    def run(batches):
        from pyspark import TaskContext

        part, known, out, size, at_start = TaskContext.get().partitionId(), {}, [], 0, True
        for b, ended in _blocks(_entries(batches), block):
            cells = b.cells(known)
            row = {"conv": b.conv, "part": part, "seq": b.seq} | b.summary()
            if ended and not at_start and not b.seq:
                cost, audit = best(cells) if b.rows else (0, "")
                sha = hashlib.sha256("\n".join(repaired(audit, b.rows)).encode("utf-8", "surrogatepass")).hexdigest()
                row |= {"done": True, "cost": cost, "audit": audit, "sha": sha}
            else:
                row |= {"done": False, "cells": _listed(cells), "roles": [r for r, _ in b.rows], "texts": [t for _, t in b.rows]}
                size += sum(len(t or "") for _, t in b.rows)
            at_start = at_start and not ended
            out.append(row)
            if len(out) >= 2000 or size > 1 << 20:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return rows.mapInArrow(run, schema)


def _arrow(schema):
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def joined(level, fan):
    """The next level: each `fan` neighbouring spans of a conversation as one."""
    arrow = _arrow(level.schema)

    def run(table):
        spans = table.sort_by("number").to_pylist()
        out = {"conv": spans[0]["conv"], "number": spans[0]["number"] // fan, "cells": _listed(parse([_cells(s["cells"]) for s in spans]))}
        total = spans[0]
        for s in spans[1:]:
            total = added(total, s)
        return pa.Table.from_pylist([total | out], schema=arrow)

    up = level.withColumn("up", F.floor(F.col("number") / fan))
    return up.groupBy("conv", "up").applyInArrow(lambda table: run(table.drop_columns("up")), level.schema)


def finished(open_blocks, tops):
    """conv and digest of the conversations in several blocks, whose blocks are read in order by one task each."""
    conv_type = open_blocks.schema["conv"].dataType
    audits = tops.select("conv", F.lit(-1).cast("long").alias("number"), "audit", F.lit(None).cast("array<string>").alias("roles"), F.lit(None).cast("array<string>").alias("texts"))
    rows = open_blocks.select("conv", "number", F.lit(None).cast("string").alias("audit"), "roles", "texts").unionByName(audits)
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = T.StructType([T.StructField("conv", conv_type), T.StructField("sha", T.StringType())])
    arrow = _arrow(schema)

    def run(batches):
        conv, audit, at, place, odd, digest = None, None, 0, 0, 0, None

        def end():
            # what is left of the audit are insertions behind the last row
            _feed(digest, repaired(audit[at:], [], place, odd), place)
            return pa.RecordBatch.from_pylist([{"conv": conv, "sha": digest.hexdigest()}], schema=arrow)

        for batch in batches:
            for r in batch.to_pylist():
                if r["number"] < 0:
                    if digest is not None:
                        yield end()
                    conv, audit, at, place, digest = r["conv"], r["audit"], 0, 0, hashlib.sha256()
                    odd = (len(audit) - audit.count("D")) % 2
                    continue
                stop, seen = at, 0
                while seen < len(r["roles"]):
                    seen += audit[stop] != "I"
                    stop += 1
                mine, at = audit[at:stop], stop
                place = _feed(digest, repaired(mine, zip(r["roles"], r["texts"]), place, odd), place)
        if digest is not None:
            yield end()

    return rows.repartition(parts, "conv").sortWithinPartitions("conv", "number").mapInArrow(run, schema)


def _feed(digest, lines, place):
    for line in lines:
        digest.update((("\n" if place else "") + line).encode("utf-8", "surrogatepass"))
        place += 1
    return place


RESULT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def repair(rows, block=BLOCK, fan=FAN, parts=None):
    """One row for each conv of rows (conv, turn, role, text, n as `damaged` gives them): gaps, blank, duplicate, truncated, illegal, cost, audit
    and repaired_sha256.

    n is how often a row occurs; 0 only names its conversation, which without rows has zeros, an empty audit and the digest of the empty text.
    Rows are taken by turn, nulls first; rows of one turn by role and text (see `ordered`). A null conv is a conversation of its own.
    A role is told by its first character; a role or text of white space is taken as it is. Results don't depend on block, fan or parts.
    An empty table gives no rows.
    """
    spark = rows.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    conv_type = rows.schema["conv"].dataType
    blocks = written(blocks_of(ordered(rows, parts), block, conv_type), "conversation-blocks")
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0).cast("long")).alias("gaps")
    counted = ["conv", gaps, "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    closed = blocks.filter("done").select(*counted, F.col("sha").alias("repaired_sha256"))
    # of a hot conversation this window sees one row for each block, without cells and texts
    by_order = Window.partitionBy("conv").orderBy("part", "seq")
    numbers = blocks.filter("NOT done").select("conv", "part", "seq").withColumn("number", F.row_number().over(by_order).cast("long") - 1)
    same = F.col("b.conv").eqNullSafe(F.col("k.conv")) & (F.col("b.part") == F.col("k.part")) & (F.col("b.seq") == F.col("k.seq"))
    opened = written(blocks.filter("NOT done").alias("b").join(numbers.alias("k"), same).select("b.*", "k.number"), "conversation-open")
    summary = [f.name for f in T._parse_datatype_string(COUNTS).fields]
    level = opened.select("conv", "number", *summary, "cells")
    while True:
        level = written(joined(level, fan), "conversation-level")
        if not level.agg(F.max("number").alias("n")).first().n:
            break
    tops = level.select("conv", *summary, F.array_min(F.expr(
        f"transform(filter(cells, c -> c.p = 0 AND c.q IN {ENDS}), c -> struct(c.cost AS cost, c.audit AS audit))")).alias("top"))
    none = F.col("rows") == 0
    tops = written(tops.select(
        "conv", *summary, F.when(none, 0).otherwise(F.col("top.cost")).cast("long").alias("cost"), F.when(none, "").otherwise(F.col("top.audit")).alias("audit")), "conversation-tops")
    shas = finished(opened, tops)
    late = tops.alias("t").join(shas.alias("s"), F.col("t.conv").eqNullSafe(F.col("s.conv"))).select("t.*", F.col("s.sha").alias("repaired_sha256"))
    return closed.unionByName(late.select(*counted, "repaired_sha256")).select("conv", *RESULT)


def op12(spark, sf_dir):
    """Damages all conversations and repairs them."""
    rows = read(spark, sf_dir, "conversations").select(F.col("conv_id").alias("conv"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string"))
    return repair(damaged(rows)).withColumnRenamed("conv", "conv_id")


#: crc32 of a short string: its bytes one by one, eight shifts each.
_CRC = "list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split({0}, ''), lambda c: ord(c)::UBIGINT)), lambda acc, b: {1})"


def _sql():
    step = "xor(acc, b)"
    for _ in range(8):
        step = f"list_transform([{step}], lambda z: xor(z >> 1, (z & 1) * 3988292384::UBIGINT))[1]"
    crc = f"xor({_CRC.format('key', step)}, 4294967295::UBIGINT)"
    white = r"[^\x20\x09-\x0D]"
    moves = ", ".join(f"({p}, '{s}', {q})" for p, s, q in STEPS)
    skips = ", ".join(
        f"({p}, {q}, {cost}, '{audit}', [{', '.join(repr(NAMES[x] + ':') for x in path)}]::VARCHAR[])" for (p, q), (cost, audit), path in _paths())
    return rf"""WITH RECURSIVE src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
kinds AS (SELECT *, {crc} % 20 AS kind FROM src),
dam AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM kinds, range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)),
num AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, left(role, 1) AS initial FROM dam),
seq AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS nth FROM num),
fau AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '{white}') THEN 'blank' WHEN nth > 1 THEN 'duplicate'
                 WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' END AS fault,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM seq),
sums AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM fau GROUP BY conv_id),
move(p, symbol, q) AS (VALUES {moves}),
skip(p, q, cost, audit, lines) AS (VALUES {skips}),
edit AS (
  SELECT conv_id, i, p.range AS p, p.range AS q, {DELETE} AS cost, 'D' AS audit, []::VARCHAR[] AS lines FROM fau, range(4) p
  UNION ALL SELECT conv_id, i, p, q, {KEEP} + CASE WHEN fault = 'truncated' THEN {CUT_OFF} ELSE 0 END, 'K', [role || ':' || text]
  FROM fau JOIN move ON symbol = initial WHERE fault IS NULL OR fault = 'truncated'
  UNION ALL SELECT conv_id, i, p, q, {REROLE} + CASE WHEN fault = 'truncated' THEN {CUT_OFF} ELSE 0 END, 'R', [CASE symbol WHEN 'u' THEN 'user:' ELSE 'assistant:' END || text]
  FROM fau JOIN move ON symbol IN ('u', 'a') WHERE fault IS NULL OR fault = 'truncated'),
best AS (
  SELECT conv_id, 0 AS i, q AS pos, {{'cost': cost, 'audit': audit}} AS k, lines FROM (SELECT DISTINCT conv_id FROM conversations), skip WHERE p = 0
  UNION ALL
  SELECT conv_id, i, pos, min(k), arg_min(lines, k) FROM (
    SELECT b.conv_id, e.i, s.q AS pos, {{'cost': b.k.cost + e.cost + s.cost, 'audit': b.k.audit || e.audit || s.audit}} AS k,
           list_concat(list_concat(b.lines, e.lines), s.lines) AS lines
    FROM best b JOIN edit e ON e.conv_id IS NOT DISTINCT FROM b.conv_id AND e.i = b.i + 1 AND e.p = b.pos JOIN skip s ON s.p = e.q)
  GROUP BY conv_id, i, pos),
fin AS (
  SELECT b.conv_id, min(k) AS k, arg_min(lines, k) AS lines FROM best b LEFT JOIN sums s ON s.conv_id IS NOT DISTINCT FROM b.conv_id
  WHERE b.i = coalesce(s.n, 0) AND pos IN {ENDS} GROUP BY b.conv_id)
SELECT f.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, k.cost::BIGINT AS cost, k.audit AS audit, sha256(array_to_string(lines, chr(10))) AS repaired_sha256
FROM fin f LEFT JOIN sums s ON s.conv_id IS NOT DISTINCT FROM f.conv_id"""


def _paths():
    """Insertions of the closure with the symbols they put in."""
    for (p, q), cell in INSERTIONS.items():
        path, at = "", p
        while len(path) < len(cell[1]):
            symbol, at = next((s, b) for a, s, b in STEPS if a == at and s in NAMES)
            path += symbol
        yield (p, q), cell, path


OP12_SQL = _sql()
