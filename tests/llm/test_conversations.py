"""Repair against a search over all edits, and against the same rows cut into small blocks and parts."""

import functools
import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from gridloom.llm import conversations

PATTERN = re.compile("(s?(ua)+)?")


def plain_faults(rows):
    seen, out = set(), []
    for role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def plain_repair(rows):
    """Least (cost, audit, lines) by trying every edit of every row, with up to two insertions before each and at the end."""
    faults = plain_faults(rows)

    @functools.cache
    def rest(i, out, inserted):
        """out: 0 nothing yet, 1 s, 2 u, 3 a as the last row."""
        found = []
        if i == len(rows) and out in (0, 3):
            found.append((0, "", ()))
        if inserted < 2:
            for symbol, name in (("u", "user"), ("a", "assistant")):
                if symbol in NEXT[out]:
                    cost, audit, lines = rest(i, 2 if symbol == "u" else 3, inserted + 1)
                    found.append((3 + cost, "I" + audit, (f"{name}:", *lines)))
        if i < len(rows):
            (role, text), fault = rows[i], faults[i]
            cost, audit, lines = rest(i + 1, out, 0)
            found.append((4 + cost, "D" + audit, lines))
            if fault not in ("blank", "duplicate"):
                more = 3 if fault else 0
                for symbol in NEXT[out]:
                    after = {"s": 1, "u": 2, "a": 3}[symbol]
                    cost, audit, lines = rest(i + 1, after, 0)
                    if role[:1] == symbol:
                        found.append((more + cost, "K" + audit, (f"{role}:{text}", *lines)))
                    if symbol != "s":
                        name = {"u": "user", "a": "assistant"}[symbol]
                        found.append((more + 3 + cost, "R" + audit, (f"{name}:{text}", *lines)))
        return min(found, default=(10 ** 9, "", ()))

    for i in range(len(rows), 0, -1):  # from the end, so that no call goes deep
        for out in NEXT:
            rest(i, out, 0)
    return rest(0, 0, 0)


NEXT = {0: "su", 1: "u", 2: "a", 3: "u"}


def plain(table):
    """The contract in plain Python over (conv, turn, role, text)."""
    by_conv = {}
    for conv, turn, role, text in table:
        mine = by_conv.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        mine += [(turn, role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv, mine in by_conv.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:64], hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()))
        rows = [r[1:] for r in mine]
        turns = [r[0] for r in mine if r[0] is not None]
        faults = plain_faults(rows)
        cost, audit, lines = plain_repair(tuple(rows))
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
            illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
        assert PATTERN.fullmatch("".join(line[0] for line in lines))
    return out


SCHEMA = "conv long, turn long, role string, text string"


def got(spark, table, **options):
    rows = conversations.repair(conversations.damaged(spark.createDataFrame(table, SCHEMA)), **options).collect()
    assert len({r.conv for r in rows}) == len(rows)
    return {r.conv: tuple(r)[1:] for r in rows}


def noisy(seed, convs, most):
    rng = random.Random(seed)
    table = []
    for conv in [*range(convs), None]:
        for _ in range(rng.randint(0 if conv else 1, most)):
            table.append((
                conv, rng.choice([None, *range(12)]), rng.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None]),
                rng.choice(["Yes.", "No!", "and then", " \t", "", None, "What?", "Well. ", f"Say {rng.randint(0, 9)}."])))
    return table


@pytest.mark.parametrize("seed", [1, 2])
def test_repair_equals_a_search_over_all_edits(spark, seed):
    table = noisy(seed, 60, 14)
    assert got(spark, table) == plain(table)


@pytest.mark.parametrize("block, fan, parts", [(1, 2, 3), (3, 2, 8), (7, 64, 5)])
def test_blocks_levels_and_parts_do_not_change_results(spark, block, fan, parts):
    table = noisy(3, 12, 40)
    assert got(spark, table, block=block, fan=fan, parts=parts) == plain(table)


def test_one_long_conversation_over_many_parts(spark):
    rng = random.Random(5)
    table = [(7, i, "user" if i % 2 == 0 else "assistant", rng.choice([f"Turn {i}.", f"Turn {i}", "Same."])) for i in range(900)]
    assert got(spark, table, block=16, fan=4, parts=8) == plain(table)


def test_copies_of_one_row_and_conversations_that_lose_all_rows(spark):
    gone = next(c for c in range(10_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    plain_one = next(c for c in range(10_000) if zlib.crc32(f"{c}:1".encode()) % 20 > 4)
    table = [(gone, 0, "user", "Hi.")] * 3 + [(plain_one, 1, "user", "Hi.")] * 300
    found = got(spark, table, block=32)
    assert found == plain(table)
    assert found[gone] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert found[plain_one][6] == "D" * 299 + "KI" or found[plain_one][5] == 299 * 4 + 3


def test_empty_table_and_other_columns(spark):
    assert got(spark, []) == {}
    table = spark.createDataFrame([(1, 0, "user", "Hi.", 5, 2)], "conv_id long, turn long, role string, text string, cost int, n int")
    one = conversations.damaged(table.withColumnRenamed("conv_id", "conv"))
    assert conversations.repair(one).count() == 1


def test_query_names_every_conversation(spark, sf_dir):
    found = conversations.op12(spark, sf_dir)
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id").distinct()
    assert found.count() == given.count() and found.select("conv_id").exceptAll(given).isEmpty()
    assert found.filter(F.col("cost").isNull() | F.col("audit").isNull()).isEmpty()
