"""Conversation repair against a recursion over all edits, and as a whole on the conversations of sf0.01."""

from __future__ import annotations

import functools
import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tallybook.llm import conversations as cv
from tallybook.llm.queries import QUERIES

WS = "\x20\t\n\v\f\r"
SCHEMA = "conv_id long, turn long, role string, text string"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def cheapest(roles, faults):
    """(cost, edits) over every way: each row is kept, renamed or deleted, with up to two insertions in every gap."""

    def ok(s):
        return re.fullmatch("(s?(ua)+)?", s) is not None

    def may_begin(s):
        return any(ok(s + t) for t in ("", "a", "ua", "uaua"))

    @functools.cache
    def rest(i, said):
        best = [(0, "")] if i == len(roles) and ok(said) else []
        if i < len(roles):
            cost, way = rest(i + 1, said) or (None, None)
            if cost is not None:
                best.append((cost + 3, "D" + way))
            if faults[i] not in ("blank", "duplicate"):
                more = 1 if faults[i] == "truncated" else 0
                for initial, edit, price in [(roles[i], "K", 0), ("u", "R", 2), ("a", "R", 2)]:
                    best += follow(i + 1, said, initial, edit, price + more)
        for initial in "ua":
            best += insert(i, said, initial)
        return min(best) if best else None

    def shorten(s):
        while len(s) > 3 and s.endswith("uaua"):
            s = s[:-2]
        while len(s) > 4 and s.endswith("uauau"):
            s = s[:-2]
        return s

    def follow(i, said, initial, edit, price):
        new = shorten(said + initial)
        if not (initial and may_begin(new)):
            return []
        found = rest(i, new)
        return [(found[0] + price, edit + found[1])] if found else []

    @functools.cache
    def after_insertions(i, said, left):
        best = []
        if i == len(roles) and ok(said):
            best.append((0, ""))
        if i < len(roles):
            found = rest(i + 1, said)
            if found:
                best.append((found[0] + 3, "D" + found[1]))
            if faults[i] not in ("blank", "duplicate"):
                more = 1 if faults[i] == "truncated" else 0
                for initial, edit, price in [(roles[i], "K", 0), ("u", "R", 2), ("a", "R", 2)]:
                    best += follow(i + 1, said, initial, edit, price + more)
        if left:
            for initial in "ua":
                new = shorten(said + initial)
                if may_begin(new):
                    found = after_insertions(i, new, left - 1)
                    if found:
                        best.append((found[0] + 2, "I" + found[1]))
        return min(best) if best else None

    def insert(i, said, initial):
        new = shorten(said + initial)
        if not may_begin(new):
            return []
        found = after_insertions(i, new, 1)
        return [(found[0] + 2, "I" + found[1])] if found else []

    return rest(0, "")


def by_hand(rows):
    """Faults and cheapest repair of one conversation's damaged rows (turn, role, text)."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
    turns = [t for t, _, _ in rows if t is not None]
    seen, faults = set(), []
    for _, role, text in rows:
        shown = text.rstrip(WS)
        faults.append("blank" if not shown else "duplicate" if (role, text) in seen else None if shown[-1] in ".!?" else "truncated")
        seen.add((role, text))
    starts = [r[:1] for _, r, _ in rows]
    cost, audit = cheapest(tuple(s if s and s in "sua" else "" for s in starts), tuple(faults))
    out, place, k = [], "", 0
    for edit in audit:
        if edit == "I":
            new = "a" if place.endswith("u") else "u"
            out.append((f"{cv.ROLE[new]}", ""))
            place += new
            continue
        _, role, text = rows[k]
        k += 1
        if edit == "R":
            role = cv.ROLE["a" if place.endswith("u") else "u"]
        if edit != "D":
            out.append((role, text))
            place += role[0]
    assert k == len(rows) and re.fullmatch("(s?(ua)+)?", place)
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, "blank": faults.count("blank"), "duplicate": faults.count("duplicate"),
        "truncated": faults.count("truncated"), "illegal": sum(x + y not in ("su", "ua", "au") for x, y in itertools.pairwise(starts)), "cost": cost, "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest(),
    }, out


def groups(rows):
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(r)
    return out


def random_rows(n, seed, most=9):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(rng.randrange(1, most)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""])
            text = rng.choice(["Hi.", "Yes!", "no", " \t", "", None, "A?\n", "B. c", "é…", f"t{rng.random()}."])
            rows.append((conv, rng.choice([turn, turn, turn, turn + 3, None]), role, text))
    return rows


def test_report_on_random_rows(spark):
    rows = [*random_rows(500, 5), (None, 1, "user", "q"), (None, 2, "assistant", "a."), (None, None, None, None)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", cost int, audit string").repartition(5)
    got = {r.conv_id: r.asDict() for r in cv.repair_report(df).collect()}
    own = groups(rows)
    assert got.keys() == own.keys()
    for conv, part in own.items():
        assert got[conv] == {"conv_id": conv, **by_hand(damage(part))[0]}, (conv, part)
    assert cv.repair_report(df.limit(0)).count() == 0
    assert cv.repair_report(spark.createDataFrame([], SCHEMA)).count() == 0


def test_long_conversations_spill_their_moves(spark):
    rows = [r for r in random_rows(12, 3, most=70) if r[1] is not None]
    df = spark.createDataFrame([(c, t, r, x) for c, t, r, x in rows], SCHEMA)
    for held in (1, 4, 1000):
        got = {r.conv_id: r.asDict() for r in cv.repairs(df, held=held).collect()}
        for conv, part in groups(rows).items():
            want = by_hand([(t, " " if r is None else r, " " if x is None else x) for _, t, r, x in part])[0]
            want.pop("repaired_sha256")
            assert got[conv] == {"conv_id": conv, **want}, held


def test_repaired_turns(spark):
    rows = random_rows(60, 8)
    df = spark.createDataFrame(rows, SCHEMA)
    out = cv.repaired_turns(df, cv.repairs(df)).collect()
    got = {}
    for r in out:
        got.setdefault(r.conv_id, []).extend([] if r.place is None else [(r.place, r.role, r.text)])
    for conv, part in groups(rows).items():
        want = by_hand([(t, " " if r is None else r, " " if x is None else x) for _, t, r, x in part])[1]
        assert [x[1:] for x in sorted(got[conv])] == want


def test_one_conversation_with_a_third_of_all_rows_and_long_texts(spark):
    turns = spark.range(30000).select(
        F.lit(7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.concat(F.lit("t"), F.col("id").cast("string"), F.lit(".")).alias("text"),
    )
    got = cv.repairs(turns, held=1000).collect()
    assert len(got) == 1 and got[0].audit == "K" * 30000 and got[0].cost == 0
    long = spark.createDataFrame([(1, 0, "user", "x " * 500_000 + "."), (1, 1, "assistant", "y." * 500_000)], SCHEMA)
    row = cv.repair_report(long).first()
    assert row.audit == by_hand(damage([tuple(r) for r in long.collect()]))[0]["audit"]


def test_registered_query(spark, sf):
    sf = sf.replace("0.001", "0.01")
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: r.asDict() for r in QUERIES["op13_conversation_repair"](spark, sf).collect()}
    own = groups(rows)
    assert got.keys() == own.keys() and sum(r["cost"] for r in got.values())
    for conv, part in own.items():
        assert got[conv] == {"conv_id": conv, **by_hand(damage(part))[0]}


@pytest.mark.parametrize("kind", range(12))
def test_automaton_is_small(kind):
    moves, ends, back = cv.automaton()
    assert len(moves) == len(ends) < 2000 and len(back) == 12 * len(moves) and len(moves[0]) > kind
