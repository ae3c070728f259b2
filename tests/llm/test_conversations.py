"""Conversation repair against a search over all edits, on random, odd and split conversations."""

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lakewright.llm import conversations as C
from lakewright.llm import registry

SCHEMA = "conv_id long, turn long, role string, text string, mark string, edits string"
BLANK = " \t\n\v\f\r"


def searched(rows):
    """Least (cost, audit) and its lines, by Dijkstra's search over (row, initials so far as an automaton's state)."""
    step = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    names = {"u": "user", "a": "assistant"}
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, state, lines = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in ("", "a"):
            return cost, audit, list(lines)
        for x, name in names.items():
            if x in step[state]:
                heapq.heappush(heap, (cost + 2, audit + "I", i, x, (*lines, f"{name}:")))
        if i < len(rows):
            role, text, fault = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state, lines))
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                if role[:1] in step[state]:
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, role[:1], (*lines, f"{role}:{text}")))
                for x, name in names.items():
                    if x in step[state]:
                        heapq.heappush(heap, (cost + 2 + more, audit + "R", i + 1, x, (*lines, f"{name}:{text}")))
    raise AssertionError


def brute(messages):
    """Reports by conversation of (conv_id, turn, role, text)."""
    by = defaultdict(list)
    for conv, turn, role, text in messages:
        role, text = (" " if x is None else x for x in (role, text))
        mark = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
        by[conv].append((turn is not None, turn or 0, mark, role, text))
    out = {}
    for conv, rows in by.items():
        seen, faulted = set(), []
        for _, _, _, role, text in sorted(rows):
            body = text.strip(BLANK)
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
            seen.add((role, text))
            faulted.append((role, text, fault))
        cost, audit, lines = searched(faulted)
        turns = {r[1] for r in rows if r[0]}
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(faulted, faulted[1:], strict=False))
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        count = [sum(f[2] == name for f in faulted) for name in C.FAULTS[1:]]
        out[conv] = (gaps, *count, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def made(seed, sizes):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", None, "", "User", "sys", "a"]
    texts = ["Hello.", "Yes!", "no end", "Why?  \n", " ", "", None, "one.\u2028", "é.", "x.\u00a0"]
    rows = []
    for conv, n in enumerate(sizes):
        for i in range(n):
            text = rng.choice(texts) if rng.random() < 0.4 else f"text {rng.randrange(10**6)}{rng.choice(['.', ''])}"
            rows.append((conv if conv else None, rng.choice([i, i, i, i // 2, None]), rng.choice(roles if rng.random() < 0.4 else roles[:2]), text))
    return rows


def table(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA)


def reports(df):
    return {r["conv_id"]: tuple(r)[1:] for r in df.collect()}


def test_conversations_against_search(spark):
    rows = made(1, [7, *[n % 12 for n in range(120)]])
    assert reports(C.report(table(spark, rows))) == brute(rows)


def test_a_conversation_in_many_ranges(spark):
    rows = made(2, [3, 900, 1, 2, 700, 5])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pieces = C._pieces(table(spark, rows), C.shared_folder(spark, "t")).groupBy("conv_id").count()
        assert pieces.agg(F.max("count")).first()[0] > 3
        assert reports(C.report(table(spark, rows))) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_solver_on_all_short_rows():
    """Every conversation of up to three rows of any role and fault."""
    solver = C.Solver(C.ITEMS)
    names = ["system", "user", "assistant", "tool"]
    codes = range(16)
    for row in [[], *[[a] for a in codes], *[[a, b] for a in codes for b in codes], *[[a, b, c] for a in codes for b in codes for c in codes]]:
        edits, cost = C.edits_of(row, solver.crossings(row, C.NONE, C.TAIL), C.NONE, True)
        assert (cost, edits) == searched([(names[c % 4], "t", C.FAULTS[c // 4]) for c in row])[:2]


def test_pieces_meet_as_one_row():
    rng = random.Random(3)
    for _ in range(200):
        row = [rng.randrange(16) for _ in range(rng.randrange(1, 30))]
        cuts = sorted(rng.sample(range(1, len(row) + 1), min(3, len(row))))
        solver = C.Solver(C.ITEMS)
        pieces = [row[a:b] for a, b in zip([0, *cuts], [*cuts, len(row)], strict=True) if a < b]
        ends = C.Solver([solver.table(p) for p in pieces]).crossings(list(range(len(pieces))), C.NONE, C.TAIL)
        got, at = "", C.NONE
        for i, (piece, end) in enumerate(zip(pieces, ends, strict=True)):
            fixed = tuple(0 if s == end else C.FAR for s in range(4))
            got += C.edits_of(piece, solver.crossings(piece, at, fixed), at, i == len(pieces) - 1)[0]
            at = end
        assert got == C.edits_of(row, solver.crossings(row, C.NONE, C.TAIL), C.NONE, True)[0]


def test_repaired_messages_keep_texts_and_alternate(spark):
    rows = made(5, [4, 9, 0, 1, 8])
    out = defaultdict(list)
    for r in C.repaired(table(spark, rows)).collect():
        out[r["conv_id"]].append(r)
    audits = {k: v[6] for k, v in brute(rows).items()}
    for conv, audit in audits.items():
        mine = sorted(out[conv], key=lambda r: r["place"])
        assert [r["place"] for r in mine] == list(range(len(mine)))
        assert "".join(r["edit"] for r in mine) == audit.replace("D", "")
        assert re.fullmatch("(s?(ua)+)?", "".join(r["role"][0] for r in mine))
        assert all((r["turn"] is None and r["text"] == "") for r in mine if r["edit"] == "I")


def test_damage_and_lost_conversations(spark):
    rows = [*made(7, [6, 5, 6]), *[(c, 0, "user", "Only one.") for c in range(100, 160)], (500, None, None, None), (None, None, "user", "x.")]
    wanted = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        wanted += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    expected = brute(wanted)
    lost = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    got = reports(C.damage_report(table(spark, rows)))
    assert got == {c: expected.get(c, lost) for c in {r[0] for r in rows}}
    assert lost in got.values()


def test_empty_table_and_long_texts(spark):
    none = table(spark, [])
    assert C.report(none).collect() == [] and C.repaired(none).collect() == [] and C.damage_report(none).collect() == []
    rows = [(1, 0, "user", "word. " * 500_000), (1, 1, "assistant", " " * 2_000_000), (1, 2, "assistant", "!" + " " * 2_000_000)]
    assert reports(C.report(table(spark, rows))) == brute(rows)


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001"])
def test_query_against_search(spark, folder):
    rows = [tuple(r) for r in C.damaged(registry.table(spark, folder, "conversations")).collect()]
    got = reports(registry.op11_conversation_repair(spark, folder))
    for conv, report in brute(rows).items():
        assert got[conv] == report
