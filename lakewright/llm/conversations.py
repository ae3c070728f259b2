"""Conversation structure repair: the cheapest edits that make roles alternate, found by divide and conquer.

The roles of a repaired conversation are nothing, or pairs of user and
assistant, perhaps after one system message.  Its prefixes have four states:
empty, after system, after user, after assistant.  A row is kept, given the
role that is due, or deleted, and messages may be put in before it; each row is
thus a table of costs from state to state.  Hirschberg's method finds the edits
in linear space: a forward and a backward vector of four costs meet in the
middle, the best crossing is fixed, and both halves are solved alike.  Of equal
costs the crossing with the ASCII-least edits so far wins.  Edits up to a
crossing end with the edit of a row, so none of them is the start of another
and their order decides; the vectors carry that order as ranks, no edits.

Rows are sorted over all conversations in ranges, so a conversation may lie in
several; its piece in each range acts as one table of costs, the pieces'
crossings are found first, and all pieces are then solved apart.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shared_folder, stored

NONE, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: State after the role that is due in a state.
DUE = (USER, USER, ASSISTANT, USER)
#: Initials of roles, by number; any other initial is 3.
INITIALS = "sua"
FAULTS = ("", "blank", "duplicate", "truncated")
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
FAR = 1 << 60
#: Costs and edits that end a conversation, by state.
TAIL, TAIL_EDITS = (0, 2 * INSERT, INSERT, 0), ("", "II", "I", "")
BLANK = r"[\x20\x09-\x0D]"

Item = tuple[tuple[tuple[int, ...], ...], tuple[tuple[int, ...], ...]]
Vector = tuple[tuple[int, ...], tuple[int, ...]]


def row_edits(role: int, fault: int) -> dict[tuple[int, int], tuple[int, str]]:
    """Least (cost, edits) of a row from state to state: insertions, then Keep, Rerole or Delete."""
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for start in range(4):
        state = start
        for inserted in range(3):  # one more would come back to a state
            options = [(state, DELETE, "D")]
            if fault not in (1, 2):
                more = TRUNCATED if fault == 3 else 0
                options.append((DUE[state], REROLE + more, "R"))
                if role == DUE[state] - 1 or (role == 0 and state == NONE):
                    options.append((role + 1, KEEP + more, "K"))
            for end, cost, letter in options:
                found = (INSERT * inserted + cost, "I" * inserted + letter)
                best[start, end] = min(best.get((start, end), found), found)
            state = DUE[state]
    return best


def _item(edits: dict[tuple[int, int], tuple[int, str]]) -> Item:
    """Costs from state to state, and for each first state the order of the edits to the others."""
    costs = tuple(tuple(edits.get((s, t), (FAR, ""))[0] for t in range(4)) for s in range(4))
    order = tuple(tuple(sorted(range(4), key=lambda t: edits.get((s, t), (0, "~"))[1]).index(t) for t in range(4)) for s in range(4))  # noqa: B023
    return costs, order


#: By code, which is role + 4 * fault.
EDITS = [row_edits(code % 4, code // 4) for code in range(16)]
ITEMS = [_item(edits) for edits in EDITS]


def start_at(state: int) -> Vector:
    return tuple(0 if s == state else FAR for s in range(4)), (0, 1, 2, 3)


class Solver:
    """Crossings of rows of items; steps from vector to vector are worked out once and looked up afterwards."""

    def __init__(self, items: list[Item]):
        self.items = items
        self.ahead: dict[tuple[Vector, int], tuple[int, Vector]] = {}
        self.behind: dict[tuple[tuple[int, ...], int], tuple[int, tuple[int, ...]]] = {}

    def _step(self, vector: Vector, item: int) -> tuple[int, Vector]:
        (costs, ranks), (by, order) = vector, self.items[item]
        found = [min((costs[s] + by[s][t], ranks[s], order[s][t]) for s in range(4)) for t in range(4)]
        places = sorted(range(4), key=lambda t: found[t][1:])
        least = min(f[0] for f in found)
        return least, (tuple(FAR if f[0] >= FAR else f[0] - least for f in found), tuple(places.index(t) for t in range(4)))

    def forward(self, vector: Vector, row: list[int]) -> Vector:
        """Costs after the row, and the order of the edits that reach each state; costs are relative to the least."""
        return self.measured(vector, row)[1]

    def measured(self, vector: Vector, row: list[int]) -> tuple[int, Vector]:
        """The least cost, and the vector relative to it."""
        total, known = 0, self.ahead
        for item in row:
            step = known.get((vector, item))
            if step is None:
                step = known[vector, item] = self._step(vector, item)
            total, vector = total + step[0], step[1]
        return total, vector

    def backward(self, ends: tuple[int, ...], row: list[int]) -> tuple[int, ...]:
        """Costs from each state through the row, relative to the least."""
        known = self.behind
        for item in reversed(row):
            step = known.get((ends, item))
            if step is None:
                by = self.items[item][0]
                found = [min(by[s][t] + ends[t] for t in range(4)) for s in range(4)]
                least = min(found)
                step = known[ends, item] = (least, tuple(FAR if f >= FAR else f - least for f in found))
            ends = step[1]
        return ends

    def crossings(self, row: list[int], start: int, ends: tuple[int, ...]) -> list[int]:
        """State after each item of the row on the best way from ``start``; ``ends`` are costs that follow."""
        states = [0] * len(row)
        open_ = [(0, len(row), start, ends)] if row else []
        while open_:
            low, high, state, after = open_.pop()
            middle = (low + high + 1) // 2
            costs, ranks = self.forward(start_at(state), row[low:middle])
            rest = self.backward(after, row[middle:high])
            met = min((costs[s] + rest[s], ranks[s], s) for s in range(4))[2]
            states[middle - 1] = met
            if middle - low > 1:
                open_.append((low, middle, state, tuple(0 if s == met else FAR for s in range(4))))
            if high > middle:
                open_.append((middle, high, met, after))
        return states

    def table(self, row: list[int]) -> Item:
        """The row as one item."""
        costs, orders = [], []
        for s in range(4):
            least, (relative, ranks) = self.measured(start_at(s), row)
            costs.append(tuple(c if c >= FAR else c + least for c in relative))
            orders.append(ranks)
        return tuple(costs), tuple(orders)


def edits_of(codes: list[int], states: list[int], start: int, closed: bool) -> tuple[str, int]:
    """Edits and cost of rows that end in the given states; ``closed`` if the conversation ends there."""
    letters, total = [], 0
    for code, state in zip(codes, states, strict=True):
        cost, word = EDITS[code][start, state]
        letters.append(word)
        total, start = total + cost, state
    return "".join(letters) + (TAIL_EDITS[start] if closed else ""), total + (TAIL[start] if closed else 0)


def _marked(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, text (nulls as one space), and the digest that orders rows of one turn."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = messages.select("conv_id", F.col("turn").cast("long").alias("turn"), text("role").alias("role"), text("text").alias("text"))
    return rows.withColumn("mark", F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)))


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def _pieces(messages: DataFrame, folder: str) -> DataFrame:
    """(conv_id, part, codes, turns): roles and faults of the rows of each conversation in each range, in order.

    Texts stay behind: rows travel as role, fault and digest.
    """
    initial, filled = F.substring("role", 1, 1), F.col("text").rlike(rf"[^\x20\x09-\x0D]")
    role = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    fault = F.when(~filled, 1).when(~F.col("text").rlike(rf"[.!?]{BLANK}*+\z"), 3).otherwise(0)
    rows = _marked(messages).select("conv_id", "turn", "mark", role.cast("byte").alias("role"), fault.cast("byte").alias("fault"))
    ordered = rows.repartitionByRange("conv_id", "turn").sortWithinPartitions("conv_id", "turn", "mark")
    rows = stored(ordered.withColumn("id", F.monotonically_increasing_id()), f"{folder}/rows")
    # a first row meets itself by its number, so a row that is repeated very often makes no hot key
    firsts = rows.groupBy("conv_id", "mark").agg(F.min("id").alias("first")).select("first")
    fault = F.when((F.col("fault") != 1) & F.col("first").isNull(), 2).otherwise(F.col("fault"))
    coded = rows.join(firsts, F.col("id") == F.col("first"), "left").select("conv_id", "turn", "id", (F.col("role") + 4 * fault).cast("int").alias("code"))
    parts = coded.groupBy("conv_id", F.shiftright("id", 33).alias("part")).agg(F.sort_array(F.collect_list(F.struct("id", "code", "turn"))).alias("rows"))
    return stored(parts.select("conv_id", "part", F.col("rows.code").alias("codes"), F.col("rows.turn").alias("turns")), f"{folder}/pieces")


def _joints(pieces: DataFrame, folder: str) -> DataFrame:
    """(conv, piece, entry, exit, before) of conversations in several ranges: states at the pieces' ends, and the last role before a piece.

    At most one conversation crosses the border of two ranges, so there are at
    most two rows a range; they are the items of a second, small solution.
    """
    kind = dict(pieces.dtypes)["conv_id"]
    split = pieces.groupBy("conv_id").count().filter("count > 1").select(F.col("conv_id").alias("conv"))
    some = pieces.join(split, _same("conv_id", "conv"), "left_semi").select("conv_id", "part", "codes")

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        solver = Solver(ITEMS)
        for batch in batches:
            out = [solver.table(codes) for codes in batch.column(2).to_pylist()]
            costs, orders = (pa.array([[x for line in item[k] for x in line] for item in out], pa.list_(pa.int64())) for k in (0, 1))
            ends = [pa.array([codes[i] % 4 for codes in batch.column(2).to_pylist()], pa.int32()) for i in (0, -1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), costs, orders, *ends], names=["conv_id", "part", "costs", "orders", "first", "last"])

    def cross(df: pd.DataFrame) -> pd.DataFrame:
        df = df.sort_values("part", ignore_index=True)
        square = lambda flat: tuple(tuple(int(x) for x in flat[4 * s : 4 * s + 4]) for s in range(4))
        items = [(square(c), square(o)) for c, o in zip(df["costs"], df["orders"], strict=True)]
        states = Solver(items).crossings(list(range(len(items))), NONE, TAIL)
        before = [-1, *df["last"][:-1]]
        return pd.DataFrame({"conv": df["conv_id"], "piece": df["part"], "entry": [NONE, *states[:-1]], "exit": states, "before": before, "closed": [i == len(items) - 1 for i in range(len(items))]})

    summed = stored(some.mapInArrow(tables, f"conv_id {kind}, part long, costs array<long>, orders array<long>, first int, last int"), f"{folder}/tables")
    return stored(summed.groupBy("conv_id").applyInPandas(cross, f"conv {kind}, piece long, entry int, exit int, before int, closed boolean"), f"{folder}/joints")


def _solved(messages: DataFrame, folder: str) -> DataFrame:
    """(conv_id, part, edits, and figures) of each piece."""
    pieces = _pieces(messages, folder)
    kind = dict(pieces.dtypes)["conv_id"]
    joints = _joints(pieces, folder)
    whole = pieces.join(F.broadcast(joints), _same("conv_id", "conv") & (F.col("part") == F.col("piece")), "left")
    whole = whole.select("conv_id", "part", "codes", "turns", F.coalesce("entry", F.lit(NONE)).alias("entry"), F.coalesce("exit", F.lit(-1)).alias("exit"), F.coalesce("before", F.lit(-1)).alias("before"), F.coalesce("closed", F.lit(True)).alias("closed"))
    legal = {(0, 1), (1, 2), (2, 1)}

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        solver = Solver(ITEMS)
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                codes, turns = row["codes"], [t for t in row["turns"] if t is not None]
                ends = TAIL if row["exit"] < 0 else tuple(0 if s == row["exit"] else FAR for s in range(4))
                edits, cost = edits_of(codes, solver.crossings(codes, row["entry"], ends), row["entry"], row["closed"])
                roles = ([row["before"]] if row["before"] >= 0 else []) + [code % 4 for code in codes]
                faults = [code // 4 for code in codes]
                illegal = sum(pair not in legal for pair in zip(roles, roles[1:], strict=False))
                out.append({"conv_id": row["conv_id"], "part": row["part"], "edits": edits, "cost": cost, "illegal": illegal, **{name: faults.count(i) for i, name in enumerate(FAULTS) if i}, "low": min(turns, default=None), "high": max(turns, default=None), "turns": len(set(turns))})
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    arrow = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}
    columns = {"conv_id": arrow[kind], "part": pa.int64(), "edits": pa.string(), **{c: pa.int64() for c in ("cost", "illegal", *FAULTS[1:], "low", "high", "turns")}}
    schema = pa.schema(list(columns.items()))
    return stored(whole.mapInArrow(solve, ", ".join(f"{c} {kind if c == 'conv_id' else 'string' if c == 'edits' else 'long'}" for c in columns)), f"{folder}/edits")


def _rebuilt(messages: DataFrame, solved: DataFrame) -> DataFrame:
    """Messages of the repaired conversations; those of one conversation follow each other in one partition."""
    kind = dict(messages.dtypes)["conv_id"]
    none = lambda t: F.lit(None).cast(t)
    texts = _marked(messages).select("conv_id", none("long").alias("part"), "turn", "mark", "role", "text", none("string").alias("edits"))
    both = texts.unionByName(solved.select("conv_id", "part", none("long").alias("turn"), none("binary").alias("mark"), none("string").alias("role"), none("string").alias("text"), "edits"))
    # the edits of a conversation come before its messages
    both = both.repartition("conv_id").sortWithinPartitions("conv_id", F.col("part").asc_nulls_last(), "turn", "mark")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, edits, at, state, place = (), "", 0, NONE, 0

        def inserted(key):
            nonlocal at, state, place
            while at < len(edits) and edits[at] == "I":
                at, state = at + 1, DUE[state]
                yield key, place, None, "I", ROLES[state], ""
                place += 1

        def outcome(batch):
            nonlocal here, edits, at, state, place
            for key, turn, role, text, piece in zip(*(batch.column(i).to_pylist() for i in (0, 2, 4, 5, 6)), strict=True):
                if (key,) != here:
                    if here:
                        yield from inserted(here[0])
                    here, edits, at, state, place = (key,), "", 0, NONE, 0
                if piece is not None:
                    edits += piece
                    continue
                yield from inserted(key)
                letter, at = edits[at], at + 1
                if letter == "D":
                    continue
                if letter == "R":
                    state = DUE[state]
                    role = ROLES[state]
                else:
                    state = INITIALS.index(role[0]) + 1
                yield key, place, turn, letter, role, text
                place += 1

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=["conv_id", "place", "turn", "edit", "role", "text"])

        for batch in batches:
            if rows := list(outcome(batch)):
                yield batch_of(rows)
        if here and (rows := list(inserted(here[0]))):
            yield batch_of(rows)

    types = [{"int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}[kind], pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
    return both.mapInArrow(run, f"conv_id {kind}, place long, turn long, edit string, role string, text string")


def _figures(solved: DataFrame) -> DataFrame:
    """One row a conversation: gaps, fault counts, illegal neighbours, cost and edits of its pieces together."""
    edits = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "edits"))), lambda x: x["edits"]), "")
    sums = [F.sum(c).alias(c) for c in (*FAULTS[1:], "illegal", "cost")]
    gaps = F.coalesce(F.max("high") - F.min("low") + 1 - F.sum("turns"), F.lit(0)).alias("gaps")
    return solved.groupBy("conv_id").agg(gaps, *sums, edits.alias("audit"))


def repaired(messages: DataFrame) -> DataFrame:
    """(conv_id, place, turn, edit, role, text) of the repaired conversations of messages (conv_id, turn, role, text, ...).

    edit: K kept, R with another role, I put in (no turn, empty text); deleted
    messages are not there.  Rows go by turn, nulls first, and those of one
    turn by digest.  A null role or text is one space; a null conv_id is a
    conversation; repeated rows are duplicates; other columns are not read.  No
    messages: no rows.
    """
    return _rebuilt(messages, _solved(messages, shared_folder(messages.sparkSession, "repair")))


def report(messages: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of each conversation with messages.

    The digest runs over ``repaired`` messages as they come, so a long
    conversation is never held as a whole.  Nulls and ties as in ``repaired``.
    """
    solved = _solved(messages, shared_folder(messages.sparkSession, "repair"))
    kind = dict(messages.dtypes)["conv_id"]

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, state = (), None
        batch_of = lambda done: pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], arrow), pa.array([d[1] for d in done])], names=["conv", "repaired_sha256"])
        for batch in batches:
            done = []
            for key, role, text in zip(*(batch.column(i).to_pylist() for i in (0, 4, 5)), strict=True):
                if (key,) != here:
                    if here:
                        done.append((here[0], state.hexdigest()))
                    here, state = (key,), hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(f"{role}:{text}".encode())
            if done:
                yield batch_of(done)
        if here:
            yield batch_of([(here[0], state.hexdigest())])

    arrow = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}[kind]
    digests = _rebuilt(messages, solved).mapInArrow(digest, f"conv {kind}, repaired_sha256 string")
    empty = F.lit(hashlib.sha256().hexdigest())
    joined = _figures(solved).join(digests, _same("conv_id", "conv"), "left")
    return joined.select("conv_id", "gaps", *FAULTS[1:], "illegal", "cost", "audit", F.coalesce("repaired_sha256", empty).alias("repaired_sha256"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults by the CRC-32 of ``conv_id:turn`` modulo 20: rows dropped, emptied, without end marks, twice, or by the user."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), kind.alias("kind")).filter("kind > 0")
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    body = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", role.alias("role"), body.alias("text"), copies.alias("copy")).drop("copy")


def damage_report(conversations: DataFrame) -> DataFrame:
    """``report`` of damaged conversations, with a row also for those that lost all messages."""
    found = report(damaged(conversations)).withColumnRenamed("conv_id", "found")
    all_ = conversations.select("conv_id").distinct().join(found, _same("conv_id", "found"), "left")
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", *FAULTS[1:], "illegal", "cost")]
    return all_.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))


def _sql() -> str:
    steps = []
    for code, edits in enumerate(EDITS):
        for (start, end), (cost, word) in sorted(edits.items()):
            state, lines = start, []
            for _ in range(word.count("I")):
                state = DUE[state]
                lines.append(f"'{ROLES[state]}:'")
            role = "NULL" if word[-1] == "D" else f"'{ROLES[DUE[state]]}'" if word[-1] == "R" else "n.role"
            kept = "''" if word[-1] == "K" else role
            steps.append(f"({code}, {start}, {end}, {cost}, '{word}', [{', '.join(lines)}]::VARCHAR[], {kept})")
    tails = ", ".join(f"({s}, {TAIL[s]}, '{TAIL_EDITS[s]}', {x}::VARCHAR[])" for s, x in enumerate(("[]", "['user:', 'assistant:']", "['assistant:']", "[]")))
    return rf"""
WITH RECURSIVE tab AS (SELECT [list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) for n in range(256)] AS tab),
raw AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: ascii(x)::BIGINT)), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS k FROM conversations, tab),
dam AS (SELECT conv_id, turn, CASE k WHEN 4 THEN 'user' ELSE role END AS role, CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(CASE k WHEN 0 THEN []::INT[] WHEN 3 THEN [0, 1] ELSE [0] END) AS copy FROM raw),
pos AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(concat(length(role), ':', role, text))) AS i FROM dam),
flt AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 1 WHEN min(i) OVER (PARTITION BY conv_id, role, text) < i THEN 2 WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 3 ELSE 0 END AS fault FROM pos),
num AS MATERIALIZED (SELECT *, CASE role[1] WHEN 's' THEN 0 WHEN 'u' THEN 1 WHEN 'a' THEN 2 ELSE 3 END + 4 * fault AS code, concat(lag(role[1]) OVER w, role[1]) AS pair, row_number() OVER w > 1 AS later FROM flt WINDOW w AS (PARTITION BY conv_id ORDER BY i)),
tr AS (SELECT * FROM (VALUES {", ".join(steps).replace("n.role", "''")}) v(code, s, t, cost, word, pre, role)),
dp AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, 0 AS s, {{'cost': 0, 'audit': '', 'lines': []::VARCHAR[]}} AS b FROM num
  UNION ALL
  SELECT d.conv_id, n.i, tr.t, min({{'cost': d.b.cost + tr.cost, 'audit': d.b.audit || tr.word, 'lines': list_concat(d.b.lines, list_concat(tr.pre, CASE WHEN tr.role IS NULL THEN [] ELSE [CASE tr.role WHEN '' THEN n.role ELSE tr.role END || ':' || n.text] END))}})
  FROM dp d JOIN num n ON n.conv_id IS NOT DISTINCT FROM d.conv_id AND n.i = d.i + 1 JOIN tr ON tr.code = n.code AND tr.s = d.s GROUP BY d.conv_id, n.i, tr.t),
per AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
  count(*) FILTER (later AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM num GROUP BY conv_id),
fin AS (SELECT d.conv_id, min({{'cost': d.b.cost + v.cost, 'audit': d.b.audit || v.word, 'lines': list_concat(d.b.lines, v.lines)}}) AS b FROM dp d JOIN per p ON p.conv_id IS NOT DISTINCT FROM d.conv_id AND p.n = d.i JOIN (VALUES {tails}) v(s, cost, word, lines) ON v.s = d.s GROUP BY d.conv_id)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(b.cost, 0)::BIGINT AS cost, coalesce(b.audit, '') AS audit, sha256(coalesce(array_to_string(b.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN per p ON p.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN fin f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
"""


SQL = _sql()
