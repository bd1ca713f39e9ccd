"""Conversation structure repair: an auction finds the cheapest edits over a lattice of rows and role states.

Nodes are (rows consumed, state of the grammar ``(s?(ua)+)?``); arcs are Delete, Insert, Keep and Rerole with
their integer costs.  The auction keeps a price at every node and a path from the origin: the path is extended
along the cheapest arc while the price of its end allows it, otherwise the price rises to that arc's and the
path is contracted.  When the path arrives, prices are distances along every shortest path, whose arcs are
therefore tight, and the least edit string is traced along tight arcs.  Long conversations are solved in
blocks of rows from the last to the first, with the prices at a block's end as its sink arcs, so the work is
linear in the rows.
"""

from __future__ import annotations

import hashlib
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsekit.llm.common import SPACE, landed, per_process

KEEP, REROLE, DELETE, INSERT, CUT = 0, 2, 3, 2, 1
BLOCK = 16
#: Grammar states: nothing yet, after the system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Role that a rerole or an insertion gives in a state, and the state after it; a kept system row only opens.
EXPECTED, AFTER = "uuau", (USER, USER, ASSISTANT, USER)
ROLES = {"u": "user", "a": "assistant"}
MAX_SOLVED = 1 << 16
MARK = r"[.!?]"
NOT_BLANK = r"[^\x20\x09-\x0D]"


# --- the auction

def block_arcs(codes: str, to_go: tuple[int, ...] | None) -> list[list[tuple[str, int, int]]]:
    """Arcs (edit, cost, node) of a block, in the order of the edits' letters; node 4 * row + state.

    A code is a row's role initial (s, u, a, x for others), a capital if the row is truncated, or ``-``
    if it has to go.  The last node is the sink.  ``to_go`` has the distances from the states at the
    block's end; None ends the conversation, where rows may still be inserted.
    """
    m, sink = len(codes), 4 * (len(codes) + 1)
    arcs: list[list[tuple[str, int, int]]] = []
    for i in range(m + 1):
        for state in range(4):
            out = []
            if i < m:
                code = codes[i]
                extra = CUT * code.isupper()
                out.append(("D", DELETE, 4 * (i + 1) + state))
            if i < m or to_go is None:
                out.append(("I", INSERT, 4 * i + AFTER[state]))
            if i < m and code != "-":
                role = code.lower()
                if role == EXPECTED[state]:
                    out.append(("K", KEEP + extra, 4 * (i + 1) + AFTER[state]))
                elif role == "s" and state == START:
                    out.append(("K", KEEP + extra, 4 * (i + 1) + SYSTEM))
                out.append(("R", REROLE + extra, 4 * (i + 1) + AFTER[state]))
            if i == m and to_go is not None:
                out.append(("", to_go[state], sink))
            elif i == m and state in (START, ASSISTANT):
                out.append(("", 0, sink))
            arcs.append(out)
    arcs.append([])
    return arcs


def auction(arcs: list[list[tuple[str, int, int]]], prices: list[int], origin: int) -> None:
    """Raises ``prices`` until a path from ``origin`` reaches the last node.

    Prices have to satisfy price[i] <= cost + price[j] on every arc, which they then still do; the price of
    ``origin`` is its distance afterwards.  Every node has a path to the sink and no cycle is free.
    """
    sink, path = len(arcs) - 1, [origin]
    while path[-1] != sink:
        i = path[-1]
        best, j = min([(cost + prices[j], j) for _, cost, j in arcs[i]])
        if prices[i] < best:
            prices[i] = best
            if len(path) > 1:
                path.pop()
        else:
            path.append(j)


def block_prices(codes: str, to_go: tuple[int, ...] | None) -> tuple[int, ...]:
    """Converged prices of a block's nodes; those of its four first nodes are distances."""
    solved = per_process(("auctions",), dict)
    if (found := solved.get((codes, to_go))) is None:
        arcs = block_arcs(codes, to_go)
        prices = [0] * len(arcs)
        for origin in range(4):
            auction(arcs, prices, origin)
        if len(solved) >= MAX_SOLVED:
            solved.clear()
        found = solved[codes, to_go] = tuple(prices)
    return found


def trace(codes: str, to_go: tuple[int, ...] | None, state: int) -> tuple[str, int]:
    """The least edit string along tight arcs from a state at the block's start, and the state at its end.

    Tight arcs have no cycle; a node from which they do not lead to the sink is visited once.
    """
    arcs, prices = block_arcs(codes, to_go), block_prices(codes, to_go)
    sink, dead, path, edits = len(arcs) - 1, set(), [state], []
    tries = [iter(arcs[state])]
    while path[-1] != sink:
        i = path[-1]
        for edit, cost, j in tries[-1]:
            if prices[i] == cost + prices[j] and j not in dead:
                path.append(j)
                edits.append(edit)
                tries.append(iter(arcs[j]))
                break
        else:
            dead.add(path.pop())
            edits.pop()
            tries.pop()
    return "".join(edits), path[-2] % 4


def cheapest_edits(codes: str, block: int = BLOCK) -> tuple[int, str]:
    """(cost, audit) of a conversation's codes: the cheapest edits, of these the least string."""
    parts = [codes[i:i + block] for i in range(0, len(codes), block)] or [""]
    ends: list[tuple[int, ...] | None] = [None]  # of the blocks from the last one
    base = 0
    for part in reversed(parts):
        first = block_prices(part, ends[-1])[:4]
        least = min(first)
        base += least if len(ends) < len(parts) else 0
        ends.append(tuple(x - least for x in first))  # distances less the least one, so blocks are solved once
        cost = base + first[START] if len(ends) > len(parts) else 0
    state, audit = START, []
    for part, to_go in zip(parts, reversed(ends[:-1])):
        edits, state = trace(part, to_go, state)
        audit.append(edits)
    return cost, "".join(audit)


# --- rows

def _shown(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(" "))


def damaged(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, ...) -> the same with planted faults, and ``n`` equal rows as one row.

    The fault follows crc32 of ``conv_id:turn``: a fifth of the 20 remainders each drops the row, empties its
    text, takes its end marks, repeats it or makes it the user's.  Null roles and texts are one space.  A
    dropped row stays as ``n`` = 0, so that its conversation is known.
    """
    fault = F.pmod(F.crc32(F.concat(_shown(F.col("conv_id")), F.lit(":"), _shown(F.col("turn"))).cast("binary")), F.lit(20))
    text = _shown(F.col("text"))
    return turns.select(
        "conv_id", F.when(fault != 0, F.col("turn")).alias("turn"),
        F.when(fault == 0, "").when(fault == 4, "user").otherwise(_shown(F.col("role"))).alias("role"),
        F.when(fault.isin(0, 1), "").when(fault == 2, F.regexp_replace(text, MARK, "")).otherwise(text).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).cast("long").alias("n"))


def judged(rows: DataFrame) -> DataFrame:
    """Equal rows of a conversation as one, with their number ``n`` and the first fault of the first of them.

    -> (conv_id, turn, role, text, n, initial, fault): fault is blank, duplicate, truncated or none.  A row is
    a duplicate if its role and text come earlier; the earliest turn of a role and text is an aggregate joined
    back on (role and text, turn), so no key gathers the copies of a text.
    """
    counted = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n"))
    same = F.md5(F.concat(_shown(F.col("conv_id")), F.lit(":"), F.length("role"), F.lit(":"), "role", "text"))
    counted = counted.withColumn("same", same).withColumn("at", F.struct(F.col("turn").isNotNull().alias("known"), "turn"))
    first = counted.filter("n > 0").groupBy("same").agg(F.min("at").alias("at"))
    first = first.select("same", _shown(F.col("at")["turn"]).alias("place"), F.lit(True).alias("first"))
    joined = counted.withColumn("place", _shown(F.col("turn"))).join(first, ["same", "place"], "left")
    last = F.right(F.rtrim("text", F.lit(SPACE)), F.lit(1))
    fault = (F.when(~F.col("text").rlike(NOT_BLANK), "blank").when(F.col("first").isNull(), "duplicate")
             .when(~last.rlike(MARK), "truncated").otherwise("none"))
    return joined.select("conv_id", "turn", "role", "text", "n", F.substring("role", 1, 1).alias("initial"),
                         fault.alias("fault"))


def _in_order(rows: DataFrame, *before: str) -> DataFrame:
    """Each conversation in one task, in the order of its turns; a task reads it as a stream."""
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *before, F.col("turn").asc_nulls_first(), "role", "text")


def _runs(batches, names):
    """(conv_id, stream of rows) of sorted batches; a run may go over several batches."""
    rows = (row for batch in batches for row in zip(*[batch.column(c).to_pylist() for c in names]))
    return groupby(rows, key=lambda row: row[0])


PLAN = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string")
LEGAL = {"su", "ua", "au"}


def structure(rows: DataFrame) -> DataFrame:
    """Judged rows -> one row per conversation: gaps, counts of faults, illegal neighbours, cost and audit.

    A task holds one character a row of the conversation at hand, as its audit does, and no text.
    """
    def plan(batches):
        names = ("conv_id", "turn", "n", "initial", "fault")
        out = []
        for conv, run in _runs(batches, names):
            codes, counts, illegal, before = [], dict.fromkeys(("blank", "duplicate", "truncated", "none"), 0), 0, None
            low = high = turn_before = None
            turns = 0
            for _, turn, n, initial, fault in run:
                if not n:
                    continue
                if turn is not None and turn != turn_before:
                    low, high, turns, turn_before = turn if low is None else low, turn, turns + 1, turn
                illegal += (before is not None and before + initial not in LEGAL) + n - 1  # a row twice is never legal
                before = initial
                counts[fault] += 1
                counts["blank" if fault == "blank" else "duplicate"] += n - 1
                code = initial if initial in ("s", "u", "a") else "x"
                codes.append("-" if fault in ("blank", "duplicate") else code.upper() if fault == "truncated" else code)
                codes.append("-" * (n - 1))
            cost, audit = cheapest_edits("".join(codes))
            out.append((conv, high - low + 1 - turns if turns else 0, counts["blank"], counts["duplicate"],
                        counts["truncated"], illegal, cost, audit))
            if len(out) >= 1024:
                yield batch_of(out)
                out = []
        yield batch_of(out)

    types = [pa.int64()] * 7 + [pa.string()]

    def batch_of(out):
        columns = zip(*out) if out else [()] * 8
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)],
                                          [c.split()[0] for c in PLAN.split(", ")])

    ordered = _in_order(rows).select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                     "n", "initial", "fault")
    return ordered.mapInArrow(plan, PLAN)


def _walk(audit: str, rows):
    """(edit, role, row) of each edit that leaves a row; ``rows`` is read as it goes, ``n`` times each."""
    state, stream = START, (row for row in rows for _ in range(row[-1]))
    for edit in audit:
        row = None if edit == "I" else next(stream)
        if edit == "D":
            continue
        if edit == "K" and state == START and row[0][:1] == "s":
            state = SYSTEM
            yield row[0], row[1]
            continue
        role = ROLES[EXPECTED[state]]
        state = AFTER[state]
        yield (role, "") if row is None else (row[0] if edit == "K" else role, row[1])


def _repaired(rows: DataFrame, plans: DataFrame, emit, schema: str) -> DataFrame:
    """``emit(conv_id, audit, kept rows)`` for each conversation, whose audit comes before its rows."""
    header = plans.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"),
                          F.lit("").alias("role"), F.col("audit").alias("text"), F.lit(0).cast("long").alias("n"))
    body = rows.filter("n > 0").select(F.col("conv_id").cast("long").alias("conv_id"), F.lit(1).alias("kind"),
                                       F.col("turn").cast("long").alias("turn"), "role", "text", "n")

    def repair(batches):
        for conv, run in _runs(batches, ("conv_id", "role", "text", "n")):
            audit = next(run)[2]
            yield from emit(conv, _walk(audit, ((role, text, n) for _, role, text, n in run)))

    return (_in_order(header.unionByName(body), "kind").select("conv_id", "role", "text", "n")
            .mapInArrow(repair, schema))


def repaired_turns(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """The conversations after their edits: (conv_id, turn from 0, role, text)."""
    def emit(conv, kept):
        part = []
        for turn, (role, text) in enumerate(kept):
            part.append((conv, turn, role, text))
            if len(part) >= 256:
                yield batch_of(part)
                part = []
        yield batch_of(part)

    def batch_of(part):
        columns = zip(*part) if part else [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string(), pa.string()))],
                                          ["conv_id", "turn", "role", "text"])

    return _repaired(rows, plans, emit, "conv_id long, turn long, role string, text string")


def repaired_digests(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of the repaired ``role:text`` joined by newlines, hashed as it is read."""
    def emit(conv, kept):
        digest, between = hashlib.sha256(), b""
        for role, text in kept:
            digest.update(between + f"{role}:{text}".encode())
            between = b"\n"
        yield pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array([digest.hexdigest()], pa.string())],
                                         ["conv_id", "repaired_sha256"])

    return _repaired(rows, plans, emit, "conv_id long, repaired_sha256 string")


def repair_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, ...) -> one row per conversation of the damaged rows: conv_id, gaps, blank,
    duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Rows are read by turn, nulls first, then role and text.  Null roles and texts are one space; rows without
    conv_id are the conversation null; repeated rows stand one after another, all but the first as
    duplicates; a conversation without rows has zeros, an empty audit and the hash of nothing; an empty table
    gives an empty result; other columns are not read.
    """
    rows = landed(judged(damaged(turns)), "judged")
    plans = landed(structure(rows), "plans")
    digests = repaired_digests(rows, plans)
    return plans.join(digests, plans["conv_id"].eqNullSafe(digests["conv_id"])).drop(digests["conv_id"])
