"""Operator 13: conversation structure repair by bidirectional Dijkstra over the edit lattice.

A lattice node is (rows consumed, state): nothing written yet, or a system, user or
assistant turn written last.  Keep, rerole and delete lead to the next row, insert stays at
the row.  Forward and reverse heaps grow from both ends, always the one with the smaller
least cost; the search ends when the two least costs together exceed the best crossing, so
that every node of every cheapest path is settled on one side.  Of all crossings of the
best cost the least audit is then read off from the start, letter by letter.

``repair`` gives the repaired turns' digest, audit and fault counts of every conversation.

* Conversations of at most ``piece_rows`` rows are one bounded group each.
* Longer ones are never gathered: their rows are numbered by the distributed ordering
  helper and cut into pieces.  A piece yields the cheapest way, with its least audit, from
  each state to each state (inserts after its last row belong to the next piece, so ways
  are unique); one pass over these small tables, last piece first, picks the states at the
  borders; each piece then writes its repaired turns, and the digest of a conversation is
  carried from piece to piece.

Rows go by turn (nulls first), rows of one turn by role and then by the digest of their
text, repeated rows next to each other.  Edge cases: null texts and roles count as one
space, a null conversation id is a conversation of its own, conversations without rows
left get zeros, an empty audit and the digest of the empty string; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepframe.llm.common import cut_lineage, prepare
from prepframe.operators.ordering import ordered_totals

PIECE_ROWS = 1024
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3

# States and the turns that lead from one to the next.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
STEP = {(EMPTY, "s"): SYSTEM, (EMPTY, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
NEXT = {EMPTY: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}  # the one turn of user and assistant that fits
NAME = {"u": "user", "a": "assistant"}
FITTING = {"su", "ua", "au"}
SPACE = " \t\n\x0b\x0c\r"

# A row in the lattice: its role's initial, whether it must go, and what it costs to stay.
Row = tuple[str, bool, int]


def _onward(rows: list[Row], i: int, q: int, tail: bool) -> Iterator[tuple[str, int, tuple[int, int]]]:
    """(letter, cost, node) of every edit at a node, letters in ASCII order."""
    if i < len(rows):
        yield "D", DELETE, (i + 1, q)
    if i < len(rows) or tail:
        yield "I", INSERT, (i, STEP[q, NEXT[q]])
    if i < len(rows):
        own, gone, extra = rows[i]
        if not gone:
            if (q, own) in STEP:
                yield "K", KEEP + extra, (i + 1, STEP[q, own])
            if own != NEXT[q]:
                yield "R", REROLE + extra, (i + 1, STEP[q, NEXT[q]])


def _backward(rows: list[Row], i: int, q: int, tail: bool) -> Iterator[tuple[int, tuple[int, int]]]:
    """(cost, node) of every edit that ends at a node."""
    for p in range(4):
        if STEP[p, NEXT[p]] == q and (i < len(rows) or tail):
            yield INSERT, (i, p)
    if i:
        own, gone, extra = rows[i - 1]
        yield DELETE, (i - 1, q)
        if not gone:
            for p in range(4):
                if STEP.get((p, own)) == q:
                    yield KEEP + extra, (i - 1, p)
                if STEP[p, NEXT[p]] == q and own != NEXT[p]:
                    yield REROLE + extra, (i - 1, p)


def cheapest(rows: list[Row], start: int = EMPTY, goals: tuple[int, ...] = (EMPTY, ASSISTANT), tail: bool = True) -> tuple[int, str] | None:
    """Least cost, and the least audit of that cost, from ``start`` to one of ``goals``.

    Without ``tail`` nothing is inserted after the last row.  None if no way leads there."""
    n = len(rows)
    ahead, behind = {(0, start): 0}, {(n, q): 0 for q in goals}  # tentative costs
    settled_f: dict[tuple[int, int], int] = {}
    settled_b: dict[tuple[int, int], int] = {}
    # Ties go along the rows: an edit without cost always leads to the next row, so equals settle in the order of the ways.
    heap_f = [(0, 0, start)]
    heap_b = [(0, -n, q) for q in goals]
    heapq.heapify(heap_b)
    order: list[tuple[int, int]] = []
    best = None
    if start in goals and not n:
        best = 0
    while heap_f and heap_b and (best is None or heap_f[0][0] + heap_b[0][0] <= best):
        if heap_f[0][0] <= heap_b[0][0]:
            c, i, q = heapq.heappop(heap_f)
            if (i, q) in settled_f:
                continue
            settled_f[i, q] = c
            order.append((i, q))
            for _, w, node in _onward(rows, i, q, tail):
                if c + w < ahead.get(node, c + w + 1):
                    ahead[node] = c + w
                    heapq.heappush(heap_f, (c + w, *node))
                if node in behind and (best is None or c + w + behind[node] < best):
                    best = c + w + behind[node]
        else:
            c, i, q = heapq.heappop(heap_b)
            i = -i
            if (i, q) in settled_b:
                continue
            settled_b[i, q] = c
            for w, node in _backward(rows, i, q, tail):
                if c + w < behind.get(node, c + w + 1):
                    behind[node] = c + w
                    heapq.heappush(heap_b, (c + w, -node[0], node[1]))
                if node in ahead and (best is None or c + w + ahead[node] < best):
                    best = c + w + ahead[node]
    if best is None:
        return None
    # Forward nodes from which a crossing of the best cost can be reached, last settled first.
    goal = {(n, q) for q in goals}

    def leads(node: tuple[int, int], cost: int, marked: set) -> bool:
        if node in settled_b:
            return cost + settled_b[node] == best
        return settled_f.get(node) == cost and node in marked or node in goal and cost == best

    marked: set[tuple[int, int]] = set()
    for node in reversed(order):
        c = settled_f[node]
        if leads(node, c, marked) or any(leads(to, c + w, marked) for _, w, to in _onward(rows, *node, tail)):
            marked.add(node)
    # Least letter first; ways differ in letters, so the first choice that leads on is the least audit.
    node, cost, audit = (0, start), 0, []
    while not (node in goal and cost == best):
        for letter, w, to in _onward(rows, *node, tail):
            if leads(to, cost + w, marked):
                audit.append(letter)
                node, cost = to, cost + w
                break
        else:
            raise AssertionError("no way of the least cost")
    return best, "".join(audit)


def written(turns: list[tuple[str, str]], audit: str, start: int = EMPTY) -> list[str]:
    """The repaired ``role:text`` turns of an audit."""
    out, q, i = [], start, 0
    for letter in audit:
        if letter == "I":
            out.append(f"{NAME[NEXT[q]]}:")
            q = STEP[q, NEXT[q]]
            continue
        role, text = turns[i]
        i += 1
        if letter == "K":
            out.append(f"{role}:{text}")
            q = STEP[q, role[:1]]
        elif letter == "R":
            out.append(f"{NAME[NEXT[q]]}:{text}")
            q = STEP[q, NEXT[q]]
    return out


def fault(text: str) -> str:
    """'blank', 'truncated' or '' of a text alone."""
    kept = text.strip(SPACE)
    return "blank" if not kept else "" if kept[-1] in ".!?" else "truncated"


def _as_rows(turns: list[tuple[str, str]], repeated: list[bool]) -> tuple[list[Row], list[int]]:
    """Lattice rows, and the numbers of blank, duplicate and truncated ones."""
    rows, counts = [], [0, 0, 0]
    for (role, text), again in zip(turns, repeated):
        kind = fault(text)
        if kind == "blank":
            counts[0] += 1
        elif again:
            counts[1] += 1
        elif kind:
            counts[2] += 1
        rows.append((role[:1], kind == "blank" or again, TRUNCATED if kind == "truncated" else 0))
    return rows, counts


def _illegal(initials: list[str]) -> int:
    return sum(a + b not in FITTING for a, b in zip(initials, initials[1:]))


def damage(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, copy) after the damage; dropped rows stay with a null copy."""

    def part(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    d = F.crc32(F.concat(part(conv_col), F.lit(":"), part(turn_col))) % 20
    role, text = part(role_col), part(text_col)
    text = F.when(d == 1, F.lit("")).when(d == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    copies = F.when(d == 0, F.array(F.lit(None).cast("int"))).when(d == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return conversations.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.when(d == 4, F.lit("user")).otherwise(role).alias("role"),
        text.alias("text"), F.explode(copies).alias("copy"),
    )


OUT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_OUT_KINDS = [*[pa.int64()] * 6, pa.string(), pa.string()]
_OUT_NAMES = [c.split()[0] for c in OUT.split(", ")]


def _short(rows: DataFrame) -> DataFrame:
    """Repair of conversations that are one bounded group each."""
    key = rows.schema["conv_id"].dataType
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def one(group: list[dict]) -> tuple:
        kept = sorted((r for r in group if r["copy"] is not None), key=lambda r: (r["turn"] is not None, r["turn"] or 0, r["role"], r["mark"], r["copy"]))
        if not kept:
            return 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()
        turns, seen, repeated = [(r["role"], r["text"]) for r in kept], set(), []
        for t in turns:
            repeated.append(t in seen)
            seen.add(t)
        lattice, counts = _as_rows(turns, repeated)
        cost, audit = cheapest(lattice)
        known = {r["turn"] for r in kept if r["turn"] is not None}
        gaps = max(known) - min(known) + 1 - len(known) if known else 0
        digest = hashlib.sha256("\n".join(written(turns, audit)).encode()).hexdigest()
        return gaps, *counts, _illegal([x[0] for x in lattice]), cost, audit, digest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at, kind = [], None, None

        def batch(done: list) -> pa.RecordBatch:
            cols = [pa.array([d[0] for d in done], kind)] + [pa.array(c, k) for c, k in zip(zip(*[d[1] for d in done]), _OUT_KINDS)]
            return pa.RecordBatch.from_arrays(cols, names=["conv_id", *_OUT_NAMES])

        for b in batches:
            kind, done = b.schema.field("conv_id").type, []
            for r in b.to_pylist():
                if held and r["conv_id"] != at:
                    done.append((at, one(held)))
                    held = []
                at = r["conv_id"]
                held.append(r)
            if done:
                yield batch(done)
        if held:
            yield batch([(at, one(held))])

    laid = rows.repartition(parts, "conv_id").sortWithinPartitions("conv_id")
    return laid.mapInArrow(run, f"conv_id {key.simpleString()}, {OUT}")


def _grouped(df: DataFrame, keys: list[str], order: list, fn, schema: str) -> DataFrame:
    """``fn(key, iterator of rows)`` for every group of ``keys``, rows streamed in ``order``; fn yields output tuples."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = [c.split()[0] for c in schema.split(", ")]
    laid = df.repartition(parts, *keys).sortWithinPartitions(*keys, *order)
    first = df.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {}

        def stream():
            for b in batches:
                kinds["conv_id"] = b.schema.field("conv_id").type
                yield from b.to_pylist()

        for key, group in groupby(stream(), key=lambda r: tuple(r[k] for k in keys)):
            for row in fn(key, group):
                yield pa.RecordBatch.from_pylist(
                    [dict(zip(["conv_id", *names], [key[0], *row]))],
                    schema=pa.schema([("conv_id", kinds["conv_id"]), *[(n, {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}[c.split()[1]]) for n, c in zip(names, schema.split(", "))]]),
                )

    return laid.mapInArrow(run, f"conv_id {first}, {schema}")


def _long(rows: DataFrame, piece_rows: int) -> DataFrame:
    """Repair of long conversations: pieces of bounded size, chained by their states."""
    kept = rows.where("copy IS NOT NULL")
    placed = ordered_totals(kept, ["turn", "role", "mark", "copy"], partition_by=["conv_id"])
    placed = placed.withColumn("piece", F.floor((F.col("_rn") - 1) / piece_rows).cast("long"))
    first = placed.groupBy(F.col("conv_id").alias("_c"), F.col("role").alias("_r"), F.col("mark").alias("_m")).agg(F.min("_rn").alias("_first"))
    placed = placed.join(first, F.expr("conv_id <=> _c AND role = _r AND mark = _m"))
    placed = placed.select("conv_id", "role", "text", "_rn", (F.col("_rn") > F.col("_first")).alias("again"), "piece")
    ends = kept.groupBy("conv_id").agg(
        F.floor((F.count(F.lit(1)) - 1) / piece_rows).cast("long").alias("last"),
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps"),
    )
    mine = ends.select(F.col("conv_id").alias("_c"), "last")
    laid = cut_lineage(placed.join(mine, F.expr("conv_id <=> _c")).drop("_c"))

    def table(key, group):
        """The cheapest way from state to state of one piece, and its fault counts."""
        got = list(group)  # at most piece_rows rows
        turns = [(r["role"], r["text"]) for r in got]
        lattice, counts = _as_rows(turns, [r["again"] for r in got])
        tail = key[1] == got[0]["last"]
        initials = [x[0] for x in lattice]
        for a in range(4):
            for z in range(4):
                way = cheapest(lattice, a, (z,), tail)
                if way:
                    yield key[1], a, z, way[0], way[1], *(counts if a == z == 0 else (0, 0, 0)), _illegal(initials) if a == z == 0 else 0, initials[0], initials[-1]
                elif a == z == 0:
                    raise AssertionError("deleting all is always a way")

    ways = cut_lineage(_grouped(
        laid, ["conv_id", "piece"], ["_rn"], table,
        "piece long, a int, z int, cost long, audit string, blank long, duplicate long, truncated long, illegal long, head string, tail string",
    ))

    def chain(_key, group):
        """The states at the borders, from the last piece to the first: four costs are carried, four small numbers kept per piece."""
        costs, choice, total, between, after = {EMPTY: 0, ASSISTANT: 0}, [], [0, 0, 0, 0], 0, None
        for piece, options in groupby(group, key=lambda r: r["piece"]):
            new, best, head, tail = {}, {}, "", ""
            for r in options:
                head, tail = r["head"], r["tail"]
                for k, c in enumerate(("blank", "duplicate", "truncated", "illegal")):
                    total[k] += r[c]
                if r["z"] in costs:
                    offer = (r["cost"] + costs[r["z"]], r["audit"], r["z"])
                    best[r["a"]] = min(best.get(r["a"], offer), offer)
            for a, (c, _, z) in best.items():
                new[a] = c
            between += after is not None and tail + after not in FITTING
            costs, after = new, head
            choice.append((piece, {a: z for a, (_, _, z) in best.items()}))
        state = EMPTY
        for piece, step in reversed(choice):
            yield piece, state, step[state], total[0], total[1], total[2], total[3] + between, costs[EMPTY]
            state = step[state]

    borders = _grouped(ways, ["conv_id"], [F.desc("piece")], chain, "piece long, a int, z int, blank long, duplicate long, truncated long, illegal long, cost long")
    borders = cut_lineage(borders)
    chosen = borders.alias("b").join(
        ways.select("conv_id", "piece", "a", "z", "audit").alias("w"),
        F.expr("b.conv_id <=> w.conv_id AND b.piece = w.piece AND b.a = w.a AND b.z = w.z"),
    ).selectExpr("b.*", "w.audit")
    turns = laid.alias("t").join(chosen.select("conv_id", "piece", "a", "audit").alias("c"), F.expr("t.conv_id <=> c.conv_id AND t.piece = c.piece"))

    def write(key, group):
        got = list(group)  # at most piece_rows rows
        lines = written([(r["role"], r["text"]) for r in got], got[0]["audit"], got[0]["a"])
        yield key[1], got[0]["audit"], "\n".join(lines), bool(lines)

    pieces = _grouped(turns.selectExpr("t.*", "c.a", "c.audit"), ["conv_id", "piece"], ["_rn"], write, "piece long, audit string, lines string, some boolean")

    def digest(_key, group):
        h, audit, begun = hashlib.sha256(), [], False
        for r in group:
            audit.append(r["audit"])
            if r["some"]:
                h.update((b"\n" if begun else b"") + r["lines"].encode())
                begun = True
        yield "".join(audit), h.hexdigest()

    done = _grouped(pieces, ["conv_id"], ["piece"], digest, "audit string, repaired_sha256 string")
    facts = borders.where("piece = 0").drop("piece", "a", "z")
    out = rows.select("conv_id").distinct().alias("i").join(ends.alias("e"), F.expr("i.conv_id <=> e.conv_id"), "left")
    out = out.join(facts.alias("f"), F.expr("i.conv_id <=> f.conv_id"), "left").join(done.alias("d"), F.expr("i.conv_id <=> d.conv_id"), "left")
    zero = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("i.conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def repair(rows: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of
    every conversation of ``rows`` (conv_id, turn, role, text, copy; a null copy marks a dropped row)."""
    prepare(rows.sparkSession)
    rows = rows.select("conv_id", "turn", "role", "text", "copy", F.md5("text").alias("mark"))
    many = cut_lineage(rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > piece_rows).select(F.col("conv_id").alias("_c")))
    short = rows.join(many, F.expr("conv_id <=> _c"), "left_anti")
    if many.limit(1).count() == 0:
        return _short(short)
    return _short(short).union(_long(rows.join(many, F.expr("conv_id <=> _c"), "left_semi"), piece_rows))
