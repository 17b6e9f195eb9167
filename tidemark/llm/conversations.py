"""Conversation structure repair: the cheapest edits that make turns alternate.

A conversation is well-formed if its roles begin with at most one system turn
and then alternate user and assistant, an assistant last, or if it is empty.
Rows may be kept, given the other role, deleted, and empty turns inserted, each
at a small whole cost (:data:`COST`).  Edits are ways in a graph whose nodes are
(row, what came last); Dial's bucket queue finds all distances to the end, and
the audit follows arcs that lose exactly their own cost, the least letter first.

Rows are dealt by ranges of (conv_id, turn), so that a conversation of any
length is spread over many tasks.  A task settles the conversations that lie
within its range; those at its two ends may go on elsewhere, and their rows are
passed on as segments.  For these, each segment gives the cost between every
two states, a fold from the back over these small tables gives each segment its
distances to the end, each segment then says where it leads from every state,
and a fold from the front says where it is entered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import store

#: Costs of the edits, and of a truncated row that stays.
COST = {"keep": 0, "rerole": 1, "delete": 2, "insert": 5, "truncated": 5}
#: What came last: nothing, a system turn, a user, an assistant.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: States in which a conversation may end.
ENDS = (0, None, None, 0)
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
#: The turn that may be made up in each state, the state it leads to, and its role.
NEXT = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}


def _arcs(initial: str, fault: int) -> list[list[tuple[str, int, int]]]:
    """By state, the edits of a row: letter, state after it, cost; in the order of letters."""
    late = COST["truncated"] if fault == TRUNCATED else 0
    out = []
    for s in range(4):
        arcs = [("D", s, COST["delete"])]
        if fault not in (BLANK, DUPLICATE):
            to = {"s": SYSTEM if s == NOTHING else None, "u": USER if NEXT[s] == USER else None, "a": ASSISTANT if NEXT[s] == ASSISTANT else None}.get(initial)
            if to is not None:
                arcs.append(("K", to, COST["keep"] + late))
            arcs.append(("R", NEXT[s], COST["rerole"] + late))
        out.append(arcs)
    return out


ARCS = {(i, f): _arcs(i, f) for i in ("s", "u", "a", "") for f in range(4)}
#: The same backwards: by state, the states before it and their costs.
BACK = {key: [[(s, c) for s in range(4) for _, to, c in arcs[s] if to == t] for t in range(4)] for key, arcs in ARCS.items()}
MADE_UP = [[s for s in range(4) if NEXT[s] == t] for t in range(4)]
#: More than any arc costs, and than the distances at one end differ.
BUCKETS = 32

Kinds = list[tuple[str, int]]


def distances(kinds: Kinds, ends: tuple[int | None, ...] = ENDS) -> list[int | None]:
    """Costs from each node (4 * row + state, one row more than there are) to the end, where each state costs ``ends``."""
    n = len(kinds)
    out: list[int | None] = [None] * (4 * n + 4)
    low = min(e for e in ends if e is not None)
    buckets: list[list[int]] = [[] for _ in range(BUCKETS)]
    waiting = 0
    for s, e in enumerate(ends):
        if e is not None:
            buckets[(e - low) % BUCKETS].append(4 * n + s)
            waiting += 1
    far = 0
    while waiting:
        bucket = buckets[far % BUCKETS]
        while bucket:
            node = bucket.pop()
            waiting -= 1
            if out[node] is not None:
                continue
            out[node] = far + low
            row, state = divmod(node, 4)
            for s in MADE_UP[state]:
                if out[4 * row + s] is None:
                    buckets[(far + COST["insert"]) % BUCKETS].append(4 * row + s)
                    waiting += 1
            if row:
                at = 4 * row - 4
                for s, cost in BACK[kinds[row - 1]][state]:
                    if out[at + s] is None:
                        (bucket if not cost else buckets[(far + cost) % BUCKETS]).append(at + s)
                        waiting += 1
        far += 1
    return out


def walk(kinds: Kinds, far: list[int | None], ends: tuple[int | None, ...] = ENDS, state: int = NOTHING) -> tuple[str, list[tuple[int, int]], int]:
    """The least letters of a cheapest way from ``state``; the turns it leaves (row or -1, role's state or -1 for its own); the state at the end."""
    n, row, letters, turns = len(kinds), 0, [], []
    while True:
        here = far[4 * row + state]
        if row == n and here == ends[state]:
            return "".join(letters), turns, state
        arcs = [] if row == n else ARCS[kinds[row]][state]  # D comes first, then I, then K and R
        for letter, to, cost in (*arcs[:1], ("I", NEXT[state], COST["insert"]), *arcs[1:]):
            at = row if letter == "I" else row + 1
            if far[4 * at + to] == here - cost:
                letters.append(letter)
                if letter != "D":
                    turns.append((-1 if letter == "I" else row, -1 if letter == "K" else to))
                row, state = at, to
                break



def damage(conversations: DataFrame) -> DataFrame:
    """The rows, a fifth of them damaged by a hash of conversation and turn; dropped ones stay as marks without text.

    Null roles and texts are one space, as are null ids and turns in the hash.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), space("role").alias("role"), space("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind").isin(0, 1), "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (F.col("kind") == 0).alias("gone"), times.alias("again")).drop("again")


def _fault(text: str, seen: bool) -> int:
    words = text.encode().split()
    return BLANK if not words else DUPLICATE if seen else SOUND if words[-1][-1:] in (b".", b"!", b"?") else TRUNCATED


TURN = pa.struct([("role", pa.string()), ("text", pa.string())])
PIECE = {
    "conv_id": pa.int64(), "part": pa.int32(), "low": pa.int64(), "high": pa.int64(), "turns": pa.int64(), "blank": pa.int64(), "duplicate": pa.int64(), "truncated": pa.int64(), "illegal": pa.int64(),
    "first": pa.string(), "last": pa.string(), "cost": pa.int64(), "audit": pa.string(), "repaired": pa.list_(TURN), "repaired_sha256": pa.string(),
}
ROW = {"conv_id": pa.int64(), "part": pa.int32(), "pos": pa.int64(), "turn": pa.int64(), "role": pa.string(), "text": pa.string(), "gone": pa.bool_()}
PIECE_SQL = "conv_id long, part int, low long, high long, turns long, blank long, duplicate long, truncated long, illegal long, first string, last string, cost long, audit string, repaired array<struct<role: string, text: string>>, repaired_sha256 string"
ROW_SQL = "pos long, turn long, role string, text string, gone boolean"
LEGAL = ("su", "ua", "au")


class Segment:
    """Consecutive rows (turn, role, text, whether it was seen before) of a conversation, without dropped ones."""

    def __init__(self, rows: list[tuple[int | None, str, str, bool]]):
        self.rows = rows
        self.faults = [_fault(text, seen) for _, _, text, seen in rows]
        self.initials = [role[:1] for _, role, _, _ in rows]
        self.kinds = [(i if i in ("s", "u", "a") else "", f) for i, f in zip(self.initials, self.faults)]

    def piece(self, ends: tuple[int | None, ...] = ENDS, state: int = NOTHING) -> dict:
        far = distances(self.kinds, ends)
        audit, turns, to = walk(self.kinds, far, ends, state)
        known = [turn for turn, *_ in self.rows if turn is not None]
        repaired = [{"role": self.rows[r][1] if s < 0 else ROLE[s], "text": self.rows[r][2] if r >= 0 else ""} for r, s in turns]
        return {
            "low": min(known, default=None), "high": max(known, default=None), "turns": len(set(known)), "blank": self.faults.count(BLANK), "duplicate": self.faults.count(DUPLICATE), "truncated": self.faults.count(TRUNCATED),
            "illegal": sum(a + b not in LEGAL for a, b in zip(self.initials, self.initials[1:])), "first": self.initials[0] if self.rows else None, "last": self.initials[-1] if self.rows else None,
            "cost": far[state] - ends[to], "audit": audit, "repaired": repaired,
        }


def _joined(turns: list[dict]) -> bytes:
    return "\n".join(f"{t['role']}:{t['text']}" for t in turns).encode()


def _unseen(rows: list[tuple]) -> list[tuple]:
    """Rows (turn, role, text) of a whole conversation, with whether each was seen before."""
    seen: set[tuple[str, str]] = set()
    return [(turn, role, text, (role, text) in seen or seen.add((role, text)) is not None) for turn, role, text in rows]


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of a range -> pieces of the conversations within it, and the rows of its first and last one."""
    schema = pa.schema([*PIECE.items(), *((k, t) for k, t in ROW.items() if k not in PIECE)])
    part, pos, first, now, own, out = TaskContext.get().partitionId(), 0, True, None, [], []

    def edge(rows: list[tuple]) -> list[dict]:
        return [{"conv_id": now, "part": part, "pos": p, "turn": t, "role": r, "text": x, "gone": g} for p, t, r, x, g in rows]

    def whole(rows: list[tuple]) -> dict:
        piece = Segment(_unseen([(t, r, x) for _, t, r, x, g in rows if not g])).piece()
        return {"conv_id": now, "part": part, "repaired_sha256": hashlib.sha256(_joined(piece["repaired"])).hexdigest(), **piece}

    def flush() -> pa.RecordBatch:
        ready = pa.RecordBatch.from_pylist(out, schema)
        out.clear()
        return ready

    begun = False
    for batch in batches:
        for conv_id, turn, role, text, gone in zip(*(c.to_pylist() for c in batch.columns)):
            if begun and conv_id != now:
                if first:
                    out.extend(edge(own))
                else:
                    out.append(whole(own))
                own, first = [], False
            begun, now = True, conv_id
            own.append((pos, turn, role, text, gone))
            pos += 1
            if first and len(own) >= 1000:  # perhaps a conversation that fills the range: nothing of it is kept back
                out.extend(edge(own))
                own = []
            if len(out) >= 1000:
                yield flush()
    out.extend(edge(own))
    yield flush()


def _segments(rows: DataFrame, work, added: dict[str, pa.DataType], schema: str) -> DataFrame:
    """Applies ``work(segment, ends, entry)`` to each part of a conversation in ``rows``, which may have ``ends`` and ``entry``."""
    into = pa.schema(list(added.items()))

    def apply(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["pos"])
        head = rows[0]
        segment = Segment([(r["turn"], r["role"], r["text"], r["seen"]) for r in rows if not r["gone"]])
        out = work(segment, *(x for x in (head.get("ends"), head.get("entry")) if x is not None))
        one = pa.Table.from_pylist([out], into)
        return one.add_column(0, "conv_id", pa.array([head["conv_id"]], pa.int64())).add_column(1, "part", pa.array([head["part"]], pa.int32()))

    return rows.groupBy("conv_id", "part").applyInArrow(apply, schema)


def _between(segment: Segment) -> dict:
    """Costs from each state before the segment to each state after it, row by row; -1 where there is no way."""
    to = [distances(segment.kinds, tuple(0 if s == t else None for s in range(4)))[:4] for t in range(4)]
    return {"costs": [-1 if to[t][s] is None else to[t][s] for s in range(4) for t in range(4)]}


def _exits(segment: Segment, ends: list[int]) -> dict:
    """The state in which the way ends from each state before the segment."""
    ends = tuple(None if e < 0 else e for e in ends)
    far = distances(segment.kinds, ends)
    return {"exits": [walk(segment.kinds, far, ends, s)[2] for s in range(4)]}


def _piece(segment: Segment, ends: list[int], entry: int) -> dict:
    return segment.piece(tuple(None if e < 0 else e for e in ends), entry)


def _folded(tables: DataFrame, fold, schema: str) -> DataFrame:
    """``fold`` over a conversation's segments in order; as many rows as ranges that it lies in, so a few thousand small ones at most."""
    added = "ends" if "ends" in schema else "entry"

    def apply(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["part"])
        values = pa.array(fold(rows), pa.list_(pa.int32()) if added == "ends" else pa.int32())
        return pa.table({"conv_id": pa.array([r["conv_id"] for r in rows], pa.int64()), "part": pa.array([r["part"] for r in rows], pa.int32()), added: values})

    return tables.groupBy("conv_id").applyInArrow(apply, schema)


def _ends(rows: list[dict]) -> list[list[int]]:
    out, now = [], [-1 if e is None else e for e in ENDS]
    for row in reversed(rows):
        out.append(now)
        costs = row["costs"]
        ways = [[costs[4 * s + t] + now[t] for t in range(4) if costs[4 * s + t] >= 0 and now[t] >= 0] for s in range(4)]
        now = [min(w, default=-1) for w in ways]
    return out[::-1]


def _entries(rows: list[dict]) -> list[int]:
    out, now = [], NOTHING
    for row in rows:
        out.append(now)
        now = row["exits"][now]
    return out


def _beside(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """``rows`` with what ``parts`` says of their segment."""
    known = parts.select(F.col("conv_id").alias("_conv"), F.col("part").alias("_part"), parts.columns[-1])
    return rows.join(known, rows["conv_id"].eqNullSafe(known["_conv"]) & (rows["part"] == known["_part"])).drop("_conv", "_part")


def repair(conversations: DataFrame) -> DataFrame:
    """``conversations(conv_id, turn, role, text[, gone])`` -> pieces of repaired conversations, in order of ``part``.

    A conversation that one task could settle is a single piece with
    ``repaired_sha256``; one that lies in several ranges has a piece for each.
    ``repaired`` has the turns that the piece leaves.  Rows count in the order of
    turn (null first), role and text; rows that are marked ``gone`` only keep
    their conversation in the result.  Roles and texts must not be null (see
    :func:`damage`); a null conv_id is a conversation like any other; repeated
    rows are duplicates; other columns are ignored; no rows give no pieces.
    """
    spark = conversations.sparkSession
    gone = F.col("gone") if "gone" in conversations.columns else F.lit(False)
    slim = conversations.select("conv_id", "turn", "role", "text", gone.alias("gone"))
    dealt = slim.repartitionByRange("conv_id", "turn").sortWithinPartitions("conv_id", "turn", "role", "text")
    settled = store.table(dealt.mapInArrow(_settle, f"{PIECE_SQL}, {ROW_SQL}"), "conversations")
    alone = settled.where("pos IS NULL").select(*PIECE)
    rows = settled.where("pos IS NOT NULL").select("conv_id", "part", "pos", "turn", "role", "text", "gone")
    same = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    keyed = rows.withColumn("same", same)
    first = keyed.where("NOT gone").groupBy(F.col("conv_id").alias("_conv"), F.col("same").alias("_same")).agg(F.min(F.struct("part", "pos")).alias("at"))
    seen = keyed.join(first, keyed["conv_id"].eqNullSafe(first["_conv"]) & (keyed["same"] == first["_same"]), "left").withColumn("seen", F.coalesce(F.struct("part", "pos") > F.col("at"), F.lit(False)))
    split = store.table(seen.select(*rows.columns, "seen"), "segments")
    ends = store.table(_folded(_segments(split, _between, {"costs": pa.list_(pa.int32())}, "conv_id long, part int, costs array<int>"), _ends, "conv_id long, part int, ends array<int>"), "ends")
    bound = _beside(split, ends)
    entry = store.table(_folded(_segments(bound, _exits, {"exits": pa.list_(pa.int32())}, "conv_id long, part int, exits array<int>"), _entries, "conv_id long, part int, entry int"), "entries")
    told = {k: t for k, t in PIECE.items() if k not in ("conv_id", "part", "repaired_sha256")}
    parts = _segments(_beside(bound, entry), _piece, told, PIECE_SQL.removesuffix(", repaired_sha256 string"))
    return alone.unionByName(parts.withColumn("repaired_sha256", F.lit(None).cast("string")))


SUMMARY = {k: pa.int64() for k in ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")} | {"audit": pa.string(), "repaired_sha256": pa.string()}
SUMMARY_SQL = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order -> a row per conversation; the hash goes on from piece to piece, so no conversation is held whole."""
    total, done = None, []
    low = high = last = None
    turns, audit, digest, begun = 0, [], hashlib.sha256(), False

    def close() -> dict:
        gaps = 0 if low is None else high - low + 1 - turns
        return {**total, "gaps": gaps, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}

    for batch in batches:
        for p in batch.to_pylist():
            if total is None or p["conv_id"] != total["conv_id"]:
                if total is not None:
                    done.append(close())
                total = {k: 0 for k in ("blank", "duplicate", "truncated", "illegal", "cost")} | {"conv_id": p["conv_id"]}
                low = high = last = None
                turns, audit, digest, begun = 0, [], hashlib.sha256(), False
            for k in ("blank", "duplicate", "truncated", "illegal", "cost"):
                total[k] += p[k]
            if p["low"] is not None:
                low, high = p["low"] if low is None else low, p["high"]
            turns += p["turns"]
            if p["first"] is not None:
                total["illegal"] += last is not None and last + p["first"] not in LEGAL
                last = p["last"]
            audit.append(p["audit"])
            if p["repaired"]:
                digest.update(b"\n" * begun + _joined(p["repaired"]))
                begun = True
    if total is not None:
        done.append(close())
    yield pa.RecordBatch.from_pylist(done, pa.schema(list(SUMMARY.items())))


def audit(pieces: DataFrame) -> DataFrame:
    """Pieces of :func:`repair` -> a row per conversation: gaps, faults, cost, audit and the hash of what is left.

    A conversation without rows has zeros, no edits and the hash of nothing.
    """
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0))
    alone = pieces.where("repaired_sha256 IS NOT NULL").withColumn("gaps", gaps).select(*SUMMARY)
    parts = pieces.where("repaired_sha256 IS NULL").repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return alone.unionByName(parts.mapInArrow(_summed, SUMMARY_SQL))
