"""Operator 13: repair of a conversation's turn structure by Hirschberg's divide and conquer.

Roles must read as an optional system turn and then pairs of user and assistant. What has been kept so far is in one of
four states: nothing, a system turn, a user turn that waits for its answer, a finished pair. Every row and every edit
moves between states at a cost, so a stretch of rows is a four by four table of least costs. Rows are kept, reroled or
deleted, and empty turns may be inserted; see ``COSTS``. Of equally cheap audits the ASCII-least is taken.

1. To repair rows lo to hi between two states, costs run forward from lo and backward from hi to the middle. The
   crossing is the state where their sum is least, and both halves are repaired by themselves: no table of all rows is
   kept. Forward vectors carry, beside the costs, the order of the states' least audits. No audit up to a row is the
   beginning of another, since each ends with that row's own edit, so this order decides between equal crossings.
2. Tables of stretches chain like those of rows. Conversations are dealt to tasks by their rows' sorted order, so a long
   one lies in many tasks, as chunks of bounded size. One row a chunk, its table, meets the others of its conversation;
   the same recursion over chunks gives each chunk its two states, and chunks are then repaired where they are.
   Conversations that begin and end within one task and one chunk, nearly all, are finished where they are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tesora.llm.common import ship, stored

COSTS = {"K": 0, "R": 1, "D": 2, "I": 5}
TRUNCATED_KEPT = 5
CHUNK_ROWS, CHUNK_BYTES = 2048, 1 << 20

NOTHING, SYSTEM, USER, PAIR = range(4)
FINAL = (NOTHING, PAIR)
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
_SPACE = " \t\n\x0b\x0c\r"
_NEXT = {NOTHING: (USER, "user"), SYSTEM: (USER, "user"), PAIR: (USER, "user"), USER: (PAIR, "assistant")}

# (from, to, cost, audit); the audit of a chunk's table is its place in the order of the audits from one state.
Step = tuple[tuple[int, int, int, object], ...]


def _kept(state: int, initial: str) -> int | None:
    if initial == "s":
        return SYSTEM if state == NOTHING else None
    return _NEXT[state][0] if initial == _NEXT[state][1][0] else None


def _least(moves: Sequence[tuple]) -> Step:
    best: dict[tuple[int, int], tuple] = {}
    for a, b, cost, audit in moves:
        if (a, b) not in best or (cost, audit) < best[a, b]:
            best[a, b] = (cost, audit)
    return tuple((a, b, *best[a, b]) for a, b in sorted(best))


def _inserted() -> list[tuple[int, int, int, str]]:
    """Up to two inserted turns from each state: more only return to a state met before."""
    found = []
    for start in range(4):
        state = start
        for n in range(3):
            found.append((start, state, n * COSTS["I"], "I" * n))
            state = _NEXT[state][0]
    return found


@lru_cache(maxsize=None)
def row_step(initial: str, fault: int) -> Step:
    """What a row and insertions before it can do."""
    moves, more = [], TRUNCATED_KEPT if fault == TRUNCATED else 0
    for a, b, cost, audit in _inserted():
        moves.append((a, b, cost + COSTS["D"], audit + "D"))
        if fault in (BLANK, DUPLICATE):
            continue
        moves.append((a, _NEXT[b][0], cost + COSTS["R"] + more, audit + "R"))
        if (to := _kept(b, initial)) is not None:
            moves.append((a, to, cost + COSTS["K"] + more, audit + "K"))
    return _least(moves)


def deleted_step(n: int) -> Step:
    """n further copies of a row, all of which must go."""
    return tuple((s, s, n * COSTS["D"], "D" * n) for s in range(4))


END: Step = _least(_inserted())


def forward(steps: Sequence[Step], lo: int, hi: int, start: int) -> dict[int, tuple[int, int]]:
    """state -> (least cost, place of its audit in the order of the states' audits) after steps lo to hi."""
    at = {start: (0, 0)}
    for i in range(lo, hi):
        best: dict[int, tuple] = {}
        for a, b, cost, audit in steps[i]:
            if a in at:
                found = (at[a][0] + cost, at[a][1], audit)
                if b not in best or found < best[b]:
                    best[b] = found
        order = sorted((place, audit, b) for b, (_, place, audit) in best.items())
        at = {b: (best[b][0], n) for n, (_, _, b) in enumerate(order)}
    return at


def backward(steps: Sequence[Step], lo: int, hi: int, end: int) -> dict[int, int]:
    """state -> least cost of going from it before step lo to ``end`` after step hi."""
    at = {end: 0}
    for i in range(hi - 1, lo - 1, -1):
        best: dict[int, int] = {}
        for a, b, cost, _ in steps[i]:
            if b in at and (a not in best or at[b] + cost < best[a]):
                best[a] = at[b] + cost
        at = best
    return at


def crossings(steps: Sequence[Step], start: int, end: int) -> list[int]:
    """The state after each step on the audit-least of the cheapest ways."""

    def between(lo: int, hi: int, a: int, b: int) -> list[int]:
        if hi - lo <= 1:
            return [b] * (hi - lo)
        mid = (lo + hi) // 2
        ahead, behind = forward(steps, lo, mid, a), backward(steps, mid, hi, b)
        _, _, meet = min((ahead[s][0] + behind[s], ahead[s][1], s) for s in ahead if s in behind)
        return between(lo, mid, a, meet) + between(mid, hi, meet, b)

    return between(0, len(steps), start, end)


def final_state(steps: Sequence[Step]) -> tuple[int, int]:
    """(cost, state) of the end of the audit-least of the cheapest ways through all steps."""
    at = forward(steps, 0, len(steps), NOTHING)
    cost, _, state = min((at[s][0], at[s][1], s) for s in FINAL if s in at)
    return cost, state


def table(steps: Sequence[Step]) -> Step:
    """A stretch as one step."""
    return tuple((a, b, *found) for a in range(4) for b, found in sorted(forward(steps, 0, len(steps), a).items()))


def audits(steps: Sequence[Step], start: int, end: int) -> list[str]:
    """Each step's part of the audit."""
    path = [start, *crossings(steps, start, end)]
    return [next(audit for x, y, _, audit in step if (x, y) == (a, b)) for step, a, b in zip(steps, path, path[1:])]


def messages(roles: Sequence[str | None], texts: Sequence[str | None], parts: Sequence[str], state: int) -> list[tuple[str, str]]:
    """(role, text) of what the audit leaves; each part has its insertions and then one row's edit."""
    out = []
    for role, text, part in zip(roles, texts, parts):
        for edit in part:
            if edit == "D":
                continue
            role_then = role if edit == "K" else _NEXT[state][1]
            state = _kept(state, role_then[:1]) if edit == "K" else _NEXT[state][0]
            out.append((role_then, "" if edit == "I" else text))
    return out


class _Chunk:
    """Rows of one conversation, in order."""

    def __init__(self) -> None:
        self.roles: list[str | None] = []
        self.texts: list[str | None] = []
        self.faults: list[int] = []
        self.copies: list[int] = []  # 0: a row; n: n more copies of the row before
        self.bytes = 0

    def add(self, role: str, text: str, copies: int, later: bool) -> None:
        rest = text.strip(_SPACE)
        fault = BLANK if not rest else DUPLICATE if later else TRUNCATED if rest[-1] not in ".!?" else SOUND
        self._append(role, text, fault, 0)
        if copies > 1:
            self._append(role, None, BLANK if fault == BLANK else DUPLICATE, copies - 1)
        self.bytes += len(role) + len(text)

    def _append(self, role: str, text: str | None, fault: int, copies: int) -> None:
        for values, value in ((self.roles, role), (self.texts, text), (self.faults, fault), (self.copies, copies)):
            values.append(value)


def _steps(roles: Sequence[str], faults: Sequence[int], copies: Sequence[int]) -> list[Step]:
    return [deleted_step(n) if n else row_step(role[:1], fault) for role, fault, n in zip(roles, faults, copies)]


def _tallies(chunk: _Chunk, turns: list[int]) -> dict:
    """What adds up over a conversation's chunks; ``turns`` are the distinct turns in order."""
    count = [0] * 4
    for fault, n in zip(chunk.faults, chunk.copies):
        count[fault] += n or 1
    initials = [role[:1] for role in chunk.roles]
    pairs = sum(max(n - 1, 0) for n in chunk.copies) + sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    return {
        "first_turn": turns[0] if turns else None, "last_turn": turns[-1] if turns else None, "turns": len(turns),
        "first_role": initials[0] if initials else None, "last_role": initials[-1] if initials else None,
        "blank": count[BLANK], "duplicate": count[DUPLICATE], "truncated": count[TRUNCATED], "illegal": pairs,
    }


_TALLIES = (
    "first_turn long, last_turn long, turns long, first_role string, last_role string, "
    "blank long, duplicate long, truncated long, illegal long"
)
_PIECE = "seg int, no int, cost long, audit string, messages array<struct<role: string, text: string>>, " + _TALLIES
_PART = _PIECE + ", whole boolean, roles array<string>, texts array<string>, faults array<int>, copies array<int>, moves array<array<long>>"


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): rows dropped (copies 0), emptied, cut, doubled or reroled by a checksum of conv_id and turn."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    how = F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn")).cast("binary")) % 20
    text = F.when(how == 1, "").when(how == 2, F.regexp_replace(name("text"), "[.!?]", "")).otherwise(name("text"))
    return conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.when(how == 4, "user").otherwise(name("role")).alias("role"),
        text.alias("text"),
        F.when(how == 0, 0).when(how == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def _ordered(turns: DataFrame) -> DataFrame:
    """Each different row once with its copies, sorted over all tasks, and whether its role and text were there at an earlier turn."""
    rows = turns.select(
        "conv_id",
        *[F.when(F.col("copies") > 0, F.col(c)).alias(c) for c in ("turn", "role", "text")],
        "copies",
    )
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies")).withColumn("digest", F.sha2("text", 256))
    when = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn"))  # null turns come first
    again = rows.filter("role IS NOT NULL").groupBy("conv_id", "role", "digest").agg(F.min(when).alias("first"), F.count("*").alias("n"))
    again = again.filter("n > 1").select(*[F.col(c).alias(f"_{c}") for c in ("conv_id", "role", "digest")], "first")
    same = F.col("conv_id").eqNullSafe(F.col("_conv_id")) & (F.col("role") == F.col("_role")) & (F.col("digest") == F.col("_digest"))
    marked = rows.join(again, same, "left").select("conv_id", "turn", "role", "text", "copies", (F.col("first").isNotNull() & (when > F.col("first"))).alias("later"))
    order = [F.asc_nulls_first(c) for c in ("conv_id", "turn", "role", "text")]
    return marked.repartitionByRange(*order).sortWithinPartitions(*order)


def _with_id(turns: DataFrame, rest: str) -> StructType:
    return StructType([turns.schema["conv_id"], *turns.sparkSession.createDataFrame([], rest).schema.fields])


def repair(turns: DataFrame, chunk_rows: int = CHUNK_ROWS, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Pieces of repaired conversations: conv_id, (seg, no) in order, cost, audit, messages (role, text) and tallies of faults.

    ``turns`` has (conv_id, turn, role, text, copies); role and text are not null, a row of no copies only names its
    conversation. A conversation's rows are ordered by turn (nulls first), role, text; equal rows stand together, and all
    but the first are duplicates. A null conv_id is one conversation. Costs belong to a conversation's last piece. No
    rows give no pieces. Further columns are ignored.
    """
    ship(turns.sparkSession)
    part_type, piece_type = _with_id(turns, _PART), _with_id(turns, _PIECE)
    part_arrow, piece_arrow = to_arrow_schema(part_type), to_arrow_schema(piece_type)

    def chunks(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        seg, no, out, held = TaskContext.get().partitionId(), 0, [], 0
        nobody = object()
        own, first, alone, chunk, turns_met = nobody, True, True, _Chunk(), []

        def close(whole: bool) -> None:
            """Ends a chunk; ``whole`` if it is all of its conversation."""
            nonlocal no, chunk, turns_met, held
            steps = _steps(chunk.roles, chunk.faults, chunk.copies)
            row = {"conv_id": own, "seg": seg, "no": no, "whole": whole, **_tallies(chunk, turns_met)}
            if whole:
                cost, end = final_state([*steps, END])
                parts = audits([*steps, END], NOTHING, end)
                left = messages([*chunk.roles, None], [*chunk.texts, None], parts, NOTHING)
                row |= {"cost": cost, "audit": "".join(parts), "messages": [{"role": r, "text": t} for r, t in left]}
            else:
                row |= {"roles": chunk.roles, "texts": chunk.texts, "faults": chunk.faults, "copies": chunk.copies, "moves": table(steps)}
            out.append(row)
            held += chunk.bytes
            no, chunk, turns_met = no + 1, _Chunk(), []

        for batch in source:
            for conv, turn, role, text, copies, later in zip(*[batch.column(i).to_pylist() for i in range(6)]):
                if own is nobody or conv != own:
                    if own is not nobody:
                        close(whole=alone and not first)
                        first = False
                    own, alone = conv, True
                elif len(chunk.roles) >= chunk_rows or chunk.bytes >= chunk_bytes:
                    close(whole=False)
                    alone = False
                if role is None:
                    continue
                chunk.add(role, text, copies, later)
                if turn is not None and (not turns_met or turns_met[-1] != turn):
                    turns_met.append(turn)
                if len(out) >= 2000 or held >= 8 * chunk_bytes:
                    yield pa.RecordBatch.from_pylist(out, part_arrow)
                    out, held = [], 0
        if own is not nobody:
            close(whole=False)  # the next task may hold more of it
        if out:
            yield pa.RecordBatch.from_pylist(out, part_arrow)

    def states(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, group, own = ["seg", "no", "entry", "exit", "closing", "cost"], [], None

        def finish() -> pa.RecordBatch:
            steps = [*[tuple(map(tuple, moves)) for _, _, moves in group], END]
            cost, end = final_state(steps)
            path = [NOTHING, *crossings(steps, NOTHING, end)]
            closing = next(audit for a, b, _, audit in END if (a, b) == (path[-2], path[-1]))
            last = len(group) - 1
            rows = [(seg, no, path[i], path[i + 1], closing if i == last else "", cost if i == last else 0) for i, (seg, no, _) in enumerate(group)]
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        for batch in source:
            for conv, seg, no, moves in zip(*[batch.column(i).to_pylist() for i in range(4)]):
                if group and conv != own:
                    yield finish()
                    group = []
                own = conv
                group.append((seg, no, moves))
        if group:
            yield finish()

    def rebuild(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for at in range(batch.num_rows):  # chunks are of bounded size
                row = batch.slice(at, 1).to_pylist()[0]
                parts = audits(_steps(row["roles"], row["faults"], row["copies"]), row["entry"], row["exit"])
                left = messages([*row["roles"], None], [*row["texts"], None], [*parts, row["closing"]], row["entry"])
                row |= {"cost": row["total"], "audit": "".join(parts) + row["closing"], "messages": [{"role": r, "text": t} for r, t in left]}
                yield pa.RecordBatch.from_pylist([{name: row[name] for name in piece_arrow.names}], piece_arrow)

    parts = stored(_ordered(turns).mapInArrow(chunks, part_type), "turns")
    pieces = piece_type.fieldNames()
    open_ones = parts.filter(~F.col("whole"))
    tables = open_ones.select("conv_id", "seg", "no", "moves").repartition("conv_id").sortWithinPartitions("conv_id", "seg", "no")
    known = tables.mapInArrow(states, "seg int, no int, entry int, exit int, closing string, cost long").withColumnRenamed("cost", "total")
    rebuilt = open_ones.join(known, ["seg", "no"]).mapInArrow(rebuild, piece_type)
    return parts.filter("whole").select(*pieces).unionByName(rebuilt)


def digests(pieces: DataFrame) -> DataFrame:
    """One row a conversation: conv_id, gaps, the numbers of faults, cost, audit and the SHA-256 of ``role:text`` lines.

    Pieces are streamed in order: a task holds one piece and the audit of one conversation, whatever its length.
    """
    ship(pieces.sparkSession)
    kind = _with_id(pieces, "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")
    arrow = to_arrow_schema(kind)

    def fold(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nobody = object()
        own, out = nobody, []

        def finish() -> None:
            gaps = total["last_turn"] - total["first_turn"] + 1 - total["turns"] if total["turns"] else 0
            found = {name: total[name] for name in ("blank", "duplicate", "truncated", "illegal", "cost")}
            out.append({"conv_id": own, "gaps": gaps, **found, "audit": "".join(audit), "repaired_sha256": sha.hexdigest()})

        for batch in source:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                if own is nobody or row["conv_id"] != own:
                    if own is not nobody:
                        finish()
                    own, audit, sha, start = row["conv_id"], [], hashlib.sha256(), ""
                    total = dict.fromkeys(("turns", "blank", "duplicate", "truncated", "illegal", "cost"), 0) | {"first_turn": None, "last_turn": None, "last_role": None}
                for name in ("turns", "blank", "duplicate", "truncated", "illegal", "cost"):
                    total[name] += row[name]
                if row["turns"]:
                    total["turns"] -= total["last_turn"] == row["first_turn"]
                    total["first_turn"] = row["first_turn"] if total["first_turn"] is None else total["first_turn"]
                    total["last_turn"] = row["last_turn"]
                if row["first_role"] is not None:
                    total["illegal"] += total["last_role"] is not None and total["last_role"] + row["first_role"] not in ("su", "ua", "au")
                    total["last_role"] = row["last_role"]
                audit.append(row["audit"])
                for message in row["messages"]:
                    sha.update((start + message["role"] + ":" + message["text"]).encode())
                    start = "\n"
            if len(out) >= 1000:
                yield pa.RecordBatch.from_pylist(out, arrow)
                out = []
        if own is not nobody:
            finish()
        if out:
            yield pa.RecordBatch.from_pylist(out, arrow)

    return pieces.repartition("conv_id").sortWithinPartitions("conv_id", "seg", "no").mapInArrow(fold, kind)
