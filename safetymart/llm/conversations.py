"""Cheapest repair of conversations, by Knuth's lightest-derivation agenda."""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema

from safetymart.llm.common import SPACES, shuffle_partitions, stored

# The costs of edits.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
# Rows, and bytes of text, of one conversation that a task holds at most.
SEGMENT_ROWS, SEGMENT_BYTES = 4096, 1 << 24

# Where a conversation stands: nothing yet, or the initial of its last role.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
# The initials that may come next and where they lead; an inserted or renamed role
# is the one in the second row.
NEXT = (
    {"s": AFTER_S, "u": AFTER_U},
    {"u": AFTER_U},
    {"a": AFTER_A},
    {"u": AFTER_U},
)
FORCED = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)
ROLE = {AFTER_U: "user", AFTER_A: "assistant"}

_FACTS = {
    **dict.fromkeys(("rows", "blank", "duplicate", "truncated", "illegal"), pa.int64()),
    **dict.fromkeys(("first_role", "last_role"), pa.string()),
    **dict.fromkeys(("first_turn", "last_turn", "turns"), pa.int64()),
}
_ITEM = {"p": pa.int32(), "q": pa.int32(), "cost": pa.int64(), "audit": pa.string()}
_SEGMENT = {
    "conv_id": pa.int64(),
    "part": pa.int32(),
    "seg": pa.int32(),
    **_FACTS,
    "items": pa.list_(pa.struct(list(_ITEM.items()))),
    "sha": pa.string(),
}
_REPAIR = {"conv_id": pa.int64(), **_FACTS, "cost": pa.int64(), "audit": pa.string()}
_TURN = {
    "conv_id": pa.int64(),
    "place": pa.int64(),
    **dict.fromkeys(("edit", "role", "text"), pa.string()),
}
_SHA = {"conv_id": pa.int64(), "sha": pa.string()}

# What a row is: to be deleted at once, or fine, or fine but cut short.
_DEAD, _FINE, _CUT = range(3)


def lightest(rows: list[tuple[str, int, int]], entry: int) -> dict[int, tuple[int, str]]:
    """The lightest (cost, audit) of each way through ``rows`` from ``entry``, by exit.

    A row is (initial, what it is, further copies of it, all to be deleted). Items are
    (rows used, place in the grammar). A row's possible edits and an insertion are
    axioms with weights (cost, letters); a deduction joins an item and one of them to
    the item behind, its weight is the sum of costs and the concatenation of letters.
    That function is monotone, and superior in its item: costs don't fall, and the
    letters grow at their end. So an item popped from the agenda is final. Equally
    dear derivations of one item are never prefixes of each other, as one of them
    would have insertions more. All exits are goals; when these are final the rest of
    the agenda is left.
    """
    n = len(rows)
    final: set[tuple[int, int]] = set()
    goals: dict[int, tuple[int, str]] = {}
    known = {(0, entry): (0, "")}
    agenda = [(0, "", 0, entry)]
    while agenda:
        cost, audit, i, q = heapq.heappop(agenda)
        if (i, q) in final:
            continue
        final.add((i, q))
        deductions = [(INSERT, "I", i, FORCED[q])]
        if i == n:
            goals[q] = (cost, audit)
        else:
            initial, what, copies = rows[i]
            more, letters = copies * DELETE, "D" * copies
            deductions.append((DELETE + more, "D" + letters, i + 1, q))
            if what != _DEAD:
                more += TRUNCATED * (what == _CUT)
                deductions.append((REROLE + more, "R" + letters, i + 1, FORCED[q]))
                if initial in NEXT[q]:
                    deductions.append((more, "K" + letters, i + 1, NEXT[q][initial]))
        for weight, letters, j, to in deductions:
            new = (cost + weight, audit + letters)
            if (j, to) not in final and ((j, to) not in known or new < known[j, to]):
                known[j, to] = new
                heapq.heappush(agenda, (*new, j, to))
    return goals


def best_end(ends: dict[int, tuple[int, str]]) -> tuple[int, str]:
    """The goal: no role at all, or an assistant's last."""
    return min(ends[q] for q in (START, AFTER_A) if q in ends)


class Replay:
    """Carries out an audit on the rows of a conversation, one after another."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state = audit, 0, START

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        """The empty turns that stand before the next row."""
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at, self.state = self.at + 1, FORCED[self.state]
            yield "I", ROLE[self.state], ""

    def row(self, role: str, text: str, copies: int) -> Iterator[tuple[str, str, str]]:
        """What ``copies`` equal rows become: the inserted turns and the first row."""
        yield from self.inserted()
        edit = self.audit[self.at]
        # Further copies are deleted in the same step as the first row's edit.
        self.at += copies
        if edit == "K":
            self.state = NEXT[self.state][role[:1]]
            yield edit, role, text
        elif edit == "R":
            self.state = FORCED[self.state]
            yield edit, ROLE[self.state], text


class _Digest:
    """SHA-256 of turns as ``role:text`` lines, joined by newlines."""

    def __init__(self) -> None:
        self.sha, self.any = hashlib.sha256(), False

    def add(self, turns: Iterator[tuple[str, str, str]]) -> None:
        for _, role, text in turns:
            self.sha.update(f"{chr(10) if self.any else ''}{role}:{text}".encode())
            self.any = True


def _prepared(rows: DataFrame) -> DataFrame:
    """Distinct rows (conv_id, turn, role, text) with their copies, faults and order."""
    trimmed = F.rtrim("text", F.lit(SPACES))
    last = F.right(trimmed, F.lit(1))
    counted = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    counted = counted.select(
        "*",
        F.when(trimmed == "", _DEAD).when(last.isin(*".!?"), _FINE).otherwise(_CUT).alias("what"),
        F.sha2(F.concat_ws(":", F.octet_length("role").cast("string"), "role", "text"), 256)
        .alias("content"),
    )
    counted = stored(counted, "turns")
    # Contents that come back in a later turn; no text moves for them.
    place = F.struct(F.col("turn").isNotNull().alias("set"), F.col("turn").alias("turn"))
    again = counted.filter("copies > 0").groupBy("conv_id", "content").agg(
        F.min(place).alias("first"), F.count(F.lit(1)).alias("n")
    )
    again = again.filter("n > 1").select(
        F.col("conv_id").alias("c"), F.col("content").alias("d"), "first"
    )
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("content") == F.col("d"))
    later = F.coalesce(place > F.col("first"), F.lit(False))
    return counted.join(again, same, "left").select(
        "conv_id", "turn", "role", "text", "copies", "what", later.alias("later")
    )


class _Segment:
    """The rows of one conversation that a task has gathered."""

    def __init__(self, conv_id: int | None, part: int, seg: int) -> None:
        self.conv_id, self.part, self.seg = conv_id, part, seg
        self.rows: list[tuple[str, int, int]] = []
        self.texts: list[tuple[str, str, int]] = []
        self.size = self.n = self.blank = self.duplicate = self.cut = self.illegal = 0
        self.first_role = self.last_role = None
        self.first_turn = self.last_turn = None
        self.turns = 0

    def add(self, turn, role: str, text: str, copies: int, what: int, later: bool) -> None:
        initial = role[:1]
        if self.last_role is not None:
            self.illegal += self.last_role + initial not in ("su", "ua", "au")
        else:
            self.first_role = initial
        self.illegal += copies - 1
        self.last_role = initial
        if turn is not None and turn != self.last_turn:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn, self.turns = turn, self.turns + 1
        if what == _DEAD:
            self.blank += copies
        else:
            self.duplicate += copies - (not later)
            self.cut += what == _CUT and not later
        self.n += copies
        self.rows.append((initial, _DEAD if later else what, copies - 1))
        self.texts.append((role, text, copies))
        self.size += len(text)

    def result(self, whole: bool, entered: bool) -> dict:
        """``whole``: no other task or segment has rows of it; ``entered``: others came before."""
        items, sha = [], None
        for p in range(4) if entered else (START,):
            found = lightest(self.rows, p)
            items += [{"p": p, "q": q, "cost": c, "audit": a} for q, (c, a) in found.items()]
            if whole:
                cost, audit = best_end(found)
                digest, replay = _Digest(), Replay(audit)
                for row in self.texts:
                    digest.add(replay.row(*row))
                digest.add(replay.inserted())
                items, sha = [{"p": p, "q": AFTER_A, "cost": cost, "audit": audit}], digest.sha.hexdigest()
        return {
            "conv_id": self.conv_id, "part": self.part, "seg": self.seg, "rows": self.n,
            "blank": self.blank, "duplicate": self.duplicate, "truncated": self.cut,
            "illegal": self.illegal, "first_role": self.first_role, "last_role": self.last_role,
            "first_turn": self.first_turn, "last_turn": self.last_turn, "turns": self.turns,
            "items": items, "sha": sha,
        }


def _ddl(columns: dict[str, pa.DataType]) -> T.StructType:
    return from_arrow_schema(pa.schema(list(columns.items())))


def _batches(rows: Iterator[dict], columns: dict[str, pa.DataType]) -> Iterator[pa.RecordBatch]:
    """Rows in batches of bounded size."""
    types, held, size = pa.schema(list(columns.items())), [], 0
    for row in rows:
        held.append(row)
        size += 200 + sum(len(x) for x in row.values() if isinstance(x, str))
        size += sum(len(i["audit"]) for i in row.get("items") or ())
        if size > 1 << 22:
            yield pa.RecordBatch.from_pylist(held, types)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, types)


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _segments(segment_rows: int):
    """Sorted rows of a range of conversations to segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held, first = None, True
        for part, conv_id, turn, role, text, copies, what, later in _records(batches):
            if held is None or held.conv_id != conv_id:
                if held is not None:  # only a task's first and last conversation go on elsewhere
                    cut = first or held.seg > 0
                    yield held.result(whole=not cut, entered=cut)
                    first = False
                held = _Segment(conv_id, part, 0)
            if not copies:
                continue
            full = len(held.rows) >= segment_rows or held.size + len(text) > SEGMENT_BYTES
            if full and held.rows:
                yield held.result(whole=False, entered=first or held.seg > 0)
                held = _Segment(conv_id, part, held.seg + 1)
            held.add(turn, role, text, copies, what, later)
        if held is not None:
            yield held.result(whole=False, entered=first or held.seg > 0)

    return lambda batches: _batches(run(batches), _SEGMENT)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments, sorted by conversation and place, to one repair for each conversation.

    The segments' items are axioms again, between the places at their two ends. All
    places of one end are known before those of the next, so that there is nothing
    to choose from but the four of them: the agenda is their minimum.
    """
    def done(total: dict, ends: dict[int, tuple[int, str]]) -> dict:
        cost, audit = best_end(ends)
        return {**total, "cost": cost, "audit": audit}

    def run() -> Iterator[dict]:
        total, ends = None, {}
        for record in _records(batches):
            s = dict(zip(_SEGMENT, record))
            items = [tuple(i.values()) for i in s.pop("items")]
            for unused in ("part", "seg", "sha"):
                s.pop(unused)
            if total is None or total["conv_id"] != s["conv_id"]:
                if total is not None:
                    yield done(total, ends)
                total, ends = s, {q: (c, a) for p, q, c, a in items if p == START}
                continue
            new: dict[int, tuple[int, str]] = {}
            for p, q, cost, audit in items:
                if p in ends:
                    weight = (ends[p][0] + cost, ends[p][1] + audit)
                    new[q] = min(new.get(q, weight), weight)
            ends = new
            if s["rows"]:
                if total["rows"]:
                    pair = total["last_role"] + s["first_role"]
                    total["illegal"] += pair not in ("su", "ua", "au")
                same = s["first_turn"] is not None and s["first_turn"] == total["last_turn"]
                total["turns"] += s["turns"] - same
                for name in ("rows", "blank", "duplicate", "truncated", "illegal"):
                    total[name] += s[name]
                for name in ("first_role", "first_turn"):
                    total[name] = s[name] if total[name] is None else total[name]
                for name in ("last_role", "last_turn"):
                    total[name] = total[name] if s[name] is None else s[name]
        if total is not None:
            yield done(total, ends)

    return _batches(run(), _REPAIR)


def _replayed(rows: DataFrame, repairs: DataFrame, turns: bool) -> DataFrame:
    """The repaired turns of conversations, or the digest of these: texts stream by.

    A conversation's audit comes first, then its rows in order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        replay = digest = None
        conv_id, place = None, 0

        def out(made: Iterator[tuple[str, str, str]]) -> Iterator[dict]:
            nonlocal place
            if not turns:
                digest.add(made)
                return
            for edit, role, text in made:
                yield {"conv_id": conv_id, "place": place, "edit": edit, "role": role, "text": text}
                place += 1

        for c, kind, _, role, text, copies in _records(batches):
            if kind == 0:
                if replay is not None:
                    yield from out(replay.inserted())
                    if not turns:
                        yield {"conv_id": conv_id, "sha": digest.sha.hexdigest()}
                conv_id, place, replay, digest = c, 0, Replay(text), _Digest()
            else:
                yield from out(replay.row(role, text, copies))
        if replay is not None:
            yield from out(replay.inserted())
            if not turns:
                yield {"conv_id": conv_id, "sha": digest.sha.hexdigest()}

    null = F.lit(None)
    audits = repairs.select(
        "conv_id", F.lit(0).alias("kind"), null.cast("bigint").alias("turn"),
        null.cast("string").alias("role"), F.col("audit").alias("text"),
        F.lit(0).cast("bigint").alias("copies"),
    )
    named = repairs.select(F.col("conv_id").alias("c")).distinct()
    of = F.col("conv_id").eqNullSafe(F.col("c"))
    kept = rows.filter("copies > 0").join(named, of, "left_semi").select(
        "conv_id", F.lit(1).alias("kind"), "turn", "role", "text", "copies"
    )
    both = audits.unionByName(kept).repartition("conv_id")
    both = both.sortWithinPartitions("conv_id", "kind", F.col("turn").asc_nulls_first(), "role", "text")
    columns = _TURN if turns else _SHA
    return both.mapInArrow(lambda batches: _batches(run(batches), columns), _ddl(columns))


def _given(conversations: DataFrame, copies: str | None) -> DataFrame:
    spaced = [F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")]
    return conversations.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        *spaced,
        (F.col(copies) if copies else F.lit(1)).cast("long").alias("copies"),
    )


def repair(
    conversations: DataFrame, copies: str | None = None, segment_rows: int = SEGMENT_ROWS
) -> DataFrame:
    """Faults and the cheapest repair of every conversation, one row for each conv_id.

    Rows (conv_id, turn, role, text) are taken by turn, nulls first, then by role and
    text; other columns are passed over. A null role or text is one space. Column
    ``copies`` tells how often a row stands there; with 0 it only names its
    conversation. A row's first fault counts: blank, duplicate (role and text seen
    before), truncated (does not end in ``.!?``). Blank and duplicate rows are deleted.
    A role's initial decides; an empty role can't be kept. conv_id and turn are whole
    numbers; others fail the job. Repaired conversations are
    empty, or end with an assistant after pairs of user and assistant, with one system
    row before them at most.

    Columns: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit (the
    edits' initials, of equally cheap ones the least), repaired_sha256 (of ``role:text``
    lines). A null conv_id is a conversation as any other. Without rows all counts are
    0, the audit is empty. An empty table gives no rows.

    Equal rows are counted before anything else, so that a row repeated any number of
    times is one. Rows are dealt by ranges of (conv_id, turn, role, text): a
    conversation of any length is spread over tasks, and cut into segments of at most
    ``segment_rows`` rows. A segment's lightest ways between any two places of the
    grammar are joined end to end afterwards. Only the audit, one letter a row, is ever
    whole in a task, four times over. SHA-256 has no parallel form: the texts of a
    conversation that was cut stream through one task, a batch at a time.
    """
    rows = stored(_prepared(_given(conversations, copies)), "rows")
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text"]
    dealt = rows.repartitionByRange(shuffle_partitions(rows), *order)
    dealt = dealt.sortWithinPartitions(*order).select(F.spark_partition_id().alias("part"), "*")
    found = stored(dealt.mapInArrow(_segments(segment_rows), _ddl(_SEGMENT)), "segments")
    first = F.col("items")[0]
    whole = found.filter("sha IS NOT NULL").select(
        "conv_id", *_FACTS, first["cost"].alias("cost"), first["audit"].alias("audit"), "sha"
    )
    parts = found.filter("sha IS NULL").repartition("conv_id")
    joined = parts.sortWithinPartitions("conv_id", "part", "seg").mapInArrow(_joined, _ddl(_REPAIR))
    joined = stored(joined, "joined")
    digests = _replayed(rows, joined, turns=False)
    digests = digests.withColumnRenamed("conv_id", "c").withColumnRenamed("sha", "s")
    cut = joined.join(digests, F.col("conv_id").eqNullSafe(F.col("c"))).select(
        "conv_id", *_FACTS, "cost", "audit", F.col("s").alias("sha")
    )
    counts = ("blank", "duplicate", "truncated", "illegal", "cost")
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns"), F.lit(0))
    return whole.unionByName(cut).select(
        "conv_id",
        gaps.cast("long").alias("gaps"),
        *(c for c in counts),
        "audit",
        F.col("sha").alias("repaired_sha256"),
    )


def repaired_turns(
    conversations: DataFrame, repairs: DataFrame, copies: str | None = None
) -> DataFrame:
    """The turns of repaired conversations: conv_id, place (from 0), edit, role, text.

    ``repairs`` comes from ``repair`` of the same rows. ``edit`` is the letter of the
    audit that the turn comes from; deleted rows are gone. Texts stream by, sorted
    within each conversation; none is gathered.
    """
    rows = _given(conversations, copies).groupBy("conv_id", "turn", "role", "text").agg(
        F.sum("copies").alias("copies")
    )
    return _replayed(rows, repairs, turns=True)


def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations`` with planted faults, by a checksum of ``conv_id:turn``.

    Of 20 remainders 0 drops the row, 1 empties its text, 2 removes its ``.!?``, 3
    repeats it and 4 makes its role ``user``. Nulls, also in the checksum, are one
    space. Column ``copies`` is 0, 1 or 2; of dropped rows only the conv_id is left.
    """

    def text(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    key = F.concat(text("conv_id"), F.lit(":"), text("turn"))
    fault = F.crc32(F.encode(key, "UTF-8")) % 20
    there = fault != 0
    changed = F.when(fault == 1, "").when(fault == 2, F.translate(text("text"), ".!?", ""))
    return conversations.select(
        "conv_id",
        F.when(there, F.col("turn")).alias("turn"),
        F.when(there, F.when(fault == 4, "user").otherwise(text("role"))).alias("role"),
        F.when(there, changed.otherwise(text("text"))).alias("text"),
        F.when(fault == 3, 2).when(there, 1).otherwise(0).alias("copies"),
    )
