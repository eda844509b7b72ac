"""Conversation structure repair by a secondary-sorted stream.

Rows are repartitioned by conversation and sorted by turn, the last turn first; ``mapInPandas`` carries the state of a
dynamic programme from Arrow batch to Arrow batch.  Four numbers are carried: the least cost of what follows, if the
repaired dialogue so far is empty, or ends with a system, user or assistant turn.  For every row one byte is kept, the
cheapest edit in each of the four states; when the conversation's first row has arrived, the bytes are walked from the
first turn on, which gives the edits.  Bytes and texts that wait for this walk are spilled to an unnamed file of the
task beyond ``SPILL`` bytes (it goes with the task, which is simply run again if its executor is lost), so a giant
conversation needs a bounded part of memory, whatever its share of the rows.

A dialogue is well formed if the initials of its roles read ``(s?(ua)+)?``.  Edits: Keep a row (0), Rerole it to user or
assistant (1), Delete it (2; blank and duplicate rows must go), Insert an empty turn (5); a truncated row that stays
costs 5 more.  Of the cheapest edits those whose initials come first in ASCII are taken.  All possible next edits have
different initials, so this choice is made edit by edit.

Defined cases: a null role or text is one space; null turns come first and make no gaps; rows of one turn are ordered by
role and text; rows repeated in all columns are rows; null conv_id is a conversation of its own; a conversation that
lost all rows, or whose rows are all deleted, is repaired to nothing (the hash of the empty string); other columns of
the input are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from functools import lru_cache
from typing import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

# The costs of edits, and the damages by the remainder of a row's checksum.
DELETE, INSERT, KEEP, REROLE, TRUNCATED = 2, 5, 0, 1, 5
DROPPED, EMPTIED, UNSTOPPED, REPEATED, MISCAST, DAMAGES = 0, 1, 2, 3, 4, 20

#: Bytes of a conversation that wait in memory for the walk from its first turn.
SPILL = 16_000_000
#: Conversations, or repaired rows, of one output batch.
OUT_ROWS = 4_000

#: What a repaired dialogue ends with so far, and what can only be added to it (a system turn may also begin it).
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)
ROLES = ("", "system", "user", "assistant")
#: Edits in the order of their initials.
EDITS = "DIKR"
#: Least cost once no row is left.
AT_END = (0, 2 * INSERT, INSERT, 0)
#: What a row demands: no fault, truncated, or to be deleted.
SOUND, CUT_OFF, WASTE = range(3)
LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}

BLANK = r"^[\x20\x09-\x0D]*\z"
ENDED = r"[.!?][\x20\x09-\x0D]*\z"


def damaged(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, gone): rows harmed by the checksum of ``conv_id:turn``; ``gone`` ones only name their conversation."""
    plain = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    rest = F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn"))) % DAMAGES
    rows = turns.select("conv_id", "turn", plain("role").alias("role"), plain("text").alias("text"), rest.alias("harm"))
    harm = F.col("harm")
    text = F.when(harm == EMPTIED, F.lit("")).when(harm == UNSTOPPED, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.array_repeat(F.lit(0), F.when(harm == REPEATED, 2).otherwise(1))
    gone = harm == DROPPED
    return rows.select(
        "conv_id", "turn",
        F.when(harm == MISCAST, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(~gone, text).alias("text"),
        gone.alias("gone"),
        F.explode(copies).alias("copy"),
    ).drop("copy")


def with_faults(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, gone) in streaming order, with ``fault``: blank, duplicate, truncated or null.

    One shuffle by conversation serves the search for earlier equal rows, which is a running number, and the stream.
    """
    dealt = turns.select("conv_id", "turn", "role", "text", "gone").repartition("conv_id")
    seen = F.row_number().over(Window.partitionBy("conv_id", "gone", "role", "text").orderBy(F.col("turn").asc_nulls_first()))
    text = F.col("text")
    fault = (
        F.when(F.col("gone"), F.lit(None))
        .when(text.rlike(BLANK), "blank")
        .when(F.col("seen") > 1, "duplicate")
        .when(~text.rlike(ENDED), "truncated")
    )
    # Of equal rows of one turn the first seen is the first one.
    order = [F.col(name).desc_nulls_last() for name in ("turn", "role", "text", "seen")]
    return dealt.withColumn("seen", seen).withColumn("fault", fault).sortWithinPartitions(F.col("conv_id").asc_nulls_first(), *order)


@lru_cache(maxsize=None)
def step(after: tuple[int, ...], initial: int, demand: int) -> tuple[int, tuple[int, ...], int]:
    """One row further towards the front: (cost common to all states, what they cost beyond it, edit codes in two bits a state).

    ``after`` are costs beyond the cheapest state; there are few different ones, as no state is worse by more than some inserts.
    """
    extra = TRUNCATED if demand == CUT_OFF else 0
    best: list[tuple[int, int]] = []
    for state in range(4):
        options = [(DELETE + after[state], EDITS.index("D"))]
        if demand != WASTE:
            if initial == NEXT[state] or (state == EMPTY and initial == SYSTEM):
                options.append((KEEP + extra + after[initial], EDITS.index("K")))
            options.append((REROLE + extra + after[NEXT[state]], EDITS.index("R")))
        best.append(min(options))
    for _ in range(3):  # inserts before the row lead to the state whose edit comes next
        best = [min(best[state], (INSERT + best[NEXT[state]][0], EDITS.index("I"))) for state in range(4)]
    least = min(cost for cost, _ in best)
    code = sum(edit << 2 * state for state, (_, edit) in enumerate(best))
    return least, tuple(cost - least for cost, _ in best), code


class Stack:
    """Items read back in reverse; whole blocks of them wait in an unnamed file."""

    def __init__(self, limit: int) -> None:
        self.limit, self.held, self.size, self.file, self.ends = limit, [], 0, None, [0]

    def push(self, item: tuple, size: int) -> None:
        self.held.append(item)
        self.size += size
        if self.size > self.limit:
            self.file = self.file or tempfile.TemporaryFile()
            pickle.dump(self.held, self.file, pickle.HIGHEST_PROTOCOL)
            self.ends.append(self.file.tell())
            self.held, self.size = [], 0

    def reversed(self) -> Iterator[tuple]:
        yield from reversed(self.held)
        for begin in reversed(self.ends[:-1]):
            self.file.seek(begin)
            yield from reversed(pickle.load(self.file))

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


class Conversation:
    """What is known of a conversation while its rows arrive, the last turn first."""

    def __init__(self, conv_id: str | None, spill: int) -> None:
        self.conv_id = conv_id
        self.base, self.costs = 0, AT_END
        self.rows = Stack(spill)
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal, self.later = 0, None
        self.first = self.last = self.turn = None
        self.turns = 0

    def add(self, turn: str | None, role: str, text: str, fault: str | None) -> None:
        initial = {"s": SYSTEM, "u": USER, "a": ASSISTANT}.get(role[:1], EMPTY)
        demand = SOUND if fault is None else CUT_OFF if fault == "truncated" else WASTE
        if fault is not None:
            self.faults[fault] += 1
        if self.later is not None and (initial, self.later) not in LEGAL:
            self.illegal += 1
        self.later = initial
        if turn is not None:
            self.turns += turn != self.turn
            self.turn = turn
            self.first, self.last = turn, self.last if self.last is not None else turn
        cost, self.costs, code = step(self.costs, initial, demand)
        self.base += cost
        self.rows.push((code, turn, role, text), 100 + len(role) + len(text))

    @property
    def gaps(self) -> int:
        return 0 if self.first is None else int(self.last) - int(self.first) + 1 - self.turns

    @property
    def cost(self) -> int:
        return self.base + self.costs[EMPTY]

    def edits(self) -> Iterator[tuple[str, str | None, str, str]]:
        """(edit, turn, role afterwards, text) from the first turn on."""
        state = EMPTY
        for code, turn, role, text in self.rows.reversed():
            while (edit := EDITS[code >> 2 * state & 3]) == "I":
                state = NEXT[state]
                yield edit, None, ROLES[state], ""
            if edit == "K":
                state = SYSTEM if role[:1] == "s" else NEXT[state]
            elif edit == "R":
                state = NEXT[state]
                role = ROLES[state]
            yield edit, turn, role, text
        while AT_END[state]:
            state = NEXT[state]
            yield "I", None, ROLES[state], ""
        self.rows.close()


def _conversations(batches: Iterator[pd.DataFrame], spill: int) -> Iterator[Conversation]:
    """Every conversation of a sorted stream once its last row has come; one at a time is held."""
    now: Conversation | None = None
    for batch in batches:
        for conv_id, turn, role, text, gone, fault in zip(*(batch[c] for c in ("conv_id", "turn", "role", "text", "gone", "fault"))):
            if now is None or conv_id != now.conv_id:
                if now is not None:
                    yield now
                now = Conversation(conv_id, spill)
            if not gone:
                now.add(turn, role, text, fault)
    if now is not None:
        yield now


REPORT = (
    "conv_id string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)


def _stream(turns: DataFrame) -> DataFrame:
    # Whole numbers go as text: beside nulls pandas would make them floats.
    numbers = {name: F.col(name).cast("string") for name in ("conv_id", "turn")}
    return with_faults(turns).withColumns(numbers)


def report(turns: DataFrame, spill: int = SPILL) -> DataFrame:
    """One row per conversation of (conv_id, turn, role, text, gone): its faults, the cost and initials of its edits, the repaired dialogue's hash."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = []
        names = [part.split()[0] for part in REPORT.split(", ")]
        for now in _conversations(batches, spill):
            audit, digest, begun = bytearray(), hashlib.sha256(), False
            for edit, _, role, text in now.edits():
                audit += edit.encode()
                if edit != "D":
                    digest.update(f"{chr(10) if begun else ''}{role}:{text}".encode())
                    begun = True
            out.append((now.conv_id, now.gaps, *now.faults.values(), now.illegal, now.cost, audit.decode(), digest.hexdigest()))
            if len(out) >= OUT_ROWS:
                yield pd.DataFrame(out, columns=names)
                out = []
        if out:
            yield pd.DataFrame(out, columns=names)

    return _stream(turns).mapInPandas(rows, REPORT).withColumn("conv_id", F.col("conv_id").cast(turns.schema["conv_id"].dataType))


def repaired(turns: DataFrame, spill: int = SPILL) -> DataFrame:
    """The repaired dialogues: conv_id, place (from 0), edit (Keep, Rerole or Insert), turn (null if inserted), role, text."""
    names = {"K": "keep", "R": "rerole", "I": "insert"}

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        for now in _conversations(batches, spill):
            place = 0
            for edit, turn, role, text in now.edits():
                if edit == "D":
                    continue
                out.append((now.conv_id, place, names[edit], turn, role, text))
                place += 1
                if len(out) >= OUT_ROWS:
                    yield pd.DataFrame(out, columns=["conv_id", "place", "edit", "turn", "role", "text"])
                    out = []
        if out:
            yield pd.DataFrame(out, columns=["conv_id", "place", "edit", "turn", "role", "text"])

    done = _stream(turns).mapInPandas(rows, "conv_id string, place long, edit string, turn string, role string, text string")
    types = {name: F.col(name).cast(turns.schema[name].dataType) for name in ("conv_id", "turn")}
    return done.withColumns(types)


def intact(turns: DataFrame) -> DataFrame:
    """``turns`` as the operators here take them, without any damage."""
    blank = lambda name: F.coalesce(F.col(name), F.lit(" ")).alias(name)
    return turns.select("conv_id", "turn", blank("role"), blank("text"), F.lit(False).alias("gone"))
