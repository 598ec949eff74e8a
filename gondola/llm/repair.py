"""Repair of the structure of conversations by their cheapest edits.

A conversation is in order if its roles begin with the letters of ``(s?(ua)+)?``: perhaps a system turn, then user and assistant in turn. Edits of a
turn are Keep (0), Rerole to user or assistant (1) and Delete (2); Insert (5) puts an empty turn of user or assistant anywhere. Blank and duplicate
turns must be deleted; a truncated one that stays costs 5 more. Of the cheapest repairs the one with the ASCII-least letters of edits is taken.

Conversations are dealt to tasks and sorted by turn, last turn first. Read from its end, a conversation needs four numbers: what the rest costs from
each state of the pattern (nothing yet, after system, after user, after assistant). For every turn and state the best edit is noted, one byte a turn;
read forward again, the notes give the repair. Notes and turns of the conversation at hand wait in buffers that go to the task's scratch files
beyond ``SPOOL`` bytes, so the memory of a task does not follow the length of a conversation. The pattern and the texts' digest run along a whole
conversation, so one is never split over tasks.

Cases: null role and text are one blank; turns are in the order of turn (nulls first), role, text; a turn is a duplicate if role and text occur earlier in
that order; the first fault of a turn counts (blank, duplicate, truncated); null conversation ids are one conversation; a conversation all of
whose turns are ``dropped`` has a row of zeros; very long texts are spooled like others; an empty table gives an empty result; other columns are not
kept.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SPOOL = 4 << 20
RECENT = 1 << 15
OK, BLANK, DUPLICATE, TRUNCATED = range(4)
#: States: nothing yet, after a system, user, assistant turn. Whoever is not the system must be what comes next.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}
KEEP, REROLE, DELETE, INSERT, UNFINISHED = 0, 1, 2, 5, 5
#: In ASCII order, which is the order among equal costs.
LETTERS = "DIKR"
#: What is left to do behind the last turn: nothing if the pattern is complete, else inserts.
AT_END = (0, 2 * INSERT, INSERT, 0)


def after_keep(state: int, initial: str) -> int | None:
    """The state after a turn of this initial, None where the pattern does not allow it."""
    if initial == "s":
        return SYSTEM if state == EMPTY else None
    kind = {"u": USER, "a": ASSISTANT}.get(initial)
    return kind if kind is not None and NEXT[state] == kind else None


@lru_cache(1 << 14)
def step(initial: str, fault: int, rest: tuple[int, ...]) -> tuple[int, tuple[int, ...]]:
    """Before a turn: two bits for each state's best edit, and the costs from each state; ``rest`` are the costs behind the turn."""
    stays = UNFINISHED if fault == TRUNCATED else 0
    without = []
    for state in range(4):
        options = [(DELETE + rest[state], 0)]
        if fault not in (BLANK, DUPLICATE):
            kept = after_keep(state, initial)
            if kept is not None:
                options.append((KEEP + stays + rest[kept], 2))
            options.append((REROLE + stays + rest[NEXT[state]], 3))
        without.append(min(options))
    # An insert may be followed by one more.
    costs = [0] * 4
    for state in (USER, ASSISTANT, EMPTY, SYSTEM):
        other = NEXT[state]
        costs[state] = min(without[state][0], INSERT + (without[other][0] if state in (USER, ASSISTANT) else costs[other]))
    notes = 0
    for state in range(4):
        best = min((cost, letter) for cost, letter in (without[state], (INSERT + costs[NEXT[state]], 1)) if cost == costs[state])
        notes |= best[1] << (2 * state)
    return notes, tuple(costs)


class Backwards:
    """Bytes written in one order and read in the other, entry by entry."""

    def __init__(self, most: int = SPOOL):
        self.entries, self.sizes = tempfile.SpooledTemporaryFile(most), tempfile.SpooledTemporaryFile(most)
        self.total = 0

    def add(self, entry: bytes) -> None:
        self.entries.write(entry)
        self.sizes.write(len(entry).to_bytes(8, "little"))
        self.total += len(entry)

    def read(self, piece: int = RECENT) -> Iterator[bytes]:
        end, at = self.total, self.sizes.tell()
        while at:
            n = min(at, 8 * piece)
            at -= n
            self.sizes.seek(at)
            sizes = self.sizes.read(n)
            for i in range(n - 8, -1, -8):
                size = int.from_bytes(sizes[i : i + 8], "little")
                end -= size
                self.entries.seek(end)
                yield self.entries.read(size)

    def close(self) -> None:
        self.entries.close()
        self.sizes.close()


class Conversation:
    """What is known of a conversation of which the last turns have been seen."""

    def __init__(self, conv: str | None):
        self.conv = conv
        self.costs, self.base = AT_END, 0
        self.faults = [0] * 4
        self.illegal, self.later = 0, None
        self.highest = self.lowest = None
        self.distinct = 0
        self.turns = Backwards()

    def add(self, turn: int | None, role: str, text: str, fault: int) -> None:
        initial = role[:1]
        note, costs = step(initial if initial in ("s", "u", "a") else "", fault, self.costs)
        # Kept small, so that few different steps are computed.
        low = min(costs)
        self.base, self.costs = self.base + low, tuple(c - low for c in costs)
        self.faults[fault] += 1
        if self.later is not None and initial + self.later not in ("su", "ua", "au"):
            self.illegal += 1
        self.later = initial
        if turn is not None:
            self.highest = turn if self.highest is None else self.highest
            self.distinct += turn != self.lowest
            self.lowest = turn
        name = role.encode()
        self.turns.add(bytes([note]) + len(name).to_bytes(4, "little") + name + text.encode())

    def edits(self) -> Iterator[tuple[str, str | None, str | None]]:
        """Letter, and the role and text that come of it; deleted turns have none."""
        state = EMPTY
        for entry in self.turns.read():
            note, border = entry[0], 5 + int.from_bytes(entry[1:5], "little")
            role, text = entry[5:border], entry[border:]
            letter = LETTERS[note >> (2 * state) & 3]
            while letter == "I":
                state = NEXT[state]
                yield "I", ROLES[state], ""
                letter = LETTERS[note >> (2 * state) & 3]
            if letter == "D":
                yield "D", None, None
                continue
            name = role.decode()
            state = after_keep(state, name[:1]) if letter == "K" else NEXT[state]
            yield letter, name if letter == "K" else ROLES[state], text.decode()
        while state not in (EMPTY, ASSISTANT):
            state = NEXT[state]
            yield "I", ROLES[state], ""

    def summary(self) -> tuple:
        audit, digest, any_yet = [], hashlib.sha256(), False
        for letter, role, text in self.edits():
            audit.append(letter)
            if role is not None:
                digest.update(f"{chr(10) if any_yet else ''}{role}:{text}".encode())
                any_yet = True
        gaps = 0 if self.highest is None else self.highest - self.lowest + 1 - self.distinct
        return self.conv, gaps, *self.faults[1:], self.illegal, self.base + self.costs[EMPTY], "".join(audit), digest.hexdigest()


SUMMARY = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
WHITE = " \t\n\x0b\x0c\r"


def with_faults(turns: DataFrame, dropped: str | None = None) -> DataFrame:
    """conv (text), turn, role, text, nth, fault; ``dropped`` names a column of those that only keep their conversation in the result."""
    gone = F.coalesce(F.col(dropped), F.lit(False)) if dropped else F.lit(False)
    blank = F.lit(" ")
    rows = turns.select(
        F.col("conv_id").cast("string").alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        F.when(gone, "").otherwise(F.coalesce("role", blank)).alias("role"),
        F.when(gone, "").otherwise(F.coalesce("text", blank)).alias("text"),
        gone.alias("gone"),
    )
    same = Window.partitionBy("conv", "gone", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    rows = rows.withColumn("nth", F.row_number().over(same))
    said = F.rtrim("text", F.lit(WHITE))
    fault = (
        F.when(said == "", BLANK).when(F.col("nth") > 1, DUPLICATE)
        .when(~F.right(said, F.lit(1)).isin(".", "!", "?"), TRUNCATED).otherwise(OK)
    )
    return rows.withColumn("fault", fault)


def _streamed(turns: DataFrame, dropped: str | None) -> DataFrame:
    rows = with_faults(turns, dropped)
    order = [F.col("turn").desc_nulls_last(), F.desc("role"), F.desc("text"), F.desc("nth")]
    dealt = rows.repartition("conv").sortWithinPartitions("conv", *order)
    # Long columns with nulls would become floating-point numbers in pandas.
    return dealt.select("conv", F.coalesce("turn", F.lit(0)).alias("turn"), F.col("turn").isNotNull().alias("has_turn"), "role", "text", "fault", "gone")


def conversations(frames: Iterator[pd.DataFrame]) -> Iterator[Conversation]:
    """Each conversation once its first turn, the last to come, is seen; it may go on over any number of batches."""
    at = None
    for frame in frames:
        for conv, turn, has_turn, role, text, fault, gone in zip(*[frame[c].tolist() for c in frame.columns], strict=True):
            if at is None or conv != at.conv:
                if at:
                    yield at
                    at.turns.close()
                at = Conversation(conv)
            if not gone:
                at.add(turn if has_turn else None, role, text, fault)
    if at:
        yield at
        at.turns.close()


def summaries(turns: DataFrame, dropped: str | None = None) -> DataFrame:
    """One row a conversation: conv_id, numbers of faults, cost, letters of the edits in order, SHA-256 of the repaired ``role:text`` lines."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, size = [], 0
        for conversation in conversations(frames):
            rows.append(conversation.summary())
            size += len(rows[-1][7]) + 200
            if size > SPOOL:
                yield pd.DataFrame(rows, columns=SUMMARY)
                rows, size = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=SUMMARY)

    types = "conv string, " + ", ".join(f"{c} long" for c in SUMMARY[1:7]) + ", audit string, repaired_sha256 string"
    found = _streamed(turns, dropped).mapInPandas(run, types)
    return found.select(F.col("conv").cast(turns.schema["conv_id"].dataType).alias("conv_id"), *SUMMARY[1:])


def repaired(turns: DataFrame, dropped: str | None = None) -> DataFrame:
    """The edits of every conversation: conv_id, place (from 1), edit, and the role and text that come of it (null where a turn is deleted)."""
    names = ["conv", "place", "edit", "role", "text"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, size = [], 0
        for conversation in conversations(frames):
            for place, (letter, role, text) in enumerate(conversation.edits(), 1):
                rows.append((conversation.conv, place, letter, role, text))
                size += len(text or "") + 100
                if size > SPOOL:
                    yield pd.DataFrame(rows, columns=names)
                    rows, size = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=names)

    found = _streamed(turns, dropped).mapInPandas(run, "conv string, place long, edit string, role string, text string")
    return found.select(F.col("conv").cast(turns.schema["conv_id"].dataType).alias("conv_id"), *names[1:])
