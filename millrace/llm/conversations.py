"""Repair of the structure of conversations, streamed in turn order.

A conversation is well formed if it is empty or has an optional system turn and then pairs of
user and assistant turns. Turns can be kept, given another role, deleted or inserted, each at a
cost; a dynamic program over the four places in that form finds the cheapest edits.

Spark deals the rows out by conversation and sorts them by turn, ``mapInPandas`` carries the state
of the program from row to row across Arrow batches. The state, the costs of the four places relative to
the cheapest and the order of their edit strings, takes few values, so its transitions are
looked up in a table that fills as they occur. Per row one number of that table remains as
backpointer; from the end of a conversation they lead back to its edits. Backpointers and turns of a
conversation that outgrows its buffer go to a file in the shared scratch folder until then, so a
task holds one buffer, whatever the length of a conversation.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.files import open_input, open_store
from millrace.session import scratch_path

REPORT = (
    "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
    "cost bigint, audit string, repaired_sha256 string"
)
TURNS = "conv_id bigint, place bigint, edit string, role string, text string"

#: White space, ends of sentences, and which initials may follow each other.
WHITE = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")
LEGAL = ("su", "ua", "au")
#: Bytes of turns that a conversation holds in memory.
BUFFER_BYTES = 32 << 20

#: Places in the form: nothing yet, after the system turn, after a user's, after an assistant's.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
PLACES = 4
#: Where a user's or assistant's turn leads from a place, and its role.
NEXT = {EMPTY: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
NEVER = 1 << 60


@dataclass(frozen=True)
class Costs:
    """What edits cost; a turn that is cut off costs more unless it is deleted."""

    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5


class Program:
    """The dynamic program as an automaton over normalised states.

    A state is ``(costs, order)``: per place the cost above the cheapest one (``NEVER`` if out of reach) and
    the position of its edit string among those of all places. After equally many rows no edit
    string is the start of another, so strings compare by the order of where they come from and then by their new
    letters. Ties in cost go to the lesser string.
    """

    def __init__(self, costs: Costs):
        self.costs = costs
        first = ((0, NEVER, NEVER, NEVER), (0, 1, 2, 3))
        self.states = {first: 0}
        self.listed = [first]
        #: (state, kind of row) to (next state, cost added to all, number of the step)
        self.table: dict[tuple[int, int], tuple[int, int, int]] = {}
        #: step to its backpointers: per place (place before, letters)
        self.steps: list[list[tuple[int, str] | None]] = []

    @staticmethod
    def kind(initial: str, deleted: bool, truncated: bool) -> int:
        """What the program needs to know of a row, as a number."""
        return {"s": 0, "u": 1, "a": 2}.get(initial, 3) * 4 + 2 * deleted + truncated

    def _options(self, place: int, kind: int) -> Iterator[tuple[int, int, str]]:
        """``(next place, cost, letters)`` of a row; insertions come ahead of it."""
        initial, deleted, truncated = "sua?"[kind // 4], kind // 2 % 2, kind % 2
        yield place, self.costs.delete, "D"
        if deleted:
            return
        extra = self.costs.truncated * truncated
        if place == EMPTY and initial == "s":
            yield SYSTEM, extra, "K"
        # one insertion reaches the other role; with more of them a place comes back to itself
        for inserted in range(3):
            after = NEXT[place]
            spent = inserted * self.costs.insert + extra
            letters = "I" * inserted
            if initial == ROLE[after][0]:
                yield after, spent, letters + "K"
            yield after, spent + self.costs.rerole, letters + "R"
            place = after

    def step(self, state: int, kind: int) -> tuple[int, int, int]:
        """Next state, cost added to all places, number of the step."""
        costs, order = self.listed[state]
        best: list[tuple | None] = [None] * PLACES
        for place in range(PLACES):
            if costs[place] >= NEVER:
                continue
            for after, cost, letters in self._options(place, kind):
                found = (costs[place] + cost, order[place], letters, place)
                if best[after] is None or found < best[after]:
                    best[after] = found
        least = min(b[0] for b in best if b)
        strings = sorted(b[1:3] for b in best if b)
        new = (
            tuple(b[0] - least if b else NEVER for b in best),
            tuple(strings.index(b[1:3]) if b else PLACES for b in best),
        )
        if new not in self.states:
            self.states[new] = len(self.listed)
            self.listed.append(new)
        self.steps.append([(b[3], b[2]) if b else None for b in best])
        entry = self.table[state, kind] = (self.states[new], least, len(self.steps) - 1)
        return entry

    def end(self, state: int) -> tuple[int, int, str]:
        """Cost, last place and insertions at the end of a conversation."""
        costs, order = self.listed[state]
        found = []
        for place in range(PLACES):
            if costs[place] < NEVER:
                after, letters = place, ""
                for inserted in range(3):
                    if after in (EMPTY, ASSISTANT):
                        found.append((costs[place] + inserted * self.costs.insert, order[place], letters, place))
                    after, letters = NEXT[after], letters + "I"
        cost, _, letters, place = min(found)
        return cost, place, letters


class Conversation:
    """The rows of one conversation: what is counted, and turns and backpointers until its end."""

    def __init__(self, program: Program, folder: str, buffer_bytes: int):
        self.program, self.folder, self.buffer_bytes = program, folder, buffer_bytes
        self.n = self.blank = self.duplicate = self.truncated = self.illegal = self.cost = 0
        self.least_turn = self.last_turn = None
        self.n_turns, self.initial, self.state = 0, None, 0
        self.held: list[tuple[str, str]] = []
        self.steps: list[int] = []
        self.size, self.spill = 0, None

    def add(self, turn: int | None, role: str, text: str, fault: int) -> None:
        """``fault``: 0 none, 1 blank, 2 duplicate, 3 truncated."""
        initial = role[:1]
        self.blank += fault == 1
        self.duplicate += fault == 2
        self.truncated += fault == 3
        if self.n:
            self.illegal += self.initial + initial not in LEGAL
        self.initial = initial
        if turn is not None and turn != self.last_turn:
            self.n_turns += 1
            self.least_turn = turn if self.least_turn is None else self.least_turn
            self.last_turn = turn
        kind = self.program.kind(initial, fault in (1, 2), fault == 3)
        entry = self.program.table.get((self.state, kind)) or self.program.step(self.state, kind)
        self.state, added, step = entry
        self.cost += added
        self.n += 1
        self.held.append((role, text))
        self.steps.append(step)
        self.size += len(role) + len(text) + 100
        if self.size > self.buffer_bytes:
            self._spill()

    def _spill(self) -> None:
        self.spill = self.spill or Spill(f"{self.folder}/{uuid.uuid4().hex}")
        self.spill.add(self.held, self.steps)
        self.held, self.steps, self.size = [], [], 0

    def finish(self) -> Iterator[tuple[str, str, str]]:
        """``(edit, role, text)`` in order, deleted rows included, insertions in their places.

        Sets the cost. The edits are found from the end, block by block, and go forward after that.
        """
        cost, place, tail = self.program.end(self.state)
        self.cost += cost
        blocks = self._letters(place)
        place = EMPTY
        for letters, held in blocks:
            for own, (role, text) in zip(letters, held):
                for letter in own:
                    if letter == "D":
                        yield "D", role, text
                        continue
                    after = SYSTEM if letter == "K" and place == EMPTY and role[:1] == "s" else NEXT[place]
                    if letter == "K":
                        yield "K", role, text
                    else:
                        yield letter, ROLE[after], text if letter == "R" else ""
                    place = after
        for letter in tail:
            place = NEXT[place]
            yield letter, ROLE[place], ""
        if self.spill:
            self.spill.delete()

    def _letters(self, place: int) -> Iterator[tuple[list[str], list[tuple[str, str]]]]:
        """Blocks of edits and rows in order."""

        def back(steps: list[int], place: int) -> tuple[list[str], int]:
            out = []
            for step in reversed(steps):
                place, letters = self.program.steps[step][place]
                out.append(letters)
            out.reverse()
            return out, place

        letters, place = back(self.steps, place)
        if self.spill:
            places = [place]  # at the end of every block, the last one first
            for steps in self.spill.steps_backwards():
                places.append(back(steps, places[-1])[1])
            for (held, steps), end in zip(self.spill.blocks(), reversed(places[:-1])):
                yield back(steps, end)[0], held
        yield letters, self.held


class Spill:
    """Blocks of turns and backpointers in files of the shared scratch folder."""

    def __init__(self, uri: str):
        self.uri = uri
        self.store, self.path = open_store(uri)
        self.store.create_dir(self.path, recursive=True)
        self.counts: list[int] = []

    def add(self, held: list[tuple[str, str]], steps: list[int]) -> None:
        parts = []
        for role, text in held:
            a, b = role.encode(), text.encode()
            parts += [struct.pack("<II", len(a), len(b)), a, b]
        for name, data in (("turns", b"".join(parts)), ("steps", np.array(steps, "<u4").tobytes())):
            with self.store.open_output_stream(f"{self.path}/{name}-{len(self.counts)}") as stream:
                stream.write(data)
        self.counts.append(len(steps))

    def _read(self, name: str, k: int) -> bytes:
        with open_input(f"{self.uri}/{name}-{k}") as stream:
            return stream.read()

    def _steps(self, k: int) -> list[int]:
        return np.frombuffer(self._read("steps", k), "<u4").tolist()

    def steps_backwards(self) -> Iterator[list[int]]:
        for k in reversed(range(len(self.counts))):
            yield self._steps(k)

    def blocks(self) -> Iterator[tuple[list[tuple[str, str]], list[int]]]:
        for k in range(len(self.counts)):
            data, at, held = self._read("turns", k), 0, []
            while at < len(data):
                a, b = struct.unpack_from("<II", data, at)
                at += 8
                held.append((data[at : at + a].decode(), data[at + a : at + a + b].decode()))
                at += a + b
            yield held, self._steps(k)

    def delete(self) -> None:
        self.store.delete_dir(self.path)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows damaged by the CRC of ``conv_id:turn`` modulo 20, a fixed rule for trying out the repair.

    0 drops a row, 1 empties its text, 2 takes its ends of sentences, 3 repeats it right behind,
    4 makes it the user's; others stay. A null role or text counts as one blank, and so does a null in
    the text of the CRC. A dropped row stays as a mark with a null role, so that its conversation is known.
    """
    blank = F.lit(" ")
    key = F.concat_ws(":", *[F.coalesce(F.col(f"`{c}`").cast("string"), blank) for c in ("conv_id", "turn")])
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), blank).alias("role"),
        F.coalesce(F.col("text").cast("string"), blank).alias("text"),
        (F.crc32(key) % 20).alias("damage"),
    )
    damage = F.col("damage")
    text = F.when(damage == 1, "").when(damage == 2, F.translate("text", "".join(ENDS), "")).otherwise(F.col("text"))
    role = F.when(damage == 0, F.lit(None)).when(damage == 4, "user").otherwise(F.col("role"))
    copies = F.when(damage == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        "conv_id",
        F.when(damage != 0, F.col("turn")).alias("turn"),
        role.alias("role"),
        F.when(damage != 0, text).alias("text"),
        F.explode(copies).alias("copy"),
    )


def with_faults(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, fault`` in one task a conversation, sorted by turn.

    Fault 1 is a text of white space, 2 a role and text that an earlier row of the conversation has, 3 a text
    that does not end a sentence, 0 none. Rows of the same turn follow each other by role and
    text. One shuffle: equal turns are found in a window that the same distribution serves.
    """
    if "copy" not in rows.columns:
        rows = rows.withColumn("copy", F.lit(0))
    trimmed = F.rtrim("text", F.lit(WHITE))
    order = [F.asc_nulls_first("turn"), F.asc("role"), F.asc("text"), F.asc("copy")]
    same = Window.partitionBy("conv_id", "role", "digest").orderBy(*order)
    dealt = rows.withColumn("digest", F.sha2("text", 256)).repartition("conv_id")
    fault = (
        F.when(F.col("role").isNull(), 0)
        .when(F.length(trimmed) == 0, 1)
        .when(F.col("nth") > 1, 2)
        .when(~F.right(trimmed, F.lit(1)).isin(*ENDS), 3)
        .otherwise(0)
    )
    return (
        dealt.withColumn("nth", F.row_number().over(same))
        .select("conv_id", "turn", "role", "text", fault.alias("fault"), "copy")
        .sortWithinPartitions(F.asc_nulls_first("conv_id"), *order)
        .drop("copy")
    )


def _streamed(rows: DataFrame, schema: str, costs: Costs, buffer_bytes: int, emit) -> DataFrame:
    """``emit(conversation id, conversation)`` gives output rows at the end of each conversation."""
    folder = scratch_path(rows.sparkSession, "conversations")
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        program, current, own, out = Program(costs), None, None, []

        def frame() -> pd.DataFrame:
            made = pd.DataFrame(out, columns=names, dtype=object)
            out.clear()
            return made

        for batch in batches:
            ids, turns = batch["conv_id"].astype(object), batch["turn"].astype(object)
            ids, turns = ids.where(ids.notna(), None), turns.where(turns.notna(), None)
            for conv_id, turn, role, text, fault in zip(ids, turns, batch["role"], batch["text"], batch["fault"]):
                if own is None or conv_id != current:
                    if own is not None:
                        for row in emit(current, own):
                            out.append(row)
                            if len(out) >= 1000:
                                yield frame()
                    current, own = conv_id, Conversation(program, folder, buffer_bytes)
                if role is not None:
                    own.add(turn if turn is None else int(turn), role, text, fault)
        if own is not None:
            for row in emit(current, own):
                out.append(row)
                if len(out) >= 1000:
                    yield frame()
        if out:
            yield frame()

    return with_faults(rows).mapInPandas(run, schema)


def repair_report(rows: DataFrame, costs: Costs = Costs(), buffer_bytes: int = BUFFER_BYTES) -> DataFrame:
    """One row per conversation: faults found, cost and letters of the cheapest edits, digest of the repair.

    ``rows`` has ``conv_id, turn, role, text`` and maybe ``copy``, the place among equal rows; a row with a null
    role only makes its conversation known. ``gaps`` counts missing turns between the least and the
    greatest, ``illegal`` neighbours whose initials are not ``su``, ``ua`` or ``au``. ``audit`` has the letters Keep, Rerole,
    Delete, Insert, the ASCII-least of all cheapest strings. ``repaired_sha256`` is of the repaired
    ``role:text`` joined by line ends. A conversation without rows has zeros, an empty audit and
    the digest of an empty text. Null ids make one conversation of their own, null turns come first and
    count for no gap; repeated rows are duplicates; an empty table gives no rows.
    """

    def emit(conv_id, own: Conversation):
        digest, letters, first = hashlib.sha256(), [], True
        for edit, role, text in own.finish():
            letters.append(edit)
            if edit != "D":
                digest.update((("" if first else "\n") + f"{role}:{text}").encode())
                first = False
        gaps = 0 if own.least_turn is None else own.last_turn - own.least_turn + 1 - own.n_turns
        counted = [gaps, own.blank, own.duplicate, own.truncated, own.illegal, own.cost]
        yield [conv_id, *counted, "".join(letters), digest.hexdigest()]

    return _streamed(rows, REPORT, costs, buffer_bytes, emit)


def repaired_turns(rows: DataFrame, costs: Costs = Costs(), buffer_bytes: int = BUFFER_BYTES) -> DataFrame:
    """``conv_id, place, edit, role, text`` of the repaired conversations; the input is that of :func:`repair_report`."""

    def emit(conv_id, own: Conversation):
        place = 0
        for edit, role, text in own.finish():
            if edit != "D":
                yield [conv_id, place, edit, role, text]
                place += 1

    return _streamed(rows, TURNS, costs, buffer_bytes, emit)


def damaged_and_repaired(conversations: DataFrame) -> DataFrame:
    """The report of every conversation of the table after :func:`damaged`."""
    return repair_report(damaged(conversations))
