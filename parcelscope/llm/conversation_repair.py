"""Repair of the structure of conversations by a Viterbi search whose survivors coalesce.

A repaired conversation has the roles `(system? (user assistant)+)?`. Each row is kept, given the role user or
assistant, or deleted, and turns with an empty text are inserted, at the least cost; of edits that cost the
same, those whose initials D, I, K, R come first in ASCII. Rows without a visible character and rows whose
role and text have been seen before must go; a row that ends without a full stop costs more to keep.

After each row one survivor is left for each of four states: nothing yet, or the last role. The survivors are
the leaves of a tree of back pointers, in which a node that no survivor leads back to any more is dropped (its
references are counted), and once all survivors share a first step, that step is final and leaves the task.
So a task holds what is still open, not the conversation. A survivor leaves as soon as another can follow it
to any end at a strictly lower cost (`BEHIND`): it can win nothing, and deleting all rows stays no option. A run of rows that must be deleted is open at the
same places before and after it, and is one count at each leaf.

Two ways into one state that cost the same are compared by all their open initials. No such string begins
another: both have one initial for each row, and insertions stand before a row's own initial. So the order of
two survivors, once they differ, holds for all that follows them, and ranks of the survivors carry it: a way
is compared by its survivor's rank, then by what the row adds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
KEEP, REROLE, DELETE, INSERT = 0, 3, 4, 3  # what an edit costs
TRUNCATED = 3  # what a kept truncated row costs besides
SPACE = " \t\n\x0b\x0c\r"
STOPS = ".!?"
LEGAL = {"su", "ua", "au"}
_NAMES = {"u": "user", "a": "assistant"}
_NEXT = {NOTHING: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
_ROWS = 2000  # rows of a batch handed on

SCHEMA = (
    "conv_id long, edit string, times long, role string, text string, "
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
)


@lru_cache(maxsize=None)
def _inserted(state: int) -> list[tuple[int, int, tuple[str, ...]]]:
    """(state, cost, roles) after no, one and two insertions; more would come back to a state at a higher cost."""
    out = [(state, 0, ())]
    for _ in range(2):
        at, cost, roles = out[-1]
        letter = next(x for x in _NEXT[at] if x in _NAMES)
        out.append((_NEXT[at][letter], cost + INSERT, (*roles, _NAMES[letter])))
    return out


@lru_cache(maxsize=None)
def steps(initial: str, truncated: bool) -> list[tuple[int, int, int, str, tuple[str, ...], str | None]]:
    """(from, to, cost, initials, inserted roles, the row's new role, None if kept or deleted): the best for each pair of states."""
    best: dict[tuple[int, int], tuple] = {}
    more = TRUNCATED if truncated else 0
    for state in range(4):
        found = [(state, DELETE, "D", (), None)]
        for at, cost, roles in _inserted(state):
            before = "I" * len(roles)
            if initial in _NEXT[at]:
                found.append((_NEXT[at][initial], cost + KEEP + more, f"{before}K", roles, None))
            for letter, name in _NAMES.items():
                if letter in _NEXT[at]:
                    found.append((_NEXT[at][letter], cost + REROLE + more, f"{before}R", roles, name))
        for to, cost, initials, roles, name in found:
            held = best.get((state, to))
            if held is None or (cost, initials) < held[:2]:
                best[state, to] = (cost, initials, roles, name)
    return [(a, b, *rest) for (a, b), rest in best.items()]


# What leads each state to an end: (cost, roles).
ENDS = {NOTHING: (0, ()), ASSISTANT: (0, ()), USER: (INSERT, ("assistant",)), SYSTEM: (2 * INSERT, ("user", "assistant"))}
# (state, other): what it costs at most to go on from `state` in place of `other`, whatever `other` goes on with. A kept
# system row is deleted instead, a missing turn inserted, and where `other` ends and `state` may not, a pair is inserted.
BEHIND = {
    (NOTHING, SYSTEM): 0, (NOTHING, USER): INSERT, (NOTHING, ASSISTANT): 0,
    (SYSTEM, NOTHING): 2 * INSERT, (SYSTEM, USER): INSERT, (SYSTEM, ASSISTANT): 2 * INSERT,
    (USER, NOTHING): INSERT + DELETE, (USER, SYSTEM): INSERT, (USER, ASSISTANT): INSERT,
    (ASSISTANT, NOTHING): DELETE, (ASSISTANT, SYSTEM): 0, (ASSISTANT, USER): INSERT,
}


class _Node:
    """A step of a survivor: edits that are not final, then rows that must go."""

    __slots__ = ("parent", "children", "edits", "deleted")

    def __init__(self, parent: _Node | None, edits: tuple = ()):
        self.parent, self.edits, self.deleted = parent, edits, 0
        self.children: list[_Node] = []  # four at most, and as many references
        if parent is not None:
            parent.children.append(self)


class Search:
    """The search over one conversation, row by row; `emit` gets the final edits (initial, times, role, text) in order."""

    def __init__(self, emit):
        self.emit = emit
        self.root = _Node(None)
        self.survivors = {NOTHING: (0, 0, self.root)}  # state -> (cost, rank, leaf)
        self.open, self.most_open = 0, 0  # nodes below the root

    def delete(self) -> None:
        """A row that must go."""
        for state, (cost, rank, leaf) in self.survivors.items():
            leaf.deleted += 1
            self.survivors[state] = (cost + DELETE, rank, leaf)
        self._settle()

    def row(self, role: str, text: str, truncated: bool) -> None:
        reached: dict[int, tuple] = {}
        for state, to, cost, initials, roles, name in steps(role[:1], truncated):
            held = self.survivors.get(state)
            if held is None:
                continue
            way = (held[0] + cost, held[1], initials, state, roles, name)
            if to not in reached or way[:3] < reached[to][:3]:
                reached[to] = way
        cheap = {to: way[0] for to, way in reached.items()}
        for state, other in BEHIND:
            if state in cheap and other in reached and cheap[other] > cheap[state] + BEHIND[state, other]:
                del reached[other]
        ranks = {place: k for k, place in enumerate(sorted((way[1], way[2]) for way in reached.values()))}
        before, after = self.survivors, {}
        for to, (cost, rank, initials, state, roles, name) in reached.items():
            edits = [("I", name_, "") for name_ in roles]
            edits.append(("D", None, None) if initials[-1] == "D" else (initials[-1], name or role, text))
            after[to] = (cost, ranks[rank, initials], _Node(before[state][2], tuple(edits)))
        self.survivors = after
        self.open += len(after)
        self.most_open = max(self.most_open, self.open)
        for _, _, leaf in before.values():
            self._drop(leaf)
        self._settle()

    def _drop(self, node: _Node) -> None:
        """Free a node that nothing refers to, and those above it that only it referred to."""
        while node is not self.root and not node.children:
            node.parent.children.remove(node)
            node, self.open = node.parent, self.open - 1

    def _out(self, node: _Node) -> None:
        for edit, role, text in node.edits:
            self.emit(edit, 1, role, text)
        if node.deleted:
            self.emit("D", node.deleted, None, None)
        node.edits, node.deleted = (), 0

    def _settle(self) -> None:
        """Steps that all survivors share are final."""
        if not self.root.children:
            self._out(self.root)  # the one survivor is the root itself
        while len(self.root.children) == 1:
            self.root, self.open = self.root.children[0], self.open - 1
            self.root.parent = None
            self._out(self.root)

    def end(self) -> int:
        """Hand on the rest; returns the cost of all edits."""
        best = min((cost + ENDS[s][0], rank, s) for s, (cost, rank, _) in self.survivors.items())
        path, at = [], self.survivors[best[2]][2]
        while at is not None:
            path.append(at)
            at = at.parent
        for node in reversed(path):
            self._out(node)
        for role in ENDS[best[2]][1]:
            self.emit("I", 1, role, "")
        return best[0]


class _Conversation:
    def __init__(self, conv: int | None, rows: list[tuple]):
        self.conv, self.rows = conv, rows
        self.search = Search(lambda edit, times, role, text: rows.append((conv, edit, times, role, text) + (None,) * 6))
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.before = None

    def add(self, turn: int | None, role: str, text: str, again: bool) -> None:
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high, self.turns = turn, self.turns + 1
        if self.before is not None:
            again = again or self.before == (turn, role, text)
            self.illegal += self.before[1][:1] + role[:1] not in LEGAL
        self.before = (turn, role, text)
        shown = text.rstrip(SPACE)
        if not shown:
            self.blank += 1
            self.search.delete()
        elif again:
            self.duplicate += 1
            self.search.delete()
        else:
            truncated = shown[-1] not in STOPS
            self.truncated += truncated
            self.search.row(role, text, truncated)

    def end(self) -> None:
        cost = self.search.end()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        figures = (gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost)
        self.rows.append((self.conv, None, None, None, None, *figures))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"edit": pa.string(), "role": pa.string(), "text": pa.string()}
    names = [field.split()[0] for field in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds.get(n, pa.int64())) for n, c in zip(names, zip(*rows))], names)


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    current: _Conversation | None = None
    for batch in batches:
        for conv, turn, role, text, again, kept in zip(*(column.to_pylist() for column in batch.columns)):
            if current is None or conv != current.conv:
                if current is not None:
                    current.end()
                current = _Conversation(conv, rows)
            if kept:
                current.add(turn, role, text, again)
            if len(rows) >= _ROWS:
                yield _batch(rows)
                rows.clear()
    if current is not None:
        current.end()
    if rows:
        yield _batch(rows)


def repair(rows: DataFrame, kept: str | None = None) -> DataFrame:
    """The edits of each conversation of `rows` (conv_id, turn, role, text), in order, and then its figures.

    An edit is (conv_id, edit, times, role, text): K or R with the row's new role and its text, I with a role and
    an empty text, D for `times` rows that go. A conversation's last row has no edit but gaps (turn numbers that
    are missing between its first and last), blank, duplicate and truncated rows by their first fault, illegal
    neighbours and the cost. Rows are taken by turn, null turns first, equal turns by role and text. A null role or
    text counts as one space, rows with a null conv_id are one conversation. Rows for which the boolean column
    `kept` is not true only say that their conversation is there. An empty table gives none; other columns are
    not looked at. Each conversation is one sorted stream through one task, which holds what is open of it.
    """
    there = F.lit(True) if kept is None else F.coalesce(F.col(kept), F.lit(False))
    blank = F.lit(" ")
    taken = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), blank).alias("role"), F.coalesce(F.col("text").cast("string"), blank).alias("text"),
        there.alias("kept"),
    )
    # Which role and text come at more than one turn is summed up before anything is sorted: a task sees rows, not sets of them.
    said = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit("none")), F.length("role").cast("string"), "role", "text")
    taken = taken.withColumn("said", F.unhex(F.sha2(said, 256)))
    often = (
        taken.filter("kept")
        .groupBy("said")
        .agg(F.min("turn").alias("first"), F.max("turn").alias("last"), F.bool_or(F.col("turn").isNull()).alias("untimed"))
        .filter("first < last or (untimed and last is not null)")
        .select("said", "first", "untimed")
    )
    again = F.coalesce((F.col("turn") > F.col("first")) | (F.col("turn").isNotNull() & F.col("untimed")), F.lit(False))
    ordered = (
        taken.join(often, "said", "left")
        .select("conv_id", "turn", "role", "text", again.alias("again"), "kept")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text")
    )
    return ordered.mapInArrow(_repaired, SCHEMA)


def digests(edits: DataFrame) -> DataFrame:
    """One row for each conversation of `repair`'s result, as it left `repair`: figures, audit and digest of the repaired turns.

    `audit` has the initials of the edits, `repaired_sha256` is of `role:text` of all turns, with line ends between.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit: list[str] = []
        digest, begun = hashlib.sha256(), False
        for batch in batches:
            out = []
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                conv, edit, times, role, text = row[:5]
                if edit is None:
                    out.append((conv, *row[5:], "".join(audit), digest.hexdigest()))
                    audit, digest, begun = [], hashlib.sha256(), False
                    continue
                audit.append(edit * times)
                if edit != "D":
                    digest.update(f"{chr(10) if begun else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
                    begun = True
            if out:
                columns = [pa.array(c, pa.string() if k > 6 else pa.int64()) for k, c in enumerate(zip(*out))]
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return edits.mapInArrow(run, ", ".join(f"{n} {'string' if k > 6 else 'long'}" for k, n in enumerate(names)))
