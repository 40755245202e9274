"""Repair of conversation structure by error-correcting Earley parsing.

The grammar of roles is left-linear: an opening that may hold a system turn, then
questions and answers in turn.  Terminals have error productions with weights: a
turn of the right role is kept, one of another role may be given the right one,
any turn may be deleted, and a question or answer that is missing may be inserted.
A chart item is a production with a dot; as the grammar is left-linear, every
item begins at the first chart set and needs no origin, so a set has a few
items and a conversation costs time in proportion to its turns.  Items retain the
least (cost, audit), the audit being the edits' initials; the completed
``Dialogue`` of the last set yields the repair.

Spark deals whole conversations by id and sorts them by turn, outside of memory
where they are large; whether a turn was seen earlier is a window over the same
partitioning, without a second shuffle.  Tasks read turns as they come.  What all
items of a set agree on is written and forgotten every few hundred turns, so a task
holds the audit, one letter a turn, and not the texts.  A conversation stays with
one task, because its hash is over its turns in order.

Defined cases: a null role or text is one space, and a null id or turn is one space
in what decides the damage; null turns come first; turns of one number are in order
of role and text, by code points; a null conv_id is a conversation; a role counts
by its first character, in lower case only, so an empty role has no initial and no
place without being changed; gaps count numbers, so repeated turns are no gap;
other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from quillspark.llm import common

#: Productions (head, body); terminals are initials of roles.
GRAMMAR = (
    ("Opening", ()),
    ("Opening", ("s",)),
    ("Asked", ("Opening", "u")),
    ("Asked", ("Answered", "u")),
    ("Answered", ("Asked", "a")),
    ("Dialogue", ()),
    ("Dialogue", ("Answered",)),
)
START = "Dialogue"
#: What inserted and rerolled turns may become.
ROLES = {"u": "user", "a": "assistant"}
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: An item that costs so much more than the best can't win: whatever follows it, the best may insert a question
#: and an answer, delete one system turn, and then do the same.
SLACK = 2 * INSERT + DELETE
#: Faults of a turn.
SOUND, BLANK, DUPLICATE, CUT_SHORT = range(4)
LEGAL = ("su", "ua", "au")

Item = tuple[int, int]
Best = tuple[int, str]


class Chart:
    """The last chart set of a parse: items (production, dot) with their least (cost, audit)."""

    def __init__(self) -> None:
        #: items that wait at the first set for a head, as prediction puts them there
        self.waiting: dict[str, list[int]] = {}
        for i, (_, body) in enumerate(GRAMMAR):
            if body and body[0] not in ("s", *ROLES):
                self.waiting.setdefault(body[0], []).append(i)
        self.items: dict[Item, Best] = {}
        for i, (_, body) in enumerate(GRAMMAR):
            if not body or body[0] in ("s", *ROLES):
                self.items[i, 0] = (0, "")
        self._close(self.items)

    def _close(self, items: dict[Item, Best]) -> None:
        """Completions and insertions, until no item gets better."""
        todo = list(items)
        while todo:
            i, dot = item = todo.pop()
            cost, audit = items[item]
            head, body = GRAMMAR[i]
            if dot == len(body):
                moves = [((j, 1), (cost, audit)) for j in self.waiting.get(head, ())]
            elif body[dot] in ROLES:
                moves = [((i, dot + 1), (cost + INSERT, audit + "I"))]
            else:
                moves = []
            for to, best in moves:
                if to not in items or best < items[to]:
                    items[to] = best
                    todo.append(to)

    def scan(self, initial: str, fault: int) -> None:
        """The next set after a turn."""
        items: dict[Item, Best] = {}

        def offer(to: Item, cost: int, audit: str) -> None:
            if to not in items or (cost, audit) < items[to]:
                items[to] = (cost, audit)

        usable = fault not in (BLANK, DUPLICATE)
        more = TRUNCATED if fault == CUT_SHORT else 0
        for (i, dot), (cost, audit) in self.items.items():
            offer((i, dot), cost + DELETE, audit + "D")
            body = GRAMMAR[i][1]
            if usable and dot < len(body):
                if body[dot] == initial:
                    offer((i, dot + 1), cost + more, audit + "K")
                if body[dot] in ROLES:
                    offer((i, dot + 1), cost + REROLE + more, audit + "R")
        self._close(items)
        most = min(cost for cost, _ in items.values()) + SLACK
        self.items = {item: best for item, best in items.items() if best[0] <= most}

    def agreed(self) -> str:
        """What all audits begin with, taken away from them; the order between them stays, as does every cost."""
        common_ = os.path.commonprefix([audit for _, audit in self.items.values()])
        if common_:
            self.items = {item: (cost, audit[len(common_) :]) for item, (cost, audit) in self.items.items()}
        return common_

    def complete(self) -> Best:
        return min(best for (i, dot), best in self.items.items() if GRAMMAR[i][0] == START and dot == len(GRAMMAR[i][1]))


def parse(turns: list[tuple[str, int]]) -> Best:
    """Least cost and audit of turns (initial, fault)."""
    chart = Chart()
    for t in turns:
        chart.scan(*t)
    return chart.complete()


class Repair:
    """One conversation, turn by turn."""

    def __init__(self, settle: int = 256) -> None:
        self.chart, self.settle = Chart(), settle
        self.held: list[tuple[str, str]] = []
        self.audit: list[str] = []
        self.digest, self.written, self.expected = hashlib.sha256(), 0, None
        self.faults = [0, 0, 0, 0]
        self.illegal, self.last, self.rows = 0, None, 0
        self.least = self.most = self.seen = None
        self.turns = 0

    def add(self, turn: int | None, role: str, text: str, fault: int) -> None:
        self.rows += 1
        self.faults[fault] += 1
        if self.last is not None and self.last + role[:1] not in LEGAL:
            self.illegal += 1
        self.last = role[:1]
        if turn is not None and turn != self.seen:
            self.least = turn if self.least is None else self.least
            self.most = self.seen = turn
            self.turns += 1
        self.held.append((role, text))
        self.chart.scan(role[:1], fault)
        if len(self.held) >= self.settle and len(self.held) % self.settle == 0:
            self._write(self.chart.agreed())

    def _write(self, edits: str) -> None:
        """Turns as the edits leave them, into the hash; the audit grows."""
        at = 0
        for e in edits:
            role, text = ("", "") if e == "I" else self.held[at]
            at += e != "I"
            if e == "D":
                continue
            if e != "K":
                role = ROLES[self.expected or "u"]
            self.digest.update((("\n" if self.written else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
            self.written += 1
            self.expected = "a" if role[:1] == "u" else "u"
        del self.held[:at]
        self.audit.append(edits)

    def done(self) -> tuple:
        cost, edits = self.chart.complete()
        self._write(edits)
        gaps = 0 if self.least is None else min(self.most - self.least + 1 - self.turns, 2**63 - 1)
        return (gaps, *self.faults[1:], self.illegal, cost, "".join(self.audit), self.digest.hexdigest())


_OUT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def _said(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" ")).alias(name)


def damaged(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, gone) of ``turns``, damaged by the checksum of id and turn; a dropped row comes without text."""
    slot = F.crc32(F.concat(_said("conv_id"), F.lit(":"), _said("turn")).cast("binary")) % 20
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), _said("role"), _said("text"), slot.alias("slot"))
    text = F.when(F.col("slot") <= 1, "").when(F.col("slot") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("slot") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("slot") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("slot") == 0).alias("gone"), F.explode(copies).alias("copy")).drop("copy")


def _repaired(batches: Iterator[pa.RecordBatch], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    now, own, out = None, None, []

    def told(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(columns[0], kind), *[pa.array(c) for c in columns[1:]]], ["conv_id", *_OUT])

    for batch in batches:
        for part in common.slices(batch, 1024):
            for conv, turn, role, text, gone, fault in zip(*[part.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "gone", "fault")], strict=True):
                if own is None or conv != now:
                    if own is not None:
                        out.append((now, *own.done()))
                        if len(out) >= 2000:
                            yield told(out)
                            out = []
                    now, own = conv, Repair()
                if not gone:
                    own.add(turn, role, text, fault)
    if own is not None:
        yield told([*out, (now, *own.done())])


def repaired(turns: DataFrame, damage: bool = True) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation.

    ``turns``: (conv_id, turn, role, text), with the contract's ``damage`` done to them first or taken as they are.
    """
    rows = damaged(turns) if damage else turns.select("conv_id", F.col("turn").cast("long").alias("turn"), _said("role"), _said("text"), F.lit(False).alias("gone"))
    last = F.regexp_extract("text", r"(?s)([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    rows = rows.withColumns({"digest": F.sha2(F.concat(F.hex("role"), F.lit(":"), "text"), 256), "last": last})
    rows = rows.repartition(common.shuffle_partitions(rows.sparkSession), "conv_id")
    # the shuffle by conversation serves the window too; rows that are gone are nobody's copies
    again = F.row_number().over(Window.partitionBy("conv_id", "digest", "gone").orderBy(F.col("turn").asc_nulls_first())) > 1
    fault = F.when(F.col("last") == "", BLANK).when(F.col("again"), DUPLICATE).when(~F.col("last").isin(".", "!", "?"), CUT_SHORT).otherwise(SOUND)
    rows = rows.withColumn("again", again).select("conv_id", "turn", "role", "text", "gone", "again", fault.alias("fault"))
    rows = rows.sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text", "again")
    kind = turns.schema["conv_id"].dataType
    arrow = to_arrow_type(kind)
    schema = f"conv_id {kind.simpleString()}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    return rows.select("conv_id", "turn", "role", "text", "gone", "fault").mapInArrow(common.tidy(lambda it: _repaired(it, arrow)), schema)
