"""Conversation structure repair as shortest paths, found by an auction over node prices.

A conversation is to read ``system? (user assistant)+`` or nothing.  Its rows and the states
of that pattern span a lattice: node (i, state) has i rows behind it, and its arcs are the
edits of the next row, or the insertion of a turn, with whole-number costs.  The auction
holds a path and a price per node, never above the cost of an arc plus the price at its end.
The path is extended along the cheapest arc while the price of its last node equals that
arc's offer; if the price is lower it is raised to the offer and the path contracts by that
node.  Origins are taken from the last row backwards, and a path ends at the first node
whose price has converged, so each origin needs a few steps only.  At the end every price is
the cheapest cost from its node; the arcs on which costs and prices balance are tight, and
the path that takes the least tight label at each node is the cheapest and, of equally cheap
ones, the alphabetically least edit script.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from arrears.llm.common import give_back, on_executors

#: states of the pattern: nothing yet, after the system turn, user has spoken, assistant has spoken
START, SYSTEM, USER, ASSISTANT = range(4)
LEGAL_END = (START, ASSISTANT)
#: where a turn of the role that the state asks for leads, and that role
NEXT = (USER, USER, ASSISTANT, USER)
ASKED = ("user", "user", "assistant", "user")
_KEEP = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
#: costs of the edits, and of a truncated row that stays
DELETE, INSERT, REROLE, KEEP, TRUNCATED = 3, 2, 2, 0, 1

#: a row's code: its initial, and whether it must go or is truncated
INITIALS = ("s", "u", "a", "")
MUST_GO, CUT_SHORT = 4, 8
_NO_ARC = 1 << 40


def code_of(initial: str, must_go: bool, cut_short: bool) -> int:
    at = INITIALS.index(initial) if initial in ("s", "u", "a") else 3
    return at | (MUST_GO if must_go else 0) | (CUT_SHORT if cut_short else 0)


def arcs(codes: bytes, node: int) -> list[tuple[str, int, int]]:
    """``(label, cost, node)`` of the arcs out of a node, labels in ASCII order; node ``4 * (n + 1)`` is the end."""
    row, state = divmod(node, 4)
    if row == len(codes):
        out = [("I", INSERT, 4 * row + NEXT[state])]
        return [("", 0, 4 * row + 4), *out] if state in LEGAL_END else out
    code, below = codes[row], 4 * row + 4
    out = [("D", DELETE, below + state), ("I", INSERT, 4 * row + NEXT[state])]
    if not code & MUST_GO:
        more = TRUNCATED if code & CUT_SHORT else 0
        kept = _KEEP[state].get(INITIALS[code & 3])
        if kept is not None:
            out.append(("K", KEEP + more, below + kept))
        out.append(("R", REROLE + more, below + NEXT[state]))
    return out


def prices(codes: bytes) -> array:
    """The converged price of every node: the cheapest cost from it to the end."""
    end = 4 * (len(codes) + 1)
    price, settled = array("q", bytes(8 * (end + 1))), bytearray(end + 1)
    settled[end] = 1
    for origin in range(end - 1, -1, -1):
        path = [origin]
        while not settled[path[-1]]:
            node = path[-1]
            best, to = _NO_ARC, node
            for _, cost, other in arcs(codes, node):
                if cost + price[other] < best:
                    best, to = cost + price[other], other
            if price[node] < best:
                price[node] = best  # raise, and contract unless at the origin
                if len(path) > 1:
                    path.pop()
            else:
                path.append(to)
        for node in path:
            settled[node] = 1
    return price


def cheapest(codes: bytes) -> tuple[int, str]:
    """``(cost, labels)`` of the alphabetically least of the cheapest edit scripts."""
    price, node, end = prices(codes), 0, 4 * (len(codes) + 1)
    labels = []
    while node != end:
        for label, cost, to in arcs(codes, node):
            if price[node] == cost + price[to]:
                labels.append(label)
                node = to
                break
    return price[0], "".join(labels)


class Replay:
    """Follows a script over the rows of a conversation and hashes the turns that it leaves."""

    def __init__(self, script: str):
        self.script, self.at, self.state = script, 0, START
        self.digest, self.empty = hashlib.sha256(), True

    def _turn(self, role: str, text: str) -> None:
        turn = f"{role}:{text}" if self.empty else f"\n{role}:{text}"
        self.digest.update(turn.encode("utf-8", "surrogatepass"))
        self.empty = False

    def _insertions(self) -> None:
        while self.script[self.at : self.at + 1] == "I":
            self.at += 1
            self._turn(ASKED[self.state], "")
            self.state = NEXT[self.state]

    def row(self, role: str, text: str) -> None:
        self._insertions()
        label = self.script[self.at]
        self.at += 1
        if label == "K":
            self._turn(role, text)
            self.state = _KEEP[self.state][role[:1]]
        elif label == "R":
            self._turn(ASKED[self.state], text)
            self.state = NEXT[self.state]

    def finish(self) -> str:
        self._insertions()
        return self.digest.hexdigest()


def _said(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text, copies)``: rows lost, emptied, cut short, repeated or given to the user.

    What happens to a row follows from the CRC-32 of its conversation and turn; nulls count
    as one space.  A lost row has 0 copies and a repeated one 2.
    """
    kind = F.crc32(F.concat_ws(":", _said("conv_id"), _said("turn"))) % 20
    return conversations.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(_said("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(_said("text"), ".!?", "")).otherwise(_said("text")).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_AUDIT = "conv_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string"


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


class _Audit:
    """Counts of one conversation while its rows pass, in order; a byte per row is kept."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.codes, self.last = conv_id, bytearray(), None
        self.turns: list[int] = []  # least, greatest, distinct
        self.blank = self.duplicate = self.truncated = self.illegal = 0

    def row(self, turn: int | None, initial: str, blank: bool, ended: bool, again: bool) -> None:
        self.blank += blank
        self.duplicate += again and not blank
        cut_short = not (blank or again or ended)
        self.truncated += cut_short
        if self.last is not None:
            self.illegal += self.last + initial not in ("su", "ua", "au")
        self.last = initial
        self.codes.append(code_of(initial, blank or again, cut_short))
        if turn is not None:
            if not self.turns:
                self.turns = [turn, turn, 1]
            elif turn != self.turns[1]:
                self.turns = [self.turns[0], turn, self.turns[2] + 1]

    def result(self) -> tuple:
        cost, script = cheapest(bytes(self.codes))
        gaps = self.turns[1] - self.turns[0] + 1 - self.turns[2] if self.turns else 0
        return (self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, script)


def audits(marked: DataFrame) -> DataFrame:
    """``(conv_id, counts, cost, audit)`` of the sorted rows of each conversation."""
    schema = pa.schema([("conv_id", pa.int64()), *((c, pa.int64()) for c in COUNTS), ("audit", pa.string())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready: list[tuple] = []
        size, own = 0, None

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*ready), schema)], schema=schema)

        for conv_id, turn, initial, blank, ended, seen, copies in _streams(batches):
            if own is None or conv_id != own.conv_id:
                if own is not None:
                    ready.append(own.result())
                    size += len(own.codes)
                    if size > 1 << 20 or len(ready) >= 4096:
                        yield batch()
                        ready, size = [], 0
                own = _Audit(conv_id)
            for copy in range(copies):
                own.row(turn, initial, blank, ended, seen or copy > 0)
        if own is not None:
            ready.append(own.result())
            yield batch()
        give_back()

    narrow = marked.select(
        "conv_id", "turn", F.substring("role", 1, 1).alias("initial"),
        (~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
        F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z").alias("ended"),
        "seen", "copies",
    )
    return narrow.mapInArrow(work, _AUDIT)


def digests(rows: DataFrame) -> DataFrame:
    """Each conversation's audit row, first, then its rows in order: replays the script and hashes what it leaves."""
    schema = pa.schema(
        [("conv_id", pa.int64()), *((c, pa.int64()) for c in COUNTS), ("audit", pa.string()), ("repaired_sha256", pa.string())]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready: list[tuple] = []
        size, audit, replay = 0, None, None

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*ready), schema)], schema=schema)

        for conv_id, *counts, script, role, text, copies in _streams(batches):
            if script is not None:
                if audit is not None:
                    ready.append((*audit, replay.finish()))
                    size += len(audit[-1])
                    if size > 1 << 20 or len(ready) >= 4096:
                        yield batch()
                        ready, size = [], 0
                audit, replay = (conv_id, *counts, script), Replay(script)
                continue
            for _ in range(copies):
                replay.row(role, text)
        if audit is not None:
            ready.append((*audit, replay.finish()))
            yield batch()
        give_back()

    return rows.mapInArrow(work, f"{_AUDIT}, repaired_sha256 string")


def repaired(rows: DataFrame) -> DataFrame:
    """``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)`` per conv_id.

    ``rows(conv_id, turn, role, text, copies)``, as ``damaged`` gives them.  Rows go by turn,
    nulls first, then by role and text; a null role or text is one space.  Rows without
    conv_id are one conversation.  A role whose first letter is none of s, u, a, the empty
    role included, cannot be kept.  A conversation whose rows have no copies gets zeros, an
    empty audit and the hash of nothing.  An empty table gives an empty result; other columns
    are not read.

    Repeated turns are marked by a window over one role and text of a conversation.  Then a
    conversation passes one task twice, as a sorted stream: for its audit, where a byte and
    four prices per row are kept, and, its audit ahead, for the hash of its repaired text.
    """
    on_executors(rows.sparkSession)
    said = rows.select("conv_id", "turn", _said("role").alias("role"), _said("text").alias("text"), "copies")
    same = F.sha2(F.concat_ws(":", F.char_length("role"), "role", "text"), 256)
    order = Window.partitionBy("conv_id", same).orderBy(F.asc_nulls_first("turn"))
    seen = F.row_number().over(order) > 1
    there = said.filter("copies > 0").withColumn("seen", seen)
    lost = said.filter("copies = 0").select("conv_id").distinct().select(
        "conv_id", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"),
        F.lit(0).alias("copies"), F.lit(False).alias("seen"),
    )
    marked = there.unionByName(lost)
    # sorting happens on all columns, only narrow ones go to the audit
    keys = ["conv_id", F.asc_nulls_first("turn"), "role", "text", "seen"]
    audit = audits(marked.repartition("conv_id").sortWithinPartitions(*keys))
    empty = lambda name: F.lit(None).cast("string" if name in ("audit", "role", "text") else "long").alias(name)
    none = F.lit(None)
    both = audit.select(
        "conv_id", *COUNTS, "audit", empty("role"), empty("text"), F.lit(0).alias("copies"),
        F.lit(0).alias("kind"), empty("turn"), none.cast("boolean").alias("seen"),
    ).unionByName(
        there.select(
            "conv_id", *map(empty, COUNTS), empty("audit"), "role", "text", "copies", F.lit(1).alias("kind"), "turn", "seen"
        )
    )
    ordered = both.repartition("conv_id").sortWithinPartitions("conv_id", "kind", *keys[1:])
    return digests(ordered.select("conv_id", *COUNTS, "audit", "role", "text", "copies"))
