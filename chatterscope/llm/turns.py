"""Conversation structure repair by Four-Russians block tables.

A row of a conversation is a symbol: its role's initial, and whether it is whole, truncated or
has to go. Edits turn the rows into ``(s?(ua)+)?``; the least cost of what follows, from each
state of that pattern, is a vector. Less its minimum there are few such vectors, so a table
holds, for every block of ``BLOCK`` symbols and every vector behind it, the vector in front, what it
costs more, and the state in which a repair leaves the block. A conversation is worked off
block by block, from its end, by lookup. To trace the edits a block is expanded backward
from the vector behind it, and of all cheapest edits the least letter is taken from its front.

Rows are dealt out by ranges of (conversation, turn), so a conversation may span tasks. Each task
sums up the parts at its two edges by composing table rows; the driver links these, two for a
task, and each task then traces its own rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatterscope.plans.lineage import cut_lineage

BLOCK = 4
# A symbol is a role (system, user, assistant, other) twice, plus 1 if truncated; or one of these.
GONE, NONE, SYMBOLS = 8, 9, 10
SYSTEM, USER, ASSISTANT = range(3)
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = range(4)
STATES = 4
#: Where a role leads from each state, and the role that a state asks for.
NEXT = {
    (START, SYSTEM): AFTER_SYSTEM,
    (START, USER): AFTER_USER,
    (AFTER_SYSTEM, USER): AFTER_USER,
    (AFTER_USER, ASSISTANT): AFTER_ASSISTANT,
    (AFTER_ASSISTANT, USER): AFTER_USER,
}
WANTED = (USER, USER, ASSISTANT, USER)
FILLED = tuple(NEXT[q, WANTED[q]] for q in range(STATES))
NAMES = {USER: "user", ASSISTANT: "assistant"}
FAR = 1 << 20

Vector = tuple[int, ...]


def with_inserts(costs: list[int]) -> list[int]:
    """The least costs where rows may be inserted first; two are enough for any state."""
    one = [min(costs[q], INSERT + costs[FILLED[q]]) for q in range(STATES)]
    return [min(one[q], INSERT + one[FILLED[q]]) for q in range(STATES)]


def moves(symbol: int, q: int) -> Iterator[tuple[str, int, int]]:
    """(letter, cost, next state) of the edits that use up a row, by letter."""
    yield "D", DELETE, q
    if symbol == GONE:
        return
    role, truncated = divmod(symbol, 2)
    if (q, role) in NEXT:
        yield "K", truncated * TRUNCATED, NEXT[q, role]
    yield "R", REROLE + truncated * TRUNCATED, FILLED[q]


def before(symbol: int, behind: Vector) -> list[int]:
    """The costs in front of a row, given those behind it."""
    if symbol == NONE:
        return list(behind)
    least = [min(c + behind[to] for _, c, to in moves(symbol, q)) for q in range(STATES)]
    return with_inserts(least)


class Tables:
    """Vectors less their minimum, and what a symbol and a block make of each.

    ``vectors[0]`` is the one behind the last row. ``to``, ``more`` and ``leave`` are by vector
    behind, block (and state in front): vector in front, cost to add, state behind.
    """

    def __init__(self) -> None:
        end = with_inserts([0, FAR, FAR, 0])
        self.vectors: list[Vector] = [tuple(end)]
        known = {self.vectors[0]: 0}
        self.step: list[list[tuple[int, int]]] = []
        while len(self.step) < len(self.vectors):
            behind, row = self.vectors[len(self.step)], []
            for symbol in range(SYMBOLS):
                costs = before(symbol, behind)
                least = min(costs)
                front = tuple(c - least for c in costs)
                if front not in known:
                    known[front] = len(self.vectors)
                    self.vectors.append(front)
                row.append((known[front], least))
            self.step.append(row)
        n = len(self.vectors)
        to, more = (np.array([[x[i] for x in row] for row in self.step]) for i in range(2))
        leave = np.array(
            [
                [[self.trace([s], v, q)[1] for q in range(STATES)] for s in range(SYMBOLS)]
                for v in range(n)
            ]
        )
        self.to, self.more, self.leave = to, more, leave
        rows = np.arange(n)[:, None, None]
        for _ in range(BLOCK - 1):
            # One more symbol in front of blocks that are known.
            mid = self.to[:, None, :]
            first = np.arange(SYMBOLS)[None, :, None]
            inner = leave[mid, first]
            blocks = np.arange(self.to.shape[1])[None, None, :, None]
            self.leave = self.leave[rows[..., None], blocks, inner].reshape(n, -1, STATES)
            self.more = (self.more[:, None, :] + more[mid, first]).reshape(n, -1)
            self.to = to[mid, first].reshape(n, -1)
        self.traced: dict[tuple[int, int, int], tuple[list[str], int]] = {}

    def trace(self, symbols: list[int], v: int, q: int) -> tuple[list[str], int]:
        """The edits of some rows from state ``q`` on, least letters first, and the state behind.

        Each row has the letters of what is inserted before it, and then its own. The vectors
        inside are found backward from the vector ``v`` behind the rows.
        """
        inside = [v]
        for symbol in reversed(symbols):
            inside.append(self.step[inside[-1]][symbol][0])
        inside.reverse()
        out = []
        for i, symbol in enumerate(symbols):
            if symbol == NONE:
                continue
            behind = self.vectors[inside[i + 1]]
            front = before(symbol, behind)
            letters = ""
            while True:
                found = {l: to for l, c, to in moves(symbol, q) if c + behind[to] == front[q]}
                if "D" not in found and INSERT + front[FILLED[q]] == front[q]:
                    letters, q = letters + "I", FILLED[q]
                    continue
                letter = min(found)
                out.append(letters + letter)
                q = found[letter]
                break
        return out, q

    def block(self, code: int, v: int, q: int) -> tuple[list[str], int]:
        """``trace`` of a block, remembered."""
        known = self.traced.get((code, v, q))
        if known is None:
            symbols = [code // SYMBOLS**i % SYMBOLS for i in reversed(range(BLOCK))]
            known = self.traced[code, v, q] = self.trace(symbols, v, q)
        return known

    def closing(self, q: int) -> str:
        """What is inserted behind the last row."""
        return "I" * (self.vectors[0][q] // INSERT)


@lru_cache(maxsize=1)
def tables() -> Tables:
    return Tables()


def codes(symbols: bytes) -> list[int]:
    """The blocks of some rows, filled up behind the last one."""
    padded = np.frombuffer(symbols + bytes([NONE]) * (-len(symbols) % BLOCK), np.uint8)
    digits = SYMBOLS ** np.arange(BLOCK - 1, -1, -1)
    return (padded.reshape(-1, BLOCK).astype(np.int64) @ digits).tolist()


def summary(symbols: bytes) -> tuple[list[int], list[int]]:
    """Of rows in one task: the vector in front by that behind, and the state behind by both."""
    known = tables()
    n = len(known.vectors)
    v, rows = np.arange(n), np.arange(n)[:, None]
    leave = np.tile(np.arange(STATES), (n, 1))
    for code in reversed(codes(symbols)):
        leave = leave[rows, known.leave[v, code]]
        v = known.to[v, code]
    return v.tolist(), leave.ravel().tolist()


def edits_of(symbols: bytes, v: int = 0, q: int = START) -> tuple[list[str], int]:
    """Letters of each row, given the vector behind the rows and the state in front of them."""
    known = tables()
    blocks = codes(symbols)
    behind = []
    for code in reversed(blocks):
        behind.append(v)
        v = int(known.to[v, code])
    out: list[str] = []
    for code, right in zip(blocks, reversed(behind), strict=True):
        letters, q = known.block(code, right, q)
        out += letters
    return out, q


SPACE = r"\x20\x09-\x0D"


def faults(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copy, fault, symbol) of all rows; nulls of role and text a space.

    Equal rows are counted before they are dealt out and numbered by ``copy``.
    """
    equal = (
        rows.select(
            F.col("conv_id").cast("long").alias("conv_id"),
            F.col("turn").cast("long").alias("turn"),
            F.coalesce(F.col("role"), F.lit(" ")).alias("role"),
            F.coalesce(F.col("text"), F.lit(" ")).alias("text"),
        )
        .groupBy("conv_id", "turn", "role", "text")
        .agg(F.count("*").alias("n"))
        .withColumn("digest", F.md5("text"))
    )
    # A null turn is before all others, as it is in a struct's order.
    first = equal.groupBy(
        F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d")
    ).agg(F.min(F.struct("turn")).alias("first"), F.count("*").alias("turns"))
    seen = equal.join(
        first.filter("turns > 1"),
        F.col("conv_id").eqNullSafe(F.col("c"))
        & (F.col("role") == F.col("r"))
        & (F.col("digest") == F.col("d")),
        "left",
    )
    copies = seen.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    again = (F.col("copy") > 1) | (
        F.col("first").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first.turn"))
    )
    fault = (
        F.when(~F.col("text").rlike(f"[^{SPACE}]"), "blank")
        .when(again, "duplicate")
        .when(~F.col("text").rlike(rf"[.!?][{SPACE}]*\z"), "truncated")
    )
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "s", SYSTEM).when(initial == "u", USER)
    role = role.when(initial == "a", ASSISTANT).otherwise(ASSISTANT + 1)
    whole = role * 2 + F.when(F.col("fault") == "truncated", 1).otherwise(0)
    return copies.select("conv_id", "turn", "role", "text", "copy", fault.alias("fault")).withColumn(
        "symbol", F.when(F.col("fault").isin("blank", "duplicate"), GONE).otherwise(whole)
    )


def in_order(rows: DataFrame) -> DataFrame:
    """``rows`` by conversation and turn over the tasks, and ``at``, which numbers them.

    The numbers rise with the order, over tasks too; written once, so they stay.
    """
    dealt = rows.withColumn("head", F.substring("text", 1, 64)).repartitionByRange(
        "conv_id", "turn", "role", "head"
    )
    inside = dealt.drop("head").sortWithinPartitions("conv_id", "turn", "role", "text", "copy")
    return cut_lineage(inside.withColumn("at", F.monotonically_increasing_id()))


# The number of a row holds its task's number above these bits.
TASK_BITS = 33


@dataclass
class Run:
    """Consecutive rows of a conversation in a task."""

    conv_id: int | None
    task: int
    batches: list[pa.RecordBatch]

    def symbols(self) -> bytes:
        return b"".join(
            b.column("symbol").to_numpy().astype(np.uint8).tobytes() for b in self.batches
        )


def runs(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[Run, bool, bool]]:
    """(run, whether it is the task's first, whether its last)."""
    held: Run | None = None
    first = True
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = batch.column("conv_id")
        known = ids.fill_null(0).to_numpy()
        null = ids.is_null().to_numpy(zero_copy_only=False)
        change = np.flatnonzero((known[1:] != known[:-1]) | (null[1:] != null[:-1])) + 1
        borders = [0, *change.tolist(), batch.num_rows]
        for begin, end in zip(borders, borders[1:]):
            conv, part = ids[begin].as_py(), batch.slice(begin, end - begin)
            if held is not None and conv == held.conv_id:
                held.batches.append(part)
                continue
            if held is not None:
                yield held, first, False
                first = False
            held = Run(conv, batch.column("at")[begin].as_py() >> TASK_BITS, [part])
    if held is not None:
        yield held, first, True


EDGE = "task int, last boolean, conv_id long, to array<int>, leave array<int>"


def edges(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The summaries of a task's first and last run."""
    for run, first, last in runs(batches):
        if first or last:
            to, leave = summary(run.symbols())
            yield pa.RecordBatch.from_pydict(
                {
                    "task": pa.array([run.task], pa.int32()),
                    "last": [last],
                    "conv_id": pa.array([run.conv_id], pa.int64()),
                    "to": pa.array([to], pa.list_(pa.int32())),
                    "leave": pa.array([leave], pa.list_(pa.int32())),
                }
            )


Link = tuple[int, int, bool]


def linked(parts: list) -> dict[tuple[int, bool], Link]:
    """For each edge: the vector behind it, the state in front, and whether its conversation ends."""
    chains: list[list] = []
    for part in sorted(parts, key=lambda r: (r["task"], r["last"])):
        if chains and chains[-1][-1]["conv_id"] == part["conv_id"]:
            chains[-1].append(part)
        else:
            chains.append([part])
    out: dict[tuple[int, bool], Link] = {}
    for chain in chains:
        behind, v = [], 0
        for part in reversed(chain):
            behind.append(v)
            v = part["to"][v]
        q = START
        for part, right in zip(chain, reversed(behind), strict=True):
            out[part["task"], part["last"]] = (right, q, part is chain[-1])
            q = part["leave"][right * STATES + q]
    return out


EDITS = (
    "conv_id long, at long, step int, turn long, role string, text string, fault string, "
    "edit string, new_role string, cost int"
)


def traced(run: Run, link: Link) -> pa.RecordBatch:
    """The edits of a run's rows, with the rows that are inserted."""
    v, q, ends = link
    rows = pa.Table.from_batches(run.batches).combine_chunks()
    symbols = run.symbols()
    letters, leaves = edits_of(symbols, v, q)
    if ends:
        letters[-1] += tables().closing(leaves)
    place, step, edit, new_role, cost = [], [], [], [], []
    for i, (symbol, own) in enumerate(zip(symbols, letters, strict=True)):
        for k, letter in enumerate(own):
            place.append(None if letter == "I" else i)
            step.append((i, k))
            edit.append(letter)
            role = None
            if letter == "K":
                q = NEXT[q, symbol // 2]
            elif letter in "IR":
                role, q = NAMES[WANTED[q]], FILLED[q]
            new_role.append(role)
            late = TRUNCATED if letter in "KR" and symbol % 2 else 0
            cost.append({"K": 0, "R": REROLE, "D": DELETE, "I": INSERT}[letter] + late)
    taken = pa.array(place, pa.int64())
    at = rows.column("at").combine_chunks().take(pa.array([i for i, _ in step], pa.int64()))
    own = {n: rows.column(n).combine_chunks().take(taken) for n in ("turn", "role", "text", "fault")}
    said = pa.array(new_role, pa.string())
    kept = own["role"]
    new = [s if s is not None else k for s, k in zip(said.to_pylist(), kept.to_pylist(), strict=True)]
    new = [None if e == "D" else n for e, n in zip(edit, new, strict=True)]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([run.conv_id] * len(edit), pa.int64()),
            at,
            pa.array([k for _, k in step], pa.int32()),
            own["turn"],
            kept,
            own["text"],
            own["fault"],
            pa.array(edit),
            pa.array(new, pa.string()),
            pa.array(cost, pa.int32()),
        ],
        names=[part.split()[0] for part in EDITS.split(", ")],
    )


def repair(rows: DataFrame) -> DataFrame:
    """The cheapest edits of each conversation's rows, one row each, ordered by (at, step).

    Columns: conv_id, at, step, turn, role, text, fault, edit, new_role, cost. ``edit`` is K (keep),
    R (rerole), D (delete) or I (insert; turn, role and text are null then). ``new_role`` is null
    where a row goes. Of equally cheap repairs the one with the ASCII-least letters is taken.

    Rows are taken by turn, null turns first, then by role and text; a null role or text is one
    space, and so blank. A row is blank, or a duplicate of an earlier (role, text) of its
    conversation, or truncated, or whole. Rows without conv_id are one conversation. Equal rows
    count each. An empty table gives no rows; other columns are not read. A task holds the rows
    of its own range.
    """
    columns = ["conv_id", "turn", "role", "text", "fault", "symbol", "at"]
    ordered = in_order(faults(rows)).select(*columns)
    # Two rows for a task at most.
    links = linked(ordered.select("conv_id", "symbol", "at").mapInArrow(edges, EDGE).collect())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, first, last in runs(batches):
            link = links[part.task, last] if first or last else (0, START, True)
            yield traced(part, link)

    return ordered.mapInArrow(run, EDITS)


FIGURES = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, "
    "cost long, audit string, repaired_sha256 string"
)
LEGAL = ("su", "ua", "au")


class Figures:
    """What a conversation's edits add up to, row by row in order."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.faults = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        self.turns, self.least, self.last = 0, None, None
        self.illegal, self.cost, self.initial = 0, 0, None
        self.audit: list[str] = []
        self.sha, self.kept = hashlib.sha256(), False

    def add(self, row: dict) -> None:
        self.audit.append(row["edit"])
        self.cost += row["cost"]
        if row["edit"] != "I":
            if row["fault"]:
                self.faults[row["fault"]] += 1
            initial = row["role"][:1]
            if self.initial is not None and self.initial + initial not in LEGAL:
                self.illegal += 1
            self.initial = initial
            turn = row["turn"]
            if turn is not None and turn != self.last:
                self.least = turn if self.least is None else self.least
                self.turns, self.last = self.turns + 1, turn
        if row["new_role"] is not None:
            self.sha.update(f"{chr(10) * self.kept}{row['new_role']}:{row['text'] or ''}".encode())
            self.kept = True

    def row(self) -> dict:
        gaps = self.last - self.least + 1 - self.turns if self.turns else 0
        return {
            "conv_id": self.conv_id,
            "gaps": gaps,
            **self.faults,
            "illegal": self.illegal,
            "cost": self.cost,
            "audit": "".join(self.audit),
            "repaired_sha256": self.sha.hexdigest(),
        }


def figures(edits: DataFrame) -> DataFrame:
    """Per conversation: gaps of its turns, faults, illegal neighbours, and its repair.

    A digest runs over the repaired rows in order, so a conversation's rows pass through one
    task, as a sorted stream of which none is kept.
    """
    kinds = [
        pa.field(n, pa.string() if t == "string" else pa.int64())
        for n, t in (part.split() for part in FIGURES.split(", "))
    ]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: Figures | None = None
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if now is None or now.conv_id != row["conv_id"]:
                    if now is not None:
                        done.append(now.row())
                    now = Figures(row["conv_id"])
                now.add(row)
            if done:
                yield pa.RecordBatch.from_pylist(done, pa.schema(kinds))
        if now is not None:
            yield pa.RecordBatch.from_pylist([now.row()], pa.schema(kinds))

    dealt = edits.repartition("conv_id").sortWithinPartitions("conv_id", "at", "step")
    return dealt.mapInArrow(run, FIGURES)


def spaced(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damage(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with a fifth of the rows damaged, by a hash of id and turn.

    Nulls are one space, in the hashed string too. Of 20 remainders, 0 drops a row, 1 empties
    its text, 2 takes its sentence ends away, 3 repeats it, 4 makes it a user's.
    """
    kind = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn"))) % 20
    role, text = spaced("role"), spaced("text")
    damaged = rows.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("times"),
    )
    return damaged.filter("times > 0").select(
        "conv_id", "turn", "role", "text", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("time")
    ).drop("time")
