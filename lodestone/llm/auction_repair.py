"""Conversation structure repair by an auction shortest-path algorithm.

A conversation's rows, in order of turn, span a lattice: a node is (rows read,
role state), an arc an edit with an integer cost. Role states: nothing written,
after ``system``, after ``user``, after ``assistant``; a repaired conversation is
empty or ``system?`` followed by user/assistant pairs.

    Keep 0 (the role must fit)   Rerole to user or assistant 2
    Delete 3 (the only way for blank and duplicate rows)
    Insert an empty user or assistant turn 2; an undeleted truncated row adds 1

Every node has a price, no more than an arc's cost plus the price at its end. A
path grows from the origin: at its last node it is extended along an arc whose
cost plus end price equals the node's price; if there is none, the price rises
to the least such sum and the path contracts by a node. The path that reaches
the end makes the origin's price the exact distance. Long conversations are
settled ``BLOCK`` rows at a time from the last block on, where the first nodes
of the block behind are ends with exact prices; so work is linear in the rows.
Converged prices expose the tight arcs; of the cheapest repairs, the one whose
edit initials (D, I, K, R) are least in ASCII order is traced over them.

One shuffle by conversation, then rows are streamed in order of turn (nulls
first; rows of one turn by role, then text). A conversation's memory is some 150
bytes a row (a digest for the duplicate rule, an edit); its texts are held only
up to ``KEEP_ROWS`` rows and ``KEEP_BYTES``, and a longer conversation's texts
are streamed a second time behind its finished edits. Its digest is one SHA-256
over all its text, which only a single task can take.

Null roles and texts count as one space, a null conv_id is a conversation of its
own, repeated rows count each. An empty table gives no rows. Other columns are
ignored."""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import map_text, stash_counted

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1     # fixed values: edit costs
LEGAL = ("su", "ua", "au")                                   # fixed values: legal neighbours
SPACE = " \t\n\x0b\x0c\r"
BLOCK = 32
KEEP_ROWS, KEEP_BYTES = 20_000, 4 << 20
SIGNATURE_CACHE, SIGNATURE_LENGTH = 100_000, 64

EMPTY, SYSTEM, USER, ASSISTANT = range(4)
_AFTER = {(EMPTY, "s"): SYSTEM, (EMPTY, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
_NEXT = {EMPTY: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}      # the only state an inserted turn leads to
_ROLE = {USER: "user", ASSISTANT: "assistant"}


# --- the lattice -------------------------------------------------------------

def _arcs(mark: str | None, state: int) -> list[tuple[str, int, int, int]]:
    """(edit, cost, rows read, state after) of a node, edits in ASCII order. ``mark``: the row's
    role initial, upper case when truncated; ``-`` when it must go; None behind the last row."""
    arcs = [("I", INSERT, 0, _NEXT[state])]
    if mark is None:
        return arcs
    arcs.insert(0, ("D", DELETE, 1, state))
    if mark != "-":
        extra = TRUNCATED if mark.isupper() else 0
        kept = _AFTER.get((state, mark.lower()))
        if kept is not None:
            arcs.append(("K", KEEP + extra, 1, kept))
        arcs.append(("R", REROLE + extra, 1, _NEXT[state]))
    return arcs


#: marks: s, u, a, o (any other role), upper case when truncated, - for rows that must go.
_TABLE = {m: [_arcs(m, s) for s in range(4)] for m in [*"suaoSUAO-", None]}
_FINAL = (EMPTY, ASSISTANT)


class Lattice:
    """Prices of a conversation's nodes. Node 4 * rows read + state; the sink is node 4 * (n + 1)."""

    def __init__(self, marks: str):
        self.marks, self.n = marks, len(marks)
        self.price = [0] * (4 * self.n + 5)
        self.steps = 0

    def arcs(self, node: int):
        """(edit, cost, end node); the arc to the sink has no edit."""
        i, s = divmod(node, 4)
        out = [(e, c, 4 * (i + d) + t) for e, c, d, t in _TABLE[self.marks[i] if i < self.n else None][s]]
        if i == self.n and s in _FINAL:
            out.insert(0, ("", 0, 4 * (self.n + 1)))
        return out

    def auction(self, origin: int, goal: int) -> None:
        """Grow a path from ``origin`` until it reaches a node from ``goal`` on."""
        price, path = self.price, [origin]
        while path[-1] < goal:
            self.steps += 1
            node = path[-1]
            least, to = min((c + price[end], end) for _, c, end in self.arcs(node))
            if price[node] < least:                 # contract
                price[node] = least
                if len(path) > 1:
                    path.pop()
            else:                                   # extend along a tight arc
                path.append(to)

    def settle(self) -> int:
        """Exact prices at the first nodes of every block; the cost of the cheapest repair."""
        goal, starts = 4 * (self.n + 1), range((max(self.n - 1, 0) // BLOCK) * BLOCK, -1, -BLOCK)
        for lo in starts:
            if goal <= 4 * self.n:                  # feasible start: no node lies nearer than the nearest end
                low = min(self.price[goal:goal + 4])
                self.price[4 * lo:goal] = [low] * (goal - 4 * lo)
            for origin in ([0] if lo == 0 else range(4 * lo, 4 * lo + 4)):
                self.auction(origin, goal)
            goal = 4 * lo
        return self.price[0]

    def trace(self) -> str:
        """Edits of the path over tight arcs from which the sink can be reached, least first."""
        price, sink = self.price, 4 * (self.n + 1)
        live = bytearray(sink + 1)
        live[sink] = 1
        for i in range(self.n, -1, -1):
            for s in (EMPTY, SYSTEM, USER, ASSISTANT, USER, SYSTEM, EMPTY):   # inserts stay in the row
                node = 4 * i + s
                if not live[node]:
                    live[node] = any(live[end] and price[node] == c + price[end] for _, c, end in self.arcs(node))
        node, edits = 0, []
        while node != sink:
            edit, node = next((e, end) for e, c, end in self.arcs(node) if live[end] and price[node] == c + price[end])
            edits.append(edit)
        return "".join(edits)


def solve(marks: str) -> tuple[int, str]:
    """(cost, edits) of the cheapest repair."""
    lattice = Lattice(marks)
    return lattice.settle(), lattice.trace()


_solve_short = lru_cache(maxsize=SIGNATURE_CACHE)(solve)       # conversations alike in roles and faults share a lattice


# --- a conversation ----------------------------------------------------------

class Conversation:
    """Faults, marks and (while it is short) the texts of the rows seen so far."""

    def __init__(self, conv, keep_rows: int):
        self.conv, self.keep_rows, self.rows, self.bytes = conv, keep_rows, [], 0
        self.marks, self.seen, self.last = [], set(), None
        self.low = self.high = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0

    def add(self, turn, role: str, text: str) -> None:
        if turn is not None:
            if turn != self.high:                  # rows come in order of turn
                self.turns += 1
                self.high = turn
                if self.low is None:
                    self.low = turn
        if self.last is not None:
            self.illegal += self.last + role[:1] not in LEGAL
        self.last = role[:1]
        key = xxhash.xxh3_128_digest(f"{len(role)} {role}{text}".encode())
        end = text.rstrip(SPACE)[-1:]
        mark = role[:1] if role[:1] in ("s", "u", "a") else "o"
        if not end:
            self.blank += 1
            mark = "-"
        elif key in self.seen:
            self.duplicate += 1
            mark = "-"
        elif end not in ".!?":
            self.truncated += 1
            mark = mark.upper()
        self.seen.add(key)
        self.marks.append(mark)
        if self.rows is not None:
            self.rows.append((role, text))
            self.bytes += len(text)
            if len(self.rows) > self.keep_rows or self.bytes > KEEP_BYTES:
                self.rows = None

    def result(self) -> tuple:
        marks = "".join(self.marks)
        cost, edits = (_solve_short if len(marks) <= SIGNATURE_LENGTH else solve)(marks)
        digest = None
        if self.rows is not None:
            out = Writer(edits)
            for role, text in self.rows:
                out.add(role, text)
            digest = out.finish()
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return (self.conv, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, edits, digest)


class Writer:
    """Applies edits to rows as they come; the digest, and the rows to a sink if there is one."""

    def __init__(self, edits: str, sink=None):
        self.edits, self.at, self.state, self.sink = edits, 0, EMPTY, sink
        self.digest, self.count = hashlib.sha256(), 0

    def _write(self, role: str, text: str) -> None:
        self.digest.update(("\n" if self.count else "").encode() + f"{role}:{text}".encode())
        if self.sink is not None:
            self.sink(self.count, role, text)
        self.count += 1

    def _inserts(self) -> None:
        while self.edits[self.at:self.at + 1] == "I":
            self.state = _NEXT[self.state]
            self._write(_ROLE[self.state], "")
            self.at += 1

    def add(self, role: str, text: str) -> None:
        self._inserts()
        edit = self.edits[self.at]
        self.at += 1
        if edit == "D":
            return
        self.state = _NEXT[self.state] if edit == "R" else _AFTER[self.state, role[:1]]
        self._write(_ROLE[self.state] if edit == "R" else role, text)

    def finish(self) -> str:
        self._inserts()
        return self.digest.hexdigest()


# --- Spark -------------------------------------------------------------------

def damaged(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """conv_id, turn, role, text, dropped: rows damaged by crc32("conv_id:turn") % 20: 0 drops a row
    (it stays as a mark without text, so that its conversation is not lost), 1 empties its text, 2
    removes ``.!?`` from it, 3 repeats it, 4 makes its role user. Nulls count as one space."""
    def plain(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fate = F.crc32(F.concat(plain(conv_col), F.lit(":"), plain(turn_col))) % 20
    rows = conversations.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        plain(role_col).alias("role"), plain(text_col).alias("text"), fate.alias("fate"))
    return rows.select(
        "conv_id", "turn", F.when(F.col("fate") == 4, "user").when(F.col("fate") != 0, F.col("role")).alias("role"),
        F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ".!?", ""))
        .when(F.col("fate") != 0, F.col("text")).alias("text"),
        (F.col("fate") == 0).alias("dropped"),
        F.explode(F.when(F.col("fate") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy")).drop("copy")


def as_rows(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """The rows of a table as they are, in the columns ``repair`` takes."""
    return conversations.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col), F.lit(" ")).alias("role"), F.coalesce(F.col(text_col), F.lit(" ")).alias("text"),
        F.lit(False).alias("dropped"))


def _conv_type(rows: DataFrame) -> str:
    return rows.schema["conv_id"].dataType.simpleString()


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


_LONGS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def audits(rows: DataFrame, keep_rows: int = KEEP_ROWS) -> DataFrame:
    """One row a conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256 (null for a conversation too long to hold)."""
    def run(batches):
        now, done, schema = None, [], None
        for batch in batches:
            schema = pa.schema([("conv_id", batch.schema.field(0).type), *((c, pa.int64()) for c in _LONGS),
                                ("audit", pa.string()), ("repaired_sha256", pa.string())])
            for conv, turn, role, text, dropped in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is None or now.conv != conv:
                    if now is not None:
                        done.append(now.result())
                    now = Conversation(conv, keep_rows)
                if not dropped:
                    now.add(turn, role, text)
            yield _batch(done, schema)
            done = []
        if now is not None:
            yield _batch([now.result()], schema)

    ordered = (rows.select("conv_id", "turn", "role", "text", "dropped").repartition("conv_id")
               .sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text"))
    return map_text(ordered, run, f"conv_id {_conv_type(rows)}, " + "".join(f"{c} long, " for c in _LONGS)
                    + "audit string, repaired_sha256 string")


def _led(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """Each conversation's rows behind a row with its edits, in order of turn."""
    lead = audits.select("conv_id", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
                         F.col("audit").alias("text"), F.lit(0).alias("kind"))
    kept = (rows.where("not dropped").withColumnRenamed("conv_id", "_c")
            .join(audits.select("conv_id"), F.col("_c").eqNullSafe(F.col("conv_id")), "left_semi")
            .select(F.col("_c").alias("conv_id"), "turn", "role", "text", F.lit(1).alias("kind")))
    return (lead.unionByName(kept).repartition("conv_id")
            .sortWithinPartitions("conv_id", "kind", F.asc_nulls_first("turn"), "role", "text"))


def repaired_rows(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """conv_id, position (from 0), role, text of the repaired conversations in ``audits``."""
    def run(batches):
        schema, writer, out = None, None, []
        for batch in batches:
            schema = pa.schema([("conv_id", batch.schema.field(0).type), ("position", pa.int64()),
                                ("role", pa.string()), ("text", pa.string())])
            for conv, _, role, text, kind in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if kind == 0:
                    if writer is not None:
                        writer.finish()
                    writer = Writer(text, lambda k, r, t, conv=conv: out.append((conv, k, r, t)))
                else:
                    writer.add(role, text)
            yield _batch(out, schema)
            out.clear()
        if writer is not None:
            writer.finish()
            yield _batch(out, schema)

    return map_text(_led(rows, audits), run, f"conv_id {_conv_type(rows)}, position long, role string, text string")


def _digests(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """conv_id, sha of the repaired conversations in ``audits``, texts streamed."""
    def run(batches):
        schema, now, writer, out = None, None, None, []
        for batch in batches:
            schema = pa.schema([("conv_id", batch.schema.field(0).type), ("sha", pa.string())])
            for conv, _, role, text, kind in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if kind == 0:
                    if writer is not None:
                        out.append((now, writer.finish()))
                    now, writer = conv, Writer(text)
                else:
                    writer.add(role, text)
            yield _batch(out, schema)
            out = []
        if writer is not None:
            yield _batch([(now, writer.finish())], schema)

    return map_text(_led(rows, audits), run, f"conv_id {_conv_type(rows)}, sha string")


def repair(rows: DataFrame, keep_rows: int = KEEP_ROWS) -> DataFrame:
    """``audits`` with every digest: the texts of long conversations are streamed once more."""
    found, seen = stash_counted(audits(rows, keep_rows), "audits", n=F.count_if(F.col("repaired_sha256").isNull()))
    if not seen["n"]:
        return found
    late = _digests(rows, found.where("repaired_sha256 is null")).withColumnRenamed("conv_id", "_c")
    return (found.join(late, F.col("conv_id").eqNullSafe(F.col("_c")), "left")
            .withColumn("repaired_sha256", F.coalesce("repaired_sha256", "sha")).drop("_c", "sha"))


def repair_damaged(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                   text_col: str = "text") -> DataFrame:
    """Damage a table of conversations by rule, then repair it: one row for every conv_id."""
    return repair(damaged(conversations, conv_col, turn_col, role_col, text_col))
