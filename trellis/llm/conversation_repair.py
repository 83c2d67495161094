"""Conversation repair: the cheapest edits that give a well-formed sequence of roles.

A well-formed conversation has the role initials ``(s?(ua)+)?``.  Rows may be kept, given
another role, deleted, and empty rows inserted; a blank row and a copy of an earlier row must
go.  Cost-to-go is a vector over the four states of that pattern (nothing yet, after system,
after user, after assistant).

Four Russians.  Less its minimum, a cost vector is one of a few dozen; a row is one of nine
symbols.  So for every vector and every block of ``BLOCK`` symbols the vector before the block
and the cost it adds are worked out once, by composing single steps, and a conversation is
processed from its end by one look-up per block.  The trace goes from the first row on, over
the vectors kept at the block ends: a block is expanded backward into its inner vectors, and of
the edits that stay cheapest the one with the least letter is taken, so ties are resolved by the
whole audit string (D < I < K < R).  Expanded blocks are kept and used again.

Spark.  Rows are dealt by ranges of (conversation, turn), so a conversation with a third of all
rows lies in many tasks, each cut into segments of at most ``SEGMENT_ROWS`` rows or
``SEGMENT_BYTES`` of text (a longer text alone).  A conversation that lies inside one segment
is repaired at once.  For the others each segment gives its cost matrix between states (the
same look-ups, started from each state), the matrices of a conversation are joined from the
end, then each segment is traced from each state it may start in, and the states are joined
from the start; these steps see 16 numbers and 4 states per segment.  Only the checksum of a
repaired conversation runs over its segments in order, because SHA-256 is sequential: one task
streams the pieces.  Copies are found by a grouping on (conversation, checksum of role and
text), not inside a conversation.

Defined results: null roles and texts are one space, so is a null conv_id or turn in the damage
rule; a null conv_id is one conversation; rows of equal turn are ordered by the first 64
characters of the role, those of the text, then the checksum of both; an empty role counts as
a role outside the pattern; other columns are ignored; an empty table gives an empty result;
a conversation without rows after damage has zeros, an empty audit and the checksum of the empty string.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trellis.llm.common import WHITE, register, store, table

DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
BLOCK = 4                    # symbols of a block
SEGMENT_ROWS = 1000
SEGMENT_BYTES = 4_000_000
FAR = 10**6                  # no way there
START, SYSTEM, USER, ASSISTANT = range(4)

# Symbols: 0 must go; 1 + initial (s, u, a, other), and 4 more if truncated.
ROLES = "sua"
N_SYMBOLS = 9
_NEXT = {(START, 0): SYSTEM, (START, 1): USER, (SYSTEM, 1): USER, (USER, 2): ASSISTANT, (ASSISTANT, 1): USER}
_FILL = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}       # where an inserted or new role leads
_FILL_ROLE = {USER: "user", ASSISTANT: "assistant"}


# -- cost vectors ------------------------------------------------------------------------

def _with_inserts(v: list[int]) -> tuple[int, ...]:
    v = list(v)
    for _ in range(3):
        for q, to in _FILL.items():
            v[q] = min(v[q], INSERT + v[to])
    return tuple(min(x, FAR) for x in v)


def edits(symbol: int, q: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of every edit of a row in a state, in order of the letters."""
    if symbol == 0:
        return [("D", DELETE, q)]
    initial, late = (symbol - 1) % 4, TRUNCATED * (symbol > 4)
    keep = [("K", late, _NEXT[q, initial])] if (q, initial) in _NEXT else []
    return [("D", DELETE, q), *keep, ("R", REROLE + late, _FILL[q])]


def before(symbol: int, v: tuple[int, ...]) -> tuple[int, ...]:
    """Cost-to-go before a row, from the one after it."""
    return _with_inserts([min(min(c + v[to] for _, c, to in edits(symbol, q)), FAR) for q in range(4)])


def normal(v: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
    low = min(v)
    return tuple(x - low if x < FAR // 2 else FAR for x in v), low


END = _with_inserts([0, FAR, FAR, 0])                                       # an ended conversation


class Tables:
    """All vectors that can occur, and the transitions of single symbols and of blocks."""

    def __init__(self) -> None:
        self.vectors = [normal(v)[0] for v in (END, *(_with_inserts([FAR * (p != q) for p in range(4)]) for q in range(4)))]
        number = {v: i for i, v in enumerate(self.vectors)}
        to, cost = [], []
        for v in self.vectors:                                              # grows while it is read
            steps = [normal(before(s, v)) for s in range(N_SYMBOLS)]
            for w, _ in steps:
                if w not in number:
                    number[w] = len(self.vectors)
                    self.vectors.append(w)
            to.append([number[w] for w, _ in steps])
            cost.append([c for _, c in steps])
        self.to, self.cost = np.array(to), np.array(cost)
        block_to, block_cost = self.to, self.cost                           # [vector, symbols], last symbol first applied
        for _ in range(BLOCK - 1):
            block_cost = (block_cost[:, :, None] + self.cost[block_to]).reshape(len(self.vectors), -1)
            block_to = self.to[block_to].reshape(len(self.vectors), -1)
        self.block_to, self.block_cost = block_to.tolist(), block_cost.tolist()
        self.to, self.cost = to, cost                                       # plain lists are read one by one
        self.expanded: dict[tuple, tuple[str, int]] = {}

    def back(self, symbols: bytes, v: int) -> tuple[list[int], int]:
        """(vector at the start of each block and at the end, in order; cost added) from vector ``v`` at the end.

        The first block holds what does not fill one."""
        at, total = [v], 0
        for hi in range(len(symbols), BLOCK - 1, -BLOCK):
            code = block_code(symbols[hi - BLOCK:hi])
            total += self.block_cost[v][code]
            v = self.block_to[v][code]
            at.append(v)
        rest = symbols[:len(symbols) % BLOCK]
        for s in reversed(rest):
            total += self.cost[v][s]
            v = self.to[v][s]
        if rest:
            at.append(v)
        return at[::-1], total

    def trace(self, symbols: bytes, at: list[int], q: int) -> tuple[str, int]:
        """(edits of all rows, state after them) along the cheapest way from state ``q``; least letters first."""
        out, hi, k = [], len(symbols) % BLOCK or min(BLOCK, len(symbols)), 1
        lo = 0
        while lo < len(symbols):
            key = (symbols[lo:hi], at[k], q)
            if key not in self.expanded:
                self.expanded[key] = self._expand(*key)
            text, q = self.expanded[key]
            out.append(text)
            lo, hi, k = hi, hi + BLOCK, k + 1
        return "".join(out), q

    def _expand(self, block: bytes, end: int, q: int) -> tuple[str, int]:
        inner = [self.vectors[end]]
        for s in reversed(block):
            inner.append(before(s, inner[-1]))
        inner.reverse()
        out = []
        for i, s in enumerate(block):
            while True:
                ways = [*edits(s, q)]
                ways.insert(1, ("I", INSERT, _FILL[q]))                     # D < I < K < R
                for letter, c, to in ways:
                    if c + (inner[i] if letter == "I" else inner[i + 1])[to] == inner[i][q]:
                        break
                out.append(letter)
                q = to
                if letter != "I":
                    break
        return "".join(out), q


def closing(q: int) -> tuple[str, int]:
    """Inserts after the last row, and the state they end in."""
    text = ""
    while q not in (START, ASSISTANT):
        text, q = text + "I", _FILL[q]
    return text, q


def block_code(block: bytes) -> int:
    """Number of a block: the last symbol is the highest digit, as it is applied first."""
    code = 0
    for s in reversed(block):
        code = code * N_SYMBOLS + s
    return code


TABLES = Tables()


def matrix(symbols: bytes) -> list[int]:
    """16 costs from each state before the rows to each state after them, row by row (no inserts counted twice:
    those after the last row are part of the next segment)."""
    out = [[0] * 4 for _ in range(4)]
    for end in range(4):
        at, total = TABLES.back(symbols, 1 + end)
        for q, x in enumerate(TABLES.vectors[at[0]]):
            out[q][end] = min(total + x, FAR) if x < FAR else FAR
    return [x for row in out for x in row]


# -- rows --------------------------------------------------------------------------------

def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after the stated damage."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))       # noqa: E731
    h = F.pmod(F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")), F.lit(20))
    text = F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return (rows.select("conv_id", "turn", said("role").alias("role"), said("text").alias("text"), h.alias("h")).filter("h <> 0")
            .select("conv_id", "turn", F.when(F.col("h") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                    F.explode(F.when(F.col("h") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")))


def with_symbols(rows: DataFrame) -> DataFrame:
    """Rows with their fault (b, d, t or empty) and symbol; a copy is any row but the first of its role and text."""
    last = F.substring(F.btrim("text", F.lit(WHITE)), -1, 1)
    key = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"))
    order = F.struct(F.col("turn").isNotNull().alias("told"), "turn", "row")
    rows = store(rows.select("conv_id", "turn", "role", "text", last.alias("last"), key.alias("key"),
                             F.monotonically_increasing_id().alias("row")), "talk-rows")        # stored, so that the numbers stay
    again = (rows.filter("last <> ''").groupBy("conv_id", "key").agg(F.min(order).alias("first"), F.count("*").alias("n"))
             .filter("n > 1").select(F.col("conv_id").alias("c"), F.col("key").alias("k"), F.col("first.row").alias("first_row")))
    rows = rows.join(again, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("key") == F.col("k")), "left")
    fault = (F.when(F.col("last") == "", "b").when(F.col("first_row") != F.col("row"), "d")
             .when(~F.col("last").isin(".", "!", "?"), "t").otherwise(""))
    initial = F.substr("role", F.lit(1), F.lit(1))
    place = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    symbol = F.when(F.col("fault").isin("b", "d"), 0).otherwise(1 + place + F.when(F.col("fault") == "t", 4).otherwise(0))
    return (rows.withColumn("fault", fault).withColumn("symbol", symbol.cast("int")).withColumn("initial", initial)
            .select("conv_id", "turn", "role", "text", "row", "key", "fault", "symbol", "initial"))


# -- segments ----------------------------------------------------------------------------

_SEGMENT = ("seg long, whole boolean, n long, symbols binary, roles array<string>, texts array<string>, blank long, duplicate long, truncated long, "
            "illegal long, first_initial string, last_initial string, min_turn long, max_turn long, turns long")


def _illegal(a: str, b: str) -> bool:
    return a + b not in ("su", "ua", "au")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of a range to segments; ``whole``: the conversation surely lies inside this one."""
    task, number = TaskContext.get().partitionId(), 0
    rows: list[tuple] = []
    size, opened, conv = 0, True, None        # opened: the segment may go on one before

    def done(kind: pa.DataType, goes_on: bool) -> pa.RecordBatch:
        nonlocal number
        turns, roles, texts, faults, symbols, initials = (list(x) for x in zip(*rows))
        told = [t for t in turns if t is not None]
        number += 1
        one = {"conv_id": conv, "seg": (task << 33) + number, "whole": not opened and not goes_on, "n": len(rows), "symbols": bytes(symbols),
               "roles": roles, "texts": texts, "blank": faults.count("b"), "duplicate": faults.count("d"), "truncated": faults.count("t"),
               "illegal": sum(map(_illegal, initials[:-1], initials[1:])), "first_initial": initials[0], "last_initial": initials[-1],
               "min_turn": min(told, default=None), "max_turn": max(told, default=None),
               "turns": sum(a != b for a, b in zip([None, *told], told))}
        return pa.RecordBatch.from_pylist([one], schema=pa.schema([("conv_id", kind), *_ARROW]))

    kind = pa.int64()
    for b in batches:
        kind = b.schema.field("conv_id").type
        cols = [b.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "fault", "symbol", "initial")]
        for c, *row in zip(*cols):
            if rows and (c != conv or len(rows) >= SEGMENT_ROWS or size >= SEGMENT_BYTES):
                yield done(kind, c == conv)
                opened = c == conv
                rows, size = [], 0
            conv = c
            rows.append(tuple(row))
            size += len(row[2])
    if rows:
        yield done(kind, True)


_ARROW = [("seg", pa.int64()), ("whole", pa.bool_()), ("n", pa.int64()), ("symbols", pa.binary()), ("roles", pa.list_(pa.string())),
          ("texts", pa.list_(pa.string())), *((c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal")),
          ("first_initial", pa.string()), ("last_initial", pa.string()), *((c, pa.int64()) for c in ("min_turn", "max_turn", "turns"))]


def segments(rows: DataFrame) -> DataFrame:
    """Rows in order, in segments of bounded size; ``seg`` grows along a conversation."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    rows = with_symbols(damaged(rows.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.substring("role", 1, 64), F.substring("text", 1, 64), "key", "row"]
    return (rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("conv_id", "turn", "role", "text", "fault", "symbol", "initial")
            .mapInArrow(_cut, f"conv_id {kind}, {_SEGMENT}"))


# -- repair ------------------------------------------------------------------------------

def repaired(audit: str, roles: list[str], texts: list[str], q: int) -> list[str]:
    """The rows after the edits, from state ``q``, as ``role:text``."""
    out, i = [], 0
    for letter in audit:
        if letter == "D":
            i += 1
            continue
        if letter == "K":
            q = _NEXT[q, ROLES.index(roles[i][0])]
            out.append(f"{roles[i]}:{texts[i]}")
        else:
            q = _FILL[q]
            out.append(f"{_FILL_ROLE[q]}:{'' if letter == 'I' else texts[i]}")
        i += letter != "I"
    return out


def _repair_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations of one segment: audit, cost and checksum."""
    for b in batches:
        audits, costs, sums = [], [], []
        for symbols, roles, texts in zip(*(b.column(c).to_pylist() for c in ("symbols", "roles", "texts"))):
            at, total = TABLES.back(symbols, 0)
            audit, q = TABLES.trace(symbols, at, START)
            audit += closing(q)[0]
            audits.append(audit)
            costs.append(total + TABLES.vectors[at[0]][START] + min(END))
            sums.append(hashlib.sha256("\n".join(repaired(audit, roles, texts, START)).encode("utf-8", "surrogatepass")).hexdigest())
        yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("conv_id", *_FIGURES)), pa.array(costs, pa.int64()), pa.array(audits, pa.string()),
                                          pa.array(sums, pa.string())], names=["conv_id", *_FIGURES, "cost", "audit", "repaired_sha256"])


_FIGURES = ["gaps", "blank", "duplicate", "truncated", "illegal"]
_RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        m = [matrix(x) for x in b.column("symbols").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("conv_id"), b.column("seg"), pa.array(m, pa.list_(pa.int64()))], names=["conv_id", "seg", "m"])


def _join_costs(rows: pa.Table) -> pa.Table:
    """Of each segment of a conversation: cost-to-go at its end, less the least; of the first also the whole cost."""
    order = np.argsort(rows.column("seg").to_numpy())
    m = rows.column("m").to_pylist()
    v, base, ends, cost = END, 0, [None] * len(m), 0
    for i in order[::-1]:
        v, low = normal(v)
        base += low
        ends[i] = list(v)
        v = tuple(min(min(m[i][4 * q + to] + v[to] for to in range(4)), FAR) for q in range(4))
    cost = base + v[START]
    return pa.table([rows.column("conv_id"), rows.column("seg"), pa.array(ends, pa.list_(pa.int64())),
                     pa.array([cost if i == order[0] else 0 for i in range(len(m))], pa.int64())], names=["conv_id", "seg", "end", "cost"])


def _vector_number(end: list[int]) -> int:
    return TABLES.vectors.index(normal(_with_inserts(end))[0])


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state in which each segment ends, for each state it may start in."""
    for b in batches:
        exits = []
        for symbols, end in zip(b.column("symbols").to_pylist(), b.column("end").to_pylist()):
            at, _ = TABLES.back(symbols, _vector_number(end))
            exits.append([TABLES.trace(symbols, at, q)[1] if TABLES.vectors[at[0]][q] < FAR else q for q in range(4)])
        yield pa.RecordBatch.from_arrays([b.column("conv_id"), b.column("seg"), pa.array(exits, pa.list_(pa.int64()))], names=["conv_id", "seg", "exits"])


def _join_states(rows: pa.Table) -> pa.Table:
    """The state in which each segment of a conversation starts; of the last also the inserts after it."""
    order = np.argsort(rows.column("seg").to_numpy())
    exits = rows.column("exits").to_pylist()
    starts, q = [0] * len(exits), START
    for i in order:
        starts[i], q = q, exits[i][q]
    last = [closing(q)[0] if i == order[-1] else "" for i in range(len(exits))]
    return pa.table([rows.column("conv_id"), rows.column("seg"), pa.array(starts, pa.int64()), pa.array(last, pa.string())],
                    names=["conv_id", "seg", "start", "closing"])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audit and repaired text of each segment."""
    for b in batches:
        audits, texts = [], []
        for symbols, end, q, last, roles, said in zip(*(b.column(c).to_pylist() for c in ("symbols", "end", "start", "closing", "roles", "texts"))):
            at, _ = TABLES.back(symbols, _vector_number(end))
            audit = TABLES.trace(symbols, at, q)[0] + last
            audits.append(audit)
            lines = repaired(audit, roles, said, q)
            texts.append("\n".join(lines) if lines else None)
        yield pa.RecordBatch.from_arrays([b.column("conv_id"), b.column("seg"), pa.array(audits, pa.string()), pa.array(texts, pa.string())],
                                         names=["conv_id", "seg", "audit", "text"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by conversation and segment: one checksum and audit of each conversation."""
    conv, first, state, audits, kind = None, True, None, [], pa.int64()

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([conv], kind), pa.array(["".join(audits)]), pa.array([state.hexdigest()])],
                                          names=["conv_id", "audit", "repaired_sha256"])

    for b in batches:
        kind = b.schema.field("conv_id").type
        for c, audit, text in zip(*(b.column(x).to_pylist() for x in ("conv_id", "audit", "text"))):
            if state is None or c != conv:
                if state is not None:
                    yield done()
                conv, first, state, audits = c, True, hashlib.sha256(), []
            audits.append(audit)
            if text is not None:
                state.update((text if first else "\n" + text).encode("utf-8", "surrogatepass"))
                first = False
    if state is not None:
        yield done()


def _gaps(low: Column, high: Column, turns: Column) -> Column:
    return F.coalesce(high - low + 1 - turns, F.lit(0)).cast("long")


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation of (conv_id, turn, role, text): figures, cost, audit and checksum of the repair."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    segs = store(segments(rows), "talk-segments")
    whole = (segs.filter("whole").withColumn("gaps", _gaps(F.col("min_turn"), F.col("max_turn"), F.col("turns")))
             .mapInArrow(_repair_whole, f"conv_id {kind}, {_RESULT}"))

    # a conversation at the edge of a range, or of more than one segment
    part = segs.filter("NOT whole")
    same = lambda a, b: a["conv_id"].eqNullSafe(b["conv_id"]) & (a["seg"] == b["seg"])       # noqa: E731
    slim = part.select("conv_id", "seg", "symbols")
    ends = store(slim.mapInArrow(_matrices, f"conv_id {kind}, seg long, m array<long>")
                 .groupBy("conv_id").applyInArrow(_join_costs, f"conv_id {kind}, seg long, end array<long>, cost long"), "talk-ends")
    starts = (slim.join(ends, same(slim, ends)).select(slim["conv_id"], slim["seg"], "symbols", "end")
              .mapInArrow(_exits, f"conv_id {kind}, seg long, exits array<long>")
              .groupBy("conv_id").applyInArrow(_join_states, f"conv_id {kind}, seg long, start long, closing string"))
    starts = store(starts, "talk-starts")
    plan = ends.join(starts, same(ends, starts)).select(ends["conv_id"], ends["seg"], "end", "start", "closing")
    pieces = (part.join(plan, same(part, plan)).select(part["conv_id"], part["seg"], "symbols", "end", "start", "closing", "roles", "texts")
              .mapInArrow(_pieces, f"conv_id {kind}, seg long, audit string, text string"))
    digests = (pieces.repartition("conv_id").sortWithinPartitions("conv_id", "seg")
               .mapInArrow(_digests, f"conv_id {kind}, audit string, repaired_sha256 string"))

    # figures of such a conversation: sums, and what happens where two segments meet
    at = F.struct("seg", "first_initial", "last_initial", "min_turn", "max_turn", "turns", "illegal")
    meet = F.expr("""aggregate(s, named_struct('last', CAST(NULL AS string), 'turn', CAST(NULL AS bigint), 'illegal', 0L, 'turns', 0L),
        (a, x) -> named_struct('last', x.last_initial, 'turn', coalesce(x.max_turn, a.turn),
            'illegal', a.illegal + x.illegal + IF(a.last IS NULL OR concat(a.last, x.first_initial) IN ('su', 'ua', 'au'), 0L, 1L),
            'turns', a.turns + x.turns - IF(coalesce(a.turn = x.min_turn, false), 1L, 0L)))""")
    sums = (part.groupBy("conv_id").agg(F.sum("blank").alias("blank"), F.sum("duplicate").alias("duplicate"), F.sum("truncated").alias("truncated"),
                                        F.min("min_turn").alias("low"), F.max("max_turn").alias("high"), F.sort_array(F.collect_list(at)).alias("s"))
            .withColumn("meet", meet)
            .select("conv_id", _gaps(F.col("low"), F.col("high"), F.col("meet.turns")).alias("gaps"), "blank", "duplicate", "truncated",
                    F.col("meet.illegal").alias("illegal")))
    costs = ends.groupBy("conv_id").agg(F.sum("cost").alias("cost"))
    eq = lambda a, b: a["conv_id"].eqNullSafe(b["conv_id"])                 # noqa: E731
    cut = (sums.join(costs, eq(sums, costs)).join(digests, eq(sums, digests))
           .select(sums["conv_id"], *_FIGURES, "cost", "audit", "repaired_sha256"))
    found = whole.unionByName(cut)
    ids = rows.select("conv_id").distinct()
    nothing = hashlib.sha256(b"").hexdigest()
    return (ids.join(found, eq(ids, found), "left")
            .select(ids["conv_id"], *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in (*_FIGURES, "cost")],
                    F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256")))


@register("op12_conversation_repair")
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation, after the stated damage."""
    return repair(table(spark, sf_dir, "conversations"))
