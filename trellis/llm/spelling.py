"""Spelling variants: words one edit apart, found with k-d trees over letter counts.

One inserted or deleted letter changes a word's letter counts by 1 in sum, one replaced letter
by 2.  So the near words of a word lie in a box of the letter-count space: at L1 distance 2
among the words of its own length and at distance 1 among those one letter longer or shorter.

1. Spark extracts and counts the words; those long and frequent enough are the vocabulary.
2. The vocabulary is cut by length, and each length with more than ``CELL`` words by the top
   of a k-d tree.  Its splits come from at most ``SAMPLE`` words of that length; they move
   words between tasks and never change a result.
3. A word is at home in one cell of its length.  It is a guest in every other cell whose box
   is within its reach: cells of its own length at distance 2, of the next length at 1.
4. Each cell builds a k-d tree over its distinct count vectors and searches it with all
   vectors of the cell, pruned by the boxes of the nodes; at the leaves the counts are
   compared in unary code by population count.  Pairs of vectors are then expanded to pairs
   of words, and the order of letters decides.
5. A cell sends, for each word, the number of near words and the best one; Spark adds up.
6. Roots follow forms by pointer doubling; a chain is short, since n grows by ``RATIO`` a step.

Defined results: a null text has no words; a null doc_id counts as empty text in the damage
rule; repeated rows count as often as they occur; other columns are ignored; an empty table
gives an empty result.  Letter counts above 250 are taken as 250, which only lets a pair
through to the comparison of letters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trellis.llm.common import register, store, table

LEAST_LENGTH = 6
LEAST_COUNT = 5
RATIO = 5              # a form occurs at least so many times as often
DAMAGE = 199           # one run in so many loses a letter in the registered query
CELL = 8192            # words of a cell
SAMPLE = 4096          # words of a length that its splits are taken from
LEAF = 32              # vectors of a leaf inside a cell
QUERIES_AT_ONCE = 8192
PAIR_BYTES = 8_000_000  # letters compared at once
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RUNS = "[A-Za-z\\u00C0-\\u00FF]+"

# a-z and U+00C0 to U+00FF, as columns of the count vectors
_LETTER = np.full(256, -1, np.int64)
_LETTER[97:123] = np.arange(26)
_LETTER[192:256] = np.arange(26, 90)
_DIMS = 90
_UNARY = 4             # bits of a letter's unary code


# -- words -------------------------------------------------------------------------------

def lower_az(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def damaged(doc_id: Column, run: Column, every: int) -> Column:
    """The run without one letter if ``every`` divides the checksum of ``<doc_id>:<run>``."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = F.pmod(h, F.length(run)).cast("int")
    cut = F.concat(F.substr(run, F.lit(1), at), F.substr(run, at + 2))
    return F.when(F.pmod(h, F.lit(every)) == 0, cut).otherwise(run)


def vocabulary(docs: DataFrame, damage: int | None = None) -> DataFrame:
    """word, n: the words of all texts that are long and frequent enough."""
    runs = (docs.select("doc_id", F.explode(F.regexp_extract_all(lower_az(F.col("text")), F.lit(RUNS), F.lit(0))).alias("run"))
            .filter(F.length("run") >= LEAST_LENGTH))
    word = F.col("run") if damage is None else damaged(F.col("doc_id"), F.col("run"), damage)
    return (runs.select(word.alias("word")).filter(F.length("word") >= LEAST_LENGTH)
            .groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST_COUNT))


def letter_counts(words: list[bytes]) -> np.ndarray:
    """Counts of each letter in each word (latin-1), at most 250."""
    out = np.zeros((len(words), _DIMS), np.uint8)
    for lo in range(0, len(words), 10_000):
        some = words[lo:lo + 10_000]
        row = np.repeat(np.arange(len(some)), [len(w) for w in some])
        col = _LETTER[np.frombuffer(b"".join(some), np.uint8)]
        flat = np.bincount(row * _DIMS + col, minlength=len(some) * _DIMS)
        out[lo:lo + len(some)] = np.minimum(flat, 250).reshape(-1, _DIMS)
    return out


def box_distance(points: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """L1 distance of each point to a box (0 inside)."""
    return (np.maximum(points, hi) - hi + lo - np.minimum(points, lo)).sum(axis=1, dtype=np.int32)


# -- cells: the top of the tree ----------------------------------------------------------

def cell_boxes(sample: np.ndarray, n_words: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Boxes that share out the whole space so that each holds about ``most`` of ``n_words``."""
    boxes: list[tuple[np.ndarray, np.ndarray]] = []

    def cut(points: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> None:
        left = np.zeros(0, bool)
        if len(points) > 1 and n_words * len(points) > most * len(sample):
            middle = np.floor(np.median(points, axis=0)).astype(np.uint8)
            share = (points <= middle).mean(axis=0)
            below = np.maximum(middle, 1) - 1              # a median that is the largest value: split below it
            lower = (points <= below).mean(axis=0)
            use_lower = (middle > 0) & (np.abs(lower - 0.5) < np.abs(share - 0.5))
            at, share = np.where(use_lower, below, middle), np.where(use_lower, lower, share)
            dim = int(np.abs(share - 0.5).argmin())
            left = points[:, dim] <= at[dim]
        if not left.any() or left.all():
            boxes.append((lo, hi))
            return
        for side, low, high in ((left, None, at[dim]), (~left, at[dim] + 1, None)):
            a, b = lo.copy(), hi.copy()
            if high is not None:
                b[dim] = high
            else:
                a[dim] = low
            cut(points[side], a, b)

    cut(sample, np.zeros(_DIMS, np.uint8), np.full(_DIMS, 255, np.uint8))
    return np.stack([b[0] for b in boxes]), np.stack([b[1] for b in boxes])


_ROUTED = "length long, cell long, home boolean, word string, n long"


def _route(boxes: dict[int, tuple[np.ndarray, np.ndarray]]):
    """Each word to its home cell and to the cells that it may have near words in."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = b.column("word")
            text = [w.encode("latin-1") for w in words.to_pylist()]
            size = np.array([len(w) for w in text], np.int64)
            counts = letter_counts(text)
            row, length, cell, home = [], [], [], []
            for n in np.unique(size):
                mine = np.flatnonzero(size == n)
                own = np.full(len(mine), -1)
                for d, reach in ((0, 2), (1, 1)):
                    lows, highs = boxes.get(int(n) + d, ((), ()))
                    for c, (lo, hi) in enumerate(zip(lows, highs)):
                        far = box_distance(counts[mine], lo, hi)
                        if d == 0:                         # a pair of two cells is looked for in the later one
                            own[(far == 0) & (own < 0)] = c
                            go = (far <= reach) & (own >= 0)
                        else:
                            go = far <= reach
                        at = mine[go]
                        row.append(at)
                        length.append(np.full(len(at), n + d))
                        cell.append(np.full(len(at), c))
                        home.append((own[go] == c) if d == 0 else np.zeros(len(at), bool))
            if row:
                at = pa.array(np.concatenate(row))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(length)), pa.array(np.concatenate(cell)), pa.array(np.concatenate(home)),
                     words.take(at), b.column("n").take(at)], names=["length", "cell", "home", "word", "n"])
    return run


# -- inside a cell -----------------------------------------------------------------------

class KdTree:
    """Distinct count vectors; nodes are (lo, hi, points, left, right) with tight boxes."""

    def __init__(self, points: np.ndarray, codes: np.ndarray):
        self.points, self.codes = points, codes
        self.root = self._node(np.arange(len(points)))

    def _node(self, at: np.ndarray):
        mine = self.points[at]
        lo, hi = mine.min(axis=0), mine.max(axis=0)
        if len(at) <= LEAF:
            return lo, hi, at, None, None
        spread = mine.astype(np.float32).var(axis=0)
        dim = int(spread.argmax())
        middle = np.median(mine[:, dim])
        left = mine[:, dim] <= middle if middle < hi[dim] else mine[:, dim] < middle
        return lo, hi, None, self._node(at[left]), self._node(at[~left])

    def within(self, queries: np.ndarray, codes: np.ndarray, radius: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, point) at no more than each query's radius."""
        stack = [(self.root, np.arange(len(queries)))]
        while stack:
            (lo, hi, at, left, right), alive = stack.pop()
            alive = alive[box_distance(queries[alive], lo, hi) <= radius[alive]]
            if not len(alive):
                continue
            if at is None:
                stack += [(left, alive), (right, alive)]
                continue
            for p in at:
                apart = np.bitwise_count(codes[alive] ^ self.codes[p]).sum(axis=1, dtype=np.int32)
                hit = alive[apart <= radius[alive]]
                if len(hit):
                    yield hit, np.full(len(hit), p)


def unary_codes(counts: np.ndarray) -> np.ndarray:
    """Counts in unary, packed: the number of bits two codes differ in is at most their L1 distance."""
    bits = counts[:, :, None] > np.arange(_UNARY, dtype=np.uint8)
    packed = np.packbits(bits.reshape(len(counts), -1), axis=1)
    return np.ascontiguousarray(np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8)))).view(np.uint64)


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rows of two letter tables that differ in exactly one place."""
    return (a != b).sum(axis=1) == 1


def one_inserted(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Rows of ``long`` that are the row of ``short`` with one letter more."""
    n = short.shape[1]
    head = np.where((short != long[:, :n]).any(axis=1), (short != long[:, :n]).argmax(axis=1), n)
    back = (short != long[:, 1:])[:, ::-1]
    tail = np.where(back.any(axis=1), back.argmax(axis=1), n)
    return head + tail >= n


def _letters(words: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1)


def near_pairs(members: list[bytes], others: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (query, member) one edit apart, each pair of members once.

    ``members`` are of one length; the queries are the members and then ``others``, which are
    of the same length or one letter shorter."""
    n = len(members[0])
    lists = [members, [w for w in others if len(w) == n], [w for w in others if len(w) < n]]
    place = [np.arange(len(members))] + [len(members) + np.flatnonzero([len(w) == m for w in others]) for m in (n, n - 1)]
    vectors, member_of, member_start = _classes(letter_counts(members))
    tree = KdTree(vectors, unary_codes(vectors))
    letters = _letters(members)
    for kind, (words, places) in enumerate(zip(lists, place)):
        if not words:
            continue
        own, table_q = kind == 0, _letters(words)
        queries, query_of, query_start = (vectors, member_of, member_start) if own else _classes(letter_counts(words))
        width = n + table_q.shape[1]
        for lo in range(0, len(queries), QUERIES_AT_ONCE):
            some = queries[lo:lo + QUERIES_AT_ONCE]
            radius = np.full(len(some), 1 if kind == 2 else 2)
            held: list[tuple[np.ndarray, np.ndarray]] = []
            size = 0
            for q, p in tree.within(some, unary_codes(some), radius):
                q = q + lo
                if own:                                    # equal vectors are never one edit apart
                    q, p = q[q < p], p[q < p]
                held.append((q, p))
                size += int((np.diff(query_start)[q] * np.diff(member_start)[p]).sum())
                if size * width > PAIR_BYTES:
                    yield from _verified(held, query_of, query_start, member_of, member_start, table_q, letters, places)
                    held, size = [], 0
            yield from _verified(held, query_of, query_start, member_of, member_start, table_q, letters, places)


def _classes(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct vectors, rows in order of their vector, start of each vector's rows)."""
    raw = np.ascontiguousarray(counts).view(np.dtype((np.void, counts.shape[1]))).ravel()
    distinct, which = np.unique(raw, return_inverse=True)
    order = np.argsort(which, kind="stable")
    start = np.searchsorted(which[order], np.arange(len(distinct) + 1))
    return counts[order[start[:-1]]], order, start


def _verified(held, query_of, query_start, member_of, member_start, table_q, letters, places):
    """Expand pairs of vectors to pairs of words and compare the letters."""
    if not held:
        return
    q, p = (np.concatenate(x) for x in zip(*held))
    nq, np_ = np.diff(query_start)[q], np.diff(member_start)[p]
    size = nq * np_
    step = max(1, PAIR_BYTES // (table_q.shape[1] + letters.shape[1]))
    ends = np.cumsum(size)
    lo = 0
    while lo < len(q):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + step, side="right")))
        which = np.repeat(np.arange(lo, hi), size[lo:hi])
        inner = np.arange(len(which)) - np.repeat(ends[lo:hi] - size[lo:hi] - (ends[lo] - size[lo]), size[lo:hi])
        a = query_of[query_start[q[which]] + inner // np_[which]]
        b = member_of[member_start[p[which]] + inner % np_[which]]
        same = table_q.shape[1] == letters.shape[1]
        good = (one_replaced if same else one_inserted)(table_q[a], letters[b])
        if good.any():
            yield places[a[good]], b[good]
        lo = hi


_NEAR = "word string, n_near long, best_n long, best string"


def _search(rows: pa.Table) -> pa.Table:
    """In one cell: of each word the number of near words and the best of them."""
    empty = pa.table([pa.array([], t) for t in (pa.string(), pa.int64(), pa.int64(), pa.string())], names=["word", "n_near", "best_n", "best"])
    home = rows.column("home").to_numpy(zero_copy_only=False)
    rows = pa.concat_tables([rows.filter(pa.array(home)), rows.filter(pa.array(~home))])
    words = rows.column("word").to_pylist()
    n = rows.column("n").to_numpy()
    text = [w.encode("latin-1") for w in words]
    n_home = int(home.sum())
    if not n_home:
        return empty
    found = list(near_pairs(text[:n_home], text[n_home:]))
    if not found:
        return empty
    a, b = (np.concatenate(x) for x in zip(*found))
    a, b = np.concatenate([a, b]), np.concatenate([b, a])
    rank = np.empty(len(words), np.int64)
    rank[sorted(range(len(words)), key=text.__getitem__)] = np.arange(len(words))
    order = np.lexsort((rank[b], -n[b], a))
    a, b = a[order], b[order]
    first = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
    near = np.diff(np.append(first, len(a)))
    take = lambda at: rows.column("word").take(pa.array(at))
    return pa.table([take(a[first]), pa.array(near), pa.array(n[b[first]]), take(b[first])], names=["word", "n_near", "best_n", "best"])


# -- the operator ------------------------------------------------------------------------

def near_words(vocab: DataFrame) -> DataFrame:
    """word, n_near, best, best_n of every word of (word, n) that has a near word."""
    sized = vocab.withColumn("length", F.length("word"))
    sizes = {r["length"]: r["words"] for r in sized.groupBy("length").agg(F.count("*").alias("words")).collect()}  # one row per length
    large = {k: v for k, v in sizes.items() if v > CELL}
    whole = (np.zeros((1, _DIMS), np.uint8), np.full((1, _DIMS), 255, np.uint8))
    boxes = {k: whole for k in sizes}
    if large:
        count = F.create_map(*[F.lit(x) for kv in large.items() for x in kv])
        some = sized.filter(F.col("length").isin(list(large)) & (F.pmod(F.xxhash64("word"), F.try_element_at(count, F.col("length"))) < SAMPLE))
        by_length: dict[int, list[bytes]] = {k: [] for k in large}
        for r in some.select("word").collect():                   # about SAMPLE words of each large length
            by_length[len(r["word"])].append(r["word"].encode("latin-1"))
        boxes |= {k: cell_boxes(letter_counts(v), sizes[k], CELL) for k, v in by_length.items() if v}
    routed = vocab.select("word", "n").mapInArrow(_route(boxes), _ROUTED)
    found = routed.groupBy("length", "cell").applyInArrow(_search, _NEAR)
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("top"))
            .select("word", "n_near", F.col("top.best").alias("best"), (-F.col("top.less")).alias("best_n")))


def roots(forms: DataFrame) -> DataFrame:
    """word, root: from each word of (word, form), follow the forms to the last one."""
    now = store(forms.select("word", F.col("form").alias("root")), "spell-roots")
    while True:
        step = now.join(now.select(F.col("word").alias("root"), F.col("root").alias("next")), "root", "left")
        now = store(step.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spell-roots")
        if now.filter("moved").isEmpty():
            return now.select("word", "root")
        now = now.select("word", "root")


def group_variants(docs: DataFrame, damage: int | None = None) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word of the vocabulary of ``docs``."""
    vocab = store(vocabulary(docs, damage), "spell-words")
    near = vocab.join(near_words(vocab), "word", "left")
    is_form = F.col("best_n") >= RATIO * F.col("n")
    rows = store(near.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                             F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n")), "spell-near")
    return (rows.join(roots(rows.filter("form IS NOT NULL")), "word", "left")
            .select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")))


@register("op13_spelling_variants")
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants of the words of all documents, after the stated damage."""
    return group_variants(table(spark, sf_dir, "documents"), DAMAGE)
