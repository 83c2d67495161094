"""N-gram language model in an Elias-Fano trie.

Model.  Tokens are the lower-cased words of a text and one end mark.  Unigrams are add-one
smoothed.  All longer n-grams are kept and smoothed by interpolated absolute discounting:
p(w | c) = (count(c w) - D) / count(c), plus the mass that the context's n-grams leave times
p(w | shorter context).  D comes from the counts of counts of all n-grams of that length,
n1 / (n1 + 2 n2).  A caller may pass a ``min_count`` above 1 for a smaller model: rarer n-grams
then go, and D of trigrams misses those below dropped bigrams.

Trie.  Level 1 is the vocabulary: sorted word hashes with counts; a word's id is its rank.
Level k holds, for each node of level k - 1, the sorted ids of the words that follow it.  The
starts of these ranges (pointers) and the followers are sorted numbers in Elias-Fano code;
discounted probabilities and left-over masses are one byte each on a logarithmic scale.  A
follower is found by successor search inside its context's range.  Levels are cut into
segments by context, one file each in the shared folder, which the tasks memory-map.

Counting.  Each task counts the n-grams of a run of texts and sends packed arrays of distinct
n-grams with counts to the part their hash belongs to; there the counts are added up.  A hot
context is spread over all parts by then; what is left of it (at most one entry per word) goes
to its segment.  An n-gram is only counted if both shorter n-grams inside it were kept: it
cannot reach ``min_count`` otherwise.  An n-gram travels as one 64-bit number, its context's
id above as many bits as the word ids need.

Held-out rows (by hash of the id) are never counted.  Words are told apart by 64-bit hashes.

Defined results: a null text counts as empty and has the end mark alone; without training
rows every token has probability 1; repeated rows count as often as they occur; other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trellis.llm.array_file import open_arrays, save_arrays
from trellis.llm.common import register, store, table
from trellis.llm.elias_fano import EliasFano, encode
from trellis.llm.word_hash import chunks, mix, word_hashes
from trellis.session import scratch_path

FOLDS = 7
HELD_OUT = 2
ORDER = 3
MIN_COUNT = 1
RUN_BYTES = 3_000_000         # text a task counts at once
FLUSH = 500_000               # distinct n-grams a task holds before it sends them
PART_TOKENS = 6_000_000       # tokens whose n-grams one part, or one segment, has on average at most
END = mix(np.array([0x656E64], np.uint64))[0]
_32 = np.uint64(32)


def word_bits(n_words: int) -> int:
    """Bits of a word id in a packed n-gram; the context's id has the others."""
    return max(int(n_words - 1).bit_length(), 1)


def packed(context: np.ndarray, word: np.ndarray, bits: int) -> np.ndarray:
    return (context.astype(np.uint64) << np.uint64(bits)) | word.astype(np.uint64)


def context_of(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> np.uint64(bits)).astype(np.int64)


def word_of(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys & np.uint64((1 << bits) - 1)).astype(np.int64)


def tokens(run: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(token hashes, start of each text): the words of each text and the end mark."""
    h, bounds = word_hashes(run)
    return np.insert(h, bounds[1:], END), bounds + np.arange(len(bounds))


def add_up(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted keys with the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    return ((keys >> _32) * np.uint64(parts) >> _32).astype(np.int64)


class Pending:
    """Counts of one task until they are sent."""

    def __init__(self, parts: int, spread: bool):
        self.parts, self.spread = parts, spread
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.held.append((keys, counts))
        self.size += len(keys)
        if self.size > 2 * FLUSH:
            keys, counts = self._merged()
            self.held, self.size = [(keys, counts)], len(keys)
            if self.size > FLUSH:
                yield from self.send()

    def _merged(self) -> tuple[np.ndarray, np.ndarray]:
        return add_up(*(np.concatenate(x) for x in zip(*self.held)))

    def send(self) -> Iterator[pa.RecordBatch]:
        if not self.size:
            return
        keys, counts = self._merged()
        self.held, self.size = [], 0
        yield dealt(part_of(mix(keys) if self.spread else keys, self.parts), keys, counts, self.parts)


_COUNTS = "part int, keys binary, counts binary"


def _planes(a: np.ndarray) -> bytes:
    """Numbers byte plane by byte plane, as many as the largest needs: high bytes compress well."""
    width = -(-int(a.max()).bit_length() // 8) if len(a) else 0
    return bytes([width]) + np.ascontiguousarray(a.astype(np.uint64).view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _from_planes(b: bytes) -> np.ndarray:
    planes = np.frombuffer(b, np.uint8, offset=1).reshape(b[0], -1) if b[0] else np.zeros((0, 0), np.uint8)
    wide = np.zeros((planes.shape[1], 8), np.uint8)
    wide[:, :b[0]] = planes.T
    return wide.view(np.uint64).ravel()


def coded_keys(keys: np.ndarray) -> bytes:
    """Sorted distinct keys: the first, then the gaps."""
    return keys[:1].tobytes() + _planes(np.diff(keys)) if len(keys) else b""


def decoded_keys(b: bytes) -> np.ndarray:
    if not b:
        return np.zeros(0, np.uint64)
    return np.cumsum(np.concatenate([np.frombuffer(b[:8], np.uint64), _from_planes(b[8:])]), dtype=np.uint64)


def dealt(part: np.ndarray, keys: np.ndarray, counts: np.ndarray, parts: int) -> pa.RecordBatch:
    """One row of packed arrays for each part; the keys are sorted and distinct."""
    order = np.argsort(part.astype(np.uint16) if parts < 65536 else part, kind="stable")
    cuts = np.searchsorted(part[order], np.arange(parts + 1))
    used = np.flatnonzero(np.diff(cuts))
    return pa.RecordBatch.from_arrays(
        [pa.array(used.astype(np.int32)),
         pa.array([coded_keys(keys[order[cuts[p]:cuts[p + 1]]]) for p in used], pa.binary()),
         pa.array([_planes(counts[order[cuts[p]:cuts[p + 1]]]) for p in used], pa.binary())],
        names=["part", "keys", "counts"])


def unpacked(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    keys = [np.zeros(0, np.uint64), *map(decoded_keys, rows.column("keys").to_pylist())]
    counts = [np.zeros(0, np.uint64), *map(_from_planes, rows.column("counts").to_pylist())]
    return np.concatenate(keys), np.concatenate(counts).astype(np.int64)


# -- byte scale --------------------------------------------------------------------------

def to_bytes(p: np.ndarray) -> tuple[np.ndarray, float]:
    """Probabilities as one byte each on a logarithmic scale: (codes, step); 1.0 is exact."""
    logs = -np.log10(np.clip(p, 1e-12, 1.0))
    step = max(float(logs.max()) / 255, 1e-6) if len(p) else 1e-6
    return np.rint(logs / step).astype(np.uint8), step


def from_bytes(codes: np.ndarray, step: float) -> np.ndarray:
    return (10.0 ** (-step * np.arange(256.0)))[codes]


@functools.lru_cache(maxsize=100_000)
def coded(uri: str, prefix: str) -> EliasFano:
    """A reader of the arrays of a file: one for each file and task process."""
    return EliasFano(open_arrays(uri), prefix)


# -- reading the trie --------------------------------------------------------------------

@dataclass
class Level:
    """Segments of one level: for each, its file ("" if it is empty), the first context it
    covers and the id of its first node; both lists have one more entry, the end."""

    files: list[str]
    contexts: list[int]
    nodes: list[int]
    discount: float = 0.0

    def find(self, context: np.ndarray, word: np.ndarray, n_words: int, scored: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Of each distinct (context, word), in order: node id (-1: none) and, if ``scored``, discounted probability."""
        node, p = np.full(len(context), -1, np.int64), np.zeros(len(context))
        for s, at, seg in self._split(context):
            rank = context[at] - self.contexts[s]
            new = np.concatenate([[True], rank[1:] != rank[:-1]])
            ptr, inverse = rank[new], np.cumsum(new) - 1
            lo, hi = coded(self.files[s], "ptr_").ranges(ptr)
            least = (ptr * n_words).astype(np.uint64)
            place = coded(self.files[s], "next_").find((rank * n_words + word[at]).astype(np.uint64), lo, hi, inverse,
                                                       least, least + np.uint64(n_words - 1))
            hit = place >= 0
            node[at][hit] = place[hit] + self.nodes[s]
            if scored:
                p[at][hit] = from_bytes(seg["prob"][place[hit]], float(seg["steps"][0]))
        return node, p

    def left_over(self, context: np.ndarray) -> np.ndarray:
        """Mass that the kept n-grams of a context leave to the shorter one; contexts in order."""
        out = np.ones(len(context))
        for s, at, seg in self._split(context):
            out[at] = from_bytes(seg["left"][context[at] - self.contexts[s]], float(seg["steps"][1]))
        return out

    def _split(self, context: np.ndarray) -> Iterator[tuple[int, slice, dict]]:
        """Sorted contexts by segment."""
        cuts = np.searchsorted(context, self.contexts)
        for s in np.flatnonzero(np.diff(cuts)):
            if self.files[s]:
                yield int(s), slice(cuts[s], cuts[s + 1]), open_arrays(self.files[s])


@dataclass
class Trie:
    """The whole model: a few numbers and the places of its files."""

    vocab: list[str] = field(default_factory=list)
    first: list[int] = field(default_factory=list)      # id of the first word of each part; one more, the end
    total: int = 0
    levels: list[Level] = field(default_factory=list)

    @property
    def n_words(self) -> int:
        return self.first[-1] if self.first else 0

    def words(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of sorted distinct hashes: word id (-1: unknown) and count."""
        ids, counts = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        if not self.vocab:
            return ids, counts
        cuts = np.searchsorted(part_of(hashes, len(self.vocab)), np.arange(len(self.vocab) + 1))
        for p in np.flatnonzero(np.diff(cuts)):
            if not self.vocab[p]:
                continue
            seg, mine = open_arrays(self.vocab[p]), slice(cuts[p], cuts[p + 1])
            at = np.searchsorted(seg["hashes"], hashes[mine])
            at[at == len(seg["hashes"])] = 0
            hit = seg["hashes"][at] == hashes[mine]
            ids[mine] = np.where(hit, at + self.first[p], -1)
            counts[mine] = np.where(hit, seg["counts"][at], 0)
        return ids, counts

    def word_counts(self, lo: int, hi: int) -> np.ndarray:
        """Counts of the words with ids from ``lo`` to ``hi`` (exclusive)."""
        out = [np.zeros(0, np.int64)]
        for p, (a, b) in enumerate(zip(self.first[:-1], self.first[1:])):
            if self.vocab[p] and a < hi and b > lo:
                out.append(open_arrays(self.vocab[p])["counts"][max(lo - a, 0):min(hi, b) - a])
        return np.concatenate(out)


@dataclass
class Line:
    """Tokens of a run of texts as the trie sees them."""

    ids: np.ndarray
    counts: np.ndarray
    bounds: np.ndarray
    place: np.ndarray           # of a token in its text
    nodes: list[np.ndarray]     # by level from 2: node of the n-gram that ends at a token
    probs: list[np.ndarray]     # the same, if scored
    lefts: list[np.ndarray]


def distinct(keys: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct ``keys``, all at most ``most``, and the rank of each: places are sorted below the keys."""
    bits = int(len(keys)).bit_length()
    if most.bit_length() + bits > 64:                              # a very long text
        return np.unique(keys, return_inverse=True)
    both = np.sort((keys << np.uint64(bits)) | np.arange(len(keys), dtype=np.uint64))
    at, keys = (both & np.uint64((1 << bits) - 1)).astype(np.int64), both >> np.uint64(bits)
    new = np.ones(len(keys), bool)
    np.not_equal(keys[1:], keys[:-1], out=new[1:])
    rank = np.empty(len(keys), np.int64)
    rank[at] = np.cumsum(new) - 1
    return keys[new], rank


def ranked(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes and the rank of each: grouped by hashing, as most words come often."""
    groups = pa.array(h).dictionary_encode()
    known = groups.dictionary.to_numpy(zero_copy_only=False)
    order = np.argsort(known)
    rank = np.empty(len(known), np.int64)
    rank[order] = np.arange(len(known))
    return known[order], rank[groups.indices.to_numpy(zero_copy_only=False)]


def look_up(trie: Trie, run: list[bytes], scored: bool = True) -> Line:
    """Walk the trie along all tokens of a run; each distinct n-gram is searched once.

    Within a run, words and contexts go by their ranks among the distinct ones, in the order of the
    trie's ids, so an n-gram and its place fit a number.  Without ``scored`` only nodes are looked up."""
    h, bounds = tokens(run)
    known, word = ranked(h)
    word_ids, word_counts = trie.words(known)
    ids, counts = word_ids[word], word_counts[word]
    place = np.arange(len(h)) - np.repeat(bounds[:-1], np.diff(bounds))
    nodes, probs, lefts = [], [], []
    before, before_ids = word, word_ids            # rank of the context that ends at a token; its node by rank
    bits = np.uint64(word_bits(len(known)))
    for k, level in enumerate(trie.levels, start=1):
        at = np.flatnonzero(place >= k)
        rank = before[at - 1]
        good = before_ids[rank] >= 0
        if not scored:
            good &= ids[at] >= 0
        at, rank = at[good], rank[good]
        keys, back = distinct(packed(rank, word[at], int(bits)), len(before_ids) << int(bits))
        of, to = context_of(keys, int(bits)), word_ids[word_of(keys, int(bits))]
        context = before_ids[of]
        found, prob = np.full(len(keys), -1, np.int64), np.zeros(len(keys))
        both = np.flatnonzero(to >= 0)
        found[both], prob[both] = level.find(context[both], to[both], trie.n_words, scored)
        node = np.full(len(h), -1, np.int64)
        node[at] = found[back]
        nodes.append(node)
        if scored:
            p, left = np.zeros(len(h)), np.ones(len(h))
            new = np.ones(len(of), bool)
            np.not_equal(of[1:], of[:-1], out=new[1:])
            p[at] = prob[back]
            left[at] = level.left_over(context[new])[np.cumsum(new) - 1][back]
            probs.append(p)
            lefts.append(left)
        if k == len(trie.levels):
            break
        # tokens without a context at this level point at one more rank, which has no node
        before = np.full(len(h), len(found))
        before[at] = back
        before_ids = np.append(found, -1)
    return Line(ids, counts, bounds, place, nodes, probs, lefts)


# -- building ----------------------------------------------------------------------------

def fold_of(doc_id: Column, folds: int = FOLDS) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds))


def _count_words(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending = Pending(parts, spread=False)
        for b in batches:
            for _, texts in chunks(b.column("text").to_pylist(), RUN_BYTES):
                yield from pending.add(*(x.astype(t) for x, t in zip(np.unique(tokens(texts)[0], return_counts=True), (np.uint64, np.int64))))
        yield from pending.send()
    return run


def _save_words(folder: str):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        part = key[0].as_py()
        hashes, counts = add_up(*unpacked(rows))
        uri = f"{folder}/words-{part:06d}"
        save_arrays(uri, {"hashes": hashes, "counts": counts})
        return pa.table({"part": pa.array([part], pa.int32()), "uri": [uri], "n": pa.array([len(hashes)], pa.int64()),
                         "total": pa.array([int(counts.sum())], pa.int64())})
    return run


def _count_ngrams(trie: Trie, parts: int):
    """Occurrences of n-grams one longer than the trie holds, where both shorter ones are kept."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, bits = len(trie.levels), word_bits(trie.n_words)
        pending = Pending(parts, spread=True)
        for b in batches:
            for _, texts in chunks(b.column("text").to_pylist(), RUN_BYTES):
                line = look_up(trie, texts, scored=False)
                ends = line.nodes[-1] if k else line.ids           # n-grams of length k + 1 by their end
                context = np.concatenate([[-1], ends[:-1]])
                good = (line.place > k) & (context >= 0) & (ends >= 0)
                keys, counts = np.unique(packed(context[good], line.ids[good], bits), return_counts=True)
                yield from pending.add(keys, counts.astype(np.int64))
        yield from pending.send()
    return run


_KEPT = "part int, keys binary, counts binary, once long, twice long"


def _keep_frequent(contexts: list[int], bits: int, min_count: int):
    """In one part: drop rare n-grams, send the others to the segment of their context."""
    def run(rows: pa.Table) -> pa.Table:
        keys, counts = add_up(*unpacked(rows))
        once, twice = int((counts == 1).sum()), int((counts == 2).sum())
        keys, counts = keys[counts >= min_count], counts[counts >= min_count]
        segment = np.searchsorted(contexts, context_of(keys, bits), side="right") - 1
        out = pa.Table.from_batches([dealt(segment, keys, counts, len(contexts) - 1)])
        first = [once] + [0] * (out.num_rows - 1), [twice] + [0] * (out.num_rows - 1)
        if not out.num_rows:                                       # only the counts of counts
            out = pa.table({"part": pa.array([-1], pa.int32()), "keys": pa.array([b""], pa.binary()), "counts": pa.array([_planes(counts)], pa.binary())})
        return (out.append_column("once", pa.array(first[0], pa.int64()))
                .append_column("twice", pa.array(first[1], pa.int64())))
    return run


def build_segment(keys: np.ndarray, counts: np.ndarray, lo: int, context_counts: np.ndarray, n_words: int,
                  discount: float) -> dict[str, np.ndarray]:
    """Arrays of one segment: contexts from ``lo`` on, as many as ``context_counts``."""
    bits = word_bits(n_words)
    rank, word = context_of(keys, bits) - lo, word_of(keys, bits)
    n = len(context_counts)
    starts = np.searchsorted(rank, np.arange(n + 1))
    p = (counts - discount) / context_counts[rank]
    left = 1.0 - np.bincount(rank, weights=p, minlength=n)
    prob, step = to_bytes(p)
    rest, rest_step = to_bytes(np.maximum(left, 1e-6))
    pointers = {f"ptr_{k}": a for k, a in encode(starts, len(keys) + 1).items()}
    followers = {f"next_{k}": a for k, a in encode(rank * n_words + word, n * n_words).items()}
    return {**pointers, **followers, "prob": prob, "left": rest, "steps": np.array([step, rest_step])}


def _save_segment(folder: str, trie: Trie, contexts: list[int], discount: float, last: bool):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        part = key[0].as_py()
        keys, counts = add_up(*unpacked(rows))
        lo, hi = contexts[part], contexts[part + 1]
        above = open_arrays(trie.levels[-1].files[part])["counts"] if trie.levels else trie.word_counts(lo, hi)
        uri = f"{folder}/level{len(trie.levels) + 2}-{part:06d}"
        arrays = build_segment(keys, counts, lo, above, trie.n_words, discount)
        if not last:                                   # the next level divides by them
            arrays["counts"] = counts.astype(np.min_scalar_type(int(counts.max())))
        save_arrays(uri, arrays)
        return pa.table({"part": pa.array([part], pa.int32()), "uri": [uri], "n": pa.array([len(keys)], pa.int64()),
                         "total": pa.array([int(counts.sum())], pa.int64())})
    return run


_FILE = "part int, uri string, n long, total long"


def train(texts: DataFrame, order: int = ORDER, min_count: int = MIN_COUNT) -> Trie:
    """Build the trie from all rows of ``texts`` (column ``text``).

    Parts and segments are as many as keep each near ``PART_TOKENS`` tokens, so none grows with
    the data (words: ``spark.sql.shuffle.partitions``).  The driver keeps one row per file."""
    spark = texts.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = scratch_path(spark, "lm")
    texts = texts.select("text")

    def files(made: DataFrame, name: str) -> tuple[list[str], list[int], int]:
        rows = {r["part"]: r for r in store(made, name).collect()}    # one row per part
        uris = [rows[p]["uri"] if p in rows else "" for p in range(parts)]
        ends = np.cumsum([0] + [rows[p]["n"] if p in rows else 0 for p in range(parts)]).tolist()
        return uris, ends, sum(r["total"] for r in rows.values())

    words = texts.mapInArrow(_count_words(parts), _COUNTS).groupBy("part").applyInArrow(_save_words(folder), _FILE)
    uris, ends, total = files(words, "lm-words")
    trie = Trie(uris, ends, total)
    parts = max(parts, -(-total // PART_TOKENS))
    contexts = [trie.n_words * s // parts for s in range(parts + 1)]
    while len(trie.levels) < order - 1 and contexts[-1]:
        bits = word_bits(trie.n_words)
        if contexts[-1] > 2**(64 - bits):
            raise ValueError(f"more than 2^{64 - bits} contexts in a level beside {trie.n_words} words")
        kept = store(texts.mapInArrow(_count_ngrams(trie, parts), _COUNTS)
                     .groupBy("part").applyInArrow(_keep_frequent(contexts, bits, min_count), _KEPT), "lm-kept")
        once, twice = kept.agg(F.sum("once"), F.sum("twice")).first()
        discount = min(max(once / (once + 2 * twice), 0.1), 0.95) if once else 0.5
        made = kept.filter("part >= 0").select("part", "keys", "counts").groupBy("part").applyInArrow(
            _save_segment(folder, trie, contexts, discount, len(trie.levels) == order - 2), _FILE)
        uris, ends, _ = files(made, "lm-files")
        trie = Trie(trie.vocab, trie.first, trie.total, [*trie.levels, Level(uris, contexts, ends, discount)])
        contexts = ends
    return trie


# -- scoring -----------------------------------------------------------------------------

def score(trie: Trie, run: list[bytes]) -> tuple[np.ndarray, ...]:
    """(tokens, known tokens, unigram log10, model log10) of each text of a run."""
    line = look_up(trie, run)
    p = base = (line.counts + 1) / (trie.total + trie.n_words + 1)
    for prob, left in zip(line.probs, line.lefts):
        p = prob + left * p
    at = line.bounds[:-1]
    return (np.diff(line.bounds), np.add.reduceat((line.counts > 0).astype(np.int64), at),
            np.add.reduceat(np.log10(base), at), np.add.reduceat(np.log10(np.minimum(p, 1.0)), at))


def add_scores(docs: DataFrame, trie: Trie) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score, score of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [score(trie, texts) for _, texts in chunks(b.column("text").to_pylist(), RUN_BYTES)]
            cols = [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, t) for t in (np.int64, np.int64, float, float)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *map(pa.array, cols)],
                                             names=["doc_id", "n_tokens", "n_known", "base_score", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens long, n_known long, base_score double, score double")


@register("op10_elias_fano_lm")
def op10_elias_fano_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probability of every document under the model of the training folds."""
    docs = table(spark, sf_dir, "documents")
    trie = train(docs.filter(~F.coalesce(fold_of(F.col("doc_id")) == HELD_OUT, F.lit(False))))
    return add_scores(docs, trie).select(
        "doc_id", F.coalesce(fold_of(F.col("doc_id")) == HELD_OUT, F.lit(False)).alias("held_out"), "n_tokens", "n_known",
        F.lit(trie.total).cast("long").alias("train_tokens"), "base_score", "score")
