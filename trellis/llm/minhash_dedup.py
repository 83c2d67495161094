"""Near-duplicate documents by MinHash: many universal hash minima, banding, verification.

1. Signatures.  ``BANDS * ROWS`` universal hash functions (a x + b modulo 2^64, a odd) run over
   the distinct shingles of each text; the minimum of each is kept as one byte, and the bytes of
   each band of ``ROWS`` minima are a bucket key.
2. Classes.  Texts with equal sets are one class; its smallest id stands for it.
3. Buckets.  Classes that agree in all minima of a band share a bucket.  Two sets of similarity
   0.85 share no bucket with a chance of (1 - 0.85^ROWS)^BANDS, about 7 in 10^9.
4. Stars.  In each bucket the class with most copies leads; each class is held against the
   leader it meets most often, by signature and then on the full sets.  That joins most families.
5. Buckets that still hold several components are compared pair by pair in blocks: pairs of one
   component are not looked at, all others are, in the first bucket they share.  A pair goes on
   if at least ``SAME`` signature bytes agree (a true pair fails with a chance below 10^-10).
   In buckets of more than ``CROWD`` classes each also has a bitmap of its shingles, which
   bounds the overlap from above, so a crowd of texts just below the threshold ends here.
   What is left is confirmed on the full sets.
6. Components by alternating large-star and small-star; the smallest id names a component.

A bucket that holds a third of all classes is cut into blocks of ``BLOCK``; every grouping
before has a partial stage.  No partner is dropped.

Defined results: null and blank texts have an empty set and are linked with nothing; rows that
share an id are one node; rows with a null id take no part (component_id null, kept true); other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trellis.llm.common import register, store, table
from trellis.llm.word_hash import chunks, distinct_by_text, mix, shingle_hashes, word_hashes

PERCENT = 85          # least similarity
WORDS = 5             # words in a shingle
BANDS = 32
ROWS = 5              # minima in a band
SAME = 104            # signature bytes, of BANDS * ROWS, that two linked sets share at least
CROWD = 32            # classes of a bucket that are compared without bitmaps
MOST_BITS = 8192      # of a bitmap; a longer set has more shingles to a bit, and its bound is weaker
BLOCK = 2048          # classes of a bucket that are compared with as many at once
RUN_BYTES = 400_000   # text hashed at once: its shingles stay in the processor's cache

_RNG = np.random.Generator(np.random.PCG64(20260711))
_A = _RNG.integers(1, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64)
_BAND = np.arange(BANDS, dtype=np.int64) << (8 * ROWS)


# -- 1. signatures -----------------------------------------------------------------------

def sets_of(texts: list[str | None], k: int, most: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(place of the first text, sorted distinct shingle hashes, start of each text), by runs of texts."""
    for first, run in chunks(texts, most):
        yield first, *distinct_by_text(*shingle_hashes(*word_hashes(run), k))


def minima(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The least value of each hash function over each set: one row per set."""
    out = np.empty((len(starts), len(_A)), np.uint64)
    for i, (a, b) in enumerate(zip(_A, _B)):
        out[:, i] = np.minimum.reduceat(values * a + b, starts)
    return out


def signature(least: np.ndarray) -> np.ndarray:
    """One byte of each minimum."""
    return (mix(least) >> np.uint64(56)).astype(np.uint8)


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One bucket key per band: its number and the bytes of its minima."""
    place = np.int64(1) << (8 * np.arange(ROWS, dtype=np.int64))
    return sig.reshape(len(sig), BANDS, ROWS).astype(np.int64) @ place + _BAND


_SIGNED = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()), ("sig", pa.binary()), ("keys", pa.list_(pa.int64()))])


def _sign(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("doc_id")
            for first, values, bounds in sets_of(b.column("text").to_pylist(), k, RUN_BYTES):
                n = np.diff(bounds)
                full = np.flatnonzero(n)
                digest, sig, keys = ([None] * len(n) for _ in range(3))
                if len(full):
                    least = minima(values, bounds[full])
                    raw = signature(least)
                    band = band_keys(raw)
                    for at, i in enumerate(full):
                        digest[i] = xxhash.xxh3_128_digest(values[bounds[i]:bounds[i + 1]].tobytes())
                        sig[i], keys[i] = raw[at].tobytes(), band[at]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, len(n)), pa.array(n), pa.array(digest, pa.binary()), pa.array(sig, pa.binary()),
                     pa.array(keys, pa.list_(pa.int64()))], schema=_SIGNED)
    return run


def signatures(docs: DataFrame, k: int = WORDS) -> DataFrame:
    """doc_id, n (set size), digest of the set, sig and keys (null without words) of every row."""
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(_sign(k), "doc_id long, n long, digest binary, sig binary, keys array<long>"))


# -- verification on the full sets -------------------------------------------------------

def bitmap(items: np.ndarray) -> bytes:
    """Bits of the shingles' hashes: at least 8 for each, a power of two, at most ``MOST_BITS``."""
    bits = min(max(64, 1 << int(8 * len(items) - 1).bit_length()), MOST_BITS) if len(items) else 64
    out = np.zeros(bits, bool)
    out[(mix(items) & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(out, bitorder="little").tobytes()


def _full_sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("doc_id")
            for first, values, bounds in sets_of(b.column("text").to_pylist(), k, RUN_BYTES):
                sets = [values[lo:hi] for lo, hi in zip(bounds[:-1], bounds[1:])]
                raw = [x.tobytes() for x in sets]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, len(raw)), pa.array([xxhash.xxh3_128_digest(x) for x in raw], pa.binary()), pa.array(raw, pa.binary()),
                     pa.array([bitmap(x) for x in sets], pa.binary())], names=["doc_id", "digest", "items", "bits"])
    return run


def arrays_of(column: pa.Array) -> list[np.ndarray]:
    """The 64-bit numbers of each binary value, without a copy."""
    starts = np.frombuffer(column.buffers()[1], np.int32 if pa.types.is_binary(column.type) else np.int64)
    starts = starts[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)
    return [data[lo:hi].view(np.uint64) for lo, hi in zip(starts[:-1], starts[1:])]


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Elements two sorted arrays have in common."""
    if len(a) > len(b):
        a, b = b, a
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return int((b[at] == a).sum())


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(arrays_of(batch.column("items_a")), arrays_of(batch.column("items_b")))):
                both = overlap(x, y)
                linked[i] = 100 * both >= percent * (len(x) + len(y) - both)
            keep = pa.array(linked)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])
    return run


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    for end in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("doc_id").alias(end), F.col("items").alias(f"items_{end}")), end)
    return pairs.select("a", "b", "items_a", "items_b").mapInArrow(_confirm(percent), "a long, b long").distinct()


# -- 5. buckets with several components --------------------------------------------------

class Bitmaps:
    """Bitmaps of a bucket by width.  Two of different width are compared at the smaller one:
    the wider is folded, bit by bit, to what it would be at that width."""

    def __init__(self, raw: list[bytes], n: np.ndarray):
        self.n, self.width = n, np.array([len(x) for x in raw])
        self.maps: dict[int, np.ndarray] = {}
        rows = np.arange(len(raw))
        for w in sorted(set(self.width.tolist()), reverse=True):
            own = self.width == w
            wide = np.zeros((len(raw), w), np.uint8)
            wide[own] = np.frombuffer(b"".join(raw[i] for i in rows[own]), np.uint8).reshape(-1, w)
            above = self.maps.get(2 * w)
            if above is not None:
                more = self.width > w
                wide[more] = above[more, :w] | above[more, w:]
            self.maps[w] = wide

    def possible(self, i: int, j: np.ndarray, percent: int) -> np.ndarray:
        """Of the places ``j``, those that may be linked with ``i``."""
        n = self.n
        j = j[100 * np.minimum(n[j], n[i]) >= percent * np.maximum(n[j], n[i])]
        keep = np.zeros(len(j), bool)
        for w in set(np.minimum(self.width[j], self.width[i]).tolist()):
            at = np.flatnonzero(np.minimum(self.width[j], self.width[i]) == w)
            mine, other = self.maps[w][i], self.maps[w][j[at]]
            only_i = np.bitwise_count(mine & ~other).sum(axis=1, dtype=np.int64)
            only_j = np.bitwise_count(other & ~mine).sum(axis=1, dtype=np.int64)
            most = np.minimum(n[i] - only_i, n[j[at]] - only_j)
            keep[at] = (100 + percent) * most >= percent * (n[i] + n[j[at]])
        return j[keep]


def cross_pairs(key: int, rep: np.ndarray, comp: np.ndarray, block: np.ndarray, sig: np.ndarray, bitmaps: Bitmaps | None,
                percent: int, same: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of different components that meet in no earlier band and may be linked; with two blocks, one end in each.

    The rows of the largest component are not taken as first ends: every pair has one outside it."""
    _, which, sizes = np.unique(comp, return_inverse=True, return_counts=True)
    outside = which != sizes.argmax()
    two = block.min() != block.max()
    band = key >> (8 * ROWS)
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    place = np.arange(len(rep))
    for i in np.flatnonzero(outside):
        other = (which != which[i]) & (~outside | (place > i))
        if two:
            other &= block != block[i]
        j = np.flatnonzero(other)
        agree = sig[j] == sig[i]
        j = j[(agree.sum(axis=1) >= same) & ~agree[:, :band * ROWS].reshape(len(j), band, ROWS).all(axis=2).any(axis=1)]
        if bitmaps is not None and len(j):
            j = bitmaps.possible(i, j, percent)
        a.append(np.full(len(j), rep[i]))
        b.append(rep[j])
    a, b = np.concatenate(a), np.concatenate(b)
    return np.minimum(a, b), np.maximum(a, b)


def _compare(percent: int, same: int):
    """Rows come sorted by bucket and pair of blocks; such a group has at most 2 * BLOCK rows on average."""
    def pairs(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        key, pair, rep, n, comp, block = (rows.column(c).to_numpy() for c in ("key", "pair", "rep", "n", "comp", "block"))
        sig = np.frombuffer(b"".join(rows.column("sig").to_pylist()), np.uint8).reshape(len(rep), -1)
        cuts = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (pair[1:] != pair[:-1]), [True]]))
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            bits = rows.column("bits").slice(lo, hi - lo)
            bitmaps = Bitmaps(bits.to_pylist(), n[lo:hi]) if not bits.null_count else None
            a, b = cross_pairs(int(key[lo]), rep[lo:hi], comp[lo:hi], block[lo:hi], sig[lo:hi], bitmaps, percent, same)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for b in batches:
            rows = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
            if not rows.num_rows:
                continue
            key, pair = rows.column("key").to_numpy(), rows.column("pair").to_numpy()
            cut = int(np.argmax((key == key[-1]) & (pair == pair[-1])))      # the last group may go on in the next batch
            if cut:
                yield from pairs(rows.slice(0, cut))
            held = rows.slice(cut)
        if held is not None:
            yield from pairs(held)
    return run


def candidate_pairs(buckets: DataFrame, reps: DataFrame, sets: DataFrame, comps: DataFrame, percent: int, same: int) -> DataFrame:
    """(a, b): pairs of different components that share a bucket, agree in their signatures and may be linked."""
    rows = (buckets.select("key", "rep").join(comps.withColumnRenamed("node", "rep"), "rep", "left")
            .withColumn("comp", F.coalesce("comp", "rep")))
    mixed = (rows.groupBy("key").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"), F.count("*").alias("size"))
             .filter("c0 < c1").select("key", (F.col("size") > CROWD).alias("crowd"), F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")))
    rows = (rows.join(mixed, "key").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
            .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumn("pair", (F.least("block", "with") * F.col("blocks") + F.greatest("block", "with")).cast("int")))
    digests = reps.select(F.col("doc_id").alias("rep"), "digest", "n", "sig")
    maps = sets.select(F.col("doc_id").alias("rep"), "digest", "bits")
    rows = (rows.join(digests.join(maps, ["rep", "digest"]), "rep")
            .select("key", "pair", "rep", "n", "comp", "block", "sig", F.when(F.col("crowd"), F.col("bits")).alias("bits")))
    return (rows.repartition("key", "pair").sortWithinPartitions("key", "pair").mapInArrow(_compare(percent, same), "a long, b long"))


# -- 6. components -----------------------------------------------------------------------

def connected(edges: DataFrame) -> DataFrame:
    """(node, comp): every node of an edge (a, b) and the smallest node it reaches.

    Large star: each node hands its larger neighbours to the smallest node it sees.  Small star:
    it hands its smaller neighbours and itself there.  The rounds alternate until both leave the
    edges as they are; then every edge points at the smallest node of its component."""
    now = store(edges.filter("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), "star-edges")

    def mark(e: DataFrame):
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())

    seen = None
    while (state := mark(now)) != seen and state[0]:
        seen = state
        ends = now.union(now.select("lo", "hi")).toDF("u", "v")
        least = ends.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (ends.filter("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct())
        large = store(large, "star-large")
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (large.join(least, "hi").filter("lo > m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
                 .union(least.select("hi", F.col("m").alias("lo"))))
        now = store(small.distinct(), "star-edges")
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("comp")).union(now.select("lo", "lo")).distinct()


# -- the operator ------------------------------------------------------------------------

def near_duplicates(docs: DataFrame, percent: int = PERCENT, k: int = WORDS, same: int = SAME) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs``."""
    signed = store(signatures(docs, k), "minhash-signed")
    real = signed.filter("doc_id IS NOT NULL AND n > 0")
    classes = store(real.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")), "minhash-classes")
    reps = store(real.join(classes.select("digest", F.col("rep").alias("doc_id"), "copies"), ["digest", "doc_id"])
                 .dropDuplicates(["digest"]).select("doc_id", "digest", "n", "copies", "sig", "keys"), "minhash-reps")

    filed = reps.select(F.col("doc_id").alias("rep"), "copies", F.explode("keys").alias("key"))
    leaders = (filed.groupBy("key").agg(F.count("*").alias("size"), F.max(F.struct("copies", (-F.col("rep")).alias("less"))).alias("top"))
               .filter("size > 1").select("key", (-F.col("top.less")).alias("lead")))
    buckets = store(filed.select("key", "rep").join(leaders, "key"), "minhash-buckets")

    wanted = buckets.select(F.col("rep").alias("doc_id")).distinct()
    full = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(wanted, "doc_id", "left_semi")
            .mapInArrow(_full_sets(k), "doc_id long, digest binary, items binary, bits binary"))
    sets = store(full.join(reps.select("doc_id", "digest"), ["doc_id", "digest"], "left_semi").dropDuplicates(["doc_id", "digest"]), "minhash-sets")

    met = buckets.filter("rep <> lead").groupBy("rep", "lead").agg(F.count("*").alias("times"))
    best = met.groupBy("rep").agg(F.max(F.struct("times", (-F.col("lead")).alias("less"))).alias("best"))
    stars = store(confirmed(best.select(F.col("rep").alias("a"), (-F.col("best.less")).alias("b")), sets, percent), "minhash-stars")
    more = store(confirmed(candidate_pairs(buckets, reps, sets, connected(stars), percent, same), sets, percent), "minhash-links")

    member = store(real.select("digest", "doc_id").join(classes.select("digest", "rep"), "digest").select("doc_id", "rep").distinct(), "minhash-member")
    several = member.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).filter("a < z").select("doc_id", "a")
    one_id = member.join(several, "doc_id").filter("a <> rep").select("a", F.col("rep").alias("b"))
    comps = connected(stars.union(more).union(one_id))
    found = (member.join(comps.withColumnRenamed("node", "rep"), "rep", "left")
             .groupBy("doc_id").agg(F.min(F.coalesce("comp", "rep")).alias("component_id")))
    return (signed.select("doc_id", F.col("n").alias("n_shingles")).join(found, "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")))


@register("op11_minhash_dedup")
def op11_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents linked by a shingle Jaccard of 0.85 or more, and the one of each that stays."""
    return (near_duplicates(table(spark, sf_dir, "documents"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))
