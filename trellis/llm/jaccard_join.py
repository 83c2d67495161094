"""N-gram Jaccard self-join: which texts share at least 75 % of their word shingles.

No link is approximated.  There are two modes.  ``join_pairs`` returns every linked pair of
different texts: steps 1 to 3, then 5 and 6 over all tiles.  ``join_components`` returns only
who belongs together and takes a shortcut: the links of stars (4) are decided first, and sets
that they join already are not compared again.  The steps:

1. Shared share.  Every distinct shingle hash of every text goes to the part that owns it
   (packed, five bytes each); the part sees which occur in two texts or more and answers with
   counts per text.  A text with a partner has at least 75 % such shingles, so all others are
   done: they form components of their own.  Common passages alone do not pass.
2. Classes.  Texts with equal sets are one class, its member of smallest id stands for it.
3. Tiles.  Two linked sets share a hash among the first n - ceil(0.75 n) + 1 of each
   (prefix filter), so sets meet in a tile per such hash.
4. Stars.  Each set is compared with one partner, the tile leader it meets most often.  The
   leader of a tile is the set with the largest shared share, which in a family of near
   copies is the text they come from.  Components of these links join most families.
5. Bands and bitmaps.  Tiles that still hold several components are cut into bands of
   similar set size.  Each set has a hashed bitmap as wide as its band asks for; for A and B
   the overlap is at most |A| less the bits only A has, and likewise for B.  Only pairs whose
   bound reaches the threshold go on; for components, only those of different components.
   Large tiles are cut into blocks and compared block by block.
6. The pairs left are decided by exact intersection of the sorted arrays; for components,
   those of all links are taken.

Defined results: null and empty texts have no set and are linked with nothing; rows that
share an id are one node; rows with a null id get no component; other columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from trellis.llm.common import register, release_shuffles, store, table
from trellis.llm.word_hash import chunks, distinct_by_text, mix, shingle_hashes, word_hashes

PERCENT = 75          # least similarity
WORDS = 5             # words in a shingle
BLOCK = 4096          # sets of a tile that one task compares with as many
BITS = 8              # bitmap bits per set element, at least
TILE_BYTES = 32_000_000  # of bitmaps that a block of a tile has at most (a single set may have more)
PACKED = 5            # bytes of a hash inside its part
PART_BYTES = 16_000_000  # text whose hashes one part owns on average
NO_ID = -2**63        # a null id on its way through packed arrays


def text_sets(texts: list[str | None], k: int, most: int = 2_000_000) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(place of the first text, sorted shingle hashes, start of each text) by runs of texts."""
    for first, run in chunks(texts, most):
        yield first, *distinct_by_text(*shingle_hashes(*word_hashes(run), k))


# -- 1. shared share ---------------------------------------------------------------------

def _blob(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a).tobytes()


_PARTS = "part int, chunk string, hashes binary, counts binary, ids binary, sizes binary"
_REPLY = "chunk string, shared binary, ids binary, sizes binary"


def _narrow(a: np.ndarray) -> bytes:
    """Counts in as few bytes as the largest needs; the first byte tells how many."""
    kind = np.min_scalar_type(int(a.max(initial=0)))
    return bytes([kind.itemsize]) + a.astype(kind).tobytes()


def _widened(b: bytes) -> np.ndarray:
    return np.frombuffer(b, f"u{b[0]}", offset=1)


def arrays_of(column: pa.Array, kind=np.uint64) -> list[np.ndarray]:
    """The numbers of each binary value, without a copy."""
    if not len(column):
        return []
    starts = np.frombuffer(column.buffers()[1], np.int32 if pa.types.is_binary(column.type) else np.int64)
    starts = starts[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    return [data[lo:hi].view(kind) for lo, hi in zip(starts[:-1], starts[1:])]


def _deal(n_parts: int, k: int):
    """Texts to packed hashes by part; one row per run of texts and part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        for b in batches:
            ids = pc.fill_null(b.column("doc_id"), NO_ID).to_numpy()
            for first, values, bounds in text_sets(b.column("text").to_pylist(), k):
                n = len(bounds) - 1
                sizes = np.diff(bounds)
                part = ((values >> np.uint64(32)) * np.uint64(n_parts) >> np.uint64(32)).astype(np.uint16 if n_parts < 65536 else np.int64)
                order = np.argsort(part, kind="stable")
                packed = values[order].view(np.uint8).reshape(-1, 8)[:, :PACKED]
                text = np.repeat(np.arange(n), sizes)
                cuts = np.searchsorted(part[order], np.arange(n_parts + 1))
                home = number % n_parts
                rows = []
                for p in range(n_parts):
                    lo, hi = cuts[p], cuts[p + 1]
                    if lo == hi and p != home:
                        continue
                    counts = np.bincount(text[order[lo:hi]], minlength=n)
                    rows.append({"part": p, "chunk": f"{task}/{number}", "hashes": _blob(packed[lo:hi]), "counts": _narrow(counts),
                                 "ids": _blob(ids[first:first + n]) if p == home else None,
                                 "sizes": _blob(sizes.astype(np.int64)) if p == home else None})
                number += 1
                yield pa.RecordBatch.from_pylist(rows, schema=_arrow(_PARTS))
    return run


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "double": pa.float64(),
             "array<long>": pa.list_(pa.int64()), "boolean": pa.bool_()}
    return pa.schema([(n, kinds[t]) for n, t in (c.strip().split(" ") for c in ddl.split(","))])


def _count_shared(rows: pa.Table) -> pa.Table:
    """In one part: for each run of texts, how many hashes of each text occur twice or more."""
    blobs = [x.reshape(-1, PACKED) for piece in rows.column("hashes").chunks for x in arrays_of(piece, np.uint8)]
    wide = np.zeros((sum(map(len, blobs)), 8), np.uint8)
    at = 0
    for x in blobs:
        wide[at:at + len(x), :PACKED] = x
        at += len(x)
    values = wide.view(np.uint64).ravel()
    order = np.argsort(values)
    ranked = values[order]
    twin = np.zeros(len(values), bool)
    same = ranked[1:] == ranked[:-1]
    twin[1:] |= same
    twin[:-1] |= same
    shared = np.empty(len(values), bool)
    shared[order] = twin
    upto = np.zeros(len(values) + 1, np.int64)
    np.cumsum(shared, out=upto[1:])
    out, at = [], 0
    for chunk, counts, ids, sizes in zip(*(rows.column(c).to_pylist() for c in ("chunk", "counts", "ids", "sizes"))):
        ends = at + np.concatenate([[0], np.cumsum(_widened(counts), dtype=np.int64)])
        out.append({"chunk": chunk, "shared": _narrow(np.diff(upto[ends])), "ids": ids, "sizes": sizes})
        at = ends[-1]
    return pa.Table.from_pylist(out, schema=_arrow(_REPLY))


_SHARE = "doc_id long, n_shingles long, n_shared long"


def _add_up(rows: pa.Table) -> pa.Table:
    """Sum the answers of all parts for one run of texts."""
    total = np.zeros(1, np.int64)
    for x in rows.column("shared").to_pylist():
        total = total + _widened(x)
    ids = next(x for x in rows.column("ids").to_pylist() if x is not None)
    sizes = next(x for x in rows.column("sizes").to_pylist() if x is not None)
    return pa.table([pa.array(np.frombuffer(ids, np.int64)), pa.array(np.frombuffer(sizes, np.int64)), pa.array(total)],
                    schema=_arrow(_SHARE))


def shared_share(docs: DataFrame, k: int = WORDS) -> DataFrame:
    """doc_id, n_shingles and n_shared (shingles that another text has too) of every row.

    There are as many parts as keep each near ``PART_BYTES`` of text, so a part does not grow with
    the data.  A part may take two hashes for one when they agree in their last 40 bits, which
    only lets a text through to the exact steps."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))
    dealt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_deal(n_parts, k), _PARTS)
    answers = dealt.groupBy("part").applyInArrow(_count_shared, _REPLY)
    return (answers.groupBy("chunk").applyInArrow(_add_up, _SHARE)
            .withColumn("doc_id", F.nullif("doc_id", F.lit(NO_ID))))


# -- 2. classes --------------------------------------------------------------------------

_SETS = "doc_id long, n long, share double, digest binary, items binary"


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, shared = (b.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "n_shared"))
            for first, values, bounds in text_sets(b.column("text").to_pylist(), k):
                sets = [values[lo:hi] for lo, hi in zip(bounds[:-1], bounds[1:])]
                keep = [i for i, s in enumerate(sets) if len(s)]
                n = np.array([len(sets[i]) for i in keep], np.int64)
                own = first + np.array(keep, np.int64)
                raw = [_blob(sets[i]) for i in keep]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[own].astype(np.int64)), pa.array(n), pa.array(np.minimum(shared[own] / np.maximum(n, 1), 1.0)),
                     pa.array([xxhash.xxh3_128_digest(x) for x in raw], pa.binary()), pa.array(raw, pa.binary())],
                    schema=_arrow(_SETS))
    return run


# -- 3. tiles ----------------------------------------------------------------------------

def prefix_length(n: np.ndarray) -> np.ndarray:
    """How many of the first hashes of a set must be looked at."""
    return n - -(-PERCENT * n // 100) + 1


_TOKENS = "rep long, n long, share double, tokens array<long>"


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        items = arrays_of(b.column("items"), np.int64)
        n = np.array([len(x) for x in items], np.int64)
        tokens = [x[:p] for x, p in zip(items, prefix_length(n))]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("n"), b.column("share"),
                                          pa.array(tokens, pa.list_(pa.int64()))], schema=_arrow(_TOKENS))


# -- 4., 6. exact intersection and components --------------------------------------------

def common(a: np.ndarray, b: np.ndarray) -> int:
    """Elements two sorted arrays share."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a))


def _decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        linked = []
        for i, (x, y) in enumerate(zip(arrays_of(b.column("items_a")), arrays_of(b.column("items_b")))):
            both = common(x, y)
            if 100 * both >= PERCENT * (len(x) + len(y) - both):
                linked.append(i)
        take = pa.array(linked, pa.int64())
        yield pa.RecordBatch.from_arrays([b.column("a").take(take), b.column("b").take(take)], schema=_arrow("a long, b long"))


def verified(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets reach the threshold."""
    side = lambda c: reps.select(F.col("doc_id").alias(c), F.col("items").alias(f"items_{c}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "items_a", "items_b").mapInArrow(_decide, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, comp): the smallest node reachable, for every node of an edge.

    Large-star and small-star rounds: edges move to ever smaller neighbours until each node
    points at its component's smallest.  Every grouping is a minimum with a partial stage."""
    def kept(e: DataFrame) -> tuple[DataFrame, tuple]:
        """The edges, written, with their number and checksum, taken on the way."""
        seen = Observation()
        e = store(e.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("sum")), "edges")
        return e, (seen.get["n"], seen.get["sum"])

    edges, state = kept(edges.filter("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct())
    before = None
    while state != before and state[0]:
        before = state
        both = edges.union(edges.select("lo", "hi")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = (both.filter("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
                 .filter("hi <> lo").distinct())
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        edges, state = kept(large.join(low, "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
                            .union(low.select("hi", F.col("m").alias("lo"))).filter("hi <> lo").distinct())
    nodes = edges.select(F.col("hi").alias("node"), F.col("lo").alias("comp"))
    return nodes.union(edges.select(F.col("lo").alias("node"), F.col("lo").alias("comp"))).distinct()


# -- 5. bands and bitmaps ----------------------------------------------------------------

def band_of(n: Column) -> Column:
    """Bands of set sizes; sizes within the threshold of each other are at most one band apart."""
    return F.floor(F.log(n.cast("double")) / F.log(F.lit(100.0 / PERCENT)) + 1e-9).cast("int")


def bitmap_words(band: int) -> int:
    """64-bit words of a band's bitmaps: a power of two, BITS per element of its largest set."""
    bits = BITS * (100.0 / PERCENT) ** (band + 1)
    return max(1, 1 << int(np.ceil(np.log2(bits / 64))))


def block_rows(band: Column) -> Column:
    """Sets in a block of a tile: ``BLOCK``, or fewer where bitmaps are wide."""
    size = F.pow(F.lit(2.0), F.ceil(F.log2(F.lit(BITS / 64) * F.pow(F.lit(100.0 / PERCENT), F.col("band") + 1)))) * 8
    return F.greatest(F.least(F.lit(float(BLOCK)), F.floor(F.lit(TILE_BYTES) / F.greatest(size, F.lit(8.0)))), F.lit(16.0))


def bitmap(items: np.ndarray, words: int) -> np.ndarray:
    place = mix(items) & np.uint64(words * 64 - 1)
    out = np.zeros(words, np.uint64)
    np.bitwise_or.at(out, (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63)))
    return out


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        maps = [_blob(bitmap(x, bitmap_words(band))) for x, band in zip(arrays_of(b.column("items")), b.column("band").to_pylist())]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("band"), pa.array(maps, pa.binary())],
                                         schema=_arrow("rep long, band int, bits binary"))


_TILE = ("token", "band", "pair")


def tile_pairs(rep: np.ndarray, n: np.ndarray, comp: np.ndarray, home: np.ndarray, block: np.ndarray,
               bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of one tile whose bitmaps leave the threshold possible.

    Sets of the tile's largest component are only compared with the others."""
    comps, which, counts = np.unique(comp, return_inverse=True, return_counts=True)
    other = which != counts.argmax()
    split = block[0] != block[-1] or len(set(block.tolist())) > 1
    a, b = [], []
    for i in np.flatnonzero(other):
        j = np.flatnonzero((which != which[i]) & (home | home[i]) & (~other | (np.arange(len(rep)) > i))
                           & (100 * np.minimum(n, n[i]) >= PERCENT * np.maximum(n, n[i])))
        if split:
            j = j[block[j] != block[i]]
        if len(j):
            only_i = np.bitwise_count(bits[i] & ~bits[j]).sum(axis=1, dtype=np.int64)
            only_j = np.bitwise_count(bits[j] & ~bits[i]).sum(axis=1, dtype=np.int64)
            bound = np.minimum(n[i] - only_i, n[j] - only_j)
            j = j[(100 + PERCENT) * bound >= PERCENT * (n[i] + n[j])]
            a.append(np.full(len(j), rep[i]))
            b.append(rep[j])
    if not a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a, b = np.concatenate(a), np.concatenate(b)
    return np.minimum(a, b), np.maximum(a, b)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by tile; a tile may go on in the next batch.

    Whole tiles are read in place; only the last one of a batch is held, and a block of a tile
    has at most ``BLOCK`` rows and about ``TILE_BYTES`` of bitmaps."""
    def pairs(rows: pa.RecordBatch, lo: int, hi: int) -> Iterator[pa.RecordBatch]:
        if hi - lo < 2:
            return
        rows = rows.slice(lo, hi - lo)
        bits = np.concatenate(arrays_of(rows.column("bits"))).reshape(hi - lo, -1)
        a, b = tile_pairs(*(rows.column(c).to_numpy(zero_copy_only=False) for c in ("rep", "n", "comp", "home", "block")), bits)
        if len(a):
            both = np.unique(np.stack([a, b]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], schema=_arrow("a long, b long"))

    def tile_of(rows: pa.RecordBatch, i: int) -> list:
        return [rows.column(c)[i].as_py() for c in _TILE]

    held: list[pa.RecordBatch] = []

    def release() -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        held.clear()
        yield from pairs(rows, 0, rows.num_rows)

    for b in batches:
        if not b.num_rows:
            continue
        keys = [b.column(c).to_numpy() for c in _TILE]
        new = np.zeros(b.num_rows, bool)
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
        cuts = [0, *np.flatnonzero(new), b.num_rows]
        if held and tile_of(held[0], 0) == tile_of(b, 0):
            held.append(b.slice(0, cuts[1]))
            cuts = cuts[1:]
            if len(cuts) == 1:                     # all of the batch belongs to the held tile
                continue
        if held:
            yield from release()
        for lo, hi in zip(cuts[:-2], cuts[1:-1]):
            yield from pairs(b, lo, hi)
        held.append(pa.Table.from_batches([b]).take(pa.array(range(cuts[-2], cuts[-1]))).combine_chunks().to_batches()[0])
    if held:
        yield from release()


def band_pairs(post: DataFrame, reps: DataFrame, comps: DataFrame | None = None) -> DataFrame:
    """Distinct pairs (a < b) that meet in a tile and pass the bitmap bound: all, or those of different components."""
    if comps is None:
        rows = post.withColumn("comp", F.col("rep"))
    else:
        rows = (post.join(comps.select(F.col("node").alias("rep"), "comp"), "rep", "left")
                .withColumn("comp", F.coalesce("comp", "rep")))
    rows = rows.select("token", "rep", "n", "comp", band_of(F.col("n")).alias("own"))
    # a set is at home in its band and a guest in the next
    rows = rows.select("token", "rep", "n", "comp", "own", F.explode(F.array(F.col("own"), F.col("own") + 1)).alias("band"))
    rows = rows.withColumn("home", F.col("own") == F.col("band")).drop("own")
    mixed = (rows.groupBy("token", "band")
             .agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"), F.count("*").alias("size"), F.max("home").alias("any_home"))
             .filter("c0 < c1 AND any_home")
             .select("token", "band", F.ceil(F.col("size") / block_rows(F.col("band"))).cast("int").alias("blocks")))
    rows = store(rows.join(mixed, ["token", "band"]), "tiles")
    wanted = rows.select(F.col("rep").alias("doc_id"), "band").distinct()
    bits = reps.select("doc_id", "items").join(wanted, "doc_id").mapInArrow(_bitmaps, "rep long, band int, bits binary")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    rows = rows.withColumn("with", other).withColumn(
        "pair", F.least("block", "with") * F.col("blocks") + F.greatest("block", "with"))
    rows = rows.join(bits, ["rep", "band"]).select("token", "band", "pair", "rep", "n", "comp", "home", "block", "bits")
    return (rows.repartition(*_TILE).sortWithinPartitions(*_TILE).mapInArrow(_compare, "a long, b long").distinct())


# -- the join ----------------------------------------------------------------------------

def near_tiles(docs: DataFrame, k: int = WORDS, by_set: bool = False) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, DataFrame]:
    """Steps 1 to 3: (share of every row; set of every row that can have a link; doc_id, rep; sets of the reps; tiles).

    A rep is the smallest id of its class, or with ``by_set`` a hash of the set, so that an id
    with different texts is not one rep for all of them."""
    share = store(shared_share(docs, k), "near-share")
    likely = (share.filter(f"doc_id IS NOT NULL AND n_shingles > 0 AND n_shared * 100 >= n_shingles * {PERCENT}")
              .groupBy("doc_id").agg(F.max("n_shared").alias("n_shared")))
    sets = store(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(likely, "doc_id")
                 .mapInArrow(_sets(k), _SETS).withColumn("row", F.monotonically_increasing_id()), "near-sets")
    release_shuffles(docs.sparkSession)       # of the hashes and the texts
    # one row for each set, however many rows or ids have it
    classes = store(sets.groupBy("digest").agg(F.min(F.struct("doc_id", "row")).alias("m")).select("digest", "m.doc_id", "m.row"), "near-classes")
    reps = sets.join(classes.select("row"), "row", "left_semi").drop("row")
    if by_set:
        key = F.xxhash64("digest")
        member = sets.select("doc_id", key.alias("rep")).distinct()
        reps = store(reps.withColumn("doc_id", key), "near-reps")
    else:
        member = (sets.select("digest", "doc_id").join(classes.select("digest", F.col("doc_id").alias("rep")), "digest")
                  .select("doc_id", "rep").distinct())
        reps = store(reps, "near-reps")

    # read from the sets twice: written, the tokens would take a quarter of the sets' own space
    post = reps.mapInArrow(_prefixes, _TOKENS).select("rep", "n", "share", F.explode("tokens").alias("token"))
    leaders = (post.groupBy("token").agg(F.count("*").alias("size"), F.max(F.struct("share", (-F.col("rep")).alias("less"))).alias("lead"))
               .filter("size > 1").select("token", F.col("lead.share").alias("lead_share"), (-F.col("lead.less")).alias("lead")))
    tiles = store(post.select("rep", "n", "token").join(leaders, "token"), "near-tiles")        # hashes of one set alone go
    release_shuffles(docs.sparkSession)
    return share, sets, member, reps, tiles


def near_components(docs: DataFrame, k: int = WORDS) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n_shingles of every row; doc_id, component_id, n_rows of the ids that can have a link)."""
    share, sets, member, reps, post = near_tiles(docs, k)
    meets = post.filter("rep <> lead").groupBy("rep", "lead").agg(F.count("*").alias("times"), F.max("lead_share").alias("lead_share"))
    best = meets.groupBy("rep").agg(F.max(F.struct("times", "lead_share", "lead")).alias("best"))
    stars = store(verified(best.select(F.col("rep").alias("a"), F.col("best.lead").alias("b")), reps), "near-stars")

    first = components(stars)
    release_shuffles(docs.sparkSession)
    more = verified(band_pairs(post, reps, first), reps)
    # rows of one id with different texts belong together
    several = member.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).filter("a < b").select("doc_id", "a")
    same_id = member.join(several, "doc_id").select("a", F.col("rep").alias("b"))
    comps = components(stars.union(more).union(same_id))
    rows = sets.groupBy("doc_id").agg(F.count("*").alias("n_rows"))
    found = (member.join(comps.withColumnRenamed("node", "rep"), "rep", "left")
             .groupBy("doc_id").agg(F.min(F.coalesce("comp", "rep")).alias("component_id")).join(rows, "doc_id"))
    return share.select("doc_id", "n_shingles"), store(found, "near-found")


def join_pairs(docs: DataFrame, k: int = WORDS) -> tuple[DataFrame, DataFrame]:
    """All links: (a, b; doc_id, rep).

    The pairs a < b are the linked pairs of different sets, each named by its 64-bit hash.  The
    membership names the sets of every id that has a link: ids of one set are linked, ids of
    two are linked if these are.  The pairs of a family grow with the square of its different
    sets, as the result itself does; equal sets are not paired out."""
    _, _, member, reps, post = near_tiles(docs, k, by_set=True)
    member = store(member, "near-member")
    pairs = store(verified(band_pairs(post, reps), reps), "near-pairs")
    ends = pairs.select(F.col("a").alias("rep")).union(pairs.select("b"))
    shared = member.groupBy("rep").agg(F.count("*").alias("n")).filter("n > 1").select("rep")
    return pairs, member.join(ends.union(shared).distinct(), "rep", "left_semi").select("doc_id", "rep")


def join_components(docs: DataFrame, k: int = WORDS) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs``."""
    rows, found = near_components(docs, k)
    return (rows.join(found.select("doc_id", "component_id"), "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs``, all columns, with one row of each group of near copies.

    Groups are made of texts (told apart by a 64-bit hash), not of ids: rows of one id with
    different texts are judged apart, and rows without an id take part.  The row of smallest id
    stays, one with an id before one without; then the hash of the text and of the whole row
    decide, and of rows equal in all columns one stays.  Rows without words stay."""
    names = docs.columns
    has_words = F.coalesce(F.col("text"), F.lit("")).rlike("[^\\x20\\x09-\\x0D]")
    key, row = F.xxhash64("text", F.length("text")), F.xxhash64(*names)
    slim = docs.filter(has_words).select(F.col("doc_id").cast("long").alias("id"), key.alias("key"), row.alias("row"))
    _, found = near_components(docs.filter(has_words).select(key.alias("doc_id"), "text"))
    text = slim.groupBy("key").agg(F.count("*").alias("n"), F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key", "row")).alias("first"))
    text = store(text.join(found.select(F.col("doc_id").alias("key"), "component_id"), "key", "left")
                 .select("key", "n", "first", F.coalesce("component_id", "key").alias("group")), "near-texts")
    best = text.groupBy("group").agg(F.sum("n").alias("rows"), F.min("first").alias("first")).filter("rows > 1").select("group", "first")
    # of each text with company: the row that stays, null if another text's row does
    act = (text.join(best.withColumnRenamed("first", "stays"), "group")
           .select(F.col("key").alias("near_key"), F.when(F.col("stays.key") == F.col("key"), F.col("stays.row")).alias("near_row")))
    judged = docs.select(F.struct(*names).alias("doc"), F.when(has_words, key).alias("own_key"), row.alias("own_row"))
    judged = judged.join(act, judged["own_key"] == act["near_key"], "left")
    alone = judged.filter("near_key IS NULL").select("doc.*")
    chosen = judged.filter("near_key IS NOT NULL AND own_row = near_row").dropDuplicates(["own_key", "own_row"]).select("doc.*")
    return alone.unionByName(chosen)


def _links(docs: DataFrame) -> DataFrame:
    """One table of both: doc_id (null for a pair), rep, linked_rep (null for a membership)."""
    pairs, member = join_pairs(docs)
    return (member.select("doc_id", "rep", F.lit(None).cast("long").alias("linked_rep"))
            .unionByName(pairs.select(F.lit(None).cast("long").alias("doc_id"), F.col("a").alias("rep"), F.col("b").alias("linked_rep"))))


@register("op6_jaccard_tiles")
def op6_jaccard_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents linked by a shingle Jaccard of 0.75 or more."""
    return join_components(table(spark, sf_dir, "documents"))


@register("op6_jaccard_pairs")
def op6_jaccard_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All linked pairs of different texts, and the documents that have these texts."""
    return _links(table(spark, sf_dir, "documents"))
