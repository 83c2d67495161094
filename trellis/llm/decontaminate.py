"""Benchmark decontamination: short test items found inside long documents.

Containment of an item in a whole document says little to MinHash when the document is
hundreds of times longer, so sizes are partitioned: items are grouped by the size of their
shingle set (from a power of two up to the next), and for each group documents are seen as
overlapping windows of twice the group's largest item.  A window then holds a contained item
whole and is at most four times its size, so their Jaccard similarity is at least a quarter.

Signatures are one-permutation MinHash: a hash's top bits choose one of 64 bins, the smallest
hash of a bin is its value; small items take several rounds with mixed hashes, so that every
group compares about 64 values.  A window and an item that agree in any bin make the
document a candidate (a contained item is missed with a chance of about 1e-6).  Candidates
are verified exactly: the share of the item's distinct shingles that the whole document has.

Windows are not built: a bin's smallest hash is one of the document's own shingles, so only
shingles whose hash is some item's value are looked at, and then the two windows around them.

Items are dealt to blocks of bounded size, whatever their ids.  One task builds the index of a
block and stores it in the shared folder; the tasks over the documents load the blocks one after
the other, a few are kept.  The driver sees one path per block, and documents are read once.

Defined results: null and empty texts and items match nothing; an item of fewer than five
words is one shingle of its own length; repeated documents and items give repeated results;
other columns are kept by ``drop_contaminated`` and ignored else.
"""

from __future__ import annotations

import functools
import pickle
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from trellis.llm.array_file import load_bytes, save_bytes
from trellis.llm.common import register, store, table
from trellis.llm.jaccard_join import common
from trellis.llm.word_hash import chunks, distinct_by_text, mix, shingle_hashes, word_hashes
from trellis.session import scratch_path

PERCENT = 75            # least containment
WORDS = 5
BINS_LOG = 6
ITEMS_PER_BLOCK = 20_000
BLOCK_BYTES = 16_000_000   # item text of a block on average at most (a longer item alone)
KEPT_BLOCKS = 2            # indexes that a task process keeps
_TOP = np.uint64(64 - BINS_LOG)
_LUT_BITS = 20             # of the table of first bits, at most


def round_hashes(shingles: np.ndarray, r: int) -> np.ndarray:
    """The hashes of round ``r``."""
    return shingles if r == 0 else mix(shingles + np.uint64(r * 0x9E3779B97F4A7C15 % 2**64))


class Group:
    """Items of one shingle length and one range of sizes, with their signature values."""

    def __init__(self, smallest: int, members: list[tuple[int, np.ndarray]]):
        self.width = 2 * smallest - 1                       # the largest item of the group
        self.rounds = []
        for r in range(max(1, -(-64 // smallest))):
            values, owners = [], []
            for item, shingles in members:
                h = np.sort(round_hashes(shingles, r))
                first = np.unique(h >> _TOP, return_index=True)[1]     # smallest of each bin
                values.append(h[first])
                owners.append(np.full(len(first), item))
            values, owners = np.concatenate(values), np.concatenate(owners)
            order = np.argsort(values, kind="stable")
            bits = min(max(int(16 * len(values)).bit_length(), 8), _LUT_BITS)
            lut = np.zeros(1 << bits, bool)
            lut[values >> np.uint64(64 - bits)] = True
            self.rounds.append((values[order], owners[order], lut, np.uint64(64 - bits)))

    def candidates(self, shingles: np.ndarray, bounds: np.ndarray) -> set[tuple[int, int]]:
        """(text, item) that agree in a bin of some window."""
        found = set()
        for r, (values, owners, lut, shift) in enumerate(self.rounds):
            h = round_hashes(shingles, r)
            near = np.flatnonzero(lut[h >> shift])
            los, his = (np.searchsorted(values, h[near], side=side) for side in ("left", "right"))
            true = los < his
            for at, lo, hi in zip(near[true], los[true], his[true]):
                v = h[at]
                text = int(np.searchsorted(bounds, at, side="right")) - 1
                block = (at - bounds[text]) // self.width
                for b in (block - 1, block):
                    start = bounds[text] + max(b, 0) * self.width
                    end = min(bounds[text + 1], bounds[text] + (b + 2) * self.width)
                    window = h[start:end]
                    if window[(window >> _TOP) == (v >> _TOP)].min() == v:
                        found.update((text, int(x)) for x in owners[lo:hi])
                        break
        return found


class ItemIndex:
    """Signatures and shingle sets of one block of items."""

    def __init__(self, item_ids: list, texts: list[str | None]):
        self.ids = item_ids
        self.sets: dict[int, np.ndarray] = {}
        groups: dict[int, dict[int, list]] = defaultdict(lambda: defaultdict(list))
        for first, run in chunks(texts):
            h, bounds = word_hashes(run)
            values, cuts = distinct_by_text(*shingle_hashes(h, bounds, WORDS))
            for i, n_words in enumerate(np.diff(bounds)):
                if n_words:
                    s = self.sets[first + i] = values[cuts[i]:cuts[i + 1]]
                    groups[int(min(n_words, WORDS))][1 << int(len(s)).bit_length() - 1].append((first + i, s))
        self.groups = {k: [Group(size, members) for size, members in sorted(g.items())] for k, g in sorted(groups.items())}

    def matches(self, texts: list[str | None]) -> Iterator[tuple[int, int, int, int]]:
        """(text, item, shingles of the item, shingles shared) for every contained item."""
        for first, run in chunks(texts):
            h, bounds = word_hashes(run)
            for k, groups in self.groups.items():
                shingles, cuts = shingle_hashes(h, bounds, k, short_whole=False)
                pairs = set().union(*(g.candidates(shingles, cuts) for g in groups))
                sets: dict[int, np.ndarray] = {}
                for text, item in sorted(pairs):
                    if text not in sets:
                        sets[text] = np.unique(shingles[cuts[text]:cuts[text + 1]])
                    shared, n = common(self.sets[item], sets[text]), len(self.sets[item])
                    if 100 * shared >= PERCENT * n:
                        yield first + text, item, n, shared


def item_blocks(items: DataFrame) -> list[str]:
    """Build and store the index of every block of items; the paths, one for each block."""
    size = items.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()        # one row
    if not size["n"]:
        return []
    blocks = max(1, -(-size["n"] // ITEMS_PER_BLOCK), -(-(size["bytes"] or 0) // BLOCK_BYTES))
    folder = scratch_path(items.sparkSession, "item-blocks")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts = [], []
        for b in batches:
            ids += b.column("item_id").to_pylist()
            texts += b.column("text").to_pylist()
        if ids:
            path = f"{folder}/block-{TaskContext.get().partitionId():06d}"
            save_bytes(path, pickle.dumps(ItemIndex(ids, texts), protocol=5))
            yield pa.RecordBatch.from_pydict({"path": [path]})

    dealt = items.select("item_id", "text").repartition(blocks)                 # round robin: equal ids spread too
    return sorted(r["path"] for r in store(dealt.mapInArrow(build, "path string"), "item-paths").collect())


@functools.lru_cache(maxsize=KEPT_BLOCKS)
def _index(path: str) -> ItemIndex:
    return pickle.loads(load_bytes(path))


def contained_items(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id, n_item, n_shared for every item that a document contains."""
    kinds = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, item_id {items.schema['item_id'].dataType.simpleString()}"
    item_kind = to_arrow_type(items.schema["item_id"].dataType)
    paths = item_blocks(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text").to_pylist()
            for path in paths:
                index = _index(path)
                hits = list(index.matches(texts))
                text, item, n, both = (list(x) for x in zip(*hits)) if hits else ([], [], [], [])
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").take(pa.array(text, pa.int64())), pa.array([index.ids[i] for i in item], item_kind),
                     pa.array(n, pa.int64()), pa.array(both, pa.int64())], names=["doc_id", "item_id", "n_item", "n_shared"])

    return docs.select("doc_id", "text").mapInArrow(run, f"{kinds}, n_item long, n_shared long")


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents, all columns, that contain no item; texts stay where they are."""
    paths = item_blocks(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = np.ones(b.num_rows, bool)
            texts = b.column("text").to_pylist()
            for path in paths:
                keep[[hit[0] for hit in _index(path).matches(texts)]] = False
            yield b.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)


OP9_SQL = """
WITH iw AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                    '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM benchmark),
i AS (SELECT item_id, least(5, len(w)) AS k, w FROM iw WHERE len(w) > 0),
ish AS (SELECT item_id, k, unnest(list_distinct(list_transform(range(1, len(w) - k + 2), lambda x: array_to_string(w[x:x + k - 1], ' ')))) AS s FROM i),
isz AS (SELECT item_id, count(*) AS n_item FROM ish GROUP BY item_id),
dw AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                   '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents),
dsh AS (SELECT doc_id, k, unnest(list_distinct(list_transform(range(1, len(w) - k + 2), lambda x: array_to_string(w[x:x + k - 1], ' ')))) AS s
        FROM dw, (SELECT DISTINCT k FROM i) WHERE len(w) >= k),
hit AS (SELECT doc_id, item_id, count(*) AS n_shared FROM dsh JOIN ish USING (k, s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_item, n_shared FROM hit JOIN isz USING (item_id) WHERE 100 * n_shared >= 75 * n_item
"""


@register("op9_benchmark_containment", OP9_SQL)
def op9_benchmark_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items contained in documents."""
    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
