"""Sharding by fixed virtual slots.

A record (its id and the checksum and size of its text) hashes into one of thousands of fixed
slots; the slot never changes.  Bytes
and rows are summed per slot, and a small versioned table maps slots to shards.  To
rebalance, that table is edited: a shard keeps its largest slots while they fit its fair
share, and only the slots beyond it move, largest first, each to the shard that is lightest
then.  Rows never carry their shard; they find it through their slot.

The map has one row per slot (``n_slots``, a parameter), so the passes over it are bounded.

Defined results: a null text has no bytes (its size is the fixed overhead, its checksum 0);
rows of one id, also null ids, are spread by their texts, rows equal in both share a slot; an
empty table gives an empty result and a map with all slots; columns other than ``doc_id`` and ``text`` are ignored (``with_shards`` keeps them, but for its own two names).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trellis.llm.common import register, store, table
from trellis.session import scratch_path

N_SLOTS = 8192
N_SHARDS = 24
OVERHEAD = 8


def text_crc(text: Column) -> Column:
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary")).cast("long")


def slot_of(record_id: Column, text: Column, n_slots: int = N_SLOTS) -> Column:
    """The fixed virtual slot of a record."""
    return F.pmod(F.xxhash64(record_id, text_crc(text), F.coalesce(F.octet_length(text), F.lit(-1))), F.lit(n_slots)).cast("int")


def record_digest(docs: DataFrame, n_slots: int = N_SLOTS) -> DataFrame:
    """doc_id, size, text_crc32, vslot of every record; the only pass over the texts."""
    text = F.col("text")
    return docs.select(
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(OVERHEAD)).cast("long").alias("size"),
        text_crc(text).alias("text_crc32"),
        slot_of(F.col("doc_id"), text, n_slots).alias("vslot"))


def slot_weights(digest: DataFrame, n_slots: int = N_SLOTS) -> DataFrame:
    """vslot, n_bytes, n_rows for every slot, empty ones too."""
    sums = digest.groupBy("vslot").agg(F.sum("size").alias("n_bytes"), F.count("*").alias("n_rows"))
    slots = digest.sparkSession.range(n_slots).select(F.col("id").cast("int").alias("vslot"))
    return (slots.join(sums, "vslot", "left")
            .select("vslot", F.coalesce("n_bytes", F.lit(0)).alias("n_bytes"),
                    F.coalesce("n_rows", F.lit(0)).alias("n_rows")))


def first_map(spark: SparkSession, n_slots: int = N_SLOTS, n_shards: int = N_SHARDS) -> DataFrame:
    """Version 0: slots dealt round robin, before any size is known."""
    return spark.range(n_slots).select(F.col("id").cast("int").alias("vslot"),
                                       (F.col("id") % n_shards).cast("int").alias("shard"))


def rebalance(slot_map: DataFrame, weights: DataFrame, n_shards: int = N_SHARDS) -> DataFrame:
    """The next version of the map: (vslot, shard, moved).

    A shard keeps slots, largest first, up to the mean load; the others move to the lightest
    shard in turn.  Shards that the old map does not know (growth) start empty, slots of
    shards that are gone all move."""
    fair = F.sum("n_bytes").over(Window.partitionBy(F.lit(0))) / F.lit(n_shards)
    in_shard = Window.partitionBy("shard").orderBy(F.desc("n_bytes"), "vslot")
    rated = (slot_map.join(weights, "vslot")
             .withColumn("fair", fair)
             .withColumn("stays", (F.sum("n_bytes").over(in_shard) <= F.col("fair"))
                         & (F.col("shard") < n_shards)))
    # one row of arrays, as long as the map
    rows = rated.agg(
        F.collect_list(F.when(F.col("stays"), F.struct("shard", "n_bytes"))).alias("kept"),
        F.array_sort(F.collect_list(F.when(~F.col("stays"), F.struct((-F.col("n_bytes")).alias("less"), "vslot")))).alias("free"))
    loads = F.transform(F.sequence(F.lit(0), F.lit(n_shards - 1)), lambda s: F.aggregate(
        "kept", F.lit(0).cast("long"), lambda t, x: t + F.when(x["shard"] == s, x["n_bytes"]).otherwise(0)))

    def place(state: Column, slot: Column) -> Column:
        lightest = (F.array_position(state["loads"], F.array_min(state["loads"])) - 1).cast("int")
        return F.struct(
            F.transform(state["loads"], lambda v, i: F.when(i == lightest, v - slot["less"]).otherwise(v)).alias("loads"),
            F.concat(state["placed"], F.array(F.struct(slot["vslot"].alias("vslot"), lightest.alias("shard")))).alias("placed"))

    nothing = F.array().cast("array<struct<vslot:int,shard:int>>")
    moved = (rows.select(F.aggregate("free", F.struct(loads.alias("loads"), nothing.alias("placed")), place)["placed"].alias("placed"))
             .select(F.inline("placed")))
    return (rated.filter("stays").select("vslot", "shard", F.lit(False).alias("moved"))
            .unionByName(moved.select("vslot", "shard", F.lit(True).alias("moved"))))


def save_map(slot_map: DataFrame, folder: str, version: int) -> DataFrame:
    """Store one version of the map; earlier versions stay as they are."""
    path = f"{folder}/version={version}"
    slot_map.coalesce(1).write.parquet(path)
    return slot_map.sparkSession.read.schema(slot_map.schema).parquet(path)


def assign(digest: DataFrame, slot_map: DataFrame, weights: DataFrame) -> DataFrame:
    """Give each record its shard and its place in it, counted from 0 without gaps.

    Records are numbered inside their slot, and the slot starts where the slots before it in
    the same shard end: no task ever holds more than a slot."""
    before = Window.partitionBy("shard").orderBy("vslot").rowsBetween(Window.unboundedPreceding, -1)
    starts = (slot_map.join(weights, "vslot")
              .withColumn("start", F.coalesce(F.sum("n_rows").over(before), F.lit(0)))
              .select("vslot", "shard", "start"))
    in_slot = Window.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size")
    return (digest.withColumn("nth", F.row_number().over(in_slot) - 1)
            .join(F.broadcast(starts), "vslot")          # one row per slot
            .withColumn("slot", (F.col("start") + F.col("nth")).cast("long")))


def fitted_map(digest: DataFrame, n_shards: int, n_slots: int) -> tuple[DataFrame, DataFrame]:
    """(slot map, slot weights) for these records.  Two versions are stored: the first deal,
    and its edit by the measured bytes, which is returned."""
    spark = digest.sparkSession
    weights = store(slot_weights(digest, n_slots), "shard-weights")
    folder = scratch_path(spark, "slot-map")
    v0 = save_map(first_map(spark, n_slots, n_shards), folder, 0)
    return save_map(rebalance(v0, weights, n_shards), folder, 1), weights


def with_shards(docs: DataFrame, n_shards: int = N_SHARDS, n_slots: int = N_SLOTS) -> DataFrame:
    """``docs``, all columns, with virtual_slot and shard; texts stay where they are."""
    slot_map, _ = fitted_map(record_digest(docs, n_slots), n_shards, n_slots)
    names = [c for c in docs.columns if c not in ("virtual_slot", "shard")]
    found = slot_map.select(F.col("vslot").alias("virtual_slot"), "shard")
    return (docs.select(*names).withColumn("virtual_slot", slot_of(F.col("doc_id"), F.col("text"), n_slots))
            .join(F.broadcast(found), "virtual_slot").select(*names, "virtual_slot", "shard"))


def shard_documents(docs: DataFrame, n_shards: int = N_SHARDS, n_slots: int = N_SLOTS) -> tuple[DataFrame, DataFrame]:
    """Shard documents by size: returns (records with shard and slot, final slot map)."""
    digest = store(record_digest(docs, n_slots), "shard-digest")
    slot_map, weights = fitted_map(digest, n_shards, n_slots)
    return assign(digest, slot_map, weights), slot_map


@register("op4_virtual_slots")
def op4_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 23 of nearly equal bytes; ``slot`` is the place in the shard."""
    placed, _ = shard_documents(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), F.col("vslot").alias("virtual_slot"))
