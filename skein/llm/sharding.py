"""Sharding as vector bin packing over bytes, tokens and rows.

What is placed are cells, not documents: groups of equal texts fall by their hash into a
fixed number of cells of falling size (each level of the hash holds half of what the level
before it holds), so the number of things placed doesn't grow with the corpus and the last
ones are small enough to level the shards. A group that holds more than 1/64 of a shard is a
cell of its own; one that holds more than a shard is split by the hash of the id.
Largest first, a cell goes where the dot product of its size vector and the residual
capacity is highest; then cells are taken out and put back by the same rule, in rounds, until none
moves, which levels all three measures. The law that holds is ``bytes``: bytes weigh most in the product.

Slots are numbered inside small parts of a shard; a part's first number comes from a running
sum over the parts' counts, so no task sees a whole shard's rows.

Defined results: a null text has size 1 and the checksum of no bytes, like an empty one;
null ids are placed like others; repeated rows each get a slot; an empty table gives no rows;
other columns are not read. Equal texts share a shard unless they are more than one holds.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.llm.common import table, written

LEVELS, PER_LEVEL = 8, 1024
#: Of the dot product: bytes, tokens, rows.
WEIGHTS = (1.0, 0.25, 0.25)
#: Rounds of levelling with these weights, and then with a tenth and a hundredth of those of tokens and rows: bytes get the last word.
ROUNDS = 6


def place(sizes: np.ndarray, shards: int, weights=WEIGHTS, rounds: int = ROUNDS) -> np.ndarray:
    """The shard of each item (rows of sizes: one column for each measure), largest first to the highest dot product with residual capacity.

    The dot product is what a placement takes off the weighted squares of the residual capacities,
    so that each later round, in which items are placed anew one by one, can only level them.
    """
    total = np.maximum(sizes.sum(axis=0), 1e-12)
    out = np.full(len(sizes), -1, np.int64)
    for less in (1.0, 0.1, 0.01) if rounds else (1.0,):
        scale = np.sqrt(np.array(weights, float) * [1.0, *[less] * (sizes.shape[1] - 1)])
        share = sizes / total * scale
        room = np.full((shards, sizes.shape[1]), 1.0 / shards) * scale
        np.subtract.at(room, out[out >= 0], share[out >= 0])
        order = np.argsort(-(share * scale).sum(axis=1), kind="stable").tolist()
        for _ in range((less == 1.0) + rounds):
            moved = False
            for k in order:
                before = out[k]
                if before >= 0:
                    room[before] += share[k]
                worth = room @ share[k]
                best = int(np.argmax(worth))
                if before >= 0 and worth[best] <= worth[before] + 1e-15:
                    best = before
                moved |= best != before
                out[k] = best
                room[best] -= share[k]
            if not moved:
                break
    return out


def cell_of(group: Column) -> Column:
    """Level and part of a group's hash: level k holds 2^-(k+1) of all hashes, the last the rest."""
    bits = F.shiftrightunsigned(group, 32).bitwiseAND(F.lit((1 << (LEVELS - 1)) - 1))
    level = F.lit(LEVELS - 1)
    for k in range(LEVELS - 2, -1, -1):
        level = F.when(bits.bitwiseAND(F.lit(1 << k)) != 0, F.lit(k)).otherwise(level)
    return (level * PER_LEVEL + F.pmod(group, F.lit(PER_LEVEL))).cast("long")


def measured(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, size, n_tokens, text_crc32 and the hash of the text, of each row. Tokens are stretches between blanks."""
    t = F.coalesce(F.col(text), F.lit(""))
    blanks = F.octet_length(t) - F.octet_length(F.replace(t, F.lit(" "), F.lit("")))
    return docs.select(F.col(key), (F.octet_length(t) + 1).cast("long").alias("size"), F.when(t == "", F.lit(0)).otherwise(blanks + 1).cast("long").alias("n_tokens"), F.crc32(t.cast("binary")).alias("text_crc32"), F.xxhash64(t).alias("text_hash"))


def shard(docs: DataFrame, shards: int = 16, key: str = "doc_id", text: str = "text", slot_part: int = 4096) -> DataFrame:
    """key, size, text_crc32, n_tokens, law, shard, slot and grown_shard of each row of docs."""
    rows = written(measured(docs, key, text), "shard-rows")
    spark = rows.sparkSession
    groups = rows.groupBy("text_hash").agg(F.sum("size").alias("bytes"), F.sum("n_tokens").alias("tokens"), F.count("*").alias("rows"))
    n_bytes, n_rows = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    # At most 2 * 64 * shards groups can hold so much.
    hot = groups.where((F.col("bytes") * 64 * shards > n_bytes) | (F.col("rows") * 64 * shards > n_rows)).collect() if n_rows else []
    pieces = [(r.text_hash, k, max(1, -(-4 * r.bytes * shards // n_bytes), -(-4 * r.rows * shards // n_rows)) if max(r.bytes * shards / n_bytes, r.rows * shards / n_rows) > 1 else 1) for k, r in enumerate(sorted(hot, key=lambda r: r.text_hash))]
    own = F.broadcast(spark.createDataFrame(pieces, "text_hash long, hot long, pieces int"))
    piece = F.pmod(F.xxhash64(key, F.lit(5)), F.col("pieces").cast("long"))
    celled = rows.join(own, "text_hash", "left").withColumn("cell", F.when(F.col("hot").isNull(), cell_of(F.col("text_hash"))).otherwise(F.lit(1 << 40) + F.col("hot") * 65536 + piece)).drop("hot", "pieces")
    cells = sorted(celled.groupBy("cell").agg(F.sum("size").alias("bytes"), F.sum("n_tokens").alias("tokens"), F.count("*").alias("rows")).collect(), key=lambda r: r.cell)
    where = place(np.array([[r.bytes, r.tokens, r.rows] for r in cells], float).reshape(-1, 3), shards)
    plan = F.broadcast(spark.createDataFrame([(r.cell, int(s)) for r, s in zip(cells, where)], "cell long, shard int"))
    parts = max(1, -(-n_rows // (shards * slot_part)))
    placed = celled.join(plan, "cell").withColumn("part", F.pmod(F.xxhash64(key, "text_hash", F.lit(3)), F.lit(parts)))
    counts = placed.groupBy("shard", "part").count()
    before = counts.withColumn("before", F.sum("count").over(Window.partitionBy("shard").orderBy("part")) - F.col("count")).drop("count")
    inside = F.row_number().over(Window.partitionBy("shard", "part").orderBy(key, "text_crc32", "size")) - 1
    out = placed.withColumn("inside", inside).join(before, ["shard", "part"])
    return out.select(key, "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("before") + F.col("inside")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "n_tokens")


def query(spark, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"))
