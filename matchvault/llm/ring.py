"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

The ring has ``CELLS`` cells. Every shard owns ``POINTS`` virtual nodes at cell borders; a row's key hashes to a cell,
and the first node at or after it, clockwise, names its home. Counts per cell, of which there are never more than
``CELLS``, go to the driver, which walks the ring once per round: each shard takes what is offered up to its
capacity, nearest cells first, and what does not fit goes on to the next node of a shard not yet tried. Rows then
find their place by their rank within their cell, counted in parallel.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchvault.llm import kernels
from matchvault.llm.store import written

CELLS = 1 << 16
POINTS = 128


def nodes(shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Cells and owners of all virtual nodes, clockwise. A shard's nodes do not depend on how many shards there are."""
    shard = np.repeat(np.arange(shards), POINTS)
    place = kernels.mix(shard.astype(np.uint64) * np.uint64(POINTS) + np.tile(np.arange(POINTS), shards).astype(np.uint64), 40)
    cell = (place >> np.uint64(48)).astype(np.int64) % CELLS
    order = np.lexsort((shard, cell))
    return cell[order], shard[order]


def place_cells(counts: np.ndarray, shards: int, slack: float = 0.0) -> list[tuple[int, int, int, int, int]]:
    """``(cell, from_rank, to_rank, shard, first_slot)`` for the rows of all cells, under the bounded loads.

    Without slack the capacities add up to the rows, so loads differ by one at most; otherwise each is
    ``ceil(rows / shards * (1 + slack))``.
    """
    rows = int(counts.sum())
    if slack:
        room = [-(-int(rows * (1 + slack)) // shards)] * shards
    else:
        room = [rows // shards + (s < rows % shards) for s in range(shards)]
    cell_of, owner = nodes(shards)
    used, out = [0] * shards, []
    offers = []
    for cell in np.flatnonzero(counts):
        at = int(np.searchsorted(cell_of, cell)) % len(cell_of)
        offers.append((int(cell), 0, int(counts[cell]), at, 0))
    while offers:
        # Nearest first: the distance from the cell to the node it has come to.
        offers.sort(key=lambda o: ((int(cell_of[o[3] % len(owner)]) - o[0]) % CELLS, o[0], o[1]))
        onward = []
        for cell, low, high, at, tried in offers:
            shard = int(owner[at % len(owner)])
            take = min(room[shard] - used[shard], high - low)
            if take > 0:
                out.append((cell, low, low + take, shard, used[shard]))
                used[shard] += take
            if take < high - low:
                tried |= 1 << shard
                while tried != (1 << shards) - 1 and tried >> int(owner[at % len(owner)]) & 1:
                    at += 1
                onward.append((cell, low + max(take, 0), high, at, tried))
        offers = onward
    return out


def bounded_shards(docs: DataFrame, shards: int, slack: float = 0.0) -> DataFrame:
    """Each row of ``docs(doc_id, text)`` with size (UTF-8 bytes plus 1), text_crc32, shard and slot.

    Slots of a shard are gapless from 0. A row's key is its id; rows without one use their text. Equal rows are
    counted before anything is sorted and share a range of slots, so repeated rows form no hot group. A null
    text has size 1 and the checksum of the empty text.
    """
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + F.lit(1).cast("long")).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    key = F.coalesce(F.xxhash64("doc_id", F.lit(7)), F.lit(0))
    key = F.when(F.col("doc_id").isNull(), F.xxhash64("text_crc32", "size")).otherwise(key)
    groups = keyed.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("copies"))
    groups = written(groups.withColumn("key", key).withColumn("cell", F.expr(f"shiftrightunsigned(key, 48) % {CELLS}")))
    counted = groups.groupBy("cell").agg(F.sum("copies").alias("n")).toArrow()
    counts = np.zeros(CELLS, np.int64)
    counts[counted["cell"].to_numpy()] = counted["n"].to_numpy()
    ranges = spark.createDataFrame(
        place_cells(counts, shards, slack), "at int, low long, high long, shard int, base long"
    )
    order = Window.partitionBy("cell").orderBy("key", "doc_id", "size", "text_crc32")
    ranked = groups.withColumn("rank", F.sum("copies").over(order) - F.col("copies"))
    inside = (F.col("cell") == F.col("at")) & (F.col("rank") < F.col("high")) & (F.col("rank") + F.col("copies") > F.col("low"))
    first, last = F.greatest("rank", "low"), F.least(F.col("rank") + F.col("copies"), "high")
    return (
        # At most one range per cell and shard tried: CELLS * shards short rows, whatever the data.
        ranked.join(F.broadcast(ranges), inside)
        .select("doc_id", "size", "text_crc32", "shard", F.explode(F.sequence(first, last - 1)).alias("rank"), "base", "low")
        .select("doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("rank") - F.col("low")).alias("slot"))
    )
