"""Substring removal by content-defined chunks.

A gear hash rolls over the last ``REACH`` bytes; a position whose hash has ``MASK`` zero bits is a cut unless
another lies within ``least`` bytes before it, and a chunk longer than ``most`` is cut further at multiples of
``most``. All but the last rule look at nearby bytes only, so that an insertion moves no cut beyond its
neighbourhood. Chunks are compared by a 128-bit digest; the first copy, by document and place, stays.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchvault.llm import kernels

REACH = 16
MASK = 4
GEAR = kernels.mix(np.arange(256, dtype=np.uint64), 5)
HELD = 1 << 17  # chunks that a task remembers at most from the blocks it has read


def gear_hash(data: np.ndarray) -> np.ndarray:
    """``sum(GEAR[data[i - j]] << j)`` for j below ``REACH``, by doubling."""
    out, span = GEAR[data], 1
    with np.errstate(over="ignore"):
        while span < REACH:
            out[span:] = out[span:] + (out[:-span] << np.uint64(span))
            span *= 2
    return out


def cut_points(data, offsets, least, most):
    """Sorted chunk starts of a block: every text's start, then its cuts."""
    place = np.flatnonzero(gear_hash(data) >> np.uint64(64 - MASK) == 0) + 1
    text = np.searchsorted(offsets, place, "right") - 1
    # The hash of a text's first bytes reaches into the text before.
    place = place[(place - offsets[text] >= max(least, REACH)) & (place < offsets[-1])]
    if len(place):
        place = place[np.concatenate([[True], np.diff(place) >= least])]
    starts = np.unique(np.concatenate([place, offsets[:-1][np.diff(offsets) > 0]]))
    size = np.diff(np.concatenate([starts, offsets[-1:]]))
    pieces = -(-size // most)
    step = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    return np.repeat(starts, pieces) + step * most


class _Seen:
    """Chunks that repeated within a block of this task, with the first place of each.

    A chunk in a third of all documents repeats in every block; remembered, it goes on about once per task and
    forms no hot group. Forgetting any of them changes no result, as a late chunk is one that has an earlier equal.
    """

    def __init__(self):
        self.rows = np.zeros((4, 0), np.int64)

    def earlier(self, d1, d2, doc, place):
        """Which chunks have an equal one, earlier by document and place, among those remembered."""
        known = self.rows
        if not known.shape[1]:
            return np.zeros(len(d1), bool)
        at = np.minimum(np.searchsorted(known[0], d1), known.shape[1] - 1)
        of = known[:, at]
        return (of[0] == d1) & (of[1] == d2) & ((of[2] < doc) | ((of[2] == doc) & (of[3] < place)))

    def add(self, *columns):
        rows = np.concatenate([self.rows, np.stack(columns)], axis=1)
        rows = rows[:, np.lexsort(rows[[3, 2, 0]])]
        rows = rows[:, np.diff(rows[0], prepend=rows[0][:1] - 1) != 0]
        self.rows = rows if rows.shape[1] <= HELD else np.zeros((4, 0), np.int64)


def _chunked(least, most):
    """Chunks with digests. Within a block only the first of equal chunks goes on; the others are marked late, as
    are those of which the task has seen an earlier copy."""
    names = ["doc_id", "version", "start", "end", "d1", "d2", "late"]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_()]
    schema = pa.schema(list(zip(names, kinds, strict=True)))

    def run(batches):
        seen = _Seen()
        for batch in batches:
            ids, versions = batch.column("doc_id").to_numpy(), batch.column("version").to_numpy()
            for rows, data, offsets in kernels.blocks(batch):
                starts = cut_points(data, offsets, least, most)
                if not len(starts):
                    continue
                ends = np.concatenate([starts[1:], offsets[-1:]])
                text = np.searchsorted(offsets, starts, "right") - 1
                running = kernels.prefix_hash(data)
                d1 = kernels.span_hash(running, starts, ends) ^ (ends - starts).astype(np.uint64)
                turned = kernels.prefix_hash(data ^ np.uint8(0xA5) ^ np.roll(data, 1))
                # The second digest mixes neighbouring bytes, from the chunk's second byte on.
                d2 = kernels.span_hash(turned, np.minimum(starts + 1, ends), ends)
                doc = ids[rows][text]
                place = starts - offsets[text]
                order = np.lexsort((place, doc, d2, d1))
                new = (d1[order][1:] != d1[order][:-1]) | (d2[order][1:] != d2[order][:-1])
                first = order[np.maximum.accumulate(np.where(np.concatenate([[True], new]), np.arange(len(order)), 0))]
                late = np.zeros(len(starts), bool)
                late[order] = (doc[order] != doc[first]) | (place[order] != place[first])
                known = kernels.signed(d1), kernels.signed(d2), doc, place
                twice = np.unique(first[late[order]])
                late |= seen.earlier(*known)
                if len(twice):
                    seen.add(*(c[twice] for c in known))
                own = kernels.mix(kernels.mix(doc.view(np.uint64)) ^ starts.astype(np.uint64), 9)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc),
                        pa.array(versions[rows][text]),
                        pa.array(place.astype(np.int32)),
                        pa.array((ends - offsets[text]).astype(np.int32)),
                        # A late chunk needs no partner; keys of its own spread it evenly.
                        pa.array(kernels.signed(np.where(late, own, d1))),
                        pa.array(kernels.signed(np.where(late, own, d2))),
                        pa.array(late),
                    ],
                    schema=schema,
                )

    return run, "doc_id long, version int, start int, end int, d1 long, d2 long, late boolean"


def repeated_chunks(docs: DataFrame, least=16, most=256, span=64) -> DataFrame:
    """Chunk statistics of every row of ``docs(doc_id, text)`` and the byte spans that earlier copies cover.

    Returns doc_id, version (hash of the text, telling apart rows of one id), n_bytes, n_chunks, n_repeated, and
    ``spans``: sorted disjoint ``[start, end)`` of neighbouring repeated chunks, at least ``span`` bytes long
    together (a text that repeats whole goes whatever its length). Equal rows are one document. A chunk is repeated if an equal one starts
    earlier, by document id (null first) and place. Null texts are empty and have no chunks.
    """
    text = F.coalesce("text", F.lit(""))
    base = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc_id"), text.alias("text"),
                       F.hash(text).alias("version"))
    run, schema = _chunked(least, most)
    same = Window.partitionBy("d1", "d2")
    first = F.min(F.struct("doc_id", "start", "version")).over(same)
    chunks = base.mapInArrow(run, schema).withColumn("first", first)
    chunks = chunks.select(
        "doc_id", "version", "start", "end",
        (F.col("late") | (F.col("first") < F.struct("doc_id", "start", "version"))).alias("repeated"),
    )
    merged = F.expr(
        "aggregate(array_sort(collect_set(CASE WHEN repeated THEN struct(start, end) END)), "
        "cast(array() AS array<struct<start:int,end:int>>), "
        "(a, x) -> CASE WHEN size(a) > 0 AND element_at(a, -1).end >= x.start THEN concat(slice(a, 1, size(a) - 1), "
        "array(struct(element_at(a, -1).start AS start, greatest(element_at(a, -1).end, x.end) AS end))) "
        "ELSE concat(a, array(x)) END)"
    )
    found = chunks.groupBy("doc_id", "version").agg(
        F.size(F.collect_set("start")).cast("long").alias("n_chunks"),
        F.size(F.collect_set(F.when(F.col("repeated"), F.col("start")))).cast("long").alias("n_repeated"), F.max("end").alias("most"),
        merged.alias("spans"),
    )
    found = found.withColumn("spans", F.expr(f"filter(spans, x -> x.end - x.start >= least({span}, most))")).drop("most")
    rows = base.select("doc_id", "version", F.octet_length("text").cast("long").alias("n_bytes"))
    return rows.join(found, ["doc_id", "version"], "left").select(
        F.when(F.col("doc_id") > -(1 << 63), F.col("doc_id")).alias("doc_id"), "version", "n_bytes",
        F.coalesce("n_chunks", F.lit(0)).alias("n_chunks"), F.coalesce("n_repeated", F.lit(0)).alias("n_repeated"),
        F.coalesce("spans", F.expr("cast(array() AS array<struct<start:int,end:int>>)")).alias("spans"),
    )
