"""Exact substring removal over a sparse suffix array.

Only suffixes at content-defined anchors are sorted. An anchor is the position of the smallest hash (the last of
equals) among the ``GRAM``-byte strings inside a window of ``length`` bytes, so each window has one anchor, and
equal windows have it at the same place. The windows of one anchor are a run of starts. Anchors whose string
with the context on either side occurs in one document only cannot lie in a repeat; a bit map of fixed size over
those that recur leaves them out (false positives only add work). The others are range-partitioned by their leading bytes, with splitters
that Spark samples, and by document, so that a common string is cut into several buckets. Within a bucket a
multikey sort over 64-bit characters brings equal suffixes together; only the first document of each keeps it.
Different suffixes with one leading string are compared window by window, by 64-bit hashes joined with that of the
leading string. Where a run crosses a bucket's edge or is longer than ``RUN`` suffixes, its windows are compared by a
distributed aggregate.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchvault.llm import kernels
from matchvault.llm.store import bit_map, written

GRAM = 16
MAP_BITS = 26
RUN = 1 << 13


def _anchors(data, offsets, length):
    """``(at, low, high, text, running)``: anchors, first and last start of their windows, their texts; the hash sums."""
    running = kernels.prefix_hash(data)
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none, running
    starts = np.arange(len(data) - GRAM + 1)
    # The hash above, the place (later is smaller) below: the least is the last of the smallest hashes.
    low_word = np.uint64(0xFFFFFFFF)
    least = (kernels.span_hash(running, starts, starts + GRAM) & ~low_word) | (low_word - starts.astype(np.uint64))
    windows, span = length - GRAM + 1, 1
    while 2 * span <= windows:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < windows:
        least = np.minimum(least[: len(least) - (windows - span)], least[windows - span :])
    text = np.repeat(np.arange(len(offsets) - 1), np.maximum(np.diff(offsets) - length + 1, 0))
    if not len(text):
        return none, none, none, none, running
    before = np.concatenate([[0], np.cumsum(np.maximum(np.diff(offsets) - length + 1, 0))])
    start = offsets[:-1][text] + np.arange(len(text)) - before[text]
    at = (low_word - (least[start] & low_word)).astype(np.int64)
    cut = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (text[1:] != text[:-1])]))
    last = np.concatenate([cut[1:], [len(at)]]) - 1
    return at[cut], start[cut], start[last], text[cut], running


def _marked(known, key):
    """Which 32-bit keys the bit map has."""
    place = (key >> np.uint64(64 - MAP_BITS)).astype(np.int64)
    return (known[place >> 3] >> (place & 7)) & 1 == 1


def _gram(running, at):
    return kernels.span_hash(running, at, at + GRAM)


def _recurring(length, known, at, low, high, text, running):
    """The anchors whose string recurs with half of the context on one side or the rest on the other."""
    some = np.zeros(len(at), bool)
    for which, key in _contexts(length, at, low, high, running):
        some[which] |= _marked(known, key)
    return at[some], low[some], high[some], text[some]


def _contexts(length, at, low, high, running):
    """Every window holds its anchor's string with ``half`` bytes before it, or with the rest after it."""
    half = (length - GRAM) // 2
    before, after = np.flatnonzero(at - low >= half), np.flatnonzero(at - high < half)
    yield before, kernels.mix(kernels.span_hash(running, at[before] - half, at[before] + GRAM), 3)
    yield after, kernels.mix(kernels.span_hash(running, at[after], at[after] + length - half), 4)


def _keys(length, kept):
    """Upper half of the keys of a block's anchors in context, with the number of texts (one or more) of each."""
    schema = pa.schema([("key", pa.int32()), ("n", pa.int32())])

    def run(batches):
        for batch in batches:
            for _, data, offsets in kernels.blocks(_processed(batch, kept)):
                at, low, high, text, running = _anchors(data, offsets, length)
                found = list(_contexts(length, at, low, high, running))
                key, text = np.concatenate([k for _, k in found]), np.concatenate([text[w] for w, _ in found])
                both = np.unique((key & np.uint64(0xFFFFFFFF00000000)) | text.astype(np.uint64)) >> np.uint64(32)
                if len(both):
                    key, n = np.unique(both, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key.astype(np.uint32).view(np.int32)), pa.array(np.minimum(n, 2).astype(np.int32))],
                        schema=schema,
                    )

    return run, "key int, n int"


def _processed(batch, kept):
    """Rows of a batch in the bit map ``kept``."""
    if not batch.num_rows:
        return batch
    place = (batch.column("digest").to_numpy().view(np.uint64) >> np.uint64(64 - MAP_BITS)).astype(np.int64)
    return batch.filter(pa.array((kept.value[place >> 3] >> (place & 7)) & 1 == 1))


def _suffixes(length, kept, shared):
    """Anchors that recur: leading string, the bytes of all their windows, document, first window start."""
    schema = pa.schema(
        [("gram", pa.int64()), ("doc_id", pa.int64()), ("version", pa.int32()), ("low", pa.int32()), ("bytes", pa.binary())]
    )

    def run(batches):
        for batch in batches:
            batch = _processed(batch, kept)
            ids, versions = batch.column("doc_id").to_numpy(), batch.column("version").to_numpy()
            for rows, data, offsets in kernels.blocks(batch):
                at, low, high, text, running = _anchors(data, offsets, length)
                at, low, high, text = _recurring(length, shared.value, at, low, high, text, running)
                if not len(at):
                    continue
                size = high - low + length
                bounds = np.concatenate([[0], np.cumsum(size)])
                taken = data[np.repeat(low - bounds[:-1], size) + np.arange(bounds[-1])]
                cells = pa.Array.from_buffers(
                    pa.binary(), len(at), [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(taken)]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(kernels.signed(_gram(running, at))),
                        pa.array(ids[rows][text]),
                        pa.array(versions[rows][text]),
                        pa.array((low - offsets[text]).astype(np.int32)),
                        cells,
                    ],
                    schema=schema,
                )

    return run, "gram long, doc_id long, version int, low int, bytes binary"


class _Suffixes:
    """Columns of some suffix rows, with equal byte strings named by one group number."""

    def __init__(self, table):
        columns = {c: table.column(c).to_numpy() for c in ("gram", "doc_id", "version", "low")}
        self.gram, self.doc, self.version, self.low = columns.values()
        cells = pa.concat_arrays(table.column("bytes").chunks)
        _, where, what = cells.buffers()
        self.offsets = np.frombuffer(where, np.int32)[cells.offset : cells.offset + len(cells) + 1].astype(np.int64)
        self.data = np.frombuffer(what, np.uint8)
        self.size = np.diff(self.offsets)
        order, new = _multikey_sort(self._characters())
        self.group = np.empty(len(order), np.int64)
        self.group[order] = np.cumsum(new) - 1
        starts = np.flatnonzero(new)
        self.least = np.minimum.reduceat(self.doc[order], starts)
        # One row of each group stands for it.
        self.head = order[starts]

    def _characters(self):
        """Suffixes as rows of 64-bit characters: the leading string's hash, the length, then the bytes."""
        wide = -(-int(self.size.max()) // 8) * 8
        cells = np.zeros((len(self.size), wide), np.uint8)
        row = np.repeat(np.arange(len(self.size)), self.size)
        step = np.arange(self.size.sum()) - np.repeat(self.offsets[:-1] - self.offsets[0], self.size)
        cells[row, step] = self.data[self.offsets[0] : self.offsets[-1]]
        lead = [self.gram.view(np.uint64)[:, None], self.size.astype(np.uint64)[:, None]]
        return np.concatenate([*lead, cells.view(">u8").astype(np.uint64)], axis=1)

    def windows(self, length):
        """``(group, step, key)`` of each window of each group; equal keys mean equal bytes."""
        base = self.offsets[0]
        running = kernels.prefix_hash(self.data[base : self.offsets[-1]])
        counts = self.size[self.head] - length + 1
        group = np.repeat(np.arange(len(counts)), counts)
        step = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        start = self.offsets[self.head][group] - base + step
        key = kernels.span_hash(running, start, start + length)
        return group, step, key ^ kernels.mix(self.gram.view(np.uint64))[self.head][group]


def _multikey_sort(characters):
    """``(order, new)``: rows sorted character by character, each only among the rows still equal; run starts."""
    order = np.argsort(characters[:, 0], kind="stable")
    first = characters[order, 0]
    new = np.concatenate([[True], first[1:] != first[:-1]])
    for j in range(1, characters.shape[1]):
        tied = ~new
        tied[:-1] |= ~new[1:]
        at = np.flatnonzero(tied)
        if not len(at):
            break
        run = np.cumsum(new)[at]
        mine = order[at]
        own = np.lexsort((characters[mine, j], run))
        order[at] = mine[own]
        value = characters[order[at], j]
        new[at[1:]] |= value[1:] != value[:-1]
    return order, new


_SPANS = pa.schema([(c, pa.int64()) for c in ("doc_id", "version", "start", "end", "key")])


def _rows(held, row, start, end, key=None):
    low = held.low[row].astype(np.int64)
    columns = [held.doc[row], held.version[row].astype(np.int64), low + start, low + end]
    return pa.RecordBatch.from_arrays(
        [*map(pa.array, columns), pa.nulls(len(row), pa.int64()) if key is None else pa.array(kernels.signed(key))],
        schema=_SPANS,
    )


def _spread(group, rows, group_of):
    """Pairs ``(i, row)`` of each entry i of ``group`` (ascending) with every one of ``rows`` in the same group."""
    low, high = np.searchsorted(group, group_of[rows], "left"), np.searchsorted(group, group_of[rows], "right")
    n = high - low
    return np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum()), np.repeat(rows, n)


def _compared(length):
    """Per bucket: the spans that a smaller document has too, and the windows of runs cut by its edges."""

    def repeated(held):
        """A suffix equal to one of a smaller document goes whole."""
        row = np.flatnonzero(held.doc > held.least[held.group])
        if len(row):
            yield _rows(held, row, 0, held.size[row])

    def settled(held, cut):
        """Spans that go by what is here; with ``cut``, also the windows that stay, for the other pieces of a run."""
        yield from repeated(held)
        group, step, key = held.windows(length)
        order = np.argsort(key)
        first = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1]]))
        least = np.minimum.reduceat(held.least[group[order]], first)
        gone = np.zeros(len(key), bool)
        gone[order] = np.repeat(least, np.diff([*first, len(order)])) < held.least[group[order]]
        owners = np.flatnonzero(held.doc == held.least[held.group])
        at = np.flatnonzero(gone)
        if len(at):
            joint = (group[at][1:] == group[at][:-1]) & (step[at][1:] == step[at][:-1] + 1)
            low, high = at[np.concatenate([[True], ~joint])], at[np.concatenate([~joint, [True]])]
            i, row = _spread(group[low], owners, held.group)
            yield _rows(held, row, step[low][i], step[high][i] + length)
        at = np.flatnonzero(~gone)
        if cut and len(at):
            i, row = _spread(group[at], owners, held.group)
            yield _rows(held, row, step[at][i], step[at][i] + length, key[at][i])

    def closed(table, cut):
        gram = table.column("gram").to_numpy()
        loose = np.isin(gram, np.array(sorted(cut), dtype=np.int64))
        if not loose.all():
            yield from settled(_Suffixes(table.filter(pa.array(~loose))), False)
        part = table.filter(pa.array(loose))
        for low in range(0, part.num_rows, RUN):
            yield from settled(_Suffixes(part.slice(low, RUN)), True)

    def run(batches):
        rest, cut = None, set()
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            if rest is not None:
                table = pa.concat_tables([rest, table])
            if table.num_rows < RUN:
                rest = table
                continue
            gram = table.column("gram").to_numpy()
            if not cut:
                cut.add(int(gram[0]))
            change = np.flatnonzero(gram[1:] != gram[:-1]) + 1
            done = int(change[-1]) if len(change) else 0
            if len(gram) - done > RUN:
                cut.add(int(gram[-1]))
                done = len(gram)
            if done:
                yield from closed(table.slice(0, done), cut)
            rest = table.slice(done)
        if rest is not None and rest.num_rows:
            first, last = (int(rest.column("gram")[i].as_py()) for i in (0, -1))
            yield from closed(rest, (cut or {first}) | {last})

    return run, "doc_id long, version long, start long, end long, key long"


def repeated_spans(docs: DataFrame, length: int = 50) -> DataFrame:
    """``(doc_id, version, spans)``: for texts that lose any, the sorted disjoint ``[start, end)`` bytes removed.

    A byte goes if a string of ``length`` bytes over it also starts in a document with a smaller id. Matches stay
    within texts; null texts are empty. ``docs`` has ``doc_id`` and ``text``; rows of one id are texts of one
    document, told apart by ``version`` (the hash of the text), which do not count against each other; rows without
    an id lose nothing and count against none.
    """
    spark = docs.sparkSession
    texts = _texts(docs).where("doc_id IS NOT NULL")
    # Copies of a text: all but the first go whole, and only firsts are sorted. Their bit map has no false
    # negatives, so a first is never left out; a copy that passes it is found by its suffixes as well.
    named = texts.select(
        "doc_id", "version", F.octet_length("text").alias("size"), F.xxhash64("text").alias("d1"), "digest",
        F.xxhash64("text", F.lit(1)).alias("d2"),
    )
    heads = written(named.groupBy("d1", "d2").agg(F.min_by("digest", "doc_id").alias("digest"), F.min("doc_id").alias("head"), F.count("*").alias("n")))
    copies = (
        named.join(heads.where("n > 1").select("d1", "d2", "head"), ["d1", "d2"])
        .where((F.col("doc_id") > F.col("head")) & (F.col("size") >= length))
        .select("doc_id", "version", F.lit(0).cast("long").alias("start"), F.col("size").cast("long").alias("end"))
    )
    top = F.expr(f"shiftrightunsigned(digest, {64 - MAP_BITS})").alias("at")
    kept = spark.sparkContext.broadcast(bit_map(heads.select(top).distinct(), MAP_BITS))

    run, schema = _keys(length, kept)
    often = texts.mapInArrow(run, schema).groupBy("key").agg(F.sum("n").alias("n")).where("n > 1")
    places = often.select(F.expr(f"shiftrightunsigned(key, {32 - MAP_BITS})").cast("long")).distinct()
    shared = spark.sparkContext.broadcast(bit_map(places, MAP_BITS))
    run, schema = _suffixes(length, kept, shared)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_suffixes = (
        texts.mapInArrow(run, schema).repartitionByRange(buckets, "gram", "doc_id", "low")
        .sortWithinPartitions("gram", "doc_id", "low")
    )
    run, schema = _compared(length)
    found = written(sorted_suffixes.mapInArrow(run, schema))
    loose = found.where("key IS NOT NULL")
    least = loose.groupBy("key").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most")
    late = loose.join(least, "key").where("doc_id > least").select("doc_id", "version", "start", "end")
    spans = found.where("key IS NULL").select("doc_id", "version", "start", "end").unionByName(late).unionByName(copies)
    merge = F.expr(
        "aggregate(array_sort(collect_set(struct(start, end))), cast(array() AS array<struct<start:bigint,end:bigint>>), "
        "(a, x) -> CASE WHEN size(a) > 0 AND element_at(a, -1).end >= x.start THEN concat(slice(a, 1, size(a) - 1), "
        "array(struct(element_at(a, -1).start AS start, greatest(element_at(a, -1).end, x.end) AS end))) "
        "ELSE concat(a, array(x)) END)"
    )
    return spans.groupBy("doc_id", F.col("version").cast("int").alias("version")).agg(merge.alias("spans"))


def _texts(docs):
    text = F.coalesce("text", F.lit(""))
    doc_id, version = F.col("doc_id").cast("long"), F.hash(text)
    return docs.select(
        doc_id.alias("doc_id"), text.alias("text"), version.alias("version"),
        F.xxhash64(doc_id, version).alias("digest"),
    )


def without_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """Each row of ``docs(doc_id, text)`` with its sizes and the SHA-256 of the bytes that stay.

    Returns doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (binary: a span may end inside a character).
    Texts cross the shuffle deflated.
    """
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
         ("kept_sha256", pa.string()), ("kept", pa.binary())]
    )

    def deflated(batches):
        for batch in batches:
            packed = [zlib.compress(x.as_buffer(), 1) for x in batch.column("text")]
            keys = [batch.column("doc_id"), batch.column("version")]
            yield pa.RecordBatch.from_arrays([*keys, pa.array(packed, pa.binary())], names=["doc_id", "version", "packed"])

    def run(batches):
        for batch in batches:
            out, size = [], 0
            for doc, text, gone in zip(*(batch.column(c) for c in ("doc_id", "packed", "spans")), strict=True):
                raw, at, kept, n, gone = zlib.decompress(text.as_buffer()), 0, [], 0, gone.as_py() or []
                for span in gone:
                    kept.append(raw[at : span["start"]])
                    n += span["end"] - span["start"]
                    at = span["end"]
                kept = b"".join([*kept, raw[at:]])
                out.append((doc.as_py(), len(raw), n, len(gone), hashlib.sha256(kept).hexdigest(), kept))
                size += len(kept)
                if size >= kernels.BLOCK:
                    yield _batch(out, schema)
                    out, size = [], 0
            if out:
                yield _batch(out, schema)

    packed = _texts(docs).select("doc_id", "version", "text").mapInArrow(deflated, "doc_id long, version int, packed binary")
    return packed.join(spans, ["doc_id", "version"], "left").mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    )


def _batch(rows, schema):
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema
    )
