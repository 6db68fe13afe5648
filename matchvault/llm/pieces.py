"""Sampled segmentation into the pieces of a SentencePiece model, and lossless decoding.

Forward filtering, backward sampling: over the lattice of a chunk (spaces and the run of other characters that follows
them; no piece crosses chunks) the weight of every prefix is the sum over its last pieces; a segmentation is drawn
from the end, each piece in proportion to its share of the prefix's weight. Draws depend on the row key and the
place in the text only. A piece's probability falls with its rank in the model, as ``rank ** -theta``. Characters
without a piece of their own are spelled with byte pieces. As in the model, a text starts with one more space.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchvault.llm import kernels
from matchvault.llm.store import unused

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = 32
TINY = 1e-120


class Pieces:
    """Arrays of a model's pieces: hashes of their bytes (a space for the meta symbol), weights, byte pieces."""

    def __init__(self, path: str, theta: float):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        normal = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.text = [b""] * size
        for i in normal:
            self.text[i] = model.id_to_piece(i).replace("▁", " ").encode()
        self.byte = np.full(256, -1, np.int64)
        for i in range(size):
            if model.is_byte(i):
                value = int(model.id_to_piece(i)[1:-1], 16)
                self.byte[value], self.text[i] = i, bytes([value])
        if (self.byte < 0).any():
            raise ValueError("the model has no byte pieces")
        self.longest = max(len(self.text[i]) for i in normal)
        data = np.frombuffer(b"".join(self.text), np.uint8)
        ends = np.cumsum([len(x) for x in self.text])
        starts = ends - [len(x) for x in self.text]
        self.data, self.starts, self.sizes = data, starts, ends - starts
        order = np.array(normal)
        hashed = kernels.span_hash(kernels.prefix_hash(data), starts[order], ends[order])
        sort = np.argsort(hashed)
        self.hash, self.id = hashed[sort], order[sort]
        rank = np.arange(1, len(order) + 1, dtype=np.float64)
        self.weight = np.zeros(size + 1)  # the last for no piece, -1
        self.weight[order] = rank**-theta
        self.weight[self.byte] = float(len(order) + 256) ** -theta
        self.weight /= self.weight.sum()
        top = (self.hash >> np.uint64(44)).astype(np.int64)
        self.filter = np.zeros(1 << 20, bool)
        self.filter[top] = True
        self.begins = np.searchsorted(top, np.arange(1 << 20)).astype(np.int32)
        self.most = int(np.bincount(top).max())

        single = {self.text[i] for i in normal if len(self.text[i]) == 1}
        self.ascii_byte = np.array([self.byte[b] if b < 128 and bytes([b]) not in single else -1 for b in range(256)], np.int32)

    def lookup(self, hashed):
        """The piece of each hash, or -1."""
        out, flat = np.full(hashed.size, -1, np.int32), hashed.ravel()
        some = np.flatnonzero(self.filter[(flat >> np.uint64(44)).astype(np.int64)])
        value = flat[some]
        at = self.begins[(value >> np.uint64(44)).astype(np.int64)]
        # Few pieces share their leading bits; one that is met behind them is no other's.
        for step in range(self.most):
            hit = self.hash.take(at + step, mode="clip") == value
            out[some[hit]] = self.id[at[hit] + step]
            some, value, at = some[~hit], value[~hit], at[~hit]
        return out.reshape(hashed.shape)


def _spelled(pieces, data, running):
    """Per byte, its byte piece where its character has no piece of its own, else -1."""
    out = pieces.ascii_byte[data]
    # Longer characters. A literal meta symbol is no space: spelled as well (no piece has its bytes).
    starts = np.flatnonzero(data >= 0xC0)
    if len(starts):
        size = 2 + (data[starts] >= 0xE0) + (data[starts] >= 0xF0)
        alone = pieces.lookup(kernels.span_hash(running, starts, starts + size)) < 0
        starts, size = starts[alone], size[alone]
        at = np.repeat(starts - (np.cumsum(size) - size), size) + np.arange(size.sum())
        out[at] = pieces.byte[data[at]]
    return out


def segment(pieces, data, offsets, keys):
    """``(ids, bounds)``: sampled pieces of a block's texts; ``keys`` seed the draws of each text."""
    some = np.diff(offsets) > 0
    data = np.insert(data, offsets[:-1][some], SPACE)
    offsets = offsets + np.concatenate([[0], np.cumsum(some)])
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    running = kernels.prefix_hash(data)
    space = data == SPACE
    begin = space.copy()
    begin[1:] &= ~space[:-1]
    begin[offsets[:-1][some]] = True
    starts = np.flatnonzero(begin)
    ends = np.append(starts[1:], len(data))
    text = np.searchsorted(offsets, starts, "right") - 1
    _, head, member = np.unique(kernels.span_hash(running, starts, ends), return_index=True, return_inverse=True)
    byte_piece = _spelled(pieces, data, running)
    drawn = np.full(len(data) + 1, -1, np.int32)
    size = ends[head] - starts[head]
    by_class = np.where(size <= 24, size, np.ceil(np.exp2(np.ceil(np.log2(np.maximum(size, 1)) * 2) / 2)).astype(np.int64))
    occurrence = np.argsort(member, kind="stable")
    bound = np.concatenate([[0], np.cumsum(np.bincount(member, minlength=len(head)))])
    for length in np.unique(by_class):
        group = np.flatnonzero(by_class == length)
        room = max(1, (1 << 21) // (int(size[group].max()) * min(int(size[group].max()), pieces.longest)))
        for low in range(0, len(group), room):
            some_chunks = group[low : low + room]
            share, piece = _filtered(pieces, starts[head][some_chunks], size[some_chunks], running, byte_piece)
            n = bound[some_chunks + 1] - bound[some_chunks]
            row = np.repeat(np.arange(len(some_chunks)), n)
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            own = occurrence[bound[some_chunks][row] + step]
            _sampled(share, piece, row, starts[own], size[some_chunks][row], offsets[text[own]], keys[text[own]], drawn)
    at = np.flatnonzero(drawn >= 0)
    # A piece stands at its last byte plus one.
    return drawn[at].astype(np.int64), np.searchsorted(at - 1, offsets)


def _filtered(pieces, start, size, running, byte_piece):
    """For each chunk and prefix length, the running share of each last piece by its length, and the piece."""
    most = int(size.max())
    reach = min(most, pieces.longest)
    total = np.zeros((len(start), most + 1))
    total[:, 0] = 1.0
    share = np.zeros((len(start), most + 1, reach), np.float32)
    piece = np.full((len(start), most + 1, reach), -1, np.int32)
    # What ``span_hash`` reads, for all places of the chunks at once.
    places = np.minimum(start[:, None] + np.arange(most + 1), len(running) - 1)
    sums, inverse = running[places], kernels.powers(kernels.BASE_INVERSE, len(running))[places]
    last = byte_piece[np.minimum(places, len(byte_piece) - 1)]
    for j in range(1, most + 1):
        # Last pieces of one byte, of two and so on, as places where they begin.
        n = min(j, reach)
        begin = slice(j - 1, j - 1 - n if j > n else None, -1)
        inside = size >= j
        with np.errstate(over="ignore"):
            found = pieces.lookup(kernels.mix((sums[:, j, None] - sums[:, begin]) * inverse[:, begin]))
        found[:, 0] = np.where(last[:, j - 1] >= 0, last[:, j - 1], found[:, 0])
        found[~inside] = -1
        weight = pieces.weight[found] * total[:, begin]
        summed = np.cumsum(weight, axis=1)
        all_of = summed[:, -1]
        share[:, j, :n] = summed / np.where(all_of > 0, all_of, 1)[:, None]
        share[:, j, n:] = 1
        piece[:, j, :n] = found
        total[:, j] = all_of
        low = (all_of > 0) & (all_of < TINY)
        if low.any():
            total[low] /= all_of[low][:, None]
    return share, piece


def _sampled(share, piece, row, start, left, text_start, key, drawn):
    left = left.copy()
    while len(row):
        at = start + left
        noise = kernels.mix(key ^ kernels.mix((at - text_start).astype(np.uint64), 90), 91)
        uniform = (noise >> np.uint64(40)).astype(np.float32) / np.float32(1 << 24)
        # The first length whose running share exceeds the draw.
        length = (share[row, left] <= uniform[:, None]).sum(axis=1)
        drawn[at] = piece[row, left, length]
        left = left - length - 1
        on = left > 0
        row, start, left, text_start, key = row[on], start[on], left[on], text_start[on], key[on]


def _fields(df, drop):
    keep = [f for f in df.schema.fields if f.name not in drop]
    return [f.name for f in keep], [f"`{f.name}` {f.dataType.simpleString()}" for f in keep]


def encode(docs: DataFrame, key="doc_id", model=MODEL, theta=1.0, seed=0) -> DataFrame:
    """``docs`` (with ``text``) with ``pieces``, an array of piece ids.

    Rows that repeat a key and a text get the same pieces; a null key counts as 0. A null text has null pieces, an
    empty one none. ``model`` is read on the driver. Other columns are kept, but for one named ``pieces``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Pieces(model, theta))
    names, schema = _fields(docs, ["pieces"])
    text, row_key = unused(docs.columns, "text_or_empty"), unused(docs.columns, "row_key")

    def run(batches):
        for batch in batches:
            for rows, data, offsets in kernels.blocks(batch, text, 2 * kernels.BLOCK):
                keys = np.asarray(batch.column(row_key)[rows], dtype=np.int64).view(np.uint64)
                ids, bounds = segment(shared.value, data, offsets, kernels.mix(keys, 100 + seed))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c)[rows] for c in names), kernels.lists(ids.astype(np.int32), bounds)], names=[*names, "pieces"]
                )

    prepared = docs.withColumns({text: F.coalesce("text", F.lit("")), row_key: F.coalesce(F.col(key).cast("long"), F.lit(0))})
    out = prepared.select(*names, text, row_key).mapInArrow(run, ", ".join([*schema, "pieces array<int>"]))
    return out.withColumn("pieces", F.when(F.col("text").isNotNull(), F.col("pieces"))) if "text" in names else out


def decode(df: DataFrame, model=MODEL) -> DataFrame:
    """``df`` with ``decoded``, the text that its ``pieces`` spell; null pieces become empty ones, which spell "".

    Native, so that a task that encodes and decodes has one Python worker, and texts go there once. Pieces may end
    inside a character, so they are joined as hexadecimal digits.
    """
    digits = F.split(F.lit(",".join(x.hex() for x in Pieces(model, 1.0).text)), ",")
    pieces = F.coalesce("pieces", F.expr("cast(array() AS array<int>)"))
    names = [F.col(f"`{c}`") if c != "pieces" else pieces.alias(c) for c in df.columns if c != "decoded"]
    joined = F.unhex(F.array_join(F.transform(pieces, lambda piece: digits[piece]), ""))
    # Each text's first byte is the space that encoding put before it.
    return df.select(*names, F.substring(joined, 2, (1 << 31) - 1).cast("string").alias("decoded"))
