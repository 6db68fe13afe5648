"""Interpolated modified Kneser-Ney language model: counted in Spark, kept as sorted hash arrays, mapped by the scorers.

A word is its 64-bit hash. Every text ends with an end token, and ``order - 1`` start marks stand before it. The highest
order counts n-grams; each lower order counts, for each n-gram, the different words seen before it. A task reduces
its share to distinct n-grams and sends them, packed, to the shard of their context (all words but the last), so that
all of a context's followers meet; an n-gram then goes on, once, to the shard of its last ``n - 1`` words. Each shard
writes two arrays, its n-grams' counts and its contexts' totals; only totals of the whole corpus reach the driver.

Texts are scored where they are: a task sorts the n-grams of some megabytes of text and looks them up in the mapped
arrays of one shard after the other, so a task's memory does not grow with the model.
"""

from __future__ import annotations

import dataclasses
import functools
import struct
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchvault.llm import hasharray, kernels
from matchvault.llm.store import shared_folder, written

START, END = 0x5DEECE66D1234567, 0x2545F4914F6CDD1D
FLUSH = 3 << 19  # tokens that a task reduces at once
BLOCK = 1 << 23  # bytes of text scored at once
SHARD_BYTES = 16 << 20  # text whose n-grams go to one shard
SHORT = (1 << 20) - 1  # so many of the commonest words are sent by their rank, not their hash; a matter of size only
OFTEN = 4
ROW = "level int, shard int, packed binary"
SCHEMA = pa.schema([("level", pa.int32()), ("shard", pa.int32()), ("packed", pa.binary())])


@dataclasses.dataclass(frozen=True)
class Model:
    """Where the arrays are, and the corpus totals that every probability needs."""

    folder: str
    order: int
    shards: int
    tokens: int  # training tokens
    words: int  # different ones
    totals: tuple  # continuation counts in all, and how many are 1, 2, 3 or more
    discounts: tuple  # by level from 1: what a count of 1, 2, 3 or more loses


def gram_keys(columns):
    """``(contexts, keys)`` of n-grams given as one column for each word: of all words but the last, and of all."""
    key = np.zeros(len(columns[0]), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for c in columns:
            context, key = key, key * np.uint64(kernels.BASE)
            key += c
            key = kernels.mix(key, 41)
    return context if len(columns) > 1 else key, key


def _spread(contexts):
    """32 bits of each context, in whose ascending order shards follow each other."""
    return kernels.mix(contexts, 43) >> np.uint64(32)


def _home(spread, shards):
    """The shard of each n-gram: that of its context, or its own where there is none."""
    return ((spread * np.uint64(shards)) >> np.uint64(32)).astype(np.int32)


def _changes(values):
    """Where a value differs from the one before it; the first place is one of them."""
    return np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])[: len(values)])


def _tokens(data, offsets):
    """``(token, first)``: the hashes of all words of a block and where each text's begin, a megabyte of text at a time."""
    tokens, counts, low, n = [], [], 0, len(offsets) - 1
    while low < n:
        high = min(n, max(low + 1, int(np.searchsorted(offsets, offsets[low] + kernels.BLOCK, "right")) - 1))
        some = data[offsets[low] : offsets[high]]
        starts, ends, first = kernels.words(some, offsets[low : high + 1] - offsets[low])
        tokens.append(kernels.span_hash(kernels.prefix_hash(kernels.LOWER[some]), starts, ends))
        counts.append(np.diff(first))
        low = high
    return np.concatenate(tokens), np.cumsum(np.concatenate([[0], *counts]))


def _stream(data, offsets, order):
    """``(words, at, first)``: word hashes with marks, the places of the tokens, and each text's first token."""
    token, first = _tokens(data, offsets)
    count = np.diff(first)
    n = len(count)
    text = np.repeat(np.arange(n), count)
    words = np.full(len(token) + n * order, START, dtype=np.uint64)
    words[np.arange(len(token)) + text * order + order - 1] = token
    words[first[1:] + np.arange(1, n + 1) * order - 1] = END
    places = np.ones(len(words), dtype=bool)
    marks = (first[:-1] + np.arange(n) * order)[:, None] + np.arange(order - 1)
    places[marks.ravel()] = False
    return words, np.flatnonzero(places), first[:-1] + np.arange(n)


def _summed(columns, names, counts=None):
    """``(columns, names, counts, contexts, keys)`` of the distinct n-grams, in ascending order of keys, counts summed.

    Without ``counts`` each row counts as one. The lists are used up, so that a column given and the one made of it
    are not held longer than need be.
    """
    contexts, keys = gram_keys(columns)
    order = np.argsort(keys)
    keys = keys[order]
    at = _changes(keys)
    if counts is None:
        counts = np.diff(at, append=len(keys))
    elif len(at):
        counts = np.add.reduceat(counts[order], at)
    one, keys = order[at], keys[at]
    del order, at
    contexts = contexts[one]
    return [columns.pop(0)[one] for _ in range(len(columns))], [names.pop(0)[one] for _ in range(len(names))], counts, contexts, keys


def _names(column, short):
    """The rank of each word hash among the commonest words, ``SHORT`` for others. ``short``: sorted hashes, their ranks."""
    if not len(short[0]):
        return np.full(len(column), SHORT, dtype=np.uint32)
    words, back = np.unique(column, return_inverse=True)
    at = np.minimum(np.searchsorted(short[0], words), len(short[0]) - 1)
    return np.where(short[0][at] == words, short[1][at], np.uint32(SHORT))[back]


def _planes(values, n):
    """The lowest ``n`` bytes of each value, first all lowest ones, then all second ones, and so on."""
    return values.view(np.uint8).reshape(len(values), values.itemsize)[:, :n].T.tobytes()


def _values(raw, at, rows, n, kind):
    out = np.zeros((rows, np.dtype(kind).itemsize), dtype=np.uint8)
    out[:, :n] = np.frombuffer(raw, np.uint8, n * rows, at).reshape(n, rows).T
    return out.view(kind).ravel()


def _pack(columns, names, counts):
    """Columns of word hashes with their names, and counts, as compressed bytes."""
    if len(columns) == 1:
        order = np.argsort(names[0].astype(np.uint64) << np.uint64(44) | columns[0] >> np.uint64(20))
    else:
        order = np.argsort(functools.reduce(lambda key, name: key << np.uint64(20) | name, names[1:3], names[0].astype(np.uint64)))
    parts = []
    for column, name in zip(columns, names, strict=True):
        name = name[order]
        rest = column[order][name == SHORT]
        if len(columns) == 1:
            rest = np.diff(rest, prepend=np.uint64(0))
        parts += [_planes(name, 3), _planes(rest, 8)]
    counts = counts[order]
    parts += [np.minimum(counts, 255).astype(np.uint8).tobytes(), counts[counts >= 255].tobytes()]
    raw = b"".join(parts)
    return struct.pack("<iiq", len(columns), len(counts), len(raw)) + pa.Codec("zstd", 1).compress(raw, asbytes=True)


def _unpack(blobs, long_names):
    """Reverse of ``_pack`` for some of its results at once; ``long_names`` has the hash of each rank."""
    heads = [struct.unpack_from("<iiq", b) for b in blobs]
    total, width = sum(h[1] for h in heads), heads[0][0]
    columns, names = [np.empty(total, np.uint64) for _ in range(width)], [np.empty(total, np.uint32) for _ in range(width)]
    counts, begin = np.empty(total, np.int64), 0
    for blob, (width, n, size) in zip(blobs, heads, strict=True):
        raw = pa.Codec("zstd").decompress(memoryview(blob)[16:], size, asbytes=True)
        at, here = 0, slice(begin, begin + n)
        for column, named in zip(columns, names, strict=True):
            named[here] = name = _values(raw, at, n, 3, np.uint32)
            at += 3 * n
            apart = name == SHORT
            m = int(apart.sum())
            rest = _values(raw, at, m, 8, np.uint64)
            at += 8 * m
            if width == 1:
                rest = np.cumsum(rest, dtype=np.uint64)
            column[here][apart] = rest
            column[here][~apart] = long_names[name[~apart]]
        some = np.frombuffer(raw, np.uint8, n, at).astype(np.int64)
        some[some == 255] = np.frombuffer(raw, np.int64, int((some == 255).sum()), at + n)
        counts[here] = some
        begin += n
    return columns, names, counts


def _parcels(level, columns, names, counts, contexts, shards):
    """One row of packed n-grams for each shard that gets any."""
    home = _home(_spread(contexts), shards)
    # Numbers of two bytes are sorted in two passes.
    order = np.argsort(home.astype(np.uint16) if shards <= 1 << 16 else home, kind="stable")
    bounds = np.flatnonzero(np.diff(home[order], prepend=-1, append=shards))
    for low, high in zip(bounds[:-1], bounds[1:], strict=True):
        one = order[low:high]
        yield level, int(home[one[0]]), _pack([c[one] for c in columns], [x[one] for x in names], counts[one])


def _batches(rows):
    for level, shard, blob in rows:
        arrays = [pa.array([level], pa.int32()), pa.array([shard], pa.int32()), pa.array([blob], pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, schema=SCHEMA)


def _counted(order, shards, level, short):
    """The distinct n-grams of a task's texts, packed for the shards of ``level``."""

    def flushed(held):
        columns = [np.concatenate(held.pop(0)) for _ in range(2 * order)]
        names = columns[order:]
        del columns[order:]
        columns, names, counts, contexts, _ = _summed(columns, names)
        return _batches(_parcels(level, columns, names, counts, contexts, shards))

    def run(batches):
        held, n = [[] for _ in range(2 * order)], 0
        for batch in batches:
            for _, data, offsets in kernels.blocks(batch, limit=BLOCK >> 1):
                words, at, _ = _stream(data, offsets, order)
                names = _names(words, short.value)
                for i in range(order):
                    held[i].append(words[at - (order - 1) + i])
                    held[order + i].append(names[at - (order - 1) + i])
                n += len(at)
                if n >= FLUSH:
                    yield from flushed(held)
                    held, n = [[] for _ in range(2 * order)], 0
        if n:
            yield from flushed(held)

    return run


def _by_shard(batches, level):
    """``(shard, blobs)`` of the rows of ``level``, which come sorted by shard; ``(None, row)`` for others."""
    now, blobs = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if row["level"] != level:
                yield None, row
                continue
            if row["shard"] != now and blobs:
                yield now, blobs
                blobs = []
            now = row["shard"]
            blobs.append(row["packed"])
    if blobs:
        yield now, blobs


def _stored(folder, level, shards, short):
    """Write the arrays of each shard of ``level``; pass on its n-grams without their first word, and its totals."""

    def rows(batches):
        long_names = np.zeros(len(short.value[0]), dtype=np.uint64)
        long_names[short.value[1]] = short.value[0]
        for shard, blobs in _by_shard(batches, level):
            if shard is None:
                yield blobs["level"], blobs["shard"], blobs["packed"]
                continue
            columns, names, counts = _unpack(blobs, long_names)
            blobs.clear()
            columns, names, counts, contexts, keys = _summed(columns, names, counts)
            arrays = [hasharray.packed(keys, counts[:, None])]
            del keys
            if level > 1:
                del columns[0], names[0]
                order = np.argsort(contexts)
                ordered = contexts[order]
                at = _changes(ordered)
                keys, sums = ordered[at], np.empty((len(at), 4), dtype=np.int64)
                del contexts, ordered
                sums[:, 0] = np.add.reduceat(counts[order], at)
                for i, kind in enumerate((counts == 1, counts == 2, counts > 2), 1):
                    sums[:, i] = np.add.reduceat(kind[order], at, dtype=np.int64)
                del order, at
                arrays.append(hasharray.packed(keys, sums))
                del keys, sums
            hasharray.store(f"{folder}/{level}-{shard}", *arrays)
            del arrays
            few = np.bincount(np.minimum(counts, 5), minlength=5)[1:5]
            yield -1 - level, shard, np.array([counts.sum(), len(counts), *few], dtype=np.int64).tobytes()
            often = counts >= OFTEN
            if level == 0 and often.any():
                yield 0, shard, np.concatenate([columns[0][often], counts[often].astype(np.uint64)]).tobytes()
            elif level > 1:
                columns, names, counts, contexts, _ = _summed(columns, names)
                yield from _parcels(level - 1, columns, names, counts, contexts, shards)

    return lambda batches: _batches(rows(batches))


def _dealt(parcels, shards):
    """Rows by shard. A shard's rows meet in one task and come one shard after the other."""
    return parcels.repartition(-(-shards // 3), "shard").sortWithinPartitions("shard")


def _totals(rows: pa.Table, level) -> list[int]:
    """Over all shards of ``level``: the sum of counts, how many n-grams there are, and how many with 1, 2, 3, 4."""
    own = rows.filter(pa.compute.equal(rows["level"], -1 - level))["packed"].to_pylist()
    return np.frombuffer(b"".join(own), np.int64).reshape(-1, 6).sum(axis=0).tolist()


def _frequent(least):
    """The words that occur ``least`` times, of the packed ones that occur ``OFTEN`` times."""

    def run(batches):
        for batch in batches:
            for blob in batch.column("packed").to_pylist():
                words, counts = np.frombuffer(blob, np.int64).reshape(2, -1)
                yield pa.RecordBatch.from_arrays([pa.array(x[counts >= least]) for x in (words, counts)], names=["word", "n"])

    return run


def _discounts(few):
    """Modified Kneser-Ney discounts from how many n-grams occur 1, 2, 3 and 4 times; plain ones for tiny corpora."""
    n = [int(x) for x in few]
    if all(n):
        y = n[0] / (n[0] + 2 * n[1])
        found = tuple(i + 1 - (i + 2) * y * n[i + 1] / n[i] for i in range(3))
        if all(0 < d < i + 1 for i, d in enumerate(found)):
            return found
    return 0.5, 1.0, 1.5


def train(docs: DataFrame, order=3, text_col="text", shard_bytes=SHARD_BYTES) -> Model:
    """The model of the texts of ``docs``; null and empty texts count as one end token each. Other columns are ignored.

    Its arrays lie in a new folder under ``spark.checkpoint.dir``. Where the counts of counts are too few for modified
    discounts (one of them 0, or a discount out of bounds), an order takes 0.5, 1 and 1.5.
    """
    if order < 2:
        raise ValueError("the order is 2 or more")
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text") + 1).cast("long")).first()[0] or 0
    shards = -(-size // shard_bytes) or 1
    folder = f"{shared_folder(spark).rstrip('/')}/matchvault-lm-{uuid.uuid4().hex}"
    none = spark.sparkContext.broadcast((np.zeros(0, np.uint64), np.zeros(0, np.uint32)))
    found = _dealt(texts.mapInArrow(_counted(1, shards, 0, none), ROW), shards)
    found = written(found.mapInArrow(_stored(folder, 0, shards, none), ROW))
    tokens, words = _totals(found.where("level = -1").toArrow(), 0)[:2]
    often = found.where("level = 0").mapInArrow(_frequent(tokens >> 23), "word long, n long")
    often = often.orderBy(F.desc("n"), "word").limit(SHORT).toArrow()["word"].to_numpy().view(np.uint64)
    by_hash = np.argsort(often)
    short = spark.sparkContext.broadcast((often[by_hash], by_hash.astype(np.uint32)))
    found = texts.mapInArrow(_counted(order, shards, order, short), ROW)
    for level in range(order, 0, -1):
        found = _dealt(found, shards).mapInArrow(_stored(folder, level, shards, short), ROW)
    found = found.toArrow()
    sums = [_totals(found, level) for level in range(1, order + 1)]
    few = sums[0][2:]
    totals = (sums[0][0], few[0], few[1], sums[0][1] - few[0] - few[1])
    return Model(folder, order, shards, tokens, words, totals, tuple(_discounts(s[2:]) for s in sums))


def _arrays(model, level, shard, held):
    """The arrays of a shard of ``level``, or None; ``held`` keeps some."""
    at = level, shard
    if at not in held:
        if len(held) >= 256:
            held.clear()
        held[at] = hasharray.load(f"{model.folder}/{level}-{shard}", 1 if level < 2 else 2)
    return held[at]


def _distinct(model, columns):
    """``(one, back, keys, contexts, bounds)`` of n-grams given as one column for each word.

    ``one`` has a place of each distinct n-gram, shard after shard, equal contexts side by side, ``back`` for each place
    its number in ``one``; shard i begins at ``bounds[i]``. (An n-gram may be listed twice where 64 bits of others collide.)
    """
    contexts, keys = gram_keys(columns)
    spread = _spread(contexts)
    order = np.argsort(spread << np.uint64(32) | keys >> np.uint64(32))
    ordered = keys[order]
    at = _changes(ordered)
    back = np.empty(len(order), dtype=np.int64)
    back[order] = np.repeat(np.arange(len(at)), np.diff(at, append=len(order)))
    one = order[at]
    bounds = np.searchsorted(_home(spread[one], model.shards), np.arange(model.shards + 1))
    return one, back, ordered[at], contexts[one], bounds


def _looked_up(model, level, lost, keys, contexts, bounds, held):
    """``(counts, totals, left)``: what the arrays of ``level`` say of distinct n-grams, shard after shard; zeros of others.

    From level 2 on, ``totals`` are of the n-grams' contexts, and ``left`` what these lose by the discounts ``lost``.
    """
    counts, n = np.zeros(len(keys), dtype=np.int64), len(keys) if level > 1 else 0
    totals, left = np.zeros(n, dtype=np.int64), np.zeros(n)
    for shard in np.flatnonzero(np.diff(bounds)).tolist():
        arrays, here = _arrays(model, level, shard, held), slice(bounds[shard], bounds[shard + 1])
        if arrays:
            counts[here] = arrays[0].rows(keys[here])[:, 0]
            if level > 1:
                own = contexts[here]
                at = _changes(own)
                rows, times = arrays[1].rows(own[at]), np.diff(at, append=len(own))
                totals[here] = np.repeat(rows[:, 0], times)
                left[here] = np.repeat(rows[:, 1:] @ lost[1:], times)
    return counts, totals, left


def _likelihoods(model, words, at, grams, held):
    """The probability of the word at each of the places ``at``, given the words before it; ``grams``: the single words."""
    p = np.full(len(at), 1.0 / (model.words + 1))
    for level in range(1, model.order + 1):
        if level > 1:
            grams = _distinct(model, [words[at - (level - 1) + i] for i in range(level)])
        one, back, *where = grams
        # Equal n-grams have equal probabilities, so one place of each is reckoned.
        lower = p[one]
        del p, grams, one
        lost = np.array([0.0, *model.discounts[level - 1]])
        counts, totals, left = _looked_up(model, level, lost, *where, held)
        kept = np.maximum(counts - lost[np.minimum(counts, 3)], 0)
        if level == 1:
            total, *few = model.totals
            if total:
                lower = lower * (sum(lost[i + 1] * n for i, n in enumerate(few)) / total) + kept / total
        else:
            lower = np.where(totals > 0, (kept + left * lower) / np.maximum(totals, 1), lower)
        p = lower[back]
    return p


def _scored(model):
    schema = pa.schema([("row_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def run(batches):
        held = {}
        for batch in batches:
            for rows, data, offsets in kernels.blocks(batch, limit=BLOCK):
                words, at, first = _stream(data, offsets, model.order)
                grams = _distinct(model, [words[at]])
                _, back, *where = grams
                counts = _looked_up(model, 0, None, *where, held)[0]
                base = np.log10((counts + 0.5) / (model.tokens + 0.5 * (model.words + 1)))[back]
                score = np.log10(_likelihoods(model, words, at, grams, held))
                arrays = [np.diff(first, append=len(at))]
                arrays += [np.add.reduceat(x, first) for x in ((counts > 0).astype(np.int64)[back], base, score)]
                yield pa.RecordBatch.from_arrays([batch.column("row_id")[rows], *map(pa.array, arrays)], schema=schema)

    return run


def score(docs: DataFrame, model: Model, id_col="doc_id", text_col="text") -> DataFrame:
    """``(id, n_tokens, n_known, base_score, score)`` for every row: its tokens, the end token among them, how many of
    them stand in the training texts, and log10 probabilities of the text: by single words with 0.5 added to each count,
    and by the model. Perplexity is ``pow(10, -score / n_tokens)``.

    A null, empty or blank text is its end token. Rows that repeat or lack an id are returned as they come, other
    columns are ignored whatever their names. A text is scored whole, however long. With no training text every
    probability is one of one possible word.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("row_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    columns = "row_id long, n_tokens long, n_known long, base_score double, score double"
    return texts.mapInArrow(_scored(model), columns).withColumnRenamed("row_id", id_col)
