"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, made from its code point. A trigram of a word (with its borders) binds
three of them: the first permuted twice, the second once, multiplied. A text's profile is the sum of its trigrams'
vectors; a language's prototype is the sum over its training texts. Prediction takes the prototype with the largest
cosine. Sums are of whole numbers, so they do not depend on how rows are dealt out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchvault.llm import kernels

DIMENSIONS = 1024
LANGUAGES = 4096  # more distinct languages than this are refused: prototypes go to the driver and to every task
CELLS = 1 << 22  # of the text by trigram matrix that is multiplied at once


def letter_vectors(codes: np.ndarray) -> np.ndarray:
    """Rows of +1 and -1, one per code point; the border of words is code 0."""
    parts = DIMENSIONS // 64
    words = kernels.mix(codes.astype(np.uint64)[:, None] * np.uint64(parts) + np.arange(parts, dtype=np.uint64), 60)
    bits = np.unpackbits(words.astype("<u8").view(np.uint8), axis=1)
    return (bits.astype(np.int8) * 2 - 1).astype(np.int8)


def trigrams(data, offsets):
    """``(vectors, index, owner)``: the distinct trigrams' vectors, each trigram's row among them, and its text."""
    codes = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    place = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    if len(codes) != place[-1]:
        raise ValueError("text is not UTF-8")
    there = np.unique(codes)
    letters = np.array([c for c in there if chr(c).isalpha()], dtype=np.int64)
    known = np.zeros(int(there[-1]) + 1 if len(there) else 1, np.int64)
    known[letters] = np.arange(1, len(letters) + 1)
    symbol = np.concatenate([[0], np.insert(known[codes], place[1:-1], 0), [0]])
    owner = np.concatenate([[0], np.insert(np.repeat(np.arange(len(place) - 1), np.diff(place)), place[1:-1], 0), [0]])
    at = np.flatnonzero(symbol)
    size = len(letters) + 1
    code = (symbol[at - 1] * size + symbol[at]) * size + symbol[at + 1]
    if size**3 <= 1 << 22:
        used = np.flatnonzero(np.bincount(code, minlength=1))
        rank = np.zeros(size**3, np.int64)
        rank[used] = np.arange(len(used))
        index = rank[code]
    else:
        used, index = np.unique(code, return_inverse=True)
    vectors = letter_vectors(np.concatenate([[0], letters]))
    first, second = np.roll(vectors, 2, axis=1), np.roll(vectors, 1, axis=1)
    bound = first[used // (size * size)] * second[used // size % size] * vectors[used % size]
    return bound, index, owner[at]


def _trained(batches):
    sums = {}
    for batch in batches:
        langs = batch.column("lang")
        for rows, data, offsets in kernels.blocks(batch):
            names, label = np.unique(np.array(langs[rows].to_pylist(), dtype=object).astype(str), return_inverse=True)
            bound, index, owner = trigrams(data, offsets)
            if not len(index):
                continue
            counts = np.bincount(label[owner] * len(bound) + index, minlength=len(names) * len(bound))
            # Counts of a block stay far below 2^53, so the product is exact.
            profile = counts.reshape(len(names), -1).astype(np.float64) @ bound.astype(np.float64)
            for name, row in zip(names, profile, strict=True):
                sums[name] = sums.get(name, 0) + row.astype(np.int64)
    for name, row in sums.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * DIMENSIONS), pa.array(np.arange(DIMENSIONS, dtype=np.int32)), pa.array(row)],
            names=["lang", "at", "value"],
        )


def prototypes(texts: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages in ascending order and their summed profiles, from ``texts(text, lang)`` without null languages."""
    texts = texts.select(F.lower(F.coalesce("text", F.lit(""))).alias("text"), "lang")
    if texts.select("lang").distinct().limit(LANGUAGES + 1).count() > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    summed = texts.mapInArrow(_trained, "lang string, at int, value long").groupBy("lang", "at").agg(F.sum("value").alias("value"))
    rows = summed.toArrow()
    langs, which = np.unique(np.array(rows["lang"].to_pylist(), dtype=object).astype(str), return_inverse=True)
    out = np.zeros((len(langs), DIMENSIONS))
    out[which, rows["at"].to_numpy()] = rows["value"].to_numpy()
    return [str(x) for x in langs], out


def predict_language(docs: DataFrame, langs: list[str], profiles: np.ndarray) -> DataFrame:
    """``docs`` (any columns with ``text``) less the text, with lang_pred and score.

    ``score`` is the cosine, at least 0. A null text, one without letters, or no trained language gives ``und`` and 0;
    of equal cosines the first language in order wins.
    """
    keep = [f for f in docs.schema.fields if f.name not in ("text", "lang_pred", "score")]
    size = np.linalg.norm(profiles, axis=1, keepdims=True)
    unit = np.divide(profiles, size, out=np.zeros_like(profiles), where=size > 0).astype(np.float32)
    model = docs.sparkSession.sparkContext.broadcast((langs, unit))

    def run(batches):
        langs, unit = model.value
        names = pa.array([*langs, "und"])
        for batch in batches:
            for rows, data, offsets in kernels.blocks(batch):
                n = len(offsets) - 1
                best, score = np.full(n, len(langs)), np.zeros(n)
                bound, index, owner = trigrams(data, offsets)
                if len(index) and len(langs):
                    bound = bound.astype(np.float32)
                    step = max(1, CELLS // len(bound))
                    edges = np.searchsorted(owner, np.arange(0, n + step, step))
                    for i, low in enumerate(range(0, n, step)):
                        part = slice(edges[i], edges[i + 1])
                        texts = min(step, n - low)
                        counts = np.bincount((owner[part] - low) * len(bound) + index[part], minlength=texts * len(bound))
                        profile = counts.reshape(texts, -1).astype(np.float32) @ bound
                        length = np.linalg.norm(profile, axis=1)
                        cosine = profile @ unit.T / np.maximum(length, 1e-30)[:, None]
                        some = np.flatnonzero(counts.reshape(texts, -1).any(axis=1))
                        best[low + some] = cosine[some].argmax(axis=1)
                        score[low + some] = np.clip(cosine[some].max(axis=1), 0, 1)
                columns = [batch.column(f.name)[rows] for f in keep]
                yield pa.RecordBatch.from_arrays(
                    [*columns, names.take(pa.array(best)), pa.array(score.astype(np.float64))],
                    names=[*(f.name for f in keep), "lang_pred", "score"],
                )

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in keep), "lang_pred string, score double"])
    lowered = docs.withColumn("text", F.lower(F.coalesce("text", F.lit(""))))
    return lowered.select(*(f.name for f in keep), "text").mapInArrow(run, schema)
