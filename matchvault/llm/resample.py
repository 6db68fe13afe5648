"""Quality selection by importance resampling.

Two generative models over hashed unigrams and bigrams: one of target text (a bounded sample of labelled good
documents), one of all raw text. A document's log weight is the mean over its n-grams of the log ratio of the two, times ``LENGTH``. With
Gumbel noise added, seeded by the row key, the top k are a sample without replacement in proportion to the weights.
k is the number of documents whose weight reaches the cut that best separates labelled good from bad ones. Target
documents are weighed without their own n-grams, so that they are no better known than others.
"""

from __future__ import annotations

from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchvault.llm import kernels
from matchvault.llm.store import set_aside, written

BUCKET_BITS = 17
LABELLED = 20_000  # labelled rows at most that the target model and the cut are fitted on
PRIOR = float(1 << BUCKET_BITS)  # weight of the raw model in the target's smoothing, in n-grams
LENGTH = 100  # n-grams to which a document's weight is brought, so that long texts are not judged by their length
SEED = 13

# Bytes by class: white space and control 0, letters, digits and bytes of longer characters 1, the rest 2.
CLASS = np.full(256, 2, np.uint8)
CLASS[:33] = 0
CLASS[128:] = 1
for _low, _high in ((48, 58), (65, 91), (97, 123)):
    CLASS[_low:_high] = 1


def hashed_ngrams(data, offsets):
    """``(buckets, owner)`` of all unigrams and bigrams; tokens are runs of one byte class, case kept."""
    kind = CLASS[data]
    edge = np.ones(len(data) + 1, bool)
    edge[1:-1] = kind[1:] != kind[:-1]
    edge[offsets] = True
    cuts = np.flatnonzero(edge)
    starts, ends = cuts[:-1], cuts[1:]
    some = kind[starts] > 0
    starts, ends = starts[some], ends[some]
    token = kernels.span_hash(kernels.prefix_hash(data), starts, ends)
    owner = np.searchsorted(offsets, starts, "right") - 1
    with np.errstate(over="ignore"):
        pair = kernels.mix(token[:-1] * np.uint64(kernels.BASE) + token[1:], 12)
    same = owner[1:] == owner[:-1]
    both = np.concatenate([token, pair[same]]) >> np.uint64(64 - BUCKET_BITS)
    return both.astype(np.int64), np.concatenate([owner, owner[:-1][same]])


def labelled_rows(labels: DataFrame, limit: int = LABELLED):
    """Up to ``limit`` labelled ids, in the order of a hash, with whether each is good, and whether clean as well.

    Rows that repeat an id count as its worst label; null labels and ids are left out.
    """
    worst = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.min("quality").alias("quality"), F.max(F.coalesce("toxic", F.lit(0))).alias("toxic")
    )
    rows = worst.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit).toArrow()
    ids = rows["doc_id"].to_numpy()
    order = np.argsort(ids)
    good = (rows["quality"].to_numpy() > 0)[order]
    return ids[order], good, good & (rows["toxic"].to_numpy() == 0)[order]


def _texts(docs):
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def _ids(batch):
    return np.asarray(batch.column("doc_id").cast(pa.int64()).fill_null(-(1 << 63)), dtype=np.int64)


class Model:
    """Raw shares and target counts per bucket; target documents are judged without their own counts."""

    def __init__(self, raw, target, target_ids, prior):
        total = raw.sum()
        self.share = raw / total if total else raw
        self.target, self.ids, self.prior = target, np.sort(target_ids), prior

    def ratio(self, bucket, own=0.0, size=0.0):
        """Log of target over raw probability; 0 for a bucket without raw counts, or without a target model."""
        share = self.share[bucket]
        rest = self.target.sum() - size
        if rest <= 0:
            return np.zeros(len(bucket))
        mixed = (np.maximum(self.target[bucket] - own, 0) + self.prior * share) / (rest + self.prior)
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(share > 0, np.log(mixed) - np.log(share), 0.0)

    def weights(self, ids, data, offsets):
        """``(n-grams, log weight)`` of each text of a block."""
        bucket, owner = hashed_ngrams(data, offsets)
        n = len(offsets) - 1
        weight = np.bincount(owner, weights=self.ratios[bucket], minlength=n)
        for t in np.flatnonzero(np.isin(ids, self.ids)):
            own, count = np.unique(bucket[owner == t], return_counts=True)
            weight[t] = (self.ratio(own, count, count.sum()) * count).sum()
        size = np.bincount(owner, minlength=n)
        return size, weight / np.maximum(size, 1) * LENGTH

    @cached_property
    def ratios(self):
        return self.ratio(np.arange(len(self.share)))


def models(docs: DataFrame, target_ids: np.ndarray, prior: float = PRIOR) -> Model:
    """Counts of the n-grams of every document, and of the target documents; the target model falls back on the raw."""
    targets = docs.sparkSession.sparkContext.broadcast(np.sort(target_ids))

    def run(batches):
        raw, target = np.zeros(1 << BUCKET_BITS, np.int64), np.zeros(1 << BUCKET_BITS, np.int64)
        for batch in batches:
            wanted = np.isin(_ids(batch), targets.value)
            for rows, data, offsets in kernels.blocks(batch):
                bucket, owner = hashed_ngrams(data, offsets)
                raw += np.bincount(bucket, minlength=len(raw))
                target += np.bincount(bucket[wanted[rows][owner]], minlength=len(raw))
        at = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at.astype(np.int32)), pa.array(raw[at]), pa.array(target[at])], names=["bucket", "raw", "target"]
        )

    counted = _texts(docs).mapInArrow(run, "bucket int, raw long, target long").groupBy("bucket")
    rows = counted.agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toArrow()
    raw, target = np.zeros(1 << BUCKET_BITS), np.zeros(1 << BUCKET_BITS)
    raw[rows["bucket"].to_numpy()], target[rows["bucket"].to_numpy()] = rows["raw"].to_numpy(), rows["target"].to_numpy()
    return Model(raw, target, target_ids, prior)


def weighted(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (with ``doc_id`` and ``text``) with n_grams, log_weight and key, the weight with Gumbel noise.

    A text without n-grams, or null, has log weight 0. The noise depends on the id, or on the text where that is null.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [f.name for f in docs.schema.fields if f.name not in ("n_grams", "log_weight", "key")]
    schema = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names]

    def run(batches):
        for batch in batches:
            ids = _ids(batch)
            for rows, data, offsets in kernels.blocks(batch):
                count, weight = shared.value.weights(ids[rows], data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c)[rows] for c in names), pa.array(count), pa.array(weight)],
                    names=[*names, "n_grams", "log_weight"],
                )

    out = docs.select(*names).mapInArrow(run, ", ".join([*schema, "n_grams long, log_weight double"]))
    noise = F.when(F.col("doc_id").isNull(), F.xxhash64(F.coalesce("text", F.lit("")))).otherwise(F.xxhash64("doc_id", F.lit(SEED)))
    uniform = (F.shiftrightunsigned(noise, 11) + 0.5) / float(1 << 53)
    return out.withColumn("key", F.col("log_weight") - F.log(-F.log(uniform)))


def best_cut(weights: np.ndarray, good: np.ndarray) -> float:
    """The least weight to keep: between classes where the mean of both classes' accuracy is largest."""
    if not good.any() or good.all():
        return -np.inf
    order = np.argsort(weights, kind="stable")
    weights, good = weights[order], good[order]
    bad_below = np.concatenate([[0], np.cumsum(~good)]) / (~good).sum()
    good_above = 1 - np.concatenate([[0], np.cumsum(good)]) / good.sum()
    score = bad_below + good_above
    # A cut between equal weights is none.
    score[1:-1][weights[1:] == weights[:-1]] = -1
    at = int(score.argmax())
    if at == 0:
        return -np.inf
    return float((weights[at - 1] + weights[at]) / 2) if at < len(weights) else float(np.nextafter(weights[-1], np.inf))


def kth_largest(values: DataFrame, k: int) -> float:
    """The k-th largest double in the column ``key``, exactly: counts per leading 16 bits, then within the hit bin."""
    if k < 1:
        return np.inf
    raw = F.expr("java_method('java.lang.Double', 'doubleToLongBits', key)").cast("long")
    bits = values.select(raw.alias("b")).select(
        F.when(F.col("b") < 0, F.bitwise_not("b").bitwiseOR(F.lit(0))).otherwise(
            F.col("b").bitwiseXOR(F.lit(-(1 << 63)))).alias("b")
    )
    top = 0
    for shift in (48, 32, 16, 0):
        part = bits if shift == 48 else bits.where(F.shiftrightunsigned("b", shift + 16) == top)
        bins = part.groupBy(F.shiftrightunsigned("b", shift).bitwiseAND(F.lit(0xFFFF)).alias("bin")).count().toArrow()
        for bin_, n in sorted(zip(bins["bin"].to_pylist(), bins["count"].to_pylist(), strict=True), reverse=True):
            if n >= k:
                top = top << 16 | bin_
                break
            k -= n
        else:
            return -np.inf
    pattern = np.uint64(top)
    pattern = pattern ^ np.uint64(1 << 63) if pattern >> np.uint64(63) else ~pattern
    return float(np.array([pattern]).view(np.float64)[0])


def fitted(docs: DataFrame, labels: DataFrame):
    """``(model, least_key)``: the model, and the key from which on a document is among the top k."""
    ids, good, clean = labelled_rows(labels)
    model = models(docs, ids[clean])
    weights = written(weighted(docs.select("doc_id", "text"), model).select("doc_id", "log_weight", "key"))
    wanted = docs.sparkSession.createDataFrame([(int(i), bool(g)) for i, g in zip(ids, good, strict=True)], "doc_id long, good boolean")
    rows = weights.join(F.broadcast(wanted), "doc_id").select("log_weight", "good").toArrow()
    cut = best_cut(rows["log_weight"].to_numpy(), rows["good"].to_numpy(zero_copy_only=False) if rows.num_rows else np.zeros(0, bool))
    k = weights.where(F.col("log_weight") >= F.lit(float(cut))).count()
    return model, kth_largest(weights, k)


def selected(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``resampled`` keeps, with all columns as they are, whatever their names."""
    docs, restored = set_aside(docs, "n_grams", "log_weight", "key", "kept")
    return restored(resampled(docs, labels).where("kept"))


def resampled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with n_grams, log_weight, key and ``kept``; rows that tie with the last of the top k are kept too.

    Without labels of both classes every row is kept.
    """
    model, least = fitted(docs, labels)
    return weighted(docs, model).withColumn("kept", F.col("key") >= F.lit(float(least)))
