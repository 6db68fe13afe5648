"""Benchmark passages in training text: a BM25 index of test items, searched with block-max WAND.

Every passage of every text is a query. Impacts are divided by the item's own score, so that a score is the share of
an item's BM25 mass that the passage holds, and one threshold suits items of any length. A passage whose terms' upper
bounds (with one bound for all common terms together) stay below the threshold is passed over; the others are
searched exactly. Hits are verified: enough
of the item's question and of its answer, or of an item without that border as a whole, must be near: by its 3-grams,
or by words in the same order inside a span of about its own length, which edited words do not break.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchvault.llm import kernels
from matchvault.llm.store import unused, written

K1, B = 1.2, 0.75
POSTINGS_PER_BLOCK = 64
RANGE = 8  # neighbouring items that share a bound when passages are passed over
ITEMS = 20_000  # test items per pass over the texts, in one index for each length class; more items, more passes
SHORT = 64  # words; items up to so many form one length class, then each class reaches twice as far
GRAM = 3
PUNCTUATION = np.ones(256, bool)
PUNCTUATION[128:] = False
for _low, _high in ((48, 58), (65, 91), (97, 123)):
    PUNCTUATION[_low:_high] = False


def _terms(data, offsets):
    starts, ends, first = kernels.words(data, offsets, PUNCTUATION)
    return kernels.span_hash(kernels.prefix_hash(data), starts, ends), first


def _grams(term, width):
    """Hashes of all runs of ``width`` terms."""
    if len(term) < width:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(term) - width + 1, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(width):
            out = out * np.uint64(kernels.BASE) + term[i : len(out) + i]
    return kernels.mix(out, 80 + width)


def _in_order(part, impact, weight, term):
    """Share of the ``weight`` of the words of ``part`` that stand in the same order in its own span of the terms.

    The span is as long as the part and half as much again, and lies where most impact falls on neighbouring diagonals.
    """
    n = len(part)
    spread = max(2, n // 2)
    diagonal = np.zeros(len(term) + n + spread)
    where = [np.flatnonzero(term == t) for t in part]
    for i, at in enumerate(where):
        diagonal[at - i + n] += impact[i]
    sums = np.cumsum(np.append(0.0, diagonal))
    low = int(np.argmax(sums[spread + 1 :] - sums[: -spread - 1])) - n
    high = min(low + n + spread, len(term))
    low = max(low, 0)
    best = np.zeros(high - low + 1)
    for at, w in zip(where, weight, strict=True):
        at = at[(at >= low) & (at < high)] - low
        if len(at):
            step = best.copy()
            step[at + 1] = np.maximum(step[at + 1], best[at] + w)
            best = np.maximum.accumulate(step)
    return float(best[-1] / weight.sum())


def _lowered(df, id_col, text):
    return df.select(F.col(id_col).alias("id"), F.lower(F.coalesce(text, F.lit(""))).alias("text"))


def _item_terms(batches):
    for batch in batches:
        for rows, data, offsets in kernels.blocks(batch):
            term, first = _terms(data, offsets)
            n = np.diff(first)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id")[rows].take(pa.array(np.repeat(np.arange(len(n)), n))),
                 pa.array(np.arange(len(term)) - np.repeat(first[:-1], n)), pa.array(kernels.signed(term))],
                names=["id", "at", "term"],
            )


def impacts(benchmark: DataFrame) -> DataFrame:
    """``(id, n, split, terms, postings)`` per test item of ``benchmark(item_id, text)`` that has a word.

    ``terms`` are its words in order, hashed; the first ``split`` are the question: up to the last question mark
    with a word behind it, else all. ``postings`` has each distinct term with its impact: BM25 over the
    item's own score. Document frequencies and lengths are of all items. Items of one id count as one each.
    """
    keyed = benchmark.withColumn("id", F.struct(F.col("item_id").cast("long").alias("item_id"), F.xxhash64("text").alias("h")))
    keyed = keyed.dropDuplicates(["id"])
    asked = F.regexp_extract("text", r"(?s)^(.*\?).*[\p{L}\p{N}]", 1)
    words = _lowered(keyed, "id", F.col("text")).mapInArrow(_item_terms, "id struct<item_id:long,h:long>, at long, term long")
    words = written(words)
    questions = _lowered(keyed, "id", asked).mapInArrow(_item_terms, "id struct<item_id:long,h:long>, at long, term long")
    questions = questions.groupBy("id").agg(F.count("*").alias("asked"))
    lengths = words.groupBy("id").agg(F.count("*").alias("n"))
    total = lengths.agg(F.count("*").alias("items"), F.avg("n").alias("mean")).first()
    items, mean = F.lit(total["items"]), F.lit(total["mean"] or 1.0)
    tf = words.groupBy("id", "term").agg(F.count("*").alias("tf"))
    df = tf.groupBy("term").agg(F.count("*").alias("df"))
    scored = tf.join(df, "term").join(lengths, "id")
    idf = F.log(1 + (items - F.col("df") + 0.5) / (F.col("df") + 0.5))
    score = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("n") / mean))
    scored = scored.withColumn("score", score)
    scored = scored.withColumn("impact", F.col("score") / F.sum("score").over(Window.partitionBy("id")))
    postings = scored.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("term", "impact"))).alias("postings"))
    ordered = words.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "term"))), lambda x: x["term"]).alias("terms"))
    out = ordered.join(postings, "id").join(lengths, "id").join(questions, "id", "left")
    return out.select("id.item_id", "n", F.coalesce("asked", "n").cast("int").alias("split"), "terms", "postings")


class Index:
    """Inverted lists in blocks, with the largest impact of each list and block, and the items' grams.

    Passages are two steps long and begin at every step. A step is the longest item and a quarter more, so that every
    copy lies whole in some passage wherever it stands, also with some words inserted.
    """

    def __init__(self, rows, threshold):
        self.threshold = threshold
        self.items = [r["item_id"] for r in rows]
        longest = max([SHORT, *(r["n"] for r in rows)])
        self.step = longest + longest // 4
        lists = {}
        for i, r in enumerate(rows):
            for p in r["postings"]:
                lists.setdefault(p["term"], []).append((i, p["impact"]))
        self.terms = np.array(sorted(t % (1 << 64) for t in lists), dtype=np.uint64)
        self.lists = []
        for t in kernels.signed(self.terms).tolist():
            items = np.array([i for i, _ in lists[t]], dtype=np.int64)
            impact = np.array([x for _, x in lists[t]])
            ends = np.append(np.arange(POSTINGS_PER_BLOCK - 1, len(items) - 1, POSTINGS_PER_BLOCK), len(items) - 1)
            most = np.maximum.reduceat(impact, np.arange(0, len(items), POSTINGS_PER_BLOCK))
            self.lists.append((items, impact, items[ends], most))
        self.bound = np.array([x[1].max() for x in self.lists])
        self.ranges = []
        for items, impact, _, _ in self.lists:
            at = np.flatnonzero(np.diff(items // RANGE, prepend=-1))
            self.ranges.append((items[at] // RANGE, np.maximum.reduceat(impact, at)))
        # Common terms, most frequent first, while no item gets half the threshold from them alone: a passage needs
        # the rest from other terms, so its bound is that of its other terms and the most that common ones give.
        common, mass = np.zeros(len(self.lists), bool), np.zeros(len(rows))
        for t in sorted(range(len(self.lists)), key=lambda t: (-len(self.lists[t][0]), t)):
            items, impact = self.lists[t][:2]
            if (mass[items] + impact).max() <= threshold / 2:
                mass[items] += impact
                common[t] = True
        self.slack = float(mass.max()) if len(mass) else 0.0
        self.rare_bound = np.where(common, 0.0, self.bound)
        self.filter = np.zeros(1 << 20, bool)
        self.filter[(self.terms >> np.uint64(44)).astype(np.int64)] = True
        self.parts = []
        for r in rows:
            terms = np.array(r["terms"], dtype=np.int64).view(np.uint64)
            mass = {p["term"]: p["impact"] for p in r["postings"]}
            _, back, times = np.unique(terms, return_inverse=True, return_counts=True)
            impact = np.array([mass[t] for t in r["terms"]]) / times[back]
            cut = r["split"]
            # Of a question or an answer alone, common words say little: words count by their impact.
            pieces = [(terms[:cut], impact[:cut], impact[:cut]), (terms[cut:], impact[cut:], impact[cut:])]
            if cut == r["n"]:
                pieces = [(terms, impact, np.ones(len(terms)))]
            self.parts.append([(*x, np.unique(_grams(x[0], min(GRAM, len(x[0]))))) for x in pieces])

    def lookup(self, term):
        """The list of each term, or -1."""
        out = np.full(len(term), -1)
        some = np.flatnonzero(self.filter[(term >> np.uint64(44)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.terms, term[some]), len(self.terms) - 1)
        hit = self.terms[at] == term[some]
        out[some[hit]] = at[hit]
        return out

    def within_reach(self, wanted):
        """Whether some range of items could reach the threshold from the lists ``wanted``, and then some item does."""
        place = np.concatenate([self.ranges[t][0] for t in wanted])
        most = np.concatenate([self.ranges[t][1] for t in wanted])
        if np.bincount(place, weights=most).max() < self.threshold - 1e-9:
            return False
        items = np.concatenate([self.lists[t][0] for t in wanted])
        impact = np.concatenate([self.lists[t][1] for t in wanted])
        return np.bincount(items, weights=impact).max() >= self.threshold - 1e-9

    def search(self, wanted):
        """``(item, score)`` of every item whose impacts over the lists ``wanted`` add up to the threshold.

        Block-max WAND: the pivot is the first list at which the bounds of the lists before it reach the threshold.
        """
        threshold = self.threshold
        lists = [self.lists[t] for t in wanted]
        bound = [float(self.bound[t]) for t in wanted]
        at = [0] * len(lists)
        found = []
        alive = list(range(len(lists)))
        while alive:
            alive.sort(key=lambda i: lists[i][0][at[i]])
            total, pivot = 0.0, -1
            for j, i in enumerate(alive):
                total += bound[i]
                if total >= threshold:
                    pivot = j
                    break
            if pivot < 0:
                break
            item = lists[alive[pivot]][0][at[alive[pivot]]]
            while pivot + 1 < len(alive) and lists[alive[pivot + 1]][0][at[alive[pivot + 1]]] == item:
                pivot += 1
            head = alive[: pivot + 1]
            blocks = [int(np.searchsorted(lists[i][2], item)) for i in head]
            inside = [(i, b) for i, b in zip(head, blocks, strict=True) if b < len(lists[i][2])]
            if sum(lists[i][3][b] for i, b in inside) >= threshold:
                if lists[alive[0]][0][at[alive[0]]] == item:
                    score = float(sum(lists[i][1][at[i]] for i in head))
                    if score >= threshold:
                        found.append((int(item), score))
                    goal = item + 1
                else:
                    goal = item
            else:
                goal = min((int(lists[i][2][b]) for i, b in inside), default=int(item)) + 1
                if pivot + 1 < len(alive):
                    goal = min(goal, int(lists[alive[pivot + 1]][0][at[alive[pivot + 1]]]))
                goal = max(goal, int(item) + 1)
            for i in head:
                at[i] += int(np.searchsorted(lists[i][0][at[i] :], goal))
            alive = [i for i in alive if at[i] < len(lists[i][0])]
        return found

    def passages(self, term, first):
        """``(text, item, score, low, high)``: passages of a block that reach the threshold, as ranges of terms."""
        step = self.step
        n = np.diff(first)
        halves = -(-n // step)
        half_of = np.concatenate([[0], np.cumsum(halves)])
        text = np.repeat(np.arange(len(n)), n)
        half = half_of[text] + (np.arange(len(term)) - first[text]) // step
        which = self.lookup(term)
        some = np.flatnonzero(np.append(self.rare_bound, 0)[which] > 0)
        pairs = np.unique(half[some] * len(self.terms) + which[some])
        bound = np.bincount(pairs // len(self.terms), weights=self.rare_bound[pairs % len(self.terms)], minlength=half_of[-1] + 1)
        owner = np.repeat(np.arange(len(n)), halves)
        # A passage is two halves; the last half of a text is one alone.
        after = np.append(owner[1:] == owner[:-1], False) if len(owner) else np.zeros(0, bool)
        both = bound[: len(owner)] + np.where(after, bound[1 : len(owner) + 1], 0)
        for h in np.flatnonzero(both + self.slack >= self.threshold - 1e-9):
            t = owner[h]
            low = first[t] + (h - half_of[t]) * step
            high = min(low + 2 * step, first[t + 1])
            wanted = np.unique(which[low:high])
            wanted = wanted[wanted >= 0]
            wanted = wanted.tolist()
            for item, score in self.search(wanted) if wanted and self.within_reach(wanted) else ():
                yield int(t), item, score, low, high

    def overlap(self, item, term):
        """Shares of the item's question and answer that occur among the terms; twice that of an item without both."""
        shares = []
        for part, impact, weight, grams in self.parts[item]:
            share = float(np.isin(grams, _grams(term, min(GRAM, len(part)))).mean())
            shares.append(max(share, _in_order(part, impact, weight, term)))
        return shares[0], shares[-1]


def _classes(rows, threshold):
    """One index for each length class of the items."""
    classes = {}
    for r in rows:
        classes.setdefault(max(r["n"] - 1, SHORT - 1).bit_length(), []).append(r)
    return [Index(classes[c], threshold) for c in sorted(classes)]


def indexes(benchmark: DataFrame, threshold: float) -> list[Index]:
    """Indexes of items of one length class, of at most about ``ITEMS`` each; an item's postings are in one only."""
    return [index for some in _passes(benchmark, threshold) for index in some]


def _passes(benchmark, threshold):
    """The indexes that are searched in one pass over the texts, for each pass."""
    rows = impacts(benchmark)
    parts = max(1, -(-rows.count() // ITEMS))
    if parts == 1:
        found = rows.orderBy("item_id").collect()
        return [_classes(found, threshold)] if found else []
    rows = written(rows.withColumn("part", F.pmod(F.hash("terms"), F.lit(parts))))
    return [_classes(rows.where(F.col("part") == p).orderBy("item_id").collect(), threshold) for p in range(parts)]


def _hits(some, overlap, data, offsets):
    """``{(text, index, item): (score, question, answer)}`` of a block."""
    best = {}
    term, first = _terms(data, offsets)
    for i, index in enumerate(some):
        for t, item, score, low, high in index.passages(term, first):
            question, answer = index.overlap(item, term[low:high])
            if question >= overlap and answer >= overlap:
                best[t, i, item] = max(best.get((t, i, item), (0.0,)), (score, question, answer))
    return best


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold=0.6, overlap=0.6) -> DataFrame:
    """``(doc_id, item_id, score, question_overlap, answer_overlap)``: test items found in ``docs(doc_id, text)``.

    One row per row of ``docs`` and item, with the best passage's scores. Null and empty texts, and items without
    words, give none. Items are searched by length class, in passages of two steps (see ``Index``). Words are compared
    in lower case, without punctuation.
    """
    spark = docs.sparkSession
    texts = _lowered(docs, "doc_id", F.col("text"))
    out = None
    schema = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"
    for some in _passes(benchmark, threshold):
        shared = spark.sparkContext.broadcast(some)

        def run(batches, shared=shared):
            for batch in batches:
                for rows, data, offsets in kernels.blocks(batch):
                    best = _hits(shared.value, overlap, data, offsets)
                    if best:
                        ids = batch.column("id")[rows].take(pa.array([t for t, _, _ in best]))
                        items = pa.array([shared.value[i].items[item] for _, i, item in best], pa.int64())
                        scores = [pa.array(c, pa.float64()) for c in zip(*best.values(), strict=True)]
                        yield pa.RecordBatch.from_arrays(
                            [ids.cast(pa.int64()), items, *scores],
                            names=["doc_id", "item_id", "score", "question_overlap", "answer_overlap"],
                        )

        part = texts.mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], schema) if out is None else out


def without_contaminated(docs: DataFrame, benchmark: DataFrame, threshold=0.6, overlap=0.6) -> DataFrame:
    """``docs`` less the rows that hold a test item; nothing is shuffled.

    Null and empty texts hold none. Rows that repeat or lack an id are judged each by its text, and all columns come
    back as they are, whatever their names.
    """
    names, lowered = docs.columns, unused(docs.columns, "text_lower")
    for some in _passes(benchmark, threshold):
        shared = docs.sparkSession.sparkContext.broadcast(some)

        def run(batches, shared=shared):
            for batch in batches:
                for rows, data, offsets in kernels.blocks(batch, lowered):
                    keep = np.ones(len(offsets) - 1, bool)
                    keep[[t for t, _, _ in _hits(shared.value, overlap, data, offsets)]] = False
                    part = batch.slice(rows.start, rows.stop - rows.start).filter(pa.array(keep))
                    yield part.select(names)

        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
        docs = docs.withColumn(lowered, F.lower(F.coalesce("text", F.lit("")))).mapInArrow(run, schema)
    return docs
