import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from matchvault.llm import hasharray, kneser_ney
from matchvault.llm.queries import QUERIES
from tests.llm.conftest import SF, frame


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)})), None]


class Brute:
    """The model in dictionaries. None is the end token, 0 the mark before a text."""

    def __init__(self, texts, order):
        self.order, self.raw = order, Counter(w for t in texts for w in tokens(t))
        self.n, self.v = sum(self.raw.values()), len(self.raw)
        grams = Counter()
        for t in texts:
            words = [0] * (order - 1) + tokens(t)
            grams.update(tuple(words[i : i + order]) for i in range(len(words) - order + 1))
        self.levels, self.lost = {}, {}
        for level in range(order, 0, -1):
            few = Counter(grams.values())
            self.lost[level] = (0.5, 1.0, 1.5)
            if all(few[i] for i in (1, 2, 3, 4)):
                y = few[1] / (few[1] + 2 * few[2])
                lost = [i - (i + 1) * y * few[i + 1] / few[i] for i in (1, 2, 3)]
                if all(0 < x < i + 1 for i, x in enumerate(lost)):
                    self.lost[level] = lost
            after = defaultdict(list)
            for g, c in grams.items():
                after[g[:-1]].append(c)
            self.levels[level] = grams, {c: (sum(n), sum(map(self.less(level), n))) for c, n in after.items()}
            grams = Counter(g[1:] for g in grams)

    def less(self, level):
        return lambda c: self.lost[level][min(c, 3) - 1] if c else 0

    def p(self, context, word):
        level = len(context) + 1
        lower = self.p(context[1:], word) if context else 1 / (self.v + 1)
        grams, after = self.levels[level]
        if context not in after:
            return lower
        c, (total, left) = grams.get((*context, word), 0), after[context]
        return (max(c - self.less(level)(c), 0) + left * lower) / total

    def row(self, text):
        own = tokens(text)
        words = [0] * (self.order - 1) + own
        score = sum(math.log10(self.p(tuple(words[i : i + self.order - 1]), w)) for i, w in enumerate(own))
        base = sum(math.log10((self.raw[w] + 0.5) / (self.n + 0.5 * (self.v + 1))) for w in own)
        return len(own), sum(self.raw[w] > 0 for w in own), base, score


def close(got, expected):
    assert [r[:2] for r in got] == [r[:2] for r in expected]
    np.testing.assert_allclose([r[2:] for r in got], [r[2:] for r in expected], rtol=1e-9)


def test_query_agrees_with_dictionaries(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    out = [zlib.crc32(str(r.doc_id).encode()) % 5 == 1 for r in rows]
    model = Brute([r.text for r, o in zip(rows, out, strict=True) if not o], 3)
    frame = QUERIES["op11_kneser_ney_score"](spark, SF)
    assert frame.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    got = frame.orderBy("doc_id").collect()
    assert [(r.doc_id, r.held_out) for r in got] == [(r.doc_id, o) for r, o in zip(rows, out, strict=True)]
    assert {r.train_tokens for r in got} == {model.n}
    close([(r.n_tokens, r.n_known, r.base_score, r.score) for r in got], [model.row(r.text) for r in rows])
    unseen = [r for r in got if r.held_out]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)


@pytest.mark.parametrize(("order", "flush", "shard_bytes"), [(2, 1000, 3000), (3, 100, 20_000), (4, 5000, 1 << 24)])
def test_orders_shards_and_flushes(odd, odd_rows, order, flush, shard_bytes, monkeypatch):
    monkeypatch.setattr(kneser_ney, "FLUSH", flush)
    monkeypatch.setattr(kneser_ney, "BLOCK", 4000)
    model = kneser_ney.train(odd, order, shard_bytes=shard_bytes)
    brute = Brute([t for _, t in odd_rows], order)
    got = {r.doc_id: tuple(r)[1:] for r in kneser_ney.score(odd, model).collect()}
    close([got[i] for i, _ in odd_rows], [brute.row(t) for _, t in odd_rows])


def test_probabilities_of_all_words_sum_to_one(spark, odd_rows):
    texts = [t for _, t in odd_rows if t and len(t) < 2000]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    model = kneser_ney.train(docs, 2, shard_bytes=5000)
    words = sorted({w for t in texts for w in tokens(t) if w})
    assert model.words == len(words) + 1
    asked = [*words, "neverseen"]
    scored = {r.doc_id: r for r in kneser_ney.score(spark.createDataFrame([(i, w) for i, w in enumerate(asked)], "doc_id long, text string"), model).collect()}
    after = Brute(texts, 2)
    first = [after.p((0,), w) for w in [*words, None, "neverseen"]]
    assert math.isclose(sum(first), 1, rel_tol=1e-9)
    for i, w in enumerate(asked):
        assert math.isclose(scored[i].score, math.log10(after.p((0,), w)) + math.log10(after.p((w,), None)), rel_tol=1e-9)


def test_repeated_rows_clashing_names_and_empty_tables(spark, repeated, empty):
    names = ("row_id", "n_tokens", "score", "level", "shard", "packed")
    clash = repeated.withColumns({c: F.lit("x") for c in names})
    model = kneser_ney.train(clash)
    got = kneser_ney.score(clash, model)
    assert got.columns == ["doc_id", "n_tokens", "n_known", "base_score", "score"]
    plain = kneser_ney.score(repeated, kneser_ney.train(repeated))
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[4])
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, plain.collect()), key=key)
    assert got.count() == repeated.count() and kneser_ney.score(empty, model).count() == 0
    nothing = kneser_ney.score(repeated, kneser_ney.train(empty)).collect()
    assert {r.score for r in nothing} == {0.0} and {r.n_known for r in nothing} == {0}
    long = frame(spark, [(1, "a b c " * 400_000), (2, None)])
    rows = {r.doc_id: r for r in kneser_ney.score(long, model).collect()}
    assert rows[1].n_tokens == 1_200_001 and math.isfinite(rows[1].score)
    with pytest.raises(ValueError):
        kneser_ney.train(repeated, 1)


def test_hash_arrays(tmp_path):
    rng = np.random.default_rng(1)
    for n in (0, 1, 7, 5000, 300_000):
        keys = np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64))
        values = np.stack([rng.geometric(0.3, len(keys)), rng.geometric(0.02, len(keys)) ** 3], axis=1)
        hasharray.store(f"file://{tmp_path}/{n}", hasharray.packed(keys, values), hasharray.packed(keys[::2], values[::2, :1]))
        both, half = hasharray.load(f"file://{tmp_path}/{n}", 2)
        order = rng.permutation(len(keys))
        assert (both.rows(keys[order]) == values[order]).all()
        assert (half.rows(keys[::2])[:, 0] == values[::2, 0]).all() and not half.rows(keys[1::2]).any()
    assert hasharray.load(f"{tmp_path}/none", 1) is None


def test_arrays_of_rows_with_large_counts():
    rng = np.random.default_rng(2)
    keys = np.unique(rng.integers(0, 1 << 64, 5000, dtype=np.uint64))
    for width in (1, 2, 4):
        values = rng.geometric(0.5, (len(keys), width)) << rng.choice([0, 0, 0, 15, 16, 31, 40], (len(keys), width))
        array = hasharray.HashArray(hasharray.packed(keys, values))
        assert (array.rows(keys) == values).all() and not array.rows(~keys).any()


def test_each_distinct_gram_is_looked_up_once(spark, tmp_path, monkeypatch):
    text = "a b c d e f g h"
    model = kneser_ney.train(frame(spark, [(1, text), (2, "c d e x")]))
    asked, rows = [], hasharray.HashArray.rows
    monkeypatch.setattr(hasharray.HashArray, "rows", lambda self, keys: asked.append(len(keys)) or rows(self, keys))
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(1000)), pa.array([text] * 1000)], names=["row_id", "text"])
    (out,) = kneser_ney._scored(model)([batch])
    assert len(set(out["score"].to_pylist())) == 1
    # Eight words and the end: counts in the corpus and of three orders, and contexts of two orders.
    assert sum(asked) <= 6 * 9
