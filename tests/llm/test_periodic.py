import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchvault.llm import periodic
from matchvault.llm.queries import QUERIES
from tests.llm.conftest import SF, frame


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_runs(words, least=6, times=4):
    """Every (start, length, period), by trying each period at each place."""
    n, best = len(words), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, times * q):
                best.setdefault((i, length), q)
            i = max(j, i) + 1
    return sorted(((i, length, q) for (i, length), q in best.items()), key=lambda r: (r[0], r[2]))


def looped(doc, words):
    if doc is None or not words:
        return words
    h = zlib.crc32(str(doc).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def collapsed(words, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def contract(doc, text):
    words = looped(doc, split(text))
    runs = brute_runs(words)
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    listed = "".join("%d,%d,%d\n" % r for r in runs)
    return (doc, len(runs), *top, None if top[0] is None else 1000 * top[1] // top[2],
            *(hashlib.sha256(x.encode()).hexdigest() for x in (listed, collapsed(words, runs))))


def found(docs, **kw):
    return [(r[0], r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic.collapse_runs(docs, **kw).collect()]


def test_query_agrees_with_every_period_tried(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op12_periodic_runs"](spark, SF)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    expected = sorted(contract(*r) for r in rows)
    assert sorted(map(tuple, got.collect())) == expected and sum(r[1] > 0 for r in expected) >= 15


@pytest.mark.parametrize(("letters", "least", "times"), [(1, 6, 4), (2, 6, 4), (2, 2, 2), (3, 4, 2), (2, 5, 3), (4, 3, 3)])
def test_random_words_of_small_alphabets(letters, least, times):
    rng = random.Random(letters * 100 + least)
    texts = [[rng.randrange(letters) for _ in range(rng.randint(0, 70))] for _ in range(150)]
    for t in texts[::5]:  # a loop in the middle
        t[10:10] = t[:3] * rng.randint(1, 9)
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    token = np.array([w for t in texts for w in t], dtype=np.uint64)
    text, start, length, period = periodic.block_runs(token, first, least, times)
    got = sorted(zip(text.tolist(), start.tolist(), length.tolist(), period.tolist(), strict=True))
    assert got == sorted((i, *r) for i, t in enumerate(texts) for r in brute_runs(t, least, times))


def test_odd_rows_and_clashing_names(spark, odd, odd_rows, repeated, empty):
    extra = [(900, "a b a b a b a b c c c c c c x"), (901, "so " * 6), (902, "so " * 5), (903, "é ü é ü é ü é ü"), (904, "A a A a A a A a")]
    def expected(rows):
        return [(i, len(split(t)), brute_runs(split(t)), collapsed(split(t), brute_runs(split(t)))) for i, t in rows]

    short = [r for r in odd_rows if len(r[1] or "") < 20_000] + extra
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(found(frame(spark, short)), key=key) == sorted(expected(short), key=key)
    rows = [tuple(r) for r in repeated.select("doc_id", "text").collect() if len(r[1] or "") < 20_000]
    clash = frame(spark, rows).withColumns({c: F.lit("x") for c in ("row_id", "runs", "collapsed", "n_words", "words", "g", "a", "p")})
    assert sorted(found(clash), key=key) == sorted(expected(rows), key=key)
    assert found(empty) == [] and periodic.looped(empty).count() == 0
    again = {(r.doc_id, tuple(split(r.text))) for r in periodic.looped(clash).collect()}
    assert again == {(i, tuple(looped(i, split(t)))) for i, t in rows}
    with pytest.raises(ValueError):
        periodic.collapse_runs(empty, times=1)


def test_long_texts_take_time_in_proportion(spark):
    def seconds(n):
        loop = [f"w{i}" for i in range(97)]
        first = np.array([0, n, 2 * n])
        token = np.array([hash(w) & (2**63 - 1) for w in (loop * (n // 97 + 1))[:n] + ["so"] * n], dtype=np.uint64)
        began = time.process_time()
        text, start, length, period = periodic.block_runs(token, first, 6, 4)
        assert list(zip(text, start, length, period, strict=True)) == [(0, 0, n, 97), (1, 0, n, 1)]
        return time.process_time() - began

    seconds(2000)
    assert seconds(160_000) < 60 * max(seconds(8_000), 0.02)
