import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from matchvault.llm import spelling
from matchvault.llm.queries import QUERIES
from tests.llm.conftest import SF, frame


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def brute(rows, shortest=6, at_least=5, times=5, one_in=199):
    """Per word ``(word, form, root, n, n_near, form_n)``, all pairs of words compared."""
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{doc}:{run}".encode())
            if doc is not None and h % one_in == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= shortest and c >= at_least}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= times * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return sorted(out)


def found(docs, **kw):
    words = spelling.word_counts(spelling.damaged(spelling.letter_runs(docs), 199), **kw)
    return sorted(map(tuple, spelling.spelling_forms(words).collect()))


def test_query_agrees_with_all_pairs(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op13_spelling_variants"](spark, SF)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    expected = brute(rows)
    assert sorted(map(tuple, got.collect())) == expected and any(r[1] for r in expected)


def test_every_kind_of_edit_at_every_place(spark):
    base = ["abcdef", "hijklmn", "äöüßéèabc"]
    words = set(base)
    for w in base:
        for i in range(len(w) + 1):
            words |= {w[:i] + "z" + w[i:], w[:i] + w[i + 1 :], w[:i] + "y" + w[i + 1 :]}
    words = sorted(w for w in words if len(w) >= 2)
    got = {(r.a, r.b) for r in spelling.near_words(spark.createDataFrame([(w,) for w in words], "word string")).collect()}
    expected = {frozenset((a, b)) for a in words for b in words if one_edit(a, b)}
    assert {frozenset(p) for p in got} == expected and len(got) == len(expected)


def test_chains_ties_and_thresholds(spark):
    rows = [("abcdef", 1000), ("abcdeg", 200), ("abcdehg", 40), ("abcdeh", 8), ("xbcdef", 1000), ("xbcdeff", 201), ("lonely", 5)]
    got = {r.word: tuple(r) for r in spelling.spelling_forms(spark.createDataFrame(rows, "word string, n long")).collect()}
    assert got["abcdehg"][:3] == ("abcdehg", "abcdeg", "abcdef")
    # The nearest by n is abcdef, more frequent than abcdeg.
    assert got["abcdeh"][:3] == ("abcdeh", "abcdef", "abcdef") and got["abcdeh"][5] == 1000
    assert got["xbcdeff"][:3] == ("xbcdeff", None, "xbcdeff") and got["xbcdeff"][4] == 1
    assert got["lonely"] == ("lonely", None, "lonely", 5, 0, None)


def test_long_chains_reach_their_root(spark):
    words = ["a" * 6 + "b" * i for i in range(12)]
    rows = [(w, 5 ** (12 - i)) for i, w in enumerate(words)]
    got = spelling.spelling_forms(spark.createDataFrame(rows, "word string, n long")).collect()
    assert {r.root for r in got} == {"aaaaaa"} and {r.form for r in got} == {None, *words[:-1]}


def test_odd_rows_and_clashing_names(spark, odd, odd_rows, repeated, empty):
    assert found(odd, shortest=2, at_least=1) == brute(odd_rows, shortest=2, at_least=1)
    rows = [tuple(r) for r in repeated.select("doc_id", "text").collect()]
    assert found(repeated, shortest=2, at_least=2) == brute(rows, shortest=2, at_least=2)
    clash = repeated.withColumns({c: F.lit("x") for c in ("id", "run", "word", "form", "size", "gram")})
    assert found(clash, shortest=2, at_least=2) == brute(rows, shortest=2, at_least=2)
    assert found(empty) == []
    long = frame(spark, [(1, "Letters " * 300_000), (2, "lettörs " * 9)])
    n = dict((w, c) for w, _, _, c, _, _ in found(long))
    assert sorted(n.values()) == [9, 300_000]


def test_a_factor_below_two_is_refused(spark):
    with pytest.raises(ValueError):
        spelling.spelling_forms(spark.createDataFrame([("abcdef", 5)], "word string, n long"), times=1)
