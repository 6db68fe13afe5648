import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from matchvault.llm import chunks, jaccard, simhash, suffixes
from matchvault.llm.components import components
from tests.llm import brute


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 20)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 120), 100), 200: 200, 201: 200}


@pytest.mark.parametrize("hot", [jaccard.HOT, 0])
def test_jaccard_groups_agree_with_all_pairs(odd, odd_rows, hot, monkeypatch):
    """On both paths of the postings: 0 makes every token a hot one."""
    monkeypatch.setattr(jaccard, "HOT", hot)
    got = jaccard.jaccard_groups(odd).drop("version").collect()
    assert sorted(map(tuple, got)) == sorted(brute.jaccard_components(odd_rows))


def test_jaccard_groups_without_the_first_step(odd, odd_rows, monkeypatch):
    """Links come from the prefix join alone when nothing is hung on heads before."""
    monkeypatch.setattr(jaccard, "head_pairs", lambda nodes, percent: nodes.select("node", "node").toDF("a", "b").where("false"))
    got = jaccard.jaccard_groups(odd).drop("version").collect()
    assert sorted(map(tuple, got)) == sorted(brute.jaccard_components(odd_rows))


def test_filters_lose_no_link(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(40):
        n = int(rng.integers(1, 3000))
        tokens = np.unique(rng.integers(0, 1 << 62, n))
        other = tokens[int(n * rng.uniform(0, 0.3)) :]
        rows += [(2 * i, " ".join(map(str, tokens))), (2 * i + 1, " ".join(map(str, other)))]
    texts = spark.createDataFrame([(i, t, 0) for i, t in rows], "row_id long, text string, version long")
    run, schema = jaccard._profile(1)
    nodes = texts.mapInArrow(run, schema).where("n > 0").selectExpr("node", "row_id AS low")
    doc = {r.node: r.low for r in nodes.collect()}
    own = {i: set(t.split()) for i, t in rows}
    linked = {(a, b) for a in own for b in own if a < b and 100 * len(own[a] & own[b]) >= 75 * len(own[a] | own[b])}
    pairs = spark.createDataFrame([(a, b) for a in doc for b in doc if doc[a] < doc[b]], "a long, b long")
    classes = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    kept = jaccard.intersected(texts, nodes, pairs, lambda wanted: spark.sparkContext.broadcast((*classes, wanted)), 1, 75)
    got = {(doc[r.a], doc[r.b]) for r in kept.collect()}
    assert linked <= got and len(linked) >= 20 and len(got) < 60


@pytest.mark.parametrize("size", [5, 300, 5000])
def test_common_counts_repeated_values(size):
    rng = np.random.default_rng(size)
    a, b = (np.sort(rng.integers(0, 4000, size).astype(np.uint16)) for _ in "ab")
    expected = sum((Counter(a.tolist()) & Counter(b.tolist())).values())
    assert jaccard._common(a.tobytes(), b.tobytes()) == expected


@pytest.mark.parametrize("dealt", [jaccard.DEALT, 50])
def test_repeated_values_are_held(spark, dealt, monkeypatch):
    """Whether they come in one task or two, twice or often; few others are held."""
    monkeypatch.setattr(jaccard, "DEALT", dealt)

    def column(batches):
        for batch in batches:
            yield np.asarray(batch.column(0)).view(np.uint64)

    values = [*range(3000), *range(0, 3000, 100), *[7] * 500]
    holds = jaccard.repeated_map(spark.createDataFrame([(v,) for v in values], "v long").repartition(5), column)
    held = set(np.flatnonzero(holds(np.arange(3000, dtype=np.uint64))).tolist())
    assert {*range(0, 3000, 100), 7} <= held and len(held) < 150
    assert not jaccard.repeated_map(spark.range(40), column)(np.arange(40, dtype=np.uint64)).any()


def test_postings_leave_out_what_one_node_alone_has(spark):
    """The rows that are shuffled by token follow what is shared, not the number of documents."""
    words = [f"{i}-{j}" for i in range(300) for j in range(60)]
    texts = [" ".join(words[60 * i : 60 * i + 60]) for i in range(300)]
    texts += [texts[0].replace("0-30 ", "changed "), texts[1]]
    texts = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "row_id long, text string, version long").repartition(4)
    run, schema = jaccard._profile(5)
    nodes = texts.mapInArrow(run, schema).where("n > 0").groupBy("node").agg(F.min("row_id").alias("low"))
    none = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    got = jaccard.postings(texts, spark.sparkContext.broadcast((*none, jaccard.node_map(nodes))), 5, 75)
    rows = {r.node: r for r in got.collect()}
    doc = {r.node: r.low for r in nodes.collect()}
    pair = [r for n, r in rows.items() if doc[n] in (0, 300)]
    assert len(pair) == 2 and set(pair[0].tokens) & set(pair[1].tokens)
    assert all(len(r.tokens) == len(r.places) and max(r.places) < 15 for r in rows.values())
    assert sum(len(r.tokens) for r in rows.values()) < 301 * 15 / 10


def test_jaccard_groups_with_repeated_rows_and_ids(repeated):
    got = jaccard.jaccard_groups(repeated)
    assert got.count() == repeated.count()
    rows = {(r.doc_id, r.n_shingles): r.component_id for r in got.collect()}
    assert rows[7, 1] == 7 and rows[None, 76] == 0 and rows[None, 0] is None
    kept = jaccard.without_near_copies(repeated)
    assert kept.columns == repeated.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(0) == 1 and ids.count(7) == 2 and ids.count(None) == 2
    assert not {1, 2, 3} & set(ids) and {4, 5, 6} <= set(ids)


def test_jaccard_groups_of_an_empty_table(empty):
    assert jaccard.jaccard_groups(empty).count() == 0


def test_suffixes_agree_with_all_substrings(odd, odd_rows, monkeypatch):
    expected = brute.substring_removal(odd_rows)
    for run in (suffixes.RUN, 16):
        monkeypatch.setattr(suffixes, "RUN", run)
        got = suffixes.without_spans(odd, suffixes.repeated_spans(odd)).collect()
        assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == expected
        assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got)


def test_suffixes_with_repeated_rows_and_no_rows(repeated, empty):
    got = suffixes.without_spans(repeated, suffixes.repeated_spans(repeated)).collect()
    assert len(got) == repeated.count()
    assert [r.n_removed for r in got if r.doc_id in (0, None)] == [0] * 5
    assert suffixes.without_spans(empty, suffixes.repeated_spans(empty)).count() == 0


def test_chunks_resist_insertions():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 123, 20_000).astype(np.uint8)
    more = np.concatenate([data[:5000], np.frombuffer(b"inserted", np.uint8), data[5000:]])

    def parts(x):
        at = chunks.cut_points(x, np.array([0, len(x)]), 16, 256)
        return {x[a:b].tobytes() for a, b in zip(at, [*at[1:], len(x)], strict=True)}

    assert len(parts(data) - parts(more)) <= 3
    ends = chunks.cut_points(data, np.array([0, len(data)]), 16, 256)
    assert np.diff(ends).max() <= 256


def test_gear_hash_is_the_rolling_sum():
    data = np.arange(100, dtype=np.uint8)
    value = sum(int(chunks.GEAR[data[60 - j]]) << j for j in range(chunks.REACH)) % (1 << 64)
    assert int(chunks.gear_hash(data)[60]) == value


def test_repeated_chunks(repeated, odd_rows, empty):
    got = {(r.doc_id, r.n_bytes): r for r in chunks.repeated_chunks(repeated).collect()}
    text = dict(odd_rows)
    copy = got[2, len(text[2])]
    assert [tuple(s) for s in copy.spans] == [(0, len(text[2]))] and copy.n_chunks == copy.n_repeated
    # The copies without an id come first and keep the text; those with one repeat it.
    assert got[None, len(text[0])].n_repeated == 0 and got[0, len(text[0])].n_repeated > 0
    assert sum(s.end - s.start for s in got[11, len(text[11])].spans) > 150
    assert got[5, 0].n_chunks == 0 and got[4, 0].spans == []
    assert chunks.repeated_chunks(empty).count() == 0
    assert chunks.repeated_chunks(repeated).count() == repeated.count()


def test_fingerprints_of_edited_texts(odd, odd_rows):
    got = {r.doc_id: r for r in simhash.edited_fingerprints(odd).collect()}
    rows = sorted((i, t or "") for i, t in odd_rows)
    assert len(got) == len(rows)
    for (doc, text), (after, following) in zip(rows, rows[1:] + rows[:1], strict=True):
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        assert got[doc].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert got[doc].n_chars == len(text) and got[doc].next_print == got[after].print
    assert got[0].print == got[2].print and got[5].print == 0


def test_fingerprints_with_repeated_rows(repeated, empty):
    assert simhash.edited_fingerprints(repeated).count() == repeated.count()
    assert simhash.edited_fingerprints(empty).count() == 0


def test_fingerprint_is_the_sign_of_the_votes(spark):
    df = spark.createDataFrame([(1, "Alpha beta, beta gamma-delta!")], "k long, text string")
    got = simhash.fingerprints(df, ["k"], {"print": F.col("text")}).first()["print"]
    terms = ["alpha", "beta", "beta", "gamma", "delta"]
    hashes = spark.createDataFrame([(t,) for t in terms], "t string").select(F.xxhash64("t")).collect()
    expected = 0
    for bit in range(64):
        votes = sum(len(t) * (1 if h[0] >> bit & 1 else -1) for t, h in zip(terms, hashes, strict=True))
        expected |= (votes > 0) << bit
    assert got % (1 << 64) == expected


def test_block_tables_find_all_within_the_radius(spark):
    rng = np.random.default_rng(4)
    prints = [int(x) for x in rng.integers(-(2**63), 2**63, 60)]
    prints += [p ^ (1 << int(a)) ^ (1 << int(b)) ^ (1 << int(c)) for p in prints[:30] for a, b, c in [rng.integers(0, 63, 3)]]
    prints += [prints[0], None]
    df = spark.createDataFrame([(p,) for p in prints], "print long")
    known = sorted({p for p in prints if p is not None})
    for radius in (1, 3):
        got = sorted((r.a, r.b) for r in simhash.within_radius(df, radius).collect())
        assert got == [(a, b) for a in known for b in known if a < b and bin((a ^ b) % (1 << 64)).count("1") <= radius]


@pytest.mark.parametrize("held", [0, 3, 1 << 17])
def test_chunks_seen_in_earlier_blocks_are_late(monkeypatch, held):
    """However the texts are dealt into batches and whatever is forgotten, the same chunks repeat."""
    monkeypatch.setattr(chunks, "HELD", held)
    rng = np.random.default_rng(9)
    lines = ["".join(chr(97 + int(c)) for c in rng.integers(0, 26, 150)) for _ in range(12)]
    texts = [(int(d), "".join(lines[int(i)] for i in rng.integers(0, 12, 5))) for d in rng.permutation(60)]

    def repeated(size):
        batches = [
            pa.RecordBatch.from_arrays(
                [pa.array([d for d, _ in part], pa.int64()), pa.array([0] * len(part), pa.int32()), pa.array([t for _, t in part])],
                names=["doc_id", "version", "text"],
            )
            for part in (texts[i : i + size] for i in range(0, len(texts), size))
        ]
        rows = [r for b in chunks._chunked(16, 256)[0](iter(batches)) for r in b.to_pylist()]
        first = {}
        for r in rows:
            first[r["d1"], r["d2"]] = min(first.get((r["d1"], r["d2"]), (1 << 60,)), (r["doc_id"], r["start"]))
        assert sum(r["late"] for r in rows) < len(rows)
        return {(r["doc_id"], r["start"]) for r in rows if r["late"] or first[r["d1"], r["d2"]] < (r["doc_id"], r["start"])}, rows

    whole, rows = repeated(60)
    text, expected, met = dict(texts), set(), set()
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["start"])):
        chunk = text[r["doc_id"]][r["start"] : r["end"]]
        expected |= {(r["doc_id"], r["start"])} if chunk in met else set()
        met.add(chunk)
    assert whole == expected and all(repeated(size)[0] == expected for size in (1, 7, 20))
