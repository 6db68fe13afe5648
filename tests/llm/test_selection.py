import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchvault.llm import decontaminate, hyperlang, pieces, resample, ring, secrets_scan
from tests.llm import brute
from tests.llm.conftest import SF, frame

BENCHMARK = [
    (1, "What is the boiling point of pure water at sea level on this planet? It is one hundred degrees by the scale of Celsius"),
    (2, "Rivers carry sediment downstream until the current slackens near the delta, where the heavy grains settle before the fine ones"),
    (3, None), (4, ""),
]


def test_contaminated_passages(spark, odd_rows):
    tests = spark.createDataFrame(BENCHMARK, "item_id long, text string")
    filler = "some other words stand here and say nothing of note " * 20
    rows = [*odd_rows, (1000, filler + BENCHMARK[0][1].upper() + " " + filler), (1001, BENCHMARK[1][1]),
            (1002, filler + BENCHMARK[0][1].split("?")[0] + " " + filler), (1003, "the of water on at is " * 300)]
    docs = frame(spark, rows)
    got = sorted((r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, tests).collect())
    assert got == [(1000, 1), (1001, 2)]
    left = decontaminate.without_contaminated(docs, tests)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted({i for i, _ in rows} - {1000, 1001})


def _edited_items(rng, lengths):
    """Items of these lengths, with a question mark in every other one, and texts that hold them with a tenth edited."""
    items, texts = [], []
    for i, n in enumerate(lengths):
        words = [f"i{i}w{k}" for k in range(n)]
        if i % 2:
            words[n // 2] += "?"
        items.append((i, " ".join(words)))
        for k in rng.choice(n, max(1, n // 10), replace=False):
            words[k] = "edited?" if words[k].endswith("?") else "edited"
        before, after = (" ".join(f"f{x}" for x in rng.integers(0, 500, rng.integers(0, 150))) for _ in range(2))
        texts.append((i, f"{before} {' '.join(words)} {after}"))
    return items, texts


def test_edited_copies_of_items_of_every_length_are_found(spark):
    items, texts = _edited_items(np.random.default_rng(5), range(8, 61))
    tests = spark.createDataFrame(items, "item_id long, text string")
    halves = [(1000 + i, t.split("?")[0]) for i, t in items if "?" in t]
    found = decontaminate.contaminated(frame(spark, [*texts, *halves]), tests).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(i, i) for i, _ in items}
    assert all(r.question_overlap == r.answer_overlap for r in found if r.item_id % 2 == 0)


def test_copies_are_found_at_every_offset_also_beside_a_long_item(spark):
    # Few rare words at both ends carry the weight; the other words are common to many items.
    items = [(0, " ".join([f"a0x{k}" for k in range(20)] + [f"c{k % 58}" for k in range(600)] + [f"b0x{k}" for k in range(20)]))]
    items += [(i, " ".join([f"a{i}x{k}" for k in range(3)] + [f"c{(i + k) % 58}" for k in range(58)] + [f"b{i}x{k}" for k in range(3)])) for i in range(1, 60)]
    tests = spark.createDataFrame(items, "item_id long, text string")
    texts = [(1000 * i + at, "far " * at + items[i][1] + " away" * 40) for i in (0, 7) for at in range(0, 80, 3)]
    # 3-grams of a short item, torn apart by more words than any passage of its class has, are no copy of it.
    torn = [" ".join(f"torn{k}" for k in range(j, j + 3)) for j in range(0, 24, 3)]
    tests = tests.unionByName(spark.createDataFrame([(99, " ".join(torn))], "item_id long, text string"))
    texts.append((99, (" far" * 60 + " ").join(torn)))
    found = decontaminate.contaminated(frame(spark, texts), tests)
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(i, i // 1000) for i, _ in texts if i != 99}
    assert found.where("score < 0.999 OR question_overlap < 1").count() == 0


def test_search_finds_every_item_above_the_threshold(spark):
    rng = np.random.default_rng(2)
    tests = spark.createDataFrame(
        [(i, " ".join(f"w{int(x)}" for x in rng.zipf(1.3, 30) % 300)) for i in range(150)], "item_id long, text string"
    )
    index = decontaminate.indexes(tests, 0.3)[0]
    for _ in range(200):
        wanted = np.unique(rng.integers(0, len(index.terms), 60)).tolist()
        score = np.zeros(150)
        for t in wanted:
            score[index.lists[t][0]] += index.lists[t][1]
        expected = {int(i) for i in np.flatnonzero(score >= 0.3)}
        got = index.search(wanted)
        assert {i for i, _ in got} == expected
        assert not expected or index.within_reach(wanted)


def test_no_items_or_documents(spark, odd, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contaminated(odd, none).count() == 0
    assert decontaminate.without_contaminated(odd, none).count() == odd.count()
    assert decontaminate.contaminated(empty, spark.createDataFrame(BENCHMARK, "item_id long, text string")).count() == 0


def test_pieces_spell_every_text_and_are_reproducible(repeated, empty):
    def encoded(df, **more):
        return sorted((r.doc_id or -1, r.text or "", r.pieces or []) for r in pieces.encode(df, **more).collect())

    first = encoded(repeated)
    assert first == encoded(repeated.repartition(7)) and first != encoded(repeated, seed=1)
    rows = pieces.decode(pieces.encode(repeated)).collect()
    assert len(rows) == repeated.count()
    assert all(r.decoded == (r.text or "") for r in rows)
    assert all((r.pieces is None) == (r.text is None) for r in pieces.encode(repeated).collect())
    assert pieces.decode(pieces.encode(empty)).count() == 0


def test_encoding_and_decoding_take_one_python_worker(spark, repeated):
    spelled = pieces.decode(pieces.encode(repeated))
    assert spelled._jdf.queryExecution().toString().count("MapInArrow") == pieces.encode(repeated)._jdf.queryExecution().toString().count("MapInArrow")
    model = pieces.Pieces(pieces.MODEL, 1.0)
    word = [i for i, x in enumerate(model.text) if x == b" the"][0]
    rows = [(1, None), (2, []), (3, [word, *model.byte[list("é".encode())].tolist(), word])]
    got = pieces.decode(spark.createDataFrame(rows, "doc_id long, pieces array<int>")).collect()
    assert sorted(map(tuple, got)) == [(1, [], ""), (2, [], ""), (3, rows[2][1], "theé the")]


def test_pieces_with_equal_leading_bits_are_found():
    model = pieces.Pieces(pieces.MODEL, 1.0)
    assert model.most > 1
    asked = np.stack([model.hash, model.hash + np.uint64(1), model.hash - np.uint64(1)])
    found = model.lookup(asked)
    assert (found[0] == model.id).all() and (found[1:] == np.where(np.isin(asked[1:], model.hash), found[1:], -1)).all()
    assert model.weight[-1] == 0 and (model.weight[model.id] > 0).all()


def test_segmentations_are_drawn_in_proportion():
    model = pieces.Pieces(pieces.MODEL, 1.0)
    text, n = b"there", 20_000
    data, offsets = np.frombuffer(text * n, np.uint8), np.arange(n + 1) * len(text)
    ids, bounds = pieces.segment(model, data, offsets, np.arange(n, dtype=np.uint64) * np.uint64(77))
    drawn = {}
    for low, high in zip(bounds[:-1], bounds[1:], strict=True):
        key = tuple(ids[low:high].tolist())
        drawn[key] = drawn.get(key, 0) + 1
    word = b" " + text
    known = {model.text[i]: i for i in model.id.tolist()}

    def ways(rest):
        if not rest:
            yield (), 1.0
        for k in range(1, len(rest) + 1):
            if rest[:k] in known:
                for tail, weight in ways(rest[k:]):
                    yield (known[rest[:k]], *tail), weight * model.weight[known[rest[:k]]]

    weights = dict(ways(word))
    total = sum(weights.values())
    assert set(drawn) <= set(weights)
    for key, weight in weights.items():
        share = weight / total
        assert abs(drawn.get(key, 0) / n - share) < 5 * (share * (1 - share) / n) ** 0.5 + 2 / n


def test_resampling_keeps_good_text(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = resample.resampled(docs, labels)
    assert got.count() == docs.count()
    truth = labels.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    rows = got.join(truth, "doc_id").select("kept", "quality").collect()
    assert sum(r.kept == bool(r.quality) for r in rows) >= 0.9 * len(rows)


def test_resampling_without_labels_or_rows(spark, repeated, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert resample.resampled(repeated, none).where("kept").count() == repeated.count()
    assert resample.resampled(empty, none).count() == 0


@pytest.mark.parametrize("k", [1, 2, 5, 8])
def test_kth_largest(spark, k):
    values = [3.5, -2.25, 0.0, 7.0, -1e300, 7.0, 1e-9, -0.5]
    df = spark.createDataFrame([(v,) for v in values], "key double")
    assert resample.kth_largest(df, k) == sorted(values, reverse=True)[k - 1]


def test_best_cut():
    weights, good = np.array([-3.0, -2.0, -1.0, 1.0, 2.0]), np.array([False, False, True, True, True])
    assert resample.best_cut(weights, good) == -1.5
    assert resample.best_cut(weights, np.ones(5, bool)) == -np.inf


def test_bounded_loads(spark, repeated, empty):
    rows = ring.bounded_shards(repeated, 8).collect()
    counts = [sorted(r.slot for r in rows if r.shard == s) for s in range(8)]
    assert len(rows) == repeated.count() and all(c == list(range(len(c))) for c in counts)
    assert max(map(len, counts)) - min(map(len, counts)) <= 1
    texts = {r.doc_id: (r.text or "").encode() for r in repeated.collect() if r.doc_id not in (7, None)}
    assert all(r.size == len(texts[r.doc_id]) + 1 and r.text_crc32 == zlib.crc32(texts[r.doc_id]) for r in rows if r.doc_id in texts)
    assert ring.bounded_shards(empty, 8).count() == 0


def test_few_rows_move_when_a_shard_is_added():
    counts = np.full(ring.CELLS, 3)

    def owners(shards):
        out = np.zeros(counts.sum(), np.int64)
        for cell, low, high, shard, _ in ring.place_cells(counts, shards, 0.25):
            out[cell * 3 + low : cell * 3 + high] = shard
        return out

    moved = (owners(8) != owners(9)).mean()
    assert moved < 0.35


def test_secret_spans(spark, odd_rows):
    noise = "aG9x+Zk3/Qw8Lp0_Vt5Yb2Nc7Rf1Hd6"
    rows = [*odd_rows, (500, f"k {noise} end"), (501, "api_key = 'abcdef' token: abc secret=\"x.y/z=12\""),
            (502, "AKIA" + "A1" * 10 + " AKIASHORT"), (503, "ß" * 5 + "0123456789abcdef" * 2 + " DEADBEEFCAFE0123456789AB7F3E"),
            (504, "id 123e4567-e89b-12d3-a456-426614174000 EXAMPLE" + noise), (505, "password=token: abcdefgh"),
            (506, "a" * 60 + noise * 3)]
    docs = frame(spark, rows)
    got = {r.doc_id: [tuple(x) for x in r.found] for r in secrets_scan.secret_spans(docs).collect()}
    for doc, text in rows:
        assert got[doc] == brute.secrets(text, secrets_scan.CLASSES, secrets_scan.ALLOWED, secrets_scan.UNIT)[1], doc
    assert got[500] and got[506] and not got[505]
    clean = {r.doc_id: r.text for r in secrets_scan.redacted(docs).collect()}
    assert clean[500] == "k [secret] end" and clean[4] is None and clean[0] == rows[0][1]


def test_language_is_predicted(spark, repeated, empty):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    test = F.col("doc_id") % 3 == 1
    model = hyperlang.prototypes(docs.where(~test))
    rows = hyperlang.predict_language(docs.where(test), *model).collect()
    assert sum(r.lang_pred == r.lang for r in rows) >= 0.95 * len(rows) and all(0 <= r.score <= 1 for r in rows)
    odd = hyperlang.predict_language(repeated, *model)
    assert odd.count() == repeated.count()
    assert {r.lang_pred for r in odd.collect() if r.doc_id in (4, 5, 6)} == {"und"}
    assert hyperlang.predict_language(empty, *hyperlang.prototypes(empty)).count() == 0
    assert {r.lang_pred for r in hyperlang.predict_language(repeated, [], np.zeros((0, hyperlang.DIMENSIONS))).collect()} == {"und"}
