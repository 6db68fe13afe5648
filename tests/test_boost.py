import math
import random

import pytest
from conftest import rows
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from matchvault.operators import boost, evaluate, ml
from matchvault.operators.scan import ROWS_PER_CHUNK_CONF

SCHEMA = "id int, day int, x double, noise double, team string, label double"
BORDERS = {"x": [-1.0, -0.3, 0.0, 0.4, 1.1], "noise": [-0.5, 0.5]}


@pytest.fixture(scope="module")
def data():
    rnd, out = random.Random(3), []
    for i in range(700):
        x, noise, team = rnd.gauss(0, 1), rnd.gauss(0, 1), rnd.choice(["A", "B", "C", None])
        label = float(x + (1.0 if team == "A" else 0.0) + rnd.gauss(0, 0.5) > 0.3)
        # One team holds most rows; some numbers are missing, some are not numbers, some rows have no label.
        x = None if i % 41 == 0 else math.nan if i % 43 == 0 else x
        out.append((i, i // 5, x, noise, "A" if i % 3 == 0 else team, None if i % 97 == 0 else label))
    return out


def brute_statistics(data, prior=0.5, weight=1.0):
    seen, out = {}, {}
    for i, _, _, _, team, label in sorted(data, key=lambda r: (r[1], r[0])):
        wins, n = seen.get(team, (0, 0))
        out[i] = (wins + prior * weight) / (n + weight)
        if label is not None:
            seen[team] = (wins + label, n + 1)
    return out, {t: (w + prior * weight) / (n + weight) for t, (w, n) in seen.items()}


def brute_scores(train, test, rounds, step, depth, l2):
    """Row by row: all cuts of all features tried on plain lists."""
    train = [r for r in train if r[5] is not None]
    before, whole = brute_statistics(train)
    even = [(i + 1) / 16 for i in range(15)]
    borders = [BORDERS["x"], BORDERS["noise"], even]

    def binned(r, stat):
        values = [r[2], r[3], stat]
        return [0 if v is None or math.isnan(v) else 1 + sum(b < v for b in bs) for v, bs in zip(values, borders)]

    bins = [binned(r, before[r[0]]) for r in train]
    margins, trees = [0.0] * len(train), []
    for _ in range(rounds):
        p = [1 / (1 + math.exp(-m)) for m in margins]
        nodes, splits = [0] * len(train), []
        for level in range(depth):
            def worth(of):
                sums = {}
                for i in range(len(train)):
                    g, h = sums.get(of(i), (0.0, 0.0))
                    sums[of(i)] = (g + train[i][5] - p[i], h + p[i] * (1 - p[i]))
                return sum(g * g / (h + l2) for g, h in sums.values())

            now = worth(lambda i: nodes[i])
            tried = [
                (-round(worth(lambda i: (nodes[i], bins[i][f] > k)) - now, 9), f, k)
                for f in range(3)
                for k in range(len(borders[f]) + 1)
            ]
            gain, f, k = min(tried)
            if gain >= 0:
                break
            splits.append((f, k))
            nodes = [n + ((bins[i][f] > k) << level) for i, n in enumerate(nodes)]
        leaves = {}
        for i, n in enumerate(nodes):
            g, h = leaves.get(n, (0.0, 0.0))
            leaves[n] = (g + train[i][5] - p[i], h + p[i] * (1 - p[i]))
        leaves = {n: step * g / (h + l2) for n, (g, h) in leaves.items()}
        margins = [m + leaves[n] for m, n in zip(margins, nodes)]
        trees.append((splits, leaves))
    out = {}
    for r in test:
        b = binned(r, whole.get(r[4], 0.5))
        at = [sum((b[f] > k) << i for i, (f, k) in enumerate(splits)) for splits, _ in trees]
        out[r[0]] = 1 / (1 + math.exp(-sum(leaves.get(n, 0.0) for n, (_, leaves) in zip(at, trees))))
    return out


@pytest.mark.parametrize("limit", [None, "40"])
def test_ordered_statistics(spark, data, limit):
    if limit:
        spark.conf.set(ROWS_PER_CHUNK_CONF, limit)
    try:
        df = spark.createDataFrame(data, SCHEMA).repartition(3)
        got = boost.ordered_statistics(df, ["team"], ["day", "id"])
        assert got.columns == [*df.columns, "team_before"]
        assert {r["id"]: r["team_before"] for r in got.collect()} == brute_statistics(data)[0]
    finally:
        spark.conf.unset(ROWS_PER_CHUNK_CONF)


def test_scores_are_those_of_plain_lists(spark, data, tmp_path):
    """12 rounds, so that margins go through a checkpoint."""
    train, test = data[:500], [*data[500:], (900, 200, 0.7, 0.0, "unseen", 1.0)]
    settings = boost.NewtonBoosting(("day", "id"), rounds=12, step=0.5, depth=3, borders=BORDERS)
    model = ml.fit(spark.createDataFrame(train, SCHEMA), ["x", "noise"], ["team"], settings)
    df = spark.createDataFrame(test, SCHEMA).withColumn("_bins", F.lit("mine"))
    scored = ml.score(model, df, 0.5)
    assert scored.columns == [*df.columns, "score", "y_pred"] and scored.filter("_bins = 'mine'").count() == len(test)
    want = brute_scores(train, test, 12, 0.5, 3, 7.0)
    got = {r["id"]: r["score"] for r in scored.collect()}
    assert got.keys() == want.keys()
    assert max(abs(got[i] - want[i]) for i in got) < 1e-9
    model.write().save(str(tmp_path / "model"))
    again = ml.score(PipelineModel.load(str(tmp_path / "model")), df, 0.5)
    assert rows(again, "id", "score", "y_pred") == rows(scored, "id", "score", "y_pred")
    table = ml.feature_importance(model, ["x", "noise"], ["team"], spark)
    found = {r["feature"]: r["feature_importance"] for r in table.collect()}
    assert set(found) == {"x", "noise", "team"} and abs(sum(found.values()) - 1) < 1e-9
    assert found["x"] > found["noise"]


def test_total_step_of_the_settings_and_learning(spark, data):
    settings = boost.NewtonBoosting(("day", "id"))
    assert settings.rounds * settings.step == boost.TOTAL_STEP == 25 and settings.l2 == 7
    df = spark.createDataFrame([r for r in data if r[5] is not None], SCHEMA)
    model = ml.fit(df.filter("id < 500"), ["x", "noise"], ["team"], boost.NewtonBoosting(("day", "id"), rounds=10))
    test = df.filter("id >= 500")
    found = evaluate.classifier_metrics(ml.score(model, test, 0.5), y="label").first()["accuracy"]
    guess = evaluate.classifier_metrics(evaluate.random_guess(test, "id"), y="label").first()["accuracy"]
    assert found > 0.75 and found > guess + 0.15


def test_nothing_to_learn(spark):
    """No rows, one label and one value: no cut, and no crash."""
    none = spark.createDataFrame([], SCHEMA)
    settings = boost.NewtonBoosting(("day", "id"), rounds=3)
    assert ml.fit(none, ["x"], ["team"], settings).stages[-1].importances() == [("x", 0.0), ("team", 0.0)]
    same = spark.createDataFrame([(i, i, 1.0, 0.0, None, 1.0) for i in range(30)], SCHEMA)
    model = ml.fit(same, ["noise"], [], settings)
    scores = {r["score"] for r in ml.score(model, same).collect()}
    assert len(scores) == 1 and scores.pop() > 0.5
    with pytest.raises(ValueError):
        boost.NewtonBoosting(("day",), l2=0.0)


def test_statistics_of_many_categories_move_rows_once(spark, small_chunks):
    """Split rows are cut once for all categories; each later one is a sort, not an exchange."""
    data = [(i, i // 5, "AB"[i % 2], "XYZ"[i % 3], None if i % 7 else "u", float(i % 4 == 0)) for i in range(400)]
    df = spark.createDataFrame(data, "id int, day int, a string, b string, c string, label double")
    out = boost.ordered_statistics(df, ["a", "b", "c"], ["day", "id"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(_chunk") == 1 and "SortMergeJoin" not in plan
    wins, n = {}, {}
    for r in sorted(out.collect(), key=lambda r: r["id"]):
        for c in "abc":
            k = (c, r[c])
            assert abs(r[f"{c}_before"] - (wins.get(k, 0) + 0.5) / (n.get(k, 0) + 1)) < 1e-12
            wins[k], n[k] = wins.get(k, 0) + r["label"], n.get(k, 0) + 1
