import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from matchvault.operators import evaluate


def labelled(spark, n=300, seed=1):
    rnd = random.Random(seed)
    data = [(i, rnd.randrange(2), rnd.randrange(40) / 40) for i in range(n)]
    return data, spark.createDataFrame(data, "id int, y int, score double")


def test_metrics_and_confusion(spark):
    df = spark.createDataFrame(
        [(1, 1)] * 4 + [(0, 1)] * 1 + [(1, 0)] * 2 + [(0, 0)] * 3, "y int, y_pred int"
    )
    m = evaluate.classifier_metrics(df).first()
    assert (m["tp"], m["fp"], m["fn"], m["tn"]) == (4, 1, 2, 3)
    assert m["accuracy"] == pytest.approx(0.7) and m["precision"] == pytest.approx(0.8)
    assert m["recall"] == pytest.approx(4 / 6) and m["f1_score"] == pytest.approx(8 / 11)
    assert m["roc_auc"] == pytest.approx((4 / 6 + 3 / 4) / 2)
    assert rows(evaluate.confusion_matrix(df)) == [(0, 0, 3), (0, 1, 1), (1, 0, 2), (1, 1, 4)]


def test_no_predicted_positives(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "y int, y_pred int")
    m = evaluate.classifier_metrics(df).first()
    assert m["precision"] is None and m["recall"] == 0 and m["f1_score"] == 0


def brute_points(data):
    p = sum(y for _, y, _ in data)
    n = len(data) - p
    out = []
    for t in sorted({s for *_, s in data}, reverse=True):
        tp = sum(1 for _, y, s in data if s >= t and y == 1)
        fp = sum(1 for _, y, s in data if s >= t and y == 0)
        out.append((t, fp / n, tp / p, tp / (tp + fp)))
    return out


def test_curves_and_auc(spark, small_chunks):
    data, df = labelled(spark)
    points = brute_points(data)
    full = sorted(rows(evaluate.roc_curve(df, drop_intermediate=False)), key=lambda r: -r[0])
    assert full[0] == (float("inf"), 0.0, 0.0)
    for i in (1, 2):
        assert [r[i] for r in full[1:]] == pytest.approx([p[i] for p in points])
    pr = sorted(rows(evaluate.pr_curve(df)), key=lambda r: -r[0])
    assert [r[1] for r in pr] == pytest.approx([p[3] for p in points])
    assert pr[-1][2] == 1.0
    pairs = [(a[2], b[2]) for a in data for b in data if a[1] == 1 and b[1] == 0]
    want = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a, b in pairs) / len(pairs)
    assert evaluate.auc_score(df).first()[0] == pytest.approx(want)
    kept = sorted(rows(evaluate.roc_curve(df)), key=lambda r: -r[0])
    area = sum((b[1] - a[1]) * (a[2] + b[2]) / 2 for a, b in zip(kept, kept[1:]))
    assert area == pytest.approx(want)


def test_straight_runs_are_dropped(spark):
    df = spark.createDataFrame([(1, s / 10) for s in range(5)] + [(0, -1.0)], "y int, score double")
    assert evaluate.roc_curve(df, drop_intermediate=False).count() == 7
    assert evaluate.roc_curve(df).count() == 4  # origin, first, last positive, last


def test_leaderboard_and_baselines(spark):
    df = spark.createDataFrame([("a", 0.5), ("b", 0.7), ("a", 0.5)], "model string, f1_score double")
    assert [r["model"] for r in evaluate.leaderboard(df).collect()] == ["b", "a"]
    _, scored = labelled(spark, 1000)
    guess = evaluate.random_guess(scored, "id")
    share = guess.agg(F.avg("y_pred")).first()[0]
    assert 0.4 < share < 0.6 and rows(guess) == rows(evaluate.random_guess(scored, "id"))
    odds = spark.createDataFrame([(1.5, 3.0), (3.0, 1.5)], "h double, v double")
    assert rows(evaluate.odds_baseline(odds, "h", "v"), "y_pred") == [(0,), (1,)]
