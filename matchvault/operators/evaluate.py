"""Evaluation of a binary classifier: decisions, confusion, metrics, curves, leaderboard, baselines."""

from pyspark.sql import functions as F

from matchvault.functions import decide, implied_probability
from matchvault.operators.scan import following, ordered_scan, sum_before


def with_decision(df, score, threshold, out="y_pred"):
    return df.withColumn(out, decide(score, threshold))


def confusion_matrix(df, y="y", y_pred="y_pred", by=()):
    """Row count per true and predicted class."""
    return df.groupBy(*by, y, y_pred).agg(F.count(F.lit(1)).alias("cnt"))


def classifier_metrics(df, y="y", y_pred="y_pred", by=()):
    """Accuracy, precision, recall, F1 and the ROC AUC of the hard labels, in one aggregate.

    A metric whose denominator is zero is NULL. The AUC of hard labels is the mean of the true
    positive and true negative rates.
    """
    t, p = F.col(y), F.col(y_pred)
    cells = df.groupBy(*by).agg(
        F.count_if((t == 1) & (p == 1)).alias("tp"),
        F.count_if((t == 0) & (p == 1)).alias("fp"),
        F.count_if((t == 1) & (p == 0)).alias("fn"),
        F.count_if((t == 0) & (p == 0)).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return cells.select(
        *by, "tp", "fp", "fn", "tn",
        F.try_divide(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        F.try_divide(tp, tp + fp).alias("precision"),
        F.try_divide(tp, tp + fn).alias("recall"),
        F.try_divide(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
        ((F.try_divide(tp, tp + fn) + F.try_divide(tn, tn + fp)) / 2).alias("roc_auc"),
    )


def _by_score(df, y, score):
    """True and false positives when everything scoring at least this much is called positive.

    Rows are reduced to one per distinct score before anything is ordered.
    """
    counts = (
        df.filter(F.col(score).isNotNull() & F.col(y).isNotNull())
        .groupBy(F.col(score).alias("threshold"))
        .agg(
            F.count_if(F.col(y) == 1).alias("_pos"),
            F.count_if(F.col(y) == 0).alias("_neg"),
        )
        .withColumn("_down", -F.col("threshold"))
    )
    totals = counts.agg(F.sum("_pos").alias("p"), F.sum("_neg").alias("n")).first()
    scan = ordered_scan(counts, [], ["_down"]).with_values(
        _tp=sum_before("_pos"),
        _fp=sum_before("_neg"),
        _next_pos=following("_pos"),
        _next_neg=following("_neg"),
    )
    rows = scan.rows().withColumns(
        {"tp": F.col("_tp") + F.col("_pos"), "fp": F.col("_fp") + F.col("_neg")}
    )
    return rows, totals["p"] or 0, totals["n"] or 0


def roc_curve(df, y="y", score="score", drop_intermediate=True):
    """False and true positive rate per threshold, from the point (0, 0) at threshold infinity.

    ``drop_intermediate`` leaves out points inside a straight run, where the step to the next
    threshold adds as many of each class as the step before.
    """
    rows, p, n = _by_score(df, y, score)
    if drop_intermediate:
        first = (F.col("_tp") + F.col("_fp")) == 0
        last = F.col("_next_pos").isNull()
        bend = (F.col("_pos") != F.col("_next_pos")) | (F.col("_neg") != F.col("_next_neg"))
        rows = rows.filter(first | last | bend)
    points = rows.select(
        F.col("threshold").cast("double").alias("threshold"),
        F.try_divide(F.col("fp"), F.lit(n)).alias("fpr"),
        F.try_divide(F.col("tp"), F.lit(p)).alias("tpr"),
    )
    origin = df.sparkSession.createDataFrame([(float("inf"), 0.0, 0.0)], points.schema)
    return origin.unionByName(points)


def pr_curve(df, y="y", score="score"):
    """Precision and recall per threshold."""
    rows, p, _ = _by_score(df, y, score)
    return rows.select(
        F.col("threshold").cast("double").alias("threshold"),
        F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        F.try_divide(F.col("tp"), F.lit(p)).alias("recall"),
    )


def auc_score(df, y="y", score="score"):
    """Area under the ROC curve of the scores, by trapezoids over distinct scores."""
    rows, p, n = _by_score(df, y, score)
    # Twice the area in units of one positive times one negative keeps the sum in whole numbers.
    twice = F.sum((F.col("_neg") * (2 * F.col("_tp") + F.col("_pos"))).cast("decimal(38,0)"))
    return rows.agg(F.try_divide(twice.cast("double"), F.lit(2.0 * p * n)).alias("auc"))


def leaderboard(scores, by="f1_score"):
    """Models with equal lines removed, best first."""
    return scores.dropDuplicates().orderBy(F.desc(by), *[c for c in ("model",) if c in scores.columns])


def random_guess(df, key, seed=15, out="y_pred"):
    """Baseline that calls a side at random, the same one on every run: one bit of a keyed hash."""
    bit = F.substring(F.sha1(F.concat_ws("_", key, F.lit(str(seed)))), 1, 1) >= "8"
    return df.withColumn(out, bit.cast("int"))


def odds_baseline(df, home_odds, visiting_odds, threshold=0.5, out="y_pred"):
    """Baseline that trusts the bookmaker's odds."""
    proba = implied_probability(home_odds, visiting_odds)
    return df.withColumn("score", proba).withColumn(out, decide("score", threshold))
