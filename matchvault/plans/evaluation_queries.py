"""Evaluation of scores, model training and stored predictions."""

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from matchvault.operators import boost, evaluate, features, kernel, ml
from matchvault.plans import fixtures as fx
from matchvault.plans.registry import iso_dates, query
from matchvault.sources.tables import scratch_store

WITH = "WITH" + fx.SCORED_SQL


@query(
    "threshold_decision",
    WITH + " SELECT doc_id, y, CASE WHEN by_length >= 0.48 THEN 1 ELSE 0 END AS y_pred FROM scored",
)
def threshold_decision(spark, sf_dir):
    rows = evaluate.with_decision(fx.scored(spark, sf_dir), "by_length", ml.PRODUCTION_THRESHOLD)
    return rows.select("doc_id", "y", "y_pred")


@query(
    "confusion_matrix",
    WITH
    + """
SELECT y, CASE WHEN by_length >= 0.48 THEN 1 ELSE 0 END AS y_pred, count(*) AS cnt
FROM scored GROUP BY ALL""",
)
def confusion_matrix(spark, sf_dir):
    rows = evaluate.with_decision(fx.scored(spark, sf_dir), "by_length", ml.PRODUCTION_THRESHOLD)
    return evaluate.confusion_matrix(rows)


def _metrics_sql(source, by=""):
    by_select = f"{by}, " if by else ""
    d = lambda c: f"CAST({c} AS DOUBLE)"
    return f"""
SELECT {by_select}tp, fp, fn, tn,
       {d("tp + tn")} / nullif(tp + fp + fn + tn, 0) AS accuracy,
       {d("tp")} / nullif(tp + fp, 0) AS "precision", {d("tp")} / nullif(tp + fn, 0) AS recall,
       {d("2 * tp")} / nullif(2 * tp + fp + fn, 0) AS f1_score,
       ({d("tp")} / nullif(tp + fn, 0) + {d("tn")} / nullif(tn + fp, 0)) / 2 AS roc_auc
FROM (SELECT {by_select}count(*) FILTER (y = 1 AND y_pred = 1) AS tp,
             count(*) FILTER (y = 0 AND y_pred = 1) AS fp,
             count(*) FILTER (y = 1 AND y_pred = 0) AS fn,
             count(*) FILTER (y = 0 AND y_pred = 0) AS tn
      FROM {source} {"GROUP BY " + by if by else ""})"""


@query(
    "classifier_metrics",
    WITH
    + ", d AS (SELECT lang, y, CASE WHEN by_length >= 0.48 THEN 1 ELSE 0 END AS y_pred FROM scored)"
    + _metrics_sql("d", "lang"),
)
def classifier_metrics(spark, sf_dir):
    rows = evaluate.with_decision(fx.scored(spark, sf_dir), "by_length", ml.PRODUCTION_THRESHOLD)
    return evaluate.classifier_metrics(rows, by=["lang"])


def _curve_sql(score):
    return (
        WITH
        + f""",
g AS (SELECT {score} AS threshold, CAST(sum(y) AS BIGINT) AS pos, CAST(sum(1 - y) AS BIGINT) AS neg
      FROM scored GROUP BY 1),
c AS (
  SELECT threshold, pos, neg, CAST(sum(pos) OVER w AS DOUBLE) AS tp, CAST(sum(neg) OVER w AS DOUBLE) AS fp,
         CAST(sum(pos) OVER () AS DOUBLE) AS p, CAST(sum(neg) OVER () AS DOUBLE) AS n,
         lead(pos) OVER w AS next_pos, lead(neg) OVER w AS next_neg, row_number() OVER w AS rn
  FROM g WINDOW w AS (ORDER BY threshold DESC)
)"""
    )


@query(
    "roc_curve",
    _curve_sql("by_length")
    + """
SELECT threshold, fp / n AS fpr, tp / p AS tpr FROM c
WHERE rn = 1 OR next_pos IS NULL OR next_pos <> pos OR next_neg <> neg
UNION ALL SELECT 'inf'::DOUBLE, 0, 0""",
)
def roc_curve(spark, sf_dir):
    return evaluate.roc_curve(fx.scored(spark, sf_dir), score="by_length")


@query(
    "pr_curve",
    _curve_sql("by_length")
    + ' SELECT threshold, tp / (tp + fp) AS "precision", tp / p AS recall FROM c',
)
def pr_curve(spark, sf_dir):
    return evaluate.pr_curve(fx.scored(spark, sf_dir), score="by_length")


@query(
    "auc_score",
    _curve_sql("by_length")
    + " SELECT CAST(sum(neg * (2 * tp - pos)) AS DOUBLE) / (2 * max(p) * max(n)) AS auc FROM c",
)
def auc_score(spark, sf_dir):
    return evaluate.auc_score(fx.scored(spark, sf_dir), score="by_length")


IMPLIED = "1 - odds_a / (odds_a + odds_b)"
GUESS = "CASE WHEN substr(sha1(concat_ws('_', doc_id, '15')), 1, 1) >= '8' THEN 1 ELSE 0 END"


@query(
    "odds_baseline",
    WITH
    + f" SELECT doc_id, {IMPLIED} AS score, CASE WHEN {IMPLIED} >= 0.5 THEN 1 ELSE 0 END AS y_pred"
    " FROM scored",
)
def odds_baseline(spark, sf_dir):
    rows = evaluate.odds_baseline(fx.scored(spark, sf_dir), "odds_a", "odds_b")
    return rows.select("doc_id", "score", "y_pred")


@query("random_baseline", WITH + f" SELECT doc_id, y, {GUESS} AS y_pred FROM scored")
def random_baseline(spark, sf_dir):
    return evaluate.random_guess(fx.scored(spark, sf_dir), "doc_id").select("doc_id", "y", "y_pred")


MODELS_SQL = f""",
called AS (
  SELECT 'Baseline - Random' AS model, y, {GUESS} AS y_pred FROM scored
  UNION ALL SELECT 'Baseline - Odds', y, CASE WHEN {IMPLIED} >= 0.5 THEN 1 ELSE 0 END FROM scored
  UNION ALL SELECT 'By length', y, CASE WHEN by_length >= 0.48 THEN 1 ELSE 0 END FROM scored
  UNION ALL SELECT 'By toxicity', y, CASE WHEN by_toxicity >= 0.52 THEN 1 ELSE 0 END FROM scored
)"""


@query("model_leaderboard", WITH + MODELS_SQL + _metrics_sql("called", "model"))
def model_leaderboard(spark, sf_dir):
    rows = fx.scored(spark, sf_dir)
    called = {
        "Baseline - Random": evaluate.random_guess(rows, "doc_id"),
        "Baseline - Odds": evaluate.odds_baseline(rows, "odds_a", "odds_b"),
        "By length": evaluate.with_decision(rows, "by_length", 0.48),
        "By toxicity": evaluate.with_decision(rows, "by_toxicity", 0.52),
    }
    union = reduce(
        lambda a, b: a.unionByName(b),
        [df.select(F.lit(name).alias("model"), "y", "y_pred") for name, df in called.items()],
    )
    return evaluate.leaderboard(evaluate.classifier_metrics(union, by=["model"]))


# --- models: the home side's win from both sides' form before the match

NUMERIC = ["home_matches", "home_wins", "home_win_pctg", "game_month"]
CATEGORICAL = ["season", "home_team_code", "visiting_team_code"]
CUTOFF = "2000-06-01"


def model_rows(spark, sf_dir):
    """Played matches with the home side's form, the label and the match key."""
    games = fx.labelled(spark, sf_dir).select(
        *fx.MATCH_KEY, "game_source_id", "eastern_start_time", "game_date", "season", "game_month",
        "home_team_code", "visiting_team_code", "home_team_winner",
    )
    formed = features.home_form(games, fx.MATCH_ORDER)
    return formed.filter(F.col("home_team_winner").isNotNull()).select(
        "game_source_id",
        "game_date",
        *[F.col(c).cast("double").alias(c) for c in NUMERIC],
        *[F.col(c).cast("string").alias(c) for c in CATEGORICAL],
        F.col("home_team_winner").cast("double").alias("label"),
    )


def split_rows(spark, rows):
    """Training and hold-out part of ``rows``, read from one table: the joins and running sums below them run once."""
    store = scratch_store(spark)
    store.overwrite(rows, "model_rows")
    return features.split_by_date(store.read("model_rows"), "game_date", CUTOFF)


def trained(spark, sf_dir, classifier):
    """``(model, test rows)``."""
    train, test = split_rows(spark, model_rows(spark, sf_dir))
    return ml.fit(train, NUMERIC, CATEGORICAL, classifier), test


# What SQL can state of a model: its hold-out rows with their labels, scores in range, decisions that follow them.
SCORES_SQL = (
    "WITH"
    + fx.LABELLED_SQL
    + f"""
SELECT game_source_id, strftime(game_date, '%Y-%m-%d') AS game_date, home_team_winner::DOUBLE AS label,
       true AS score_in_range, true AS decision_follows
FROM labelled WHERE game_date >= DATE '{CUTOFF}' AND home_team_winner IS NOT NULL"""
)


def _scores(spark, sf_dir, classifier, threshold, is_probability=True):
    """Every hold-out row scored, with what must hold for its score and decision."""
    model, test = trained(spark, sf_dir, classifier)
    return _checked_scores(ml.score(model, test, threshold), threshold, is_probability)


def stored_scores(spark, scored):
    """``scored`` from a table: the kernel machine's cosines are made by numpy, once, and what reads the scores has no Python."""
    store = scratch_store(spark)
    store.overwrite(scored, "scores")
    return store.read("scores")


def _checked_scores(scored, threshold, is_probability=True):
    score = F.col("score")
    in_range = score.between(0, 1) if is_probability else ~F.isnan(score) & (F.abs(score) < float("inf"))
    return iso_dates(
        scored.select(
            "game_source_id", "game_date", "label",
            in_range.alias("score_in_range"),
            ((score >= threshold) == (F.col("y_pred") == 1)).alias("decision_follows"),
        )
    )


@query("train_logistic", SCORES_SQL)
def train_logistic(spark, sf_dir):
    return _scores(spark, sf_dir, ml.logistic, 0.5)


@query("train_svm", SCORES_SQL)
def train_svm(spark, sf_dir):
    return _scores(spark, sf_dir, ml.svm(), 0.0, is_probability=False)


@query("train_kernel_svm", SCORES_SQL)
def train_kernel_svm(spark, sf_dir):
    """The support vector machine with a Gaussian kernel and probabilities."""
    train, test = split_rows(spark, model_rows(spark, sf_dir))
    model = kernel.fit_kernel_svm(train, NUMERIC, CATEGORICAL)
    scored = ml.score(model, test, 0.52).select("game_source_id", "game_date", "label", "score", "y_pred")
    return _checked_scores(stored_scores(spark, scored), 0.52)


@query("train_gbt", SCORES_SQL)
def train_gbt(spark, sf_dir):
    return _scores(spark, sf_dir, ml.boosted_trees(), 0.52)


@query(
    "feature_importance",
    "SELECT * FROM (VALUES "
    + ", ".join(f"('{c}', true, 1.0::DOUBLE)" for c in [*NUMERIC, *CATEGORICAL])
    + ") AS t(feature, not_negative, total)",
)
def feature_importance(spark, sf_dir):
    """The features by importance, none negative, and what all of them add up to."""
    model, _ = trained(spark, sf_dir, ml.boosted_trees())
    found = ml.top_features(ml.feature_importance(model, NUMERIC, CATEGORICAL, spark))
    total = F.sum("feature_importance").over(Window.partitionBy())  # one row per feature
    return found.select(
        "feature", (F.col("feature_importance") >= 0).alias("not_negative"), F.round(total, 6).alias("total")
    )


@query("model_comparison")
def model_comparison(spark, sf_dir):
    """Hold-out metrics of each model at its threshold next to the random baseline, best first."""
    train, test = split_rows(spark, model_rows(spark, sf_dir))
    called = {"Baseline - Random": (evaluate.random_guess(test, "game_source_id"), None)}
    # All models read the same rows: they are dealt out, kept and preprocessed once.
    with ml.kept_evenly(train.select(*NUMERIC, *CATEGORICAL, "label")) as kept:
        prepared = ml.prepare(kept, NUMERIC, CATEGORICAL)
        for name, classifier, threshold in (
            ("Logistic Regression", ml.logistic, 0.5),
            ("Boosted Trees", ml.boosted_trees(), 0.52),
            ("Support Vector Machine", ml.svm(), 0.0),
        ):
            model = ml.fit(kept, NUMERIC, CATEGORICAL, classifier, prepared)
            called[name] = (ml.score(model, test, threshold), threshold)
        model = kernel.fit_kernel_svm(kept, NUMERIC, CATEGORICAL, prepared=prepared)
    scored = ml.score(model, test, 0.52).select("label", "y_pred")
    called["Kernel Support Vector Machine"] = (stored_scores(spark, scored), 0.52)
    union = reduce(
        lambda a, b: a.unionByName(b),
        [
            df.select(
                F.lit(name).alias("model"), F.lit(cut).cast("double").alias("threshold"),
                F.col("label").cast("int").alias("y"), "y_pred",
            )
            for name, (df, cut) in called.items()
        ],
    )
    return evaluate.leaderboard(evaluate.classifier_metrics(union, by=["model", "threshold"]))


# --- Newton trees: the rows as SQL, the statistics of categories by earlier rows, and three small trees in SQL

STATISTIC_ORDER = ["game_date", "game_source_id"]
MODEL_ROWS_SQL = f"""
formed AS (
  SELECT game_source_id, game_date, season, home_team_code, visiting_team_code, home_team_winner AS y,
         month(game_date)::DOUBLE AS game_month,
         coalesce(sum(CASE WHEN home_team_winner IS NULL THEN 0 ELSE 1 END) OVER w, 0)::DOUBLE AS home_matches,
         sum(home_team_winner) OVER w::DOUBLE
           / nullif(sum(CASE WHEN home_team_winner IS NULL THEN 0 ELSE 1 END) OVER w, 0)::DOUBLE AS home_win_pctg
  FROM labelled
  WINDOW w AS (PARTITION BY home_team_code, season ORDER BY {", ".join(fx.MATCH_ORDER)}
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
model_rows AS (SELECT *, game_date < DATE '{CUTOFF}' AS trains FROM formed WHERE y IS NOT NULL)"""
_BEFORE = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"


def _statistic_sql(c):
    """The statistic of ``c`` by earlier training rows."""
    w = f"OVER (PARTITION BY {c} ORDER BY {', '.join(STATISTIC_ORDER)} {_BEFORE})"
    return f"(coalesce(sum(y) {w}, 0) + {boost.PRIOR} * {boost.PRIOR_WEIGHT})::DOUBLE / (count(*) {w} + {boost.PRIOR_WEIGHT})"


@query(
    "ordered_category_statistics",
    "WITH"
    + fx.LABELLED_SQL
    + ","
    + MODEL_ROWS_SQL
    + "SELECT game_source_id, "
    + ", ".join(f"{_statistic_sql(c)} AS {c}_before" for c in CATEGORICAL)
    + " FROM model_rows WHERE trains",
)
def ordered_category_statistics(spark, sf_dir):
    """Each training match with the home wins among the earlier ones of its season and of either team."""
    narrow = model_rows(spark, sf_dir).select(*STATISTIC_ORDER, *CATEGORICAL, "label")
    train, _ = split_rows(spark, narrow)
    out = boost.ordered_statistics(train, CATEGORICAL, STATISTIC_ORDER)
    return out.select("game_source_id", *[f"{c}_before" for c in CATEGORICAL])


# Cuts, rounds and levels of the trees that SQL repeats; the other settings are those of the production model.
SMALL_NUMERIC = {
    "home_matches": [5.0, 20.0, 60.0, 150.0],
    "home_win_pctg": [0.3, 0.45, 0.5, 0.55, 0.7],
    "game_month": [3.0, 6.0, 9.0],
}
SMALL_CATEGORICAL = ["home_team_code", "visiting_team_code"]
SMALL_ROUNDS, SMALL_DEPTH, SMALL_STEP = 3, 2, 0.5


def _bin_sql(value, borders):
    return f"CASE WHEN {value} IS NULL THEN 0 ELSE 1 + " + " + ".join(f"({value} > {b})::INT" for b in borders) + " END"


def _small_trees_sql():
    """Rounds and levels one after the other: sums by node, feature and bin, the best cut, the next level's nodes."""
    even = [(i + 1) / (boost.CATEGORY_CUTS + 1) for i in range(boost.CATEGORY_CUTS)]
    numbers = [_bin_sql(c, borders) for c, borders in SMALL_NUMERIC.items()]
    widths = [len(b) + 1 for b in SMALL_NUMERIC.values()] + [len(even) + 1] * len(SMALL_CATEGORICAL)
    known = lambda c: f"(sum(y) + {boost.PRIOR} * {boost.PRIOR_WEIGHT})::DOUBLE / (count(*) + {boost.PRIOR_WEIGHT})"
    parts = [
        "stat_train AS MATERIALIZED (SELECT *, "
        + ", ".join(f"{_statistic_sql(c)} AS s_{c}" for c in SMALL_CATEGORICAL)
        + " FROM model_rows WHERE trains)"
    ]
    parts += [
        f"all_{c} AS (SELECT {c}, {known(c)} AS s_{c} FROM model_rows WHERE trains GROUP BY {c})" for c in SMALL_CATEGORICAL
    ]
    joins = " ".join(f"LEFT JOIN all_{c} USING ({c})" for c in SMALL_CATEGORICAL)
    unseen = ", ".join(f"coalesce(s_{c}, {boost.PRIOR}) AS s_{c}" for c in SMALL_CATEGORICAL)
    bins = ", ".join([*numbers, *[_bin_sql(f"s_{c}", even) for c in SMALL_CATEGORICAL]])
    cuts = ", ".join(f"({f}, {k})" for f, width in enumerate(widths) for k in range(width))
    parts += [
        f"stat_test AS (SELECT m.*, {unseen} FROM model_rows m {joins} WHERE NOT trains)",
        "told AS (SELECT * FROM stat_train UNION ALL SELECT * FROM stat_test)",
        f"cuts(f, k) AS (VALUES {cuts})",
        f"r0 AS MATERIALIZED (SELECT game_source_id, game_date, y, trains, [{bins}] AS bins, 0.0::DOUBLE AS margin FROM told)",
    ]
    side = lambda what, test: f"coalesce(sum({what}) FILTER (bin {test} k), 0)"
    term = lambda test: f"{side('g', test)} ** 2 / ({side('h', test)} + {boost.L2})"
    for r in range(SMALL_ROUNDS):
        parts.append(f"n{r}_0 AS MATERIALIZED (SELECT *, 1 / (1 + exp(-margin)) AS p, 0 AS node FROM r{r})")
        for level in range(SMALL_DEPTH):
            at = f"{r}_{level}"
            parts += [
                f"h{at} AS MATERIALIZED (SELECT node, f, bin, sum(g) AS g, sum(h) AS h FROM (SELECT node, y - p AS g, p * (1 - p) AS h, "
                f"unnest(bins) AS bin, unnest({list(range(len(widths)))}) AS f FROM n{at} WHERE trains) GROUP BY ALL)",
                f"c{at} AS MATERIALIZED (SELECT f, k FROM (SELECT f, k, node, {term('<=')} + {term('>')} AS gain "
                f"FROM h{at} JOIN cuts USING (f) GROUP BY ALL) GROUP BY f, k ORDER BY round(sum(gain), 9) DESC, f, k LIMIT 1)",
                f"n{r}_{level + 1} AS MATERIALIZED (SELECT n.* REPLACE (node + CASE WHEN bins[f + 1] > k THEN {1 << level} "
                f"ELSE 0 END AS node) FROM n{at} n, c{at})",
            ]
        last = f"n{r}_{SMALL_DEPTH}"
        parts += [
            f"l{r} AS (SELECT node, {SMALL_STEP} * sum(y - p) / (sum(p * (1 - p)) + {boost.L2}) AS leaf "
            f"FROM {last} WHERE trains GROUP BY node)",
            f"r{r + 1} AS MATERIALIZED (SELECT game_source_id, game_date, y, trains, bins, margin + coalesce(leaf, 0) AS margin "
            f"FROM {last} LEFT JOIN l{r} USING (node))",
        ]
    return (
        "WITH" + fx.LABELLED_SQL + "," + MODEL_ROWS_SQL + ",\n" + ",\n".join(parts) + f"""
SELECT game_source_id, strftime(game_date, '%Y-%m-%d') AS game_date, y::DOUBLE AS label,
       round(1 / (1 + exp(-margin)), 6) AS score, CASE WHEN 1 / (1 + exp(-margin)) >= 0.5 THEN 1 ELSE 0 END AS y_pred
FROM r{SMALL_ROUNDS} WHERE NOT trains"""
    )


@query("newton_trees_small", _small_trees_sql())
def newton_trees_small(spark, sf_dir):
    """Hold-out scores of three trees of two levels."""
    train, test = split_rows(spark, model_rows(spark, sf_dir))
    settings = boost.NewtonBoosting(
        tuple(STATISTIC_ORDER), rounds=SMALL_ROUNDS, depth=SMALL_DEPTH, step=SMALL_STEP, borders=SMALL_NUMERIC
    )
    model = ml.fit(train, list(SMALL_NUMERIC), SMALL_CATEGORICAL, settings)
    scored = ml.score(model, test, 0.5)
    return iso_dates(scored.select("game_source_id", "game_date", "label", F.round("score", 6).alias("score"), "y_pred"))


@query(
    "merge_predictions",
    "WITH"
    + fx.LABELLED_SQL
    + f"""
SELECT game_source_id, strftime(game_date, '%Y-%m-%d') AS game_date,
       CASE WHEN game_date < DATE '{CUTOFF}' THEN 0.25 ELSE 0.75 END::DOUBLE AS home_team_win_proba,
       CASE WHEN game_date < DATE '{CUTOFF}' THEN 0 ELSE 1 END AS home_team_win
FROM labelled""",
)
def merge_predictions(spark, sf_dir):
    """Predictions of an earlier run for every match, those from the cutoff on made anew."""
    games = fx.matches(spark, sf_dir).select("game_source_id", "game_date")

    def run(rows, proba):
        return rows.withColumn("home_team_win_proba", F.lit(proba)).withColumn(
            "home_team_win", (F.col("home_team_win_proba") >= ml.PRODUCTION_THRESHOLD).cast("int")
        )

    new = features.split_by_date(games, "game_date", CUTOFF)[1]
    return iso_dates(ml.merge_predictions(run(games, 0.25), run(new, 0.75), "game_date", CUTOFF))


