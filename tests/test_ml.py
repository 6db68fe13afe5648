import random
from datetime import date

import pytest
from conftest import rows
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from matchvault.operators import evaluate, kernel, ml, packed, trees


@pytest.fixture(scope="module")
def training(spark):
    rnd = random.Random(8)
    data = []
    for i in range(600):
        x, noise, team = rnd.gauss(0, 1), rnd.gauss(0, 1), rnd.choice(["A", "B", "C"])
        label = float(x + (1.0 if team == "A" else 0.0) + rnd.gauss(0, 0.3) > 0.3)
        data.append((i, None if i % 50 == 0 else x, noise, team, label))
    return spark.createDataFrame(data, "id int, x double, noise double, team string, label double")


@pytest.mark.parametrize("make", [lambda n: ml.logistic(n), lambda n: ml.svm(), lambda n: ml.boosted_trees(rounds=3)])
def test_models_learn_and_ignore_unseen_values(spark, training, make):
    model = ml.fit(training, ["x", "noise"], ["team"], make(600))
    scored = ml.score(model, training)
    assert scored.columns == [*training.columns, "score", "y_pred"]
    metrics = evaluate.classifier_metrics(scored, y="label").first()
    assert metrics["accuracy"] > 0.85
    unseen = spark.createDataFrame([(1, 2.0, 0.0, "Z", 1.0), (2, None, 0.0, None, 0.0)], training.schema)
    assert ml.score(model, unseen).count() == 2
    table = ml.feature_importance(model, ["x", "noise"], ["team"], spark)
    assert [r["feature"] for r in ml.top_features(table, 2).collect()][0] in ("x", "team")
    assert table.count() == 3


def test_model_is_saved_and_loaded(spark, training, tmp_path):
    model = ml.fit(training, ["x", "noise"], ["team"], ml.logistic(600))
    model.write().overwrite().save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model"))
    assert rows(ml.score(again, training)) == rows(ml.score(model, training))


def test_kernel_machine_learns_a_ring(spark, tmp_path):
    """A disc inside a ring, which no line divides; probabilities agree with the shares of wins."""
    rnd, data = random.Random(4), []
    for i in range(900):
        x, y = rnd.uniform(-2, 2), rnd.uniform(-2, 2)
        data.append((i, x, y, rnd.choice("AB"), float(x * x + y * y + rnd.gauss(0, 0.3) < 1.6)))
    rows_ = spark.createDataFrame(data, "id int, x double, y double, team string, label double")
    train, test = rows_.filter("id % 3 > 0"), rows_.filter("id % 3 = 0")
    model = kernel.fit_kernel_svm(train, ["x", "y"], ["team"])
    scored = ml.score(model, test, 0.5)
    assert scored.columns == [*test.columns, "score", "y_pred"] and scored.filter("score BETWEEN 0 AND 1").count() == 300
    found = evaluate.classifier_metrics(scored, y="label").first()
    linear = ml.score(ml.fit(train, ["x", "y"], ["team"], ml.svm()), test)
    guess = evaluate.random_guess(test, "id")
    assert found["accuracy"] > 0.85
    for other in (linear, guess):
        assert found["accuracy"] > evaluate.classifier_metrics(other, y="label").first()["accuracy"] + 0.15
    for low, high in ((0, 0.2), (0.8, 1.001)):
        share, mean = scored.filter(f"score >= {low} AND score < {high}").agg(F.avg("label"), F.avg("score")).first()
        assert abs(share - mean) < 0.15
    model.write().overwrite().save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model"))
    assert rows(ml.score(again, test, 0.5)) == rows(scored)


def test_kernel_width_and_features(spark):
    """The width is that of the entries, and inner products of the features are near the kernel."""
    import numpy as np
    from pyspark.ml.linalg import Vectors

    x = np.random.default_rng(1).normal(1, 2, (40, 3))
    df = spark.createDataFrame([(i, Vectors.dense(v)) for i, v in enumerate(x.tolist())], ["id", "features"])
    gamma, width = kernel.kernel_width(df, "features")
    assert width == 3 and abs(gamma - 1 / (3 * x.var())) < 1e-9
    out = kernel.FourierFeatures(inputCol="features", outputCol="z", gamma=gamma, width=3, dimensions=2000).transform(df)
    z = np.array([r.z.toArray() for r in out.orderBy("id").collect()])
    want = np.exp(-gamma * ((x[:, None] - x[None]) ** 2).sum(-1))
    assert np.abs(z @ z.T - want).max() < 0.12


def test_merge_predictions(spark):
    schema = "id int, game_date date, p double"
    old = spark.createDataFrame([(1, date(2024, 1, 1), 0.1), (2, date(2024, 1, 3), 0.2)], schema)
    new = spark.createDataFrame([(2, date(2024, 1, 3), 0.9), (3, date(2024, 1, 4), 0.8)], schema)
    got = ml.merge_predictions(old, new, "game_date", "2024-01-02")
    assert rows(got, "id", "p") == [(1, 0.1), (2, 0.9), (3, 0.8)]
    assert got.filter(F.col("p").isNull()).count() == 0


def test_fitted_rows_are_in_even_parts(spark, training, monkeypatch):
    """A part holds no more rows than planned, however uneven the table, and only columns that the model reads."""
    seen = []

    class Sizes:
        def fit_rows(self, train, numeric, categorical):
            seen.extend(r["count"] for r in train.groupBy(F.spark_partition_id()).count().collect())

    monkeypatch.setattr(ml, "ROWS_PER_TASK", 50)
    ml.fit(training.coalesce(1), ["x"], [], Sizes())
    assert sum(seen) == 600 and max(seen) <= 55
    read = ml._read_by(ml.svm(), training, ["x"])
    assert read.columns == ["x", "label"]


def test_models_score_after_an_observed_write(spark, training):
    """A session that has observed a write cannot be sent to tasks, and a training summary holds it."""
    from pyspark.sql import Observation

    seen = Observation()
    training.observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 600
    for classifier in (ml.logistic(600), ml.svm()):
        assert ml.score(ml.fit(training, ["x"], ["team"], classifier), training).filter("score IS NULL").count() == 0
    model = kernel.fit_kernel_svm(training, ["x"], ["team"], dimensions=8)
    assert ml.score(model, training).filter("score BETWEEN 0 AND 1").count() == 600


def test_fourier_features_by_batch(spark):
    """Features equal the formula row for row, in batches of any size, with NULL kept; they are not interpreted."""
    import numpy as np
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.linalg import Vectors, VectorUDT
    from pyspark.sql.types import IntegerType, StructField, StructType

    step = kernel.FourierFeatures(inputCol="x", outputCol="z", gamma=0.5, width=3, dimensions=5)
    data = [(i, None if i == 7 else Vectors.sparse(3, {0: i / 9.0, 2: float(i % 2)})) for i in range(1300)]
    df = spark.createDataFrame(data, StructType([StructField("id", IntegerType()), StructField("x", VectorUDT())])).repartition(3)
    plan = step.transform(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "ArrowEvalPython" in plan and "lambda" not in plan
    rnd = np.random.default_rng(ml.SEED)
    w, b = rnd.normal(0, 1.0, (5, 3)), rnd.uniform(0, 2 * np.pi, 5)
    for r in step.transform(df.filter("x IS NOT NULL")).collect():
        assert np.allclose(r.z.toArray(), np.sqrt(2 / 5) * np.cos(w @ r.x.toArray() + b))
    assert step.transform(df.filter("x IS NULL")).select(vector_to_array("x")).count() == 1


def test_kernel_machine_is_sparks_on_rows_of_some_bytes(spark, training):
    """The same weights as a machine fitted on kept cosines, from blocks of 18 bytes a row instead of 32 doubles."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LinearSVC

    prepared = Pipeline(stages=ml.preprocessing(["x", "noise"], ["team"])).fit(training)
    gamma, width = kernel.kernel_width(prepared.transform(training), "features")
    cosines = kernel.FourierFeatures(inputCol="features", outputCol="cosines", gamma=gamma, width=width, dimensions=32)
    machine = LinearSVC(featuresCol="cosines", maxIter=100, tol=1e-3, regParam=1 / 600, standardization=False)
    shape = packed.Shape(prepared, ["x", "noise"], ["team"])
    unseen = training.withColumn("team", F.when(F.col("id") % 7 > 0, F.col("team")))  # in no slot
    with packed.packed(prepared, unseen, shape, "label") as (blocks, rows_):
        assert rows_ == 600
        assert blocks.selectExpr("sum(length(numbers) + length(codes) + length(labels))").first()[0] == 600 * (16 + 1 + 1)
        found = kernel.fit_machine(machine, cosines, blocks, rows_, shape)
    wanted = machine.fit(cosines.transform(prepared.transform(unseen)))
    assert max(abs(found.coefficients.toArray() - wanted.coefficients.toArray())) < 1e-9
    assert abs(found.intercept - wanted.intercept) < 1e-9


def test_packed_trees_are_sparks(spark, training, monkeypatch, tmp_path):
    """Trees grown on packed blocks have the cuts, leaves, gains and scores of those that Spark grows on the vectors."""
    numeric, categorical = ["x", "noise"], ["team"]
    ours = training.withColumn("team", F.when(F.col("id") % 7 > 0, F.col("team")))
    settings = dict(rounds=4, step=0.3)
    with ml.kept_evenly(ours) as kept:
        prepared = ml.prepare(kept, numeric, categorical)
        wanted = ml.fit(kept, numeric, categorical, ml.boosted_trees(**settings).setMaxDepth(3), prepared)
        monkeypatch.setattr(ml, "ROWS_IN_SPARK", 0)
        monkeypatch.setattr(packed, "ROWS_PER_BLOCK", 50)
        calls, grown = [], trees.fit_prepared
        monkeypatch.setattr(trees, "fit_prepared", lambda *a: calls.append(1) or grown(*a))
        found = ml.fit(kept, numeric, categorical, ml.boosted_trees(**settings).setMaxDepth(3), prepared)
    assert calls and type(found.stages[-1]) is type(wanted.stages[-1])

    def told(model):  # lines of cuts, and numbers of leaves to nine digits
        lines = [line.split() for line in model.stages[-1].toDebugString.splitlines()[1:]]
        return [[f"{float(v):.9g}" if words[0] == "Predict:" and i else v for i, v in enumerate(words)] for words in lines]

    assert told(found) == told(wanted)
    gains = [m.stages[-1].featureImportances.toArray() for m in (found, wanted)]
    assert max(abs(gains[0] - gains[1])) < 1e-9
    scores = [dict(ml.score(m, ours).select("id", "score").collect()) for m in (found, wanted)]
    assert max(abs(scores[0][i] - scores[1][i]) for i in scores[1]) < 1e-9
    found.write().overwrite().save(str(tmp_path / "model"))
    assert rows(ml.score(PipelineModel.load(str(tmp_path / "model")), ours)) == rows(ml.score(found, ours))
