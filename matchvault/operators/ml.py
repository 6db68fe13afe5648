"""Win-probability models on Spark ML: preprocessing, three classifiers, scoring, predictions."""

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LinearSVC, LogisticRegression
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from matchvault.functions import decide
from matchvault.operators import trees

# Training settings the results are compared under.
SEED = 17
INVERSE_L1 = 0.1
DEPTH = 6
PRODUCTION_THRESHOLD = 0.48
TOP_FEATURES = 80
ROWS_PER_TASK = 250_000
# Boosted trees are grown by Spark up to here, where a level's fixed cost is most of it, and on packed blocks beyond.
ROWS_IN_SPARK = 2_000_000


def preprocessing(numeric, categorical):
    """Scaled numbers and one-hot categories; a category unseen in training becomes all zeros.

    Categories are named columns with few values (season, team, month): their distinct values are
    what the indexer keeps.
    """
    stages, blocks = [], []
    if numeric:
        filled = [f"{c}_filled" for c in numeric]
        stages += [
            Imputer(inputCols=list(numeric), outputCols=filled, strategy="mean"),
            VectorAssembler(inputCols=filled, outputCol="numbers"),
            StandardScaler(inputCol="numbers", outputCol="scaled", withMean=True),
        ]
        blocks.append("scaled")
    if categorical:
        indexed = [f"{c}_index" for c in categorical]
        hot = [f"{c}_hot" for c in categorical]
        stages += [
            StringIndexer(
                inputCols=list(categorical), outputCols=indexed, handleInvalid="keep",
                stringOrderType="alphabetAsc",
            ),
            # The dropped last slot is the one the indexer keeps for unseen values.
            OneHotEncoder(inputCols=indexed, outputCols=hot, dropLast=True),
        ]
        blocks += hot
    stages.append(VectorAssembler(inputCols=blocks, outputCol="features"))
    return stages


def logistic(rows, label="label"):
    """L1 logistic regression; the penalty of a summed loss turned into one on the mean loss."""
    return LogisticRegression(
        labelCol=label, elasticNetParam=1.0, regParam=1.0 / (INVERSE_L1 * max(rows, 1)),
        standardization=False, maxIter=100,
    )


def svm(label="label"):
    """Linear support vector machine; it ranks by margin and gives no probability."""
    return LinearSVC(labelCol=label, maxIter=30, regParam=0.01, standardization=False)


def boosted_trees(label="label", rounds=20, step=0.1):
    """Boosted trees; fewer, larger steps than a single-machine trainer since each round is a job."""
    return GBTClassifier(labelCol=label, maxDepth=DEPTH, maxIter=rounds, stepSize=step, seed=SEED)


@contextmanager
def kept_evenly(train):
    """Yield the rows in parts of about ``ROWS_PER_TASK``.

    Each stage is a pass over the training rows, so they are kept once (spilling to disk) and a lost part is computed
    again. The parts are made even first: every pass repeats what a table or a window left uneven.
    """
    rows = train.count()
    parts = max(-(-rows // ROWS_PER_TASK), train.sparkSession.sparkContext.defaultParallelism)
    kept = train.repartition(parts).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()


def _read_by(classifier, train, names):
    """``train`` with the named columns and those that the classifier's settings name."""
    if not hasattr(classifier, "getLabelCol"):  # a pipeline or a search names its columns in its parts
        return train
    set_ = [classifier.getOrDefault(p) for p in classifier.params if classifier.isDefined(p)]
    wanted = {*names, *(v for v in set_ if isinstance(v, str))}
    return train.select(*[F.col(f"`{c}`") for c in train.columns if c in wanted])


def without_summary(model):
    """A fitted pipeline whose stages let go of their training summaries, as after saving and loading.

    A summary holds the session, and tasks that score are sent it with the model: they fail once the session has
    observed a write, as table stores do.
    """
    for stage in model.stages:
        if getattr(stage, "hasSummary", False):
            stage._java_obj.setSummary(SparkSession.active()._jvm.scala.Option.empty())
    return model


def prepare(kept, numeric, categorical):
    """The fitted preprocessing of rows that are kept, for several models of them."""
    return Pipeline(stages=preprocessing(numeric, categorical)).fit(kept)


def fit(train, numeric, categorical, classifier, prepared=None):
    """Fitted pipeline; ``classifier`` may be a function of the number of training rows, or fit the rows itself.

    With ``prepared``, the rows are already kept evenly, and that is their preprocessing.
    """
    if hasattr(classifier, "fit_rows"):
        with kept_evenly(train) as kept:
            return classifier.fit_rows(kept, numeric, categorical)
    if callable(classifier):
        classifier = classifier(train.count())
    if prepared is not None:
        return _fitted(prepared, train, numeric, categorical, classifier)
    with kept_evenly(_read_by(classifier, train, [*numeric, *categorical])) as kept:
        return _fitted(prepare(kept, numeric, categorical), kept, numeric, categorical, classifier)


def _fitted(prepared, kept, numeric, categorical, classifier):
    if trees.grows(classifier) and kept.count() > ROWS_IN_SPARK:
        model = trees.fit_prepared(prepared, kept, numeric, categorical, classifier)
        if model is not None:
            return PipelineModel(stages=[*prepared.stages, model])
    return without_summary(Pipeline(stages=[*prepared.stages, classifier]).fit(kept))


def score(model, df, threshold=PRODUCTION_THRESHOLD):
    """Each row with its win probability (or margin) and the decision; keys stay on the row."""
    out = model.transform(df)
    if "probability" in out.columns:
        value, cut = vector_to_array("probability")[1], threshold
    else:
        value, cut = vector_to_array("rawPrediction")[1], 0.0
    out = out.withColumn("score", value).withColumn("y_pred", decide("score", cut))
    return out.select(*df.columns, "score", "y_pred")


def feature_importance(model, numeric, categorical, spark):
    """Importance per input column, one-hot slots added up to their column."""
    last = model.stages[-1]
    if hasattr(last, "importances"):
        return spark.createDataFrame(last.importances(), "feature string, feature_importance double")
    weights = (
        last.featureImportances.toArray()
        if hasattr(last, "featureImportances")
        else [abs(v) for v in last.coefficients.toArray()]
    )
    widths = [(c, 1) for c in numeric]
    if categorical:
        indexer = next(s for s in model.stages if hasattr(s, "labelsArray"))
        widths += [(c, len(v)) for c, v in zip(categorical, indexer.labelsArray)]
    rows, at = [], 0
    for name, width in widths:
        rows.append((name, float(sum(weights[at : at + width]))))
        at += width
    return spark.createDataFrame(rows, "feature string, feature_importance double")


def top_features(importance, n=TOP_FEATURES):
    """The ``n`` most important features."""
    return importance.orderBy(F.desc("feature_importance"), "feature").limit(n)


def merge_predictions(old, new, date, cutoff):
    """Stored predictions from before the cutoff, or without a date, and the new ones from it on."""
    late = F.coalesce(F.col(date) >= F.lit(cutoff).cast(old.schema[date].dataType), F.lit(False))
    return old.filter(~late).unionByName(new, allowMissingColumns=True)
