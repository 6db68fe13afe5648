"""Spark's boosted trees, grown on packed blocks.

Spark keeps an array of one bin per one-hot slot for every row and reads it once a level. Here a row is one bin per number
and one index per category, whose slots' sums follow from the sums by index. Cuts, gains, leaves and weights are those of
``GBTClassifier``, and the result is its model.
"""

import numpy as np
import pyarrow as pa
from pyspark import SparkContext, StorageLevel
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchvault.operators.packed import SCHEMA, Shape, blocks_of, packed, reads, summed

STATE = SCHEMA + ", margins binary, residuals binary"
EPSILON = 2.0**-52
TIE = 1e-12


def grows(classifier):
    """Whether the settings of ``classifier`` are those that are known here."""
    if type(classifier) is not GBTClassifier or classifier.getFeaturesCol() != "features":
        return False
    plain = not any(classifier.isDefined(p) for p in (classifier.weightCol, classifier.validationIndicatorCol))
    every = classifier.getSubsamplingRate() == 1.0 and classifier.getFeatureSubsetStrategy() == "all"
    return plain and every and classifier.getMinWeightFractionPerNode() == 0.0


def fit_prepared(prepared, kept, numeric, categorical, classifier):
    """Spark's model of ``classifier``; None where the columns are not what it is made for."""
    shape, label = Shape(prepared, numeric, categorical), classifier.getLabelCol()
    cuts = _cuts(prepared.transform(kept), classifier, shape)
    if cuts is None:
        return None
    dtype = np.min_scalar_type(max([len(c) for c in cuts], default=0))

    def bins(numbers):
        return np.array([np.searchsorted(c, v) for c, v in zip(cuts, numbers.T)], dtype)

    with packed(prepared, kept, shape, label, bins) as (blocks, _):
        trees = _boosted(blocks, classifier, _Layout(cuts, shape, dtype))
    return _model(trees, classifier, shape)


def _cuts(rows, classifier, shape):
    """Spark's own cuts of the numbers, from its own sample; None where a slot of a category is not one of two values."""
    jvm = SparkContext._active_spark_context._jvm
    slots = jvm.org.apache.spark.ml.util.MetadataUtils.getCategoricalFeatures(rows._jdf.schema().apply("features"))
    if [i for i in range(shape.size) if slots.contains(i)] != [*range(shape.numbers, shape.size)]:
        return None
    if any(slots.apply(i) != 2 for i in range(shape.numbers, shape.size)):
        return None
    if not shape.numbers:
        return []

    def single(package, name):  # a Scala object
        return getattr(getattr(package, f"{name}$"), "MODULE$")

    # Which rows are drawn does not depend on the slots, so these are left out.
    numbers = rows.select(F.col("scaled").alias("features"), classifier.getLabelCol())
    classifier._transfer_params_to_java()
    tree, utils = jvm.org.apache.spark.ml.tree.impl, single(jvm.org.apache.spark.ml.util, "DatasetUtils")
    instances = utils.extractInstances(classifier._java_obj, numbers._jdf, jvm.scala.Option.apply(2))
    kind = jvm.org.apache.spark.mllib.tree.configuration.Algo.Classification()
    none = jvm.org.apache.spark.ml.util.MetadataUtils.getCategoricalFeatures(numbers._jdf.schema().apply("features"))
    strategy = classifier._java_obj.getOldBoostingStrategy(none, kind).treeStrategy()
    told = tree.DecisionTreeMetadata.buildMetadata(instances, strategy)
    splits = single(tree, "RandomForest").findSplits(instances, told, classifier.getSeed())
    return [np.array([s.threshold() for s in splits[i]]) for i in range(shape.numbers)]


class _Layout:
    """Columns of a block, numbers before categories, and where the sums of their cells are in a node's part."""

    def __init__(self, cuts, shape, dtype):
        self.cuts, self.starts, self.dtypes = cuts, shape.starts, (dtype, shape.dtype)
        self.widths = [*[len(c) + 1 for c in cuts], *[w + 1 for w in shape.widths]]
        self.ends = np.cumsum(self.widths).tolist()
        self.cells = sum(self.widths)

    def columns(self, block):
        n, k = block["n"], len(self.cuts)
        numbers, codes = (np.frombuffer(block[c], t) for c, t in zip(("numbers", "codes"), self.dtypes))
        return [*numbers.reshape(k, n), *codes.reshape(len(self.widths) - k, n)]


class _Node:
    """A node of a growing tree: rows, sum and sum of squares; once cut, the column, the cells that go right, and its children."""

    def __init__(self, sums, depth, classifier):
        self.sums, self.gain, self.valid, self.children = sums, None, True, None
        self.open = depth == 0 or (depth < classifier.getMaxDepth() and abs(_variance(*sums)) >= EPSILON)


def _variance(n, total, squares):
    return (squares - total * total / n) / n


def _rules(root):
    """The cuts so far as arrays by node, children after each other, for ``_places``."""
    nodes = [root]
    for node in nodes:
        nodes.extend(node.children or ())
    at = {id(node): i for i, node in enumerate(nodes)}
    widest = max((len(n.right) for n in nodes if n.children), default=1)
    column, first, right = np.full(len(nodes), -1), np.zeros(len(nodes), int), np.zeros((len(nodes), widest), bool)
    for i, node in enumerate(nodes):
        if node.children:
            column[i], first[i] = node.column, at[id(node.children[0])]
            right[i, : len(node.right)] = node.right
    return nodes, column, first, right


def _places(columns, n, column, first, right):
    """The node without children that each row falls into."""
    at, moving = np.zeros(n, np.intp), None
    flat, inner, widest, right = np.concatenate(columns), column >= 0, right.shape[1], right.ravel()
    rows = np.arange(n)
    while inner[at if moving is None else at[moving]].any():
        if moving is not None or not inner[at].all():
            moving = rows[inner[at]] if moving is None else moving[inner[at[moving]]]
        here, its = (at, rows) if moving is None else (at[moving], moving)
        to = first[here] + right[here * widest + flat[column[here] * n + its]]
        if moving is None:
            at = to
        else:
            at[moving] = to
    return at


def _boosted(blocks, classifier, layout):
    """``(root, weight)`` of each tree: the first fits the labels of -1 and 1, the others what the loss leaves."""
    trees, state = [], blocks
    try:
        for round_ in range(classifier.getMaxIter()):
            with reads(blocks):
                old, state = state, _advanced(_leaf(state), trees[-1:], layout).persist(StorageLevel.MEMORY_AND_DISK)
            root = _grown(state, classifier, layout)
            if old is not blocks:
                old.unpersist()
            trees.append((root, classifier.getStepSize() if round_ else 1.0))
    finally:
        if state is not blocks:
            state.unpersist()
    return trees


def _leaf(rows):
    """``rows`` with a plan of one node: plans would hold those of all rounds before. Lost parts are still made again."""
    session, made = rows.sparkSession, rows._jdf.queryExecution().toRdd()
    return DataFrame(session._jsparkSession.internalCreateDataFrame(made, rows._jdf.schema(), False), session)


def _advanced(state, last, layout):
    """Blocks with margins that the last tree is added to, and the residuals of the logistic loss there."""
    rules = []
    for root, weight in last:
        nodes, *rule = _rules(root)
        rules.append((rule, np.array([n.sums[1] / n.sums[0] for n in nodes]) * weight))

    def task(batches):
        for batch in batches:
            for block in blocks_of(batch):
                n, signs = block["n"], np.frombuffer(block["labels"], np.int8) * 2.0 - 1
                margins = np.frombuffer(block["margins"]) if "margins" in block else np.zeros(n)
                residuals = signs
                for rule, values in rules:
                    margins = margins + values[_places(layout.columns(block), n, *rule)]
                    with np.errstate(over="ignore"):
                        residuals = 4.0 * signs / (1.0 + np.exp(2.0 * signs * margins))
                data = {c: n if c == "n" else v.to_pybytes() for c, v in block.items()}
                data |= {"margins": margins.tobytes(), "residuals": residuals.tobytes()}
                yield pa.RecordBatch.from_arrays([pa.array([v]) for v in data.values()], list(data))

    return state.mapInArrow(task, STATE)


def _grown(state, classifier, layout):
    """The root of a tree of the residuals; a level is one pass, whose tasks send the sums by node, column and cell."""
    state = state.select("n", "numbers", "codes", "residuals")
    root = _Node(None, 0, classifier)
    for depth in range(classifier.getMaxDepth() + 1):
        nodes, column, first, right = _rules(root)
        part, todo = np.full(len(nodes), -1), [i for i, n in enumerate(nodes) if n.open and not n.children and n.gain is None]
        if not todo:
            break
        part[todo] = range(len(todo))

        def make(column=column, first=first, right=right, part=part, size=len(todo)):
            def sums(block):
                columns, n = layout.columns(block), block["n"]
                at, y = part[_places(columns, n, column, first, right)], np.frombuffer(block["residuals"])
                if (at < 0).any():
                    rows = np.flatnonzero(at >= 0)
                    at, y, columns = at[rows], y[rows], [c[rows] for c in columns]
                squares, out = y * y, []
                for c, width in zip(columns, layout.widths):
                    cell = at * width
                    cell += c
                    out.append([np.bincount(cell, w, size * width).reshape(size, width) for w in (None, y, squares)])
                return np.concatenate([np.array(o, float) for o in out], axis=2).ravel()

            return sums

        found = summed(state, make, 3 * len(todo) * layout.cells).reshape(3, len(todo), layout.cells)
        for i, node in enumerate(todo):
            _cut(nodes[node], found[:, i], depth, classifier, layout)
    return root


def _cut(node, sums, depth, classifier, layout):
    """Cut ``node`` where Spark does, at the first of the largest gains, if one is positive."""
    if node.sums is None:
        node.sums = tuple(sums[:, : layout.ends[0]].sum(1).tolist())
    sides, places = [np.zeros((2, 3, 0))], []
    for column, (width, end) in enumerate(zip(layout.widths, layout.ends)):
        cells = sums[:, end - width : end]
        below, above = np.cumsum(cells, 1), np.cumsum(cells[:, ::-1], 1)[:, ::-1]
        if column < len(layout.cuts):
            left, right = below[:, :-1], above[:, 1:]
            places += [(column, column, k) for k in range(width - 1)]
        else:  # a slot tells one value from all others; the lower mean goes left
            one, rest = cells[:, :-1], np.pad(below[:, :-2], ((0, 0), (1, 0))) + above[:, 1:]
            with np.errstate(divide="ignore", invalid="ignore"):
                means = [np.where(s[0] != 0, s[1] / s[0], np.inf) for s in (rest, one)]
            other = means[0] <= means[1]
            left, right = np.where(other, rest, one), np.where(other, one, rest)
            start = layout.starts[column - len(layout.cuts)]
            places += [(start + k, column, (k, bool(o))) for k, o in enumerate(other)]
        sides.append(np.array([left, right]))
    left, right = np.concatenate(sides, axis=2)
    impurity = _variance(*node.sums)
    with np.errstate(divide="ignore", invalid="ignore"):
        rows = left[0] + right[0]
        gains = impurity - left[0] / rows * _variance(*left) - right[0] / rows * _variance(*right)
    allowed = (np.minimum(left[0], right[0]) >= classifier.getMinInstancesPerNode()) & (gains >= classifier.getMinInfoGain())
    gains = np.where(allowed, gains, -np.inf)
    # Sums depend on the order in which rows are added up: of gains that differ by no more, the first is taken.
    best = int((gains >= gains.max() - TIE * impurity).argmax()) if len(gains) else 0
    node.valid = bool(len(gains)) and bool(allowed[best])
    node.gain = float(gains[best]) if node.valid else -np.inf
    if node.gain <= 0 or depth == classifier.getMaxDepth():
        return
    node.feature, node.column, cell = places[best]
    at = np.arange(layout.widths[node.column])
    if node.column < len(layout.cuts):
        node.cut, node.right = float(layout.cuts[node.column][cell]), at > cell
    else:
        # ``cut`` is the value of the slot that goes left
        node.cut, node.right = (0.0, at == cell[0]) if cell[1] else (1.0, at != cell[0])
    node.children = [_Node(tuple(s[:, best].tolist()), depth + 1, classifier) for s in (left, right)]


def _model(trees, classifier, shape):
    """The trees as Spark's model, children that say the same drawn together as Spark does."""
    context = SparkContext._active_spark_context
    ml, old = context._jvm.org.apache.spark.ml, context._jvm.org.apache.spark.mllib

    def doubles(values):
        out = context._gateway.new_array(context._jvm.double, len(values))
        for i, v in enumerate(values):
            out[i] = float(v)
        return out

    def made(node):
        """Spark's node, and its prediction if it is a leaf."""
        n, total, _ = node.sums
        stats, value = old.tree.impurity.VarianceCalculator(doubles(node.sums), int(n)), total / n
        if node.children:
            (left, a), (right, b) = map(made, node.children)
            if a is None or a != b:
                if node.feature < shape.numbers:
                    split = ml.tree.ContinuousSplit(node.feature, node.cut)
                else:
                    split = ml.tree.CategoricalSplit(node.feature, doubles([node.cut]), 2)
                return ml.tree.InternalNode(value, _variance(*node.sums), node.gain, left, right, split, stats), None
        return ml.tree.LeafNode(value, _variance(*node.sums) if node.valid else -1.0, stats), value

    models = context._gateway.new_array(ml.regression.DecisionTreeRegressionModel, len(trees))
    for i, (root, _) in enumerate(trees):
        models[i] = ml.regression.DecisionTreeRegressionModel(made(root)[0], shape.size)
    weights = doubles([w for _, w in trees])
    model = ml.classification.GBTClassificationModel(classifier.uid, models, weights, shape.size, 2)
    return classifier._copyValues(classifier._create_model(model))
