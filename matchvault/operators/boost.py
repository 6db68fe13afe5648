"""Boosted trees by Newton steps, with an l2 penalty, and categories told by the rows before each row.

Every round fits one tree of ``depth`` levels, each level one cut for all its nodes. A level is one job: the rows' first
and second derivatives are summed by node, feature and bin, reduced on the map side, and the driver gets those sums
(at most ``2 ** depth * features * (cuts + 2)`` of them, however many rows there are) and picks the cut. The rows hold
small bin numbers, kept between rounds; their margins are checkpointed every ``ROUNDS_PER_CHECKPOINT`` rounds.
"""

import json
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
from pyspark import StorageLevel, keyword_only
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import functions as F

from matchvault.operators.ml import DEPTH
from matchvault.operators.scan import CHUNK, _written, ordered_scan, sum_before

ROUNDS_PER_CHECKPOINT = 5
# Gains that differ by less are equal: sums of doubles depend on the order in which tasks end.
DIGITS = 9

# Training settings the results are compared under. The product of rounds and step is what counts.
L2 = 7.0
TOTAL_STEP = 25.0
PRIOR = 0.5
PRIOR_WEIGHT = 1.0
CATEGORY_CUTS = 15


def category_key(c):
    """A category as text in which NULL differs from all values."""
    return F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null"))


def _share(wins, rows, prior, weight):
    return (wins + prior * weight) / (rows + weight)


def ordered_statistics(df, categorical, order, label="label", prior=PRIOR, weight=PRIOR_WEIGHT, suffix="_before"):
    """One column per category: the share of positive labels among the rows before this one with its value.

    A row's own label takes no part in its statistic, so nothing leaks. ``prior`` counts like ``weight`` rows more. NULL
    is a value of its own; a NULL label counts as no row. ``order`` should be total; rows that tie on it come in any order.

    The rows are counted and cut into ranges of the order once for all categories, and move between tasks once.
    """
    scan = ordered_scan(df, [], order)
    if scan.split:
        # A chunk holds all categories' rows of its range, so the windows below need no exchange of their own.
        scan = scan.map(lambda rows: rows.repartition(CHUNK))
    known = F.col(label).isNotNull().cast("long")
    names = {c: (f"{c}{suffix}_wins", f"{c}{suffix}_rows") for c in categorical}
    for c, (wins, rows) in names.items():
        scan = scan.with_values(by=[c], **{wins: sum_before(label), rows: sum_before(known)})
        share = _share(F.col(wins), F.col(rows), prior, weight)
        scan = scan.map(lambda d: d.withColumn(f"{c}{suffix}", share).drop(wins, rows))  # noqa: B023
    return scan.rows()


def _bin(value, borders):
    """0 for NULL and NaN, else 1 + the number of borders below the value."""
    below = F.size(F.filter(F.from_json(F.lit(json.dumps(borders)), "array<double>"), lambda b: b < value)) + 1
    return F.when(value.isNull() | F.isnan(value), 0).otherwise(below).cast("int")


def _leaf(tree, bins):
    """Value of the leaf that a row of these bins falls into; a literal array, so that it stays one constant."""
    at = F.lit(0)
    for level, (feature, cut, _) in enumerate(tree["splits"]):
        at = at + F.when(bins[feature] > cut, 1 << level).otherwise(0)
    return F.get(F.from_json(F.lit(json.dumps(tree["leaves"])), "array<double>"), at)


def _free(name, columns):
    while name in columns:
        name = f"_{name}"
    return name


class NewtonTrees(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted trees as one text of bin borders, category statistics, cuts and leaves; adds ``probability``."""

    state = Param(Params._dummy(), "state", "the trees as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, state="{}"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset):
        state = json.loads(self.getOrDefault(self.state))
        bins = _free("_bins", dataset.columns)
        out = dataset.withColumn(bins, F.array(*[_bin(self._value(f), f["borders"]) for f in state["features"]]))
        margin = reduce(lambda a, b: a + b, [_leaf(t, F.col(bins)) for t in state["trees"]], F.lit(0.0))
        p = 1 / (1 + F.exp(-margin))
        return out.withColumn("probability", array_to_vector(F.array(1 - p, p))).drop(bins)

    @staticmethod
    def _value(feature):
        if feature["values"] is None:
            return F.col(feature["name"]).cast("double")
        table = F.from_json(F.lit(json.dumps(feature["values"])), "map<string, double>")
        return F.coalesce(F.try_element_at(table, category_key(feature["name"])), F.lit(feature["unseen"]))

    def importances(self):
        """``(column, share of all gains)``, in the order of training."""
        state = json.loads(self.getOrDefault(self.state))
        gains = [0.0] * len(state["features"])
        for tree in state["trees"]:
            for feature, _, gain in tree["splits"]:
                gains[feature] += gain
        total = sum(gains) or 1.0
        return [(f["name"], g / total) for f, g in zip(state["features"], gains)]


@dataclass(frozen=True)
class NewtonBoosting:
    """Settings; ``ml.fit`` takes one in place of a Spark classifier.

    ``order`` names the columns by which rows are earlier or later. Numbers are cut at ``cuts`` quantiles, or at those
    that ``borders`` gives for a column; NULL and NaN lie below all numbers. Labels are 0 or 1; rows without one do not
    train. Categories are columns with few values, whose statistics the model keeps; an unseen value has the prior.
    """

    order: tuple
    label: str = "label"
    rounds: int = 50
    step: float = TOTAL_STEP / 50
    depth: int = DEPTH
    l2: float = L2
    cuts: int = 32
    borders: dict = field(default_factory=dict)
    prior: float = PRIOR
    weight: float = PRIOR_WEIGHT

    def __post_init__(self):
        if self.l2 <= 0:
            raise ValueError("l2 must be positive: an empty side of a cut has no second derivative")

    def fit_rows(self, train, numeric, categorical):
        """A fitted pipeline of one stage."""
        train = train.filter(F.col(self.label).isNotNull())
        features = self._numbers(train, numeric) + [self._category(train, c) for c in categorical]
        rows = ordered_statistics(
            train.select(*dict.fromkeys([*numeric, *categorical, *self.order, self.label])),
            categorical, self.order, self.label, self.prior, self.weight,
        )
        at = [F.col(c).cast("double") for c in numeric] + [F.col(f"{c}_before") for c in categorical]
        bins = F.array(*[_bin(v, f["borders"]) for v, f in zip(at, features)])
        rows = rows.select(F.col(self.label).cast("double").alias("y"), bins.alias("bins"), F.lit(0.0).alias("margin"))
        shape = (len(features), max((len(f["borders"]) for f in features), default=0) + 2)
        trees = self._trees(rows, shape)
        state = json.dumps({"features": features, "trees": trees})
        return PipelineModel(stages=[NewtonTrees(state=state)])

    def _numbers(self, train, numeric):
        """Columns of numbers with their cuts: one aggregation for all of them."""
        asked = [c for c in numeric if c not in self.borders]
        found = dict(self.borders)
        if asked:
            shares = [(i + 1) / (self.cuts + 1) for i in range(self.cuts)]
            value = lambda c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))
            row = train.agg(*[F.percentile_approx(value(c), shares, 10_000).alias(c) for c in asked]).first()
            found |= {c: sorted(set(row[i] or [])) for i, c in enumerate(asked)}
        return [{"name": c, "borders": [float(b) for b in found[c]], "values": None} for c in numeric]

    def _category(self, train, c):
        """A category with the share of positive labels of each of its values, over all rows."""
        sums = train.groupBy(category_key(c).alias("key")).agg(F.sum(self.label).alias("wins"), F.count(self.label).alias("n"))
        values = {r["key"]: float(_share(r["wins"], r["n"], self.prior, self.weight)) for r in sums.collect()}
        borders = [(i + 1) / (CATEGORY_CUTS + 1) for i in range(CATEGORY_CUTS)]
        return {"name": c, "borders": borders, "values": values, "unseen": self.prior}

    def _trees(self, rows, shape):
        kept, trees, pending = rows.persist(StorageLevel.MEMORY_AND_DISK), [], []
        try:
            for _ in range(self.rounds):
                margin = reduce(lambda a, b: a + b, pending, F.col("margin"))
                tree = self._tree(kept, margin, shape)
                if not tree["splits"] and abs(tree["leaves"][0]) < 10**-DIGITS:
                    break
                trees.append(tree)
                pending.append(_leaf(tree, F.col("bins")))
                if len(pending) == ROUNDS_PER_CHECKPOINT:
                    margin = reduce(lambda a, b: a + b, pending, F.col("margin"))
                    old, pending = kept, []
                    kept = _written(old.withColumn("margin", margin)).persist(StorageLevel.MEMORY_AND_DISK)
                    old.unpersist()
        finally:
            kept.unpersist()
        return trees

    def _tree(self, rows, margin, shape):
        p = 1 / (1 + F.exp(-margin))
        node, splits = F.lit(0), []
        for level in range(self.depth):
            told = rows.select("y", "bins", p.alias("p"), node.alias("node"))
            cells = told.select("node", (F.col("y") - F.col("p")).alias("g"), (F.col("p") * (1 - F.col("p"))).alias("h"),
                                F.posexplode("bins").alias("feature", "bin"))
            sums = cells.groupBy("node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect()
            found, sides = self._cut(sums, 1 << level, shape)
            if found is None:
                break
            splits.append(found)
            node = node + F.when(F.col("bins")[found[0]] > found[1], 1 << level).otherwise(0)
        # Of the last level cut, or of the level that no cut improves.
        return {"splits": splits, "leaves": [self.step * g / (h + self.l2) for g, h in sides]}

    def _cut(self, sums, nodes, shape):
        """Best ``(feature, cut, gain)``, and the sums of its sides by new node; None and the nodes' where no cut helps."""
        g, h = np.zeros((nodes, *shape)), np.zeros((nodes, *shape))
        for r in sums:
            g[r["node"], r["feature"], r["bin"]] = r["g"]
            h[r["node"], r["feature"], r["bin"]] = r["h"]
        left, below = g.cumsum(2), h.cumsum(2)
        all_g, all_h = left[:, :, -1:], below[:, :, -1:]
        gain = (left**2 / (below + self.l2) + (all_g - left) ** 2 / (all_h - below + self.l2)).sum(0)
        gain = np.round(gain - (all_g**2 / (all_h + self.l2)).sum(0), DIGITS)[:, :-1]
        whole = list(zip(all_g[:, 0, 0].tolist(), all_h[:, 0, 0].tolist()))
        feature, cut = divmod(int(gain.argmax()), gain.shape[1])  # the first of equals
        if gain[feature, cut] <= 0:
            return None, whole
        low = list(zip(left[:, feature, cut].tolist(), below[:, feature, cut].tolist()))
        high = [(a - c, b - d) for (a, b), (c, d) in zip(whole, low)]
        return (feature, cut, float(gain[feature, cut])), low + high
