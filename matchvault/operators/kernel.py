"""Support vector machine with a Gaussian kernel and probabilities, as a linear one over random Fourier features.

The kernel matrix of a kernel machine grows with the square of the rows. Here the kernel is approximated by the inner
product of ``dimensions`` random cosines of the input, so that training is linear in the rows and distributed.
"""

import numpy as np
import pyarrow as pa
from numpy.polynomial import chebyshev
from pyspark import SparkContext, StorageLevel, keyword_only
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.common import _py2java
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol, HasSeed
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import functions as F

from matchvault.operators.ml import SEED, kept_evenly, prepare, without_summary
from matchvault.operators.owlqn import minimum
from matchvault.operators.packed import Shape, packed, summed

# One row in five sets the probabilities and takes no part in finding the margin.
HELD_OUT = 5
# Rows whose features are made at once: half a MB of them, so that they stay in the processor's cache.
ROWS_AT_ONCE = 512
# The same in the passes of training, where a polynomial is worked out term by term.
AT_ONCE = 256
# Rows of a table of what combinations of categories add to the angles.
JOINT_ROWS = 8192
# Fixed value: where the search for the margin stops.
TOLERANCE = 1e-3


def _sine_terms(n=7):
    """Coefficients of ``sin(pi t) / t`` as a polynomial in ``t^2``, highest first, for half a turn either way (error 2e-15)."""
    nodes = chebyshev.chebpts1(400)
    t = np.sqrt((nodes + 1) / 8)
    found = chebyshev.cheb2poly(chebyshev.chebfit(nodes, np.sin(np.pi * t) / t, n))
    return np.polynomial.Polynomial(found)(np.polynomial.Polynomial([-1.0, 8.0])).coef[::-1].tolist()


SINE = _sine_terms()


class FourierFeatures(Transformer, HasInputCol, HasOutputCol, HasSeed, DefaultParamsReadable, DefaultParamsWritable):
    """``sqrt(2 / D) * cos(w x + b)`` for D random rows ``w`` drawn for the kernel ``exp(-gamma |x - y|^2)``.

    The rows follow from ``seed``, so a saved pipeline needs no matrix. The product is made with numpy on Arrow batches:
    array functions of Spark, interpreted entry by entry, took some 200 microseconds a row.
    """

    gamma = Param(Params._dummy(), "gamma", "kernel width", TypeConverters.toFloat)
    width = Param(Params._dummy(), "width", "length of the input vector", TypeConverters.toInt)
    dimensions = Param(Params._dummy(), "dimensions", "number of random features", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, seed=SEED, gamma=1.0, width=1, dimensions=128):
        super().__init__()
        self._setDefault(seed=SEED, gamma=1.0, width=1, dimensions=128)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def drawn(self):
        """``w``, a column for each feature, and ``b``."""
        d, n = self.getOrDefault(self.dimensions), self.getOrDefault(self.width)
        rnd = np.random.default_rng(self.getSeed())
        weights = np.ascontiguousarray(rnd.normal(0, np.sqrt(2 * self.getOrDefault(self.gamma)), (d, n)).T)
        return weights, rnd.uniform(0, 2 * np.pi, d)

    def scale(self):
        return float(np.sqrt(2 / self.getOrDefault(self.dimensions)))

    def _transform(self, dataset):
        d, n = self.getOrDefault(self.dimensions), self.getOrDefault(self.width)
        weights, shifts = self.drawn()
        scale = self.scale()

        @F.arrow_udf("array<double>")
        def cosines(vectors: pa.Array) -> pa.Array:
            x = vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, n)  # of the rows that are not NULL
            out = np.tile(shifts, (len(x), 1))
            for at in range(0, len(x), ROWS_AT_ONCE):
                values, angles = x[at : at + ROWS_AT_ONCE], out[at : at + ROWS_AT_ONCE]
                # Entry by entry, as few are set in a row; a sum does not depend on which rows come together.
                for i in range(n):
                    rows = np.flatnonzero(values[:, i])
                    if len(rows) == len(values):
                        angles += values[:, i, None] * weights[i]
                    elif len(rows):
                        angles[rows] += values[rows, i, None] * weights[i]
                np.cos(angles, out=angles)
            missing = vectors.is_null().to_numpy(zero_copy_only=False)
            ends = np.concatenate([[0], np.cumsum(~missing) * d])
            flat = pa.array((out * scale).ravel())
            return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat, mask=pa.array(missing))

        made = cosines(vector_to_array(F.col(self.getInputCol())))
        return dataset.withColumn(self.getOutputCol(), array_to_vector(made))


def kernel_width(df, vector):
    """``1 / (length * variance of all entries)``, and the length; two sums come to the driver."""
    found = Summarizer.metrics("mean", "normL2", "count").summary(F.col(vector))
    row = df.filter(F.col(vector).isNotNull()).agg(found.alias("found")).first()["found"]
    length = len(row["mean"])
    squares = float((row["normL2"].toArray() ** 2).sum())
    variance = squares / (row["count"] * length) - float(np.mean(row["mean"].toArray())) ** 2
    return (1.0 / (length * variance) if variance > 0 else 1.0), length


def fit_kernel_svm(
    train, numeric, categorical, label="label", dimensions=128, inverse_penalty=1.0, seed=SEED, prepared=None
):
    """Fitted pipeline whose ``probability`` is the margin turned by a logistic curve (Platt), for ``ml.score``.

    The curve is fitted on every fifth row, chosen by a hash of its values: those rows take no part in finding the
    margin. Where either part lacks one of the labels, both steps use all rows. With ``prepared``, the rows are already
    kept evenly, and that is their preprocessing.
    """
    if prepared is not None:
        return _fitted(prepared, train, numeric, categorical, label, dimensions, inverse_penalty, seed)
    with kept_evenly(train.select(*dict.fromkeys([*numeric, *categorical, label]))) as kept:
        return _fitted(prepare(kept, numeric, categorical), kept, numeric, categorical, label, dimensions, inverse_penalty, seed)


def _fitted(prepared, kept, numeric, categorical, label, dimensions, inverse_penalty, seed):
    gamma, width = kernel_width(prepared.transform(kept), "features")
    cosines = FourierFeatures(
        inputCol="features", outputCol="cosines", seed=seed, gamma=gamma, width=width, dimensions=dimensions
    )
    # NULL and absent values hash alike everywhere, so a lost part is divided again as before.
    out = F.pmod(F.xxhash64(*[F.col(c) for c in [*numeric, *categorical]]), F.lit(HELD_OUT)) == 0
    sides = kept.groupBy(out.alias("out"), label).count().collect()  # four counts
    whole = len({(r["out"], r[label]) for r in sides}) < 4
    to_fit, to_turn = (kept, kept) if whole else (kept.filter(~out), kept.filter(out))
    machine = LinearSVC(
        featuresCol="cosines", labelCol=label, predictionCol="side", rawPredictionCol="margins",
        maxIter=100, tol=TOLERANCE, standardization=False,
    )
    shape = Shape(prepared, numeric, categorical)
    with packed(prepared, to_fit, shape, label) as (blocks, rows):
        machine.setRegParam(1.0 / (inverse_penalty * max(rows, 1)))
        found = fit_machine(machine, cosines, blocks, rows, shape)
    margin = VectorSlicer(inputCol="margins", outputCol="margin", indices=[1])
    margins = PipelineModel(stages=[*prepared.stages, cosines, found, margin])
    # The curve reads the margins many times; they are made once.
    told = margins.transform(to_turn).select("margin", label).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        turned = LogisticRegression(featuresCol="margin", labelCol=label).fit(told)
    finally:
        told.unpersist()
    return without_summary(PipelineModel(stages=[*margins.stages, turned]))


def _cosines(cosines, shape):
    """A function that yields the cosines of a block's rows, some hundred at once, with their labels of -1 and 1.

    They take most of a pass. Angles are added up in turns and brought to one turn, whose cosine is ``1 - 2 sin(pi t)^2``
    by a polynomial: exact to rounding, at a quarter of the time of numpy's own.
    """
    weights, shifts = cosines.drawn()
    weights, shifts = weights / (2 * np.pi), shifts / (2 * np.pi)
    numbers, slots = weights[: shape.numbers], weights[shape.numbers :]
    none = np.zeros((1, len(shifts)))  # of values unseen in training
    tables, at = [], 0
    for n in shape.widths:
        tables.append(np.concatenate([slots[at : at + n], none]))
        at += n

    def make():
        joint, sizes, groups = [shifts[None]], [1], [[]]
        for i, table in enumerate(tables):  # categories with few combinations share a table
            if len(joint[-1]) * len(table) > JOINT_ROWS:
                joint.append(none), sizes.append(1), groups.append([])
            joint[-1] = (joint[-1][:, None] + table[None]).reshape(-1, len(shifts))
            groups[-1].append(i)

        def of(block):
            n = block["n"]
            x = np.frombuffer(block["numbers"]).reshape(n, shape.numbers)
            codes = np.frombuffer(block["codes"], shape.dtype).reshape(len(tables), n)
            signs = np.frombuffer(block["labels"], np.int8) * 2.0 - 1
            places = []
            for group in groups:
                place = np.zeros(n, np.intp)
                for i in group:
                    place *= len(tables[i])
                    place += codes[i]
                places.append(place)
            turns, other, squares = np.empty((3, AT_ONCE, len(shifts)))
            for start in range(0, n, AT_ONCE):
                some = slice(start, min(start + AT_ONCE, n))
                t, u, v = (a[: some.stop - start] for a in (turns, other, squares))
                np.take(joint[0], places[0][some], axis=0, out=t)
                for table, place in zip(joint[1:], places[1:]):
                    np.take(table, place[some], axis=0, out=u)
                    t += u
                if shape.numbers:
                    t += np.matmul(x[some], numbers, out=u)
                np.rint(t, out=u)
                t -= u
                np.multiply(t, t, out=v)
                u[:] = SINE[0]
                for term in SINE[1:]:
                    u *= v
                    u += term
                u *= t
                u *= u
                u *= -2
                u += 1
                yield u, signs[some]

        return of

    return make


def fit_machine(machine, cosines, blocks, rows, shape):
    """What ``machine.fit`` finds on the cosines of all rows, which are made anew in each pass instead of kept.

    They are a kilobyte a row. The objective is the one of Spark's linear machine: mean hinge loss on columns divided by
    their deviations, and centred, with the penalty on the weights of the columns as they are.
    """
    d, scale = cosines.getOrDefault(cosines.dimensions), cosines.scale()
    make = _cosines(cosines, shape)

    def moments():
        of = make()

        def sums(block):
            total = np.zeros((2, d))
            for z, _ in of(block):
                total += z.sum(0), np.einsum("ij,ij->j", z, z)
            return total.ravel()

        return sums

    total, squares = summed(blocks, moments, 2 * d).reshape(2, d) * [[scale], [scale**2]]
    mean = total / max(rows, 1)
    deviation = np.sqrt(np.maximum(squares - rows * mean**2, 0) / max(rows - 1, 1))
    inverse = np.divide(1.0, deviation, out=np.zeros(d), where=deviation > 0)
    penalty = machine.getRegParam()

    def value_and_gradient(point):
        weights = point[:d] * inverse
        offset, scaled = point[d] - weights @ mean, weights * scale

        def hinges():
            of = make()

            def sums(block):
                out = np.zeros(d + 2)
                for z, sign in of(block):
                    loss = 1 - sign * (z @ scaled + offset)
                    at = np.where(loss > 0, -sign, 0.0)
                    out[:d] += at @ z
                    out[d:] += at.sum(), np.maximum(loss, 0).sum()
                return out

            return sums

        *found, slope, loss = summed(blocks, hinges, d + 2)
        gradient = np.append((scale * np.array(found) - mean * slope) * inverse, slope) / rows
        gradient[:d] += penalty * weights * inverse
        return loss / rows + 0.5 * penalty * (weights @ weights), gradient

    point, _ = minimum(value_and_gradient, np.zeros(d + 1), machine.getMaxIter(), machine.getTol())
    weights = point[:d] * inverse
    context = SparkContext._active_spark_context
    jvm = context._jvm.org.apache.spark.ml.classification
    model = jvm.LinearSVCModel(machine.uid, _py2java(context, Vectors.dense(weights)), float(point[d] - weights @ mean))
    return machine._copyValues(machine._create_model(model))
