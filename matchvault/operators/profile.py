"""Data profile: missing values, histograms, counts and exact quantiles by class."""

from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchvault.operators.scan import ordered_scan, sum_before


def null_profile(df, cols=None):
    """Rows, NULLs, NaNs and infinities per column, all from one pass over the data."""
    fields = [f for f in df.schema.fields if cols is None or f.name in cols]
    aggs = [F.count(F.lit(1)).alias("rows")]
    for f in fields:
        c = F.col(f.name)
        floating = isinstance(f.dataType, (T.DoubleType, T.FloatType))
        aggs += [
            F.count_if(c.isNull()).alias(f"null_{f.name}"),
            (F.count_if(F.isnan(c)) if floating else F.lit(0).cast("long")).alias(f"nan_{f.name}"),
            (
                F.count_if(c.isin(float("inf"), float("-inf"))) if floating else F.lit(0).cast("long")
            ).alias(f"inf_{f.name}"),
        ]
    lines = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.col("rows").alias("row_cnt"),
            *[F.col(f"{k}_{f.name}").alias(f"{k}_cnt") for k in ("null", "nan", "inf")],
        )
        for f in fields
    ]
    return df.agg(*aggs).select(F.inline(F.array(*lines)))


def histogram(df, col, width, start=0):
    """Rows per fixed-width bin; a bin is named by its lower edge."""
    bin_ = (F.floor((F.col(col) - start) / width)).cast("long").alias("bin")
    return (
        df.filter(F.col(col).isNotNull())
        .groupBy(bin_)
        .agg(F.count(F.lit(1)).alias("cnt"))
        .select("bin", (F.col("bin") * width + start).alias("bin_from"), "cnt")
    )


def class_counts(df, cols):
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("cnt"))


def quantiles_by_class(df, by, col, probs):
    """Exact quantiles per class, interpolated between neighbours.

    Rows are first reduced to distinct values with counts; a running count over those finds the two
    neighbours of each position. No task sees more than a chunk of one class's values.
    """
    counts = (
        df.filter(F.col(col).isNotNull())
        .groupBy(*by, F.col(col).cast("double").alias("_v"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    sizes = counts.groupBy(*by).agg(F.sum("_n").alias("_size"))
    ranked = ordered_scan(counts, by, ["_v"]).with_values(_before=sum_before("_n")).rows()
    sized = ranked.join(
        sizes.select(*[F.col(k).alias(f"_k_{k}") for k in by], "_size"),
        reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in by]),
    )
    at = lambda pos: F.max(
        F.when((F.col("_before") <= pos) & (pos < F.col("_before") + F.col("_n")), F.col("_v"))
    )
    aggs = []
    for name, p in probs.items():
        pos = F.lit(float(p)) * (F.col("_size") - 1)
        aggs += [
            at(F.floor(pos)).alias(f"_lo_{name}"),
            at(F.ceil(pos)).alias(f"_hi_{name}"),
            F.max(pos - F.floor(pos)).alias(f"_w_{name}"),
        ]
    out = sized.groupBy(*by).agg(F.max("_size").alias("cnt"), *aggs)
    return out.select(
        *by,
        "cnt",
        *[
            (F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * F.col(f"_w_{n}")).alias(n)
            for n in probs
        ],
    )


def distinct_sorted(df, col):
    """Sorted distinct values."""
    return df.select(col).distinct().orderBy(col)
