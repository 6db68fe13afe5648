"""Match features that use only what was known before the match, and missing-value handling."""

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchvault.operators.scan import last_known, next_known, ordered_scan, sum_before


def _null_safe_join(df, table, keys, how="left"):
    renamed = table.select(
        *[F.col(k).alias(f"_j_{k}") for k in keys], *[c for c in table.columns if c not in keys]
    )
    on = [df[k].eqNullSafe(renamed[f"_j_{k}"]) for k in keys]
    return df.join(renamed, on, how).drop(*[f"_j_{k}" for k in keys])


def running_form(games, team, season, order, label, prefix):
    """Played games, wins and win share of a side before each game of its season.

    ``label`` is 1 for a win of that side, 0 for a loss and NULL for a game not played, which counts
    neither as a game nor as a win. The share is NULL before the first played game.
    """
    played = F.col("_label").isNotNull().cast("long")
    scan = ordered_scan(games.withColumn("_label", label), [team, season], order)
    out = scan.with_values(
        **{f"{prefix}matches": sum_before(played), f"{prefix}wins": sum_before("_label")}
    ).rows()
    share = F.try_divide(F.col(f"{prefix}wins"), F.col(f"{prefix}matches"))
    return out.withColumn(f"{prefix}win_pctg", share).drop("_label")


def home_form(games, order, team="home_team_code", season="season", label="home_team_winner"):
    """Home games before this one, as ``home_matches``, ``home_wins``, ``home_win_pctg``."""
    return running_form(games, team, season, order, F.col(label), "home_")


def road_form(games, order, team="visiting_team_code", season="season", label="home_team_winner"):
    """The same for the visitors on the road; their win is the home side's loss."""
    return running_form(games, team, season, order, 1 - F.col(label), "road_")


def overall_form(games, match_key, order, season="season", label="home_team_winner"):
    """Form over home and road games together, for both sides of each game.

    Every game becomes two rows, one scan per (team, season) numbers them, and the two rows are folded
    back by match key: two games of a team on one day do not multiply, and the games are read once.
    """
    side = lambda flag, team, win: F.struct(
        F.lit(flag).alias("_side"), F.col(team).alias("_side_team"), win.alias("_side_win")
    )
    sides = games.select(
        "*",
        F.inline(
            F.array(
                side("h", "home_team_code", F.col(label)),
                side("v", "visiting_team_code", 1 - F.col(label)),
            )
        ),
    )
    scan = ordered_scan(sides, ["_side_team", season], [*order, "_side"])
    played = F.col("_side_win").isNotNull().cast("long")
    formed = scan.with_values(_side_games=sum_before(played), _side_wins=sum_before("_side_win")).rows()
    at = lambda flag, c: F.max(F.when(F.col("_side") == flag, F.col(c)))
    folded = formed.groupBy(*match_key).agg(
        *[F.first(c).alias(c) for c in games.columns if c not in match_key],  # equal on both rows
        *[
            at(s, c).alias(f"{s}_{name}_cumsum")
            for s in "hv"
            for c, name in (("_side_games", "games_played"), ("_side_wins", "wins"))
        ],
    )
    for s in "hv":
        share = F.try_divide(F.col(f"{s}_wins_cumsum"), F.col(f"{s}_games_played_cumsum"))
        folded = folded.withColumn(f"{s}_wins_pctg_cumsum", share)
    return folded.select(*games.columns, *[c for c in folded.columns if c not in games.columns])


def fill_from(df, sources):
    """Fill missing values of each column from another: ``{column: source}``."""
    return df.withColumns({c: F.coalesce(F.col(c), F.col(s)) for c, s in sources.items()})


def columns_with_nulls(df, prefix="", dtypes=None):
    """Names of columns (by prefix and type) that hold a NULL, from one aggregate pass."""
    names = [
        f.name
        for f in df.schema.fields
        if f.name.startswith(prefix) and (dtypes is None or isinstance(f.dataType, dtypes))
    ]
    if not names:
        return []
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in names]).first()
    return [c for c in names if row[c]]


def gap_fill(df, keys, order, cols, backward=True):
    """Fill gaps from the previous known value of the entity, then from the next one.

    Filling backwards lets later matches leak into earlier ones; pass ``backward=False`` for features.
    """
    values = {f"_f_{c}": last_known(c) for c in cols}
    if backward:
        values |= {f"_b_{c}": next_known(c) for c in cols}
    out = ordered_scan(df, keys, order).with_values(**values).rows()
    filled = {
        c: F.coalesce(F.col(f"_f_{c}"), *([F.col(f"_b_{c}")] if backward else [])) for c in cols
    }
    return out.withColumns(filled).drop(*values)


def ratios(df, pairs):
    """Per-game ratios ``{name: (numerator, denominator)}``, NULL where the denominator is zero."""
    return df.withColumns(
        {
            name: F.try_divide(F.col(a).cast("double"), F.col(b).cast("double"))
            for name, (a, b) in pairs.items()
        }
    )


def join_fill(left, right, keys, fill=0):
    """Inner join on natural keys, numeric gaps filled."""
    return left.join(right, list(keys), "inner").fillna(fill)


def _mean(df, c):
    """Mean of a column; decimals are summed exactly, so that the order of rows does not matter."""
    if isinstance(df.schema[c].dataType, T.DecimalType):
        return F.try_divide(F.sum(c).cast("double"), F.count(c).cast("double"))
    return F.avg(c)


def mean_impute(df, keys, cols):
    """Fill gaps with the mean of the row's group.

    Group means are aggregated with map-side reduction and joined back, so no task holds a group.
    """
    means = df.groupBy(*keys).agg(*[_mean(df, c).alias(f"_m_{c}") for c in cols])
    out = _null_safe_join(df, means, keys)
    return out.withColumns({c: F.coalesce(F.col(c), F.col(f"_m_{c}")) for c in cols}).drop(
        *[f"_m_{c}" for c in cols]
    )


def mode_impute(df, keys, cols):
    """Fill gaps with the most frequent value of the row's group, the smallest one on a tie."""
    out = df
    for c in cols:
        counts = df.filter(F.col(c).isNotNull()).groupBy(*keys, c).agg(
            F.count(F.lit(1)).alias("_n")
        )
        modes = counts.groupBy(*keys).agg(
            F.min(F.struct((-F.col("_n")).alias("n"), F.col(c).alias("v")))["v"].alias(f"_m_{c}")
        )
        out = _null_safe_join(out, modes, keys).withColumn(c, F.coalesce(F.col(c), F.col(f"_m_{c}")))
    return out.drop(*[f"_m_{c}" for c in cols])


def global_mean_impute(df, cols):
    """Infinite values become gaps, gaps become the mean of the whole column (one aggregate pass)."""
    finite = {c: F.when(~F.isnan(c) & ~F.abs(F.col(c)).isin(float("inf")), F.col(c)) for c in cols}
    clean = df.withColumns(finite)
    means = clean.agg(*[F.avg(c).alias(c) for c in cols]).first()
    return clean.fillna({c: means[c] for c in cols if means[c] is not None})


def remap(df, mapping, cols):
    """Replace renamed entities' values in the given columns."""
    return df.replace(mapping, subset=list(cols))


def numeric_columns(df):
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def string_columns(df):
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def split_by_date(df, date, cutoff):
    """Train rows before the cutoff, test rows from it on. Rows without a date train."""
    late = F.coalesce(F.col(date) >= F.lit(cutoff).cast(df.schema[date].dataType), F.lit(False))
    return df.filter(~late), df.filter(late)


def tail_cutoff(df, date, share):
    """``(day, rows of that day)`` where the last ``share`` of rows by date begins.

    Only per-day counts are ordered, never the rows: the window has one row per calendar day. Rows without a
    date are not counted.
    """
    days = df.filter(F.col(date).isNotNull()).groupBy(F.to_date(date).alias("day")).agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy()
    newest_first = Window.orderBy(F.desc("day")).rowsBetween(Window.unboundedPreceding, 0)
    wanted = F.floor(F.lit(share) * F.col("total"))
    row = (
        days.withColumns({"tail": F.sum("n").over(newest_first), "total": F.sum("n").over(whole)})
        .filter(F.col("tail") - F.col("n") < wanted)
        .orderBy("day")
        .select("day", (wanted - F.col("tail") + F.col("n")).alias("rows"))
        .first()
    )
    return (row["day"], row["rows"]) if row else (None, 0)


def tail_split(df, date, share, order):
    """``df`` with ``is_test`` true on exactly the last ``floor(share * n)`` of the n rows with a date, by date.

    Days after the cutoff are test and days before it train by a date filter; inside the one day that
    is divided, ``order`` decides and only that day's rows are scanned. Rows without a date train.
    """
    day, wanted = tail_cutoff(df, date, share)
    if day is None:
        return df.withColumn("is_test", F.lit(False))
    on_day = F.coalesce(F.to_date(date) == F.lit(day), F.lit(False))
    later = F.coalesce(F.to_date(date) > F.lit(day), F.lit(False))
    others = df.filter(~on_day).withColumn("is_test", later)
    divided = df.filter(on_day)
    size = divided.count()
    ranked = ordered_scan(divided, [], order).with_values(_before=sum_before(F.lit(1))).rows()
    tested = ranked.withColumn("is_test", F.col("_before") >= size - wanted).drop("_before")
    return others.unionByName(tested)
