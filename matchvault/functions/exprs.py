"""Scalar expressions, all built from JVM-side functions."""

from pyspark.sql import functions as F

__all__ = [
    "abbreviate_name",
    "age_years",
    "clean_number",
    "confidence",
    "decide",
    "default_text",
    "implied_probability",
    "inf_to_null",
    "matchup_label",
    "mmss_to_seconds",
    "parse_score",
    "result_line",
    "score_agrees",
    "shift_hours",
    "snapshot_suffix",
    "url_quote",
    "winner_name",
]


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def _int_pair(text):
    """The two integers of ``"a:b"`` as columns, both NULL unless there are exactly two parts."""
    parts = F.split(_col(text), ":", -1)
    two = F.size(parts) == 2
    number = lambda i: F.when(two, F.get(parts, F.lit(i))).try_cast("bigint")
    return number(0), number(1)


def mmss_to_seconds(text):
    """``"MM:SS"`` as seconds, 0 for NULL or anything malformed."""
    minutes, seconds = _int_pair(text)
    return F.coalesce(minutes * 60 + seconds, F.lit(0).cast("bigint"))


def parse_score(text):
    """``"home:visiting"`` as a struct, NULL when it is not two integers."""
    home, visiting = _int_pair(text)
    return F.when(
        home.isNotNull() & visiting.isNotNull(),
        F.struct(home.alias("home"), visiting.alias("visiting")),
    )


def score_agrees(home_wins, score):
    """Whether a parsed score fits the picked winner; an unparsed score never does."""
    fits = F.when(_col(home_wins), score["home"] > score["visiting"]).otherwise(
        score["home"] < score["visiting"]
    )
    return F.coalesce(fits, F.lit(False))


def age_years(birth, as_of):
    """Completed years between two dates, by calendar month and day."""
    birth, as_of = _col(birth), _col(as_of)
    month_day = lambda d: F.month(d) * 100 + F.dayofmonth(d)
    return F.year(as_of) - F.year(birth) - (month_day(as_of) < month_day(birth)).cast("int")


def shift_hours(ts, hours):
    """Timestamp moved by whole hours."""
    return _col(ts) + F.make_dt_interval(hours=F.lit(hours))


def confidence(wins, proba):
    """0-10 confidence in the called side from the home win probability."""
    p = _col(proba).cast("decimal(18,15)")
    side = F.when(_col(wins) == 1, p).otherwise(F.lit(1).cast("decimal(18,15)") - p)
    return (F.round(side, 1) * 10).cast("int")


def decide(score, threshold):
    """1 where the score reaches the threshold, else 0; NULL for a NULL score."""
    score = _col(score)
    return F.when(score.isNotNull(), (score >= threshold).cast("int"))


def implied_probability(home_odds, visiting_odds):
    """Home win probability implied by two decimal odds."""
    home, visiting = _col(home_odds), _col(visiting_odds)
    return 1 - F.try_divide(home, home + visiting)


def inf_to_null(c):
    """Infinite values as NULL."""
    c = _col(c)
    return F.when(~c.isin(float("inf"), float("-inf")), c)


def clean_number(c, type_="double"):
    """Text or number as a typed value, NULL for bad text and NaN, so one bad cell spoils no sum."""
    value = _col(c).try_cast(type_)
    return F.when(~F.isnan(value), value) if type_ in ("double", "float") else value


def default_text(c):
    """The ``default`` field of a localised text struct, empty when the struct or field is missing."""
    return F.coalesce(_col(c)["default"], F.lit(""))


def snapshot_suffix(ts):
    """``2024-01-15 08:00:00`` as ``2024_01_15``."""
    return F.replace(F.substring(_col(ts).cast("string"), 1, 10), F.lit("-"), F.lit("_"))


def abbreviate_name(name):
    """All but the last kept word in full, the last cut to three letters; at most three words."""
    words = F.split(_col(name), " ")
    at = lambda i: F.get(words, F.lit(i))
    short = lambda i: F.substring(at(i), 1, 3)
    return F.when(F.size(words) > 2, F.concat_ws(" ", at(0), at(1), short(2))).otherwise(
        F.concat_ws(" ", at(0), short(1))
    )


def matchup_label(home, visiting, ts):
    """``01-15 22:00 home vs visiting`` with abbreviated names."""
    return F.concat(
        F.date_format(_col(ts), "MM-dd HH:mm"),
        F.lit(" "),
        abbreviate_name(home),
        F.lit(" vs "),
        abbreviate_name(visiting),
    )


def winner_name(home, visiting, home_score, visiting_score):
    """Name of the side with more goals, NULL for a draw."""
    hs, vs = _col(home_score), _col(visiting_score)
    return F.when(hs > vs, _col(home)).when(hs < vs, _col(visiting))


def result_line(date, home, visiting, home_score, visiting_score):
    """One result as text, the winner marked with a cup and bold tags."""
    hs, vs = _col(home_score), _col(visiting_score)
    home_text = F.when(
        hs > vs, F.concat(F.lit("\N{TROPHY} <b>"), _col(home), F.lit("</b>"))
    ).otherwise(_col(home))
    visiting_text = F.when(
        hs < vs, F.concat(F.lit("<b>"), _col(visiting), F.lit("</b> \N{TROPHY}"))
    ).otherwise(_col(visiting))
    return F.concat(
        _col(date).cast("string"), F.lit("   "), home_text, F.lit(" "), hs.cast("string"),
        F.lit(" : "), vs.cast("string"), F.lit(" "), visiting_text,
    )


def url_quote(text):
    """Percent-encoding as in a URL path: space as %20, slash and tilde kept."""
    quoted = F.url_encode(_col(text))
    # Where form encoding differs from path quoting.
    for form, path in (("+", "%20"), ("*", "%2A"), ("%7E", "~"), ("%2F", "/")):
        quoted = F.replace(quoted, F.lit(form), F.lit(path))
    return quoted
