import hashlib
from datetime import date, datetime
from urllib.parse import quote

from conftest import rows
from pyspark.sql import functions as F

from matchvault import functions as fn


def values(spark, data, schema, *exprs):
    df = spark.createDataFrame(data, schema)
    return [tuple(r) for r in df.select(*exprs).collect()]


def test_mmss(spark):
    texts = ["12:34", " 5: 07", "x", "", "1:2:3", None, "-1:30", "1.5:2", "7", ":"]
    got = values(spark, [(t,) for t in texts], "t string", fn.mmss_to_seconds("t"))
    assert [g[0] for g in got] == [754, 307, 0, 0, 0, 0, -30, 0, 0, 0]


def test_age_counts_completed_years(spark):
    data = [
        (date(2000, 3, 2), date(2024, 3, 1), 23),
        (date(2000, 3, 2), date(2024, 3, 2), 24),
        (date(2000, 2, 29), date(2023, 2, 28), 22),
        (date(2000, 2, 29), date(2023, 3, 1), 23),
        (date(1999, 12, 31), date(2000, 1, 1), 0),
    ]
    got = values(spark, data, "b date, a date, want int", fn.age_years("b", "a"), "want")
    assert all(g == w for g, w in got)


def test_shift_hours(spark):
    got = values(spark, [(datetime(2024, 1, 1, 19),)], "t timestamp_ntz", fn.shift_hours("t", 3))
    assert got == [(datetime(2024, 1, 1, 22),)]


def test_confidence(spark):
    data = [(1, 0.55), (1, 0.649), (0, 0.3), (0, 0.05), (1, 1.0)]
    got = values(spark, data, "w int, p double", fn.confidence("w", "p"))
    assert [g[0] for g in got] == [6, 6, 7, 10, 10]


def test_scores(spark):
    data = [
        ("3:2", True, True), ("2:3", True, False), ("2:3", False, True), ("2:2", True, False),
        ("2:2", False, False), ("a:b", True, False), ("3", True, False), (None, False, False),
        (" 4 : 1 ", True, True),
    ]
    score = fn.parse_score("s")
    got = values(spark, data, "s string, w boolean, ok boolean", fn.score_agrees("w", score), "ok")
    assert all(g == w for g, w in got)


def test_names_and_lines(spark):
    data = [("Toronto Maple Leafs",), ("Boston Bruins",), ("Solo",), ("New York Rangers Two",)]
    got = values(spark, data, "n string", fn.abbreviate_name("n"))
    assert [g[0] for g in got] == ["Toronto Maple Lea", "Boston Bru", "Solo", "New York Ran"]
    data = [("A", "B", 3, 1), ("A", "B", 1, 3), ("A", "B", 2, 2)]
    got = values(
        spark, data, "h string, v string, hs int, vs int",
        fn.result_line(F.lit("2024-01-01"), "h", "v", "hs", "vs"), fn.winner_name("h", "v", "hs", "vs"),
    )
    assert got == [
        ("2024-01-01   \N{TROPHY} <b>A</b> 3 : 1 B", "A"),
        ("2024-01-01   A 1 : 3 <b>B</b> \N{TROPHY}", "B"),
        ("2024-01-01   A 2 : 2 B", None),
    ]


def test_url_quote_is_path_quoting(spark):
    texts = ["Tim Stützle", "a/b c", "100%*", "x~y_z-1.", "Montréal & Co+"]
    got = values(spark, [(t,) for t in texts], "t string", fn.url_quote("t"))
    assert [g[0] for g in got] == [quote(t) for t in texts]


def test_numbers(spark):
    inf = float("inf")
    got = values(spark, [(1.0,), (inf,), (-inf,), (None,)], "v double", fn.inf_to_null("v"))
    assert [g[0] for g in got] == [1.0, None, None, None]
    got = values(spark, [("1.5",), ("NaN",), ("bad",), (None,)], "t string", fn.clean_number("t"))
    assert [g[0] for g in got] == [1.5, None, None, None]
    got = values(
        spark, [(1.5, 3.0), (0.0, 0.0)], "a double, b double", fn.implied_probability("a", "b")
    )
    assert got == [(1 - 1.5 / 4.5,), (None,)]
    got = values(spark, [(0.48,), (0.47,), (None,)], "s double", fn.decide("s", 0.48))
    assert [g[0] for g in got] == [1, 0, None]


def test_hash_key_is_plain_sha1(spark):
    got = values(spark, [(7, None)], "a int, b string", fn.hash_key("a", "b", F.lit("SRC")))
    assert got == [(hashlib.sha1(b"7_SRC").hexdigest(),)]


def test_data_hash_keeps_nulls_and_borders_apart(spark):
    data = [("a", None, "b"), ("a", "b", None), ("a_b", None, None), ("a", "_b", None), ("a", "", "b")]
    df = spark.createDataFrame(data, "x string, y string, z string")
    assert len(set(rows(df.select(fn.data_hash("x", "y", "z"))))) == len(data)


def test_snapshot_suffix_and_default_text(spark):
    df = spark.createDataFrame([(("en",),), ((None,),), (None,)], "n struct<default:string>")
    assert [r[0] for r in df.select(fn.default_text("n")).collect()] == ["en", "", ""]
    one = spark.range(1).select(fn.snapshot_suffix(F.lit("2024-01-15 08:00:00")))
    assert one.first()[0] == "2024_01_15"
