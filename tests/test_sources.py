import json
from datetime import date

import pytest
from conftest import rows
from pyspark.sql import functions as F

from matchvault.operators import cdc
from matchvault.sources import landing, tables


@pytest.fixture
def store(spark, tmp_path):
    return tables.TableStore(spark, str(tmp_path / "store"))


def test_read_and_overwrite_one_table(spark, store):
    name = "detailed.hub"
    assert not store.exists(name) and store.read_or_none(name) is None
    with pytest.raises(LookupError):
        store.read(name)
    store.overwrite(spark.range(3), name)
    assert store.count(name) == 3
    store.overwrite(store.read(name).union(spark.range(10, 12)), name)
    assert rows(store.read(name)) == [(0,), (1,), (10,), (11,), (2,)]
    store.append(spark.range(50, 51), name)
    assert store.count(name) == 6


def test_unfinished_version_is_not_read(spark, store, tmp_path):
    store.overwrite(spark.range(3), "t")
    broken = tmp_path / "store" / "t" / "v=2"
    spark.range(9).write.parquet(str(broken))
    (broken / "_SUCCESS").unlink()
    assert store.read("t").count() == 3
    store.overwrite(store.read("t").filter("id > 0"), "t")
    assert store.read("t").count() == 2
    store.drop_old_versions("t", keep=1)
    assert store.read("t").count() == 2
    assert sorted(p.name for p in (tmp_path / "store" / "t").iterdir() if p.is_dir()) == ["v=2", "v=3"]


def test_failed_write_leaves_the_table(spark, store):
    store.overwrite(spark.range(3), "t")
    bad = store.read("t").select((F.col("id") / F.lit(0)).alias("id"))
    with pytest.raises(Exception):
        store.overwrite(bad, "t")
    assert store.read("t").count() == 3


def test_batch_rerun_adds_nothing(spark, store):
    for n in (5, 4):
        one = spark.range(n).withColumn("_batch_id", F.lit("2024-01-01"))
        store.replace_partitions(one, "operational.games", ["_batch_id"])
    store.replace_partitions(
        spark.range(2).withColumn("_batch_id", F.lit("2024-01-02")), "operational.games", ["_batch_id"]
    )
    got = store.read("operational.games").groupBy("_batch_id").count()
    assert {(str(r[0]), r[1]) for r in got.collect()} == {("2024-01-01", 4), ("2024-01-02", 2)}


def test_snapshots_and_delta(spark, store):
    def load(ds, data):
        df = spark.createDataFrame(data, "id int, v string")
        tables.write_snapshot(store, df, "source.teams", ds, f"{ds} 08:00:00", "API")
        cur = tables.read_snapshot(store, "source.teams", ds)
        prev = tables.read_previous_snapshot(store, "source.teams", ds)
        return cdc.snapshot_delta(cur, prev, ["id"], ["v"], f"{ds} 08:00:00", ds, True)

    assert load("2024-01-01", [(1, "a"), (2, "b")]).count() == 2
    second = load("2024-01-03", [(1, "x"), (3, "c")])
    want = [(1, "x", "False"), (2, "b", "True"), (3, "c", "False")]
    assert rows(second, "id", "v", cdc.DELETED) == want
    # A rerun of the day compares with the day before it, not with itself.
    assert rows(load("2024-01-03", [(1, "x"), (3, "c")]), "id", "v", cdc.DELETED) == want
    log = store.read(tables.LOG)
    assert rows(tables.previous_load(log, "source.teams", "2024-01-03")) == [(date(2024, 1, 1),)]
    assert rows(tables.previous_load(log, "source.teams", "2024-01-01")) == []
    plan = tables.read_snapshot(store, "source.teams", "2024-01-01")
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan._jdf.queryExecution().executedPlan().toString()


def test_json_landing(spark, tmp_path):
    roster = {
        "forwards": [{"id": 1, "firstName": {"default": "Ann"}}],
        "defensemen": [{"id": 2, "firstName": {"fr": "x"}}],
        "goalies": [{"id": 3}],
    }
    for code in ("BOS", "NYR"):
        folder = tmp_path / "roster" / f"triCodeCurrent={code}"
        folder.mkdir(parents=True)
        body = roster if code == "BOS" else {"forwards": [{"id": 9, "firstName": {"default": "Zoe"}}]}
        (folder / "roster.json").write_text(json.dumps(body, indent=1))
    player = "array<struct<id:int,firstName:struct<default:string>>>"
    schema = f"forwards {player}, defensemen {player}, goalies {player}"
    payloads = landing.read_payloads(spark, str(tmp_path / "roster"), schema)
    flat = landing.land_groups(payloads, ["forwards", "defensemen", "goalies"], ["triCodeCurrent"])
    got = landing.flatten_defaults(flat, ["firstName"])
    assert rows(got) == [("BOS", 1, "Ann"), ("BOS", 2, ""), ("BOS", 3, ""), ("NYR", 9, "Zoe")]


def test_arrays_by_date_look_back(spark, tmp_path):
    for day in ("2024-01-01", "2024-01-14", "2024-01-15"):
        folder = tmp_path / "standings" / f"day={day}"
        folder.mkdir(parents=True)
        (folder / "p.json").write_text(json.dumps({"standings": [{"team": "A"}, {"team": "B"}]}))
    payloads = landing.read_payloads(spark, str(tmp_path / "standings"), "standings array<struct<team:string>>")
    recent = landing.look_back(payloads, "day", "2024-01-15")
    got = landing.land_array(recent, "standings", ["day"])
    assert {str(r["day"]) for r in got.collect()} == {"2024-01-14", "2024-01-15"} and got.count() == 4


def test_stamp(spark):
    got = tables.stamp(spark.range(1), "2024-01-01 08:00:00", "API")
    assert got.columns == ["id", "_source_load_datetime", "_source"]


def test_every_write_returns_its_rows(spark, tmp_path):
    store = tables.TableStore(spark, str(tmp_path))
    df = spark.range(25).selectExpr("id", "id % 3 AS part")
    assert store.overwrite(df, "a.t") == 25
    assert store.append(df.where("id < 4"), "a.t") == 4 and store.count("a.t") == 29
    assert store.append(df.where("id < 0"), "a.t") == 0
    assert store.overwrite(df.where("false"), "a.empty") == 0 and store.overwrite(spark.createDataFrame([], df.schema), "a.e") == 0
    assert store.replace_partitions(df, "a.p", ["part"]) == 25
    assert store.replace_partitions(df.where("part = 1 AND id > 10"), "a.p", ["part"]) == 4
    assert store.read("a.p").count() == 25 - 8 + 4
    joined = df.join(df.withColumnRenamed("part", "other"), "id").groupBy("part").count()
    assert store.overwrite(joined, "a.j") == 3
    assert tables.write_snapshot(store, df, "a.s", "2024-01-02", "2024-01-02 08:00:00", "X") == 25


def test_landing_of_odd_payloads(spark):
    rows = [
        (1, '{"turns": [{"n": 1, "name": {"default": "a"}}, {"n": "2", "name": {}}, 5, null, {"n": "x"}]}'),
        (2, '{"turns": []}'), (3, '{"other": [{"n": 1}]}'), (4, '{"turns": [{"n": 1'), (5, None), (6, ""), (7, "[1, 2]"),
        (8, '{"turns": {"n": 1}}'), (9, "null"),
    ]
    got = landing.parsed(spark.createDataFrame(rows, "key int, body string"), "body", ["key"])
    fields = {"n": ("n", "int"), "name": ("name.default", "string", "")}
    landed = landing.land_elements(got, "turns", fields, ["key"]).collect()
    assert sorted(map(tuple, landed), key=str) == [(1, 1, "a"), (1, 2, ""), (1, None, "")]
    entries = landing.land_entries(got, "group", fields, ["key"]).collect()
    assert {(r.key, r.group, r.n) for r in entries} == {(1, "turns", 1), (1, "turns", 2), (1, "turns", None), (3, "other", 1)}
    assert {r.key for r in landing.unreadable(got).collect()} == {4, 5, 6}
    hub = spark.createDataFrame([(k,) for k in (1, 4, 5, 9, 10, 10)], "key int")
    assert {r.key for r in landing.to_fetch(landing.request_keys(hub, "key"), got, "key").collect()} == {4, 5, 10}
    nothing = got.where("false")
    assert landing.land_entries(nothing, "group", fields, ["key"]).count() == 0
