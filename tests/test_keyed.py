"""Tables by key hash: results against a dictionary, files of untouched buckets, lost writes."""

import random
from pathlib import Path

import pytest
from conftest import rows

from matchvault.operators import serving
from matchvault.sources.keyed import KeyedTable
from matchvault.sources.tables import TableStore

SCHEMA = "user_id bigint, game_id string, score string, selected_at int"


def batch(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def files(root):
    return {p: p.stat().st_mtime_ns for p in Path(root).rglob("data/g=*/*/*.parquet")}


@pytest.fixture
def bets(spark, tmp_path):
    return serving.bet_table(TableStore(spark, str(tmp_path)), "public.bets", SCHEMA, buckets=16)


def test_batches_against_a_dictionary(spark, bets):
    rnd, want = random.Random(3), {}
    for day in range(4):
        data = [
            (rnd.choice([None, *range(30)]), rnd.choice([None, "", "a", "b"]), f"{day}:{n}", 100 * day + n)
            for n in range(80)
        ]
        bets.upsert(batch(spark, data), ["selected_at"])
        want |= {r[:2]: r for r in data}
        gone = [(u, g) for u, g in want if u is not None and u % 5 == day] + [(999, "a"), (None, "b")]
        bets.delete(spark.createDataFrame(gone, "user_id bigint, game_id string"))
        want = {k: r for k, r in want.items() if k not in gone}
        assert rows(bets.read()) == sorted(want.values(), key=lambda r: [(v is not None, str(v)) for v in r])
    known = next(k for k in want if None not in k)
    assert rows(bets.lookup(user_id=known[0], game_id=known[1])) == [want[known]]
    assert rows(bets.lookup(user_id=999, game_id="a")) == []


def test_files_of_other_buckets_stay(spark, bets, tmp_path):
    assert bets.upsert(batch(spark, [(u, "a", "1:0", 1) for u in range(200)]), ["selected_at"]) == 200
    before, held = files(tmp_path), bets.manifest()
    assert len(held) == 16
    bets.upsert(batch(spark, [(7, "a", "2:0", 2), (7, "a", "3:0", 3)]), ["selected_at"])
    after, now = files(tmp_path), bets.manifest()
    assert {p: t for p, t in after.items() if p in before} == before and len(after) == len(before) + 1
    changed = [b for b in now if now[b] != held[b]]
    assert len(changed) == 1 and rows(bets.lookup(user_id=7, game_id="a")) == [(7, "a", "3:0", 3)]
    read = bets.lookup(user_id=7, game_id="a").inputFiles()
    assert len(read) == 1 and f"_bucket={changed[0]}/" in read[0]
    # A key that is not there touches nothing.
    assert bets.delete(batch(spark, [(5000, "a", None, None)])) == 0 and files(tmp_path) == after


def test_lost_write_and_old_generations(spark, bets, tmp_path):
    bets.upsert(batch(spark, [(u, "a", "1:0", 1) for u in range(50)]), ["selected_at"])
    want = rows(bets.read())
    commit, bets._commit = bets._commit, lambda *a: (_ for _ in ()).throw(OSError("lost"))
    with pytest.raises(OSError):
        bets.upsert(batch(spark, [(1, "a", "9:9", 9)]), ["selected_at"])
    assert rows(bets.read()) == want
    bets._commit = commit
    for n in range(3):
        bets.upsert(batch(spark, [(1, "a", f"{n}:1", 10 + n)]), ["selected_at"])
    now = rows(bets.read())
    assert (1, "a", "2:1", 12) in now and len(now) == 50
    n_files = len(files(tmp_path))
    bets.drop_old_generations(keep=1)
    assert rows(bets.read()) == now and len(files(tmp_path)) < n_files


def test_empty_tables_and_other_columns(spark, tmp_path):
    table = KeyedTable(TableStore(spark, str(tmp_path)), "a.t", ["user_id"], "user_id bigint, team string", 8)
    assert rows(table.read()) == [] and table.delete(spark.range(3).toDF("user_id")) == 0
    change = spark.createDataFrame([(1, "x", 5), (2, "y", 5), (1, "z", 6)], "user_id bigint, team string, at int")
    assert table.upsert(change.where("false"), ["at"]) == 0 and table.manifest() == {}
    assert table.upsert(change, ["at"]) == 2 and rows(table.read()) == [(1, "z"), (2, "y")]
    assert table.delete(change) == 0 and rows(table.read()) == []
    # The number of buckets is kept with the table, empty or not.
    again = KeyedTable(table.store, "a.t", ["user_id"], "user_id bigint, team string", 3)
    assert again._state() == ({}, 8) and again.upsert(change, ["at"]) == 2 and rows(again.read()) == [(1, "z"), (2, "y")]
