"""Archive objects in bundles: the same objects as in files of their own, in a few files."""

from __future__ import annotations

import datetime as dt
import json

import pyarrow as pa
import pytest
from pyarrow import fs
from pyspark.sql import functions as F

from rookery.bindings import archive as bound
from rookery.plans.load import load_month
from rookery.sources import archive, bundles, objects
from test_objects import NAMES

PERIODS = ("2024/10", "2024/11", "2025/10")
BODIES = {f"player/{n}/games/{p}": json.dumps({"games": [n, p]}, ensure_ascii=False) for n in NAMES for p in PERIODS}
OTHER = {"leaderboards/2024": "{}", "player/a/profile": "{}"}


def put(spark, root, bodies, parts=3):
    rows = spark.createDataFrame(list(bodies.items()), "endpoint string, body string").repartition(parts)
    objects.write_objects(rows, str(root), bundled=True)


def paths_of(frame):
    return sorted(r.path for r in frame.collect())


def files_of(root):
    return sorted(p for p in root.rglob("*") if p.is_file())


@pytest.fixture
def root(spark, tmp_path):
    put(spark, tmp_path, BODIES | OTHER)
    return tmp_path


def test_write_list_and_read(spark, root):
    want = {p: len(b.encode()) for p, b in BODIES.items()}
    assert {r.path: r.size for r in objects.list_objects(spark, f"file://{root}").collect()} == want
    listed = objects.list_objects(spark, str(root), "2024/10")
    assert {r.path: r.size for r in listed.collect()} == {p: n for p, n in want.items() if p.endswith("2024/10")}
    read = {r.endpoint: r.body for r in objects.read_listed(objects.list_objects(spark, str(root)), str(root)).collect()}
    assert read == BODIES
    read = {r.endpoint: r.body for r in archive.read_objects(spark, str(root), "2024/11").collect()}
    assert read == {p: b for p, b in BODIES.items() if p.endswith("2024/11")}
    assert archive.read_objects(spark, str(root), "1999/01").count() == 0


def test_an_object_is_replaced(spark, root):
    path, empty = "player/a/games/2024/10", "player/b[1]/games/2024/10"
    put(spark, root, {path: "new", empty: "", "player/z/games/2024/10": "z"})
    put(spark, root, {path: "newer"})
    (row,) = archive.read_objects(spark, str(root), "2024/10", path).collect()
    assert row.body == "newer"
    read = {r.endpoint: r.body for r in archive.read_objects(spark, str(root), "2024/10").collect()}
    want = {p: b for p, b in BODIES.items() if p.endswith("2024/10")}
    assert read == want | {path: "newer", empty: "", "player/z/games/2024/10": "z"}


def test_filter_on_the_path_is_taken_by_the_source(spark, root):
    listed = objects.list_objects(spark, str(root))
    some = ["player/b[1]/games/2024/10", "player/ü/games/2024/11", "leaderboards/2024"]
    assert paths_of(listed.where(F.col("path") == some[0])) == some[:1]
    assert paths_of(listed.where(F.col("path").isin(*some, "player/a/games/x"))) == sorted(some)
    reader = objects.ObjectReader({"root": str(root)})
    assert not list(reader.pushFilters([objects.In(("path",), tuple(some))]))
    assert sorted(p for b in reader.partitions() for p in b.paths) == sorted(some)
    assert sorted(r[0] for b in reader.partitions() for r in reader.read(b)) == sorted(some)
    assert listed.where("path = ''").count() == 0


@pytest.mark.parametrize("buckets", (1, 4, 1000))
def test_buckets_part_the_objects(root, buckets):
    reader = objects.ObjectReader({"root": str(root), "buckets": str(buckets)})
    found = [[r[0] for r in reader.read(p)] for p in reader.partitions()]
    assert sorted(sum(found, [])) == sorted(BODIES)
    assert max(map(len, found)) < len(BODIES) or buckets == 1


def test_no_body_crosses_an_exchange(spark, root):
    documents = objects.read_listed(objects.list_objects(spark, str(root), "2024/10"), str(root))
    plan = documents._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("Exchange", 1)
    assert "MapInArrow" in above and "body" in above
    assert "body" not in below and "BatchScan" in below


def test_many_bundles_and_blocks(tmp_path, monkeypatch):
    monkeypatch.setattr(bundles, "BUNDLE_OBJECTS", 50)
    monkeypatch.setattr(bundles, "BUNDLE_BYTES", 10_000)
    monkeypatch.setattr(bundles, "BLOCK_BYTES", 100)
    bodies = {f"player/p{i % 97}/games/{2000 + i // 97}/01": "é" * (i % 90) for i in range(500)} | {"player/q/games/2024/10": "x" * 20_000}
    batch = pa.RecordBatch.from_pydict({"path": list(bodies), "body": list(bodies.values())})
    system, base = fs.LocalFileSystem(), str(tmp_path)
    writer = bundles.BundleWriter(system, base)
    written = writer.write(iter([batch.slice(0, 300), batch.slice(300)]))
    assert not bundles.list_writes(system, base)  # nothing is there before the commit
    writer.commit([written, None])
    assert len(written.names) >= 10
    reader, found = objects.ObjectReader({"root": base}), bundles.BundleReader(system, base)
    rows = [r for p in reader.partitions() for r in reader.read(p)]
    assert len(rows) == len(bodies)
    assert {path: found.body(place, size).decode() for path, size, place in rows} == bodies


def test_a_write_that_fails_leaves_nothing(spark, root):
    before = files_of(root)
    rows = [(f"player/{n}/games/2024/10", None if n == "*" else "new") for n in NAMES]
    with pytest.raises(Exception, match="encode"):
        objects.write_objects(spark.createDataFrame(rows, "endpoint string, body string"), str(root), bundled=True)
    assert paths_of(objects.list_objects(spark, str(root))) == sorted(BODIES)
    assert {r.body for r in archive.read_objects(spark, str(root), "2024/10").collect()}.isdisjoint({"new"})
    assert files_of(root) == before


def test_a_root_holds_one_kind(spark, root, tmp_path_factory):
    one = spark.createDataFrame([("player/a/games/2024/10", "{}")], "endpoint string, body string")
    with pytest.raises(Exception, match="holds bundles"):
        objects.write_objects(one, str(root))
    files = tmp_path_factory.mktemp("files")
    objects.write_objects(one, str(files))
    with pytest.raises(Exception, match="holds files"):
        objects.write_objects(one, str(files), bundled=True)


def test_load_month(spark, root, database, tmp_path):
    """A month's load lists, opens and records bundled objects like others."""
    put(spark, tmp_path / "load", {"player/a/games/2024/10": '{"games": []}', "player/b/games/2024/10": "{}", "player/b/games/2024/11": "{}"})
    result = load_month(spark, str(tmp_path / "load"), "2024/10", database, dt.datetime(2024, 12, 1))
    assert sorted(r.gcs_endpoint for r in result.purge.collect()) == ["player/a/games/2024/10", "player/b/games/2024/10"]
    again = load_month(spark, str(tmp_path / "load"), "2024/10", database, dt.datetime(2024, 12, 2))
    assert again.purge.count() == 0


def test_query_takes_a_few_files(spark, tmp_path, monkeypatch):
    """The objects of many players, repeated and unknown ones among them, are whole and take less disk than their bytes."""
    import duckdb

    rows = [
        (i, None if i % 50 == 7 else i % 800, "OFP"[i % 3], 100.0 + i, dt.datetime(1997, 1, 1), f"{i % 5 + 1}-X")
        for i in range(3000)
    ]
    rows += rows[:40]
    columns = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"
    spark.createDataFrame(rows, columns).write.parquet(str(tmp_path / "orders.parquet"))
    store = tmp_path / "objects"
    monkeypatch.setattr(bound, "scratch_path", lambda _, label: str(store))
    got = [tuple(r) for r in bound.archive_objects(spark, str(tmp_path)).collect()]
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    con.execute(f"CREATE VIEW orders AS SELECT DISTINCT * FROM read_parquet('{tmp_path}/orders.parquet/*.parquet')")
    assert sorted(got) == sorted(con.execute(bound.ORACLE["archive_objects"]).fetchall()) and got
    listed = objects.list_objects(spark, str(store)).agg(F.count("*").alias("n"), F.sum("size").alias("size")).first()
    periods = con.execute(bound._ARCHIVE + "SELECT count(DISTINCT (white_username, period)) FROM v_games WHERE white_username IS NOT NULL").fetchone()
    assert listed.n == periods[0] > 1500
    on_disk = sum(p.lstat().st_blocks * 512 for p in store.rglob("*"))
    assert len(files_of(store)) < 20 and on_disk < listed.size
