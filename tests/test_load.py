"""Archive reading and the incremental load, on real object files."""

from __future__ import annotations

import datetime as dt
import json
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rookery import schemas, session
from rookery.bindings import streams, views
from rookery.operators import archive, quality
from rookery.plans.load import GameTables, load_documents, load_month, load_run, new_games, on_days, run_period
from rookery.sources import archive as source
from rookery.sources import tables
from rookery.streaming.load import start_load, start_unique_games
from rookery.streaming.runs import file_stream, stream_session

T1 = dt.datetime(2025, 1, 20, 12)
T2 = dt.datetime(2025, 1, 20, 13)


def game(number, end_time=1730419199, **changes):
    side = {"uuid": "u", "username": "n", "rating": 1500, "result": "win"}
    return {
        "url": f"https://x/game/live/{number}",
        "end_time": end_time,
        "time_control": "600",
        "rated": True,
        "time_class": "blitz",
        "rules": "chess",
        "white": side,
        "black": {**side, "result": "resigned"},
        "eco": "https://x/openings/Sicilian-Defense",
        **changes,
    }


FILES = {
    "player/a/games/2024/10": {"games": [game(101), game(102, 1730419200), game(102, 1730419200)]},
    "player/b/games/2024/10": {"games": [game(101), game(103, eco=None, pgn='[ECOUrl "https://x/o/Kings-Gambit"]\n')]},
    "player/c/games/2024/10": {"games": []},
    "player/d/games/2024/10": {},
    "player/e/games/2024/11": {"games": [game(104, accuracies={"white": 90.5})]},
    "leaderboards/2024/10": {"daily": [{"username": "Ann"}]},
}


def write(root, files):
    for name, document in files.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(document if isinstance(document, str) else json.dumps(document))


@pytest.fixture
def root(tmp_path):
    write(tmp_path, FILES)
    return tmp_path


def games_of(spark, target):
    return {r.game_id: r for r in tables.current(spark, target.games).collect()}


def ledger_of(spark, target):
    return {r.gcs_endpoint: r.action_taken for r in tables.current(spark, target.ledger).collect()}


def test_listing(spark, root):
    listed = {r.path for r in source.list_objects(spark, str(root), "2024/10").collect()}
    assert listed == {f"player/{p}/games/2024/10" for p in "abcd"}
    assert source.list_objects(spark, str(root), "1999/01").count() == 0


def test_load_month(spark, root, database):
    result = load_month(spark, str(root), "2024/10", database, T1)
    games = games_of(spark, database)
    assert sorted(games) == [101, 102, 103]
    assert games[101].game_date == dt.date(2024, 10, 31)
    assert games[102].game_date == dt.date(2024, 11, 1)
    assert games[101].opening == "Sicilian Defense" and games[103].opening == "Kings Gambit"
    assert games[101].accuracies is None and games[101].ingested_dt == T1
    assert ledger_of(spark, database) == {
        "player/a/games/2024/10": "Loaded",
        "player/b/games/2024/10": "Loaded",
        "player/c/games/2024/10": "Deleted",
        "player/d/games/2024/10": "Deleted",
    }
    assert {r.gcs_endpoint[7] for r in result.purge.collect()} == {"c", "d"}
    assert result.games.count() == 3 and result.rejects.count() == 0

    again = load_month(spark, str(root), "2024/10", database, T2)
    assert again.games.count() == 0 and again.actions.count() == 0
    assert len(games_of(spark, database)) == 3 and spark.table(database.ledger).count() == 4

    write(root, {"player/z/games/2024/10": {"games": [game(101), game(105)]}})
    later = load_month(spark, str(root), "2024/10", database, T2)
    assert [r.game_id for r in later.games.collect()] == [105]
    assert spark.table(database.games).count() == 4


def test_handled_objects_are_dropped_by_path(spark, root, database):
    load_documents(documents(spark, {"player/a/games/2024/10": FILES["player/a/games/2024/10"]}), database, T1)
    result = load_month(spark, str(root), "2024/10", database, T2)
    assert sorted(games_of(spark, database)) == [101, 102, 103] and len(ledger_of(spark, database)) == 4
    assert result.counts.asDict() == {"rows": 2, "filtered_away": 1, "duplicates_removed": 0, "kept": 1}


ODD = ["b[1]", "c{2}", "d e", "f%20", "g+h", "q'r"]


def test_odd_names(spark, tmp_path, database):
    write(tmp_path, {f"player/{name}/games/2024/10": {"games": [game(i)]} for i, name in enumerate(ODD)})
    dev = load_month(spark, str(tmp_path), "2024/10", database, T1, mode="DEV", dev_endpoint="player/b[1]/games/2024/10")
    assert [r.game_id for r in dev.games.collect()] == [0]
    load_month(spark, str(tmp_path), "2024/10", database, T1)
    assert sorted(games_of(spark, database)) == list(range(len(ODD)))
    assert load_month(spark, str(tmp_path), "2024/10", database, T2).games.count() == 0
    with pytest.raises(ValueError, match="dev_endpoint"):
        load_month(spark, str(tmp_path), "2024/10", database, T1, mode="DEV")


def test_days_are_listed(spark):
    days = spark.sql("SELECT explode(sequence(DATE '2024-01-01', DATE '2024-01-09', INTERVAL 2 DAYS)) AS d")
    table = spark.sql("SELECT explode(sequence(DATE '2023-12-30', DATE '2024-01-20')) AS game_date")
    assert table.where(on_days("game_date", days)).count() == 5


def test_no_objects(spark, root, database):
    assert load_month(spark, str(root), "1999/01", database, T1).games.count() == 0
    assert spark.table(database.games).count() == 0 and spark.table(database.ledger).count() == 0


def test_modes_without_writes(spark, root, database):
    test = load_month(spark, str(root), "2024/10", database, T1, mode="TEST", test_volume=1)
    assert {r.game_id for r in test.games.collect()} == {101, 102}
    dev = load_month(spark, str(root), "2024/10", database, T1, mode="DEV", dev_endpoint="player/e/games/2024/11")
    (row,) = dev.games.collect()
    assert row.game_id == 104 and tuple(row.accuracies) == (90.5, None)
    assert spark.table(database.games).count() == 0 and spark.table(database.ledger).count() == 0


def test_rerun_after_ledger_failure(spark, root, database, monkeypatch):
    append = tables.append

    def fail_on_ledger(rows, table, partition_column=None):
        if table == database.ledger:
            raise RuntimeError("lost")
        append(rows, table, partition_column)

    monkeypatch.setattr(tables, "append", fail_on_ledger)
    with pytest.raises(RuntimeError):
        load_month(spark, str(root), "2024/10", database, T1)
    monkeypatch.setattr(tables, "append", append)
    load_month(spark, str(root), "2024/10", database, T2)
    assert spark.table(database.games).count() == 3 and len(ledger_of(spark, database)) == 4


def documents(spark, files):
    rows = [(k, v if isinstance(v, str) else json.dumps(v)) for k, v in files.items()]
    return spark.createDataFrame(rows, "endpoint string, body string")


BAD = {
    "player/a/games/2024/10": {"games": [game("abc"), game(1)]},
    "player/b/games/2024/10": {"games": [game(2, white={"uuid": "u", "username": "n", "result": "win"})]},
    "player/c/games/2024/10": '{"games": [',
}


@pytest.mark.parametrize("name", list(BAD))
def test_strict_load_fails_before_writing(spark, database, name):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|white.rating: 1|MALFORMED|malformed"):
        load_documents(documents(spark, {name: BAD[name]}), database, T1)
    assert spark.table(database.games).count() == 0 and spark.table(database.ledger).count() == 0


def test_lenient_load_reports_rejects(spark, database):
    result = load_documents(documents(spark, BAD), database, T1, strict=False)
    assert sorted(games_of(spark, database)) == [1]
    want = [
        ("player/a/games/2024/10", 0, "missing required value"),
        ("player/b/games/2024/10", 0, "missing required value"),
        ("player/c/games/2024/10", None, "malformed document"),
    ]
    rejects = sorted(tuple(r) for r in result.rejects.select("endpoint", "pos", "reason").collect())
    assert rejects == want
    stored = {r.endpoint[7]: r for r in tables.current(spark, database.rejects).collect()}
    assert json.loads(stored["a"].text)["url"].endswith("/abc") and stored["c"].text == BAD["player/c/games/2024/10"]
    # The malformed document is neither handled nor purged.
    assert sorted(ledger_of(spark, database)) == ["player/a/games/2024/10", "player/b/games/2024/10"]
    assert result.purge.count() == 0
    # The second run tries the malformed document again; each reject is kept once.
    load_documents(documents(spark, BAD), database, T2, strict=False)
    assert tables.current(spark, database.rejects).count() == 3


def test_every_reject_of_an_endpoint_is_kept(spark, database):
    name = "player/c/games/2024/10"
    # A table made before parts were kept.
    spark.sql(f"DROP TABLE {database.rejects}")
    old = StructType([f for f in schemas.LOAD_REJECTS if f.name != "part"])
    tables.ensure_table(spark, database.rejects, old, "rejected_date")
    GameTables.create(spark, database.rejects.split(".")[0])
    texts = ['{"games": [', '{"games": [{', '{"games": [']
    for text, stored in zip(texts, (1, 2, 2)):
        load_documents(documents(spark, {name: text}), database, T1, strict=False)
        assert tables.current(spark, database.rejects).count() == stored
    for part, stored in ((1, 3), (2, 4), (2, 4)):
        load_documents(documents(spark, {name: texts[0]}).withColumn("part", F.lit(part)), database, T2, strict=False)
        assert tables.current(spark, database.rejects).count() == stored
    # Bad games in the same place of different documents.
    for number, stored in (("x", 5), ("y", 6), ("x", 6)):
        body = {name: {"games": [game(number)]}}
        load_documents(documents(spark, body), database, T2, strict=False, by_endpoint=False)
        assert tables.current(spark, database.rejects).count() == stored


def test_lenient_stream_keeps_every_reject(spark, database, tmp_path):
    landing, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")
    good = {"player/z/games/2024/10": {"games": [game(9)]}}
    for files in ({k: v for k, v in BAD.items() if k[7] != "a"} | good, {k: BAD[k] for k in BAD if k[7] == "a"}):
        responses = documents(spark, files).select(F.concat(F.lit("https://x/pub/"), "endpoint").alias("url"), "body")
        source.land_responses(responses, landing)
        stream = file_stream(spark, landing, schemas.readable(schemas.LANDING), max_files=1)
        start_load(stream.select("endpoint", "body"), database, checkpoint, strict=False).awaitTermination()
    assert sorted(games_of(spark, database)) == [1, 9]
    assert sorted(r.endpoint[7] for r in tables.current(spark, database.rejects).collect()) == ["a", "b", "c"]


def test_staged_games_hold_no_bodies(spark, database, monkeypatch):
    seen = {}
    stage = tables.stage

    def spy(rows, label):
        seen[label] = rows.columns
        return stage(rows, label)

    monkeypatch.setattr(tables, "stage", spy)
    load_documents(documents(spark, FILES).where("endpoint LIKE 'player/%'"), database, T1)
    assert not {"body", "game", "games", "pgn"} & set(seen["staged"])


def test_any_split_of_endpoints_gives_the_same_table(spark, database):
    files = {k: v for k, v in FILES.items() if k.startswith("player/")}
    for name in reversed(files):
        load_documents(documents(spark, {name: files[name]}), database, T1)
    assert sorted(games_of(spark, database)) == [101, 102, 103, 104]
    assert len(ledger_of(spark, database)) == 5


def test_stream_load(spark, database, tmp_path):
    files = {k: v for k, v in FILES.items() if k.startswith("player/")}
    landing, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")

    def land(names):
        responses = documents(spark, {k: files[k] for k in names}).select(
            F.concat(F.lit("https://x/pub/"), "endpoint").alias("url"), "body"
        )
        unknown = responses.limit(1).withColumn("url", F.lit("https://x/pub/other"))
        assert source.land_responses(responses.union(unknown), landing).count() == 1

    def run():
        stream = file_stream(spark, landing, schemas.readable(schemas.LANDING), max_files=1)
        start_load(stream.select("endpoint", "body"), database, checkpoint).awaitTermination()

    land(list(files)[:2])
    run()
    assert sorted(games_of(spark, database)) == [101, 102, 103]
    land(list(files))
    run()
    run()
    assert sorted(games_of(spark, database)) == [101, 102, 103, 104]
    assert spark.table(database.games).count() == 4 and spark.table(database.ledger).count() == 5
    assert source.read_landing(spark, landing, "2024/11").count() == 1


PARTS = [{"games": []}, {"games": [game(1)]}, {"games": [game(1), game(2)]}, {"games": [game("x"), game(3)]}]


def test_stream_loads_every_part_of_an_endpoint(spark, database, tmp_path):
    landing, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")
    name = "player/a/games/2024/10"
    for document in PARTS:
        responses = documents(spark, {name: document}).select(F.lit(f"https://x/pub/{name}").alias("url"), "body")
        source.land_responses(responses, landing)
    for _ in range(2):
        stream = file_stream(spark, landing, schemas.readable(schemas.LANDING), max_files=1).select("endpoint", "body")
        start_unique_games(stream, database, checkpoint, T1).awaitTermination()
    ids = [r.game_id for r in tables.current(spark, database.games).collect()]
    assert sorted(ids) == [1, 2, 3]
    assert tables.current(spark, database.rejects).count() == 1
    # Loaded once; if the part without games came first, after a row that says so.
    actions = [r.action_taken for r in tables.current(spark, database.ledger).collect()]
    assert actions.count("Loaded") == 1 and actions.count("Deleted") <= 1


def test_stream_of_unique_games_takes_its_months_from_the_data(spark, monkeypatch):
    monkeypatch.setattr(views, "ARCHIVE_START", 1704067200)
    found = streams.stream_dedup(spark, "/root/testdata/sf0.001")
    orders = views.table(spark, "/root/testdata/sf0.001", "orders").count()
    assert found.count() == found.select("game_id").distinct().count() == orders


def test_contract(spark):
    exploded = archive.explode_games(archive.parse_documents(documents(spark, FILES)))
    rows = archive.games_rows(exploded, T1)
    paths = list(schemas.required_paths(schemas.GAMES))
    assert "white.rating" in paths and "accuracies" not in paths and len(paths) == 21
    assert quality.violations(rows, paths).where("violations > 0").count() == 0
    broken = rows.withColumn("rules", F.when(F.col("game_id") != 101, F.col("rules")))
    assert [tuple(r) for r in quality.violations(broken, paths).where("violations > 0").collect()] == [("rules", 2)]
    good, bad = quality.split_rejects(broken, paths)
    assert (good.count(), bad.count()) == (4, 2)
    with pytest.raises(quality.ContractError, match="rules: 2"):
        quality.check(broken, paths)


def test_table_scan_is_pruned_and_exchanged_once(spark, root, database):
    load_month(spark, str(root), "2024/10", database, T1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        batch = archive.games_rows(archive.explode_games(archive.parse_documents(documents(spark, FILES))), T1)
        table = spark.table(database.games).where(on_days("game_date", batch.select("game_date")))
        text = new_games(batch, table)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "LeftAnti" in text and text.count("Exchange hashpartitioning") == 2
    assert "PartitionFilters: [game_date" in text
    assert text.count("from_json") == 1


def test_tables(spark):
    name = f"t_{uuid.uuid4().hex}"
    tables.ensure_database(spark, name)
    schema = schemas.RUNS_TRIGGERED
    for _ in range(2):
        tables.ensure_table(spark, f"{name}.runs", schema, "run_start_date")
    assert sorted(spark.table(f"{name}.runs").columns) == sorted(schema.fieldNames())
    values = ("r", dt.date(2025, 1, 1), T1, "s.py", "PROD", "h", "3")
    rows = spark.createDataFrame([values], schema)
    tables.append(rows.select(*reversed(rows.columns)), f"{name}.runs", "run_start_date")
    (stored,) = tables.query(spark, "SELECT * FROM {runs} WHERE run_id = :id", {"id": "r"}, runs=spark.table(f"{name}.runs")).collect()
    assert stored.hostname == "h" and stored.run_start_dt == T1
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_leaderboard_snapshots(spark, tmp_path):
    boards = spark.createDataFrame([('{"daily":[{"username":"Ann"}]}',)], "body string")
    for _ in range(2):
        source.write_leaderboards(boards, str(tmp_path / "now"), T1)
        source.append_leaderboards(boards, str(tmp_path / "dated"), T1)
    assert spark.read.parquet(str(tmp_path / "now")).count() == 1
    dated = spark.read.parquet(str(tmp_path / "dated"))
    assert dated.count() == 2 and dated.first().snapshot_date == T1.date()
    assert archive.leaderboard_players(dated).count() == 1


class Conf(dict):
    """Stand-in for a session: only its settings."""

    @property
    def conf(self):
        return self


def test_scratch_folder(spark):
    assert session.scratch_path(spark, "a") != session.scratch_path(spark, "a")
    shared = Conf({"spark.checkpoint.dir": "hdfs://shared/", "spark.master": "yarn"})
    assert session.scratch_path(shared, "a").startswith("hdfs://shared/a-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_root(Conf({"spark.master": "yarn"}))
    local = Conf({"spark.master": "local[2]", "spark.app.id": "app"})
    assert session.scratch_root(local) == session.scratch_root(local)


def test_actions_of_unparsed_documents(spark):
    bodies = {
        "a": '{"games": [{"url": "x/1", "rated": "not a boolean"}]}',
        "b": '{"games": []}',
        "c": "{}",
        "d": '{"games": null}',
        "e": '{"games": [{}], "more": {"games": []}}',
    }
    docs = [(f"player/{k}/games/2025/04", v) for k, v in bodies.items()] + [("player/b/games/2025/04", bodies["a"])]
    frame = spark.createDataFrame(docs, "endpoint string, body string")
    found = {r.gcs_endpoint[7]: r.action_taken for r in archive.document_actions(frame, T1).collect()}
    assert found == {"a": "Loaded", "b": "Loaded", "c": "Deleted", "d": "Deleted", "e": "Loaded"}
    cut = frame.union(spark.createDataFrame([("player/z/games/2025/04", '{"games": [')], frame.schema))
    lenient = {r.gcs_endpoint[7] for r in archive.document_actions(cut, T1, strict=False).collect()}
    assert lenient == set(bodies)
    with pytest.raises(Exception):
        archive.document_actions(cut, T1).collect()


DAY = 86400


def _land_and_run(spark, database, folder, files, seen):
    """Land documents in one file each, and run the stream of unique games; the days each batch read."""
    landing, checkpoint = f"{folder}/landing", f"{folder}/checkpoint"
    responses = documents(spark, files).select(F.concat(F.lit("https://x/pub/"), "endpoint").alias("url"), "body")
    source.land_responses(responses, landing)
    stream = file_stream(stream_session(spark), landing, schemas.readable(schemas.LANDING), max_files=1)
    start_unique_games(
        stream.select("endpoint", "body"), database, checkpoint, T1, on_batch=lambda r: seen.append((r.days, r.counts.kept))
    ).awaitTermination()


def test_near_copies_end_in_the_state(spark, database, tmp_path):
    """Months in reverse order, and all games again under another player: the table is not asked a second time."""
    months = {f"2024/{m:02d}": [game(m * 10 + i, 1704067200 + (m * 30 + i) * DAY) for i in range(3)] for m in (9, 7, 5)}
    first, second = [], []
    for period, games in months.items():
        _land_and_run(spark, database, tmp_path, {f"player/a/games/{period}": {"games": games}}, first)
    assert [len(days) for days, _ in first if days] == [3, 3, 3] and sum(kept for _, kept in first) == 9
    for period, games in reversed(months.items()):
        _land_and_run(spark, database, tmp_path, {f"player/b/games/{period}": {"games": games}}, second)
    assert sum(len(days) for days, _ in second) == 0
    assert len(games_of(spark, database)) == tables.current(spark, database.games).count() == 9
    # What the copies' documents are is known all the same.
    assert {r.action_taken for r in tables.current(spark, database.ledger).collect()} == {"Loaded"}
    assert len(ledger_of(spark, database)) == 6


def test_copies_the_state_has_forgotten_meet_the_table(spark, database, tmp_path):
    files = {"player/a/games/2024/09": {"games": [game(1), game(2)]}, "player/c/games/2024/09": {"games": []}}
    _land_and_run(spark, database, tmp_path / "one", files, [])
    seen = []
    # Another checkpoint knows nothing.
    _land_and_run(spark, database, tmp_path / "two", {"player/b/games/2024/09": {"games": [game(1), game(3)]}}, seen)
    assert sum(len(days) for days, _ in seen) == 1 and sum(kept for _, kept in seen) == 1
    assert sorted(r.game_id for r in tables.current(spark, database.games).collect()) == [1, 2, 3]
    actions = {r.gcs_endpoint[7]: r.action_taken for r in tables.current(spark, database.ledger).collect()}
    assert actions == {"a": "Loaded", "b": "Loaded", "c": "Deleted"}


def test_a_load_measures_while_it_writes(spark, database):
    files = {k: v for k, v in FILES.items() if k.startswith("player/")}
    result = load_documents(documents(spark, files), database, T1)
    assert result.counts.asDict() == {"rows": 6, "filtered_away": 0, "duplicates_removed": 2, "kept": 4}
    assert result.days == [dt.date(2024, 10, 31), dt.date(2024, 11, 1)]
    context = spark.sparkContext
    context.setJobGroup("second load", "")
    try:
        load_documents(documents(spark, files), database, T2)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    # No job for the contract, the days, the months or the counts.
    assert len(context.statusTracker().getJobIdsForGroup("second load")) <= 12


def test_repeated_rejects_compare_hashes(spark, database):
    load_documents(documents(spark, BAD), database, T1, strict=False)
    stored = tables.current(spark, database.rejects)
    assert {r.game_month for r in stored.collect()} == {dt.date(2024, 10, 1)}
    assert all(r.text_hash for r in stored.collect())
    # A row of before, without hash and month.
    old = stored.where("endpoint LIKE '%/c/%'").withColumns(
        {"endpoint": F.lit("player/d/games/2024/10"), "text_hash": F.lit(None).cast("string"), "game_month": F.lit(None).cast("date")}
    )
    tables.append(tables.stage(old, "old"), database.rejects, "rejected_date")
    again = BAD | {"player/d/games/2024/10": BAD["player/c/games/2024/10"]}
    load_documents(documents(spark, again), database, T2, strict=False)
    assert tables.current(spark, database.rejects).count() == 4


def test_run_loads_the_period_of_its_mode(spark, root, database):
    assert run_period(spark, dt.date(2024, 11, 20), "PROD") == "2024/10"
    assert run_period(spark, dt.date(2024, 11, 20), "TEST", dt.date(2024, 3, 5)) == "2024/03"
    result = load_run(spark, str(root), dt.date(2024, 11, 4), database, T1)
    assert sorted(games_of(spark, database)) == [101, 102, 103] and result.counts.kept == 3
    test = load_run(spark, str(root), dt.date(2025, 1, 1), database, T1, mode="TEST", start=dt.date(2024, 11, 1), test_volume=5)
    assert [r.game_id for r in test.games.collect()] == [104]
    assert len(games_of(spark, database)) == 3
