"""Checked loads, quarantine, drifting files, input order, alias files and repeated deliveries, on small inputs."""

import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake import schemas
from matchlake.operators import top_n
from matchlake.operators.quality import Rule
from matchlake.operators.top_n import deduplicate_in_order
from matchlake.plans import jobs
from matchlake.sinks import writers
from matchlake.sinks.checked import EXISTING, REPEATED, Refused, load_checked
from matchlake.sinks.quarantine import TooManyRejected, fork
from matchlake.sources import aliases, scans
from matchlake.streaming.dedupe import dedupe_stream


@pytest.fixture
def gold(spark, tmp_path):
    schema = f"checked_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE SCHEMA {schema} LOCATION '{tmp_path}/{schema}'")
    writers.init_schema(spark, schema)
    return schema


def games(spark, *rows):
    return spark.createDataFrame(rows, "game_id string, season string, home_team_id int, home_team string, away_team_id int, away_team string")


def ids(spark, schema, table="nba_games"):
    return sorted(r[0] for r in spark.table(f"{schema}.{table}").select("game_id").collect())


def test_a_batch_is_loaded_whole_or_not_at_all(spark, gold):
    assert load_checked(games(spark, ("1", "a", 1, "X", 2, "Y"), ("2", "a", 2, "Y", 1, "X")), "nba_games", gold) == 2
    bad = games(spark, ("2", "b", 1, "X", 2, "Y"), ("3", "b", 1, None, 2, "Y"), ("4", "b", 1, "X", 2, "Y"), ("4", "b", 1, "X", 2, "Y"), (None, "b", 1, "X", 2, "Y"), ("5", "b", 1, "X", 2, "Y"))
    with pytest.raises(Refused) as refused:
        load_checked(bad, "nba_games", gold)
    assert refused.value.counts == {EXISTING: 1, REPEATED: 2, "home_team is NULL": 1, "game_id is NULL": 1}
    kept = {(r["game_id"], tuple(r["reasons"])) for r in refused.value.rows(spark).collect()}
    assert kept == {("2", (EXISTING,)), ("3", ("home_team is NULL",)), ("4", (REPEATED,)), (None, ("game_id is NULL",))}
    assert ids(spark, gold) == ["1", "2"]


def test_replace_keeps_the_declaration(spark, gold):
    before = spark.sql(f"DESCRIBE {gold}.nba_player_games").collect()
    player = spark.createDataFrame([(7, "P", 1, "X")], "player_id int, player_name string, team_id int, team string")
    assert load_checked(player, "nba_player_games", gold, "replace") == 1
    assert spark.sql(f"DESCRIBE {gold}.nba_player_games").collect() == before
    row = spark.table(f"{gold}.nba_player_games").first()
    assert (row["points"], row["minutes"]) == (0, 0)
    with pytest.raises(Refused):
        load_checked(player.withColumn("team", F.lit(None).cast("string")), "nba_player_games", gold, "replace")
    assert spark.table(f"{gold}.nba_player_games").count() == 1
    with pytest.raises(ValueError, match="no columns"):
        load_checked(player.withColumn("shoe_size", F.lit(1)), "nba_player_games", gold)


def test_replace_compares_with_no_old_key_and_empty_changes_nothing(spark, gold):
    rows = games(spark, ("1", "a", 1, "X", 2, "Y"))
    assert load_checked(rows, "nba_games", gold, "replace") == load_checked(rows, "nba_games", gold, "replace") == 1
    assert load_checked(rows.limit(0), "nba_games", gold, "replace") == 0
    assert ids(spark, gold) == ["1"]
    with pytest.raises(ValueError, match="mode"):
        load_checked(rows, "nba_games", gold, "upsert")


def test_pruned_lookup_reads_the_seasons_of_the_batch(spark, gold):
    load_checked(games(spark, ("1", "a", 1, "X", 2, "Y"), ("2", "b", 1, "X", 2, "Y")), "nba_games", gold)
    with pytest.raises(Refused):
        load_checked(games(spark, ("2", "b", 1, "X", 2, "Y")), "nba_games", gold, prune="season")
    assert load_checked(games(spark, ("3", "b", 1, "X", 2, "Y")), "nba_games", gold, prune="season") == 1


def test_a_key_with_most_rows_is_refused_with_all_of_them(spark, gold):
    hot = spark.range(1000).select(F.when(F.col("id") < 700, "hot").otherwise(F.col("id").cast("string")).alias("game_id"), F.lit("X").alias("home_team"), F.lit("Y").alias("away_team"))
    with pytest.raises(Refused) as refused:
        load_checked(hot, "nfl_games", gold)
    assert refused.value.counts == {REPEATED: 700}


def test_fork_counts_and_stops(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a", 3), (2, None, -1), (3, "c", None), (4, "d", -2)], "id int, name string, score int")
    rules = [Rule("name", "not_null"), Rule("score", "at_least", 0)]
    forked = fork(rows, rules, f"{tmp_path}/q")
    assert sorted(r["id"] for r in forked.accepted.collect()) == [1, 3] and forked.accepted.columns == rows.columns
    assert {r["id"]: r["reasons"] for r in forked.quarantined.collect()} == {2: ["name: not_null", "score: at_least 0"], 4: ["score: at_least 0"]}
    assert (forked.rows, forked.rejected, forked.violations) == (4, 2, {"name: not_null": 1, "score: at_least 0": 2})
    with pytest.raises(TooManyRejected) as stopped:
        fork(rows, rules, f"{tmp_path}/q2", limit=0.25)
    assert stopped.value.forked.quarantined.count() == 2
    assert fork(rows.limit(0), rules, f"{tmp_path}/q3").rejected == 0


def test_refine_sets_rows_aside_or_stops(spark, tmp_path):
    columns = {f.name: F.lit(None).cast(f.dataType) for f in schemas.bronze("football/games")}
    rows = spark.createDataFrame([("1", "A", "B", 3, 1), ("2", None, "B", 3, 1), ("3", "A", "B", -3, 1)], "g string, h string, a string, hs int, as int")
    types = {f.name: f.dataType for f in schemas.bronze("football/games")}
    given = {"game_id": "g", "home_team": "h", "away_team": "a", "home_score": "hs", "away_score": "as"}
    games = rows.select(*[(F.col(given[c]).cast(types[c]) if c in given else F.lit("2024").cast(types[c]) if c == "season" else value).alias(c) for c, value in columns.items()])
    writers.write_snapshot(games, f"{tmp_path}/bronze", "football", "games", "2024-01-01")
    schema = f"refined_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE SCHEMA {schema} LOCATION '{tmp_path}/{schema}'")
    lake = jobs.Lake("", f"{tmp_path}/bronze", f"{tmp_path}/silver", schema, quarantine=f"{tmp_path}/aside", max_rejected=0.7)
    (outcome,) = jobs.refine(spark, lake)
    assert (outcome.rows, outcome.rejected) == (1, 2) and ids(spark, schema, "nfl_games") == ["1"]
    lake.max_rejected = 0.1
    with pytest.raises(TooManyRejected):
        jobs.refine(spark, lake)
    assert ids(spark, schema, "nfl_games") == ["1"]


def test_files_whose_types_drift(spark, tmp_path):
    parts = {"1": "1 AS n, 1 AS m, 'x' AS t", "2": "CAST(2 AS BIGINT) AS n, 2.5D AS m, 7 AS t", "3": "3.5D AS n, 'x' AS t", "4": "4 AS n, true AS b", "5": "CAST(5 AS SMALLINT) AS n, DATE'2024-01-01' AS d", "6": "6 AS n, TIMESTAMP'2024-01-02 03:00:00' AS d"}
    for day, columns in parts.items():
        spark.sql(f"SELECT {columns}").write.parquet(f"{tmp_path}/tree/date={day}")
    found = scans.scan_tree(spark, f"{tmp_path}/tree", "part-*.parquet", with_source=True)
    assert [f"{f.name} {f.dataType.simpleString()}" for f in found.schema] == ["n double", "m double", "t string", "source_file string", "b boolean", "d timestamp"]
    rows = sorted(tuple(r) for r in found.select("n", "m", "t").collect())
    assert rows == [(1.0, 1.0, "x"), (2.0, 2.5, "7"), (3.5, None, "x"), (4.0, None, None), (5.0, None, None), (6.0, None, None)]


def test_widest_types():
    byte, long, text = T.ByteType(), T.LongType(), T.StringType()
    assert scans.widest([byte, long]) == long and scans.widest([long, T.FloatType()]) == T.DoubleType()
    assert scans.widest([T.DateType(), T.TimestampNTZType()]) == T.TimestampNTZType()
    assert scans.widest([T.NullType(), byte]) == byte and scans.widest([long, text]) == scans.widest([T.BooleanType(), long]) == text
    assert scans.widest([T.ArrayType(long), T.ArrayType(long)]) == T.ArrayType(long)


@pytest.mark.parametrize("keep, wanted", [("last", {(1, "c1"), (2, "b9"), (None, "a2")}), ("first", {(1, "a1"), (2, "b0"), (None, "a0")})])
def test_input_order_decides(spark, tmp_path, keep, wanted):
    files = {"a": [(None, "a0"), (1, "a1"), (None, "a2")], "b": [(2, "b0"), (1, "z"), (2, "b9")], "c": [(1, "c1")]}
    for name, rows in files.items():
        spark.createDataFrame(rows, "k int, v string").coalesce(1).write.parquet(f"{tmp_path}/order/{name}")
    found = scans.scan_tree(spark, f"{tmp_path}/order", "part-*.parquet", with_position=True)
    kept = deduplicate_in_order(found, ["k"], scans.POSITION, keep)
    assert kept.columns == ["k", "v"] and {tuple(r) for r in kept.collect()} == wanted


def test_positions_hold_numbers_of_files_in_order_of_their_paths(spark, tmp_path):
    for name in ("z", "b c", "b%20c", "é+x", "q#r", "k=v"):
        spark.range(2).coalesce(1).write.parquet(f"{tmp_path}/tree/{name}")
    found = scans.scan_tree(spark, f"{tmp_path}/tree", "part-*.parquet", with_source=True, with_position=True)
    assert found.schema[scans.POSITION].dataType.simpleString() == "struct<file:int,row_index:bigint>"
    rows = sorted((r["source_file"], r["id"], tuple(r[scans.POSITION])) for r in found.collect())
    assert [p for *_, p in rows] == [(n, i) for n in range(6) for i in range(2)] and [i for _, i, _ in rows] == [0, 1] * 6
    spark.sql("SELECT 'x' AS id").write.parquet(f"{tmp_path}/tree/a")
    drifted = scans.scan_tree(spark, f"{tmp_path}/tree", "part-*.parquet", with_position=True)
    assert {(r["id"], *r[scans.POSITION]) for r in drifted.collect()} == {("x", 0, 0)} | {(str(i), n + 1, i) for n in range(6) for i in range(2)}


def test_input_order_sorts_pieces_of_the_advisory_size(spark, tmp_path):
    n = 40_000
    rows = spark.range(0, n, 1, 8).selectExpr("if(id % 3 = 0, 0, id) AS k", "id AS v", "uuid() AS text")
    rows.write.parquet(f"{tmp_path}/hot")
    found = scans.scan_tree(spark, f"{tmp_path}/hot", "part-*.parquet", with_position=True)
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(advisory)
    try:
        spark.conf.set(advisory, "64k")
        near = top_n._near(found, ["k"]).groupBy(F.spark_partition_id())
        sizes = [r["n"] for r in near.agg(F.count("text").alias("n")).collect()]
        kept = deduplicate_in_order(found, ["k"], scans.POSITION)
        plan = kept._jdf.queryExecution().executedPlan().toString()
        first = plan[plan.rindex("+- Sort") :]
        got = {tuple(r) for r in kept.select("k", "v").collect()}
    finally:
        spark.conf.set(advisory, before)
    assert sum(sizes) == n and max(sizes) < n / 6  # the hot key has n / 3
    assert "REBALANCE" in first and "file_path" not in first[: first.index("Exchange")]
    assert got == {(i, i) for i in range(n) if i % 3} | {(0, (n - 1) // 3 * 3)}


@pytest.mark.parametrize("keep, wanted", [("last", 5), ("first", 0)])
def test_input_order_without_keys_or_parts(spark, keep, wanted):
    rows = spark.range(6).selectExpr("id", "id AS position", "id % 2 AS k")
    assert [r["id"] for r in deduplicate_in_order(rows, [], "position", keep).collect()] == [wanted]
    assert {r["id"] for r in deduplicate_in_order(rows, ["k"], "position", keep).collect()} == ({4, 5} if keep == "last" else {0, 1})


def test_lines_of_landing_files_have_places(spark, tmp_path):
    for name, text in {"a": "id,full_name\n1,x\n2,y\n1,z\n", "b": "id,full_name\n2,w\n"}.items():
        (tmp_path / f"{name}.csv").write_text(text)
    found = scans.scan_landing(spark, str(tmp_path), "teams", "csv", with_position=True)
    kept = deduplicate_in_order(found, ["id"], scans.POSITION)
    assert {(r["id"], r["full_name"]) for r in kept.collect()} == {(1, "z"), (2, "w")}


YAML = """# aliases
soccer:
    Manchester United:   # the red one
        fbref: 'Manchester Utd'
        "short name": Man Utd
    'Queen''s Park':
        feed: "the \\"Spiders\\" # not a comment"
    1. FC Köln:

basketball:
  Philadelphia 76ers:
    nba: 76ers
    abbreviation: ~
"""


def test_yaml_aliases(spark, tmp_path):
    (tmp_path / "a.yaml").write_text(YAML.replace("basketball:\n  Philadelphia 76ers:\n    nba: 76ers\n    abbreviation: ~\n", ""))
    (tmp_path / "b.yaml").write_text("---\r\n" + YAML[YAML.index("basketball") :].replace("\n", "\r\n"))
    entries = aliases.read_alias_yaml(spark, str(tmp_path / "*.yaml"))
    rows = [tuple(r) for r in entries.orderBy("position").drop("position").collect()]
    assert rows == [
        ("soccer", "Manchester United", None, None),
        ("soccer", "Manchester United", "fbref", "Manchester Utd"),
        ("soccer", "Manchester United", "short name", "Man Utd"),
        ("soccer", "Queen's Park", None, None),
        ("soccer", "Queen's Park", "feed", 'the "Spiders" # not a comment'),
        ("soccer", "1. FC Köln", None, None),
        ("basketball", "Philadelphia 76ers", None, None),
        ("basketball", "Philadelphia 76ers", "nba", "76ers"),
        ("basketball", "Philadelphia 76ers", "abbreviation", None),
    ]
    lookup = {(r["alias_lower"], r["canonical"]) for r in aliases.alias_lookup(entries).collect()}
    assert {("man utd", "Manchester United"), ("1. fc köln", "1. FC Köln"), ("76ers", "Philadelphia 76ers")} <= lookup


@pytest.mark.parametrize("text", ["a:\n  - b\n", "a: {b: c}\n", "a:\n  b: c\n", "a:\n  b:\n    c: d\n      e: f\n", "a\n"])
def test_other_yaml_is_an_error(spark, tmp_path, text):
    (tmp_path / "x.yaml").write_text(text)
    with pytest.raises(Exception, match="no block mapping of names"):
        aliases.read_alias_yaml(spark, str(tmp_path / "x.yaml")).collect()


def test_stream_keeps_each_key_once_and_forgets_old_ones(spark, tmp_path):
    def deliver(name, *rows):
        frame = spark.createDataFrame(rows, "id int, at string").select("id", F.to_timestamp("at").alias("at"))
        frame.coalesce(1).write.parquet(f"{tmp_path}/in/{name}")
        return dedupe_stream(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/progress", frame.schema, ["id"], "at", "1 day", 1)

    told = deliver("1", (1, "2024-01-01"), (1, "2024-01-01"), (2, "2024-01-02"))
    told += deliver("2", (2, "2024-01-02"), (3, "2024-02-01"))
    told += deliver("3", (4, "2024-01-01"), (3, "2024-02-01"), (5, "2024-02-02"))
    assert sorted(r["id"] for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [1, 2, 3, 5]
    assert sum(b["late"] for b in told) >= 1 and sum(b["evicted"] for b in told) >= 1 and max(b["state"] for b in told) <= 3
