"""Gold states folded by season, datasets of one's own, and sources side by side."""

import random
import time
import uuid
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake.operators import form, records, standings
from matchlake.operators.quality import Rule
from matchlake.plans import jobs
from matchlake.plans.incremental_gold import GoldState

MATCH = "match_id string, season string, league string, match_date date, home_team string, away_team string, home_goals bigint, away_goals bigint, home_xg double, away_xg double, result string, venue string"


def played(spark, seasons, seed=1):
    draw, rows = random.Random(seed), []
    for number in range(120):
        season = draw.choice(seasons)
        home, away = draw.sample("ABCDE", 2)
        goals = (None, None) if number % 9 == 0 else (draw.randint(0, 4), draw.randint(0, 4))
        result = None if goals[0] is None else "HAD"[(goals[0] < goals[1]) + 2 * (goals[0] == goals[1])]
        rows.append((f"{season}-{number}", season, draw.choice("xy"), date(int(season[:4]), 1, 1) + timedelta(draw.randint(0, 300)), home, away, *goals, 0.5, 0.25, result, "v"))
    return spark.createDataFrame(rows, MATCH)


def same(a, b):
    columns = sorted(b.columns)
    return sorted(map(str, a.select(columns).collect())) == sorted(map(str, b.select(columns).collect()))


def test_states_equal_the_full_build(spark, tmp_path):
    first, second = played(spark, ["2021-22", "2022-23"]), played(spark, ["2022-23", "2023-24"], 2)
    whole = first.where("season < '2022'").unionByName(second)
    state = GoldState(spark, f"{tmp_path}/state", 3)
    state.refresh(first)
    state.refresh(second)
    state.refresh(second)
    assert same(state.head_to_head(), records.head_to_head(whole))
    assert same(state.team_form(), form.team_form(whole, 3)) and same(state.team_form(2), form.team_form(whole, 2))
    assert same(state.league_standings(), standings.league_standings(whole))
    state.refresh(second.where("season > '2023'"), emptied=["2022-23"])
    left = whole.where("season <> '2022-23'")
    assert same(state.head_to_head(), records.head_to_head(left)) and same(state.team_form(), form.team_form(left, 3))


def test_a_state_tells_no_more_than_it_holds(spark, tmp_path):
    state = GoldState(spark, f"{tmp_path}/state", 3)
    with pytest.raises(FileNotFoundError):
        state.head_to_head()
    state.refresh(played(spark, ["2021-22"]))
    with pytest.raises(ValueError, match="last 3"):
        state.team_form(4)


def test_a_refresh_reads_only_what_it_is_given(spark, tmp_path):
    state = GoldState(spark, f"{tmp_path}/state")
    state.refresh(played(spark, ["2021-22", "2022-23"]))
    before = {r[0] for r in spark.read.parquet(f"{tmp_path}/state/pairs").where("season = '2021-22'").select("_metadata.file_path").collect()}
    state.refresh(played(spark, ["2022-23"], 3))
    after = {r[0] for r in spark.read.parquet(f"{tmp_path}/state/pairs").where("season = '2021-22'").select("_metadata.file_path").collect()}
    assert before == after


def rugby(tmp_path, schema, **more):
    def build(spark, lake, season):
        rows = [("1", season, "A", 10), ("2", season, None, 3)]
        return spark.createDataFrame(rows, "game_id string, season string, team string, tries int")

    bronze = "game_id string, season string, team string, tries int, date string"
    refined = jobs.Refinement(
        "rugby", "games", "rugby_games", lambda snapshots, lookup: snapshots.select("game_id", "season", "team", (F.col("tries") * 5).alias("points")),
        T.StructType.fromDDL(bronze), T.StructType.fromDDL("game_id string, season string, team string, points int"), (Rule("team", "not_null"),),
    )
    return jobs.Lake(f"{tmp_path}/landing", f"{tmp_path}/bronze", f"{tmp_path}/silver", schema, seasons={"rugby": ["2023", "2024"], "football": ["2024"]}, sources=[jobs.Source("rugby", "games", build)], refined=[refined], **more)


@pytest.mark.parametrize("parallel", [1, 3])
def test_own_sources_run_with_the_others(spark, tmp_path, parallel):
    schema = f"own_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE SCHEMA {schema} LOCATION '{tmp_path}/{schema}'")
    lake = rugby(tmp_path, schema, quarantine=f"{tmp_path}/aside")
    outcomes = jobs.ingest(spark, lake, parallel=parallel)
    assert [(o.source, o.rows, o.error is None) for o in outcomes] == [
        ("football/games/2024", 0, False), ("football/player_stats/2024", 0, False), ("football/team_stats/2024", 0, False),
        ("rugby/games/2023", 2, True), ("rugby/games/2024", 2, True),
    ]
    (outcome,) = jobs.refine(spark, lake)
    assert (outcome.source, outcome.rows, outcome.rejected) == ("rugby/games", 2, 2)
    assert sorted(tuple(r) for r in spark.table(f"{schema}.rugby_games").select("season", "points").collect()) == [("2023", 50), ("2024", 50)]


def test_one_source_can_be_cancelled(spark, tmp_path):
    def build(spark, lake, season):
        rows = spark.range(0, 4, 1, 4).withColumn("season", F.lit(season))
        if season == "slow":
            return rows.where(F.udf(lambda: time.sleep(8) or True, "boolean")())
        time.sleep(4)
        spark.sparkContext.cancelJobsWithTag(jobs.source_tag("chess", "slow"))
        return rows

    lake = jobs.Lake("", f"{tmp_path}/b", "", seasons={"chess": ["slow", "quick"]}, sources=[jobs.Source("chess", "games", build)])
    slow, quick = jobs.ingest(spark, lake, "chess", parallel=2)
    assert slow.error and "cancel" in slow.error.lower() and (quick.rows, quick.error) == (4, None)
