"""Web pages: links of the real pages, and tables placed into them."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchlake.operators import bronze, page_tables
from matchlake.workloads import fixtures as fx

SITE = "https://stats.example.org/en"

# What a page's tables say; the check reads this relation, Spark reads the HTML.
_ROWS = """CASE page_id % 3 WHEN 0 THEN 'Oslo FC' WHEN 1 THEN 'Turin & Sons' ELSE 'Cork' END"""
_ESCAPED = f"replace({_ROWS}, '&', '&amp;')"


def pages_with_tables(spark, sf_dir):
    """The given pages with one or two tables after their own markup.

    By page: 0 a direct table below a two-row head, 1 the same inside a comment,
    2 a table without a head, 3 only a table with another id.  Every page also
    has a players' summary, on odd pages twice (once hidden in a comment).
    """
    body = f"""concat(
        '<tbody><tr><th>2024-01-0', 1 + page_id % 9, '</th><td> ', {_ESCAPED}, ' </td>',
        '<td>', page_id % 7, '–', page_id % 5, '</td><td>1.5</td><td>0.5</td>',
        '<td>1,', 100 + page_id % 900, '</td><td><a href="/matches/', page_id,
        '">Match-Report</a></td></tr>',
        '<tr class="spacer x"><td colspan=7></td></tr><tr class="thead"><th>Date</th></tr>',
        '<tr><th>bad date<td><b>A</b> <i>C</i> Milan<td>(4) 1–1 (3)<td><td>x<td>',
        '<td><a href="https://other.example/matches/z', page_id, '">Match-Report</a>',
        ' <a href="/squads/1">Match-Report</a></tr></tbody>')"""
    names = "<th>Date</th><th>Home</th><th>Score</th><th>xG</th><th>xG</th><th>Attendance</th>"
    plain_names = names.replace("th>", "td>")
    schedule = f"""CASE page_id % 4
        WHEN 0 THEN concat('<table class="s" id="sched_all"><thead><tr><th colspan=6>All</th></tr>',
                           '<tr>{names}</tr></thead>', {body}, '</table>')
        WHEN 1 THEN concat('<!-- <table id="sched_all"><thead><tr>{names}</tr></thead>',
                           {body}, '</table> -->')
        WHEN 2 THEN concat('<table id="sched_all"><tr>{plain_names}</tr>', {body}, '</table>')
        ELSE concat('<table id="other"><thead><tr>{names}</tr></thead>', {body}, '</table>') END"""
    player = """concat('<table id="stats_', page_id, '_summary"><thead><tr><th>Player</th>',
        '<th>Min</th><th>Gls</th><th>SoT</th></tr></thead><tbody><tr><td>P', page_id,
        '</td><td>90</td><td>', page_id % 4, '</td><td>n/a</td></tr>',
        '<tr><td></td><td>90</td><td>9</td><td>1</td></tr></tbody></table>')"""
    players = f"""CASE WHEN page_id % 2 = 0 THEN {player}
        ELSE concat({player}, '<!--', replace({player}, '>90<', '>45<'), '-->') END"""
    return fx.table(spark, sf_dir, "pages").select(
        "page_id", F.concat("html", F.expr(schedule), F.expr(players)).alias("html")
    )


def _html_table(spark, d):
    rows = page_tables.table_rows(pages_with_tables(spark, d), page_tables.SCHEDULE_TABLE)
    return _flat(rows)


def _flat(rows):
    """Headers and cells as text, which any engine compares alike."""
    return rows.select(
        "page_id",
        "table_id",
        "in_comment",
        F.col("row_idx").cast("bigint").alias("row_idx"),
        F.array_join("headers", "|").alias("headers"),
        F.array_join("cells", "|", "NULL").alias("cells"),
    )


def _html_player_tables(spark, d):
    rows = page_tables.player_table_rows(pages_with_tables(spark, d))
    typed = page_tables.columns_of(rows, ["page_id", "table_id"], "Player", "Min", "Gls", "SoT")
    players = bronze.soccer_players(typed, season="2024-2025", league="Test League")
    return players.drop("extract_timestamp").withColumn(
        "match_date", F.col("match_date").cast("date")
    )


def _html_match_links(spark, d):
    links = page_tables.match_links(pages_with_tables(spark, d), SITE)
    return links.withColumn("link_idx", F.col("link_idx").cast("bigint"))


_PAGE_HEADERS = ("Date", "Home", "Score", "Away", "Venue")


def match_pages(spark, sf_dir):
    """One schedule page per match; an unplayed match has no score."""
    score = F.concat(F.col("home_goals"), F.lit("–"), F.col("away_goals"))
    cells = [
        F.date_format("match_date", "yyyy-MM-dd"), F.col("home_team"),
        F.coalesce(score, F.lit("")), F.col("away_team"), F.col("venue"),
    ]
    head = "".join(f"<th>{name}</th>" for name in _PAGE_HEADERS)
    return fx.matches(spark, sf_dir).select(
        F.col("match_id").alias("page_id"),
        "league",
        F.concat(
            F.lit(f'<html><table id="sched_all"><thead><tr>{head}</tr></thead><tbody><tr><td>'),
            F.concat_ws("</td><td>", *cells),
            F.lit("</td></tr></tbody></table></html>"),
        ).alias("html"),
    )


def _html_matches(spark, d):
    """Pages of matches read back into typed matches."""
    rows = page_tables.table_rows(match_pages(spark, d), page_tables.SCHEDULE_TABLE)
    texts = page_tables.columns_of(rows, ["page_id", "league"], *_PAGE_HEADERS)
    matches = bronze.soccer_matches(texts, season="all", league=F.col("league"))
    return matches.select(
        "league", F.col("match_date").cast("date").alias("match_date"), "home_team", "away_team",
        "home_goals", "away_goals", "venue", "home_xg",
    )


def _page_links(spark, d):
    links = page_tables.page_links(fx.table(spark, d, "pages"))
    return links.withColumn("link_idx", F.col("link_idx").cast("bigint"))


QUERIES = {
    "page_links": _page_links,
    "html_table": _html_table,
    "html_all_tables": lambda spark, d: _flat(
        page_tables.all_table_rows(pages_with_tables(spark, d))
    ),
    "html_player_tables": _html_player_tables,
    "html_match_links": _html_match_links,
    "html_matches": _html_matches,
}

_SCHEDULE_SQL = f"""
rendered AS (
    SELECT page_id, CASE page_id % 4 WHEN 3 THEN 'other' ELSE 'sched_all' END AS table_id,
           page_id % 4 = 1 AS in_comment, row_idx,
           'Date|Home|Score|xG|xG.1|Attendance|col_6' AS headers,
           CASE row_idx
             WHEN 0 THEN '2024-01-0' || (1 + page_id % 9) || '|' || {_ROWS} || '|'
                  || (page_id % 7) || '–' || (page_id % 5) || '|1.5|0.5|1,'
                  || (100 + page_id % 900) || '|Match-Report'
             ELSE 'bad date|ACMilan|(4) 1–1 (3)|NULL|x|NULL|Match-ReportMatch-Report' END
               AS cells
    FROM (SELECT page_id, CAST(unnest([0, 1]) AS BIGINT) AS row_idx FROM pages)
)"""
_PLAYERS_SQL = """
player_rows AS (
    SELECT page_id, 'stats_' || page_id || '_summary' AS table_id, false AS in_comment, row_idx,
           'Player|Min|Gls|SoT' AS headers,
           CASE row_idx WHEN 0 THEN 'P' || page_id || '|90|' || (page_id % 4) || '|n/a'
                        ELSE 'NULL|90|9|1' END AS cells
    FROM (SELECT page_id, CAST(unnest([0, 1]) AS BIGINT) AS row_idx FROM pages)
)"""

ORACLES = {
    "page_links": """
        WITH found AS (
            SELECT page_id, url, regexp_extract_all(html, '<a [^>]*?href="([^"]*)"', 1) AS hrefs
            FROM pages)
        SELECT page_id, url, CAST(i - 1 AS BIGINT) AS link_idx, hrefs[i] AS href
        FROM found, LATERAL (SELECT unnest(range(1, len(hrefs) + 1)) AS i)""",
    "html_table": f"""WITH {_SCHEDULE_SQL}
        SELECT * FROM rendered WHERE table_id = 'sched_all'""",
    "html_all_tables": f"""WITH {_SCHEDULE_SQL}, {_PLAYERS_SQL}
        SELECT * FROM rendered UNION ALL SELECT * FROM player_rows""",
    "html_player_tables": """
        SELECT '2024-2025' AS season, 'Test League' AS league, CAST(NULL AS DATE) AS match_date,
               'P' || page_id AS player_name, '' AS team, '' AS opponent, false AS is_home,
               CAST(90 AS DOUBLE) AS minutes, CAST(page_id % 4 AS DOUBLE) AS goals,
               CAST(0 AS DOUBLE) AS assists, CAST(0 AS DOUBLE) AS shots,
               CAST(NULL AS DOUBLE) AS shots_on_target,
               CAST(0 AS DOUBLE) AS xg, CAST(0 AS DOUBLE) AS xa
        FROM pages""",
    "html_match_links": f"""
        SELECT page_id, CAST(0 AS BIGINT) AS link_idx, '/matches/' || page_id AS href,
               '{SITE}/matches/' || page_id AS match_url
        FROM pages WHERE page_id % 4 <> 3
        UNION ALL
        SELECT page_id, CAST(1 AS BIGINT), 'https://other.example/matches/z' || page_id,
               'https://other.example/matches/z' || page_id
        FROM pages WHERE page_id % 4 <> 3""",
    "html_matches": f"""WITH {fx.MATCHES_SQL}
        SELECT league, match_date, home_team, away_team, CAST(home_goals AS DOUBLE) AS home_goals,
               CAST(away_goals AS DOUBLE) AS away_goals, venue, CAST(NULL AS DOUBLE) AS home_xg
        FROM fx_matches WHERE home_goals IS NOT NULL AND away_goals IS NOT NULL""",
}
