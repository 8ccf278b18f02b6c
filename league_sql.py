"""DuckDB statements that answer the registered queries straight from ``events``.

They repeat the arithmetic of the derived league and never see a document, so they check the
whole way from ingest to scorecard.
"""

from __future__ import annotations

from crease.plans import quality


def half_up(amount: str, per: str, factor: int, places: int) -> str:
    scale = 10**places
    return (
        f"CASE WHEN ({per}) = 0 THEN NULL ELSE CAST((2 * ({amount}) * {factor * scale} + ({per}))"
        f" // (2 * ({per})) AS DOUBLE) / {scale} END"
    )


def half_even(mean: str, places: int) -> str:
    scale = 10**places
    return f"round_even(({mean}) * {scale}, 0) / {scale}"


def mean_of_rates(column: str) -> str:
    return (
        f"CAST(sum(CAST(round({column} * 100) AS BIGINT)) AS DOUBLE)"
        f" / (100.0::DOUBLE * count({column}))"
    )


def mean_of_whole(column: str) -> str:
    return f"CAST(sum({column}) AS DOUBLE) / count({column})"


TABLES = f"""
e AS (
  SELECT event_id AS id, event_id // 240 AS mi, event_type AS t, user_id % 11 AS slot,
    CAST(floor(value * 100 + 0.5) AS BIGINT) % 10 AS v,
    CAST((event_id % 240) // 120 + 1 AS INTEGER) AS innings_no,
    CAST(((event_id % 240) % 120) // 6 + 1 AS INTEGER) AS over_no,
    CAST(event_id % 6 + 1 AS INTEGER) AS ball_in_over
  FROM events
),
m AS (
  SELECT mi, CAST(100000 + mi AS VARCHAR) AS match_id,
    CAST(2008 + (mi // 8) % 4000 AS INTEGER) AS season,
    'T' || (mi % 25) AS team_1, 'T' || ((mi + 7) % 25) AS team_2,
    mi % 10 <> 9 AS decided,
    CASE WHEN mi % 3 < 2 THEN 'T' || (mi % 25) ELSE 'T' || ((mi + 7) % 25) END AS leader,
    strftime(TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(mi // 10 AS INTEGER)),
      '%Y-%m-%d %H:%M:%S') AS loaded_at
  FROM (SELECT DISTINCT mi FROM e)
),
raw_match_json AS (
  SELECT match_id, match_id || '.json' AS file_name, 'document' AS raw_variant, loaded_at FROM m
),
dim_match AS (
  SELECT match_id, season, 'City ' || (mi % 25) AS city, 'Ground ' || (mi % 25) AS venue,
    CAST(make_date(CAST(season AS BIGINT), 4, 1) + CAST(mi % 8 AS INTEGER) AS DATE) AS match_date,
    'Derived League' AS event_name, CASE WHEN mi % 8 = 7 THEN 'Final' END AS event_stage,
    team_1, team_2, team_1 AS toss_winner,
    CASE WHEN mi % 2 = 0 THEN 'bat' ELSE 'field' END AS toss_decision,
    CASE WHEN decided THEN leader END AS winner,
    CAST(CASE WHEN decided AND mi % 2 = 0 THEN 1 + mi % 50 END AS INTEGER) AS result_runs,
    CAST(CASE WHEN decided AND mi % 2 = 1 THEN 1 + mi % 9 END AS INTEGER) AS result_wickets,
    CASE WHEN decided THEN leader || '_P' || (mi % 11) END AS player_of_match,
    'T20' AS match_type, 'male' AS gender
  FROM m
),
sides AS (
  SELECT mi, match_id, season, team_1 AS team FROM m
  UNION ALL SELECT mi, match_id, season, team_2 FROM m
),
squads AS (
  SELECT mi, match_id, season, team, team || '_P' || slot AS name
  FROM sides CROSS JOIN (SELECT unnest(range(11)) AS slot)
),
stg_registry AS (
  SELECT match_id, name AS person_name, substr(md5(name), 1, 8) AS cricsheet_id FROM squads
  UNION ALL
  SELECT match_id, 'Umpire ' || (mi % 5), substr(md5('Umpire ' || (mi % 5)), 1, 8) FROM m
),
dim_team AS (
  SELECT DISTINCT md5(team) AS team_id, team AS team_name FROM sides
),
dim_player AS (
  SELECT substr(md5(name), 1, 8) AS player_id, name AS player_name,
    min(season) AS first_season, max(season) AS last_season
  FROM squads GROUP BY name
),
dim_player_team AS (
  SELECT substr(md5(name), 1, 8) AS player_id, match_id, team AS team_name FROM squads
),
dim_season AS (
  SELECT s.season, s.total_matches, s.start_date, s.end_date, f.winner AS champion
  FROM (SELECT season, count(*) AS total_matches, min(match_date) AS start_date,
          max(match_date) AS end_date FROM dim_match GROUP BY season) s
  LEFT JOIN (SELECT season, winner FROM dim_match WHERE event_stage = 'Final') f
    ON f.season = s.season
),
placed AS (
  SELECT e.*, m.match_id, m.season, m.loaded_at, d.match_date,
    CASE WHEN (e.mi % 2 = 0) = (innings_no = 1) THEN m.team_1 ELSE m.team_2 END AS batting_team,
    CASE WHEN (e.mi % 2 = 0) = (innings_no = 1) THEN m.team_2 ELSE m.team_1 END AS bowling_team,
    CASE WHEN t = 'signup' AND id % 25 = 0 THEN 5 WHEN t = 'signup' AND id % 5 = 0 THEN 1
      ELSE 0 END AS wides,
    CASE WHEN t = 'view' AND id % 7 = 0 THEN 1 ELSE 0 END AS noballs,
    CASE WHEN t = 'click' AND id % 9 = 0 THEN 1 ELSE 0 END AS legbyes,
    CASE WHEN t = 'click' AND id % 9 <> 0 AND id % 11 = 0 THEN 1 ELSE 0 END AS byes,
    t = 'error' AND id % 4 = 0 AS is_wicket,
    ['bowled', 'caught', 'lbw', 'run out', 'stumped', 'retired hurt'][(id // 4) % 6 + 1] AS kind
  FROM e JOIN m USING (mi) JOIN dim_match d USING (match_id)
),
named AS (
  SELECT *, batting_team || '_P' || slot AS batter,
    batting_team || '_P' || ((slot + 1 + id % 10) % 11) AS non_striker,
    bowling_team || '_P' || ((over_no * 3 + innings_no) % 11) AS bowler,
    CAST(CASE WHEN wides + byes + legbyes > 0 THEN 0 WHEN v <= 4 THEN 0 WHEN v <= 6 THEN 1
      WHEN v = 7 THEN 2 WHEN v = 8 THEN 4 ELSE 6 END AS INTEGER) AS runs_batter,
    CAST(wides + noballs + byes + legbyes AS INTEGER) AS runs_extras,
    CASE WHEN is_wicket THEN kind END AS wicket_kind
  FROM placed
),
fact_ball AS (
  SELECT md5(match_id || '-' || innings_no || '-' || over_no || '-' || ball_in_over)
      AS delivery_key,
    match_id, season, match_date, innings_no, batting_team, bowling_team, over_no, ball_in_over,
    batter, non_striker, bowler, md5(batting_team) AS batting_team_id,
    md5(bowling_team) AS bowling_team_id, substr(md5(batter), 1, 8) AS batter_id,
    substr(md5(non_striker), 1, 8) AS non_striker_id, substr(md5(bowler), 1, 8) AS bowler_id,
    runs_batter, runs_extras, CAST(runs_batter + runs_extras AS INTEGER) AS runs_total,
    wides > 0 AS is_wide, noballs > 0 AS is_noball, byes > 0 AS is_bye, legbyes > 0 AS is_legbye,
    wides + noballs = 0 AS legal_delivery, wides = 0 AS batter_faced, is_wicket, wicket_kind,
    CASE WHEN is_wicket THEN CASE WHEN kind = 'run out' AND (id // 24) % 2 = 0
      THEN non_striker ELSE batter END END AS player_out,
    CASE WHEN wicket_kind IN ('caught', 'run out', 'stumped')
      THEN bowling_team || '_P' || ((id // 4) % 11) END AS fielder_name,
    loaded_at
  FROM named
),
v_batting AS (
  SELECT match_id, season, match_date, innings_no, batting_team, batter, batter_id,
    count(*) FILTER (batter_faced) AS balls_faced, CAST(sum(runs_batter) AS BIGINT) AS runs,
    count(*) FILTER (batter_faced AND runs_batter = 4) AS fours,
    count(*) FILTER (batter_faced AND runs_batter = 6) AS sixes,
    {half_up("CAST(sum(runs_batter) AS BIGINT)", "count(*) FILTER (batter_faced)", 100, 2)}
      AS strike_rate,
    max(CASE WHEN is_wicket AND player_out = batter THEN wicket_kind END) AS dismissal_kind,
    count(*) FILTER (is_wicket AND player_out = batter) = 0 AS not_out
  FROM fact_ball GROUP BY ALL
),
bowled_overs AS (
  SELECT match_id, innings_no, bowler, over_no FROM fact_ball GROUP BY ALL
  HAVING count(*) FILTER (legal_delivery) = 6 AND sum(runs_total) = 0
),
v_bowling AS (
  SELECT b.*, (SELECT count(*) FROM bowled_overs o WHERE o.match_id = b.match_id
      AND o.innings_no = b.innings_no AND o.bowler = b.bowler) AS maidens
  FROM (
    SELECT match_id, season, match_date, innings_no, bowling_team, bowler, bowler_id,
      count(*) FILTER (legal_delivery) AS balls_bowled,
      {half_up("count(*) FILTER (legal_delivery)", "6", 1, 1)} AS overs,
      CAST(sum(runs_total) AS BIGINT) AS runs_conceded,
      count(*) FILTER (is_wicket AND wicket_kind <> 'run out') AS wickets,
      {half_up("CAST(sum(runs_total) AS BIGINT)", "count(*) FILTER (legal_delivery)", 6, 2)}
        AS economy,
      count(*) FILTER (legal_delivery AND runs_total = 0) AS dot_balls,
      CAST(sum(runs_extras) AS BIGINT) AS extras_conceded
    FROM fact_ball GROUP BY ALL
  ) b
),
v_match_summary AS (
  SELECT d.match_id, d.season, d.city, d.venue, d.match_date, d.event_name, d.event_stage,
    i.innings_no, i.batting_team, i.bowling_team, i.runs, i.wickets,
    {half_up("i.balls", "6", 1, 1)} AS overs, {half_up("i.runs", "i.balls", 6, 2)} AS run_rate,
    i.extras, d.toss_winner, d.toss_decision, d.winner, d.result_runs, d.result_wickets,
    d.player_of_match
  FROM (
    SELECT match_id, innings_no, batting_team, bowling_team,
      CAST(sum(runs_total) AS BIGINT) AS runs, count(*) FILTER (is_wicket) AS wickets,
      count(*) FILTER (legal_delivery) AS balls, CAST(sum(runs_extras) AS BIGINT) AS extras
    FROM fact_ball GROUP BY ALL
  ) i JOIN dim_match d USING (match_id)
),
v_phase AS (
  SELECT match_id, season, match_date, innings_no, batting_team,
    CASE WHEN over_no <= 6 THEN 'Powerplay' WHEN over_no <= 15 THEN 'Middle' ELSE 'Death' END
      AS phase,
    count(*) FILTER (batter_faced) AS balls_faced, CAST(sum(runs_total) AS BIGINT) AS runs,
    count(*) FILTER (is_wicket) AS wickets,
    {half_up("CAST(sum(runs_total) AS BIGINT)", "count(*) FILTER (batter_faced)", 6, 2)}
      AS run_rate
  FROM fact_ball GROUP BY ALL
),
stands AS (
  SELECT *, row_number() OVER w AS seq, 1 + CAST(coalesce(sum(CAST(is_wicket AS INTEGER)) OVER (
      w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS wicket_number
  FROM fact_ball
  WINDOW w AS (PARTITION BY match_id, innings_no ORDER BY over_no, ball_in_over)
),
v_partnership AS (
  SELECT match_id, season, match_date, innings_no, batting_team, wicket_number,
    min_by(batter, seq) AS batter1, min_by(non_striker, seq) AS batter2,
    count(*) FILTER (batter_faced) AS balls_faced, CAST(sum(runs_total) AS BIGINT) AS runs,
    {half_up("CAST(sum(runs_total) AS BIGINT)", "count(*) FILTER (batter_faced)", 6, 2)}
      AS run_rate,
    count(*) FILTER (is_wicket) AS wickets
  FROM stands GROUP BY ALL
),
ranked_batting AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY match_id
    ORDER BY runs DESC, innings_no, batter) AS INTEGER) AS rank FROM v_batting
),
ranked_bowling AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY match_id
    ORDER BY wickets DESC, economy ASC NULLS LAST, innings_no, bowler) AS INTEGER) AS rank
  FROM v_bowling
),
ranked_partnership AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY match_id
    ORDER BY runs DESC, innings_no, wicket_number) AS INTEGER) AS rank FROM v_partnership
),
margins AS (
  SELECT match_id, innings_no, CASE
    WHEN result_wickets IS NOT NULL THEN ' by ' || result_wickets || ' wickets'
    WHEN result_runs IS NOT NULL THEN ' by ' || result_runs || ' runs' ELSE '' END AS margin
  FROM v_match_summary
)"""


def _over(select: str) -> str:
    return f"WITH {TABLES}\n{select}"


#: What planted faults and matches loaded twice show up as.
_FAULTS = """SELECT 'raw_match_json' AS table_name, 'unique' AS test, 'match_id' AS column_name,
  match_id AS value, CAST(2 AS BIGINT) AS rows
FROM raw_match_json WHERE CAST(match_id AS BIGINT) % 4 = 1
UNION ALL SELECT 'fact_ball', 'unique', 'delivery_key', delivery_key, 2 FROM fact_ball
  WHERE innings_no = 1 AND over_no = 1 AND ball_in_over = 1 AND CAST(match_id AS BIGINT) % 4 = 1
UNION ALL SELECT 'fact_ball', 'unique_combination', 'match_id+innings_no+over_no+ball_in_over',
  match_id || '-1-1-1', 2 FROM m WHERE mi % 4 = 1
UNION ALL SELECT 'fact_ball', 'not_null', unnest(['batter', 'batter_id']), match_id || '-3-1-1', 1
  FROM m WHERE mi % 4 = 2
UNION ALL SELECT 'fact_ball', 'relationships', 'batter_id', 'nobody-' || match_id, 1
  FROM m WHERE mi % 4 = 3
UNION ALL SELECT 'fact_ball', 'not_null', 'season', match_id || '-5-1-1', 1
  FROM m WHERE mi % 4 = 0"""


def _quality_tests() -> str:
    tests = []
    for table, columns in quality.NOT_NULL.items():
        for column in columns:
            tests.append(
                f"SELECT '{table}' AS table_name, 'not_null' AS test, '{column}' AS column_name,"
                f" count(*) FILTER ({column} IS NULL) AS failures FROM {table}"
            )
    for table, column in quality.UNIQUE:
        tests.append(
            f"SELECT '{table}', 'unique', '{column}', count(*) FROM (SELECT {column} FROM {table}"
            f" WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1)"
        )
    for table, column, parent, parent_column in quality.RELATIONSHIPS:
        tests.append(
            f"SELECT '{table}', 'relationships', '{column}', count(*) FROM {table}"
            f" WHERE {column} NOT IN (SELECT {parent_column} FROM {parent})"
        )
    for table, columns in quality.COMBINATIONS:
        tests.append(
            f"SELECT '{table}', 'unique_combination', '{'+'.join(columns)}', count(*) FROM"
            f" (SELECT 1 FROM {table} GROUP BY {', '.join(columns)} HAVING count(*) > 1)"
        )
    return "\nUNION ALL ".join(tests)


def statements() -> dict[str, str]:
    fact = "SELECT * FROM fact_ball"
    every = {
        "raw_ingest": _over("SELECT match_id, file_name, loaded_at FROM raw_match_json"),
        "ingest_rejects": _over(
            """SELECT CASE WHEN mi % 12 = 0 THEN translate(match_id, '0123456789', 'abcdefghij')
              ELSE match_id END || '.json' AS file_name,
            ['no_match_id', 'invalid_json', 'several_matches', 'missing_meta', 'missing_info',
             'missing_innings', 'bad_season', 'bad_date', 'bad_people', 'bad_players',
             'bad_innings', 'bad_innings'][mi % 12 + 1] AS reason FROM m"""
        ),
        "repaired_files": _over(
            """SELECT file_name, 'accepted' AS outcome FROM raw_match_json
            UNION ALL SELECT translate(match_id, '0123456789', 'abcdefghij') || '.json',
              'no_match_id' FROM m WHERE mi % 12 = 0"""
        ),
        "repaired_build": _over("SELECT * FROM dim_match"),
        "late_load": _over("SELECT * FROM dim_match"),
        "late_players": _over("SELECT * FROM dim_player"),
        "unmerged": _over(
            """SELECT 'dim_match' AS table_name, 0::BIGINT AS matches
            UNION ALL SELECT 'fact_ball', count(*) FROM m WHERE mi % 4 = 3"""
        ),
        "latest_copies": _over("SELECT match_id, file_name, 2 AS copy FROM raw_match_json"),
        "stream_ingest": _over(
            """SELECT match_id, match_id || '.json' AS file_name, count(*) AS balls
            FROM fact_ball GROUP BY ALL"""
        ),
        "stg_matches": _over("SELECT * FROM dim_match"),
        "stg_innings": _over(
            """SELECT match_id, innings_no, batting_team, 'mandatory' AS powerplay_type,
              5.6::DOUBLE AS powerplay_to
            FROM fact_ball GROUP BY match_id, innings_no, batting_team"""
        ),
        "stg_deliveries": _over(
            """SELECT match_id, innings_no, batting_team, over_no, ball_in_over, batter,
              non_striker, bowler, runs_batter, runs_extras,
              CAST(runs_batter + runs_extras AS INTEGER) AS runs_total,
              CAST(nullif(wides, 0) AS INTEGER) AS wides,
              CAST(nullif(noballs, 0) AS INTEGER) AS noballs,
              CAST(nullif(byes, 0) AS INTEGER) AS byes,
              CAST(nullif(legbyes, 0) AS INTEGER) AS legbyes,
              wicket_kind, loaded_at FROM named"""
        ),
        "stg_registry": _over("SELECT * FROM stg_registry"),
        "dim_match": _over("SELECT * FROM dim_match"),
        "dim_team": _over("SELECT * FROM dim_team"),
        "dim_player": _over("SELECT * FROM dim_player"),
        "dim_player_team": _over("SELECT * FROM dim_player_team"),
        "dim_season": _over("SELECT * FROM dim_season"),
        "fact_ball": _over(fact),
        "fact_ball_incremental": _over(
            """SELECT * EXCLUDE (loaded_at), CASE WHEN (CAST(match_id AS BIGINT) - 100000) % 8 >= 4
              THEN '2024-01-02 00:00:00' ELSE '2024-01-01 00:00:00' END AS loaded_at
            FROM fact_ball"""
        ),
        "stream_fact_ball": _over(
            """SELECT * EXCLUDE (loaded_at), CASE WHEN (CAST(match_id AS BIGINT) - 100000) % 8 >= 4
              THEN '2024-01-02 00:00:00' ELSE '2024-01-01 00:00:00' END AS loaded_at
            FROM fact_ball"""
        ),
        "v_batting": _over("SELECT * FROM v_batting"),
        "v_bowling": _over("SELECT * FROM v_bowling"),
        "v_match_summary": _over("SELECT * FROM v_match_summary"),
        "v_phase": _over("SELECT * FROM v_phase"),
        "v_partnership": _over("SELECT * FROM v_partnership"),
        "match_list": _over(
            """SELECT match_id, season, match_date, team_1, team_2, venue,
              team_1 || ' vs ' || team_2 || ' (' || match_date || ')' AS label
            FROM dim_match ORDER BY match_date, match_id"""
        ),
        "season_list": _over("SELECT DISTINCT season FROM dim_match ORDER BY season DESC"),
        "match_scorecard": _over(
            """SELECT 'summary' AS section, match_id, innings_no, batting_team AS name, runs,
              wickets, run_rate AS rate FROM v_match_summary
            UNION ALL SELECT 'batting', match_id, innings_no, batter, runs, NULL, strike_rate
              FROM v_batting
            UNION ALL SELECT 'bowling', match_id, innings_no, bowler, runs_conceded, wickets,
              economy FROM v_bowling
            UNION ALL SELECT 'phases', match_id, innings_no, phase, runs, wickets, run_rate
              FROM v_phase
            UNION ALL SELECT 'partnerships', match_id, innings_no, batter1 || ' + ' || batter2,
              runs, wickets, run_rate FROM v_partnership"""
        ),
        "over_progression": _over(
            """SELECT match_id, innings_no, 'Innings ' || innings_no || ' · ' || batting_team
              AS innings, over_no, CAST(sum(runs_total) AS BIGINT) AS runs,
              count(*) FILTER (is_wicket) AS wickets
            FROM fact_ball GROUP BY match_id, innings_no, batting_team, over_no"""
        ),
        "result_header": _over(
            """SELECT s.match_id, s.winner, g.margin,
              coalesce(s.winner, 'None') || ' won' || g.margin AS headline,
              'Toss: ' || f.toss_winner || ' chose to ' || lower(f.toss_decision)
                || '  ·  Player of the match: ' || coalesce(f.player_of_match, 'None')
                || '  ·  Venue: ' || f.venue || ', ' || f.city AS details
            FROM v_match_summary s JOIN v_match_summary f
              ON f.match_id = s.match_id AND f.innings_no = 1
            JOIN margins g ON g.match_id = s.match_id AND g.innings_no = 2
            WHERE s.innings_no = 2"""
        ),
        "batting_board": _over(
            """SELECT match_id, innings_no, batting_team, rank, batter, balls_faced, runs, fours,
              sixes, strike_rate, dismissal_kind,
              CASE WHEN not_out THEN 'Yes' ELSE 'No' END AS not_out FROM ranked_batting"""
        ),
        "top_scorers": _over(
            """SELECT match_id, rank, innings_no, batting_team, batter, runs
            FROM ranked_batting WHERE rank <= 8"""
        ),
        "bowling_board": _over(
            """SELECT match_id, innings_no, bowling_team, rank, bowler, balls_bowled, overs,
              runs_conceded, wickets, economy, dot_balls, maidens FROM ranked_bowling"""
        ),
        "phase_table": _over(
            """SELECT match_id, innings_no, batting_team AS team, phase,
              CAST(list_position(['Powerplay', 'Middle', 'Death'], phase) AS INTEGER) AS phase_no,
              runs, balls_faced, wickets, run_rate FROM v_phase"""
        ),
        "partnership_board": _over(
            """SELECT match_id, innings_no, batting_team, rank, wicket_number, batter1, batter2,
              batter1 || ' + ' || batter2 AS pair, runs, balls_faced, run_rate
            FROM ranked_partnership"""
        ),
        "player_index": _over(
            """SELECT batter AS player FROM v_batting UNION SELECT bowler FROM v_bowling
            ORDER BY player"""
        ),
        "career_batting": _over(
            f"""SELECT batter, count(DISTINCT match_id) AS matches,
              CAST(sum(runs) AS BIGINT) AS total_runs,
              {half_even(mean_of_whole("runs"), 1)} AS avg,
              {half_even(mean_of_rates("strike_rate"), 1)} AS strike_rate,
              CAST(sum(fours) AS BIGINT) AS fours, CAST(sum(sixes) AS BIGINT) AS sixes
            FROM v_batting GROUP BY batter"""
        ),
        "career_batting_season": _over(
            f"""SELECT batter, season, count(DISTINCT match_id) AS matches,
              CAST(sum(runs) AS BIGINT) AS runs, {mean_of_whole("runs")} AS avg,
              {mean_of_rates("strike_rate")} AS strike_rate
            FROM v_batting GROUP BY batter, season"""
        ),
        "career_bowling": _over(
            f"""SELECT bowler, count(DISTINCT match_id) AS matches,
              CAST(sum(wickets) AS BIGINT) AS total_wickets,
              {half_even(mean_of_rates("economy"), 2)} AS economy,
              CAST(sum(runs_conceded) AS BIGINT) AS total_runs,
              CAST(sum(dot_balls) AS BIGINT) AS dot_balls
            FROM v_bowling GROUP BY bowler"""
        ),
        "career_bowling_season": _over(
            f"""SELECT bowler, season, count(DISTINCT match_id) AS matches,
              CAST(sum(wickets) AS BIGINT) AS wickets, {mean_of_rates("economy")} AS economy
            FROM v_bowling GROUP BY bowler, season"""
        ),
        "career_log": _over(
            """SELECT batter AS player, 'Bat' AS role, season, match_date AS date,
              batting_team AS team, runs, balls_faced AS balls, strike_rate, fours, sixes,
              dismissal_kind, not_out, NULL::BIGINT AS wickets, NULL::DOUBLE AS overs,
              NULL::DOUBLE AS economy, NULL::BIGINT AS dots, NULL::BIGINT AS maidens
            FROM v_batting
            UNION ALL
            SELECT bowler, 'Bowl', season, match_date, bowling_team, runs_conceded, NULL, NULL,
              NULL, NULL, NULL, NULL, wickets, overs, economy, dot_balls, maidens
            FROM v_bowling"""
        ),
        "match_facts": _over(
            """SELECT s.match_id, s.n AS summaries, a.n AS batters, o.n AS bowlers,
              p.n AS phases, t.n AS partnerships, a.top AS top_batter, o.top AS top_bowler,
              t.top AS top_pair
            FROM (SELECT match_id, CAST(count(*) AS INTEGER) AS n FROM v_match_summary
                GROUP BY match_id) s
            JOIN (SELECT match_id, CAST(least(count(*), 10) AS INTEGER) AS n,
                min_by(batter, rank) AS top FROM ranked_batting GROUP BY match_id) a
              USING (match_id)
            JOIN (SELECT match_id, CAST(least(count(*), 10) AS INTEGER) AS n,
                min_by(bowler, rank) AS top FROM ranked_bowling GROUP BY match_id) o
              USING (match_id)
            JOIN (SELECT match_id, CAST(count(*) AS INTEGER) AS n FROM v_phase
                GROUP BY match_id) p USING (match_id)
            JOIN (SELECT match_id, CAST(least(count(*), 5) AS INTEGER) AS n,
                min_by(batter1 || ' + ' || batter2, rank) AS top
                FROM ranked_partnership GROUP BY match_id) t USING (match_id)"""
        ),
        "global_facts": _over(
            """SELECT 'summary' AS section, NULL::INTEGER AS place, match_id, innings_no,
              batting_team AS name, runs, wickets FROM v_match_summary
            UNION ALL SELECT 'phases', NULL, match_id, innings_no, phase, runs, wickets
              FROM v_phase
            UNION ALL SELECT * FROM (SELECT 'batting', CAST(row_number() OVER (ORDER BY runs DESC,
                innings_no, batter, match_id) AS INTEGER) AS place, match_id, innings_no, batter,
                runs, NULL::BIGINT FROM v_batting) WHERE place <= 10
            UNION ALL SELECT * FROM (SELECT 'bowling', CAST(row_number() OVER (ORDER BY wickets
                DESC, economy ASC NULLS LAST, innings_no, bowler, match_id) AS INTEGER) AS place,
                match_id, innings_no, bowler, runs_conceded, wickets FROM v_bowling)
              WHERE place <= 10
            UNION ALL SELECT * FROM (SELECT 'partnerships', CAST(row_number() OVER (ORDER BY
                runs DESC, innings_no, wicket_number, match_id) AS INTEGER) AS place, match_id,
                innings_no, batter1 || ' + ' || batter2, runs, wickets FROM v_partnership)
              WHERE place <= 5"""
        ),
        "match_commentary": _over(
            """SELECT f.match_id, concat_ws(' ',
              coalesce(s.winner, f.winner) || ' won' || coalesce(g.margin, '') || '. '
                || f.batting_team || ' posted ' || f.runs || '/' || f.wickets || ' in '
                || f.overs || ' overs (run rate ' || f.run_rate || '); '
                || coalesce(s.batting_team, 'None') || ' replied with '
                || coalesce(CAST(s.runs AS VARCHAR), 'None') || '/'
                || coalesce(CAST(s.wickets AS VARCHAR), 'None') || ' in '
                || coalesce(CAST(s.overs AS VARCHAR), 'None') || ' overs.',
              'Top scorer was ' || b.batter || ' with ' || b.runs || ' runs off '
                || b.balls_faced || ' balls (strike rate '
                || coalesce(CAST(b.strike_rate AS VARCHAR), 'nan') || ').',
              o.bowler || ' was the pick of the bowlers with ' || o.wickets
                || ' wicket(s) for ' || o.runs_conceded || ' runs (economy '
                || coalesce(CAST(o.economy AS VARCHAR), 'nan') || ').',
              'The largest partnership was ' || t.batter1 || ' and ' || t.batter2
                || ', who added ' || t.runs || ' runs.') AS text
            FROM v_match_summary f
            LEFT JOIN v_match_summary s ON s.match_id = f.match_id AND s.innings_no = 2
            LEFT JOIN margins g ON g.match_id = f.match_id AND g.innings_no = 2
            JOIN ranked_batting b ON b.match_id = f.match_id AND b.rank = 1
            JOIN ranked_bowling o ON o.match_id = f.match_id AND o.rank = 1
            JOIN ranked_partnership t ON t.match_id = f.match_id AND t.rank = 1
            WHERE f.innings_no = 1"""
        ),
        "boundaries_by_team": _over(
            """SELECT match_id, batting_team, CAST(sum(fours) AS BIGINT) AS fours,
              CAST(sum(sixes) AS BIGINT) AS sixes FROM v_batting GROUP BY ALL"""
        ),
        "player_of_match_contribution": _over(
            """SELECT d.match_id, d.player_of_match, d.winner, a.runs, a.balls_faced, a.fours,
              a.sixes, o.wickets, o.runs_conceded, o.balls_bowled
            FROM dim_match d
            LEFT JOIN v_batting a ON a.match_id = d.match_id AND a.batter = d.player_of_match
            LEFT JOIN v_bowling o ON o.match_id = d.match_id AND o.bowler = d.player_of_match
            WHERE d.player_of_match IS NOT NULL"""
        ),
        "most_runs_by_season": _over(
            """SELECT season, batter, runs FROM (
              SELECT season, batter, CAST(sum(runs) AS BIGINT) AS runs, row_number() OVER (
                PARTITION BY season ORDER BY sum(runs) DESC, batter) AS place
              FROM v_batting GROUP BY season, batter) WHERE place = 1"""
        ),
        "freshness": _over(
            """SELECT max(loaded_at) AS last_loaded_at, CASE
              WHEN TIMESTAMP '2024-01-02 03:00:00' - max(CAST(loaded_at AS TIMESTAMP))
                > INTERVAL 24 HOUR THEN 'error'
              WHEN TIMESTAMP '2024-01-02 03:00:00' - max(CAST(loaded_at AS TIMESTAMP))
                > INTERVAL 1 HOUR THEN 'warn' ELSE 'pass' END AS status FROM raw_match_json"""
        ),
        "quality_report": _over(_quality_tests()),
        "failing_rows": _over(_FAULTS),
        "failing_tests": _over(
            f"""SELECT table_name, test, column_name, CAST(count(*) AS BIGINT) AS failures
            FROM ({_FAULTS}) GROUP BY ALL"""
        ),
        "pipeline_stops": _over(
            f"""SELECT 'gate' AS run, 1 AS position, 'freshness' AS step, 'failed' AS status,
              'error' AS detail
            UNION ALL SELECT 'build', 1, 'freshness', 'passed', 'pass'
            UNION ALL SELECT 'build', 2, 'build', 'failed', 'an error'
            UNION ALL SELECT 'test', 1, 'freshness', 'passed', 'pass'
            UNION ALL SELECT 'test', 2, 'build', 'passed',
              (count(*) + count(DISTINCT match_id)) || ' balls' FROM fact_ball
            UNION ALL SELECT 'test', 3, 'test', 'failed',
              count(DISTINCT (table_name, test, column_name)) || ' of 45 tests failing'
              FROM ({_FAULTS})"""
        ),
        "irregular_deliveries": _over(
            """SELECT match_id, innings_no, CAST(over_no + even AS INTEGER) AS over_no,
              ball_in_over, batter, CAST(runs_batter + runs_extras AS INTEGER) AS runs_total
            FROM (SELECT *, CASE WHEN mi % 2 = 0 THEN 1 ELSE 0 END AS even FROM named)
            UNION ALL SELECT DISTINCT match_id, innings_no, 1, NULL::INTEGER, NULL, NULL::INTEGER
            FROM named WHERE mi % 2 = 0"""
        ),
        "irregular_fact": _over(
            """SELECT md5(match_id || '-' || innings_no || '-' || (over_no + even) || '-'
                || ball_in_over) AS delivery_key,
              match_id, innings_no, CAST(over_no + even AS INTEGER) AS over_no, ball_in_over,
              batter, bowler, batter_id, runs_total
            FROM (SELECT *, (CAST(match_id AS BIGINT) + 1) % 2 AS even FROM fact_ball)
            WHERE even = 0 OR NOT (batter LIKE '%#_P3' ESCAPE '#'
              OR non_striker LIKE '%#_P3' ESCAPE '#' OR bowler LIKE '%#_P3' ESCAPE '#')"""
        ),
        "match_facts_json": _over(
            """SELECT match_id, 'summary' AS section, CAST(row_number() OVER (
                PARTITION BY match_id ORDER BY innings_no) AS INTEGER) AS place, innings_no, season,
              CAST(match_date AS VARCHAR) AS match_date, batting_team AS name, runs, wickets,
              run_rate AS rate FROM v_match_summary
            UNION ALL SELECT match_id, 'batting', rank, innings_no, season,
              CAST(match_date AS VARCHAR), batter, runs, NULL, strike_rate
              FROM ranked_batting WHERE rank <= 10
            UNION ALL SELECT match_id, 'bowling', rank, innings_no, season,
              CAST(match_date AS VARCHAR), bowler, runs_conceded, wickets, economy
              FROM ranked_bowling WHERE rank <= 10
            UNION ALL SELECT match_id, 'phases', CAST(row_number() OVER (
                PARTITION BY match_id ORDER BY innings_no, phase) AS INTEGER), innings_no, season,
              CAST(match_date AS VARCHAR), phase, runs, wickets, run_rate FROM v_phase
            UNION ALL SELECT match_id, 'partnerships', rank, innings_no, season,
              CAST(match_date AS VARCHAR), batter1 || ' + ' || batter2, runs, wickets, run_rate
              FROM ranked_partnership WHERE rank <= 5"""
        ),
        "match_teams": _over(
            """SELECT match_id, CAST(row_number() OVER (PARTITION BY match_id ORDER BY team)
              AS INTEGER) AS place, team
            FROM (SELECT DISTINCT match_id, batting_team AS team FROM v_match_summary)"""
        ),
        "pipeline_report": _over(
            """SELECT 1 AS position, 'freshness' AS step, 'passed' AS status, 'pass' AS detail
            UNION ALL SELECT 2, 'build', 'passed', count(*) || ' balls' FROM fact_ball
            UNION ALL SELECT 3, 'test', 'passed', '0 of 45 tests failing'"""
        ),
    }

    def narrowed(name: str, condition: str) -> str:
        return f"SELECT * FROM ({every[name]}) WHERE {condition}"

    return every | {
        "one_match_scorecard": narrowed("match_scorecard", "match_id = '100002'"),
        "season_matches": narrowed("match_list", "season = 2008"),
        "one_player_career": narrowed("career_batting", "batter = 'T2_P5'"),
    }
