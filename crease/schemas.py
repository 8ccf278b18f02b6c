"""Column lists and Spark types of the documents and tables."""

from __future__ import annotations

# Match header columns, the path below ``info`` each is read from, and its type.
MATCH_FIELDS = [
    ("season", "$.season", "int"),
    ("city", "$.city", "string"),
    ("venue", "$.venue", "string"),
    ("match_date", "$.dates[0]", "date"),
    ("event_name", "$.event.name", "string"),
    ("event_stage", "$.event.stage", "string"),
    ("team_1", "$.teams[0]", "string"),
    ("team_2", "$.teams[1]", "string"),
    ("toss_winner", "$.toss.winner", "string"),
    ("toss_decision", "$.toss.decision", "string"),
    ("winner", "$.outcome.winner", "string"),
    ("result_runs", "$.outcome.by.runs", "int"),
    ("result_wickets", "$.outcome.by.wickets", "int"),
    ("player_of_match", "$.player_of_match[0]", "string"),
    ("match_type", "$.match_type", "string"),
    ("gender", "$.gender", "string"),
]

RAW_COLUMNS = ["match_id", "file_name", "raw_variant", "loaded_at"]

DIM_MATCH_COLUMNS = ["match_id"] + [name for name, _, _ in MATCH_FIELDS]

HEADER_COLUMNS = (
    [("match_id", "string")]
    + [(name, kind) for name, _, kind in MATCH_FIELDS]
    + [
        ("registry", "map<string,string>"),
        ("players", "map<string,array<string>>"),
        ("loaded_at", "timestamp_ntz"),
    ]
)

FACT_BALL_COLUMNS = [
    ("delivery_key", "string"),
    ("match_id", "string"),
    ("season", "int"),
    ("match_date", "date"),
    ("innings_no", "int"),
    ("batting_team", "string"),
    ("bowling_team", "string"),
    ("over_no", "int"),
    ("ball_in_over", "int"),
    ("batter", "string"),
    ("non_striker", "string"),
    ("bowler", "string"),
    ("batting_team_id", "string"),
    ("bowling_team_id", "string"),
    ("batter_id", "string"),
    ("non_striker_id", "string"),
    ("bowler_id", "string"),
    ("runs_batter", "int"),
    ("runs_extras", "int"),
    ("runs_total", "int"),
    ("is_wide", "boolean"),
    ("is_noball", "boolean"),
    ("is_bye", "boolean"),
    ("is_legbye", "boolean"),
    ("legal_delivery", "boolean"),
    ("batter_faced", "boolean"),
    ("is_wicket", "boolean"),
    ("wicket_kind", "string"),
    ("player_out", "string"),
    ("fielder_name", "string"),
    ("loaded_at", "timestamp_ntz"),
]

DIM_TEAM_COLUMNS = [("team_id", "string"), ("team_name", "string")]

DIM_PLAYER_COLUMNS = [
    ("player_id", "string"),
    ("player_name", "string"),
    ("first_season", "int"),
    ("last_season", "int"),
]

DIM_PLAYER_TEAM_COLUMNS = [
    ("player_id", "string"),
    ("match_id", "string"),
    ("team_name", "string"),
]

DIM_SEASON_COLUMNS = [
    ("season", "int"),
    ("total_matches", "bigint"),
    ("start_date", "date"),
    ("end_date", "date"),
    ("champion", "string"),
]
