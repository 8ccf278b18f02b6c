"""Small match documents, written out by hand."""

from __future__ import annotations

import json

TEAM_A = [f"A{i}" for i in range(1, 6)]
TEAM_B = [f"B{i}" for i in range(1, 6)]


def ball(batter="A1", non_striker="A2", bowler="B1", bat=0, extras=None, wickets=None):
    extra_runs = sum((extras or {}).values())
    delivery = {
        "batter": batter,
        "non_striker": non_striker,
        "bowler": bowler,
        "runs": {"batter": bat, "extras": extra_runs, "total": bat + extra_runs},
    }
    if extras:
        delivery["extras"] = extras
    if wickets:
        delivery["wickets"] = wickets
    return delivery


def wicket(kind, out, *fielders):
    entry = {"kind": kind, "player_out": out}
    if fielders:
        entry["fielders"] = [{"name": name} for name in fielders]
    return [entry]


def innings(team, *overs):
    return {
        "team": team,
        "overs": [{"over": i, "deliveries": list(balls)} for i, balls in enumerate(overs)],
    }


def match(*played, teams=("A", "B"), season=2016, people=None, players=None, **info):
    listed = players or {teams[0]: TEAM_A, teams[1]: TEAM_B}
    registry = {name: f"id-{name}" for squad in listed.values() for name in squad}
    registry["Umpire"] = "id-Umpire"
    registry.update(people or {})
    header = {
        "season": season,
        "city": "City",
        "venue": "Ground",
        "dates": ["2016-05-01"],
        "event": {"name": "Cup"},
        "teams": list(teams),
        "toss": {"winner": teams[0], "decision": "Field"},
        "outcome": {"winner": teams[0], "by": {"runs": 7}},
        "player_of_match": [listed[teams[0]][0]],
        "match_type": "T20",
        "gender": "male",
        "players": listed,
        "registry": {"people": {n: i for n, i in registry.items() if i != "absent"}},
    }
    header.update(info)
    return {"meta": {"data_version": "1.0.0"}, "info": header, "innings": list(played)}


def files(spark, documents: dict):
    """(file_name, text) rows of documents, given as values or as text."""
    rows = [
        (name, doc if isinstance(doc, str) else json.dumps(doc)) for name, doc in documents.items()
    ]
    return spark.createDataFrame(rows, "file_name string, text string")


def raw(spark, documents: dict, loaded_at="2024-01-01 00:00:00"):
    from pyspark.sql import functions as F

    from crease.sources.landing import parse

    return parse(files(spark, documents), F.lit(loaded_at)).drop("reason")


def fact(spark, documents: dict):
    from crease.operators import marts, staging

    rows = raw(spark, documents)
    return marts.fact_ball(rows, marts.dim_team(staging.stg_matches(rows)))


def dicts(rows, *order):
    return [r.asDict() for r in (rows.orderBy(*order) if order else rows).collect()]
