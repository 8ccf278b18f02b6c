from __future__ import annotations

import json

import pytest
from documents import ball, files, innings, match
from pyspark.sql import functions as F

from crease.plans.build import build, load, load_folder
from crease.sources.landing import list_folder, parse, read_folder


def reasons(spark, documents):
    rows = parse(files(spark, documents)).select("file_name", "reason").collect()
    return {r.file_name: r.reason for r in rows}


def without(key):
    document = match(innings("A", [ball()]))
    del document[key]
    return document


def test_each_defect_has_its_reason(spark):
    sound = match(innings("A", [ball()]))
    assert reasons(
        spark,
        {
            "1.json": sound,
            "1007.json": match(innings("A", [ball()]), season="2007/08"),
            "1008.json": json.dumps(sound)[:40],
            "1009.json": without("innings"),
            "2.json": without("meta"),
            "3.json": without("info"),
            "4.json": {**sound, "meta": None},
            "1010.json": [sound],
            "5.json": [sound, sound],
            "6.json": [],
            "7.json": match(innings("A", [ball()]), season="2016"),
            "nodigits.json": sound,
        },
    ) == {
        "1.json": None,
        "1007.json": "bad_season",
        "1008.json": "invalid_json",
        "1009.json": "missing_innings",
        "2.json": "missing_meta",
        "3.json": "missing_info",
        "4.json": "missing_meta",
        "1010.json": None,
        "5.json": "several_matches",
        "6.json": "missing_meta",
        "7.json": None,
        "nodigits.json": "no_match_id",
    }


def test_single_match_in_an_array_reads_like_the_match(spark):
    sound = match(innings("A", [ball()]))
    rows = parse(files(spark, {"1.json": sound, "2.json": [sound]}))
    texts = {r[0] for r in rows.select(F.to_json("raw_variant")).collect()}
    assert len(texts) == 1


def test_text_is_parsed_once(spark):
    plan = parse(files(spark, {"1.json": "{}"}))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1


def test_folder_holds_only_its_own_json_files(spark, tmp_path):
    (tmp_path / "below").mkdir()
    for name in ("2.json", "1.json", "note.txt", "below/3.json"):
        (tmp_path / name).write_text("{\n}")
    rows = read_folder(spark, [str(tmp_path), str(tmp_path)]).orderBy("file_name").collect()
    assert [(r.file_name, r.text) for r in rows] == [("1.json", "{\n}"), ("2.json", "{\n}")]


def test_loads_repeat_without_copies(spark, warehouse):
    wh = warehouse()
    documents = {"1.json": match(innings("A", [ball()])), "2.json": "{"}

    def stored():
        return wh.table("raw_match_json").count(), wh.rejects().count()

    load(wh, files(spark, documents), "first")
    assert stored() == (1, 1)
    load(wh, files(spark, documents), "first")  # the same load once more
    assert stored() == (1, 1)
    load(wh, files(spark, documents), "second")  # files already present
    assert stored() == (1, 1)
    load(wh, files(spark, documents), "third", skip_present=False)  # wanted again
    assert stored() == (2, 1)  # a file turned away again is listed as it came last
    assert wh.rejects().first().reason == "invalid_json"
    assert wh.table("raw_match_json").columns == [
        "match_id",
        "file_name",
        "raw_variant",
        "loaded_at",
    ]


def test_a_repaired_file_is_taken(spark, warehouse):
    wh = warehouse()
    load(wh, files(spark, {"1.json": "{", "2.json": "{"}), "broken")
    load(wh, files(spark, {"1.json": match(innings("A", [ball()])), "2.json": "["}), "repaired")
    assert [r.match_id for r in wh.table("raw_match_json").collect()] == ["1"]
    assert [tuple(r)[:2] for r in wh.rejects().collect()] == [("2.json", "invalid_json")]


def test_names_come_first_and_only_new_texts_are_read(spark, warehouse, tmp_path):
    wh, folder = warehouse(), tmp_path / "landing"
    folder.mkdir()
    document = json.dumps(match(innings("A", [ball()])))
    (folder / "1.json").write_text(document)
    load_folder(wh, str(folder), "first")
    (folder / "2.json").write_text(document)
    (folder / "1.json").write_text("{")  # present, so it is not looked into
    load_folder(wh, str(folder), "second")
    load_folder(wh, str(folder), "third")
    names = wh.stored("raw_match_json").select("file_name", "load_id").collect()
    assert sorted(map(tuple, names)) == [("1.json", "first"), ("2.json", "second")]
    plan = list_folder(spark, str(folder))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def spoiled(path, value):
    """A sound document with a value put in place at a path."""
    document = json.loads(json.dumps(match(innings("A", [ball()]))))
    at = document
    for step in path[:-1]:
        at = at.setdefault(step, {}) if isinstance(at, dict) else at[step]
    at[path[-1]] = value
    return document


BALL = ("innings", 0, "overs", 0, "deliveries", 0)


@pytest.mark.parametrize(
    ("path", "value", "reason"),
    [
        (("info", "dates"), ["2016-13-45"], "bad_date"),
        (("info", "outcome"), {"by": {"runs": "many"}}, "bad_outcome"),
        (("info", "outcome"), [1], "bad_outcome"),
        (("info", "registry"), {"people": ["A"]}, "bad_people"),
        (("info", "players"), {"A": 7}, "bad_players"),
        (("innings",), {}, "bad_innings"),
        (("innings",), [5], "bad_innings"),
        (("innings", 0, "overs"), "none", "bad_innings"),
        (("innings", 0, "overs", 0, "deliveries"), {"a": 1}, "bad_innings"),
        ((*BALL, "runs"), {"batter": "x"}, "bad_innings"),
        ((*BALL, "runs"), 4, "bad_innings"),
        ((*BALL, "extras"), {"wides": []}, "bad_innings"),
        ((*BALL, "wickets"), [{"fielders": ["B"]}], "bad_innings"),
        ((*BALL, "wickets"), None, None),
        (("info", "outcome"), None, None),
        (("innings", 0, "overs", 0, "deliveries"), None, None),
    ],
)
def test_what_cannot_be_cast_is_turned_away(spark, path, value, reason):
    rows = parse(files(spark, {"1.json": spoiled(path, value)})).collect()
    assert [r.reason for r in rows] == [reason]


def test_a_build_goes_on_beside_bad_values(spark, warehouse):
    wh = warehouse()
    documents = {
        "1.json": spoiled(("info", "dates"), ["2016-13-45"]),
        "2.json": spoiled((*BALL, "runs"), {"batter": "x"}),
        "3.json": spoiled(("innings",), {}),
        "4.json": match(innings("A", [ball()])),
    }
    load(wh, files(spark, documents), "mixed")
    build(wh)
    assert [r.match_id for r in wh.table("dim_match").collect()] == ["4"]
    assert wh.table("fact_ball").count() == 1 and wh.rejects().count() == 3
