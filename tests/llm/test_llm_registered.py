from __future__ import annotations

import __spark_entry__ as registered
import corpus_pipeline
import pytest
import tables

from crease.llm import queries

SQL = queries.oracle_sql()


def ordered(columns, rows):
    places = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(
        tuple(round(v, 6) if isinstance(v, float) else v for v in (row[i] for i in places))
        for row in rows
    )


@pytest.mark.parametrize("name", SQL)
def test_query_equals_its_sql(spark, name):
    got = queries.queries()[name](spark, tables.SMALL)
    expected = tables.connection().execute(SQL[name])
    columns = [column[0] for column in expected.description]
    rows = expected.fetchall()
    assert rows and ordered(got.columns, got.collect()) == ordered(columns, rows)


def test_one_query_for_each_operator():
    names = sorted(int(name.split("_")[0][2:]) for name in queries.queries())
    assert names == list(range(1, 14))
    assert {*queries.queries(), "pipeline"} <= {*registered.queries()}
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "line_dedup", "near_dedup", "mixing", "sentencepiece",
    ]
