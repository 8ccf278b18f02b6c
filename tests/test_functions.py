from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal
from hashlib import md5

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from crease.functions import (
    match_id_of,
    mean_of_rates,
    mean_of_whole,
    phase,
    phase_rank,
    rate,
    surrogate_key,
)


def test_rate_rounds_half_up_exactly(spark):
    @settings(max_examples=5, deadline=None)
    @given(
        st.lists(
            st.tuples(st.integers(0, 10_000), st.integers(0, 1_000)), min_size=200, max_size=400
        )
    )
    def check(pairs):
        rows = spark.createDataFrame(pairs, "amount long, per long")
        got = rows.select(
            rate(F.col("amount"), F.col("per"), 6, 2).alias("r"),
            rate(F.col("amount"), F.col("per"), 100, 2).alias("s"),
        ).collect()
        for (amount, per), row in zip(pairs, got, strict=True):
            for factor, value in ((6, row.r), (100, row.s)):
                if per == 0:
                    assert value is None
                    continue
                exact = Decimal(amount * factor) / Decimal(per)
                assert value == float(exact.quantize(Decimal("0.01"), ROUND_HALF_UP))

    check()


def test_rate_of_overs(spark):
    rows = spark.createDataFrame([(23,), (120,), (3,)], "balls long")
    assert [r[0] for r in rows.select(rate(F.col("balls"), F.lit(6), 1, 1)).collect()] == [
        3.8,
        20.0,
        0.5,
    ]


def test_means_round_halves_to_even_and_skip_nulls(spark):
    rows = spark.createDataFrame([(12.2, 12), (12.3, 13), (None, None)], "sr double, runs int")
    got = rows.agg(mean_of_rates("sr", 1), mean_of_whole("runs", 0), mean_of_rates("sr")).first()
    assert tuple(got) == (12.2, 12.0, 12.25)


def test_surrogate_key_marks_nulls(spark):
    row = spark.range(1).select(
        surrogate_key(F.lit("a"), F.lit(1)), surrogate_key(F.lit(None).cast("string"))
    )
    marker = "_dbt_utils_surrogate_key_null_"
    assert tuple(row.first()) == (
        md5(b"a-1").hexdigest(),
        md5(marker.encode()).hexdigest(),
    )


def test_match_id_is_first_digit_run(spark):
    names = [("981017.json",), ("m12-34.json",), ("nodigits.json",)]
    rows = spark.createDataFrame(names, "file_name string")
    got = [r[0] for r in rows.select(match_id_of(F.col("file_name"))).collect()]
    assert got == ["981017", "12", None]


def test_phases(spark):
    rows = spark.createDataFrame([(6,), (7,), (15,), (16,), (21,)], "over_no int")
    got = rows.select(phase().alias("phase")).select("phase", phase_rank()).collect()
    assert [tuple(r) for r in got] == [
        ("Powerplay", 1),
        ("Middle", 2),
        ("Middle", 2),
        ("Death", 3),
        ("Death", 3),
    ]
