"""Column expressions shared by the models; all of them stay inside whole-stage codegen."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what a null column contributes to a surrogate key.
NULL_KEY_PART = "_dbt_utils_surrogate_key_null_"

# The phases of an innings in playing order.
PHASES = ["Powerplay", "Middle", "Death"]


def surrogate_key(*columns: str | Column) -> Column:
    """md5 hex over the columns joined by '-', nulls written as a marker text."""
    parts = [
        F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(NULL_KEY_PART))
        for c in columns
    ]
    return F.md5(F.concat_ws("-", *parts))


def rate(amount: Column, per: Column, factor: int, places: int) -> Column:
    """``factor * amount / per`` rounded half up to ``places``, null when ``per`` is zero.

    Whole-number arithmetic keeps the rounding exact (a double quotient can land on the
    wrong side of a half); only the last step leaves the integers.
    """
    scale = 10**places
    divisor = F.nullif(per.cast("long"), F.lit(0))
    scaled = amount.cast("long") * F.lit(2 * factor * scale)
    units = F.call_function("div", F.abs(scaled) + divisor, divisor * F.lit(2))
    return F.signum(scaled) * units / F.lit(float(scale))


def _half_even(value: Column, places: int) -> Column:
    scale = float(10**places)
    return F.rint(value * F.lit(scale)) / F.lit(scale)


def mean_of_whole(column: str, places: int | None = None) -> Column:
    """Mean of a whole-number column, halves rounded to even."""
    mean = F.sum(column).cast("double") / F.count(column)
    return mean if places is None else _half_even(mean, places)


def mean_of_rates(column: str, places: int | None = None) -> Column:
    """Unweighted mean of a two-decimal column, nulls skipped, halves rounded to even.

    Summing hundredths as integers makes the result independent of the order in which
    Spark merges partial sums.
    """
    hundredths = F.sum(F.rint(F.col(column) * F.lit(100.0)).cast("long"))
    mean = hundredths.cast("double") / (F.lit(100.0) * F.count(column))
    return mean if places is None else _half_even(mean, places)


def file_name_of(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def match_id_of(file_name: Column) -> Column:
    """First run of digits in a file name, null when there is none."""
    return F.regexp_substr(file_name, F.lit(r"\d+"))


def phase(over_no: str = "over_no") -> Column:
    over = F.col(over_no)
    return F.when(over <= 6, PHASES[0]).when(over <= 15, PHASES[1]).otherwise(PHASES[2])


def phase_rank(column: str = "phase") -> Column:
    return F.array_position(F.array(*[F.lit(p) for p in PHASES]), F.col(column)).cast("int")


def moment(when: datetime) -> Column:
    """A date and time as written, whatever time zones Python and the session are in."""
    return F.lit(when.isoformat(sep=" ")).cast("timestamp_ntz")


def text_or(column: str | Column, missing: str) -> Column:
    """The column as text, with ``missing`` printed for null."""
    value = F.col(column) if isinstance(column, str) else column
    return F.coalesce(value.cast("string"), F.lit(missing))


def fixture_label() -> Column:
    """``T1 vs T2 (date)`` label of a match."""
    return F.concat(
        text_or("team_1", "None"),
        F.lit(" vs "),
        text_or("team_2", "None"),
        F.lit(" ("),
        text_or("match_date", "None"),
        F.lit(")"),
    )


def innings_label() -> Column:
    return F.concat(
        F.lit("Innings "), F.col("innings_no").cast("string"), F.lit(" · "), F.col("batting_team")
    )
