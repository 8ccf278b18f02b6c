from crease.functions.scalar import (
    file_name_of,
    innings_label,
    fixture_label,
    match_id_of,
    mean_of_rates,
    mean_of_whole,
    moment,
    phase,
    phase_rank,
    rate,
    surrogate_key,
    text_or,
)

__all__ = [
    "file_name_of",
    "innings_label",
    "fixture_label",
    "match_id_of",
    "mean_of_rates",
    "mean_of_whole",
    "moment",
    "phase",
    "phase_rank",
    "rate",
    "surrogate_key",
    "text_or",
]
