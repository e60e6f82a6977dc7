"""Column expressions; everything here stays inside the JVM."""

from touchline.functions.arrays import holds, list_length, pluck
from touchline.functions.dates import (
    completed_years,
    day_of_week,
    month_start,
    month_text_to_date,
    week_end,
    week_number,
    week_start,
    year_to_date,
)
from touchline.functions.keys import surrogate_key
from touchline.functions.text import code_to_words, join_present, slug, split_text, without_accents

__all__ = [
    "code_to_words",
    "completed_years",
    "day_of_week",
    "holds",
    "join_present",
    "list_length",
    "month_start",
    "month_text_to_date",
    "pluck",
    "slug",
    "split_text",
    "surrogate_key",
    "week_end",
    "week_number",
    "week_start",
    "without_accents",
    "year_to_date",
]
