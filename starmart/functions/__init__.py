from .casts import cast_column, cast_failed, number_to_int, number_to_long, text_to_double, text_to_integer
from .dates import day_number_to_date, sas_day_number, sas_to_date, sas_to_timestamp, to_date
from .text import normalise_name, strip_blank, strip_quotes, strip_tabs, upper_trim

__all__ = [
    "cast_column", "cast_failed", "number_to_int", "number_to_long", "text_to_double",
    "text_to_integer", "day_number_to_date", "sas_day_number", "sas_to_date", "sas_to_timestamp", "to_date",
    "normalise_name", "strip_blank", "strip_quotes", "strip_tabs", "upper_trim",
]
