from .amounts import line_amount
from .dates import day_bucket, day_of, utc_date
from .keys import surrogate_key
from .parsing import blank_to_null, number_text, parse_date, parse_number

__all__ = [
    "blank_to_null", "day_bucket", "day_of", "line_amount", "number_text", "parse_date",
    "parse_number", "surrogate_key", "utc_date",
]
