"""Column-level helpers: pure ``Column -> Column`` expressions, all JVM-side."""

from .numeric import coerce_double, coerce_long, nan_to_null
from .text import key_part, normalise_header
from .time import coerce_timestamp, day_name, hours_between

__all__ = [
    "coerce_double", "coerce_long", "nan_to_null", "key_part", "normalise_header",
    "coerce_timestamp", "day_name", "hours_between",
]
