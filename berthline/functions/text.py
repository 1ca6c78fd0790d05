"""Text helpers: header normalisation and null-safe key parts."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import NULL_INT_TEXT, NULL_TEXT

_NON_ALNUM = re.compile(r"[^0-9a-zA-Z]+")


def normalise_header(name: str) -> str:
    """Runs of characters outside ``[0-9a-zA-Z]`` -> ``_``, strip ``_``, lower case.

    Operates on schema metadata only (driver side, no data touched).
    """
    return _NON_ALNUM.sub("_", name).strip("_").lower()


def key_part(c: Column, integer: bool = False) -> Column:
    """A value as key text where NULL becomes the pandas text of a missing value.

    String and float parts render as ``nan``; nullable integers as ``<NA>``.
    Plain ``concat`` would make the whole key NULL and ``concat_ws`` would drop the part.
    """
    return F.coalesce(c.cast("string"), F.lit(NULL_INT_TEXT if integer else NULL_TEXT))
