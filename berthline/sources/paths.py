"""Output naming rule for scored files, and file names as paths."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import Column
from pyspark.sql import functions as F


def prediction_path(source: Column) -> Column:
    """``cleaned/`` -> ``predictions/`` and ``.json`` -> ``_predictions.json`` (every occurrence)."""
    s = F.replace(source, F.lit("cleaned/"), F.lit("predictions/"))
    return F.replace(s, F.lit(".json"), F.lit("_predictions.json"))


def cleaned_path(source: Column) -> Column:
    """Upload name -> ``cleaned/<name>.json`` (``.csv`` replaced)."""
    name = F.regexp_extract(source, r"([^/]+)$", 1)
    return F.concat(F.lit("cleaned/"), F.replace(name, F.lit(".csv"), F.lit(".json")))


def literal(path: str) -> str:
    """A file's name as a path without wildcards."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def plain_name(url: str) -> str:
    """A file's URL (``_metadata.file_path``) as the name that the file index gives it."""
    return re.sub(r"^(\w+):///+", r"\1:/", unquote(url))
