"""White space at the ends of cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(value: Column | str) -> Column:
    """The text without white space of any script at its ends."""
    return F.regexp_replace(value, r"^[\s\p{Z}]++|(?<![\s\p{Z}])[\s\p{Z}]++\z", "")
