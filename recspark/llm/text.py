"""Column functions on texts. Words are runs without ASCII white space; only A-Z are lower-cased."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITE = " \t\n\x0b\x0c\r"
WHITE_RUN = r"[\x20\x09-\x0D]+"


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is (``lower`` would change É as well)."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def words(text: Column) -> Column:
    """The words of a text in order; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WHITE_RUN), lambda w: w != "")


def windows(items: Column, width: int) -> Column:
    """Structs of ``width`` neighbouring items each; none if there are fewer."""
    n = F.greatest(F.size(items) - (width - 1), F.lit(0))
    return F.arrays_zip(*[F.slice(items, i + 1, n).alias(f"w{i}") for i in range(width)])
