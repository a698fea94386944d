"""Word arrays and shingles as SQL expressions."""

from pyspark.sql import Column, functions as F

SPACES = " \t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    """Words: runs of characters other than space and 0x09 to 0x0D. Null text has none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[ \\t-\\r]+"))


def grams(array: str, size: int, value) -> Column:
    """value(words) of each run of `size` words of an array column, in order; none if there are fewer."""
    n = F.size(array)
    return F.when(
        n >= size, F.transform(F.sequence(F.lit(1), n - (size - 1)), lambda i: value(F.slice(F.col(array), i, F.lit(size))))
    )
