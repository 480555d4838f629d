"""One-way masking of personal data."""

from pyspark.sql import Column
from pyspark.sql import functions as F

MASK_PATTERN = "^[0-9a-f]{64}$"


def masked(value: Column, salt: str) -> Column:
    """Lower-case hex SHA-256 of the value followed by the salt; NULL stays NULL."""
    return F.sha2(F.concat(value.cast("string"), F.lit(salt)), 256)


def masked_full_name(first: Column, last: Column) -> Column:
    """The two name hashes joined with a bar; NULL when either is missing."""
    return F.concat(first, F.lit("|"), last)
