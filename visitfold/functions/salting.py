"""Salt expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_salt(columns: list[str], factor: int) -> Column:
    """Bucket 0..factor-1 taken from the row's own values.

    A random salt changes when a lost task runs again on rows in another order, and
    readers of the first attempt then miss or repeat rows. A hash of the row does not.
    """
    return F.pmod(F.xxhash64(*columns), F.lit(factor)).cast("int")
