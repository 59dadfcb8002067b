"""Keep an expensive column from being computed several times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add or replace ``columns``, each row evaluating them a single time.

    A filter on a computed column is pushed below the projection by repeating the expression, so JSON text that is
    decoded, filtered by length and then used would be decoded twice. A one-row generator is not repeated.
    """
    made = F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()])))
    return df.select(*[c for c in df.columns if c not in columns], made)
