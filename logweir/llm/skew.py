"""Joins by key that do not gather a frequent key's rows in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# At most so many keys are broadcast, by the choice of the bound below.
MAX_HOT_KEYS = 50_000
# A key with fewer rows than this is never treated as frequent.
MIN_HOT_ROWS = 1_000


def join_dealt(
    rows: DataFrame, facts: DataFrame, key: str, total: int, n: str = "n", how: str = "inner"
) -> DataFrame:
    """Inner or left join of ``rows`` with ``facts``, one row per key with the key's row count.

    ``total`` bounds the rows. Keys with more than a 50 000th of them (and more than
    1000) are at most 50 000; their facts are broadcast and their rows stay where they
    are. The rest is joined by hash, where no key has more rows than that. Both inputs
    are read twice, so they should be tables or cheap to compute.
    """
    bound = max(MIN_HOT_ROWS, total // MAX_HOT_KEYS)
    hot = F.broadcast(facts.filter(F.col(n) > bound))
    frequent = rows.join(hot, key)
    others = rows.join(hot.select(key), key, "left_anti")
    return frequent.unionByName(others.join(facts.filter(F.col(n) <= bound), key, how))
