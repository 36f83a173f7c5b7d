"""Set operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def union_years(frames: Sequence[DataFrame]) -> DataFrame:
    """``UNION ALL`` of same-layout yearly sheets, matched by column name (after conforming to one
    schema this equals the positional union). No shuffle."""
    first = frames[0].columns
    return reduce(lambda a, b: a.unionByName(b.select(*first)), frames)
