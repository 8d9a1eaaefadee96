"""Bridge flattening: a core link left-joined to optional links on one key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def left_chain(core: DataFrame, key: str, sides: Sequence[DataFrame]) -> DataFrame:
    """``core`` LEFT JOIN each side on ``key``, in order.

    All joins use the same key, so the planner shuffles every input once by
    that key and chains the sort-merge (or broadcast) joins without
    re-shuffling the growing left side.  Each side must carry ``key`` and only
    the columns it contributes.
    """
    out = core
    for side in sides:
        out = out.join(side, key, "left")
    return out
