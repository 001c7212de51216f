"""Groups of any size cut into blocks of time.

A capture or a source may hold a third of all rows, so a window over it would be one
task. Rows are partitioned on (group, block of time) instead. What a row needs from
outside its block comes along in one of two ways: the last rows before the block are
copied into it (a look back of fixed length), or one row at the border of the block
carries what the others sum up to, one small row per block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = "_block"


def block_start(at: Column, width: int) -> Column:
    """First instant of the block that holds ``at``; exact before zero, null for null."""
    return at - F.pmod(at, F.lit(width))


def with_look_back(df: DataFrame, at: Column, width: int, look_back: int) -> DataFrame:
    """Add the block and ``_own``, and copy rows into the next block when it looks back on them.

    A row is its own block's once; a copy (``_own`` false) only serves the rows of the next.
    ``look_back`` is at most ``width`` and counts both ends. Rows without a time share a block.
    """
    start = block_start(at, width)
    own = F.struct(start.alias(BLOCK), F.lit(True).alias("_own"))
    copy = F.struct((start + width).alias(BLOCK), F.lit(False).alias("_own"))
    seen_later = F.pmod(at, F.lit(width)) >= width - look_back
    return df.select(
        "*", F.inline(F.when(seen_later, F.array(own, copy)).otherwise(F.array(own)))
    )
