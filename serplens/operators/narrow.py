"""Rows cut to the keys of another table before they are parsed or moved."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pages of 4 KB in the bitmap; a page holds 32,768 bits.
PAGES = 2048
_PAGE_BITS = 32768


def maybe_in(rows: DataFrame, wanted: DataFrame, column: str, pages: int = PAGES) -> DataFrame:
    """The ``rows`` whose ``column`` may be in ``wanted``, told without a shuffle of them.

    Hashes of the wanted keys are set in a bitmap of fixed size, 8 MB by default,
    which is broadcast whatever the number of keys. The fuller it is, the more
    rows pass in vain: one in a hundred at 600,000 keys. Rows may be wide, such as
    landed HTML; an exact join on the key belongs after they have been narrowed.
    """
    bits = pages * _PAGE_BITS

    def bit(key: str) -> str:
        return f"pmod(xxhash64({key}), {bits}L)"

    bitmap = wanted.where(F.col(column).isNotNull()).select(F.expr(bit(column)).alias("bit")) \
        .groupBy(F.expr(f"bit div {_PAGE_BITS}").alias("_page")) \
        .agg(F.bitmap_construct_agg(F.expr(f"bit % {_PAGE_BITS}")).alias("_bits"))
    octet = F.expr(f"int(conv(hex(substring(_bits, int(_bit % {_PAGE_BITS} div 8) + 1, 1)), 16, 10))")
    return rows.withColumn("_bit", F.expr(bit(column))).withColumn("_page", F.expr(f"_bit div {_PAGE_BITS}")) \
        .join(F.broadcast(bitmap), "_page") \
        .where(F.getbit(octet, F.expr("int(_bit % 8)")) == 1).drop("_bit", "_page", "_bits")
