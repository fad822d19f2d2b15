"""Sets of 64-bit ids as bitmaps: one binary of 4 KB for every 32,768 consecutive ids.

Trade ids count up per symbol, so a day of a symbol fills a few bitmaps almost completely: about
an eighth of a byte per trade. Scattered ids leave bitmaps nearly empty, which compress well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ID_KEY = ["symbol", "bucket"]


def id_bitmaps(rows: DataFrame, *keys: str, id: str = "trade_id") -> DataFrame:
    """``keys``, symbol, bucket and bits: the ids in ``rows``. Rows without an id are in no set."""
    return (
        rows.where(F.col(id).isNotNull())
        .groupBy(*keys, "symbol", F.bitmap_bucket_number(id).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(id)).alias("bits"))
    )


def merge_bitmaps(index: DataFrame, *keys: str) -> DataFrame:
    """One bitmap per key, symbol and bucket out of several."""
    return index.groupBy(*keys, *ID_KEY).agg(F.bitmap_or_agg("bits").alias("bits"))


def has_bit(bits: Column, position: Column) -> Column:
    """Whether a bitmap holds the id at ``position`` of its bucket."""
    byte = F.conv(F.hex(F.substr(bits, (F.shiftright(position, 3) + 1).cast("int"), F.lit(1))), 16, 10)
    return F.getbit(byte.cast("int"), (position % 8).cast("int")) == 1


def holders(index: DataFrame, asked: DataFrame, label: str) -> DataFrame:
    """The values of ``label`` in ``index`` whose bitmaps share an id with ``asked``.

    Only bitmaps of the same symbol and bucket meet. The range of buckets asked for goes to the
    scan as a literal, where sorted files skip what lies outside.
    """
    asked = merge_bitmaps(asked)
    low, high = asked.agg(F.min("bucket"), F.max("bucket")).first()
    if low is None:
        return index.select(label).limit(0)
    other = asked.select(F.col("symbol").alias("_symbol"), F.col("bucket").alias("_bucket"), F.col("bits").alias("_bits"))
    near = merge_bitmaps(index.where(F.col("bucket").between(low, high)), label)
    met = near.join(other, F.col("symbol").eqNullSafe(F.col("_symbol")) & (F.col("bucket") == F.col("_bucket")))
    both = met.select(label, *ID_KEY, F.explode(F.array("bits", "_bits")).alias("bits"))
    common = both.groupBy(label, *ID_KEY).agg(F.bitmap_count(F.bitmap_and_agg("bits")).alias("n"))
    return common.where("n > 0").select(label).distinct()
