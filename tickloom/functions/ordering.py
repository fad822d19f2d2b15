"""First and last value of a group by (time, id), kept in a hash aggregate.

``min_by(price, struct(time, id))`` is the short way to write this, but a struct in
the aggregation buffer makes Spark sort every input row before the partial
aggregate. Fixed-width keys keep the plan a HashAggregate, with no sort of the input.

Two keys share the work, and each row has exactly one of them:

* ``near``, a bigint: the millisecond offset inside the bucket, then the id. It takes
  every row whose id fits the bits left over and whose time is a whole millisecond,
  which is what a trade feed sends.
* ``wide``, a decimal(38,0): microseconds times 10^20 plus the id. It takes any row,
  and is only worked out for those the near key cannot hold.

A NULL id sorts after every id of the same time; rows with a NULL time must be
filtered out before.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_NAMES = ("near_value", "near_key", "wide_value", "wide_key")


def wide_key(time: Column, row_id: Column) -> Column:
    """Total order on (time, id) as one decimal(38,0), for any 64-bit id or NULL."""
    shifted = row_id.cast("decimal(20,0)") + F.lit("9223372036854775808").cast("decimal(20,0)")
    id_part = F.coalesce(shifted, F.lit("18446744073709551616").cast("decimal(20,0)"))
    step = F.lit("100000000000000000000").cast("decimal(21,0)")
    return (F.unix_micros(time).cast("decimal(18,0)") * step + id_part).cast("decimal(38,0)")


@dataclass(frozen=True)
class BucketOrder:
    """Order of the rows inside one bucket of ``seconds``; ``time`` and ``row_id`` are columns."""

    time: str
    row_id: str
    seconds: int

    @property
    def id_bits(self) -> int:
        return 63 - (self.seconds * 1000).bit_length()

    def _keys(self) -> tuple[Column, Column]:
        micros, row_id = F.unix_micros(F.col(self.time)), F.col(self.row_id)
        no_id = (1 << self.id_bits) - 1
        fits = (F.pmod(micros, F.lit(1000)) == 0) & (
            row_id.isNull() | ((row_id >= 0) & (row_id < no_id))
        )
        offset = F.call_function("div", F.pmod(micros, F.lit(self.seconds * 1_000_000)), F.lit(1000))
        near = F.shiftleft(offset, self.id_bits) + F.coalesce(row_id, F.lit(no_id))
        return F.when(fits, near), F.when(~fits, wide_key(F.col(self.time), row_id))

    def _widen(self, near: Column, start: Column) -> Column:
        """The wide key of a row known by its near key and its bucket's start."""
        no_id = (1 << self.id_bits) - 1
        row_id = near.bitwiseAND(F.lit(no_id))
        micros = F.unix_micros(start) + F.shiftright(near, self.id_bits) * 1000
        return wide_key(F.timestamp_micros(micros), F.when(row_id != no_id, row_id))

    def with_keys(self, rows: DataFrame) -> DataFrame:
        """Add the two order keys, so that each is worked out once per row."""
        near, wide = self._keys()
        return rows.withColumns({"near_key": near, "wide_key": wide})

    def first(self, value: Column, prefix: str) -> list[Column]:
        """Aggregates for the first value; resolve them with :meth:`pick_first`."""
        near, wide = F.col("near_key"), F.col("wide_key")
        found = (F.min_by(value, near), F.min(near), F.min_by(value, wide), F.min(wide))
        return [c.alias(f"{prefix}_{n}") for c, n in zip(found, _NAMES)]

    def last(self, value: Column, prefix: str) -> list[Column]:
        near, wide = F.col("near_key"), F.col("wide_key")
        found = (F.max_by(value, near), F.max(near), F.max_by(value, wide), F.max(wide))
        return [c.alias(f"{prefix}_{n}") for c, n in zip(found, _NAMES)]

    def _pick(self, prefix: str, start: Column, wide_wins) -> Column:
        near_value, near, wide_value, wide = (F.col(f"{prefix}_{n}") for n in _NAMES)
        return (
            F.when(wide.isNull(), near_value)
            .when(near.isNull(), wide_value)
            .when(wide_wins(wide, self._widen(near, start)), wide_value)
            .otherwise(near_value)
        )

    def pick_first(self, prefix: str, start: Column) -> Column:
        return self._pick(prefix, start, lambda wide, near: wide < near)

    def pick_last(self, prefix: str, start: Column) -> Column:
        return self._pick(prefix, start, lambda wide, near: wide > near)
