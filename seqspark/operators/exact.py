"""Sums of doubles that are exact, and so the same in whatever order rows come."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bits a sum of limbs may take; the rest of a long is sign and reserve.
SUM_BITS = 62


class Limbs:
    """How the doubles of a table fall into whole numbers at fixed powers of two.

    Every value is a whole multiple of ``2**low`` and below ``2**high``. It is cut into limbs of ``bits`` bits,
    so few that ``rows`` of them add up within a long. Limbs are summed as longs, which is exact, combines
    before the shuffle and needs 8 bytes a limb; the sums are put together once per group. Whole numbers and
    prices need one or two limbs, a table of 1e300 and 1e-300 as many as that takes.
    """

    def __init__(self, low: int, high: int, rows: int, odd: bool = False):
        self.low, self.odd = low, odd
        self.bits = max(1, SUM_BITS - int(rows).bit_length())
        self.count = max(1, -(-(high - low) // self.bits))

    @classmethod
    def of(cls, df: DataFrame, *columns: str) -> Limbs:
        """Limbs for the given columns, from one pass over these columns alone."""
        value = F.explode(F.array(*[F.col(c).cast("double") for c in columns])).alias("_v")
        finite = ~F.isnan("_v") & (F.abs(F.col("_v")) < float("inf"))
        size = F.when(finite & (F.col("_v") != 0), F.abs(F.col("_v")))
        found = df.select(value).agg(
            F.count("_v").alias("rows"), F.max(size).alias("high"), F.min(size).alias("low"),
            F.coalesce(F.bool_and(F.when(finite, F.rint("_v") == F.col("_v"))), F.lit(True)).alias("whole"),
            F.coalesce(F.bool_or(~finite), F.lit(False)).alias("odd"),
        ).first()
        if found["high"] is None:
            return cls(0, 1, found["rows"], found["odd"])
        # The last of 53 bits of the least value; nothing is smaller than the last bit of the least double.
        low = max(math.frexp(found["low"])[1] - 53, -1074)
        return cls(max(low, 0) if found["whole"] else low, math.frexp(found["high"])[1], found["rows"], found["odd"])

    def _sums(self, value: Column) -> list[Column]:
        out = []
        for i in range(self.count):
            at = self.low + i * self.bits
            # What is above this limb is taken off exactly by a remainder.
            rest = value if i + 1 == self.count else value % F.lit(2.0 ** (at + self.bits))
            out.append(F.sum((rest / F.lit(2.0**at)).cast("bigint")))
        return out

    def _joined(self, sums: list[Column], sign: int) -> Column:
        """Carries go up, then digits that are not negative are added from the least on."""
        start = F.struct(F.lit(0).cast("bigint").alias("carry"), F.lit(0.0).alias("total"), F.lit(2.0**self.low).alias("unit"))

        def add(state: Column, limb: Column) -> Column:
            here = limb * sign + state["carry"]
            digit = here.bitwiseAND(F.lit((1 << self.bits) - 1))
            return F.struct(
                F.shiftright(here, self.bits).alias("carry"),
                (state["total"] + digit.cast("double") * state["unit"]).alias("total"),
                (state["unit"] * F.lit(2.0**self.bits)).alias("unit"),
            )

        return F.aggregate(F.array(*sums), start, add)

    def sum(self, column: str) -> Column:
        """The sum of the column, NULL if all values are. With a NaN or an infinite value, what these add up to."""
        value = F.col(column).cast("double")
        finite = F.when(~F.isnan(value) & (F.abs(value) < float("inf")), value) if self.odd else value
        sums = self._sums(finite)
        if self.count == 1:
            exact = sums[0].cast("double") * F.lit(2.0**self.low)
        else:
            up, down = self._joined(sums, 1), self._joined(sums, -1)

            def total(state: Column) -> Column:
                # A unit beyond the largest double only ever meets a carry of 0.
                more = F.when(state["carry"] == 0, F.lit(0.0)).otherwise(state["carry"].cast("double") * state["unit"])
                return state["total"] + more

            exact = F.when(up["carry"] < 0, -total(down)).otherwise(total(up))
        if not self.odd:
            return F.when(F.count(value) > 0, exact)
        return F.when(F.count(value) > F.count(finite), F.sum(value)).when(F.count(value) > 0, exact)

    def mean(self, column: str) -> Column:
        return F.when(F.count(column) > 0, self.sum(column) / F.count(column))
