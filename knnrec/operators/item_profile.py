"""How many products the items of a table make, by class of item."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knnrec.operators.similarity import CELL_ROWS

#: Classes of rare items that together hold at most this share of the products
#: are multiplied before any threshold is known.
COLD_SHARE = 0.25


@dataclass
class ItemProfile:
    """Products (u < v) by item class: at most 64 numbers on the driver."""

    products: dict[int, int]
    largest: int

    @property
    def total(self) -> int:
        return sum(self.products.values())

    def cold_class(self, share: float = COLD_SHARE) -> int:
        """The last class that is multiplied in full."""
        seen, last = 0, -1
        for c in sorted(self.products):
            seen += self.products[c]
            if seen > share * self.total:
                break
            last = c
        return last

    def skewed(self, cell_rows: int = CELL_ROWS) -> bool:
        """Whether items of more than ``cell_rows`` raters make up most products."""
        hot = sum(n for c, n in self.products.items() if 2 ** c > cell_rows)
        return 2 * hot > self.total


def item_class(count: Column) -> Column:
    return F.floor(F.log2(count)).cast("int")


def item_counts(unit: DataFrame) -> DataFrame:
    return unit.groupBy("i").agg(F.count(F.lit(1)).alias("c"))


def item_profile(counts: DataFrame) -> ItemProfile:
    c = F.col("c").cast("decimal(38,0)")
    by_class = counts.groupBy(item_class(F.col("c")).alias("cls")).agg(
        F.sum(c * (c - 1) / 2).cast("decimal(38,0)").alias("n"), F.max("c").alias("largest"))
    rows = by_class.collect()
    return ItemProfile({r["cls"]: int(r["n"]) for r in rows}, max((r["largest"] for r in rows), default=0))
