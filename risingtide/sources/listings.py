"""Exchange listings (S1, U-1).

The reference asked a listing service for one exchange's symbols and put
the exchanges' lists one after the other, duplicates kept.  Here a listing
is a table; one exchange's symbols are a filtered projection (the filter
reaches the scan) and the universe is a ``UNION ALL`` of such projections.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def listing_symbols(listings: DataFrame, exchange: str, code_col: str = "Code",
                    exchange_col: str = "exchange") -> DataFrame:
    """``(symbol)`` of the rows of one exchange."""
    return (listings.where(F.col(exchange_col) == F.lit(exchange))
            .select(F.col(code_col).alias("symbol")))


def universe(*lists: DataFrame) -> DataFrame:
    """U-1: the symbol lists one after the other, duplicates kept (a symbol
    on two exchanges appears twice; the bar lookup's semi-join makes its
    bars unique, H8)."""
    return reduce(lambda a, b: a.union(b), [x.select("symbol") for x in lists])
