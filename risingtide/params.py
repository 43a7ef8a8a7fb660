"""Job parameters.

Every threshold the screen uses is a field here, with the reference job's
hard-coded values as defaults.  Parameters are plain Python values that end
up as literals in the logical plan, so Catalyst folds and pushes them like
any other constant.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, replace


# Fixed values that must equal the reference job's for the same results.
DEFAULT_WINDOW_DAYS = 10          # trailing calendar days of bars
DEFAULT_UP_DAY_PERCENT = 5.0      # a day counts as "up" when percent > this
DEFAULT_MIN_UP_DAYS = 3           # a symbol needs at least this many up-days
DEFAULT_MIN_PERIOD_GAIN = 20.0    # whole-window gain must be > this
DEFAULT_MIN_MARKET_CAP = 100_000_000  # market cap must be > this
DEFAULT_NEWS_PER_SYMBOL = 3       # at most this many articles per symbol
NEWS_SEPARATOR = "***"            # joins several articles into one string
MISSING_TEXT = "no data"          # fills string columns that stayed NULL


@dataclass(frozen=True)
class ScreenParams:
    """Thresholds of the repetitive-upside screen and its lookups."""

    end_date: _dt.date = _dt.date(2024, 1, 30)
    window_days: int = DEFAULT_WINDOW_DAYS
    up_day_percent: float = DEFAULT_UP_DAY_PERCENT
    min_up_days: int = DEFAULT_MIN_UP_DAYS
    min_period_gain: float = DEFAULT_MIN_PERIOD_GAIN
    min_market_cap: int = DEFAULT_MIN_MARKET_CAP
    news_per_symbol: int = DEFAULT_NEWS_PER_SYMBOL
    # "none": a missing close gives a NULL change (pandas >= 3);
    # "ffill": carry the previous close forward first (pandas < 3).
    fill: str = "none"

    @property
    def start_date(self) -> _dt.date:
        return self.end_date - _dt.timedelta(days=self.window_days)

    def with_(self, **kw) -> "ScreenParams":
        return replace(self, **kw)


# The driver tables stand in for the market data; money there is in the
# thousands, so the bound cap threshold is scaled down accordingly.
DRIVER_PARAMS = ScreenParams(min_market_cap=1000)
