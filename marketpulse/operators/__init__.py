from marketpulse.operators.bars import bars, latest_versions
from marketpulse.operators.prices import (
    by_day, change_of_day, day_over_day, day_prices, symbol_daily_avg,
)
from marketpulse.operators.ranking import keep_best, top_per_group

__all__ = [
    "bars", "by_day", "change_of_day", "day_over_day", "day_prices", "keep_best",
    "latest_versions", "symbol_daily_avg", "top_per_group",
]
