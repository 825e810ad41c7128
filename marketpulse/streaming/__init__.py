from marketpulse.streaming.bar_table import (
    bar_differences, bar_updates, heal_bars, latest_bars, merge_bars, rebuild_bars,
)
from marketpulse.streaming.compaction import compact_days, read_compacted
from marketpulse.streaming.service import StreamAudit, watch
from marketpulse.streaming.ticks import (
    end_marker, open_bars, start_bars, start_bars_final, start_bronze, start_quarantine, start_silver,
    start_streams, stream_bars, tick_stream,
)

__all__ = [
    "StreamAudit", "bar_differences", "bar_updates", "compact_days", "end_marker", "heal_bars", "latest_bars",
    "merge_bars", "open_bars", "read_compacted", "rebuild_bars", "start_bars", "start_bars_final", "start_bronze", "start_quarantine",
    "start_silver", "start_streams", "stream_bars", "tick_stream", "watch",
]
