from marketpulse.sources.feeds import shape_articles, shape_stories
from marketpulse.sources.frames import normalize_frames
from marketpulse.sources.messages import bad_ticks, file_values, kafka_values, parse_ticks, valid_ticks
from marketpulse.sources.tables import scan_day

__all__ = [
    "bad_ticks", "file_values", "kafka_values", "normalize_frames", "parse_ticks", "scan_day",
    "shape_articles", "shape_stories", "valid_ticks",
]
