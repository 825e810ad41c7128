from marketpulse.functions.json_text import json_fields, malformed, parse_records, record_fields
from marketpulse.functions.keys import load_key, text_key
from marketpulse.functions.numbers import percent_change, round_half_up
from marketpulse.functions.report import money, or_text, percent
from marketpulse.functions.text import clean_headline, first_usable_number, first_usable_text, is_blank
from marketpulse.functions.times import epoch_to_ts, safe_ts

__all__ = [
    "clean_headline", "epoch_to_ts", "first_usable_number", "first_usable_text", "is_blank",
    "json_fields", "load_key", "malformed", "money", "or_text", "parse_records", "percent",
    "percent_change", "record_fields", "round_half_up", "safe_ts", "text_key",
]
