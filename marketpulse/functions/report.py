"""Values as report text."""

from pyspark.sql import functions as F

from marketpulse.functions.numbers import round_half_up


def or_text(text, missing):
    return F.coalesce(text.cast("string"), F.lit(missing))


def money(amount):
    """$1,234.50"""
    return F.concat(F.lit("$"), F.format_number(round_half_up(amount, 2), 2))


def percent(value):
    """At least one decimal and no padding: 0.0%, -1.25%, 0.1%."""
    text = F.regexp_replace(F.format_string("%.2f", value), r"0\z", "")
    return F.when(value.isNotNull(), F.concat(text, F.lit("%")))
