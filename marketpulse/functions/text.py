"""Text cleaning and first-usable-value rules."""

from pyspark.sql import functions as F

# Fixed value: the trailing " - Publisher" part of a headline. \z is the very end of the
# text, where Java's $ would also match before a final line break.
PUBLISHER_SUFFIX = r" - [^-]+\z"


def clean_headline(title):
    return F.trim(F.regexp_replace(title, PUBLISHER_SUFFIX, ""))


def is_blank(text):
    """NULL, empty, or nothing but spaces."""
    return F.coalesce(F.trim(text) == "", F.lit(True))


def first_usable_text(*candidates):
    """The first value that is neither NULL nor the empty string."""
    return F.coalesce(*[F.when(c != "", c) for c in candidates])


def first_usable_number(*candidates):
    """The first value that reads as a number other than zero."""
    return F.coalesce(*[F.nullif(c.try_cast("double"), F.lit(0.0)) for c in candidates])
