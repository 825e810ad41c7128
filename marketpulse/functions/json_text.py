"""Reading JSON text columns."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

BAD_RECORD = "_corrupt_record"


def parse_records(df, text, schema, keep=()):
    """Parse the JSON object in column `text` into the fields of `schema`.

    The parsed struct goes through a one-element `inline`. A plain projection would let
    Catalyst push later filters below it and parse the text once more for every filtered
    field; filters stay above a generator, so each row is parsed once.
    Malformed text gives NULL fields and itself in `_corrupt_record`.
    """
    with_bad = T.StructType(schema.fields + [T.StructField(BAD_RECORD, T.StringType())])
    parsed = F.from_json(F.col(text).cast("string"), with_bad)
    return df.select(*keep, F.inline(F.array(parsed)))


def malformed(df, text, schema, keep=()):
    """The quarantine: rows whose text could not be parsed, with the text itself."""
    parsed = parse_records(df, text, schema, keep)
    return parsed.where(F.col(BAD_RECORD).isNotNull()).select(
        *keep, F.col(BAD_RECORD).alias("bad_text")
    )


def record_fields(rows, text, variant, schema, keep=()):
    """The top-level text fields of `schema`: from the VARIANT column `variant` where the rows
    have one, so that the scan reads these fields alone, else parsed from the JSON in `text`."""
    if variant not in rows.columns:
        return parse_records(rows, text, schema, keep)
    fields = [F.try_variant_get(variant, f"$.{f.name}", "string").alias(f.name) for f in schema]
    return rows.select(*keep, *fields)


def json_fields(text, **paths):
    """Columns read from a JSON text through VARIANT: `name=(path, type)`.

    A missing path, a JSON null, a value that does not convert and malformed text all
    give NULL.
    """
    variant = F.try_parse_json(text)
    return [
        F.try_variant_get(variant, path, kind).alias(name) for name, (path, kind) in paths.items()
    ]
