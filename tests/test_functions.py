from pyspark.sql import functions as F

from conftest import values
from marketpulse import functions as M
from marketpulse import schemas


def one(spark, column, **inputs):
    """The value of a column expression over a one-row frame of typed literals."""
    cells = [F.lit(v).cast(kind).alias(name) for name, (v, kind) in inputs.items()]
    return spark.range(1).select(*cells).select(column.alias("x")).first().x


def text(spark, function, value):
    return one(spark, function(F.col("t")), t=(value, "string"))


def test_headline_loses_only_the_last_plain_suffix(spark):
    clean = lambda t: text(spark, M.clean_headline, t)
    assert clean("X - Y - Publisher") == "X - Y"
    assert clean("Story - Coca-Cola") == "Story - Coca-Cola"
    assert clean(" - CNN") == ""
    assert clean("  padded - Site  ") == "padded"
    assert clean("Ireland's plan - The Paper") == "Ireland's plan"
    assert clean("line one - a\nb") == "line one"
    assert clean("ends with break - Site\n") == "ends with break"
    assert clean("\ttab stays") == "\ttab stays"
    assert clean(None) is None


def test_blank(spark):
    for value, expected in [(None, True), ("", True), ("  ", True), ("x", False), ("\t", False)]:
        assert text(spark, M.is_blank, value) is expected


def test_rounding_is_half_away_from_zero(spark):
    half = lambda v, n: one(spark, M.round_half_up(F.col("v"), n), v=(v, "double"))
    assert half(1.005, 2) == 1.01
    assert half(-2.5, 0) == -3.0
    assert half(12.344999999999999, 2) == 12.35
    assert half(128.05, 1) == 128.1
    assert half(None, 1) is None
    assert half(1e30, 2) == 1e30
    assert half(float("inf"), 2) == float("inf")
    assert half(float("nan"), 2) != half(float("nan"), 2)


def test_percent_change(spark):
    def change(now, before):
        return one(
            spark, M.percent_change(F.col("a"), F.col("b")), a=(now, "double"), b=(before, "double")
        )

    assert change(66954.91, 66888.01) == 0.1
    assert change(5.0, 5.0) == 0.0
    assert change(5.0, 0.0) is None
    assert change(5.0, None) is None
    assert change(None, 5.0) is None


def test_times(spark):
    assert text(spark, lambda c: M.safe_ts(c).cast("string"), "2024-03-01T10:11:12Z") == "2024-03-01 10:11:12"
    assert text(spark, M.safe_ts, "garbage") is None
    assert text(spark, lambda c: M.epoch_to_ts(c).cast("string"), "1704067261") == "2024-01-01 00:01:01"
    assert text(spark, M.epoch_to_ts, "soon") is None


def test_keys_are_stable(spark):
    key = one(
        spark, M.load_key("HN", F.col("i"), F.col("t")),
        i=(42, "long"), t=("2026-02-19 20:22:55", "timestamp"),
    )
    assert key == "HN_42_202602192022"
    assert text(spark, M.text_key, "a") == text(spark, M.text_key, "a")
    assert len(text(spark, M.text_key, "a")) == 64


def test_first_usable(spark):
    def number(a, b):
        c = M.first_usable_number(F.col("a"), F.col("b"))
        return one(spark, c, a=(a, "string"), b=(b, "string"))

    assert number("", "3.5") == 3.5
    assert number("0", "3.5") == 3.5
    assert number(None, None) is None
    assert number("abc", "2") == 2.0
    assert number("1", "2") == 1.0


def test_report_text(spark):
    money = lambda v: one(spark, M.money(F.col("v")), v=(v, "double"))
    percent = lambda v: one(spark, M.percent(F.col("v")), v=(v, "double"))
    assert money(66888.005) == "$66,888.01"
    assert money(82.5) == "$82.50"
    assert money(None) is None
    assert [percent(v) for v in (0.0, 0.1, -1.25, 12.0, None)] == [
        "0.0%", "0.1%", "-1.25%", "12.0%", None
    ]


def test_json_fields_never_fail(spark):
    rows = spark.createDataFrame(
        [('{"id":1,"score":"7"}',), ('{"id":null,"score":"many"}',), ('{"id":',), (None,)], "j string"
    )
    fields = M.json_fields(F.col("j"), id=("$.id", "string"), score=("$.score", "int"))
    assert values(rows.select(*fields)) == [("1", 7), (None, None), (None, None), (None, None)]


def test_records_are_parsed_once_and_the_broken_are_listed(spark):
    rows = spark.createDataFrame(
        [(1, '{"id":1,"title":" a ","score":{"x":1}}'), (2, '{"id":2,"ti'), (3, "null"), (4, None)],
        "n int, j string",
    )
    parsed = M.parse_records(rows, "j", schemas.STORY_RECORD, ["n"])
    assert values(parsed, "n", "id", "title", "score") == [
        (1, "1", " a ", '{"x":1}'), (2, None, None, None), (3, None, None, None), (4, None, None, None),
    ]
    assert values(M.malformed(rows, "j", schemas.STORY_RECORD, ["n"])) == [(2, '{"id":2,"ti'), (3, "null")]
    filtered = parsed.where((F.trim("title") != "") & (F.trim("url") != ""))
    assert filtered._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
