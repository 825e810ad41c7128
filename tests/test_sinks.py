import os
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import folders_read, plan, utc, values
from marketpulse import plans, schemas
from marketpulse.plans import batch, winners
from marketpulse.plans.batch import table_paths
from marketpulse.sinks import land_bronze, pointers, read_days, replace_days
from marketpulse.sources import scan_day
from marketpulse.workspace import scratch_dir
from test_plans import bronze, hn, news
from test_sources import feed, story

from pyspark.sql.types import DateType, IntegerType, StringType, StructField, StructType

SCHEMA = StructType([
    StructField("x", StringType()), StructField("n", IntegerType()), StructField("report_date", DateType()),
])


def rows(spark, *pairs):
    return spark.createDataFrame(
        [(x, n, utc(d + "T00:00:00").date()) for x, n, d in pairs], SCHEMA
    )


@pytest.fixture
def table(spark, tmp_path):
    path = f"{tmp_path}/t"
    replace_days(
        rows(spark, ("a", 1, "2026-02-18"), ("b", 2, "2026-02-19")), path, ["2026-02-18", "2026-02-19"]
    )
    return path


def current(spark, path, day=None):
    return values(read_days(spark, path, SCHEMA, day=day), "x", "n", "report_date")


def test_days_are_replaced_one_by_one(spark, table):
    replace_days(rows(spark, ("c", 3, "2026-02-19")), table, ["2026-02-19"])
    assert current(spark, table) == [("a", 1, "2026-02-18"), ("c", 3, "2026-02-19")]
    assert current(spark, table, "2026-02-19") == [("c", 3, "2026-02-19")]


def test_rerun_gives_the_same_rows(spark, table):
    for _ in range(3):
        replace_days(rows(spark, ("b", 2, "2026-02-19")), table, ["2026-02-19"])
    assert current(spark, table) == [("a", 1, "2026-02-18"), ("b", 2, "2026-02-19")]


def test_a_day_can_become_empty(spark, table):
    replace_days(rows(spark), table, ["2026-02-19"])
    assert current(spark, table) == [("a", 1, "2026-02-18")]
    replace_days(rows(spark, ("d", 4, "2026-02-19")), table, ["2026-02-19"])
    assert current(spark, table, "2026-02-19") == [("d", 4, "2026-02-19")]


def test_failed_write_keeps_the_earlier_rows_and_can_be_repeated(spark, table):
    failing = rows(spark, ("c", 3, "2026-02-19")).withColumn(
        "n", F.when(F.col("n") == 3, F.raise_error(F.lit("boom")).cast("int"))
    )
    with pytest.raises(Exception, match="boom"):
        replace_days(failing, table, ["2026-02-19"])
    assert current(spark, table) == [("a", 1, "2026-02-18"), ("b", 2, "2026-02-19")]
    replace_days(rows(spark, ("c", 3, "2026-02-19")), table, ["2026-02-19"])
    assert current(spark, table, "2026-02-19") == [("c", 3, "2026-02-19")]


def test_without_a_list_the_days_of_the_rows_are_replaced(spark, table):
    more = rows(spark, ("c", 3, "2026-02-19"), ("d", 4, "2026-02-19"), ("e", 5, "2026-02-21"))
    replace_days(more, table)
    assert current(spark, table) == [
        ("a", 1, "2026-02-18"), ("c", 3, "2026-02-19"), ("d", 4, "2026-02-19"), ("e", 5, "2026-02-21")
    ]


def test_rows_of_other_days_are_left_out(spark, table):
    replace_days(rows(spark, ("c", 3, "2026-02-19"), ("q", 4, "2026-02-21")), table, ["2026-02-19"])
    assert current(spark, table) == [("a", 1, "2026-02-18"), ("c", 3, "2026-02-19")]


def test_reading_a_table_that_does_not_exist_yet(spark, tmp_path):
    assert read_days(spark, f"{tmp_path}/none", SCHEMA).count() == 0


def test_after_many_versions_only_the_current_files_are_there(spark, table):
    for n in range(5):
        replace_days(rows(spark, ("c", n, "2026-02-19")), table, ["2026-02-19"])
    assert sorted(d for d in os.listdir(table) if "=" in d) == ["report_date=2026-02-18", "report_date=2026-02-19"]
    stored = spark.read.schema(SCHEMA).parquet(f"{table}/report_date=2026-02-19")
    assert values(stored.where("x IS NOT NULL"), "x", "n") == [("c", 4)]


def test_one_day_read_prunes_the_other_folders(spark, table):
    day = read_days(spark, table, SCHEMA, day="2026-02-19")
    assert "PartitionFilters: [isnotnull(report_date" in plan(day)
    assert folders_read(day) == 1


def test_bronze_folders_and_repeats(spark, tmp_path):
    path = f"{tmp_path}/bronze"
    fetched = bronze(spark, hn(), news())
    for _ in range(2):  # the second is a retry of the same run
        land_bronze(fetched, path, "r1")
    land_bronze(bronze(spark, hn(at="2026-02-20T00:00:00")), path, "r2")
    land_bronze(bronze(spark, hn()), path, "r3")
    table = spark.read.schema(schemas.BRONZE_POSTS).parquet(path)
    assert values(scan_day(table, "fetch_date", "2026-02-19", source="hackernews"), "load_id", "run_id") == [
        ("L0", "r1"), ("L0", "r3")
    ]
    assert table.count() == 4


def raw_articles(spark, at, *articles):
    import json

    text = json.dumps({"articles": list(articles)})
    return spark.createDataFrame([(utc(at), text)], "fetched_at timestamp, value string")


def article(url, title="T - Site"):
    return {"title": title, "description": "d", "url": url, "publishedAt": "2026-02-19T08:00:00Z", "source": {"name": "Site"}}


def run(spark, root, run_id, items, articles, ticks):
    # the 23:45 run takes place, and fetches, after midnight
    stories = feed(spark, items).withColumn("fetched_at", F.lit("2026-02-20 00:12:00").cast("timestamp"))
    return plans.run_batch(spark, root, "2026-02-19T23:45:00", stories, articles, ticks, run_id)


def no_ticks(spark):
    return spark.createDataFrame([], "symbol string, price double, event_time timestamp")


def test_batch_chain_and_its_rerun(spark, tmp_path):
    root = str(tmp_path)
    pages = raw_articles(spark, "2026-02-19T23:45:00", article("http://a"), article("http://a"), article(""))
    items = [story(1, score=5), story(2, score=9), story(3, url=""), story(4, type="job")]
    first = run(spark, root, "r1", items, pages, no_ticks(spark)).first()
    assert (first.top_hn_story, first.hn_max_score, first.total_articles, first.all_articles) == ("t2", 9, 2, 3)

    # a later run of the same day sees a better score; days are replaced, bronze grows
    again = run(spark, root, "r2", [story(1, score=50)], pages, no_ticks(spark)).first()
    assert (again.top_hn_story, again.hn_max_score, again.total_articles) == ("t1", 50, 2)

    paths = table_paths(root)
    silver = read_days(spark, paths["silver_posts"], schemas.SILVER_POSTS, "run_date")
    assert values(silver.where("source = 'hackernews'"), "post_id", "score", "run_date") == [
        ("1", 50, "2026-02-19"), ("2", 9, "2026-02-19")
    ]
    top = read_days(spark, paths["top_stories"], schemas.TOP_STORIES)
    assert values(top, "source", "title", "rank") == [
        ("hackernews", "t1", 1), ("hackernews", "t2", 2), ("news_api", "T", 1)
    ]
    audit = spark.read.schema(schemas.RUN_AUDIT).parquet(paths["run_audit"])
    assert values(audit, "run_id", "records_fetched", "records_loaded", "status", "execution_date") == [
        ("r1", 6, 3, "SUCCESS", "2026-02-19 23:45:00"), ("r2", 4, 3, "SUCCESS", "2026-02-19 23:45:00")
    ]
    counts = read_days(spark, paths["source_counts"], schemas.SOURCE_COUNTS, "run_date")
    assert values(counts, "source", "total") == [("hackernews", 2), ("news_api", 1)]
    report = read_days(spark, paths["reports"], schemas.REPORTS).first().report
    assert "Top HN Story  : t1" in report


def test_all_landed_rows_are_loaded_and_the_broken_are_kept(spark, tmp_path):
    items = [story(n) for n in range(1, 51)] + ['{"id": 51, "ti', "words"]
    pages = raw_articles(spark, "2026-02-19T23:45:00", *[article(f"http://{n}") for n in range(45)])
    broken_page = spark.createDataFrame([(utc("2026-02-19T23:45:00"), '{"articles": [')], "fetched_at timestamp, value string")
    for _ in range(2):  # a retry changes nothing
        run(spark, str(tmp_path), "r1", items, pages.unionAll(broken_page), no_ticks(spark))
    paths = table_paths(str(tmp_path))
    assert spark.read.schema(schemas.BRONZE_POSTS).parquet(paths["bronze_posts"]).count() == 95
    bad = spark.read.schema(schemas.QUARANTINE).parquet(paths["quarantine"])
    assert values(bad, "feed", "bad_text", "run_id", "run_date") == [
        ("hackernews", "words", "r1", "2026-02-19"), ("hackernews", '{"id": 51, "ti', "r1", "2026-02-19"),
        ("news_api", '{"articles": [', "r1", "2026-02-19"),
    ]


def test_run_id_follows_from_the_logical_time(spark, tmp_path):
    pages = raw_articles(spark, "2026-02-19T23:45:00", article("http://a"))
    for _ in range(2):
        run(spark, str(tmp_path), None, [story(1)], pages, no_ticks(spark))
    paths = table_paths(str(tmp_path))
    assert spark.read.schema(schemas.BRONZE_POSTS).parquet(paths["bronze_posts"]).count() == 2
    audit = spark.read.schema(schemas.RUN_AUDIT).parquet(paths["run_audit"])
    assert values(audit, "run_id") == [("20260219T234500",)] * 2


def test_batch_chain_without_any_news(spark, tmp_path):
    ticks = spark.createDataFrame(
        [("BTC-USD", 2.0, utc("2026-02-19T01:00:00"))], "symbol string, price double, event_time timestamp"
    )
    empty = raw_articles(spark, "2026-02-19T23:45:00")
    stories = spark.createDataFrame([], "fetched_at timestamp, feed_pos int, value string")
    row = plans.run_batch(spark, str(tmp_path), "2026-02-19", stories, empty, ticks).first()
    assert (row.top_hn_story, row.total_articles, row.btc_avg_price) == (None, None, 2.0)


def test_failed_chain_is_audited(spark, tmp_path):
    broken = no_ticks(spark).drop("price")
    with pytest.raises(Exception):
        run(spark, str(tmp_path), "r1", [story(1)], raw_articles(spark, "2026-02-19T23:45:00"), broken)
    audit = spark.read.schema(schemas.RUN_AUDIT).parquet(table_paths(str(tmp_path))["run_audit"])
    assert values(audit, "records_fetched", "records_loaded", "status") == [(1, 1, "FAILED")]


class Settings(dict):
    """A session that only has settings."""

    @property
    def conf(self):
        return self


def test_scratch_folder_is_the_shared_one():
    shared = Settings({"spark.checkpoint.dir": "s3a://bucket/checkpoints/", "spark.master": "yarn"})
    assert scratch_dir(shared, "a").startswith("s3a://bucket/checkpoints/a-")
    assert scratch_dir(shared, "a") != scratch_dir(shared, "a")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(Settings({"spark.master": "yarn"}), "a")


class Died(Exception):
    """The driver is gone."""


def dying(monkeypatch, name, step):
    """Let the driver die at a step: at the n-th call of a function of `pointers`."""
    calls, whole = [], getattr(pointers, name)

    def call(*args):
        calls.append(args)
        if len(calls) == step:
            raise Died
        return whole(*args)

    monkeypatch.setattr(pointers, name, call)


@pytest.mark.parametrize("name, step, switched", [
    ("matching", 1, 0), ("appear", 1, 0), ("appear", 2, 1), ("remove", 1, 2), ("remove", 2, 2), ("remove", 3, 2), ("remove", 4, 2),
])
def test_a_driver_that_dies_leaves_each_day_old_or_new(spark, table, monkeypatch, name, step, switched):
    old = [("a", 1, "2026-02-18"), ("b", 2, "2026-02-19")]
    new = [("c", 3, "2026-02-18"), ("d", 4, "2026-02-19")]
    days = ["2026-02-18", "2026-02-19"]
    with monkeypatch.context() as patch:
        dying(patch, name, step)
        with pytest.raises(Died):
            replace_days(rows(spark, *new), table, days)
    assert current(spark, table) == sorted(new[:switched] + old[switched:])
    replace_days(rows(spark, *new), table, days)
    assert current(spark, table) == new
    for d in days:  # what the dead driver left is gone
        assert len([f for f in os.listdir(f"{table}/report_date={d}") if "=" in f]) == 1
    assert len([f for f in os.listdir(f"{table}/_current") if f.startswith("2026")]) == 2


def test_documents_of_other_days_stay(spark, tmp_path):
    path, kind = f"{tmp_path}/docs", "hackernews array<struct<id long, title string, score int>>, news array<struct<title string, source string>>, ds date"
    def document(title, day):
        return spark.createDataFrame([([(1, title, 2)], [], utc(day + "T00:00:00").date())], kind)

    for title, day in (("first", "2026-02-18"), ("second", "2026-02-19"), ("second again", "2026-02-19")):
        plans.write_documents(document(title, day), path)
    read = plans.read_documents(spark, path).select("ds", F.col("hackernews.title").getItem(0).alias("title"), "news")
    assert values(read) == [("2026-02-18", "first", []), ("2026-02-19", "second again", [])]
    one = plans.read_documents(spark, path, "2026-02-18")
    assert folders_read(one) == 1 and one.count() == 1
    plans.write_documents(document("none", "2026-02-20"), path, ["2026-02-18"])
    assert values(plans.read_documents(spark, path), "ds") == [("2026-02-19",)]
    assert plans.read_documents(spark, f"{tmp_path}/nothing").count() == 0


def test_pointers_follow_the_largest_number(spark, tmp_path):
    root = str(tmp_path)
    assert pointers.current(spark, root) == {}
    for n in range(12):
        pointers.switch(spark, root, {"k": f"v{n}"})
    pointers.switch(spark, root, {"other": "w"})
    assert pointers.current(spark, root) == {"k": "v11", "other": "w"}
    assert len(pointers.forget(spark, root, {"k"})) == 11
    assert pointers.current(spark, root) == {"k": "v11", "other": "w"}


def landed(spark, root, run_id, day, items, at="10:00:00"):
    """A run that has landed its stories and nothing more."""
    rows = bronze(spark, *[hn(at=f"{day}T{at}", **item) for item in items])
    rows = rows.withColumn("load_id", F.concat(F.lit(run_id), "load_id"))
    land_bronze(rows, table_paths(root)["bronze_posts"], run_id)


def silver(spark, root, *columns):
    rows = read_days(spark, table_paths(root)["silver_posts"], schemas.SILVER_POSTS, "run_date")
    return values(rows, *(columns or [c for c in rows.columns if c != "loaded_at"]))


def whole(spark, root):
    """Silver from all that has landed."""
    table = spark.read.schema(schemas.BRONZE_POSTS).parquet(table_paths(root)["bronze_posts"])
    rows = plans.silver_posts(table)
    return values(rows, *[f.name for f in schemas.SILVER_POSTS if f.name != "loaded_at"])


def test_runs_are_merged_into_the_winners(spark, tmp_path, monkeypatch):
    root, read = str(tmp_path), []

    def spy(bronze, versions=winners.versions):
        read.append(folders_read(bronze))
        return versions(bronze)

    monkeypatch.setattr(winners, "versions", spy)
    for n in range(5):
        items = [dict(id=i, title=f"t{n}", score=(i * 7 + n * 5) % 11) for i in range(n, n + 6)]
        landed(spark, root, f"r{n}", "2026-02-19", items, f"1{n}:00:00")
        assert plans.catch_up(spark, root, no_ticks(spark)) == ["2026-02-19"]
        assert silver(spark, root) == whole(spark, root)
    assert read == [1] * 5  # only the run's own folder
    assert plans.catch_up(spark, root, no_ticks(spark)) == []

    # A run that lands again takes back what it had won.
    landed(spark, root, "r2", "2026-02-19", [dict(id=3, score=1)], "12:00:00")
    assert plans.catch_up(spark, root, no_ticks(spark)) == ["2026-02-19"]
    assert read[-1] == 5 and silver(spark, root) == whole(spark, root)


def test_only_days_with_new_runs_are_rebuilt(spark, tmp_path):
    root = str(tmp_path)
    days = [f"2026-03-{d:02}" for d in range(1, 31)]
    rows = [hn(at=f"{d}T10:00:00", id=n, title=d, score=n) for d in days for n in range(3)]
    land_bronze(bronze(spark, *rows), table_paths(root)["bronze_posts"], "r1")
    ticks = spark.createDataFrame(
        [("BTC-USD", 2.0 + n, utc(f"{d}T01:00:00")) for n, d in enumerate(days)], "symbol string, price double, event_time timestamp"
    )
    assert plans.catch_up(spark, root, ticks) == days
    before = pointers.current(spark, table_paths(root)["insights"])
    changed = [days[4], days[5], days[20]]
    for d in changed:
        landed(spark, root, "r2", d, [dict(id=9, title="new", score=50)], "11:00:00")
    assert plans.catch_up(spark, root, ticks) == changed
    after = pointers.current(spark, table_paths(root)["insights"])
    assert [d for d in days if before[d] != after[d]] == changed
    assert silver(spark, root) == whole(spark, root)
    stored = read_days(spark, table_paths(root)["insights"], schemas.INSIGHTS).drop("loaded_at")
    full = plans.insights_all(plans.source_summary(plans.silver_posts(
        spark.read.schema(schemas.BRONZE_POSTS).parquet(table_paths(root)["bronze_posts"]))), ticks)
    assert values(stored) == values(full, *stored.columns)
    assert folders_read(read_days(spark, table_paths(root)["winners"], schemas.WINNERS, "run_date", days=changed)) == 3


def test_a_chain_that_dies_is_caught_up(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    landed(spark, root, "r1", "2026-02-19", [dict(id=1, score=3)])
    for step in range(1, 8):  # at the switch of each table
        landed(spark, root, f"s{step}", "2026-02-19", [dict(id=step, title=f"s{step}", score=step)])
        with monkeypatch.context() as patch:
            dying(patch, "appear", step)
            with pytest.raises(Died):
                plans.catch_up(spark, root, no_ticks(spark))
        assert plans.catch_up(spark, root, no_ticks(spark)) == ["2026-02-19"]
        assert silver(spark, root) == whole(spark, root)
    report = read_days(spark, table_paths(root)["reports"], schemas.REPORTS).first().report
    assert "Top HN Story  : s7" in report


def test_bronze_records_are_read_field_by_field(spark, tmp_path):
    path = f"{tmp_path}/bronze"
    rows = bronze(spark, hn(title="it's"), hn(id=2, score="n/a"), hn(id=3, score=None), news(), ("hackernews", "2026-02-19T10:00:00", "{broken"))
    land_bronze(rows, path, "r1")
    table = spark.read.schema(schemas.BRONZE_POSTS).parquet(path)
    assert values(table.where("raw_data IS NOT NULL"), "load_id", "raw_data") == [("L4", "{broken")]
    for made in (plans.silver_posts, plans.silver_stories, plans.silver_articles):
        assert values(made(table)) == values(made(rows))
    assert "from_json" in plan(plans.silver_stories(rows)) and "from_json" not in plan(plans.silver_posts(table))
    read = [line for line in plan(plans.silver_stories(table)).split("\n") if "ReadSchema" in line]
    assert all("record:struct<0:string" in line for line in read) and read


def test_thousands_of_days_are_caught_up_at_once(spark, tmp_path, monkeypatch):
    """The chain of 1,500 days, up to their insights; folders are not written."""
    first, made = date(2020, 1, 1), {}
    days = [str(first + timedelta(n)) for n in range(1500)]

    def keep(rows, table, *place, **options):
        if table.endswith("/insights"):
            made["rows"] = values(rows.where("btc_avg_price IS NOT NULL"), "report_date", "btc_avg_price", "btc_price_change")
            made["count"] = rows.count()

    monkeypatch.setattr(batch, "landed_runs", lambda *place: {day: {"r1": 1} for day in days})
    monkeypatch.setattr(batch, "merge_days", lambda *place: None)
    monkeypatch.setattr(batch, "replace_days", keep)
    ticks = spark.createDataFrame(
        [("BTC-USD", p, utc(f"{d}T01:00:00")) for p, d in ((2.0, "2019-12-31"), (3.0, days[0]), (4.0, days[-1]), (5.0, "2030-01-01"))],
        "symbol string, price double, event_time timestamp",
    )
    ticks.withColumn("event_date", F.to_date("event_time")).write.partitionBy("event_date").parquet(f"{tmp_path}/ticks")
    for prices in (ticks, spark.read.parquet(f"{tmp_path}/ticks")):
        assert plans.catch_up(spark, f"{tmp_path}/tables", prices) == days
        assert made == {"count": 1500, "rows": [(days[0], 3.0, 50.0), (days[-1], 4.0, None)]}


def test_notes_of_many_days(spark, tmp_path):
    """Each day's version carries its own note."""
    path, first = f"{tmp_path}/t", date(2020, 1, 1)
    days = [str(first + timedelta(n)) for n in range(400)]
    new = rows(spark, ("a", 1, days[0]), ("b", 2, days[0]), ("c", 3, days[399]), ("x", 4, "2019-01-01"))
    for few in (False, True):
        replace_days(new, path, days, notes={d: f"n{d[-2:]}" for d in days}, few=few)
        assert current(spark, path) == [("a", 1, days[0]), ("b", 2, days[0]), ("c", 3, days[399])]
        versions = pointers.current(spark, path)
        assert versions[days[0]].endswith("-n01") and versions[days[399]].endswith(f"-n{days[399][-2:]}")
        assert len(versions) == 400 and set(list(versions.values())[1:-1]) == {"none"}


def test_few_rows_of_many_days_are_written_by_several_tasks(spark, tmp_path):
    path, first = f"{tmp_path}/t", date(2020, 1, 1)
    days = [str(first + timedelta(n)) for n in range(40)]
    replace_days(rows(spark, *[(d, 1, d) for d in days for _ in range(2)]), path, days, few=True)
    files = [f for d in days for _, _, names in os.walk(f"{path}/report_date={d}") for f in names if f.endswith(".parquet")]
    assert len(files) == 40 and len({f.split("-")[1] for f in files}) > 1
    assert read_days(spark, path, SCHEMA).count() == 80


MANY = [str(date(2020, 1, 1) + timedelta(n)) for n in range(200)]


def many(spark, x, days=MANY):
    return rows(spark, *[(x, n, d) for n, d in enumerate(days)])


def told(x, days=MANY):
    return [(x, n, d) for n, d in enumerate(days)]


def in_order(found):
    return sorted(found, key=repr)


def files(path, ending=".parquet"):
    return [os.path.join(at, f) for at, _, names in os.walk(path) for f in names if f.endswith(ending)]


def groups(path):
    return sorted(at[len(path):] for at, _, _ in os.walk(path) if "days_group=" in at)


def test_many_days_share_files_and_a_pointer(spark, tmp_path):
    path = f"{tmp_path}/t"
    for few in (False, True):
        replace_days(many(spark, f"a{few}"), path, MANY, few=few)
        assert len(files(path)) == 4 and len([f for f in os.listdir(f"{path}/_current") if "." not in f[:1]]) == 1
    assert current(spark, path) == in_order(told("aTrue"))
    assert current(spark, path, MANY[70]) == [("aTrue", 70, MANY[70])]

    # Some days anew, alone: the others stay where they are, read without the rows that went.
    replace_days(rows(spark, ("b", 1, MANY[0]), ("b", 2, MANY[70])), path, [MANY[0], MANY[1], MANY[70]])
    expected = [r for r in told("aTrue") if r[1] not in (0, 1, 70)] + [("b", 1, MANY[0]), ("b", 2, MANY[70])]
    assert current(spark, path) == in_order(expected) and len(groups(path)) == 4
    assert values(read_days(spark, path, SCHEMA, days=MANY[69:72]), "x", "n") == [("aTrue", 69), ("aTrue", 71), ("b", 2)]
    assert current(spark, path, MANY[1]) == []

    # Many days anew, in other groups: groups go with the last of their days, folders of days at once.
    replace_days(many(spark, "c", MANY[:100]), path, MANY[:100])
    expected = told("c", MANY[:100]) + [r for r in told("aTrue") if r[1] >= 100]
    assert current(spark, path) == in_order(expected) and len(groups(path)) == 2 + 3
    assert [f for f in files(path) if "report_date=" in f] == []
    replace_days(many(spark, "d"), path, MANY)
    assert current(spark, path) == in_order(told("d")) and len(groups(path)) == 4 and len(os.listdir(f"{path}/_together")) == 1
    replace_days(rows(spark, ("x", 1, "2031-01-01")), path, MANY)  # none has rows
    assert current(spark, path) == [] and groups(path) == []
    assert set(pointers.current(spark, path).values()) == {"none"}


@pytest.mark.parametrize("name, step, switched", [
    ("write_text", 1, False), ("write_text", 2, False), ("appear", 1, False), ("remove", 1, True), ("remove", 2, True),
])
def test_a_driver_that_dies_leaves_many_days_old_or_new(spark, tmp_path, monkeypatch, name, step, switched):
    path = f"{tmp_path}/t"
    replace_days(many(spark, "a"), path, MANY)
    with monkeypatch.context() as patch:
        dying(patch, name, step)
        with pytest.raises(Died):
            replace_days(many(spark, "b"), path, MANY)
    assert current(spark, path) == in_order(told("b" if switched else "a"))
    replace_days(rows(spark, ("z", 0, "2031-01-01")), path, ["2031-01-01"])  # leaves what is another's
    left = len(groups(path))
    assert left == (4 if (name, step) in (("write_text", 1), ("remove", 2)) else 8)
    replace_days(many(spark, "c"), path, MANY)
    assert current(spark, path) == in_order([*told("c"), ("z", 0, "2031-01-01")])
    assert len(groups(path)) == 4 and len(files(f"{path}/_together")) == 4
    assert len([f for f in os.listdir(f"{path}/_current") if f.startswith("_list")]) == 1


def test_many_days_are_merged_from_run_to_run(spark, tmp_path):
    """Winners, silver and gold of days that share files."""
    root, bronze_path = str(tmp_path), table_paths(str(tmp_path))["bronze_posts"]
    ticks = no_ticks(spark)
    for n, days in enumerate((MANY[:150], MANY[50:], MANY[60:63])):
        items = [hn(at=f"{d}T1{n}:00:00", id=i, title=f"t{n}", score=(i * 7 + n * 5) % 11) for d in days for i in range(n, n + 2)]
        land_bronze(bronze(spark, *items), bronze_path, f"r{n}")
        assert plans.catch_up(spark, root, ticks) == days
        assert silver(spark, root) == whole(spark, root)
        assert plans.catch_up(spark, root, ticks) == []
    stored = read_days(spark, table_paths(root)["insights"], schemas.INSIGHTS).drop("loaded_at")
    full = plans.insights_all(plans.source_summary(plans.silver_posts(
        spark.read.schema(schemas.BRONZE_POSTS).parquet(bronze_path))), ticks)
    assert values(stored) == values(full, *stored.columns) and stored.count() == 200
    assert len(files(table_paths(root)["reports"])) < 40
