"""Stored tables, the batch pipeline and the stream, run more than once."""

from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadsheet.plans import medallion as M
from broadsheet.schemas import BRONZE, RAW, SILVER
from broadsheet.session import broadcast_if_small, fits, scratch_path, shared_dir, stage
from broadsheet.sources import posts as A
from broadsheet.sources import tables as S
from broadsheet.streaming.ingest import ingest_stream

JAN, FEB = datetime(2024, 1, 10), datetime(2024, 2, 10)
START, END = datetime(2024, 1, 1), datetime(2024, 2, 29, 23, 59, 59)


def record(url, modified, title="t"):
    year, month = (modified.year, modified.month) if modified else (None, None)
    row = dict(url=url, title=title, date_modified=modified, tags=["x"], content_links=[("a", "/a")], content=["b"], year=year, month=month)
    return tuple(row.get(f.name) for f in RAW)


def records(spark, *rows):
    return spark.createDataFrame(list(rows), RAW)


def bag(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


def test_write_raw_merges_months(spark):
    base = scratch_path(spark, "raw")
    S.write_raw(records(spark, record("a", JAN), record("b", JAN, "old"), record("c", FEB), record(None, None, "p")), base)
    S.write_raw(records(spark, record("b", JAN, "new"), record("d", JAN), record(None, None, "p"), record(None, None, "q")), base)
    assert bag(S.read_raw(spark, base), "url", "title") == {
        ("a", "t"): 1, ("b", "new"): 1, ("c", "t"): 1, ("d", "t"): 1, (None, "p"): 1, (None, "q"): 1,
    }
    assert {r.url for r in S.read_raw(spark, base, 2024, 2).collect()} == {"c"}
    assert S.read_raw(spark, base).columns == BRONZE.fieldNames()


def test_untouched_months_stay(spark):
    base = scratch_path(spark, "raw")
    S.write_raw(records(spark, record("a", JAN), record("c", FEB)), base)
    before = {f for f in spark.read.parquet(base).inputFiles() if "month=2" in f}
    S.write_raw(records(spark, record("b", JAN)), base)
    assert before == {f for f in spark.read.parquet(base).inputFiles() if "month=2" in f}


def test_month_partitions_are_pruned(spark):
    base = scratch_path(spark, "raw")
    S.write_raw(records(spark, record("a", JAN), record("c", FEB)), base)
    plan = S.read_raw(spark, base, 2024, 1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_replace_stored_window_empties_months(spark):
    path = scratch_path(spark, "t")
    old = records(spark, record("a", JAN), record("b", FEB), record("z", datetime(2024, 3, 1)), record("n", None))
    S.save_table(old, path)
    new = records(spark, record("a", FEB, "moved"), record("late", datetime(2024, 5, 1)))
    for _ in range(2):
        S.replace_stored_window(new, path, START, END)
        assert bag(S.load_table(spark, path, RAW), "url", "title") == {("a", "moved"): 1, ("z", "t"): 1, ("n", "t"): 1}


def test_replace_part_of_a_month(spark):
    path = scratch_path(spark, "t")
    S.save_table(records(spark, record("a", datetime(2024, 1, 5)), record("b", datetime(2024, 1, 25))), path)
    S.replace_stored_window(records(spark, record("c", datetime(2024, 1, 6))), path, datetime(2024, 1, 1), datetime(2024, 1, 10))
    assert set(bag(S.load_table(spark, path, RAW), "url")) == {("b",), ("c",)}


def test_missing_table_is_empty(spark):
    found = S.load_table(spark, scratch_path(spark, "none"), SILVER)
    assert found.count() == 0 and found.columns == SILVER.fieldNames()


def test_apply_schema(spark):
    df = spark.createDataFrame([("u", "2024-01-01 00:00:00", 2024)], "url string, date_modified string, year bigint")
    found = S.apply_raw_schema(df)
    assert [(f.name, f.dataType) for f in found.schema] == [(f.name, f.dataType) for f in RAW]
    assert found.first().tags is None


def test_csv(spark):
    path = scratch_path(spark, "csv")
    df = spark.createDataFrame([('say "hi",\nthere', ["a", "b,c"])], "title string, tags array<string>")
    S.write_articles_csv(df, path)
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    assert [tuple(r) for r in back.collect()] == [('say "hi",\nthere', '["a","b,c"]')]


def test_size_checks(spark):
    df = spark.range(100).withColumn("x", F.lit("y" * 100))
    assert fits(df, 100) and not fits(df, 99) and not fits(df, 100, max_bytes=5000)
    assert broadcast_if_small(df, 99) is df


def test_stage_is_a_written_table(spark):
    df = stage(spark.range(5).withColumn("r", F.rand()))
    assert df.collect() == df.collect()
    assert df.inputFiles()[0].replace("file://", "").startswith(shared_dir(spark))


def test_spread_scan_leaves_large_scans_alone(spark):
    path = scratch_path(spark, "many")
    spark.range(100).repartition(16).write.parquet(path)
    spark.conf.set("spark.sql.files.openCostInBytes", str(128 << 20))
    try:
        scan = spark.read.parquet(path)
        assert S.spread_scan(scan) is scan
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert S.spread_scan(spark.read.parquet(path).limit(1)) is not None


@pytest.fixture
def raw(spark):
    base = scratch_path(spark, "raw")
    S.write_raw(records(spark, *[record(f"u{i}", JAN if i % 2 else FEB) for i in range(10)]), base)
    return base


def test_stream_restarts(spark, raw):
    bronze, mark = scratch_path(spark, "bronze"), scratch_path(spark, "mark")
    ingest_stream(spark, raw, bronze, mark, max_files_per_trigger=1).awaitTermination()
    assert S.load_table(spark, bronze, BRONZE).count() == 10
    # A new version of one article arrives in its own file.
    S.save_table(records(spark, record("u1", FEB, "new")), raw)
    ingest_stream(spark, raw, bronze, mark).awaitTermination()
    assert S.load_table(spark, bronze, BRONZE).count() == 11
    # Lost offsets make it read everything again, and nothing doubles.
    ingest_stream(spark, raw, bronze, mark + "-lost").awaitTermination()
    assert S.load_table(spark, bronze, BRONZE).count() == 11


def test_pipeline_twice(spark):
    layout = M.Layout.under(scratch_path(spark, "layers"))
    documents = spark.createDataFrame(
        [(i, f"Title {i}\nline one\n\nline two", "en", f"s{i % 3}", 10) for i in range(16)],
        "doc_id bigint, text string, lang string, source string, n_chars bigint",
    )
    posts = A.posts(documents)
    pages = A.post_pages(posts).join(posts.select(F.col("doc_id").alias("page_id"), "url"), "page_id")
    urls = posts.select("url", F.col("date_modified").alias("last_modified"))
    window = (datetime(2021, 1, 1), datetime(2028, 12, 31, 23, 59, 59))
    counts = []
    for _ in range(2):
        M.store_sitemap(urls, layout)
        wanted = S.load_table(spark, layout.sitemap, M.SITEMAP_URLS)
        M.load_raw(M.select_pages(pages, wanted, "https://blog.example.com/"), layout)
        M.load_bronze(spark, layout)
        M.load_silver(spark, layout, *window)
        M.load_gold(spark, layout, *window)
        M.load_gold_links(spark, layout, *window, probe=A.length_probe, parallelism=2)
        counts.append(
            [S.load_table(spark, p, s).count() for p, s in ((layout.bronze, BRONZE), (layout.silver, SILVER), (layout.gold, M.GOLD), (layout.gold_links, M.GOLD_LINKS))]
        )
    assert counts == [[16, 8, 8, 8]] * 2


def test_months_that_hold_most_rows_are_split(spark):
    """Nine of ten rows fall in one month: the writer gets several tasks for it."""
    path = scratch_path(spark, "skew")
    df = spark.range(40_000).select(
        F.col("id").cast("string").alias("url"),
        F.when(F.col("id") % 10 == 0, F.lit(str(FEB))).otherwise(F.lit(str(JAN))).cast("timestamp").alias("date_modified"),
        F.sha2(F.col("id").cast("string"), 512).alias("title"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200000")
    try:
        S.save_table(df, path)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = spark.read.parquet(path).inputFiles()
    assert len([f for f in files if "month=1/" in f]) > 1
    assert spark.read.parquet(path).count() == 40_000


def test_window_loads_read_the_folders_of_their_months(spark):
    rows = [(f"u{i}", datetime(2023, 1 + i % 12, 1 + i % 27)) for i in range(60)]
    schema = T.StructType([T.StructField("url", T.StringType()), T.StructField("date_modified", T.TimestampType())])
    path = scratch_path(spark, "months")
    S.save_table(spark.createDataFrame(rows, schema), path)
    start, end = datetime(2023, 3, 5), datetime(2023, 4, 30, 23, 59, 59)
    loaded = S.load_window(spark, path, schema, start, end)
    assert sorted(r.url for r in loaded.collect()) == sorted(u for u, d in rows if start <= d <= end)
    plan = loaded._jdf.queryExecution().executedPlan().toString()
    pruned = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "year" in pruned and "month" in pruned
    assert S.load_window(spark, path + "-none", schema, start, end).count() == 0


def test_only_rows_that_stay_are_written_twice(spark, tmp_path, monkeypatch):
    """The new rows of a window go straight to the table; a window that gets none is emptied."""
    path, start, end = str(tmp_path / "t"), datetime(2024, 1, 10), datetime(2024, 2, 29)
    held = [record("a", datetime(2024, 1, 5)), record("b", datetime(2024, 1, 15)), record("c", datetime(2024, 2, 3))]
    S.save_table(records(spark, *held), path)
    staged, plain = [], S.stage
    monkeypatch.setattr(S, "stage", lambda df, label: staged.append(df.count()) or plain(df, label))
    S.replace_stored_window(records(spark, record("n", datetime(2024, 1, 20))), path, start, end)
    assert staged == [1] and urls_in(spark, path) == ["a", "n"]
    # Rows read from the table itself are written first.
    S.replace_stored_window(spark.read.parquet(path).withColumn("url", F.concat("url", F.lit("2"))), path, start, end)
    assert urls_in(spark, path) == ["a", "n2"]
    S.replace_stored_window(records(spark, record("x", datetime(2025, 1, 1))), path, start, end)
    assert urls_in(spark, path) == ["a"]
    S.replace_stored_window(records(spark, record("x", datetime(2025, 1, 1))), path, datetime(2024, 1, 1), end)
    assert not list((tmp_path / "t").glob("year=*/month=*/*.parquet"))


def urls_in(spark, path):
    return sorted(r["url"] for r in spark.read.parquet(path).select("url").collect())
