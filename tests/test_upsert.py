from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from broadsheet.functions.windows import filter_window, month_window, months_in
from broadsheet.operators import upsert as P

SCHEMA = "url string, date_modified timestamp, title string"
T0 = datetime(2024, 1, 1)


def at(n):
    return None if n is None else T0 + timedelta(hours=n)


def table(spark, rows):
    return spark.createDataFrame([(u, at(n), t) for u, n, t in rows], SCHEMA)


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def literal_rule(main, incoming):
    """The "unseen or differing" rule by brute force, as a bag of incoming rows."""
    out = Counter()
    for url, version, title in incoming:
        matches = [v for u, v, _ in main if u is not None and u == url]
        if not matches:
            out[(url, at(version), title)] += 1
        for v in matches:
            if v is not None and version is not None and v != version:
                out[(url, at(version), title)] += 1
    return out


MAIN = [("a", 1, "a1"), ("a", 2, "a2"), ("b", 1, "b1"), ("c", None, "c")]
INCOMING = [("a", 1, "a1"), ("a", 2, "a2"), ("a", 3, "a3"), ("b", None, "bn"), ("c", 5, "c5"), ("d", 1, "d1"), (None, 1, "x")]


def test_reference_mode_repeats_what_the_literal_rule_repeats(spark):
    got = bag(P.rows_to_append(table(spark, MAIN), table(spark, INCOMING), mode="reference"))
    assert got == literal_rule(MAIN, INCOMING)
    assert got[("a", at(3), "a3")] == 2 and got[("a", at(1), "a1")] == 1


rows = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c", None]), st.sampled_from([1, 2, 3, None]), st.just("t")), max_size=8
)
relaxed = settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@relaxed
@given(rows, rows)
def test_reference_mode_by_brute_force(spark, main, incoming):
    got = bag(P.rows_to_append(table(spark, main), table(spark, incoming), mode="reference"))
    assert got == literal_rule(main, incoming)


@relaxed
@given(rows, rows)
def test_upsert_is_idempotent(spark, main, incoming):
    once = P.upsert_versions(table(spark, main), table(spark, incoming))
    twice = P.upsert_versions(once, table(spark, incoming))
    assert bag(once) == bag(twice)
    stored = set(bag(table(spark, main)))
    keys = {(u, at(v)) for u, v, _ in incoming}
    assert {(u, v) for u, v, _ in bag(once)} == keys | {(u, v) for u, v, _ in stored}


def test_rows_without_url_are_told_apart_by_content(spark):
    incoming = table(spark, [(None, None, "one"), (None, None, "two"), (None, None, "two")])
    once = P.upsert_versions(table(spark, []), incoming)
    assert bag(once) == {(None, None, "one"): 1, (None, None, "two"): 1}
    assert bag(P.upsert_versions(once, incoming)) == bag(once)


def test_empty_batch_changes_nothing(spark):
    urls = spark.createDataFrame([("a", T0)], "url string, last_modified timestamp")
    for mode in ("idempotent", "reference"):
        assert bag(P.upsert_sitemap_urls(urls, urls.limit(0), mode)) == bag(urls)
    with pytest.raises(ValueError):
        P.rows_to_append(urls, urls, mode="other")


def test_replace_window_bounds_are_inclusive(spark):
    main = table(spark, [("a", 0, "in"), ("b", 5, "in"), ("c", 6, "out"), ("d", None, "null")])
    new = table(spark, [("n", 3, "new")])
    assert {r.url for r in P.replace_window(main, new, at(0), at(5)).collect()} == {"c", "d", "n"}


def test_latest_version(spark):
    df = table(spark, [("a", 1, "x"), ("a", 3, "y"), ("a", None, "z"), ("b", 2, "p"), ("b", 2, "q")])
    first = P.latest_version(df).collect()
    assert {(r.url, r.date_modified) for r in first} == {("a", at(3)), ("b", at(2))}
    # Ties are settled the same way whatever the partitioning.
    again = P.latest_version(df.repartition(7)).collect()
    assert {tuple(r) for r in again} == {tuple(r) for r in first}


def test_latest_is_limited_before_the_shuffle(spark):
    plan = P.latest_version(table(spark, MAIN))._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan and "row_number(), 1, Final" in plan


def test_window_decides_which_rows_compete(spark):
    df = table(spark, [("a", 1, "in"), ("a", 9, "out")])
    assert [r.title for r in P.latest_in_window(df, at(0), at(5)).collect()] == ["in"]


@relaxed
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from([1, 2, 30, 31, 100, None])), max_size=12))
def test_version_counts_by_brute_force(spark, drawn):
    drawn = [(u, v, str(i)) for i, (u, v) in enumerate(drawn)]
    got = bag(P.version_counts(table(spark, drawn)))
    wanted = Counter()
    for u, v, t in drawn:
        mine = [w for x, w, _ in drawn if x == u]
        if len(mine) > 1:
            newer = sum(1 for w in mine if w is not None and (v is None or w > v))
            wanted[(u, at(v), t, len(mine), 1 + newer)] += 1
    assert got == wanted


def test_hot_url(spark):
    """A third of all rows share one url, with many versions and many equal rows."""
    hot = [("hot", i % 500, "h") for i in range(3000)]
    cold = [(f"u{i}", i, "c") for i in range(6000)]
    df = table(spark, hot + cold).repartition(8)
    latest = {r.url: r.date_modified for r in P.latest_version(df).collect()}
    assert latest["hot"] == at(499) and len(latest) == 6001
    counted = P.version_counts(df).collect()
    assert len(counted) == 3000
    assert {r.recency for r in counted if r.date_modified == at(499)} == {1}
    assert {r.recency for r in counted if r.date_modified == at(0)} == {1 + 499 * 6}
    stored = P.upsert_versions(table(spark, hot[:100]), df)
    assert bag(stored)[("hot", at(7), "h")] == 1 and stored.count() == 6500


def test_one_day_of_stamps_of_one_url(spark):
    """Many versions on one day, some within the same second: ranked without a group of the day."""
    df = spark.range(3000).select(
        F.lit("hot").alias("url"),
        F.timestamp_micros(F.lit(1_700_000_000_000_000) + F.col("id") * 250_000).alias("date_modified"),
        F.col("id").cast("string").alias("title"),
    )
    counted = P.version_counts(df)
    assert counted.filter("n_versions = 3000 AND recency = 3000 - int(title)").count() == 3000
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") == 3


def test_month_window():
    today = date(2025, 3, 10)
    assert month_window(2023, 12, 2024, 12, today) == (datetime(2023, 12, 1), datetime(2024, 12, 31, 23, 59, 59))
    assert month_window(2024, 2, 2024, 2, today).end == datetime(2024, 2, 29, 23, 59, 59)
    assert month_window(2025, 1, today=today).end == datetime(2025, 3, 31, 23, 59, 59)
    for bad in [(2020, 1, 2024, 1), (2024, 0, 2024, 1), (2024, 1, 2024, 13), (2024, 5, 2024, 4), (2024, 1, 2025, 4), (2024, 1, 2026, 1)]:
        with pytest.raises(ValueError):
            month_window(*bad, today=today)
    assert months_in(datetime(2023, 11, 5), datetime(2024, 2, 1)) == [(2023, 11), (2023, 12), (2024, 1), (2024, 2)]


def test_window_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    table(spark, MAIN).write.parquet(path)
    plan = filter_window(spark.read.parquet(path), "date_modified", at(0), at(5))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqu" in text and "LessThanOrEqu" in text
