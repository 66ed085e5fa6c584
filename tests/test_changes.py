"""Layers that follow changes, and loads driven by the months of the sitemap."""

import random
from datetime import datetime, timedelta
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F

from broadsheet.functions.windows import months_in
from broadsheet.plans import backfill, changes
from broadsheet.plans import medallion as M
from broadsheet.schemas import BRONZE, GOLD, GOLD_LINKS, PROGRESS, SILVER, SILVER_LINKS
from broadsheet.session import scratch_path
from broadsheet.sources import posts as A
from broadsheet.sources import tables as S

WINDOW = datetime(2024, 1, 1), datetime(2024, 3, 31, 23, 59, 59)
TABLES = (("silver", SILVER), ("silver_links", SILVER_LINKS), ("gold", GOLD), ("gold_links", GOLD_LINKS))


def version(url, modified, links=(("a", "/a"),)):
    row = dict(url=url, title=f"t{modified}", date_published=modified, date_modified=modified, author="x",
               tags=["y"], content_links=list(links), content=["two words"])
    return tuple(row[f.name] for f in BRONZE)


def batch(spark, rows):
    return spark.createDataFrame(rows, BRONZE)


def load(spark, rows, layout, run, probe=A.length_probe):
    return changes.load_changes(batch(spark, rows), layout, run, probe, 2)


def content(spark, layout):
    return {
        name: sorted(map(repr, S.load_table(spark, getattr(layout, name), schema).collect()))
        for name, schema in TABLES
    }


def by_windows(spark, rows):
    """The same tables by the window loads, every month a window."""
    layout = M.Layout.under(scratch_path(spark, "plain"))
    S.save_table(batch(spark, rows), layout.bronze)
    for year, month in months_in(*WINDOW):
        window = datetime(year, month, 1), datetime(year, month + 1, 1) - timedelta(seconds=1)
        M.load_silver(spark, layout, *window)
        M.load_gold(spark, layout, *window)
        M.load_gold_links(spark, layout, *window, probe=A.length_probe, parallelism=2)
    return content(spark, layout)


def test_two_runs_give_what_the_window_loads_give(spark):
    draw = random.Random(5)
    rows = [
        version(
            draw.choice(["u1", "u2", "https://h.org/u3", None]),
            datetime(2024, draw.randint(1, 3), draw.randint(1, 28), draw.randint(0, 23)),
            [("n", f"/{draw.randint(0, 9)}")] * draw.randint(0, 2),
        )
        for _ in range(24)
    ]
    unique = list({(r[0], r[3]): r for r in rows}.values())
    layout = M.Layout.under(scratch_path(spark, "layers"))
    load(spark, unique[:10], layout, "a")
    load(spark, unique[8:] + [version("u1", None)], layout, "b")
    assert content(spark, layout) == by_windows(spark, unique)
    assert S.load_table(spark, layout.bronze, BRONZE).count() == len(unique) + 1


def files(path):
    return {p: p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}


def test_other_months_and_other_links_are_left_alone(spark):
    layout = M.Layout.under(scratch_path(spark, "layers"))
    days = [datetime(2024, m, 3) for m in (1, 2, 3)]
    load(spark, [version(u, d, [("n", f"/{u}")]) for u in ("u1", "u2") for d in days], layout, "a")
    before = {name: files(getattr(layout, name)) for name, _ in TABLES}
    fail = lambda targets: pd.Series(["error"] * len(targets))
    keys = load(spark, [version("u1", datetime(2024, 2, 9), [("n", "/u1")])], layout, "b", fail)
    assert [tuple(r) for r in keys.collect()] == [("u1", 2024, 2)]
    for name, _ in TABLES:
        after = files(getattr(layout, name))
        same = {p for p in before[name] if after.get(p) == before[name][p]}
        assert same == {p for p in before[name] if "month=2" not in str(p)}, name
    broken = S.load_table(spark, layout.gold_links, GOLD_LINKS).filter(F.col("link_status").endswith("broken"))
    assert [(r.url, r.date_modified) for r in broken.collect()] == [("u1", datetime(2024, 2, 9))]


def test_nothing_new_and_nothing_at_all(spark):
    layout = M.Layout.under(scratch_path(spark, "layers"))
    assert load(spark, [], layout, "none").count() == 0
    rows = [version("u1", datetime(2024, 1, 3))]
    load(spark, rows, layout, "a")
    before = files(layout.gold)
    assert load(spark, rows, layout, "b").count() == 0
    assert files(layout.gold) == before


def test_an_ended_run_is_repeated_under_its_name(spark, monkeypatch):
    layout = M.Layout.under(scratch_path(spark, "layers"))
    rows = [version("u1", datetime(2024, 1, 3)), version("u2", datetime(2024, 2, 3))]
    with monkeypatch.context() as patched:
        patched.setattr(changes, "newest_per_month", lambda df: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            load(spark, rows, layout, "a")
    assert S.load_table(spark, layout.bronze, BRONZE).count() == 2
    assert load(spark, rows, layout, "a").count() == 2
    assert content(spark, layout) == by_windows(spark, rows)


def test_last_link_of_a_month_taken_away(spark):
    layout = M.Layout.under(scratch_path(spark, "layers"))
    load(spark, [version("u1", datetime(2024, 1, 3))], layout, "a")
    load(spark, [version("u1", datetime(2024, 1, 4), [])], layout, "b")
    assert S.load_table(spark, layout.silver, SILVER).count() == 1
    assert S.load_table(spark, layout.gold_links, GOLD_LINKS).count() == 0


def test_stream_through_all_layers(spark):
    layout, mark = M.Layout.under(scratch_path(spark, "layers")), scratch_path(spark, "mark")
    rows = [version(f"u{i}", datetime(2024, 1 + i % 2, 3)) for i in range(6)]
    S.save_table(batch(spark, rows), layout.raw)
    changes.follow_raw(spark, layout, mark, A.length_probe, 9, 2).awaitTermination()
    rows.append(version("u1", datetime(2024, 2, 9)))
    S.save_table(batch(spark, rows[-1:]), layout.raw)
    changes.follow_raw(spark, layout, mark, A.length_probe, 9, 2).awaitTermination()
    # With a checkpoint begun anew the names of batches come again.
    changes.follow_raw(spark, layout, mark + "-lost", A.length_probe, 9, 2).awaitTermination()
    assert content(spark, layout) == by_windows(spark, rows)


@pytest.fixture
def site(spark):
    documents = spark.createDataFrame(
        [(i, f"Title {i}\nline", "en", "s", 10) for i in range(40)],
        "doc_id bigint, text string, lang string, source string, n_chars bigint",
    )
    posts = A.posts(documents)
    ids = posts.select(F.col("doc_id").alias("page_id"), "url")
    layout = M.Layout.under(scratch_path(spark, "site"))
    M.store_sitemap(posts.select("url", F.col("date_modified").alias("last_modified")), layout)
    return posts, A.post_pages(posts).join(ids, "page_id").cache(), layout


ALL = datetime(2021, 1, 1), datetime(2028, 12, 31, 23, 59, 59)
LISTING = "https://blog.example.com/"


def loaded(spark, layout):
    return {r.url for r in S.read_raw(spark, layout.raw).collect()}


def test_backfill_goes_on_where_it_ended(spark, site, monkeypatch):
    posts, pages, layout = site
    months = {(r.y, r.m) for r in posts.select(F.year("date_modified").alias("y"), F.month("date_modified").alias("m")).collect()}
    plain, calls = backfill.load_raw, []

    def twice(found, to):
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("lost")
        plain(found, to)

    with monkeypatch.context() as patched:
        patched.setattr(backfill, "load_raw", twice)
        with pytest.raises(RuntimeError, match="lost"):
            backfill.load_open_months(spark, pages, layout, *ALL, LISTING, 4)
    rest = backfill.load_open_months(spark, pages, layout, *ALL, LISTING, 40)
    assert rest == sorted(months)[8:]
    assert loaded(spark, layout) == {r.url for r in posts.collect()}
    assert backfill.load_open_months(spark, pages, layout, *ALL, LISTING) == []


def test_backfill_asks_again_for_changed_months_and_missing_pages(spark, site):
    posts, pages, layout = site
    gone = pages.filter("page_id <> 7 AND page_id <> 6")
    backfill.load_open_months(spark, gone, layout, *ALL, LISTING, 100)
    row = posts.filter("doc_id = 7").first()
    place = (row.date_modified.year, row.date_modified.month)
    noted = S.load_table(spark, layout.progress, PROGRESS).filter("n_found < n_urls").collect()
    assert [(r.year, r.month) for r in noted] == [place]
    assert backfill.load_open_months(spark, pages, layout, *ALL, LISTING) == [place]
    assert row.url in loaded(spark, layout)
    fresh = spark.createDataFrame([(row.url, datetime(2028, 12, 30))], M.SITEMAP_URLS)
    M.store_sitemap(fresh, layout)
    assert backfill.load_open_months(spark, pages, layout, *ALL, LISTING) == [(2028, 12)]


def test_backfill_of_empty_tables(spark):
    layout = M.Layout.under(scratch_path(spark, "site"))
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert backfill.load_open_months(spark, pages, layout, *ALL, LISTING) == []
    with pytest.raises(ValueError):
        backfill.load_open_months(spark, pages, layout, *ALL, LISTING, 0)


def test_listing_and_images_are_not_asked_for(spark, site):
    posts, pages, layout = site
    listing = posts.filter("doc_id = 7").first().url
    M.store_sitemap(spark.createDataFrame([("https://x.org/a.png", ALL[0])], M.SITEMAP_URLS), layout)
    backfill.load_open_months(spark, pages, layout, *ALL, listing, 100)
    assert loaded(spark, layout) == {r.url for r in posts.collect()} - {listing}
