"""Silver, gold, links and dashboard operators on small tables."""

import json
from datetime import date, datetime

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from broadsheet.functions import text as X
from broadsheet.operators import dashboard as D
from broadsheet.operators import links as L
from broadsheet.operators import silver as V
from broadsheet.schemas import BRONZE, DOCUMENT_LIMITS, GOLD, GOLD_LINKS, SILVER, SILVER_LINKS

FIRST, LAST = datetime(2023, 1, 1), datetime(2023, 12, 31, 23, 59, 59)


def article(url="https://b.example/c/p/", published=datetime(2023, 1, 1, 23), modified=datetime(2023, 1, 2, 1), **more):
    row = dict(url=url, title="t", date_published=published, date_modified=modified, author="ann", tags=["x"])
    row |= dict(content_links=[("home", "/")], content=["one two", "three"]) | more
    return tuple(row[f.name] for f in BRONZE)


def bronze(spark, *rows):
    return spark.createDataFrame(list(rows), BRONZE)


def test_derived_columns(spark):
    row = V.derive_articles(bronze(spark, article())).first()
    assert (row.domain, row.category, row.url_title) == ("https://b.example", "c", "p")
    assert row.days_between_published_modified == 1  # two hours, but across midnight
    assert (row.content_paragraphs, row.total_content_words, row.year, row.month) == (2, 3, 2023, 1)


def test_declared_schemas(spark):
    silver = V.derive_articles(bronze(spark, article()))
    links = V.explode_links(silver, FIRST, LAST)
    for df, schema in ((silver, SILVER), (L.as_gold(silver), GOLD), (links, SILVER_LINKS)):
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in schema]


def test_word_count_traps(spark):
    cases = [(None, 0), ([], 0), ([""], 1), ([" a b "], 4), (["a\x0bb"], 1), (["a\n\t b", "c"], 3), ([None, "a"], 1)]
    df = spark.createDataFrame([(c, n) for c, n in cases], "content array<string>, wanted bigint")
    assert df.filter(X.word_count(F.col("content")) != F.col("wanted")).collect() == []
    counts = df.select(X.paragraph_count(F.col("content")).alias("n")).collect()
    assert [r.n for r in counts][:3] == [None, 0, 1]


def test_row_id_is_stable_and_distinct(spark):
    df = spark.createDataFrame([("a", "b"), ("ab", ""), ("a", None), (None, "a")], "x string, y string")
    ids = [r[0] for r in df.select(X.row_id(F.col("x"), F.col("y"))).collect()]
    assert len(set(ids)) == 4
    assert ids == [r[0] for r in df.select(X.row_id(F.col("x"), F.col("y"))).collect()]


def test_silver_keeps_versions_of_other_windows(spark):
    old = article(modified=datetime(2022, 5, 1))
    newer, newest = article(modified=datetime(2023, 3, 1)), article(modified=datetime(2023, 4, 1))
    stored = V.derive_articles(bronze(spark, old, newer))
    built = V.build_silver_articles(bronze(spark, old, newer, newest), stored, FIRST, LAST)
    assert sorted(r.date_modified for r in built.collect()) == [datetime(2022, 5, 1), datetime(2023, 4, 1)]


def test_explode_links(spark):
    rows = [article(content_links=[("a", "/a"), ("a", "/a"), (None, None)]), article("u2", content_links=[]), article("u3", content_links=None)]
    links = V.explode_links(V.derive_articles(bronze(spark, *rows)), FIRST, LAST).collect()
    assert [(r.alias, r.link) for r in links] == [("a", "/a"), ("a", "/a"), (None, None)]
    assert len({r.row_id for r in links}) == 3


def test_publish_gold_inserts_only_the_window(spark):
    silver = V.derive_articles(bronze(spark, article(modified=datetime(2022, 5, 1)), article()))
    gold = L.publish_gold(silver, L.as_gold(silver), FIRST, LAST)
    assert gold.count() == 2
    assert L.publish_gold(silver, gold, FIRST, LAST).count() == 2


def test_links_as_json(spark):
    df = bronze(spark, article(content_links=[("a", "/a"), (None, "/b")]), article(content_links=None))
    found = [r[0] for r in df.select(L.links_as_json(F.col("content_links"))).collect()]
    assert json.loads(found[0]) == [{"text": "a", "link": "/a"}, {"text": None, "link": "/b"}]
    assert found[1] is None


def test_check_limits(spark):
    df = spark.createDataFrame([("1", "é" * 5, [1.0]), ("2", "abc", [1.0, 2.0]), ("3", None, None)], "row_id string, title string, v array<float>")
    found = L.check_limits(df, {"title": 4}, vector_col="v", dimension=2)
    assert sorted(map(tuple, found.collect())) == [("1", "title", 5, 4), ("1", "v", 1, 2)]


def test_check_limits_of_documents(spark):
    rows = [("i" * 129, "c", {"url": "u"}), ("1", "c" * 65536, {"url": "u" * 65530})]
    df = spark.createDataFrame(rows, "id string, content string, metadata struct<url:string>")
    found = L.check_limits(df, DOCUMENT_LIMITS, id_col="id").collect()
    assert {(r.id[:1], r.column) for r in found} == {("i", "id"), ("1", "content"), ("1", "metadata")}


CASES = [
    ("https://e.example/a", "external", "https://e.example/a"),
    ("https://e.example/a) x", "external", "https://e.example/a"),
    ("https://", "internal", "https:///"),
    ("(https://e.example/b)", "internal", "https://b.example/c/(https:/e.example/b)"),
    ("/about", "internal", "https://b.example/about"),
    ("#top", "internal_working", None),
    ("mailto:me@e.example", "mail_link", None),
    ("mailto:", None, None),
    ("see-mail", None, None),
    ("", "internal", "https://b.example/c/p"),
    (None, "parse_error", None),
    ("//[http", "parse_error", None),
]


def test_classify_link(spark):
    df = spark.createDataFrame([("https://b.example/c/p", link) for link, _, _ in CASES], "url string, link string")
    found = L.classify_link(df.coalesce(1)).collect()
    got = [(r.link, r.kind, r.target) for r in found]
    assert [g for g in got if g[0] != "https://"] == [c for c in CASES if c[0] != "https://"]
    assert [r.same_site for r in found if r.link == "/about"] == [True]


def test_link_status(spark):
    outcome = {"/ok": "ok", "/err": "error", "/slow": "timeout"}
    links = [("https://b.example/x/", link) for link in ["/ok", "/err", "/slow", "", "https://e.example/ok", "#a", "mailto:a@b", None]]
    df = spark.createDataFrame(links, "url string, link string").withColumns(
        {"row_id": F.lit("r"), "date_modified": F.lit(str(FIRST)).cast("timestamp")}
    )

    def probe(targets):
        return pd.Series([next((o for s, o in outcome.items() if t.endswith(s)), "error") for t in targets])

    audited = L.audit_links(df, FIRST, LAST, probe, parallelism=2)
    assert audited.columns == GOLD_LINKS.fieldNames()
    got = {r.link: r.link_status for r in audited.collect()}
    assert got == {
        "/ok": "internal_working",
        "/err": "internal_broken",
        "/slow": "timeout 30 sec",
        "": "external_broken",
        "https://e.example/ok": "external_working",
        "#a": "internal_working",
        "mailto:a@b": "mail_link",
        None: "parse_error",
    }


def test_each_target_is_probed_once(spark):
    """A third of the links share one target."""
    links = [("https://b.example/", "/hot")] * 500 + [("https://b.example/", f"/p{i}") for i in range(1000)]
    df = spark.createDataFrame(links, "url string, link string").repartition(6)
    classified = L.classify_link(df)
    outcomes = L.probe_targets(classified, lambda t: pd.Series(["ok"] * len(t)), parallelism=3)
    assert outcomes.count() == 1001
    assert L.link_status(classified, outcomes).filter("link_status = 'internal_working'").count() == 1500


# --- dashboard ---


def gold(spark, *rows):
    return L.as_gold(V.derive_articles(bronze(spark, *rows)))


def test_overview(spark):
    empty_author = [article(f"n{i}", author=None, tags=None) for i in range(3)]
    df = gold(spark, *empty_author, article(tags=["b", "a"]), article("u2", tags=["b"], published=datetime(2022, 1, 1)))
    assert D.top_author(df).first().author == "N/A"
    assert tuple(D.top_tag(df).first()) == ("b", 2)
    assert D.recent_articles_count(df, date(2023, 3, 9)).first().n_recent == 4
    assert tuple(D.overview_metrics(df, date(2023, 3, 9)).first()) == (5, 4, "N/A", "b")
    assert [r.author for r in D.authors(df).collect()] == ["ann", None]
    assert [r.tag for r in D.tags(df).collect()] == ["a", "b"]
    assert D.tags(df, distinct=False).count() == 3


def test_recent_count_starts_180_days_before_the_month(spark):
    edge = datetime(2023, 3, 1) - pd.Timedelta(days=180).to_pytimedelta()
    df = gold(spark, article(published=edge), article("b", published=edge - pd.Timedelta(seconds=1).to_pytimedelta()))
    assert D.recent_articles_count(df, date(2023, 3, 31)).first().n_recent == 1


def test_trend_with_gaps(spark):
    stamps = [datetime(2023, 11, 30, 23, 59, 59), datetime(2024, 2, 1), datetime(2024, 2, 29, 23, 59, 59), datetime(2024, 3, 1)]
    df = gold(spark, *[article(f"u{i}", published=s) for i, s in enumerate(stamps)])
    filled = D.fill_month_gaps(D.monthly_trend(df, date(2023, 11, 30), date(2024, 2, 29)))
    assert [tuple(r) for r in filled.collect()] == [
        (2023, 11, "2023-11", 1),
        (2023, 12, "2023-12", None),
        (2024, 1, "2024-01", None),
        (2024, 2, "2024-02", 2),
    ]
    assert D.fill_month_gaps(D.monthly_trend(df, date(2030, 1, 1), date(2030, 2, 1))).count() == 0


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sets(st.integers(0, 80), min_size=1))
def test_filled_trend_is_continuous(spark, months):
    rows = [(2021 + m // 12, m % 12 + 1, m) for m in months]
    trend = spark.createDataFrame(rows, "year bigint, month bigint, n_articles bigint")
    got = [(r.year * 12 + r.month, r.n_articles) for r in D.fill_month_gaps(trend).collect()]
    first = 2021 * 12 + 1
    assert [g[0] - first for g in got] == list(range(min(months), max(months) + 1))
    assert {g[1] for g in got if g[1] is not None} == months


def test_filter_articles(spark):
    df = gold(
        spark,
        article("1", title="both", author="ann", tags=["x", "y"], published=datetime(2023, 1, 1)),
        article("2", title="author", author="ann", tags=["z"], published=datetime(2023, 1, 2)),
        article("3", title="tags", author="bob", tags=["y", None, "x"], published=datetime(2023, 1, 3)),
        article("4", title="none", author="it's", tags=None, published=None),
        article("5", title="nulls", author=None, tags=["x", None], published=datetime(2023, 1, 4)),
    )

    def titles(*args, **kw):
        return [r.title for r in D.filter_articles(df, *args, **kw).collect()]

    assert titles(["ann"], ["x", "y"], "and") == ["both"]
    assert titles(["ann"], ["x", "y"], "or") == ["tags", "author", "both"]
    assert titles(["ann"], None, "or") == ["author", "both"]
    assert titles(None, ["x", "y"], "or") == ["tags", "both"]
    assert titles(["All", "ann"], ["z"], "or") == ["author"]
    assert titles(["it's"]) == ["none"]
    assert titles() == ["none", "nulls", "tags", "author", "both"]  # unknown dates first
    assert titles(n=2) == ["none", "nulls"]
    with pytest.raises(ValueError):
        titles(how="xor")


def test_filter_articles_takes_ordered_rows(spark):
    plan = D.filter_articles(gold(spark, article()))._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_url_months(spark):
    stamps = [datetime(2023, 12, 1), datetime(2023, 12, 31, 23, 59, 59, 999999), datetime(2024, 1, 1), None]
    df = spark.createDataFrame([(str(i), s) for i, s in enumerate(stamps)], "url string, last_modified timestamp")
    assert [r.url for r in D.urls_for_month(df, 2023, 12).collect()] == ["0", "1"]
    assert [tuple(r) for r in D.modified_distribution(df).collect()][0] == (2023, 12, 2)
