"""

Every query reads the given tables whole. Arrays and structs are written as text and stamps
as ``yyyy-MM-dd HH:mm:ss`` at the edge, so that both engines give comparable values.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from hashlib import md5

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.functions import text as X
from broadsheet.functions import urls as U
from broadsheet.functions.windows import filter_window, month_window
from broadsheet.operators import chunks as C
from broadsheet.operators import dashboard as D
from broadsheet.operators import extract as B
from broadsheet.operators import lexical as G
from broadsheet.operators import links as L
from broadsheet.operators import search as R
from broadsheet.operators import silver as V
from broadsheet.operators import upsert as P
from broadsheet.plans import backfill, changes
from broadsheet.plans import medallion as M
from broadsheet.plans import retrieval
from broadsheet.schemas import BRONZE, GOLD, GOLD_LINKS, PROGRESS, RAW, SILVER, SILVER_LINKS, SITEMAP_URLS
from broadsheet.session import prepare, scratch_path, stage
from broadsheet.sources import posts as A
from broadsheet.sources import tables as S
from broadsheet.streaming.ingest import ingest_stream

try:  # the package for training data can be left out together with its pipeline, or lack what it needs
    import broadsheet.llm.queries as _llm
except ImportError:
    _llm = None

TODAY = date(2028, 12, 31)
ALL_MONTHS = month_window(2021, 1, 2028, 12, TODAY)
SOME_MONTHS = month_window(2022, 3, 2026, 12, TODAY)
CUTOFF = datetime(2024, 1, 1)
VECTOR_SIZE = 64


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    scan = prepare(spark).read.parquet(f"{sf}/{name}.parquet")
    return S.spread_scan(scan) if name in ("documents", "pages") else scan


def _posts(spark, sf) -> DataFrame:
    return A.posts(_table(spark, sf, "documents"))


def _bronze(spark, sf) -> DataFrame:
    return A.bronze_posts(_table(spark, sf, "documents"))


def _silver(spark, sf, window=ALL_MONTHS) -> DataFrame:
    return V.new_silver_articles(_bronze(spark, sf), *window)


def _gold(spark, sf) -> DataFrame:
    return L.as_gold(_silver(spark, sf))


def _page_table(spark, sf) -> DataFrame:
    return S.read_pages(prepare(spark), f"{sf}/pages.parquet")


def _long(c: Column | str, name: str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("bigint").alias(name)


def _stamp(name: str) -> Column:
    return X.as_utc_text(F.col(name)).alias(name)


def _list(name: str, sep: str = "|") -> Column:
    return F.array_join(name, sep).alias(name)


def _digest(name: str) -> Column:
    """Paragraphs as one hash: compares whole texts in a short value."""
    return F.md5(F.array_join(name, "\n")).alias(name)


def _links(name: str = "content_links") -> Column:
    return F.array_join(
        F.transform(name, lambda a: F.concat(a["text"], F.lit("="), a["link"])), "|"
    ).alias(name)


def _articles_text(df: DataFrame) -> DataFrame:
    """The bronze columns as plain values."""
    return df.select(
        "url",
        "title",
        _stamp("date_published"),
        _stamp("date_modified"),
        "author",
        _list("tags"),
        _links(),
        _digest("content"),
    )


def _silver_text(df: DataFrame) -> DataFrame:
    return df.select(
        "row_id",
        "url",
        "domain",
        "category",
        "url_title",
        _stamp("date_published"),
        _stamp("date_modified"),
        _long("days_between_published_modified", "days_between"),
        "title",
        "author",
        _list("tags"),
        _digest("content"),
        "content_paragraphs",
        "total_content_words",
        _long("year", "year"),
        _long("month", "month"),
    )


# --- queries ---------------------------------------------------------------------------------


def q_read_pages(spark, sf):
    pages = _page_table(spark, sf)
    return pages.select("page_id", "url", _long(F.char_length("html"), "n_chars"))


def q_raw_dataset(spark, sf):
    """Write twice, the second time over the first, and read back: nothing doubles."""
    records = S.with_months(_bronze(spark, sf))
    base = scratch_path(spark, "raw")
    S.write_raw(records.filter(F.col("date_modified") < F.lit(str(CUTOFF)).cast("timestamp")), base)
    S.write_raw(records, base)
    return _articles_text(S.read_raw(spark, base))


def q_raw_year(spark, sf):
    """One year of the raw dataset, by partition."""
    base = scratch_path(spark, "raw")
    S.write_raw(S.with_months(_bronze(spark, sf)), base)
    return S.read_raw(spark, base, year=2024).select("url", _stamp("date_modified"))


def q_stored_table(spark, sf):
    path = scratch_path(spark, "silver")
    S.save_table(_silver(spark, sf), path)
    return _silver_text(S.load_table(spark, path, SILVER))


def q_articles_csv(spark, sf):
    path = scratch_path(spark, "csv")
    chosen = D.filter_articles(_gold(spark, sf), ["src1", "src3"], None, "and", None)
    S.write_articles_csv(chosen, path)
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    schema = "title string, author string, tags string, date_published timestamp, date_modified timestamp"
    return back.schema(schema).csv(path).select(
        "title", "author", "tags", _stamp("date_published"), _stamp("date_modified")
    )


def q_first_load(spark, sf):
    """Upsert into a table that does not exist yet."""
    empty = S.load_table(spark, scratch_path(spark, "none"), BRONZE)
    return _articles_text(P.upsert_versions(empty, _bronze(spark, sf)))


def q_extract_articles(spark, sf):
    pages = A.post_pages(_posts(spark, sf))
    found = B.extract_articles(pages)
    return found.select(
        "url",
        "title",
        _stamp("date_published"),
        _stamp("date_modified"),
        "author",
        _list("tags"),
        _links(),
        _digest("content"),
        _long("year", "year"),
        _long("month", "month"),
    )


def q_jsonld_metadata(spark, sf):
    pages = A.post_pages(_posts(spark, sf))
    return B.jsonld_metadata(pages).select(
        "page_id", "url", "title", "date_published", "date_modified", "author"
    )


def q_extract_tags(spark, sf):
    found = B.extract_tags(A.post_pages(_posts(spark, sf)))
    return found.select("page_id", _list("tags"))


def q_extract_links(spark, sf):
    """Anchors of whole pages, read as HTML elements."""
    found = B.extract_links(_page_table(spark, sf), body_class=None)
    return found.select("page_id", _links("content_links"))


def q_extract_flat_links(spark, sf):
    return B.extract_flat_links(_page_table(spark, sf)).select("page_id", _links("content_links"))


def q_extract_paragraphs(spark, sf):
    found = B.extract_paragraphs(A.post_pages(_posts(spark, sf)), mode="leaf")
    return found.select("page_id", _digest("content"))


def q_parse_iso_timestamps(spark, sf):
    texts = _posts(spark, sf).select(
        "doc_id",
        F.concat(F.date_format("date_published", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00")).alias(
            "date_published"
        ),
        F.concat(F.date_format("date_modified", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-05:00")).alias(
            "date_modified"
        ),
    )
    return B.parse_iso_timestamps(texts).select(
        "doc_id",
        _stamp("date_published"),
        _stamp("date_modified"),
        _long("year", "year"),
        _long("month", "month"),
    )


def q_sitemap_locs(spark, sf):
    return B.sitemap_locs(A.sitemap_documents(_page_table(spark, sf), "page_id"))


def q_sitemap_table_rows(spark, sf):
    rows = B.sitemap_table_rows(A.sitemap_tables(_posts(spark, sf)))
    return rows.select("url", _stamp("last_modified"))


def q_sitemap_stamps(spark, sf):
    """Stamps in the forms of several sites, with the form each was read by."""
    tables = A.sitemap_tables(_posts(spark, sf), A.mixed_stamps())
    return B.sitemap_stamps(tables).select("url", _stamp("last_modified"), "form")


def q_rejected_stamps(spark, sf):
    return B.rejected_stamps(A.sitemap_tables(_posts(spark, sf), A.mixed_stamps()))


def q_exclude_urls(spark, sf):
    """Pages and their image links, without the images and the first listing page."""
    pages = _page_table(spark, sf)
    images = pages.select(F.concat("url", F.lit("/cover.png")).alias("url"))
    return B.exclude_urls(pages.select("url").unionByName(images), "https://thther.example.org/en/685")


def _sitemap(spark, sf) -> DataFrame:
    return _bronze(spark, sf).select("url", F.col("date_modified").alias("last_modified"))


def _before_cutoff(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column) < F.lit(str(CUTOFF)).cast("timestamp"))


def q_upsert_sitemap_urls(spark, sf):
    urls = _sitemap(spark, sf)
    known = _before_cutoff(urls, "last_modified")
    return P.upsert_sitemap_urls(known, urls).select("url", _stamp("last_modified"))


def q_upsert_versions(spark, sf):
    rows = _bronze(spark, sf)
    return _articles_text(P.upsert_versions(_before_cutoff(rows, "date_modified"), rows))


def q_version_copies(spark, sf):
    """What the literal "unseen or differing" rule appends, with the number of copies."""
    rows = _bronze(spark, sf).select("url", "date_modified")
    copies = P.version_copies(_before_cutoff(rows, "date_modified"), rows)
    return copies.select("url", _stamp("date_modified"), "copies")


def q_upsert_versions_reference(spark, sf):
    rows = _bronze(spark, sf).select("url", "title", "date_modified")
    added = P.rows_to_append(_before_cutoff(rows, "date_modified"), rows, mode="reference")
    return added.select("url", "title", _stamp("date_modified"))


def q_replace_window(spark, sf):
    """The window refilled with the latest versions only."""
    rows = _bronze(spark, sf)
    new = P.latest_in_window(rows, *SOME_MONTHS)
    return _articles_text(P.replace_window(rows, new, *SOME_MONTHS))


def q_latest_version(spark, sf):
    return _articles_text(P.latest_version(_bronze(spark, sf)))


def q_latest_order(spark, sf):
    """The last order of every customer: the same operator on another table."""
    orders = _table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    latest = P.latest_version(orders, "o_custkey", "o_orderdate")
    return latest.select("o_custkey", _stamp("o_orderdate"))


def q_version_counts(spark, sf):
    rows = _bronze(spark, sf).select("url", "title", "date_modified")
    return P.version_counts(rows).select(
        "url", "title", _stamp("date_modified"), _long("n_versions", "n_versions"), _long("recency", "recency")
    )


def q_order_counts(spark, sf):
    """Orders per customer with their recency: keys with many rows."""
    orders = _table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    ranked = P.version_counts(orders, "o_custkey", "o_orderdate")
    return ranked.select(
        "o_orderkey", _long("n_versions", "n_versions"), _long("recency", "recency")
    )


def q_filter_window(spark, sf):
    return _articles_text(filter_window(_bronze(spark, sf), "date_modified", *SOME_MONTHS))


def q_url_parts(spark, sf):
    url = F.col("url")
    return _page_table(spark, sf).select(
        "page_id",
        U.url_domain(url).alias("domain"),
        U.url_category(url).alias("category"),
        U.url_title(url).alias("url_title"),
    )


def q_days_between(spark, sf):
    rows = _posts(spark, sf)
    days = X.days_between(F.col("date_published"), F.col("date_modified"))
    return rows.select("doc_id", _long(days, "days_between"))


def q_content_counts(spark, sf):
    content = F.col("content")
    return _posts(spark, sf).select(
        "doc_id",
        X.paragraph_count(content).alias("content_paragraphs"),
        X.word_count(content).alias("total_content_words"),
    )


def q_year_month(spark, sf):
    events = _table(spark, sf, "events")
    found = events.withColumns(X.year_month(F.col("ts")))
    return found.select("event_id", _long("year", "year"), _long("month", "month"))


def q_row_id(spark, sf):
    rows = _posts(spark, sf)
    return rows.select("doc_id", X.row_id(F.col("url"), F.col("date_modified")).alias("row_id"))


def q_silver_articles(spark, sf):
    bronze = _bronze(spark, sf)
    stored = V.derive_articles(bronze)
    return _silver_text(V.build_silver_articles(bronze, stored, *SOME_MONTHS))


def q_silver_links(spark, sf):
    links = V.explode_links(_silver(spark, sf), *SOME_MONTHS)
    return links.select("url", "alias", "link", _stamp("date_modified"))


def q_publish_gold(spark, sf):
    silver = _silver(spark, sf)
    gold = L.publish_gold(silver, L.as_gold(V.derive_articles(_bronze(spark, sf))), *SOME_MONTHS)
    return gold.select("row_id", "url", _stamp("date_modified"), "author")


def q_links_json(spark, sf):
    """Links as JSON text, read back from that text."""
    text = L.links_as_json(F.col("content_links"))
    return _posts(spark, sf).select(
        "doc_id",
        F.get_json_object(text, "$[0].text").alias("text"),
        F.get_json_object(text, "$[0].link").alias("link"),
    )


def q_check_limits(spark, sf):
    limits = {"title": 50, "url": 45, "author": 4}
    return L.check_limits(_gold(spark, sf), limits)


def q_check_vectors(spark, sf):
    """Vectors against a wanted size; the given ones all break it."""
    vectors = _table(spark, sf, "embeddings")
    return L.check_limits(vectors, {}, "vec_id", "embedding", 1536)


def q_author_snapshot(spark, sf):
    return L.author_snapshot(_silver(spark, sf))


def _classified(spark, sf, window=ALL_MONTHS) -> DataFrame:
    return L.classify_link(V.explode_links(V.derive_articles(_bronze(spark, sf)), *window))


def q_classify_link(spark, sf):
    return _classified(spark, sf).select(
        "url", _stamp("date_modified"), "link", "kind", "target", "same_site"
    )


def q_resolve_url(spark, sf):
    pages = B.extract_flat_links(_page_table(spark, sf))
    links = pages.select("url", F.explode("content_links.link").alias("link"))
    return links.select("url", "link", U.resolve_url(F.col("url"), F.col("link")).alias("target"))


def q_probe_targets(spark, sf):
    return L.probe_targets(_classified(spark, sf), A.length_probe, parallelism=8)


def q_link_status(spark, sf):
    links = V.explode_links(V.derive_articles(_bronze(spark, sf)), *ALL_MONTHS)
    audited = L.audit_links(links, *SOME_MONTHS, probe=A.length_probe, parallelism=8)
    return audited.select("url", "link", "link_status", _stamp("date_modified"))


def _gold_links(spark, sf) -> DataFrame:
    links = V.explode_links(V.derive_articles(_bronze(spark, sf)), *ALL_MONTHS)
    return L.audit_links(links, *ALL_MONTHS, probe=A.length_probe, parallelism=8)


def q_publish_gold_links(spark, sf):
    """A link table without statuses whose window is replaced by audited links."""
    links = V.explode_links(V.derive_articles(_bronze(spark, sf)), *ALL_MONTHS)
    old = links.withColumn("link_status", F.lit(None).cast("string")).select(*GOLD_LINKS.fieldNames())
    new = L.audit_links(links, *SOME_MONTHS, probe=A.length_probe, parallelism=8)
    result = L.publish_gold_links(old, new, *SOME_MONTHS)
    return result.select("url", "link", "link_status", _stamp("date_modified"))


def q_link_status_counts(spark, sf):
    return L.link_status_counts(_gold_links(spark, sf))


def q_total_articles(spark, sf):
    return D.total_articles(_gold(spark, sf))


def q_recent_articles_count(spark, sf):
    return D.recent_articles_count(_gold(spark, sf), date(2027, 6, 15))


def q_top_author(spark, sf):
    return D.top_author(_gold(spark, sf))


def q_top_tag(spark, sf):
    return D.top_tag(_gold(spark, sf))


def q_overview_metrics(spark, sf):
    return D.overview_metrics(_gold(spark, sf), date(2027, 6, 15))


def q_authors(spark, sf):
    return D.authors(_gold(spark, sf))


def q_tags(spark, sf):
    return D.tags(_gold(spark, sf))


def q_tags_all(spark, sf):
    return D.tags(_gold(spark, sf), distinct=False)


def q_monthly_trend(spark, sf):
    return D.monthly_trend(_gold(spark, sf), date(2022, 1, 1), date(2026, 12, 31))


def q_monthly_trend_filled(spark, sf):
    return D.fill_month_gaps(D.monthly_trend(_gold(spark, sf), date(2021, 1, 1), date(2028, 12, 31)))


def q_top_authors(spark, sf):
    return D.top_authors(_gold(spark, sf))


def _article_list(df: DataFrame) -> DataFrame:
    return df.select("title", "author", _list("tags"), _stamp("date_published"), _stamp("date_modified"))


def q_filter_articles_and(spark, sf):
    return _article_list(D.filter_articles(_gold(spark, sf), ["src1", "src3", "src5"], ["en"], "and", 20))


def q_filter_articles_or(spark, sf):
    return _article_list(D.filter_articles(_gold(spark, sf), ["src1"], ["en", "t3"], "or", 20))


def q_filter_articles_all(spark, sf):
    return _article_list(D.filter_articles(_gold(spark, sf), ["All"], None, "and", 20))


def q_modified_distribution(spark, sf):
    return D.modified_distribution(_sitemap(spark, sf))


def q_urls_for_month(spark, sf):
    return D.urls_for_month(_sitemap(spark, sf), 2023, 8).select("url", _stamp("last_modified"))


def q_events_for_month(spark, sf):
    events = D.urls_for_month(_table(spark, sf, "events"), 2024, 1, "ts")
    return events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_events"))


def q_row_counts(spark, sf):
    return D.row_counts(_bronze(spark, sf), *SOME_MONTHS)


def q_sample_rows(spark, sf):
    return _articles_text(D.sample_rows(_bronze(spark, sf), 5, ["url", "date_modified"]))


def q_merge_paragraphs(spark, sf):
    merged = X.merge_paragraphs(F.col("content"))
    return _posts(spark, sf).select("doc_id", F.md5(merged).alias("digest"))


def q_tokenize(spark, sf):
    documents = _table(spark, sf, "documents")
    return documents.select("doc_id", _long(F.size(X.tokenize(F.col("text"))), "n_tokens"))


def _chunks(spark, sf) -> DataFrame:
    return C.chunk_articles(_silver(spark, sf))


def q_chunk_documents(spark, sf):
    return _chunks(spark, sf).select(
        "id",
        F.md5("content").alias("digest"),
        F.col("metadata.url").alias("url"),
        F.col("metadata.date_modified").alias("date_modified"),
        F.col("metadata.author").alias("author"),
        F.array_join("metadata.tags", "|").alias("tags"),
    )


def q_skip_reason(spark, sf):
    """Texts cut at line ends with blank-only lines kept, counted by what is wrong with them."""
    lines = _table(spark, sf, "documents").select(F.explode(F.split("text", "\n")).alias("line"))
    marked = C.with_skip_reason(lines.select(F.array("line").alias("content")))
    return marked.groupBy("skip_reason").agg(F.count(F.lit(1)).alias("n_lines"))


def q_embed_chunks(spark, sf):
    """Nonzero entries of the vectors of all chunks."""
    embedded = C.embed_chunks(_chunks(spark, sf), C.hashing_embedder(VECTOR_SIZE), VECTOR_SIZE)
    entries = embedded.select("id", F.posexplode("dense_vector").alias("slot", "weight"))
    return entries.filter(F.col("weight") != 0).select(
        "id", _long("slot", "slot"), F.round(F.col("weight").cast("double"), 4).alias("weight")
    )


def q_upsert_documents(spark, sf):
    """Texts by id with pages put over those with the same id."""
    old = _table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("content"))
    new = _table(spark, sf, "pages").select(F.col("page_id").alias("id"), F.col("html").alias("content"))
    return C.upsert_documents(old, new).select("id", F.md5("content").alias("digest"))


def q_ingest_report(spark, sf):
    articles = _silver(spark, sf)
    _, skipped = C.skip_blank(articles)
    return C.ingest_report(articles, _chunks(spark, sf), skipped)


def q_unaccounted_ids(spark, sf):
    """Articles left over when only those of some months were turned into chunks."""
    articles = _silver(spark, sf)
    done = C.chunk_articles(filter_window(articles, "date_modified", *SOME_MONTHS))
    _, skipped = C.skip_blank(articles)
    return C.unaccounted_ids(articles, done, skipped)


def q_distinct_row_ids(spark, sf):
    return C.distinct_row_ids(_chunks(spark, sf))


def q_distinct_row_id_count(spark, sf):
    as_text = _chunks(spark, sf).withColumn("metadata", F.to_json("metadata"))
    return C.distinct_row_id_count(as_text)


def _vectors(spark, sf) -> DataFrame:
    return _table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("dense_vector"), "label"
    )


def _centroids(spark, sf) -> DataFrame:
    """The mean vector of every label, from all vectors: one query per label."""
    entries = _vectors(spark, sf).select("label", F.posexplode("dense_vector").alias("slot", "x"))
    means = entries.groupBy("label", "slot").agg(F.round(F.avg(F.col("x").cast("double")), 6).alias("x"))
    # One group per label holds one value per dimension.
    ordered = F.array_sort(F.collect_list(F.struct("slot", "x")))
    return means.groupBy(F.col("label").alias("query_id")).agg(
        F.transform(ordered, lambda e: e["x"]).cast("array<float>").alias("dense_vector")
    )


def _hits(df: DataFrame) -> DataFrame:
    return df.select(
        _long("query_id", "query_id"), "id", F.col("score").cast("double").alias("score"), _long("rank", "rank")
    )


def q_dense_topk(spark, sf):
    return _hits(R.dense_topk(_vectors(spark, sf), _centroids(spark, sf), 10, VECTOR_SIZE))


def q_dense_topk_tiled(spark, sf):
    """The same search in the form used for query sets too large to send to every task."""
    hits = R.dense_topk(
        _vectors(spark, sf), _centroids(spark, sf), 10, VECTOR_SIZE, max_broadcast=0
    )
    return _hits(hits)


def q_dense_topk_lsh(spark, sf):
    index = R.lsh_index(_vectors(spark, sf), VECTOR_SIZE)
    return _hits(R.dense_topk_lsh(index, _centroids(spark, sf), 10, VECTOR_SIZE))


def q_dense_recall(spark, sf):
    """Share of the exact hits the approximate search finds."""
    vectors, asked = _vectors(spark, sf), _centroids(spark, sf)
    index = R.lsh_index(vectors, VECTOR_SIZE)
    found = R.dense_topk_lsh(index, asked, 10, VECTOR_SIZE)
    return R.recall(found, R.dense_topk(vectors, asked, 10, VECTOR_SIZE))


def _texts(spark, sf) -> DataFrame:
    return _table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("content"))


def _questions(spark, sf) -> DataFrame:
    return _table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def q_bm25_postings(spark, sf):
    index = R.bm25_index(_texts(spark, sf))
    return index.postings.select("term", "id", "tf", "doc_length")


def q_bm25_term_stats(spark, sf):
    return R.bm25_index(_texts(spark, sf)).term_stats


def q_bm25_corpus(spark, sf):
    corpus = R.bm25_index(_texts(spark, sf)).corpus
    return corpus.select("n_docs", F.round("avg_length", 6).alias("avg_length"))


def q_bm25_topk(spark, sf):
    return _hits(R.bm25_topk(R.bm25_index(_texts(spark, sf)), _questions(spark, sf)))


def q_bm25_scan(spark, sf):
    """The same search straight over the texts."""
    return _hits(R.bm25_scan(_texts(spark, sf), _questions(spark, sf)))


def q_bm25_stored_index(spark, sf):
    """The same search over an index stored as bucketed tables."""
    path = scratch_path(spark, "index")
    name = "bm25_" + path.rsplit("-", 1)[1]
    retrieval.publish_index(spark, _texts(spark, sf), name, path, buckets=8)
    return _hits(R.bm25_topk(R.load_bm25_index(spark, name), _questions(spark, sf)))


def q_bm25_pruned(spark, sf):
    """The same search over a segmented index, from a part of its blocks."""
    path = scratch_path(spark, "segments")
    G.upsert(_texts(spark, sf), path)
    return _hits(G.pruned_topk(G.open_index(spark, path), _questions(spark, sf)).hits)


def q_bm25_upserted(spark, sf):
    """An index made of older texts, then followed through replacements, deletions and a merge."""
    path, texts = scratch_path(spark, "segments"), _texts(spark, sf)
    older = F.concat(F.lit("older words of "), F.col("content"))
    G.upsert(texts.withColumn("content", F.when(F.col("id") % 3 == 0, older).otherwise(F.col("content"))), path)
    G.upsert(texts.filter("id % 6 = 0"), path, deleted=texts.filter("id % 7 = 1").select("id"))
    G.upsert(texts.filter("id % 6 = 3"), path, deleted=texts.filter("id % 7 = 3").select("id"))
    G.merge(spark, path)
    return _hits(G.pruned_topk(G.open_index(spark, path), _questions(spark, sf)).hits)


def _collection(spark, sf) -> DataFrame:
    """Texts with a vector where one has the same id; the metadata names the source.

    Stored once: searches read it several times, and the join moves all texts.
    """
    vectors = _table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("dense_vector")
    )
    texts = _table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"),
        F.col("text").alias("content"),
        F.struct(F.col("source").alias("author"), F.col("lang").alias("lang")).alias("metadata"),
    )
    return stage(texts.join(vectors, "id", "left"), "collection")


def _vector_questions(spark, sf) -> DataFrame:
    vectors = _table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("query_id"), F.col("embedding").alias("dense_vector")
    )
    return _questions(spark, sf).join(vectors, "query_id")


def _search(spark, sf, mode: str, collection: DataFrame | None = None) -> DataFrame:
    documents = _collection(spark, sf) if collection is None else collection
    return R.search_mode(mode, documents, None, _vector_questions(spark, sf), dimension=VECTOR_SIZE)


def q_search_keyword(spark, sf):
    return _hits(_search(spark, sf, R.KEYWORD))


def q_search_contextual(spark, sf):
    return _hits(_search(spark, sf, R.CONTEXTUAL))


def q_rrf_fuse(spark, sf):
    """Both branches at depth 20, fused to 10."""
    asked = _vector_questions(spark, sf)
    dense = R.dense_topk(_collection(spark, sf), asked, 20, VECTOR_SIZE)
    lexical = R.bm25_scan(_texts(spark, sf), asked, 20)
    return _hits(R.rrf_fuse([dense, lexical]))


def q_hybrid_search(spark, sf):
    """Five fused hits per query with the documents they name."""
    documents = _collection(spark, sf)
    found = R.attach_documents(_search(spark, sf, R.HYBRID, documents), documents)
    return found.select(
        "query_id",
        "id",
        "score",
        _long("rank", "rank"),
        F.md5("content").alias("digest"),
        F.col("metadata.author").alias("author"),
    )


def q_dedup_hits_by_url(spark, sf):
    """Chunks of all article versions searched; each article is listed once per query."""
    articles = V.derive_articles(_bronze(spark, sf))
    documents = stage(C.chunk_articles(articles), "collection")
    hits = R.bm25_scan(documents, _questions(spark, sf))
    found = R.dedup_hits_by_url(R.attach_documents(hits, documents))
    return found.select(
        "query_id", _long("rank", "rank"), "url", "author", "date_published", _list("tags")
    )


def q_ingest_stream(spark, sf):
    """Raw files streamed into bronze twice; the second run finds nothing new."""
    base, bronze, mark = (scratch_path(spark, n) for n in ("raw", "bronze", "offsets"))
    S.write_raw(S.with_months(_bronze(spark, sf)), base)
    ingest_stream(spark, base, bronze, mark).awaitTermination()
    ingest_stream(spark, base, bronze, mark + "-again").awaitTermination()
    return _articles_text(S.load_table(spark, bronze, BRONZE))


def q_stored_pipeline(spark, sf):
    """Pages to stored raw, bronze, silver, gold and audited links, the window loaded twice."""
    layout = M.Layout.under(scratch_path(spark, "layers"))
    M.load_raw(A.post_pages(_posts(spark, sf)), layout)
    M.load_bronze(spark, layout)
    for window in (SOME_MONTHS, SOME_MONTHS):
        M.load_silver(spark, layout, *window)
        M.load_gold(spark, layout, *window)
        M.load_gold_links(spark, layout, *window, probe=A.length_probe, parallelism=8)
    gold = S.load_table(spark, layout.gold, GOLD).select("url", "date_modified", "total_content_words")
    links = S.load_table(spark, layout.gold_links, GOLD_LINKS).select("url", "link_status")
    return gold.join(links, "url").select(
        "url", _stamp("date_modified"), "total_content_words", "link_status"
    )


def q_stored_sitemap(spark, sf):
    """Sitemap urls stored in two batches, the second holding the first again."""
    layout = M.Layout.under(scratch_path(spark, "layers"))
    urls = _sitemap(spark, sf)
    M.store_sitemap(_before_cutoff(urls, "last_modified"), layout)
    M.store_sitemap(urls, layout)
    return S.load_table(spark, layout.sitemap, SITEMAP_URLS).select("url", _stamp("last_modified"))


def q_changed_layers(spark, sf):
    """Article versions through all layers in two runs, the second touching one month only."""
    layout = M.Layout.under(scratch_path(spark, "layers"))
    versions = _bronze(spark, sf)
    late = F.date_trunc("month", "date_modified") == F.lit("2024-03-01").cast("timestamp")
    changes.load_changes(versions.filter(~late), layout, "first", A.length_probe, 8)
    changes.load_changes(versions.filter(late), layout, "second", A.length_probe, 8)
    gold = S.load_table(spark, layout.gold, GOLD).select("url", "date_modified", "total_content_words")
    links = S.load_table(spark, layout.gold_links, GOLD_LINKS)
    return gold.join(links.select("url", "date_modified", "link_status"), ["url", "date_modified"]).select(
        "url", _stamp("date_modified"), "total_content_words", "link_status"
    )


def _backfilled(spark, sf) -> M.Layout:
    """Pages of the months of two years loaded by the sitemap, then those of all years."""
    layout = M.Layout.under(scratch_path(spark, "layers"))
    posts = _posts(spark, sf)
    urls = posts.select(F.col("doc_id").alias("page_id"), "url")
    pages = stage(A.post_pages(posts).join(urls, "page_id"), "pages")
    M.store_sitemap(_sitemap(spark, sf), layout)
    listing = "https://blog.example.com/c1/post-1/"
    backfill.load_open_months(spark, pages, layout, *month_window(2023, 1, 2024, 12, TODAY), listing, 24)
    backfill.load_open_months(spark, pages, layout, *ALL_MONTHS, listing, 96)
    return layout


def q_backfill_raw(spark, sf):
    raw = S.read_raw(spark, _backfilled(spark, sf).raw)
    return raw.select("url", "title", _stamp("date_modified"))


def q_backfill_progress(spark, sf):
    """What each load of a month asked for and found; no month was loaded twice."""
    progress = S.load_table(spark, _backfilled(spark, sf).progress, PROGRESS)
    return progress.select(_long("year", "year"), _long("month", "month"), "n_urls", "n_found")


def q_ingest_collection(spark, sf):
    """Articles of some months, then of all, upserted into one collection."""
    gold = L.as_gold(_silver(spark, sf))
    embed = C.hashing_embedder(VECTOR_SIZE)
    empty = S.empty_like(spark, C.CHUNK_DOCUMENTS)
    first, _ = retrieval.ingest(gold, empty, embed, VECTOR_SIZE, *SOME_MONTHS)
    merged, _ = retrieval.ingest(gold, stage(first, "collection"), embed, VECTOR_SIZE)
    return merged.select("id", F.md5("content").alias("digest"))


def q_stored_collection(spark, sf):
    """The same collection kept as a stored table, loaded window by window."""
    gold, embed = L.as_gold(_silver(spark, sf)), C.hashing_embedder(VECTOR_SIZE)
    path = scratch_path(spark, "collection")
    for window in (SOME_MONTHS, ALL_MONTHS):
        retrieval.load_collection(spark, gold, path, embed, VECTOR_SIZE, *window)
    stored = S.load_table(spark, path, C.CHUNK_DOCUMENTS)
    return stored.select("id", F.md5("content").alias("digest"))


def _refusing_embedder():
    """Refuses a batch when the hash of a text in it begins with 0: about one text of sixteen."""
    plain = C.hashing_embedder(VECTOR_SIZE)

    def embed(texts):
        refused = [h for h in (md5(t.encode("utf-8")).hexdigest() for t in texts) if h[0] == "0"]
        if refused:
            raise ValueError(f"refused {' '.join(refused)}")
        return plain(texts)

    return embed


def _quarantined(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Report, collection and quarantine of a load with texts that cannot be embedded."""
    gold = L.as_gold(_silver(spark, sf))
    path, apart = scratch_path(spark, "collection"), scratch_path(spark, "quarantine")
    report = retrieval.load_collection(
        spark, gold, path, _refusing_embedder(), VECTOR_SIZE, *ALL_MONTHS, quarantine_path=apart
    )
    return report, S.load_table(spark, path, C.CHUNK_DOCUMENTS), S.load_table(spark, apart, C.QUARANTINE)


def q_failed_report(spark, sf):
    return _quarantined(spark, sf)[0]


def q_quarantine(spark, sf):
    """Chunks by what became of them: stored with their article, or refused and why."""
    _, stored, quarantine = _quarantined(spark, sf)
    kept = stored.select("id", F.lit(None).cast("string").alias("failure"))
    return kept.unionByName(quarantine.select("id", "failure"))


def entry(spark: SparkSession) -> DataFrame:
    """Articles per month, latest versions only, with the gaps shown."""
    return q_monthly_trend_filled(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = {name[2:]: query for name, query in globals().items() if name.startswith("q_")}
    return own | (_llm.queries() if _llm else {})


# --- SQL counterparts ------------------------------------------------------------------------

_POSTS = r"""
posts AS (
  SELECT doc_id,
         'https://blog.example.com/c' || ((doc_id // 2) % 4) || '/post-' || (doc_id // 2) || '/' AS url,
         string_split(text, chr(10))[1] AS title,
         TIMESTAMP '2021-01-01' + to_days(CAST((((doc_id // 2) * 37) % 60) * 45 AS INTEGER)) AS date_published,
         TIMESTAMP '2021-01-01' + to_days(CAST((((doc_id // 2) * 37) % 60) * 45 AS INTEGER))
           + to_hours(CAST(doc_id % 97 AS INTEGER)) AS date_modified,
         source AS author,
         [lang, 't' || (doc_id % 7)] AS tags,
         'see ' || (doc_id % 8) AS alias,
         ['https://ext.example.org/a', '/about', '#top', 'mailto:me@example.org', 'see-mail',
          '(https://ext.example.org/b)', 'https://ext.example.org/c) tail', ''][doc_id % 8 + 1] AS link,
         list_filter(string_split(text, chr(10)), lambda p: regexp_matches(p, '[^ \t\n\f\r]')) AS content
  FROM documents
)"""

_TS = "strftime({0}, '%Y-%m-%d %H:%M:%S')"


def _ts(name: str) -> str:
    return f"{_TS.format(name)} AS {name}"


_ARTICLE = f"""url, title, {_ts('date_published')}, {_ts('date_modified')}, author,
  array_to_string(tags, '|') AS tags, alias || '=' || link AS content_links,
  md5(array_to_string(content, chr(10))) AS content"""

_SOME = "date_modified BETWEEN TIMESTAMP '2022-03-01 00:00:00' AND TIMESTAMP '2026-12-31 23:59:59'"
_KNOWN = "date_modified < TIMESTAMP '2024-01-01'"

_LATEST = """
latest AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY url ORDER BY date_modified DESC) AS rn FROM posts
  ) WHERE rn = 1
)"""

_ROW_ID = "sha256(url || chr(1) || strftime(date_modified, '%Y-%m-%d %H:%M:%S'))"

_SILVER = rf"""{_ROW_ID} AS row_id, url,
  split_part(url, '/', 1) || '//' || split_part(url, '/', 3) AS domain,
  split_part(url, '/', 4) AS category, split_part(url, '/', -2) AS url_title,
  {_ts('date_published')}, {_ts('date_modified')},
  date_diff('day', date_published, date_modified) AS days_between, title, author,
  array_to_string(tags, '|') AS tags, md5(array_to_string(content, chr(10))) AS content,
  CAST(len(content) AS BIGINT) AS content_paragraphs,
  CAST(coalesce((SELECT sum(len(regexp_split_to_array(p, '\s+'))) FROM unnest(content) AS t(p)), 0) AS BIGINT)
    AS total_content_words,
  CAST(year(date_modified) AS BIGINT) AS year, CAST(month(date_modified) AS BIGINT) AS month"""

# Python's strip and the pattern class agree on the blanks found in the texts.
_TRIMMED = r"list_transform(content, lambda p: regexp_replace(p, '^[\s\x0b\x1c-\x1f\x{85}\x{a0}]+|[\s\x0b\x1c-\x1f\x{85}\x{a0}]+$', '', 'g'))"

_LINKS = rf"""
links AS (
  SELECT url, link, date_modified,
    CASE WHEN contains(link, 'http') AND regexp_matches(link, '^https?://[^)]+') THEN 'external'
         WHEN contains(link, 'http') THEN 'internal'
         WHEN contains(link, 'mail') AND regexp_matches(link, '^mailto:[^)]+') THEN 'mail_link'
         WHEN contains(link, 'mail') THEN NULL
         WHEN starts_with(link, '#') THEN 'internal_working'
         ELSE 'internal' END AS kind,
    CASE link WHEN '/about' THEN 'https://blog.example.com/about'
              WHEN '' THEN url
              WHEN '(https://ext.example.org/b)' THEN url || '(https:/ext.example.org/b)'
              WHEN 'https://ext.example.org/a' THEN link
              WHEN 'https://ext.example.org/c) tail' THEN 'https://ext.example.org/c' END AS target
  FROM posts
),
audited AS (
  SELECT url, link, date_modified,
    CASE WHEN target IS NULL THEN kind
         WHEN length(target) % 5 = 1 THEN 'timeout 30 sec'
         ELSE CASE WHEN kind = 'external' OR link = '' THEN 'external' ELSE 'internal' END
              || CASE WHEN length(target) % 5 = 0 THEN '_broken' ELSE '_working' END
    END AS link_status
  FROM links
)"""

_CHUNKED = r"""
  SELECT row_id || '_' || CAST(i // 350 AS VARCHAR) AS id, row_id, url, title, author, tags,
         date_published, date_modified,
         array_to_string(list_slice(tokens, i + 1, i + 400), '') AS content
  FROM (SELECT *, unnest(range(0, len(tokens), 350)) AS i FROM (
    SELECT *, regexp_extract_all(array_to_string(content, ' '), '[ \t\n\f\r]*[^ \t\n\f\r]+') AS tokens
    FROM (SELECT *, {row_id} AS row_id FROM {source})
  ))"""


def _chunked(source: str, name: str = "chunks") -> str:
    return f"\n{name} AS ({_CHUNKED.format(row_id=_ROW_ID, source=source)})"


def _bm25(docs: str, k: int, name: str = "lexical") -> str:
    """Common table expressions ending in ``name``; needs ``asked(query_id, text)``."""
    return rf"""
doc_terms AS (
  SELECT id, regexp_extract_all(lower(content), '[\p{{L}}\p{{N}}]+') AS terms FROM {docs}
),
corpus AS (SELECT count(*) AS n, avg(len(terms)) AS avg_length FROM doc_terms),
postings AS (
  SELECT term, id, doc_length, count(*) AS tf
  FROM (SELECT id, len(terms) AS doc_length, unnest(terms) AS term FROM doc_terms) GROUP BY ALL
),
term_stats AS (SELECT term, count(*) AS df FROM postings GROUP BY term),
query_terms AS (
  SELECT query_id, term, count(*) AS query_tf
  FROM (SELECT query_id, unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+')) AS term FROM asked)
  GROUP BY ALL
),
bm25 AS (
  SELECT query_id, id, round(sum(query_tf * ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2
           / (tf + 1.2 * (0.25 + 0.75 * doc_length / avg_length))), 6) AS score
  FROM query_terms JOIN term_stats USING (term) JOIN postings USING (term) CROSS JOIN corpus
  GROUP BY query_id, id
),
{name} AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM bm25)
  WHERE rank <= {k}
)"""


def _dense(docs: str, asked: str, k: int, name: str = "dense") -> str:
    """Cosine in doubles over all pairs; both sides have ``id``/``query_id`` and ``v``."""
    return f"""
{name} AS (
  SELECT * FROM (
    SELECT query_id, id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank
    FROM (
      SELECT query_id, id,
             round(list_inner_product(d.v, q.v)
                   / sqrt(list_inner_product(d.v, d.v) * list_inner_product(q.v, q.v)), 6) AS score
      FROM {docs} d CROSS JOIN {asked} q
    )
  ) WHERE rank <= {k}
)"""


_CENTROIDS = """
vectors AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
entries AS (
  SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS slot FROM embeddings
),
centroids AS (
  SELECT query_id, CAST(CAST(list(x ORDER BY slot) AS FLOAT[]) AS DOUBLE[]) AS v
  FROM (SELECT label AS query_id, slot, round(avg(CAST(x AS DOUBLE)), 6) AS x FROM entries GROUP BY ALL)
  GROUP BY query_id
)"""

_ASKED = """
vectors AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
            WHERE vec_id IN (SELECT doc_id FROM documents)),
asked AS (
  SELECT item_id AS query_id, text, CAST(embedding AS DOUBLE[]) AS v
  FROM benchmark JOIN embeddings ON item_id = vec_id
),
texts AS (SELECT doc_id AS id, text AS content FROM documents)"""

_FUSED = """
fused AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM (
    SELECT query_id, id, round(sum(1.0 / (100 + rank)), 9) AS score
    FROM (SELECT query_id, id, rank FROM dense UNION ALL SELECT query_id, id, rank FROM lexical)
    GROUP BY query_id, id
  )
)"""

_HIT_COLUMNS = "query_id, id, CAST(score AS DOUBLE) AS score, rank"
_LIST = f"""title, author, array_to_string(tags, '|') AS tags, {_ts('date_published')}, {_ts('date_modified')}"""


def oracle_sql() -> dict[str, str]:
    posts, latest = f"WITH {_POSTS}", f"WITH {_POSTS}, {_LATEST}"
    anchor = r"""<a href="([^"]*)">([^<]*)</a>"""
    page_links = rf"""
      SELECT page_id, url, unnest(regexp_extract_all(html, '{anchor}', 1)) AS link FROM pages"""
    joined_links = rf"""
      SELECT page_id, array_to_string(list_transform(
        list_zip(regexp_extract_all(html, '{anchor}', 2), regexp_extract_all(html, '{anchor}', 1)),
        lambda z: z[1] || '=' || z[2]), '|') AS content_links
      FROM pages"""
    all_articles = f"{posts} SELECT {_ARTICLE} FROM posts"
    trend = "CAST(year(date_published) AS BIGINT) AS year, CAST(month(date_published) AS BIGINT) AS month"
    recent = "date_published >= TIMESTAMP '2027-06-01' - INTERVAL 180 DAY"
    urls = f"SELECT url, {_TS.format('date_modified')} AS last_modified FROM posts"
    dense_hits = f"WITH {_CENTROIDS}, {_dense('vectors', 'centroids', 10)} SELECT {_HIT_COLUMNS} FROM dense"
    texts = "WITH texts AS (SELECT doc_id AS id, text AS content FROM documents)"
    bm25 = (
        f"{texts}, asked AS (SELECT item_id AS query_id, text FROM benchmark), {_bm25('texts', 10)}"
        f" SELECT {_HIT_COLUMNS} FROM lexical"
    )
    order = "ORDER BY date_published DESC NULLS FIRST, date_modified DESC, url"
    return (_llm.oracle_sql() if _llm else {}) | {
        "read_pages": "SELECT page_id, url, CAST(length(html) AS BIGINT) AS n_chars FROM pages",
        "raw_dataset": all_articles,
        "raw_year": f"{posts} SELECT url, {_ts('date_modified')} FROM posts WHERE year(date_modified) = 2024",
        "stored_table": f"{latest} SELECT {_SILVER} FROM latest",
        "articles_csv": f"""{latest} SELECT title, author, '["' || tags[1] || '","' || tags[2] || '"]' AS tags,
            {_ts('date_published')}, {_ts('date_modified')}
          FROM latest WHERE author IN ('src1', 'src3')""",
        "first_load": all_articles,
        "extract_articles": f"""{posts} SELECT url, title, {_ts('date_published')}, {_ts('date_modified')}, author,
            array_to_string(tags, '|') AS tags, alias || '=' || link AS content_links,
            md5(array_to_string(list_append({_TRIMMED}, alias), chr(10))) AS content,
            CAST(year(date_modified) AS BIGINT) AS year, CAST(month(date_modified) AS BIGINT) AS month
          FROM posts""",
        "jsonld_metadata": f"""{posts} SELECT doc_id AS page_id, url, title,
            strftime(date_published, '%Y-%m-%dT%H:%M:%SZ') AS date_published,
            strftime(date_modified, '%Y-%m-%dT%H:%M:%SZ') AS date_modified, author FROM posts""",
        "extract_tags": f"{posts} SELECT doc_id AS page_id, array_to_string(tags, '|') AS tags FROM posts",
        "extract_links": joined_links,
        "extract_flat_links": joined_links,
        "extract_paragraphs": f"""{posts} SELECT doc_id AS page_id,
            md5(array_to_string(list_append({_TRIMMED}, alias), chr(10))) AS content FROM posts""",
        "parse_iso_timestamps": f"""{posts} SELECT doc_id,
            strftime(date_published - INTERVAL 2 HOUR, '%Y-%m-%d %H:%M:%S') AS date_published,
            strftime(date_modified + INTERVAL 5 HOUR, '%Y-%m-%d %H:%M:%S') AS date_modified,
            CAST(year(date_modified) AS BIGINT) AS year, CAST(month(date_modified) AS BIGINT) AS month
          FROM posts""",
        "sitemap_locs": "SELECT url FROM pages",
        "sitemap_table_rows": f"{posts} {urls}",
        "sitemap_stamps": f"""{posts} SELECT url, {_TS.format('stamp')} AS last_modified, form FROM (
            SELECT url, CASE doc_id % 7 WHEN 4 THEN date_modified + INTERVAL 5 HOUR WHEN 5 THEN NULL
                WHEN 6 THEN date_trunc('day', date_modified) ELSE date_modified END AS stamp,
              CASE doc_id % 7 WHEN 0 THEN 'iso' WHEN 1 THEN 'd-MMM-yyyy[ HH:mm[:ss]][ xx]'
                WHEN 2 THEN 'M-d-yyyy[ HH:mm[:ss]][ xx]' WHEN 3 THEN 'd-MMM-yyyy[ HH:mm[:ss]][ xx]'
                WHEN 4 THEN 'yyyyMMdd''T''HHmmss[xx]' WHEN 6 THEN 'iso' END AS form FROM posts)""",
        "rejected_stamps": f"{posts} SELECT url, 'mid-morning' AS stamp FROM posts WHERE doc_id % 7 = 5",
        "exclude_urls": """SELECT url FROM pages WHERE url <> 'https://thther.example.org/en/685'
            AND NOT regexp_matches(url, '(png|jpeg|jpg)$')""",
        "upsert_sitemap_urls": f"{posts} {urls}",
        "upsert_versions": all_articles,
        "version_copies": f"""{posts} SELECT url, {_ts('date_modified')}, count(*) AS copies FROM (
            SELECT t.url, t.date_modified, t.doc_id FROM posts t
            LEFT JOIN (SELECT * FROM posts WHERE {_KNOWN}) main ON t.url = main.url
            WHERE main.url IS NULL OR t.date_modified <> main.date_modified)
          GROUP BY url, date_modified, doc_id""",
        "upsert_versions_reference": f"""{posts} SELECT t.url, t.title,
            {_TS.format('t.date_modified')} AS date_modified FROM posts t
          LEFT JOIN (SELECT * FROM posts WHERE {_KNOWN}) main ON t.url = main.url
          WHERE main.url IS NULL OR t.date_modified <> main.date_modified""",
        "replace_window": f"""{posts} SELECT {_ARTICLE} FROM (
            SELECT * FROM posts WHERE NOT ({_SOME})
            UNION ALL
            SELECT * EXCLUDE (rn) FROM (
              SELECT *, row_number() OVER (PARTITION BY url ORDER BY date_modified DESC) AS rn
              FROM posts WHERE {_SOME}) WHERE rn = 1)""",
        "latest_version": f"{latest} SELECT {_ARTICLE} FROM latest",
        "latest_order": f"""SELECT o_custkey, {_TS.format('max(o_orderdate)')} AS o_orderdate
          FROM orders GROUP BY o_custkey""",
        "version_counts": f"""{posts} SELECT url, title, {_ts('date_modified')}, n_versions, recency FROM (
            SELECT *, count(*) OVER (PARTITION BY url) AS n_versions,
              row_number() OVER (PARTITION BY url ORDER BY date_modified DESC) AS recency FROM posts)
          WHERE n_versions > 1""",
        "order_counts": """SELECT o_orderkey, n_versions, recency FROM (
            SELECT o_orderkey, count(*) OVER (PARTITION BY o_custkey) AS n_versions,
              rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC) AS recency FROM orders)
          WHERE n_versions > 1""",
        "filter_window": f"{posts} SELECT {_ARTICLE} FROM posts WHERE {_SOME}",
        "url_parts": """SELECT page_id, split_part(url, '/', 1) || '//' || split_part(url, '/', 3) AS domain,
            split_part(url, '/', 4) AS category, split_part(url, '/', -2) AS url_title FROM pages""",
        "days_between": f"""{posts} SELECT doc_id,
            date_diff('day', date_published, date_modified) AS days_between FROM posts""",
        "content_counts": rf"""{posts} SELECT doc_id, CAST(len(content) AS BIGINT) AS content_paragraphs,
            CAST(coalesce((SELECT sum(len(regexp_split_to_array(p, '\s+'))) FROM unnest(content) AS t(p)), 0)
              AS BIGINT) AS total_content_words FROM posts""",
        "year_month": """SELECT event_id, CAST(year(ts) AS BIGINT) AS year,
            CAST(month(ts) AS BIGINT) AS month FROM events""",
        "row_id": f"{posts} SELECT doc_id, {_ROW_ID} AS row_id FROM posts",
        "silver_articles": f"""{posts} SELECT {_SILVER} FROM (
            SELECT * FROM posts WHERE NOT ({_SOME})
            UNION ALL
            SELECT * EXCLUDE (rn) FROM (
              SELECT *, row_number() OVER (PARTITION BY url ORDER BY date_modified DESC) AS rn
              FROM posts WHERE {_SOME}) WHERE rn = 1)""",
        "silver_links": f"{latest} SELECT url, alias, link, {_ts('date_modified')} FROM latest WHERE {_SOME}",
        "publish_gold": f"""{latest} SELECT {_ROW_ID} AS row_id, url, {_ts('date_modified')}, author FROM (
            SELECT * FROM posts WHERE NOT ({_SOME}) UNION ALL SELECT * FROM latest WHERE {_SOME})""",
        "links_json": f"{posts} SELECT doc_id, alias AS text, link FROM posts",
        "check_limits": f"""{latest}, named AS (SELECT {_ROW_ID} AS id, title, url, author FROM latest)
          SELECT id, 'title' AS "column", CAST(length(title) AS BIGINT) AS size, CAST(50 AS BIGINT) AS allowed
            FROM named WHERE length(title) > 50
          UNION ALL SELECT id, 'url', length(url), 45 FROM named WHERE length(url) > 45
          UNION ALL SELECT id, 'author', length(author), 4 FROM named WHERE length(author) > 4""",
        "check_vectors": """SELECT vec_id AS id, 'embedding' AS "column", CAST(len(embedding) AS BIGINT) AS size,
            CAST(1536 AS BIGINT) AS allowed FROM embeddings WHERE len(embedding) <> 1536""",
        "author_snapshot": f"{latest} SELECT author FROM latest GROUP BY author ORDER BY author",
        "classify_link": rf"""{posts}, {_LINKS} SELECT url, {_ts('date_modified')}, link, kind, target,
            regexp_extract(target, '://([^/?#]*)', 1) = 'blog.example.com' AS same_site FROM links""",
        "resolve_url": rf"""SELECT url, link, regexp_extract(url, '^https?://[^/?#]*') || link AS target
          FROM ({page_links})""",
        "probe_targets": f"""{posts}, {_LINKS} SELECT DISTINCT target,
            CASE length(target) % 5 WHEN 0 THEN 'error' WHEN 1 THEN 'timeout' ELSE 'ok' END AS outcome
          FROM links WHERE target IS NOT NULL""",
        "link_status": f"""{posts}, {_LINKS} SELECT url, link, link_status, {_ts('date_modified')}
          FROM audited WHERE {_SOME}""",
        "publish_gold_links": f"""{posts}, {_LINKS} SELECT url, link,
            CASE WHEN {_SOME} THEN link_status END AS link_status, {_ts('date_modified')} FROM audited""",
        "link_status_counts": f"""{posts}, {_LINKS} SELECT link_status, count(*) AS n_links
          FROM audited GROUP BY link_status ORDER BY n_links DESC""",
        "total_articles": f"{latest} SELECT count(*) AS total FROM latest",
        "recent_articles_count": f"{latest} SELECT count(*) AS n_recent FROM latest WHERE {recent}",
        "top_author": f"""{latest} SELECT coalesce(author, 'N/A') AS author, count(*) AS article_count
          FROM latest GROUP BY latest.author ORDER BY count(*) DESC, latest.author LIMIT 1""",
        "top_tag": f"""{latest} SELECT tag, count(*) AS tag_count FROM (SELECT unnest(tags) AS tag FROM latest)
          GROUP BY tag ORDER BY count(*) DESC, tag LIMIT 1""",
        "overview_metrics": f"""{latest} SELECT (SELECT count(*) FROM latest) AS total_articles,
            (SELECT count(*) FROM latest WHERE {recent}) AS last_six_months,
            (SELECT author FROM latest GROUP BY author ORDER BY count(*) DESC, author LIMIT 1) AS top_author,
            (SELECT tag FROM (SELECT unnest(tags) AS tag FROM latest) GROUP BY tag
              ORDER BY count(*) DESC, tag LIMIT 1) AS top_tag""",
        "authors": f"{latest} SELECT author FROM latest GROUP BY author ORDER BY author",
        "tags": f"{latest} SELECT DISTINCT unnest(tags) AS tag FROM latest ORDER BY tag",
        "tags_all": f"{latest} SELECT unnest(tags) AS tag FROM latest",
        "monthly_trend": f"""{latest} SELECT {trend}, count(*) AS n_articles FROM latest
          WHERE date_published BETWEEN TIMESTAMP '2022-01-01 00:00:00' AND TIMESTAMP '2026-12-31 23:59:59'
          GROUP BY ALL ORDER BY year, month""",
        "monthly_trend_filled": f"""{latest}, trend AS (
            SELECT date_trunc('month', date_published) AS m, count(*) AS n_articles FROM latest GROUP BY m),
          months AS (SELECT unnest(generate_series(min(m), max(m), INTERVAL 1 MONTH)) AS m FROM trend)
          SELECT CAST(year(m) AS BIGINT) AS year, CAST(month(m) AS BIGINT) AS month,
            strftime(m, '%Y-%m') AS year_month, n_articles
          FROM months LEFT JOIN trend USING (m) ORDER BY year_month""",
        "top_authors": f"""{latest} SELECT author, count(*) AS article_count FROM latest
          GROUP BY author ORDER BY count(*) DESC, author LIMIT 10""",
        "filter_articles_and": f"""{latest} SELECT {_LIST} FROM (SELECT * FROM latest
          WHERE author IN ('src1', 'src3', 'src5') AND list_has_all(tags, ['en']) {order} LIMIT 20)""",
        "filter_articles_or": f"""{latest} SELECT {_LIST} FROM (SELECT * FROM latest
          WHERE author IN ('src1') OR list_has_all(tags, ['en', 't3']) {order} LIMIT 20)""",
        "filter_articles_all": f"{latest} SELECT {_LIST} FROM (SELECT * FROM latest {order} LIMIT 20)",
        "modified_distribution": f"""{posts} SELECT CAST(year(date_modified) AS BIGINT) AS year,
            CAST(month(date_modified) AS BIGINT) AS month, count(*) AS n_urls FROM posts
          GROUP BY ALL ORDER BY n_urls DESC""",
        "urls_for_month": f"{posts} {urls} WHERE year(date_modified) = 2023 AND month(date_modified) = 8",
        "events_for_month": """SELECT event_type, count(*) AS n_events FROM events
          WHERE year(ts) = 2024 AND month(ts) = 1 GROUP BY event_type""",
        "row_counts": f"{posts} SELECT count(*) AS n_rows FROM posts WHERE {_SOME}",
        "sample_rows": f"""{posts} SELECT {_ARTICLE} FROM (
            SELECT * FROM posts ORDER BY posts.url, posts.date_modified LIMIT 5)""",
        "merge_paragraphs": f"{posts} SELECT doc_id, md5(array_to_string(content, ' ')) AS digest FROM posts",
        "tokenize": r"""SELECT doc_id,
            CAST(len(regexp_extract_all(text, '[ \t\n\f\r]*[^ \t\n\f\r]+')) AS BIGINT) AS n_tokens FROM documents""",
        "chunk_documents": f"""{latest}, {_chunked('latest')} SELECT id, md5(content) AS digest, url,
            {_ts('date_modified')}, author, array_to_string(tags, '|') AS tags FROM chunks""",
        "skip_reason": r"""SELECT CASE WHEN NOT regexp_matches(line,
              '[^\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]')
              THEN 'blank' END AS skip_reason, count(*) AS n_lines
          FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY 1""",
        "embed_chunks": rf"""{latest}, {_chunked('latest')}, words AS (
            SELECT id, unnest(regexp_extract_all(lower(content), '[\p{{L}}\p{{N}}]+')) AS word FROM chunks),
          counts AS (SELECT id, CAST('0x' || left(md5(word), 8) AS BIGINT) % 64 AS slot, count(*) AS n
            FROM words GROUP BY ALL)
          -- Vectors are stored in single precision.
          SELECT id, slot, round(CAST(CAST(n / sqrt(sum(n * n) OVER (PARTITION BY id)) AS FLOAT) AS DOUBLE), 4)
            AS weight FROM counts""",
        "upsert_documents": """SELECT coalesce(page_id, doc_id) AS id, md5(coalesce(html, text)) AS digest
          FROM documents FULL JOIN pages ON page_id = doc_id""",
        "ingest_report": f"""{latest}, {_chunked('latest')},
          totals AS (SELECT count(*) AS fetched, count(*) FILTER (len(content) = 0 OR content IS NULL) AS skipped
            FROM latest),
          made AS (SELECT count(*) AS chunks, count(DISTINCT row_id) AS processed FROM chunks)
          SELECT fetched, processed, CAST(0 AS BIGINT) AS failed, skipped, chunks,
            fetched - processed - skipped AS unaccounted FROM totals CROSS JOIN made""",
        "unaccounted_ids": f"{latest} SELECT {_ROW_ID} AS row_id FROM latest WHERE NOT ({_SOME})",
        "distinct_row_ids": f"{latest}, {_chunked('latest')} SELECT DISTINCT row_id FROM chunks",
        "distinct_row_id_count": f"""{latest}, {_chunked('latest')}
          SELECT count(DISTINCT row_id) AS n_articles FROM chunks""",
        "dense_topk": dense_hits,
        "dense_topk_tiled": dense_hits,
        "bm25_postings": f"""{texts}, asked AS (SELECT 0 AS query_id, '' AS text), {_bm25('texts', 1)}
          SELECT term, id, tf, CAST(doc_length AS BIGINT) AS doc_length FROM postings""",
        "bm25_term_stats": f"""{texts}, asked AS (SELECT 0 AS query_id, '' AS text), {_bm25('texts', 1)}
          SELECT term, df FROM term_stats""",
        "bm25_corpus": f"""{texts}, asked AS (SELECT 0 AS query_id, '' AS text), {_bm25('texts', 1)}
          SELECT n AS n_docs, round(avg_length, 6) AS avg_length FROM corpus""",
        "bm25_topk": bm25,
        "bm25_scan": bm25,
        "bm25_stored_index": bm25,
        "bm25_pruned": bm25,
        "bm25_upserted": bm25.replace(
            "FROM documents)",
            "FROM documents WHERE (doc_id % 7 <> 1 OR doc_id % 3 = 0) AND (doc_id % 7 <> 3 OR doc_id % 6 = 3))",
        ),
        "search_keyword": f"WITH {_ASKED}, {_bm25('texts', 5)} SELECT {_HIT_COLUMNS} FROM lexical",
        "search_contextual": f"WITH {_ASKED}, {_dense('vectors', 'asked', 5)} SELECT {_HIT_COLUMNS} FROM dense",
        "rrf_fuse": f"""WITH {_ASKED}, {_bm25('texts', 20)}, {_dense('vectors', 'asked', 20)}, {_FUSED}
          SELECT {_HIT_COLUMNS} FROM fused WHERE rank <= 10""",
        "hybrid_search": f"""WITH {_ASKED}, {_bm25('texts', 10)}, {_dense('vectors', 'asked', 10)}, {_FUSED}
          SELECT query_id, id, CAST(score AS DOUBLE) AS score, rank, md5(text) AS digest, source AS author
          FROM fused JOIN documents ON doc_id = id WHERE rank <= 5""",
        "dedup_hits_by_url": f"""{posts}, {_chunked('posts')},
          asked AS (SELECT item_id AS query_id, text FROM benchmark), {_bm25('chunks', 10)}
          SELECT query_id, rank, url, author, {_ts('date_published')}, array_to_string(tags, '|') AS tags FROM (
            SELECT lexical.query_id, lexical.rank, chunks.*,
              row_number() OVER (PARTITION BY query_id, url ORDER BY rank) AS rn
            FROM lexical JOIN chunks ON lexical.id = chunks.id) WHERE rn = 1""",
        "failed_report": f"""{latest}, {_chunked('latest')}, refused AS (
            SELECT DISTINCT row_id FROM chunks WHERE md5(content)[1] = '0'),
          totals AS (SELECT count(*) AS fetched, count(*) FILTER (len(content) = 0 OR content IS NULL) AS skipped
            FROM latest),
          made AS (SELECT count(*) AS chunks, count(DISTINCT row_id) AS processed FROM chunks
            WHERE row_id NOT IN (SELECT row_id FROM refused))
          SELECT fetched, processed, (SELECT count(*) FROM refused) AS failed, skipped, chunks,
            CAST(0 AS BIGINT) AS unaccounted FROM totals CROSS JOIN made""",
        "quarantine": f"""{latest}, {_chunked('latest')}, refused AS (
            SELECT DISTINCT row_id FROM chunks WHERE md5(content)[1] = '0')
          SELECT id, CASE WHEN md5(content)[1] = '0' THEN 'ValueError: refused ' || md5(content) END AS failure
          FROM chunks WHERE md5(content)[1] = '0' OR row_id NOT IN (SELECT row_id FROM refused)""",
        "ingest_stream": all_articles,
        "stored_pipeline": rf"""{posts}, {_LINKS}, fresh AS (
            SELECT * EXCLUDE (rn) FROM (
              SELECT *, row_number() OVER (PARTITION BY url ORDER BY date_modified DESC) AS rn
              FROM posts WHERE {_SOME}) WHERE rn = 1)
          SELECT f.url, {_TS.format('f.date_modified')} AS date_modified,
            CAST((SELECT sum(len(regexp_split_to_array(p, '\s+'))) FROM unnest(list_append({_TRIMMED}, alias))
              AS t(p)) AS BIGINT) AS total_content_words, a.link_status
          FROM fresh f JOIN audited a ON a.url = f.url AND a.date_modified = f.date_modified""",
        "changed_layers": rf"""{posts}, {_LINKS}, monthly AS (
            SELECT * EXCLUDE (rn) FROM (
              SELECT *, row_number() OVER (
                PARTITION BY url, date_trunc('month', date_modified) ORDER BY date_modified DESC) AS rn
              FROM posts) WHERE rn = 1)
          SELECT m.url, {_TS.format('m.date_modified')} AS date_modified,
            CAST(coalesce((SELECT sum(len(regexp_split_to_array(p, '\s+'))) FROM unnest(content) AS t(p)), 0)
              AS BIGINT) AS total_content_words, a.link_status
          FROM monthly m JOIN audited a ON a.url = m.url AND a.date_modified = m.date_modified""",
        "backfill_raw": f"""{posts} SELECT url, title, {_ts('date_modified')} FROM posts
          WHERE url <> 'https://blog.example.com/c1/post-1/'""",
        "backfill_progress": f"""{posts} SELECT CAST(year(date_modified) AS BIGINT) AS year,
            CAST(month(date_modified) AS BIGINT) AS month, count(DISTINCT url) AS n_urls,
            count(DISTINCT url) AS n_found
          FROM posts WHERE url <> 'https://blog.example.com/c1/post-1/' GROUP BY ALL""",
        "stored_sitemap": f"{posts} {urls}",
        "stored_collection": f"{latest}, {_chunked('latest')} SELECT id, md5(content) AS digest FROM chunks",
        "ingest_collection": f"{latest}, {_chunked('latest')} SELECT id, md5(content) AS digest FROM chunks",
    }
