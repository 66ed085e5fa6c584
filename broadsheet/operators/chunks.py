"""Gold articles to searchable chunk documents."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as X
from ..schemas import CHUNK_DOCUMENTS, QUARANTINE
from ..session import broadcast_if_small

# Tokens per chunk and tokens shared with the next chunk.
CHUNK_SIZE, CHUNK_OVERLAP = 400, 50


def with_skip_reason(articles: DataFrame, content_col: str = "content") -> DataFrame:
    """Adds ``skip_reason``: ``missing`` or ``blank`` content, NULL for articles to process."""
    content = F.col(content_col)
    reason = F.when(content.isNull() | (F.size(content) == 0), "missing").when(
        X.is_blank(X.merge_paragraphs(content)), "blank"
    )
    return articles.withColumn("skip_reason", reason)


def skip_blank(
    articles: DataFrame, content_col: str = "content"
) -> tuple[DataFrame, DataFrame]:
    """Articles to process, and the skipped ones with ``skip_reason``."""
    marked = with_skip_reason(articles, content_col)
    return (
        marked.filter(F.col("skip_reason").isNull()).drop("skip_reason"),
        marked.filter(F.col("skip_reason").isNotNull()),
    )


def _check_sizes(size: int, overlap: int) -> None:
    if size < 1 or not 0 <= overlap < size:
        raise ValueError(f"need 0 <= overlap < size, got size {size} and overlap {overlap}")


def chunk_tokens(
    articles: DataFrame,
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    content_col: str = "content",
    tokenizer: Callable[[Column], Column] = X.tokenize,
) -> DataFrame:
    """One row per window of ``size`` tokens, with ``chunk_no`` and ``chunk``.

    Windows start every ``size - overlap`` tokens while tokens are left, so the last one may
    hold only overlap. ``tokenizer`` gives tokens whose concatenation is the text. Narrow:
    an article is cut where it is read.
    """
    _check_sizes(size, overlap)
    tokens = articles.withColumn("_tokens", tokenizer(X.merge_paragraphs(F.col(content_col))))
    starts = F.sequence(F.lit(0), F.size("_tokens") - 1, F.lit(size - overlap))
    windows = F.when(
        F.size("_tokens") > 0,
        F.transform(starts, lambda i: F.array_join(F.slice("_tokens", i + 1, F.lit(size)), "")),
    )
    # The outer form: with the plain one Spark infers a test of the array, which would cut
    # every text a second time.
    cut = tokens.select(
        *[F.col(f"`{c}`") for c in articles.columns],
        F.posexplode_outer(windows).alias("chunk_no", "chunk"),
    )
    return cut.filter(F.col("chunk") != "")


class Codec(Protocol):
    """An encoder of texts to token ids and back, made anew in each Python worker."""

    def encode(self, text: str) -> list[int]: ...

    def decode(self, ids: list[int]) -> str: ...


def chunk_encoded(
    articles: DataFrame,
    make_codec: Callable[[], Codec],
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    content_col: str = "content",
) -> DataFrame:
    """As ``chunk_tokens`` but over the ids of an encoder, such as a byte-pair one.

    ``make_codec`` returns anything with ``encode`` and ``decode``; whole texts are encoded.
    """
    _check_sizes(size, overlap)

    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = make_codec()
        for texts in batches:
            rows = []
            for text in texts.to_pylist():
                ids = codec.encode(text or "")
                starts = range(0, len(ids), size - overlap)
                rows.append([codec.decode(ids[i : i + size]) for i in starts])
            yield pa.array(rows, pa.list_(pa.string()))

    # Annotations are texts in this module; the batch function needs the types themselves.
    cut.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    windows = F.arrow_udf(cut, "array<string>")(X.merge_paragraphs(F.col(content_col)))
    pieces = articles.withColumn("_windows", windows).select(
        *[F.col(f"`{c}`") for c in articles.columns],
        F.posexplode_outer("_windows").alias("chunk_no", "chunk"),
    )
    return pieces.filter(F.col("chunk") != "")


def build_chunk_documents(chunks: DataFrame) -> DataFrame:
    """Chunk rows to documents: id, content and metadata of the article."""
    stamp = X.as_utc_text
    return chunks.select(
        F.concat_ws("_", F.col("row_id"), F.col("chunk_no").cast("string")).alias("id"),
        F.col("chunk").alias("content"),
        F.struct(
            "row_id",
            "url",
            stamp(F.col("date_published")).alias("date_published"),
            stamp(F.col("date_modified")).alias("date_modified"),
            "title",
            "author",
            "tags",
        ).alias("metadata"),
    )


Embed = Callable[[list[str]], np.ndarray]


def embed_chunks(
    documents: DataFrame, embed: Embed, dimension: int, content_col: str = "content"
) -> DataFrame:
    """Adds ``dense_vector`` from a function of a batch of texts.

    A result of another shape fails the task with both shapes in the message.
    """

    def run(texts: pa.Array) -> pa.Array:
        values = texts.to_pylist()
        vectors = np.asarray(embed([v or "" for v in values]), dtype=np.float32)
        if vectors.shape != (len(values), dimension):
            raise ValueError(
                f"expected vectors of shape {(len(values), dimension)}, got {vectors.shape}"
            )
        offsets = np.arange(0, (len(values) + 1) * dimension, dimension, dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(vectors.ravel()))

    run.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return documents.withColumn(
        "dense_vector", F.arrow_udf(run, "array<float>")(F.col(content_col))
    )


def _embed_parts(texts: list[str], embed: Embed, dimension: int) -> tuple[list, list]:
    """Per text its vector or the reason it has none; failing parts of the batch are halved."""
    vectors, reasons = [None] * len(texts), [None] * len(texts)
    parts = [(0, len(texts))] if texts else []
    while parts:
        first, last = parts.pop()
        try:
            found = embed(texts[first:last])
        except Exception as error:  # whatever the function of the caller may raise
            if last - first == 1:
                reasons[first] = f"{type(error).__name__}: {error}"
            else:
                middle = (first + last) // 2
                parts += [(middle, last), (first, middle)]
            continue
        found = np.asarray(found, dtype=np.float32)
        if found.shape != (last - first, dimension):
            raise ValueError(
                f"expected vectors of shape {(last - first, dimension)}, got {found.shape}"
            )
        finite = np.isfinite(found).all(axis=1)
        for place in range(first, last):
            if finite[place - first]:
                vectors[place] = found[place - first]
            else:
                reasons[place] = "vector with a number that is not finite"
    return vectors, reasons


def embed_apart(
    documents: DataFrame, embed: Embed, dimension: int, content_col: str = "content"
) -> DataFrame:
    """Adds ``dense_vector`` and ``failure``, of which one is NULL.

    A batch the function refuses is halved until the failing texts stand alone, so one bad text
    costs two calls per halving and no other text its vector. A NULL text counts as an empty
    one. Vectors of another shape are no matter of a text: they fail the task.
    """

    def run(texts: pa.Array) -> pa.Array:
        values = [v or "" for v in texts.to_pylist()]
        vectors, reasons = _embed_parts(values, embed, dimension)
        lists = pa.array(vectors, pa.list_(pa.float32()))
        return pa.StructArray.from_arrays(
            [lists, pa.array(reasons, pa.string())], ["dense_vector", "failure"]
        )

    run.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    answer = F.arrow_udf(run, "struct<dense_vector:array<float>,failure:string>")
    answered = documents.withColumn("_answer", answer(F.col(content_col)))
    kept = [F.col(f"`{c}`") for c in documents.columns if c not in ("dense_vector", "failure")]
    return answered.select(*kept, "_answer.dense_vector", "_answer.failure")


def set_failed_apart(embedded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents of articles whose every chunk has a vector, and the failing chunks.

    An article counts as a whole: without one of its chunks none of the others is kept.
    """
    failing = embedded.filter(F.col("failure").isNotNull())
    failed = failing.select(F.col("metadata.row_id").alias("_failed")).distinct()
    whole = embedded.join(
        broadcast_if_small(failed),
        F.col("metadata.row_id").eqNullSafe(F.col("_failed")),
        "left_anti",
    )
    stamp = F.to_timestamp("metadata.date_modified").alias("date_modified")
    quarantine = failing.select("id", "metadata.row_id", "content", "failure", stamp)
    return whole.drop("failure"), quarantine.select(*QUARANTINE.fieldNames())


def hashing_embedder(dimension: int) -> Embed:
    """Deterministic stand-in for an embedding service: hashed word counts at unit length."""

    def embed(texts: list[str]) -> np.ndarray:
        vectors = np.zeros((len(texts), dimension))
        slots: dict[str, int] = {}
        for row, text in enumerate(texts):
            for word in re.findall(r"[^\W_]+", text.lower()):
                if word not in slots:
                    digest = hashlib.md5(word.encode("utf-8")).hexdigest()
                    slots[word] = int(digest[:8], 16) % dimension
                vectors[row, slots[word]] += 1.0
        norms = np.linalg.norm(vectors, axis=1, keepdims=True)
        return vectors / np.where(norms == 0, 1.0, norms)

    return embed


def upsert_documents(main: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """Inserts documents or replaces those with the same id."""
    ranked = new.withColumn(
        "_rn", F.row_number().over(W.partitionBy(key).orderBy(X.tie_break(new.columns)))
    )
    unique = ranked.filter(F.col("_rn") == 1).drop("_rn")
    # A small batch is sent to the stored documents, which then need no shuffle.
    replaced = broadcast_if_small(new.select(key).distinct())
    return main.join(replaced, key, "left_anti").unionByName(unique)


def distinct_row_ids(documents: DataFrame) -> DataFrame:
    """Articles present among the documents, all of them.

    ``metadata`` may be a struct or JSON text; unreadable JSON and empty ids are left out.
    """
    return _row_ids(documents).distinct()


def _row_ids(documents: DataFrame) -> DataFrame:
    kind = documents.schema["metadata"].dataType.typeName()
    found = (
        F.get_json_object("metadata", "$.row_id") if kind == "string" else F.col("metadata.row_id")
    )
    return documents.select(found.alias("row_id")).filter(F.col("row_id") != "")


def distinct_row_id_count(documents: DataFrame, approximate: bool = False) -> DataFrame:
    if not approximate:
        return distinct_row_ids(documents).agg(F.count(F.lit(1)).alias("n_articles"))
    return _row_ids(documents).agg(F.approx_count_distinct("row_id").alias("n_articles"))


def _accounts(articles: DataFrame, documents: DataFrame, skipped: DataFrame, failed) -> DataFrame:
    """Per article id: where it turned up and how many chunks it has."""
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")

    def marked(df: DataFrame, id_col: Column, what: str) -> DataFrame:
        flags = [(one if f == what else zero).alias(f) for f in ("fetched", "chunks", "skipped", "failed")]
        return df.select(id_col.alias("row_id"), *flags)

    parts = [
        marked(articles, F.col("row_id"), "fetched"),
        marked(documents, F.col("metadata.row_id"), "chunks"),
        marked(skipped, F.col("row_id"), "skipped"),
    ]
    if failed is not None:
        parts.append(marked(failed, F.col("row_id"), "failed"))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows.groupBy("row_id").agg(
        *[F.sum(c).alias(c) for c in ("fetched", "chunks", "skipped", "failed")]
    ).filter(F.col("fetched") > 0)


def unaccounted_ids(
    articles: DataFrame,
    documents: DataFrame,
    skipped: DataFrame,
    failed: DataFrame | None = None,
) -> DataFrame:
    """Fetched articles that are neither among the documents nor skipped nor failed."""
    accounts = _accounts(articles, documents, skipped, failed)
    return accounts.filter("chunks = 0 AND skipped = 0 AND failed = 0").select("row_id")


def ingest_report(
    articles: DataFrame,
    documents: DataFrame,
    skipped: DataFrame,
    failed: DataFrame | None = None,
) -> DataFrame:
    """One row: articles fetched, processed, failed, skipped and unaccounted for, and chunks.

    ``failed`` has a ``row_id`` per failing chunk or article, such as the quarantine has.
    One aggregation by article id over the four inputs; partial sums keep it small.
    """
    accounts = _accounts(articles, documents, skipped, failed)
    return accounts.agg(
        F.count(F.lit(1)).alias("fetched"),
        F.count_if(F.col("chunks") > 0).alias("processed"),
        F.count_if(F.col("failed") > 0).alias("failed"),
        F.count_if(F.col("skipped") > 0).alias("skipped"),
        F.coalesce(F.sum("chunks"), F.lit(0)).alias("chunks"),
        F.count_if((F.col("chunks") == 0) & (F.col("skipped") == 0) & (F.col("failed") == 0)).alias(
            "unaccounted"
        ),
    )


def chunk_articles(
    articles: DataFrame,
    embed: Embed | None = None,
    dimension: int = 0,
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
) -> DataFrame:
    """Articles with content to documents, embedded when a function is given."""
    usable, _ = skip_blank(articles)
    documents = build_chunk_documents(chunk_tokens(usable, size, overlap))
    if embed is None:
        return documents
    return embed_chunks(documents, embed, dimension).select(*CHUNK_DOCUMENTS.fieldNames())
