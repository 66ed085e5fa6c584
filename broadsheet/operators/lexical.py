"""A lexical index that follows upserts, and a BM25 search that reads a part of its blocks.

The index lies in segments. An upsert counts the terms of its documents where their rows lie and adds
one segment: postings by ``term_bucket`` in blocks of one term and some documents of like length, each
with its largest count and least length, a row for the blocks a term has among the documents a task holds
at once; how the document frequencies and the corpus figures change; and which ids of older segments are gone. Nothing stored before is touched. :func:`merge` joins the newest segments
once they outweigh the one before, so there are about as many as the logarithm of the upserts.

A search opens the buckets of its terms only. The rarest terms of a query lead to documents whose whole
scores tell what the k-th hit has at least. What the heads of the blocks allow rules out groups of
documents. Of the others the rarer terms are read; the frequent ones, which cannot reach a good part of that
score together, only for documents that can still get there. The hits are those of a search that
reads everything.
"""

from __future__ import annotations

from contextlib import contextmanager
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.ranking import Best
from ..functions.text import analyze
from ..session import broadcast_if_small, fits, scratch_path
from .search import (
    BLOCK_CELLS,
    BM25_B,
    BM25_K1,
    DEFAULT_K,
    MAX_QUERY_TERMS,
    SCORE_DIGITS,
    one_row_per_id,
    postings_of,
    query_terms_of,
    term_counts,
    top_k,
)

#: Buckets of a new index; a stored one keeps its own number.
TERM_BUCKETS = 32
#: Documents of a block, as a power of two.
BLOCK_BITS = 3
#: Postings a task that makes blocks holds at once, and rows of terms it passes on at once.
POSTINGS_AT_ONCE, TERMS_AT_ONCE = 2_000_000, 20_000
#: Share of the least score of a hit that terms read last may reach together.
FREQUENT = 0.4
#: Postings of rare terms per hit asked for that lead to the first documents of a query, and how many of
#: the best of those documents per hit get their whole score.
SEED_POSTINGS, SEED_DOCUMENTS = 100, 6
#: Ids of replaced documents that are sent to every task, at most.
MAX_GONE = 2_000_000
#: Blocks looked up for the first documents that are sent to every task, at most.
MAX_WANTED = 1_000_000
#: Rows of terms and blocks a task of a search takes at once.
ROWS_AT_ONCE = 20_000
#: Documents of one partition of such tasks.
DOCUMENTS_AT_ONCE = 8_192
#: Scores nearer than this may be equal at the precision they are ranked at.
MARGIN = 2 * 10.0**-SCORE_DIGITS


class Index(NamedTuple):
    """The live segments of a stored index.

    ``postings(segment, term_bucket, term, block, n, top_tf, least_length, entries)``, ``terms(segment,
    term_bucket, term, df, top_tf, least_length)`` with changes of df, ``corpus(segment, n_docs, total_length)``
    with changes too, ``forward(segment, id, doc_length, terms, tfs, block)``, and ``gone(segment, id)``: ids that
    no older segment holds any more.
    """

    segments: list[int]
    buckets: int
    postings: DataFrame
    terms: DataFrame
    corpus: DataFrame
    forward: DataFrame
    gone: DataFrame


def _bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def _files(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _manifest(spark: SparkSession, path: str) -> tuple[list[int], int]:
    files, at = _files(spark, f"{path}/manifest")
    if not files.exists(at):
        return [], TERM_BUCKETS
    newest = spark.read.parquet(f"{path}/manifest").orderBy(F.desc("version")).first()
    return sorted(newest["segments"]), newest["buckets"]


def live_segments(spark: SparkSession, path: str) -> list[int]:
    """The segments the newest manifest names; none if there is no index."""
    return _manifest(spark, path)[0]


def open_index(spark: SparkSession, path: str) -> Index:
    segments, buckets = _manifest(spark, path)
    if not segments:
        raise ValueError(f"no index in {path}")

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{path}/{name}").filter(F.col("segment").isin(segments))

    postings, *others = (table(name) for name in Index._fields[2:])
    return Index(segments, buckets, _postings(postings, others[2].schema["id"].dataType.simpleString()), *others)


def _live(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """Rows (segment, id) that no newer segment has replaced or deleted."""
    return rows.join(*_replaced(gone), "left_anti")


def _replaced(gone: DataFrame) -> tuple[DataFrame, Column]:
    newer = gone.select(F.col("segment").alias("_newer"), F.col("id").alias("_gone"))
    # Ids are few bytes next to the rows they take out, which need not move then.
    newer = broadcast_if_small(newer, MAX_GONE)
    return newer, (F.col("id") == F.col("_gone")) & (F.col("_newer") > F.col("segment"))


@contextmanager
def _open_files(spark: SparkSession, number: int):
    """Lets a task of a partitioned write hold so many files open."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, str(number))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _write(spark: SparkSession, path: str, segment: int, buckets: int = TERM_BUCKETS, **tables: DataFrame) -> None:
    for name, rows in tables.items():
        if name == "postings":
            # Postings stay where they were made; every task keeps a file per bucket open instead of sorting.
            # A term stands in a file once or a few times, so there is nothing for a dictionary.
            rows = rows.write.mode("overwrite").option("parquet.enable.dictionary", "false")
            with _open_files(spark, buckets):
                rows.partitionBy("term_bucket").parquet(f"{path}/{name}/segment={segment}")
        elif "term_bucket" in rows.columns:
            # A bucket with a frequent term is split, small ones share a file.
            rows = rows.hint("rebalance", "term_bucket").sortWithinPartitions("term_bucket", "term")
            rows.write.mode("overwrite").partitionBy("term_bucket").parquet(f"{path}/{name}/segment={segment}")
        else:
            rows.write.mode("overwrite").parquet(f"{path}/{name}/segment={segment}")


def _publish(spark: SparkSession, path: str, segments: list[int], buckets: int) -> None:
    files, at = _files(spark, f"{path}/manifest")
    last = spark.read.parquet(f"{path}/manifest").agg(F.max("version")).first()[0] if files.exists(at) else 0
    row = spark.createDataFrame([(last + 1, segments, buckets)], "version long, segments array<int>, buckets int")
    row.coalesce(1).write.mode("append").parquet(f"{path}/manifest")


def _next(spark: SparkSession, path: str) -> int:
    """A number above all that were ever published, so a broken run's leftovers are overwritten."""
    files, at = _files(spark, f"{path}/manifest")
    if not files.exists(at):
        return 1
    return spark.read.parquet(f"{path}/manifest").agg(F.max(F.array_max("segments"))).first()[0] + 1


def _by_length(counted: DataFrame) -> DataFrame:
    """Adds ``block``, of documents of one task next to each other by length. Written before it is used."""
    spread = counted.sortWithinPartitions("doc_length", "id")
    return spread.withColumn("block", F.shiftright(F.monotonically_increasing_id(), BLOCK_BITS))


def _last_run(*numbers: np.ndarray) -> int:
    """Where the last stretch of rows with equal numbers begins."""
    if not len(numbers[0]):
        return 0
    other = np.flatnonzero(np.logical_or.reduce([n != n[-1] for n in numbers]))
    return int(other[-1]) + 1 if len(other) else 0


def _packed(numbers: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The numbers from each start to the next one as bytes."""
    offsets = np.r_[starts, len(numbers)] * numbers.itemsize
    buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(numbers))]
    return pa.Array.from_buffers(pa.binary(), len(starts), buffers)


def _unpacked(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a column of bytes, and where each row's end."""
    sizes = np.asarray(pc.binary_length(column)) // np.dtype(kind).itemsize
    return np.frombuffer(b"".join(column.to_pylist()), kind), np.cumsum(sizes)


def _term_rows(docs: pa.Table) -> pa.RecordBatch:
    """The postings of whole blocks, a row per term. Numbers lie as bytes, so a row is a few values to Spark."""
    lists, ids = docs["terms"].combine_chunks(), docs["id"].combine_chunks()
    coded = lists.flatten().dictionary_encode()
    row = np.repeat(np.arange(len(ids)), np.asarray(pc.list_value_length(lists)))
    codes = np.asarray(coded.indices)
    order = np.argsort(codes.astype(np.int64) * max(1, len(ids)) + row)
    row, codes = row[order], codes[order]
    block, length = np.asarray(docs["block"])[row], np.asarray(docs["doc_length"])[row]
    tf = np.asarray(docs["tfs"].combine_chunks().flatten())[order]
    starts = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]]) if len(codes) else np.empty(0, np.int64)
    if pa.types.is_string(ids.type):
        ends = pa.array(np.r_[starts, len(codes)].astype(np.int32))
        names = pa.ListArray.from_arrays(ends, ids.take(pa.array(row)))
    else:
        names = _packed(np.asarray(ids, np.int64)[row], starts)
    return pa.RecordBatch.from_arrays(
        [
            coded.dictionary.take(pa.array(codes[starts])).cast(pa.string()),
            pa.array(np.diff(np.r_[starts, len(codes)]).astype(np.int64)),
            pa.array(np.maximum.reduceat(tf, starts) if len(starts) else tf),
            pa.array(np.minimum.reduceat(length, starts) if len(starts) else length),
            names,
            _packed(block, starts),
            _packed(tf.astype(np.int32), starts),
            _packed(length.astype(np.int32), starts),
        ],
        names=["term", "df", "top_tf", "least_length", "ids", "blocks", "tfs", "lengths"],
    )


def _rows_type(kind: str) -> str:
    ids = "array<string>" if kind == "string" else "binary"
    return (
        f"term string, df bigint, top_tf bigint, least_length bigint, ids {ids}, blocks binary, tfs binary, lengths binary"
    )


def _listed(kind: str):
    """A function of (ids, blocks, tfs, lengths) that lists the blocks of a term's row."""
    entry = f"struct<id:{kind},tf:bigint,doc_length:bigint>"

    @F.arrow_udf(f"array<struct<block:bigint,n:bigint,top_tf:bigint,least_length:bigint,entries:array<{entry}>>>")
    def listed(ids: pa.Array, blocks: pa.Array, tfs: pa.Array, lengths: pa.Array) -> pa.Array:
        (block, ends), tf, length = _unpacked(blocks, "<i8"), _unpacked(tfs, "<i4")[0], _unpacked(lengths, "<i4")[0]
        tf, length = tf.astype(np.int64), length.astype(np.int64)
        if kind == "string":
            names = ids.flatten()
        else:
            names = pa.array(_unpacked(ids, "<i8")[0]).cast(pa.int32() if kind == "int" else pa.int64())
        new = np.zeros(len(block) + 1, bool)
        new[0] = new[ends] = True  # a row per term has one posting at least
        new[1:-1] |= block[1:] != block[:-1]
        starts = np.flatnonzero(new[:-1])
        bounds = np.r_[starts, len(block)].astype(np.int32)
        entries = pa.StructArray.from_arrays(
            [names, pa.array(tf), pa.array(length)], names=["id", "tf", "doc_length"]
        )
        made = pa.StructArray.from_arrays(
            [
                pa.array(block[starts]),
                pa.array(np.diff(bounds).astype(np.int64)),
                pa.array(np.maximum.reduceat(tf, starts) if len(starts) else tf),
                pa.array(np.minimum.reduceat(length, starts) if len(starts) else length),
                pa.ListArray.from_arrays(pa.array(bounds), entries),
            ],
            names=["block", "n", "top_tf", "least_length", "entries"],
        )
        return pa.ListArray.from_arrays(pa.array(np.r_[0, np.searchsorted(starts, ends)].astype(np.int32)), made)

    return listed


def _postings(rows: DataFrame, kind: str) -> DataFrame:
    """Stored rows of terms as a row per block."""
    return rows.select("segment", "term_bucket", "term", F.inline(_listed(kind)("ids", "blocks", "tfs", "lengths")))


def _blocks(forward: DataFrame, buckets: int) -> DataFrame:
    """Postings in blocks of one term and some documents of like length, a row for the blocks a term has among
    the documents a task holds at once.

    The documents of a block follow each other in one file, so blocks are made where they lie. One that a
    reader's split cuts becomes two with its number; a search takes them as one block.
    """

    def cut(batches):
        def rows(table):
            made = _term_rows(table)
            for first in range(0, made.num_rows, TERMS_AT_ONCE):
                yield made.slice(first, TERMS_AT_ONCE)

        held, waiting = [], 0
        for batch in batches:
            held.append(batch)
            waiting += len(batch.column("terms").flatten())
            if waiting >= POSTINGS_AT_ONCE:
                table = pa.Table.from_batches(held)
                whole = _last_run(np.asarray(table["block"]))
                if whole:
                    yield from rows(table.slice(0, whole))
                held = table.slice(whole).to_batches()
                waiting = sum(len(b.column("terms").flatten()) for b in held)
        if held:
            yield from rows(pa.Table.from_batches(held))

    rows = forward.select("id", "doc_length", "terms", "tfs", "block").mapInArrow(
        cut, _rows_type(forward.schema["id"].dataType.simpleString())
    )
    return rows.withColumn("term_bucket", _bucket(F.col("term"), buckets))


def _write_postings(spark: SparkSession, path: str, segment: int, forward: DataFrame, buckets: int) -> DataFrame:
    """Writes the postings of a segment; returns them as they lie, a row for the blocks a term has at one place."""
    _write(spark, path, segment, buckets, postings=_blocks(forward, buckets))
    kind = _rows_type(forward.schema["id"].dataType.simpleString())
    return spark.read.schema(f"{kind}, term_bucket int").parquet(f"{path}/postings/segment={segment}")


def _term_changes(changes: DataFrame, buckets: int) -> DataFrame:
    """Changes of df and the bounds of terms, of (term, df, top_tf, least_length)."""
    return (
        changes.groupBy("term")
        .agg(F.sum("df").alias("df"), F.max("top_tf").alias("top_tf"), F.min("least_length").alias("least_length"))
        .withColumn("term_bucket", _bucket(F.col("term"), buckets))
    )


def _unbounded(terms: DataFrame, df: Column) -> DataFrame:
    """(term, df, top_tf, least_length) that change no bound."""
    none = F.lit(None).cast("bigint")
    return terms.select("term", df.cast("bigint").alias("df"), none.alias("top_tf"), none.alias("least_length"))


def _corpus_changes(new: DataFrame, dead: DataFrame | None) -> DataFrame:
    rows = new.select(F.lit(1).alias("d"), "doc_length")
    if dead is not None:
        rows = rows.union(dead.select(F.lit(-1), -F.col("doc_length")))
    zero = F.lit(0).cast("bigint")
    return rows.agg(
        F.coalesce(F.sum("d"), zero).alias("n_docs"), F.coalesce(F.sum("doc_length"), zero).alias("total_length")
    )


def upsert(
    documents: DataFrame,
    path: str,
    deleted: DataFrame | None = None,
    id_col: str = "id",
    text_col: str = "content",
    analyzer=analyze,
) -> int:
    """Adds one segment with ``documents``, which replace those of the same id; returns its number.

    ``deleted`` has ids that go; one that is also upserted stays with its new text. Ids the index does not
    hold are no error. Rows that repeat an id are one document, rows without id are left out, one
    without text counts with length 0. The index is what it was until the manifest is written last.
    """
    spark = documents.sparkSession
    segment, (segments, buckets) = _next(spark, path), _manifest(spark, path)
    texts = one_row_per_id(documents.filter(F.col(id_col).isNotNull()), id_col, text_col)
    _write(spark, path, segment, forward=_by_length(term_counts(texts, analyzer(F.col("_text")))))
    forward = spark.read.parquet(f"{path}/forward/segment={segment}")
    ids = forward.select("id")
    if deleted is not None:
        ids = ids.union(deleted.select(F.col(deleted.columns[0]).alias("id"))).distinct()
    if segments:
        index = open_index(spark, path)
        dead = _live(index.forward, index.gone).join(ids, "id", "left_semi")
        _write(spark, path, segment, gone=dead.select("id"))
        # Counted before and after the ids are known to be gone, from one stored list.
        gone = broadcast_if_small(spark.read.parquet(f"{path}/gone/segment={segment}"), MAX_GONE)
        dead = _live(index.forward, index.gone).join(gone, "id", "left_semi")
    else:
        dead = None
        _write(spark, path, segment, gone=ids.limit(0))
    changes = _write_postings(spark, path, segment, forward, buckets).select("term", "df", "top_tf", "least_length")
    if dead is not None:
        changes = changes.union(_unbounded(dead.select(F.explode("terms").alias("term")), F.lit(-1)))
    _write(
        spark,
        path,
        segment,
        buckets,
        terms=_term_changes(changes, buckets),
        corpus=_corpus_changes(forward, dead),
    )
    _publish(spark, path, [*segments, segment], buckets)
    return segment


def merge(spark: SparkSession, path: str, ratio: float = 1.0) -> list[int]:
    """Joins the newest segments as long as they outweigh the one before ``ratio`` times; returns the live ones.

    Only the newest lie next to each other, so what they tell to be gone still counts for all older ones.
    """
    segments = live_segments(spark, path)
    if len(segments) < 2:
        return segments
    index = open_index(spark, path)
    sizes = {r["segment"]: r["n"] for r in index.forward.groupBy("segment").agg(F.count(F.lit(1)).alias("n")).collect()}
    first, held = len(segments) - 1, sizes.get(segments[-1], 0)
    while first and sizes.get(segments[first - 1], 0) <= ratio * held:
        first -= 1
        held += sizes.get(segments[first], 0)
    joined = segments[first:]
    if len(joined) < 2:
        return segments
    number = _next(spark, path)
    of = lambda df: df.filter(F.col("segment").isin(joined))
    _write(spark, path, number, forward=_by_length(_live(of(index.forward), of(index.gone)).drop("segment", "block")))
    forward = spark.read.parquet(f"{path}/forward/segment={number}")
    postings = _write_postings(spark, path, number, forward, index.buckets)
    bounds = postings.select("term", F.lit(0).cast("bigint").alias("df"), "top_tf", "least_length")
    changes = _unbounded(of(index.terms), F.col("df")).union(bounds)
    zero = F.lit(0).cast("bigint")
    _write(
        spark,
        path,
        number,
        index.buckets,
        terms=_term_changes(changes, index.buckets),
        corpus=of(index.corpus).agg(
            F.coalesce(F.sum("n_docs"), zero).alias("n_docs"), F.coalesce(F.sum("total_length"), zero).alias("total_length")
        ),
        # What is gone from segments that stay; ids of the joined ones do no harm there.
        gone=of(index.gone).select("id").distinct() if first else of(index.gone).select("id").limit(0),
    )
    live = [*segments[:first], number]
    _publish(spark, path, live, index.buckets)
    return live


class Found(NamedTuple):
    """``hits(query_id, id, score, rank)``; ``read(query_id, step, n_blocks)`` and ``held(query_id, n_blocks)``:
    blocks a query read in each step, and all blocks of its terms."""

    hits: DataFrame
    read: DataFrame
    held: DataFrame


class _Asked(NamedTuple):
    """What a task knows of a query: its terms by number, the rarer ones and the frequent ones."""

    rare: np.ndarray
    rare_weights: np.ndarray
    frequent: np.ndarray
    frequent_weights: np.ndarray
    floor: float
    rest: float


def _asked_of(table: pa.Table) -> tuple[pa.Array, pa.Array, list[_Asked]]:
    """The distinct terms and queries of (query_id, term, weight, ceiling, floor, frequent), and each query's own."""
    terms, queries = (table[c].combine_chunks().dictionary_encode() for c in ("term", "query_id"))
    number, query = np.asarray(terms.indices), np.asarray(queries.indices)
    weight, ceiling, floor = (np.asarray(table[c], np.float64) for c in ("weight", "ceiling", "floor"))
    frequent = np.asarray(table["frequent"], bool)
    order = np.argsort(query, kind="stable")
    asked = []
    for rows in np.split(order, np.flatnonzero(np.diff(query[order])) + 1) if len(order) else []:
        often, seldom = rows[frequent[rows]], rows[~frequent[rows]]
        asked.append(
            _Asked(number[seldom], weight[seldom], number[often], weight[often], floor[rows[0]], ceiling[often].sum())
        )
    return terms.dictionary, queries.dictionary, asked


def _of_few_terms(blocks: DataFrame, terms: DataFrame) -> DataFrame:
    """The blocks of terms that every task can hold. Rows of other terms go before their blocks are listed."""
    return blocks.join(F.broadcast(terms.select("term").distinct()), "term", "left_semi")


def _best_of_blocks(
    blocks: DataFrame,
    dead: DataFrame | None,
    terms: DataFrame,
    k: int,
    k1: float,
    b: float,
    mean_length: float,
    n_tasks: int,
) -> DataFrame:
    """(query_id, id, score, step, n_blocks): the best ``k`` documents per query and task, without ``step``, and
    how many blocks a query read in each step.

    The blocks of the terms meet by their documents, each once whatever the number of queries. A query looks into
    those of a group of documents if the heads allow a hit: its rarer terms first, the frequent ones for
    documents that can still be hits.
    """
    words, queries, asked = _asked_of(terms.toArrow())  # the caller bounds its rows
    n_words, kind = len(words), blocks.schema["entries"].dataType.elementType["id"].dataType.simpleString()
    numbers = pa.table({"term": words.cast(pa.string()), "number": pa.array(np.arange(n_words), pa.int32())})
    names = pa.table({"query": pa.array(np.arange(len(queries)), pa.int32()), "query_id": queries})
    spark = blocks.sparkSession
    numbered = F.broadcast(spark.createDataFrame(numbers))
    rows = _of_few_terms(blocks, numbered).join(numbered, "term").select(
        "segment",
        "block",
        "number",
        F.col("top_tf").cast("int").alias("top_tf"),
        F.col("least_length").cast("int").alias("least_length"),
        F.col("entries.id").alias("ids"),
        F.col("entries.tf").cast("array<int>").alias("tfs"),
        F.col("entries.doc_length").cast("array<int>").alias("lengths"),
    )
    if dead is not None:
        one = F.lit(1)
        rows = rows.union(
            dead.select("segment", "block", F.lit(-1), one, one, F.array("id"), F.array(one), F.array(one))
        )

    def impact(tf: np.ndarray, length: np.ndarray) -> np.ndarray:
        return tf * (k1 + 1.0) / (tf + k1 * (1.0 - b + b * length / mean_length))

    def look(table: pa.Table, best: Best, read: np.ndarray) -> None:
        """Whole groups of documents, in order."""
        segment, number_of = np.asarray(table["segment"]), np.asarray(table["block"])
        group = np.cumsum(np.r_[0, (segment[1:] != segment[:-1]) | (number_of[1:] != number_of[:-1])])
        word = np.asarray(table["number"])
        lists = table["ids"].combine_chunks()
        row = np.repeat(np.arange(len(word)), np.asarray(pc.list_value_length(lists)))
        coded = lists.flatten().dictionary_encode()
        names_of = np.array(coded.dictionary.to_pylist(), dtype=object)
        documents, document = np.unique(
            group[row] * max(1, len(names_of)) + np.asarray(coded.indices), return_inverse=True
        )
        home, ids = documents // max(1, len(names_of)), names_of[documents % max(1, len(names_of))]
        live = np.ones(len(documents), bool)
        live[document[word[row] < 0]] = False
        present = np.unique(word[word >= 0])
        column = np.full(n_words + 1, len(present))  # terms that are not here share an empty column
        column[present] = np.arange(len(present))
        heads = np.zeros((group[-1] + 1, len(present) + 1))
        known = np.flatnonzero(word >= 0)
        most = impact(np.asarray(table["top_tf"], np.float64), np.asarray(table["least_length"], np.float64))
        np.maximum.at(heads, (group[known], column[word[known]]), most[known])
        parts = np.zeros((len(documents), len(present) + 1))
        tf, length = (np.asarray(table[c].combine_chunks().flatten(), np.float64) for c in ("tfs", "lengths"))
        known = np.flatnonzero(word[row] >= 0)
        parts[document[known], column[word[row[known]]]] = impact(tf[known], length[known])
        for query, own in enumerate(asked):
            rare, often = column[own.rare], column[own.frequent]
            top = heads[:, rare]
            limit = top @ own.rare_weights + heads[:, often] @ own.frequent_weights
            able = (limit > 0) & (limit + MARGIN >= own.floor)
            if not able.any():
                continue
            read[0, query] += np.count_nonzero(top[able])
            at = np.flatnonzero(able[home] & live)
            score = parts[np.ix_(at, rare)] @ own.rare_weights
            near = score + own.rest + MARGIN >= max(own.floor, best.floor[query])
            at, score = at[near], score[near]
            if len(often) and len(at):
                read[1, query] += np.count_nonzero(heads[np.ix_(np.unique(home[at]), often)])
                score = score + parts[np.ix_(at, often)] @ own.frequent_weights
            hit = score > 0
            best.offer(query, ids[at[hit]], np.round(score[hit], SCORE_DIGITS))

    def scan(batches):
        best, read = Best(len(asked), k), np.zeros((2, len(asked)), np.int64)
        schema, held, waiting = None, [], 0

        def bounded(table: pa.Table):
            """Parts of whole groups whose matrices have a bounded size."""
            words_here = len(pc.unique(table["number"])) + 1
            size = max(1, BLOCK_CELLS // (words_here << BLOCK_BITS))
            segment, number_of = np.asarray(table["segment"]), np.asarray(table["block"])
            new = np.flatnonzero((segment[1:] != segment[:-1]) | (number_of[1:] != number_of[:-1])) + 1
            cuts = np.r_[0, new[size - 1 :: size], table.num_rows]
            for first, last in zip(cuts[:-1], cuts[1:]):
                if last > first:
                    yield table.slice(first, last - first)

        for batch in batches:
            schema = batch.schema
            held.append(batch)
            waiting += batch.num_rows
            if waiting >= ROWS_AT_ONCE:
                table = pa.Table.from_batches(held)
                whole = _last_run(np.asarray(table["segment"]), np.asarray(table["block"]))
                for piece in bounded(table.slice(0, whole)):
                    look(piece, best, read)
                held, waiting = table.slice(whole).to_batches(), 0
        if held:
            for piece in bounded(pa.Table.from_batches(held)):
                look(piece, best, read)
        if schema is None:
            return
        id_type = schema.field("ids").type.value_type
        found = best.table(
            np.arange(len(asked)), pa.schema([("query", pa.int32()), ("id", id_type), ("score", pa.float64())])
        )
        n, m = found.num_rows, 2 * len(asked)
        yield pa.RecordBatch.from_arrays(
            [
                pa.concat_arrays([found.column(0), pa.array(np.tile(np.arange(len(asked)), 2), pa.int32())]),
                pa.concat_arrays([found.column(1), pa.nulls(m, id_type)]),
                pa.concat_arrays([found.column(2), pa.nulls(m, pa.float64())]),
                pa.concat_arrays([pa.nulls(n, pa.int32()), pa.array(np.repeat([3, 4], len(asked)), pa.int32())]),
                pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(read.ravel(), pa.int64())]),
            ],
            names=["query", "id", "score", "step", "n_blocks"],
        )

    met = rows.repartition(n_tasks, "segment", "block").sortWithinPartitions("segment", "block", "number")
    found = met.mapInArrow(scan, f"query int, id {kind}, score double, step int, n_blocks bigint")
    return found.join(F.broadcast(spark.createDataFrame(names)), "query").select(
        "query_id", "id", "score", "step", "n_blocks"
    )


def pruned_topk(
    index: Index,
    queries: DataFrame,
    k: int = DEFAULT_K,
    query_id_col: str = "query_id",
    query_text_col: str = "text",
    analyzer=analyze,
    k1: float = BM25_K1,
    b: float = BM25_B,
) -> Found:
    """The ``k`` best documents per query by BM25, the same as :func:`..search.bm25_topk` finds.

    A query without a known term has no hits; queries may be many, their terms are collected in parts of bounded size.
    """
    spark = queries.sparkSession
    base, made = scratch_path(spark, "lexical"), iter(range(99))

    def stored(df: DataFrame) -> DataFrame:
        path = f"{base}/{next(made)}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    figures = index.corpus.agg(F.sum("n_docs"), F.sum("total_length")).first()
    n_docs, mean_length = figures[0], (figures[1] or 0) / max(1, figures[0]) or 1.0

    def impact(tf: Column, length: Column) -> Column:
        return tf * (k1 + 1.0) / (tf + k1 * (1.0 - b + b * length / F.lit(mean_length)))

    asked = query_terms_of(queries, query_id_col, query_text_col, analyzer)
    asked = stored(asked.withColumn("term_bucket", _bucket(F.col("term"), index.buckets)))
    # At most as many numbers as buckets; as literals they choose folders.
    buckets = [r[0] for r in asked.select("term_bucket").distinct().collect()]
    inside = F.col("term_bucket").isin(buckets)
    figures = (
        index.terms.filter(inside)
        .join(asked.select("term").distinct(), "term", "left_semi")
        .groupBy("term")
        .agg(F.sum("df").alias("df"), F.max("top_tf").alias("top_tf"), F.min("least_length").alias("least_length"))
        .filter(F.col("df") > 0)
    )
    idf = F.log1p((n_docs - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighted = asked.join(figures, "term").withColumn("weight", idf * F.col("query_tf"))
    ceiling = F.col("weight") * impact(F.col("top_tf"), F.col("least_length"))
    rarest, least = W.partitionBy("query_id").orderBy("df", "term"), W.partitionBy("query_id").orderBy("ceiling", "term")
    before = F.coalesce(F.sum("df").over(rarest.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    weighted = stored(
        weighted.select("query_id", "term", "term_bucket", "weight", "df", ceiling.alias("ceiling"))
        .withColumn("before", before)
        .withColumn("below", F.sum("ceiling").over(least.rowsBetween(W.unboundedPreceding, 0)))
    )
    blocks = index.postings.filter(inside)
    # Terms that every task can hold: the others' rows go before their blocks are listed.
    chosen = (lambda terms: _of_few_terms(blocks, terms)) if fits(weighted, MAX_QUERY_TERMS) else (lambda terms: blocks)
    gone = stored(index.gone.select("segment", "id"))
    live = (lambda rows: rows) if gone.isEmpty() else (lambda rows: _live(rows, gone))

    def scored(rows: DataFrame) -> DataFrame:
        """(query_id, id, segment, block, part) of blocks with the weight of their query's term."""
        entry = rows.select("query_id", "segment", "block", "weight", F.explode("entries").alias("e"))
        part = F.col("weight") * impact(F.col("e.tf"), F.col("e.doc_length"))
        return live(entry.select("query_id", F.col("e.id").alias("id"), "segment", "block", part.alias("part")))

    def of_terms(terms: DataFrame) -> DataFrame:
        """The blocks of the terms, each once for every query that has it."""
        return chosen(terms).join(terms.drop("term_bucket"), "term")

    def kth(scores: DataFrame) -> DataFrame:
        """(query_id, floor): what the k-th hit has at least, of queries with so many scores."""
        best = top_k(scores, k).groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("floor"))
        return best.filter(F.col("n") >= k).select("query_id", "floor")

    def added(rows: DataFrame) -> DataFrame:
        return rows.groupBy("query_id", "id", "segment", "block").agg(F.sum("part").alias("score"))

    def whole(rows: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The blocks of other terms in which documents stand, and all parts of those documents' scores."""
        places = found.select("query_id", "segment", "block").distinct()
        wanted = stored(rows.select("query_id", "term", "weight").join(places, "query_id"))
        wanted = broadcast_if_small(wanted, MAX_WANTED)  # else all blocks move
        read = chosen(rows).join(wanted, ["term", "segment", "block"])
        few = found.select("query_id", "id")
        parts = scored(read).join(few, ["query_id", "id"], "left_semi").select("query_id", "id", "part")
        return read, found.select("query_id", "id", F.col("score").alias("part")).union(parts)

    def summed(parts: DataFrame) -> DataFrame:
        return parts.groupBy("query_id", "id").agg(F.round(F.sum("part"), SCORE_DIGITS).alias("score"))

    # 1. Of the best documents by the rarest terms, the whole scores.
    first = F.col("before") < SEED_POSTINGS * k
    seeds = of_terms(weighted.filter(first))
    best = stored(top_k(added(scored(seeds)), SEED_DOCUMENTS * k).drop("rank"))
    others, parts = whole(weighted.filter(~first), best)
    floors = stored(kth(summed(parts)))
    known = stored(weighted.join(floors, "query_id", "left").fillna(0.0, ["floor"]))
    # 2. to 4. In the tasks that gather the blocks of the same documents, each block once for all queries.
    frequent = F.col("below") + MARGIN < FREQUENT * F.col("floor")
    terms = known.filter(F.col("query_id").isNotNull()).select(
        "query_id", "term", "weight", "ceiling", "floor", frequent.alias("frequent")
    )
    n_terms = terms.count()
    n_parts = 1 if n_terms <= MAX_QUERY_TERMS else 2 * n_terms // MAX_QUERY_TERMS + 1
    part = F.pmod(F.xxhash64("query_id"), F.lit(n_parts))
    n_tasks = max(spark.sparkContext.defaultParallelism, n_docs // DOCUMENTS_AT_ONCE)
    dead = None if gone.isEmpty() else index.forward.select("segment", "block", "id").join(*_replaced(gone), "left_semi")
    passes = [
        _best_of_blocks(blocks, dead, terms.filter(part == i), k, k1, b, mean_length, n_tasks) for i in range(n_parts)
    ]
    best = stored(reduce(DataFrame.union, passes))
    hits = top_k(best.filter("step IS NULL").select("query_id", "id", "score"), k)
    steps = best.filter("n_blocks > 0").groupBy("query_id", "step").agg(F.sum("n_blocks").alias("n_blocks"))

    def counted(rows: DataFrame, step: int) -> DataFrame:
        return rows.groupBy("query_id").agg(F.lit(step).alias("step"), F.count(F.lit(1)).alias("n_blocks"))

    read = counted(seeds, 1).union(counted(others, 2)).union(steps)
    held = of_terms(weighted).groupBy("query_id").agg(F.count(F.lit(1)).alias("n_blocks"))
    return Found(hits.select("query_id", "id", "score", "rank"), read, held)
