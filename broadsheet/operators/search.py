"""Dense, lexical and hybrid search. Queries are a table, so one job answers many of them."""

from __future__ import annotations

import math
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.ranking import Best, distances, matrix, signatures, term_cells, unit
from ..functions.text import analyze
from ..session import broadcast_if_small, fits

# BM25 parameters, the rank constant of the fusion, results per search and on
# the dashboard, and how many more than asked for each branch of a hybrid search fetches.
BM25_K1, BM25_B = 1.2, 0.75
RRF_K0 = 100
DEFAULT_K, DASHBOARD_K = 10, 5
OVERFETCH = 2

# Scores are ranked at this precision: sums differ in the last bits between partitionings.
SCORE_DIGITS = 6

# A query block sent to every task has at most so many rows; beyond it both sides are tiled.
MAX_BROADCAST_QUERIES = 4096
MAX_QUERY_TERMS = 200_000
# Cells of one dense matrix in a task, 8 bytes each.
BLOCK_CELLS = 4_000_000
TILE_ROWS = 16_384

# Approximate search: documents probed per hit asked for, and the share of true hits it may miss.
PROBED = 8
MISSED = 0.02


def top_k(hits: DataFrame, k: int, by: Column | None = None) -> DataFrame:
    """The best ``k`` hits per query with ``rank``; ties go to the smaller id.

    Each task keeps its own best ``k`` before the shuffle, so a query with very many hits
    does not gather them in one place.
    """
    order = F.desc("score") if by is None else by
    best_first = W.partitionBy("query_id").orderBy(order, F.col("id"))
    return hits.withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= k)


# --- dense ---------------------------------------------------------------------------------


def _usable(df: DataFrame, id_col: str, vector_col: str, dimension: int, name: str) -> DataFrame:
    return df.filter(F.array_size(vector_col) == dimension).select(
        F.col(id_col).alias(name), F.col(vector_col).cast("array<float>").alias("vector")
    )


def _arrow_type(df: DataFrame, column: str) -> pa.DataType:
    kind = df.schema[column].dataType.simpleString()
    types = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
    if kind not in types:
        raise TypeError(f"{column} is {kind}; ids are strings or integers")
    return types[kind]


def _hit_types(documents: DataFrame, queries: DataFrame) -> tuple[pa.Schema, str]:
    schema = pa.schema(
        [
            ("query_id", _arrow_type(queries, "query_id")),
            ("id", _arrow_type(documents, "id")),
            ("score", pa.float64()),
        ]
    )
    ddl = (
        f"query_id {queries.schema['query_id'].dataType.simpleString()}, "
        f"id {documents.schema['id'].dataType.simpleString()}, score double"
    )
    return schema, ddl


def _dense_by_block(documents: DataFrame, queries: DataFrame, k: int, dimension: int) -> DataFrame:
    """Scan the documents once against a block of queries every task holds."""
    schema, ddl = _hit_types(documents, queries)
    block = queries.toArrow()  # its size was checked by the caller
    query_ids = np.array(block["query_id"].to_pylist(), dtype=object)
    asked = unit(matrix(block["vector"], dimension)).T
    rows_at_once = max(1, BLOCK_CELLS // max(1, len(query_ids)))

    def scan(batches):
        best = Best(len(query_ids), k)
        for whole in batches:
            for first in range(0, whole.num_rows, rows_at_once):
                batch = whole.slice(first, rows_at_once)
                ids = np.array(batch.column("id").to_pylist(), dtype=object)
                scores = unit(matrix(batch.column("vector"), dimension)) @ asked
                scores = np.round(scores, SCORE_DIGITS)
                for query in range(len(query_ids)):
                    best.offer(query, ids, scores[:, query])
        yield best.table(query_ids, schema)

    return documents.mapInArrow(scan, ddl)


def _dense_by_tile(documents: DataFrame, queries: DataFrame, k: int, dimension: int) -> DataFrame:
    """Meet tiles of documents with tiles of queries, for query sets beyond one block.

    Tile counts follow from the row counts, so each group stays near the tile size whatever
    the data looks like; a tile pair yields only its best ``k`` per query.
    """
    schema, ddl = _hit_types(documents, queries)
    n_docs = documents.count() // TILE_ROWS + 1
    n_queries = queries.count() // TILE_ROWS + 1

    def tile(df, key, own: int, other: int, own_name: str, other_name: str):
        return df.withColumns(
            {
                own_name: F.pmod(F.xxhash64(key), F.lit(own)).cast("int"),
                other_name: F.explode(F.sequence(F.lit(0), F.lit(other - 1))),
            }
        )

    doc_tiles = tile(documents, "id", n_docs, n_queries, "doc_tile", "query_tile")
    query_tiles = tile(queries, "query_id", n_queries, n_docs, "query_tile", "doc_tile")

    def meet(docs: pa.Table, asked: pa.Table) -> pa.Table:
        if not docs.num_rows or not asked.num_rows:
            return schema.empty_table()
        query_ids = np.array(asked["query_id"].to_pylist(), dtype=object)
        ids = np.array(docs["id"].to_pylist(), dtype=object)
        left = unit(matrix(docs["vector"], dimension))
        right = unit(matrix(asked["vector"], dimension))
        best = Best(len(query_ids), k)
        at_once = max(1, BLOCK_CELLS // len(ids))
        for first in range(0, len(query_ids), at_once):
            scores = np.round(left @ right[first : first + at_once].T, SCORE_DIGITS)
            for offset in range(scores.shape[1]):
                best.offer(first + offset, ids, scores[:, offset])
        return pa.Table.from_batches([best.table(query_ids, schema)])

    keys = ["doc_tile", "query_tile"]
    return doc_tiles.groupBy(*keys).cogroup(query_tiles.groupBy(*keys)).applyInArrow(meet, ddl)


def dense_topk(
    documents: DataFrame,
    queries: DataFrame,
    k: int = DEFAULT_K,
    dimension: int = 1536,
    id_col: str = "id",
    vector_col: str = "dense_vector",
    query_id_col: str = "query_id",
    query_vector_col: str = "dense_vector",
    max_broadcast: int = MAX_BROADCAST_QUERIES,
) -> DataFrame:
    """The ``k`` nearest documents per query by cosine, exactly: query_id, id, score, rank.

    Vectors of another length are left out; a zero vector scores 0. Tasks score batches with
    a matrix product and keep their best ``k`` per query, so only those are shuffled.
    """
    documents = _usable(documents, id_col, vector_col, dimension, "id")
    queries = _usable(queries, query_id_col, query_vector_col, dimension, "query_id")
    if fits(queries, max_broadcast, max_bytes=256 << 20):
        survivors = _dense_by_block(documents, queries, k, dimension)
    else:
        survivors = _dense_by_tile(documents, queries, k, dimension)
    return top_k(survivors, k)


# --- approximate dense -----------------------------------------------------------------------


def _planes(dimension: int, tables: int, bits: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((dimension, tables * bits))


def lsh_index(
    documents: DataFrame,
    dimension: int,
    tables: int = 8,
    bits: int = 8,
    seed: int = 17,
    id_col: str = "id",
    vector_col: str = "dense_vector",
) -> DataFrame:
    """Documents with ``signature``: one random-hyperplane bucket per table. Narrow."""
    planes = _planes(dimension, tables, bits, seed)

    def sign(vectors: pa.Array) -> pa.Array:
        found = signatures(matrix(vectors, dimension), planes, tables, bits)
        offsets = np.arange(0, (len(found) + 1) * tables, tables, dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(found.ravel().astype(np.int32)))

    sign.__annotations__ = {"vectors": pa.Array, "return": pa.Array}
    usable = _usable(documents, id_col, vector_col, dimension, "id")
    return usable.withColumn("signature", F.arrow_udf(sign, "array<int>")("vector"))


def dense_topk_lsh(
    index: DataFrame,
    queries: DataFrame,
    k: int = DEFAULT_K,
    dimension: int = 1536,
    tables: int = 8,
    bits: int = 8,
    seed: int = 17,
    query_id_col: str = "query_id",
    query_vector_col: str = "dense_vector",
) -> DataFrame:
    """Approximate ``dense_topk`` over an ``lsh_index`` made with the same settings.

    A first scan scores the ``PROBED`` times ``k`` documents whose signatures differ from a query's in
    the fewest bits; the score of the ``k``-th best is a bound no true hit lies below. A bit differs
    with a probability known from the angle, so a second scan scores all documents up to as many
    differing bits as leave out a document at the bound with probability ``MISSED`` at most,
    whatever the vectors look like. A query whose bound is not above 0 is answered exactly, so each
    gets ``k`` hits if there are as many documents. Candidates never leave the task that reads
    them. Query sets beyond one block are answered block by block; what a query gets depends
    neither on the others nor on the partitions.
    """
    asked = _usable(queries, query_id_col, query_vector_col, dimension, "query_id")
    if fits(asked, MAX_BROADCAST_QUERIES, max_bytes=256 << 20):
        return top_k(_lsh_block(index, asked, k, dimension, tables, bits, seed), k)
    n_blocks = 2 * asked.count() // MAX_BROADCAST_QUERIES + 1
    block = F.pmod(F.xxhash64("query_id"), F.lit(n_blocks))
    parts = [
        _lsh_block(index, asked.filter(block == n), k, dimension, tables, bits, seed)
        for n in range(n_blocks)
    ]
    return top_k(reduce(DataFrame.union, parts), k)


def _reach(bound: float | None, n_bits: int) -> int:
    """Differing bits up to which documents are scored, given a score the ``k``-th best reaches."""
    if bound is None or bound <= 0:
        return n_bits
    differs = math.acos(min(1.0, bound - 10.0**-SCORE_DIGITS)) / math.pi
    within = 0.0
    for reach in range(n_bits):
        within += math.comb(n_bits, reach) * differs**reach * (1 - differs) ** (n_bits - reach)
        if within >= 1 - MISSED:
            return reach
    return n_bits


def _lsh_block(index, asked, k, dimension, tables, bits, seed) -> DataFrame:
    schema, ddl = _hit_types(index, asked)
    probed_schema, probed_ddl = schema.append(pa.field("distance", pa.int64())), f"{ddl}, distance long"
    block = asked.toArrow()
    query_ids = np.array(block["query_id"].to_pylist(), dtype=object)
    vectors = matrix(block["vector"], dimension)
    wanted = signatures(vectors, _planes(dimension, tables, bits, seed), tables, bits)
    unit_queries = unit(vectors)
    most = PROBED * k

    def read(batches):
        for batch in batches:
            ids = np.array(batch.column("id").to_pylist(), dtype=object)
            units = unit(matrix(batch.column("vector"), dimension))
            buckets = np.asarray(batch.column("signature").flatten()).reshape(-1, tables)
            yield ids, units, buckets

    def score(units, query):
        return np.round(units @ unit_queries[query], SCORE_DIGITS)

    def probe(batches):
        best = Best(len(query_ids), most)
        kept = [{} for _ in query_ids]
        for ids, units, buckets in read(batches):
            for query in range(len(query_ids)):
                nearness = -distances(buckets, wanted[query]).astype(np.float64)
                near = np.flatnonzero(nearness >= best.floor[query])
                if near.size > most:
                    cut = np.partition(nearness[near], near.size - most)[near.size - most]
                    near = near[nearness[near] >= cut]
                    near = near[np.lexsort((ids[near], -nearness[near]))[:most]]
                best.offer(query, ids[near], nearness[near])
                # Rows that repeat an id bring the smallest of their scores.
                scores = kept[query]
                for id_, value in zip(ids[near], score(units[near], query)):
                    scores[id_] = min(value, scores.get(id_, value))
                kept[query] = {id_: scores[id_] for id_ in best.ids[query]}
        found = best.table(query_ids, schema)
        scores = [kept[query][id_] for query in range(len(query_ids)) for id_ in best.ids[query]]
        distance = pa.array(-np.concatenate([*best.scores, np.empty(0)]), pa.float64()).cast(pa.int64())
        arrays = [found.column(0), found.column(1), pa.array(scores, pa.float64()), distance]
        yield pa.RecordBatch.from_arrays(arrays, schema=probed_schema)

    probed = top_k(index.mapInArrow(probe, probed_ddl), most, F.asc("distance"))
    # At most ``most`` scores per query.
    scores = F.sort_array(F.collect_list(F.when(~F.isnan("score"), F.col("score"))), asc=False)
    bounds = probed.groupBy("query_id").agg(
        F.get(scores, F.lit(k - 1)).alias("bound"), F.max("distance").alias("distance")
    )
    known = {r["query_id"]: max(_reach(r["bound"], tables * bits), r["distance"]) for r in bounds.collect()}
    reach = [known.get(q, tables * bits) for q in query_ids]

    def scan(batches):
        best = Best(len(query_ids), k)
        for ids, units, buckets in read(batches):
            for query in range(len(query_ids)):
                near = np.flatnonzero(distances(buckets, wanted[query]) <= reach[query])
                if near.size:
                    best.offer(query, ids[near], score(units[near], query))
        yield best.table(query_ids, schema)

    return index.mapInArrow(scan, ddl)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """Share of the exact hits that an approximate search found, as one row."""
    both = exact.join(found.select("query_id", "id", F.lit(True).alias("_hit")), ["query_id", "id"], "left")
    return both.agg(F.round(F.avg(F.when(F.col("_hit"), 1.0).otherwise(0.0)), 6).alias("recall"))


# --- lexical ---------------------------------------------------------------------------------


def one_row_per_id(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, _text): the texts of rows that repeat an id joined to one, the others as they are."""
    texts = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("_text"))
    repeated = texts.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("id")
    if not repeated.limit(1).count():
        return texts
    repeated = broadcast_if_small(repeated)
    joined = F.array_join(F.sort_array(F.collect_list("_text")), "\n").alias("_text")
    merged = texts.join(repeated, "id", "left_semi").groupBy("id").agg(joined)
    return texts.join(repeated, "id", "left_anti").union(merged)


def term_counts(texts: DataFrame, terms: Column) -> DataFrame:
    """(id, doc_length, terms, tfs) of (id, ...): each distinct term of a row and how often it is there.

    Rows are counted where they lie. Null ``terms`` count as none.
    """

    def count(batches):
        for batch in batches:
            lists = batch.column("terms")
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            coded = lists.flatten().dictionary_encode()
            width = max(1, len(coded.dictionary))
            keys = np.sort(np.repeat(np.arange(len(sizes)), sizes) * width + coded.indices.to_numpy())
            starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)
            tfs = np.diff(np.r_[starts, len(keys)]).astype(np.int64)
            rows, codes = np.divmod(keys[starts], width)
            ends = pa.array(np.r_[0, np.cumsum(np.bincount(rows, minlength=len(sizes)))].astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(sizes.astype(np.int64)),
                    pa.ListArray.from_arrays(ends, coded.dictionary.take(pa.array(codes)).cast(pa.string())),
                    pa.ListArray.from_arrays(ends, pa.array(tfs)),
                ],
                names=["id", "doc_length", "terms", "tfs"],
            )

    chosen = texts.select("id", terms.alias("terms"))
    kind = chosen.schema["id"].dataType.simpleString()
    return chosen.mapInArrow(count, f"id {kind}, doc_length bigint, terms array<string>, tfs array<bigint>")


def postings_of(forward: DataFrame, *columns: str) -> DataFrame:
    """(term, id, tf, doc_length, columns): a row per document and distinct term."""
    entry = F.explode(F.arrays_zip("terms", "tfs")).alias("e")
    return forward.select("id", "doc_length", *columns, entry).select(
        F.col("e.terms").alias("term"), "id", F.col("e.tfs").alias("tf"), "doc_length", *columns
    )


class LexicalIndex(NamedTuple):
    """``postings(term, id, tf, doc_length)``, ``term_stats(term, df)``, one-row ``corpus``."""

    postings: DataFrame
    term_stats: DataFrame
    corpus: DataFrame


def bm25_index(
    documents: DataFrame,
    id_col: str = "id",
    text_col: str = "content",
    analyzer=analyze,
    partitions: int | None = None,
) -> LexicalIndex:
    """Term postings with document lengths, document frequencies and corpus figures.

    Rows with one id are one document; one without text counts, with length 0.

    Terms are counted where the rows of their texts lie. The counts of the postings, not the
    texts, are dealt out by id, to ``partitions`` if given.
    """
    counted = term_counts(one_row_per_id(documents, id_col, text_col), analyzer(F.col("_text")))
    if partitions is not None:
        counted = counted.repartition(partitions, "id")
    postings = postings_of(counted.repartition("id") if partitions is None else counted)
    lengths = counted.select("doc_length")
    term_stats = postings_of(counted).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    corpus = lengths.agg(
        F.count(F.lit(1)).alias("n_docs"), F.avg("doc_length").alias("avg_length")
    )
    return LexicalIndex(postings, term_stats, corpus)


def save_bm25_index(index: LexicalIndex, name: str, path: str, buckets: int = 200) -> None:
    """Stores the index as catalog tables.

    Postings are bucketed by document and sorted by term, so scoring needs no shuffle of
    postings. A search reads all buckets. An index made with as many partitions
    gives one file per bucket.
    """
    index.postings.write.mode("overwrite").bucketBy(buckets, "id").sortBy("term").option(
        "path", f"{path}/postings"
    ).saveAsTable(f"{name}_postings")
    spark = index.postings.sparkSession
    stored = spark.table(f"{name}_postings")
    stats = stored.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    stats.write.mode("overwrite").option("path", f"{path}/term_stats").saveAsTable(f"{name}_term_stats")
    index.corpus.write.mode("overwrite").option("path", f"{path}/corpus").saveAsTable(f"{name}_corpus")


def load_bm25_index(spark: SparkSession, name: str) -> LexicalIndex:
    return LexicalIndex(*(spark.table(f"{name}_{p}") for p in ("postings", "term_stats", "corpus")))


def query_terms_of(queries: DataFrame, id_col: str, text_col: str, analyzer) -> DataFrame:
    return (
        queries.select(
            F.col(id_col).alias("query_id"), F.explode(analyzer(F.col(text_col))).alias("term")
        )
        .groupBy("query_id", "term")
        .agg(F.count(F.lit(1)).alias("query_tf"))
    )


def _term_matrix(entries: pa.Table, value: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct terms, distinct queries, and ``value`` as a matrix of one by the other."""
    terms, row = np.unique(np.array(entries["term"].to_pylist(), dtype=object), return_inverse=True)
    asked, column = np.unique(
        np.array(entries["query_id"].to_pylist(), dtype=object), return_inverse=True
    )
    cells = np.zeros((len(terms), len(asked)))
    np.add.at(cells, (row, column), np.asarray(entries[value], dtype=np.float64))
    return terms, asked, cells


def _n_cells(entries: pa.Table) -> int:
    """Cells of the matrix of these terms and queries, before it is made."""
    return len(pc.unique(entries["term"])) * len(pc.unique(entries["query_id"]))


def _score_by_block(
    postings: DataFrame, queries: DataFrame, weighted: pa.Table, k: int
) -> DataFrame:
    """Score every document against all queries where its postings lie.

    The weights of the query terms form a small matrix each task holds. A document brings a
    list of its query terms, so scores are a matrix product and a task passes on only its
    best ``k`` per query instead of one row per document and query.
    """
    schema, ddl = _hit_types(postings, queries)
    terms, asked, weights = _term_matrix(weighted, "weight")
    numbers = pa.table(
        {
            "term": pa.array(terms.tolist(), pa.string()),
            "term_no": pa.array(np.arange(len(terms)), pa.int32()),
        }
    )
    numbered = F.broadcast(postings.sparkSession.createDataFrame(numbers))
    documents = (
        postings.join(numbered, "term")
        .groupBy("id")
        # At most one entry per query term, so the list is bounded.
        .agg(F.collect_list(F.struct("term_no", "part")).alias("found"))
    )
    rows_at_once = max(1, BLOCK_CELLS // max(1, len(terms), len(asked)))

    def scan(batches):
        best = Best(len(asked), k)
        for whole in batches:
            for first in range(0, whole.num_rows, rows_at_once):
                batch = whole.slice(first, rows_at_once)
                ids = np.array(batch.column("id").to_pylist(), dtype=object)
                found = batch.column("found")
                rows = np.repeat(np.arange(batch.num_rows), np.diff(np.asarray(found.offsets)))
                entries = found.flatten()
                parts = np.zeros((batch.num_rows, len(terms)))
                np.add.at(parts, (rows, np.asarray(entries.field("term_no"))), np.asarray(entries.field("part")))
                scores = parts @ weights
                for query in range(len(asked)):
                    hit = np.flatnonzero(scores[:, query] > 0)
                    best.offer(query, ids[hit], np.round(scores[hit, query], SCORE_DIGITS))
        yield best.table(asked, schema)

    return documents.mapInArrow(scan, ddl)


def _score_by_join(postings: DataFrame, weighted: DataFrame) -> DataFrame:
    """Join by term and sum per document and query, for query sets beyond one block."""
    return (
        postings.join(weighted, "term")
        .groupBy("id", "query_id")
        .agg(F.round(F.sum(F.col("weight") * F.col("part")), SCORE_DIGITS).alias("score"))
        .select("query_id", "id", "score")
    )


def bm25_topk(
    index: LexicalIndex,
    queries: DataFrame,
    k: int = DEFAULT_K,
    query_id_col: str = "query_id",
    query_text_col: str = "text",
    analyzer=analyze,
    k1: float = BM25_K1,
    b: float = BM25_B,
    max_broadcast: int = MAX_QUERY_TERMS,
) -> DataFrame:
    """The ``k`` best documents per query by BM25: query_id, id, score, rank.

    A term repeated in the query counts each time. Query terms that fit one block go to every
    task; larger sets are joined by term. Both give the same hits.
    """
    query_terms = query_terms_of(queries, query_id_col, query_text_col, analyzer)
    figures = index.corpus.first()  # one row
    length = k1 * (1.0 - b + b * F.col("doc_length") / F.lit(figures["avg_length"]))
    tf_part = F.col("tf") * (k1 + 1.0) / (F.col("tf") + length)
    frequency = F.col("df")
    idf = F.log1p((figures["n_docs"] - frequency + 0.5) / (frequency + 0.5))

    small = fits(query_terms, max_broadcast)
    postings, term_stats = index.postings, index.term_stats
    if small:
        # These semi joins go below the counting of terms: only query terms are counted.
        wanted = F.broadcast(query_terms.select("term").distinct())
        postings = postings.join(wanted, "term", "left_semi")
        term_stats = term_stats.join(wanted, "term", "left_semi")
        query_terms = F.broadcast(query_terms)
    postings = postings.withColumn("part", tf_part)
    weighted = term_stats.join(query_terms, "term").select(
        "query_id", "term", (idf * F.col("query_tf")).alias("weight")
    )
    if not small:
        return top_k(_score_by_join(postings, weighted), k)
    block = weighted.toArrow()  # no more rows than the query terms that fit
    if _n_cells(block) <= BLOCK_CELLS:
        return top_k(_score_by_block(postings, query_terms, block, k), k)
    return top_k(_score_by_join(postings, F.broadcast(weighted)), k)


def bm25_scan(
    documents: DataFrame,
    queries: DataFrame,
    k: int = DEFAULT_K,
    id_col: str = "id",
    text_col: str = "content",
    query_id_col: str = "query_id",
    query_text_col: str = "text",
    analyzer=analyze,
    k1: float = BM25_K1,
    b: float = BM25_B,
) -> DataFrame:
    """``bm25_topk`` straight over texts without an index: two passes, no shuffle of texts.

    The first pass counts in how many documents each query term occurs and how long the
    documents are, the second scores. Query sets beyond one block go through an index.
    """
    query_terms = query_terms_of(queries, query_id_col, query_text_col, analyzer)
    entries = query_terms.toArrow() if fits(query_terms, MAX_QUERY_TERMS) else None
    if entries is None or _n_cells(entries) > BLOCK_CELLS:
        index = bm25_index(documents, id_col, text_col, analyzer)
        return bm25_topk(index, queries, k, query_id_col, query_text_col, analyzer, k1, b)

    terms, asked, query_tf = _term_matrix(entries, "query_tf")
    n_terms = len(terms)
    vocabulary = pa.array(terms.tolist(), pa.string())
    texts = one_row_per_id(documents, id_col, text_col).select("id", analyzer(F.col("_text")).alias("terms"))

    def count(batches):
        # One slot per term, then the number of documents and their total length.
        totals = np.zeros(n_terms + 2, dtype=np.int64)
        for batch in batches:
            cells, _, lengths = term_cells(batch.column("terms"), vocabulary)
            totals[:n_terms] += np.bincount(cells % max(1, n_terms), minlength=n_terms)[:n_terms]
            totals[n_terms:] += (len(lengths), lengths.sum())
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(n_terms + 2)), pa.array(totals)], names=["slot", "n"]
        )

    counted = (
        texts.select("terms")
        .mapInArrow(count, "slot bigint, n bigint")
        .groupBy("slot")
        .agg(F.sum("n").alias("n"))
        .toArrow()  # one row per slot
    )
    totals = np.zeros(n_terms + 2)
    totals[np.asarray(counted["slot"])] = np.asarray(counted["n"])
    frequency, (n_docs, total_length) = totals[:n_terms], totals[n_terms:]
    idf = np.log1p((n_docs - frequency + 0.5) / (frequency + 0.5))
    weights = idf[:, None] * query_tf
    mean_length = total_length / n_docs if total_length else 1.0

    schema, ddl = _hit_types(texts, query_terms)
    rows_at_once = max(1, BLOCK_CELLS // max(1, n_terms, len(asked)))

    def score(batches):
        best = Best(len(asked), k)
        for whole in batches:
            for first in range(0, whole.num_rows, rows_at_once):
                batch = whole.slice(first, rows_at_once)
                ids = np.array(batch.column("id").to_pylist(), dtype=object)
                cells, tf, lengths = term_cells(batch.column("terms"), vocabulary)
                damping = k1 * (1.0 - b + b * lengths / mean_length)
                parts = np.zeros(batch.num_rows * n_terms)
                parts[cells] = tf * (k1 + 1.0) / (tf + damping[cells // max(1, n_terms)])
                scores = parts.reshape(-1, n_terms) @ weights if n_terms else np.zeros((len(ids), 0))
                for query in range(len(asked)):
                    hit = np.flatnonzero(scores[:, query] > 0)
                    best.offer(query, ids[hit], np.round(scores[hit, query], SCORE_DIGITS))
        yield best.table(asked, schema)

    return top_k(texts.mapInArrow(score, ddl), k)


# --- fusion ----------------------------------------------------------------------------------


def rrf_fuse(
    ranked_lists: list[DataFrame],
    k0: int = RRF_K0,
    limit: int = DEFAULT_K,
    weights: list[float] | None = None,
) -> DataFrame:
    """Reciprocal-rank fusion: the sum of ``1 / (k0 + rank)`` over the lists, ranks from 1.

    The order of the lists does not matter. ``weights`` is an option beyond plain fusion.
    """
    weights = weights or [1.0] * len(ranked_lists)
    union = None
    for hits, weight in zip(ranked_lists, weights, strict=True):
        part = hits.select(
            "query_id", "id", (F.lit(weight) / (F.lit(k0) + F.col("rank"))).alias("part")
        )
        union = part if union is None else union.unionByName(part)
    fused = union.groupBy("query_id", "id").agg(F.round(F.sum("part"), 9).alias("score"))
    return top_k(fused, limit)


def attach_documents(hits: DataFrame, documents: DataFrame) -> DataFrame:
    """Hits with content and metadata; the documents are not shuffled while hits are few."""
    return documents.select("id", "content", "metadata").join(broadcast_if_small(hits), "id")


def keyword_search(
    documents: DataFrame, index: LexicalIndex | None, queries: DataFrame, k: int = DEFAULT_K
) -> DataFrame:
    return bm25_scan(documents, queries, k) if index is None else bm25_topk(index, queries, k)


def hybrid_search(
    documents: DataFrame,
    index: LexicalIndex | None,
    queries: DataFrame,
    k: int = DEFAULT_K,
    dimension: int = 1536,
    weights: list[float] | None = None,
) -> DataFrame:
    """Dense and lexical search fused. Queries have query_id, text and dense_vector.

    Each branch fetches twice ``k``. Without an index the texts themselves are scanned.
    """
    dense = dense_topk(documents, queries, OVERFETCH * k, dimension)
    lexical = keyword_search(documents, index, queries, OVERFETCH * k)
    return rrf_fuse([dense, lexical], limit=k, weights=weights)


# Names of the search modes.
KEYWORD, CONTEXTUAL, HYBRID = "Keyword", "Contextual Search", "Hybrid Search"


def search_mode(
    mode: str,
    documents: DataFrame,
    index: LexicalIndex | None,
    queries: DataFrame,
    k: int = DASHBOARD_K,
    dimension: int = 1536,
) -> DataFrame:
    """Search in one of the three modes."""
    if mode == KEYWORD:
        return keyword_search(documents, index, queries, k)
    if mode == CONTEXTUAL:
        return dense_topk(documents, queries, k, dimension)
    if mode == HYBRID:
        return hybrid_search(documents, index, queries, k, dimension)
    raise ValueError(f"unknown search mode {mode!r}")


def dedup_hits_by_url(hits: DataFrame) -> DataFrame:
    """The first hit per query and article url, with the article's metadata.

    Hits carry ``rank`` and ``metadata``. There are at most ``k`` per query, so the groups
    are small.
    """
    first = W.partitionBy("query_id", "metadata.url").orderBy("rank", "id")
    return (
        hits.withColumn("_rn", F.row_number().over(first))
        .filter(F.col("_rn") == 1)
        .select(
            "query_id",
            "rank",
            "metadata.url",
            "metadata.author",
            "metadata.date_published",
            "metadata.tags",
        )
    )
