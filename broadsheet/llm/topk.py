"""Exact top k by inner product: matrix products of query tiles and shards, lists merged as a tree.

Vectors are packed into shards and queries into tiles, both bounded by bytes, and every shard meets
every tile once. A pair is multiplied block by block; of each block only the scores that can still
enter a list are looked at. Lists of one tile are then merged FAN shards at a time, so no task
holds more than FAN lists of a tile, whatever the number of shards.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.scratch import Scratch

#: Bytes of a shard or a tile.
PACK_BYTES = 8 << 20
#: Entries of all lists of a tile, and lists that a task merges.
LIST_ENTRIES = 1 << 18
FAN = 16
#: Queries and vectors of one matrix product.
QUERY_BLOCK, VECTOR_BLOCK = 1024, 4096

PACKED = "key long, ids binary, body binary, width int, kind string"
LISTS = "tile long, at long, queries binary, sizes binary, ids binary, scores binary"
FOUND = "query_id long, rank int, vec_id long, score long"
_LONG = np.iinfo(np.int64)


def whole(vector: Column, factor: float) -> Column:
    """floor(factor * x) of every component as long.

    Null for a null vector, and for one with a component that is null, not finite, or too large for a long.
    """
    scaled = F.transform(vector, lambda x: F.lit(float(factor)) * x.cast("double"))
    fine = F.forall(scaled, lambda x: x.isNotNull() & (F.abs(x) < 2.0**63))
    return F.when(fine, F.transform(scaled, lambda x: F.floor(x)))


def _matrix(vectors: pa.ListArray) -> np.ndarray:
    """Rows of whole numbers, filled up with zeros."""
    sizes = np.diff(vectors.offsets.to_numpy())
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = values
    return out


def _narrow(matrix: np.ndarray) -> np.ndarray:
    low, high = matrix.min(initial=0), matrix.max(initial=0)
    for kind in (np.int16, np.int32):
        if np.iinfo(kind).min <= low and high <= np.iinfo(kind).max:
            return matrix.astype(kind)
    return matrix


def pack(vectors: DataFrame, most_rows: int) -> DataFrame:
    """PACKED rows of (id, vector): ids and one matrix each, of at most so many rows and PACK_BYTES."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def row() -> pa.RecordBatch:
            width = max(m.shape[1] for _, m in held)
            body = np.concatenate([np.pad(m, ((0, 0), (0, width - m.shape[1]))) for _, m in held])
            ids = np.concatenate([i for i, _ in held])
            return pa.record_batch(
                [
                    pa.array([(task << 32) + made], pa.int64()),
                    pa.array([ids.tobytes()], pa.binary()),
                    pa.array([body.tobytes()], pa.binary()),
                    pa.array([width], pa.int32()),
                    pa.array([body.dtype.str]),
                ],
                names=["key", "ids", "body", "width", "kind"],
            )

        for batch in batches:
            ids, matrix = batch["id"].to_numpy(zero_copy_only=False).astype(np.int64), _narrow(_matrix(batch["vector"]))
            while len(ids):
                width = max([matrix.shape[1], *(m.shape[1] for _, m in held)])
                bytes_a_row = max(1, width * max([matrix.itemsize, *(m.itemsize for _, m in held)]))
                room = max(1, min(most_rows, PACK_BYTES // bytes_a_row)) - sum(len(i) for i, _ in held)
                if room > 0:
                    held.append((ids[:room], matrix[:room]))
                    ids, matrix = ids[room:], matrix[room:]
                if len(ids):
                    yield row()
                    held, made = [], made + 1
        if held:
            yield row()

    return vectors.mapInArrow(run, PACKED)


def unpack(packed: dict) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(packed["ids"], np.int64)
    return ids, np.frombuffer(packed["body"], packed["kind"]).reshape(len(ids), packed["width"])


def products(left: np.ndarray, right: np.ndarray, bound: float) -> np.ndarray:
    """Inner products of all rows, exact: in the narrowest numbers that hold every sum up to ``bound``.

    Products beyond the range of a long count as the nearest long.
    """
    for limit, kind in ((2.0**24, np.float32), (2.0**53, np.float64), (2.0**62, np.int64)):
        if bound < limit:
            return left.astype(kind) @ right.astype(kind).T
    exact = left.astype(object) @ right.astype(object).T if left.shape[1] else np.zeros((len(left), len(right)))
    return np.clip(exact, -_LONG.max, _LONG.max).astype(np.int64)


def best(query: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The k entries of each query with the highest scores, best first; ties go to smaller ids."""
    order = np.lexsort((ids, -scores, query))
    query, scores, ids = query[order], scores[order], ids[order]
    starts = np.flatnonzero(np.r_[True, query[1:] != query[:-1]]) if len(query) else np.empty(0, np.int64)
    rank = np.arange(len(query)) - np.repeat(starts, np.diff(np.r_[starts, len(query)]))
    return query[rank < k], scores[rank < k], ids[rank < k]


class TopLists:
    """Running lists of the queries of one block."""

    def __init__(self, ids: np.ndarray, k: int):
        self.own, self.k = ids, k
        none = np.empty(0, np.int64)
        self.query, self.scores, self.ids = none, none, none
        self.floor = np.full(len(ids), -np.inf)

    def see(self, scores: np.ndarray, ids: np.ndarray) -> None:
        """Take what can enter the lists from the scores of all queries and a block of vectors by id."""
        passing = scores >= self.floor[:, None].astype(scores.dtype if scores.dtype.kind == "f" else np.float64)
        for at in np.flatnonzero(np.isin(ids, self.own)):
            passing[:, at] &= self.own != ids[at]
        if np.count_nonzero(passing) > 4 * self.k * len(self.own) and len(ids) > self.k:
            lowest = -np.inf if scores.dtype.kind == "f" else _LONG.min
            kept = np.where(passing, scores, lowest)
            least = np.partition(kept, -self.k, axis=1)[:, -self.k][:, None]
            tied, above = passing & (kept == least), passing & (kept > least)
            # Ids ascend within the block: of equal scores the first ones can enter.
            passing = above | (tied & (tied.cumsum(axis=1) <= self.k - above.sum(axis=1)[:, None]))
        query, at = np.nonzero(passing)
        if not len(query):
            return
        self.query, self.scores, self.ids = best(
            np.concatenate([self.query, query]),
            np.concatenate([self.scores, scores[query, at].astype(np.int64)]),
            np.concatenate([self.ids, ids[at]]),
            self.k,
        )
        counts = np.bincount(self.query, minlength=len(self.own))
        full = np.flatnonzero(counts >= self.k)
        last = np.cumsum(counts)[full] - 1
        # Rounded down, so that nothing that could enter is left out.
        self.floor[full] = np.nextafter(self.scores[last].astype(np.float32), np.float32(-np.inf))


def _lists(tile: int, at: int, own: np.ndarray, query: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> dict:
    sizes = np.bincount(query, minlength=len(own)).astype(np.int32)
    return {"tile": tile, "at": at, "queries": own.tobytes()} | {
        "sizes": sizes.tobytes(), "ids": ids.tobytes(), "scores": scores.tobytes()
    }


_LIST_SCHEMA = pa.schema(
    [("tile", pa.int64()), ("at", pa.int64()), *((c, pa.binary()) for c in ("queries", "sizes", "ids", "scores"))]
)


def _read(lists: dict) -> tuple[np.ndarray, ...]:
    sizes = np.frombuffer(lists["sizes"], np.int32)
    return (
        np.repeat(np.arange(len(sizes)), sizes),
        np.frombuffer(lists["scores"], np.int64),
        np.frombuffer(lists["ids"], np.int64),
    )


def _largest(matrix: np.ndarray) -> float:
    return float(max(-float(matrix.min(initial=0)), float(matrix.max(initial=0))))


def search(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """FOUND: for each query the k vectors of largest inner product, best first, ties to smaller ids.

    Vectors are arrays of whole numbers (see :func:`whole`), the ids are long. All vectors without the
    query's id are candidates; a query gets all of them if there are fewer than k, and no row if there
    are none. Rows whose id or vector is null or holds a null take no part. Shorter vectors count as
    filled up with zeros, empty ones score 0. Repeated rows are candidates each, and a repeated
    query is answered each time. Scores are exact; one beyond the range of a long counts as the nearest
    long. An empty table gives no rows; other columns are not read.
    """
    spark = vectors.sparkSession

    def chosen(df: DataFrame) -> DataFrame:
        vector = F.col(vector_column).cast("array<long>")
        return df.select(F.col(id_column).cast("long").alias("id"), vector.alias("vector")).filter(
            F.col("id").isNotNull() & F.forall("vector", lambda x: x.isNotNull())
        )

    scratch = Scratch(spark, "topk")
    shards = scratch.write(pack(chosen(vectors), PACK_BYTES))
    tiles = scratch.write(pack(chosen(queries), max(1, LIST_ENTRIES // k)))
    n_shards, n_tiles = shards.count(), tiles.count()
    if not n_shards or not n_tiles or k < 1:
        return spark.createDataFrame([], FOUND)
    place = lambda n: F.pmod(F.xxhash64("key"), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<long>"))
    left = shards.withColumns({"at": place(n_shards), "by": every(n_tiles)})
    right = tiles.withColumns({"by": place(n_tiles), "at": every(n_shards)})

    def pair(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows:
            at, parts = left["at"][0].as_py(), []
            for shard in left.select(["ids", "body", "width", "kind"]).to_pylist():
                ids, body = unpack(shard)
                order = np.argsort(ids, kind="stable")
                parts.append((ids[order], body[order], _largest(body)))
            for tile in right.to_pylist():
                own, body = unpack(tile)
                top, found = _largest(body), []
                for start in range(0, len(own), QUERY_BLOCK):
                    rows = slice(start, start + QUERY_BLOCK)
                    lists = TopLists(own[rows], k)
                    for ids, matrix, highest in parts:
                        width = min(matrix.shape[1], body.shape[1])
                        for column in range(0, len(ids), VECTOR_BLOCK):
                            columns = slice(column, column + VECTOR_BLOCK)
                            scores = products(body[rows, :width], matrix[columns, :width], width * top * highest)
                            lists.see(scores, ids[columns])
                    found.append((lists.query + start, lists.scores, lists.ids))
                out.append(_lists(tile["key"], at, own, *(np.concatenate(c) for c in zip(*found))))
        return pa.Table.from_pylist(out, _LIST_SCHEMA)

    lists = left.groupBy("at", "by").cogroup(right.groupBy("at", "by")).applyInArrow(pair, LISTS)

    def merge(lists: pa.Table) -> pa.Table:
        rows = lists.to_pylist()
        merged = best(*(np.concatenate(c) for c in zip(*map(_read, rows))), k)
        own = np.frombuffer(rows[0]["queries"], np.int64)
        return pa.Table.from_pylist([_lists(rows[0]["tile"], rows[0]["at"], own, *merged)], _LIST_SCHEMA)

    while n_shards > 1:
        n_shards = -(-n_shards // FAN)
        lists = lists.withColumn("at", F.floor(F.col("at") / FAN)).groupBy("tile", "at").applyInArrow(merge, LISTS)

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tile in batch.to_pylist():
                query, scores, ids = _read(tile)
                sizes = np.frombuffer(tile["sizes"], np.int32)
                rank = np.arange(len(query)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + 1
                own = np.frombuffer(tile["queries"], np.int64)
                yield pa.record_batch(
                    [pa.array(own[query]), pa.array(rank.astype(np.int32)), pa.array(ids), pa.array(scores)],
                    names=["query_id", "rank", "vec_id", "score"],
                )

    return lists.mapInArrow(rows, FOUND)
