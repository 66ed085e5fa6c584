"""Batch arithmetic of the searches: cosines, buckets and running best lists.

Kept apart from the operators, so that Python workers import numpy and Arrow only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def unit(vectors: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(norms == 0, 1.0, norms)


def matrix(column, dimension: int) -> np.ndarray:
    """Rows of an Arrow list column as a float64 matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten(), dtype=np.float64).reshape(-1, dimension)


class Best:
    """Running best ``k`` per query over batches of scored documents."""

    def __init__(self, n_queries: int, k: int):
        self.k = k
        self.floor = np.full(n_queries, -np.inf)
        self.ids = [np.empty(0, dtype=object)] * n_queries
        self.scores = [np.empty(0)] * n_queries

    def offer(self, query: int, ids: np.ndarray, scores: np.ndarray) -> None:
        at = np.flatnonzero(scores >= self.floor[query])
        if at.size > self.k:
            values = scores[at]
            cut = np.partition(values, at.size - self.k)[at.size - self.k]
            at = at[values >= cut]
        if not at.size:
            return
        ids = np.concatenate([self.ids[query], ids[at]])
        scores = np.concatenate([self.scores[query], scores[at]])
        keep = np.lexsort((ids, -scores))[: self.k]
        self.ids[query], self.scores[query] = ids[keep], scores[keep]
        if keep.size == self.k:
            self.floor[query] = self.scores[query][-1]

    def table(self, query_ids: np.ndarray, schema: pa.Schema) -> pa.RecordBatch:
        counts = [len(s) for s in self.scores]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(query_ids, counts).tolist(), schema.field(0).type),
                pa.array(np.concatenate([*self.ids, np.empty(0, dtype=object)]).tolist(), schema.field(1).type),
                pa.array(np.concatenate([*self.scores, np.empty(0)]), pa.float64()),
            ],
            schema=schema,
        )


def signatures(vectors: np.ndarray, planes: np.ndarray, tables: int, bits: int) -> np.ndarray:
    """Per vector and table the number whose bits say on which side of each plane it lies."""
    sides = (vectors @ planes >= 0).reshape(len(vectors), tables, bits)
    return sides @ (1 << np.arange(bits))


def distances(buckets: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """In how many bits the signature of each row differs from another one."""
    return np.bitwise_count(buckets ^ wanted.astype(buckets.dtype)).sum(axis=1, dtype=np.int64)


def term_cells(terms: pa.ListArray, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Term counts of a batch of documents, for the terms of a small vocabulary only.

    Gives the cells ``row * len(vocabulary) + term`` with a count, those counts, and the
    lengths of all documents.
    """
    lengths = np.asarray(pc.fill_null(pc.list_value_length(terms), 0))
    flat = terms.flatten()
    found = np.asarray(pc.fill_null(pc.index_in(flat, value_set=vocabulary.cast(flat.type)), -1))
    rows = np.repeat(np.arange(len(terms)), lengths)
    known = found >= 0
    cells, counts = np.unique(rows[known] * len(vocabulary) + found[known], return_counts=True)
    return cells, counts, lengths
