"""Word windows as hashes, and the exchange that tells which windows occur in several documents.

Texts never meet: every group of documents (a *chunk*, a range of doc_id) sends each distinct
window hash once, in five bytes, to the bucket of that hash. A bucket learns which hashes came
from several chunks and answers each of them. A window that a third of all documents contain
therefore costs one entry per chunk, and no bucket or chunk grows with such a group.
"""

from __future__ import annotations

import ctypes
import math
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Documents of one chunk, by doc_id range, as a power of two. A chunk has to fit in a Python worker.
CHUNK_BITS = 9
#: Characters of input per bucket of the exchange; sets how many buckets there are.
BUCKET_CHARS = 2_000_000
#: Hashes a task gathers before it sends them.
FLUSH = 1_000_000

LOW = (1 << 40) - 1
#: Words whose hashes a worker remembers, some 30 MB of them.
_CACHED_WORDS = 200_000


class _WordHashes(dict):
    """64-bit hash of a word, remembered for frequent words within a bounded memory."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = _WordHashes()


@contextmanager
def remembered(*caches):
    """What a task remembers goes when it ends, so that reused workers do not add up what stages remember."""
    try:
        yield
    finally:
        for cache in (*caches, _hashes):
            cache.clear()
        give_back()


def give_back() -> None:
    """Memory that is free goes back to the machine, where its C library can do so."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def distinct(keys: np.ndarray) -> np.ndarray:
    """The values once each, sorted."""
    ordered = np.sort(keys)
    return ordered[np.r_[True, ordered[1:] != ordered[:-1]]] if len(ordered) else ordered


def words_of(text: bytes | None) -> list[bytes]:
    """Maximal runs of bytes other than space and \\x09-\\x0D, which is what bytes.split cuts at."""
    return text.split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))


#: Words of a text up to which powers are kept.
_KEPT_POWERS = 1 << 16


def _powers_of(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


@lru_cache(maxsize=8)
def _kept_powers(family: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(family, _KEPT_POWERS)


def _powers(family: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number per family, and of its inverse modulo 2 ** 64."""
    base = xxhash.xxh3_64_intdigest(b"%d" % family) | 1
    return _powers_of(base, n), _powers_of(pow(base, -1, 1 << 64), n)


class Rolling:
    """Hashes of the windows of one text: a polynomial in an odd number, taken from one running sum."""

    def __init__(self, hashes: np.ndarray, family: int = 0):
        n = len(hashes)
        powers, self.inverse = _kept_powers(family) if n <= _KEPT_POWERS else _powers(family, n)
        self.sums, self.made = np.zeros(n + 1, np.uint64), {}
        with np.errstate(over="ignore"):
            np.cumsum(hashes * powers[:n], out=self.sums[1:])

    def of(self, size: int) -> np.ndarray:
        """As :meth:`windows`, made once for each size."""
        if size not in self.made:
            self.made[size] = self.windows(size)
        return self.made[size]

    def windows(self, size: int) -> np.ndarray:
        n = max(0, len(self.sums) - size)
        with np.errstate(over="ignore"):
            return _mixed((self.sums[size : size + n] - self.sums[:n]) * self.inverse[:n])


def rolling(hashes: np.ndarray, size: int, family: int = 0) -> np.ndarray:
    """Hash of every window of ``size`` words; a different ``family`` is an independent hash."""
    return Rolling(hashes, family).windows(size)


def _mixed(out: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        out ^= out >> np.uint64(32)
        out *= np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def with_chunk(df: DataFrame, id_column: str) -> DataFrame:
    """Adds ``chunk``, of ids that are not null."""
    return df.withColumn("chunk", F.shiftright(id_column, CHUNK_BITS))


def bucket_count(df: DataFrame, text_column: str, least: int = 256) -> int:
    """Buckets for the windows of all texts, in proportion to the characters."""
    chars = df.agg(F.sum(F.octet_length(text_column).cast("long"))).first()[0] or 0
    return min(1 << 24, max(least, math.ceil(chars / BUCKET_CHARS)))


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets are ranges of hashes, so sorted hashes are in the order of their buckets."""
    return ((keys >> np.uint64(40)) * np.uint64(buckets)) >> np.uint64(24)


def address(keys: np.ndarray, buckets: int) -> np.ndarray:
    """What the exchange tells hashes apart by: the bucket and the low 40 bits, the lowest set."""
    keys = keys | np.uint64(1)
    return (bucket_of(keys, buckets) << np.uint64(40)) | (keys & np.uint64(LOW))


def pack5(keys: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(keys).view(np.uint8).reshape(-1, 8)[:, :5]


def unpack5(data: bytes) -> np.ndarray:
    packed = np.frombuffer(data, np.uint8).reshape(-1, 5)
    out = np.zeros((len(packed), 8), np.uint8)
    out[:, :5] = packed
    return out.view(np.uint64).ravel()


ENTRIES = "chunk long, bucket int, keys binary, anchored binary"
REPLIES = "chunk long, bucket int, keys binary, weights binary"


def send_windows(docs: DataFrame, windows, buckets: int) -> DataFrame:
    """ENTRIES of all documents (columns chunk and body, a binary).

    ``windows(body)`` gives a document's hashes and, or None, which of them are anchors.
    """

    def flush(pending: dict) -> Iterator[pa.RecordBatch]:
        for chunk, parts in pending.items():
            # The lowest bit of a hash tells anchors; of equal hashes the last one has it if any does.
            keys = np.sort(np.concatenate(parts))
            last = np.r_[(keys[1:] | np.uint64(1)) != (keys[:-1] | np.uint64(1)), True]
            keys = keys[last]
            anchored = (keys & np.uint64(1)).astype(bool)
            keys = keys | np.uint64(1)
            where = bucket_of(keys, buckets).astype(np.int32)
            cuts = np.flatnonzero(np.r_[True, where[1:] != where[:-1]])
            ends = np.r_[cuts[1:], len(where)]
            packed = pack5(keys)
            yield pa.record_batch(
                [
                    pa.array(np.full(len(cuts), chunk, np.int64)),
                    pa.array(where[cuts]),
                    pa.array([packed[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary()),
                    pa.array([np.packbits(anchored[a:b]).tobytes() for a, b in zip(cuts, ends)], pa.binary()),
                ],
                names=["chunk", "bucket", "keys", "anchored"],
            )

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending, held = {}, 0
        with remembered():
            for batch in batches:
                for chunk, body in zip(batch["chunk"].to_pylist(), batch["body"]):
                    keys, anchored = windows(body.as_py())
                    if not len(keys):
                        continue
                    keys = keys | np.uint64(1)
                    if anchored is not None:
                        keys ^= ~anchored
                    pending.setdefault(chunk, []).append(keys)
                    held += len(keys)
                    if held >= FLUSH:
                        yield from flush(pending)
                        pending, held = {}, 0
            if pending:
                yield from flush(pending)

    return docs.select("chunk", "body").mapInArrow(send, ENTRIES)


def answer_shared(entries: DataFrame) -> DataFrame:
    """REPLIES: to every chunk, those of its hashes that other entries hold too.

    A document's windows lie in one entry of a bucket, so two entries mean two documents. Only
    hashes that are an anchor somewhere count. The weight is in how many entries a hash lies,
    the same for all who ask.
    """

    def answer(table: pa.Table) -> pa.Table:
        parts = [unpack5(k) for k in table["keys"].to_pylist()]
        sizes = np.array([len(p) for p in parts])
        anchored = np.concatenate(
            [np.unpackbits(np.frombuffer(a, np.uint8), count=n) for a, n in zip(table["anchored"].to_pylist(), sizes)]
        )
        keys, row = np.concatenate(parts), np.repeat(np.arange(len(parts)), sizes)
        order = np.argsort(keys)
        ordered = keys[order]
        starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
        counts = np.diff(np.r_[starts, len(keys)])
        told = (counts > 1) & (np.maximum.reduceat(anchored[order], starts) > 0)
        keep = np.empty(len(keys), bool)
        keep[order] = np.repeat(told, counts)
        weight = np.empty(len(keys), np.uint16)
        weight[order] = np.repeat(np.minimum(counts, 65535), counts)
        chunks, bucket = table["chunk"].to_pylist(), table["bucket"][0].as_py()
        ends = np.cumsum(sizes)
        rows = []
        for i in np.unique(row[keep]):
            part = slice(ends[i] - sizes[i], ends[i])
            mine = keep[part]
            rows.append((chunks[i], pack5(keys[part][mine]).tobytes(), weight[part][mine].tobytes()))
        give_back()
        return pa.table(
            {
                "chunk": pa.array([r[0] for r in rows], pa.int64()),
                "bucket": pa.array([bucket] * len(rows), pa.int32()),
                "keys": pa.array([r[1] for r in rows], pa.binary()),
                "weights": pa.array([r[2] for r in rows], pa.binary()),
            }
        )

    return entries.groupBy("bucket").applyInArrow(answer, REPLIES)


def read_replies(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Addresses, sorted and distinct, and weights of the hashes a chunk has been told of."""
    if not table.num_rows:
        return np.empty(0, np.uint64), np.empty(0, np.uint16)
    keys = np.concatenate(
        [
            unpack5(k) | (np.uint64(b) << np.uint64(40))
            for b, k in zip(table["bucket"].to_pylist(), table["keys"].to_pylist())
        ]
    )
    weights = np.concatenate([np.frombuffer(w, np.uint16) for w in table["weights"].to_pylist()])
    order = np.argsort(keys)
    keys = keys[order]
    first = np.r_[True, keys[1:] != keys[:-1]]
    return keys[first], weights[order[first]]


def lookup(sorted_keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each wanted key is there, and where."""
    if not len(sorted_keys):
        return np.zeros(len(wanted), bool), np.zeros(len(wanted), np.int64)
    at = np.minimum(np.searchsorted(sorted_keys, wanted), len(sorted_keys) - 1)
    return sorted_keys[at] == wanted, at


def in_several(parts: list[np.ndarray]) -> np.ndarray:
    """Values, sorted, that occur in two or more of the arrays."""
    if not parts:
        return np.empty(0, np.uint64)
    keys, part = np.concatenate(parts), np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    order = np.argsort(keys)
    keys, part = keys[order], part[order]
    return distinct(keys[1:][(keys[1:] == keys[:-1]) & (part[1:] != part[:-1])])
