"""Exact substring dedup: words of passages that an earlier document has already.

1. *Anchors.* Every document indexes its non-overlapping blocks of ANCHOR words and probes with
   every rolling window of as many words. A passage of WINDOW words holds a whole block of any
   document it stands in, so it cannot be repeated without a probe that hits an anchor. The
   exchange of :mod:`broadsheet.llm.windows` finds the hits.
2. *Extension.* Hits next to each other are joined and extended to the stretches that may be
   repeats. Only for the windows of such stretches a second, 128-bit exchange learns the smallest
   document each starts in.
3. *Removal.* A word goes if a window over it starts in a smaller document. Documents without
   hits are finished in step 1 and their texts move no further.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm import windows as W
from broadsheet.llm.scratch import Scratch

WINDOW = 13
_NO_ID = (1 << 63) - 1
#: ``packed`` is the text, compressed: it is stored, and where there are hits it moves once more.
_DOCS = "chunk long, doc_id long, n_words long, packed binary, starts binary"
#: Windows sent hold the place of a doc_id in its chunk (two bytes), answers whole doc_ids.
_FIRSTS = "chunk long, bucket int, keys binary, firsts binary"
_PLACES = (1 << W.CHUNK_BITS) - 1


def anchor_size(window: int) -> int:
    """The longest block that every passage of ``window`` words holds whole, wherever it starts."""
    return (window + 1) // 2


def _probes(size: int):
    def windows(body: bytes | None):
        keys = W.rolling(W.word_hashes(W.words_of(body)), size)
        return keys, np.arange(len(keys)) % size == 0

    return windows


def _widen(marks: np.ndarray, by: int) -> np.ndarray:
    """Positions up to ``by`` - 1 before a mark, or at one."""
    sums = np.cumsum(np.r_[0, marks.astype(np.int64), np.zeros(by, np.int64)])
    return sums[by:] - sums[:-by] > 0


def _widen_forward(starts: np.ndarray, n_words: int, window: int) -> np.ndarray:
    """Whether each word lies in a window that starts at one of ``starts``."""
    edges = np.zeros(n_words + 1, np.int64)
    edges[starts] += 1
    edges[starts + window] -= 1
    return np.cumsum(edges[:-1]) > 0


def candidate_starts(hits: np.ndarray, n_words: int, window: int) -> np.ndarray:
    """Starts of the windows that hold a hit block; ``hits`` marks the starts of such blocks."""
    if n_words < window or not hits.any():
        return np.empty(0, np.int64)
    size = anchor_size(window)
    return np.flatnonzero(_widen(hits, window - size + 1)[: n_words - window + 1])


def _find_stretches(buckets: int, window: int):
    size = anchor_size(window)

    def find(docs: pa.Table, replies: pa.Table) -> pa.Table:
        known, _ = W.read_replies(replies)
        packer = zstandard.ZstdCompressor(level=3)
        chunk = (docs if docs.num_rows else replies)["chunk"][0].as_py()
        bodies = docs["body"].to_pylist()
        keys = [W.rolling(W.word_hashes(W.words_of(b)), size) for b in bodies]
        local = W.in_several(keys)
        rows = []
        for doc_id, body, probe in zip(docs["doc_id"].to_pylist(), bodies, keys):
            n_words = len(probe) + size - 1 if len(probe) else len(W.words_of(body))
            hits = W.lookup(known, W.address(probe, buckets))[0] | W.lookup(local, probe)[0]
            starts = candidate_starts(hits, n_words, window)
            rows.append((chunk, doc_id, n_words, packer.compress(body or b""), starts.astype(np.int32).tobytes()))
        columns = list(zip(*rows)) or [()] * 5
        kinds = [pa.int64()] * 3 + [pa.binary()] * 2
        names = ["chunk", "doc_id", "n_words", "packed", "starts"]
        return pa.table({k: pa.array(c, t) for k, c, t in zip(names, columns, kinds)})

    return find


def _unpack(packed: list[bytes]) -> list[bytes]:
    unpacker = zstandard.ZstdDecompressor()
    return [unpacker.decompress(p) for p in packed]


def window_keys(words: list[bytes], starts: np.ndarray, window: int) -> np.ndarray:
    """Two independent hashes of each window that starts at one of ``starts`` (sorted); shape (n, 2)."""
    inside = _widen_forward(starts, len(words), window)
    # A window's words are all inside and so lie next to each other among those inside.
    hashes = W.word_hashes([words[i] for i in np.flatnonzero(inside).tolist()])
    at = np.cumsum(inside)[starts] - 1
    return np.stack([W.rolling(hashes, window, family)[at] for family in (1, 2)], axis=1)


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order that brings equal keys together, and where each run of them starts."""
    if not len(keys):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    order = np.argsort(keys[:, 0])
    ordered = keys[order]
    change, other = ordered[1:, 0] != ordered[:-1, 0], ordered[1:, 1] != ordered[:-1, 1]
    if (other & ~change).any():
        # Different windows share the first hash: both hashes have to be sorted by.
        order = np.lexsort((keys[:, 1], keys[:, 0]))
        ordered = keys[order]
        change, other = ordered[1:, 0] != ordered[:-1, 0], ordered[1:, 1] != ordered[:-1, 1]
    return order, np.flatnonzero(np.r_[True, change | other])


def _least(keys: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ordered, with the smallest value of each."""
    order, starts = _runs(keys)
    return keys[order][starts], np.minimum.reduceat(firsts[order], starts) if len(keys) else firsts


def _send_firsts(buckets: int, window: int):
    """Per chunk and bucket: distinct windows of the stretches, and the smallest doc_id of each."""

    def flush(chunk: int, parts: list) -> Iterator[pa.RecordBatch]:
        keys, firsts = _least(np.concatenate([k for k, _ in parts]), np.concatenate([f for _, f in parts]))
        where = W.bucket_of(keys[:, 0], buckets).astype(np.int32)  # in the order of the keys
        cuts = np.flatnonzero(np.r_[True, where[1:] != where[:-1]])
        ends = np.r_[cuts[1:], len(where)]
        yield pa.record_batch(
            [
                pa.array(np.full(len(cuts), chunk, np.int64)),
                pa.array(where[cuts]),
                pa.array([keys[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary()),
                pa.array([(firsts[a:b] & _PLACES).astype(np.uint16).tobytes() for a, b in zip(cuts, ends)], pa.binary()),
            ],
            names=["chunk", "bucket", "keys", "firsts"],
        )

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending, held = {}, 0
        with W.remembered():
            for batch in batches:
                columns = [batch[c].to_pylist() for c in ("chunk", "doc_id", "packed", "starts")]
                for chunk, doc_id, packed, starts in zip(*columns):
                    words = W.words_of(_unpack([packed])[0])
                    keys = window_keys(words, np.frombuffer(starts, np.int32), window)
                    pending.setdefault(chunk, []).append((keys, np.full(len(keys), doc_id, np.int64)))
                    held += len(keys)
                    if held >= W.FLUSH:
                        for of_chunk, parts in pending.items():
                            yield from flush(of_chunk, parts)
                        pending, held = {}, 0
            for of_chunk, parts in pending.items():
                yield from flush(of_chunk, parts)

    return send


def _read_keys(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all rows, and the row of each."""
    keys = [np.frombuffer(k, np.uint64).reshape(-1, 2) for k in table["keys"].to_pylist()]
    sizes = [len(k) for k in keys]
    return np.concatenate([np.empty((0, 2), np.uint64), *keys]), np.repeat(np.arange(len(keys)), sizes)


def _read_firsts(table: pa.Table, kind: type) -> np.ndarray:
    parts = [np.frombuffer(f, kind).astype(np.int64) for f in table["firsts"].to_pylist()]
    return np.concatenate([np.empty(0, np.int64), *parts])


def _answer_firsts(table: pa.Table) -> pa.Table:
    """To every chunk, the smallest doc_id of those of its windows that a smaller one has."""
    keys, row = _read_keys(table)
    chunks = table["chunk"].to_pylist()
    firsts = (np.array(chunks, np.int64)[row] << W.CHUNK_BITS) | _read_firsts(table, np.uint16)
    order, starts = _runs(keys)
    least = np.empty(len(keys), np.int64)
    least[order] = np.repeat(np.minimum.reduceat(firsts[order], starts), np.diff(np.r_[starts, len(keys)]))
    told = least < firsts
    at = np.flatnonzero(told)  # in the order of the rows
    cuts = np.flatnonzero(np.r_[True, np.diff(row[at]) > 0]) if len(at) else []
    rows = [
        (chunks[row[m[0]]], keys[m].tobytes(), least[m].tobytes()) for m in np.split(at, cuts[1:]) if len(m)
    ]
    columns = list(zip(*rows)) or [(), (), ()]
    return pa.table(
        {
            "chunk": pa.array(columns[0], pa.int64()),
            "bucket": pa.array([table["bucket"][0].as_py()] * len(rows), pa.int32()),
            "keys": pa.array(columns[1], pa.binary()),
            "firsts": pa.array(columns[2], pa.binary()),
        }
    )


def _remove(window: int):
    def remove(docs: pa.Table, replies: pa.Table) -> pa.Table:
        rows = []
        parts = []
        columns = [docs[c].to_pylist() for c in ("doc_id", "packed", "starts")]
        for doc_id, body, starts in zip(columns[0], _unpack(columns[1]), columns[2]):
            words, at = W.words_of(body), np.frombuffer(starts, np.int32)
            parts.append((doc_id, words, at, window_keys(words, at, window)))
        if parts:
            told_keys, told_firsts = _read_keys(replies)[0], _read_firsts(replies, np.int64)
            own = np.concatenate([k for *_, k in parts])
            ids = np.concatenate([np.full(len(k), d, np.int64) for d, _, _, k in parts])
            keys, firsts = np.concatenate([own, told_keys]), np.concatenate([ids, told_firsts])
            order, starts = _runs(keys)
            least = np.empty(len(keys), np.int64)
            least[order] = np.repeat(
                np.minimum.reduceat(firsts[order], starts), np.diff(np.r_[starts, len(keys)])
            )
            at = 0
            for doc_id, words, begin, own_keys in parts:
                repeated = begin[least[at : at + len(own_keys)] < doc_id]
                at += len(own_keys)
                gone = _widen_forward(repeated, len(words), window)
                kept = words if not len(repeated) else list(compress(words, (~gone).tolist()))
                rows.append((doc_id, len(words), int(gone.sum()), b" ".join(kept)))
        columns = list(zip(*rows)) or [()] * 4
        kinds = [pa.int64()] * 3 + [pa.binary()]
        names = ["doc_id", "n_words", "n_removed", "kept"]
        return pa.table({k: pa.array(c, t) for k, c, t in zip(names, columns, kinds)})

    return remove


def _whole(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bodies = [b" ".join(W.words_of(b)) for b in _unpack(batch["packed"].to_pylist())]
        yield pa.record_batch(
            [
                batch["doc_id"],
                batch["n_words"],
                pa.array(np.zeros(len(bodies), np.int64)),
                pa.array(bodies, pa.binary()),
            ],
            names=["doc_id", "n_words", "n_removed", "kept"],
        )


def remove_repeats(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): the text without passages of smaller documents.

    A word is removed if a window of ``window`` consecutive words over it also starts in a document
    with a smaller doc_id; windows are judged on the input. ``kept`` (string) joins the words that
    stay by one space. Null, empty and blank texts have no words and are kept as "". Texts of
    fewer words than a window lose nothing. Rows that repeat a doc_id are judged each on its own
    and are no smaller than each other. Rows without id come after all others. Columns besides
    id and text are not read. An empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "substring")
    result = "doc_id long, n_words long, n_removed long, kept binary"
    doc_id = F.coalesce(F.col(id_column).cast("long"), F.lit(_NO_ID)).alias("doc_id")
    bodies = W.with_chunk(docs.select(doc_id, F.col(text_column).cast("binary").alias("body")), "doc_id")
    buckets = W.bucket_count(bodies, "body")
    replies = W.answer_shared(W.send_windows(bodies, _probes(anchor_size(window)), buckets))
    found = scratch.write(
        bodies.groupBy("chunk")
        .cogroup(replies.groupBy("chunk"))
        .applyInArrow(_find_stretches(buckets, window), _DOCS)
    )
    hit = found.filter(F.octet_length("starts") > 0)
    firsts = hit.mapInArrow(_send_firsts(buckets, window), _FIRSTS)
    answers = firsts.groupBy("bucket").applyInArrow(_answer_firsts, _FIRSTS)
    cut = hit.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_remove(window), result)
    rest = found.filter(F.octet_length("starts") == 0).mapInArrow(_whole, result)
    clean = F.when(F.col("doc_id") != _NO_ID, F.col("doc_id")).alias("doc_id")
    return rest.union(cut).select(clean, "n_words", "n_removed", F.col("kept").cast("string"))
