"""Maximal periodic runs of words, found in the classes of equal suffixes by decreasing length.

The suffixes of a text are sorted; edges between neighbours in that order are taken by decreasing
longest common prefix (LCP), and each joins two classes of positions, kept in order. Two positions
that become neighbours in such a class agree on exactly as many words as the LCP of the edge. If
their distance is within it, they repeat at that distance, which then is the smallest period.

A run of at least ``least`` words and ``times`` periods makes its first two periods agree on a number
of words known beforehand, so edges below that are not needed: a text in which no window of that
many words occurs twice has no run, and most texts end there.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.windows import word_hashes, words_of

LEAST, TIMES = 24, 3
#: Bytes of texts that one Arrow batch returns.
OUT_BYTES = 4 << 20

_MULTIPLIERS = [np.uint64(0x9E3779B97F4A7C15 * (2 * k + 1) & (1 << 64) - 1) for k in range(64)]


def least_prefix(least: int, times: int) -> int:
    """Words on which the first two periods of any run agree."""
    return min(max(least, times * period) - period for period in range(1, least + 1))


def has_repeats(hashes: np.ndarray, size: int) -> bool:
    """Whether a window of the largest power of two up to ``size`` words occurs twice."""
    width, step = 1, 0
    while 2 * width <= size:
        if len(hashes) <= width:
            return False
        with np.errstate(over="ignore"):
            hashes = hashes[:-width] * _MULTIPLIERS[step] + hashes[width:]
            hashes ^= hashes >> np.uint64(29)
        width, step = 2 * width, step + 1
    ordered = np.sort(hashes)
    return bool((ordered[1:] == ordered[:-1]).any())


def suffix_order(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions by their suffixes, and the words each neighbour in that order shares with the next.

    Ranks by 1, 2, 4, ... words double until all differ; the LCP is read off the ranks of all sizes.
    """
    n, width = len(symbols), 1
    ranks = [symbols.astype(np.int32)]
    while True:
        last = ranks[-1].astype(np.int64)
        key = (last + 1) * (n + 1)
        key[:-width] += last[width:] + 1
        order = np.argsort(key, kind="stable")
        fresh = np.r_[False, key[order][1:] != key[order][:-1]]
        rank = np.empty(n, np.int32)
        rank[order] = np.cumsum(fresh)
        width *= 2
        if fresh.sum() == n - 1 or width >= n:
            break
        ranks.append(rank)
    a, b = order[:-1].copy(), order[1:].copy()
    first = a.copy()
    for level in range(len(ranks) - 1, -1, -1):
        rank, step = ranks[level], 1 << level
        inside = np.maximum(a, b) < n
        same = inside & (rank[np.minimum(a, n - 1)] == rank[np.minimum(b, n - 1)])
        a, b = a + step * same, b + step * same
    return order, a - first


def runs_of(words: list, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start, then period."""
    if len(words) < least:
        return []
    ids = {word: i for i, word in enumerate(dict.fromkeys(words))}
    symbols = [ids[w] for w in words]
    order, shared = suffix_order(np.array(symbols))
    edges = np.flatnonzero(shared >= least_prefix(least, times))
    edges = edges[np.argsort(-shared[edges], kind="stable")]
    label = list(range(len(words)))
    members: dict[int, list[int]] = {}
    found = []
    for a, b, same in zip(order[edges].tolist(), order[edges + 1].tolist(), shared[edges].tolist()):
        large, small = label[a], label[b]
        ours, theirs = members.get(large) or [large], members.get(small) or [small]
        if len(ours) < len(theirs):
            large, small, ours, theirs = small, large, theirs, ours
        pairs = []
        if len(theirs) * 16 < len(ours):
            for x in theirs:
                ours.insert(bisect_left(ours, x), x)
        else:
            ours = sorted(ours + theirs)
        members[large] = ours
        members.pop(small, None)
        for x in theirs:
            label[x] = large
        if len(theirs) == 1:
            x = theirs[0]
            at = bisect_left(ours, x)
            if at:
                pairs.append((ours[at - 1], x))
            if at + 1 < len(ours):
                pairs.append((x, ours[at + 1]))
        else:
            new = set(theirs)
            for x in theirs:
                at = bisect_left(ours, x)
                if at and ours[at - 1] not in new:
                    pairs.append((ours[at - 1], x))
                if at + 1 < len(ours) and ours[at + 1] not in new:
                    pairs.append((x, ours[at + 1]))
        for i, j in pairs:
            period = j - i
            length = same + period
            if length >= times * period and length >= least and (i == 0 or symbols[i - 1] != symbols[j - 1]):
                found.append((i, length, period))
    return sorted(found, key=lambda run: (run[0], run[2]))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words, joined by spaces, without those that a run holds after its first period."""
    if not runs:
        return b" ".join(words)
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return b" ".join(words[i] for i in np.flatnonzero(kept).tolist())


_RUNS = "array<struct<start:long,length:long,period:long>>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def find_runs(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    least: int = LEAST,
    times: int = TIMES,
) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row.

    Words are maximal runs of bytes other than space and \\x09-\\x0D. A run is a stretch with smallest
    period q, of at least ``least`` words and ``times`` (3 or more) periods, that cannot grow at either
    end; ``runs`` holds (start, length, period) by start, then period. ``collapsed`` is the text without the
    words that a run holds after its first q. Null and empty texts have no words. Rows are independent:
    repeated or null ids are answered each, an empty table gives no rows, other columns are not read. A
    text of n words takes memory of the order n log n and is never cut; nothing moves between tasks.
    """
    if times < 3:
        raise ValueError("neighbours in a class tell smallest periods from three periods on")
    prefix = least_prefix(least, times)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done, held = 0, []
            size = 0
            for i, body in enumerate(batch["text"]):
                words = words_of(body.as_py())
                repeats = len(words) >= least and has_repeats(word_hashes(words), prefix)
                runs = runs_of(words, least, times) if repeats else []
                held.append((len(words), runs, collapsed(words, runs)))
                size += len(held[-1][2])
                if size >= OUT_BYTES or i == batch.num_rows - 1:
                    ends = np.cumsum([0, *(len(r) for _, r, _ in held)]).astype(np.int32)
                    flat = np.array([x for _, r, _ in held for x in r], np.int64).reshape(-1, 3)
                    entries = pa.StructArray.from_arrays([pa.array(c) for c in flat.T], fields=list(_RUN))
                    yield pa.record_batch(
                        [
                            batch["doc_id"].slice(done, len(held)),
                            pa.array([n for n, _, _ in held], pa.int64()),
                            pa.ListArray.from_arrays(pa.array(ends), entries),
                            pa.array([text for _, _, text in held], pa.binary()),
                        ],
                        names=["doc_id", "n_words", "runs", "collapsed"],
                    )
                    done, held, size = i + 1, [], 0

    chosen = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("binary").alias("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()
    found = chosen.mapInArrow(run, f"doc_id {kind}, n_words long, runs {_RUNS}, collapsed binary")
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))


def longest(runs: Column) -> Column:
    """The run of most periods, compared exactly; ties go to the smallest start, then period. Null if none."""
    none = F.lit(None).cast("struct<start:long,length:long,period:long>")

    def better(best: Column, run: Column) -> Column:
        # Runs come by start, then period, so only more periods replace.
        more = run["length"] * best["period"] > best["length"] * run["period"]
        return F.when(best.isNull() | more, run).otherwise(best)

    return F.aggregate(runs, none, better)


def repeat_tail(words: Column, start: Column, period: Column) -> Column:
    """The words with those from ``start`` (from 0) on replaced by repeats of the first ``period`` of them."""
    rest = F.size(words) - start
    times = F.ceil(rest / period).cast("int")
    tail = F.flatten(F.array_repeat(F.slice(words, start + 1, period), times))
    return F.concat(F.slice(words, F.lit(1), start), F.slice(tail, F.lit(1), rest))
