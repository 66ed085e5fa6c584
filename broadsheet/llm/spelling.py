"""Spelling variants: words one edit apart, found by comparing dense tiles of code points.

Two words one edit apart share their first or their last half. So words are put into blocks by either
half and a band of lengths, and a block too large for a tile is cut again by the halves of what its
words do not share yet; a pair always has one block it is counted in. Blocks lie side by side in tiles,
padded matrices of code points aligned left and right, and tiles are compared as a whole: common prefix
plus common suffix reach the longer length minus one exactly for single edits.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.scratch import Scratch

#: Words of a block beyond which it is cut again.
LARGE_BLOCK = 512
#: Rows of a tile, and code points of a tile's matrix.
TILE, TILE_CHARS = 128, 1 << 20
#: Code points of all words of one bucket, about.
BUCKET_CHARS = 400_000
#: A form occurs at least as many times as often.
RATIO = 10

_KEYS = ["band", "head", "tail", "below", "shared"]


def letter_runs(docs: DataFrame, least: int = 1, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, word): every maximal run of at least ``least`` letters A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased.

    Null and empty texts have none.
    """
    runs = F.regexp_extract_all(F.col(text_column), F.lit(rf"[A-Za-zÀ-ÿ]{{{least},}}"), F.lit(0))
    lower = F.translate("word", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return docs.select(F.col(id_column).alias("doc_id"), F.explode(runs).alias("word")).withColumn("word", lower)


def without_letter(word: Column, place: Column) -> Column:
    """The word without the code point at ``place`` (from 0)."""
    place = place.cast("int")
    return F.concat(F.substring(word, F.lit(1), place), F.substring(word, place + 2, F.char_length(word)))


def _halves(blocks: DataFrame) -> DataFrame:
    """Every row in two narrower blocks: by the first half of what is not shared yet, and by the last.

    The second counts no pair that also shares the first half (``below``).
    """
    half = F.floor((F.col("band") - F.col("head") - F.col("tail")) / 2).cast("int")
    first = F.struct((F.col("head") + half).alias("head"), F.col("tail"), F.col("below"))
    last = F.struct(
        F.col("head"), (F.col("tail") + half).alias("tail"), F.least("below", F.col("head") + half).alias("below")
    )
    cut = blocks.withColumn("to", F.explode(F.array(first, last)))
    return cut.select("word", "n", "band", "to.head", "to.tail", "to.below").withColumn("shared", _shared())


def _shared() -> Column:
    return F.concat(F.substring("word", F.lit(1), F.col("head")), F.right("word", F.col("tail")))


def first_blocks(words: DataFrame) -> DataFrame:
    """Each word in the bands of its own length and the one below, as the longer of a pair."""
    size = F.char_length("word")
    bands = words.withColumn("band", F.explode(F.array(size, size - 1))).filter("band > 0")
    whole = bands.withColumns({"head": F.lit(0), "tail": F.lit(0), "below": F.lit(2**31 - 1)})
    return _halves(whole)


def _points(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points plus one, padded with zeros, aligned left and (reversed) right; lengths."""
    sizes = np.array([len(w) for w in words])
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32) + 1
    inside = np.arange(sizes.max()) < sizes[:, None]
    left, right = np.zeros(inside.shape, np.uint32), np.zeros(inside.shape, np.uint32)
    left[inside] = flat
    right[inside] = np.frombuffer("".join(w[::-1] for w in words).encode("utf-32-le", "surrogatepass"), np.uint32) + 1
    return left, right, sizes


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Leading columns in which each row of a equals each row of b."""
    alive = np.ones((len(a), len(b)), bool)
    out = np.zeros(alive.shape, np.int32)
    for column in range(min(a.shape[1], b.shape[1])):
        alive &= a[:, column, None] == b[None, :, column]
        if not alive.any():
            break
        out += alive
    return out


class Tiles:
    """Rows of blocks, sorted by block, as padded matrices of at most TILE rows."""

    def __init__(self, words: list[str], blocks: list[tuple[int, int, int, int, str]]):
        order = sorted(range(len(words)), key=lambda i: (blocks[i], words[i]))
        self.words = [words[i] for i in order]
        blocks = [blocks[i] for i in order]
        fresh = [i == 0 or blocks[i] != blocks[i - 1] for i in range(len(blocks))]
        self.block = np.cumsum(fresh)
        self.band = np.array([b[0] for b in blocks])
        self.below = np.array([b[3] for b in blocks])
        self.cuts, start, widest = [0], 0, 0
        for i, word in enumerate(self.words):
            widest = max(widest, len(word))
            if i > start and (i - start >= TILE or (i - start + 1) * widest > TILE_CHARS):
                self.cuts.append(i)
                start, widest = i, len(word)
        self.cuts.append(len(self.words))
        self.n_tiles = len(self.cuts) - 1

    def tile(self, i: int) -> tuple:
        rows = slice(self.cuts[i], self.cuts[i + 1])
        return (*_points(self.words[rows]), self.block[rows], self.band[rows], self.below[rows], self.cuts[i])

    def pairs(self):
        """Arrays of rows (i, j) that are one edit apart, each pair once."""
        for i in range(self.n_tiles):
            ours, j = self.tile(i), i
            while j < self.n_tiles and self.block[self.cuts[j]] <= ours[3][-1]:
                theirs = ours if j == i else self.tile(j)
                yield self._near(ours, theirs, i == j)
                j += 1

    @staticmethod
    def _near(ours: tuple, theirs: tuple, same: bool) -> tuple[np.ndarray, np.ndarray]:
        left, right, sizes, block, band, below, start = ours
        left2, right2, sizes2, block2, _, _, start2 = theirs
        together = block[:, None] == block2[None, :]
        if same:
            together = np.triu(together, 1)
        longer = np.maximum(sizes[:, None], sizes2[None, :])
        shorter = np.minimum(sizes[:, None], sizes2[None, :])
        # Pairs of the longer kind only belong to the next band.
        together &= (shorter == band[:, None]) & (longer - shorter <= 1)
        if not together.any():
            return np.empty(0, np.int64), np.empty(0, np.int64)
        prefix = _common(left, left2)
        near = together & (prefix < below[:, None]) & (prefix + _common(right, right2) >= longer - 1)
        i, j = np.nonzero(near)
        return i + start, j + start2


_NEAR = "word string, n_near long, form_n long, form string"


def _compare(rows: pa.Table) -> pa.Table:
    """Of each word: how many near ones it meets here, and the most frequent of them."""
    columns = [rows[c].to_pylist() for c in _KEYS]
    # n is the same wherever the word stands, so one list by the tiles' order is enough.
    tiles = Tiles(rows["word"].to_pylist(), list(zip(*columns)))
    counts = dict(zip(rows["word"].to_pylist(), rows["n"].to_pylist()))
    found: dict[str, tuple[int, int, str]] = {}
    for i, j in tiles.pairs():
        for a, b in zip(i.tolist(), j.tolist()):
            for word, other in ((tiles.words[a], tiles.words[b]), (tiles.words[b], tiles.words[a])):
                n, best, form = found.get(word, (0, 0, ""))
                count = counts[other]
                if count > best or count == best and other < form:
                    best, form = count, other
                found[word] = (n + 1, best, form)
    return pa.table(
        {
            "word": pa.array(list(found), pa.string()),
            "n_near": pa.array([n for n, _, _ in found.values()], pa.int64()),
            "form_n": pa.array([b for _, b, _ in found.values()], pa.int64()),
            "form": pa.array([f for _, _, f in found.values()], pa.string()),
        }
    )


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, form_n, form) of the words (word, n; distinct) that have others one edit apart.

    ``form`` is the near word of largest n, ties to the smallest in code-point order, ``form_n`` its n.
    """
    scratch = Scratch(words.sparkSession, "spelling")
    blocks, done = first_blocks(words), None
    while True:
        sizes = blocks.filter("band - head - tail > 1").groupBy(_KEYS).count()
        large = scratch.write(sizes.filter(F.col("count") > LARGE_BLOCK).drop("count"))
        if large.isEmpty():
            break
        small = blocks.join(large, _KEYS, "left_anti")
        done = small if done is None else done.unionByName(small)
        blocks = scratch.write(_halves(blocks.join(large, _KEYS, "left_semi")))
    blocks = blocks if done is None else done.unionByName(blocks)
    chars = words.agg(F.sum(F.char_length("word") + 8).cast("long")).first()[0] or 0
    bucket = F.pmod(F.xxhash64(*_KEYS), F.lit(max(1, math.ceil(4 * chars / BUCKET_CHARS))))
    # A word that is alone in its block costs a row of a tile; telling so beforehand would cost a shuffle.
    met = blocks.withColumn("bucket", bucket).groupBy("bucket").applyInArrow(lambda t: _compare(t), _NEAR)
    order = F.struct((-F.col("form_n")).alias("less"), "form", "form_n")
    return (
        met.groupBy("word")
        .agg(F.sum("n_near").alias("n_near"), F.min(order).alias("least"))
        .select("word", "n_near", "least.form_n", "least.form")
    )


def group_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every distinct word of ``words`` (word, n).

    Words are near if they differ by one inserted, deleted or replaced code point. ``form`` is the near
    word of largest n (ties: smallest in code-point order) if that is at least ``ratio`` (2 or more) times
    the word's, else null with ``form_n``; ``root`` is where forms lead to, the word itself if it has none.
    Rows of one word are added up; null and empty words and rows with a null n have no result. An empty table
    gives no rows, other columns are not read. Long words are compared whole.
    """
    if ratio < 2:
        raise ValueError("forms lead to a root only if they grow")
    scratch = Scratch(words.sparkSession, "variants")
    words = scratch.write(
        words.filter("word <> '' AND n IS NOT NULL").groupBy("word").agg(F.sum("n").cast("long").alias("n"))
    )
    met = words.join(near_words(words), "word", "left")
    grows = F.col("form_n") >= ratio * F.col("n")
    met = scratch.write(
        met.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(grows, F.col("form")).alias("form"),
            F.when(grows, F.col("form_n")).alias("form_n"),
        )
    )
    links = scratch.write(met.filter("form IS NOT NULL").select("word", F.col("form").alias("root")))
    while True:
        # Every round doubles the steps that a root is away, and n grows with every step.
        further = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = links.join(further, "root", "left")
        following = scratch.write(
            joined.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        )
        moved = not following.filter("moved").isEmpty()
        scratch.drop(links)
        links = following
        if not moved:
            break
    return met.join(links.select("word", "root"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
