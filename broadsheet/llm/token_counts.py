"""Token counts of texts that are edited: only what an edit touches is encoded again.

A document's pre-tokens lie in the leaves of a segment tree that sums their characters and
tokens. An edit finds its place by descending along the sums, cuts the text again from the
pre-token whose end the edit may move until a cut falls on an old one, encodes what is new, and
updates the sums above the leaves it changed.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.bpe import Encoder, Vocabulary, parse_ranks, parts_of
from broadsheet.llm.windows import remembered

#: Pre-tokens of a leaf when the tree is made, and at most.
LEAF = 32
FULL = 256
#: A pre-token can depend on as many characters after its end.
LOOKAHEAD = 2


class TokenTree:
    """Segment tree over the pre-tokens of one text; nodes hold (characters, tokens), leaves their texts."""

    def __init__(self, text: str, encoder: Encoder, sizes: np.ndarray | None = None):
        """``sizes``: characters and tokens of each pre-token, shape (n, 2), if they are known."""
        self.encoder, self.encoded = encoder, 0
        if sizes is None:
            sizes = np.frombuffer(encoder.sizes([text])[0], np.int32).reshape(-1, 2)
        self._build(text, sizes)

    def _build(self, text: str, sizes: np.ndarray) -> None:
        parts = max(1, -(-len(sizes) // LEAF))
        self.size = 1 << (parts - 1).bit_length()
        ends = np.zeros((self.size + 1, 2), np.int64)
        sums = np.cumsum(np.r_[np.zeros((1, 2), np.int64), sizes], axis=0)
        ends[1:] = sums[np.minimum(np.arange(1, self.size + 1) * LEAF, len(sizes))]
        places = ends[:, 0].tolist()
        #: Of each leaf: its text, and the sizes of its pre-tokens.
        self.texts = [text[x:y] for x, y in zip(places, places[1:])]
        self.leaves = [sizes[i * LEAF : (i + 1) * LEAF] for i in range(self.size)]
        self.sums = np.zeros((2 * self.size, 2), np.int64)
        self.sums[self.size :] = np.diff(ends, axis=0)
        level = self.size
        while level > 1:
            half = level // 2
            self.sums[half:level] = self.sums[level : 2 * level : 2] + self.sums[level + 1 : 2 * level : 2]
            level = half

    def _changed(self, leaf: int) -> None:
        node = self.size + leaf
        self.sums[node] = self.leaves[leaf].sum(axis=0)
        while node > 1:
            node >>= 1
            self.sums[node] = self.sums[2 * node] + self.sums[2 * node + 1]

    @property
    def total(self) -> int:
        return int(self.sums[1, 1])

    @property
    def chars(self) -> int:
        return int(self.sums[1, 0])

    @property
    def text(self) -> str:
        return "".join(self.texts)

    def pieces(self) -> np.ndarray:
        """Characters and tokens of every pre-token in order."""
        return np.concatenate(self.leaves)

    def _leaf(self, position: int) -> tuple[int, int]:
        """(leaf, its start) of the leaf that holds a character; the last one beyond the end."""
        node, start = 1, 0
        while node < self.size:
            node *= 2
            if position - start >= self.sums[node, 0] and self.sums[node + 1, 0]:
                start += int(self.sums[node, 0])
                node += 1
        return node - self.size, start

    def _find(self, position: int) -> tuple[int, int, int, int]:
        """(leaf, place in it, start in it, start) of the pre-token that holds a character, or of the end."""
        leaf, start = self._leaf(position)
        ends = np.cumsum(self.leaves[leaf][:, 0])
        place = int(np.searchsorted(ends, position - start, "right"))
        inside = int(ends[place - 1]) if place else 0
        return leaf, place, inside, start + inside

    def edit(self, start: int, stop: int, replacement: str) -> None:
        """Replace the characters from start to stop (exclusive); places beyond the text are its end."""
        size = self.chars
        start = min(max(start, 0), size)
        stop = min(max(stop, start), size)
        first, place, before, begin = self._find(max(0, start - LOOKAHEAD))
        last = self._leaf(stop)[0]
        while True:
            # The text from the pre-token on, to the end of a leaf after the edit.
            old = "".join(self.texts[first : last + 1])[before:]
            fresh, ended = self._encode(old, begin, start, stop, replacement, size)
            if ended is not None:
                break
            last = min(self.size - 1, 2 * last - first + 1)
        self._replace((first, place, before), ended, old, begin, fresh, (start, stop, replacement))

    def _encode(self, old: str, begin: int, start: int, stop: int, replacement: str, size: int):
        """The new pre-tokens from ``begin`` up to a cut that falls on an old one, and where (leaf, place, start)
        that is; None if the text at hand ends before."""
        at_end = begin + len(old) == size
        text = old[: start - begin] + replacement + old[stop - begin :]
        delta = len(text) - len(old)
        fresh = []
        for match in self.encoder.piece_matches(text):
            if not at_end and match.end() > len(text) - LOOKAHEAD:
                return fresh, None
            fresh.append(match[0])
            end = begin + match.end() - delta
            if stop <= end < size:
                leaf, place, _, found = self._find(end)
                if found == end:
                    return fresh, (leaf, place, found)
        return (fresh, (self.size - 1, len(self.leaves[-1]), size)) if at_end else (fresh, None)

    def _replace(self, first: tuple, ended: tuple, old: str, begin: int, fresh: list[str], change: tuple) -> None:
        (leaf, place, before), (end_leaf, end_place, end) = first, ended
        start, stop, replacement = change
        known = self.encoder.piece_ids(set(fresh))
        self.encoded += len(fresh)
        sizes = np.array([(len(p), len(known[p]) // 4) for p in fresh], np.int32).reshape(-1, 2)
        middle = old[: start - begin] + replacement + old[stop - begin : end - begin]
        tail = self.leaves[end_leaf][end_place:]
        chars = int(tail[:, 0].sum())
        tail_text = self.texts[end_leaf][len(self.texts[end_leaf]) - chars :]
        for i in range(leaf + 1, end_leaf):
            self.leaves[i], self.texts[i] = self.leaves[i][:0], ""
        head, head_text = self.leaves[leaf][:place], self.texts[leaf][:before]
        if leaf == end_leaf:
            self.leaves[leaf], self.texts[leaf] = np.concatenate([head, sizes, tail]), head_text + middle + tail_text
        else:
            self.leaves[leaf], self.texts[leaf] = np.concatenate([head, sizes]), head_text + middle
            self.leaves[end_leaf], self.texts[end_leaf] = tail, tail_text
        for i in range(leaf, end_leaf + 1):
            self._changed(i)
        if len(self.leaves[leaf]) > FULL:
            self._build(self.text, self.pieces())


@lru_cache(maxsize=2)
def _encoder(data: bytes, pattern: str) -> Encoder:
    return Encoder(Vocabulary(parse_ranks(data)), pattern)


COUNTS = "text string, n_tokens long, n_before long, n_edits long, n_encoded long"
PIECES = "piece_chars array<int>, piece_tokens array<int>"
EDITS = "array<struct<start:int,stop:int,replacement:string>>"


def with_edits(docs: DataFrame, edits: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """``docs`` with ``edits``, an array, from a table (id, seq, start, stop, replacement), in order of seq.

    Documents without edits get an empty array; edits of no document are left out.
    """
    entry = F.struct("seq", "start", "stop", "replacement")
    grouped = edits.groupBy(id_column).agg(F.array_sort(F.collect_list(entry)).alias("edits"))
    plain = F.transform("edits", lambda e: F.struct(e["start"], e["stop"], e["replacement"])).cast(EDITS)
    return docs.drop("edits").join(grouped.withColumn("edits", plain), id_column, "left")


def count_edited(
    docs: DataFrame,
    ranks: bytes,
    pattern: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    edits_column: str = "edits",
    with_pieces: bool = False,
) -> DataFrame:
    """(doc_id, COUNTS) after the edits of each row, an array of (start, stop, replacement).

    Edits apply one after the other, each to the text the one before left; places count code points,
    ends are exclusive, and places beyond the text mean its end. ``n_encoded`` counts the pre-tokens
    that the edits encoded again. With ``with_pieces`` there are also ``piece_chars`` and ``piece_tokens``,
    what a later call needs (columns of these names in ``docs`` are taken as the state of the text
    and not made anew). Null texts count as empty, a null array as no edits, a null replacement as a
    deletion. Rows, repeated ones too, are independent; other columns are not read; an empty table gives no
    rows. An edit of a very long text works on the leaves around it only.
    """
    state = [c for c in ("piece_chars", "piece_tokens") if {"piece_chars", "piece_tokens"} <= set(docs.columns)]
    chosen = docs.select(
        F.col(id_column).alias("doc_id"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
        F.col(edits_column).cast(EDITS).alias("edits"),
        *state,
    )
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    returned = f"{COUNTS}, {PIECES}" if with_pieces else COUNTS
    names = [part.split()[0] for part in returned.split(", ")]
    kinds = [pa.string(), *[pa.int64()] * 4, *[pa.list_(pa.int32())] * 2]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value, pattern)
        with remembered(encoder):
            for whole in batches:
                at = 0
                for part in parts_of(whole["text"]):
                    batch, rows = whole.slice(at, len(part)), []
                    at += len(part)
                    texts = part.to_pylist()
                    if state:
                        both = zip(*(batch[c].to_pylist() for c in state))
                        held = [None if None in s else np.array(s, np.int32).T for s in both]
                    else:
                        held = [np.frombuffer(s, np.int32).reshape(-1, 2) for s in encoder.sizes(texts)]
                    for text, edits, sizes in zip(texts, batch["edits"].to_pylist(), held):
                        tree = TokenTree(text, encoder, sizes)
                        before = tree.total
                        for e in edits or ():
                            tree.edit(e["start"] or 0, e["stop"] or 0, e["replacement"] or "")
                        row = (tree.text, tree.total, before, len(edits or ()), tree.encoded)
                        rows.append((*row, *tree.pieces().T.astype(np.int32)) if with_pieces else row)
                    columns = list(zip(*rows))
                    yield pa.record_batch(
                        [batch["doc_id"], *(pa.array(c, k) for c, k in zip(columns, kinds))], names=["doc_id", *names]
                    )

    kind = chosen.schema["doc_id"].dataType.simpleString()
    return chosen.mapInArrow(run, f"doc_id {kind}, {returned}")
