"""Byte-level BPE: texts to token ids and back.

A text is cut into pieces by the tokenizer's pattern. A piece that is no token itself is merged:
a segment tree over its byte positions stores the leftmost pair of least rank; each merge reads
the root, joins the pair, and updates the tree at the positions whose pair changed. Pieces of
usual length are merged many at a time, as rows of one array of trees; long ones one by one.

Words of a text repeat, so each task remembers the ids of frequent words within a bounded memory.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.windows import remembered

_NONE = np.int64(1 << 62)
#: Pieces of more bytes get a tree of their own.
LONG = 64
#: Words remembered per generation; two generations are held.
REMEMBERED = 200_000
#: Characters of the documents whose words are looked up together.
GROUP_CHARS = 2_000_000


class Vocabulary:
    """Ranks of tokens; the rank is the id. All single bytes are tokens."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.single = {token: rank.to_bytes(4, "little") for token, rank in ranks.items()}
        self.byte_ids = np.array([ranks[bytes([i])] for i in range(256)], np.int64)
        pairs = {
            (ranks[token[:i]] << 32) | ranks[token[i:]]: rank
            for token, rank in ranks.items()
            for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        }
        self.pairs = pairs
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_ranks = np.array([pairs[k] for k in sorted(pairs)], np.int64)

    def pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left << 32) | right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], _NONE)


def parse_ranks(data: bytes) -> dict[bytes, int]:
    """From lines of a base64 token and its rank."""
    lines = (line.split() for line in data.splitlines() if line)
    return {base64.b64decode(token): int(rank) for token, rank in lines}


class Decoder:
    """The bytes of token ids."""

    def __init__(self, ranks: dict[bytes, int]):
        tokens = sorted(ranks, key=ranks.__getitem__)
        self.size = np.zeros(max(ranks.values()) + 1, np.int32)
        self.size[[ranks[t] for t in tokens]] = [len(t) for t in tokens]
        self.start = (np.cumsum(self.size) - self.size).astype(np.int32)
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def decode(self, ids: np.ndarray) -> bytes:
        sizes = self.size[ids]
        before = np.cumsum(sizes, dtype=np.int64) - sizes
        return self.bytes[np.arange(sizes.sum()) + np.repeat(self.start[ids] - before, sizes)].tobytes()


@lru_cache(maxsize=2)
def _decoder(data: bytes) -> Decoder:
    return Decoder(parse_ranks(data))


class PairTree:
    """Segment tree over the byte positions of one piece: the leftmost pair of least rank."""

    def __init__(self, ranks: list[tuple[int, int]]):
        self.size = 1 << max(0, (len(ranks) - 1).bit_length())
        none = (int(_NONE), 0)
        self.nodes = [none] * self.size + ranks + [none] * (self.size - len(ranks))
        for i in range(self.size - 1, 0, -1):
            self.nodes[i] = min(self.nodes[2 * i], self.nodes[2 * i + 1])

    def least(self) -> tuple[int, int]:
        return self.nodes[1]

    def put(self, position: int, rank: int) -> None:
        i = self.size + position
        self.nodes[i] = (rank, position)
        i >>= 1
        while i:
            self.nodes[i] = min(self.nodes[2 * i], self.nodes[2 * i + 1])
            i >>= 1


def merge_one(piece: bytes, vocabulary: Vocabulary) -> bytes:
    """Ids, as int32 bytes, of one piece, in time of the order n log n."""
    ids = vocabulary.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
    n, none, pairs = len(ids), int(_NONE), vocabulary.pairs
    if n < 2:
        return np.array(ids, np.int32).tobytes()
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    tree = PairTree([(pairs.get((ids[i] << 32) | ids[i + 1], none), i) for i in range(n - 1)])
    alive = [True] * n
    while True:
        rank, at = tree.least()
        if rank == none:
            return np.array([x for x, live in zip(ids, alive) if live], np.int32).tobytes()
        gone = after[at]
        ids[at], alive[gone], after[at] = rank, False, after[gone]
        if gone < n - 1:
            tree.put(gone, none)
        if after[at] < n:
            before[after[at]] = at
            tree.put(at, pairs.get((rank << 32) | ids[after[at]], none))
        else:
            tree.put(at, none)
        if before[at] >= 0:
            tree.put(before[at], pairs.get((ids[before[at]] << 32) | rank, none))


def merge_many(pieces: list[bytes], vocabulary: Vocabulary) -> list[bytes]:
    """Ids, as int32 bytes, of many pieces of at most LONG bytes; one tree per row, all rows merge in step."""
    lengths = np.array([len(p) for p in pieces])
    width = max(2, 1 << int(lengths.max() - 1).bit_length())
    rows = np.arange(len(pieces))
    flat = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(-1, width)
    ids = vocabulary.byte_ids[flat]
    place = np.arange(width)
    alive = place < lengths[:, None]
    after = np.broadcast_to(place + 1, ids.shape).copy()
    before = np.broadcast_to(place - 1, ids.shape).copy()
    # A node holds rank * width + position, so the least is the leftmost of the least rank.
    tree = np.full((len(pieces), 2 * width), _NONE)
    ranks = vocabulary.pair_rank(ids[:, :-1], ids[:, 1:])
    paired = (place[1:] < lengths[:, None]) & (ranks != _NONE)
    tree[:, width : 2 * width - 1] = np.where(paired, ranks * width + place[:-1], _NONE)
    level = width
    while level > 1:
        half = level // 2
        tree[:, half:level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
        level = half

    while True:
        least = tree[rows, 1]
        rows = rows[least != _NONE]
        if not len(rows):
            break
        rank, at = np.divmod(least[least != _NONE], width)
        gone = after[rows, at]
        ids[rows, at] = rank
        alive[rows, gone] = False
        following = after[rows, gone]
        after[rows, at] = following
        has_next = following < lengths[rows]
        nexts = np.minimum(following, width - 1)
        before[rows[has_next], following[has_next]] = at[has_next]
        previous = before[rows, at]
        has_previous = previous >= 0
        prior = np.maximum(previous, 0)
        right = vocabulary.pair_rank(rank, ids[rows, nexts])
        right = np.where(has_next & (right != _NONE), right * width + at, _NONE)
        left = vocabulary.pair_rank(ids[rows, prior], rank)
        left = np.where(has_previous & (left != _NONE), left * width + prior, _NONE)
        tree[rows, width + gone] = _NONE
        tree[rows, width + at] = right
        tree[rows[has_previous], width + prior[has_previous]] = left[has_previous]
        touched = np.stack([width + gone, width + at, width + prior])
        while touched[0, 0] > 1:
            touched >>= 1
            tree[rows, touched] = np.minimum(tree[rows, 2 * touched], tree[rows, 2 * touched + 1])
    packed, ends = ids[alive].astype(np.int32).tobytes(), np.cumsum(alive.sum(axis=1) * 4).tolist()
    return [packed[a:b] for a, b in zip([0, *ends], ends)]


class Recent:
    """Values of recently used strings: at most about two times REMEMBERED of them."""

    def __init__(self):
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def of(self, wanted: Iterable[str], make: Callable[[list[str]], list[bytes]]) -> dict[str, bytes]:
        """The value of each of the distinct strings; ``make`` gives those of unknown ones."""
        found, missing = {}, []
        for key in wanted:
            value = self.young.get(key) or self.old.get(key)
            if value:
                found[key] = value
            else:
                missing.append(key)
        found.update(zip(missing, make(missing)))
        if len(self.young) > REMEMBERED:
            self.old, self.young = self.young, {}
        self.young.update(found)
        return found

    def clear(self) -> None:
        self.young, self.old = {}, {}


class Encoder:
    """Encodes texts; remembers frequent words."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary = vocabulary
        # White space as Unicode defines it, without the separators U+001C to U+001F.
        pattern = pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
        compiled = regex.compile(pattern)
        self.pieces, self.piece_matches = compiled.findall, compiled.finditer
        # A space before a visible character begins a piece, so texts can be cut there.
        self.uneven = regex.compile(r" (?:\p{White_Space}|\Z)").search
        self.cut = regex.compile(r" (?=\P{White_Space})").split
        self.known_words, self.known_pieces, self.known_sizes = Recent(), Recent(), Recent()

    def clear(self) -> None:
        """Forget all words."""
        for recent in (self.known_words, self.known_pieces, self.known_sizes):
            recent.clear()

    def words(self, text: str) -> list[str]:
        """The text cut before its words, without the space at each cut."""
        return self.cut(text) if self.uneven(text) else text.split(" ")

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        out = list(map(self.vocabulary.single.get, pieces))
        by_width: dict[int, list[int]] = {}
        for i, ids in enumerate(out):
            if ids is None:
                by_width.setdefault((len(pieces[i]) - 1).bit_length(), []).append(i)
        for width, members in by_width.items():
            if 1 << width > LONG:
                for i in members:
                    out[i] = merge_one(pieces[i], self.vocabulary)
                continue
            for start in range(0, len(members), 4096):
                part = members[start : start + 4096]
                for i, ids in zip(part, merge_many([pieces[i] for i in part], self.vocabulary)):
                    out[i] = ids
        return out

    def piece_ids(self, pieces: set[str]) -> dict[str, bytes]:
        """Ids, as int32 bytes, of each piece."""
        return self.known_pieces.of(pieces, lambda missing: self.merge(list(map(str.encode, missing))))

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids, as int32 bytes, of each string."""
        cut = list(map(self.pieces, words))
        known = self.piece_ids(set(chain.from_iterable(cut)))
        return [
            known[pieces[0]] if len(pieces) == 1 else b"".join(map(known.__getitem__, pieces)) for pieces in cut
        ]

    def word_sizes(self, words: list[str]) -> list[bytes]:
        """Characters and tokens of each piece of each string, in turn as int32 bytes."""
        cut = list(map(self.pieces, words))
        flat = list(chain.from_iterable(cut))
        known = self.piece_ids(set(flat))
        sizes = np.empty((len(flat), 2), np.int32)
        sizes[:, 0] = list(map(len, flat))
        sizes[:, 1] = list(map(len, map(known.__getitem__, flat)))
        sizes[:, 1] //= 4
        packed, ends = sizes.tobytes(), (8 * np.cumsum(list(map(len, cut)), dtype=np.int64)).tolist()
        return [packed[a:b] for a, b in zip([0, *ends], ends)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as int32 bytes."""
        return self._by_words(texts, self.known_words, self.encode_words)

    def sizes(self, texts: list[str]) -> list[bytes]:
        """Characters and tokens of the pieces of each text, as :meth:`word_sizes` has them."""
        return self._by_words(texts, self.known_sizes, self.word_sizes)

    def _by_words(self, texts: list[str], recent: Recent, make: Callable[[list[str]], list[bytes]]) -> list[bytes]:
        cut = [self.words(t) for t in texts]
        wanted = set()
        for parts in cut:
            wanted.update(parts[1:])
        known = recent.of(wanted, lambda words: make([" " + w for w in words]))
        heads = list({parts[0] for parts in cut})
        first = dict(zip(heads, make(heads)))
        return [
            first[parts[0]] + b"".join(map(known.__getitem__, parts[1:])) for parts in cut
        ]


@lru_cache(maxsize=2)
def _encoder(data: bytes, pattern: str) -> Encoder:
    return Encoder(Vocabulary(parse_ranks(data)), pattern)


def parts_of(texts: pa.Array, most: int = GROUP_CHARS) -> Iterator[pa.Array]:
    """Consecutive parts of about ``most`` bytes; a longer text is a part of its own."""
    sizes = np.cumsum(pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        before = sizes[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(sizes, before + most, "right")))
        yield texts.slice(start, stop - start)
        start = stop


def read_ranks(path: str) -> bytes:
    """A tokenizer's rank file, as installed with the driver; it is small and sent to the tasks."""
    with open(path, "rb") as file:
        return file.read()


def _lists(ids: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0, *(len(i) // 4 for i in ids)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), np.int32)))


def encode(
    docs: DataFrame,
    ranks: bytes,
    pattern: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_decoded: bool = False,
) -> DataFrame:
    """(doc_id, token_ids array<int>) of each row, without special tokens.

    With ``with_decoded`` the same pass adds ``decoded`` as :func:`decode` does. Null and empty texts
    have no tokens. Rows that repeat an id are encoded each; the id may be null. Other columns are
    not read; an empty table gives no rows. Nothing moves between tasks.
    """
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _encoder(shared.value, pattern), _decoder(shared.value)
        with remembered(encoder):
            for batch in batches:
                at, texts = 0, batch["text"]
                # Parts of a batch become Python strings one after the other.
                for part in parts_of(texts):
                    ids = encoder.encode([t or "" for t in part.to_pylist()])
                    columns = [batch["doc_id"].slice(at, len(part)), _lists(ids)]
                    if with_decoded:
                        bodies = [decoder.decode(np.frombuffer(i, np.int32)) for i in ids]
                        columns.append(pa.array(bodies, pa.binary()))
                    yield pa.record_batch(columns, names=["doc_id", "token_ids", "decoded"][: len(columns)])
                    at += len(part)

    chosen = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()
    return chosen.mapInArrow(
        run, f"doc_id {kind}, token_ids array<int>" + (", decoded binary" if with_decoded else "")
    )


def decode(encoded: DataFrame, ranks: bytes) -> DataFrame:
    """``encoded`` (doc_id, token_ids) with ``decoded``, the bytes the ids stand for; null if the ids are."""
    shared = encoded.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _decoder(shared.value)
        for batch in batches:
            lists = batch["token_ids"]
            bodies = [decoder.decode(ids.values.to_numpy()) if ids.is_valid else None for ids in lists]
            yield pa.record_batch(
                [batch["doc_id"], lists, pa.array(bodies, pa.binary())],
                names=["doc_id", "token_ids", "decoded"],
            )

    chosen = encoded.select("doc_id", "token_ids")
    kind = chosen.schema["doc_id"].dataType.simpleString()
    return chosen.mapInArrow(run, f"doc_id {kind}, token_ids array<int>, decoded binary")


def digests() -> list[Column]:
    """Count of the ids, and digests of them and of the decoded bytes."""
    return [
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("token_ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    ]
