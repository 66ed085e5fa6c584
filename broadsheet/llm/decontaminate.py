"""Benchmark decontamination: documents that hold benchmark items, also with other numbers and names.

Texts are turned into templates: numbers, names and units become typed placeholders. Windows of
the items' templates are looked up by hash in every task that reads documents; where windows hit,
the item is laid over the document, and the slots are compared: one value of the item has to
stand for one value of the document throughout. What then matches decides. Runs of names, and a
number with its unit, are one placeholder, and what matches at nearby places is taken together, so
slots of another number of words and words put in break nothing. A word left out or changed breaks
the windows that hold it.

A capital at the start of a sentence may or may not make a name, so every text has three forms: one
without names there, one where any capitalised word but a function word is a name, and the plain
words, without placeholders. Of the first two, windows with fewer than LEAST_LITERAL words other
than placeholders are not looked up; of the plain words all are, so verbatim copies are always found.

The benchmark is sent to the tasks in blocks of a bounded number of words. A larger benchmark is
more passes over the documents, never a larger block. Documents do not move.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm import windows as W

#: Words of a template window, and how many of them at least must not be placeholders.
WINDOW = 8
LEAST_LITERAL = 4
#: An item is held if this share of its windows matches, or this many words in a row do.
COVERAGE = 0.5
RUN = 13
#: Places this near are taken together, if at least PIECE words in a row agree there; SHIFTS of them
#: without a hit of their own too.
NEAR = 8
PIECE = 3
SHIFTS = 2
#: Words of the benchmark that are sent to the tasks at once.
BLOCK_WORDS = 1_000_000

UNITS = (
    "mm cm m km in ft yd mi mile miles meter meters metre metres inch inches foot feet yard yards mg g kg lb lbs oz"
    " gram grams kilogram kilograms pound pounds ton tons ml l liter liters litre litres gallon gallons s sec second"
    " seconds min minute minutes h hr hour hours day days week weeks month months year years dollar dollars euro euros"
    " cent cents percent degree degrees mph kmh km/h hz khz mhz kb mb gb tb w kw v amp amps"
).split()
_UNITS = frozenset(u.encode() for u in UNITS)
#: Words that are no names where a capital may come from the start of a sentence.
_FUNCTION_WORDS = frozenset(
    w.encode()
    for w in (
        "a an the this that these those i you he she it we they his her its my your our their who whom whose what which"
        " when where why how if in on at to of for from by with and or but so as is are was were be do does did has have had"
        " can could will would shall should may might must not no there here then than after before each every all some any"
        " one two three after during while el la los las un una de en y o que se su con por para no es al lo le les der die"
        " das ein eine und oder in im zu mit von auf ist sind wie was wer wo wenn er sie es wir ihr le la les un une des du"
        " et ou dans sur avec pour par est sont que qui il elle nous vous ils elles"
    ).split()
)
_NUMBER = re.compile(rb"[+-]?[$\xe2\x82\xac\xc2\xa3]*[0-9][0-9.,:/]*%?\Z")
_MEASURE = re.compile(rb"([+-]?[0-9][0-9.,]*)([A-Za-z/]+)\Z")
_EDGES = b".,;:!?\"'()[]{}*#$%&|<>"
_ENDS = (b".", b"!", b"?", b":")
_STOPS = (*_ENDS, b",", b";")
_CACHED = 300_000
#: Bits of the table that tells most windows apart from all of the index.
_TABLE_BITS = 20
PLACEHOLDERS = ("<number>", "<name>", "<unit>", "<measure>")
_SLOT = np.array([xxhash.xxh3_64_intdigest(p) for p in PLACEHOLDERS], np.uint64)
_NUMBER_SLOT, _NAME_SLOT, _UNIT_SLOT, _MEASURE_SLOT = range(4)


def _is_name(text: str) -> bool:
    return len(text) > 1 and text[0].isupper() and text[1:].islower()


def classify(word: bytes, first: bool) -> tuple[int, int]:
    """(hash of the canonical word, slot type): -1 for a literal, else its place in PLACEHOLDERS.

    ``first`` tells that the word begins a sentence, where a capital makes no name.
    """
    bare = word.strip(_EDGES)
    lower = bare.decode().lower().encode()
    if _NUMBER.match(bare):
        slot = _NUMBER_SLOT
    elif lower in _UNITS:
        slot = _UNIT_SLOT
    elif (measure := _MEASURE.match(bare)) and measure[2].lower() in _UNITS:
        slot = _MEASURE_SLOT
    else:
        if first or not _is_name(bare.decode()):
            return xxhash.xxh3_64_intdigest(lower), -1
        slot = _NAME_SLOT
    return int(_SLOT[slot]), slot


class _Words(dict):
    """Place of a word in two columns: hash of the lower word, and a byte of what it can be: its slot type
    inside a sentence plus one, then the bits below."""

    FUNCTION, ENDS, STOPS = 8, 16, 32

    def __init__(self):
        self.hashes, self.kinds = array("Q"), bytearray()

    def __missing__(self, word: bytes) -> int:
        place = len(self.hashes)
        bare = word.strip(_EDGES)
        if bare.isalpha() and bare.islower():
            lower, slot = bare, _UNIT_SLOT if bare in _UNITS else -1
        else:
            text = bare.decode()
            lower = text.lower().encode()
            if not text.isalpha():
                slot = classify(word, False)[1]
            elif lower in _UNITS:
                slot = _UNIT_SLOT
            else:
                slot = _NAME_SLOT if _is_name(text) else -1
        kind = slot + 1 + self.FUNCTION * (lower in _FUNCTION_WORDS)
        self.kinds.append(kind + self.ENDS * word.endswith(_ENDS) + self.STOPS * word.endswith(_STOPS))
        self.hashes.append(xxhash.xxh3_64_intdigest(lower))
        self[word] = place
        return place

    def clear(self) -> None:
        super().clear()
        self.__init__()


_known = _Words()


@dataclass
class Template:
    """Canonical words of a text; each stands for ``sizes`` words from ``starts`` on."""

    words: list[bytes]
    starts: np.ndarray
    sizes: np.ndarray
    hashes: np.ndarray
    slots: np.ndarray

    def values(self, i: int) -> list[bytes]:
        """What fills a slot: a name, a number, a unit, or number and unit."""
        bare = [w.strip(_EDGES) for w in self.words[self.starts[i] : self.starts[i] + self.sizes[i]]]
        if self.slots[i] == _MEASURE_SLOT and len(bare) == 1:
            return list(_MEASURE.match(bare[0]).groups())
        return bare if self.slots[i] == _MEASURE_SLOT else [b" ".join(bare)]


def templates(body: bytes | None) -> list[Template]:
    """The forms of a text."""
    words = W.words_of(body)
    if len(_known) >= _CACHED:
        _known.clear()
    at = np.fromiter(map(_known.__getitem__, words), np.int64, len(words))
    lower, kinds = np.frombuffer(_known.hashes, np.uint64)[at], np.frombuffer(_known.kinds, np.uint8)[at]
    inside, name = (kinds & 7).astype(np.int8) - 1, (kinds & 7) == _NAME_SLOT + 1
    first = _after((kinds & _Words.ENDS) > 0, True)
    goes_on = _after((kinds & _Words.STOPS) == 0, False)
    starting = np.where(first & name, -1, inside)
    wide = np.where(name & (kinds & _Words.FUNCTION > 0), -1, inside)
    plain = Template(words, np.arange(len(words)), np.ones(len(words), np.int64), lower, np.full(len(words), -1))
    return [*(_joined(words, lower, slots, goes_on) for slots in (starting, wide)), plain]


def _after(values: np.ndarray, first) -> np.ndarray:
    """What stands before each place."""
    out = np.empty_like(values)
    out[:1], out[1:] = first, values[:-1]
    return out


def _joined(words: list[bytes], lower: np.ndarray, slots: np.ndarray, goes_on: np.ndarray) -> Template:
    before = _after(slots, -1)
    of_number = goes_on & (slots == _UNIT_SLOT) & (before == _NUMBER_SLOT)
    starts = np.flatnonzero(~(of_number | (goes_on & (slots == _NAME_SLOT) & (before == _NAME_SLOT))))
    numbers = np.flatnonzero(of_number) - 1
    slots = slots.copy()
    slots[numbers] = _MEASURE_SLOT
    slots = slots[starts]
    hashes = np.where(slots >= 0, _SLOT[slots], lower[starts])
    sizes = np.empty(len(starts), np.int64)
    sizes[:-1] = starts[1:] - starts[:-1]
    sizes[-1:] = len(words) - starts[-1:]
    return Template(words, starts, sizes, hashes, slots)


def _literal_enough(slots: np.ndarray, size: int) -> np.ndarray:
    literal = np.cumsum(np.r_[0, slots < 0])
    return literal[size:] - literal[:-size] >= min(LEAST_LITERAL, size)


def _probes(n: int) -> set[int]:
    """Sizes of the windows looked up for an item: one of two halves of a short item has half its words."""
    return {min(WINDOW, n), n // 2} if WINDOW <= n < 2 * WINDOW else {min(WINDOW, n)} - {0}


def _runs(agree: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(np.r_[False, agree, False].astype(np.int8)))
    return edges[::2], edges[1::2]


class Items:
    """A block of benchmark items with the index of their windows, per form."""

    def __init__(self, ids: list[int], bodies: list[bytes | None]):
        self.ids = ids
        self.templates = list(zip(*map(templates, bodies)))
        self.index = [self._indexed(of_form) for of_form in self.templates]
        self.table = [self._table(index) for index in self.index]

    @staticmethod
    def _indexed(of_form: Iterable[Template]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        by_size: dict[int, list] = {}
        for item, one in enumerate(of_form):
            for size in _probes(len(one.hashes)):
                keys = W.rolling(one.hashes, size, 3)
                at = np.flatnonzero(_literal_enough(one.slots, size))
                by_size.setdefault(size, []).append((keys[at], np.full(len(at), item), at))
        index = {}
        for size, parts in by_size.items():
            keys, items, at = (np.concatenate(c) for c in zip(*parts))
            order = np.argsort(keys, kind="stable")
            index[size] = keys[order], items[order], at[order]
        return index

    @staticmethod
    def _table(index: dict) -> np.ndarray:
        table = np.zeros(1 << _TABLE_BITS, bool)
        for keys, _, _ in index.values():
            table[keys >> np.uint64(64 - _TABLE_BITS)] = True
        return table

    def matches(self, body: bytes | None) -> list[tuple]:
        """(item_id, n_windows, n_matched, longest_run, n_slots, exact) of each item the text holds."""
        best: dict[int, tuple] = {}
        docs = templates(body)
        # A document whose forms are the same still meets the items' own forms.
        rolled = [W.Rolling(docs[0].hashes, 3)]
        for before, doc in zip(docs, docs[1:]):
            rolled.append(rolled[-1] if np.array_equal(before.hashes, doc.hashes) else W.Rolling(doc.hashes, 3))
        for of_form, index, table, doc, rolling in zip(self.templates, self.index, self.table, docs, rolled):
            for item, places in self._places(index, table, rolling).items():
                n_windows = max(1, len(of_form[item].hashes) - WINDOW + 1)
                if item in best and best[item][1] == best[item][0]:
                    continue
                found = (n_windows, *self._laid_near(of_form[item], doc, sorted(places), n_windows))
                # Of two forms the one that matches more; the first if both match as much.
                if item not in best or found[1] * best[item][0] > best[item][1] * n_windows:
                    longest = max(found[2], best[item][2]) if item in best else found[2]
                    best[item] = (*found[:2], longest, *found[3:])
                elif found[2] > best[item][2]:
                    best[item] = (*best[item][:2], found[2], *best[item][3:])
        return [
            (self.ids[item], *one) for item, one in best.items() if one[1] >= COVERAGE * one[0] or one[2] >= RUN
        ]

    @staticmethod
    def _places(index: dict, table: np.ndarray, rolling: W.Rolling) -> dict[int, set[int]]:
        """Where windows of each item hit: place of the document less place of the item."""
        offsets: dict[int, set[int]] = {}
        for size, (keys, items, at) in index.items():
            probes = rolling.of(size)
            maybe = np.flatnonzero(table[probes >> np.uint64(64 - _TABLE_BITS)])
            for position in maybe[W.lookup(keys, probes[maybe])[0]] if len(maybe) else ():
                low, high = np.searchsorted(keys, probes[position], "left"), np.searchsorted(keys, probes[position], "right")
                for entry in range(low, high):
                    offsets.setdefault(int(items[entry]), set()).add(int(position - at[entry]))
        return offsets

    @classmethod
    def _laid_near(cls, item: Template, doc: Template, places: list[int], n_windows: int) -> tuple[int, int, int, bool]:
        best = (-1, 0, 0, False)
        for place in places:
            near = {p for p in places if abs(p - place) <= NEAR} | {place + d for d in range(-SHIFTS, SHIFTS + 1)}
            best = max(best, cls._laid(item, doc, sorted(near, key=lambda p: (abs(p - place), p))))
            if best[0] == n_windows:
                break
        return best

    @staticmethod
    def _laid(item: Template, doc: Template, places: list[int]) -> tuple[int, int, int, bool]:
        """Windows that agree with the item laid at the first place, and near it where that does not agree, and
        the longest run of words at one place; slots included."""
        n = len(item.hashes)
        held, longest, n_slots, exact = np.zeros(n, bool), 0, 0, True
        stands_for: dict[bytes, bytes] = {}
        for place in places:
            low, high = max(0, -place), min(n, len(doc.hashes) - place)
            if high <= low or held.all():
                continue
            agree = np.zeros(n, bool)
            agree[low:high] = item.hashes[low:high] == doc.hashes[low + place : high + place]
            if place != places[0]:
                agree &= ~held
                for a, b in zip(*_runs(agree)):
                    agree[a:b] = b - a >= PIECE
            for i in np.flatnonzero(agree & (item.slots >= 0)):
                pairs = list(zip(item.values(i), doc.values(i + place)))
                if all(stands_for.setdefault(mine, theirs) == theirs for mine, theirs in pairs):
                    n_slots += 1
                    exact &= all(mine == theirs for mine, theirs in pairs)
                else:
                    agree[i] = exact = False
            for a, b in zip(*_runs(agree)):
                longest = max(longest, int(item.sizes[a:b].sum()))
            held |= agree
        starts, stops = _runs(held)
        return int(np.maximum(stops - starts - min(WINDOW, n) + 1, 0).sum()), longest, n_slots, exact


def _blocks(benchmark: DataFrame, id_column: str, text_column: str) -> Iterator[Items]:
    """The items, in blocks of about BLOCK_WORDS words; no item is in two."""
    items = benchmark.select(
        F.col(id_column).cast("long").alias("item_id"), F.col(text_column).cast("binary").alias("body")
    ).filter(F.col("item_id").isNotNull() & (F.octet_length("body") > 0))
    chars = items.agg(F.sum(F.octet_length("body").cast("long"))).first()[0] or 0
    n_blocks = math.ceil(chars / (6 * BLOCK_WORDS))
    for block in range(n_blocks):
        part = items.filter(F.pmod(F.xxhash64("item_id"), F.lit(n_blocks)) == block).orderBy("item_id").toArrow()
        yield Items(part["item_id"].to_pylist(), part["body"].to_pylist())


FOUND = "item_id long, n_windows long, n_matched long, longest_run long, n_slots long, exact boolean"


def find_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """(doc_id, item_id, n_windows, n_matched, longest_run, n_slots, exact): a row per document and item it holds.

    A document holds an item if COVERAGE of its template windows match at nearby places, or RUN words
    in a row at one place, with consistent slots. Of the forms of a text (see above) the one that
    matches more counts. ``exact`` tells that all slot values are the item's own. Items
    without id or text, and documents without text, match nothing. Rows that repeat an id give a
    row each. An item of fewer words than a window is one window. With other values, an item is found only
    if some of its windows have LEAST_LITERAL words that are no placeholders, or all of a shorter window;
    verbatim, with any. Other columns are not read.
    """
    chosen = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("binary").alias("body"))
    kind = chosen.schema["doc_id"].dataType.simpleString()
    context, result = docs.sparkSession.sparkContext, None
    for items in _blocks(benchmark, item_column, item_text):
        shared = context.broadcast(items)

        def run(batches: Iterable[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            with W.remembered(_known):
                for batch in batches:
                    places, rows = [], []
                    for i, body in enumerate(batch["body"]):
                        found = shared.value.matches(body.as_py())
                        rows += found
                        places += [i] * len(found)
                    columns = list(zip(*rows)) or [()] * 6
                    arrays = [pa.array(c, pa.bool_() if n == 5 else pa.int64()) for n, c in enumerate(columns)]
                    names = [part.split()[0] for part in FOUND.split(", ")]
                    ids = batch["doc_id"].take(pa.array(places, pa.int64()))
                    yield pa.record_batch([ids, *arrays], names=["doc_id", *names])

        part = chosen.mapInArrow(run, f"doc_id {kind}, {FOUND}")
        result = part if result is None else result.union(part)
    if result is None:
        return docs.sparkSession.createDataFrame([], f"doc_id {kind}, {FOUND}")
    return result


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no item, with all columns as they are."""
    for items in _blocks(benchmark, "item_id", "text"):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterable[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            with W.remembered(_known):
                for batch in batches:
                    bodies = (t.as_py() or b"" for t in batch[text_column].cast(pa.binary()))
                    yield batch.filter(pa.array([not shared.value.matches(b) for b in bodies], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
