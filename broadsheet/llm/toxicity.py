"""Toxicity: a logistic classifier whose score should not change with the group a text names.

1. Every labelled training row counts its features per class: words, word beginnings, and beginnings
   that several of its words share, hashed. The counts are summed by Spark. The features most
   telling, by the log-likelihood ratio of their counts, are kept, at most MAX_FEATURES, together
   with those of the identity terms.
2. The weights are fitted on a bounded sample of labelled rows, SAMPLE per class, the first by a
   hash of their id. Every row comes with a form that names an identity: the row itself if it does, else
   with a term put into it, which is learned with the row's label too. Each such form comes again with
   other identities in the term's place, and changes of the score between the two are penalised.
3. The weights score every text, in one pass without a shuffle.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain
from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.windows import remembered
from broadsheet.session import broadcast_if_small

BITS = 20
_MASK = (1 << BITS) - 1
#: Lengths of the word beginnings that are features, and numbers of words that share one that are.
BEGINNINGS = (4, 5, 6)
LEVELS = (2, 3, 5)
#: Labelled rows of each class the weights are fitted on, at most.
SAMPLE = 15_000
MAX_FEATURES = 4096
#: Least log-likelihood ratio (two times the log, as chi-squared) of a feature that is kept.
LEAST_RATIO = 25.0
THRESHOLD = 0.3
PENALTY = 10.0
#: Texts with another identity made of each sampled text that names one.
SWAPS = 2
_CACHED = 100_000
#: Words a task remembers: a large share stands in few texts. Most have nothing to score by, which is one shared value.
_CACHED_WORDS, _SCORED_WORDS = 200_000, 400_000

#: Terms of one row can stand for each other in a sentence.
IDENTITIES = (
    ("women", "men", "girls", "boys", "mothers", "fathers"),
    ("woman", "man", "girl", "boy", "mother", "father"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist", "catholic"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists", "catholics"),
    ("black", "white", "asian", "latino", "african", "european", "arab"),
    ("gay", "straight", "lesbian", "bisexual", "transgender", "queer"),
    ("blind", "deaf", "disabled", "elderly", "young"),
    ("immigrants", "refugees", "foreigners", "natives", "citizens"),
    ("mujeres", "hombres"),
    ("femmes", "hommes"),
    ("frauen", "männer"),
)
_ROW_OF = {term: row for row in IDENTITIES for term in row}
_word = re.compile(r"\w+").findall
_named = re.compile(r"\b(?:" + "|".join(sorted(_ROW_OF, key=len, reverse=True)) + r")\b", re.IGNORECASE)


class _Kept(dict):
    """Values of a function by its argument, a bounded number of them."""

    def __init__(self, value, most: int = _CACHED):
        super().__init__()
        self.value, self.most = value, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        found = self[key] = self.value(key)
        return found


def _hashed(part: str) -> int:
    return xxhash.xxh3_64_intdigest(part.encode()) & _MASK


# Many words share a beginning, so a word not met before is hashed once.
_starts = _Kept(lambda start: _hashed("^" + start))


def word_features(word: str) -> tuple[int, ...]:
    """Hashed features of a word: itself, then its beginnings."""
    return (_hashed("=" + word), *[_starts[word[:n]] for n in BEGINNINGS if len(word) >= n])


def repeated(beginning: int, times: int) -> list[int]:
    """Features of a beginning that several distinct words of a text share."""
    return [(beginning * 0x9E3779B1 + level * 0x85EBCA6B) & _MASK for level in LEVELS if times >= level]


_features = _Kept(word_features, _CACHED_WORDS)
_repeats = _Kept(lambda entry: repeated(*entry))
_first, _second = itemgetter(0), itemgetter(1)


def _distinct_features(text: str | None) -> set[int]:
    words = list(map(_features.__getitem__, set(_word(text.lower())))) if text else []
    times = Counter(chain.from_iterable(w[1:] for w in words))
    found = set(times)
    found.update(map(_first, words))
    found.update(chain.from_iterable(_repeats[entry] for entry in times.items() if entry[1] > 1))
    return found


def features(text: str | None) -> np.ndarray:
    """Distinct features of a text, sorted."""
    found = _distinct_features(text)
    return np.sort(np.fromiter(found, np.int64, len(found)))


def swapped(text: str, turn: int) -> str:
    """The text with every identity term replaced by the one ``turn`` places on in its row."""

    def other(match: re.Match) -> str:
        row = _ROW_OF[match[0].lower()]
        term = row[(row.index(match[0].lower()) + turn) % len(row)]
        return term.capitalize() if match[0][0].isupper() else term

    return _named.sub(other, text)


def naming(text: str) -> str:
    """The text if it names an identity, else with one term, told by the text, put between its words."""
    if _named.search(text):
        return text
    told = xxhash.xxh3_64_intdigest(text.encode())
    row = IDENTITIES[told % len(IDENTITIES)]
    words = text.split(" ")
    words.insert((told >> 16) % (len(words) + 1), row[(told >> 8) % len(row)])
    return " ".join(words)


def counterparts(text: str) -> list[str]:
    """The form of :func:`naming`, then up to SWAPS others with other identities in its terms' places."""
    named = naming(text)
    return [named, *dict.fromkeys(s for k in range(1, SWAPS + 1) if (s := swapped(named, k)) != named)]


@dataclass(frozen=True)
class Model:
    bias: float
    features: np.ndarray
    weights: np.ndarray


def held_out(doc_id: Column) -> Column:
    """Rows that labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def feature_counts(labelled: DataFrame) -> DataFrame:
    """(feature, toxic, clean): rows of each class with the feature, of all rows (text, toxic)."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((2, 1 << BITS), np.int32)
        with remembered(_features, _starts, _repeats):
            for batch in batches:
                for text, toxic in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist()):
                    found = _distinct_features(text)
                    totals[toxic, np.fromiter(found, np.int64, len(found))] += 1
        totals = totals.astype(np.int64)
        seen = np.flatnonzero(totals.any(axis=0))
        yield pa.record_batch(
            [pa.array(seen), pa.array(totals[1, seen]), pa.array(totals[0, seen])],
            names=["feature", "toxic", "clean"],
        )

    partial = labelled.select("text", "toxic").mapInArrow(count, "feature long, toxic long, clean long")
    return partial.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def select_features(labelled: DataFrame, n_toxic: int, n_clean: int) -> np.ndarray:
    """The most telling features and those of identity terms, sorted."""
    def part(count: Column, seen: Column, of_class: int) -> Column:
        expected = seen * (of_class / (n_toxic + n_clean))
        return F.when(count > 0, count * F.log(count / expected)).otherwise(0.0)

    toxic, clean, seen = F.col("toxic"), F.col("clean"), F.col("toxic") + F.col("clean")
    ratio = 2 * sum(
        part(here, all_here, size)
        for all_here, pairs in (
            (seen, ((toxic, n_toxic), (clean, n_clean))),
            (n_toxic + n_clean - seen, ((n_toxic - toxic, n_toxic), (n_clean - clean, n_clean))),
        )
        for here, size in pairs
    )
    ranked = feature_counts(labelled).select("feature", ratio.alias("ratio"))
    best = ranked.filter(F.col("ratio") >= LEAST_RATIO).orderBy(F.desc("ratio"), "feature").limit(MAX_FEATURES)
    chosen = [row[0] for row in best.select("feature").collect()]
    return np.unique(np.array([*chosen, *(f for term in _ROW_OF for f in word_features(term))], np.int64))


def _sample_rows(sample: DataFrame, chosen: np.ndarray) -> pa.Table:
    """Features, as positions in ``chosen``, of each sampled row, of the form that names an identity, and of
    that form's counterparts."""
    kept = sample.sparkSession.sparkContext.broadcast(chosen)

    def places(text: str | None) -> bytes:
        found = features(text)
        at = np.minimum(np.searchsorted(kept.value, found), len(kept.value) - 1)
        return at[kept.value[at] == found].astype(np.int32).tobytes()

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with remembered(_features, _starts, _repeats):
            for batch in batches:
                texts = batch["text"].to_pylist()
                forms = [list(map(places, counterparts(t or ""))) for t in texts]
                yield pa.record_batch(
                    [
                        batch["toxic"],
                        pa.array([places(t) for t in texts], pa.binary()),
                        pa.array([f[0] for f in forms], pa.binary()),
                        pa.array([f[1:] for f in forms], pa.list_(pa.binary())),
                    ],
                    names=["toxic", "own", "named", "others"],
                )

    schema = "toxic int, own binary, named binary, others array<binary>"
    return sample.select("text", "toxic").mapInArrow(rows, schema).toArrow()


def _without(rows: list[bytes], others: list[bytes]) -> list[bytes]:
    """Of each row, what the other one lacks."""
    pairs = ((np.frombuffer(a, np.int32), np.frombuffer(b, np.int32)) for a, b in zip(rows, others))
    return [np.setdiff1d(a, b, assume_unique=True).tobytes() for a, b in pairs]


class _Sparse:
    """Rows of feature positions."""

    def __init__(self, rows: list[bytes], width: int):
        parts = [np.frombuffer(r, np.int32) for r in rows]
        self.n, self.width = len(parts), width
        self.row = np.repeat(np.arange(self.n), [len(p) for p in parts])
        self.column = np.concatenate(parts) if parts else np.empty(0, np.int32)

    def dot(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.column], self.n)

    def back(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, values[self.row], self.width)


def fit_weights(
    labels: np.ndarray,
    own: list[bytes],
    others: list[list[bytes]],
    width: int,
    penalty: float = PENALTY,
    ridge: float = 1e-4,
    steps: int = 400,
    named: list[bytes] | None = None,
) -> tuple[float, np.ndarray]:
    """Bias and weights that minimise the log loss, the squared weights, and the squared change of
    the linear score between a row's form in ``named`` (``own`` if not given) and its swapped forms.

    Named forms that differ from their rows are learned too, with the same label.
    """
    if named is not None:
        added = _without(named, own)
        new = [i for i, more in enumerate(added) if more]
        pairs = [(row, other) for row, forms in zip(named, others) for other in forms]
        labels, own = np.r_[labels, labels[new]], [*own, *(named[i] for i in new)]
    else:
        pairs = [(row, other) for row, forms in zip(own, others) for other in forms]
    x = _Sparse(own, width)
    # Two forms differ in a few features only; the others do not change the score.
    left, right = [a for a, _ in pairs], [b for _, b in pairs]
    first, second = _Sparse(_without(left, right), width), _Sparse(_without(right, left), width)
    bias, weights = 0.0, np.zeros(width)
    speed, scale = np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, steps + 1):
        error = (1 / (1 + np.exp(-np.clip(x.dot(weights) + bias, -30, 30))) - labels) / max(1, x.n)
        slope = x.back(error) + ridge * weights
        if pairs:
            change = (first.dot(weights) - second.dot(weights)) * (penalty / len(pairs))
            slope = slope + first.back(change) - second.back(change)
        slope = np.r_[error.sum(), slope]
        # Adam, full batch.
        speed = 0.9 * speed + 0.1 * slope
        scale = 0.99 * scale + 0.01 * slope**2
        move = 0.1 * (speed / (1 - 0.9**step)) / (np.sqrt(scale / (1 - 0.99**step)) + 1e-9)
        bias, weights = bias - move[0], weights - move[1:]
    return bias, weights


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    penalty: float = PENALTY,
) -> Model:
    """Fit on the labelled rows that :func:`held_out` does not hold out.

    Labels that are null or have no document are not used; of labels that repeat an id each counts.
    Without labels of both classes the model has no weights, and its bias gives the share seen.
    """
    doc_id = F.col(id_column).alias("doc_id")
    marks = labels.select(doc_id, F.col(label_column).cast("int").alias("toxic"))
    marks = marks.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    texts = docs.select(doc_id, F.col(text_column).alias("text"))
    labelled = texts.join(broadcast_if_small(marks, 1_000_000), "doc_id")
    n_toxic, n = marks.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.count(F.lit(1))).first()
    if not 0 < n_toxic < n:
        share = (n_toxic + 0.5) / (n + 1)
        return Model(float(np.log(share / (1 - share))), np.empty(0, np.int64), np.empty(0))
    chosen = select_features(labelled, n_toxic, n - n_toxic)
    order = F.xxhash64("doc_id")
    parts = [marks.filter(F.col("toxic") == c).orderBy(order, "doc_id").limit(SAMPLE) for c in (0, 1)]
    sample = texts.join(F.broadcast(parts[0].union(parts[1])), "doc_id")
    rows = _sample_rows(sample, chosen)
    toxic = rows["toxic"].to_numpy().astype(float)
    own, named, others = (rows[c].to_pylist() for c in ("own", "named", "others"))
    bias, weights = fit_weights(toxic, own, others, len(chosen), penalty, named=named)
    # The sample may hold another share of toxic rows than all labels do.
    if len(toxic) and 0 < toxic.sum() < len(toxic):
        bias += np.log(n_toxic / (n - n_toxic)) - np.log(toxic.sum() / (len(toxic) - toxic.sum()))
    used = np.abs(weights) > 1e-3
    return Model(float(bias), chosen[used], weights[used])


_NO_FEATURES: tuple[tuple[int, ...], tuple[int, ...]] = ((), ())


class _Scorer:
    def __init__(self, model: Model):
        weight = dict(zip(model.features.tolist(), model.weights.tolist()))
        self.bias, self.weight = model.bias, weight
        # Beginnings matter if they or one of their repetitions have a weight.
        matters = _Kept(lambda b: b in weight or any(r in weight for r in repeated(b, LEVELS[-1])))

        def known(word: str) -> tuple[tuple[int, ...], tuple[int, ...]]:
            own, *beginnings = word_features(word)
            matter = tuple([b for b in beginnings if matters[b]])
            return ((own,) if own in weight else (), matter) if matter or own in weight else _NO_FEATURES

        self.known = _Kept(known, _SCORED_WORDS)
        # Features with a weight of a beginning and of how often it is shared.
        self.shared = _Kept(lambda e: [f for f in (e[0], *repeated(*e)) if f in weight])
        self.caches = self.known, self.shared, matters

    def score(self, text: str | None) -> float:
        words = list(map(self.known.__getitem__, set(_word(text.lower())))) if text else []
        found = set(chain.from_iterable(map(_first, words)))
        times = Counter(chain.from_iterable(map(_second, words)))
        found.update(chain.from_iterable(map(self.shared.__getitem__, times.items())))
        linear = self.bias + sum(map(self.weight.__getitem__, sorted(found)))
        return float(1 / (1 + np.exp(-np.clip(linear, -30, 30))))


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, score): the probability that each row is toxic, from its whole text.

    Null and empty texts get the score of no features. Rows that repeat an id are scored each. Other
    columns are not read; an empty table gives no rows.
    """
    chosen = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(shared.value)
        with remembered(*scorer.caches, _starts):
            for batch in batches:
                scores = pa.array([scorer.score(t) for t in batch["text"].to_pylist()], pa.float64())
                yield pa.record_batch([batch["doc_id"], scores], names=["doc_id", "score"])

    return chosen.mapInArrow(run, f"doc_id {chosen.schema['doc_id'].dataType.simpleString()}, score double")


def reject(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that score less than ``threshold``, with all columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(shared.value)
        with remembered(*scorer.caches, _starts):
            for batch in batches:
                keep = [scorer.score(t.as_py()) < threshold for t in batch[text_column]]
                yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
