"""Approximate nearest neighbours by inner product: NN-descent builds a graph, greedy search uses it.

Vectors get one more component that makes all of them equally long, so that the nearest by
distance are the largest inner products of a query, whose own component is nought. That component
is kept as the difference from the one of a vector of median length: a few very long vectors leave
the distances of all others as they are. Equal vectors are one node. Graph and search compare
vectors in half precision; the hits are ranked by the original vectors in double precision.

*Building.* Nodes sorted by random hyperplanes meet their neighbours in order, which gives first
lists of DEGREE neighbours. Then rounds of NN-descent: every node writes to its neighbours, and
gets back those of their neighbours (and of the nodes that have them as neighbour) that are nearer
than its own farthest one. Each round is one exchange there and one back, by buckets of nodes; a
node that very many have as neighbour answers all of them, and passes on a sample of them.

*Search.* A query keeps a beam of the nearest nodes found. In each round it writes to the nearest
ones it has not asked yet and takes in their neighbours, until all of the beam were asked. Its
first round needs no exchange: the lists of all entries, some nodes by a hash and the longest ones,
are bounded and go to every task.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.llm.scratch import Scratch

#: Neighbours in a node's list, and nodes of those that have it in theirs that it passes on.
DEGREE = 24
REVERSE = 24
#: Rounds of NN-descent, and candidates of one answer.
ROUNDS = 6
ANSWERS = 6
#: Random orders of the first lists, nodes compared with each other there, and neighbours kept of each.
ORDERS = 4
TOGETHER = 96
FIRST = 8
HYPERPLANES = 12
#: Nodes of one bucket of the exchanges.
BUCKET_NODES = 1500
#: Beam of a query, and nodes it asks at once.
BEAM = 160
ASKED = 32
#: Nodes, the first by a hash and the longest, whose nearest begin a search besides the query's own node.
ENTRIES = 192
LONGEST = 64
#: Largest component in half precision.
_LARGEST = 30_000.0

_GRAPH = "node long, bucket int, code binary, ids binary, sims binary, fresh binary, codes binary"
_NAMES = [p.split()[0] for p in _GRAPH.split(", ")]
_MESSAGE = "bucket int, dest binary, src binary, least binary, fresh binary, known binary, codes binary"
_ANSWER = "bucket int, dest binary, ids binary, sims binary, codes binary"
_MARKS = 256


def _floats(data: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(data), np.float16).reshape(-1, width)


def _nearness(own: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Orders ``others`` as their distance from each of ``own`` does: the same is left out of all of a row."""
    others = others.astype(np.float32)
    return own.astype(np.float32) @ others.T - 0.5 * np.einsum("ij,ij->i", others, others)


def _bucket(nodes: np.ndarray, buckets: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        mixed = nodes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(33)) % np.uint64(buckets)).astype(np.int32)


def _marks(ids: np.ndarray, salt: int) -> np.ndarray:
    """The bit of each id in a filter of _MARKS bits; another salt gives other bits."""
    with np.errstate(over="ignore"):
        mixed = (ids.astype(np.uint64) + np.uint64(salt + 1)) * np.uint64(0xBF58476D1CE4E5B9)
    return ((mixed >> np.uint64(40)) % np.uint64(_MARKS)).astype(np.int64)


def _packed(buckets: np.ndarray, columns: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """One row per bucket with its part of every column."""
    if not len(buckets):
        return
    order = np.argsort(buckets, kind="stable")
    where = buckets[order]
    cuts = np.flatnonzero(np.r_[True, where[1:] != where[:-1]])
    ends = np.r_[cuts[1:], len(where)]
    arrays = [pa.array(where[cuts].astype(np.int32))]
    for values in columns.values():
        ordered = values[order]
        arrays.append(pa.array([ordered[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary()))
    yield pa.record_batch(arrays, names=["bucket", *columns])


def _column(table: pa.Table, name: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(table[name].to_pylist()), kind)


class _Lists:
    """Neighbour lists of some nodes, flat: row, id, similarity, fresh and code of each entry."""

    def __init__(self, table: pa.Table, width: int):
        self.width = width
        self.nodes = table["node"].to_numpy().astype(np.int64)
        self.own = _floats(table["code"].to_pylist(), width)
        sizes = [len(b) // 8 for b in table["ids"].to_pylist()]
        self.row = np.repeat(np.arange(len(sizes)), sizes)
        self.ids = _column(table, "ids", np.int64)
        self.sims = _column(table, "sims", np.float32)
        self.fresh = _column(table, "fresh", bool)
        self.codes = _floats(table["codes"].to_pylist(), width)
        self.ends = np.cumsum(sizes).astype(np.int64)

    def part(self, row: int) -> slice:
        return slice(self.ends[row - 1] if row else 0, self.ends[row])


def _nearest(rows: np.ndarray, ids: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
    """Places of the best entries of every row, each id once; ties go to the smaller id."""
    order = np.lexsort((ids, rows))
    first = np.r_[True, (rows[order][1:] != rows[order][:-1]) | (ids[order][1:] != ids[order][:-1])]
    order = order[first[: len(order)]]
    order = order[np.lexsort((ids[order], -sims[order], rows[order]))]
    start = np.searchsorted(rows[order], rows[order], "left")
    return order[np.arange(len(order)) - start < most]


def _rows(lists, rows, ids, sims, fresh, codes, bucket) -> pa.Table:
    """Table of _GRAPH from flat entries, ordered by row."""
    n = len(lists.nodes)
    cuts = np.searchsorted(rows, np.arange(n + 1))
    cut = lambda v: pa.array([v[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary())
    own = pa.array([c.tobytes() for c in lists.own], pa.binary())
    columns = [pa.array(lists.nodes), pa.array(np.full(n, bucket, np.int32)), own]
    return pa.table([*columns, *map(cut, (ids, sims, fresh, codes))], names=_NAMES)


def _merge(width: int, most: int):
    """Takes the answers into the lists; what stays of a list is no longer fresh."""

    def merge(state: pa.Table, answers: pa.Table) -> pa.Table:
        if not state.num_rows:
            return state.select(_NAMES)
        lists = _Lists(state, width)
        order = np.argsort(lists.nodes)
        dest = _column(answers, "dest", np.int64)
        row = order[np.searchsorted(lists.nodes[order], dest)] if len(dest) else np.empty(0, np.int64)
        rows = np.r_[lists.row, row]
        ids = np.r_[lists.ids, _column(answers, "ids", np.int64)]
        sims = np.r_[lists.sims, _column(answers, "sims", np.float32)]
        fresh = np.r_[np.zeros(len(lists.row), bool), np.ones(len(row), bool)]
        codes = np.concatenate([lists.codes, _floats(answers["codes"].to_pylist(), width)])
        best = _nearest(rows, ids, sims, most)
        return _rows(lists, rows[best], ids[best], sims[best], fresh[best], codes[best], state["bucket"][0].as_py())

    return merge


def _first_lists(width: int, buckets: int):
    """Nodes next to each other in a random order, compared TOGETHER at a time."""

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, orders = batch["node"].to_numpy(), batch["tree"].to_numpy()
            codes = _floats(batch["code"].to_pylist(), width)
            out = []
            for tree in np.unique(orders):
                members = np.flatnonzero(orders == tree)
                for start in range(0, len(members), TOGETHER):
                    part = members[start : start + TOGETHER]
                    sims = _nearness(codes[part], codes[part])
                    np.fill_diagonal(sims, -np.inf)
                    count = min(FIRST, len(part) - 1)
                    near = np.argpartition(-sims, count - 1, axis=1)[:, :count] if count > 0 else np.empty((len(part), 0), int)
                    here = np.repeat(np.arange(len(part)), near.shape[1])
                    out.append((nodes[part][here], part[near.ravel()], sims[here, near.ravel()]))
            dest, near, sims = (np.concatenate(c) for c in zip(*out))
            columns = {"dest": dest, "ids": nodes[near], "sims": sims.astype(np.float32), "codes": codes[near]}
            yield from _packed(_bucket(dest, buckets), columns)

    return compare


def _send(width: int, buckets: int, salt: int):
    """Every node's message to each of its neighbours."""

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = _Lists(pa.table(batch), width)
            known = np.zeros((len(lists.nodes), _MARKS), bool)
            known[lists.row, _marks(lists.ids, salt)] = True
            known = np.packbits(known, axis=1)
            full = np.diff(np.r_[0, lists.ends]) >= DEGREE
            least = np.full(len(lists.nodes), -np.inf, np.float32)
            np.minimum.at(found := np.full(len(lists.nodes), np.inf, np.float32), lists.row, lists.sims)
            least[full] = found[full]
            columns = {
                "dest": lists.ids,
                "src": lists.nodes[lists.row],
                "least": least[lists.row],
                "fresh": lists.fresh,
                "known": known[lists.row],
                "codes": lists.own[lists.row],
            }
            yield from _packed(_bucket(lists.ids, buckets), columns)

    return send


class _Inbox:
    """Messages to the nodes of a bucket, by node."""

    def __init__(self, table: pa.Table, lists: _Lists, width: int):
        dest = _column(table, "dest", np.int64)
        order = np.argsort(dest, kind="stable")
        self.src = _column(table, "src", np.int64)[order]
        self.least = _column(table, "least", np.float32)[order]
        self.fresh = _column(table, "fresh", bool)[order]
        self.known = _column(table, "known", np.uint8).reshape(-1, _MARKS // 8)[order]
        self.codes = _floats(table["codes"].to_pylist(), width)[order]
        self.start = np.searchsorted(dest[order], lists.nodes, "left")
        self.stop = np.searchsorted(dest[order], lists.nodes, "right")

    def passed_on(self, row: int) -> np.ndarray:
        """A sample of who wrote: all, or evenly spread ones."""
        n = self.stop[row] - self.start[row]
        return self.start[row] + (np.arange(n) if n <= REVERSE else np.linspace(0, n - 1, REVERSE).astype(np.int64))


def _answer(width: int, buckets: int, salt: int):
    """For each message, the nearest new neighbours of the node written to."""

    def answer(state: pa.Table, messages: pa.Table) -> pa.Table:
        out = []
        if state.num_rows and messages.num_rows:
            lists = _Lists(state, width)
            inbox = _Inbox(messages, lists, width)
            for row in range(len(lists.nodes)):
                a, b = inbox.start[row], inbox.stop[row]
                if a == b:
                    continue
                own, others = lists.part(row), inbox.passed_on(row)
                ids = np.r_[lists.ids[own], inbox.src[others]]
                fresh = np.r_[lists.fresh[own], inbox.fresh[others]]
                codes = np.concatenate([lists.codes[own], inbox.codes[others]])
                marks = _marks(ids, salt)
                # Very many writers are answered in parts.
                for low in range(a, b, 4096):
                    part = slice(low, min(low + 4096, b))
                    sims = _nearness(inbox.codes[part], codes)
                    seen = (inbox.known[part][:, marks >> 3] >> (7 - (marks & 7)).astype(np.uint8)) & 1
                    able = (sims > inbox.least[part][:, None]) & (seen == 0)
                    able &= (inbox.fresh[part][:, None] | fresh) & (inbox.src[part][:, None] != ids)
                    sims = np.where(able, sims, -np.inf)
                    if sims.shape[1] > ANSWERS:
                        near = np.argpartition(-sims, ANSWERS - 1, axis=1)[:, :ANSWERS]
                    else:
                        near = np.broadcast_to(np.arange(sims.shape[1]), sims.shape)
                    who, which = np.nonzero(np.take_along_axis(sims, near, 1) > -np.inf)
                    which = near[who, which]
                    out.append((inbox.src[part][who], ids[which], sims[who, which].astype(np.float32), codes[which]))
        names = ("dest", "ids", "sims", "codes")
        if not any(len(part[0]) for part in out):
            return pa.schema([("bucket", pa.int32()), *[(c, pa.binary()) for c in names]]).empty_table()
        columns = dict(zip(names, (np.concatenate(c) for c in zip(*out))))
        return pa.Table.from_batches(list(_packed(_bucket(columns["dest"], buckets), columns)))

    return answer


def valid(vector: Column) -> Column:
    """Whether a vector takes part: not null, no component null or not finite, not all nought."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _length(vector: Column) -> Column:
    """Euclidean length, also where squares would be too large or too small."""
    most = F.array_max(F.transform(vector, F.abs))
    return most * F.sqrt(F.aggregate(F.transform(vector, lambda x: x / most), F.lit(0.0), lambda a, x: a + x * x))


def _distinct(vectors: DataFrame, members: int) -> DataFrame:
    """(node, vector, members): equal vectors as one, with the smallest ids they stand for.

    The smallest are first taken per salt, so that one vector of very many rows meets nowhere whole.
    """
    salt = F.pmod(F.xxhash64("vec_id"), F.lit(32))
    order = Window.partitionBy("vector", "salt").orderBy("vec_id")
    some = vectors.withColumn("salt", salt).withColumn("n", F.row_number().over(order)).filter(F.col("n") <= members)
    groups = some.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("all"))
    return groups.select(F.get("all", F.lit(0)).alias("node"), "vector", F.slice("all", 1, members).alias("members"))


class Index:
    """A neighbour graph of all vectors, in written tables.

    ``nodes`` (node, vector, members, bucket) and ``graph`` (_GRAPH, reverse neighbours included).
    """

    def __init__(self, vectors: DataFrame, id_column: str, vector_column: str, members: int):
        self.scratch = scratch = Scratch(vectors.sparkSession, "ann")
        rows = vectors.select(
            F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("vector")
        )
        rows = rows.filter(F.col("vec_id").isNotNull() & valid(F.col("vector")))
        smallest = rows.agg(F.min_by(F.size("vector"), "vec_id"), F.count(F.lit(1))).first()
        self.dimension, n = smallest[0] or 0, smallest[1]
        self.width = self.dimension + 1
        self.buckets = buckets = max(1, math.ceil(n / BUCKET_NODES))
        rows = rows.filter(F.size("vector") == self.dimension)
        self.nodes = scratch.write(_distinct(rows, members))
        lengths = self.nodes.agg(F.max(_length(F.col("vector"))), F.percentile_approx(_length(F.col("vector")), 0.5))
        self.longest, self.median = (length or 1.0 for length in lengths.first())
        self.coded = scratch.write(self.nodes.mapInArrow(self._code(), "node long, bucket int, code binary"))
        self.graph = self._build()

    def _code(self):
        longest, median, width, buckets = self.longest, self.median, self.width, self.buckets
        scale = min(longest / median, _LARGEST)
        its_rest = math.sqrt(max(0.0, 1 - (median / longest) ** 2))

        def code(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                values = batch["vector"].flatten().to_numpy().reshape(batch.num_rows, width - 1) / longest
                square = (values**2).sum(axis=1)
                both = np.maximum(its_rest + np.sqrt(np.maximum(0, 1 - square)), 1e-12)
                codes = (np.c_[values, (square - (median / longest) ** 2) / both] * scale).astype(np.float16)
                bucket = _bucket(batch["node"].to_numpy(), buckets)
                column = pa.array([c.tobytes() for c in codes], pa.binary())
                yield pa.record_batch([batch["node"], pa.array(bucket), column], names=["node", "bucket", "code"])

        return code

    def _ordered(self) -> DataFrame:
        """The nodes once per random order, sorted within partitions by range."""
        width = self.width
        planes = np.random.default_rng(7).standard_normal((ORDERS, HYPERPLANES + 1, width)).astype(np.float32)

        def keys(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                codes = _floats(batch["code"].to_pylist(), width).astype(np.float32)
                for tree in range(ORDERS):
                    along = codes @ planes[tree].T
                    sides = ((along[:, :-1] > 0) << np.arange(HYPERPLANES)).sum(axis=1)
                    tree_column = pa.array(np.full(len(codes), tree, np.int32))
                    columns = [batch["node"], batch["code"], tree_column, pa.array(sides), pa.array(along[:, -1])]
                    yield pa.record_batch(columns, names=["node", "code", "tree", "side", "along"])

        keyed = self.coded.mapInArrow(keys, "node long, code binary, tree int, side long, along float")
        order = ["tree", "side", "along", "node"]
        return keyed.repartitionByRange(*order).sortWithinPartitions(*order)

    def _build(self) -> DataFrame:
        width, buckets, scratch = self.width, self.buckets, self.scratch
        merge = _merge(width, DEGREE)
        empty = self.coded.select("*", *[F.lit(b"").alias(c) for c in ("ids", "sims", "fresh", "codes")])
        answers = self._ordered().mapInArrow(_first_lists(width, buckets), _ANSWER)

        def taken_in(state: DataFrame, rows: DataFrame, function) -> DataFrame:
            return scratch.write(
                state.groupBy("bucket").cogroup(rows.groupBy("bucket")).applyInArrow(function, _GRAPH)
            )

        graph = taken_in(empty, answers, merge)
        for turn in range(ROUNDS):
            messages = graph.mapInArrow(_send(width, buckets, turn), _MESSAGE)
            answers = (
                graph.groupBy("bucket")
                .cogroup(messages.groupBy("bucket"))
                .applyInArrow(_answer(width, buckets, turn), _ANSWER)
            )
            following = taken_in(graph, answers, merge)
            scratch.drop(graph)
            graph = following
        messages = graph.mapInArrow(_send(width, buckets, 0), _MESSAGE)
        whole = taken_in(graph, messages, _with_reverse(width))
        scratch.drop(graph)
        return whole


def _with_reverse(width: int):
    """Adds to every list the sample of nodes that have the node in theirs."""

    def add(state: pa.Table, messages: pa.Table) -> pa.Table:
        if not state.num_rows:
            return state.select(_NAMES)
        lists = _Lists(state, width)
        inbox = _Inbox(messages, lists, width)
        parts = [inbox.passed_on(row) for row in range(len(lists.nodes))]
        more = np.concatenate(parts).astype(np.int64)
        row = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        theirs = inbox.codes[more].astype(np.float32)
        sims = np.einsum("ij,ij->i", theirs, lists.own[row].astype(np.float32) - 0.5 * theirs)
        rows, ids = np.r_[lists.row, row], np.r_[lists.ids, inbox.src[more]]
        sims, codes = np.r_[lists.sims, sims], np.concatenate([lists.codes, inbox.codes[more]])
        best = _nearest(rows, ids, sims, DEGREE + REVERSE)
        fresh = np.zeros(len(best), bool)
        return _rows(lists, rows[best], ids[best], sims[best], fresh, codes[best], state["bucket"][0].as_py())

    return add


_BEAMS = "query_id long, code binary, ids binary, sims binary, asked binary"
_QUESTION = "bucket int, dest binary, src binary, least binary, codes binary"
_REPLY = "query_id long, ids binary, sims binary"


def _ask(width: int, buckets: int):
    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dest, src, least, codes = [], [], [], []
            columns = [batch[c].to_pylist() for c in ("query_id", "code", "ids", "sims", "asked")]
            for query, code, ids, sims, asked in zip(*columns):
                open_ = np.flatnonzero(~np.frombuffer(asked, bool))[:ASKED]
                sims = np.frombuffer(sims, np.float32)
                dest.append(np.frombuffer(ids, np.int64)[open_])
                src.append(np.full(len(open_), query))
                least.append(np.full(len(open_), sims[-1] if len(sims) >= BEAM else -np.inf, np.float32))
                codes.append(np.tile(np.frombuffer(code, np.float16), (len(open_), 1)))
            dest = np.concatenate(dest)
            parts = {"src": np.concatenate(src), "least": np.concatenate(least), "codes": np.concatenate(codes)}
            yield from _packed(_bucket(dest, buckets), {"dest": dest, **parts})

    return ask


def _reply(width: int):
    def reply(state: pa.Table, questions: pa.Table) -> pa.Table:
        out = []
        if state.num_rows and questions.num_rows:
            lists = _Lists(state, width)
            order = np.argsort(lists.nodes)
            dest, src = _column(questions, "dest", np.int64), _column(questions, "src", np.int64)
            least, codes = _column(questions, "least", np.float32), _floats(questions["codes"].to_pylist(), width)
            at = np.searchsorted(lists.nodes[order], dest)
            for i, row in enumerate(order[at]):
                part = lists.part(row)
                sims = lists.codes[part].astype(np.float32) @ codes[i].astype(np.float32)
                near = sims > least[i]
                out.append((src[i], lists.ids[part][near].tobytes(), sims[near].tobytes()))
        columns = list(zip(*out)) or [(), (), ()]
        kinds = [pa.int64(), pa.binary(), pa.binary()]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=["query_id", "ids", "sims"])

    return reply


def _narrow(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Takes the replies (lists per query) into the beams; what was asked before stays marked."""
    for batch in batches:
        rows = []
        columns = [batch[c].to_pylist() for c in ("query_id", "code", "ids", "sims", "asked", "more_ids", "more_sims")]
        for query, code, ids, sims, asked, more_ids, more_sims in zip(*columns):
            ids, sims = np.frombuffer(ids, np.int64), np.frombuffer(sims, np.float32)
            asked = np.frombuffer(asked, bool).copy()
            asked[np.flatnonzero(~asked)[:ASKED]] = True
            ids = np.concatenate([ids, *(np.frombuffer(m, np.int64) for m in more_ids or ())])
            sims = np.concatenate([sims, *(np.frombuffer(m, np.float32) for m in more_sims or ())])
            asked = np.r_[asked, np.zeros(len(ids) - len(asked), bool)]
            # Of equal ids the first stays, which is the one already in the beam.
            first = np.sort(np.unique(ids, return_index=True)[1])
            best = first[np.lexsort((ids[first], -sims[first]))][:BEAM]
            rows.append((query, code, ids[best].tobytes(), sims[best].tobytes(), asked[best].tobytes()))
        kinds = [pa.int64(), *[pa.binary()] * 4]
        names = ["query_id", "code", "ids", "sims", "asked"]
        yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def _entries(index: Index) -> pa.Table:
    """The entries and their lists (node, code, ids, codes, long), at most ENTRIES + LONGEST; some are both."""
    some = index.nodes.select("node").orderBy(F.xxhash64("node"), "node").limit(ENTRIES)
    most = index.nodes.orderBy(F.desc(_length(F.col("vector"))), "node").select("node").limit(LONGEST)
    chosen = some.withColumn("long", F.lit(0)).union(most.withColumn("long", F.lit(1)))
    rows = index.graph.select("node", "code", "ids", "codes").join(F.broadcast(chosen), "node")
    return rows.orderBy("long", "node").toArrow()


def _beams(index: Index, queries: DataFrame) -> DataFrame:
    """First beams: the query's own node, if it has one, and the nearest entries with their neighbours."""
    width = index.width
    table = _entries(index)
    ids, codes = table["node"].to_numpy(), _floats(table["code"].to_pylist(), width)
    groups = [np.flatnonzero(table["long"].to_numpy() == g) for g in (0, 1)]
    their_ids = [np.frombuffer(b, np.int64) for b in table["ids"].to_pylist()]
    their_codes = [_floats([b], width) for b in table["codes"].to_pylist()]

    def begin(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch["vector"].flatten().to_numpy().reshape(batch.num_rows, width - 1)
            values = values / np.maximum(np.abs(values).max(axis=1, keepdims=True), 1e-300)
            scale = np.sqrt((values**2).sum(axis=1))
            own = np.c_[values / scale[:, None], np.zeros(len(values))].astype(np.float16)
            wide = own.astype(np.float32)
            nearness = wide @ codes.astype(np.float32).T
            rows = []
            for i, query in enumerate(batch["query_id"].to_pylist()):
                near = np.concatenate([g[np.lexsort((ids[g], -nearness[i][g]))[:ASKED]] for g in groups])
                found = np.concatenate([ids[near], *(their_ids[e] for e in near)])
                sims = np.concatenate([nearness[i][near], *(their_codes[e].astype(np.float32) @ wide[i] for e in near)])
                asked = np.arange(len(found)) < len(near)
                node = batch["node"][i].as_py()
                if node is not None:
                    others = found != node
                    found, sims = np.r_[node, found[others]], np.r_[np.float32(np.inf), sims[others]]
                    asked = np.r_[False, asked[others]]
                # Of equal ids the first stays, so entries stay asked.
                first = np.sort(np.unique(found, return_index=True)[1])
                best = first[np.lexsort((found[first], -sims[first]))][:BEAM]
                found, sims = found[best].astype(np.int64), sims[best].astype(np.float32)
                rows.append((query, own[i].tobytes(), found.tobytes(), sims.tobytes(), asked[best].tobytes()))
            kinds = [pa.int64(), *[pa.binary()] * 4]
            names = ["query_id", "code", "ids", "sims", "asked"]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return queries.select("query_id", "vector", "node").mapInArrow(begin, _BEAMS)


def _expand(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = [np.frombuffer(b, np.int64) for b in batch["ids"].to_pylist()]
        query = np.repeat(batch["query_id"].to_numpy(), [len(p) for p in parts])
        yield pa.record_batch([pa.array(query), pa.array(np.concatenate(parts))], names=["query_id", "node"])


def search(index: Index, queries: DataFrame, k: int, id_column: str, vector_column: str) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for each query, its own row left out.

    A query that is a row of the index is known by its id. Queries whose vector takes no part, or is
    of another dimension, give no rows. Scores are inner products of the original vectors in
    double precision; ties go to the smaller vec_id.
    """
    scratch, width, buckets = index.scratch, index.width, index.buckets
    asked = queries.select(
        F.col(id_column).cast("long").alias("query_id"), F.col(vector_column).cast("array<double>").alias("vector")
    ).filter(F.col("query_id").isNotNull() & valid(F.col("vector")) & (F.size("vector") == index.dimension))
    known = index.nodes.select("node", F.col("vector").alias("its"))
    asked = scratch.write(asked.join(known, F.col("vector") == F.col("its"), "left").drop("its"))
    graph = index.graph.repartition(max(1, buckets), "bucket").persist(StorageLevel.DISK_ONLY)
    beams = scratch.write(_beams(index, asked))
    # A node that leaves a beam never comes back, so every beam is asked out at some time.
    while True:
        questions = beams.mapInArrow(_ask(width, buckets), _QUESTION)
        replies = graph.groupBy("bucket").cogroup(questions.groupBy("bucket")).applyInArrow(_reply(width), _REPLY)
        lists = replies.groupBy("query_id").agg(
            F.collect_list("ids").alias("more_ids"), F.collect_list("sims").alias("more_sims")
        )
        following = scratch.write(beams.join(lists, "query_id", "left").mapInArrow(_narrow, _BEAMS))
        scratch.drop(beams)
        beams = following
        if not beams.filter(F.instr(F.hex("asked"), "00") > 0).limit(1).count():
            break
    graph.unpersist()
    found = beams.mapInArrow(_expand, "query_id long, node long")
    scored = found.join(index.nodes.select("node", F.col("vector").alias("theirs"), "members"), "node").join(
        asked.select("query_id", "vector"), "query_id"
    )
    product = F.aggregate(F.zip_with("vector", "theirs", lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    hits = scored.select("query_id", F.explode("members").alias("vec_id"), product.alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    hits = hits.filter(F.col("vec_id") != F.col("query_id")).withColumn("rank", F.row_number().over(order))
    return hits.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """Build an :class:`Index` of ``vectors`` and :func:`search` it for ``queries``.

    Vectors that are null, all nought, or hold null or non-finite components take no part; nor do
    those of another dimension than the row with the smallest id has. Of rows that repeat an id with
    the same vector one counts. Fewer than k candidates give as many rows. An empty table gives none.
    """
    return search(Index(vectors, id_column, vector_column, k + 1), queries, k, id_column, vector_column)
