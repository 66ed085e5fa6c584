"""N-gram Jaccard join: documents whose word-shingle sets overlap enough, and their groups.

1. Windows that lie in one document only cannot be shared. The exchange of
   :mod:`broadsheet.llm.windows` tells each document which of its shingles others have. A document
   with too few of those links with nothing and is done.
2. Documents with equal sets become one class.
3. Classes meet through the prefix of their set in one global order, rarest shingles first: two
   sets similar enough share a shingle of their prefixes. Classes that reach each other through
   such shingles form a pool.
4. A pool is cut into tiles by size band and block. In a tile, hashed bitmaps bound the overlap
   from above, bit counts decide which pairs can link at all, and those are intersected exactly.
   Members already connected are not compared again, so a tile returns at most one edge less
   than it has members. A pool larger than a tile is first connected through its first blocks;
   only what is left apart then meets all other blocks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm import windows as W
from broadsheet.llm.components import components
from broadsheet.llm.scratch import Scratch
from broadsheet.session import broadcast_if_small

SHINGLE = 5
PERCENT = 75
#: Classes of one block; a tile holds at most two blocks.
BLOCK = 256
#: Width of a size band: sets further apart than one band cannot reach the similarity.
_BAND = np.log(100 / PERCENT)

_SETS = "doc_id long, n_shingles long, hi long, lo long, shared binary, prefix binary"


def shingle_keys(body: bytes | None, size: int = SHINGLE) -> np.ndarray:
    """Hashes of the distinct shingles of a text, sorted; A-Z count as a-z."""
    words = W.words_of(body.lower() if body else body)
    if not words:
        return np.empty(0, np.uint64)
    return W.distinct(W.rolling(W.word_hashes(words), min(size, len(words))))


def needed(first, second):
    """Least intersection with which sets of these sizes link."""
    return -(-PERCENT * (first + second) // (100 + PERCENT))


def _set_rows(buckets: int, size: int):
    """Per chunk: what each document's set is, and what of it others share."""

    def sets(docs: pa.Table, replies: pa.Table) -> pa.Table:
        known, weights = W.read_replies(replies)
        ids = docs["doc_id"].to_pylist()
        keys = [shingle_keys(b, size) for b in docs["body"].to_pylist()]
        local = W.in_several(keys)
        rows = []
        for doc_id, mine in zip(ids, keys):
            n = len(mine)
            digest = xxhash.xxh3_128_digest(mine.tobytes())
            hi, lo = (int.from_bytes(digest[i : i + 8], "big", signed=True) for i in (0, 8))
            told, at = W.lookup(known, W.address(mine, buckets))
            weight = np.where(told, weights[at] if len(weights) else 1, 1)
            held = told | W.lookup(local, mine)[0]
            least = -(-PERCENT * n // 100)
            if n == 0 or held.sum() < least:
                rows.append((doc_id, n, hi, lo, None, None))
                continue
            shared, weight = mine[held], weight[held]
            order = np.lexsort((shared, weight))[: len(shared) - least + 1]
            rows.append((doc_id, n, hi, lo, shared.tobytes(), shared[order].tobytes()))
        W.give_back()
        columns = list(zip(*rows)) or [()] * 6
        kinds = [pa.int64()] * 4 + [pa.binary()] * 2
        names = ["doc_id", "n_shingles", "hi", "lo", "shared", "prefix"]
        return pa.table({k: pa.array(c, t) for k, c, t in zip(names, columns, kinds)})

    return sets


def _tokens(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = [np.frombuffer(p, np.int64) for p in batch["prefix"].to_pylist()]
        ids = np.repeat(batch["class_id"].to_numpy(), [len(p) for p in parts])
        tokens = np.concatenate(parts) if parts else np.empty(0, np.int64)
        yield pa.record_batch([pa.array(ids), pa.array(tokens)], names=["class_id", "token"])


class _Joined:
    """Union of members found to be linked."""

    def __init__(self, labels):
        self.parent = list(range(len(labels)))
        seen = {}
        for i, label in enumerate(labels):
            self.parent[i] = seen.setdefault(label, i)

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        self.parent[max(i, j)] = min(i, j)
        return i != j


def bitmaps(sets: list[np.ndarray], bits: int) -> np.ndarray:
    """One row of ``bits`` bits per set, a bit for each element's hash."""
    out = np.zeros((len(sets), bits), bool)
    for row, members in zip(out, sets):
        row[(members % np.uint64(bits)).astype(np.int64)] = True
    return np.packbits(out, axis=1).view(np.uint64)


def tile_edges(ids, sizes, sets, labels, first=None) -> list[tuple[int, int]]:
    """Edges that connect the members of a tile as their links do.

    ``sizes`` count whole sets, ``sets`` hold what others share of them. Members with one label
    are connected already. With ``first`` (booleans), only pairs of a first and another are
    looked at, else all.
    """
    ids, sizes = np.asarray(ids), np.asarray(sizes)
    held = np.array([len(s) for s in sets])
    bits = 1 << max(6, int(np.ceil(np.log2(max(1, held.max()) * 4))))
    maps = bitmaps(sets, min(bits, 1 << 14))
    joined, edges = _Joined(labels), []
    for i in range(len(ids)):
        rest = slice(i + 1, None)
        least = needed(sizes[i], sizes[rest])
        possible = np.minimum(
            held[i] - np.bitwise_count(maps[i] & ~maps[rest]).sum(axis=1, dtype=np.int64),
            held[rest] - np.bitwise_count(~maps[i] & maps[rest]).sum(axis=1, dtype=np.int64),
        )
        able = possible >= least
        if first is not None:
            able &= first[rest] != first[i]
        others = np.flatnonzero(able)
        for j in others[np.argsort(least[others] - possible[others], kind="stable")] + i + 1:
            if joined.root(i) == joined.root(j):
                continue
            if W.lookup(sets[j], sets[i])[0].sum() >= needed(sizes[i], sizes[j]) and joined.join(i, j):
                edges.append((int(ids[i]), int(ids[j])))
    return edges


def _tile(table: pa.Table) -> pa.Table:
    """One tile's edges; ``part`` 0 meets part 1, and a tile of part 0 alone meets itself."""
    part = np.array(table["part"].to_pylist())
    edges = tile_edges(
        table["class_id"].to_pylist(),
        table["n_shingles"].to_pylist(),
        [np.frombuffer(s, np.uint64) for s in table["shared"].to_pylist()],
        table["label"].to_pylist(),
        part == 0 if part.any() else None,
    )
    columns = list(zip(*edges)) or [(), ()]
    return pa.table({"a": pa.array(columns[0], pa.int64()), "b": pa.array(columns[1], pa.int64())})


def _edges_of(tiles: DataFrame) -> DataFrame:
    keys = ["pool", "b1", "i1", "b2", "i2"]
    rows = tiles.select(*keys, "part", "class_id", "n_shingles", "shared", "label")
    return rows.groupBy(*keys).applyInArrow(_tile, "a long, b long")


def _blocks(members: DataFrame, *keys: str) -> DataFrame:
    """Adds band and block, at most about BLOCK members each, and ``n_blocks`` of the band.

    A pool of at most BLOCK members is one band and one block.
    """
    pools = members.groupBy("pool").agg(F.count(F.lit(1)).alias("in_pool"))
    band = F.floor(F.log(F.col("n_shingles")) / F.lit(float(_BAND)))
    members = members.join(pools, "pool").withColumn(
        "band", F.when(F.col("in_pool") <= BLOCK, F.lit(0)).otherwise(band).cast("int")
    )
    blocks = F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("n_blocks")
    counts = members.groupBy("pool", "band", *keys).agg(blocks)
    block = F.pmod(F.xxhash64("class_id"), F.col("n_blocks")).cast("int")
    return members.join(counts, ["pool", "band", *keys]).withColumn("block", block)


def _cell(b1, i1, b2, i2, part) -> F.Column:
    values = zip(("b1", "i1", "b2", "i2", "part"), (b1, i1, b2, i2, part))
    return F.struct(*[(v if not isinstance(v, int) else F.lit(v)).cast("int").alias(k) for k, v in values])


def _spread(members: DataFrame, cells) -> DataFrame:
    return members.withColumn("cell", F.explode(cells)).select(
        "pool", "cell.*", "class_id", "n_shingles", "shared", "label"
    )


def _first_tiles(members: DataFrame) -> DataFrame:
    """Each block with itself and with the first block of its band."""
    band, block = F.col("band"), F.col("block")
    later = F.transform(
        F.sequence(F.lit(1), F.greatest(F.col("n_blocks") - 1, F.lit(1))),
        lambda i: _cell(band, 0, band, i, 0),
    )
    own = F.array(_cell(band, block, band, block, 0))
    cells = (
        F.when((block == 0) & (F.col("n_blocks") > 1), F.concat(own, later))
        .when(block > 0, F.concat(own, F.array(_cell(band, 0, band, block, 1))))
        .otherwise(own)
    )
    return _spread(members, cells)


def _last_tiles(members: DataFrame) -> DataFrame:
    """Blocks of what is not in its pool's largest group, with themselves and all in reach."""
    groups = members.groupBy("pool", "label").agg(F.count(F.lit(1)).alias("n"))
    largest = groups.groupBy("pool").agg(
        F.max_by("label", F.struct("n", "label")).alias("largest"), F.count(F.lit(1)).alias("groups")
    )
    open_pools = largest.filter(F.col("groups") > 1)
    members = members.join(open_pools, "pool").withColumn("apart", F.col("label") != F.col("largest"))
    members = _blocks(members.drop("in_pool", "band", "n_blocks", "block"), "apart")
    apart = F.col("apart")
    counts = (
        members.filter("apart").groupBy("pool", "band").agg(F.first("n_blocks").alias("n_apart"))
    )
    # Cells are named by the block apart (b1, i1) and the other one; -1 - block tells those apart.
    reach = None
    for step in (-1, 0, 1):
        near = counts.select("pool", (F.col("band") - step).alias("band"), "n_apart")
        met = members.join(near, ["pool", "band"])
        other = F.when(apart, -1 - F.col("block")).otherwise(F.col("block"))
        theirs = F.col("band") + step
        cells = F.transform(
            F.sequence(F.lit(0), F.col("n_apart") - 1), lambda i: _cell(theirs, i, F.col("band"), other, 1)
        )
        if step == 0:
            cells = F.filter(cells, lambda c: ~apart | (c["i1"] != F.col("block")))
        rows = _spread(met, cells)
        reach = rows if reach is None else reach.union(rows)
    # The other side of the same cells: a block apart goes to every block it meets.
    targets = members.select(
        "pool", "band", F.when(apart, -1 - F.col("block")).otherwise(F.col("block")).alias("other")
    ).distinct()
    sides = members.filter("apart")
    for step in (-1, 0, 1):
        far = targets.select("pool", (F.col("band") + step).alias("band"), "other")
        met = sides.join(far, ["pool", "band"])
        cell = _cell(F.col("band"), F.col("block"), F.col("band") - step, F.col("other"), 0)
        if step == 0:
            met = met.filter(F.col("other") != -1 - F.col("block"))
        reach = reach.union(_spread(met, F.array(cell)))
        if step == 0:
            own = _cell(F.col("band"), F.col("block"), F.col("band"), -1 - F.col("block"), 0)
            reach = reach.union(_spread(sides, F.array(own)))
    return reach


def link_documents(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = SHINGLE
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row.

    Two documents link when PERCENT percent of the union of their shingle sets is shared; the
    component is the smallest doc_id reachable by links. Equal texts link. Null, empty and blank
    texts have no shingles and stay alone; a text of fewer words is one shingle. Rows that
    repeat a doc_id are documents of their own under the same id; rows without id link like others,
    and count as larger than any id (component null if all of it are such). Other columns are
    not read. An empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "jaccard")
    id_or_last = F.coalesce(F.col(id_column).cast("long"), F.lit(_NO_ID))
    bodies = docs.select(id_or_last.alias("doc_id"), F.col(text_column).cast("binary").alias("body"))
    bodies = W.with_chunk(bodies, "doc_id")
    buckets = W.bucket_count(bodies, "body")
    entries = W.send_windows(bodies, lambda body: (shingle_keys(body, shingle), None), buckets)
    replies = W.answer_shared(entries)
    sets = scratch.write(
        bodies.groupBy("chunk")
        .cogroup(replies.groupBy("chunk"))
        .applyInArrow(_set_rows(buckets, shingle), _SETS)
    )

    same = ["n_shingles", "hi", "lo"]
    classes = scratch.write(
        sets.filter("prefix IS NOT NULL")
        .groupBy(*same)
        .agg(F.min("doc_id").alias("class_id"), F.first("shared").alias("shared"), F.first("prefix").alias("prefix"))
    )
    groups = scratch.write(_connect(classes, scratch))
    found = sets.select("doc_id", *same).join(groups, same, "left")
    component = F.coalesce("component", "doc_id")
    clean = lambda c: F.when(c != _NO_ID, c)
    return found.select(
        clean(F.col("doc_id")).alias("doc_id"), "n_shingles", clean(component).alias("component_id")
    )


_NO_ID = (1 << 63) - 1


def _connect(classes: DataFrame, scratch: Scratch) -> DataFrame:
    """(n_shingles, hi, lo, component): the smallest doc_id of each class's component."""
    same = ["n_shingles", "hi", "lo"]
    name = F.xxhash64(*same)
    named = classes.select(*same, F.col("class_id").alias("least_id"), name.alias("class_id"), "shared", "prefix")
    tokens = named.select("class_id", "prefix").mapInArrow(_tokens, "class_id long, token long")
    hubs = tokens.groupBy("token").agg(F.min("class_id").alias("hub"), F.max("class_id").alias("most"))
    met = tokens.join(hubs.filter("hub < most"), "token")
    pools = components(met.select(F.col("class_id").alias("a"), F.col("hub").alias("b")))
    members = scratch.write(
        _blocks(
            named.join(pools, F.col("class_id") == F.col("node")).select(
                F.col("component").alias("pool"), "class_id", "n_shingles", "shared"
            )
        ).withColumn("label", F.col("class_id"))
    )
    edges = scratch.write(_edges_of(_first_tiles(members)))
    large = members.filter(F.col("in_pool") > BLOCK)
    if large.limit(1).count():
        labels = components(edges).withColumnRenamed("node", "class_id")
        large = large.drop("label").join(labels, "class_id", "left")
        large = scratch.write(large.withColumn("label", F.coalesce("component", "class_id")).drop("component"))
        edges = scratch.write(edges.union(_edges_of(_last_tiles(large))))
    linked = components(edges)
    heads = named.select(*same, "least_id", "class_id").join(
        linked, F.col("class_id") == F.col("node"), "left"
    )
    heads = heads.select(*same, "least_id", F.coalesce("component", "class_id").alias("root"))
    least = heads.groupBy("root").agg(F.min("least_id").alias("component"))
    return heads.join(least, "root").select(*same, "component")


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` without those linked to a smaller doc_id; columns stay as they are.

    Of rows that repeat an id and a text one stays; rows without id go if they link to one with an id. Only ids that go are sent to the rows, to every task if few.
    """
    linked = Scratch(docs.sparkSession, "kept").write(link_documents(docs, id_column, text_column))
    gone = linked.filter(F.col("component_id") < F.col("doc_id")).select("doc_id").distinct()
    gone = broadcast_if_small(gone, 2_000_000)
    kept = docs.join(gone, docs[id_column].cast("long") == gone["doc_id"], "left_anti")
    repeated = linked.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 AND doc_id IS NOT NULL")
    if not repeated.limit(1).count():
        return kept
    # An id that is there more than once: of its rows with equal texts, one stays.
    often = broadcast_if_small(repeated.select("doc_id"), 2_000_000)
    key = docs[id_column].cast("long") == often["doc_id"]
    return kept.join(often, key, "left_anti").unionByName(
        kept.join(often, key, "left_semi").dropDuplicates([id_column, text_column])
    )
