"""N-gram Jaccard join by signature trees.

Texts whose sets of word shingles have a Jaccard similarity of ``percent`` or more
are linked; the result is the connected components.

1. Signatures. One pass over the texts gives each its set size, a hash of the set
   (equal sets are one node from here on) and band keys: hashes of min-hashes, so
   many that a linked pair misses all of them with a chance of at most ``MISS``.
2. Blocks. Nodes that share a key come together: every node is tied to the least
   node of each of its keys, and the ties' components are the blocks within which
   trees are built. Ties only say where to look.
3. Trees. The nodes of a block are the leaves of a signature tree. A tree node
   holds the OR of its leaves' token bitmaps, the range of their set sizes and how
   many tokens a bitmap may hide. The tree is traversed against itself; a pair of
   tree nodes goes if the sizes cannot fit, if the greatest possible overlap is too
   small, or if all their leaves are linked already. Pairs of leaves are compared
   exactly, by integers.
4. Links give the final components; the copies of a set join it by its hash.

Hot groups: equal sets are one node. A block of more than ``CHUNK_TOKENS`` tokens is
never gathered in one task: all its nodes are compared with its least node (a join,
which Spark may split). Those linked to it are in one component and need not be
compared with each other; the others are cut into chunks, and each pair of chunks,
and each chunk with each chunk of the linked ones, is a tree of its own.

Shingles are compared by 64-bit hashes. Words are runs outside 0x20 and 0x09..0x0D,
with A-Z in lower case; a text of fewer words than a shingle has one shingle, the
whole sequence.

Defined cases: null and empty texts have no shingles and are linked with nothing;
equal texts are linked; repeated rows stay rows; null ids take part, and the
component's id is the least id that is not null (null if there is none); an empty
table gives no rows; other columns are ignored (``similar_groups``) or kept
(``drop_near_copies``).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelake.llm.graph import components
from farelake.llm.tables import table, written
from farelake.llm.textscan import Scan, mix, scans, window_hashes

MISS = 1e-8
BAND_ROWS = 5  # at most
CHUNK_TOKENS = 200_000
FANOUT = 4


def bands(percent: int) -> tuple[int, int]:
    """(min-hashes in a key, keys) for a chance of at most MISS to miss a link."""
    t = percent / 100
    rows = max(r for r in range(1, BAND_ROWS + 1) if r == 1 or t ** r >= 0.4)
    return rows, math.ceil(math.log(MISS) / math.log(1 - t ** rows)) if t < 1 else 1


def shingle_sets(scan: Scan, n: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text."""
    words, ptr = scan.word_hashes(lower=True), scan.ptr
    windows = window_hashes(words, n)
    out = []
    for i in range(scan.n):
        a, b = ptr[i], ptr[i + 1]
        out.append(np.unique(windows[a:b - n + 1]) if b - a >= n else window_hashes(words[a:b], b - a) if b > a else words[:0])
    return out


def set_hash(tokens: np.ndarray) -> int:
    """64-bit hash of a set."""
    mixed = mix(tokens)
    parts = np.array([mixed.sum(dtype=np.uint64), np.bitwise_xor.reduce(mix(mixed)), len(tokens)], np.uint64)
    return int(window_hashes(parts, 3).view(np.int64)[0])


def band_keys(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """(sets, keys) band keys of sets that are not empty."""
    rows, keys = bands(percent)
    start = np.cumsum([0, *[len(s) for s in sets[:-1]]])
    tokens = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    seeds = mix(np.arange(1, 2 * rows * keys + 1, dtype=np.uint64)).astype(np.uint32)
    out = np.empty((len(sets), keys), np.int64)
    for key in range(keys):
        low = [np.full(len(sets), key + 1, np.uint64)]
        for row in range(key * rows, (key + 1) * rows):
            low.append(np.minimum.reduceat((tokens ^ seeds[2 * row]) * (seeds[2 * row + 1] | np.uint32(1)), start).astype(np.uint64))
        stacked = np.stack(low, 1)
        h = np.full(len(sets), key, np.uint64)
        for column in range(rows + 1):
            h = mix(h * np.uint64(0x9FB21C651E98DF25) + stacked[:, column])
        out[:, key] = h.view(np.int64)
    return out


def enough(shared: int, a: int, b: int, percent: int) -> bool:
    """Whether sets of a and b tokens, shared of them common, are similar enough."""
    return 100 * shared >= percent * (a + b - shared)


class Tree:
    """Node of a signature tree over leaves first..last (exclusive)."""

    __slots__ = ("bits", "least", "most", "hidden", "first", "last", "below", "whole")

    def __init__(self, first: int, last: int, below: list[Tree], bits: int = 0, size: int = 0):
        self.first, self.last, self.below, self.bits = first, last, below, bits
        self.least = self.most = size
        self.hidden = size - bits.bit_count()
        self.whole = not below  # all leaves known to be linked
        if below:
            for x in below:
                self.bits |= x.bits
            self.least, self.most = min(x.least for x in below), max(x.most for x in below)
            self.hidden = max(x.hidden for x in below)


def build(sets: list[np.ndarray]) -> Tree:
    """Tree over sets that are in order."""
    width = 1 << max(8, (4 * max(len(s) for s in sets) - 1).bit_length())
    level = []
    for i, s in enumerate(sets):
        flags = np.zeros(width, np.uint8)
        flags[(s & np.uint64(width - 1)).astype(np.int64)] = 1
        level.append(Tree(i, i + 1, [], int.from_bytes(np.packbits(flags).tobytes(), "big"), len(s)))
    while len(level) > 1:
        level = [Tree(part[0].first, part[-1].last, part) if len(part) > 1 else part[0]
                 for part in (level[k:k + FANOUT] for k in range(0, len(level), FANOUT))]
    return level[0]


def tree_links(sets: list[np.ndarray], percent: int, joined: list[bool] | None = None) -> list[tuple[int, int]]:
    """Links among sets that connect all that are similar enough, directly or over
    others. joined: sets that are known to be connected already."""
    if len(sets) < 2:
        return []
    # Neighbours in the tree should be similar: order by the least shingle hash.
    order = sorted(range(len(sets)), key=lambda i: (int(sets[i][0]), len(sets[i]), int(sets[i][-1])))
    ordered = [sets[i] for i in order]
    parent = list(range(len(sets)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    known = [i for i, at in enumerate(order) if joined and joined[at]]
    for i in known[1:]:
        parent[root(i)] = root(known[0])

    def whole(x: Tree) -> bool:
        if not x.whole:
            at = root(x.first)
            x.whole = all(whole(c) and root(c.first) == at for c in x.below)
        return x.whole

    out, top = [], build(ordered)
    work = [(top, top)]
    while work:
        x, y = work.pop()
        if x is y and not x.below:
            continue
        if whole(x) and whole(y) and root(x.first) == root(y.first):
            continue
        if x is not y:
            if percent * max(x.least, y.least) > 100 * min(x.most, y.most):
                continue
            shared = min(x.most, y.most, (x.bits & y.bits).bit_count() + min(x.hidden, y.hidden))
            if not enough(shared, x.least, y.least, percent):
                continue
        if not x.below and not y.below:
            a, b = ordered[x.first], ordered[y.first]
            if enough(len(np.intersect1d(a, b, assume_unique=True)), len(a), len(b), percent):
                out.append((order[x.first], order[y.first]))
                parent[root(x.first)] = root(y.first)
        elif x is y:
            below = x.below
            work += [(below[i], below[j]) for i in range(len(below)) for j in range(len(below) - 1, i, -1)]
            work += [(c, c) for c in below]
        elif x.below and (not y.below or x.last - x.first >= y.last - y.first):
            work += [(c, y) for c in x.below]
        else:
            work += [(x, c) for c in y.below]
    return out


def _signatures(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """(doc_id, n_shingles, node, keys) of every row; node null without shingles."""
    rows = docs.select("doc_id", F.col("text").alias("__text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def sign(batches):
        for batch in batches:
            for a, b, scan in scans(batch.column(1)):
                sets = shingle_sets(scan, n)
                some = [s for s in sets if len(s)]
                keys = iter(band_keys(some, percent)) if some else iter(())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([set_hash(s) if len(s) else None for s in sets], pa.int64()),
                     pa.array([next(keys) if len(s) else None for s in sets], pa.list_(pa.int64()))],
                    ["doc_id", "n_shingles", "node", "keys"])

    return rows.mapInArrow(sign, f"doc_id {kind}, n_shingles long, node long, keys array<long>")


def with_node(docs: DataFrame, n: int, name: str) -> DataFrame:
    """docs with the hash of each text's shingle set as a column of that name (null without shingles)."""
    at = docs.columns.index("text")

    def nodes(batches):
        for batch in batches:
            found = [set_hash(s) if len(s) else None for _, _, scan in scans(batch.column(at)) for s in shingle_sets(scan, n)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int64())], [*batch.schema.names, name])

    return docs.mapInArrow(nodes, T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())]))


def _set_of(packed: bytes, n: int) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(packed), np.uint8)
    return shingle_sets(Scan(raw, np.array([0, len(raw)])), n)[0]


def _packed_texts(docs: DataFrame, n: int) -> DataFrame:
    """(node, packed): the compressed text of every shingle set, once for each task."""
    def pack(batches):
        tool, seen = zstandard.ZstdCompressor(level=3), set()
        for batch in batches:
            for _, _, scan in scans(batch.column(0)):
                raw, off = scan.data.tobytes(), scan.offsets
                found = {set_hash(s): i for i, s in enumerate(shingle_sets(scan, n)) if len(s)}
                found = {node: i for node, i in found.items() if node not in seen}
                seen.update(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(found), pa.int64()),
                     pa.array([tool.compress(raw[off[i]:off[i + 1]]) for i in found.values()], pa.binary())], ["node", "packed"])

    return docs.select(F.col("text").alias("__text")).mapInArrow(pack, "node long, packed binary")


def _links(members: DataFrame, n: int, percent: int) -> DataFrame:
    """(a, b): links that connect what is similar within each block, from members
    (block, tokens, node, size, packed)."""
    def search(group: pa.Table) -> pa.Table:
        nodes = group["node"].to_pylist()
        sets = [_set_of(x, n) for x in group["packed"].to_pylist()]
        found = tree_links(sets, percent, group["near"].to_pylist())
        return pa.table({"a": pa.array([nodes[i] for i, _ in found], pa.int64()),
                         "b": pa.array([nodes[j] for _, j in found], pa.int64())})

    small = members.where(F.col("tokens") <= CHUNK_TOKENS).withColumn("near", F.lit(False)).select(
        "block", "node", "packed", "near")
    links = small.groupBy("block").applyInArrow(search, "a long, b long")

    # Blocks too large for one task: first everything against the least node.
    large = members.where(F.col("tokens") > CHUNK_TOKENS)
    hubs = large.groupBy("block").agg(F.min("node").alias("hub"))
    hubs = large.select("node", F.col("packed").alias("hub_packed")).join(
        hubs, F.col("node") == F.col("hub")).select("block", "hub", "hub_packed")

    def against(batches):
        for batch in batches:
            hubs_seen: dict[int, np.ndarray] = {}
            near = []
            for hub, hub_packed, packed in zip(*(batch.column(i).to_pylist() for i in (3, 4, 5)), strict=True):
                if hub not in hubs_seen:
                    hubs_seen = {hub: _set_of(hub_packed, n)}
                a, b = hubs_seen[hub], _set_of(packed, n)
                near.append(enough(len(np.intersect1d(a, b, assume_unique=True)), len(a), len(b), percent))
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in (0, 1, 2, 3, 5)], pa.array(near, pa.bool_())],
                                             ["block", "node", "size", "hub", "packed", "near"])

    seen = written(large.join(hubs, "block").select("block", "node", "size", "hub", "hub_packed", "packed").mapInArrow(
        against, "block long, node long, size long, hub long, packed binary, near boolean"), "jaccard-hubs")
    hub_links = seen.where("near and node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b"))
    # What is linked to the hub is connected; the rest meets itself and that, chunk by chunk.
    chunks = lambda near: F.coalesce(F.ceil(F.sum(F.when(
        F.col("near") == near, F.col("size"))) / CHUNK_TOKENS), F.lit(0)).cast("int")
    counts = seen.groupBy("block").agg(chunks(False).alias("far_chunks"), chunks(True).alias("near_chunks")).where("far_chunks > 0")
    dealt = seen.join(counts, "block").withColumn("chunk", F.pmod(F.xxhash64("node"), F.when(
        F.col("near"), F.col("near_chunks")).otherwise(F.col("far_chunks"))).cast("int"))
    far = F.sequence(F.lit(0), F.col("far_chunks") - 1)
    pair = lambda kind, i, j: F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"))
    with_far = F.transform(far, lambda x: pair("far", F.least(x, F.col("chunk")), F.greatest(x, F.col("chunk"))))
    with_near = F.transform(F.sequence(F.lit(0), F.col("near_chunks") - 1), lambda x: pair("near", F.col("chunk"), x))
    from_near = F.transform(far, lambda x: pair("near", x, F.col("chunk")))
    tasks = dealt.withColumn("task", F.explode(F.when(F.col("near"), from_near).otherwise(
        F.concat(with_far, F.when(F.col("near_chunks") > 0, with_near).otherwise(F.slice(with_near, 1, 0))))))
    rest = tasks.select("block", "task", "node", "packed", "near").groupBy("block", "task").applyInArrow(search, "a long, b long")
    return links.unionByName(hub_links).unionByName(rest)


def similar_groups(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, node, component) of every row.

    Shingles of n words; linked from a similarity of percent / 100. node: the hash
    of the shingle set; component: the least node linked to it, the same for the
    rows of one group only, whatever their ids. Both are null without shingles.
    """
    signed = written(_signatures(docs, n, percent), "jaccard-signatures")
    nodes = written(signed.where("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("least_id"), F.first("n_shingles").alias("size"), F.first("keys").alias("keys")), "jaccard-nodes")
    keyed = nodes.select("node", F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.min("node").alias("least"), F.max("node").alias("most")).where("least < most")
    ties = keyed.join(shared.select("key", "least"), "key").where("node <> least").select(
        F.col("node").alias("a"), F.col("least").alias("b")).distinct()
    blocks = components(ties).withColumnRenamed("component", "block").join(nodes.select("node", "size"), "node")
    tokens = blocks.groupBy("block").agg(F.sum("size").alias("tokens"))
    wanted = written(blocks.join(tokens, "block").select("node", "block", "size", "tokens"), "jaccard-blocks")
    # Texts are dealt by node at every size of the input: the plan does not turn on how many are wanted.
    members = written(_packed_texts(docs, n).join(wanted.hint("merge"), "node").groupBy("node", "block", "size", "tokens").agg(
        F.first("packed").alias("packed")), "jaccard-members")
    linked = written(components(_links(members, n, percent)), "jaccard-components")
    of_node = nodes.select("node", "least_id").join(linked, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    ids = of_node.groupBy("component").agg(F.min("least_id").alias("component_id"))
    of_node = of_node.join(ids, "component").select("node", "component_id", "component")
    return signed.select("doc_id", "n_shingles", "node").join(of_node, "node", "left").select(
        "doc_id", "n_shingles", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(
            F.col("component_id")).alias("component_id"), "node", "component")


def drop_near_copies(docs: DataFrame, n: int = 5, percent: int = 80, clashing: bool = True) -> DataFrame:
    """docs with one row of each group of near copies, the one of the least id (not
    null before null); rows without shingles all stay. An id may stand on different texts,
    so groups are told by their component, not by its least id (whatever ``clashing`` says)."""
    node = "__node"
    while node in docs.columns:
        node += "_"
    groups = similar_groups(docs, n, percent).where("node is not null")
    kept = groups.groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")).alias("k")).select(
        F.col("k")["doc_id"].alias(node + "_id"), F.col("k")["node"].alias(node + "_of"))
    marked = with_node(docs, n, node)
    with_words = marked.where(F.col(node).isNotNull()).join(
        kept, (F.col(node) == F.col(node + "_of")) & F.col("doc_id").eqNullSafe(F.col(node + "_id"))).dropDuplicates([node])
    return with_words.select(*docs.columns).unionByName(marked.where(F.col(node).isNull()).select(*docs.columns))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document: 3-word shingles, similarity 0.9."""
    docs = table(spark, sf_dir, "documents", ("doc_id", "text"))
    return similar_groups(docs, 3, 90).select("doc_id", "n_shingles", "component_id")
