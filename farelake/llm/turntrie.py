"""Conversation prefix trie by burst tries.

A node of the trie is a distinct sequence of first turns (role, text); the root is the
empty one. Four steps, each over written tables:

1. *Sequences*: a turn becomes a unit of 20 bytes, 16 of the SHA-256 of its role and text
   and 4 of its length; a conversation is its units one behind the other. Equal
   conversations are folded into one row first (count, least id, digest of their ids), so
   a group of copies of any size is one row from here on.
2. *Burst*: a container holds the sequences below one trie node. A container of more
   than ``CONTAINER_TURNS`` turns becomes a head: the turns that all its sequences share
   (the common part of its least and greatest sequence) are a path, and behind the path
   the sequences go to new containers by their next unit. Rounds go on until no container
   of more than one sequence is too large; a round moves the rows of large containers only.
3. *Sweep*: the rows of the remaining containers are sorted by container and sequence
   and swept in order; a container's nodes come out of its common prefixes.
4. *Heads*: the sums of the containers are added up along the heads above them, and
   each head's path gives its nodes.

The digest of a node's own conversations needs their ids in order. Ids are sorted by
(sequence, id) over ranges, which split a large group; each range joins its ids into
pieces, and only the pieces of a sequence meet, streamed through one hash. SHA-256 has no
parallel form, so that last pass over the text of the ids is the part that cannot be
split.

Bounded memory: a container (65,536 turns, or one sequence), a piece of 1 MB, and a
conversation's units as one row of 20 bytes a turn, whatever the texts' lengths.

Defined cases: null role and text are empty; turns are ordered by turn (null first), ties
by role, then text; repeated rows are turns of their own; rows with null conv_id belong to
no conversation and are left out; an empty table gives no node, not even a root; other
columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farelake.llm.tables import table, written

UNIT = 20  # bytes of a turn: 16 of its digest, 4 of its length
CONTAINER_TURNS = 1 << 16
PIECE_BYTES = 1 << 20
BATCH_ROWS = 1 << 13

NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
        "saved_tokens long, ends_sha256 string")
NOBODY = hashlib.sha256(b"").hexdigest()


def conversations(rows: DataFrame) -> DataFrame:
    """(conv_id, units): the turns of each conversation in order, 20 bytes each."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    # The length of the role tells where the text begins.
    digest = F.sha2(F.concat(F.char_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    turns = rows.where("conv_id is not null").select("conv_id", "turn", role.alias("role"), text.alias("text"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    units = turns.select("conv_id", F.row_number().over(order).alias("at"), F.concat(
        F.substring(digest, 1, 32), F.lpad(F.hex(F.char_length("text")), 8, "0")).alias("unit"))
    in_order = F.array_sort(F.collect_list(F.struct("at", "unit")))
    return units.groupBy("conv_id").agg(in_order.alias("turns")).select(
        "conv_id", F.unhex(F.array_join(F.col("turns")["unit"], "")).alias("units"))


def _turns(units: Column | str) -> Column:
    return (F.octet_length(units) / UNIT).cast("int")


def rebuilt(convs: DataFrame, block: int = 100, prefixes: int = 6) -> DataFrame:
    """Each conversation c with the first h turns of conversation c - c % block in place of
    its own first h; h = crc32(decimal c) % prefixes. An absent one has no turns. ``%`` keeps
    the sign, as in SQL."""
    own = convs.select("conv_id", "units", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % prefixes)
                       .cast("int").alias("h"), (F.col("conv_id") - F.col("conv_id") % block).alias("base"))
    first = convs.where(F.col("conv_id") % block == 0).select(
        F.col("conv_id").alias("base"), F.substring("units", 1, UNIT * (prefixes - 1)).alias("head"))
    joined = own.join(first, "base", "left")
    head = F.coalesce(F.substr("head", F.lit(1), F.col("h") * UNIT), F.lit(b""))
    return joined.select("conv_id", F.concat(head, F.substr("units", F.col("h") * UNIT + 1)).alias("units"))


def folded(convs: DataFrame) -> DataFrame:
    """Equal conversations as one row: (units, n, lo, ends); ends: SHA-256 of their
    decimal ids in ascending order, joined by commas."""
    rows = written(convs.select(F.sha2("units", 256).alias("seq"), "conv_id", "units"), "trie-sequences")

    def pieces(batches):
        """Runs of one sequence as joined ids; a run is cut beyond PIECE_BYTES."""
        seq, units, first, ids, size = None, b"", 0, [], 0
        out = []
        for batch in batches:
            for s, c, u in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                if s != seq or size > PIECE_BYTES:
                    if ids:
                        out.append((seq, units, first, len(ids), ",".join(ids)))
                    seq, units, first, ids, size = s, u, c, [], 0
                ids.append(str(c))
                size += len(ids[-1]) + 1
            yield _records(out, ["seq", "units", "first", "n", "ids"], PIECES)
            out = []
        if ids:
            yield _records([(seq, units, first, len(ids), ",".join(ids))], ["seq", "units", "first", "n", "ids"], PIECES)

    def fold(batches):
        seq, row, digest = None, None, None
        out = []
        for batch in batches:
            for s, u, c, n, ids in zip(*[batch.column(i).to_pylist() for i in range(5)], strict=True):
                if s != seq:
                    if row:
                        out.append((*row, digest.hexdigest()))
                    seq, row, digest = s, (u, 0, c), hashlib.sha256()
                elif row[1]:
                    digest.update(b",")
                row = (row[0], row[1] + n, row[2])
                digest.update(ids.encode())
            yield _records(out, ["units", "n", "lo", "ends"], FOLDED)
            out = []
        if row:
            yield _records([(*row, digest.hexdigest())], ["units", "n", "lo", "ends"], FOLDED)

    parts = rows.repartitionByRange("seq", "conv_id").sortWithinPartitions("seq", "conv_id").select(
        "seq", "conv_id", "units").mapInArrow(pieces, "seq string, units binary, first long, n long, ids string")
    return parts.repartition("seq").sortWithinPartitions("seq", "first").mapInArrow(
        fold, "units binary, n long, lo long, ends string")


PIECES = [pa.string(), pa.binary(), pa.int64(), pa.int64(), pa.string()]
FOLDED = [pa.binary(), pa.int64(), pa.int64(), pa.string()]
NODES = [pa.int64()] * 7 + [pa.string(), pa.list_(pa.binary())]
SHARED = [pa.binary(), pa.int32()]


def _records(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def shared_turns(a: bytes, b: bytes) -> int:
    """Number of first units that a and b share."""
    n = min(len(a), len(b)) // UNIT * UNIT
    if a[:n] == b[:n]:
        return n // UNIT
    x, y = np.frombuffer(a, np.uint8, n), np.frombuffer(b, np.uint8, n)
    return int(np.argmax(x != y)) // UNIT


def _length(units: bytes, depth: int) -> int:
    """Code points in the text of the turn that ends a prefix of depth turns."""
    return int.from_bytes(units[depth * UNIT - 4:depth * UNIT], "big") if depth else 0


def _container() -> Column:
    """Digest of the units that the sequences of a container share."""
    return F.unhex(F.substring(F.sha2(F.substr("units", F.lit(1), F.col("depth") * UNIT), 256), 1, 32))


def burst(seqs: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(rows in containers that are small enough, heads by round).

    Rows: container, depth (of its top node), above (the heads over it, the last one its
    parent's), parent (least id of the parent node, null for the root), units, n, lo, ends.
    Heads: container, depth, bottom (depth of the path's end), above, parent, units (a
    sequence below it), n, lo, seqs, ends (of the sequence that is the path itself).
    """
    loose = written(seqs.select("units", "n", "lo", "ends", F.lit(0).alias("depth"), F.lit(None).cast("long").alias("parent"),
                                F.array().cast("array<binary>").alias("above")).withColumn("container", _container()), "trie-rows")
    small, heads = [], []
    while True:
        size = (_turns("units") - F.col("depth") + 1).cast("long")
        large = loose.groupBy("container").agg(
            F.sum(size).alias("turns"), F.count("*").alias("seqs"), F.sum("n").alias("all_n"), F.min("lo").alias("all_lo"),
            F.min("units").alias("least"), F.max("units").alias("greatest")).where(
            (F.col("turns") > CONTAINER_TURNS) & (F.col("seqs") > 1))

        def path(batches):
            for batch in batches:
                ends = [shared_turns(a, b) for a, b in zip(batch.column("least").to_pylist(), batch.column("greatest").to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ends, pa.int32())], [*batch.schema.names, "bottom"])

        names = ["container", "all_n", "all_lo", "seqs", "least", "greatest"]
        large = written(large.select(*names).mapInArrow(
            path, "container binary, all_n long, all_lo long, seqs long, least binary, greatest binary, bottom int")
            .drop("greatest"), "trie-heads")
        if large.isEmpty():
            return _union([*small, loose]), heads
        here = loose.join(large.select("container", "bottom", "all_lo"), "container", "left")
        small.append(loose.join(large.select("container"), "container", "left_anti"))
        inside = here.where("bottom is not null")
        top = inside.groupBy("container").agg(
            F.any_value("depth").alias("depth"), F.any_value("parent").alias("parent"), F.any_value("above").alias("above"),
            F.max(F.when(_turns("units") == F.col("bottom"), F.col("ends"))).alias("ends"))
        heads.append(large.join(top, "container").select(
            "container", "depth", "bottom", "above", "parent", F.col("least").alias("units"), F.col("all_n").alias("n"),
            F.col("all_lo").alias("lo"), "seqs", "ends"))
        loose = written(inside.where(_turns("units") > F.col("bottom")).select(
            "units", "n", "lo", "ends", (F.col("bottom") + 1).alias("depth"), F.col("all_lo").alias("parent"),
            F.concat("above", F.array("container")).alias("above")).withColumn("container", _container()), "trie-rows")


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _nodes_of(rows: list[tuple], depth: int, parent: int | None, above: list[bytes]) -> list[tuple]:
    """Nodes of one container; rows: (units, n, lo, ends) in ascending order of units.
    The top node carries ``above``, the others null."""
    out: list[tuple] = []

    # Open nodes along the current sequence: depth, convs, least id, children, leaves,
    # saved, ends, closed children that still need this node's least id.
    def opened(d: int, units: bytes) -> list:
        return [d, 0, None, 0, 0, 0, NOBODY, [], _length(units, d)]

    def close(stack: list[list]) -> None:
        node = stack.pop()
        d, n, lo, children, leaves, saved, ends, waiting, length = node
        leaves = leaves or 1
        saved += (n - 1) * length
        for w in waiting:
            out.append((w[0], w[1], lo, *w[2:], None))
        row = (lo, d, n, children, leaves, saved, ends)
        if not stack:
            out.append((lo, d, parent, *row[2:], above))
            return
        up = stack[-1]
        up[1] += n
        up[2] = lo if up[2] is None else min(up[2], lo)
        up[3] += 1
        up[4] += leaves
        up[5] += saved
        up[7].append(row)

    stack: list[list] = []
    before = b""
    for units, n, lo, ends in rows:
        last = len(units) // UNIT
        if not stack:
            stack.append(opened(depth, units))
        else:
            keep = shared_turns(before, units)
            while stack[-1][0] > keep:
                close(stack)
        for d in range(stack[-1][0] + 1, last + 1):
            stack.append(opened(d, units))
        end = stack[-1]
        end[1] += n
        end[2] = lo if end[2] is None else min(end[2], lo)
        end[6] = ends
        before = units
    while stack:
        close(stack)
    return out


NODE_NAMES = [f.split()[0] for f in NODE.split(", ")]


def sweep(rows: DataFrame) -> DataFrame:
    """Nodes of all containers (columns of NODE, and ``above`` at top nodes)."""
    def swept(batches):
        container, top, held = None, None, []
        out: list[tuple] = []
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(8)]
            for c, depth, parent, above, units, n, lo, ends in zip(*columns, strict=True):
                if c != container:
                    if held:
                        out += _nodes_of(held, *top)
                    container, top, held = c, (depth, parent, above), []
                    if len(out) > BATCH_ROWS:
                        yield _records(out, [*NODE_NAMES, "above"], NODES)
                        out = []
                held.append((units, n, lo, ends))
        if held:
            out += _nodes_of(held, *top)
        yield _records(out, [*NODE_NAMES, "above"], NODES)

    names = ["container", "depth", "parent", "above", "units", "n", "lo", "ends"]
    return rows.select(*names).repartition("container").sortWithinPartitions("container", "units").mapInArrow(
        swept, f"{NODE}, above array<binary>")


def head_nodes(heads: DataFrame, tops: DataFrame) -> DataFrame:
    """Nodes of the heads' paths. tops: (above, n_leaves, saved_tokens) of what hangs
    below heads: containers' top nodes."""
    def own(batches):
        """What a head's path saves in itself."""
        for batch in batches:
            saved = [(n - 1) * sum(_length(u, d) for d in range(a, b + 1)) for u, a, b, n in zip(
                *[batch.column(c).to_pylist() for c in ("units", "depth", "bottom", "n")], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(saved, pa.int64())], [*batch.schema.names, "own"])

    schema = ("container binary, depth int, bottom int, above array<binary>, parent long, units binary, n long, lo long, "
              "seqs long, ends string")
    heads = written(heads.select(*[f.split()[0] for f in schema.split(", ")]).mapInArrow(own, f"{schema}, own long"), "trie-paths")
    below = tops.select(F.explode("above").alias("container"), "n_leaves", "saved_tokens").unionByName(
        heads.select(F.explode("above").alias("container"), F.lit(0).cast("long").alias("n_leaves"),
                     F.col("own").alias("saved_tokens")))
    sums = below.groupBy("container").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved"))
    child = lambda rows: rows.where(F.size("above") > 0).select(F.element_at("above", -1).alias("container"))
    children = child(tops).unionByName(child(heads)).groupBy("container").agg(F.count("*").alias("children"))

    def paths(batches):
        for batch in batches:
            out = []
            for units, depth, bottom, parent, n, lo, ends, children, leaves, saved in zip(*[batch.column(c).to_pylist() for c in (
                    "units", "depth", "bottom", "parent", "n", "lo", "ends", "children", "n_leaves", "saved")], strict=True):
                for d in range(bottom, depth - 1, -1):
                    saved += (n - 1) * _length(units, d)
                    out.append((lo, d, parent if d == depth else lo, n, children if d == bottom else 1, leaves, saved,
                                ends if d == bottom and ends else NOBODY))
                if len(out) > BATCH_ROWS:
                    yield _records(out, NODE_NAMES, NODES[:8])
                    out = []
            yield _records(out, NODE_NAMES, NODES[:8])

    return heads.join(sums, "container").join(children, "container").mapInArrow(paths, NODE)


def trie(convs: DataFrame) -> DataFrame:
    """All nodes of the prefix trie of conversations (conv_id, units), as NODE rows."""
    rows, heads = burst(folded(convs))
    swept = written(sweep(rows), "trie-nodes")
    nodes = swept.select(*NODE_NAMES)
    if not heads:
        return nodes
    tops = swept.where("above is not null").select("above", "n_leaves", "saved_tokens")
    return nodes.unionByName(head_nodes(_union(heads), tops))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all conversations, rebuilt with shared first turns."""
    rows = table(spark, sf_dir, "conversations", ("conv_id", "turn", "role", "text"))
    return trie(rebuilt(written(conversations(rows), "trie-conversations")))


ORACLE = """
with own as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
    row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as pos
  from conversations where conv_id is not null
), convs as (
  select conv_id, conv_id - conv_id % 100 as base, xor(list_reduce(
    list_prepend(4294967295::bigint, list_transform(string_split(conv_id::varchar, ''), lambda x: ascii(x)::bigint)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, i: xor(x >> 1, (x & 1) * 3988292384))),
    4294967295::bigint) % 6 as h
  from (select distinct conv_id from own)
), parts as (
  select c.conv_id, 0 as part, o.pos, o.role, o.text from convs c join own o on o.conv_id = c.base and o.pos <= c.h
  union all
  select c.conv_id, 1, o.pos, o.role, o.text from convs c join own o on o.conv_id = c.conv_id and o.pos > c.h
), turns as (
  select conv_id, length(text) as len, row_number() over w as depth,
    md5(cast(list(sha256(length(role) || ':' || role || text)) over w as varchar)) as node
  from parts window w as (partition by conv_id order by part, pos)
), prefixes as (
  select conv_id, 0 as len, 0 as depth, '' as node from convs
  union all
  select conv_id, len, depth, node from turns
), nodes as (
  select node, depth, any_value(len) as len, min(conv_id) as lo, count(*) as n from prefixes group by node, depth
), ups as (
  select x.node, p.node as up from nodes x join prefixes p on p.conv_id = x.lo and p.depth = x.depth - 1
), children as (
  select up as node, count(*) as n_children from ups group by up
), below as (
  select p.node, count(*) filter (c.node is null) as n_leaves, sum((x.n - 1) * x.len) as saved
  from nodes x left join children c on c.node = x.node join prefixes p on p.conv_id = x.lo and p.depth <= x.depth
  group by p.node
), ends as (
  select node, string_agg(conv_id::varchar, ',' order by conv_id) as ids from prefixes p
  where depth = (select max(depth) from prefixes q where q.conv_id = p.conv_id) group by node
)
select x.lo as conv_id, cast(x.depth as bigint) as depth, u.lo as parent_conv_id, x.n as n_convs,
  coalesce(c.n_children, 0) as n_children, b.n_leaves, cast(b.saved as bigint) as saved_tokens,
  sha256(coalesce(e.ids, '')) as ends_sha256
from nodes x left join ups on ups.node = x.node left join nodes u on u.node = ups.up
left join children c on c.node = x.node join below b on b.node = x.node left join ends e on e.node = x.node
"""
