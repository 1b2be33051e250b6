"""Variable-capacity best-fit packing of documents into training sequences.

Several sequence lengths are permitted. A sequence of capacity c costs
``cost(c)``: linear work plus attention. Documents, longest first, go to the open
bin with the least room that still fits; if none fits, the bin size with the
least cost per expected token is opened. How full a new bin will get is not known
beforehand, so every fill rate of ``FILL_RATES`` is tried over a whole group and
the cheapest packing stays: the permitted lengths are optimised jointly. At the
end each bin is downsized to the smallest permitted length that holds its
contents.

Scale: a document longer than the largest capacity first gives off full pieces,
each a sequence of its own; no part is dropped. What is left of each document is
dealt by row number to groups of about ``GROUP_ROWS``, packed independently. The
number of groups follows the table, so no group grows with it; the loss is at
most a few open bins a group. Only ids and lengths are shuffled.

Defined cases: the length of a null or empty text is that of its end mark;
repeated rows are packed each on their own; ties in length go by id (null first),
then by row; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Sequence

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.llm.tables import table

CAPACITIES = (2048, 4096, 8192, 16384)
FILL_RATES = (0.0, 0.5, 0.8, 0.95, 1.0)
GROUP_ROWS = 8192
ATTENTION = 65536  # capacity at which attention costs as much as the linear work


def cost(capacity: int) -> float:
    return capacity * (1 + capacity / ATTENTION)


def byte_tokens(text: Column) -> Column:
    """Tokens of a text under a byte vocabulary, with one end mark."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def _openings(capacities: Sequence[int], fill: float, length: int) -> int:
    """The capacity to open for an item: least cost per token expected in it."""
    return min((c for c in capacities if c >= length),
               key=lambda c: (cost(c) / (length + fill * (c - length)), c))


def best_fit(lengths: Sequence[int], capacities: Sequence[int], fill: float) -> list[list[int]]:
    """Bins as lists of item numbers; lengths come in descending order."""
    room: list[tuple[int, int]] = []  # (room left, bin), sorted
    bins: list[list[int]] = []
    opened: dict[int, int] = {}
    for item, length in enumerate(lengths):
        k = bisect_left(room, (length, -1))
        if k < len(room):
            left, b = room.pop(k)
        else:
            if length not in opened:
                opened[length] = _openings(capacities, fill, length)
            left, b = opened[length], len(bins)
            bins.append([])
        bins[b].append(item)
        if left > length:
            insort(room, (left - length, b))
    return bins


def pack_group(lengths: Sequence[int], capacities: Sequence[int]) -> list[tuple[int, list[int]]]:
    """(capacity, items) of the cheapest packing, each bin downsized."""
    best: tuple[float, list[tuple[int, list[int]]]] | None = None
    for fill in FILL_RATES:
        packed = []
        for items in best_fit(lengths, capacities, fill):
            used = sum(lengths[i] for i in items)
            packed.append((next(c for c in capacities if c >= used), items))
        total = sum(cost(c) for c, _ in packed)
        if best is None or total < best[0]:
            best = total, packed
    return best[1] if best else []


def pack(items: DataFrame, key: str, length: Column, capacities: Sequence[int] = CAPACITIES,
         group_rows: int = GROUP_ROWS) -> DataFrame:
    """One row per piece of an item: (key, piece, start, length, bin_id, capacity, offset).

    start and length place the piece in the item, offset places it in its bin.
    """
    capacities = tuple(sorted(capacities))
    top = capacities[-1]
    groups = max(1, -(-items.count() // group_rows))
    rows = items.select(F.col(key).alias("__key"), length.cast("long").alias("__len"),
                        F.monotonically_increasing_id().alias("__row"))
    whole = F.floor((F.col("__len")) / top).cast("int")
    full = rows.where(whole > 0).select(
        "__key", "__row", F.explode(F.sequence(F.lit(0), whole - 1)).alias("piece")).select(
        "__key", "piece", (F.col("piece").cast("long") * top).alias("start"), F.lit(top).cast("long").alias("length"),
        F.concat(F.lit("w"), F.col("__row"), F.lit("-"), F.col("piece")).alias("bin_id"),
        F.lit(top).cast("long").alias("capacity"), F.lit(0).cast("long").alias("offset"))
    rest = rows.where(F.col("__len") % top > 0).select(
        "__key", "__row", whole.alias("piece"), (F.col("__len") % top).alias("length"),
        F.pmod(F.xxhash64("__row"), F.lit(groups)).alias("__group"))
    kind = rows.schema["__key"].dataType.simpleString()
    out = (f"__key {kind}, piece int, start long, length long, bin_id string, capacity long, offset long")

    def packed(group: pa.Table) -> pa.Table:
        group = group.take(pa.compute.sort_indices(group, [
            ("length", "descending"), ("__key", "ascending"), ("__row", "ascending")], null_placement="at_start"))
        lengths, name = group["length"].to_pylist(), group["__group"][0].as_py()
        order, bin_id, capacity, offset = [], [], [], []
        for b, (cap, members) in enumerate(pack_group(lengths, capacities)):
            at = 0
            for i in members:
                order.append(i)
                bin_id.append(f"g{name}-{b}")
                capacity.append(cap)
                offset.append(at)
                at += lengths[i]
        got = group.take(pa.array(order, pa.int64()))
        start = pa.compute.multiply(got["piece"].cast(pa.int64()), top)
        return pa.table({"__key": got["__key"], "piece": got["piece"], "start": start, "length": got["length"],
                         "bin_id": pa.array(bin_id, pa.string()), "capacity": pa.array(capacity, pa.int64()),
                         "offset": pa.array(offset, pa.int64())})

    return full.unionByName(rest.groupBy("__group").applyInArrow(packed, out)).withColumnRenamed("__key", key)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document placed in sequences of 2,048 to 16,384 byte tokens."""
    docs = table(spark, sf_dir, "documents", ("doc_id", "text"))
    return pack(docs, "doc_id", byte_tokens(F.col("text")))
