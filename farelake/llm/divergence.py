"""Source divergence audit with a minimal acyclic transducer as the vocabulary.

How far do the sources of a language differ in their terms, and by which terms?

1. *Kept terms*: documents with each (lang, term) are counted; terms in ``MIN_DOCS`` of a
   language's documents stay. They are sorted over ranges, and each gets its ordinal in the
   order of UTF-8 within its language.
2. *Vocabulary*: a language's terms are dealt into shards by their hash, at least
   ``MIN_SHARDS`` and at most about ``SHARD_TERMS`` terms each. A minimal acyclic transducer is built from the sorted terms of a
   shard (``transducer.py``); its ordinals stand for the language's by one array.
3. *Recount*: texts are read again in blocks. The distinct terms of a block, with their
   counts by source, go to the shards they hash to and stream through the transducer there,
   which turns them into ordinals; terms that it does not accept are not kept. Everything
   after this works on (lang, source, ordinal, count), and ties in the order of terms are
   ties in ordinals.
4. *Audit*: shares and their divergences, in whole numbers. Pairs of sources are compared
   in tiles of sources by blocks of ordinals, as in a product of matrices, and the tiles'
   sums are added.

Nothing is broadcast by this module. A task holds a block of ``BLOCK_BYTES`` (one text at
least), one shard's transducer, or one tile. Streams of one shard are dealt over ``salts``
tasks, so a language that holds most of the text is spread.

Shares: p = 1 + floor(SCALE * (count + 1) / (N + V)); divergence: floor((p - q)^2 / q).

Defined cases: null text, lang and source are empty strings; rows with one doc_id are
documents of their own (no id is read); a language without kept terms has pairs of value
0; an empty table gives no rows; other columns are ignored. 64-bit hashes tell the distinct
terms of a block apart.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farelake.llm.tables import table, written
from farelake.llm.textscan import LOWER, cuts, span_hashes, text_buffers
from farelake.llm.transducer import Transducer

MIN_DOCS = 3
SCALE = 1_000_000_000
TOP_TERMS = 200
SHARD_TERMS = 1 << 16
MIN_SHARDS = 16  # so that what a block sends to one shard stays small
BLOCK_BYTES = 8 << 20
TILE = 128  # sources
ORDINALS = 1 << 12  # ordinals of a block in the comparison of pairs
HELD = 1 << 20  # counts held by a task before they are added up

TERM = np.zeros(256, bool)
TERM[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def term_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, text) of all terms: runs of ASCII letters and other code points."""
    term = TERM[data]
    first, last = term.copy(), term.copy()
    first[1:] &= ~term[:-1]
    last[:-1] &= ~term[1:]
    inner = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
    first[inner] = term[inner]
    last[inner - 1] = term[inner - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(offsets, starts, "right") - 1


def _codes(column: pa.Array) -> tuple[np.ndarray, list[str]]:
    """A string column as numbers of its distinct values."""
    coded = column.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary.to_pylist()


def _pick(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of the spans one behind the other, their ends)."""
    size = ends - starts
    to = np.cumsum(size)
    return raw[np.repeat(starts - (to - size), size) + np.arange(int(size.sum()))], to


def _strings(raw: np.ndarray, to: np.ndarray, kind: pa.DataType) -> pa.Array:
    ends = np.concatenate([[0], to]).astype(np.int32)
    return pa.Array.from_buffers(kind, len(to), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(raw.tobytes())])


def _source_rows(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])


def term_documents(docs: DataFrame) -> DataFrame:
    """(lang, term, docs) added up by block: how many documents hold a term."""
    def counted(batches):
        for batch in batches:
            lang, names = _codes(batch.column(0))
            data, offsets = text_buffers(batch.column(1))
            for a, b in cuts(offsets, BLOCK_BYTES):
                raw, off = LOWER[data[offsets[a]:offsets[b]]], offsets[a:b + 1] - offsets[a]
                starts, ends, text = term_spans(raw, off)
                # One hash tells the term and its language, one pass the pairs with documents.
                h = span_hashes(raw, starts, ends) + lang[a + text].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                order = np.argsort(h, kind="stable")  # texts of a term stay in order
                h, text = h[order], text[order]
                fresh = np.append(True, h[1:] != h[:-1])[:len(h)]
                once = fresh | np.append(True, text[1:] != text[:-1])[:len(h)]
                at = np.flatnonzero(fresh)
                if not len(at):
                    continue
                n = np.add.reduceat(once.astype(np.int64), at)
                term, to = _pick(raw, starts[order[at]], ends[order[at]])
                langs = pa.array(names, pa.string()).take(pa.array(lang[a + text[at]]))
                yield pa.RecordBatch.from_arrays([langs, _strings(term, to, pa.string()), pa.array(n)], ["lang", "term", "docs"])

    return docs.select("lang", "text").mapInArrow(counted, "lang string, term string, docs long")


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, term, ordinal) of the terms in at least min_docs documents of a language;
    ordinal: place in the UTF-8 order of the language's terms, from 0."""
    kept = written(term_documents(docs).groupBy("lang", "term").agg(F.sum("docs").alias("docs"))
                   .where(F.col("docs") >= min_docs).select("lang", "term"), "divergence-terms")

    def numbered(batches):
        part, lang, n = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            langs = batch.column(0).to_pylist()
            places = []
            for x in langs:
                n = n + 1 if x == lang else 0
                lang = x
                places.append(n)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([part] * len(langs), pa.int32()), pa.array(places, pa.int64())],
                                             ["lang", "term", "part", "place"])

    ranged = written(kept.repartitionByRange("lang", "term").sortWithinPartitions("lang", "term").mapInArrow(
        numbered, "lang string, term string, part int, place long"), "divergence-sorted")
    # One row for each language and range: how many terms lie in the ranges before.
    ranges = ranged.groupBy("lang", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("lang").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    ranges = ranges.select("lang", "part", F.coalesce(before, F.lit(0)).alias("before"))
    return ranged.join(ranges, ["lang", "part"]).select("lang", "term", (F.col("before") + F.col("place")).alias("ordinal"))


def vocabulary(terms: DataFrame, shards: int) -> DataFrame:
    """(lang, shard, transducer, ordinals): a transducer of every shard of a language, and
    the language's ordinals in the order of the shard's own."""
    def dealt(batches):
        for batch in batches:
            raw, off = text_buffers(batch.column(1))
            h = span_hashes(raw, off[:-1], off[1:])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array((h % np.uint64(shards)).astype(np.int32))],
                                             ["lang", "term", "ordinal", "shard"])

    def build(shard: pa.Table) -> pa.Table:
        shard = shard.sort_by("ordinal")
        built = Transducer.build(t.encode() for t in shard["term"].to_pylist())
        return pa.table({"lang": shard["lang"].slice(0, 1), "shard": shard["shard"].slice(0, 1),
                         "transducer": pa.array([zstandard.compress(built.to_bytes())], pa.binary()),
                         "ordinals": pa.array([shard["ordinal"].to_numpy().astype("<i8").tobytes()], pa.binary())})

    return terms.mapInArrow(dealt, "lang string, term string, ordinal long, shard int").groupBy("lang", "shard").applyInArrow(
        build, "lang string, shard int, transducer binary, ordinals binary")


def _squeeze(*arrays: np.ndarray) -> bytes:
    """Arrays of one type each, compressed together."""
    parts = [np.array([len(x)], "<i8").tobytes() + x.astype("<i4").tobytes() for x in arrays]
    return zstandard.compress(b"".join(parts))


def _unsqueeze(blob: bytes, n: int) -> list[np.ndarray]:
    raw, at, out = zstandard.decompress(blob), 0, []
    for _ in range(n):
        size = int(np.frombuffer(raw, "<i8", 1, at)[0])
        out.append(np.frombuffer(raw, "<i4", size, at + 8).astype(np.int64))
        at += 8 + 4 * size
    return out


def recount(docs: DataFrame, shards_of: DataFrame, shards: int, salts: int) -> DataFrame:
    """(lang, source, ordinal, count) of the kept terms, by streaming the texts' terms
    through the transducers; a row for each task that counted."""
    def blocks(batches):
        part = TaskContext.get().partitionId()
        number = 0
        for batch in batches:
            lang, langs = _codes(batch.column(0))
            source, sources = _codes(batch.column(1))
            data, offsets = text_buffers(batch.column(2))
            for a, b in cuts(offsets, BLOCK_BYTES):
                raw, off = LOWER[data[offsets[a]:offsets[b]]], offsets[a:b + 1] - offsets[a]
                starts, ends, text = term_spans(raw, off)
                h = span_hashes(raw, starts, ends)
                out = []
                for x in np.unique(lang[a:b]).tolist():
                    some = np.flatnonzero(lang[a + text] == x)
                    keys, one, of = np.unique(h[some], return_index=True, return_inverse=True)
                    used, by = np.unique(source[a + text[some]], return_inverse=True)
                    cells, counts = np.unique(of.astype(np.int64) * len(used) + by, return_counts=True)
                    shard = (keys % np.uint64(shards)).astype(np.int64)
                    cell_shard = shard[cells // max(1, len(used))]
                    for s in np.unique(shard).tolist():
                        mine = np.flatnonzero(shard == s)
                        at = some[one[mine]]
                        spans, to = _pick(raw, starts[at], ends[at])
                        mine_cells = cell_shard == s
                        c = cells[mine_cells]
                        out.append((langs[x], s, (part + number) % salts, [sources[i] for i in used.tolist()], zstandard.compress(spans.tobytes()),
                                    _squeeze(to, np.searchsorted(mine, c // len(used)), c % len(used), counts[mine_cells])))
                number += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 6, STREAM[:6], strict=True)],
                    ["lang", "shard", "salt", "sources", "terms", "cells"])

    def streamed(batches):
        """Rows in the order of (lang, shard, salt), the transducer first, then the blocks."""
        here, built, local, names, held, waiting = None, None, None, {}, [], 0

        def rows():
            if not held:
                return
            key = np.concatenate([k for k, _ in held])
            keys, of = np.unique(key, return_inverse=True)
            n = np.zeros(len(keys), np.int64)
            np.add.at(n, of, np.concatenate([c for _, c in held]))
            of_source = pa.array(list(names), pa.string()).take(pa.array(keys // len(local)))
            for i in range(0, len(keys), 1 << 16):
                j = min(i + (1 << 16), len(keys))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([here[0]] * (j - i), pa.string()), of_source.slice(i, j - i), pa.array(local[keys[i:j] % len(local)]),
                     pa.array(n[i:j])], ["lang", "source", "ordinal", "count"])

        for batch in batches:
            for lang, shard, salt, sources, terms, cells, ordinals in zip(*[batch.column(i).to_pylist() for i in range(7)], strict=True):
                if (lang, shard, salt) != here:
                    yield from rows()
                    here, built, names, held, waiting = (lang, shard, salt), None, {}, [], 0
                if ordinals is not None:
                    built, local = Transducer.from_bytes(zstandard.decompress(terms)), np.frombuffer(ordinals, "<i8")
                elif built is not None:
                    to, term, source, count = _unsqueeze(cells, 4)
                    raw = np.frombuffer(zstandard.decompress(terms), np.uint8)
                    found = built.ordinals(raw, np.concatenate([[0], to[:-1]]), to)[term]
                    number = np.array([names.setdefault(s, len(names)) for s in sources], np.int64)
                    kept = found >= 0
                    held.append((number[source[kept]] * len(local) + found[kept], count[kept]))
                    waiting += len(count)
                    if waiting > HELD:
                        key, of = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
                        n = np.zeros(len(key), np.int64)
                        np.add.at(n, of, np.concatenate([c for _, c in held]))
                        held, waiting = [(key, n)], 0
                        if len(key) > HELD:
                            yield from rows()
                            held, names = [], {}
        yield from rows()

    texts = docs.select("lang", "source", "text").mapInArrow(
        blocks, "lang string, shard int, salt int, sources array<string>, terms binary, cells binary")
    tools = shards_of.select("lang", "shard", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"),
                             F.lit(None).cast("array<string>").alias("sources"), F.col("transducer").alias("terms"),
                             F.lit(None).cast("binary").alias("cells"), "ordinals")
    both = texts.withColumn("ordinals", F.lit(None).cast("binary")).unionByName(tools)
    return both.repartition("lang", "shard", "salt").sortWithinPartitions(
        "lang", "shard", "salt", F.col("ordinals").isNull()).mapInArrow(
        streamed, "lang string, source string, ordinal long, count long")


STREAM = [pa.string(), pa.int32(), pa.int32(), pa.list_(pa.string()), pa.binary(), pa.binary()]


def share(count: Column, total: Column) -> Column:
    """1 + floor(SCALE * (count + 1) / total) in whole numbers: long division in three
    steps of a thousand, so nothing overflows below 9e15 terms."""
    out, rest = F.lit(1).cast("long"), count + 1
    for power in (1_000_000, 1_000, 1):
        out = out + _div(rest * 1000, total) * power
        rest = (rest * 1000) % total
    return out


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def gap(p: Column, q: Column) -> Column:
    return _div((p - q) * (p - q), q)


def pair_gaps(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, a, b, value) for all ordered pairs of sources of a language: the sum of the
    divergences of a from b over all kept terms. counts: (lang, place, ordinal, count);
    groups: (lang, place, total, terms); place: number of the source in its language."""
    cells = counts.groupBy("lang", "place", F.floor(F.col("ordinal") / ORDINALS).alias("block")).agg(
        F.collect_list(F.struct((F.col("ordinal") % ORDINALS).cast("int").alias("i"), "count")).alias("cells"))
    blocks = groups.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(
        F.floor((F.col("terms") - 1) / ORDINALS), F.lit(0)))))
    rows = blocks.join(cells, ["lang", "place", "block"], "left")
    tiles = groups.groupBy("lang").agg(F.floor(F.max("place") / TILE).alias("last"))
    tile = F.floor(F.col("place") / TILE)
    dealt = rows.join(tiles, "lang").withColumn("tile", tile).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("last"))))
    dealt = dealt.select("lang", "block", F.least("tile", "other").alias("t1"), F.greatest("tile", "other").alias("t2"),
                         "place", "total", "terms", F.col("cells")["i"].alias("at"), F.col("cells")["count"].alias("n"))

    def compare(tiles_of: pa.Table) -> pa.Table:
        place = tiles_of["place"].to_numpy()
        total = tiles_of["total"].to_numpy()
        block, t1, t2 = (int(tiles_of[c][0].as_py()) for c in ("block", "t1", "t2"))
        terms = int(tiles_of["terms"][0].as_py())
        width = max(0, min(ORDINALS, terms - block * ORDINALS))
        n = np.zeros((len(place), width), np.int64)
        for row, (at, count) in enumerate(zip(tiles_of["at"].to_pylist(), tiles_of["n"].to_pylist(), strict=True)):
            if at:
                n[row, at] = count
        # SCALE * (count + 1) in three steps of a thousand, as in share().
        p, rest = np.ones_like(n), n + 1
        for power in (1_000_000, 1_000, 1):
            rest *= 1000
            p += rest // total[:, None] * power
            rest %= total[:, None]
        left, right = np.flatnonzero(place // TILE == t1), np.flatnonzero(place // TILE == t2)
        a, b, value = [], [], []
        for i in left.tolist():
            d = (p[i] - p[right]) ** 2
            there, back = (d // p[right]).sum(axis=1), (d // p[i]).sum(axis=1)
            for x, y, v in ((np.full(len(right), place[i]), place[right], there), (place[right], np.full(len(right), place[i]), back)):
                a.append(x)
                b.append(y)
                value.append(v)
                if t1 == t2:
                    break  # the other row of the tile gives the way back
        a, b, value = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b, value))
        other = a != b
        return pa.table({"lang": pa.array([tiles_of["lang"][0].as_py()] * int(other.sum()), pa.string()),
                         "a": a[other], "b": b[other], "value": value[other]})

    return dealt.groupBy("lang", "block", "t1", "t2").applyInArrow(
        compare, "lang string, a long, b long, value long").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source is from each other one
    of its language (part ``pair``), and the terms that it has more than its language, the
    ``top`` most divergent (part ``term``)."""
    spark = docs.sparkSession
    rows = _source_rows(docs)
    terms = written(kept_terms(rows, min_docs), "divergence-ordinals")
    sizes = terms.groupBy("lang").agg(F.count("*").alias("terms"))
    largest = sizes.agg(F.max("terms")).first()[0] or 0
    shards = max(MIN_SHARDS, -(-largest // SHARD_TERMS))
    # Streams of one shard are dealt so that all shards of a language fill the cluster once.
    salts = max(1, -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // shards))
    counts = written(recount(rows, vocabulary(terms, shards), shards, salts)
                     .groupBy("lang", "source", "ordinal").agg(F.sum("count").alias("count")), "divergence-counts")

    totals = counts.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    every = rows.select("lang", "source").distinct().join(sizes, "lang", "left").join(totals, ["lang", "source"], "left")
    every = every.select("lang", "source", F.coalesce("terms", F.lit(0)).alias("terms"), F.coalesce("n", F.lit(0)).alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long") - 1
    groups = written(every.select("lang", "source", "terms", place.alias("place"),
                                  F.greatest(F.col("n") + F.col("terms"), F.lit(1)).alias("total")), "divergence-groups")

    placed = counts.join(groups.select("lang", "source", "place"), ["lang", "source"]).select("lang", "place", "ordinal", "count")
    name = lambda number, named: groups.select("lang", F.col("place").alias(number), F.col("source").alias(named))
    pairs = pair_gaps(placed, groups.select("lang", "place", "total", "terms")).join(
        name("a", "source"), ["lang", "a"]).join(name("b", "item"), ["lang", "b"])
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))

    in_lang = counts.groupBy("lang", "ordinal").agg(F.sum("count").alias("lang_count"))
    lang_totals = groups.groupBy("lang").agg(F.sum(F.col("total") - F.col("terms")).alias("n"), F.max("terms").alias("terms")).select(
        "lang", (F.col("n") + F.col("terms")).alias("lang_total"))
    shares = counts.join(in_lang, ["lang", "ordinal"]).join(groups.select("lang", "source", "total"), ["lang", "source"]).join(
        lang_totals, "lang").select("lang", "source", "ordinal", share(F.col("count"), F.col("total")).alias("p"),
                                    share(F.col("lang_count"), F.col("lang_total")).alias("q"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ordinal")
    best = shares.where("p > q").select("lang", "source", "ordinal", gap(F.col("p"), F.col("q")).alias("value")).withColumn(
        "rank", F.row_number().over(order)).where(F.col("rank") <= top)
    best = best.join(terms, ["lang", "ordinal"]).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")
    return pairs.unionByName(best)


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergences of all (lang, source) groups of documents."""
    return audit(table(spark, sf_dir, "documents", ("lang", "source", "text")))


ORACLE = """
with docs as (
  select row_number() over () as doc, coalesce(lang, '') as lang, coalesce(source, '') as source, coalesce(text, '') as text
  from documents
), occurs as (
  select doc, lang, source, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term
  from docs
), kept as (
  select lang, term from occurs group by lang, term having count(distinct doc) >= 3
), langs as (
  select lang, count(term) as v from (select distinct lang from docs) left join kept using (lang) group by lang
), groups as (
  select distinct lang, source from docs
), counts as (
  select lang, source, term, count(*) as n from occurs semi join kept using (lang, term) group by lang, source, term
), dense as (
  select g.lang, g.source, k.term, coalesce(c.n, 0) as n, sum(coalesce(c.n, 0)) over (partition by g.lang, g.source) as total,
    sum(coalesce(c.n, 0)) over (partition by g.lang, k.term) as lang_n
  from groups g join kept k using (lang) left join counts c on c.lang = g.lang and c.source = g.source and c.term = k.term
), shares as (
  select lang, source, term, n, 1 + (1000000000::hugeint * (n + 1)) // (total + v) as p,
    1 + (1000000000::hugeint * (lang_n + 1)) // (sum(n) over (partition by lang) + v) as q
  from dense join langs using (lang)
), pairs as (
  select a.lang, a.source, b.source as item, coalesce(x.value, 0) as value
  from groups a join groups b on b.lang = a.lang and b.source <> a.source
  left join (
    select s.lang, s.source, o.source as item, sum((s.p - o.p) * (s.p - o.p) // o.p) as value
    from shares s join shares o on o.lang = s.lang and o.term = s.term and o.source <> s.source group by all
  ) x on x.lang = a.lang and x.source = a.source and x.item = b.source
), terms as (
  select lang, source, term as item, (p - q) * (p - q) // q as value from shares where n > 0 and p > q
), ranked as (
  select lang, source, 'pair' as part, item, value from pairs
  union all
  select lang, source, 'term', item, value from terms
), numbered as (
  select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from ranked
)
select lang, source, part, item, cast(value as bigint) as value, cast(rank as integer) as rank
from numbered where part = 'pair' or rank <= 200
"""
