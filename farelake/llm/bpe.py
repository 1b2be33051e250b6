"""Byte-level BPE encoding and decoding by a global distinct-word shuffle.

Encoding, three steps:

1. Blocks of texts (about ``BLOCK_BYTES``) are cut into pre-tokens in vectorised
   passes over their code points. A block keeps each distinct pre-token once and
   the positions as numbers of them, so frequent words cost a number, not a row.
2. The distinct pre-tokens of all blocks are shuffled by their hash, packed by
   block and bucket; the task that owns a word's bucket encodes it once by the
   merge ranks.
3. The ids go back to the blocks (a cogroup by block), where the positions put them
   together in order.

Decoding looks every id up in the token-byte table, which is bounded by the
vocabulary and shipped to every task.

Pre-tokens follow the public pattern of the rank file (``public_tokenizers.PATTERN``):
contractions, runs of letters, numbers or other signs with one space before them,
and white space. No special tokens are recognised.

No group is larger than a block: a word is sent once for each block that holds it,
whatever the number of its occurrences. A text longer than a block is a block.

Defined cases: null and empty texts have no ids and decode to an empty string;
every row is encoded on its own; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import base64
import heapq

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.llm.tables import table
from farelake.llm.textscan import cuts, span_hashes, text_buffers

BLOCK_BYTES = 8 << 20
KEPT_WORDS = 400_000  # encoded words kept per task; beyond that the store starts anew
ESCAPE = 255  # numbers with a byte of their own
OTHER, LETTER, NUMBER, SPACE = range(4)


def load_ranks(path: str) -> list[bytes]:
    """Token bytes by rank, from a rank file."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    tokens = {int(b): base64.b64decode(a) for a, b in pairs}
    return [tokens[i] for i in range(len(tokens))]


def classes() -> np.ndarray:
    """Class of every code point: letter (L), number (N), white space or other."""
    import regex
    out = np.zeros(0x110000, np.int8)
    text = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
        for m in regex.finditer(pattern, text):
            a, b = ord(text[m.start()]), ord(text[m.end() - 1])
            out[a:b + 1] = kind
    out[0xD800:0xE000] = OTHER
    return out


def pretoken_starts(codes: np.ndarray, kinds: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Whether a pre-token begins at each code point; first: where texts begin."""
    n = len(codes)
    before = np.empty(n, np.int8)
    before[1:] = kinds[:-1]
    before[first] = -1
    start = kinds != before
    # A space run gives its last character off: a blank joins what follows.
    at = np.flatnonzero((kinds != SPACE) & (before == SPACE))
    start[at - 1] = True
    start[at[codes[at - 1] == 0x20]] = False
    # Contractions, where an apostrophe begins a pre-token.
    begins = np.zeros(n + 3, bool)
    begins[first] = True
    begins[n:] = True
    padded = np.concatenate([codes, np.zeros(3, codes.dtype)])
    quote = np.flatnonzero((codes == 0x27) & start)
    quote = quote[~begins[quote + 1]]
    a, b = padded[quote + 1], np.where(begins[quote + 2], 0, padded[quote + 2])
    one = np.isin(a, [ord(c) for c in "stmd"])
    two = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
    for some, length in ((one, 1), (two, 2)):
        start[quote[some] + 1] = False
        end = quote[some] + 1 + length
        start[end[end < n]] = True
    return start


def _ids(text_of: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: merge the neighbours of least rank, leftmost first."""
    whole = ranks.get(text_of)
    if whole is not None:
        return [whole]
    if len(text_of) > 48:
        return _ids_long(text_of, ranks)
    parts = [text_of[i:i + 1] for i in range(len(text_of))]
    pairs = [ranks.get(parts[i] + parts[i + 1], 1 << 30) for i in range(len(parts) - 1)]
    while pairs:
        low = min(pairs)
        if low == 1 << 30:
            break
        i = pairs.index(low)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i < len(pairs):
            pairs[i] = ranks.get(parts[i] + parts[i + 1], 1 << 30)
        if i:
            pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], 1 << 30)
    return [ranks[p] for p in parts]


def _ids_long(text_of: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same by a heap, for long pre-tokens."""
    n = len(text_of)
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # of the part that begins at i
    live = [True] * n
    heap = []

    def offer(i: int) -> None:
        j = end[i]
        if j < n:
            rank = ranks.get(text_of[i:end[j]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, j, end[j]))

    for i in range(n):
        offer(i)
    while heap:
        _, i, j, k = heapq.heappop(heap)
        if not live[i] or end[i] != j or j >= n or not live[j] or end[j] != k:
            continue
        live[j], end[i] = False, k
        if k < n:
            before[k] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [ranks[text_of[i:end[i]]] for i in range(n) if live[i]]


def _gather(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """values[start:start + size] of every pair, one behind the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.repeat(starts - (ends - sizes), sizes) + np.arange(total)]


def _planes(numbers: np.ndarray, kind: str) -> bytes:
    """Numbers byte plane by byte plane, compressed."""
    wide = np.dtype(kind)
    rows = np.ascontiguousarray(numbers.astype(wide).view(np.uint8).reshape(len(numbers), wide.itemsize).T)
    return zstandard.ZstdCompressor(level=3).compress(rows.tobytes())


def _from_planes(blob: bytes, kind: str) -> np.ndarray:
    wide = np.dtype(kind)
    rows = np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(wide.itemsize, -1)
    return np.ascontiguousarray(rows.T).view(wide).ravel().astype(np.int64)


def _numbers_out(numbers: np.ndarray, n: int) -> list[bytes]:
    """Numbers below n, compressed: one byte for the most frequent, an escape for the others."""
    frequent = np.argsort(-np.bincount(numbers, minlength=n), kind="stable")[:ESCAPE]
    short = np.full(n, ESCAPE, np.int64)
    short[frequent] = np.arange(len(frequent))
    codes = short[numbers]
    return [_planes(frequent, "<u4"), _planes(codes, "u1"), _planes(numbers[codes == ESCAPE], "<u4")]


def _numbers_in(blobs: list[bytes]) -> np.ndarray:
    frequent, codes, others = (_from_planes(x, kind) for x, kind in zip(blobs, ("<u4", "u1", "<u4"), strict=True))
    out = np.empty(len(codes), np.int64)
    out[codes == ESCAPE] = others
    out[codes != ESCAPE] = frequent[codes[codes != ESCAPE]]
    return out


def _words_out(words: list[bytes]) -> bytes:
    """Sorted words, compressed together."""
    sizes = np.array([len(w) for w in words], "<u4").tobytes()
    return zstandard.ZstdCompressor(level=3).compress(len(words).to_bytes(4, "little") + sizes + b"".join(words))


def _words_in(blob: bytes) -> list[bytes]:
    raw = zstandard.decompress(blob)
    n = int.from_bytes(raw[:4], "little")
    ends = (np.cumsum(np.frombuffer(raw, "<u4", n, 4)) + 4 + 4 * n).tolist()
    return [raw[a:b] for a, b in zip([4 + 4 * n, *ends], ends, strict=False)]


def _block(data: np.ndarray, offsets: np.ndarray, table_of: np.ndarray,
           buckets: int = 1) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """(distinct pre-tokens by bucket of their hash, sorted; their numbers, counted
    through the buckets, in text order; pre-tokens of each text)."""
    found, sizes = [], []
    for a, b in cuts(offsets, 1 << 20):
        raw = data[offsets[a]:offsets[b]].tobytes()
        codes = np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32)
        byte_at = np.append(np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80), len(raw))
        off = np.searchsorted(byte_at, offsets[a:b + 1] - offsets[a])
        first = np.unique(off[:-1])
        start = np.flatnonzero(pretoken_starts(codes, table_of[codes], first[first < len(codes)]))
        end = np.append(start[1:], len(codes))[:len(start)]
        keys, at, of = np.unique(span_hashes(codes, start, end), return_index=True, return_inverse=True)
        found.append((keys, [raw[byte_at[start[i]]:byte_at[end[i]]] for i in at], of))
        sizes.append(np.diff(np.searchsorted(start, off)))
    if not found:
        return [[] for _ in range(buckets)], np.zeros(0, np.int64), np.zeros(0, np.int64)
    keys, at, of = np.unique(np.concatenate([f[0] for f in found]), return_index=True, return_inverse=True)
    words = [w for f in found for w in f[1]]
    words = [words[i] for i in at]
    by_bucket: list[list[int]] = [[] for _ in range(buckets)]
    for i, bucket in enumerate((keys % np.uint64(buckets)).tolist()):
        by_bucket[bucket].append(i)
    order = [i for some in by_bucket for i in sorted(some, key=words.__getitem__)]
    number = np.empty(len(keys), np.int64)
    number[order] = np.arange(len(keys))
    parts, done = [], 0
    for f in found:
        parts.append(number[of[done:done + len(f[0])]][f[2]])
        done += len(f[0])
    ends = np.cumsum([len(some) for some in by_bucket]).tolist()
    return ([[words[i] for i in order[a:b]] for a, b in zip([0, *ends], ends, strict=False)],
            np.concatenate(parts), np.concatenate(sizes))


def encode(docs: DataFrame, tokens: list[bytes], key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids) of every row; ids: little-endian unsigned 32-bit integers."""
    context = docs.sparkSession.sparkContext
    rows = docs.select(F.col(key), F.col(text).alias("__text"))
    kind = rows.schema[0].dataType.simpleString()
    # Fixed tables, bounded by the vocabulary and the code space.
    shipped = context.broadcast((tokens, zstandard.compress(classes().tobytes())))

    # Some buckets for each task of the shuffle, so that tasks get equal shares.
    buckets = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def blocks(batches):
        table_of, number = None, 0
        part = TaskContext.get().partitionId()
        one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
        for batch in batches:
            if table_of is None:
                table_of = np.frombuffer(zstandard.decompress(shipped.value[1]), np.int8)
            data, offsets = text_buffers(batch.column(1))
            for a, b in cuts(offsets, BLOCK_BYTES):
                words, numbers, sizes = _block(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], table_of, buckets)
                used = [i for i, some in enumerate(words) if some]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part << 32 | number]), one(pa.array(used, pa.int32())),
                     one(pa.array([_words_out(words[i]) for i in used], pa.binary())), one(batch.column(0).slice(a, b - a)),
                     one(pa.array(sizes, pa.int32())), one(pa.array(_numbers_out(numbers, sum(map(len, words))), pa.binary()))],
                    ["block", "buckets", "words", "keys", "sizes", "numbers"])
                number += 1

    def words_of(batches):
        for batch in batches:
            for i in range(len(batch)):
                used, words = (batch.column(c).slice(i, 1).flatten() for c in (1, 2))
                yield pa.RecordBatch.from_arrays(
                    [used, pa.array(np.full(len(used), batch.column(0)[i].as_py())), words], ["bucket", "block", "words"])

    def encoded(batches):
        ranks, known = None, {}
        for batch in batches:
            ranks = ranks or {t: i for i, t in enumerate(shipped.value[0])}
            out = []
            for blob in batch.column(2).to_pylist():
                if len(known) > KEPT_WORDS:
                    known = {}
                got = []
                for word in _words_in(blob):
                    ids = known.get(word)
                    if ids is None:
                        ids = known[word] = _ids(word, ranks)
                    got.append(ids)
                out.append([_planes(np.array([len(x) for x in got]), "<u4"),
                            _planes(np.array([i for x in got for i in x]), "<u4")])
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(0), pa.array(out, pa.list_(pa.binary()))], ["block", "bucket", "ids"])

    def joined(block: pa.Table, coded: pa.Table) -> pa.Table:
        coded = coded.take(pa.array(np.argsort(coded["bucket"].to_numpy(), kind="stable")))
        pairs = [[_from_planes(x, "<u4") for x in pair] for pair in coded["ids"].to_pylist()]
        each, ids = (np.concatenate([np.zeros(0, np.int64), *[p[k] for p in pairs]]) for k in (0, 1))
        keys = block["keys"].combine_chunks().slice(0, 1).flatten()
        numbers = _numbers_in(block["numbers"][0].as_py())
        flat = _gather(ids.astype("<u4"), (np.cumsum(each) - each)[numbers], each[numbers])
        ends = np.concatenate([[0], np.cumsum(each[numbers])])[
            np.concatenate([[0], np.cumsum(np.array(block["sizes"][0].as_py(), np.int64))])]
        buffers = [None, pa.py_buffer((ends * 4).astype(np.int32).tobytes()), pa.py_buffer(flat.tobytes())]
        return pa.table({key: keys, "n_tokens": pa.array(np.diff(ends)),
                         "ids": pa.Array.from_buffers(pa.binary(), len(keys), buffers)})

    # One exchange: both uses take whole rows, so Spark reuses its output.
    cut = rows.mapInArrow(
        blocks, f"block long, buckets array<int>, words array<binary>, keys array<{kind}>, sizes array<int>, "
        "numbers array<binary>").repartition("block")
    coded = cut.mapInArrow(words_of, "bucket int, block long, words binary").repartition("bucket").mapInArrow(
        encoded, "block long, bucket int, ids array<binary>")
    return cut.groupBy("block").cogroup(coded.groupBy("block")).applyInArrow(
        joined, f"`{key}` {kind}, n_tokens long, ids binary")


def decode(coded: DataFrame, tokens: list[bytes], ids: str = "ids", out: str = "decoded") -> DataFrame:
    """coded with the bytes that its ids stand for, in place of the ids."""
    shipped = coded.sparkSession.sparkContext.broadcast(tokens)  # bounded by the vocabulary
    rest = [c for c in coded.columns if c != ids]
    fields = [coded.schema[c] for c in rest]

    def lookup(batches):
        table_of = None
        for batch in batches:
            if table_of is None:
                sizes = np.array([len(t) for t in shipped.value], np.int64)
                table_of = np.frombuffer(b"".join(shipped.value), np.uint8), np.cumsum(sizes) - sizes, sizes
            data, offsets = text_buffers(batch.column(len(rest)))
            for a, b in cuts(offsets, 2 << 20):
                found = np.frombuffer(data[offsets[a]:offsets[b]].tobytes(), "<u4").astype(np.int64)
                each = table_of[2][found]
                flat = _gather(table_of[0], table_of[1][found], each)
                ends = np.concatenate([[0], np.cumsum(each)])[(offsets[a:b + 1] - offsets[a]) // 4]
                buffers = [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(flat.tobytes())]
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(i).slice(a, b - a) for i in range(len(rest))],
                     pa.Array.from_buffers(pa.binary(), b - a, buffers)], [*rest, out])

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in fields], f"`{out}` binary"])
    return coded.select(*[F.col(f"`{c}`") for c in rest], ids).mapInArrow(lookup, schema)


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of every document and of what they decode to."""
    import public_tokenizers
    tokens = load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    coded = encode(table(spark, sf_dir, "documents", ("doc_id", "text")), tokens)
    both = coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), "ids")
    return decode(both, tokens).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))
