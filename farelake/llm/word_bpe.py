"""Byte pair encoding with word ends: speculate and verify.

Texts are cut into words in vectorised passes; the distinct words of a slice are
then encoded together:

1. *Speculate*: the longest token at every position, by a trie of the vocabulary
   stepped for all positions at once; following them from each word's begin
   proposes its tokens.
2. *Verify*: a proposal is the result of merging by rank if and only if no pair of
   adjacent tokens would have merged across their border. All distinct pairs are
   tested at once (``crosses``).
3. Only words with a crossing pair are merged exactly, rank by rank (``merge``).

Why pairs are enough: merging by rank builds a token from its parts in the order of
rank. Look at the first merge that a text's exact run makes across a border of the
proposal. Until then both tokens beside the border have been built as they are
alone, so the merge joins a part on the right edge of one with a part on the left edge
of the other, and it also happens when the two tokens stand alone. Tokens that are not
the result of merging their own symbols are found by the same test and never
proposed.

Text rules, those of the vocabulary file: special tokens are cut out first; the rest is
normalised (NFC, lower case code point by code point), white space separates words,
and a word is a contraction, a run of letters, one number or a run of other signs. The
last symbol of a word carries the word end. Decoding joins the token strings by one
space, as the file names no decoder.

Everything is local to a slice of ``SLICE_BYTES`` (one text at least): nothing is
shuffled, and a lost task is run again alone. The vocabulary tables are shipped to
every task; the vocabulary bounds them.

Defined cases: null and empty texts have no ids and decode to an empty string; every
row, repeated ones too, is encoded on its own; an empty table gives no rows; other
columns are ignored. Ids outside the vocabulary are left out by ``decode``.
"""

from __future__ import annotations

import heapq
import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.llm.tables import table
from farelake.llm.textscan import cuts, span_hashes, text_buffers

SLICE_BYTES = 3 << 19  # of texts: some 30 times as much in arrays at once
SLICE_IDS = 1 << 17  # of decoding
WORD_END = "</w>"
OTHER, LETTER, NUMBER, SPACE = range(4)
NEVER = np.int64(1) << 40
LONG = 64  # symbols; words beyond are merged one at a time, by a heap
SYMBOLS = 512  # bytes, and bytes that end a word
PLAIN_BELOW = 0x300  # texts of code points below are in normal form


def byte_letters() -> list[str]:
    """The letter that stands for each byte in token strings: printable bytes stand for
    themselves, the others for the code points from 256, in order."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


def code_tables() -> tuple[np.ndarray, np.ndarray]:
    """(class, lower case) of every code point, as the tokenizer library has them. A code
    point whose lower case is longer keeps itself here; ``LONGER`` holds it."""
    from tokenizers import Regex, normalizers, pre_tokenizers
    text = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    kinds = np.full(0x110000, OTHER, np.int8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        split = pre_tokenizers.Split(Regex(pattern), "removed", invert=True)
        for i in range(0, len(text), 1 << 12):  # its time grows with the square of the text
            for run, _ in split.pre_tokenize_str(text[i:i + (1 << 12)]):
                kinds[[ord(c) for c in run]] = kind
    low = np.arange(0x110000, dtype=np.uint32)
    others = text.replace("\n", "")
    for c, small in zip(others, normalizers.Lowercase().normalize_str("\n".join(others)).split("\n"), strict=True):
        if c != small and c not in LONGER:
            low[ord(c)] = ord(small)
    return kinds, low


LONGER = {"İ": "i̇"}  # fixed value: the one code point with a longer lower case


class Vocabulary:
    """Tables of a vocabulary file: token strings, merges and the trie of its tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model = file["model"]
        names = model["vocab"]
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.strings = [""] * (1 + max([*names.values(), *self.special.values()]))
        for name, i in [*names.items(), *self.special.items()]:
            self.strings[i] = name
        letters = byte_letters()
        #: id of each symbol: byte b, and byte b at the end of a word (256 + b)
        self.base = np.array([names[c + end] for end in ("", WORD_END) for c in letters], np.int64)
        n = len(self.strings)
        self.rank = np.full(n, -1, np.int64)  # of the merge that makes a token; -1: symbol
        self.left, self.right = np.zeros(n, np.int64), np.zeros(n, np.int64)
        symbols: dict[int, tuple[int, ...]] = {int(i): (s,) for s, i in enumerate(self.base)}
        keys = np.zeros(len(model["merges"]), np.int64)
        for r, merge_of in enumerate(model["merges"]):
            a, b = merge_of if isinstance(merge_of, list) else merge_of.split(" ")
            x, y, z = names[a], names[b], names[a + b]
            if self.rank[z] >= 0:
                raise ValueError("a token made by two merges cannot be verified by pairs")
            self.rank[z], self.left[z], self.right[z] = r, x, y
            keys[r] = x << 32 | y
            symbols[z] = symbols[x] + symbols[y]
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], order.astype(np.int64)
        self.made = np.zeros(len(keys), np.int64)
        self.made[self.rank[self.rank >= 0]] = np.flatnonzero(self.rank >= 0)
        sound = self._sound(sorted(symbols))
        self._trie({t: s for t, s in symbols.items() if t in sound})

    def _sound(self, tokens: list[int]) -> set[int]:
        """Tokens that merging their own symbols gives."""
        made = np.array([t for t in tokens if self.rank[t] >= 0], np.int64)
        apart = crosses(self, self.left[made], self.right[made], self.rank[made])
        bad = set(made[apart].tolist())
        sound: set[int] = set()
        for t in sorted(tokens, key=lambda t: self.rank[t]):
            if self.rank[t] < 0 or t not in bad and int(self.left[t]) in sound and int(self.right[t]) in sound:
                sound.add(t)
        return sound

    def _trie(self, symbols: dict[int, tuple[int, ...]]) -> None:
        step: dict[int, int] = {}
        token = [-1]
        for t, word in symbols.items():
            node = 0
            for s in word:
                key = node * SYMBOLS + s
                node = step.get(key, 0)
                if not node:
                    node = step[key] = len(token)
                    token.append(-1)
            token[node] = t
        keys = np.array(sorted(step), np.int64)
        self.step_keys, self.step_to = keys, np.array([step[k] for k in keys.tolist()], np.int64)
        self.token = np.array(token, np.int64)

    def ranks_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair of ids; NEVER where there is none."""
        key = a << np.int64(32) | b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NEVER)


def crosses(v: Vocabulary, a: np.ndarray, b: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
    """Whether merging by rank joins something across the border of tokens a and b (before
    the rank ``limit``).

    Both edges are walked back in time together: x, y are the parts at the border, until
    the ranks ``until_x``, ``until_y`` at which they become part of more. Their merge happens
    if its rank comes before; at equal rank the leftmost goes first, which is the merge on
    the left edge, then this one, then the one on the right edge.
    """
    out = np.zeros(len(a), bool)
    at = np.arange(len(a))
    x, y = a.copy(), b.copy()
    until_x = np.full(len(a), NEVER) if limit is None else limit.copy()
    until_y = until_x.copy()
    while len(at):
        rank = v.ranks_of(x, y)
        cross = (rank < until_x) & (rank <= until_y) & (rank < NEVER)
        out[at[cross]] = True
        made_x, made_y = v.rank[x], v.rank[y]
        go = ~cross & ((made_x >= 0) | (made_y >= 0))
        at, x, y, until_x, until_y, made_x, made_y = (z[go] for z in (at, x, y, until_x, until_y, made_x, made_y))
        back = made_x > made_y
        until_x, until_y = np.where(back, made_x, until_x), np.where(back, until_y, made_y)
        x, y = np.where(back, v.right[x], x), np.where(back, y, v.left[y])
    return out


def merge(ids: list[int], ranks: dict[int, int], made: list[int]) -> list[int]:
    """Exact merging of one long word: the adjacent pair of least rank, leftmost first, until
    none is left.

    ranks: rank by ``a << 32 | b``; made: the token of each rank.
    """
    n = len(ids)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(ranks[k], i) for i in range(n - 1) if (k := ids[i] << 32 | ids[i + 1]) in ranks]
    heapq.heapify(heap)
    while heap:
        rank, i = heapq.heappop(heap)
        j = after[i]
        if ids[i] < 0 or j >= n or ranks.get(ids[i] << 32 | ids[j]) != rank:
            continue
        ids[i], ids[j], after[i] = made[rank], -1, after[j]
        if after[i] < n:
            before[after[i]] = i
        for left in (before[i], i):
            if left >= 0 and after[left] < n and (k := ids[left] << 32 | ids[after[left]]) in ranks:
                heapq.heappush(heap, (ranks[k], left))
    return [t for t in ids if t >= 0]


def merge_words(v: Vocabulary, ids: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for many short words side by side: each round makes one merge in every word
    that has one left. of: the word of each id, ascending; returns (ids, of)."""
    done_ids, done_of = [], []
    rank = np.full(len(ids), NEVER)
    near = np.flatnonzero(of[1:] == of[:-1])
    rank[near] = v.ranks_of(ids[near], ids[near + 1])
    while len(ids):
        first = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
        size = np.diff(np.append(first, len(of)))
        least = np.minimum.reduceat(rank, first)
        going = np.repeat(least < NEVER, size)
        done_ids.append(ids[~going])
        done_of.append(of[~going])
        at = np.flatnonzero((rank == np.repeat(least, size)) & going)
        at = at[np.append(True, of[at[1:]] != of[at[:-1]])] if len(at) else at
        ids[at] = v.made[rank[at]]
        going[at + 1] = False
        at = np.cumsum(going)[at] - 1
        ids, of = ids[going], of[going]
        rank = rank[going]
        rank[at] = NEVER
        touched = np.concatenate([at, at[at > 0] - 1])
        touched = touched[touched + 1 < len(ids)]
        touched = touched[of[touched] == of[touched + 1]]
        rank[touched] = v.ranks_of(ids[touched], ids[touched + 1])
    of = np.concatenate([*done_of, of])
    order = np.argsort(of, kind="stable")
    return np.concatenate([*done_ids, ids])[order], of[order]


def _longest(v: Vocabulary, symbols: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(token, length) of the longest token at every position; ends: where its word ends."""
    token, size = np.full(len(symbols), -1, np.int64), np.zeros(len(symbols), np.int64)
    at, node, depth = np.arange(len(symbols)), np.zeros(len(symbols), np.int64), 0
    while len(at):
        key = node * SYMBOLS + symbols[at + depth]
        found = np.minimum(np.searchsorted(v.step_keys, key), len(v.step_keys) - 1)
        hit = v.step_keys[found] == key
        at, node = at[hit], v.step_to[found[hit]]
        depth += 1
        some = v.token[node] >= 0
        token[at[some]], size[at[some]] = v.token[node[some]], depth
        more = at + depth < ends[at]
        at, node = at[more], node[more]
    return token, size


def _path(size: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Positions met when going from each start to its end by steps of size, marked."""
    on = np.zeros(len(size), bool)
    at, end = starts, ends
    while len(at) > 64:
        on[at] = True
        at = at + size[at]
        go = at < end
        at, end = at[go], end[go]
    for a, e in zip(at.tolist(), end.tolist(), strict=True):
        steps, p, met = size[a:e].tolist(), 0, []
        while p < e - a:
            met.append(p)
            p += steps[p]
        on[a + np.array(met)] = True
    return on


def encode_words(v: Vocabulary, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                 exact: tuple[dict[int, int], list[int]], counts: dict[str, int] | None = None,
                 ) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all words one behind the other, ids of each word) of the words
    raw[start:end], none empty. counts: gets words and words merged exactly."""
    size = ends - starts
    begin = np.cumsum(size) - size
    symbols = raw[np.repeat(starts - begin, size) + np.arange(int(size.sum()))].astype(np.int64)
    symbols[begin + size - 1] += 256
    token, length = _longest(v, symbols, np.repeat(begin + size, size))
    on = _path(length, begin, begin + size)
    of = np.repeat(np.arange(len(size)), size)[on]
    ids = token[on]
    near = np.flatnonzero(of[1:] == of[:-1])
    pairs, which = np.unique(ids[near] << np.int64(32) | ids[near + 1], return_inverse=True)
    bad = crosses(v, pairs >> np.int64(32), pairs & np.int64(0xFFFFFFFF))[which]
    failed = np.unique(of[near[bad]])
    if counts is not None:
        counts["words"] = counts.get("words", 0) + len(size)
        counts["merged"] = counts.get("merged", 0) + len(failed)
    each = np.bincount(of, minlength=len(size))
    if len(failed):
        keep = np.ones(len(size), bool)
        keep[failed] = False
        bases = v.base[symbols]
        words = np.repeat(np.arange(len(size)), size)
        short = ~keep & (size <= LONG)
        some = short[words]
        parts = [(ids[keep[of]], of[keep[of]]), merge_words(v, bases[some], words[some])]
        for w in np.flatnonzero(~keep & ~short).tolist():
            one = np.array(merge(bases[begin[w]:begin[w] + size[w]].tolist(), *exact))
            parts.append((one, np.full(len(one), w)))
        of = np.concatenate([p[1] for p in parts])
        ids = np.concatenate([p[0] for p in parts])[np.argsort(of, kind="stable")]
        each = np.bincount(of, minlength=len(size))
    return ids, each


def word_starts(codes: np.ndarray, kinds: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Whether a word (or a run of white space) begins at each code point; first: where
    the texts begin."""
    n = len(codes)
    start = np.ones(n, bool)
    start[1:] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == NUMBER)
    start[first] = True
    # Contractions, where an apostrophe begins a word.
    edge = np.zeros(n + 3, bool)
    edge[first] = True
    edge[n:] = True
    padded = np.concatenate([codes, np.zeros(3, codes.dtype)])
    quote = np.flatnonzero((codes == ord("'")) & start)
    quote = quote[~edge[quote + 1]]
    a, b = padded[quote + 1], np.where(edge[quote + 2], 0, padded[quote + 2])
    one = np.isin(a, [ord(c) for c in "stmd"])
    two = np.isin(a, [ord("r"), ord("v")]) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
    for some, size in ((one, 1), (two, 2)):
        start[quote[some] + 1] = False
        end = quote[some] + 1 + size
        start[end[end < n]] = True
    return start


class Encoder:
    """Encoding of slices of texts; one per task."""

    def __init__(self, v: Vocabulary, kinds: np.ndarray, low: np.ndarray):
        from tokenizers import normalizers
        self.v, self.kinds, self.low = v, kinds, low
        self.nfc = normalizers.NFC().normalize_str
        self.exact = (dict(zip(v.pair_keys.tolist(), v.pair_ranks.tolist(), strict=True)), v.made.tolist())
        self.cut = re.compile("|".join(f"({re.escape(s)})" for s in v.special)) if v.special else None
        self.counts: dict[str, int] = {}

    def _normal(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(code points, offsets of the segments, special id of each or -1, segments
        before each text): texts without their specials, in normal form and lower case."""
        raw = data.tobytes()
        n = len(offsets) - 1
        whole = np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32)
        chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
        odd = np.zeros(len(whole) + 1, np.int64)
        np.cumsum((whole >= PLAIN_BELOW) | (whole == 0x130), out=odd[1:])
        redo = odd[chars[1:]] > odd[chars[:-1]]
        if any(s.encode() in raw for s in self.v.special):
            for i in range(n):
                redo[i] |= any(s.encode() in raw[offsets[i]:offsets[i + 1]] for s in self.v.special)
        if not redo.any():
            return self.low[whole], chars, np.full(n, -1, np.int64), np.arange(n + 1)
        parts, special, before = [], [], [0]
        for i in range(n):
            if not redo[i]:
                parts.append(whole[chars[i]:chars[i + 1]])
                special.append(-1)
            else:
                text = raw[offsets[i]:offsets[i + 1]].decode()
                for piece in self.cut.split(text) if self.cut else [text]:
                    if not piece:
                        continue
                    known = self.v.special.get(piece, -1)
                    if known < 0:
                        piece = self.nfc(piece)
                        for c, longer in LONGER.items():
                            piece = piece.replace(c, longer)
                    parts.append(np.frombuffer(piece.encode("utf-32-le"), np.uint32))
                    special.append(known)
            before.append(len(parts))
        ends = np.cumsum([0, *[len(p) for p in parts]])
        return self.low[np.concatenate([*parts, np.zeros(0, np.uint32)])], ends, np.array(special, np.int64), np.array(before)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one behind the other, ids of each text)."""
        codes, ends, special, before = self._normal(data, offsets)
        if not len(codes):
            return np.zeros(0, np.int64), np.zeros(len(offsets) - 1, np.int64)
        kinds = self.kinds[codes]
        marked = np.repeat(special, np.diff(ends))
        kinds[marked >= 0] = OTHER
        first = ends[:-1][np.diff(ends) > 0]
        start = word_starts(codes, kinds, first)
        start[marked >= 0] = False
        start[first] = True
        a = np.flatnonzero(start)
        b = np.append(a[1:], len(codes))
        word = kinds[a] != SPACE
        a, b = a[word], b[word]
        _, one, which = np.unique(span_hashes(codes, a, b), return_index=True, return_inverse=True)
        # UTF-8 of the distinct words.
        size = (b - a)[one]
        to = np.cumsum(size)
        text = codes[np.repeat(a[one] - (to - size), size) + np.arange(int(size.sum()))]
        raw = np.frombuffer(text.tobytes().decode("utf-32-le").encode(), np.uint8)
        lead = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))
        ids, each = encode_words(self.v, raw, lead[to - size], lead[to], self.exact, self.counts) if len(one) else (
            np.zeros(0, np.int64), np.zeros(0, np.int64))
        known = marked[a[one]] if len(one) else each
        if (known >= 0).any():
            keep = np.repeat(known < 0, each)
            ids, sizes = ids[keep], np.where(known < 0, each, 1)
            out = np.empty(int(sizes.sum()), np.int64)
            plain = np.repeat(known < 0, sizes)
            out[plain], out[~plain] = ids, known[known >= 0]
            ids, each = out, sizes
        found = each[which]
        at = (np.cumsum(each) - each)[which]
        to = np.cumsum(found)
        flat = ids[np.repeat(at - (to - found), found) + np.arange(int(to[-1]) if len(to) else 0)]
        total = np.concatenate([[0], to])[np.searchsorted(a, ends[before])]
        return flat, np.diff(total)


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids) of every row by the vocabulary file at path."""
    rows = docs.select(F.col(key), F.col(text).alias("__text"))
    kind = rows.schema[0].dataType.simpleString()
    shipped = docs.sparkSession.sparkContext.broadcast((Vocabulary(path), *code_tables()))  # bounded by the vocabulary

    def encoded(batches):
        encoder = None
        for batch in batches:
            encoder = encoder or Encoder(*shipped.value)
            data, offsets = text_buffers(batch.column(1))
            for a, b in cuts(offsets, SLICE_BYTES):
                ids, each = encoder.encode(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                ends = np.concatenate([[0], np.cumsum(each)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(each),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(ids.astype(np.int32)))], [key, "n_tokens", "ids"])

    return rows.mapInArrow(encoded, f"`{key}` {kind}, n_tokens long, ids array<int>")


def decode(coded: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """coded with the text that its ids stand for, in place of the ids."""
    strings = Vocabulary(path).strings
    shipped = coded.sparkSession.sparkContext.broadcast([s.encode() for s in strings])  # bounded by the vocabulary
    rest = [c for c in coded.columns if c != ids]
    fields = [coded.schema[c] for c in rest]

    def lookup(batches):
        raw = None
        for batch in batches:
            if raw is None:
                size = np.array([len(s) + 1 if s else 0 for s in shipped.value], np.int64)
                raw, begin = np.frombuffer(b"".join(s + b" " for s in shipped.value if s), np.uint8), np.cumsum(size) - size
            lists = batch.column(len(rest))
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            each = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            ends = np.concatenate([[0], np.cumsum(each)]).astype(np.int64)
            for a, b in cuts(ends, SLICE_IDS):
                some = flat[ends[a]:ends[b]]
                some = np.where((some < 0) | (some >= len(size)), -1, some)
                n = np.where(some < 0, 0, size[some])
                to = np.concatenate([[0], np.cumsum(n)])
                text = raw[np.repeat(begin[some] - to[:-1], n) + np.arange(int(to[-1]))]
                edge = to[ends[a:b + 1] - ends[a]]
                keep = np.ones(len(text), bool)
                keep[edge[1:][np.diff(edge) > 0] - 1] = False  # no space behind the last token
                edge = edge - np.concatenate([[0], np.cumsum(np.diff(edge) > 0)])
                buffers = [None, pa.py_buffer(edge.astype(np.int32).tobytes()), pa.py_buffer(text[keep].tobytes())]
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(i).slice(a, b - a) for i in range(len(rest))],
                     pa.Array.from_buffers(pa.string(), b - a, buffers)], [*rest, out])

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in fields], f"`{out}` string"])
    return coded.select(*[F.col(f"`{c}`") for c in rest], ids).mapInArrow(lookup, schema)


def op12_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of every document and of what they decode to."""
    import public_tokenizers
    path = public_tokenizers.path("word_bpe_49k.json")
    coded = encode(table(spark, sf_dir, "documents", ("doc_id", "text")), path)
    both = coded.select("doc_id", "n_tokens", F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"), "ids")
    return decode(both, path).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))
