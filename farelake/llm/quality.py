"""Quality rules: a linear-chain conditional random field over the lines of a text.

Every line with a word gets a label, content or boilerplate, by Viterbi decoding:
a line's score comes from bucketed features of its words and signs (``FEATURES``),
neighbouring lines are tied by transition weights. A text is kept if at least
``MIN_CONTENT`` of its words stand in content lines and the base rules pass.

The weights are fitted on labelled documents by L2-penalised likelihood. The lines
of a document carry its quality label, but a line of a bad document that also
stands in a good one of the sample is content. The sample is bounded by documents:
the first ``TRAIN_DOCS`` by hash of their id, and the first ``TRAIN_LEAST`` of each
label, so that a rare label is in it. All lines of a sampled document take part, a
long one in sequences of ``TRAIN_LINES`` lines; everything else covers all rows and
whole texts. Without labels of both classes there is no field and every line
counts as content; a warning tells if the labels hold both but the sample's
documents do not.

Base figures (``base_rules``): words are runs outside 0x20 and 0x09..0x0D.

* word_chars: code points in words; n_symbols: characters of ``#*$%&|<>``;
* n_dup_lines: lines (cut at line feeds) with a word, equal to an earlier line;
* n_repeat_words: words in 5-word windows found twice or more in the text;
* base_failed: n_words < 10 or 100 * n_repeat_words > 20 * n_words.

Lines and windows are compared by 64-bit hashes.

Defined cases: null and empty texts have no words and fail the base rules; every
row is judged on its own, so ties and repeated rows need no rule; an empty table
gives no rows; other columns are ignored (``judge``) or kept (``keep_quality``);
labels of an unknown, null or contradictory document are not used.
"""

from __future__ import annotations

import warnings

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.llm.tables import table
from farelake.llm.textscan import SPACE, Scan, scans, span_hashes, window_hashes

TRAIN_DOCS, TRAIN_LINES = 2000, 48
TRAIN_LEAST = 200
MIN_CONTENT = 0.5
MIN_WORDS, REPEAT_PERCENT, WINDOW = 10, 20, 5
SYMBOLS = b"#*$%&|<>"
STEPS, RATE, PENALTY = 150, 0.3, 1e-4


def _flag(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_SYMBOL, _SHOUT, _DIGIT = _flag(SYMBOLS), _flag(b"!"), _flag(b"0123456789")
_STOP = _flag(b".,;:?")
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True
_LETTER[128:] = True
_POINT = np.ones(256, bool)  # bytes that begin a code point
_POINT[0x80:0xC0] = False

#: name -> upper edges of its buckets; one weight for each bucket
FEATURES = {
    "words": (1, 3, 7, 15),
    "upper_per_letter": (0, 0.1, 0.5),
    "symbols_per_word": (0, 0.1, 0.5),
    "shouts_per_word": (0, 0.1, 0.5),
    "digits_per_byte": (0, 0.1),
    "stops_per_word": (0, 0.05, 0.2),
    "repeats_per_word": (0, 0.1, 0.5),
    "window_repeats": (0, 0.2, 0.5),
    "seen_before": (0,),
    "bytes_per_word": (3, 8, 13),
    "place": (0, 1),
}
_AT = np.concatenate([[0], np.cumsum([len(e) + 1 for e in FEATURES.values()])])
N_WEIGHTS = int(_AT[-1])


def _sums(flags: np.ndarray) -> np.ndarray:
    out = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=out[1:])
    return out


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Which of some hashes occur twice or more."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    out = np.zeros(len(keys), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


class Lines:
    """Base figures of every text of a scan, and its lines with their features."""

    def __init__(self, scan: Scan):
        data, off, ptr = scan.data, scan.offsets, scan.ptr
        self.n_words = np.diff(ptr)
        self.word_chars = scan.per_text(scan.is_word & _POINT[data])
        self.n_symbols = scan.per_text(_SYMBOL[data])
        words = scan.word_hashes()
        covered = np.zeros(len(words) + 1, np.int64)
        windows = window_hashes(words, WINDOW)
        for i in range(scan.n):
            a, b = ptr[i], ptr[i + 1] - WINDOW + 1
            if b - a > 1:
                ordered = np.sort(windows[a:b])
                if (ordered[1:] == ordered[:-1]).any():
                    at = a + np.flatnonzero(_repeated(windows[a:b]))
                    # covered: +1 where a repeated window begins, -1 behind its end
                    covered[at] += 1
                    np.subtract.at(covered, at + WINDOW, 1)
        in_repeat = np.cumsum(covered)[:-1] > 0
        repeat = _sums(in_repeat)
        self.n_repeat = repeat[ptr[1:]] - repeat[ptr[:-1]]

        feeds = np.flatnonzero(data == 10)
        starts = np.unique(np.concatenate([off[:-1], feeds + 1]))
        starts = starts[starts < len(data)]
        bounds = np.append(starts, len(data))
        first, last = np.searchsorted(scan.starts, bounds[:-1]), np.searchsorted(scan.starts, bounds[1:])
        has = last > first
        starts, ends, first, last = starts[has], bounds[1:][has], first[has], last[has]
        self.doc = np.searchsorted(off, starts, "right") - 1
        ends = ends - (data[ends - 1] == 10)
        #: lines of text i are ptr[i] .. ptr[i + 1]
        self.ptr = np.searchsorted(self.doc, np.arange(scan.n + 1))
        self.words = last - first
        self.keys = keys = span_hashes(data, starts, ends)
        seen = np.zeros(len(keys), bool)
        for i in np.flatnonzero(np.diff(self.ptr) > 1):
            a, b = self.ptr[i], self.ptr[i + 1]
            seen[a:b] = True
            seen[a + np.unique(keys[a:b], return_index=True)[1]] = False
        seen_sums = _sums(seen)
        self.n_dup_lines = seen_sums[self.ptr[1:]] - seen_sums[self.ptr[:-1]]
        if not len(starts):
            self.ids = np.zeros((0, len(FEATURES)), np.int16)
            return

        def count(flags: np.ndarray) -> np.ndarray:
            sums = _sums(flags[data])
            return sums[ends] - sums[starts]

        again = _sums(np.concatenate([[False], words[1:] == words[:-1]]))
        place = np.ones(len(starts))
        place[self.ptr[:-1][self.ptr[:-1] < self.ptr[1:]]] = 0
        place[self.ptr[1:][self.ptr[:-1] < self.ptr[1:]] - 1] += 1
        n = self.words
        values = {
            "words": n,
            "upper_per_letter": count(_UPPER) / np.maximum(count(_LETTER), 1),
            "symbols_per_word": count(_SYMBOL) / n,
            "shouts_per_word": count(_SHOUT) / n,
            "digits_per_byte": count(_DIGIT) / (ends - starts),
            "stops_per_word": count(_STOP) / n,
            "repeats_per_word": (again[last] - again[first + 1]) / n,
            "window_repeats": (repeat[last] - repeat[first]) / n,
            "seen_before": seen,
            "bytes_per_word": count(~SPACE) / n,
            "place": place,
        }
        self.ids = np.stack([np.searchsorted(np.asarray(e, float), values[k], "left") + _AT[j]
                             for j, (k, e) in enumerate(FEATURES.items())], 1).astype(np.int16)

    @property
    def base_failed(self) -> np.ndarray:
        return (self.n_words < MIN_WORDS) | (100 * self.n_repeat > REPEAT_PERCENT * self.n_words)


def viterbi(emission: np.ndarray, ptr: np.ndarray, ties: np.ndarray) -> np.ndarray:
    """Best 0/1 labels of many sequences at once.

    emission: score of label 1 over label 0 of every line; sequence i is
    ptr[i]..ptr[i+1]; ties[a, b]: score of b behind a. Equal scores give 1.
    """
    out = np.ones(len(emission), bool)
    sizes = np.diff(ptr)
    order = np.argsort(-sizes, kind="stable")
    begin, sizes = ptr[:-1][order], sizes[order]
    steps = int(sizes[0]) if len(sizes) else 0
    if not steps:
        return out
    alive = np.searchsorted(-sizes, -np.arange(steps), "left")  # sequences longer than t
    best = np.zeros((alive[0], 2))
    best[:, 1] = emission[begin[:alive[0]]]
    back = np.zeros((len(emission), 2), np.int8)
    final = best.copy()
    for t in range(1, steps):
        n = alive[t]
        ways = best[:n, :, None] + ties
        came = ways[:, 1] >= ways[:, 0]
        at = begin[:n] + t
        back[at] = came
        best = np.where(came, ways[:, 1], ways[:, 0])
        best[:, 1] += emission[at]
        final[:n] = best
    label = (final[:, 1] >= final[:, 0]).astype(np.int8)
    for t in range(steps - 1, -1, -1):
        n = alive[t]
        at = begin[:n] + t
        out[at] = label[:n]
        label[:n] = back[at, label[:n]] if t else label[:n]
    return out


def fit(sequences: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray] | None:
    """(weights, ties) of the field, from (feature ids, labels) of the lines of each text."""
    sequences = sorted((s for s in sequences if len(s[0])), key=lambda s: -len(s[0]))
    labels = np.concatenate([s[1] for s in sequences]) if sequences else np.zeros(0)
    if not len(labels) or labels.min() == labels.max():
        return None
    sizes = np.array([len(s[0]) for s in sequences])
    steps = sizes[0]
    alive = np.searchsorted(-sizes, -np.arange(steps), "left")
    ids = [np.stack([s[0][t] for s in sequences[:alive[t]]]).astype(np.int64) for t in range(steps)]
    y = [np.array([s[1][t] for s in sequences[:alive[t]]], np.int64) for t in range(steps)]
    seen = np.zeros((2, 2))
    for t in range(1, steps):
        np.add.at(seen, (y[t - 1][:alive[t]], y[t]), 1)
    w, ties = np.zeros(N_WEIGHTS), np.zeros((2, 2))
    m, v = np.zeros(N_WEIGHTS + 4), np.zeros(N_WEIGHTS + 4)
    lines = sizes.sum()
    for step in range(1, STEPS + 1):
        gw, gt = np.zeros(N_WEIGHTS), -seen
        score = [w[ids[t]].sum(1) for t in range(steps)]
        forward = [np.stack([np.zeros(alive[0]), score[0]], 1)]
        for t in range(1, steps):
            a = np.logaddexp(forward[-1][:alive[t], 0, None] + ties[0], forward[-1][:alive[t], 1, None] + ties[1])
            a[:, 1] += score[t]
            forward.append(a)
        behind = np.zeros((alive[-1], 2))
        for t in range(steps - 1, -1, -1):
            if t < steps - 1:
                nxt = behind.copy()
                nxt[:, 1] += score[t + 1]
                n = alive[t + 1]
                joint = forward[t][:n, :, None] + ties + nxt[:, None, :]
                joint = np.exp(joint - np.logaddexp.reduce(joint.reshape(n, 4), 1)[:, None, None])
                gt = gt + joint.sum(0)
                behind = np.zeros((alive[t], 2))
                behind[:n] = np.logaddexp(ties[:, 0] + nxt[:, :1], ties[:, 1] + nxt[:, 1:])
            both = forward[t] + behind
            p = 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -50, 50)))
            gw += np.bincount(ids[t].ravel(), np.repeat(p - y[t], ids[t].shape[1]), N_WEIGHTS)
        g = np.concatenate([gw, gt.ravel()]) / lines + PENALTY * np.concatenate([w, ties.ravel()])
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        move = RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
        w, ties = w - move[:N_WEIGHTS], ties - move[N_WEIGHTS:].reshape(2, 2)
    return w, ties


def train(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray] | None:
    """The field fitted on a bounded sample of labelled documents."""
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.min("quality").alias("__low"), F.max("quality").alias("__high")).where("__low = __high").select(
        "doc_id", (F.col("__low") > 0).cast("int").alias("__label"))
    both = known.select("__label").distinct().count() == 2
    # Labels of documents that are not here say nothing; the sample is of the others.
    known = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    first = lambda df, n: df.orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    sample = first(known, TRAIN_DOCS)
    for label in (0, 1):
        sample = sample.unionByName(first(known.where(F.col("__label") == label), TRAIN_LEAST))
    sample = sample.distinct()
    # At most TRAIN_DOCS + 2 * TRAIN_LEAST rows of two numbers: a proven bound for the broadcast.
    rows = docs.select("doc_id", F.col("text").alias("__text")).join(F.broadcast(sample), "doc_id")

    def lines(batches):
        for batch in batches:
            got = []
            for _, _, scan in scans(batch.column(1)):
                found = Lines(scan)
                for i, j in zip(found.ptr[:-1], found.ptr[1:], strict=True):
                    part = slice(i, j)
                    got.append(np.column_stack([found.ids[part].astype(np.uint64), found.keys[part]]).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(got, pa.binary())], ["doc_id", "label", "lines"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    # One text for each id, whatever the number of its rows.
    got = rows.mapInArrow(lines, f"doc_id {kind}, label int, lines binary").groupBy("doc_id", "label").agg(
        F.min("lines").alias("lines")).orderBy("doc_id").collect()
    read = [(np.frombuffer(r["lines"], np.uint64).reshape(-1, len(FEATURES) + 1), r["label"]) for r in got]
    good = np.concatenate([np.zeros(0, np.uint64), *[x[:, -1] for x, label in read if label]])
    if len({label for _, label in read}) < 2 and both:
        warnings.warn("labels of both classes, but sampled documents of one at most: every line counts as content", stacklevel=2)
    return fit([(x[a:a + TRAIN_LINES, :-1].astype(np.int64), np.isin(x[a:a + TRAIN_LINES, -1], good))
                for x, _ in read for a in range(0, len(x), TRAIN_LINES)])


def content_words(found: Lines, field: tuple[np.ndarray, np.ndarray] | None) -> np.ndarray:
    """Words in content lines of every text."""
    if field is None:
        return found.n_words
    label = viterbi(field[0][found.ids].sum(1), found.ptr, field[1])
    sums = _sums(np.where(label, found.words, 0))
    return sums[found.ptr[1:]] - sums[found.ptr[:-1]]


def _kept(found: Lines, words: np.ndarray) -> np.ndarray:
    return ~found.base_failed & (words >= MIN_CONTENT * found.n_words)


def judge(docs: DataFrame, labels: DataFrame, train_docs: DataFrame | None = None) -> DataFrame:
    """(doc_id, base figures, base_failed, kept, content_words) of every row."""
    field = train(docs if train_docs is None else train_docs, labels)
    rows = docs.select("doc_id", F.col("text").alias("__text"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "content_words")

    def verdicts(batches):
        for batch in batches:
            for a, b, scan in scans(batch.column(1)):
                x = Lines(scan)
                words = content_words(x, field)
                longs = (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat, words)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), *[pa.array(c, pa.int64()) for c in longs],
                     pa.array(x.base_failed), pa.array(_kept(x, words))],
                    ["doc_id", *names, "base_failed", "kept"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(verdicts, f"doc_id {kind}, {', '.join(f'{n} long' for n in names)}, base_failed boolean, kept boolean")


def keep_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that pass, with all their columns."""
    field, at = train(docs, labels), docs.columns.index("text")

    def passing(batches):
        for batch in batches:
            keep = [np.zeros(0, bool)]
            for _, _, scan in scans(batch.column(at)):
                x = Lines(scan)
                keep.append(_kept(x, content_words(x, field)))
            yield batch.filter(pa.array(np.concatenate(keep)))

    return docs.mapInArrow(passing, docs.schema)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base figures and verdict of every document."""
    return judge(table(spark, sf_dir, "documents", ("doc_id", "text")),
                 table(spark, sf_dir, "labels", ("doc_id", "quality")))
