"""Cross-entropy difference of two n-gram language models.

A target model (documents labelled good) and a background model (all documents)
share one vocabulary, order and smoothing; a document's score is the mean over its
words of the loss under the target model less the loss under the background model.
A low score is more like the target.

Both are bigram models with absolute discounting, interpolated with add-one
unigrams. All counts cover all documents. The vocabulary holds every word that the
background has ``LEAST`` times, other words are one unknown word; a bigram is kept if
either corpus has it ``LEAST`` times, the others fall back on the unigrams with the
mass that discounting left. Nothing is dropped for its share of the corpus.

No table of the model is held whole anywhere. Texts are cut into blocks of about
``BLOCK_BYTES``, kept as numbers of their distinct words. A block sends each of its
distinct words (then bigrams) once, with its counts, to the bucket of the key's hash;
the bucket adds up the blocks' counts and sends each block the sums of what it asked
for, in its order. So the shuffle that counts is the one that looks up. A bucket of words
also numbers those it keeps by their frequency: bigrams are pairs of these numbers, which
pack well. The discounted mass of a history is summed over the buckets of its bigrams
and looked up in the bucket of its number. Buckets grow with the blocks, so that a bucket
fits a task; a frequent word or history comes once from each block, and its bigrams lie
in all buckets. Blocks lie by their number on the executors' disks while they are asked for.

Words are runs outside 0x20 and 0x09..0x0D with A-Z in lower case, compared by 64-bit
hash. Two to the power of 32 kept words at most can be numbered; more are an error.

Defined cases: null and empty texts score null; labels count if quality is over 0
and toxic is not, for some row of the id; repeated documents are counted and scored
each; without target documents the target model is uniform; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.llm.tables import table, written
from farelake.llm.textscan import mix, scans, text_buffers

LEAST = 2  # a word or bigram seen less often is not kept
DISCOUNT = 0.75
BLOCK_BYTES = 8 << 20
BLOCK_PARTITIONS = 4  # times the shuffle partitions
UNKNOWN, BEGIN = 0, 1  # first two keys of every block and their numbers: the unknown word, the begin of a text


# --- arrays in rows ------------------------------------------------------------------

def _packed(x: np.ndarray, kind: str) -> bytes:
    """The bytes of the numbers by significance, compressed."""
    x = np.ascontiguousarray(x, kind)
    return zstandard.compress(x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes(), 1)


def _unpacked(blob: bytes, kind: str) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(blob), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _sorted_in(x: np.ndarray) -> bytes:
    """Sorted numbers as differences."""
    return _packed(np.diff(x.astype(np.uint64), prepend=np.uint64(0)), "<u8")


def _sorted_out(blob: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(blob, "<u8"), dtype=np.uint64)


def _counts_in(x: np.ndarray) -> bytes:
    return _packed(x, "<u8")


def _counts_out(blob: bytes) -> np.ndarray:
    return _unpacked(blob, "<u8").astype(np.int64)


def _numbers_in(x: np.ndarray) -> bytes:
    return _packed(x, "<u4")


def _numbers_out(blob: bytes) -> np.ndarray:
    return _unpacked(blob, "<u4").astype(np.uint64)


def _mass_in(x: np.ndarray) -> bytes:
    return _packed(x, "<f8")


def _mass_out(blob: bytes) -> np.ndarray:
    return _unpacked(blob, "<f8")


def _all(rows: list[dict], at: int, out) -> np.ndarray:
    """One array of all rows, one behind the other."""
    return np.concatenate([out(r["parts"][at]) for r in rows])


# --- blocks --------------------------------------------------------------------------

def _blocks(docs: DataFrame, counted: bool) -> DataFrame:
    """One row a block of texts: ids and words of each text, the sorted hashes of the block's
    words (behind UNKNOWN and BEGIN) with their counts, and each word's place among them, the
    most frequent first. Texts that are not ``counted`` are only scored."""
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("__text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def cut(batches) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId() | (0 if counted else 1 << 30), 0

        def out(ids, texts):
            nonlocal number
            hashes, sizes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for text in texts:
                for _, _, scan in scans(text):
                    hashes.append(scan.word_hashes(lower=True))
                    sizes.append(np.diff(scan.ptr))
            keys, of, n = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
            keys, n = np.concatenate([np.array([UNKNOWN, BEGIN], np.uint64), keys]), np.concatenate([[0, 0], n])
            rank = np.empty(len(n), np.int64)
            rank[np.argsort(-n, kind="stable")] = np.arange(len(n))
            begun = np.concatenate([np.asarray(pc.fill_null(pc.binary_length(t), 0)) for t in texts]) > 0
            number += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([part << 32 | number]), pa.array([counted]),
                 pa.ListArray.from_arrays(pa.array([0, sum(map(len, ids))], pa.int32()), pa.concat_arrays(ids)),
                 *[pa.array([x], pa.binary()) for x in (
                     _packed(np.concatenate(sizes), "<u4"), _packed(begun, "<u1"), _sorted_in(keys), _counts_in(n),
                     _numbers_in(rank[of + 2]))]],
                ["block", "counted", "ids", "sizes", "begun", "keys", "n", "of"])

        ids, texts, held = [], [], 0
        for batch in batches:
            _, offsets = text_buffers(batch.column(1))
            a = 0
            while a < len(batch):
                b = int(np.searchsorted(offsets, offsets[a] + BLOCK_BYTES - held, "left"))
                b = min(max(b, a + 1), len(batch))
                ids.append(batch.column(0).slice(a, b - a))
                texts.append(batch.column(1).slice(a, b - a))
                held += int(offsets[b] - offsets[a])
                if held >= BLOCK_BYTES:
                    yield out(ids, texts)
                    ids, texts, held = [], [], 0
                a = b
        if texts:
            yield out(ids, texts)

    made = rows.mapInArrow(
        cut, f"block long, counted boolean, ids array<{kind}>, sizes binary, begun binary, keys binary, n binary, of binary")
    # Kept by block: what is told to the blocks comes to them.
    n = BLOCK_PARTITIONS * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return made.repartition(n, "block").persist(StorageLevel.DISK_ONLY)


class Block:
    """A row of ``_blocks`` with the places of its target texts: what is to be counted of it."""

    def __init__(self, row: dict, marks: list[int]):
        self.keys, self.n = _sorted_out(row["keys"]), _counts_out(row["n"])
        self.of = np.argsort(-self.n, kind="stable")[_unpacked(row["of"], "<u4")]
        self.sizes = _unpacked(row["sizes"], "<u4").astype(np.int64)
        self.begun = _unpacked(row["begun"], "<u1").astype(bool)
        self.counted = row["counted"]
        marked = np.zeros(len(self.sizes), bool)
        marked[marks] = True
        self.marked, self.target = marked, np.repeat(marked, self.sizes)

    def counts(self, of: np.ndarray, size: int) -> np.ndarray:
        """How often each of ``size`` keys occurs in the block's target texts and in all."""
        if not self.counted:
            return np.zeros((2, size), np.int64)
        return np.stack([np.bincount(of[self.target], minlength=size), np.bincount(of, minlength=size)])

    def words(self) -> np.ndarray:
        n = self.counts(self.of, len(self.keys))
        if self.counted:
            n[:, BEGIN] = (self.begun & self.marked).sum(), self.begun.sum()
        return n

    def bigrams(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct bigrams as sorted codes (number of the history and of the word), their
        histories and words as places among the keys, and the bigram of each word of the texts."""
        word = np.where(numbers > BEGIN, np.arange(len(numbers)), UNKNOWN)[self.of]
        before = np.empty_like(word)
        before[1:] = word[:-1]
        before[(np.cumsum(self.sizes) - self.sizes)[self.sizes > 0]] = BEGIN
        codes, at, of = np.unique(numbers[before] << np.uint64(32) | numbers[word], return_index=True, return_inverse=True)
        return codes, before[at], word[at], of


def _dealt(bucket: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order by bucket, first place of each bucket and the end, buckets used)."""
    order = np.argsort(bucket, kind="stable")
    ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
    return order, ends, np.flatnonzero(np.diff(ends))


def _bucket(x: np.ndarray, buckets: int) -> np.ndarray:
    return (x % np.uint64(buckets)).astype(np.int64)


def _in_place(bucket: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Values told by bucket, in the order of the keys."""
    out = np.empty_like(values)
    out[..., np.argsort(bucket, kind="stable")] = values
    return out


ASKED = "bucket int, block long, part string, parts array<binary>"


def _asked(block: int, part: str, bucket: np.ndarray, buckets: int, values) -> pa.RecordBatch:
    """A row for each bucket: the keys and counts that it gets of a block."""
    order, ends, used = _dealt(bucket, buckets)
    parts = [[pack(x[order[ends[b]:ends[b + 1]]]) for pack, x in values] for b in used]
    return pa.RecordBatch.from_arrays(
        [pa.array(used, pa.int32()), pa.array(np.full(len(used), block, np.int64)), pa.array([part] * len(used), pa.string()),
         pa.array(parts, pa.list_(pa.binary()))], ["bucket", "block", "part", "parts"])


def _rows(rows: list[tuple]) -> pa.Table:
    """(bucket, block, part, parts) as a table."""
    columns = list(zip(*rows, strict=True)) or [()] * 4
    kinds = [pa.int32(), pa.int64(), pa.string(), pa.list_(pa.binary())]
    return pa.table({n: pa.array(list(c), k) for n, c, k in zip(["bucket", "block", "part", "parts"], columns, kinds, strict=True)})


def _sums(rows: list[dict], at: int, of: np.ndarray, size: int) -> np.ndarray:
    """Counts by key over all blocks, target first; exact below 2**53."""
    return np.stack([np.bincount(of, _all(rows, at + k, _counts_out), size).astype(np.int64) for k in (0, 1)])


def _words_counted(buckets: int):
    def counted(asked: pa.Table) -> pa.Table:
        """One bucket of words: counts and number of what each block asked for (part words), and
        the bucket's share of the totals (part totals)."""
        rows = asked.to_pylist()
        bucket = rows[0]["bucket"]
        each = [_sorted_out(r["parts"][0]) for r in rows]
        keys, of = np.unique(np.concatenate(each), return_inverse=True)
        n = _sums(rows, 1, of, len(keys))
        word = keys > BEGIN
        known = np.flatnonzero(word & (n[1] >= LEAST))
        numbers = np.where(word, np.uint64(UNKNOWN), keys)
        order = known[np.argsort(-n[1][known], kind="stable")]
        numbers[order] = np.arange(len(order), dtype=np.uint64) * np.uint64(buckets) + np.uint64(bucket + 2)
        if len(order) and int(numbers[order[-1]]) >= 1 << 32:
            raise ValueError("more than 2**32 words occur often enough to be kept")
        out, done = [], 0
        for r, some in zip(rows, each, strict=True):
            places = of[done:done + len(some)]
            done += len(some)
            out.append((bucket, r["block"], "words", [_counts_in(n[0][places]), _counts_in(n[1][places]), _numbers_in(numbers[places])]))
        totals = np.concatenate([[len(known)], n[:, known].sum(1), n[:, word].sum(1)])
        return _rows([*out, (bucket, None, "totals", [totals.astype("<i8").tobytes()])])
    return counted


def _bigrams_counted(buckets: int):
    def counted(asked: pa.Table) -> pa.Table:
        """One bucket of bigrams: counts of what each block asked for (part bigrams), and for the
        bucket of each history its kept counts, summed, and how many there are (part kept). What
        is wanted of histories passes through."""
        every = asked.to_pylist()
        out = [(r["bucket"], r["block"], r["part"], r["parts"]) for r in every if r["part"] == "wanted"]
        rows = [r for r in every if r["part"] != "wanted"]
        if not rows:
            return _rows(out)
        history = [_sorted_out(r["parts"][0]) for r in rows]
        sizes = [len(x) for x in history]
        codes = np.concatenate(history) << np.uint64(32) | _all(rows, 1, _numbers_out)
        del history
        codes, of = np.unique(codes, return_inverse=True)
        n = _sums(rows, 2, of, len(codes))
        done = 0
        for r, size in zip(rows, sizes, strict=True):
            places = of[done:done + size]
            done += size
            if r["part"] == "asked":
                out.append((r["bucket"], r["block"], "bigrams", [_counts_in(n[0][places]), _counts_in(n[1][places])]))
        kept = n.max(0) >= LEAST
        history, n = codes[kept] >> np.uint64(32), n[:, kept]
        if len(history):
            first = np.flatnonzero(np.concatenate([[True], history[1:] != history[:-1]]))
            used = [np.add.reduceat(x, first) for k in (0, 1) for x in (n[k], (n[k] > 0).astype(np.int64))]
            order, ends, some = _dealt(_bucket(history[first], buckets), buckets)
            for b in some:
                places = order[ends[b]:ends[b + 1]]
                out.append((int(b), None, "kept", [_sorted_in(history[first][places]), *[_counts_in(x[places]) for x in used]]))
        return _rows(out)
    return counted


def _mass_told(wanted: pa.Table, kept: pa.Table) -> pa.Table:
    """Discounted mass of the histories that each block wants, target first (part mass)."""
    rows = [{"parts": x} for x in kept["kept"].to_pylist()]
    each = [np.zeros(0, np.uint64), *[_sorted_out(r["parts"][0]) for r in rows]]
    keys, of = np.unique(np.concatenate(each), return_inverse=True)
    mass = np.zeros((2, len(keys) + 1))
    for k in (0, 1) if rows else ():
        total, some = (np.bincount(of, _all(rows, 1 + 2 * k + j, _counts_out), len(keys)) for j in (0, 1))
        mass[k, :-1] = total - DISCOUNT * some
    out = []
    for r in wanted.to_pylist():
        want = _sorted_out(r["parts"][0])
        at = np.searchsorted(keys, want)
        hit = np.append(keys, np.uint64(0))[at] == want
        at = np.where(hit, at, len(keys))
        out.append((r["bucket"], r["block"], "mass", [_mass_in(mass[k][at]) for k in (0, 1)]))
    return _rows(out)


def _told(rows: list[dict], part: str, at: int, out) -> np.ndarray:
    """What the buckets told a block, by bucket."""
    return np.concatenate([out(r["parts"][at]) for r in sorted((r for r in rows if r["part"] == part), key=lambda r: r["bucket"])])


def _block(rows: pa.Table, told: list[dict]) -> Block:
    marks = [m for r in told if r["part"] == "marks" for m in r["marks"]]
    return Block(rows.select(["counted", "sizes", "begun", "keys", "n", "of"]).to_pylist()[0], marks)


class Model:
    """The counted documents as blocks, with the places of the target texts; ``score`` counts
    and looks up in one."""

    def __init__(self, docs: DataFrame, blocks: DataFrame, marks: DataFrame):
        self.docs, self.blocks, self.marks = docs, blocks, marks


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Both models over all of docs."""
    good = labels.where("quality > 0 and coalesce(toxic, 0) = 0").select("doc_id").distinct()
    blocks = _blocks(docs, True)
    places = blocks.select("block", F.posexplode("ids").alias("place", "doc_id")).join(good, "doc_id")
    return Model(docs, blocks, written(places.groupBy("block").agg(F.collect_list("place").alias("marks")), "lm-marks"))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, n_words, target_loss, background_loss, difference) of every row; mean losses in nats a word."""
    spark = docs.sparkSession
    own = docs is model.docs
    blocks = model.blocks.withColumn("asks", F.lit(own))
    if not own:
        blocks = blocks.unionByName(_blocks(docs, False).withColumn("asks", F.lit(True)))
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), blocks.count())
    state = ["block", "counted", "asks", "sizes", "begun", "keys", "n", "of"]
    marks = model.marks.select(F.lit(0).alias("bucket"), "block", F.lit("marks").alias("part"),
                               F.lit(None).cast("array<binary>").alias("parts"), "marks")
    with_marks = lambda df: df.withColumn("marks", F.lit(None).cast("array<int>"))

    def ask_words(rows: pa.Table, told: pa.Table) -> pa.Table:
        block, number = _block(rows, told.to_pylist()), rows["block"][0].as_py()
        n = block.words()
        return pa.Table.from_batches([_asked(number, "asked", _bucket(block.keys, buckets), buckets, [
            (_sorted_in, block.keys), (_counts_in, n[0]), (_counts_in, n[1])])])

    def numbers_of(block: Block, told: list[dict]) -> np.ndarray:
        return _in_place(_bucket(block.keys, buckets), _told(told, "words", 2, _numbers_out))

    def ask_bigrams(rows: pa.Table, told: pa.Table) -> pa.Table:
        told = told.to_pylist()
        block, number, asks = _block(rows, told), rows["block"][0].as_py(), rows["asks"][0].as_py()
        numbers = numbers_of(block, told)
        codes, before, _, of = block.bigrams(numbers)
        n = block.counts(of, len(codes))
        batches = [_asked(number, "asked" if asks else "counted", _bucket(mix(codes), buckets), buckets, [
            (_sorted_in, codes >> np.uint64(32)), (_numbers_in, codes & np.uint64(0xFFFFFFFF)),
            (_counts_in, n[0]), (_counts_in, n[1])])]
        if asks:
            histories = np.unique(numbers[before])
            batches.append(_asked(number, "wanted", _bucket(histories, buckets), buckets, [(_sorted_in, histories)]))
        return pa.Table.from_batches(batches)

    words = written(blocks.select(*state).groupBy("block").cogroup(marks.groupBy("block")).applyInArrow(ask_words, ASKED)
                    .groupBy("bucket").applyInArrow(_words_counted(buckets), ASKED), "lm-words")
    # A row of five numbers a bucket.
    totals = [np.frombuffer(r[0][0], "<i8") for r in words.where("part = 'totals'").select("parts").collect()]
    size, *each = np.sum([np.zeros(5, np.int64), *totals], axis=0)
    totals = np.array(each[2:], float)
    unknown = totals - np.array(each[:2])
    of_words = with_marks(words.where("part = 'words'")).unionByName(marks)
    bigrams = written(
        blocks.select(*state).groupBy("block").cogroup(of_words.groupBy("block")).applyInArrow(ask_bigrams, ASKED)
        .groupBy("bucket").applyInArrow(_bigrams_counted(buckets), ASKED), "lm-bigrams")
    mass = bigrams.where("part = 'wanted'").groupBy("bucket").cogroup(
        bigrams.where("part = 'kept'").select(F.col("bucket").alias("at"), F.col("parts").alias("kept")).groupBy("at")
    ).applyInArrow(_mass_told, ASKED)

    def losses(rows: pa.Table, told: pa.Table) -> pa.Table:
        told = told.to_pylist()
        if not len(rows):  # told to a block that is counted only
            return pa.table({n: pa.array([], k) for n, k in zip(
                ["doc_id", "n_words", "target_loss", "background_loss", "difference"],
                [rows.schema.field("ids").type.value_type, pa.int64(), *[pa.float64()] * 3], strict=True)})
        block = _block(rows, told)
        mean = np.zeros((2, len(block.sizes)))
        if len(block.of):
            numbers = numbers_of(block, told)
            codes, before, word, of = block.bigrams(numbers)
            history = np.stack([_in_place(_bucket(block.keys, buckets), _told(told, "words", k, _counts_out)) for k in (0, 1)]).astype(float)
            history[:, UNKNOWN] = unknown
            unigram = (history + 1) / (totals[:, None] + size + 1)
            wanted, at = np.unique(numbers[before], return_inverse=True)
            used = np.stack([_in_place(_bucket(wanted, buckets), _told(told, "mass", k, _mass_out)) for k in (0, 1)])[:, at]
            n = np.stack([_in_place(_bucket(mix(codes), buckets), _told(told, "bigrams", k, _counts_out)) for k in (0, 1)])
            of_history = history[:, before]
            left = np.maximum(np.where(of_history > 0, 1 - used / np.maximum(of_history, 1), 1.0), 1e-9)
            kept = np.where(n.max(0) >= LEAST, np.maximum(n - DISCOUNT, 0) / np.maximum(of_history, 1), 0)
            loss = -np.log(kept + left * unigram[:, word])[:, of]
            some = np.flatnonzero(block.sizes)
            starts = np.cumsum(block.sizes) - block.sizes
            mean[:, some] = np.add.reduceat(loss, starts[some], axis=1) / block.sizes[some]
        none = block.sizes == 0
        double = lambda x: pa.array(np.round(x, 6), pa.float64(), mask=none)
        return pa.table({"doc_id": rows["ids"].combine_chunks().flatten(), "n_words": pa.array(block.sizes, pa.int64()),
                         "target_loss": double(mean[0]), "background_loss": double(mean[1]), "difference": double(mean[0] - mean[1])})

    kind = docs.schema["doc_id"].dataType.simpleString()
    told = of_words.unionByName(with_marks(mass)).unionByName(with_marks(bigrams.where("part = 'bigrams'")))
    return blocks.where("asks").select("ids", *state).groupBy("block").cogroup(told.groupBy("block")).applyInArrow(
        losses, f"doc_id {kind}, n_words long, target_loss double, background_loss double, difference double")


def op5_cross_entropy_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-entropy difference of every document."""
    docs = table(spark, sf_dir, "documents", ("doc_id", "text"))
    return score(docs, train(docs, table(spark, sf_dir, "labels", ("doc_id", "quality", "toxic"))))
