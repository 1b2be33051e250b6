"""Encoding with word ends against the public tokenizer library, and its parts against
exact merging."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from farelake.llm import word_bpe as w

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, `__text` string, ids int, n_tokens int, key int"
EDGE = ["", None, " \t\n\r\x0b\x0c　 ", "a", "İstanbul ΑΣ Σ", "école É ﬁ ½ x² 12 日本 😀", "don't I'll 'tis ''s '", "x" * 70_000,
        "word " * 30_000, "a<|endoftext|≯b<|startoftext|><|endoftext|> <|end", "a\x00b​", "é" * 999 + "!" * 999]


@pytest.fixture(scope="module")
def vocabulary():
    return w.Vocabulary(PATH)


def library(texts):
    return [e.ids for e in Tokenizer.from_file(PATH).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def some_texts(seed, count):
    rng = random.Random(seed)
    letters = "aaabbcxyz'''stdrevlm0189 \n\t.,!?<|>éÉßİΣςǅ日本😀½̸̣́"
    names = [s.replace(w.WORD_END, "") for s in w.Vocabulary(PATH).strings if s.isascii()]
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(count)] + [
        "".join(rng.choice(names) for _ in range(rng.randint(1, 5))) for _ in range(count)]


def test_equals_the_library(spark):
    texts = EDGE + some_texts(3, 1500)
    rows = [(i, t, "other", 1, 2, 3) for i, t in enumerate(texts)]
    rows += [(None, "null id", None, None, None, None), rows[0], rows[4], rows[4]]
    coded = w.encode(spark.createDataFrame(rows, SCHEMA).repartition(3), PATH)
    assert coded.columns == ["doc_id", "n_tokens", "ids"]
    got = sorted(((r[0] is not None, r[0] or 0, r[1], tuple(r[2])) for r in coded.collect()))
    want = sorted((r[0] is not None, r[0] or 0, len(ids), tuple(ids)) for r, ids in zip(rows, library([r[1] for r in rows]), strict=True))
    assert got == want
    tokenizer = Tokenizer.from_file(PATH)
    back = {r["doc_id"]: r["decoded"] for r in w.decode(coded, PATH).collect()}
    for i in range(len(EDGE)):
        assert back[i] == tokenizer.decode(library([EDGE[i]])[0], skip_special_tokens=False)
    assert w.encode(spark.createDataFrame([], SCHEMA), PATH).collect() == []


def test_decode_leaves_unknown_ids_out(spark):
    coded = spark.createDataFrame([(1, [0, -1, 99999, 320], "x"), (2, None, "y"), (3, [], None)], "decoded_by long, ids array<int>, extra string")
    assert [r["decoded"] for r in w.decode(coded, PATH).orderBy("decoded_by").collect()] == ["! a</w>", "", ""]


def test_pair_test_equals_exact_merging(vocabulary):
    """crosses(a, b) tells whether merging the symbols of a and b gives something else."""
    v = vocabulary
    ranks = dict(zip(v.pair_keys.tolist(), v.pair_ranks.tolist(), strict=True))
    rng = random.Random(7)

    def symbols(t):
        return symbols(int(v.left[t])) + symbols(int(v.right[t])) if v.rank[t] >= 0 else [t]

    inner = [t for t in range(49406) if not v.strings[t].endswith(w.WORD_END)]
    a = [rng.choice(inner) for _ in range(4000)]
    b = [rng.randrange(49406) for _ in a]
    # Repeated letters, where equal ranks meet.
    same = [t for t in inner if len(set(v.strings[t])) == 1 and len(v.strings[t]) > 1]
    a, b = a + [x for x in same for _ in same], b + [y for _ in same for y in same]
    got = w.crosses(v, np.array(a), np.array(b))
    for x, y, crossing in zip(a, b, got.tolist(), strict=True):
        assert (w.merge(symbols(x) + symbols(y), ranks, v.made.tolist()) != [x, y]) == crossing


def test_only_failing_words_are_merged(vocabulary):
    import pyarrow as pa

    from farelake.llm.textscan import text_buffers
    encoder = w.Encoder(vocabulary, *w.code_tables())
    encoder.encode(*text_buffers(pa.array(["the cat and the dog", "qzxjv"])))
    assert encoder.counts["words"] == 5 and encoder.counts["merged"] <= 1


def test_query(spark):
    got = {r["doc_id"]: r for r in w.op12_word_bpe(spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    tokenizer = Tokenizer.from_file(PATH)
    assert len(got) == len(rows)
    for (key, _), ids in zip(rows, library([r[1] for r in rows]), strict=True):
        r = got[key]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()
