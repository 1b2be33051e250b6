"""Source divergences against a plain count, and the transducer against a dictionary."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from farelake.llm import divergence
from farelake.llm.transducer import Transducer

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, lang string, source string, text string, term string, ordinal int, count int, shard int"


def words(text):
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(rows):
    rows = [(lang or "", source or "", words(text)) for lang, source, text in rows]
    out = set()
    for lang in {r[0] for r in rows}:
        docs = Counter(t for r in rows if r[0] == lang for t in set(r[2]))
        kept = [t for t, n in docs.items() if n >= 3]
        count = {}
        for x, source, ws in rows:
            if x == lang:
                count.setdefault(source, Counter()).update(t for t in ws if docs[t] >= 3)
        whole = sum(count.values(), Counter())
        share = lambda c: {t: 1 + 10 ** 9 * (c[t] + 1) // (sum(c.values()) + len(kept)) for t in kept}  # noqa: B023, E731
        p = {s: share(c) for s, c in count.items()}
        q = share(whole)
        for s in count:
            pairs = [(-sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o.encode(), o) for o in count if o != s]
            terms = [(-((p[s][t] - q[t]) ** 2 // q[t]), t.encode(), t) for t in kept if count[s][t] and p[s][t] > q[t]]
            for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:200])):
                out |= {(lang, s, part, item, -v, rank) for rank, (v, _, item) in enumerate(items, 1)}
    return out


def found(df):
    rows = [tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def texts(seed, count):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdé日😀ß") for _ in range(rng.randint(1, 4))) for _ in range(400)]
    rows = [(rng.choice(["en", "en", "de", None]), rng.choice(["hot"] * 6 + ["a", "b", "é", "z", None]),
             " ".join(rng.choice(vocabulary).upper() if rng.random() < 0.1 else rng.choice(vocabulary[:rng.choice([20, 400])])
                      for _ in range(rng.randint(0, 60)))) for _ in range(count)]
    rows += [("fr", "one", "seul"), ("fr", "two", None), ("", "", "x-y_z 12 x\x00y"), ("pt", "alone", "um um"), (None, None, None)]
    return rows + rows[:4] * 2 + [("en", "long", "é" * 30_000 + " tail")] * 3


@pytest.mark.parametrize("shard_terms, tile, ordinals, block, held", [
    (1 << 16, 128, 1 << 12, 8 << 20, 1 << 20), (3, 2, 16, 2000, 50)])
def test_equals_a_plain_count(spark, monkeypatch, shard_terms, tile, ordinals, block, held):
    for name, value in (("SHARD_TERMS", shard_terms), ("TILE", tile), ("ORDINALS", ordinals), ("BLOCK_BYTES", block), ("HELD", held)):
        monkeypatch.setattr(divergence, name, value)
    rows = texts(shard_terms, 300)
    df = spark.createDataFrame([(1, *r, "t", 1, 2, 3) for r in rows], SCHEMA).repartition(3)
    assert found(divergence.audit(df)) == brute(rows)


def test_empty(spark):
    assert found(divergence.audit(spark.createDataFrame([], SCHEMA))) == set()


def test_large_counts(spark):
    """Shares are exact where count times SCALE does not fit 64 bits."""
    from pyspark.sql import functions as F
    cases = [(0, 1), (10 ** 12, 10 ** 12 + 1), (123456789012345, 987654321098765), (5, 7), (10 ** 10, 3 * 10 ** 10)]
    df = spark.createDataFrame(cases, "n long, total long")
    got = [r[0] for r in df.select(divergence.share(F.col("n"), F.col("total"))).collect()]
    assert got == [1 + 10 ** 9 * (n + 1) // t for n, t in cases]


def test_transducer():
    rng = random.Random(1)
    strings = sorted({bytes(rng.choice(b"ab\xc3\xff\x00") for _ in range(rng.randint(0, 9))) for _ in range(3000)} | {b"a" * 500})
    built = Transducer.from_bytes(Transducer.build(strings).to_bytes())
    probe = strings + [s + b"b" for s in strings] + [b"q"]
    raw = np.frombuffer(b"".join(probe), np.uint8)
    ends = np.cumsum([len(p) for p in probe])
    got = built.ordinals(raw, np.concatenate([[0], ends[:-1]]), ends)
    place = {s: i for i, s in enumerate(strings)}
    assert got.tolist() == [place.get(p, -1) for p in probe]
    assert [built.string(i) for i in range(len(strings))] == strings
    empty = Transducer.build([])
    assert empty.ordinals(raw, np.array([0]), np.array([2])).tolist() == [-1]
    for wrong in ([b"b", b"a"], [b"a", b"a"], [b"", b""]):
        with pytest.raises(ValueError):
            Transducer.build(wrong)


def test_transducer_is_minimal():
    """No two states accept the same endings: 2**10 strings over two letters need 11 states."""
    strings = sorted(bytes(97 + (i >> j & 1) for j in range(10)) for i in range(1 << 10))
    assert len(Transducer.build(strings)) == 11


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{SF}/documents.parquet')")
    want = set(con.execute(f"select lang, source, part, item, value, rank from ({divergence.ORACLE})").fetchall())
    assert found(divergence.op11_source_divergence(spark, SF)) == want
