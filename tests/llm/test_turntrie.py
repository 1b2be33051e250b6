"""Prefix trie of conversations against a plain trie in memory."""

import hashlib
import math
import random
import zlib

import pytest

from farelake.llm import turntrie

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, units string, depth int, n int, container string"


def brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(t[2], t[3]) for t in sorted(ts)] for c, ts in own.items()}
    convs = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        convs[c] = tuple(own.get(c - int(math.fmod(c, 100)), [])[:h] + turns[h:])
    nodes = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(turns[:d], []).append(c)
    out = set()
    children, below = {}, {}
    for seq in sorted(nodes, key=len, reverse=True):
        kids = children.get(seq, 0)
        leaves, saved = below.get(seq, (0, 0))
        leaves = leaves if kids else 1
        saved += (len(nodes[seq]) - 1) * len(seq[-1][1]) if seq else 0
        ends = ",".join(map(str, sorted(c for c in nodes[seq] if convs[c] == seq)))
        out.add((min(nodes[seq]), len(seq), min(nodes[seq[:-1]]) if seq else None, len(nodes[seq]), kids, leaves, saved,
                 hashlib.sha256(ends.encode()).hexdigest()))
        if seq:
            up = below.get(seq[:-1], (0, 0))
            below[seq[:-1]] = (up[0] + leaves, up[1] + saved)
            children[seq[:-1]] = children.get(seq[:-1], 0) + 1
    assert len(out) == len(nodes)
    return out


def found(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def chats(seed, count):
    rng = random.Random(seed)
    rows = []
    for c in range(count):
        c = c if rng.random() < 0.8 else c * 37
        kind = rng.random()
        # A third are copies of one conversation, a third share their first turn.
        texts = ["same", "ok", "bye"] if kind < 0.33 else ["same", *[rng.choice("abc") for _ in range(rng.randint(0, 6))]] \
            if kind < 0.66 else [rng.choice(["", "x", "yé😀", "z" * 300]) for _ in range(rng.randint(1, 5))]
        rows += [(c, t if rng.random() < 0.9 else None, rng.choice(["user", "assistant"]) if rng.random() < 0.1 else ["user", "assistant"][t % 2], x)
                 for t, x in enumerate(texts)]
    rows += [(7, None, None, None), (7, None, "user", None), (None, 1, "user", "lost"), (-5, 0, "a", "1:b"), (-205, 0, "", "b"),
             (100_000_000_105, 0, "user", "alone")] + rows[:3] + [(900, i, "user", "long" if i % 3 else "x") for i in range(150)] + [
             (1000, i, "user", "long" if i % 3 else "x") for i in range(140)]
    return rows


@pytest.mark.parametrize("limit", [1, 60, 1 << 16])
def test_equals_a_plain_trie(spark, monkeypatch, limit):
    monkeypatch.setattr(turntrie, "CONTAINER_TURNS", limit)
    monkeypatch.setattr(turntrie, "PIECE_BYTES", 20)
    rows = chats(limit, 260 if limit > 5 else 60)
    df = spark.createDataFrame([(*r, "u", 1, 2, "c") for r in rows], SCHEMA).repartition(3)
    assert found(turntrie.trie(turntrie.rebuilt(turntrie.conversations(df)))) == brute(rows)


def test_turnless_and_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert found(turntrie.trie(turntrie.rebuilt(turntrie.conversations(df)))) == set()
    # Without the base conversation the first turns are gone; such conversations are members of the root only.
    rows = [(c, 0, "user", "only") for c in range(101, 140)]
    got = found(turntrie.trie(turntrie.rebuilt(turntrie.conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))))
    assert got == brute(rows)


def test_unlike_turns_are_not_one(spark):
    rows = [(200, 0, "user", "x"), (201, 0, "use", "rx"), (202, 0, "", "userx"), (203, 0, "4:user", "x")]
    convs = turntrie.conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert len({bytes(r["units"]) for r in convs.collect()}) == 4


def test_sql(spark):
    import duckdb
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from read_parquet('{SF}/conversations.parquet')")
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    names = [c.split()[0] for c in turntrie.NODE.split(", ")]
    assert set(con.execute(f"select {', '.join(names)} from ({turntrie.ORACLE})").fetchall()) == brute(rows)


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    df = turntrie.op13_prefix_trie(spark, SF)
    assert [f"{f.name} {f.dataType.simpleString()}" for f in df.schema] == [c.replace("long", "bigint") for c in turntrie.NODE.split(", ")]
    assert found(df) == brute(rows)
