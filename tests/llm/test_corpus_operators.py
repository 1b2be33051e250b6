"""Joins, searches, packing and the pipeline, against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest

import __spark_entry__
import corpus_pipeline
from farelake.llm import graph, jaccard, packing, quality, secrets, topk

SF = "/root/testdata/sf0.001"


def shingles(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def brute_groups(rows, n, percent):
    """row -> (set size, least id of its component)."""
    sets = [shingles(t, n) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and min(len(a), len(b)) * 100 >= percent * max(len(a), len(b)):
                both = len(a & b)
                if 100 * both >= percent * (len(a) + len(b) - both):
                    parent[root(i)] = root(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[root(i)] = min(key, least.get(root(i), key))
    return [(len(sets[i]), least.get(root(i)) if sets[i] else rows[i][0]) for i in range(len(rows))]


def similar_texts(count, seed):
    rng = random.Random(seed)
    base = [f"{rng.choice('abcdefgh')}{rng.randint(0, 300)}" for _ in range(90)]
    rows = []
    for i in range(count):
        w = list(base) if i % 3 else [f"q{rng.randint(0, 9)}" for _ in range(rng.randint(0, 6))]
        for _ in range(rng.randint(0, 4)):
            if w:
                w[rng.randrange(len(w))] = f"x{rng.randint(0, 10 ** 6)}"
        rows.append((i, (" " if i % 2 else "\n").join(w)))
    return rows


@pytest.mark.parametrize("n, percent, tokens", [(3, 90, 2000), (5, 80, 200_000)])
def test_jaccard_groups(spark, monkeypatch, n, percent, tokens):
    monkeypatch.setattr(jaccard, "CHUNK_TOKENS", tokens)  # 2000: blocks are cut into chunks
    rows = similar_texts(240, n) + [(1000, None), (1001, ""), (1002, " \n"), (None, "only one"), (None, "Only One"), (5, "other text of five")]
    rows += rows[1:3]
    docs = spark.createDataFrame([(*r, 1, "z") for r in rows], "doc_id long, text string, node int, `__node` string")
    got = [(r.n_shingles, r.component_id) for r in jaccard.similar_groups(docs, n, percent).collect()]
    assert Counter(got) == Counter(brute_groups(rows, n, percent))
    kept = jaccard.drop_near_copies(docs, n, percent)
    assert kept.columns == docs.columns
    # One row of each component, told by rows: unlike texts under one id are two of them.
    of_row = brute_groups([(i, t) for i, (_, t) in enumerate(rows)], n, percent)
    assert kept.count() == len({c for s, c in of_row if s}) + sum(not s for s, _ in of_row)


def test_jaccard_query_and_empty_table(spark):
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.op3_jaccard_join(spark, SF).collect()}
    assert [got[i] for i, _ in rows] == brute_groups(rows, 3, 90)
    none = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.similar_groups(none).count() == 0 and jaccard.drop_near_copies(none).count() == 0


def test_near_copies_with_clashing_ids(spark):
    one, two, three = (" ".join(f"{c}{i}" for i in range(40)) for c in "abc")
    rows = [(1, one), (2, one + " end"), (1, two), (7, two + " end"), (1, three), (None, three + " end"), (1, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(tuple(r) for r in jaccard.drop_near_copies(docs, 5, 80, clashing=True).collect())
    assert kept == sorted([(1, one), (1, two), (1, three), (1, "")])
    assert sorted(tuple(r) for r in jaccard.drop_near_copies(docs).collect()) == kept
    none = docs.selectExpr("cast(null as long) as doc_id", "text").where("text <> ''")
    assert jaccard.drop_near_copies(none, 5, 80, clashing=True).count() == 3


def test_tree_links_connect_like_all_pairs():
    rng = random.Random(8)
    for percent in (60, 80, 90, 100):
        sets = []
        for _ in range(60):
            base = set(range(rng.choice((0, 100, 200)), rng.choice((210, 230, 260))))
            sets.append(np.unique(jaccard.mix(np.array(sorted(base - set(rng.sample(sorted(base), rng.randint(0, 9)))), np.uint64))))

        def parts(links):
            parent = list(range(len(sets)))
            def root(i):  # noqa: E306
                while parent[i] != i:
                    i = parent[i]
                return i
            for i, j in links:
                parent[root(i)] = root(j)
            return [min(k for k in range(len(sets)) if root(k) == root(i)) for i in range(len(sets))]

        every = [(i, j) for i in range(len(sets)) for j in range(i) if jaccard.enough(
            len(np.intersect1d(sets[i], sets[j])), len(sets[i]), len(sets[j]), percent)]
        assert parts(jaccard.tree_links(sets, percent)) == parts(every)


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (102, 101), (7, 7)], "a long, b long")
    got = {r.node: r.component for r in graph.components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 102: 100}


def test_top_k_with_ties_and_faults(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 50)
    monkeypatch.setattr(topk, "QUERY_ROWS", 7)
    rng = np.random.default_rng(9)
    vectors = np.round(rng.normal(size=(300, 5)), 2)
    vectors[50:150] = vectors[50]  # one vector a third of the rows
    rows = [(i, [float(x) for x in v], 1) for i, v in enumerate(vectors)]
    rows += [(1000, None, 1), (1001, [1.0, None, 0.0, 0.0, 0.0], 1), (1010, [float("nan")] * 5, 1), (1020, [float("inf")] * 5, 1),
             (None, [1.0] * 5, 1), (1030, [1.0, 2.0], 1), (2000, [], 1), (20, rows[20][1], 1), (21, rows[21][1], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in topk.top_k(frame, topk.F.col("vec_id") % 10 == 0, 10).collect())
    fine = [(i, np.floor(1024 * np.array(v)).astype(int)) for i, v, _ in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for q, v in {(i, tuple(x)) for i, x in fine if i % 10 == 0}:
        scored = sorted((-int(np.dot(v, x)), i) for i, x in fine if i != q and len(x) == len(v))[:10]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scored)]
    assert got == sorted(want)
    assert topk.top_k(frame.limit(0), topk.F.col("vec_id") % 10 == 0, 10).count() == 0


def test_top_k_with_large_components(spark):
    rows = [(0, [1.0, 1e10]), (1, [2.0, 1.0]), (2, [1e30, 0.0]), (3, [-1e30, 0.0]), (4, [3.0, 0.0]), (5, [-1e12, 1e12]), (6, [8e12, 8e12]), (7, [7e12, 7e12])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in topk.top_k(frame, topk.F.col("vec_id").isin(0, 1, 6), 3).select("query_id", "rank", "vec_id", "score").collect()]
    whole = {i: [int(1024 * x) for x in v] for i, v in rows if max(map(abs, v)) < 1e13 and max(abs(1024 * x) for x in v) < 2 ** 53}
    want = []
    for q in (0, 1, 6):
        score = lambda i: max(-topk.MOST, min(topk.MOST, sum(a * b for a, b in zip(whole[q], whole[i], strict=True))))  # noqa: B023, E731
        best = sorted((i for i in whole if i != q), key=lambda i: (-score(i), i))[:3]
        want += [(q, k, i, score(i)) for k, i in enumerate(best, 1)] if q in whole else []
    assert sorted(got) == sorted(want) and {2, 3}.isdisjoint(whole) and 0 in whole


def test_top_k_few_candidates(spark):
    frame = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [2.0])], "vec_id long, embedding array<double>")
    got = [tuple(r) for r in topk.top_k(frame, topk.F.col("vec_id") == 0, 10).orderBy("rank").collect()]
    assert got == [(0, 1, 1, 2097152), (0, 2, 2, 2097152)]


def _packed_well(rows, lengths, capacities):
    by_key, by_bin = {}, {}
    for r in rows:
        by_key.setdefault(r.id, []).append(r)
        by_bin.setdefault(r.bin_id, []).append(r)
    for key, total in lengths.items():
        at = 0
        for r in sorted(by_key[key], key=lambda r: r.start):
            assert r.start == at and r.length > 0
            at += r.length
        assert at == total
    for some in by_bin.values():
        at = 0
        for r in sorted(some, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert {r.capacity for r in some} == {min(c for c in capacities if c >= at)}  # downsized


def test_packing_places_everything(spark):
    rng = random.Random(10)
    lengths = {i: rng.choice((1, 3, 7, 10, 20, 21, 45, 200)) for i in range(500)}
    items = spark.createDataFrame([(i, n, "x") for i, n in lengths.items()], "id long, n long, bin_id string")
    rows = packing.pack(items, "id", packing.F.col("n"), (10, 20, 40), 60).collect()
    _packed_well(rows, lengths, (10, 20, 40))
    fill = sum(r.length for r in rows) / sum({r.bin_id: r.capacity for r in rows}.values())
    assert fill > 0.95
    assert packing.pack(items.limit(0), "id", packing.F.col("n")).count() == 0


def test_packing_is_best_fit_and_cheapest_of_its_rates():
    rng = random.Random(11)
    for _ in range(30):
        lengths = sorted((rng.randint(1, 40) for _ in range(rng.randint(1, 40))), reverse=True)
        costs = []
        for fill in packing.FILL_RATES:
            bins = packing.best_fit(lengths, (10, 20, 40), fill)
            assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
            costs.append(sum(packing.cost(min(c for c in (10, 20, 40) if c >= sum(lengths[i] for i in b))) for b in bins))
        assert sum(packing.cost(c) for c, _ in packing.pack_group(lengths, (10, 20, 40))) == pytest.approx(min(costs))


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality rules"](spark, docs, SF)
    assert good.schema == docs.schema
    verdict = {r.doc_id for r in quality.judge(docs, labels).where("kept").collect()}
    good_rows = good.collect()
    assert {r.doc_id for r in good_rows} == verdict

    good = spark.createDataFrame(good_rows, docs.schema)
    single = stages["n-gram Jaccard join"](spark, good, SF)
    rows = [(r.doc_id, r.text) for r in good_rows]
    assert single.schema == docs.schema
    single_rows = single.collect()
    assert {r.doc_id for r in single_rows} == {c for _, c in brute_groups(rows, 5, 80)}
    assert len(single_rows) == len({r.doc_id for r in single_rows})

    single = spark.createDataFrame(single_rows, docs.schema)
    clean = stages["secret scans"](spark, single, SF).collect()
    before = {r.doc_id: r for r in single_rows}
    assert len(clean) == len(before)
    for r in clean:
        assert not secrets.find_secrets(r.text.encode()) and r.n_chars == len(r.text)
        if not secrets.find_secrets(before[r.doc_id].text.encode()):
            assert r == before[r.doc_id]

    rows = corpus_pipeline.run(spark, SF).withColumnRenamed("doc_id", "id").collect()
    _packed_well(rows, {r.doc_id: len(r.text.encode()) + 1 for r in clean}, packing.CAPACITIES)
    assert {r.id for r in rows} == {r.doc_id for r in clean}


def test_pipeline_on_odd_and_empty_rows(spark, tmp_dir):
    schema = "doc_id long, text string, lang string, source string, n_chars long, bin_id string, found int"
    text = " ".join(f"word{i}" for i in range(40)) + "."
    rows = [(1, None, None, None, None, "b", 1), (2, "", "en", "s", 0, "b", 1), (3, text, "en", None, 1, "b", 1), (3, text, "en", None, 1, "b", 1),
            (None, text + " password=hunter2hunter2", "en", "s", 1, "b", 1), (4, "q%d " * 9, "en", "s", 1, "b", 1)]
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_dir}/labels.parquet")
    docs = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), tmp_dir).count() == 0, name
        docs = spark.createDataFrame(stage(spark, docs, tmp_dir).collect(), schema)
    assert [(r.doc_id, r.text) for r in docs.collect()] == [(3, text)]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, tmp_dir)
    assert [(r.doc_id, r.length) for r in packed.collect()] == [(3, len(text) + 1)]


def test_every_operator_is_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(k.startswith(f"op{n}_") for k in names) == 1
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "n-gram Jaccard join", "secret scans", "best-fit packing"]
