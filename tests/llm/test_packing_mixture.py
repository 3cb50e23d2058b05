import os
import random
from collections import defaultdict

import numpy as np
import pytest

from sieveworks.llm import copies, mixture, packing


def sizes(spark, n=400, seed=1):
    rnd = random.Random(seed)
    rows = [(i, rnd.choice([1, 5, 20, 60, 99, 100, 101, 230, 512]), rnd.randint(0, n // 2), rnd.choice(["a", "b", None])) for i in range(n)]
    return spark.createDataFrame(rows + [(n, 0, 1, "a")], "row_id long, tokens long, cluster long, source string"), rows


@pytest.mark.parametrize("shard", [40, 20_000])
def test_packing(spark, monkeypatch, shard):
    monkeypatch.setattr(packing, "SHARD", shard)
    df, rows = sizes(spark)
    got = packing.pack(df, spark.createDataFrame([(1, 100), (2, 1000), (3, 0)], "spec_id long, capacity_tokens int")).collect()
    for spec, cap in ((1, 100), (2, 1000)):
        mine = [r for r in got if r.spec_id == spec]
        fill, whole, pieces = defaultdict(int), defaultdict(int), defaultdict(int)
        for r in mine:
            fill[r.container] += r.size
            whole[r.row_id] += r.size
            pieces[r.row_id] += 1
            assert 0 < r.size <= cap
        assert all(f <= cap for f in fill.values()) and {r.container: r.fill for r in mine} == dict(fill)
        assert whole == {i: t for i, t, *_ in rows}  # every text once and whole
        assert all(pieces[i] == (1 if t <= cap else -(-t // cap)) for i, t, *_ in rows)
        assert sum(fill.values()) / (cap * len(fill)) > 0.93
    assert not [r for r in got if r.spec_id == 3]
    assert packing.pack(df.filter("row_id < 0"), spark.createDataFrame([(1, 100)], "spec_id long, capacity_tokens int")).collect() == []


def test_bins_keep_conflicts_apart():
    bins = packing.Bins(100)
    assert bins.add(60, 7, "a") == 0 and bins.add(30, 7, "b") == 1  # the only bin with room holds the cluster
    assert bins.add(50, 8, "c") == 1 and bins.add(8, 8, "d") == 0 and bins.add(20, None, "e") == 1  # tightest first
    mostly = packing.Bins(100)
    assert mostly.add(80, None, "a") == 0 and mostly.add(60, None, "b") == 1
    assert mostly.add(15, None, "a") == 1 and mostly.add(15, None, "b") == 0  # away from its own source
    assert mostly.add(25, None, "b") == 1  # the only bin with room


def test_no_shared_container_and_bounded_shards(spark, monkeypatch):
    """A third of the rows are copies of one text; sizes near 0.6 of the capacity leave every bin open."""
    monkeypatch.setattr(packing, "SHARD", 100)
    rnd = random.Random(2)
    rows = [(i, rnd.randint(55, 65) if i % 2 else rnd.randint(5, 12), 0 if i % 3 == 0 else i, "a") for i in range(900)]
    df = spark.createDataFrame(rows, "row_id long, tokens long, cluster long, source string")
    got = packing.pack(df, spark.createDataFrame([(1, 100)], "spec_id long, capacity_tokens int"))
    report = packing.fill_report(got).first()
    assert report.conflicts == 0 and report.pieces == 900


def test_near_copies_are_one_class(spark):
    rnd = random.Random(6)
    words = lambda n: [f"w{rnd.randint(0, 5000)}" for _ in range(n)]
    base = words(120)
    near = base[:60] + ["other"] + base[61:]
    rows = [(i, " ".join(words(120))) for i in range(60)] + [(100, " ".join(base)), (101, " ".join(base).upper() + "!"), (102, " ".join(near)), (103, " ".join(base[:70] + words(50))), (104, None), (105, " "), (106, "two words"), (107, "Two, words"), (108, "--"), (109, "??")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.row_id: r.cluster for r in copies.copy_classes(df, "doc_id", "text").collect()}
    assert got == {i: i for i in range(60)} | {100: 100, 101: 100, 102: 100, 103: 103, 106: 106, 107: 106, 108: 108, 109: 109}
    assert copies.copy_classes(df.filter("doc_id < 0"), "doc_id", "text").collect() == []


def test_classes_equal_brute_force(spark):
    rnd = random.Random(9)
    texts = []
    for _ in range(25):
        base = [f"w{rnd.randint(0, 300)}" for _ in range(rnd.randint(3, 80))]
        for _ in range(rnd.randint(1, 4)):
            t = list(base)
            for _ in range(rnd.randint(0, 2)):
                t[rnd.randrange(len(t))] = "x"
            texts.append(" ".join(t))
    sets = [copies.shingles(t) for t in texts]
    up = list(range(len(texts)))
    root = lambda x: x if up[x] == x else root(up[x])
    for i in range(len(texts)):
        for j in range(i):
            if copies.jaccard(sets[i], sets[j]) >= 0.8:
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    got = {r.row_id: r.cluster for r in copies.copy_classes(spark.createDataFrame(list(enumerate(texts)), "i long, t string"), "i", "t").collect()}
    assert got == {i: root(i) for i in range(len(texts))}


def classes(sets):
    """Smallest index of each set's class, by all pairs."""
    up = list(range(len(sets)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            if copies.jaccard(sets[i], sets[j]) >= copies.SIMILAR:
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return {i: root(i) for i in range(len(sets))}


@pytest.mark.parametrize("frequent", [1, 10**6])
def test_every_similar_pair_is_linked(spark, monkeypatch, frequent):
    """Pairs at 0.8 exactly, amid texts of smaller and larger ids that share much with both of a pair but are alike to none."""
    monkeypatch.setattr(copies, "SAMPLE", 1)
    monkeypatch.setattr(copies, "FREQUENT", frequent)
    monkeypatch.setattr(copies, "DIRECT", 0)
    rnd = random.Random(3)
    texts = []
    for k in range(3):
        base = [f"w{k}_{i}" for i in range(94)]  # 90 runs; a word inside changes five of them

        def changed(words):
            return " ".join(f"x{rnd.randint(0, 10**9)}" if i in words else w for i, w in enumerate(base))

        around = [changed({rnd.randint(5, 25), rnd.randint(35, 55), rnd.randint(65, 85)}) for _ in range(120)]
        texts += [(0, t) for t in around[:60]] + [(1, " ".join(base)), (1, changed({20, 70}))] + [(2, t) for t in around[60:]]
    texts = [t for _, t in sorted(texts, key=lambda x: x[0])]
    want = classes([copies.shingles(t) for t in texts])
    assert sorted(a - b for a, b in want.items() if a != b) == [1, 1, 1]
    got = {r.row_id: r.cluster for r in copies.copy_classes(spark.createDataFrame(list(enumerate(texts)), "i long, t string"), "i", "t").collect()}
    assert got == want


@pytest.mark.parametrize("direct", [0, 10**9])
def test_frequent_shingles_give_the_same_classes(spark, monkeypatch, direct):
    """Common wording in all texts, chains of copies and every listed shingle frequent: the buckets are compared by components."""
    monkeypatch.setattr(copies, "SAMPLE", 1)
    monkeypatch.setattr(copies, "FREQUENT", 1)
    monkeypatch.setattr(copies, "LIST", 3)
    monkeypatch.setattr(copies, "DIRECT", direct)
    rnd = random.Random(5)
    common = [f"c{i}" for i in range(60)]
    texts = []
    for k in range(12):
        t = common[: rnd.randint(20, 60)] + [f"w{k}_{rnd.randint(0, 9)}" for _ in range(rnd.randint(0, 12))]
        for _ in range(rnd.randint(1, 9)):  # each a change of the one before
            t = list(t)
            t[rnd.randrange(len(t))] = f"x{rnd.randint(0, 10**6)}"
            texts.append(" ".join(t))
    rnd.shuffle(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "i long, t string")
    assert len(copies.common_shingles(copies.text_rows(df, "i", "t"))[0]) > 40
    got = {r.row_id: r.cluster for r in copies.copy_classes(df, "i", "t").collect()}
    assert got == classes([copies.shingles(t) for t in texts])


def test_buckets_are_compared_across_components(spark, monkeypatch):
    monkeypatch.setattr(copies, "LIST", 2)
    rnd = random.Random(8)
    part = {i: i - i % 5 if i < 30 else i for i in range(40)}  # six components of five texts, ten texts alone
    places = [(i, rnd.choice([50, 60]), rnd.randint(0, 1), t) for i in range(40) for t in rnd.sample(range(4), 2)]
    places += [(i, 50, 0, 9) for i in range(5)]  # a bucket of one component
    at = spark.createDataFrame(places, "rep long, n long, pos int, tok long")
    joined = spark.createDataFrame([(i, p) for i, p in part.items() if i < 30], "node long, component long")
    want = set()
    for i, n, p, t in places:
        for j, m, q, u in places:
            most = 1 + min(n - p - 1, m - q - 1) + min(p, q)
            if i < j and t == u and part[i] != part[j] and most / (n + m - most) >= 0.8:
                want.add((i, j))
    assert {tuple(r) for r in copies.apart_pairs(at, joined).collect()} == want and want


@pytest.mark.skipif(not os.path.exists(packing.TOKENIZER), reason="no tokenizer file")
def test_token_counts(spark):
    df = spark.createDataFrame([(1, "Hello world", "a"), (2, None, "a"), (3, " ", None), (4, "hello, WORLD!", None)], "doc_id long, text string, source string")
    got = {r.row_id: (r.tokens, r.cluster) for r in packing.sized_texts(df, "doc_id", "text", "source").collect()}
    assert set(got) == {1, 4} and got[1][0] == 2 and got[1][1] == got[4][1]


def test_split_tree():
    rng = np.random.default_rng(1)
    counts = np.array([100, 7, 0, 33])
    tree = mixture.split_tree(counts, 7, rng)
    assert (tree.sum(axis=0) == counts).all() and tree.min() >= 0 and np.ptp(tree.sum(axis=1)) <= 2
    big = mixture._hypergeometric(np.array([3_000_000_000, 5, 1_000_000_000]), 2_000_000_000, rng)
    assert big.sum() == 2_000_000_000 and (big <= [3_000_000_000, 5, 1_000_000_000]).all() and abs(big[0] - 1_500_000_000) < 1_000_000


def test_mixture(spark, monkeypatch):
    monkeypatch.setattr(mixture, "BLOCK_DOCS", 10)
    rnd = random.Random(4)
    rows = [(i, rnd.choice(["a"] * 6 + ["b"] * 3 + ["c", "z", None]), rnd.randint(1, 30)) for i in range(900)] + [(5000, "a", 0)]
    df = spark.createDataFrame(rows, "row_id long, source string, tokens long")
    targets = spark.createDataFrame([("a", 0.4, 1), ("b", 0.3, 2), ("c", 0.2, 3), ("none", 0.1, 5)], "source string, target_share double, max_repeats int")
    drawn = mixture.draw(df, targets, shards=4)
    got = drawn.collect()
    uses, tokens = defaultdict(int), defaultdict(int)
    for r in got:
        uses[r.source, r.row_id] += 1
        tokens[r.source] += r.tokens
    limit = {"a": 1, "b": 2, "c": 3}
    assert set(tokens) == set(limit) and all(n <= limit[s] for (s, _), n in uses.items())
    total = sum(tokens.values())
    for s, share in (("a", 4 / 9), ("b", 3 / 9), ("c", 2 / 9)):
        assert abs(tokens[s] / total - share) < 0.01
    assert len({(r.row_id, r.copy) for r in got}) == len(got) and {r.shard for r in got} <= set(range(4))
    report = {r.source: r for r in mixture.share_report(drawn, df, targets).collect()}
    assert report["none"].tokens == 0 and abs(sum(r.actual_share for r in report.values()) - 1) < 1e-9
    assert mixture.draw(df.filter("row_id < 0"), targets).collect() == []
