"""Brute-force tests of centroid clustering, ranked search and SimHash."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from strandline.llm import components, lloyd, ranked_search, simhash
from strandline.llm import queries as q
from strandline.llm.storage import Workspace

from .test_llm import ODD, make, words_of

SF = "/root/testdata/sf0.001"


# ---- 11


def vectors(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2.0) for r in rows], "vec_id long, embedding array<float>, label int, v string, cluster double")


def brute_lloyd(rows, k, rounds, size):
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    centroids = [v for _, v in first]

    def near(v):
        d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        own = [near(v)[0] for _, v in kept]
        for c in range(len(centroids)):
            members = [v for (_, v), o in zip(kept, own) if o == c]
            if members:
                centroids[c] = [sum(x) // len(members) for x in zip(*members)]
    final = [(i, *near(v)) for i, v in kept]
    inertia = Counter()
    for _, c, d in final:
        inertia[c] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i is None, i or 0), c, d, inertia[c], sum(inertia.values()), sha[c]) for i, c, d in final)


def plain(rows):
    return sorted(((r.vec_id is None, r.vec_id or 0), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in rows)


def test_lloyd_by_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = [(int(i), [float(x) for x in rng.normal(size=8)]) for i in range(90)]
    rows += [(i, rows[i][1]) for i in (3, 3, 5)] + [(900 + i, rows[7][1]) for i in range(40)]  # repeated rows and a hot vector
    rows += [(500, None), (501, []), (502, [1.0] * 7), (503, [1.0] * 7 + [None]), (504, [math.nan] + [0.0] * 7), (505, [math.inf] + [0.0] * 7), (None, [0.5] * 8), ((1 << 60) + 1, [-0.25] * 8)]
    got = lloyd.cluster_report(vectors(spark, rows).repartition(5), k=6, size=8)
    assert plain(got.collect()) == brute_lloyd(rows, 6, 5, 8)


def test_lloyd_ties_and_empty_clusters(spark):
    rows = [(i, [float(i // 3)] * 2) for i in range(12)]  # equal vectors make equal centroids: the smaller number takes all, the other stays
    assert plain(lloyd.cluster_report(vectors(spark, rows), k=9, size=2).collect()) == brute_lloyd(rows, 9, 5, 2)


def test_lloyd_few_none_and_large(spark):
    few = [(1, [1.0, 2.0]), (2, [5.0, 5.0])]
    assert plain(lloyd.cluster_report(vectors(spark, few), k=40, size=2).collect()) == brute_lloyd(few, 40, 5, 2)
    assert lloyd.cluster_report(vectors(spark, []), size=2).collect() == []
    assert lloyd.cluster_report(vectors(spark, [(None, [1.0, 1.0]), (3, [1.0])]), size=2).collect() == []
    huge = lloyd.cluster_report(vectors(spark, [(1, [3e38] * 64), (2, [-3e38] * 64)]), k=1).collect()
    assert [r.distance for r in huge] == [64 * lloyd.BOUND**2] * 2  # the mean of both bounds is zero


# ---- 12


def terms(t):
    return re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))


def brute_search(docs, items, top=20):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n, total = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in sorted(set(items), key=str):
        asked, found = Counter(terms(text)), []
        for i, b in bags:
            m = 75 + 25 * sum(b.values()) * n // total
            score = sum(c * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 12 * m)) for t, c in asked.items() if t in b)
            if score > 0:
                found.append((-score, i is None, i or 0))
        out += [(item, rank, None if none else i, -s) for rank, (s, none, i) in enumerate(sorted(found)[:top], 1)]
    return sorted(out, key=str)


def searched(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=str)


@pytest.fixture
def small_trees(monkeypatch):
    """Shards of several levels on a small table; closures carry the values that the driver has."""
    for name, value in (("LEAF", 2), ("SHARD", 40), ("ARITY", 3), ("LEAF_POSTINGS", 30), ("BLOCK_TERMS", 25)):
        monkeypatch.setattr(ranked_search, name, value)


def prose(rng, n, words):
    return " ".join(rng.choice(words) for _ in range(n))


def search_case():
    rng = random.Random(12)
    words = [f"w{int(rng.expovariate(0.08))}" for _ in range(400)] + ["Ünder", "é", "A1", "the"]
    docs = [(i, prose(rng, rng.randint(1, 60), words)) for i in range(300)]
    docs += [(300 + i, docs[5][1]) for i in range(70)] + [(7, docs[7][1]), (7, "another text w1 w2 w3"), (None, docs[9][1]), (None, "w1"), (991, None), (992, ""), (993, " .,- ")]
    items = [(i, prose(rng, 12, words)) for i in range(12)] + [(50, docs[5][1]), (51, None), (52, ""), (53, "nothing known"), (54, "w1 W1 w1, the"), (54, "w2"), (54, "w2"), (None, "w3 a1")]
    return docs, items


def test_search_by_brute_force(spark, small_trees):
    docs, items = search_case()
    table = spark.createDataFrame([(t, i, 0, "x", 1.5) for i, t in docs], "text string, doc_id long, shard int, terms string, score double").repartition(3)
    asked = spark.createDataFrame([(i, t, 3, "y") for i, t in items], "item_id long, text string, item int, rank string")
    assert searched(ranked_search.ranked(table, asked)) == brute_search(docs, items)


def test_search_ties_go_to_the_smallest_ids(spark, small_trees):
    docs = [(i, "alpha beta") for i in range(500)] + [(1000 + i, "gamma") for i in range(30)]
    random.Random(3).shuffle(docs)
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    asked = spark.createDataFrame([(1, "beta alpha alpha")], "item_id long, text string")
    assert [r[2] for r in sorted(searched(ranked_search.ranked(table, asked)), key=lambda r: r[1])] == list(range(20))


def test_search_opens_few_ranges(monkeypatch):
    """Best first: of many leaves only those whose bound reaches the worst result are scored."""
    wanted = np.array([10, 20])
    leaves = [{"terms": np.array([10, 20]), "at": np.array([0, 0]), "tf": np.array([1 + i % 50, 1]), "lengths": np.array([100]), "doc_ids": ranked_search.pa.array([i])} for i in range(512)]
    tree = ranked_search.Tree(leaves, wanted, 512, 512 * 100)
    opened = []
    scores = ranked_search.Tree.scores
    monkeypatch.setattr(ranked_search.Tree, "scores", lambda self, leaf, *a: opened.append(leaf) or scores(self, leaf, *a))
    columns, weights = tree.columns(np.array([0, 1]), np.array([5, 7]))
    best = tree.search(columns, weights, 1, 5)
    every = sorted(((int(tree.bound(columns, weights)) and int(scores(tree, i, columns, weights)[0]), -i) for i in range(512)), reverse=True)[:5]
    assert sorted(best, key=lambda x: (-x[0], x[1])) == [(s, -i) for s, i in every]
    assert len(opened) <= 30  # ten leaves tie at the top


def test_search_of_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs, items = make(spark, ["a b", None]), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert ranked_search.ranked(docs, none).collect() == [] == ranked_search.ranked(make(spark, []), items).collect()
    assert searched(ranked_search.ranked(make(spark, [None, "", "!"]), items)) == []
    assert [r[:3] for r in searched(ranked_search.ranked(docs, items))] == [(1, 1, 0)]


def test_search_of_a_long_text(spark):
    rng = random.Random(5)
    long = " ".join(f"t{rng.randrange(90_000)}" for _ in range(900_000))  # over five million characters
    docs, items = [(1, long), (2, "t5 t6"), (3, "t7 zz")], [(1, "t5 t6 t7"), (2, " ".join(f"t{i}" for i in range(2000)))]
    got = ranked_search.ranked(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert searched(got) == brute_search(docs, items)


# ---- 13


def brute_print(t):
    w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in words_of(t)]
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + min(3, len(w))]).encode(), 42) for i in range(len(w) - min(3, len(w)) + 1)] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, prints, radius):
    """The smallest id of each row's component."""
    label = list(range(len(ids)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                label[root(i)] = root(j)
    least = {}
    for i in range(len(ids)):
        least[root(i)] = min(ids[i], least.get(root(i), ids[i]))
    return [least[root(i)] for i in range(len(ids))]


def test_simhash_by_brute_force(spark):
    rng = random.Random(13)
    base = [prose(rng, 60, [f"v{i}" for i in range(50)]) for _ in range(12)]
    texts = [*ODD, *base, base[0].upper()]
    for b in base:
        for _ in range(6):
            w = b.split()
            w[rng.randrange(60)] = "changed"
            texts.append(" ".join(w))
    ids = [*range(len(texts))]
    rng.shuffle(ids)
    docs = make(spark, [*texts, texts[12], "no id", base[3]], [*ids, ids[12], None, None])
    got = simhash.simhash_components(docs).collect()
    prints = [brute_print(t) for t in texts]
    want = sorted(zip(ids, (f"{p:016x}" for p in prints), brute_components(ids, prints, 2)))
    known = sorted((r.doc_id, r.fingerprint, r.component_id) for r in got if r.doc_id is not None)
    assert known == sorted([*want, next(r for r in want if r[0] == ids[12])])
    assert sorted((r.fingerprint, r.component_id) for r in got if r.doc_id is None) == sorted((f"{brute_print(t):016x}", None) for t in ("no id", base[3]))
    assert len({r[2] for r in want}) < len(want) - 5  # there are links


@pytest.mark.parametrize("parts", [1, 2, 4, 8, 16])
def test_tiles_lose_no_link(spark, parts, monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", 20)
    rng = random.Random(parts)
    prints = {0, (1 << 64) - 1}
    for _ in range(25):
        p = rng.getrandbits(64)
        for _ in range(12):  # a chain whose ends are far apart
            prints.add(p)
            for b in rng.sample(range(64), rng.choice([1, 2, 3])):
                p ^= 1 << b
    prints |= {1 << b for b in range(64)} | {((1 << 64) - 1) ^ (1 << b) for b in range(64)}
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(s,) for s in signed], "fp long")
    with simhash.Workspace(spark) as ws:
        edges = simhash.links(df, 2, ws, parts).collect()
    mask = (1 << 64) - 1
    label = {p: p for p in prints}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for r in edges:
        x, y = root(r.a & mask), root(r.b & mask)
        label[max(x, y)] = min(x, y)
    assert [root(p) for p in prints] == brute_components(prints, prints, 2)
    assert len(edges) < 20 * len(prints)  # spanning forests, not all pairs


def test_simhash_empty_table(spark):
    assert simhash.simhash_components(make(spark, [])).collect() == []


def test_simhash_uses_sparks_own_hash(spark):
    r = spark.range(1).select(F.xxhash64(F.lit("ab cd ef")).alias("h")).first()
    assert simhash.hashes(b"AB\tcd\n ef ", 3).view(np.int64).tolist() == [r.h]


@pytest.mark.parametrize("name", ["op11_centroid_clustering", "op12_ranked_search", "op13_simhash"])
def test_registered(spark, name):
    assert q.QUERIES[name](spark, SF).count() > 0


# ---- 9: cutting lines


def test_lines_are_cut_in_linear_time(spark):
    """200,000 lines of one text, half of them to go; an expression that looks each number up in an array takes hours."""
    from strandline.llm.line_dedup import _without

    text = "\n".join(f"line {i}" for i in range(200_000))
    df = spark.createDataFrame([(1, text, list(range(0, 200_000, 2))), (2, "a\nb\n", [1]), (3, None, [0]), (4, "\n\n", [])], "id long, text string, gone array<int>")
    got = {r.id: r.left for r in df.select("id", _without("text", "gone").alias("left")).collect()}
    assert got == {1: "\n".join(f"line {i}" for i in range(1, 200_000, 2)), 2: "a\n", 3: None, 4: "\n\n"}


# ---- 1: items in many blocks; 5: an independent best segmentation


def test_leaks_of_many_blocks_go(spark):
    from strandline.llm import decontaminate

    rng = random.Random(6)
    words = [f"w{i}" for i in range(300)]
    items = [(i, prose(rng, rng.randint(3, 30), words)) for i in range(25)] + [(90, None), (91, "")]
    texts = [prose(rng, 20, words) + (" " + items[i % 25][1] + " " if i % 3 == 0 else " ") + prose(rng, 20, words) for i in range(60)] + ODD
    docs = make(spark, [*texts, texts[0], texts[1]], [*range(len(texts)), None, None])
    table = spark.createDataFrame(items, "item_id long, text string")
    one, many = (sorted(map(str, decontaminate.without_leaks(docs, table, block_words=b).collect())) for b in (1_000_000, 40))
    assert one == many and len(one) == len(texts) + 2 - 21


def test_codec_against_an_independent_search(spark):
    from strandline.llm import piece_codec

    v = piece_codec.load()

    def best(text):
        """Of all ways to cut a text into pieces and single code points: the greatest sum of scores."""
        at = [0] + [-math.inf] * len(text)
        for end in range(1, len(text) + 1):
            single = at[end - 1] + v.unknown
            at[end] = max([single, *(at[end - n] + v.scores[text[end - n : end]] for n in range(1, min(v.longest, end) + 1) if text[end - n : end] in v.scores)])
        return at[-1]

    rows = spark.read.parquet(f"{SF}/documents.parquet").select("text").limit(40).collect()
    texts = [r.text[:1500] for r in rows if r.text] + [t for t in ODD if t and len(t) < 2000] + ["nospacesatall" * 60, "  a   b ", "𝒳y" * 30]
    docs = make(spark, texts)
    for chunk in (23, 1000):
        got = {r.doc_id: r.ids for r in piece_codec.encode(docs, v, ["doc_id"], chunk_chars=chunk).collect()}
        assert all(piece_codec.score_of(v, t, got[i]) == best(" " + t) for i, t in enumerate(texts))


def test_shared_pairs_are_those_of_shared_rows(spark):
    rng = np.random.default_rng(3)
    lists = [(i, [int(k) for k in rng.integers(-40_000, 40_000, rng.integers(0, 9))] + [7] * (i % 500 == 0)) for i in range(5000)] * 2
    rows = spark.createDataFrame(lists, "id long, keys array<long>").repartition(5)
    want = components.shared_rows(rows.select(F.explode("keys").alias("key"), "id"))
    got = components.shared_pairs(rows).collect()
    assert len(got) == len(set(got)) and {(r.key, r.id) for r in got} == {(r.key, r.id) for r in want.collect()}


def test_op9_own_edges_are_stars_at_once_and_links_join_components(spark):
    """A task's edges, a long path too, need no round; further links change only the components that they join."""
    rng = np.random.default_rng(4)
    path = rng.permutation(300).tolist()
    edges = spark.createDataFrame(list(zip(path, path[1:])) + [(1000, 1001), (2000, 2001)], "a long, b long").coalesce(1)
    with Workspace(spark) as ws:
        first = components.connected_components(edges, ws)
        links = spark.createDataFrame([(1001, 2000), (2001, 3000), (4000, 4001), (5, 7)], "a long, b long")
        got = {r.id: r.component for r in components._joined(first, links, ws).collect()}
    assert {i: got[i] for i in range(300)} == dict.fromkeys(range(300), 0)
    assert {i: c for i, c in got.items() if i >= 300} == {1000: 1000, 1001: 1000, 2000: 1000, 2001: 1000, 3000: 1000, 4000: 4000, 4001: 4000}
    assert [tuple(x.column(c).to_pylist() for c in "ab") for x in components._own_stars(iter(pa.table({"a": [5, 9, 4], "b": [9, 4, 4]}).to_batches()))] == [([5, 9], [4, 4])]


@pytest.mark.parametrize("tasks", [1, 7])
def test_components_of_random_edges_however_they_are_dealt(spark, tasks, monkeypatch):
    """Paths, hubs and random graphs, some edges twice and in both directions, in few and in many tasks and portions of a task."""
    monkeypatch.setattr(components, "MOST_EDGES", 50)
    rng = np.random.default_rng(tasks)
    path = (rng.permutation(200) + 1000).tolist()
    edges = [*zip(path, path[1:]), *((i, 5000) for i in range(5001, 5200)), *map(tuple, rng.integers(0, 400, (220, 2)).tolist()), (-3, -9), (77777, 77777)]
    edges = [e for i in rng.permutation(len(edges)) for e in (edges[i], edges[i][::-1], edges[i])[: 1 + i % 3]]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = components.connected_components(spark.createDataFrame(edges, "a long, b long").repartition(tasks)).collect()
    assert len(got) == len(root) and {r.id: r.component for r in got} == {x: find(x) for x in root}


def test_pipeline_op9_union_find_takes_few_exchanges(spark, monkeypatch):
    """Edges of wide components, dealt over many tasks: with many shuffle partitions it is the exchanges that cost."""
    plans, before = [], Workspace.stored

    def counted(ws, df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return before(ws, df, name)

    monkeypatch.setattr(Workspace, "stored", counted)
    edges = spark.range(0, 3000, 1, 12).select(F.col("id").alias("a"), (F.col("id") + F.lit(1) + F.col("id") % 2 * 6).alias("b"))
    got = components.connected_components(edges)
    assert {r.component for r in got.collect()} == {0, 2, 4, 6}
    assert "Exchange" not in plans[0]  # stars are made before anything is dealt out
    assert sum(p.count("Exchange hashpartitioning") for p in plans) < 8


def test_pipeline_op9_components_of_shared_keys(spark):
    """Links among ids that share a key, whether verify or the search thins its pairs; the rows' sizes are those of the keys."""
    rows = [(k, i) for k in range(40) for i in range(k, 400, 37 + k)] + [(999, i) for i in range(400)]
    keys = spark.createDataFrame(rows, "key long, id long")
    first = components.shared_rows(keys, once=True)
    assert {(r.key, r.size) for r in first.collect()} == {(k, sum(x == k for x, _ in rows)) for k in {k for k, _ in rows}}
    for thin in (True, False):
        with Workspace(spark) as ws:
            marks = lambda ids: ws.stored(ids.withColumn("v", F.col("id") % 50), "v")
            verify = lambda pairs: pairs.where("a % 50 = b % 50")
            may = lambda x, y: F.abs(F.col(f"{x}.v") - F.col(f"{y}.v")) <= 1
            found = components.linked_components(ws.stored(first, "first"), verify, marks, may, ws, thin=thin).collect()
        assert {r.id: r.component for r in found} == {i: i % 50 for i in range(400)}
