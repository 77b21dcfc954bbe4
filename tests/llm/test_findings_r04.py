"""Tests of the findings of round 4: what the n-gram Jaccard join keeps on disk."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.llm import components, jaccard_join
from strandline.llm.storage import Workspace

from .test_llm import make


@pytest.mark.parametrize("tasks", [1, 6])
def test_f1_pipeline_shared_of_lists_are_shared_rows(spark, tasks):
    """Keys of two rows, of many and of all, in few tasks and in many; a blob holds four bytes a key."""
    rng = np.random.default_rng(tasks)
    own = rng.integers(-(1 << 63), 1 << 63, (1500, 30))
    some = rng.integers(-(1 << 63), 1 << 63, 400)
    lists = [(i, list({int(k) for k in [*own[i, : i % 30], *some[rng.integers(0, 400, i % 3)], *[5, -1, 1 << 50][: 3 * (i % 7 == 0)]]})) for i in range(1500)]
    lists += [(9999, [2**63 - 1]), (10_000, [2**63 - 1]), (10_001, [])]
    df = spark.createDataFrame(lists, "id long, keys array<long>").repartition(tasks)
    want = components.shared_rows(df.select(F.explode("keys").alias("key"), "id"), once=True).collect()
    with Workspace(spark) as ws:
        got = components.shared_of_lists(df, ws).collect()
    assert len(want) > 1000 and sorted((r.key, r.id, r.size) for r in got) == sorted((r.key, r.id, r.size) for r in want)
    heads = components.repeated_heads(df).collect()
    assert len(heads) == len({r.key for r in want})
    with Workspace(spark) as ws:
        assert not components.shared_of_lists(df.limit(0), ws).count()


def test_f1_pipeline_few_rows_are_shuffled_for_keys_of_one_id(spark, monkeypatch):
    """Of 60,000 keys that one id has nearly no row reaches the shuffle; before, each did, twice."""
    seen, before = {}, Workspace.stored

    def counted(ws, df, name):
        out = before(ws, df, name)
        seen[name] = out.count()
        return out

    monkeypatch.setattr(Workspace, "stored", counted)
    rng = np.random.default_rng(2)
    lists = [(i, rng.integers(-(1 << 63), 1 << 63, 100).tolist() + [3] * (i < 2)) for i in range(600)]
    with Workspace(spark) as ws:
        got = components.shared_of_lists(spark.createDataFrame(lists, "id long, keys array<long>"), ws).collect()
    assert sorted(tuple(r) for r in got) == [(3, 0, 2), (3, 1, 2)]
    assert seen["heads-of-keys"] == 1 and seen["near-keys"] < 100


def test_f1_pipeline_sketches_of_large_sets_tell_them_apart(spark):
    """Sets on both sides of a doubling: linked ones pass, whatever their sketches' lengths; sets without a common shingle don't, as with 1024 bits they did."""
    rng = np.random.default_rng(6)
    one = lambda n: np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
    rows = []
    for i, n in enumerate([1500, 2040, 2200, 4000, 4500, 9000, 18_000]):
        a = one(n)
        for j, x in enumerate((a, a[: len(a) * 81 // 100], np.concatenate([a, one(n // 5)]), one(n))):
            sketch = jaccard_join.sketch(x, jaccard_join.sketch_words(len(x)))
            short = jaccard_join.sketch(x)
            assert len(sketch) * 64 * 2 >= len(x)
            while len(sketch) > len(short):
                sketch = np.bitwise_xor(*np.split(sketch, 2))
            assert (sketch == short).all()
            rows.append((4 * i + j, len(x), jaccard_join.sketch(x, jaccard_join.sketch_words(len(x))).tolist()))
    sets = spark.createDataFrame(rows, "id long, n_shingles long, sketch array<long>")
    x, y = sets.alias("x"), sets.alias("y")
    same = F.expr("x.id div 4 = y.id div 4 and x.id < y.id")
    near = lambda folds: {(r.a % 4, r.b % 4, r.a // 4) for r in x.join(y, same & jaccard_join.may_link(80, folds)("x", "y")).select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).collect()}
    assert near(True) == {(0, j, i) for i in range(7) for j in (1, 2)}
    # sets of less than half the size are not lost where so few percent let them link
    low = x.join(y, F.expr("x.id = 0 and y.id = 16") & jaccard_join.may_link(10, True)("x", "y"))
    assert low.count() == 1


def test_f1_pipeline_texts_of_linked_pairs_alone_are_gathered(spark, monkeypatch):
    """Long texts that share a passage, and so keys, are not verified; before, the texts of all of them were gathered and each pair's were joined."""
    texts, before = [], Workspace.stored

    def counted(ws, df, name):
        out = before(ws, df, name)
        if name.endswith("-texts"):
            texts.append(out.count())
        return out

    monkeypatch.setattr(Workspace, "stored", counted)
    rng = np.random.default_rng(8)
    passage = " ".join(f"p{i}" for i in range(600))
    docs = [" ".join(f"w{k}" for k in rng.integers(0, 1 << 40, 2600 + i).tolist()) + " " + passage for i in range(30)]
    docs.append(docs[3] + " and a few more words")
    got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(make(spark, docs), 80, 5).collect()}
    assert got == {**{i: i for i in range(30)}, 30: 3}
    assert texts and max(texts) == 2
