"""Brute-force, round-trip and held-out tests of the training-data operators."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strandline.llm import components, decontaminate, jaccard_join, language_id, line_dedup, piece_codec, quality_fm, quality_rules, recompression, secret_scan, toxicity
from strandline.llm import queries as q
from strandline.llm.arrays import text_bytes

from ..compare import assert_same, duck

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, keys string, id string, label string, k string"


def make(spark, texts, ids=None):
    """Documents with extra columns whose names operators use inside."""
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "en", "s", None if t is None else len(t), 0.5, "x", "y", "z", "w") for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, SCHEMA)


ODD = [None, "", " \n ", "word", "word", "é ▁ 日本", "a\x00b " * 3, "same text here again\n" * 40, "tail " * 6000]


@pytest.fixture(scope="module")
def odd(spark):
    return make(spark, [*ODD, "repeated row"] + ["repeated row"], [*range(len(ODD)), 77, 77]).unionByName(make(spark, ["no id", None], [None, None]))


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, (i + 1) % 2) for i in range(8)] + [(3, 1, 0), (4, None, None)], "doc_id long, quality int, toxic int")


def words_of(t):
    return re.findall(r"[^\x20\x09-\x0d]+", t or "")


# ---- the queries with SQL counterparts, and all of them on odd and empty tables


@pytest.mark.parametrize("name", sorted(q.ORACLES))
def test_oracle(spark, name):
    assert_same(q.QUERIES[name](spark, SF), duck(SF), q.ORACLES[name])


def every(spark, docs, labels):
    items = spark.createDataFrame([(1, "repeated row"), (2, None), (None, ""), (1, "tail tail tail tail tail tail")], "item_id long, text string")
    v = piece_codec.load()
    return {
        1: lambda: decontaminate.leaks(docs, items), 2: lambda: quality_fm.quality(docs, labels), 3: lambda: recompression.dedup(docs), 4: lambda: language_id.language(docs),
        5: lambda: piece_codec.encode(docs, v, ["doc_id"], 1000), 6: lambda: quality_rules.quality_rules(docs, labels), 7: lambda: jaccard_join.jaccard_components(docs),
        8: lambda: secret_scan.scan(docs), 9: lambda: line_dedup.line_report(docs), 10: lambda: toxicity.toxicity(docs, labels),
    }


@pytest.mark.parametrize("n", range(1, 11))
def test_odd_rows(spark, odd, labels, n):
    got = every(spark, odd, labels)[n]().collect()
    if n > 1:
        assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in odd.collect())
    else:
        assert sorted((r.doc_id, r.item_id) for r in got) == [(8, 1), (77, 1), (77, 1)]


@pytest.mark.parametrize("n", range(1, 11))
def test_empty_table(spark, labels, n):
    assert every(spark, make(spark, []), labels.limit(0))[n]().count() == 0


# ---- 1


def test_containment_search_is_exact(spark):
    rng = random.Random(1)
    vocab = [f"w{i}" for i in range(60)]
    items = [" ".join(rng.choice(vocab) for _ in range(n)) for n in (1, 3, 4, 5, 8, 20, 40, 41, 70)]
    docs = []
    for _ in range(80):
        body = [rng.choice(vocab) for _ in range(rng.randint(0, 200))]
        if rng.random() < 0.7:
            piece = rng.choice(items).split()
            for j in range(len(piece)):
                if rng.random() < 0.03:
                    piece[j] = rng.choice(vocab)
            at = rng.randint(0, len(body))
            body[at:at] = piece
        docs.append(" ".join(body).upper() if rng.random() < 0.3 else ", ".join(body))
    grams = lambda w, k: {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}
    want = set()
    for j, item in enumerate(items):
        w = item.split()
        k = min(5, len(w))
        own = grams(w, k)
        for i, d in enumerate(docs):
            if len(own & grams(re.findall(r"\w+", d.lower()), k)) >= 0.8 * len(own):
                want.add((i, j))
    table = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    for block in (1_000_000, 40):
        got = decontaminate.leaks(make(spark, docs), table, block_words=block)
        assert {(r.doc_id, r.item_id) for r in got.collect()} == want
    kept = decontaminate.without_leaks(make(spark, docs), table)
    assert kept.columns == make(spark, docs).columns and {r.doc_id for r in kept.collect()} == set(range(len(docs))) - {i for i, _ in want}


# ---- 2, 4, 10: held-out accuracy


@pytest.fixture(scope="module")
def trained(spark):
    sf = "/root/testdata/sf0.01"
    return {n: q.QUERIES[n](spark, sf).toPandas() for n in ("op2_quality_classifier", "op4_language_id", "op6_quality_rules", "op10_toxicity")}, spark.read.parquet(f"{sf}/documents.parquet").toPandas(), spark.read.parquet(f"{sf}/labels.parquet").toPandas()


def test_quality_held_out(trained):
    out, _, labels = trained
    r = out["op2_quality_classifier"].merge(labels, on="doc_id")
    r = r[r.held_out]
    assert (r.predicted == r.quality).mean() > 0.95 and r.score.between(0, 1).all()


def test_language_held_out(trained):
    out, docs, _ = trained
    r = out["op4_language_id"].merge(docs, on="doc_id")
    r = r[r.held_out]
    assert (r.lang_pred == r.lang).mean() > 0.97


def test_toxicity_held_out(trained):
    out, _, labels = trained
    r = out["op10_toxicity"].merge(labels, on="doc_id")
    r = r[r.held_out]
    assert (r.predicted[r.toxic == 0] == 1).mean() < 0.03
    assert (r.predicted[r.toxic == 1] == 1).mean() > 0.6  # learnt from some 30 toxic documents


def test_toxicity_held_out_of_a_larger_table(spark):
    sf = "/root/testdata/sf0.1"
    r = q.op10_toxicity(spark, sf).where("held_out").join(q.table(spark, sf, "labels"), "doc_id").toPandas()
    assert (r.predicted[r.toxic == 0] == 1).mean() < 0.03
    assert (r.predicted[r.toxic == 1] == 1).mean() >= 0.9


def test_rules_held_out(trained):
    out, _, labels = trained
    r = out["op6_quality_rules"].merge(labels, on="doc_id")
    r = r[~r.base_failed & r.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)]  # the fold that fit never learns from
    assert (r.kept == (r.quality == 1)).mean() > 0.95


def test_labels_of_the_fold_never_matter(spark):
    docs, labels = q.table(spark, SF, "documents"), q.table(spark, SF, "labels")
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    got = [sorted(map(tuple, toxicity.toxicity(docs, x).select("doc_id", "score", "held_out").collect())) for x in (labels, flipped)]
    assert got[0] == got[1]
    assert all(h == (zlib.crc32(str(i).encode()) % 4 == 2) for i, _, h in got[0])


def test_other_folds_never_matter(spark):
    docs, labels = q.table(spark, SF, "documents"), q.table(spark, SF, "labels")
    away = lambda n, fold: F.crc32(F.col("doc_id").cast("string")) % n == fold
    flip = labels.withColumn("quality", F.when(away(3, 1), 1 - F.col("quality")).otherwise(F.col("quality")))
    got = [sorted(map(tuple, quality_fm.quality(docs, x).select("doc_id", "score").collect())) for x in (labels, flip)]
    assert got[0] == got[1]
    moved = docs.withColumn("lang", F.when(away(4, 2), F.lit("xx")).otherwise(F.col("lang")))
    got = [sorted(map(tuple, language_id.language(x).select("doc_id", "lang_pred", "score").collect())) for x in (docs, moved)]
    assert got[0] == got[1]
    flip = labels.withColumn("quality", F.when(away(5, 0), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert quality_rules.fit(docs, labels) == quality_rules.fit(docs, flip)


def test_unknown_languages_are_rejected(spark):
    docs = q.table(spark, SF, "documents").select("doc_id", "text", "lang")
    odd = ["今日はとてもいい天気ですね。散歩に行きましょう。", "Сегодня очень хорошая погода, пойдём гулять в парк.", "qzx wvkj pfft zzkq xqjv bbkw qqzt vvkx", None, "", "12 34 !?"]
    both = docs.unionByName(spark.createDataFrame([(10**6 + i, t, None) for i, t in enumerate(odd)], docs.schema))
    got = {r.doc_id: r for r in language_id.language(both).collect()}
    assert all(got[10**6 + i].rejected for i in range(len(odd)))
    assert all((got[10**6 + i].lang_pred, got[10**6 + i].score) == ("und", 0.0) for i in (3, 4, 5))
    own = [got[r.doc_id].rejected for r in docs.where("lang is not null and text is not null").collect()]
    assert sum(own) < 0.05 * len(own)


def test_mean_of_embeddings_by_hand():
    rng = np.random.default_rng(1)
    texts = pa.array(["Ab c", "", "é!x"])
    table, bias = rng.normal(size=(1 << language_id.BITS, 3)).astype(np.float32), rng.normal(size=3)
    buckets, first = language_id.grams(*text_bytes(texts))
    z = language_id._logits(table, bias, buckets, first)
    k = 0x9E3779B1
    for i, t in enumerate(["Ab c", "", "é!x"]):
        x = [language_id.FOLD[b] for b in t.encode()] + [0, 0, 0]
        own = []
        for j in range(len(t.encode())):
            if x[j]:
                two = int(x[j]) | int(x[j + 1]) << 8
                own += [two, two | int(x[j + 2] if x[j + 1] else (x[j + 2])) << 16 | 0x1000000]
        at = [((c if n % 2 == 0 else (c & 0xFFFFFF) + 0x1000000) * k & 0xFFFFFFFF) >> (32 - language_id.BITS) for n, c in enumerate(own)]
        assert z[i] == pytest.approx(table[at].astype(float).mean(0) + bias if at else bias, abs=1e-6)


def test_noisy_or_by_hand():
    rng = np.random.default_rng(2)
    m = toxicity.Model(-3.0, -1.0, (rng.normal(size=1 << toxicity.BITS) * (rng.random(1 << toxicity.BITS) < 0.5)).astype(np.float32))
    texts = ["One two. Three four! five\nsix", "", "alone", "... !!", "a b c. a b c."]
    score, count, _, worst = toxicity.score_rows(m, *text_bytes(pa.array(texts)))
    sig = lambda z: 1 / (1 + np.exp(-z))
    for i, t in enumerate(texts):
        clean, probabilities, n = 1 - sig(m.leak), [0.0], 0
        for s in re.split(r"[.!?\n]", t):
            if not s.split():
                continue
            n += 1
            b = toxicity.sentences(*text_bytes(pa.array([s])))[0]
            if (m.weights[b] != 0).any():
                probabilities.append(sig(m.bias + m.weights[b].astype(float).sum()))
                clean *= 1 - probabilities[-1]
        assert score[i] == pytest.approx(1 - clean) and count[i] == n and worst[i] == pytest.approx(max(probabilities))


def test_scores_do_not_depend_on_neighbours(spark):
    docs, labels = q.table(spark, SF, "documents"), q.table(spark, SF, "labels")
    model = quality_fm.fit(docs, labels)
    texts = [r.text for r in docs.limit(60).collect()]
    together = quality_fm._forward(model, *quality_fm.features(*text_bytes(pa.array(texts))))[0]
    alone = [quality_fm._forward(model, *quality_fm.features(*text_bytes(pa.array([t]))))[0][0] for t in texts]
    assert together.tolist() == alone


def test_identity_of_the_factorisation():
    rng = np.random.default_rng(0)
    texts = pa.array(["one two three two", "", "a b"])
    buckets, first, own = quality_fm.features(*text_bytes(texts))
    m = quality_fm.Model(0.3, rng.normal(size=quality_fm.SIZE), rng.normal(size=(quality_fm.SIZE, 3)))
    y, _ = quality_fm._forward(m, buckets, first, own)
    for i in range(3):
        w = buckets[first[i] : first[i + 1]]
        x = [(b, 1 / max(len(w), 1)) for b in w] + [(b, 1.0) for b in own[i]]
        z = 0.3 + sum(m.linear[b] * v for b, v in x) + sum(m.factors[a] @ m.factors[b] * u * v for n, (a, u) in enumerate(x) for b, v in x[:n])
        assert y[i] == pytest.approx(z)


def test_noisy_or_finds_the_sentence():
    texts = ["fine words here. all good today."] * 60 + [f"fine words here. you vile{i % 3} vile thing. all good." for i in range(30)]
    b, s, d, at = toxicity.sentences(*text_bytes(pa.array(texts)))
    m = toxicity.train(b, s, d, np.array([0] * 60 + [1] * 30))
    score, _, start, worst = toxicity.score_rows(m, *text_bytes(pa.array(["nothing bad. it is vile. end."] + ["clean sentence here. " * 500])))
    assert score[0] > 0.5 and start[0] == len("nothing bad. ") and score[1] < 0.3


# ---- 3


def brute_windows(texts, n=recompression.WINDOW):
    seen = defaultdict(list)
    words = [words_of(t) for t in texts]
    for i, w in enumerate(words):
        for s in range(len(w) - n + 1):
            seen[tuple(w[s : s + n])].append((i, s))
    gone = [set() for _ in texts]
    for places in seen.values():
        if len(places) > 1:
            for i, s in places:
                gone[i].update(range(s, s + n))
    return [(len(w), len(g), " ".join(x for j, x in enumerate(w) if j not in g)) for w, g in zip(words, gone)]


def test_repeated_windows_equal_brute_force(spark):
    import hashlib

    rng = random.Random(3)
    vocab = ["a", "b", "the", "of"] + [f"v{i}" for i in range(30)]
    passage = [rng.choice(vocab) for _ in range(90)]
    texts = [None, "", "x " * 34, "y " * 35, "z " * 36, "run " * 200, "ab cd " * 60]
    for _ in range(60):
        body = [rng.choice(vocab) for _ in range(rng.randint(0, 150))]
        if rng.random() < 0.5:
            a = rng.randint(0, 40)
            body += passage[a : a + rng.choice([33, 34, 35, 36, 50])]
        if rng.random() < 0.3:
            body += [rng.choice("ab")] * rng.randint(1, 80)
        body += [rng.choice(vocab) for _ in range(rng.randint(0, 60))]
        texts.append(rng.choice([" ", "\n", "\t "]).join(body))
    texts += texts[20:24]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in recompression.dedup(make(spark, texts)).collect()}
    for i, (n, gone, kept) in enumerate(brute_windows(texts)):
        assert got[i] == (n, gone, hashlib.sha256(kept.encode()).hexdigest()), i


def test_equal_substrings_are_parsed_alike():
    rng = np.random.default_rng(5)
    middle = rng.integers(0, 6, 60).astype(np.uint64)
    parsed = []
    for _ in range(20):
        a, b = rng.integers(0, 6, rng.integers(0, 30)).astype(np.uint64), rng.integers(0, 6, rng.integers(0, 30)).astype(np.uint64)
        w = np.concatenate([a, middle, b])
        name, start, end, left, right = recompression.parse(w, np.array([0, len(w)]))
        inside = (left >= len(a)) & (right <= len(a) + 60)
        parsed.append({(int(n), int(s) - len(a), int(e) - len(a)) for n, s, e in zip(name[inside], start[inside], end[inside])})
        for n, s, e, l, r in zip(name[inside], start[inside], end[inside], left[inside], right[inside]):
            assert l <= s < e <= r
    assert len(parsed[0]) > 3 and all(p == parsed[0] for p in parsed)


# ---- 5


def test_codec_round_trip_and_best_score(spark):
    v = piece_codec.load()
    rng = random.Random(2)
    texts = ["".join(rng.choice(["the", "and", " ", "  ", "in", "é", "\n", "▁", "日", "q" * 70]) for _ in range(rng.randint(1, 300))) for _ in range(40)] + [t for t in ODD if t]
    docs = make(spark, texts)
    direct = {r.doc_id: r.ids for r in piece_codec.encode(docs, v, ["doc_id"]).collect()}
    split = piece_codec.encode(docs, v, ["doc_id"], chunk_chars=37)
    back = {r.doc_id: r.text for r in piece_codec.decode(split, v, ["doc_id"]).collect()}
    split = {r.doc_id: r.ids for r in split.collect()}
    for i, t in enumerate(texts):
        assert back[i] == t and piece_codec.decode_ids(v, direct[i]) == t
        assert direct[i] == piece_codec.encode_text(v, t)
        best = piece_codec.forward(v, " " + t, 0, len(t) + 1, 0)[0][len(t) + 1]
        assert piece_codec.score_of(v, t, direct[i]) == best == piece_codec.score_of(v, t, split[i])


def test_levels_of_products(spark, monkeypatch):
    monkeypatch.setattr(piece_codec, "FAN", 3)
    v = piece_codec.load()
    text = "the and in qzq  " * 60
    got = piece_codec.encode(make(spark, [text, "nospaces" * 70, text]), v, ["doc_id"], chunk_chars=20)
    assert {r.doc_id: r.text for r in piece_codec.decode(got, v, ["doc_id"]).collect()} == {0: text, 1: "nospaces" * 70, 2: text}


# ---- 6


def brute_stats(t):
    t = t or ""
    w = words_of(t)
    grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if words_of(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(covered)


def test_statistics_equal_brute_force(spark):
    rng = random.Random(6)
    texts = ["".join(rng.choice(["a", "b", "é", " ", " ", "\n", "#", "日"]) for _ in range(rng.randint(0, 120))) for _ in range(80)] + ODD
    got = {r.doc_id: tuple(r)[1:] for r in quality_rules.statistics(make(spark, texts)).collect()}
    assert got == {i: brute_stats(t) for i, t in enumerate(texts)}


def test_decision_list_is_what_it_says(spark):
    rng = np.random.default_rng(8)
    x = {k: rng.integers(0, 1000, 3000) for k in quality_rules.RATES}
    bad = (x["symbols_per_kword"] > 700) | ((x["words"] < 200) & (x["repeats_per_kword"] > 500))
    rules = quality_rules.learn(x, bad)
    hit = np.zeros(3000, bool)
    for r in rules:
        hit |= quality_rules._covers(r, x)
    assert (hit == bad).mean() > 0.97
    df = spark.createDataFrame([tuple(int(x[k][i]) for k in x) for i in range(200)], ", ".join(f"{k} long" for k in x))
    assert [r[0] is not None for r in df.select(quality_rules.verdict(rules)).collect()] == hit[:200].tolist()


# ---- 7 and 9


def closure(n, linked):
    at = list(range(n))

    def find(i):
        while at[i] != i:
            i = at[i]
        return i

    for i, j in linked:
        a, b = find(i), find(j)
        at[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def near_copies(rng, n, size, edits, vocab=400):
    base = [f"w{rng.randrange(vocab)}" for _ in range(size)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("percent, words", [(90, 3), (80, 5)])
def test_components_equal_brute_force(spark, percent, words):
    rng = random.Random(percent)
    texts = [None, "", "one", "One", "one two", "a b c", "A B c d"]
    for size, edits in ((12, 1), (40, 2), (60, 5), (300, 8), (700, 30)):
        texts += near_copies(rng, 25, size, edits)
    texts += texts[40:60] * 2 + ["hot copy of some words here"] * 200
    rng.shuffle(texts)

    def grams(t):
        w = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        w = words_of(w)
        return {tuple(w[i : i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set())

    sets = [grams(t) for t in texts]
    linked = [(i, j) for i in range(len(texts)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    want = closure(len(texts), linked)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(make(spark, texts), percent, words).collect()}
    assert got == {i: (len(s), want[i]) for i, s in enumerate(sets)}
    kept = {r.doc_id for r in jaccard_join.one_of_each(make(spark, texts), percent, words).collect()}
    assert kept == {i for i, s in enumerate(sets) if want[i] == i}


def test_rows_that_repeat_a_doc_id(spark):
    base = " ".join(f"w{i}" for i in range(40))
    texts, ids = [base, "quite another text of its own here", base + " more", base, "", ""], [7, 7, 3, 7, 5, 5]
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(make(spark, texts, ids)).collect())
    assert got == [(3, 39, 3), (5, 0, 5), (5, 0, 5), (7, 5, 7), (7, 38, 3), (7, 38, 3)]
    kept = sorted((r.doc_id, r.text) for r in jaccard_join.one_of_each(make(spark, texts, ids)).collect())
    assert kept == [(3, base + " more"), (5, ""), (5, ""), (7, "quite another text of its own here")]
    kept = sorted((r.doc_id, r.text) for r in jaccard_join.one_of_each(make(spark, ["x y", "x y", "z"], [1, 1, 1])).collect())
    assert kept == [(1, "x y"), (1, "z")]


def test_pigeonhole_at_other_thresholds():
    rng = np.random.default_rng(14)
    for percent in (80, 90):
        for size in (3, 9, 30, 90, 400, 1500):
            for _ in range(12):
                a = np.unique(rng.integers(0, 1 << 62, size).astype(np.uint64))
                most = (100 - percent) * len(a) // 100
                b = np.unique(np.concatenate([a[rng.permutation(len(a))[: len(a) - most]], rng.integers(0, 1 << 62, 0).astype(np.uint64)]))
                both, either = len(np.intersect1d(a, b)), len(np.union1d(a, b))
                if 100 * both >= percent * either:
                    assert len(np.intersect1d(jaccard_join.segment_keys(a, percent), jaccard_join.segment_keys(b, percent)))


def test_extra_columns_with_inner_names(spark):
    rows = spark.createDataFrame([(i, "the same line of text\n" + t, 1, 2, 3, 4) for i, t in enumerate(["one", "two"])], "doc_id long, text string, __gone int, gone int, k int, lost_k int")
    for out in (line_dedup.without_repeated_lines(rows), jaccard_join.one_of_each(rows), toxicity.without_toxic(rows, toxicity.Model(-6.0, -10.0, np.zeros(1 << toxicity.BITS, np.float32)), 0.3)):
        assert out.columns == rows.columns and out.count() == 2
    assert sorted(r.text for r in line_dedup.without_repeated_lines(rows).collect()) == ["the same line of text\none", "two"]


def test_distance_bounds_and_pigeonhole():
    rng = np.random.default_rng(4)
    for _ in range(200):
        a = np.unique(rng.integers(0, 1 << 62, rng.integers(1, 120)).astype(np.uint64))
        keep = a[rng.random(len(a)) > 0.04]
        b = np.unique(np.concatenate([keep, rng.integers(0, 1 << 62, rng.integers(0, 4)).astype(np.uint64)]))
        if not len(b):
            continue
        both, either = len(np.intersect1d(a, b)), len(np.union1d(a, b))
        bits = sum(int(x).bit_count() for x in (jaccard_join.sketch(a) ^ jaccard_join.sketch(b)).view(np.uint64))
        assert bits <= either - both
        if 100 * both >= 90 * either:
            assert len(np.intersect1d(jaccard_join.segment_keys(a, 90), jaccard_join.segment_keys(b, 90)))


def test_union_find(spark):
    rng = random.Random(12)
    edges = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(90), rng.randrange(90)) for _ in range(60)] + [(500, 500 + i) for i in range(1, 80)]
    want = closure(700, edges)
    got = {r.id: r.component for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: want[i] for e in edges if e[0] != e[1] for i in e}


def test_marks_of_lines():
    texts = pa.array(["abcdefgh" * 9, "x", "", "short", "éa" * 30, "the quick brown fox jumps over the lazy dog"])
    n, sketches = line_dedup.line_marks(texts)
    for i, s in enumerate(line_dedup._sets(texts)):
        assert n[i] == len(s) and (sketches[i] == jaccard_join.sketch(s)).all()


def test_lines_equal_brute_force(spark):
    rng = random.Random(21)
    letters = "abcdefghijklmnopqrstuvwxyz    "
    line = lambda n: "".join(rng.choice(letters) for _ in range(n)).strip() or "x"
    bases = [line(n) for n in (3, 9, 30, 70, 85, 150, 400)]

    def vary(t):
        t = list(t)
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            t[rng.randrange(len(t))] = rng.choice(letters)
        return "".join(t)

    texts = ["\n".join([*(vary(rng.choice(bases)) for _ in range(rng.randint(0, 4))), *(line(rng.randint(20, 200)) for _ in range(2)), "", "  "]) for _ in range(50)] + ["hot line of text", None, ""] + ["hot line of text"] * 60
    at = [(i, j, x) for i, t in enumerate(texts) for j, x in enumerate((t or "").split("\n")) if words_of(x)]
    grams = lambda x: {x[i : i + 8] for i in range(len(x) - 7)} or {x}  # noqa: E731  ASCII: eight bytes are eight characters
    sets = [grams(x) for *_, x in at]
    linked = [(a, b) for a in range(len(at)) for b in range(a) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    root = closure(len(at), linked)
    want = defaultdict(set)
    for n, (i, j, _) in enumerate(at):
        if root[n] != n:
            want[i].add(j)
    got = {r.doc_id: {int(x) for x in r.removed.split(",") if x} for r in line_dedup.line_report(make(spark, texts)).collect()}
    missed = sum(len(want[i] - got[i]) for i in got)
    assert sum(len(got[i] - want[i]) for i in got) == 0
    assert missed <= 0.02 * sum(map(len, want.values()))
    kept = {r.doc_id: r for r in line_dedup.without_repeated_lines(make(spark, texts)).collect()}
    for i, t in enumerate(texts):
        left = [x for j, x in enumerate((t or "").split("\n")) if j not in got[i]]
        if got[i] and not any(map(words_of, left)):
            assert i not in kept
        else:
            assert kept[i].text == (t if not got[i] else "\n".join(left)) and (kept[i].n_chars is None or kept[i].n_chars == len(kept[i].text))


@pytest.mark.parametrize("letters", ["абвгдежзийклмн     ", "上下左右东西南北春夏秋冬天地", "αéßñaeiou 東😀"])
def test_lines_in_other_scripts_equal_brute_force(spark, letters):
    rng = random.Random(22)
    texts = ["Глава 12", "Глава 13", "第三章上", "第三章下", "第三章上、第三章の上", "第三章上、第三章の下", "Été 1990é1", "Été 1990é2"]
    for n in (5, 7, 8, 9, 12, 40, 90, 150):
        base = "x" + "".join(rng.choice(letters) for _ in range(n - 2)) + "y"
        texts += [base, base[:-1] + "z", base[:-1] + "上", base[:-1] + "下", base[: n // 2] + "é" + base[n // 2 + 1 :]]
    # each line's set: every eight characters
    data, offsets = text_bytes(pa.array(texts))
    h, line = line_dedup.line_shingles(data, offsets[:-1], offsets[1:])
    sets = [{x[i : i + 8] for i in range(len(x) - 7)} or {x} for x in texts]
    named = defaultdict(set)
    for i, x in enumerate(texts):
        for g, v in zip([x[j : j + 8] for j in range(len(x) - 7)] or [x], h[line == i].tolist(), strict=True):
            named[g].add(v)
    assert all(len(v) == 1 for v in named.values()) and len(set().union(*named.values())) == len(named)
    root = closure(len(texts), [(a, b) for a in range(len(texts)) for b in range(a) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])])
    want = {i for i in range(len(texts)) if root[i] != i}
    got = {r.doc_id for r in line_dedup.line_report(make(spark, texts)).collect() if r.n_removed}
    assert not got - want and len(want - got) <= 1 and not got & set(range(8))


def test_repetitive_lines_meet_across_the_border_of_signatures(spark):
    # few distinct shingles, many positions: 64 and 80 positions are the borders
    repeats = [["-" * 70, "-" * 90, "-" * 3000], ["ha " * 20 + "ha", "ha " * 40 + "ha"], ["1" + "." * 55 + "7", "1" + "." * 200 + "7"], ["buy one now, get two! " * 3 + "!", "buy one now, get two! " * 9 + "!"]]
    texts = [x for group in repeats for x in group]
    data, offsets = text_bytes(pa.array(texts))
    h, line = line_dedup.line_shingles(data, offsets[:-1], offsets[1:])
    keys = [set(k) for k in line_dedup.band_keys(h, line, len(texts)).to_pylist()]
    i = 0
    for group in repeats:
        assert all(keys[i] & keys[i + j] for j in range(1, len(group))), group[0]
        assert not any(keys[i] & k for j, k in enumerate(keys) if not i <= j < i + len(group))
        i += len(group)
    got = {r.doc_id for r in line_dedup.line_report(make(spark, texts)).collect() if r.n_removed}
    assert got == set(range(len(texts))) - {0, 3, 5, 7}
    # the number that decides is that of the distinct shingles
    rng = random.Random(23)
    texts = ["".join(rng.choice("abcdefgh") for _ in range(d)) * k for d in (5, 60, 63, 64, 79, 80, 90, 127, 128, 200) for k in (1, 2, 3, 30)] + ["x" * 300 + "".join(rng.choice("abcdefgh") for _ in range(d)) for d in (10, 70, 300)]
    data, offsets = text_bytes(pa.array(texts))
    h, line = line_dedup.line_shingles(data, offsets[:-1], offsets[1:])
    n = [len({t[i : i + 8] for i in range(max(len(t) - 7, 1))}) for t in texts]
    assert [(x >= 64, x < 80) for x in line_dedup.distinct_counts(h, line, len(texts)).tolist()] == [(x >= 64, x < 80) for x in n]


# ---- 8


def test_ledger_scans_each_blob_once(spark, tmp_path):
    ledger = str(tmp_path / "ledger")
    first = make(spark, ["password = hunter22 x", "nothing", "password = hunter22 x", None])
    got = {r.doc_id: r for r in secret_scan.scan(first, ledger).collect()}
    assert got[0].spans == got[2].spans == "assign:0:19" and got[1].spans == got[3].spans == ""
    before = spark.read.parquet(ledger).count()
    assert before == 3
    more = make(spark, ["nothing", "token: abcdef AKIA" + "Z" * 16], [10, 11])
    got = {r.doc_id: r for r in secret_scan.scan(more, ledger).collect()}
    assert spark.read.parquet(ledger).count() == before + 1
    assert (got[11].n_assign, got[11].n_access, got[11].spans) == (1, 1, "assign:0:13,access:14:34")


def test_spans_equal_python(spark):
    rng = random.Random(30)
    bits = ["password", "PassWd", " = ", ":", '"', "'", "api_key", "APIKEY", "secret", "token", "abcdef12", "x" * 5, "AKIA", "Q7" * 9, "0123456789abcdef" * 2, "é", " ", "\n", "-----BEGIN RSA PRIVATE KEY-----", "ghp_" + "a1" * 18, "eyJ" + "a" * 9 + "." + "b" * 9 + "." + "c" * 9]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for _ in range(150)]
    got = {r.doc_id: r.spans for r in secret_scan.scan(make(spark, texts)).collect()}
    for i, t in enumerate(texts):
        spans = []
        for n, (kind, p) in enumerate(secret_scan.RULES.items()):
            spans += [(m.start(), n, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(p, t) if kind != "assign" or len(m[2]) >= 6]
        assert got[i] == ",".join(x for *_, x in sorted(spans)), t


# ---- the pipeline


def test_pipeline(spark):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in p.STAGES] == ["toxicity", "line_dedup", "ngram_jaccard_join", "decontamination", "sentencepiece"]
    now = docs
    for name, stage in p.STAGES[:-1]:
        after = stage(spark, now, SF)
        assert after.columns == docs.columns, name
        after = spark.createDataFrame(after.collect(), after.schema)
        assert set(r.doc_id for r in after.select("doc_id").collect()) <= set(r.doc_id for r in now.select("doc_id").collect())
        now = after
    out = p.run(spark, SF)
    v = piece_codec.load()
    texts = {r.doc_id: r.text for r in now.collect()}
    got = {r.doc_id: piece_codec.decode_ids(v, r.ids) for r in out.collect()}
    assert got == texts and 0.5 * docs.count() < len(got) < docs.count()


def test_pipeline_on_odd_rows(spark, odd, labels, tmp_path):
    import corpus_pipeline as p

    d = str(tmp_path)
    labels.write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, "unrelated words that no document has at all")], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    for rows in (odd, odd.limit(0)):
        now = rows
        for name, stage in p.STAGES:
            after = stage(spark, now, d)
            if name != "sentencepiece":
                assert after.columns == rows.columns
            now = spark.createDataFrame(after.collect(), after.schema)
