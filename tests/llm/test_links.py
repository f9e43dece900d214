"""Jaccard links, components and shingles against brute force."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tenura.llm import jaccard
from tenura.llm.components import Forest, components
from tenura.llm.shingles import shingle_sets, word_hashes

WORDS = re.compile("[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORDS.findall((text or "").translate(LOWER))


def shingles(text, n):
    w = words(text)
    return {tuple(w[j : j + n]) for j in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def brute(rows, n, percent):
    sets = {}
    for i, text in rows:
        sets.setdefault(i, []).append(shingles(text, n))
    forest, ids = Forest(), [(i, s) for i, many in sets.items() for s in many]
    for x, (i, a) in enumerate(ids):
        for j, b in ids[:x]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                forest.unite(i, j)
    return sorted((i, len(s), forest.root(i)) for i, s in ids)


def corpus(seed=1, n=60):
    draw = random.Random(seed)
    vocabulary = ["w%d" % k for k in range(300)]
    line = "the very same line of boilerplate in each of them"
    texts = [None, "", " ", "A", "a", "a B", "A b", "a b c", "x" * 500, "É b c d", "é b c d", line, line + " once", "o " * 40]
    for _ in range(n):
        text = [draw.choice(vocabulary) for _ in range(draw.choice([3, 8, 12, 20, 30, 60, 200, 700]))]
        texts.append(" ".join(text))
        for _ in range(draw.randrange(4)):
            other = list(text)
            for _ in range(draw.randrange(1 + len(text) // 30)):
                other[draw.randrange(len(other))] = draw.choice(vocabulary)
            if draw.random() < 0.3:
                other += line.split()
            texts.append("\n ".join(other).upper() if draw.random() < 0.3 else " ".join(other))
    return texts


def test_shingles_are_sets_of_words():
    texts = corpus() + ["é b c d e", "a\x0bb\x0cc\rd", "\x1c a \x85 b"]
    for n in (1, 2, 3, 5):
        got = shingle_sets(pa.array(texts), n)
        names = {}
        for text, found in zip(texts, got, strict=True):
            want = shingles(text, n)
            assert len(found) == len(want)
            # equal sets and only they have equal hashes
            assert names.setdefault(frozenset(want), found.tobytes()) == found.tobytes()
        assert len(set(names.values())) == len(names)
    hashes, owner = word_hashes(pa.array(texts))
    seen = {}
    flat = [w for t in texts for w in words(t)]
    assert len(flat) == len(hashes)
    for w, h in zip(flat, hashes.tolist(), strict=True):
        assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)
    assert owner.tolist() == [i for i, t in enumerate(texts) for _ in words(t)]


@pytest.mark.parametrize(("n", "percent", "most"), [(3, 90, 10**6), (5, 80, 10**6), (3, 90, 800), (2, 50, 500), (1, 100, 10**6)])
def test_links(spark, documents, clashing, monkeypatch, n, percent, most):
    monkeypatch.setattr(jaccard, "LEAF_SETS", 8)
    monkeypatch.setattr(jaccard, "BLOCK_SETS", 16)
    texts = corpus(n)
    rows = list(zip(random.Random(2).sample(range(1000), len(texts)), texts, strict=True))
    docs = clashing(documents([(i, t, "s") for i, t in rows]))
    got = jaccard.linked_documents(docs, jaccard.Rule(n, percent), most).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, n, percent)


def test_local_joins_by_pivots(monkeypatch):
    monkeypatch.setattr(jaccard, "LEAF_SETS", 4)
    rule = jaccard.Rule(3, 80)
    texts = [t for t in corpus(9, 80) if words(t)]
    links = jaccard.cluster_links(list(range(len(texts))), shingle_sets(pa.array(texts), 3), rule)
    forest = Forest()
    for a, b in links:
        forest.unite(a, b)
    assert [(i, len(shingles(t, 3)), forest.root(i)) for i, t in enumerate(texts)] == brute(list(enumerate(texts)), 3, 80)


def test_linked_sets_agree_in_a_bucket():
    draw = random.Random(4)
    for percent in (50, 80, 90, 97):
        rule = jaccard.Rule(1, percent)
        for _ in range(150):
            n = draw.choice([2, 5, 10, 19, 20, 33, 100, 400])
            a = [f"w{draw.randrange(10**6)}" for _ in range(n)]
            b = list(a)
            for _ in range(draw.randrange(1 + n // 5)):
                if draw.random() < 0.5 and len(b) > 1:
                    b.pop(draw.randrange(len(b)))
                else:
                    b.append(f"v{draw.randrange(10**6)}")
            x, y = set(a), set(b)
            if x != y and 100 * len(x & y) >= percent * len(x | y):
                keys, owner = jaccard.bucket_keys(shingle_sets(pa.array([" ".join(a), " ".join(b)]), 1), rule)
                assert set(keys[owner == 0].tolist()) & set(keys[owner == 1].tolist())


def test_edges(documents):
    assert jaccard.linked_documents(documents([])).count() == 0
    rows = [(1, "a b c d", "s"), (1, "a b c d", "s"), (None, "a b c d", "s"), (3, "A b C d", "s"), (1, "q r s t", "s"), (2, "q r s t", "s"), (9, None, "s"), (8, "", "s")]
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.linked_documents(documents(rows)).collect()), key=str)
    assert got == sorted([(1, 2, 1), (1, 2, 1), (1, 2, 1), (2, 2, 1), (3, 2, 1), (8, 0, 8), (9, 0, 9), (None, 2, None)], key=str)


def test_hot_keys_leave_a_task_once():
    draw = random.Random(3)
    rows = [(k, i) for i in range(5000) for k in (draw.randrange(10**9), *(range(20) if i % 3 == 0 else ()))]
    rows += [(draw.randrange(2000) + 10**10, draw.randrange(-3000, 5000)) for _ in range(2000)]
    rows += rows[:50]
    keys, ids = jaccard.chained(*(np.array(x, np.int64) for x in zip(*rows, strict=True)))
    roots = []
    for table in (rows, list(zip(keys.tolist(), ids.tolist(), strict=True))):
        forest, holder = Forest(), {}
        for k, i in table:
            forest.unite(holder.setdefault(k, i), i)
        roots.append({i: forest.root(i) for _, i in rows})
    assert roots[0] == roots[1]
    assert {k for k, _ in rows} <= set(keys.tolist())
    assert max(np.unique(keys, return_counts=True)[1]) <= 2


def test_near_copies_under_a_repeated_id(documents):
    a, b = (" ".join(f"{x}{k}" for k in range(200)) for x in "ab")
    rows = [(3, a), (5, a), (5, b), (8, b + " end"), (2, "a text of its own"), (2, "another text of its own"), (7, "another text of its own")]
    got = jaccard.linked_documents(documents([(i, t, "s") for i, t in rows])).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, 3, 90)


@pytest.mark.parametrize("seed", [3, 4])
def test_links_of_repeated_ids(spark, documents, seed):
    texts = corpus(seed)
    draw = random.Random(seed)
    rows = [(draw.randrange(len(texts) // 2), t) for t in texts]
    got = jaccard.linked_documents(documents([(i, t, "s") for i, t in rows])).collect()
    want = brute(rows, 3, 90)
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got if r["n_shingles"]) == [r for r in want if r[1]]


def test_one_of_each_group_stays(documents, clashing):
    base = " ".join(f"w{k}" for k in range(100))
    rows = [(5, base, "s"), (3, base + " end", "s"), (9, base, "s"), (1, "other text of its own", "s"), (2, None, "s"), (4, "", "s"), (None, base, "s"), (1, "other text of its own", "s")]
    kept = jaccard.first_of_groups(clashing(documents(rows)), jaccard.Rule(5, 80))
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted(
        [(3, base + " end"), (1, "other text of its own"), (2, None), (4, ""), (None, base)], key=str
    )


def test_components_of_any_shape(spark):
    draw = random.Random(8)
    chain = [(k, k + 1) for k in range(300)]
    star = [(1000, 1000 + k) for k in range(1, 200)]
    loose = [(draw.randrange(2000, 2400), draw.randrange(2000, 2400)) for _ in range(220)]
    edges = chain + star + loose + [(5000, 5000)]
    forest = Forest()
    for a, b in edges:
        forest.unite(a, b)
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    df = spark.createDataFrame(edges, "a long, b long").repartition(7)
    assert {tuple(r) for r in components(df).collect()} == {(x, forest.root(x)) for x in nodes}
    assert components(df.limit(0)).count() == 0


@pytest.mark.parametrize("rule", [jaccard.Rule(), jaccard.Rule(words=5, percent=80)])
def test_short_unrelated_texts_stay_apart(rule):
    """100,000 texts of 6 to 30 words: what hangs together by keys is at most five of them."""
    draw = np.random.default_rng(8)
    forest, seen = Forest(), {}
    for at in range(0, 100_000, 20_000):
        texts = [" ".join(map(str, draw.integers(0, 5000, draw.integers(6, 31)))) for _ in range(20_000)]
        keys, owners = jaccard.bucket_keys(shingle_sets(pa.array(texts), rule.words), rule)
        for key, owner in zip(keys.tolist(), (owners + at).tolist(), strict=True):
            forest.unite(seen.setdefault(key, owner), owner)
    sizes = {}
    for i in range(100_000):
        sizes[forest.root(i)] = sizes.get(forest.root(i), 0) + 1
    assert max(sizes.values()) <= 5


@pytest.mark.parametrize("percent", [60, 80, 90, 95])
def test_short_linked_sets_share_a_key(percent):
    rule, draw = jaccard.Rule(words=1, percent=percent), random.Random(percent)
    for _ in range(3000):
        a = draw.sample(range(10**6), draw.randrange(1, rule.short() + 12))
        b = [x for x in a if draw.random() > (100 - percent) / 250] + draw.sample(range(10**6, 2 * 10**6), draw.randrange(1 + len(a) * (100 - percent) // 150))
        if a != b and b and 100 * len(set(a) & set(b)) >= percent * len(set(a) | set(b)) and set(a) != set(b):
            keys, owner = jaccard.bucket_keys(shingle_sets(pa.array([" ".join(map(str, x)) for x in (a, b)]), 1), rule)
            assert set(keys[owner == 0].tolist()) & set(keys[owner == 1].tolist())


def one_region(spark, texts, rule):
    sets = shingle_sets(pa.array(texts), rule.words)
    rows = [(0, i, len(s), s.tobytes()) for i, s in enumerate(sets)]
    return spark.createDataFrame(rows, "region long, doc_id long, n long, shingles binary")


def test_large_regions_come_apart_by_other_hashes(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "LARGE_SETS", 50)
    draw, rule = random.Random(5), jaccard.Rule()
    texts = [" ".join(str(draw.randrange(10**6)) for _ in range(80)) for _ in range(200)]
    texts += [t + " end" for t in texts[:100]]  # linked with the first hundred
    got = {r["doc_id"]: r["region"] for r in jaccard.refined(one_region(spark, texts, rule), rule, 10**6).collect()}
    assert got == {i: i % 200 for i in [*range(100), *range(200, 300)]}
    alike = ["x " + texts[0]] * 60
    kept = jaccard.refined(one_region(spark, alike, rule), rule, 10**6).collect()
    assert sorted((r["region"], r["doc_id"]) for r in kept) == [(0, i) for i in range(60)]


def test_regions_that_pivots_cannot_split_are_compared_once(spark):
    draw, rule = random.Random(6), jaccard.Rule()
    texts = [" ".join(str(draw.randrange(10**6)) for _ in range(40)) for _ in range(100)]
    small, stuck, _ = jaccard.split_large(one_region(spark, texts, rule), rule, 500)
    assert small.count() == 0
    assert sorted(r["doc_id"] for r in stuck.select("doc_id").collect()) == list(range(100))


def test_copies_do_not_meet(spark, documents):
    """Copies in other tasks: their keys tie nothing together."""
    draw = random.Random(7)
    texts = [" ".join(str(draw.randrange(10**6)) for _ in range(60)) for _ in range(5)]
    rows = documents([(10 * k + i, t, "s") for k in range(6) for i, t in enumerate(texts)])
    assert jaccard.meeting_sets(rows.repartition(6, F.floor(F.col("doc_id") / 10)), jaccard.Rule()).count() == 0
    got = jaccard.linked_documents(rows).collect()
    assert {(r["doc_id"], r["component_id"]) for r in got} == {(10 * k + i, i) for k in range(6) for i in range(5)}
