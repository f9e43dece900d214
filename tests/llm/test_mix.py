"""The mix against hand-made targets and brute-force counts."""

import re

import pytest
from pyspark.sql import functions as F

from tenura.llm import mix

WORDS = re.compile("[^\x20\x09-\x0D]+")


def targets(sizes):
    """The contract's own words: share by weight, stop at twice the size, share the excess again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    budget, done = 1.5 * sum(sizes.values()), {}
    while True:
        left = budget - sum(done.values())
        open_ = [s for s in names if s not in done]
        total = sum(weight[s] for s in open_)
        target = {s: left * weight[s] / total for s in open_} if total else {}
        over = [s for s in open_ if target[s] > 2 * sizes[s] + 1e-9]
        if not over:
            return done | target
        done |= {s: 2.0 * sizes[s] for s in over}


def corpus():
    rows = [(i, "w " * (i * 7 % 90), f"s{i % 5}") for i in range(150)]
    rows += [(200, "x" * 9 + " long" * 5000, "s1"), (201, None, "s1"), (202, "", "s2"), (203, " \t\x0b one two　three ", None), (204, "é b c", "S0"), (205, "a b", "")]
    return rows


@pytest.mark.parametrize("block", [1, 4, 16, 256])
def test_counts(spark, documents, clashing, block):
    rows = corpus()
    docs = clashing(documents(rows))
    size = {i: len(WORDS.findall(t or "")) for i, t, _ in rows}
    sizes = {}
    for i, _, s in rows:
        sizes[s] = sizes.get(s, 0) + size[i]
    want = targets(sizes)
    got = mix.words_taken(docs, block_words=block, shard_slots=8).collect()
    assert len(got) == len(rows)
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]]) and 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 0.5 + 1e-6


def test_same_rows_same_mix(documents):
    first = {tuple(r) for r in mix.mixture(documents(corpus(), 1), block_words=8, shard_slots=16)[2].collect()}
    second = {tuple(r) for r in mix.mixture(documents(corpus()[::-1], 7), block_words=8, shard_slots=16)[2].collect()}
    other = {tuple(r) for r in mix.mixture(documents(corpus(), 1), block_words=8, shard_slots=16, seed=2)[2].collect()}
    assert first == second != other


def test_permutations(spark):
    for n in (1, 2, 3, 10, 257, 1000):
        df = spark.range(n).select("id", mix.permuted(F.col("id"), F.lit(n), F.lit(5), F.lit(1)).alias("x"))
        found = [r["x"] for r in df.orderBy("id").collect()]
        assert sorted(found) == list(range(n))
        if n > 100:
            assert found != list(range(n)) and sum(a == b for a, b in enumerate(found)) < n / 20


def test_shards_are_drawn_by_share(documents):
    docs = documents([(i, "w " * 64, f"s{i % 3}") for i in range(300)])
    documents_, sources, _ = mix.mixture(docs, block_words=8, shard_slots=100)
    slots = mix.drawn_slots(sources, 8, 100, 1)
    counts = {}
    for r in slots.collect():
        counts.setdefault(r["shard"], {}).setdefault(r["rank"], 0)
        counts[r["shard"]][r["rank"]] += 1
    total = sum(sum(c.values()) for c in counts.values())
    share = {k: sum(c.get(k, 0) for c in counts.values()) / total for k in (1, 2, 3)}
    full = [c for c in counts.values() if sum(c.values()) >= 90]
    assert len(full) >= 0.8 * total / 100
    assert len({tuple(sorted(c.items())) for c in full}) > 5  # draws differ from shard to shard
    for c in full:
        for k in share:
            assert abs(c.get(k, 0) - 100 * share[k]) < 30


def test_texts_follow_the_mix(documents, clashing):
    rows = corpus()
    docs = clashing(documents(rows))
    taken = {r["doc_id"]: r["taken"] for r in mix.words_taken(docs, block_words=16).collect()}
    out = mix.mixed_documents(docs, block_words=16)
    assert out.columns == docs.columns
    found, text = {}, {i: t for i, t, _ in rows}
    for r in out.collect():
        words = WORDS.findall(r["text"])
        assert r["n_chars"] == len(r["text"]) and words
        if len(words) == len(WORDS.findall(text[r["doc_id"]])):
            assert r["text"] == text[r["doc_id"]]
        found[r["doc_id"]] = found.get(r["doc_id"], 0) + len(words)
    assert found == {i: n for i, n in taken.items() if n}


def test_edges(documents):
    assert mix.words_taken(documents([])).count() == 0
    assert mix.mixed_documents(documents([])).count() == 0
    assert [r["taken"] for r in mix.words_taken(documents([(1, None, "a"), (2, " ", "b")])).collect()] == [0, 0]
    repeated = mix.words_taken(documents([(1, "a b", "s")] * 4 + [(1, "c", "s"), (None, "d e", None)])).collect()
    assert sorted((r["doc_id"] or 0, r["size"]) for r in repeated) == [(0, 2), (1, 1), (1, 2)]
    alone = mix.words_taken(documents([(1, "a b c", "s")])).collect()[0]
    assert (alone["target"], alone["taken"]) == (4.5, 5) or alone["taken"] == 4
