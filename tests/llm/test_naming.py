"""Exact copies against a plain dictionary of whole texts."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tenura.llm.naming import exact_copies, without_copies


def plain(text):
    return re.sub("[\x20\x09-\x0d]", "", text or "")


def expected(rows):
    groups = {}
    for key, text in rows:
        groups.setdefault(plain(text), []).append((key, text or ""))
    out = []
    for name, members in groups.items():
        keep = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))[0]
        digest = hashlib.sha256(name.encode()).hexdigest()
        out += [(key, keep, len(members), key == keep, digest) for key, _ in members]
    return sorted(out, key=str)


def found(df):
    assert df.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("block_bytes", [1, 3, 1024])
def test_against_a_dictionary(spark, documents, block_bytes):
    rng = random.Random(5)
    texts = ["", None, " \t\n", "a", "a ", "ab", "a b", "aab", "é", "e", " ", "a" * 40, "a " * 40, "ab" * 20, "x" * 3000, "x" * 2999 + "y"]
    texts += ["".join(rng.choice("ab ") for _ in range(rng.randrange(9))) for _ in range(200)]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    df = documents([(k, t, "s") for k, t in rows], partitions=5)
    assert found(exact_copies(df, block_bytes=block_bytes, held_bytes=50)) == expected(rows)


def test_long_texts_that_differ_in_one_place(spark, documents):
    rng = random.Random(1)
    base = "".join(rng.choice("abcdefgh ") for _ in range(40_000))
    rows = [(i, base[:i * 997] + "Z" + base[i * 997 + 1:]) for i in range(30)]
    rows += [(100 + i, base[: 20_000 + i]) for i in range(10)] + [(200, base), (201, base.replace(" ", "  ")), (202, base.replace(" ", ""))]
    df = documents([(k, t, "s") for k, t in rows])
    assert found(exact_copies(df, block_bytes=64)) == expected(rows)


def test_hot_group_and_repeated_rows(spark, documents, clashing):
    rows = [(i, "one text of many" if i % 3 else f"text {i}") for i in range(600)]
    rows += [(7, "one text of  many")] * 2 + [(None, "one text of many")]
    df = clashing(documents([(k, t, "s") for k, t in rows], partitions=7))
    told = exact_copies(df).collect()
    hot = [r for r in told if r.group_size > 1]
    assert len(told) == 603 and len(hot) == 403 and {r.keep_id for r in hot} == {7}
    assert sum(r.kept for r in hot) == 1
    assert sum(r.kept for r in told) == 201


def test_empty_table_and_null_ids(spark, documents):
    assert exact_copies(documents([(1, "a", "s")]).filter("doc_id < 0")).collect() == []
    rows = [(None, "a b"), (3, "ab"), (None, "q")]
    df = documents([(k, t, "s") for k, t in rows])
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_copies(df).collect() if r.doc_id) == [(3, None, 2, False)]


def test_without_copies_keeps_whole_rows(spark, documents):
    df = documents([(1, "a b", "s"), (2, "a  b", "s"), (3, "c", "s"), (4, "c", "t")])
    assert sorted((r.doc_id, r.text) for r in without_copies(df).collect()) == [(2, "a  b"), (3, "c")]


def test_distinct_blocks_leave_a_task_once(spark, documents):
    from tenura.llm.naming import _spell

    df = documents([(i, "abcd" * 100, "s") for i in range(50)], partitions=1)
    spelled = _spell(df, "doc_id", "text", 4, 1 << 20)
    assert spelled.filter(F.col("at").isNotNull()).count() == 1
