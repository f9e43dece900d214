"""Suffix arrays and the removal of repeated passages against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest

from tenura.llm import suffix


def brute(rows, length):
    first, out = set(), {}
    for i, text in sorted(rows):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            window = raw[p : p + length]
            if window in first:
                gone[p : p + length] = b"\x01" * length
            first.add(window)
        kept = bytes(x for x, g in zip(raw, gone, strict=True) if not g)
        out[i] = (len(raw), sum(gone), len(re.findall(b"\x01+", bytes(gone))), hashlib.sha256(kept).hexdigest(), kept)
    return out


def corpus(seed=3, n=50):
    draw = random.Random(seed)
    passage = "".join(draw.choice("abcd é") for _ in range(700))
    rows = []
    for i in range(n):
        text = "".join(draw.choice("abc xyz\n") for _ in range(draw.choice([0, 5, 99, 100, 101, 300, 900])))
        for _ in range(draw.randrange(4)):
            a, c = draw.randrange(600), draw.randrange(len(text) + 1)
            text = text[:c] + passage[a : a + draw.randrange(60, 220)] + text[c:]
        rows.append((i, text))
    more = ["a" * 500, "a" * 101, "ab" * 300, passage, passage, passage[5:], "a" * 99, "", None, "\x00" * 150, "\x00" * 120]
    return rows + [(1000 - k, t) for k, t in enumerate(more)]


@pytest.mark.parametrize(("length", "many", "shard"), [(100, 2048, 1 << 21), (100, 2, 3000), (40, 3, 2000), (17, 2048, 1 << 21), (9, 2048, 1 << 21), (100, 2048, 500)])
def test_removal(spark, documents, clashing, monkeypatch, length, many, shard):
    monkeypatch.setattr(suffix, "MANY", many)
    monkeypatch.setattr(suffix.repeated_windows, "__defaults__", (shard,))
    monkeypatch.setattr(suffix, "COMBINE", 4000)
    monkeypatch.setattr(suffix, "CHUNK", 20 if many < 10 else 1 << 15)
    rows = corpus(length)
    docs = clashing(documents([(i, t, "s") for i, t in rows]))
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix.removed_passages(docs, length).collect()}
    want = brute(rows, length)
    assert got == {i: w[:4] for i, w in want.items()}


def test_texts_without_repeats(documents, clashing):
    rows = corpus(7)
    docs = clashing(documents([(i, t, "s") for i, t in rows]))
    out = suffix.without_repeats(docs)
    assert out.columns == docs.columns
    got = {r["doc_id"]: r for r in out.collect()}
    for i, (n, removed, _, _, kept) in brute(rows, 100).items():
        text = dict(rows)[i]
        if text and not kept:
            assert i not in got
        else:
            assert (got[i]["text"] or "") == kept.decode("utf-8", "ignore")
            assert text is None or got[i]["n_chars"] == len(got[i]["text"])


def test_edges(documents):
    assert suffix.removed_passages(documents([])).count() == 0
    text = "abc" * 50 + "".join(map(str, range(100)))
    rows = [(7, text, "s"), (7, text, "s"), (None, text, "s"), (7, "x" + text, "s")]
    got = suffix.removed_passages(documents(rows)).collect()
    assert len(got) == 3  # rows that repeat id and text are one
    first = [r for r in got if r["doc_id"] is None]
    assert first[0]["n_removed"] < len(text)  # a null id comes first, and keeps its text's unique part
    assert sorted(r["n_bytes"] - r["n_removed"] for r in got if r["doc_id"] == 7) == [0, 1]


@pytest.mark.parametrize("text", [b"", b"a", b"banana", b"aaaaaaaaaaaaaaaaaaaaaa", b"mississippi" * 9, b"\x00\x00\x01\x00", b"ab\x00" * 7, bytes(range(256)) * 2])
def test_suffix_arrays(text):
    data = np.frombuffer(text, np.uint8)
    order = suffix.suffix_order(data)
    assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
    for pieces in (1, 3):
        cuts = np.linspace(0, len(text), pieces + 1).astype(int)
        shared = suffix.common_prefixes(data, order, cuts[:-1], np.diff(cuts), 12)
        for a, b in zip(order.tolist(), order[1:].tolist(), strict=False):
            n = 0
            while n < 12 and max(a, b) + n < len(text) and text[a + n] == text[b + n]:
                n += 1
            assert shared[b] == n


def test_random_suffix_arrays():
    draw = random.Random(1)
    for _ in range(60):
        text = bytes(draw.choice(b"ab\x00\xff") for _ in range(draw.randrange(1, 400)))
        assert suffix.suffix_order(np.frombuffer(text, np.uint8)).tolist() == sorted(range(len(text)), key=lambda i: text[i:])


def test_equal_windows_have_equal_anchors():
    draw = random.Random(6)
    text = bytes(draw.choice(b"abcd") for _ in range(3000))
    text += text[500:900] + b"a" * 300 + text[100:230]
    data = np.frombuffer(text, np.uint8)
    where = set(suffix.anchors(data, np.array([0, 1500, 1500, len(text)]), 100).tolist())
    offsets = {}
    for low, high in ((0, 1500), (1500, len(text))):
        for p in range(low, high - 99):
            inside = tuple(a - p for a in range(p, p + 100 - suffix.GRAM + 1) if a in where)
            assert inside
            # anchors may differ by what neighbours add, but the smallest is common
            known = offsets.setdefault(text[p : p + 100], set(inside))
            known &= set(inside)
            assert known


def test_union_of_spans():
    draw = random.Random(2)
    for _ in range(50):
        rows = [(draw.randrange(3), draw.randrange(60), draw.randrange(1, 9)) for _ in range(draw.randrange(25))]
        covered = {(k, x) for k, p, s in rows for x in range(p, p + s)}
        k, p, s = suffix.union(*(np.array([r[i] for r in rows], np.int64) for i in range(3)))
        found = [(a, x) for a, b, c in zip(k.tolist(), p.tolist(), s.tolist(), strict=True) for x in range(b, b + c)]
        assert len(found) == len(set(found)) and set(found) == covered
        assert all(a != c or b + d < e for a, b, d, c, e in zip(k, p, s, k[1:], p[1:], strict=False))


def test_shards_merge_by_binary_search():
    draw = random.Random(5)
    content = [bytes(draw.choice(b"ab") for _ in range(draw.randrange(10, 40))) for _ in range(60)]
    key, place = np.arange(60) // 2, np.zeros(60, np.int64)
    place[1::2] = 1000
    shards = [suffix.build_shard(content[i : i + 20], key[i : i + 20], place[i : i + 20], 10) for i in (40, 0, 20)]
    keys, places = suffix.merge_shards(shards)
    first, want = {}, set()
    starts = sorted((k, p + o, c[o : o + 10]) for k, p, c in zip(key.tolist(), place.tolist(), content, strict=True) for o in range(len(c) - 9))
    for k, p, window in starts:
        if first.setdefault(window, (k, p)) != (k, p):
            want.add((k, p))
    assert set(zip(keys.tolist(), places.tolist(), strict=True)) == want
