"""Ids, packing, bit-packed files and token attribution against the tokenizer itself."""

import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tenura.llm import bitpack, pack, spans
from tenura.llm.tokens import PIECE_BYTES, Encoder, vocabulary_path

ODD = [
    None, "", "a", " a", "a ", "  a", "a  b", "a   b\n c", "\n", " \n x", "it's 's a'll 'S", "é 中文 😀 ok <|endoftext|> x",
    "x \x1c y", "x \x85y", "ab\t c  \t d", " 　a", "naïve\nÜber 12.5% (x)", "a" * 3000, "word " * 3000, "é" * 50,
]


@pytest.fixture(scope="module")
def encode():
    return Encoder(vocabulary_path())


def plain(encode, text):
    return encode.tokenizer.encode(text or "", add_special_tokens=False)


def random_texts(n):
    draw = random.Random(5)
    parts = [" ", "\n", "a", "'s", "1", "é", "\t", " ", "\x85", "\x1f", "!", "😀", " a", "'", "ll", "×", "the", " ", " of"]
    return ["".join(draw.choice(parts) for _ in range(draw.randrange(40))) for _ in range(n)]


def test_ids_are_the_tokenizers(encode):
    texts = ODD + random_texts(3000)
    for text, ids in zip(texts, encode.ids(texts), strict=True):
        assert ids.tolist() == plain(encode, text).ids
    assert encode.ids([]) == []
    sliced = pa.array(ODD).slice(3, 5)
    assert [x.tolist() for x in encode.ids(sliced)] == [plain(encode, t).ids for t in ODD[3:8]]


def test_memo_may_be_small(encode):
    tiny = Encoder(vocabulary_path(), memo_chunks=2)
    texts = random_texts(50)
    for _ in range(2):
        assert [x.tolist() for x in tiny.ids(texts)] == [plain(encode, t).ids for t in texts]


def test_memo_keeps_no_python_objects():
    draw = random.Random(8)
    words = ["".join(draw.choice("etaoinshrdlu") for _ in range(9)) for _ in range(50_000)]
    fresh = Encoder(vocabulary_path())
    fresh.arrays(pa.array(["a first text"]))
    tracemalloc.start()
    fresh.arrays(pa.array([" ".join(words)]))
    held, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert held < 1_000_000  # 50,000 chunks and their ids as objects take over 8 MB
    assert 49_000 < len(fresh.memo) <= 50_100 and fresh.memo.nbytes + fresh.memo_ids.nbytes < 60 * 50_000


def test_memo_stays_in_its_bounds():
    small, draw = Encoder(vocabulary_path(), memo_chunks=300), random.Random(9)
    alphabets = ["abcdefgh", "абвгдежз", "abгд", "ßàñ", "a\t"]
    often = ["the", "of", "слово", "naïve,"]
    for n in (40, 290, 1000, 60):
        words = ["".join(draw.choice(letters) for _ in range(7)) for letters in alphabets for _ in range(n // 5)]
        texts = [" ".join(draw.sample(words, len(words)) + often), None, "the of", "z" * draw.randrange(20, 60) * n + " the"]
        assert [x.tolist() for x in small.ids(texts)] == [plain(small, t).ids for t in texts]
        assert len(small.memo) == len(small.memo_ids) <= 300
        assert small.memo.nbytes + small.memo_ids.nbytes <= 300 * PIECE_BYTES


def test_spans_are_the_tokenizers(encode):
    for text in [t for t in ODD + random_texts(400) if t]:
        starts, ends = spans.token_spans(text, encode.ids([text])[0], encode)
        assert list(zip(starts.tolist(), ends.tolist(), strict=True)) == plain(encode, text).offsets


# --- packing ---------------------------------------------------------------------------


def check_pieces(rows, encode, texts, limits, end_id=1):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for i, text in texts.items():
        ids = np.array([*plain(encode, text).ids, end_id], "<u4")
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at == pieces[0]["sequence_tokens"] <= limits.tokens
        assert len(pieces) <= limits.segments and sum(r["loss_tokens"] for r in pieces) <= limits.loss
    return by_sequence


@pytest.mark.parametrize("limits", [pack.Limits(), pack.Limits(64, 3, 40), pack.Limits(16, 1, 16), pack.Limits(1, 1, 1), pack.Limits(50, 100, 7)])
def test_pack_keeps_each_id_once(spark, documents, clashing, encode, limits):
    texts = dict(enumerate(ODD + random_texts(60)))
    docs = clashing(documents([(i, t, "s") for i, t in texts.items()]))
    rows = pack.pack(docs, limits=limits, window=16).collect()
    sequences = check_pieces(rows, encode, texts, limits)
    assert all(r["padding"] == 0 or r["sequence_tokens"] & (r["sequence_tokens"] - 1) for p in sequences.values() for r in p)


def test_pack_pads_next_to_nothing(documents, encode):
    texts = dict(enumerate(random_texts(400) + ["word " * k for k in range(1, 400, 7)]))
    rows = pack.pack(documents([(i, t, "s") for i, t in texts.items()])).collect()
    sequences = check_pieces(rows, encode, texts, pack.Limits())
    assert sum(p[0]["padding"] for p in sequences.values()) == 0


def test_pack_counts_prompts_as_quiet(spark, encode):
    rows = [(i, "word " * n, q) for i, (n, q) in enumerate([(30, 10), (30, 100), (5, None), (80, 0), (1, 1)])]
    df = spark.createDataFrame(rows, "doc_id long, text string, prompt int")
    limits = pack.Limits(64, 4, 20)
    out = pack.pack(df, quiet_column="prompt", limits=limits).collect()
    check_pieces(out, encode, {i: t for i, t, _ in rows}, limits)
    for i, text, quiet in rows:
        n = len(plain(encode, text).ids) + 1
        assert sum(r["loss_tokens"] for r in out if r["doc_id"] == i) == n - min(n, quiet or 0)


def test_pack_without_cuts_keeps_rests_whole(documents, encode):
    texts = {i: "word " * (i % 50) for i in range(120)}
    rows = pack.pack(documents([(i, t, "s") for i, t in texts.items()], 1), cut=False, limits=pack.Limits(100, 3, 100)).collect()
    check_pieces(rows, encode, texts, pack.Limits(100, 3, 100))
    assert len(rows) == len(texts)


def test_dot_product_takes_what_fits_best():
    limits = pack.Limits(10, 9, 10)
    pieces = [pack.Piece(i, 0, n, 0) for i, n in enumerate([6, 4, 5, 5, 7, 3])]
    bins = pack.dot_product_bins(pieces, limits)
    assert sorted(sorted(p.length for p in b) for b in bins) == [[3, 7], [4, 6], [5, 5]]


def test_pack_over_many_batches(spark, documents, encode):
    texts = dict(enumerate(random_texts(150) + ["word " * 900, "a b " * 400]))
    limits = pack.Limits(64, 5, 30)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = pack.pack(documents([(i, t, "s") for i, t in texts.items()], 2), limits=limits, window=25).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    check_pieces(rows, encode, texts, limits)


def test_waiting_rows_keep_only_what_waits():
    raw = np.arange(300_000, dtype="<u4").tobytes()
    held = {k: pack.Held(k, 300_000, 0, raw) for k in range(5)}
    rests = [pack.Piece(1, 299_000, 1000, 0), pack.Piece(3, 299_990, 10, 0), pack.Piece(3, 299_900, 90, 0)]
    want = {(p.example, p.start): held[p.example].part(p) for p in rests}
    for _ in range(2):
        held = pack.still_needed(held, rests)
        assert {k: len(h.raw) for k, h in held.items()} == {1: 4000, 3: 400}
        assert {(p.example, p.start): held[p.example].part(p) for p in rests} == want
    assert pack.still_needed(held, []) == {}


def test_pack_edges(documents, spark):
    assert pack.pack(documents([])).count() == 0
    repeated = pack.pack(documents([(1, "a b", "s")] * 3 + [(None, "a b", "s")])).collect()
    assert sorted((r["doc_id"] is None, r["length"]) for r in repeated)[-1][0] and sum(r["length"] for r in repeated) == 12
    with pytest.raises(ValueError):
        pack.pack(documents([]), limits=pack.Limits(0, 1, 1))


# --- bit-packed files ------------------------------------------------------------------------


@pytest.mark.parametrize("bits", [1, 3, 7, 8, 9, 15, 16, 17, 25, 31, 32])
def test_bits_round_trip(bits):
    draw = np.random.default_rng(bits)
    for n in (0, 1, 7, 8, 9, 1000):
        ids = draw.integers(0, 2**bits, n).astype(np.uint32)
        raw = bitpack.pack_bits(ids, bits)
        assert len(raw) == (n * bits + 7) // 8
        assert (bitpack.unpack_bits(raw, n, bits) == ids).all()
        value = int.from_bytes(raw, "little")
        assert all((value >> (k * bits)) & ((1 << bits) - 1) == x for k, x in enumerate(ids[:20].tolist()))


def test_bits_for_a_vocabulary():
    assert [bitpack.bits_for(n) for n in (1, 2, 3, 256, 257, 50257, 65537)] == [1, 1, 2, 8, 9, 16, 17]


def test_shard_random_access():
    draw = np.random.default_rng(1)
    documents = [draw.integers(0, 50257, n).astype(np.uint32) for n in (0, 1, 5000, 3, 0, 9000)]
    shard = bitpack.Shard(bitpack.encode_shard([5, None, -3, 2**60, 0, 1], documents, 16, block=512))
    whole = np.concatenate(documents)
    assert shard.keys() == [5, None, -3, 2**60, 0, 1]
    for a, b in [(0, 0), (0, 1), (511, 513), (512, 1024), (100, 9000), (14003, 14004), (0, len(whole))]:
        assert (shard.ids(a, b) == whole[a:b]).all()
    with pytest.raises(ValueError):
        bitpack.Shard(b"something else\n")


def test_token_files(spark, documents, clashing, encode):
    texts = dict(enumerate(ODD + random_texts(80)))
    docs = clashing(documents([(i * 7 - 20, t, "s") for i, t in texts.items()]))
    rows = sorted(bitpack.token_index(spark, docs, with_ids=True, shard_ids=2000, block=128).collect(), key=lambda r: r["doc_id"])
    at = 0
    assert len({r["file"] for r in rows}) > 1
    for r, text in zip(rows, texts.values(), strict=True):
        ids = np.array([*plain(encode, text).ids, 2], "<u4").tobytes()
        assert (r["start"], r["n_tokens"], r["ids"], r["ids_crc32"]) == (at, len(ids) // 4, ids, zlib.crc32(ids))
        at += r["n_tokens"]


def test_token_files_edges(spark, documents):
    assert bitpack.token_index(spark, documents([])).count() == 0
    rows = bitpack.token_index(spark, documents([(1, "a", "s"), (1, "b c", "s"), (None, "x", "s"), (1, "a", "s")])).collect()
    rows = sorted(rows, key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == [None, 1, 1, 1]
    assert [r["start"] for r in rows] == [0, *np.cumsum([r["n_tokens"] for r in rows])[:-1].tolist()]


# --- attribution ----------------------------------------------------------------------


def brute_sections(encode, text, starts, rule):
    ends = [*starts[1:], len(text)]
    counts, crossing = [0.0] * len(starts), [0] * len(starts)
    for a, b in plain(encode, text).offsets:
        widths = [max(0, min(b, e) - max(a, s)) for s, e in zip(starts, ends, strict=True)]
        touched = [k for k, w in enumerate(widths) if w]
        if len(touched) > 1:
            for k in touched:
                crossing[k] += 1
        if rule == "share":
            for k in touched:
                counts[k] += widths[k] / sum(widths)
        else:
            counts[{"start": touched[0], "end": touched[-1], "largest": widths.index(max(widths))}[rule]] += 1
    return counts, crossing


@pytest.mark.parametrize("rule", spans.RULES)
def test_sections(documents, clashing, encode, rule):
    texts = [t for t in ODD if t is None or "\x85" not in t] + random_texts(60) + ["a\n\n\nb", "\n\n", "x\n\n\n\ny z\n"]
    docs = clashing(documents([(i, t, "s") for i, t in enumerate(texts)]))
    got = {}
    for r in spans.section_tokens(docs, section_end="\n", rule=rule).collect():
        got.setdefault(r["doc_id"], []).append(r)
    for i, text in enumerate(texts):
        text = text or ""
        starts = [0, *(k + 1 for k, c in enumerate(text) if c == "\n")]
        rows = sorted(got[i], key=lambda r: r["section"])
        counts, crossing = brute_sections(encode, text, starts, rule)
        assert [r["start_char"] for r in rows] == starts
        assert [r["n_crossing"] for r in rows] == crossing
        assert [r["n_tokens"] for r in rows] == pytest.approx(counts)
        assert sum(r["n_tokens"] for r in rows) == pytest.approx(len(plain(encode, text).ids))


def test_fields(spark, encode):
    df = spark.createDataFrame([(1, "user", "hello\nyou", "x"), (2, None, "", None), (3, "a:b,1", "7", "é")], "conv_id long, role string, text string, extra string")
    rows = spans.field_tokens(df, "conv_id", ["role", "text", "extra"], rule="start").collect()
    for key, fields in [(1, ["user", "hello\nyou", "x"]), (2, ["", "", ""]), (3, ["a:b,1", "7", "é"])]:
        text = "\n".join(fields)
        starts = np.cumsum([0, *(len(f) + 1 for f in fields[:-1])]).tolist()
        counts, _ = brute_sections(encode, text, starts, "start")
        assert [r["n_tokens"] for r in sorted((r for r in rows if r["conv_id"] == key), key=lambda r: r["section"])] == counts


def test_sections_edges(documents):
    assert spans.section_tokens(documents([])).count() == 0
    assert spans.section_tokens(documents([(None, "a\nb", "s"), (None, "a\nb", "s")])).count() == 4
    with pytest.raises(ValueError):
        spans.section_tokens(documents([]), rule="most")
