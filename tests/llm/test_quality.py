"""The additive model: fit, scores, held-out rows; and the whole pipeline."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tenura.llm import gam
from tenura.llm.queries import QUERIES


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def texts(n):
    draw = random.Random(1)
    out = []
    for i in range(n):
        words = [draw.choice(["the", "house", "is", "green", "and", "old", "river"]) for _ in range(draw.randrange(5, 80))]
        good = i % 3 > 0
        out.append((i, ". ".join(" ".join(words[k : k + 9]) for k in range(0, len(words), 9)) if good else " | ".join(w + "$$" for w in words), "s", good))
    return out


def test_model_learns_steps_and_pairs():
    draw = np.random.default_rng(0)
    x = draw.uniform(0, 1, (4000, 3))
    step = (x[:, 0] > 0.6).astype(float)
    both = ((x[:, 1] > 0.5) ^ (x[:, 2] > 0.5)).astype(float)
    test = draw.uniform(0, 1, (1000, 3))
    first = gam.fit(x, step)
    assert ((first.score(test) > 0.5) == (test[:, 0] > 0.6)).mean() > 0.97
    plain = gam.fit(x, both, n_pairs=0)
    paired = gam.fit(x, both)
    truth = (test[:, 1] > 0.5) ^ (test[:, 2] > 0.5)
    assert ((plain.score(test) > 0.5) == truth).mean() < 0.65
    assert ((paired.score(test) > 0.5) == truth).mean() > 0.9 and (1, 2) in paired.pairs


def test_score_is_a_sum_of_table_entries():
    draw = np.random.default_rng(2)
    x = draw.normal(size=(500, 4))
    model = gam.fit(x, (x[:, 0] + x[:, 1] * x[:, 2] > 0).astype(float), rounds=10)
    for row, score in zip(x[:30], model.score(x[:30]), strict=True):
        total = model.base
        for j in range(4):
            total += model.tables[j][sum(row[j] >= c for c in model.cuts[j])]
        for (a, b), table in zip(model.pairs, model.pair_tables, strict=True):
            total += table[sum(row[a] >= c for c in model.coarse[a]), sum(row[b] >= c for c in model.coarse[b])]
        assert score == pytest.approx(1 / (1 + np.exp(-total)))


def test_degenerate_fits():
    width = len(gam.FEATURES)
    empty = gam.fit(np.zeros((0, width)), np.zeros(0))
    assert empty.score(np.zeros((2, width))).tolist() == [0.5, 0.5]
    one = gam.fit(np.ones((50, width)), np.ones(50))
    assert 0.9 < one.score(np.zeros((1, width)))[0] < 1
    same = gam.fit(np.ones((50, width)), np.arange(50) % 2)
    assert same.score(np.ones((1, width)))[0] == pytest.approx(0.5, abs=0.01)


def test_features_of_odd_texts():
    for text in (None, "", " ", "\n\n", "é" * 10, "a" * 100_000, "| | |", "\x00", "A\tB\nC"):
        values = gam.text_features(text)
        assert len(values) == len(gam.FEATURES) and np.isfinite(values).all()
    assert gam.text_features(None) == gam.text_features("")


def test_scores(spark, documents, clashing):
    rows = texts(240)
    docs = clashing(documents([r[:3] for r in rows] + [(1000, None, "s"), (1001, "", None), (None, "the old house", "s")]))
    labels = labelled(spark, [(i, int(good), 0) for i, _, _, good in rows] + [(5, None, 0), (None, 1, 0), (99999, 0, 0)])
    got = gam.quality_scores(docs, labels).collect()
    assert len(got) == 243
    for r in got:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
    good = {i: g for i, _, _, g in rows}
    assert all(r["predicted"] == good[r["doc_id"]] for r in got if r["doc_id"] in good)
    # held-out labels change nothing
    flipped = labels.withColumn("quality", F.when(gam.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = gam.quality_scores(docs, flipped).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    kept = gam.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in got if r["predicted"]}


def test_scores_without_labels_or_rows(spark, documents):
    none = labelled(spark, []) if False else spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r["score"] for r in gam.quality_scores(documents(["a", "b"]), none).collect()] == [0.5, 0.5]
    assert gam.quality_scores(documents([]), none).count() == 0


@pytest.mark.parametrize("label", [None, 0, 1])
def test_all_rows_stay_without_both_labels(spark, documents, label):
    docs = documents(["a clean text of a few words"] * 9 + [None])
    labels = labelled(spark, [] if label is None else [(i, label, 0) for i in range(9)])
    kept = gam.keep_good(docs, labels)
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(10)) and kept.schema == docs.schema


def test_a_repeated_id_is_fitted_once(spark, documents, monkeypatch):
    fitted = []
    monkeypatch.setattr(gam, "fit", lambda x, y: fitted.append((x.tolist(), y.tolist())))
    ids = [i for i in range(20) if zlib.crc32(str(i).encode()) % 4 != 2]
    rows = [(i, f"text {i}", "s") for i in ids] + [(ids[0], f"other {k}" if k % 2 else None, "s") for k in range(300)]
    labels = labelled(spark, [(i, i % 2, 0) for i in ids])
    for partitions in (1, 5):
        gam.fit_quality(documents(rows, partitions), labels)
    assert len(fitted[0][0]) == len(ids) and fitted[0] == fitted[1]


def test_held_out_accuracy(spark, sf_dir):
    scored = QUERIES["op10_additive_model"](spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    right = scored.join(labels, "doc_id").filter("held_out").agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0]
    assert right > 0.9


# --- the pipeline ----------------------------------------------------------------------


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "n-gram Jaccard join", "suffix-array dedup", "mixing sources", "packing"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.settle(stage(spark, docs, sf_dir))
        assert docs.columns == columns and docs.count() > 0
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    whole = corpus_pipeline.run(spark, sf_dir)
    key = ["doc_id", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, packed.select(key).collect())) == sorted(map(tuple, whole.select(key).collect()))


def test_pipeline_against_brute_force(spark, sf_dir):
    from test_links import brute as links
    from test_mix import WORDS, targets
    from test_passages import brute as passages

    from tenura.llm.tokens import Encoder, vocabulary_path

    def rows(df):
        return {r["doc_id"]: r["text"] for r in df.collect()}

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    good = corpus_pipeline.settle(corpus_pipeline.quality(spark, docs, sf_dir))
    scored = QUERIES["op10_additive_model"](spark, sf_dir).filter("predicted = 1")
    assert set(rows(good)) == {r["doc_id"] for r in scored.collect()}
    single = corpus_pipeline.settle(corpus_pipeline.near_duplicates(spark, good, sf_dir))
    assert set(rows(single)) == {i for i, _, root in links(list(rows(good).items()), 5, 80) if i == root}
    cut = corpus_pipeline.settle(corpus_pipeline.repeated_passages(spark, single, sf_dir))
    want = {i: kept.decode("utf-8", "ignore") for i, (*_, kept) in passages(list(rows(single).items()), 100).items()}
    assert rows(cut) == {i: t for i, t in want.items() if t}
    mixed = corpus_pipeline.settle(corpus_pipeline.mixing(spark, cut, sf_dir))
    size, taken = {}, {}
    for table, sums in ((cut, size), (mixed, taken)):
        for r in table.collect():
            sums[r["source"]] = sums.get(r["source"], 0) + len(WORDS.findall(r["text"]))
    assert all(abs(taken.get(s, 0) - t) <= 0.5 for s, t in targets(size).items())
    packed = corpus_pipeline.packing(spark, mixed, sf_dir)
    encode, tokens = Encoder(vocabulary_path()), {}
    for r in mixed.collect():
        n = len(encode.tokenizer.encode(r["text"], add_special_tokens=False).ids) + 1
        tokens[r["doc_id"]] = tokens.get(r["doc_id"], 0) + n
    found = {r["doc_id"]: r["n"] for r in packed.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert found == tokens


def test_pipeline_decides(spark, documents, tmp_path):
    clean = [" ".join(f"the river {k} old house {i * 37 + k}" for k in range(40)) + "." for i in range(12)]
    junk = [" | ".join(f"x{i}{k}$$%" for k in range(60)) for i in range(12)]
    shared = "a passage that stands in several documents word for word and is therefore longer than one hundred bytes, quite certainly"
    rows = [(i, t, f"s{i % 2}") for i, t in enumerate(clean)] + [(100 + i, t, "s1") for i, t in enumerate(junk)]
    rows += [(50, clean[0], "s0"), (51, clean[1] + " end", "s1"), (60, clean[10] + " " + shared, "s0"), (61, " ".join(reversed(clean[11].split())) + " " + shared, "s1")]
    rows = [r for r in rows if r[0] not in (10, 11)] + [(70, None, "s0")]
    folder = str(tmp_path)
    documents(rows).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1 if i < 100 else 0, 0) for i, _, _ in rows if i != 70]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = corpus_pipeline.quality(spark, docs, folder)
    good = {r["doc_id"] for r in kept.collect()}
    assert {i for i, _, _ in rows if i < 70} <= good and not any(i >= 100 for i in good)
    single = corpus_pipeline.near_duplicates(spark, kept, folder)
    assert good - {r["doc_id"] for r in single.collect()} == {50, 51}
    cut = corpus_pipeline.repeated_passages(spark, single, folder)
    assert [shared in r["text"] for r in cut.filter("doc_id in (60, 61)").orderBy("doc_id").collect()] == [True, False]
    mixed = corpus_pipeline.mixing(spark, cut, folder)
    assert mixed.count() >= cut.filter("length(text) > 0").count()
    assert corpus_pipeline.packing(spark, mixed, folder).agg(F.sum("padding")).first()[0] == 0
