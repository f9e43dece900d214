"""Mixing sources to target weights, with DataFrame operations only.

The words of a source stand in one line, document after document, cut into blocks of
fixed length. Each source owes a number of slots, one block each. Output shards draw
their slots from the sources (a multinomial draw by the sources' shares); draws
beyond what a source owes are void, and what is left over goes to closing shards, so
the mix hits each target to the word. Slot i of a pass over a source takes the block
that a pseudorandom permutation of that pass has at i, and slots meet blocks in a join
on the index.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura.llm.common import WORD, same, set_apart, word_count
from tenura.operators.ordering import dense_key, running_totals
from tenura.session import settle

WEIGHTS = (3, 1, 2)
BLOCK_WORDS = 256
SHARD_SLOTS = 4096
ROUNDS = 24


def permuted(index: Column, n: Column, *key: Column) -> Column:
    """Where a pseudorandom permutation of 0..n-1, one for each ``key``, has ``index``.

    The swap-or-not shuffle: each round pairs x with (k - x) mod n and a hash of the
    pair decides whether they change places, so every round is a permutation.
    """

    def turn(x: Column, r: Column) -> Column:
        k = F.pmod(F.xxhash64(F.lit("turn"), *key, r), n)
        other = F.pmod(k - x, n)
        swap = F.xxhash64(F.lit("swap"), *key, r, F.greatest(x, other)).bitwiseAND(F.lit(1)) == 1
        return F.when(swap, other).otherwise(x)

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), index.cast("long"), turn)


def sized_documents(docs: DataFrame) -> DataFrame:
    """doc_id, source, text_key, size of each document, written once. Rows equal in id, source and text are one."""
    return settle(
        docs.select("doc_id", "source", F.xxhash64("text").alias("text_key"), word_count("text").alias("size"))
        .groupBy("doc_id", "source", "text_key").agg(F.max("size").alias("size"))
    )


def source_targets(
    documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: int = 2
) -> DataFrame:
    """rank, source, source_size, weight, target, words (the target, rounded) of each source.

    Sources in code point order, null last, get the weights in turn. They share
    ``share`` times all sizes by weight; no target is above ``most`` times its source's
    size, and the excess goes to the others by weight until none is above: every target
    is the smaller of its cap and weight * level, for one level.
    """
    sources = documents.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = dense_key(sources, [F.col("source").asc_nulls_last()], "rank")
    turn = F.pmod(F.col("rank") - 1, F.lit(len(weights))).cast("int")
    weighed = ranked.select(
        "rank", "source", "source_size",
        F.element_at(F.array(*[F.lit(w) for w in weights]), turn + 1).cast("long").alias("weight"),
    ).withColumn("cap", F.col("source_size") * most).withColumn("full_at", F.col("cap") / F.col("weight"))
    # those whose caps are reached first come first
    laid = settle(running_totals(weighed, ["cap", "weight"], ["full_at", "rank"]))
    budget = F.lit(share) * F.col("cap_total") / most
    level = (budget - F.col("cap_before")) / (F.col("weight_total") - F.col("weight_before"))
    found = laid.filter(F.col("full_at") >= level).agg(F.min_by(level, F.struct("full_at", "rank"))).first()[0]
    cap = F.col("cap").cast("double")
    return settle(
        laid.withColumn("target", cap if found is None else F.least(cap, F.col("weight") * F.lit(found)))
        .select("rank", "source", "source_size", "weight", "target", F.round("target").cast("long").alias("words"))
    )


def source_blocks(documents: DataFrame, sources: DataFrame, block_words: int) -> DataFrame:
    """rank, block, at (first word in the block), words, and the document part: doc_id, source, text_key, from_word."""
    ranks = sources.select("rank", F.col("source").alias("_source"))
    laid = running_totals(
        documents.filter("size > 0"), ["size"], [F.xxhash64("doc_id", "text_key"), F.col("doc_id"), F.col("text_key")], within=["source"]
    )
    first = F.col("size_before")
    last = first + F.col("size")
    low = F.greatest(first, F.col("block") * block_words)
    high = F.least(last, (F.col("block") + 1) * block_words)
    parts = laid.withColumn("block", F.explode(F.sequence(F.floor(first / block_words), F.floor((last - 1) / block_words))))
    return parts.join(ranks, same(F.col("source"), F.col("_source"))).select(
        "rank", "block", (low - F.col("block") * block_words).alias("at"), (high - low).alias("words"),
        "doc_id", "source", "text_key", (low - first).alias("from_word"),
    )


def drawn_slots(sources: DataFrame, block_words: int, shard_slots: int, seed: int) -> DataFrame:
    """rank, shard, pass, block, words: the slots of all shards, each a block or its first words."""
    size, blocks = F.col("source_size"), F.ceil(F.col("source_size") / block_words)
    rest = F.col("words") % size
    owing = sources.filter("words > 0").withColumn("blocks", blocks).withColumn("whole", F.floor(size / block_words))
    owing = owing.withColumn("slots", F.floor(F.col("words") / size) * blocks + F.ceil(rest / block_words))
    owing = settle(running_totals(owing, ["slots"], ["rank"]))
    total, count = owing.agg(F.coalesce(F.sum("slots"), F.lit(0)), F.count(F.lit(1))).first()
    if not total:
        return sources.sparkSession.createDataFrame([], "rank long, shard long, pass long, block long, words long")
    # A draw is a place in 0..total-1 and falls to the source whose stretch holds it. Both
    # sides are cut into about as many cells as there are sources, so a draw meets two
    # sources on average, however long the stretches are.
    cell = -(-total // count)
    begin, end = F.col("slots_before"), F.col("slots_before") + F.col("slots")
    cells = owing.select("rank", begin.alias("begin"), end.alias("end"), F.explode(F.sequence(F.floor(begin / cell), F.floor((end - 1) / cell))).alias("cell"))
    place = F.pmod(F.xxhash64(F.lit("draw"), F.lit(seed), F.col("id")), F.lit(total))
    draws = sources.sparkSession.range(total).select(F.floor(F.col("id") / shard_slots).alias("shard"), place.alias("place")).withColumn("cell", F.floor(F.col("place") / cell))
    counts = (
        draws.join(cells, "cell").filter("place >= begin and place < end")
        .groupBy("shard", "rank").agg(F.count(F.lit(1)).alias("n"))
    )
    counted = settle(running_totals(counts, ["n"], ["shard"], within=["rank"]))
    owed = owing.select("rank", "slots")
    kept = counted.join(owed, "rank").select(
        "rank", "shard", F.col("n_before").alias("low"), F.least(F.col("n_before") + F.col("n"), F.col("slots")).alias("high")
    )
    closing = -(-total // shard_slots)
    drawn = counted.groupBy("rank").agg(F.max("n_total").alias("n_total"))
    open_ = owed.join(drawn, "rank", "left").withColumn("n_total", F.coalesce("n_total", F.lit(0))).filter("n_total < slots")
    late = open_.withColumn("low", F.explode(F.sequence(F.col("n_total"), F.col("slots") - 1, F.lit(shard_slots).cast("long")))).select(
        "rank", (F.lit(closing) + F.floor((F.col("low") - F.col("n_total")) / shard_slots)).alias("shard"), "low",
        F.least(F.col("low") + shard_slots, F.col("slots")).alias("high"),
    )
    # no row stands for more slots than one shard has
    each = kept.unionByName(late).filter("low < high").withColumn("slot", F.explode(F.sequence("low", F.col("high") - 1)))
    # few rows became many: they are spread over all tasks before their permutation
    each = each.repartition(int(each.sparkSession.conf.get("spark.sql.shuffle.partitions")), "rank", "slot").select("rank", "shard", "slot")
    facts = owing.select("rank", "source_size", F.col("words").alias("owed"), "blocks", "whole")
    i = F.col("slot") % F.col("blocks")
    done = F.floor(F.col("slot") / F.col("blocks"))
    left = F.col("owed") - done * F.col("source_size") - i * block_words
    length = F.least(F.lit(block_words).cast("long"), F.col("source_size") - i * block_words, left)
    block = F.when(i < F.col("whole"), permuted(i, F.col("whole"), F.lit(seed), F.col("rank"), done)).otherwise(F.col("whole"))
    return each.join(facts, "rank").select("rank", "shard", done.alias("pass"), block.alias("block"), length.alias("words"))


def mixture(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = 1.5,
    most: int = 2,
    block_words: int = BLOCK_WORDS,
    shard_slots: int = SHARD_SLOTS,
    seed: int = 1,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The documents with sizes, the sources with targets, and the mix.

    The mix has one row per stretch of words: shard, pass, doc_id, source, text_key,
    from_word, words. Reads doc_id, source and text. A null text has no words, a null
    source is a source, rows equal in all three are one document, an empty table gives
    empty results. The same rows give the same mix in any layout.
    """
    documents = sized_documents(docs)
    sources = source_targets(documents, weights, share, most)
    blocks = source_blocks(documents, sources, block_words)
    slots = drawn_slots(sources, block_words, shard_slots, seed).withColumnRenamed("words", "slot_words")
    taken = F.least(F.col("at") + F.col("words"), F.col("slot_words")) - F.col("at")
    mix = slots.join(blocks, ["rank", "block"]).withColumn("taken", taken).filter("taken > 0")
    return documents, sources, mix.select("shard", "pass", "doc_id", "source", "text_key", "from_word", F.col("taken").alias("words"))


def words_taken(docs: DataFrame, **options: object) -> DataFrame:
    """doc_id, size, source_size, target, taken, source of each document."""
    documents, sources, mix = mixture(docs, **options)
    key = ["doc_id", "source", "text_key"]
    both = documents.select(*key, "size", F.lit(0).cast("long").alias("words")).unionByName(
        mix.select(*key, F.lit(0).cast("long").alias("size"), "words")
    )
    counted = both.groupBy(*key).agg(F.sum("size").alias("size"), F.sum("words").alias("taken"))
    told = sources.select(F.col("source").alias("_source"), "source_size", "target")
    return counted.join(told, same(F.col("source"), F.col("_source"))).select("doc_id", "size", "source_size", "target", "taken", "source")


def mixed_documents(docs: DataFrame, **options: object) -> DataFrame:
    """The mix as rows like ``docs``: one per document and pass, with the words that the pass takes.

    A text taken whole stays as it is; of others the taken stretches remain, each with
    the white space after its words. ``n_chars`` is set anew where there is one. Other
    columns may have any name.
    """
    names = docs.columns
    docs = set_apart(docs, ["__mix_id", "__mix_source", "__mix_text", "__mix_stretches", "__mix_whole", "__mix_key"])
    documents, _, mix = mixture(docs, **options)
    stretch = F.struct("from_word", "words")
    passes = mix.groupBy("doc_id", "source", "text_key", "pass").agg(
        F.sort_array(F.collect_list(stretch)).alias("_stretches"), F.sum("words").alias("_taken")
    )
    sized = passes.join(
        documents.select(*[F.col(c).alias(f"_{c}") for c in ("doc_id", "source", "text_key", "size")]),
        same(F.col("doc_id"), F.col("_doc_id")) & same(F.col("source"), F.col("_source")) & (F.col("text_key") == F.col("_text_key")),
    ).select(
        F.col("doc_id").alias("__mix_id"), F.col("source").alias("__mix_source"), F.col("_text_key").alias("__mix_text"),
        F.col("_stretches").alias("__mix_stretches"), (F.col("_taken") == F.col("_size")).alias("__mix_whole"),
    )
    once = docs.withColumn("__mix_key", F.xxhash64("text")).dropDuplicates(["doc_id", "source", "__mix_key"])
    met = once.join(
        sized, same(once["doc_id"], sized["__mix_id"]) & same(once["source"], sized["__mix_source"]) & (F.col("__mix_key") == F.col("__mix_text"))
    )
    words = F.regexp_extract_all("text", F.lit(f"({WORD}[\\x20\\x09-\\x0D]*)"), F.lit(1))
    cut = F.array_join(
        F.transform("__mix_stretches", lambda s: F.array_join(F.slice(words, s["from_word"].cast("int") + 1, s["words"].cast("int")), "")), ""
    )
    text = F.when(F.col("__mix_whole"), F.col("text")).otherwise(cut)
    out = met.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns).toDF(*names)
