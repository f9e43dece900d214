"""Data of the operators' tests; the session comes from the parent folder."""

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Documents from texts or (id, text, source) rows."""

    def make(rows, partitions=3):
        whole = []
        for i, row in enumerate(rows):
            key, text, source = row if isinstance(row, tuple) else (i, row, "s")
            whole.append((key, text, "en", source, None if text is None else len(text)))
        return spark.createDataFrame(whole, DOCS).repartition(partitions)

    return make


@pytest.fixture
def clashing():
    """Adds columns with names that an operator might use itself."""

    def add(df):
        from pyspark.sql import functions as F

        names = ["id", "key", "h", "rank", "size", "words", "block", "sequence_id", "file", "score", "region", "start", "_id", "ordinal", "spans", "_key", "_first", "_whole", "_size", "text_key", "taken", "target", "n", "a", "b", "place", "features"]
        names += ["__k", "__o", "__first", "__mix_id", "__mix_key", "__MIX_WHOLE", "__mix_whole_", "__passage_key", "__passage_spans"]
        return df.select("*", *[F.lit("x").alias(n) for n in names])

    return add
