"""Token counts of sections and fields: whole texts are encoded once, and token spans are joined with section spans."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.llm.common import arrow_schema, kind_of, text_batches
from tenura.llm.tokens import Encoder, encoder, vocabulary_path

RULES = ("start", "end", "largest", "share")
FIELD_END = "\n"


def token_spans(text: str, ids: np.ndarray, encode: Encoder) -> tuple[np.ndarray, np.ndarray]:
    """First character of each token and the end after its last; a token of a part of a character has all of it."""
    ends = np.cumsum(encode.n_bytes[ids])
    starts = ends - encode.n_bytes[ids]
    raw = text.encode("utf-8", "surrogatepass")
    if len(raw) == len(text):
        return starts, ends
    character = np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80) - 1
    return character[starts], character[ends - 1] + 1


def attribute(starts: np.ndarray, ends: np.ndarray, sections: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section, and how many tokens each shares with another.

    ``sections`` has each section's first character, ascending from 0; the last is open.
    A token over a border goes to the section of its first character (start), of its
    last (end), to that with most of its characters, the earlier on a tie (largest), or
    is divided by characters (share).
    """
    first = np.searchsorted(sections, starts, "right") - 1
    last = np.searchsorted(sections, ends - 1, "right") - 1
    n = len(sections)
    inside = first == last
    counts = np.bincount(first[inside], minlength=n).astype(np.float64)
    crossing = np.zeros(n, np.int64)
    for k in np.flatnonzero(~inside).tolist():
        a, b = int(first[k]), int(last[k])
        edges = np.concatenate([[starts[k]], sections[a + 1 : b + 1], [ends[k]]])
        widths = np.diff(edges)
        touched = np.flatnonzero(widths) + a
        crossing[touched] += 1
        if rule == "share":
            counts[a : b + 1] += widths / widths.sum()
        else:
            counts[{"start": a, "end": b, "largest": a + int(widths.argmax())}[rule]] += 1
    return counts, crossing


def _attributed(rows: DataFrame, parts, rule: str, path: str, kind: str) -> DataFrame:
    """``parts(row text)`` gives the text and its section starts."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    number = "double" if rule == "share" else "long"
    columns = f"id {kind}, section int, start_char long, n_chars long, n_tokens {number}, n_crossing long"
    shape = arrow_schema(columns)

    def task(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for frame in text_batches(frames, "text", 4_000_000):
            given = frame.column("text").to_pylist()
            cut = [parts(text) for text in given]
            owners, section, start, size, counts, crossing = [], [], [], [], [], []
            for row, ((text, at), ids) in enumerate(zip(cut, encode.ids([t for t, _ in cut]), strict=True)):
                found, shared = attribute(*token_spans(text, ids, encode), at, rule)
                owners.append(np.full(len(at), row))
                section.append(np.arange(len(at), dtype=np.int32))
                start.append(at)
                size.append(np.diff(np.append(at, len(text))))
                counts.append(found)
                crossing.append(shared)
            if not owners:
                continue
            ids = frame.column("id").take(pa.array(np.concatenate(owners)))
            values = [np.concatenate(c) for c in (section, start, size, counts, crossing)]
            yield pa.RecordBatch.from_arrays([ids, *[pa.array(v).cast(f.type) for v, f in zip(values, list(shape)[1:], strict=True)]], schema=shape)

    return rows.mapInArrow(task, columns)


def section_tokens(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    section_end: str = "\n",
    rule: str = "largest",
    vocabulary: str | None = None,
) -> DataFrame:
    """One row per section of each text: section, start_char, n_chars, n_tokens, n_crossing.

    ``section_end`` is a pattern; a section reaches to the end of its match. Each token
    of the whole text counts once, by ``rule`` (see :func:`attribute`); ``n_crossing``
    tokens also lie in a neighbour. A null or empty text, or one that ends in a match,
    has a last section without characters. Repeated rows give repeated sections, a null
    id stays null, an empty table gives none, other columns are not read.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    pattern = re.compile(section_end)

    def parts(text: str | None) -> tuple[str, np.ndarray]:
        text = text or ""
        return text, np.array([0, *(m.end() for m in pattern.finditer(text) if m.end() > m.start())], np.int64)

    out = _attributed(rows, parts, rule, vocabulary or vocabulary_path(), kind_of(rows, "id"))
    return out.withColumnRenamed("id", id_column)


def field_tokens(
    rows: DataFrame, id_column: str, fields: Sequence[str], rule: str = "largest", vocabulary: str | None = None
) -> DataFrame:
    """One row per field: the fields of a row are joined by line ends, encoded once, and each token goes to one.

    ``section`` counts the fields from 0; a field includes the line end after it. A null
    field is empty.
    """
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in fields]
    # lengths in front, so that line ends inside a field don't cut it
    lengths = F.concat_ws(",", *[F.length(t).cast("string") for t in texts])
    told = rows.select(F.col(id_column).alias("id"), F.concat(lengths, F.lit(":"), F.concat_ws(FIELD_END, *texts)).alias("text"))

    def parts(text: str) -> tuple[str, np.ndarray]:
        head, _, rest = text.partition(":")
        sizes = [int(x) + 1 for x in head.split(",")]
        return rest, np.cumsum([0, *sizes[:-1]])

    out = _attributed(told, parts, rule, vocabulary or vocabulary_path(), kind_of(told, "id"))
    return out.withColumnRenamed("id", id_column)
