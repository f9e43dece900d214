"""Vector bin packing of tokenised examples under limits on tokens, segments and loss tokens.

An example is cut into pieces that fill a sequence by themselves and one rest. Rests
are placed bin by bin: of the rests that fit into all limits, the one whose vector
(tokens, one segment, loss tokens) has the largest dot product with what the bin has
left goes in. Gaps that nothing fits are closed by cutting rests of the emptiest
bins. A task packs its own partition in windows of bounded size, so nothing is
shuffled; what a window can't fill goes on to the next, and the last few tokens of a
task become sequences whose lengths are powers of two, which need no padding.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.llm.common import arrow_schema, batch_of, kind_of, text_batches
from tenura.llm.tokens import encoder, vocabulary_path

SCHEMA = (
    "start long, length long, loss_tokens long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, segment int, sequence_tokens long, padding long"
)


@dataclass(frozen=True)
class Limits:
    """What one sequence may hold."""

    tokens: int = 2048
    segments: int = 256
    loss: int = 2048


@dataclass(frozen=True, slots=True)
class Piece:
    """Ids ``start`` to ``start + length`` of example ``example``; the first ``quiet`` of the example carry no loss."""

    example: int
    start: int
    length: int
    quiet: int

    @property
    def loss(self) -> int:
        return self.length - min(max(self.quiet - self.start, 0), self.length)

    def cut(self, length: int) -> tuple[Piece, Piece]:
        return (
            Piece(self.example, self.start, length, self.quiet),
            Piece(self.example, self.start + length, self.length - length, self.quiet),
        )


def longest(piece: Piece, tokens: int, loss: int) -> int:
    """How many ids from the front of ``piece`` keep within both bounds."""
    quiet = piece.length - piece.loss
    return max(0, min(piece.length, tokens, quiet + loss))


def split(example: int, n: int, quiet: int, limits: Limits) -> list[Piece]:
    """All pieces of one example; only the last may be shorter than a limit asks."""
    out, rest = [], Piece(example, 0, n, quiet)
    while rest.length:
        size = longest(rest, limits.tokens, limits.loss)
        if size == rest.length:
            return [*out, rest]
        head, rest = rest.cut(size)
        out.append(head)
    return out


def dot_product_bins(pieces: list[Piece], limits: Limits) -> list[list[Piece]]:
    """Bins of whole pieces by the dot-product heuristic. Ties go to the longer piece, then to the earlier."""
    kinds: dict[tuple[int, int], list[Piece]] = {}
    for piece in reversed(pieces):
        kinds.setdefault((piece.length, piece.loss), []).append(piece)
    keys = sorted(kinds, reverse=True)
    if not keys:
        return []
    tokens, loss = (np.array(column, dtype=np.int64) for column in zip(*keys, strict=True))
    longest_first = -tokens
    left = np.array([len(kinds[k]) for k in keys])
    bins, remaining = [], len(pieces)
    while remaining:
        room, quota, places, content = limits.tokens, limits.loss, limits.segments, []
        while places and remaining:
            a = int(np.searchsorted(longest_first, -room))  # from here on pieces are short enough
            fits = (left[a:] > 0) & (loss[a:] <= quota)
            # a segment weighs the same for each piece, so it decides only whether a place is left
            score = tokens[a:] * (room / limits.tokens**2) + loss[a:] * (quota / limits.loss**2)
            score[~fits] = -1.0
            k = a + int(score.argmax()) if len(score) else a
            if not len(score) or not fits[k - a]:
                break
            content.append(kinds[keys[k]].pop())
            left[k] -= 1
            remaining -= 1
            room, quota, places = room - keys[k][0], quota - keys[k][1], places - 1
        bins.append(content)
        if remaining and 2 * remaining < left.size:  # kinds that are used up only cost time
            alive = left > 0
            keys = [k for k, x in zip(keys, alive.tolist(), strict=True) if x]
            tokens, loss, longest_first, left = tokens[alive], loss[alive], longest_first[alive], left[alive]
    return bins


def fill(bins: list[list[Piece]], limits: Limits) -> tuple[list[list[Piece]], list[Piece]]:
    """Closes the gaps of full bins with cuts from the emptiest; returns full bins and what is left over."""
    bins = sorted(bins, key=lambda b: -sum(p.length for p in b))
    full, last, donor = [], len(bins), []
    at = 0
    while at < last:
        content = bins[at]
        at += 1
        room = limits.tokens - sum(p.length for p in content)
        loss = limits.loss - sum(p.loss for p in content)
        while room and len(content) < limits.segments:
            if not donor:
                if at >= last:
                    break
                last -= 1
                donor = list(bins[last])
            piece = donor.pop()
            size = longest(piece, room, loss)
            if not size:
                donor.append(piece)
                break
            head, tail = piece.cut(size)
            content.append(head)
            room, loss = room - size, loss - head.loss
            if tail.length:
                donor.append(tail)
        if room and len(content) < limits.segments and loss:
            donor += content
        else:
            full.append(content)
    return full, donor


def powers(pieces: list[Piece], limits: Limits) -> list[list[Piece]]:
    """Sequences of power-of-two lengths, as long as the limits allow."""
    out, queue = [], list(reversed(pieces))
    while queue:
        reach = loss = count = 0  # what a prefix of the queue within the limits holds
        for piece in reversed(queue):
            size = longest(piece, limits.tokens - reach, limits.loss - loss)
            if not size or count == limits.segments:
                break
            reach, loss, count = reach + size, loss + piece.cut(size)[0].loss, count + 1
            if size < piece.length:
                break
        goal, content = 1 << (reach.bit_length() - 1), []
        while goal:
            piece = queue.pop()
            head, tail = piece.cut(min(goal, piece.length))
            content.append(head)
            goal -= head.length
            if tail.length:
                queue.append(tail)
        out.append(content)
    return out


class Packer:
    """Packs examples in windows; ``ready`` gives finished sequences."""

    def __init__(self, limits: Limits, cut: bool, window: int):
        self.limits, self.cut, self.window = limits, cut, window
        self.rests: list[Piece] = []

    def add(self, example: int, n: int, quiet: int) -> Iterator[list[Piece]]:
        for piece in split(example, n, quiet, self.limits):
            if piece.length == self.limits.tokens:
                yield [piece]
            else:
                self.rests.append(piece)
        if len(self.rests) >= self.window:
            yield from self.flush()

    def flush(self) -> Iterator[list[Piece]]:
        bins = dot_product_bins(self.rests, self.limits)
        self.rests = []
        if self.cut:
            bins, self.rests = fill(bins, self.limits)
        yield from bins

    def close(self) -> Iterator[list[Piece]]:
        yield from self.flush()
        yield from powers(self.rests, self.limits)
        self.rests = []


class Held(NamedTuple):
    """A row whose ids are still needed: its id, how many ids it has, and those from ``start`` on."""

    key: object
    n: int
    start: int
    raw: bytes

    def part(self, piece: Piece) -> bytes:
        at = 4 * (piece.start - self.start)
        return self.raw[at : at + 4 * piece.length]


def still_needed(held: dict[int, Held], rests: list[Piece]) -> dict[int, Held]:
    """What the pieces that wait need of their rows, and no more."""
    begin: dict[int, int] = {}
    for piece in rests:
        begin[piece.example] = min(piece.start, begin.get(piece.example, piece.start))
    return {
        k: row if at == row.start else Held(row.key, row.n, at, row.raw[4 * (at - row.start) :])
        for k, at in begin.items() for row in (held[k],)
    }


def pack(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    quiet_column: str | None = None,
    limits: Limits | None = None,
    end_id: int = 1,
    cut: bool = True,
    window: int = 8192,
    vocabulary: str | None = None,
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece: which ids of which row stand where in which sequence.

    A row's ids are those of its whole text and then ``end_id``. The first
    ``quiet_column`` ids of a row (a prompt; null or no column: none) bear no loss.
    Each id is in exactly one piece; offsets have no gaps within a sequence;
    ``sequence_tokens`` is the sequence's length and ``padding`` what it lacks to
    the token limit, 0 where that length is a power of two. ``cut=False`` keeps
    rests whole and leaves the gaps.

    A null or empty text is the end id alone. A null id is kept as it is, and
    repeated rows are packed each for itself. An empty table gives no row. Other
    columns are not read, so their names can't clash. Sequence ids are unique, not
    dense: the task's number and a count.
    """
    limits = limits or Limits()
    path = vocabulary or vocabulary_path()
    if min(limits.tokens, limits.segments, limits.loss, window) < 1:
        raise ValueError("limits and window must be 1 at least")
    quiet = F.lit(0) if quiet_column is None else F.coalesce(F.col(quiet_column), F.lit(0))
    rows = docs.select(
        F.col(id_column).alias("id"), F.col(text_column).alias("text"), quiet.cast("long").alias("quiet")
    )
    schema = f"id {kind_of(rows, 'id')}, {SCHEMA}" + (", ids binary" if with_ids else "")

    shape = arrow_schema(schema)

    def task(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer = encoder(path), Packer(limits, cut, window)
        first = TaskContext.get().partitionId() << 40
        end = np.array([end_id], "<u4").tobytes()
        held: dict[int, Held] = {}
        count = sequences = 0

        def rows_of(done: list[list[Piece]]) -> pa.RecordBatch:
            nonlocal sequences
            out = []
            for content in done:
                total = sum(p.length for p in content)
                padding = 0 if total & (total - 1) == 0 else limits.tokens - total
                offset = 0
                for segment, p in enumerate(content):
                    example = held[p.example]
                    ids = example.part(p)
                    row = (example.key, p.start, p.length, p.loss, crc32(ids), example.n, first + sequences, offset, segment, total, padding)
                    out.append((*row, ids) if with_ids else row)
                    offset += p.length
                sequences += 1
            return batch_of(shape, out)

        for frame in text_batches(frames, "text"):
            done: list[list[Piece]] = []
            raws = encode.raw_ids(frame.column("text"))
            for key, raw, n_quiet in zip(frame.column("id").to_pylist(), raws, frame.column("quiet").to_pylist(), strict=True):
                raw += end
                held[count] = Held(key, len(raw) // 4, 0, raw)
                done += packer.add(count, len(raw) // 4, n_quiet)
                count += 1
            if done:
                yield rows_of(done)
            held = still_needed(held, packer.rests)
        if done := list(packer.close()):
            yield rows_of(done)

    return rows.mapInArrow(task, schema).withColumnRenamed("id", id_column)
