"""Removal of repeated passages with suffix arrays.

A byte goes if a string of ``length`` bytes that covers it also starts earlier in the
table. Merging suffix arrays of the whole corpus would send every suffix with its bytes
around, so shards are built of the text that can matter:

1. Each window of ``length`` bytes has the smallest hash of its k-grams as its anchor:
   equal windows have equal anchors at equal places. An anchor's context is all that
   the windows around it cover. Of equal contexts the first stays, the others go whole.
2. Where one anchor has different contexts, windows must be compared: those contexts,
   once each, are brought together by anchor. Contexts are cut back to what they share
   with any other on either side of the anchor, and what is equal then is combined
   again. Each task lays the rest out in shards of bounded size and sorts each shard's
   suffixes by Larsson-Sadakane refinement; Kasai's rule gives common prefixes, and
   suffixes that share ``length`` bytes are equal windows. Shards are merged by binary
   search in each other's sorted windows. An anchor with very many contexts is brought
   together window by window.
3. Each document gets its spans, and what is left of it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tenura.llm.common import arrow_schema, gathered, let_go, set_apart, text_batches
from tenura.llm.shingles import mix
from tenura.session import settle

GRAM = 48
#: Bytes of text that are hashed at a time, and bytes whose equal contexts a task combines.
BATCH, COMBINE = 1 << 20, 16 << 20
SHARD_BYTES = 2 << 20
#: Contexts that are cut back at a time.
CHUNK = 1 << 15
#: Contexts of one anchor beyond which its windows go their own ways.
MANY = 1 << 16
_PLACE = 40  # low bits of a place: the byte; high bits: which of the texts under one id

_ANCHOR = "h long, c long, key long, place long, span long"
_FOUND = "kind int, key long, place long, span long, h long, contexts long"
# kind 0: a span that goes; 1: a context with ``span`` bytes before its anchor; 2: a window
_CONTEXT = "kind int, route long, key long, place long, span long, content binary"
_SPAN = "key long, place long, span long"


# --- anchors -----------------------------------------------------------------------


def _words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each byte on, little-endian; ``data`` must have eight bytes to spare."""
    return np.ndarray((len(data) - 8,), "<u8", data.data, 0, (1,))


def _sliding(x: np.ndarray, width: int, least: np.ufunc) -> np.ndarray:
    """Least (or largest) of each ``width`` neighbours from each place on."""
    size = 1
    while 2 * size <= width:
        x = least(x[:-size], x[size:])
        size *= 2
    rest = width - size
    return least(x[: len(x) - rest], x[rest:]) if rest else x


def anchors(data: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Where k-grams stand that are the smallest of a window inside one text. Texts begin at ``at``, the end last."""
    gram = min(GRAM, length)
    n = len(data)
    if n < length:
        return np.zeros(0, np.int64)
    padded = np.concatenate([data, np.zeros(GRAM + 8, np.uint8)])
    words = _words_at(padded)
    with np.errstate(over="ignore"):
        x = np.zeros(n - gram + 1, np.uint64)
        for j in range(0, gram, 8):
            w = words[j : j + len(x)]
            if gram - j < 8:
                w = w & np.uint64((1 << (8 * (gram - j))) - 1)
            x = (x + w) * np.uint64(0x9E3779B97F4A7C15)
            x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
    rank = (x >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    width = length - gram + 1
    least = _sliding(rank, width, np.minimum)  # of the window from each place on
    inside = np.zeros(n + 1, np.int8)
    sizes = np.diff(at)
    long = sizes >= length
    inside[at[:-1][long]] += 1
    inside[(at[1:] - length + 1)[long]] -= 1
    least = np.where(np.cumsum(inside[: len(least)]) > 0, least, np.uint32(0))
    reach = np.concatenate([np.zeros(width - 1, np.uint32), least, np.zeros(width - 1, np.uint32)])
    best = _sliding(reach, width, np.maximum)  # over the windows that hold each place
    return np.flatnonzero((best[: len(rank)] == rank) & (rank > 0))


def contexts(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each stretch of bytes."""
    words = _words_at(np.concatenate([data, np.zeros(16, np.uint8)]))
    size = end - begin
    h = mix(size.astype(np.uint64), 5)
    for j in range(0, int(size.max(initial=0)), 8):
        left = size - j
        live = left > 0
        w = words[np.where(live, begin + j, 0)]
        part = live & (left < 8)
        w = np.where(part, w & ((np.uint64(1) << (8 * np.clip(left, 0, 7)).astype(np.uint64)) - np.uint64(1)), w)
        with np.errstate(over="ignore"):
            h = np.where(live, mix(h * np.uint64(0xD6E8FEB86659FD93) + w, 9), h)
    return h, size


def document_anchors(rows: DataFrame, length: int) -> DataFrame:
    """An anchor row (span 0) per different anchor and context of a task, and spans that repeat there."""
    shape = arrow_schema(_ANCHOR)
    gram = min(GRAM, length)

    def task(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size = 0

        def combined() -> pa.RecordBatch:
            nonlocal held, size
            h, c, key, place = (np.concatenate(x) for x in zip(*held, strict=True))
            held, size = [], 0
            order = np.lexsort((place, key, c, h))
            h, c, key, place = h[order], c[order], key[order], place[order]
            first = np.ones(len(h), bool)
            first[1:] = (h[1:] != h[:-1]) | (c[1:] != c[:-1])
            more = ~first
            rest_key, rest_place, rest_span = merged(key[more], place[more], length, gram)
            columns = [
                np.concatenate([h[first].astype(np.int64), mix(rest_key.astype(np.uint64) ^ rest_place.astype(np.uint64)).astype(np.int64)]),
                np.concatenate([c[first].astype(np.int64), np.zeros(len(rest_key), np.int64)]),
                np.concatenate([key[first], rest_key]), np.concatenate([place[first], rest_place]),
                np.concatenate([np.zeros(int(first.sum()), np.int64), rest_span]),
            ]
            return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], schema=shape)

        for frame in text_batches(frames, "text", BATCH):
            data, at = _bytes(frame.column("text"))
            where = anchors(data, at, length)
            if not len(where):
                continue
            owner = np.searchsorted(at, where, "right") - 1
            begin = np.maximum(where - (length - gram), at[owner])
            end = np.minimum(where + length, at[owner + 1])
            c, _ = contexts(data, begin, end)
            with np.errstate(over="ignore"):
                c = mix(c + (where - begin).astype(np.uint64), 2)
            h, _ = contexts(data, where, where + gram)
            key = frame.column("key").to_numpy()[owner]
            ordinal = frame.column("ordinal").to_numpy()[owner].astype(np.int64)
            held.append((h, c, key, (ordinal << _PLACE) + where - at[owner]))
            size += len(data)
            if size >= COMBINE:
                yield combined()
        if held:
            yield combined()

    return rows.mapInArrow(task, _ANCHOR)


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def merged(key: np.ndarray, place: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Contexts of anchors at ``place`` as few long spans; the end may lie behind the text's."""
    low = place - np.minimum(place & ((1 << _PLACE) - 1), length - gram)
    return union(key, low, place + length - low)


def union(key: np.ndarray, place: np.ndarray, span: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping and touching spans of a text as one."""
    if not len(key):
        return key, place, span
    order = np.lexsort((place, key))
    key, place, end = key[order], place[order], (place + span)[order]
    fresh = np.ones(len(key), bool)
    fresh[1:] = key[1:] != key[:-1]
    group = np.cumsum(fresh) - 1
    # running ends, started anew for each text: ranks keep them apart
    order_end = np.argsort(end, kind="stable")
    rank = np.empty(len(end), np.int64)
    rank[order_end] = np.arange(len(end))
    top = np.maximum.accumulate(group * len(end) + rank) % len(end)
    reach = end[order_end][top]
    start = fresh.copy()
    start[1:] |= place[1:] > reach[:-1]
    begins = np.flatnonzero(start)
    lasts = np.append(begins[1:], len(key)) - 1
    return key[begins], place[begins], reach[lasts] - place[begins]


def repeated_contexts(rows: DataFrame, length: int) -> DataFrame:
    """kind 0: a span that goes; kind 1: the first of its context, where its anchor has others."""
    shape = arrow_schema(_FOUND)
    gram = min(GRAM, length)

    def task(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = gathered(frames, arrow)
        h, c, key, place, span = (table.column(x).to_numpy() for x in ("h", "c", "key", "place", "span"))
        known = span > 0
        order = np.flatnonzero(~known)
        order = order[np.lexsort((place[order], key[order], c[order], h[order]))]
        hs, cs = h[order], c[order]
        fresh_h = np.ones(len(order), bool)
        fresh_h[1:] = hs[1:] != hs[:-1]
        first = fresh_h.copy()
        first[1:] |= cs[1:] != cs[:-1]
        group = np.cumsum(fresh_h) - 1
        kinds = np.bincount(group, first, minlength=1)[group] if len(order) else np.zeros(0)
        later, open_ = order[~first], order[first & (kinds > 1)]
        low_key, low_place, low_span = merged(key[later], place[later], length, gram)
        out = [
            np.concatenate([np.zeros(int(known.sum()) + len(low_key), np.int32), np.ones(len(open_), np.int32)]),
            np.concatenate([key[known], low_key, key[open_]]), np.concatenate([place[known], low_place, place[open_]]),
            np.concatenate([span[known], low_span, np.zeros(len(open_), np.int64)]),
            np.concatenate([np.zeros(int(known.sum()) + len(low_key), np.int64), h[open_]]),
            np.concatenate([np.zeros(int(known.sum()) + len(low_key), np.int64), kinds[first & (kinds > 1)].astype(np.int64)]),
        ]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], schema=shape)

    arrow = arrow_schema(_ANCHOR)
    return settle(rows.repartition("h").mapInArrow(task, _FOUND))


# --- suffix arrays -------------------------------------------------------------------


def suffix_order(text: np.ndarray) -> np.ndarray:
    """The suffix array.

    Larsson-Sadakane: a group's number is the place of its last member. Suffixes that
    agree in h bytes are sorted by the groups of the suffixes h bytes on, which doubles
    h; groups of one are done and not touched again.
    """
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    head = _words_at(padded)[:n].byteswap()
    # the last suffixes are shorter than a word: each stands before its equals, the shortest first
    whole = max(0, n - 7)
    order = np.argsort(head[:whole])
    last = np.arange(n - 1, whole - 1, -1)
    last = last[np.argsort(head[last], kind="stable")]
    order = np.insert(order, np.searchsorted(head[order], head[last], "left"), last)
    sorted_head = head[order]
    tail = np.minimum(n - order, 8)
    fresh = np.ones(n, bool)
    fresh[1:] = (sorted_head[1:] != sorted_head[:-1]) | (tail[1:] != tail[:-1])
    rank = np.empty(n, np.int64)

    def number(places: np.ndarray, fresh: np.ndarray) -> np.ndarray:
        begins = np.flatnonzero(fresh)
        ends = np.append(begins[1:], len(places)) - 1
        rank[order[places]] = np.repeat(places[ends], ends - begins + 1)
        single = ends == begins
        return np.repeat(~single, ends - begins + 1)

    places = np.arange(n)
    places = places[number(places, fresh)]
    h = 8
    while len(places):
        suffixes = order[places]
        ahead = suffixes + h
        # group and what follows, as one number
        both = rank[suffixes] * (n + 1) + np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        inner = np.argsort(both)
        order[places] = suffixes[inner]
        both = both[inner]
        fresh = np.ones(len(places), bool)
        fresh[1:] = both[1:] != both[:-1]
        places = places[number(places, fresh)]
        h *= 2
    return order


def common_prefixes(text: np.ndarray, order: np.ndarray, begin: np.ndarray, size: np.ndarray, most: int) -> np.ndarray:
    """Bytes that each suffix shares with the one before it in ``order``, up to ``most``; by suffix.

    Kasai's rule, one lane for each stretch of text: a suffix shares at least one byte
    less than the suffix before it in the text, so a lane only goes on from there.
    """
    n = len(text)
    padded = np.concatenate([text, np.zeros(most + 16, np.uint8)])
    words = _words_at(padded)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    before = np.where(place > 0, order[place - 1], -1)
    shared = np.zeros(n, np.int64)
    h = np.zeros(len(begin), np.int64)
    for step in range(int(size.max(initial=0))):
        lanes = np.flatnonzero(step < size)
        i = begin[lanes] + step
        j = before[i]
        got = np.maximum(h[lanes] - 1, 0)
        got[j < 0] = 0
        live = np.flatnonzero(j >= 0)
        while len(live):
            room = np.minimum(most, n - np.maximum(i[live], j[live])) - got[live]
            differ = words[i[live] + got[live]] ^ words[j[live] + got[live]]
            low = differ & (~differ + np.uint64(1))
            equal = np.where(differ == 0, 8, (np.log2(np.maximum(low, 1).astype(np.float64)).astype(np.int64)) // 8)
            add = np.minimum(equal, np.maximum(room, 0))
            got[live] += add
            live = live[(equal == 8) & (room > 8)]
        h[lanes] = got
        shared[i] = got
    return shared


@dataclass
class Shard:
    """Different windows of a shard in sorted order, where each starts first, and windows that repeat in it."""

    text: np.ndarray
    at: np.ndarray  # where the windows are in the text
    length: int
    key: np.ndarray
    place: np.ndarray
    gone_key: np.ndarray
    gone_place: np.ndarray

    @cached_property
    def rows(self) -> np.ndarray:
        """The windows' bytes as big-endian numbers, one row each."""
        words = _words_at(np.concatenate([self.text, np.zeros(8, np.uint8)]))
        columns = []
        for j in range(0, self.length, 8):
            w = words[self.at + j].byteswap()
            if self.length - j < 8:
                w = w >> np.uint64(8 * (8 - (self.length - j)))
            columns.append(w)
        return np.stack(columns, axis=1)


def build_shard(content: list[bytes], key: np.ndarray, place: np.ndarray, length: int) -> Shard:
    """``content`` starts at ``place`` of text ``key``; each has ``length`` bytes at least."""
    text = np.frombuffer(b"".join(content), np.uint8)
    size = np.fromiter(map(len, content), np.int64, len(content))
    begin = np.cumsum(size) - size
    order = suffix_order(text)
    shared = common_prefixes(text, order, begin, size, length)
    same = shared[order] >= length  # as the suffix before
    group = np.cumsum(~same)
    owner_of = np.repeat(np.arange(len(content)), size)
    left = begin[owner_of] + size[owner_of] - np.arange(len(text))  # bytes to the end of the content
    whole = left[order] >= length
    starts, group = order[whole], group[whole]
    keys = key[owner_of[starts]]
    places = place[owner_of[starts]] + starts - begin[owner_of[starts]]
    fresh = np.ones(len(starts), bool)
    fresh[1:] = group[1:] != group[:-1]
    # groups lie together already; only those of several windows need their first one found
    several = np.zeros(len(starts), bool)
    several[1:] |= ~fresh[1:]
    several[:-1] |= ~fresh[1:]
    some = np.flatnonzero(several)
    some = some[np.lexsort((places[some], keys[some], group[some]))]
    first = np.ones(len(some), bool)
    first[1:] = group[some][1:] != group[some][:-1]
    leader = some[first][np.cumsum(first) - 1]
    # a place may be there twice, in neighbouring contexts: it doesn't repeat itself
    gone = some[(keys[some] != keys[leader]) | (places[some] != places[leader])]
    kept = np.flatnonzero(~several)
    kept = np.sort(np.concatenate([kept, some[first]]))
    return Shard(text, starts[kept], length, keys[kept], places[kept], keys[gone], places[gone])


def search(rows: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Where each wanted window stands among sorted windows, by binary search; -1 where it doesn't."""
    low, high = np.zeros(len(wanted), np.int64), np.full(len(wanted), len(rows), np.int64)
    while (open_ := np.flatnonzero(low < high)).size:
        mid = (low[open_] + high[open_]) // 2
        less, tied = np.zeros(len(open_), bool), np.ones(len(open_), bool)
        for j in range(rows.shape[1]):
            a, b = rows[mid, j], wanted[open_, j]
            less |= tied & (a < b)
            tied &= a == b
            if not tied.any():
                break
        low[open_] = np.where(less, mid + 1, low[open_])
        high[open_] = np.where(less, high[open_], mid)
    at = np.minimum(low, max(len(rows) - 1, 0))
    if not len(rows):
        return np.full(len(wanted), -1)
    return np.where((rows[at] == wanted).all(axis=1), at, -1)


def merge_shards(shards: list[Shard]) -> tuple[np.ndarray, np.ndarray]:
    """Starts of windows that start earlier in another place of any shard."""
    keys, places = [s.gone_key for s in shards], [s.gone_place for s in shards]
    for i, s in enumerate(shards):
        late = np.zeros(len(s.key), bool)
        for j, o in enumerate(shards):
            if i != j:
                at = search(o.rows, s.rows)
                hit = at >= 0
                k, p = o.key[at], o.place[at]
                late |= hit & ((k < s.key) | ((k == s.key) & (p < s.place)))
        keys.append(s.key[late])
        places.append(s.place[late])
    return np.concatenate(keys), np.concatenate(places)


# --- contexts to shards ------------------------------------------------------------


def cut_contexts(rows: DataFrame, open_: DataFrame, length: int) -> DataFrame:
    """Contexts that must be compared, with their bytes, cut from their texts."""
    shape = arrow_schema(_CONTEXT)
    gram = min(GRAM, length)
    byte = F.col("place").bitwiseAND(F.lit((1 << _PLACE) - 1))
    wanted = open_.groupBy("key", F.shiftright("place", _PLACE).cast("int").alias("ordinal")).agg(
        F.collect_list(F.struct(byte.alias("at"), "h", (F.col("contexts") > MANY).alias("many"))).alias("wanted")
    )

    def task(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in text_batches(frames, "text", 4 * BATCH):
            out: list[tuple[object, ...]] = []
            windows: dict[bytes, tuple[int, int]] = {}
            repeats: list[tuple[int, int]] = []
            for key, ordinal, text, wanted in zip(*[frame.column(c).to_pylist() for c in ("key", "ordinal", "text", "wanted")], strict=True):
                raw, base = (text or "").encode("utf-8", "surrogatepass"), ordinal << _PLACE
                for w in wanted:
                    low = max(0, w["at"] - (length - gram))
                    content = raw[low : w["at"] + length]
                    if not w["many"]:
                        out.append((1, w["h"], key, base + low, w["at"] - low, content))
                        continue
                    for o in range(len(content) - length + 1):
                        window, place = content[o : o + length], (key, base + low + o)
                        known = windows.setdefault(window, place)
                        if known != place:
                            windows[window] = min(known, place)
                            repeats.append(max(known, place))
            for window, (key, place) in windows.items():
                route = int.from_bytes(hashlib.blake2b(window, digest_size=8).digest(), "little", signed=True)
                out.append((2, route, key, place, 0, window))
            if repeats:
                k, p, s = union(np.array([x[0] for x in repeats]), np.array([x[1] for x in repeats]), np.full(len(repeats), length))
                out += [(0, a ^ b, a, b, c, None) for a, b, c in zip(k.tolist(), p.tolist(), s.tolist(), strict=True)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), shape, strict=True)], schema=shape)

    return rows.join(wanted, ["key", "ordinal"]).select("key", "ordinal", "text", "wanted").mapInArrow(task, _CONTEXT)


def _sides(text: np.ndarray, start: np.ndarray, size: np.ndarray, step: int, width: int) -> np.ndarray:
    """The ``size`` bytes from each start on, forwards or backwards, filled up with zeros."""
    at = np.arange(width)
    index = start[:, None] + step * at
    return np.where(at < size[:, None], text[np.clip(index, 0, len(text) - 1)], np.uint8(0))


def _most_shared(route: np.ndarray, side: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The longest prefix that each side shares with another of the same route: its neighbours' in sorted order."""
    words = np.ascontiguousarray(side).view(">u8").astype(np.uint64)
    order = np.lexsort((size, *words.T[::-1], route))  # zeros that fill up come before zeros of a text
    one, other = order[1:], order[:-1]
    equal = side[one] == side[other]
    shared = np.where(equal.all(axis=1), side.shape[1], equal.argmin(axis=1))
    shared = np.minimum(shared, np.minimum(size[one], size[other]))
    shared[route[one] != route[other]] = -1
    most = np.full(len(route), -1)
    most[one] = shared
    most[other] = np.maximum(most[other], shared)
    return most


def cut_back(content: list[bytes], route: np.ndarray, before: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """How many bytes of each context can be cut at its start, and how many can stay; none if no window is shared.

    A window that two contexts share reaches over what they share before and behind
    the anchor, so what a context shares with none of its route is of no use.
    """
    gram = min(GRAM, length)
    width = -(-max(length - gram, 1) // 8) * 8
    text = np.frombuffer(b"".join(content), np.uint8)
    size = np.fromiter(map(len, content), np.int64, len(content))
    begin = np.cumsum(size) - size
    after = size - before - gram
    left = _most_shared(route, _sides(text, begin + before - 1, before, -1, width), before)
    right = _most_shared(route, _sides(text, begin + before + gram, after, 1, width), after)
    stay = np.where(left >= 0, left + gram + right, 0)
    return before - left, np.where(stay >= length, stay, 0)


def repeated_windows(found: DataFrame, length: int, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Spans of windows that start earlier elsewhere, from contexts brought together."""
    shape, arrow = arrow_schema(_SPAN), arrow_schema(_CONTEXT)

    def shared(content: list[bytes], route: np.ndarray, key: np.ndarray, place: np.ndarray) -> list[tuple[np.ndarray, ...]]:
        """Spans of contexts that are ordered by key and place: repeats of whole ones, then of windows."""
        first: dict[tuple[int, bytes], int] = {}
        again = [i for i, x in enumerate(zip(route.tolist(), content, strict=True)) if first.setdefault(x, i) != i]
        # the same bytes may have come by two anchors
        again = [i for i in again if (j := first[route[i], content[i]]) >= 0 and (key[i] != key[j] or place[i] != place[j])]
        spans = [(key[again], place[again], np.fromiter((len(content[i]) for i in again), np.int64, len(again)))]
        kept = sorted(first.values())
        shards, start, size = [], 0, 0
        for e, i in enumerate(kept):
            size += len(content[i])
            if size >= shard_bytes or e == len(kept) - 1:
                part = kept[start : e + 1]
                shards.append(build_shard([content[i] for i in part], key[part], place[part], length))
                start, size = e + 1, 0
        if shards:
            k, p = merge_shards(shards)
            spans.append((k, p, np.full(len(k), length)))
        return spans

    def task(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = gathered(frames, arrow).sort_by([("kind", "ascending"), ("route", "ascending")])
        kind, route, key, place, span = (table.column(c).to_numpy() for c in ("kind", "route", "key", "place", "span"))
        content = table.column("content")
        spans = [(key[kind == 0], place[kind == 0], span[kind == 0])]
        # windows that came by their own bytes: all but the first go
        windows = np.flatnonzero(kind == 2)
        windows = windows[np.lexsort((place[windows], key[windows], route[windows]))]
        first: dict[bytes, int] = {}
        late = [i for i, w in zip(windows.tolist(), content.take(pa.array(windows)).to_pylist(), strict=True) if first.setdefault(w, i) != i]
        spans.append((key[late], place[late], np.full(len(late), length)))
        rows = np.flatnonzero(kind == 1)
        heads = np.flatnonzero(np.diff(route[rows], prepend=0) != 0) if len(rows) else rows
        start = 0
        while start < len(rows):  # chunks end where a route ends
            at = np.searchsorted(heads, start + CHUNK)
            stop = int(heads[at]) if at < len(heads) else len(rows)
            part = rows[start:stop]
            part = part[np.lexsort((place[part], key[part]))]
            raw = content.take(pa.array(part)).to_pylist()
            cut, stay = cut_back(raw, route[part], span[part], length)
            use = np.flatnonzero(stay)
            if len(use):
                trimmed = [raw[i][a : a + n] for i, a, n in zip(use.tolist(), cut[use].tolist(), stay[use].tolist(), strict=True)]
                spans += shared(trimmed, route[part][use], key[part][use], place[part][use] + cut[use])
            start = stop
        k, p, s = union(*(np.concatenate(x) for x in zip(*spans, strict=True)))
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (k, p, s)], schema=shape)

    return found.repartition("route").mapInArrow(task, _SPAN)


# --- documents ------------------------------------------------------------------------


# names of added columns that no other column has
_KEY, _ORDINAL, _SPANS = "__passage_key", "__passage_ordinal", "__passage_spans"
_OWN = (_KEY, _ORDINAL, _SPANS, "__k", "__o")


def keyed(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """All columns, a key and an ordinal: rows that repeat an id and a text are one, other texts under one id are numbered."""
    rows = docs.withColumn(_KEY, F.coalesce(F.col(id_column).cast("long"), F.lit(-(2**63)).cast("long")))
    if not rows.groupBy(_KEY).count().filter("count > 1").head(1):
        return rows.withColumn(_ORDINAL, F.lit(0))
    order = Window.partitionBy(_KEY).orderBy(F.xxhash64("text"), "text")
    return settle(rows.dropDuplicates([_KEY, "text"]).withColumn(_ORDINAL, F.row_number().over(order) - 1))


def repeated_spans(rows: DataFrame, length: int = 100) -> DataFrame:
    """key, ordinal, spans of the keyed texts that lose bytes; spans are pieces of [start, end) in any order."""
    texts = rows.select(F.col(_KEY).alias("key"), F.col(_ORDINAL).alias("ordinal"), "text")
    found = repeated_contexts(document_anchors(texts, length), length)
    let_go(rows.sparkSession)
    cut = cut_contexts(texts, found.filter("kind = 1"), length)
    spans = found.filter("kind = 0").select("key", "place", "span").unionByName(repeated_windows(cut, length))
    byte = F.col("place").bitwiseAND(F.lit((1 << _PLACE) - 1))
    return spans.groupBy("key", F.shiftright("place", _PLACE).cast("int").alias("ordinal")).agg(
        F.collect_list(F.struct(byte.alias("start"), (byte + F.col("span")).alias("end"))).alias("spans")
    )


def _kept(raw: bytes, spans: list[dict[str, int]] | None) -> tuple[bytes, int]:
    """The remaining bytes and the number of removed runs."""
    runs: list[list[int]] = []
    for a, b in sorted((s["start"], min(s["end"], len(raw))) for s in spans or ()):
        if runs and a <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], b)
        else:
            runs.append([a, b])
    edges = [0, *(x for r in runs for x in r), len(raw)]
    return b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)), len(runs)


def _apply(rows: DataFrame, length: int) -> DataFrame:
    spans = settle(repeated_spans(rows, length))
    let_go(rows.sparkSession)
    spans = spans.select(F.col("key").alias("__k"), F.col("ordinal").alias("__o"), F.col("spans").alias(_SPANS))
    return rows.join(spans, (rows[_KEY] == spans["__k"]) & (rows[_ORDINAL] == spans["__o"]), "left").drop("__k", "__o")


def removed_passages(docs: DataFrame, length: int = 100) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of each document.

    Texts are UTF-8 bytes, a null text has none. Documents stand in the order of their
    ids, a null id first; rows that repeat an id and a text are one document, other
    texts under one id follow each other by hash. Texts of fewer than ``length`` bytes
    keep all. An empty table gives no row; other columns are not read.
    """
    columns = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    shape = arrow_schema(columns)

    def task(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in text_batches(frames, "text"):
            out = []
            for key, text, spans in zip(*[frame.column(c).to_pylist() for c in ("doc_id", "text", _SPANS)], strict=True):
                raw = (text or "").encode("utf-8", "surrogatepass")
                left, runs = _kept(raw, spans)
                out.append((key, len(raw), len(raw) - len(left), runs, hashlib.sha256(left).hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), shape, strict=True)], schema=shape)

    rows = keyed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    return _apply(rows, length).select("doc_id", "text", _SPANS).mapInArrow(task, columns)


def without_repeats(docs: DataFrame, length: int = 100) -> DataFrame:
    """``docs`` with the repeated passages cut out of ``text``; rows of which nothing is left go.

    A cut inside a character takes the whole character. ``n_chars`` is set anew where
    there is one. A row that had no text stays. Other columns may have any name.
    """
    names, shape = docs.columns, docs.schema
    where = {n: i for i, n in enumerate(names)}
    docs = set_apart(docs, _OWN)
    inner = docs.columns

    def task(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in text_batches(frames, "text"):
            texts, spans = frame.column("text").to_pylist(), frame.column(_SPANS).to_pylist()
            new = [t if not s else _kept(t.encode("utf-8", "surrogatepass"), s)[0].decode("utf-8", "ignore") for t, s in zip(texts, spans, strict=True)]
            arrays = [frame.column(n) for n in inner]
            arrays[where["text"]] = pa.array(new, arrays[where["text"]].type)
            if "n_chars" in where:
                sizes = [old if not s else len(t) for old, t, s in zip(frame.column("n_chars").to_pylist(), new, spans, strict=True)]
                arrays[where["n_chars"]] = pa.array(sizes, arrays[where["n_chars"]].type)
            out = pa.RecordBatch.from_arrays(arrays, names=names)
            yield out.filter(pa.array([bool(n) or not o for n, o in zip(new, texts, strict=True)]))

    return _apply(keyed(docs), length).select(*inner, _SPANS).mapInArrow(task, shape)
