"""Whole-text token ids with a memo of pieces that earlier texts already had.

The byte-level pattern never runs across the boundary before a single space that a
non-space character follows, so a text may be cut there and its chunks encoded
apart. A batch has few different chunks, and these fewer pieces; those that the memo does
not have go to the tokenizer. A full memo keeps the last batch's pieces alone. Chunks,
pieces and ids stay in Arrow: a worker holds no Python object for any that it remembers.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_CUT = re.compile(r" (?=\S)")
# Chunks of visible ASCII, Latin letters and single line ends between them.
_LATIN = "A-Za-zÀ-ÖØ-öø-ɏ"
_KNOWN = rf"\A[!-~{_LATIN}]+(?:\n[!-~{_LATIN}]+)*\z"
_ALL_KNOWN = re.compile(f"[!-~{_LATIN}]+(?:[ \n][!-~{_LATIN}]+)*")
# An empty chunk, or one that begins with what either library takes for white space.
_ODD = r"^(?:$|[\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}])"
# The public pattern of the vocabulary, narrowed to those characters.
_PIECES = re.compile(rf"'(?:s|t|re|ve|m|ll|d)| ?[{_LATIN}]+| ?[0-9]+| ?[^\s{_LATIN}0-9]+|\n")
MEMO_CHUNKS = 200_000
#: Bytes that a piece of the memo and its ids may have on average.
PIECE_BYTES = 200


def byte_alphabet() -> dict[int, str]:
    """The public table from byte to character: printable bytes stand for themselves, others follow from 256."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in kept]
    return {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(others)}


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    """Where a public vocabulary lies on this machine; it is on every worker."""
    import public_tokenizers

    return public_tokenizers.path(name)


def vocabulary_size(path: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).get_vocab_size()


def _offsets(values: pa.Array) -> np.ndarray:
    """Where each value of a binary array begins in its buffer, the end last."""
    return np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1]


def _binary(ids: list[list[int]]) -> pa.Array:
    """Lists of ids as values of little-endian unsigned 32-bit integers."""
    flat = np.fromiter(chain.from_iterable(ids), "<u4")
    ends = np.cumsum([0, *map(len, ids)], dtype=np.int64) * 4
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(ends), pa.py_buffer(flat)])


def _joined(values: pa.Array, between: str) -> str:
    """All values as one text; below 1 GB without a Python object for each."""
    if values.nbytes > 1 << 30:
        return between.join(values.to_pylist())
    whole = pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values.cast(pa.string()))
    return pc.binary_join(whole, between)[0].as_py()


class Encoder:
    """Ids of byte-level texts, as the tokenizer gives them for the whole text.

    A null text counts as empty and has no ids. Strings of special tokens in a
    text are ordinary text.
    """

    def __init__(self, path: str, memo_chunks: int = MEMO_CHUNKS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        size = self.tokenizer.get_vocab_size()
        vocabulary = json.loads(self.tokenizer.to_str())["model"]["vocab"]
        self.vocab_size = size
        #: bytes that each id stands for: one character of the byte alphabet is one byte
        self.n_bytes = np.zeros(size, np.int64)
        for token, i in vocabulary.items():
            self.n_bytes[i] = len(token)
        self.alphabet = byte_alphabet()
        self.memo_chunks = memo_chunks
        self._forget()

    def _forget(self) -> None:
        self.memo, self.memo_ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())

    def _plain(self, texts: list[str]) -> pa.Array:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return _binary([e.ids for e in encoded])

    def _merged(self, pieces: pa.Array) -> pa.Array:
        """Ids of pieces of the public pattern: they go to the vocabulary's merges."""
        if not len(pieces):
            return _binary([])
        shown = _joined(pieces, "\0")
        merge = self.tokenizer.model.tokenize
        split = shown.encode().decode("latin-1").translate(self.alphabet).split(self.alphabet[0])
        return _binary([[t.id for t in merge(text)] for text in split])

    def _learnt(self, keys: pa.Array, n_pieces: int) -> pa.Array:
        """Ids of distinct keys; the first ``n_pieces`` are pieces of the public pattern, the others chunks and their space."""
        place = pc.index_in(keys, value_set=self.memo)
        missing = np.flatnonzero(place.is_null().to_numpy(zero_copy_only=False))
        if not len(missing):
            return self.memo_ids.take(place)
        cut = int(np.searchsorted(missing, n_pieces))
        new = keys.take(pa.array(missing))
        new_ids = pa.concat_arrays([self._merged(new[:cut]), self._plain(new[cut:].to_pylist())])
        slot = place.fill_null(0).to_numpy().astype(np.int64)
        slot[missing] = len(self.memo) + np.arange(len(missing))
        memo, memo_ids = pa.concat_arrays([self.memo, new]), pa.concat_arrays([self.memo_ids, new_ids])
        found = memo_ids.take(pa.array(slot))
        for kept in ((memo, memo_ids), (keys, found)):
            if len(kept[0]) <= self.memo_chunks and sum(x.nbytes for x in kept) <= self.memo_chunks * PIECE_BYTES:
                self.memo, self.memo_ids = kept
                break
        else:
            self._forget()
        return found

    def _known(self, chunks: pa.Array) -> pa.Array:
        """Ids of distinct chunks that follow a space."""
        if not len(chunks):
            return _binary([])
        joined, known = _joined(chunks, " "), np.ones(len(chunks), bool)
        if not _ALL_KNOWN.fullmatch(joined):
            known = pc.match_substring_regex(chunks, _KNOWN).to_numpy(zero_copy_only=False)
            joined = _joined(chunks.filter(pa.array(known)), " ")
        pieces = pa.array(_PIECES.findall(" " + joined) if known.any() else [], pa.large_string())
        others = pa.array([" " + c for c in chunks.filter(pa.array(~known)).to_pylist()], pa.large_string())
        coded = pa.concat_arrays([pieces, others]).dictionary_encode()
        which = coded.indices.to_numpy()
        n_pieces = int(which[: len(pieces)].max(initial=-1)) + 1
        ids = self._learnt(coded.dictionary, n_pieces).take(coded.indices)
        # a chunk begins with the piece that has its space
        starts = np.flatnonzero(pc.starts_with(pieces, " ").to_numpy(zero_copy_only=False))
        order = np.empty(len(chunks), np.int64)
        order[known] = np.arange(len(starts))
        order[~known] = len(starts) + np.arange(len(others))
        begin = np.concatenate([starts, len(pieces) + np.arange(len(others) + 1)])
        chunk_ids = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(chunks), [None, pa.py_buffer(_offsets(ids)[begin]), ids.buffers()[2]]
        )
        return chunk_ids if known.all() else chunk_ids.take(pa.array(order))

    def _rare(self, texts: list[str]) -> list[bytes]:
        """Ids of texts in which white space follows a space: they are cut only where a word follows."""
        split = [_CUT.split(t) for t in texts]
        different = list(dict.fromkeys(c for s in split for c in s[1:]))
        known = dict(zip(different, self._known(pa.array(different, pa.string())).to_pylist(), strict=True))
        heads = self._plain([s[0] for s in split]).to_pylist()
        return [h + b"".join([known[c] for c in s[1:]]) for h, s in zip(heads, split, strict=True)]

    def arrays(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, one after the other, and where each text's begin, the end last."""
        n = len(texts)
        split = pc.split_pattern(texts.fill_null(""), " ")
        place = np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy())])
        coded = split.flatten().dictionary_encode()
        del split
        which, chunks = coded.indices.to_numpy(), coded.dictionary
        heads = place[:-1]
        later = np.ones(len(which), bool)
        later[heads] = False
        # the first chunk of a text has no space in front
        follows = np.zeros(len(chunks), bool)
        follows[which[later]] = True
        odd = pc.match_substring_regex(chunks, _ODD).to_numpy(zero_copy_only=False) & follows
        rare = np.unique(np.searchsorted(place, np.flatnonzero(odd[which] & later), "right") - 1).tolist()
        used = np.flatnonzero(follows & ~odd)
        front, back = np.unique(which[heads], return_inverse=True)
        ids = pa.concat_arrays([self._known(chunks.take(pa.array(used))), self._plain(chunks.take(pa.array(front)).to_pylist())])
        slot = np.zeros(len(chunks), np.int32)
        slot[used] = np.arange(len(used))
        taken = slot[which]
        taken[heads] = len(used) + back
        picked = ids.take(pa.array(taken))
        ends = _offsets(picked) // 4
        out = np.frombuffer(picked.buffers()[2] or b"", "<u4", ends[-1])
        at = ends[place]
        if not rare:
            return out, at
        parts = [out[a:b] for a, b in zip(at.tolist(), at[1:].tolist(), strict=False)]
        for i, raw in zip(rare, self._rare(texts.take(pa.array(rare)).to_pylist()), strict=True):
            parts[i] = np.frombuffer(raw, "<u4")
        return np.concatenate(parts), np.cumsum([0, *map(len, parts)])[: n + 1]

    def ids(self, texts: pa.Array | Sequence[str | None]) -> list[np.ndarray]:
        """Ids of each text."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        if not len(texts):
            return []
        out, at = self.arrays(texts)
        return [out[a:b] for a, b in zip(at.tolist(), at[1:].tolist(), strict=False)]

    def raw_ids(self, texts: pa.Array | Sequence[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        return [ids.tobytes() for ids in self.ids(texts)]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each worker process and vocabulary."""
    return Encoder(path)
