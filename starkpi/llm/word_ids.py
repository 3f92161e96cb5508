"""Token ids of whole texts by a word-level BPE tokenizer of the tokenizers library.

The library's own encoding spends most of its time on normalising and cutting words that it
has met before.  The tokenizer drops blanks and joins nothing over them, so that a text can
be cut beforehand: numpy finds the pieces that the tokenizer's own pattern would cut, Arrow
numbers the distinct ones, and each of those is encoded once, remembered in a bounded cache
(at every overflow only the pieces of the batch at hand stay; others are encoded again when
they come back) and put in place by its number.

Pieces are cut from words of printable ASCII and the Latin letters of Latin-1, for which
normalising means lower case and nothing else.  Any other word, and any with an apostrophe
or the first character of a special token, is one piece that the library normalises and cuts.  ``Words`` checks that the tokenizer is of
this kind and has the library encode whole texts if it is not."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Fixed value: the pattern by which the tokenizer cuts normalised text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

# Kinds of bytes.  The apostrophe may begin a contraction, so that words with it are odd.
_BLANK, _LETTER, _DIGIT, _MARK, _ODD = range(5)
_KIND = np.full(256, _ODD, np.uint8)
_KIND[0x21:0x7F] = _MARK
_KIND[list(b"\t\n\v\f\r ")] = _BLANK
_KIND[0x30:0x3A] = _DIGIT
_KIND[0x41:0x5B] = _KIND[0x61:0x7B] = _LETTER
_KIND[0x27] = _ODD
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
# A plain piece: letters in lower case, one digit, or marks.
_PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+|[0-9]|[!-&(-/:-@\[-`{-~]+")


class Words:
    """A tokenizer with a bounded cache of pieces, one per worker."""

    _held: dict[int, Words] = {}

    def __init__(self, data: bytes, entries: int = 300_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer
        self.whole = Tokenizer.from_str(data.decode())
        self.entries = entries
        self.known: dict[bytes, bytes] = {}
        parts = json.loads(data)
        cuts = (parts["pre_tokenizer"] or {}).get("pretokenizers") or [{}]
        self.plain = (cuts[0].get("pattern") == {"Regex": PATTERN}
                      and bool(parts["model"].get("end_of_word_suffix")) and cuts[-1].get("type") == "ByteLevel")
        # a word that may hold a special token is odd: the library finds such tokens before it cuts
        special = [t["content"] for t in parts.get("added_tokens") or []]
        self.plain &= all(not re.search(r"\s", t) for t in special)
        self.kind = _KIND.copy()
        self.kind[[t.encode()[0] for t in special if t]] = _ODD
        if self.plain:
            # pieces are cut and in lower case already: blanks alone part them
            parts["normalizer"] = None
            cuts[0].update(pattern={"String": " "}, behavior="Removed", invert=False)
            self.pieces = Tokenizer.from_str(json.dumps(parts))
            mark, vocabulary = parts["model"]["end_of_word_suffix"], self.pieces.get_vocab()
            self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
            for token, i in vocabulary.items():
                self.ends[i] = token.endswith(mark)

    @classmethod
    def of(cls, data: bytes) -> Words:
        key = hash(data)
        if key not in cls._held:
            cls._held.clear()
            cls._held[key] = cls(data)
        return cls._held[key]

    def _library(self, texts: list[str]) -> list[bytes]:
        found = self.whole.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(c.ids, "<u4").tobytes() for c in found]

    def _learn(self, fresh: list[bytes], together: int = 200) -> None:
        """Encode pieces, many in one text; an id that ends a word ends its piece."""
        groups = [fresh[i:i + together] for i in range(0, len(fresh), together)]
        for at in range(0, len(groups), 50):
            some = groups[at:at + 50]
            coded = self.pieces.encode_batch_fast([b" ".join(g).decode() for g in some], add_special_tokens=False)
            for group, c in zip(some, coded):
                ids = np.array(c.ids, "<u4")
                cut = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
                raw = ids.tobytes()
                if len(cut) == len(group):
                    self.known.update((w, raw[a:b]) for w, a, b in zip(group, [0, *cut], cut))
                else:  # a piece that the vocabulary cannot spell out
                    self.known.update(zip(group, self._library([x.decode() for x in group])))

    def _of_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of distinct pieces."""
        known = self.known
        fresh = [x for x in pieces if x not in known]
        if len(known) + len(fresh) > self.entries:
            known = self.known = {x: known[x] for x in pieces if x in known}
        plain, odd = [], []
        for x in fresh:
            (plain if _PLAIN.fullmatch(x) else odd).append(x)
        self._learn(plain)
        known.update(zip(odd, self._library([x.decode() for x in odd])))
        return [known[x] for x in pieces]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, where each text's end); NULL is empty."""
        if not self.plain:
            coded = self._library([t or "" for t in texts.to_pylist()])
            return np.frombuffer(b"".join(coded), "<u4"), np.cumsum([len(c) // 4 for c in coded], dtype=np.int64)
        pieces, ends = cut(pc.fill_null(texts.cast(pa.large_string()), ""), self.kind)
        coded = pieces.dictionary_encode()
        ids = self._of_pieces(coded.dictionary.to_pylist())
        pool = np.frombuffer(b"".join(ids), "<u4")
        size = np.fromiter(map(len, ids), np.int32, len(ids)) // 4
        first = np.cumsum(size, dtype=np.int32) - size
        at = coded.indices.to_numpy()
        size = size[at]
        done = np.cumsum(size, dtype=np.int64)
        place = np.arange(int(done[-1]) if len(done) else 0, dtype=np.int32)
        place += np.repeat(first[at] - (done - size).astype(np.int32), size)
        return pool[place], np.append(0, done)[ends]


def cut(texts: pa.LargeStringArray, kinds: np.ndarray = _KIND) -> tuple[pa.Array, np.ndarray]:
    """(pieces of all texts as one binary array, how many pieces each text and those before it
    have).  Pieces are runs of letters, runs of marks and single digits, letters in lower
    case; words that are not plain are one piece, as they stand."""
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(texts) + 1, 8 * texts.offset)
    raw = np.frombuffer(data or b"", np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    kind = kinds[raw]
    lead = np.flatnonzero(raw == 0xC3)  # two-byte letters of Latin-1
    second = raw[lead + 1]
    letter = (second != 0x97) & (second != 0xB7)
    kind[lead[letter]] = kind[lead[letter] + 1] = _LETTER
    lower = _LOWER[raw]
    lower[lead[letter & (second < 0x9F)] + 1] += 0x20
    edge = np.empty(len(raw) + 1, bool)
    edge[0] = edge[-1] = True
    np.not_equal(kind[1:], kind[:-1], out=edge[1:-1])
    edge[offsets] = True
    odd = np.flatnonzero(kind == _ODD)
    if len(odd):
        blank = kind == _BLANK
        start = ~blank
        start[1:] &= blank[:-1]
        start[offsets[:-1][offsets[:-1] < len(raw)]] |= ~blank[offsets[:-1][offsets[:-1] < len(raw)]]
        word = np.cumsum(start, dtype=np.int32)
        held = np.zeros(int(word[-1]) + 1, bool)
        held[word[odd]] = True
        held = held[word] & ~blank
        kind[held] = _ODD
        lower[held] = raw[held]
        np.not_equal(kind[1:], kind[:-1], out=edge[1:-1])
        edge[offsets] = True
    edge[:-1] |= kind == _DIGIT
    solid = kind != _BLANK
    starts = np.flatnonzero(edge[:-1] & solid)
    packed = lower[solid]
    before = np.cumsum(solid, dtype=np.int64)
    bounds = np.append(before[starts] - 1, len(packed))
    pieces = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(packed)])
    return pieces, np.searchsorted(starts, offsets[1:])


def with_end(flat: np.ndarray, ends: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """``encode``'s result with ``end_id`` behind every text."""
    return np.insert(flat, ends, end_id), ends + np.arange(1, len(ends) + 1)


def runs(column: pa.Array, limit: int = 6 << 20) -> Iterator[pa.Array]:
    """``column`` in runs of about ``limit`` bytes."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(column):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + limit, "right")))
        yield column.slice(at, stop - at)
        at = stop
