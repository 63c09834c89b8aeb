"""Token ids by the tokenizers library, with one library call for each distinct stretch of text.

Both vocabularies split a text before they merge, and never across the stretches used here, so ids of whole texts
are the ids of their stretches in order. Stretches are found and told apart as spans of bytes, in numpy for many texts
at once. Texts in which that does not hold (other white space than ASCII, special tokens) are encoded whole.
"""

from __future__ import annotations

import os
import re
from functools import cached_property
from itertools import accumulate, chain, pairwise

import numpy as np

from corpuslens.llm.words import SLICE_BYTES, span_hashes

CACHE_ENTRIES = 500_000
#: Stretches that the library gets in one text, and what parts them: no Latin text has this character.
JOINED, _PART = 50, "\ue000"
#: Latin letters that lower-casing and composition leave in this range.
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f"
#: Texts of these letters, ASCII and signs that are neither letters nor numbers: the vocabularies' own splits are exact
#: there and leave fewer different stretches.
_LATIN = re.compile(f"[\x00-\x7f{_LETTERS}\u00a1\u00a7\u00ab\u00b0\u00bb\u00bf\u2010-\u2027\u2030-\u205e]*")
#: Ranges of code points that are white space, or nearly, outside ASCII's. None but ASCII's are in _LATIN.
_OTHER_SPACE = [(0x1C, 0x1F), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x180E, 0x180E), (0x2000, 0x200F),
                (0x2028, 0x202F), (0x205F, 0x206F), (0x3000, 0x3000), (0xFEFF, 0xFEFF)]
_WHOLE = re.compile("<\\||[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in _OTHER_SPACE) + "]")
_ASCII_WHOLE = ["<|", "\x1c", "\x1d", "\x1e", "\x1f"]

#: Kinds of bytes; UTF-8 has no 0xFF, so it stands between texts.
_SPACE, _LETTER, _DIGIT, _SIGN, _GAP, _FOLLOWS = range(6)
_BREAK = 0xFF
_ANY = np.full(256, _SIGN, np.uint8)
_ANY[[0x20, *range(0x09, 0x0E)]] = _SPACE
_ANY[_BREAK] = _GAP
#: The Latin letters above ASCII begin with C3 to C5, the signs with C2 or E2.
_KIND = _ANY.copy()
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B), 0xC3, 0xC4, 0xC5]] = _LETTER
_KIND[0x30:0x3A] = _DIGIT
_KIND[0x80:0xC0] = _FOLLOWS


def _stretches(data: np.ndarray, latin: bool, keep_space: bool) -> tuple[np.ndarray, np.ndarray]:
    """(start, stop) of the stretches in texts that _BREAK parts; three of it have to follow the last.

    Latin texts: 's 't 're 've 'm 'll 'd, runs of letters, of digits (each alone unless spaces are kept) and of signs.
    Others: what white space parts. If spaces are kept, a blank belongs to the stretch behind it, the rest of a run of
    white space is a stretch of its own.
    """
    kind = (_KIND if latin else _ANY)[data]
    if latin and len(at := np.flatnonzero(kind == _FOLLOWS)):
        before = kind[at - 1]
        kind[at] = np.where(before == _FOLLOWS, kind[at - 2], before)
    begin = np.empty(len(data), bool)
    begin[0] = True
    np.not_equal(kind[1:], kind[:-1], out=begin[1:])
    if latin:
        if not keep_space:
            begin |= kind == _DIGIT
        at = np.flatnonzero(begin & (data == ord("'")))
        if keep_space:
            at = at[data[at - 1] != 0x20]
        one, two = data[at + 1], data[at + 2]
        short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
        long = (np.isin(one, np.frombuffer(b"rv", np.uint8)) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        at, size = at[short | long], np.where(short, 2, 3)[short | long]
        begin[at + 1] = False
        begin[(at + size)[kind[at + size] == _LETTER]] = True
    if keep_space:
        behind = np.flatnonzero((kind[1:] != _SPACE) & (kind[1:] != _GAP) & (kind[:-1] == _SPACE)) + 1
        begin[behind - 1] = True
        begin[behind[data[behind - 1] == 0x20]] = False
    start = np.flatnonzero(begin)
    stop = np.append(start[1:], len(data))
    kept = kind[start] != _GAP
    if not keep_space:
        kept &= kind[start] != _SPACE
    return start[kept], stop[kept]


def _same(data: np.ndarray, start: np.ndarray, other: np.ndarray, size: np.ndarray) -> bool:
    """Whether spans of the same sizes hold the same bytes."""
    ends, a = np.cumsum(size), 0
    while a < len(size):
        base = ends[a] - size[a]
        b = max(a + 1, int(np.searchsorted(ends, base + SLICE_BYTES, "right")))
        at = np.arange(ends[b - 1] - base) + np.repeat(start[a:b] - (ends[a:b] - size[a:b] - base), size[a:b])
        if not np.array_equal(data[at], data[at + np.repeat(other[a:b] - start[a:b], size[a:b])]):
            return False
        a = b
    return True


def _distinct(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the first span of each distinct one, for each span the number of its distinct one)."""
    _, first, of = np.unique(span_hashes(data, start, stop), return_index=True, return_inverse=True)
    size = stop - start
    if np.array_equal(size, size[first][of]) and _same(data, start, start[first][of], size):
        return first, of
    # Two stretches of one hash.
    raw, number = data.tobytes(), {}
    of = np.array([number.setdefault(raw[a:b], len(number)) for a, b in zip(start.tolist(), stop.tolist(), strict=True)])
    return np.unique(of, return_index=True)[1], of


class Encoder:
    """`keep_space`: whether the vocabulary has pieces with white space (byte-level) or drops it (word ends)."""

    def __init__(self, path: str, keep_space: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self._path = path
        self._keep_space = keep_space
        self._known: dict[bytes, bytes] = {}
        #: What was known before `_known` was begun; what is asked for again moves back.
        self._before: dict[bytes, bytes] = {}

    @cached_property
    def _tokenizer(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self._path)

    @cached_property
    def _plain(self):
        """For stretches of Latin texts, in lower case if spaces are dropped: nothing is left to normalize or split but
        at _PART, a token of its own here."""
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        plain = Tokenizer.from_file(self._path)
        if plain.normalizer is not None:
            plain.normalizer = normalizers.Sequence([])
        plain.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        plain.add_special_tokens([_PART])
        return plain

    def _ids(self, texts: list[str], latin: bool = False) -> list[bytes]:
        if latin:
            return self._joined_ids(texts)
        found = [x.ids for x in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        raw = np.fromiter(chain.from_iterable(found), np.uint32).tobytes()
        ends = list(accumulate(map(len, found), initial=0))
        return [raw[4 * i : 4 * j] for i, j in pairwise(ends)]

    def _joined_ids(self, stretches: list[str]) -> list[bytes]:
        """The ids of Latin stretches, JOINED of them in a text: a result for each costs more than its ids."""
        texts = [_PART.join(stretches[k : k + JOINED]) + _PART for k in range(0, len(stretches), JOINED)]
        found = self._plain.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.fromiter(chain.from_iterable(x.ids for x in found), np.uint32)
        parts = ids == self._plain.token_to_id(_PART)
        raw = ids[~parts].tobytes()
        ends = 4 * (np.flatnonzero(parts) - np.arange(len(stretches)))
        return [raw[i:j] for i, j in pairwise([0, *ends.tolist()])]

    def _look_up(self, stretches: list[bytes], latin: bool) -> list[bytes]:
        """The ids of different stretches; those not met lately are forgotten."""
        if len(self._known) + len(stretches) > CACHE_ENTRIES // 2:
            self._known, self._before = {}, self._known
        known = self._known
        found = list(map(known.get, stretches))
        missing = [k for k, x in enumerate(found) if x is None]
        old = list(map(self._before.get, [stretches[k] for k in missing]))
        new = [k for k, x in zip(missing, old, strict=True) if x is None]
        for k, x in zip(missing, old, strict=True):
            found[k] = x
        for e in range(0, len(new), 5_000):
            part = new[e : e + 5_000]
            for k, x in zip(part, self._ids([stretches[k].decode() for k in part], latin), strict=True):
                found[k] = x
        known.update((stretches[k], found[k]) for k in missing)
        return found

    def _kind(self, text: str) -> str:
        """whole, latin or any."""
        latin = text.isascii() or _LATIN.fullmatch(text)
        if any(x in text for x in _ASCII_WHOLE) if latin else _WHOLE.search(text):
            return "whole"
        return "latin" if latin else "any"

    def _encode_split(self, texts: list[str], latin: bool) -> list[bytes]:
        if latin and not self._keep_space:
            texts = [t.lower() for t in texts]
        parts = [t.encode() for t in texts]
        raw = bytes([_BREAK]).join(parts) + bytes([_BREAK] * 3)
        data = np.frombuffer(raw, np.uint8)
        start, stop = _stretches(data, latin, self._keep_space)
        first, of = _distinct(data, start, stop)
        different = [raw[a:b] for a, b in zip(start[first].tolist(), stop[first].tolist(), strict=True)]
        found = self._look_up(different, latin)
        # The ids of all stretches in a row, gathered from those of the different ones.
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        begin, n = np.cumsum(size) - size, size[of]
        ends = np.cumsum(n)
        ids = np.frombuffer(b"".join(found), np.uint32)[np.arange(n.sum()) + np.repeat(begin[of] - (ends - n), n)]
        text_ends = np.cumsum([len(p) + 1 for p in parts])
        cut = np.append(0, ends)[np.searchsorted(start, text_ends)]
        return [x.tobytes() for x in np.split(ids, cut)[:-1]]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, where each text begins and the end)."""
        kinds = [self._kind(t) for t in texts]
        raw = [b""] * len(texts)
        for kind in set(kinds):
            rows = [k for k, x in enumerate(kinds) if x == kind]
            some = [texts[k] for k in rows]
            for k, ids in zip(rows, self._ids(some) if kind == "whole" else self._encode_split(some, kind == "latin"), strict=True):
                raw[k] = ids
        return np.frombuffer(b"".join(raw), np.uint32), np.cumsum([0, *map(len, raw)]) // 4


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, keep_space: bool) -> Encoder:
    """One encoder for each Python worker; its cache is bounded by CACHE_ENTRIES and one slice of texts."""
    if (path, keep_space) not in _ENCODERS:
        _ENCODERS[path, keep_space] = Encoder(path, keep_space)
    return _ENCODERS[path, keep_space]
