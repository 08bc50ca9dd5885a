"""Token ids by the tokenizers library, with a cache of what stands between cuts that no token crosses.

Texts that hold the content of an added token (such as <|endoftext|>), in any case, go
whole to the library, which makes one id of it; the cuts would part it. Words of plain
letters go straight to the library's model, where it is seen that the steps before it
leave them whole.
"""

from __future__ import annotations

import json
import os
import re
import zlib

import numpy as np

from loamwork.llm.pretokenize import slice_starts
from loamwork.llm.texts import LOWER, IdCache, hold, ragged

_SPACES = np.zeros(256, bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True
_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(65, 91), *range(97, 123)]] = True
_MARKS = np.zeros(256, bool)
_MARKS[[b for b in range(33, 127) if not chr(b).isalnum()]] = True
_APOSTROPHE = 39


def word_pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts in lower case without ASCII white space, where pieces begin in them, and their offsets.

    Pieces begin after white space and between ASCII letters and marks: for a tokenizer
    that lower-cases, drops white space, takes runs of letters and runs of marks apart, and knows no
    longer pieces than contractions, which begin at an apostrophe; behind one there is
    no cut.
    """
    data = LOWER[data]
    inside, letter, mark = ~_SPACES[data], _LETTERS[data], _MARKS[data]
    begins = np.zeros(len(data), bool)
    begins[1:] = ~inside[:-1] | (letter[:-1] & mark[1:]) | (mark[:-1] & (data[:-1] != _APOSTROPHE) & letter[1:])
    begins[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    packed = np.append(0, np.cumsum(inside, dtype=np.int64))
    return data[inside], packed[np.flatnonzero(begins & inside)], packed[offsets]


def pattern_slices(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts as they are, cut as by the byte-level pattern."""
    return data, slice_starts(data, offsets), offsets


#: Ways to cut texts before the library sees the pieces.
CUTS = {"words": word_pieces, "slices": pattern_slices}


#: Letters of plain words in UTF-8: a-z and the letters from U+00C0 to U+00FF, which have a lower case of one letter there.
PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")


def _model_letters() -> dict[int, int]:
    """The letters by which a byte-level model knows the second bytes of plain letters, in lower case."""
    second = {b: b + 32 if b < 0x9F else b for b in range(0x80, 0xC0)}
    unseen = [*range(33), *range(127, 161), 173]
    return {b: 256 + unseen.index(to) if to in unseen else to for b, to in second.items()}


_MODEL_LETTERS = _model_letters()


#: Pieces that are remembered.
CACHED = 250_000


class LibraryTokenizer:
    def __init__(self, content: bytes, cut: str, cached: int = CACHED):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(content.decode())
        # what marks added tokens, in lower case
        self.added = sorted({t["content"].lower().encode() for t in json.loads(content).get("added_tokens") or []})
        self.cut = CUTS[cut]
        self.cache = IdCache(self._encode_pieces, cached)
        self.model = self.tokenizer.model
        self.plain = cut == "words" and self._leaves_plain_words()

    def _leaves_plain_words(self) -> bool:
        """Whether words of plain letters reach the model whole, in lower case, as byte-level letters, and its ids are the result."""
        from tokenizers import models

        letters = [chr(c) for c in [*range(97, 123), *range(0xC0, 0x100)] if c not in (0xD7, 0xF7)]
        words = [*letters, "".join(letters), "".join(letters[::-1]), "".join(a + b for a in letters for b in letters)]
        first, then, model = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer, self.model
        if first is None or then is None or not isinstance(model, models.BPE) or model.dropout or self.tokenizer.truncation or self.tokenizer.padding:
            return False
        for word in words:
            seen = [x for x, _ in then.pre_tokenize_str(first.normalize_str(word))]
            if seen != [word.encode().decode("latin-1").translate(_MODEL_LETTERS)]:
                return False
        whole = self._encode_many([w.encode() for w in words])
        return all(x == self._plain_ids(w.encode()) for w, x in zip(words, whole, strict=True))

    def _plain_ids(self, word: bytes) -> list[int]:
        return [t.id for t in self.model.tokenize(word.decode("latin-1").translate(_MODEL_LETTERS))]

    def _encode_pieces(self, strings: list[bytes]) -> list:
        """Ids of pieces: plain words by the model alone, others by all steps."""
        if not self.plain:
            return self._encode_many(strings)
        plain, ids = PLAIN.fullmatch, self._plain_ids
        out = [ids(s) if plain(s) else None for s in strings]
        others = [k for k, x in enumerate(out) if x is None]
        for k, x in zip(others, self._encode_many([strings[k] for k in others]), strict=True):
            out[k] = x
        return out

    def _encode_many(self, strings: list[bytes]) -> list:
        return [x.ids for x in self.tokenizer.encode_batch_fast([s.decode() for s in strings], add_special_tokens=False)]

    def encode(self, data: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of UTF-8 texts end to end, each with ``end_id`` after it, and the offsets of each text's ids."""
        whole = self._with_added(data, offsets)
        if not len(whole):
            ids, ends = self._encode_cut(data, offsets)
        else:
            size = np.diff(offsets)
            rest = size.copy()
            rest[whole] = 0
            ids, ends = self._encode_cut(ragged(data, offsets[:-1], rest), np.append(0, np.cumsum(rest)))
            raw = data.tobytes()
            parts, length, done = [], np.diff(ends), 0
            for k, new in zip(whole.tolist(), self._encode_many([raw[offsets[k] : offsets[k + 1]] for k in whole.tolist()]), strict=True):
                parts += [ids[done : ends[k]], np.array(new, ids.dtype)]
                done, length[k] = ends[k], len(new)
            ids, ends = np.concatenate([*parts, ids[done:]]), np.append(0, np.cumsum(length))
        return np.insert(ids, ends[1:], end_id), ends + np.arange(len(ends))

    def _encode_cut(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        data, starts, offsets = self.cut(data, offsets)
        return self.cache.encode(data, starts, np.searchsorted(starts, offsets[:-1]))

    def _with_added(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Numbers of the texts that hold the content of an added token."""
        raw, found = data.tobytes().lower(), []
        for mark in self.added:
            at = raw.find(mark)
            while at >= 0:
                k = int(np.searchsorted(offsets, at, "right")) - 1
                if at + len(mark) <= offsets[k + 1]:
                    found.append(k)
                    at = raw.find(mark, int(offsets[k + 1]))
                else:
                    at = raw.find(mark, at + 1)
        return np.unique(np.array(found, np.int64))


_loaded: dict[tuple[int, str, int], LibraryTokenizer] = {}


def library_tokenizer(content: bytes, cut: str, cached: int = CACHED) -> LibraryTokenizer:
    """The tokenizer of a JSON file, once in each worker process, that remembers about ``cached`` pieces, or twice as many."""
    hold("library", _loaded.clear)
    key = zlib.crc32(content), cut, cached
    if key not in _loaded:
        _loaded[key] = LibraryTokenizer(content, cut, cached)
    return _loaded[key]
