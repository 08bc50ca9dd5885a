"""Words of plain letters go to the library's model alone, with the ids of the library's default call."""

import json
import random

import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

from loamwork.llm.library_tokenizer import LibraryTokenizer
from loamwork.llm.texts import IdCache

PATH = P.path("word_bpe_49k.json")
LETTERS = [chr(c) for c in [*range(65, 91), *range(97, 123), *range(0xC0, 0x100)]]
ODD = ["İ", "ſ", "K", "Å", "é", "ñ̃", "ª", "µ", "×", "÷", "Ÿ", "ĳ", "Σς", "日本", "é日", "'s", "l'été", "x1", "1é", " ", "a b", "é-è", "ﬁ", "́a"]


class Recorder:
    def __init__(self, tokenizer):
        self.tokenizer, self.seen = tokenizer, []

    def encode_batch_fast(self, texts, **options):
        self.seen += texts
        return self.tokenizer.encode_batch_fast(texts, **options)


def encoded(content, texts):
    raw = [t.encode() for t in texts]
    own = LibraryTokenizer(content, "words", cached=50)
    own.tokenizer = Recorder(own.tokenizer)
    whole, ends = [], [0]
    for at in range(0, len(raw), 40):  # several calls, so that pieces come from both generations of the cache
        part = raw[at : at + 40]
        ids, to = own.encode(np.frombuffer(b"".join(part), np.uint8), np.append(0, np.cumsum([*map(len, part)])), 2)
        whole += [ids[a:b].tolist() for a, b in zip(to, to[1:], strict=False)]
    return own.tokenizer.seen, whole


def test_plain_words_skip_the_steps_before_the_model():
    rng = random.Random(3)
    texts = [*LETTERS, *ODD, "".join(LETTERS)]
    for _ in range(400):
        texts.append(" ".join("".join(rng.choices([*LETTERS, *ODD] if rng.random() < 0.3 else LETTERS, k=rng.randrange(1, 12))) for _ in range(12)))
    library = Tokenizer.from_file(PATH)
    want = [[*library.encode(t, add_special_tokens=False).ids, 2] for t in texts]
    with open(PATH, "rb") as f:
        content = f.read()
    seen, got = encoded(content, texts)
    assert got == want
    assert not [s for s in seen if all("a" <= c <= "z" or "à" <= c <= "ÿ" and c != "÷" for c in s)]


def test_tokenizers_that_change_plain_words_are_asked_in_full():
    with open(PATH, "rb") as f:
        config = json.load(f)
    config["normalizer"]["normalizers"] += [{"type": "NFD"}, {"type": "StripAccents"}]
    content = json.dumps(config).encode()
    library = Tokenizer.from_str(content.decode())
    texts = ["Été à la plage", "plain words", "ÀÉÎ ñandú"]
    seen, got = encoded(content, texts)
    assert got == [[*library.encode(t, add_special_tokens=False).ids, 2] for t in texts] and "plain" in seen


def test_cache_finds_in_both_generations():
    calls = []

    def encode_many(strings):
        calls.extend(strings)
        return [[len(s), *s] for s in strings]

    cache, rng = IdCache(encode_many, limit=10), random.Random(1)
    for _ in range(60):
        strings = rng.sample([b"%d" % (k * k) for k in range(30)], 8)
        at = cache.find(strings)
        assert [cache.flat[cache.start[k] : cache.start[k] + cache.length[k]].tolist() for k in at] == [[len(s), *s] for s in strings]
    assert 30 < len(calls) < 480
