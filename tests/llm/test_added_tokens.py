"""Texts that hold the content of an added token, against the library's default call."""

import zlib

import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

from loamwork.llm.library_tokenizer import LibraryTokenizer
from loamwork.llm.packing import pack
from loamwork.llm.token_files import read_token_files, with_ids_crc32, write_token_files
from loamwork.session import new_path

TEXTS = ["end <|endoftext|> more", "", "plain text, it's plain", "<|startoftext|>Ünder<|endoftext|>", None, "half <|endof", "text|> half", "<|ENDOFTEXT|> x",
         "a<|endoftext|><|endoftext|>  b", "it's <|endoftext |> 42", "last one"]


def test_ids_are_the_librarys():
    raw = [(t or "").encode() for t in TEXTS]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.append(0, np.cumsum([*map(len, raw)]))
    for name, cut in (("word_bpe_49k.json", "words"), ("byte_bpe_50k.json", "slices")):
        tokenizer = Tokenizer.from_file(P.path(name))
        ids, ends = LibraryTokenizer(open(P.path(name), "rb").read(), cut).encode(data, offsets, 7)
        assert len(ends) == len(TEXTS) + 1 and ends[-1] == len(ids)
        for k, text in enumerate(TEXTS):
            assert ids[ends[k] : ends[k + 1]].tolist() == [*tokenizer.encode(text or "", add_special_tokens=False).ids, 7]


def test_token_files_and_packing(spark):
    docs = spark.createDataFrame([*enumerate(TEXTS)], "doc_id long, text string")
    for name, end in (("word_bpe_49k.json", 2), ("byte_bpe_50k.json", 0)):
        tokenizer = Tokenizer.from_file(P.path(name))
        want = [np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, end], "<u4") for t in TEXTS]
        if end:
            path = new_path(spark, "tokens")
            write_token_files(docs, path, P.path(name), end)
            got = {r.doc_id: r for r in with_ids_crc32(read_token_files(spark, path)).collect()}
            assert [got[k].start for k in range(len(want))] == [sum(map(len, want[:k])) for k in range(len(want))]
            assert all(got[k].ids_crc32 == zlib.crc32(w) for k, w in enumerate(want))
        else:
            got = pack(docs, P.path(name), end).collect()
            assert sum(r.length for r in got) == sum(map(len, want))
            assert all(r.ids_crc32 == zlib.crc32(want[r.doc_id][r.start : r.start + r.length]) for r in got)
