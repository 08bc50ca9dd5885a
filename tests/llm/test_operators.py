"""The operators against brute force, on a fixture with nulls, empty texts, ties, repeats and clashing columns."""

import base64
import hashlib
import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from loamwork.llm import queries as Q
from loamwork.llm.byte_bpe import Tokens, decode, decode_span, encode
from loamwork.llm.exact_dedup import exact_dedup, identities
from loamwork.llm.licenses import license_scan
from loamwork.llm.log_bilinear import score_documents
from loamwork.llm.packing import cut_documents, pack, sequences, whole_patterns
from loamwork.llm.quality import quality_rules
from loamwork.llm.sharding import interleaved_shards
from loamwork.llm.simhash import near_links, EXACT, simhash_components
from loamwork.llm.token_files import read_documents, read_token_files, with_ids_crc32, write_token_files
from loamwork.llm.toxicity import Decoder, character_counts, character_model, toxicity
from loamwork.session import new_path

WORD = re.compile("[^\x20\x09-\x0d]+")
LONG = "the cat sat on the mat and it's 'll 12 é " * 700
TEXTS = [None, "", " \n\t", "a", "the same text here", "the same text here", "the same text here", LONG, LONG, LONG + "x",
         "All Rights Reserved. cc by cc-by General  Public\nLicense",
         "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction", "we'll \n\n go  don't İstanbul ß 日本 🙂",
         *(f"word{k} and some more of the words number {k * k} in line {k}\nend of it" for k in range(40)), "you are an 1d10t and a m o r o n"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, kept string, name string, score string"


@pytest.fixture(scope="module")
def rows():
    out = [(k, t, ["en", "de", None, "xx"][k % 4], None if k % 5 == 0 else "hot", 0, "r", "k", "n", "s") for k, t in enumerate(TEXTS)]
    return [*out, out[4], (None, "no id", None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def lower(t):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), t or "")


def test_exact_dedup(docs, rows, empty):
    for size in (4096, 7):
        got = exact_dedup(docs, size).collect()
        assert len(got) == len(rows)
        by_text = {}
        for r in rows:
            by_text.setdefault(hashlib.sha256((r[1] or "").encode()).hexdigest(), []).append(r[0])
        for r in got:
            same = by_text[r.text_sha256]
            assert r.group_size == len(same) and r.keep_id == max((x for x in same if x is not None), default=None)
        assert Counter(r.text_sha256 for r in got if r.kept) == dict.fromkeys(by_text, 1)
        names = {(r.n_blocks, r.name): r.text_sha256 for r in identities(docs, size).collect()}
        assert len(names) == len(by_text)
    assert exact_dedup(empty).count() == 0


def test_sharding(docs, rows, empty):
    got = interleaved_shards(docs, 8).collect()
    counts = Counter(r.shard for r in got)
    assert len(got) == len(rows) and max(counts.values()) - min(counts.values()) <= 1
    for s in counts:
        assert sorted(r.slot for r in got if r.shard == s) == [*range(counts[s])]
    for source in (None, "hot"):
        per = Counter(r.shard for r in got if r.source == source)
        assert max(per.values()) - min(per[s] for s in counts) <= 2
    texts = {r[0]: r[1] or "" for r in rows}
    assert all(r.size == len(texts[r.doc_id].encode()) + 1 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) for r in got)
    assert interleaved_shards(empty).count() == 0


def test_quality(docs, rows, empty):
    got = {(r.doc_id): r for r in quality_rules(docs).collect()}
    for r in rows:
        t, g = r[1] or "", got[r[0]]
        w = WORD.findall(t)
        wins = Counter(zip(w, w[1:], w[2:]))
        again = {i + d for i in range(len(w) - 2) if wins[w[i], w[i + 1], w[i + 2]] > 1 for d in range(3)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len({*lines}), len(again))
        assert g.base_failed == (len(w) < 50 or 100 * len(again) > 50 * len(w)) and not (g.kept and g.base_failed)
    assert quality_rules(empty).count() == 0


def test_byte_bpe(docs, rows, empty):
    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r[0]: r[1] or "" for r in rows}
    got = decode(encode(docs, path), path).collect()
    assert len(got) == len(rows)
    assert all(r.ids == enc.encode_ordinary(texts[r.doc_id]) and bytes(r.bytes).decode() == texts[r.doc_id] for r in got)
    tokens = Tokens(open(path, "rb").read())
    for r in got:
        raw, at = texts[r.doc_id].encode(), 0
        for token, offset in zip(r.ids, r.offsets, strict=True):
            assert offset == at
            at += len(enc.decode_single_token_bytes(token))
        assert at == len(raw)
        for a, b in ((0, len(raw)), (3, 9), (len(raw) - 2, len(raw)), (5, 5), (7, len(raw) + 9)):
            assert decode_span(r.ids, r.offsets, tokens, max(a, 0), b) == raw[max(a, 0) : b]
    assert decode(encode(empty, path), path).count() == 0


def test_token_files(spark, docs, rows, empty):
    tk = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    want = {r[0]: [*tk.encode(r[1] or "", add_special_tokens=False).ids, 2] for r in rows}
    path = new_path(spark, "tokens")
    write_token_files(docs, path, P.path("word_bpe_49k.json"), 2)
    got = sorted(read_token_files(spark, path).collect(), key=lambda r: (r.start))
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows), key=lambda x: -1 if x is None else x)
    assert all(list(r.ids) == want[r.doc_id] for r in got) and [r.start for r in got] == [sum(x.n_tokens for x in got[:k]) for k in range(len(got))]
    crc = {r.doc_id: r.ids_crc32 for r in with_ids_crc32(read_token_files(spark, path)).collect()}
    assert all(crc[k] == zlib.crc32(np.array(v, "<u4")) for k, v in want.items())
    assert [r.doc_id for r in read_documents(spark, path, [7]).collect()] == [7]
    write_token_files(empty, path + "e", P.path("word_bpe_49k.json"), 2)
    assert read_token_files(spark, path + "e").count() == 0


def test_packing(docs, rows, empty):
    tk = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = {r[0]: [*tk.encode(r[1] or "", add_special_tokens=False).ids, 0] for r in rows}
    got = pack(docs, P.path("byte_bpe_50k.json"), 0).collect()
    assert all(r.ids_crc32 == zlib.crc32(np.array(want[r.doc_id][r.start : r.start + r.length], "<u4")) and r.doc_tokens == len(want[r.doc_id]) for r in got)
    assert sum(r.length for r in got) == sum(len(want[r[0]]) for r in rows)
    for s in {r.sequence_id for r in got}:
        at = 0
        for r in sorted((r for r in got if r.sequence_id == s), key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    assert pack(empty, P.path("byte_bpe_50k.json"), 0).count() == 0
    with_ids = pack(docs, P.path("byte_bpe_50k.json"), 0, with_ids=True).cache()
    assert all(list(r.ids) == want[r.doc_id][r.start : r.start + r.length] for r in with_ids.collect())
    whole = {r.sequence_id: list(r.ids) for r in sequences(with_ids).collect()}
    assert sum(map(len, whole.values())) == sum(len(want[r[0]]) for r in rows)
    assert all(whole[r.sequence_id][r.offset : r.offset + r.length] == list(r.ids) for r in with_ids.collect())
    assert len(whole) <= sum(map(len, whole.values())) / 1024 * 1.02 + 2
    assert "ids" not in cut_documents(docs, P.path("byte_bpe_50k.json"), 0, with_ids=False).columns
    demand = np.random.default_rng(1).integers(0, 30, 64)
    patterns, uses = whole_patterns(demand)
    assert (patterns.T @ uses == demand).all() and (patterns @ (np.arange(64) + 1) <= 64).all()


def test_license_scan(docs, rows, empty):
    got = {r.doc_id: r for r in license_scan(docs).collect()}
    for r in rows:
        w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(r[1]))
        at = [(i, label) for text, label in (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")) for i in range(len(w)) if w[i : i + len(text.split())] == text.split()]
        assert got[r[0]].n_words == len(w) and sorted((p.word, p.label) for p in got[r[0]].phrases) == sorted(at)
    assert got[11].labels == "mit" and license_scan(empty).count() == 0


def test_log_bilinear(docs, rows, empty):
    got = {r.doc_id: r for r in score_documents(docs, Q.remainder(7) == 2, n_common=5).collect()}
    train = [r for r in rows if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 != 2]
    c = Counter(w for r in train for w in WORD.findall(lower(r[1])))
    n, v = sum(c.values()) + len(train), len(c) + 1
    for r in rows:
        w = WORD.findall(lower(r[1]))
        base = sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w) + math.log10((len(train) + 1) / (n + v + 1))
        g = got[r[0]]
        assert (g.n_tokens, g.n_known, g.train_tokens) == (len(w) + 1, sum(x in c for x in w) + 1, n)
        assert abs(g.base_score - base) < 1e-6 * max(1, -base) and g.score < 0
    assert score_documents(empty, Q.remainder(7) == 2).count() == 0
    assert sum(r.score for r in got.values()) > sum(r.base_score for r in got.values())


def test_simhash(spark, docs, rows, empty):
    got = simhash_components(docs).collect()
    assert len(got) == len(rows) and len({r.component_id for r in got if r.doc_id in (4, 5, 6)}) == 1
    assert {bytes(r.fp) for r in got if r.doc_id in (0, 1, 2)} == {bytes(8)}
    rng = np.random.default_rng(0)
    base = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    fp = np.unique(np.concatenate([base, base[:100] ^ np.uint64(5), base[:50] ^ np.uint64(7 << 40)]))
    links = near_links(spark.createDataFrame([(int(x).to_bytes(8, "big"),) for x in fp], "fp binary"), 3, EXACT, shard_rows=20, sample=100).collect()
    def groups(pairs):
        u = {int(x): int(x) for x in fp}
        def root(x):
            while u[x] != x:
                x = u[x]
            return x
        for a, b in pairs:
            a, b = root(a), root(b)
            u[max(a, b)] = min(a, b)
        return [root(int(x)) for x in fp]
    near = [(int(a), int(b)) for i, a in enumerate(fp) for b in fp[i + 1 :] if int(a ^ b).bit_count() <= 3]
    assert groups(near) == groups((int.from_bytes(r.a, "big"), int.from_bytes(r.b, "big")) for r in links)
    assert simhash_components(empty).count() == 0


def test_fingerprints_of_texts(docs, rows):
    got = {(r.doc_id, bytes(r.fp)) for r in simhash_components(docs).collect()}
    for r in rows:
        w = WORD.findall(lower(r[1]))
        shingles = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] or ([" ".join(w)] if w else [])
        h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
        bits = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
        assert (r[0], bits.to_bytes(8, "big")) in got


def test_toxicity(spark, docs, rows, empty):
    insults = ["idiot", "moron", "loser"]
    text = [(k, f"you {insults[k % 3]} of the {k}" if k % 2 else f"the good of all {k} and more", "en") for k in range(200)]
    many = spark.createDataFrame(text, "doc_id long, text string, lang string").unionByName(docs.select("doc_id", "text", "lang").filter("doc_id = 53").withColumn("doc_id", F.lit(1000).cast("long")))
    labels = spark.createDataFrame([(k, k % 2) for k in range(200)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity(many, labels, F.pmod("doc_id", F.lit(5)) == 0).collect()}
    assert all(got[k].predicted == k % 2 for k in range(200)) and got[1000].predicted == 1
    assert toxicity(empty, labels, F.lit(False)).count() == 0 and toxicity(docs, labels.limit(0), F.lit(False)).count() == len(rows)
    decoder = Decoder(character_model(character_counts(many)))
    assert decoder.words(b"1d10t", True) == ("idiot",) and decoder.restore("m o r o n", True) == "moron"


def test_viterbi_finds_the_cheapest_path(docs):
    decoder = Decoder(character_model(character_counts(docs)))
    for token, spaced in (("1d10t", False), ("w0rrd", False), ("th3", False), ("a$$ss", False), ("s.a.m.3", False), ("t h 3", True), ("l1nnnee", False), ("", False)):
        runs = [(m[1], len(m[0])) for m in re.finditer(r"(?s)(.)\1*", token)]
        options = [decoder._options(c, n, 0 < k < len(runs) - 1, spaced) for k, (c, n) in enumerate(runs)]
        paths = []
        for path in itertools.product(*options):
            cost, context = 0.0, 0
            for text, channel in path:
                more, context = decoder._spell(text, context)
                cost += channel + more
            paths.append((cost + decoder.costs[context * 28], "".join(text for text, _ in path)))
        least = min(paths)[0]
        assert decoder.restore(token, spaced) in {text for cost, text in paths if cost < least + 1e-9}


CLASHING = ["score", "predicted", "evidence", "found", "kept", "n_words", "ref", "row", "__text", "__row", "__id", "held_out", "ids", "piece", "node", "key"]


def test_pipeline_stages_keep_rows_and_columns(spark, docs, rows):
    import corpus_pipeline as C

    more = docs.select(*C.COLUMNS, *(F.concat(F.lit(f"{c}-"), F.col("text")).alias(c) for c in CLASHING)).cache()
    held = exact_dedup(docs)
    texts = Counter((r.doc_id, r.text) for r in more.collect())

    def stage(name, table, sf_dir="/root/testdata/sf0.001"):
        out = dict(C.STAGES)[name](spark, table, sf_dir)
        if name != "packing":
            assert out.columns == table.columns
            for r in out.collect():
                assert all(r[c] == (None if r.text is None else f"{c}-{r.text}") for c in CLASHING if c in table.columns)
        return out

    everything = Counter((r.doc_id, r.text) for r in stage("toxicity", more).collect())
    assert everything <= texts and everything.total() >= texts.total() - 2
    judged = {(r.doc_id, r.n_words): r.kept for r in quality_rules(docs).collect()}
    good = Counter((r.doc_id, r.text) for r in stage("quality_rules", more).collect())
    assert good == Counter({k: n for k, n in texts.items() if judged[k[0], len(WORD.findall(k[1] or ""))]})
    kept = [(r.doc_id, r.text or "") for r in stage("exact_dedup", more).collect()]
    best = {}
    for d, t in texts:
        best[t or ""] = max(best.get(t or "", -1), -1 if d is None else d)
    assert sorted((-1 if d is None else d, t) for d, t in kept) == sorted((d, t) for t, d in best.items())
    near = [(r.doc_id, r.text) for r in stage("simhash_near_dedup", more).collect()]
    # no words: 0 to 2; equal texts: 4 to 6 and the row again; 7 to 9: one set but for a word
    assert sorted(-1 if d is None else d for d, _ in near) == [-1, 0, 3, 4, 7, *range(10, len(TEXTS))]
    pieces = stage("packing", more).collect()
    assert {r.doc_id for r in pieces} == {r[0] for r in rows}
    assert held.count() == len(rows)  # other queries' tables are still there
    for name, _ in C.STAGES:
        assert stage(name, more.limit(0)).count() == 0


def test_near_copies_are_told_apart_by_text(spark):
    import corpus_pipeline as C

    a, b = (" ".join(f"{x}{k}" for k in range(40)) for x in "ab")
    table = spark.createDataFrame([(1, a), (2, a + " end"), (2, b), (None, b + " end"), (None, "c d e"), (None, "c d e"), (3, "f"), (3, "f")], "doc_id long, text string")
    left = dict(C.STAGES)["simhash_near_dedup"](spark, table, "").collect()
    assert sorted((r.doc_id or 0, r.text) for r in left) == sorted([(1, a), (2, b), (0, "c d e"), (3, "f")])


def test_pipeline_runs(spark, tmp_path, docs):
    import corpus_pipeline as C

    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows.unionByName(rows.limit(5)).unionByName(docs.select(*C.COLUMNS), allowMissingColumns=True).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet("/root/testdata/sf0.001/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    packed = C.run(spark, str(tmp_path))
    whole = {}
    for r in sorted(packed.collect(), key=lambda r: (r.doc_id, r.start)):
        assert r.start == len(whole.setdefault(r.doc_id, [])) and len(r.ids) == r.length
        whole[r.doc_id] += r.ids
    tk = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    texts = {r.doc_id: r.text for r in rows.collect()}
    assert 100 < len(whole) < 200
    assert all(ids == [*tk.encode(texts[d], add_special_tokens=False).ids, 0] for d, ids in whole.items() if d >= len(TEXTS))
