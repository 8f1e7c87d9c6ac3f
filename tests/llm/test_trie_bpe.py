"""Ids equal the library's, texts come back, agreements equal plain merging."""

from __future__ import annotations

import hashlib
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from verdictlake.llm import trie_bpe
from verdictlake.llm.tokens import tokenizer_path

FILE = "byte_bpe_50k.json"
SYMBOLS = ["a", "b", "A", " ", "  ", "\n", "\t", "é", "日", "\u0558", "\u088f", "<|endoftext|>", "<|endof", "'s", "'S", "1", "²", "½", "\x00",
           "\x1c", "\u00a0", "\u2003", "\u0301", "x", "the ", " th", "ing", ".", "!!", "🙂", "\U0002ebf0"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path(FILE))


@pytest.fixture(scope="module")
def trie():
    return trie_bpe.TrieEncoder(tokenizer_path(FILE))


def test_random_texts(library, trie):
    rng = random.Random(2)
    texts = ["".join(rng.choice(SYMBOLS) for _ in range(rng.randrange(40))) for _ in range(3000)]
    encoder, decoder = trie.encoder(kept=500), trie_bpe.Decoder(trie.vocabulary)
    for k in range(0, len(texts), 100):
        part = texts[k:k + 100]
        raw = encoder.encode([*part, None])
        ends = np.cumsum([len(r) // 4 for r in raw])
        ids = np.frombuffer(b"".join(raw), "<u4")
        back = decoder.decode(ids, ends).to_pylist()
        for n, text in enumerate(part):
            want = library.encode(text, add_special_tokens=False).ids
            assert ids[ends[n - 1] if n else 0:ends[n]].tolist() == want, repr(text)
            assert back[n] == library.decode(want, skip_special_tokens=False) == text


def test_random_words_and_one_very_long(library, trie):
    rng = random.Random(4)
    words = {"".join(rng.choice("aehinrst") for _ in range(rng.randrange(1, 14))) for _ in range(4000)} | {"a" * 3000, "=" * 1000, "é" * 500}
    got = trie.encode([w.encode() for w in words])
    assert all(got[w.encode()] == library.encode(w).ids for w in words)


def test_shared_lengths():
    rng = random.Random(3)
    words = sorted({bytes(rng.choice(b"a\x00b") for _ in range(rng.choice([0, 1, 3, 31, 32, 33, 70]))) for _ in range(3000)} | {b"a" * n for n in range(80)})
    want = [0, *(next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b))) for a, b in zip(words, words[1:]))]
    assert trie_bpe.shared_lengths(words) == want and trie_bpe.shared_lengths([]) == []


def test_each_prefix_is_computed_once(trie, monkeypatch):
    class Counted(dict):
        seen: list = []

        def get(self, key, default=None):
            self.seen.append(key)
            return dict.get(self, key, default)

    monkeypatch.setattr(trie, "pairs", {})
    monkeypatch.setattr(trie.vocabulary, "prefix", Counted(trie.vocabulary.prefix))
    trie.encode([b"zqzqzqzq" + bytes([c]) for c in b"abcdefgh"])
    alone = len(Counted.seen)
    Counted.seen.clear()
    trie.encode([b"zqzqzqzqa"])
    assert alone < 3 * len(Counted.seen)  # eight words, one path shared


def test_decoding_of_broken_ids(library, trie):
    rng, decoder = random.Random(6), trie_bpe.Decoder(trie.vocabulary)
    for _ in range(300):
        ids = np.array([rng.choice([rng.randrange(256), rng.randrange(50257)]) for _ in range(12)])
        cut = np.array([5, 5, 12])
        assert decoder.decode(ids, cut).to_pylist() == [library.decode(ids[a:b].tolist(), skip_special_tokens=False) for a, b in ((0, 5), (5, 5), (5, 12))]


def test_files_of_another_kind_are_refused(tmp_path):
    with pytest.raises(ValueError):
        trie_bpe.Vocabulary(tokenizer_path("word_bpe_49k.json"))
    with open(tokenizer_path(FILE), encoding="utf-8") as f:
        data = json.load(f)
    data["model"]["merges"] = [*data["model"]["merges"][1:], data["model"]["merges"][0]]  # made after it is used
    (tmp_path / "t.json").write_text(json.dumps(data))
    with pytest.raises(ValueError):
        trie_bpe.Vocabulary(str(tmp_path / "t.json"))


def test_edges(spark, library):
    rows = [(1, None), (2, ""), (3, "<|endoftext|>"), (None, "a  b"), (4, "x y " * 40_000), (4, "z"), (4, "z"), (5, "q" * 20_000), (6, "\u088f é"), (7, " \n\t ")]
    frame = spark.createDataFrame([(*r, "i", 1, "d") for r in rows], "doc_id long, text string, ids string, n_tokens int, decoded string").repartition(3)
    got = sorted((str(r.doc_id), r.n_tokens, np.frombuffer(r.ids, "<u4").tolist(), r.decoded) for r in trie_bpe.encode_and_decode(frame, FILE).collect())
    want = [(str(i), library.encode(t or "", add_special_tokens=False).ids, t or "") for i, t in rows]
    assert got == sorted((i, len(ids), ids, t) for i, ids, t in want)
    assert trie_bpe.encode_and_decode(frame.filter(F.lit(False)), FILE).collect() == []


def test_query_equals_the_library(spark, sf_dir, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    rows = trie_bpe.op11_bpe_round_trip(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        ids = library.encode(docs[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
