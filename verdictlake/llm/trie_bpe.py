"""Byte-level BPE by traversal of a trie, and decoding.

In byte-pair encoding a sequence of tokens is what a string gives if and only if
every two neighbours are what their joined bytes give. So each prefix of a word
has one last token: the suffix that is a token and agrees with the last token of
the prefix before it. The distinct words of a batch, sorted, are the leaves of a
trie in depth-first order; a stack holds the last token at each depth of the
current path, so the state of a shared prefix is found once for all words below
it. A word's ids are read off its path from the end.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from os.path import commonprefix
from unicodedata import category

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdictlake.llm.common import table
from verdictlake.llm.tokens import Encoder, binary_array, byte_slices, ranges, spaced_pieces, tokenizer_path, worker_encoder

# Fixed values of the public byte-level format: the cutting pattern, and which
# bytes are written as the character of the same number.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]

NEVER = 1 << 40
KEPT_PAIRS = 500_000


def byte_of_character() -> dict[str, int]:
    """The byte that each character of a vocabulary entry stands for: bytes that
    are not shown as themselves follow from 256 on."""
    hidden = [b for b in range(256) if b not in SHOWN]
    return {**{chr(b): b for b in SHOWN}, **{chr(256 + n): b for n, b in enumerate(hidden)}}


class Vocabulary:
    """Tokens of a byte-level BPE file: their bytes, how each is made, and the
    strings of added tokens.

    A file that cuts or spells otherwise, or whose merges do not make each token
    in one way, is refused: the agreement of pairs would not hold.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        model, cut = data["model"], data["pre_tokenizer"] or {}
        plain = (cut.get("type") == "ByteLevel" and cut.get("use_regex") and not cut.get("add_prefix_space") and not data["normalizer"]
                 and model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix",
                                                                              "end_of_word_suffix", "byte_fallback", "ignore_merges")))
        added = data["added_tokens"]
        if not plain or any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in added):
            raise ValueError("not a plain byte-level BPE file")
        spelled = byte_of_character()
        self.token = {bytes(spelled[c] for c in s): i for s, i in model["vocab"].items()}
        self.added = {t["content"]: t["id"] for t in added}
        size = 1 + max([*self.token.values(), *self.added.values()])
        self.bytes = [b""] * size
        for s, i in [*self.token.items(), *((s.encode(), i) for s, i in self.added.items())]:
            self.bytes[i] = s
        self.left, self.right, self.time, self.merge = [-1] * size, [-1] * size, [-1] * size, {}
        for time, pair in enumerate(model["merges"]):
            a, b = (bytes(spelled[c] for c in s) for s in (pair.split(" ") if isinstance(pair, str) else pair))
            one, other, made = self.token[a], self.token[b], self.token[a + b]
            if self.time[made] >= 0 or any(self.time[t] < 0 and len(self.bytes[t]) > 1 for t in (one, other)):
                raise ValueError("merges do not make each token in one way")
            self.left[made], self.right[made], self.time[made] = one, other, time
            self.merge[one, other] = time
        if any(self.time[i] < 0 for s, i in self.token.items() if len(s) > 1) or any(bytes([b]) not in self.token for b in range(256)):
            raise ValueError("tokens that no merge makes")
        # Each prefix of a token, with the token it is (-1: none).
        self.prefix = {s[:n]: -1 for s in self.token for n in range(1, len(s))}
        self.prefix.update(self.token)

    def agree(self, a: int, b: int) -> bool:
        """Whether the bytes of the tokens ``a`` and ``b``, joined, give just these.

        They do unless a merge across the border comes first: one of a token at
        the right edge of ``a`` with one at the left edge of ``b``, while both are
        there. Of two equal merges the left one is done first.
        """
        edge, until_b, y = [], NEVER, b
        while y >= 0:
            edge.append((y, until_b))
            y, until_b = self.left[y], self.time[y]
        until, x = NEVER, a
        while x >= 0:
            for y, until_y in edge:
                time = self.merge.get((x, y))
                if time is not None and time < until and time <= until_y:
                    return False
            x, until = self.right[x], self.time[x]
        return True


SHORT = 32


def shared_lengths(words: list[bytes]) -> list[int]:
    """How many bytes each of the sorted, distinct words shares with the one
    before it: the depth at which its path leaves the last one's."""
    if not words:
        return []
    heads = np.array([w[:SHORT] for w in words], f"S{SHORT}").view(np.uint8).reshape(len(words), SHORT)
    same = heads[1:] == heads[:-1]
    first = np.where(same.all(axis=1), SHORT, same.argmin(axis=1)).tolist()
    return [0, *(min(n, len(a), len(b)) if n < SHORT and a[n:n + 1] != b[n:n + 1] else len(commonprefix((a, b)))
                 for n, a, b in zip(first, words, words[1:]))]


class TrieEncoder:
    """Ids of words and of texts; agreements of pairs are kept, up to a number."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.pairs: dict[int, bool] = {}
        self.cut = regex.compile(PATTERN).findall
        self.added = regex.compile("|".join(map(regex.escape, sorted(self.vocabulary.added, key=len, reverse=True)))) if self.vocabulary.added else None
        self.path, self.own = path, None

    def words(self, piece: str) -> list[str]:
        """A text without added tokens, cut into words. Letters and digits newer
        than this Python's character tables are left to the library's own cut."""
        if piece.isascii():
            return [piece] if piece.isalpha() or piece[:1] == " " and piece[1:].isalpha() else self.cut(piece)
        if all(category(c) != "Cn" for c in piece):
            return self.cut(piece)
        if self.own is None:
            from tokenizers import Tokenizer
            self.own = Tokenizer.from_file(self.path).pre_tokenizer
        return [piece[a:b] for _, (a, b) in self.own.pre_tokenize_str(piece)]

    def encode(self, words: list[bytes]) -> dict[bytes, list[int]]:
        """The ids of each word, by one depth-first walk of their trie."""
        vocabulary, pairs, out = self.vocabulary, self.pairs, {}
        prefix, spelled, agree = vocabulary.prefix, vocabulary.bytes, vocabulary.agree
        if len(pairs) > KEPT_PAIRS:
            pairs.clear()
        depth = max(map(len, words), default=0) + 1
        last, reach = [0] * depth, [0] * depth  # per depth: last token, longest suffix that starts a token
        words = sorted(words)
        for word, shared in zip(words, shared_lengths(words)):
            for at in range(shared + 1, len(word) + 1):
                size = reach[at - 1] + 1
                token = prefix.get(word[at - size:at])
                while token is None:
                    size -= 1
                    token = prefix.get(word[at - size:at])
                reach[at] = size
                while True:
                    if token is not None and token >= 0:
                        if size == at:
                            break
                        pair = last[at - size] << 32 | token
                        good = pairs.get(pair)
                        if good is None:
                            good = pairs[pair] = agree(last[at - size], token)
                        if good:
                            break
                    size -= 1
                    token = prefix.get(word[at - size:at])
                last[at] = token
            ids, at = [], len(word)
            while at:
                ids.append(last[at])
                at -= len(spelled[last[at]])
            ids.reverse()
            out[word] = ids
        return out

    def pieces(self, pieces: list[str]) -> list[list[int]]:
        """The ids of each piece, all their distinct words in one trie."""
        cut = [[w.encode() for w in self.words(p)] for p in pieces]
        known = self.encode(list({w for words in cut for w in words}))
        return [known[words[0]] if len(words) == 1 else [i for w in words for i in known[w]] for words in cut]

    def whole(self, text: str) -> list[int]:
        """The ids of any text; strings of added tokens get their ids."""
        out, at = [], 0
        for m in self.added.finditer(text) if self.added else ():
            out += [*self.pieces([text[at:m.start()]])[0], self.vocabulary.added[m.group()]]
            at = m.end()
        return out + self.pieces([text[at:]])[0]

    def encoder(self, **kept: int) -> Encoder:
        return Encoder(self.whole, lambda new: self.pieces([p.decode("utf-8", "surrogatepass") for p in new]), spaced_pieces, list(self.vocabulary.added), **kept)


def trie_encoder(path: str) -> Encoder:
    """An encoder by tries, with its ``decoder`` beside it."""
    trie = TrieEncoder(path)
    encoder = trie.encoder()
    encoder.decoder = Decoder(trie.vocabulary)
    return encoder


class Decoder:
    """Texts of ids: the tokens' bytes, joined; broken UTF-8 becomes U+FFFD."""

    def __init__(self, vocabulary: Vocabulary):
        self.lengths = np.array([len(b) for b in vocabulary.bytes], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(vocabulary.bytes), np.uint8)

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        """One text per end: the ids up to it."""
        lengths = self.lengths[ids]
        after = np.concatenate([[0], np.cumsum(lengths)])
        raw = binary_array(self.flat[ranges(self.starts[ids], lengths)], after[ends])
        try:
            return raw.cast(pa.string())
        except pa.ArrowInvalid:
            return pa.array([b.decode("utf-8", "replace") for b in raw.to_pylist()], pa.string())


def encode_and_decode(docs: DataFrame, tokenizer_file: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded): each text's ids, little-endian unsigned
    32-bit integers, and the text that these ids decode to.

    A null or empty text has no ids and decodes to the empty text. Texts of any
    length are encoded whole; a word is one path of the trie, whatever its length.
    Document ids may be null or repeat: each row is encoded by itself. An empty
    table gives no rows; other columns are not read, whatever their names.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(tokenizer_path(tokenizer_file), trie_encoder)
        for batch in batches:
            for part in byte_slices(batch, 1):
                raw = encoder.encode(part.column(1).to_pylist())
                sizes = np.fromiter(map(len, raw), np.int64, len(raw)) // 4
                decoded = encoder.decoder.decode(np.frombuffer(b"".join(raw), "<u4"), np.cumsum(sizes))
                yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), pa.array(sizes), pa.array(raw, pa.binary()), decoded],
                                                 ["doc_id", "n_tokens", "ids", "decoded"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded string")


def op11_bpe_round_trip(spark, sf_dir: str) -> DataFrame:
    """Every document's ids and the text they decode to, as digests."""
    done = encode_and_decode(table(spark, sf_dir, "documents"), "byte_bpe_50k.json")
    return done.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))
