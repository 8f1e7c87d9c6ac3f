"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads a word's UTF-8 bytes from both ends and labels every position
with language probabilities; a document's probabilities pool those of all its
positions. Its state starts anew at each word (a run without white space, of any
length, is one word), so what a word contributes is the same wherever it stands: a
worker computes it once per distinct word it meets and whole texts are read at the
cost of looking words up. Training is numpy backpropagation through time on the
driver, over all words of a bounded sample of labelled rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdictlake.llm.common import fresh_name, table, worker_keeps

HIDDEN = 20
CHUNK = 1024
TRAINED_BYTES = 48
DOCS_PER_LANGUAGE = 100
MOST_LANGUAGES = 500
EPOCHS = 5
BATCH = 256
RATE = 0.01
KEPT_WORDS = 100_000
UNKNOWN = "und"
REJECT_BELOW = 0.4

_LETTER = regex.compile(r"\p{L}")


class Direction(NamedTuple):
    """One reading direction: byte rows, recurrent weights, biases; the gates
    update, reset and candidate stand side by side."""
    bytes: np.ndarray
    state: np.ndarray
    bias: np.ndarray


class Network(NamedTuple):
    forward: Direction
    backward: Direction
    out: np.ndarray
    out_bias: np.ndarray
    languages: list[str]


def fresh(languages: list[str], hidden: int = HIDDEN, seed: int = 7) -> Network:
    rng = np.random.default_rng(seed)

    def direction() -> Direction:
        return Direction(rng.normal(0, 0.3, (256, 3 * hidden)).astype(np.float32),
                         rng.normal(0, hidden ** -0.5, (hidden, 3 * hidden)).astype(np.float32), np.zeros(3 * hidden, np.float32))

    return Network(direction(), direction(), rng.normal(0, hidden ** -0.5, (2 * hidden, len(languages))).astype(np.float32),
                   np.zeros(len(languages), np.float32), languages)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def read(d: Direction, words: np.ndarray, keep: bool = False, state: np.ndarray | None = None) -> tuple[np.ndarray, list]:
    """States after each byte, (position, word, hidden), of equally long words;
    ``state`` is what an earlier part of the words left."""
    hidden = d.state.shape[0]
    state = np.zeros((len(words), hidden), np.float32) if state is None else state
    states, steps = np.empty((words.shape[1], len(words), hidden), np.float32), []
    for t in range(words.shape[1]):
        given, back = d.bytes[words[:, t]] + d.bias, state @ d.state
        gates = sigmoid(given[:, :2 * hidden] + back[:, :2 * hidden])
        update, reset = gates[:, :hidden], gates[:, hidden:]
        candidate = np.tanh(given[:, 2 * hidden:] + reset * back[:, 2 * hidden:])
        if keep:
            steps.append((state, update, reset, candidate, back[:, 2 * hidden:]))
        state = candidate + update * (state - candidate)
        states[t] = state
    return states, steps


def labelled(net: Network, ahead: np.ndarray, behind: np.ndarray) -> np.ndarray:
    """Language probabilities from the states of both directions."""
    logits = np.concatenate([ahead, behind], axis=2) @ net.out + net.out_bias
    logits = np.exp(logits - logits.max(axis=2, keepdims=True))
    return logits / logits.sum(axis=2, keepdims=True)


def positions(net: Network, words: np.ndarray) -> np.ndarray:
    """Language probabilities of every position, (position, word, language)."""
    return labelled(net, read(net.forward, words)[0], read(net.backward, words[:, ::-1])[0][::-1])


def log_sums(net: Network, words: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
    """Per word the sum of its positions' log-probabilities, (word, language).
    Long words are read in chunks that hand their states on, forward once for the
    states at the chunks' starts and then chunk by chunk from the end, so that
    memory does not grow with their length."""
    starts, state = range(0, words.shape[1], chunk), None
    before = []
    for a in starts:
        before.append(state)
        if a + chunk < words.shape[1]:
            state = read(net.forward, words[:, a:a + chunk], state=state)[0][-1]
    total, state = 0, None
    for a, first in zip(reversed(starts), reversed(before)):
        part = words[:, a:a + chunk]
        behind = read(net.backward, part[:, ::-1], state=state)[0]
        total = total + np.log(labelled(net, read(net.forward, part, state=first)[0], behind[::-1]) + 1e-6).sum(axis=0)
        state = behind[-1]
    return total


def back_through(d: Direction, words: np.ndarray, steps: list, slopes: np.ndarray) -> Direction:
    """Gradients of one direction from the slopes at its states."""
    hidden = d.state.shape[0]
    g_bytes, g_state = np.zeros_like(d.bytes), np.zeros_like(d.state)
    carried = np.zeros((len(words), hidden), np.float32)
    for t in range(words.shape[1] - 1, -1, -1):
        state, update, reset, candidate, back = steps[t]
        slope = slopes[t] + carried
        at_candidate = slope * (1 - update) * (1 - candidate * candidate)
        at_update = slope * (state - candidate) * update * (1 - update)
        at_reset = at_candidate * back * reset * (1 - reset)
        gates = np.concatenate([at_update, at_reset, at_candidate * reset], axis=1)
        g_state += state.T @ gates
        carried = slope * update + gates @ d.state.T
        gates[:, 2 * hidden:] = at_candidate
        np.add.at(g_bytes, words[:, t], gates)
    return Direction(g_bytes, g_state, g_bytes.sum(axis=0))


def gradients(net: Network, words: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
    """Of the mean cross-entropy over all positions."""
    ahead, steps_a = read(net.forward, words, keep=True)
    behind, steps_b = read(net.backward, words[:, ::-1], keep=True)
    both = np.concatenate([ahead, behind[::-1]], axis=2)
    logits = both @ net.out + net.out_bias
    chance = np.exp(logits - logits.max(axis=2, keepdims=True))
    chance /= chance.sum(axis=2, keepdims=True)
    chance[:, np.arange(len(words)), labels] -= 1
    chance /= words.size
    slopes = chance @ net.out.T
    hidden = net.forward.state.shape[0]
    one = back_through(net.forward, words, steps_a, slopes[:, :, :hidden])
    two = back_through(net.backward, words[:, ::-1], steps_b, slopes[::-1, :, hidden:])
    return [*one, *two, np.tensordot(both, chance, axes=([0, 1], [0, 1])), chance.sum(axis=(0, 1))]


def byte_rows(words: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1)


def train(samples: list[tuple[str, list[str]]], languages: list[str], epochs: int = EPOCHS, seed: int = 11) -> Network:
    """Fit on (language, words) rows; batches hold words of one length. Adam. A
    word counts as often as it occurs; of words beyond ``TRAINED_BYTES`` each
    stretch of that many bytes is a sample (truncated backpropagation)."""
    net = fresh(languages)
    weights = [*net.forward, *net.backward, net.out, net.out_bias]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    by_length: dict[int, list[tuple[bytes, int]]] = defaultdict(list)
    for language, words in samples:
        for word in words:
            raw = spelled(word)
            for a in range(0, len(raw), TRAINED_BYTES):
                part = raw[a:a + TRAINED_BYTES]
                by_length[len(part)].append((part, languages.index(language)))
    rng, step = np.random.default_rng(seed), 0
    for epoch in range(epochs):
        batches = []
        for length in sorted(by_length):
            rows = by_length[length]
            order = rng.permutation(len(rows))
            batches += [[rows[i] for i in order[a:a + BATCH]] for a in range(0, len(rows), BATCH)]
        for n in rng.permutation(len(batches)):
            words, labels = byte_rows([w for w, _ in batches[n]]), np.array([k for _, k in batches[n]])
            step += 1
            rate = RATE * (1 - 0.9 * epoch / max(1, epochs - 1)) * len(words) / BATCH
            for w, g, m, v in zip(weights, gradients(net, words, labels), first, second):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                w -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return net


def spelled(word: str) -> bytes:
    return word.encode("utf-8", "surrogatepass")


class Reader:
    """Pools whole texts; keeps what distinct words contribute: per language the
    sum of the positions' log-probabilities, and the number of positions."""

    def __init__(self, net: Network, kept: int = KEPT_WORDS):
        self.net, self.kept = net, kept
        self.place: dict[str, int] = {}
        self.sums = np.zeros((1 << 12, len(net.languages) + 1), np.float32)

    def learn(self, words: list[str]) -> None:
        """Add what the words contribute; words without letters add nothing."""
        for w in words:
            self.place[w] = len(self.place)
        while len(self.sums) < len(self.place):
            self.sums = np.concatenate([self.sums, np.zeros_like(self.sums)])
        by_length: dict[int, list[tuple[bytes, int]]] = defaultdict(list)
        for w in words:
            if _LETTER.search(w):
                by_length[len(raw := spelled(w))].append((raw, self.place[w]))
        for length, rows in by_length.items():
            at_once = max(1, min(4096, (1 << 18) // length))
            for a in range(0, len(rows), at_once):
                part = rows[a:a + at_once]
                where = [k for _, k in part]
                self.sums[where, :-1] = log_sums(self.net, byte_rows([w for w, _ in part]))
                self.sums[where, -1] = length

    def pool(self, texts: list[str | None]) -> np.ndarray:
        """Per text the probability of each language; zeros without letters."""
        split = [(t or "").lower().split() for t in texts]
        if len(self.place) > self.kept:
            self.place.clear()
            self.sums[:] = 0
        missing = set().union(*split).difference(self.place)
        if missing:
            self.learn(sorted(missing))
        out = np.zeros((len(texts), len(self.net.languages)))
        for n, words in enumerate(split):
            if words:
                places = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
                total = self.sums[places].sum(axis=0, dtype=np.float64)
                if total[-1]:
                    mean = np.exp((total[:-1] - total[:-1].max()) / np.sqrt(total[-1]))
                    out[n] = mean / mean.sum()
        return out


def fold(doc_id: str = "doc_id") -> Column:
    """The remainder that keeps a document out of training where it is 2."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 4


def training_words(docs: DataFrame, docs_per_language: int, most_languages: int) -> list[tuple[str, list[str]]]:
    """(language, words): all words of a sample of the labelled documents, about
    ``docs_per_language`` of each of the ``most_languages`` languages with most
    documents. A hash of a row below its language's share picks it, so no
    language's rows meet in one task."""
    able = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold() != 2)).select("doc_id", "lang", "text")
    sizes = able.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(most_languages)
    part = 1 << 30
    shares = sizes.select("lang", (docs_per_language * part / F.col("n")).alias("share"))
    chosen = able.withColumn("place", F.pmod(F.xxhash64("doc_id", "text"), F.lit(part))).join(shares, "lang").filter("place < share").select("lang", "text")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [[w for w in text.lower().split() if _LETTER.search(w)] for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.string()))], ["lang", "words"])

    return sorted((r.lang, r.words) for r in chosen.mapInArrow(spread, "lang string, words array<string>").collect())


def fit(docs: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE, most_languages: int = MOST_LANGUAGES) -> Network | None:
    """A network from the documents outside the held-out fold; None without any.
    The sample is bounded in rows: about ``docs_per_language`` of each language."""
    samples = [s for s in training_words(docs, docs_per_language, most_languages) if s[1]]
    return train(samples, sorted({language for language, _ in samples})) if samples else None


def identify(docs: DataFrame, net: Network | None, out: str = "_lang") -> DataFrame:
    """Add ``out``: struct(pred, score) to every row; the text alone decides.

    A null text, or one without letters, is ``und`` with score 0, and so is every
    text if there was nothing to learn from. Whole texts of any length are read;
    repeated rows get equal results; an empty table stays empty. All other
    columns stay as they are, whatever their names; one named ``out`` is replaced.
    """
    mark = hash(tuple(w.tobytes() for w in (*net.forward, *net.backward, net.out, net.out_bias))) if net else 0

    @F.arrow_udf("struct<pred:string,score:double>")
    def label(texts: pa.Array) -> pa.Array:
        names, scores = [], []
        reader = worker_keeps(("language", mark), lambda: Reader(net)) if net else None
        for part in (texts.slice(i, 256) for i in range(0, len(texts), 256)):
            chance = reader.pool(part.to_pylist()) if reader else np.zeros((len(part), 1))
            scores += chance.max(axis=1).tolist()
            names += [net.languages[k] if c else UNKNOWN for k, c in zip(chance.argmax(axis=1), chance.max(axis=1))] if net else [UNKNOWN] * len(part)
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["pred", "score"])

    # Non-deterministic to the planner: it must not be computed again by a filter.
    return docs.withColumn(out, label.asNondeterministic()(F.col("text")))


def recognised(docs: DataFrame, reject_below: float = REJECT_BELOW) -> DataFrame:
    """The documents whose language is recognised: a text without letters (null,
    empty, white space), or one whose best language stays below ``reject_below``,
    goes. Texts of any length are read whole, equal rows fare alike, an empty
    table stays empty, and all columns stay as they are, whatever their names."""
    out = fresh_name(docs.columns, "_lang")
    known = identify(docs, fit(docs), out)
    return known.filter((F.col(f"{out}.pred") != UNKNOWN) & (F.col(f"{out}.score") >= reject_below)).drop(out)


def op7_language_id(spark, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    found = identify(docs.select("doc_id", "text"), fit(docs))
    return found.select("doc_id", (fold() == 2).alias("held_out"), F.col("_lang.pred").alias("lang_pred"), F.col("_lang.score").alias("score"))
