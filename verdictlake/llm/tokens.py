"""Whole texts to token ids, with a public tokenizer file, in Arrow batches.

Words repeat, so texts are cut into pieces where the tokenizer cuts them anyway,
each worker keeps the ids of the pieces it has met, and only new pieces of a
batch are encoded. The cuts are chosen so that the pieces' ids, joined, are exactly the
ids of the text.
"""

from __future__ import annotations

import os
import re
import sys
from array import array
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from verdictlake.llm.common import worker_keeps

END = 1
KEPT_PIECES = 300_000
BATCH_BYTES = 1 << 20

_TOUCHING = re.compile(r"\s\s")
_BEFORE_SPACED_WORD = re.compile(r"(?<=\S)(?= \S)")
# Letters of ASCII, and of Latin-1 as their two bytes; where punctuation follows
# them, two words meet.
_LETTER, _LATIN, _MARK = np.zeros(256, bool), np.zeros(256, bool), np.zeros(256, bool)
_LETTER[[*b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"]] = True
_LATIN[[b for b in range(0x80, 0xC0) if b not in (0x97, 0xB7)]] = True
_SPACE = np.zeros(256, bool)
_SPACE[[*b"\t\n\v\f\r "]] = True
_MARK[[*b"!\"#$%&()*+,-./:;<=>?@[]^{|}~"]] = True
# One word, whatever is before or behind it; to lower-casing files, one that stays.
_WORD = re.compile(rb" ?(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
_FOLDED_WORD = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")

# Characters that byte-level files write for bytes: bytes not shown as themselves
# follow from 256 on.
_HIDDEN = [*range(0x21), *range(0x7F, 0xA1), 0xAD]
_SPELLED = [chr(256 + _HIDDEN.index(b)) if b in _HIDDEN else chr(b) for b in range(256)]

Ids = Iterable[Sequence[int]]


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer file lies on this machine."""
    import public_tokenizers
    return public_tokenizers.path(name)


def byte_slices(batch: pa.RecordBatch, column: int, size: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batch`` in runs whose values in ``column`` have about
    ``size`` bytes together; a longer value is a run by itself."""
    if not batch.num_rows:
        return
    length = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    run = np.cumsum(length, dtype=np.int64) // size
    starts = np.flatnonzero(np.diff(run, prepend=-1))
    for a, b in zip(starts, [*starts[1:], batch.num_rows]):
        yield batch.slice(a, b - a)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The integers of several ranges, one range after the other."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


def binary_array(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """One binary value per end: the bytes of ``data`` up to it."""
    offsets = np.concatenate([[0], ends])
    if len(data) >= 1 << 31:
        return pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)])
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])


def behind_letters(data: np.ndarray) -> np.ndarray:
    """Where punctuation follows a letter."""
    letter, first = _LETTER[data], np.zeros(len(data), bool)
    letter[1:] |= (data[:-1] == 0xC3) & _LATIN[data[1:]]
    first[1:] = letter[:-1] & _MARK[data[1:]]
    return first


# A cut takes texts in UTF-8 and gives the bytes of their pieces, at which of them
# a piece begins, and how many of them each text has.
Cut = Callable[[list[bytes]], tuple[np.ndarray, np.ndarray, np.ndarray]]


def spaced_pieces(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pieces for tokenizers whose words take a single space before them along: a
    cut before each such space and around line ends, unless white space touches."""
    data, sizes = np.frombuffer(b"".join(texts), np.uint8), np.fromiter(map(len, texts), np.int64, len(texts))
    first, lines = behind_letters(data), data == 0x0A
    first |= lines | (data == 0x20)
    first[1:] |= lines[:-1]
    for text, end, size in zip(texts, np.cumsum(sizes), sizes):
        first[end - size:end][:1] = True
        plain = text.decode("utf-8", "surrogatepass")
        if _TOUCHING.search(plain):
            own = [len(p.encode("utf-8", "surrogatepass")) for p in _BEFORE_SPACED_WORD.split(plain)]
            first[end - size:end] = False
            first[end - size + np.cumsum([0, *own[:-1]])] = True
    return data, np.flatnonzero(first), sizes


def bare_pieces(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pieces for tokenizers to which white space only separates words."""
    data, sizes = np.frombuffer(b"".join(texts), np.uint8), np.fromiter(map(len, texts), np.int64, len(texts))
    space, first = _SPACE[data], behind_letters(data)
    first[1:] |= space[:-1]
    first[(np.cumsum(sizes) - sizes)[sizes > 0]] = True
    kept = np.concatenate([[0], np.cumsum(~space)])[np.concatenate([[0], np.cumsum(sizes)])]
    return data[~space], np.flatnonzero(first[~space]), np.diff(kept)


def folded_pieces(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same for tokenizers that also lower-case: A-Z are lower-cased here."""
    return bare_pieces([t.lower() for t in texts])


class Encoder:
    """``encode(texts)``: the ids of each text, as bytes of type ``kind``.

    ``whole(text)`` gives the ids of any text, ``new(pieces)`` those of pieces and
    ``cut(texts)`` the pieces of texts. ``specials`` are strings with ids of their
    own: texts that hold one are encoded whole. What pieces give is kept; beyond
    ``kept`` pieces a new table is begun, and of the one before it those stay that
    come again before the new one is full.
    """

    def __init__(self, whole: Callable[[str], Sequence[int]], new: Callable[[list[bytes]], Ids], cut: Cut,
                 specials: list[str], kind: str = "<u4", kept: int = KEPT_PIECES):
        self.whole, self.new, self.cut, self.kind, self.kept = whole, new, cut, kind, kept
        self.specials = specials
        self.known: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}

    def bytes_of(self, ids: Sequence[int]) -> bytes:
        out = array("H" if self.kind == "<u2" else "I", ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def ids_of(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of distinct pieces."""
        if len(self.known) > self.kept:
            self.before, self.known = self.known, {}
        found = list(map(self.known.get, pieces))
        missing = []
        for n, (piece, ids) in enumerate(zip(pieces, found)):
            if ids is None:
                ids = self.before.get(piece)
                if ids is None:
                    missing.append(n)
                else:
                    found[n] = self.known[piece] = ids
        for n, ids in zip(missing, self.new([pieces[n] for n in missing])):
            found[n] = self.known[pieces[n]] = self.bytes_of(ids)
        return found

    def encode(self, texts: list[str | None]) -> list[bytes]:
        texts = [t or "" for t in texts]
        special = [any([s in t for s in self.specials]) for t in texts]
        data, starts, sizes = self.cut([b"" if s else t.encode("utf-8", "surrogatepass") for s, t in zip(special, texts)])
        pieces = binary_array(data, np.append(starts[1:], len(data)) if len(starts) else starts).dictionary_encode()
        distinct = self.ids_of(pieces.dictionary.to_pylist())
        ids, lengths = np.frombuffer(b"".join(distinct), self.kind), np.fromiter(map(len, distinct), np.int64, len(distinct)) // np.dtype(self.kind).itemsize
        used = pieces.indices.to_numpy()
        own = lengths[used]
        out = memoryview(ids[ranges((np.cumsum(lengths) - lengths)[used], own)].tobytes())
        before = np.concatenate([[0], np.cumsum(own)])[np.searchsorted(starts, np.concatenate([[0], np.cumsum(sizes)]))]
        at = (before * np.dtype(self.kind).itemsize).tolist()
        return [self.bytes_of(self.whole(t)) if s else bytes(out[a:b]) for t, s, a, b in zip(texts, special, at, at[1:])]


def file_encoder(path: str, kept: int = KEPT_PIECES) -> Encoder:
    """The encoder of a tokenizer file, for files whose words take a single space
    before them along, or that drop white space. Strings of added tokens get
    those tokens' ids, as the file says; truncation and padding stay unused."""
    from tokenizers import Tokenizer
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals the cores
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()

    def whole(text: str) -> list[int]:
        return tokenizer.encode(text, add_special_tokens=False).ids

    def same(*texts: str) -> bool:
        return all(whole(texts[0]) == whole(t) for t in texts)

    cut = spaced_pieces if not same("a b", "a  \n b", " a b ") else folded_pieces if same("ab", "AB", "aB") else bare_pieces
    single, model = (_FOLDED_WORD if cut is folded_pieces else _WORD).fullmatch, tokenizer.model

    def word(piece: bytes) -> list[int]:
        """A piece that is one word goes to the merges without the cutting."""
        spelled = piece.decode() if piece.isalpha() else "".join([_SPELLED[b] for b in piece])
        return [t.id for t in model.tokenize(spelled)]

    letters = [*map(chr, [*range(65, 91), *range(97, 123), *range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)])]
    probes = [p for t in [*letters, *("".join(letters[n:n + k]) for n in range(len(letters)) for k in (2, 3, 9))] for p in (t.encode(), b" " + t.encode()) if single(p)]
    plain = all(word(p) == whole(p.decode()) for p in probes)

    def new(pieces: list[bytes]) -> Iterator[list[int]]:
        for start in range(0, len(pieces), 4096):
            part = pieces[start:start + 4096]
            alone = [plain and (p.isalpha() or single(p) is not None) for p in part]
            others = iter(tokenizer.encode_batch_fast([p.decode("utf-8", "surrogatepass") for p, a in zip(part, alone) if not a], add_special_tokens=False))
            for p, a in zip(part, alone):
                yield word(p) if a else next(others).ids

    return Encoder(whole, new, cut, [t.content for t in tokenizer.get_added_tokens_decoder().values()],
                   "<u2" if tokenizer.get_vocab_size() <= 1 << 16 else "<u4", kept)


def worker_encoder(path: str, make: Callable[[str], Encoder] = file_encoder) -> Encoder:
    """A file's encoder with the pieces that this worker's tasks have met: texts
    of one corpus share most of their words. At most twice ``KEPT_PIECES`` pieces of
    some 250 bytes are kept."""
    return worker_keeps((path, make.__module__, make.__qualname__), lambda: make(path))


def encoded(docs: DataFrame, tokenizer_file: str, doc_id: str = "doc_id", text: str = "text",
            end: int | None = END, then: Callable | None = None, schema: str = "doc_id long, ids binary") -> DataFrame:
    """(doc_id, ids): each document's ids with the ``end`` id, as little-endian
    binary of 2 bytes an id (4 for vocabularies above 65,536). ``then`` makes rows of
    ``schema`` of them in the same Python worker, so a task has one, not two.

    A null text counts as empty and gives the end id alone. Ids of documents may
    be null or repeat; each row is encoded by itself. Other columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(tokenizer_path(tokenizer_file))
        tail = b"" if end is None else encoder.bytes_of([end])
        for batch in batches:
            for part in byte_slices(batch, 1):
                ids = [value + tail for value in encoder.encode(part.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return docs.select(doc_id, text).mapInArrow((lambda batches: then(run(batches))) if then else run, schema)


def id_dtype(tokenizer_file: str) -> str:
    from tokenizers import Tokenizer
    return "<u2" if Tokenizer.from_file(tokenizer_path(tokenizer_file)).get_vocab_size() <= 1 << 16 else "<u4"
