"""Piecewise encoding equals whole encoding; block files give every id back."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from verdictlake.llm import token_files as files
from verdictlake.llm.packing import op3_pack_sequences
from verdictlake.llm.tokens import byte_slices, encoded, file_encoder, tokenizer_path

TOKENIZERS = ["word_bpe_49k.json", "byte_bpe_50k.json"]
ODD = ["", " ", "a", " a", "a ", "a  b", "a\n b", "a \nb", "it's  'll I'M\tx", "a\x1cb \x1d c", "x y  z", "été ́x",
       "ΟΔΟΣ ΟΔΟΣ", "<|endoftext|> a<|endoftext|>", "x<|startoftext|>  y <|endoftext|>", "nul\x00 x \x00", "e.g. a.b,c;D:E!f? X...y .,", "A.B C.\nD,e", "É.é, ß!", "\u2003 \u2003b \u2003 c", "a\t \n b", "K. \u212a.", "a\x1f\x1eb", "123 4567  89", "日本語 テスト", "a" * 5000, "\r\n\r\n x", "😀 😀😀", "a\u0085b \u0085 c"]


def plain(name):
    """The library's own encoding, with the file as it is."""
    tokenizer = Tokenizer.from_file(tokenizer_path(name))
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", TOKENIZERS)
@pytest.mark.parametrize("kept", [50, 400_000])
def test_pieces_join_to_the_whole(spark, sf_dir, name, kept):
    encoder, whole = file_encoder(tokenizer_path(name), kept=kept), plain(name)
    texts = ODD + [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    for part in (texts[:7], texts[7:60], texts[60:]):
        for text, ids in zip([*part, ""], encoder.encode([*part, None])):
            assert np.frombuffer(ids, "<u2").tolist() == whole(text), repr(text[:60])


def test_code_lengths_are_optimal_and_limited():
    counts = np.array([1, 1, 2, 3, 5, 8, 13, 21, 34, 0, 55])
    free, tight = files.code_lengths(counts, 16), files.code_lengths(counts, 4)
    assert free.max() == 9 and tight.max() == 4 and free[9] == tight[9] == 0
    for lengths in (free, tight):
        assert sum(2.0 ** -int(x) for x in lengths if x) == 1.0
    assert (free * counts).sum() < (tight * counts).sum()


@pytest.mark.parametrize("n,symbols,every", [(1, 1, 4), (5, 1, 4), (1000, 3, 64), (5000, 300, 512), (4096, 300, 512)])
def test_bits_come_back(n, symbols, every):
    rng = np.random.default_rng(n)
    ids = (rng.random(n) ** 3 * symbols).astype(np.int64)
    lengths = files.code_lengths(np.bincount(ids, minlength=symbols + 2), 10)
    payload, marks = files.pack(ids, files.canonical_codes(lengths), lengths, every)
    back = files.unpack([payload, payload], [marks, marks], [n, n], files.decoding_table(lengths), every)
    assert all(np.array_equal(b, ids) for b in back)


def round_trip(spark, docs, path):
    lengths = files.encode_to_files(docs, path, TOKENIZERS[0])
    return files.read_documents(spark, path, lengths)


def test_files_equal_plain_encoding(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame([(10 ** 9, "a <|endoftext|> b<|startoftext|>"), (10 ** 9 + 1, None)], docs.schema))
    back = {r.doc_id: r for r in round_trip(spark, docs, str(tmp_path / "f")).collect()}
    whole, start = plain(TOKENIZERS[0]), 0
    for row in docs.select("doc_id", "text").orderBy("doc_id").collect():
        ids = np.array([*whole(row.text or ""), 1], "<u4")
        got = back[row.doc_id]
        assert (got.start, got.n_tokens, zlib.crc32(bytes(got.ids))) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert len(back) == docs.count()


def test_nulls_ties_and_empty_tables(spark, tmp_path):
    schema = "doc_id long, text string, ids string, n_tokens int"
    docs = spark.createDataFrame([(2, None, "x", 1), (1, "", None, 2), (1, "b a", "y", 3), (1, "b a", "y", 3), (None, "z", "", 4)], schema)
    rows = round_trip(spark, docs, str(tmp_path / "a")).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, 1, 1, 1, 2] and rows[-1].n_tokens == 1
    assert round_trip(spark, docs.filter(F.lit(False)), str(tmp_path / "b")).count() == 0
    assert encoded(docs, TOKENIZERS[1]).count() == 5


def test_slices_hold_every_row():
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * n if n else None for n in (0, 5, 30, 0, 9, 2, 0)])], ["t"])
    for size in (1, 8, 1000):
        parts = list(byte_slices(batch, 0, size))
        assert pa.Table.from_batches(parts).column(0).to_pylist() == batch.column(0).to_pylist()
    assert list(byte_slices(batch.slice(0, 0), 0)) == []


def test_query_digests_equal_plain_python(spark, sf_dir):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    whole, start = plain(TOKENIZERS[0]), 0
    got = {r.doc_id: tuple(r) for r in files.op1_token_files(spark, sf_dir).collect()}
    for name in sorted(docs):
        ids = np.array([*whole(docs[name]), 1], "<u4")
        assert got.pop(name) == (name, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert not got
    whole = plain(TOKENIZERS[1])
    placed = op3_pack_sequences(spark, sf_dir).toPandas()
    for name, own in placed.sort_values(["doc_id", "start"]).groupby("doc_id"):
        ids, at = np.array([*whole(docs[name]), 1], "<u4"), 0
        for r in own.itertuples():
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids[at:at + r.length].tobytes()))
            at += r.length
        assert at == len(ids)
    assert sorted(set(placed.doc_id)) == sorted(docs)


@pytest.mark.parametrize("name", TOKENIZERS)
def test_pieces_that_come_again_are_not_encoded_again(name):
    """Filling the table of pieces drops those only that were long not met."""
    encoder, whole, asked = file_encoder(tokenizer_path(name), kept=40), plain(name), []
    new = encoder.new
    encoder.new = lambda pieces: asked.extend(pieces) or new(pieces)
    texts = [f"common words, été### Ñandú: {' '.join(f'own{chr(97 + i // 26)}{chr(97 + i % 26)}{chr(97 + k)}' for k in range(25))}" for i in range(60)]
    for text in texts:
        assert np.frombuffer(encoder.encode([text])[0], "<u2").tolist() == whole(text)
    assert len(asked) == len(set(asked)) > 1500
