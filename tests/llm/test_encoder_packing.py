"""The chunk encoder, packing into sequences and token files against the untouched library."""

import collections
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tests.llm.conftest import prose, table
from waitcast.llm import chunk_codes, packing, token_files

PARTS = ["\x01", "b.", "a\nb", "a", "é", "É", "1", " ", " ", "  ", "\n", "\t", "'s", "'", "!", ",", "\x1c", "\x85", " ", " ", "漢", "<|endoftext|>",
         "<|startoftext|>", "<|", "İ", "ß", "é", "é", "́", "Σ", "ςa", "word", "The", "ligne.", "\x00", "\x0b", "½", "٣", "ǅ", "ſ", "ĳ", "Ŀ", "×", "÷", "$", "`"]


def model(name: str) -> str:
    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        return f.read()


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_equals_the_library(name):
    r = random.Random(4)
    texts = ["".join(r.choices(PARTS, k=r.randint(0, 14))) for _ in range(8000)] + [prose(9, 3000), ""]
    tokenizer, encoder = Tokenizer.from_str(model(name)), chunk_codes.Encoder(model(name))
    assert encoder.byte_level or encoder.word_level
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in encoder(chunk_codes.large(pa.array(texts))).each()] == want
    encoder.clear()
    again = [x.tolist() for p in chunk_codes.pieces(chunk_codes.large(pa.array(texts)), 500) for x in encoder(p).each()]
    assert again == want


def test_encoder_takes_whole_texts_of_another_scheme():
    text = model("byte_bpe_50k.json").replace('"add_prefix_space": false', '"add_prefix_space": true').replace('"add_prefix_space":false', '"add_prefix_space":true')
    encoder, tokenizer = chunk_codes.Encoder(text), Tokenizer.from_str(text)
    assert not (encoder.byte_level or encoder.word_level)
    texts = ["one two", "", " a  b\n c."]
    assert [x.tolist() for x in encoder(chunk_codes.large(pa.array(texts))).each()] == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_encoder_forgets_when_full(monkeypatch):
    monkeypatch.setattr(chunk_codes, "CACHE_CHUNKS", 20)
    encoder, tokenizer = chunk_codes.Encoder(model("word_bpe_49k.json")), Tokenizer.from_str(model("word_bpe_49k.json"))
    for i in range(5):
        text = prose(i, 100)
        assert encoder(chunk_codes.large(pa.array([text]))).flat.tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def check_pieces(got, rows, window):
    tokenizer = Tokenizer.from_str(model("word_bpe_49k.json"))
    want = collections.Counter((i, np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes()) for i, t in rows)
    got = sorted(got, key=lambda r: (r.sequence_id, r.offset))
    filled = collections.Counter()
    for r in got:
        assert r.offset == filled[r.sequence_id]  # without gaps from 0
        filled[r.sequence_id] += r.length
        assert len(r.ids) == 4 * r.length > 0 and r.ids_crc32 == zlib.crc32(bytes(r.ids))
    assert sorted(filled) == list(range(len(filled)))
    assert all(n <= window and n & (n - 1) == 0 for n in filled.values())  # nothing is padded
    assert [n for _, n in sorted(filled.items())] == sorted(filled.values(), reverse=True)
    documents, at = collections.Counter(), 0
    while at < len(got):  # pieces of a document follow each other
        ids, first = b"", got[at]
        while len(ids) < 4 * first.doc_tokens:
            assert got[at].doc_id == first.doc_id and got[at].start == len(ids) // 4 and got[at].doc_tokens == first.doc_tokens
            ids, at = ids + bytes(got[at].ids), at + 1
        documents[first.doc_id, ids] += 1
    assert documents == want


@pytest.mark.parametrize("window", [1, 64, 4096])
def test_packing(edge, clashing, edge_rows, window):
    for docs in (edge.repartition(5), clashing):
        if window == 1:
            docs = docs.where("coalesce(length(text), 0) < 200")
        rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        check_pieces(packing.pack(docs, model("word_bpe_49k.json"), 2, window).collect(), rows, window)


def test_packing_gives_sequences(edge):
    packed = packing.pack(edge, model("word_bpe_49k.json"), 2, 256)
    total = packed.agg({"length": "sum"}).first()[0]
    got = packing.sequences(packed).orderBy("sequence_id").collect()
    assert sum(len(r.ids) for r in got) == 4 * total and all(len(r.ids) == 1024 for r in got[:total // 256])
    assert all(len(r.doc_ids) == len(r.offsets) and r.offsets[0] == 0 for r in got)


def test_packing_of_nothing_and_wrong_windows(empty):
    assert packing.pack(empty, model("word_bpe_49k.json"), 2).count() == 0
    with pytest.raises(ValueError, match="power of two"):
        packing.pack(empty, model("word_bpe_49k.json"), 2, 1000)


def test_boundaries_are_the_binary_digits_of_the_rest():
    assert packing.boundaries(3 * 4096 + 1234, 4096).tolist() == [3 * 4096 + x for x in (0, 1024, 1152, 1216, 1232, 1234)]
    assert packing.boundaries(8192, 4096).tolist() == [8192]
    place, size = np.array([0, 10, 4000, 4096]), np.array([10, 3990, 96, 4096 + 5])
    row, start, length, sequence, offset = packing.cut(place, size, 8197, 4096)
    assert row.tolist() == [0, 1, 2, 3, 3, 3] and length.tolist() == [10, 3990, 96, 4096, 4, 1] and sequence.tolist() == [0, 0, 0, 1, 2, 3]
    assert start.tolist() == [0, 0, 0, 0, 4096, 4100] and offset.tolist() == [0, 10, 4000, 0, 0, 0]


def test_token_files_take_added_tokens_as_the_library_does(spark):
    docs = spark.createDataFrame([(1, "a <|endoftext|> b"), (2, "a<|endoftext|>\n<|endoftext|> c, d")], "doc_id long, text string")
    tokenizer = Tokenizer.from_str(model("byte_bpe_50k.json"))
    got = token_files.write(docs, model("byte_bpe_50k.json")).read().collect()
    want = [(i, np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 0], "<u4").tobytes()) for i, t in docs.collect()]
    assert table([(r.doc_id, bytes(r.ids)) for r in got]) == table(want)
