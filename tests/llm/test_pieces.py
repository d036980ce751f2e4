import hashlib
import random
import struct

import public_tokenizers
import pytest
import sentencepiece
from helpers import documents

from creditmart.llm import pieces, queries

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def coder():
    vocabulary = pieces.load(PATH)
    return pieces.Encoder(vocabulary), pieces.Decoder(vocabulary)


def check(coder, text):
    ids = coder[0].encode(text)
    expected = LIBRARY.encode(text, add_bos=True, add_eos=True)
    assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == expected, repr(text)
    assert coder[1].decode(ids) == LIBRARY.decode(expected), repr(text)


def test_special_texts(coder):
    for text in ("", " ", "  a", "a ", "▁a▁", "a\nb", "\n", " \n ", "\x00x", "😀 hi", "<s></s><0x41>", "é" * 500, " " * 100, "x" * 4000, "\t\r\n", "a  b   c"):
        check(coder, text)


def test_random_texts(coder):
    draw = random.Random(3)
    alphabet = "abcdethin erst   \n\n▁\t😀éñ中文ABC.,!<s>0123\x00"
    known = sorted(coder[0].v.scores)
    for _ in range(3000):
        check(coder, "".join(draw.choice(alphabet) for _ in range(draw.randint(0, 40))))
        check(coder, "".join(draw.choice(known).replace("▁", " ") for _ in range(draw.randint(0, 12))))


def test_words_and_whole_texts_agree(coder):
    """A vocabulary that cannot be cut at words is encoded in one piece, with the same ids."""
    import dataclasses

    whole = pieces.Encoder(dataclasses.replace(coder[0].v, by_word=False))
    for text in ("The  quick\nbrown fox, über alles ", "中 文\n\n x"):
        assert whole.encode(text) == coder[0].encode(text)


def test_decoding_of_arbitrary_ids(coder):
    for ids in ([], [259], [300, 1, 2, 400], [264, 264]):
        assert coder[1].decode(struct.pack(f"<{len(ids)}I", *ids)) == LIBRARY.decode(ids)
    assert coder[1].decode(struct.pack("<3I", coder[0].v.byte_ids[0xC3], coder[0].v.byte_ids[0x28], 264)) == "�( a"


def test_tables_are_bounded(coder, monkeypatch):
    monkeypatch.setattr(pieces, "KEPT_WORDS", 5)
    monkeypatch.setattr(pieces, "KEPT_PAIRS", 5)
    for text in ("one two three four five six seven", "eight nine ten eleven", "twelve thirteen unbelievably"):
        check(coder, text)


def test_query_against_the_library(spark, small):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = queries.QUERIES["op4_sentencepiece"](spark, small).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = LIBRARY.encode(docs[r.doc_id], add_bos=True, add_eos=True)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest()


def test_edge_rows(spark):
    docs = documents(spark, [(1, None), (2, ""), (None, "hi"), (4, "hi"), (4, "hi")]).withColumnRenamed("lang", "_encoded").withColumnRenamed("source", "IDS")
    out = pieces.encode_documents(docs, pieces.load(PATH), decoded="decoded")
    rows = {(r.doc_id, r.text): (r.n_tokens, r.decoded) for r in out.collect()}
    assert out.count() == 5 and rows[1, None] == rows[2, ""] == (2, "") and rows[None, "hi"] == rows[4, "hi"] and "_encoded" in out.columns
    assert pieces.encode_documents(docs.limit(0), pieces.load(PATH)).count() == 0
