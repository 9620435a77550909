import hashlib

import public_tokenizers
import pytest
import sentencepiece

from learnsilver.llm import agenda_pieces
from learnsilver.llm.queries import model_bytes

TEXTS = [
    "The cat sat on the mat.",
    "",
    None,
    " two  spaces, a\ttab\nand a line ",
    "▁already marked ▁▁",
    "😀 bytes \x00 é퟿ ｆﬁ",
    "</s> <s> <unk> <0x0A> are text",
    "aaaaaaaaaaaaaaaaaaaaaaaa" * 50,
    " " * 70 + "x" + " " * 33,
    "long words " * 20_000,
    "The cat sat on the mat.",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(
        model_file=public_tokenizers.path("piece_bpe_32k.model")
    )


def test_ids_and_texts_are_the_librarys(documents, library):
    rows = list(enumerate(TEXTS))
    got = {r.doc_id: r.ids for r in agenda_pieces.encode(documents(rows), model_bytes()).collect()}
    assert got == {i: library.encode(text or "", add_eos=True) for i, text in rows}


def test_decoding_gives_the_texts_back(documents, library):
    rows = list(enumerate(TEXTS))
    encoded = agenda_pieces.encode(documents(rows), model_bytes())
    got = {r.doc_id: r.text for r in agenda_pieces.decode(encoded, model_bytes()).collect()}
    assert got == {i: (text or "").replace("▁", " ") for i, text in rows}


def test_digests(documents, library):
    rows = list(enumerate(TEXTS))
    for row in agenda_pieces.digests(documents(rows), model_bytes()).collect():
        ids = library.encode(TEXTS[row.doc_id] or "", add_eos=True)
        assert row.n_tokens == len(ids)
        decimals = " ".join(map(str, ids))
        assert row.ids_sha256 == hashlib.sha256(decimals.encode()).hexdigest()
        text = library.decode(ids)
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_no_rows_and_null_ids(documents):
    assert agenda_pieces.encode(documents([]), model_bytes()).count() == 0
    rows = agenda_pieces.digests(documents([(None, "a"), (None, "a")]), model_bytes()).collect()
    assert len(rows) == 2 and rows[0] == rows[1]


def test_a_difference_to_the_library_is_an_error():
    known = agenda_pieces.vocabulary(model_bytes())
    with pytest.raises(ValueError, match="the library encodes"):
        known.check(["the"], [b"\x01\x00\x00\x00"])


def test_the_whole_query_against_the_library(spark, library):
    import duckdb

    from learnsilver.llm.queries import op8_sentencepiece

    folder = "/root/testdata/sf0.001"
    got = {r.doc_id: r.ids_sha256 for r in op8_sentencepiece(spark, folder).collect()}
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{folder}/documents.parquet'").fetchall()
    digest = lambda text: hashlib.sha256(
        " ".join(map(str, library.encode(text or "", add_eos=True))).encode()
    ).hexdigest()
    assert got == {i: digest(text) for i, text in rows}


def test_forgetting_does_not_change_results(monkeypatch, library):
    monkeypatch.setattr(agenda_pieces, "REMEMBERED", 3)
    encoder = agenda_pieces.Encoder(model_bytes())
    texts = [text for text in TEXTS if text]
    for _ in range(2):
        for text, (ids, _) in zip(texts, encoder.encode(texts)):
            assert ids == library.encode(text, add_eos=True)
