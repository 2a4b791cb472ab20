"""SentencePiece coding and token counts against the libraries."""

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from annoflow.llm.pieces import PieceCoder, encode_documents
from annoflow.llm.token_counts import count_batch, token_counts

PATH = public_tokenizers.path("piece_bpe_32k.model")
MODEL = sentencepiece.SentencePieceProcessor(model_file=PATH)
CODER = PieceCoder(PATH)
ODD = ["", " ", "  ", "   a", "a ", "a  ", "▁", " ▁ x", "\n\n", "<s>hi</s><unk>", "a" * 300, "the" * 60, " " * 70, "①Ａ😀\x00é", None]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=" \nabcehinorst▁é①😀0", max_size=40))
def test_encodes_and_decodes_as_the_library(text):
    ids = MODEL.encode(text)
    assert CODER.encode(text) == ids
    assert CODER.decode(ids) == MODEL.decode(ids)
    assert CODER.document(text) == (len(ids), ",".join(map(str, ids)), MODEL.decode(ids))


def test_random_pieces_side_by_side():
    draw = random.Random(5)
    for _ in range(2000):
        text = "".join(CODER.pieces[draw.randrange(259, 32000)] for _ in range(draw.randrange(10)))
        assert CODER.encode(text) == MODEL.encode(text)


def test_decodes_any_ids():
    draw = random.Random(6)
    for _ in range(500):
        ids = [draw.choice([draw.randrange(32000), draw.randrange(3, 259)]) for _ in range(draw.randrange(9))]
        assert CODER.decode(ids) == MODEL.decode(ids)


def test_documents(make_docs):
    rows = list(enumerate(ODD)) + [(0, ""), (None, "a b")]
    got = encode_documents(make_docs(rows), PATH, with_ids=True).collect()
    want = []
    for doc_id, text in rows:
        ids = MODEL.encode(text or "")
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        want.append((doc_id, len(ids), digest, hashlib.sha256(MODEL.decode(ids).encode()).hexdigest(), ids))
    order = lambda r: (r[0] is None, r[0] or 0, r[2])
    assert sorted(((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256, r.ids) for r in got), key=order) == sorted(want, key=order)
    assert encode_documents(make_docs([]), PATH).count() == 0


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "byte_bpe_50k.json", "word_bpe_49k.json"])
def test_counts(name, make_docs):
    path = public_tokenizers.path(name)
    texts = [t or "" for t in ODD] + ["<|endoftext|> x<|endoftext|>", "don't   stop\n\n now " * 500, "x" * 5000]
    if name.endswith(".json"):
        library = Tokenizer.from_file(path)
        want = [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    else:
        want = [len(MODEL.encode(t)) for t in texts]
    assert count_batch(path, texts) == want
    rows = list(enumerate(texts)) + [(99, None)]
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts(make_docs(rows), path, limit=9).collect()}
    assert got == {i: (len(t.encode()), n, n > 9) for i, (t, n) in enumerate(zip(texts, want))} | {99: (0, 0, False)}


def test_long_json_texts_are_cut_safely():
    path = public_tokenizers.path("byte_bpe_50k.json")
    text = "some words, 12 numbers\n and  blanks " * 9000 + "y" * 300_000 + " end"
    assert count_batch(path, [text]) == [len(Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids)]
