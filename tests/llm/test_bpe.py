import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from llm_cases import ROWS, documents, frame
from tokenizers import Tokenizer

from orderlens.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
PARTS = [
    "he'll", "the", "'s", " ", "<|endoftext|>", "<|", "İ", "Σ", "ΑΣ", "é", "é", "\x1c", "\x85", "　", "\n", "0", "12",
    "²", "Ⅷ", "一二", "ǅ", "ﬁ", "ª", "×", "😀", "👨‍👩", "_", "!!", "x" * 70, "ab" * 40, "aaaaaaa", "\x00", "​",
]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def test_equals_library(library):
    draw = random.Random(5)
    texts = [t or "" for _, t in [*ROWS, *documents()]]
    texts += ["".join(draw.choice(PARTS) for _ in range(draw.randint(0, 25))) for _ in range(2000)]
    vocab = bpe.vocabulary(PATH)
    encoder = bpe.TrieEncoder(vocab)
    lists = [vocab.pieces(t) for t in texts]
    encoder.prepare(lists)
    for text, pieces in zip(texts, lists, strict=True):
        ids = np.frombuffer(encoder.encode(pieces), "<u4").tolist()
        expected = library.encode(text, add_special_tokens=False).ids
        assert ids == expected, text
        assert bpe.decode(vocab, ids) == encoder.decoded(pieces) == library.decode(expected, skip_special_tokens=False)


def test_query_rows(spark, library):
    docs = [*ROWS, *documents()]
    result = bpe.encoding_digests(frame(spark, docs, ["n_tokens", "ids"]), PATH).collect()
    expected = []
    for doc, text in docs:
        ids = library.encode(text or "", add_special_tokens=False).ids
        shown = library.decode(ids, skip_special_tokens=False)
        expected.append((str(doc), len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(shown.encode()).hexdigest()))
    assert sorted((str(r[0]), *r[1:]) for r in map(tuple, result)) == sorted(expected)


def test_real_outputs(spark, library):
    rows = bpe.encode_documents(frame(spark, [(1, "Hello the world"), (2, None)]), PATH).collect()
    ids = library.encode("Hello the world").ids
    assert {r["doc_id"]: (r["n_tokens"], r["ids"], r["decoded"]) for r in rows} == {
        1: (len(ids), ids, library.decode(ids, skip_special_tokens=False)), 2: (0, [], "")
    }


def test_words_are_forgotten_and_learnt_again(monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_WORDS", 2)
    encoder = bpe.TrieEncoder(bpe.vocabulary(PATH))
    for _ in range(3):
        encoder.prepare([["alpha", "beta", "alphabet"]])
        before = encoder.encode(["alphabet"])
        encoder.prepare([["gamma", "alphabet"]])
        assert encoder.encode(["alphabet"]) == before


def test_empty_table(spark):
    assert bpe.encoding_digests(frame(spark, []), PATH).collect() == []
