from __future__ import annotations

import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest_llm import LONG
from feira.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
RANKS = bpe.read_ranks(PATH)
THEIRS = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@pytest.fixture(scope="module")
def codecs():
    model, order = bpe.model_bytes(RANKS), tuple(sorted(RANKS.values()))
    return [bpe.Codec(model, order, public_tokenizers.PATTERN, cut) for cut in (True, False)]


@settings(max_examples=400, deadline=None)
@given(
    st.text(max_size=80)
    | st.text(alphabet="ab '\n\t\r s1é.  \u0085\x1c▁<>unk/", max_size=80)
    | st.lists(st.sampled_from(["the", " ", "  ", "'ll", "don't", "\n", "word", "1234", "ﬁ", "😀", "﷐"]), max_size=30).map("".join)
)
def test_same_ids_as_the_rank_library(codecs, text):
    expected = " ".join(map(str, THEIRS.encode_ordinary(text)))
    for codec in codecs:
        # Twice, so that remembered pieces are used too.
        assert codec.encode([text, text]) == [expected, expected]
        assert codec.decode(expected) == text.encode()


def test_every_token_decodes_to_itself(codecs):
    assert all(codecs[0].tokens[str(rank)] == token for token, rank in RANKS.items())


def test_documents(documents):
    texts = ["Hello  world", None, "", LONG, "x" * 5000, " " * 3000, "naïve\n\ncafé"]
    docs = documents(*enumerate(texts), (None, "a"), (0, texts[0]))
    found = bpe.digest(docs, PATH, public_tokenizers.PATTERN).collect()
    assert len(found) == len(texts) + 2
    for r in found:
        text = "a" if r.doc_id is None else texts[r.doc_id] or ""
        ids = THEIRS.encode_ordinary(text)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    for r in bpe.encoded(docs, PATH, public_tokenizers.PATTERN).collect():
        text = "a" if r.doc_id is None else texts[r.doc_id] or ""
        assert r.decoded == text and r.ids == THEIRS.encode_ordinary(text)


def test_empty_table(documents):
    assert bpe.digest(documents((1, "x")).filter("false"), PATH, public_tokenizers.PATTERN).count() == 0
