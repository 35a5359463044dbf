"""The encoder against the public tokenizer, and its transducer by itself."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_frames import docs  # noqa: F401
from ledgerloom.llm import automaton
from ledgerloom.llm.bpe import Codec, Vocabulary, decoded, compiled, encoded

tokenizers = pytest.importorskip("public_tokenizers")
PATH = tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def codec():
    vocabulary = Vocabulary.read(PATH)
    words = sorted({b" the", b"the", b"tion", b" and", b" nation", "é".encode(), b"'s", b"."})
    sizes = np.array([len(w) for w in words])
    ends = np.cumsum(sizes)
    ids, counts = vocabulary.merged(np.frombuffer(b"".join(words), np.uint8), ends - sizes, ends)
    arrays = vocabulary.arrays | automaton.build(words)
    arrays |= {"lexicon_ids": ids, "lexicon_start": np.cumsum(counts) - counts, "lexicon_size": counts}
    own = Codec("", {}, vocabulary.specials)
    own.vocabulary = Vocabulary(arrays, vocabulary.specials)
    return own


@pytest.fixture(scope="module")
def theirs():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


PIECES = ["'s", "'re", "'ll", " '", "<|endoftext|>", "the", "tion", " ", "\n", "\t", "1", "é", "ß", "中", "😀", "a", "s", "t", "'", ".", "!?"]


@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=25).map("".join), min_size=1, max_size=20))
@settings(deadline=None, max_examples=80)
def test_ids_and_texts(codec, theirs, texts):
    check(codec, theirs, texts)


@given(st.lists(st.text(max_size=40), min_size=1, max_size=10))
@settings(deadline=None, max_examples=80)
def test_any_text(codec, theirs, texts):
    check(codec, theirs, texts)


def check(codec, theirs, texts):
    ids, counts = codec.encode([t.encode() for t in texts])
    back, at = codec.decode(ids, counts), 0
    for text, n, again in zip(texts, counts, back, strict=True):
        want = theirs.encode(text, add_special_tokens=False).ids
        assert ids[at: at + n].tolist() == want
        assert again == theirs.decode(want, skip_special_tokens=False) == text
        at += n


def test_long_words(codec, theirs):
    check(codec, theirs, ["x" * 3000, "ab" * 700 + " y", "thequick" * 400])


def test_transducer():
    rng = random.Random(0)
    words = sorted({bytes(rng.choices(b"abc", k=rng.randint(1, 7))) for _ in range(500)})
    table = automaton.build(words)
    assert len(table["base"]) < sum(map(len, words)) / 2
    asked = words + [b"", b"zzz", b"abcabcabcabc", words[0] + b"q"]
    ends = np.cumsum([len(w) for w in asked])
    starts = ends - [len(w) for w in asked]
    got = automaton.look_up(table, np.frombuffer(b"".join(asked), np.uint8), starts, ends)
    known = {w: i for i, w in enumerate(words)}
    assert got.tolist() == [known.get(w, -1) for w in asked]


def test_round_trip_on_spark(docs):
    given = docs([(1, "the nation's 12 days"), (2, None), (3, "é<|endoftext|> ok")])
    own = compiled(given, PATH)
    ids = encoded(given, PATH)
    texts = {r.doc_id: r.text for r in decoded(ids, own).collect()}
    assert texts == {1: "the nation's 12 days", 2: "", 3: "é<|endoftext|> ok"}
