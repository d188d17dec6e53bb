"""Word hashes against plain splitting."""

import random

import numpy as np

from schemagate.llm import common
from schemagate.llm.common import hashed_words

ODD = [None, b"", b" ", b"a", b" a\tb\x0bc\x0cd\re\n", b"a\0 a \0a a\0\0", b"12345678 123456789 1234567812345678 12345678 9",
       b"x" * 64, b"x" * 65 + b" " + b"x" * 300, b"A a", "ß     é".encode(), None, b"end"]


def test_words_have_equal_hashes_if_they_are_equal(monkeypatch):
    rng = random.Random(1)
    texts = ODD + [bytes(rng.choices(b"ab \n\0", k=rng.randrange(40))) for _ in range(2000)]
    hashes, ends = hashed_words(texts)
    monkeypatch.setattr(common, "RUN_BYTES", 50)
    in_runs, ends_in_runs = hashed_words(texts)
    assert (hashes == in_runs).all() and (ends == ends_in_runs).all()
    words = [(text or b"").split() for text in texts]
    assert ends.tolist() == np.cumsum([len(w) for w in words]).tolist()
    flat = [w for some in words for w in some]
    assert len(set(zip(flat, hashes.tolist(), strict=True))) == len(set(flat)) == len(set(hashes.tolist()))


def test_a_word_has_one_hash_wherever_it_stands():
    for word in {w for text in ODD if text for w in text.split()}:
        alone = hashed_words([word])[0].tolist()
        assert hashed_words([b"x " + word, word + b"\ny"])[0][[1, 2]].tolist() == alone * 2
    assert hashed_words([b"A a"], lower=True)[0].tolist() == hashed_words([b"a a"])[0].tolist()
    assert [len(x) for x in hashed_words([])] == [0, 0]


def test_no_word_is_hashed_by_itself_but_long_ones(monkeypatch):
    called = []
    monkeypatch.setattr(common.xxhash, "xxh3_64_intdigest", lambda word: called.append(word) or 1)
    hashed_words([b"%d" % n for n in range(1000)] + [b"y" * 65])
    assert called == [b"y" * 65]
