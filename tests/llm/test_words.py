import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from sonoledger.llm._words import Hasher, slices, words_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=40), st.sampled_from(["", "Aa b9", "é ß日本 x", "ab", "cd"]))))
def test_words_match_the_pattern(texts):
    hasher, got = Hasher(), []
    hashes: dict = {}
    for _, data, offsets in slices(pa.array(texts, pa.string()), most=30):
        words = words_of(data, offsets, hasher)
        rows = [[] for _ in range(len(offsets) - 1)]
        for a, b, d, h in zip(words.start, words.end, words.doc, words.hash):
            word = words.low[a:b].tobytes()
            assert hashes.setdefault(word, h) == h
            rows[d].append(word.decode())
        got += rows
    assert got == [plain(t) for t in texts]
    assert len(set(hashes.values())) == len(hashes)


def test_long_words_and_slices():
    text = "x" * 700_000 + " y"
    data, offsets = np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)])
    words = words_of(data, offsets, Hasher())
    assert list(words.end - words.start) == [700_000, 1]
    alone = words_of(data[-1:], np.array([0, 1]), Hasher())
    assert alone.hash[0] == words.hash[1]
