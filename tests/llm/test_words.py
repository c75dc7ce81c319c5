import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortlift.llm import words as W

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
TEXT = st.text(alphabet=st.sampled_from("aAbZ é漢\t\n\x0b .-"), max_size=40)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=8), st.sampled_from([3, 7, 1 << 18]))
def test_words_equal_the_pattern(texts, chunk):
    held, W.CHUNK = W.CHUNK, chunk
    try:
        hashes, at, (prefix,) = W.find_words(*W.text_buffer(pa.array(texts, pa.string())), prefixes=(2,))
    finally:
        W.CHUNK = held
    want = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW)) for t in texts]
    assert np.diff(at).tolist() == [len(w) for w in want]
    flat = [w for ws in want for w in ws]
    names = {}
    for word, h, p in zip(flat, hashes.tolist(), prefix.tolist()):
        assert names.setdefault(word, h) == h
        raw = word.encode()
        assert (p != 0) == (len(raw) > 2)
        if p:
            assert names.setdefault(("prefix", raw[:2]), p) == p
    assert len(set(names.values())) == len(names)


def test_slices_of_a_column_and_large_strings():
    column = pa.array(["one two", None, "three", "", "four five six"])
    whole, _, _ = W.find_words(*W.text_buffer(column))
    part, at, _ = W.find_words(*W.text_buffer(column.slice(2)))
    assert at.tolist() == [0, 1, 1, 4] and part.tolist() == whole[2:].tolist()
    large, _, _ = W.find_words(*W.text_buffer(column.cast(pa.large_string())))
    assert large.tolist() == whole.tolist()


def test_grams():
    words = np.arange(1, 6, dtype=np.uint64)
    assert len(W.grams(words, 3)) == 3 and len(W.grams(words[:2], 3)) == 1 and len(W.grams(words[:0], 3)) == 0
    found, whole = W.all_grams(words, np.array([0, 2, 5]), 2)
    assert whole.tolist() == [True, False, True, True]
    assert found[2] == W.grams(words[2:], 2)[0]
