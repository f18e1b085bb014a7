import re

import numpy as np
import pyarrow as pa
from hypothesis import given
from hypothesis import strategies as st

from recensio.llm import arrays as A

texts = st.lists(st.one_of(st.none(), st.text(alphabet=st.sampled_from("aB9é \t\n\x0b,-😀ß"), max_size=30)), max_size=6)


@given(texts)
def test_words_follow_the_patterns(values):
    column = pa.array(values, pa.string())
    for table, pattern, lower in ((A.SPACES, r"[^\x20\x09-\x0D]+", False), (A.MARKS, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", True)):
        data, offsets = A.text_bytes(column)
        data = A.LOWER[data] if lower else data
        begins, ends, text = A.words(data, offsets, table)
        got = [(int(t), data[b:e].tobytes().decode()) for b, e, t in zip(begins, ends, text, strict=True)]
        low = lambda s: re.sub("[A-Z]", lambda m: m[0].lower(), s) if lower else s  # noqa: E731, B023
        assert got == [(i, w) for i, s in enumerate(values) for w in re.findall(pattern, low(s or ""))]
        hashes = A.span_hashes(data, begins, ends)
        assert len(set(hashes.tolist())) == len({w for _, w in got})


@given(st.lists(st.integers(0, 2**62)))
def test_packing_is_a_round_trip(values):
    x = np.array(values, np.int64)
    assert A.unpack(A.pack(x)).tolist() == values
    assert A.unpack_low(A.pack_low(x.astype(np.uint64), 8), 8).tolist() == values
    assert A.unpack_bits(A.pack_bits(x > 5), len(x)).tolist() == (x > 5).tolist()


def test_shingles_of_short_and_long_texts():
    h, t = A.word_hashes(pa.array(["a b c d e f", "a b", None, "a b", "b c d e f"]), A.MARKS, lower=True)
    values, owner = A.shingles(h, t, 5, 5)
    assert owner.tolist() == [0, 0, 1, 3, 4]
    assert values[2] == values[3] and values[1] == values[4] and values[0] != values[1]


def test_long_word_crosses_segments():
    long = "x" * (3 << 20)
    h, _ = A.word_hashes(pa.array([f"a {long} b", f"{long} b"]))
    assert h[1] == h[3] and h[2] == h[4]
