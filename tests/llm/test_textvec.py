import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from deidflow.llm import textvec as tv

TEXT = st.text(alphabet=st.sampled_from("ab \n\t\x0b\x1cé日A"), max_size=40)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=8), st.sampled_from([1, 7, 1 << 20]))
def test_words_and_hashes(texts, limit):
    got, seen = [], {}
    for i, j, raw, offsets in tv.blocks(pa.array(texts, pa.string()), limit):
        start, end, row = tv.words(raw, offsets)
        h = tv.hashes(raw, start, end)
        for s, e, r, x in zip(start, end, row, h):
            word = raw[s:e].tobytes()
            got.append((i + r, word))
            assert seen.setdefault(word, x) == x
    want = [(k, w) for k, t in enumerate(texts) for w in (t or "").encode().split()]
    assert got == want and len(set(seen.values())) == len(seen)


def test_windows_stay_in_their_row():
    at, h = tv.windows(np.arange(6, dtype=np.uint64), np.array([0, 0, 0, 1, 1, 1]), 2)
    assert at.tolist() == [0, 1, 3, 4] and len(set(h.tolist())) == 4
