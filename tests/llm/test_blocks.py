import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from obsvar.llm import textblocks as tb

TEXTS = st.lists(st.one_of(st.none(), st.text(max_size=40)), max_size=12)


@settings(deadline=None, max_examples=60)
@given(TEXTS, st.integers(1, 30))
def test_words_and_hashes_do_not_depend_on_blocks(texts, limit):
    array = pa.array(texts, pa.string())
    found, hashes = [], {}
    for block in tb.blocks(array, limit):
        block.words(tb.SPACE)
        for start, end, row, key in zip(block.start, block.end, block.row, block.hashes(block.start, block.end), strict=True):
            word = block.data[start:end].tobytes()
            found.append((block.first + row, word))
            assert hashes.setdefault(word, key) == key
    assert found == [(k, w) for k, t in enumerate(texts) for w in (t or "").encode().split()]
    assert len(set(hashes.values())) == len(hashes)


def test_rolling_grams():
    word = np.arange(1, 30, dtype=np.uint64)
    same = np.concatenate((word, word))
    rolled = tb.grams(same, 4)
    assert (rolled[:26] == rolled[29:55]).all() and len(set(rolled[:26].tolist())) == 26
