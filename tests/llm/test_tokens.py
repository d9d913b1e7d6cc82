import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from gavelcast.llm import tokens

from . import plain

TEXT = st.text(alphabet="aAbB é\n\t.€\x0b", max_size=60)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=8), st.integers(1, 40))
def test_words_of_any_batch(texts, size):
    hashes, first = tokens.word_hashes(pa.array(texts, pa.string()), size=size)
    own = [plain.words(t) for t in texts]
    assert np.diff(first).tolist() == [len(x) for x in own]
    code = {}
    for word, value in zip([w for x in own for w in x], hashes.tolist()):
        assert code.setdefault(word, value) == value
    assert len(set(code.values())) == len(code)


def test_shingles_of_short_texts_differ_from_long_ones():
    texts = pa.array(["a b c d", "a b c", "", None, "a b c d e"])
    hashes, first = tokens.word_hashes(texts)
    found = [x.tolist() for x in tokens.shingles(hashes, first, 4)]
    assert [len(x) for x in found] == [1, 1, 0, 0, 2] and found[0][0] == found[4][0] != found[1][0]


def test_slices_of_arrays():
    texts = pa.array(["x y", "a b", "c"]).slice(1)
    hashes, first = tokens.word_hashes(texts)
    whole, _ = tokens.word_hashes(pa.array(["a b", "c"]))
    assert first.tolist() == [0, 2, 3] and hashes.tolist() == whole.tolist()


def test_slices_are_bounded_in_rows_and_bytes():
    texts = ["a b"] * 1200 + [None, "", "long " * 1_000_000, "x " * 1_500_000, None] + ["y" * 3_000_000] * 3
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["id", "text"])
    for given in (batch, batch.slice(700), batch.slice(0, 0), batch.slice(1200, 2)):
        parts = list(tokens.slices(given, 1))
        assert [i for part in parts for i in part.column(0).to_pylist()] == given.column(0).to_pylist()
        for part in parts:
            sizes = [len(x or "") for x in part.column(1).to_pylist()]
            assert 0 < len(sizes) <= 500 and (sum(sizes) <= 1 << 22 or len(sizes) == 1)
