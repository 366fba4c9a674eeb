import random

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from nestdoc.llm import _words as W

from .helpers import alnum, spaced

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aAbZ09 \t\n.,é中\U0001f600\x00", max_size=40)), max_size=8)


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_patterns(texts):
    for kind in (pa.string(), pa.large_string()):
        data, offsets = W.utf8(pa.array(texts, kind))
        for cls, plain in ((W.NON_SPACE, spaced), (W.ALNUM, alnum)):
            w = W.words(data, offsets, cls)
            got = [bytes(W.LOWER[data[s:e]]).decode() for s, e in zip(w.starts, w.ends)]
            want = [plain(t) for t in texts]
            assert got == [x for ws in want for x in ws]
            assert w.counts.tolist() == [len(ws) for ws in want]
            by_word = {}
            for g, h in zip(got, w.hashes.tolist()):
                assert by_word.setdefault(g, h) == h
            assert len(set(by_word.values())) == len(by_word)


def test_hashes_do_not_depend_on_place(monkeypatch):
    rng = random.Random(1)
    texts = [" ".join(f"x{rng.randrange(50)}" for _ in range(300)) for _ in range(5)]
    whole = W.words(*W.utf8(pa.array(texts)), W.NON_SPACE)
    monkeypatch.setattr(W, "_BLOCK", 64)
    small = W.words(*W.utf8(pa.array(texts)), W.NON_SPACE)
    assert np.array_equal(whole.hashes, small.hashes)
    grams, at = W.ngrams(whole, 3)
    words = [t for x in texts for t in x.split()]
    seen = {}
    for g, a in zip(grams.tolist(), at.tolist()):
        assert seen.setdefault(tuple(words[a : a + 3]), g) == g
    assert len(grams) == sum(300 - 2 for _ in texts) and len(set(seen.values())) == len(seen)


def test_chunks_cut_rows_only():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * 10, None, "b" * 100, "c", "d"]})
    parts = list(W.chunks(iter([batch]), "text", 12, most_rows=2))
    assert [x for p in parts for x in p.column(0).to_pylist()] == batch.column(0).to_pylist()
    assert all(p.num_rows <= 2 for p in parts)
