import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from changeloom.llm import tokens
from changeloom.llm.text import pieces, window_hashes
from tests.llm.brute import words

ANY = st.lists(st.one_of(st.none(), st.text("ab \n\té ", max_size=30)), max_size=12)


@settings(max_examples=60, deadline=None)
@given(ANY, st.integers(1, 40))
def test_words_windows_and_hashes(texts, most):
    seen = {}
    at = 0
    for part in pieces(pa.array(texts, pa.string()), most):
        assert part.rows.start == at
        for r in range(len(part)):
            own = words(texts[at + r])
            first, last = part.bounds[r], part.bounds[r + 1]
            assert [part.text(s, e) for s, e in zip(part.starts[first:last], part.ends[first:last])] == own
            for word, value in zip(own, part.words[first:last]):
                assert seen.setdefault(word, value) == value
        starts, ends, row = part.windows(3)
        hashes = window_hashes(part.words, starts, ends)
        for s, r, h in zip(starts, row, hashes):
            k = s - part.bounds[r]
            key = tuple(words(texts[at + r])[k : k + 3])
            assert seen.setdefault(key, h) == h
        at += len(part)
    assert at == len(texts)
    assert len(set(map(int, seen.values()))) == len(seen)


def test_slices_of_columns():
    column = pa.array(["a b", "c", None, "d e f"]).slice(1)
    assert [p.counts.tolist() for p in pieces(column)] == [[1, 0, 3]]
    assert not list(pieces(pa.array([], pa.string())))
    assert np.all([len(p.words) == 0 for p in pieces(pa.array(["", None]))])


def test_distinct_hashes_are_those_of_a_sort():
    for n, kinds in ((0, 1), (1, 1), (5000, 40), (5000, 1 << 62)):
        hashes = np.random.default_rng(n).integers(0, kinds, n).astype(np.uint64) * np.uint64(3)
        expected = np.unique(hashes, return_index=True, return_inverse=True)
        assert all(np.array_equal(a, b) for a, b in zip(tokens.distinct(hashes), expected, strict=True))


def test_known_parts_are_found_again_without_encoding():
    known, asked = tokens._Known(None), []
    known._encode = lambda parts: (asked.append(parts), np.arange(len(parts), dtype=np.uint32), np.arange(len(parts)), np.ones(len(parts), np.int64))[1:]
    first, second = np.array([3, 9, 20], np.uint64), np.array([1, 9, 20, 2**64 - 21], np.uint64)
    known.lookup(first, lambda k: b"%d" % first[k])
    where, sizes = known.lookup(second, lambda k: b"%d" % second[k])
    assert asked == [[b"3", b"9", b"20"], [b"1", b"18446744073709551595"]]
    assert where.tolist() == [3, 1, 2, 4] and sizes.tolist() == [1] * 4
