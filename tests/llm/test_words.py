import numpy as np
import pyarrow as pa
from hypothesis import given
from hypothesis import strategies as st

from tallywatch.llm import words as w
from tests.llm.conftest import WORD

TEXTS = st.lists(st.none() | st.text(st.sampled_from("ab é\n\t\x0b\x1c 日"), max_size=30), max_size=6)


def found(texts):
    data, offsets = w.text_buffer(pa.array(texts, pa.string()))
    starts, ends, first = w.word_bounds(data, offsets)
    spans = [data[a:b].tobytes().decode() for a, b in zip(starts, ends)]
    return [spans[a:b] for a, b in zip(first[:-1], first[1:])], w.span_hashes(data, starts, ends), first


@given(TEXTS)
def test_words_are_those_of_the_pattern(texts):
    assert found(texts)[0] == [WORD.findall(t or "") for t in texts]


@given(TEXTS, st.integers(1, 4))
def test_windows_are_equal_where_words_are(texts, n):
    spans, hashes, first = found(texts)
    at = np.flatnonzero(w.whole_windows(first, n))
    want = [tuple(row[i: i + n]) for row in spans for i in range(len(row) - n + 1)]
    keys = w.window_hashes(hashes, n)[at].tolist()
    assert len(keys) == len(want)
    assert len(set(keys)) == len(set(want)) == len(set(zip(keys, want)))


def test_hashes_do_not_depend_on_place_or_block():
    long = "x" * (w.LONG_WORD + 5)
    text = f"alpha {'pad ' * 200_000}alpha {long} beta {long}"
    spans, hashes, _ = found([text, "alpha", long])
    flat = [s for row in spans for s in row]
    assert len({(s, h) for s, h in zip(flat, hashes.tolist())}) == len(set(flat)) == 4


def test_folding_joins_ascii_case():
    data, offsets = w.text_buffer(pa.array(["Word wORD wird"]))
    starts, ends, _ = w.word_bounds(data, offsets)
    a, b, c = w.span_hashes(data, starts, ends, fold=True)
    assert a == b != c


def test_slices_hold_whole_rows_and_all_of_them():
    batch = pa.record_batch([pa.array(["a" * 10, None, "b" * 50, "", "c"])], names=["text"])
    parts = list(w.slices(batch, "text", 12))
    assert [p["text"].to_pylist() for p in parts] == [["a" * 10, None], ["b" * 50], ["", "c"]]
    assert list(w.slices(batch.slice(0, 0), "text", 12)) == []
