from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st

from tallywatch.llm import pieces as module
from tallywatch.llm.pieces import SPACE, decode, encode, pieces
from tallywatch.llm.queries import QUERIES

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = st.text(st.sampled_from("the and  \n\t.,é日▁0aZ"), max_size=14) | st.text(max_size=12)


def best_score(text):
    """The greatest score of any segmentation, by trying all."""
    coder = pieces(PATH)
    whole = SPACE + text.replace(" ", SPACE) if text else ""

    @lru_cache(maxsize=None)
    def best(at):
        if at == len(whole):
            return 0.0
        scores = []
        for end in range(at + 1, len(whole) + 1):
            found = coder.scores.get(whole[at:end])
            if found or end == at + 1:
                scores.append((found[0] if found else coder.unknown) + best(end))
        return max(scores)

    return best(0)


def score(ids, text):
    coder = pieces(PATH)
    whole = SPACE + text.replace(" ", SPACE) if text else ""
    total, at, raw = 0.0, 0, {i: b for b, i in coder.bytes_of.items()}
    ids = list(ids)
    while ids:
        if ids[0] in raw:
            n = len(whole[at].encode())
            assert bytes(raw[i] for i in ids[:n]) == whole[at].encode()
            total, at, ids = total + coder.unknown, at + 1, ids[n:]
        else:
            piece = coder.texts[ids.pop(0)]
            assert whole.startswith(piece, at)
            total, at = total + coder.scores[piece][0], at + len(piece)
    assert at == len(whole)
    return total


@given(TEXTS)
def test_stream_finds_the_best_score(text):
    assert score(pieces(PATH).encode_text(text), text) == pytest.approx(best_score(text))


@given(st.lists(st.none() | TEXTS, max_size=6))
def test_many_at_once_equal_the_stream(texts):
    ids, counts = pieces(PATH).encode_slice(pa.array(texts, pa.string()))
    rows = np.split(ids, np.cumsum(counts)[:-1]) if texts else []
    assert [r.tolist() for r in rows] == [pieces(PATH).encode_text(t or "") for t in texts]


def test_stream_commits_early_and_keeps_a_bounded_window():
    coder = pieces(PATH)
    whole = SPACE + SPACE.join(["inter", "national", "isation"] * 300)
    parts = list(coder.streaming_viterbi(whole))
    assert len(parts) > 600
    longest = max(sum(len(coder.texts[i]) for i in p) for p in parts)
    assert longest <= 3 * coder.longest


def test_long_stretches_equal_short_ones():
    text = "a" * 500 + " " + "0123456789" * 30 + "é" * 70
    ids, counts = pieces(PATH).encode_slice(pa.array([text]))
    assert ids.tolist() == pieces(PATH).encode_text(text) and counts.tolist() == [len(ids)]


def test_round_trip_of_the_whole_table(spark, sf_dir, documents):
    got = {r.doc_id: r for r in QUERIES["op5_pieces"](spark, sf_dir).collect()}
    assert all(r.round_trip for r in got.values()) and len(got) == len(documents)
    for row in documents[:12]:
        text = (row["text"] or "")[:600]
        ids = pieces(PATH).encode_text(text)
        assert score(ids, text) == pytest.approx(best_score(text))
        if len(row["text"] or "") <= 600:
            assert got[row["doc_id"]].ids == ids


def test_odd_rows(frame, odd_pairs):
    data = frame(odd_pairs)
    coded = encode(data, PATH)
    assert sorted(coded.columns) == sorted(data.columns)  # the extra column `ids` is replaced
    again = decode(coded, PATH, into="key").collect()
    assert sorted((repr(r.doc_id), r.key) for r in again) == sorted((repr(i), t or "") for i, t in odd_pairs)
    assert encode(frame([]), PATH).count() == 0


def test_decoding_any_ids_does_not_fail(spark):
    coder = pieces(PATH)
    rows = [(1, [coder.bytes_of[0xC3]]), (2, []), (3, None), (4, [0, 1, 2]), (5, coder.encode_text("▁ x"))]
    got = {r.n: r.text for r in decode(spark.createDataFrame(rows, "n int, ids array<int>"), PATH).collect()}
    assert got == {1: "�", 2: "", 3: "", 4: "", 5: "  x"}


def test_many_streams_commit_early_and_keep_a_bounded_window(monkeypatch):
    coder, pending, commits = pieces(PATH), [], []
    real_add, real_commit = module.Window.add, module.Window.commit
    monkeypatch.setattr(module.Window, "add", lambda w, *a: (real_add(w, *a), pending.append(len(w.back)))[0])
    monkeypatch.setattr(module.Window, "commit", lambda w, *a: (real_commit(w, *a), commits.append(int(w.done.min())))[0])
    word = SPACE + SPACE.join(["inter", "national", "isation"] * 40)
    ids, counts = coder._search([word, word[::-1], "x" * len(word), "é日" * (len(word) // 2) + "é" * (len(word) % 2)], len(word))
    want = [[i for some in coder.streaming_viterbi(s) for i in some]
            for s in (word, word[::-1], "x" * len(word), "é日" * (len(word) // 2) + "é" * (len(word) % 2))]
    assert [r.tolist() for r in np.split(ids, np.cumsum(counts)[:-1])] == want
    # Boundaries are committed all along, and what is kept follows the longest piece, not the stretch.
    assert len(commits) >= len(word) // coder.longest and commits[len(commits) // 2] > len(word) // 3
    assert max(pending) <= 4 * coder.longest < len(word) // 2


@given(st.lists(st.text(st.sampled_from("theandisg0é▁"), min_size=1, max_size=70), min_size=1, max_size=5))
def test_stretches_of_any_length_side_by_side(stretches):
    coder = pieces(PATH)
    ids, counts = coder.side_by_side(stretches)
    want = [[i for some in coder.streaming_viterbi(s) for i in some] for s in stretches]
    assert [r.tolist() for r in np.split(ids, np.cumsum(counts)[:-1])] == want
