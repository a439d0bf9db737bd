import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallywatch.llm import token_files, tokens
from tallywatch.llm.queries import QUERIES
from tallywatch.llm.token_counts import count_tokens, resynchronised
from tallywatch.session import new_folder

PATH = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
ODD = st.lists(
    st.sampled_from([*"aB é́ñß日'.,<|>12 \n\t\xa0\x1c", "<|endoftext|>", "'S", "İ", "ΑΣ"]), max_size=40).map("".join)


def library(path, text):
    return tokens.tokenizer(path).encode(text or "", add_special_tokens=False).ids


@given(st.lists(st.none() | ODD | st.text(max_size=20), max_size=8))
def test_ids_by_parts_are_those_of_whole_texts(texts):
    ids, counts = tokens.part_table(PATH).encode_slice(pa.array(texts, pa.string()))
    rows = np.split(ids, np.cumsum(counts)[:-1]) if texts else []
    assert [r.tolist() for r in rows] == [library(PATH, t) for t in texts]


def test_a_full_table_still_encodes(monkeypatch):
    monkeypatch.setattr(tokens, "MAX_REMEMBERED", 2)
    table = tokens.PartTable(PATH)
    for texts in (["one two"], ["three four five"], ["two six three"], ["seven one"]):
        assert table.encode_slice(pa.array(texts))[0].tolist() == library(PATH, texts[0])
    assert len(table.keys) <= 5


@settings(max_examples=60)
@given(st.lists(ODD, max_size=40).map(" ".join), st.integers(20, 60), st.integers(1, 8), st.sampled_from([PATH, BYTES]))
def test_spliced_chunks_give_the_ids_of_the_whole(text, chunk, overlap, path):
    got = [i for ids in resynchronised(tokens.tokenizer(path), text, chunk, overlap) for i in ids]
    assert got == library(path, text)


@pytest.mark.parametrize("text", ["x" * 4000 + " y", "ab1" * 700, " " * 2000 + "z", "'s" * 500, "<|endoftext|>" * 200])
def test_overlaps_widen_where_nothing_aligns(text):
    for path in (PATH, BYTES):
        assert [i for ids in resynchronised(tokens.tokenizer(path), text, 64, 4) for i in ids] == library(path, text)


def test_counts_of_the_whole_table(spark, sf_dir, documents):
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in QUERIES["op8_token_counts"](spark, sf_dir).collect()}
    want = {}
    for row in documents:
        n = len(library(PATH, row["text"]))
        want[row["doc_id"]] = (len((row["text"] or "").encode()), n, n > 2048)
    assert got == want


@pytest.mark.parametrize("path", [PATH, BYTES])
def test_counts_of_odd_rows(frame, odd_pairs, path):
    got = count_tokens(frame(odd_pairs), path, chunk=1000, overlap=20).collect()
    want = [(i, len((t or "").encode()), len(library(path, t))) for i, t in odd_pairs]
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in got), key=repr) == sorted(want, key=repr)
    assert max(r.n_chunks for r in got) > 50
    assert count_tokens(frame([]), path).count() == 0


def files_of(texts):
    """(start, n_tokens, crc) of texts in order."""
    out, start = [], 0
    for text in texts:
        ids = [*library(PATH, text), 2]
        out.append((start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_files_of_the_whole_table(spark, sf_dir, documents):
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op9_token_files"](spark, sf_dir).collect()}
    rows = sorted(documents, key=lambda r: r["doc_id"])
    assert got == dict(zip((r["doc_id"] for r in rows), files_of(r["text"] for r in rows)))


def test_sequences_and_masks(spark, frame, odd_pairs):
    pairs = [(i, t) for i, t in odd_pairs if i in (1, 2, 6, 7, 8)]
    folder = new_folder(spark, "files")
    token_files.write_token_files(frame(pairs), PATH, folder, end_id=2, length=16)
    want = [i for _, t in sorted(pairs) for i in [*library(PATH, t), 2]]
    held = []
    for row in token_files.read_manifest(spark, folder).orderBy("part").collect():
        part = token_files.TokenPart(folder, row.name)
        assert row.start == len(held)
        sequences = [part.sequence(s) for s in range(row.n_sequences)]
        assert all(len(ids) == len(mask) == 16 for ids, mask in sequences)
        ids, mask = sequences[row.n_sequences // 2]
        with pytest.raises(ValueError):
            ids[0] = 1  # it is the file's own memory
        held += [i for ids, mask in sequences for i, m in zip(ids.tolist(), mask.tolist()) if m]
        part.close()
    assert held == want


def test_files_of_odd_rows(spark, frame, odd_pairs):
    folder, data = new_folder(spark, "files"), frame(odd_pairs)
    token_files.write_token_files(data, PATH, folder, end_id=2)
    got = token_files.read_documents(spark, folder, data.schema["doc_id"].dataType).collect()
    assert len(got) == len(odd_pairs)
    ordered = sorted(got, key=lambda r: r.start)
    assert [r.start for r in ordered] == np.cumsum([0] + [r.n_tokens for r in ordered])[:-1].tolist()
    assert [r.key for r in ordered] == [None, None, 1, 2, 3, 4, 4, 5, 5, 6, 7, 8]
    folder = new_folder(spark, "files")
    token_files.write_token_files(frame([]), PATH, folder, end_id=2)
    assert token_files.read_documents(spark, folder, data.schema["doc_id"].dataType).count() == 0


def test_other_tokenizers_are_refused(spark, frame):
    assert not tokens.drops_space(BYTES)
    with pytest.raises(ValueError, match="white space"):
        token_files.write_token_files(frame([]), BYTES, new_folder(spark, "files"), end_id=2)
