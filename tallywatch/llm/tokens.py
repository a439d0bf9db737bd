"""Token ids of texts by the tokenizers library, each distinct word part encoded once per worker.

A tokenizer qualifies when white space ends every piece that its model sees and is then dropped, as SPACE_DROPPING
says. Then the ids of a text are those of its words in a row, and a cut between an ASCII letter and a following ASCII
sign or digit changes nothing either: the pattern ends its run of letters there, and no normalisation reaches over it.
Words that may hold a special token, which is matched before the pattern, are not cut. Hypothesis tests compare with
the library's result for whole texts.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa

from tallywatch.llm.words import LOWER, SPACE, mix, span_hashes, text_buffer, word_bounds

# The normaliser and the pattern of a tokenizer that drops white space and folds case.
SPACE_DROPPING = {
    "normalizers": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
    "pattern": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+",
}

LINE_PARTS = 256
MAX_REMEMBERED = 1 << 21

_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
_SIGN = np.zeros(256, dtype=bool)
_SIGN[:128] = ~_LETTER[:128] & ~SPACE[:128]

_loaded: dict[str, object] = {}
_tables: dict[str, "PartTable"] = {}


def tokenizer(path: str):
    """The tokenizer of a file, loaded once per worker, without truncation, padding or threads of its own."""
    if path not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        made = Tokenizer.from_file(path)
        made.no_truncation()
        made.no_padding()
        _loaded[path] = made
    return _loaded[path]


def drops_space(path: str) -> bool:
    """Whether the ids of a text are those of its words, by the settings stated in the file."""
    with open(path, encoding="utf-8") as file:
        said = json.load(file)
    normalizer, before = said.get("normalizer") or {}, said.get("pre_tokenizer") or {}
    steps = before.get("pretokenizers") or [{}]
    return (
        normalizer.get("normalizers") == SPACE_DROPPING["normalizers"]
        and steps[0].get("type") == "Split" and steps[0].get("invert") is True
        and steps[0].get("behavior") == "Removed"
        and steps[0].get("pattern") == {"Regex": SPACE_DROPPING["pattern"]}
        and [s.get("type") for s in steps[1:]] == ["ByteLevel"] and not steps[1].get("use_regex")
        and not steps[1].get("add_prefix_space") and not said.get("post_processor")
        and all(t["content"].startswith("<|") and not t["lstrip"] and not t["rstrip"] and not t["single_word"]
                and not t["normalized"] and not any(c.isspace() for c in t["content"])
                for t in said.get("added_tokens", []))
    )


def part_table(path: str) -> PartTable:
    if path not in _tables:
        _tables[path] = PartTable(path)
    return _tables[path]


class PartTable:
    """Ids of word parts that this worker has met, found by hash.

    It holds at most MAX_REMEMBERED parts; once full, new parts are encoded for their slice and forgotten.
    """

    def __init__(self, path: str):
        self.tokenizer = tokenizer(path)
        self.keys = np.zeros(0, np.uint64)
        self.counts = np.zeros(0, np.int64)
        self.begins = np.zeros(0, np.int64)
        self.ids = np.zeros(1 << 16, np.int32)
        self.used = 0

    def encode_slice(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the number of ids of each text."""
        data, offsets = text_buffer(texts)
        counts, begins, first, used = self._parts(data, offsets)
        total = np.zeros(len(counts) + 1, np.int64)
        np.cumsum(counts, out=total[1:])
        at = np.repeat(begins - total[:-1], counts) + np.arange(total[-1])
        ids = self.ids[at]
        self.used = used if len(self.keys) >= MAX_REMEMBERED else self.used
        return ids, np.diff(total[first])

    def count_slice(self, texts: pa.Array) -> np.ndarray:
        """The number of ids of each text."""
        data, offsets = text_buffer(texts)
        counts, _, first, used = self._parts(data, offsets)
        self.used = used if len(self.keys) >= MAX_REMEMBERED else self.used
        total = np.zeros(len(counts) + 1, np.int64)
        np.cumsum(counts, out=total[1:])
        return np.diff(total[first])

    def _parts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """Of every part: number of ids and where they begin; parts before each row; ids in use before the slice."""
        starts, ends, whole = cut(data, offsets)
        keys = span_hashes(data, starts, ends, fold=True)
        if whole.any():
            keys[whole] = mix(span_hashes(data, starts[whole], ends[whole]), 1)
        distinct, where, back = np.unique(keys, return_index=True, return_inverse=True)
        found = np.searchsorted(self.keys, distinct)
        known = np.zeros(len(distinct), dtype=bool)
        inside = found < len(self.keys)
        known[inside] = self.keys[found[inside]] == distinct[inside]
        counts, begins = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.int64)
        counts[known], begins[known] = self.counts[found[known]], self.begins[found[known]]
        used = self.used
        fresh = np.flatnonzero(~known)
        if len(fresh):
            parts = [data[starts[i]: ends[i]].tobytes().decode("utf-8", "replace") for i in where[fresh]]
            ids, lengths = self._encode(parts)
            self._store(ids)
            counts[fresh] = lengths
            begins[fresh] = used + np.cumsum(lengths) - lengths
            if len(self.keys) < MAX_REMEMBERED:
                at = found[fresh]
                self.keys = np.insert(self.keys, at, distinct[fresh])
                self.counts = np.insert(self.counts, at, counts[fresh])
                self.begins = np.insert(self.begins, at, begins[fresh])
                used = self.used
        return counts[back], begins[back], np.searchsorted(starts, offsets), used

    def _encode(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all parts in a row and their number for each: many parts in a line, told apart by offsets."""
        all_ids, all_lengths = [], []
        for at in range(0, len(parts), LINE_PARTS * 64):
            some = parts[at: at + LINE_PARTS * 64]
            lines = [some[i: i + LINE_PARTS] for i in range(0, len(some), LINE_PARTS)]
            for line, encoded in zip(lines, self.tokenizer.encode_batch(
                [" ".join(line) for line in lines], add_special_tokens=False,
            )):
                sizes = np.fromiter(map(len, line), np.int64, len(line))
                begins = np.cumsum(sizes + 1) - sizes - 1
                places = np.fromiter((o[0] for o in encoded.offsets), np.int64, len(encoded))
                of = np.searchsorted(begins, places, side="right") - 1
                all_ids.append(np.array(encoded.ids, np.int32))
                all_lengths.append(np.bincount(of, minlength=len(line)))
        return np.concatenate(all_ids), np.concatenate(all_lengths)

    def _store(self, ids: np.ndarray) -> None:
        need = self.used + len(ids)
        if need > len(self.ids):
            grown = np.zeros(max(need, len(self.ids) * 3 // 2), np.int32)
            grown[: self.used] = self.ids[: self.used]
            self.ids = grown
        self.ids[self.used: need] = ids
        self.used = need


def cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every part of every word, and whether the part is a word left whole for a special token."""
    starts, ends, _ = word_bounds(data, offsets)
    if not len(starts):
        return starts, ends, np.zeros(0, dtype=bool)
    word_starts = starts
    turns = np.flatnonzero(_LETTER[data[:-1]] & _SIGN[data[1:]]) + 1
    turns = turns[~np.isin(turns, word_starts, assume_unique=True)]
    marks = np.flatnonzero((data[:-1] == 60) & (data[1:] == 124))
    special = np.zeros(len(word_starts), dtype=bool)
    if len(marks):
        special[np.searchsorted(word_starts, marks, side="right") - 1] = True
        turns = turns[~special[np.searchsorted(word_starts, turns, side="right") - 1]]
    starts = np.sort(np.concatenate([word_starts, turns]))
    ends = np.sort(np.concatenate([ends, turns]))
    whole = special[np.searchsorted(word_starts, starts, side="right") - 1] if len(marks) else np.zeros(len(starts), bool)
    return starts, ends, whole


__all__ = ["LOWER", "PartTable", "cut", "drops_space", "part_table", "tokenizer"]
