"""Encoding and decoding with the pieces and scores of a SentencePiece model by a streaming Viterbi search.

The best segmentation of a text is the one with the greatest sum of piece scores. `streaming_viterbi` reads it once: it
keeps the backpointers of the last positions, as many as the longest piece has characters, and commits ids as soon as all
surviving paths run through one boundary. Some boundaries are known to be such before the search: those no piece of
the model reaches over. Texts are cut there, and each distinct stretch is searched once per worker: stretches of up to
SIDE_BY_SIDE characters by a stream that takes many of them side by side, with the same window and the same commits, longer
ones one by one. Ties go to the path whose last piece begins first, at every position.

Characters without a piece are written as byte pieces, with the score the library's unigram model gives unknown ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywatch.llm.words import slices, span_hashes, text_buffer

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
SIDE_BY_SIDE = 48
MAX_REMEMBERED = 1 << 21

# In rows of committed ids: nothing. Numbers below say at which place a character has no piece.
NO_PIECE = -1

_models: dict[str, "Pieces"] = {}


def pieces(path: str) -> Pieces:
    """The pieces of a model file, read once per worker."""
    if path not in _models:
        _models[path] = Pieces(path)
    return _models[path]


class Pieces:
    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        probe = " a  b\né "
        if model.normalize(probe) != SPACE + probe.replace(" ", SPACE):
            raise ValueError(f"{path} normalises text, which this search doesn't do")
        ids = range(model.get_piece_size())
        self.texts = [model.id_to_piece(i) for i in ids]
        self.bytes_of = {int(self.texts[i][3:5], 16): i for i in ids if model.is_byte(i)}
        plain = [i for i in ids if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.scores = {self.texts[i]: (float(model.get_score(i)), i) for i in reversed(plain)}
        if len(self.bytes_of) != 256:
            raise ValueError(f"{path} has no byte pieces")
        self.longest = max(map(len, self.scores))
        self.unknown = min(s for s, _ in self.scores.values()) - UNKNOWN_PENALTY
        self._index()
        self._closed()
        # Bytes of every piece, as decoding writes them.
        raw = [bytes([int(t[3:5], 16)]) if model.is_byte(i) else b"" if model.is_control(i) or model.is_unknown(i)
               else t.replace(SPACE, " ").encode() for i, t in enumerate(self.texts)]
        self.raw_sizes = np.array([len(r) for r in raw], np.int64)
        self.raw_begins = np.cumsum(self.raw_sizes) - self.raw_sizes
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        # Stretches this worker has met: hash, number of ids, where they begin.
        self.keys = np.zeros(0, np.uint64)
        self.counts = np.zeros(0, np.int64)
        self.begins = np.zeros(0, np.int64)
        self.ids = np.zeros(1 << 16, np.int32)
        self.used = 0

    def _index(self) -> None:
        """Pieces by length, as sorted keys of their characters."""
        self.by_length = {}
        for n in range(1, self.longest + 1):
            found = [(t, s, i) for t, (s, i) in self.scores.items() if len(t) == n]
            if found:
                points = np.array([[ord(c) for c in t] for t, _, _ in found], np.uint64)
                keys = self._key(points)
                order = np.argsort(keys)
                self.by_length[n] = (
                    keys[order], np.array([s for _, s, _ in found])[order], np.array([i for _, _, i in found])[order],
                )
                if len(np.unique(keys)) < len(keys):
                    raise ValueError("two pieces share a key")

    @staticmethod
    def _key(points: np.ndarray) -> np.ndarray:
        keys = np.zeros(len(points), np.uint64)
        for k in range(points.shape[1]):
            keys = keys * np.uint64(0x9E3779B97F4A7C15) + points[:, k] * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(k)
            keys ^= keys >> np.uint64(29)
        return keys

    def _closed(self) -> None:
        """Pairs of ASCII characters that no piece holds side by side, with the space of pieces as a space."""
        inside = np.zeros((256, 256), dtype=bool)
        many = set()
        self.space_closed = True
        for text in self.scores:
            many.update(text if len(text) > 1 else "")
            ascii_ = [ord(c) if ord(c) < 128 else 32 if c == SPACE else 0 for c in text]
            for (x, a), (y, b) in zip(zip(text, ascii_), zip(text[1:], ascii_[1:])):
                if a and b:
                    inside[a, b] = True
                if y == SPACE and x != SPACE:
                    self.space_closed = False
        self.closed = ~inside
        self.closed[128:, :] = self.closed[:, 128:] = False
        for c in range(128):
            if c != 32 and chr(c) not in many:
                self.closed[c, :] = self.closed[:, c] = True  # also beside characters of several bytes
        if self.space_closed:
            self.closed[:, 32] = True
            self.closed[32, 32] = False

    # One text at a time.

    def streaming_viterbi(self, text: str) -> Iterator[list[int]]:
        """The ids of one normalised text in pieces, each committed when all surviving paths share its last boundary."""
        scores, longest = self.scores, self.longest
        best, back = {0: 0.0}, {}
        done = 0
        for end in range(1, len(text) + 1):
            top, chosen = None, None
            for start in range(max(done, end - longest), end):
                piece = text[start:end]
                found = scores.get(piece)
                if found is None:
                    if end - start > 1:
                        continue
                    found = (self.unknown, -1)
                score = best[start] + found[0]
                if top is None or score > top:
                    top, chosen = score, (start, found[1])
            best[end], back[end] = top, chosen
            # Paths that go on begin at one of the last `longest` positions. Where do they all come through?
            alive = set(range(max(done, end - longest + 1), end + 1))
            while len(alive) > 1:
                last = max(alive)
                alive.discard(last)
                alive.add(back[last][0])
            (joint,) = alive
            if joint > done:
                yield self._path(text, back, done, joint)
                for position in range(done, joint):
                    best.pop(position, None)
                    back.pop(position, None)
                done = joint
        if done < len(text):
            yield self._path(text, back, done, len(text))

    def _path(self, text: str, back: dict, begin: int, end: int) -> list[int]:
        found = []
        while end > begin:
            start, i = back[end]
            found.append([i] if i >= 0 else [self.bytes_of[b] for b in text[start:end].encode()])
            end = start
        return [i for piece in reversed(found) for i in piece]

    def encode_text(self, text: str) -> list[int]:
        """The ids of one text."""
        whole = SPACE + text.replace(" ", SPACE) if text else ""
        return [i for some in self.streaming_viterbi(whole) for i in some]

    # Many texts at a time.

    def side_by_side(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all stretches in a row and their number for each, by one search over all of equal length."""
        sizes = np.array([len(s) for s in stretches], np.int64)
        lengths = np.zeros(len(stretches), np.int64)
        parts, order = [], []
        for size in np.unique(sizes[sizes > 0]):
            at = np.flatnonzero(sizes == size)
            for some in (at[i: i + 32_768] for i in range(0, len(at), 32_768)):
                ids, counts = self._search([stretches[i] for i in some], int(size))
                lengths[some] = counts
                parts.append(ids)
                order.append(some)
        if not parts:
            return np.zeros(0, np.int32), lengths
        ids, order = np.concatenate(parts), np.concatenate(order)
        held = lengths[order]
        begins = np.zeros(len(stretches), np.int64)
        begins[order] = np.cumsum(held) - held
        total = np.cumsum(lengths) - lengths
        return ids[np.repeat(begins - total, lengths) + np.arange(len(ids))], lengths

    def _search(self, stretches: list[str], size: int) -> tuple[np.ndarray, np.ndarray]:
        """The same for stretches of `size` characters: the stream, position by position over all of them.

        Of the scores the last `longest` positions are kept, of the backpointers those behind the committed boundaries.
        Every `longest` positions, and at the end, each stretch commits the ids before the boundary at which all its
        surviving paths meet.
        """
        n, width = len(stretches), self.longest + 1
        points = np.frombuffer("".join(stretches).encode("utf-32-le"), np.uint32).reshape(n, size).astype(np.uint64)
        best = np.zeros((width, n))
        window = Window(n)
        for end in range(1, size + 1):
            top, back, piece = np.full(n, -np.inf), np.zeros(n, np.int64), np.zeros(n, np.int64)
            for start in range(max(0, end - self.longest), end):
                if end - start not in self.by_length:
                    continue
                keys, scores, ids = self.by_length[end - start]
                wanted = self._key(points[:, start:end])
                found = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
                hit, before = keys[found] == wanted, best[start % width]
                if end - start == 1:
                    score, id_ = before + np.where(hit, scores[found], self.unknown), np.where(hit, ids[found], -1)
                else:
                    score, id_ = np.where(hit, before + scores[found], -np.inf), ids[found]
                better = score > top
                top = np.where(better, score, top)
                back[better], piece[better] = start, id_[better]
            best[end % width] = top
            window.add(back, piece)
            if end == size:
                window.commit(end, end)
            elif end % self.longest == 0:
                window.commit(max(0, end - self.longest + 1), end)
        path = np.concatenate(window.committed, axis=1)
        counts = (path != NO_PIECE).sum(axis=1)
        odd = np.flatnonzero((path < NO_PIECE).any(axis=1))
        if not len(odd):
            return path[path != NO_PIECE].astype(np.int32), counts
        coded = [p[p != NO_PIECE] for p in path]
        for k in odd:
            # A character without a piece, by its place.
            ids = [[i] if i >= 0 else [self.bytes_of[b] for b in stretches[k][NO_PIECE - 1 - i].encode()] for i in coded[k].tolist()]
            coded[k] = np.array([i for some in ids for i in some])
            counts[k] = len(coded[k])
        return np.concatenate(coded).astype(np.int32), counts

    def cut(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all texts, each but the empty with a space before it, and the starts of their stretches."""
        filled = np.flatnonzero(np.diff(offsets))
        data = np.insert(data, offsets[filled], 32)
        rows = offsets[:-1][filled] + np.arange(len(filled))
        cuts = np.zeros(len(data), dtype=bool)
        if len(data):
            cuts[1:] = self.closed[data[:-1], data[1:]]
            marks = np.flatnonzero((data[:-2] == 0xE2) & (data[1:-1] == 0x96) & (data[2:] == 0x81))
            after = marks[marks + 3 < len(data)] + 3  # a space character of pieces in the text itself
            cuts[after[data[after] == 32]] = False
            cuts[rows] = True
        return data, np.flatnonzero(cuts)

    def encode_slice(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the number of ids of each text. NULL is an empty text."""
        data, offsets = text_buffer(texts)
        row_sizes = np.diff(offsets)
        data, starts = self.cut(data, offsets)
        row_ends = np.cumsum(row_sizes + (row_sizes > 0))
        ends = np.append(starts[1:], len(data)) if len(starts) else starts
        keys = span_hashes(data, starts, ends)
        distinct, where, again = np.unique(keys, return_index=True, return_inverse=True)
        found = np.searchsorted(self.keys, distinct)
        known = np.zeros(len(distinct), dtype=bool)
        inside = found < len(self.keys)
        known[inside] = self.keys[found[inside]] == distinct[inside]
        counts, begins = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.int64)
        counts[known], begins[known] = self.counts[found[known]], self.begins[found[known]]
        fresh, used = np.flatnonzero(~known), self.used
        if len(fresh):
            stretches = [data[starts[i]: ends[i]].tobytes().decode("utf-8", "replace").replace(" ", SPACE) for i in where[fresh]]
            short = [len(s) <= SIDE_BY_SIDE for s in stretches]
            ids, lengths = self.side_by_side([s if k else "" for s, k in zip(stretches, short)])
            if not all(short):
                coded = np.split(ids, np.cumsum(lengths)[:-1])
                for k in (k for k, is_short in enumerate(short) if not is_short):
                    coded[k] = np.array([i for some in self.streaming_viterbi(stretches[k]) for i in some], np.int32)
                    lengths[k] = len(coded[k])
                ids = np.concatenate(coded)
            self._store(ids)
            counts[fresh], begins[fresh] = lengths, used + np.cumsum(lengths) - lengths
            if len(self.keys) < MAX_REMEMBERED:
                at = found[fresh]
                self.keys = np.insert(self.keys, at, distinct[fresh])
                self.counts = np.insert(self.counts, at, counts[fresh])
                self.begins = np.insert(self.begins, at, begins[fresh])
                used = self.used
        counts, begins = counts[again], begins[again]
        total = np.zeros(len(counts) + 1, np.int64)
        np.cumsum(counts, out=total[1:])
        ids = self.ids[np.repeat(begins - total[:-1], counts) + np.arange(total[-1])]
        self.used = used
        bounds = np.concatenate([[0], np.searchsorted(starts, row_ends)])
        return ids, np.diff(total[bounds])

    def _store(self, ids: np.ndarray) -> None:
        need = self.used + len(ids)
        if need > len(self.ids):
            grown = np.zeros(max(need, len(self.ids) * 3 // 2), np.int32)
            grown[: self.used] = self.ids[: self.used]
            self.ids = grown
        self.ids[self.used: need] = ids
        self.used = need

    def decode_slice(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all texts in a row and the number of bytes of each, without the space that encoding put first."""
        sizes = self.raw_sizes[ids]
        total = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(sizes, out=total[1:])
        data = self.raw[np.repeat(self.raw_begins[ids] - total[:-1], sizes) + np.arange(total[-1])]
        bounds = np.zeros(len(counts) + 1, np.int64)
        np.cumsum(counts, out=bounds[1:])
        begins, ends = total[bounds[:-1]], total[bounds[1:]]
        filled = np.flatnonzero(ends > begins)
        filled = filled[data[begins[filled]] == 32]
        lengths = ends - begins
        lengths[filled] -= 1
        return np.delete(data, begins[filled]), lengths

    def gives_back(self, texts: pa.Array, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Whether decoding gives each text back."""
        data, offsets = text_buffer(texts)
        again, sizes = self.decode_slice(ids, counts)
        same = sizes == np.diff(offsets)
        ends = np.cumsum(sizes)
        if same.all() and np.array_equal(data, again):
            return same
        for i in np.flatnonzero(same):
            same[i] = np.array_equal(data[offsets[i]: offsets[i + 1]], again[ends[i] - sizes[i]: ends[i]])
        return same


class Window:
    """Backpointers of many searches that go side by side, from the first boundary that is not committed on."""

    def __init__(self, n: int):
        self.done = np.zeros(n, np.int64)
        self.first = 1  # the position of the first row of the backpointers
        self.back: list[np.ndarray] = []
        self.piece: list[np.ndarray] = []
        self.committed: list[np.ndarray] = []
        self.rows = np.arange(n)

    def add(self, back: np.ndarray, piece: np.ndarray) -> None:
        """Where the best path to the next position comes from, and by which piece."""
        self.back.append(back)
        self.piece.append(piece)

    def commit(self, begin: int, end: int) -> None:
        """Commit what the paths to all positions from `begin` to `end` have in common."""
        back, piece = np.stack(self.back), np.stack(self.piece)
        alive = np.maximum(np.arange(begin, end + 1)[:, None], self.done)
        while True:
            last = alive.max(axis=0)
            apart = last > alive.min(axis=0)
            if not apart.any():
                break
            # The path that is furthest goes back by one piece.
            before = np.where(apart, back[np.maximum(last - self.first, 0), self.rows], last)
            alive = np.where(alive == last, before, alive)
        joint, at, steps = alive[0], alive[0].copy(), []
        while True:
            going = at > self.done
            if not going.any():
                break
            where = np.maximum(at - self.first, 0)
            start, id_ = back[where, self.rows], piece[where, self.rows]
            steps.append(np.where(going, np.where(id_ < 0, NO_PIECE - 1 - start, id_), NO_PIECE))
            at = np.where(going, start, at)
        if steps:
            self.committed.append(np.stack(steps[::-1], axis=1))
        self.done = joint
        gone = max(0, int(joint.min()) + 1 - self.first)
        del self.back[:gone], self.piece[:gone]
        self.first += gone


def encode(
    docs: DataFrame, path: str, text: str = "text", into: str = "ids", round_trip: str | None = None
) -> DataFrame:
    """The rows of `docs` with the ids of their texts as column `into` (array of int), which replaces one of that name.

    NULL and empty texts have no ids. Other columns pass unchanged; no shuffle. The file is read on every executor. With
    `round_trip`, a column of that name says whether decoding the ids gives the text back, NULL being an empty one.
    """
    names, at = docs.columns, docs.columns.index(text)
    numbered = docs.toDF(*(f"c{i}" for i in range(len(names))))
    schema = T.StructType(numbered.schema.fields + [
        T.StructField("ids", T.ArrayType(T.IntegerType(), False)), T.StructField("same", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = pieces(path)
        for batch in batches:
            for part in slices(batch, f"c{at}"):
                ids, counts = coder.encode_slice(part.column(at))
                ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))
                same = coder.gives_back(part.column(at), ids, counts) if round_trip else np.ones(len(counts), dtype=bool)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, lists, pa.array(same)], names=[*part.schema.names, "ids", "same"])

    coded = numbered.mapInArrow(run, schema)
    kept = [F.col(f"c{i}").alias(n) for i, n in enumerate(names) if n not in (into, round_trip)]
    added = [F.col("ids").alias(into)] + ([F.col("same").alias(round_trip)] if round_trip else [])
    return coded.select(*kept, *added)


def decode(frame: DataFrame, path: str, ids: str = "ids", into: str = "text") -> DataFrame:
    """The rows of `frame` with the texts of their ids as column `into`, which replaces one of that name.

    No ids give an empty text. Bytes that are no UTF-8 are replaced, as decoding does. No shuffle.
    """
    names, at = frame.columns, frame.columns.index(ids)
    numbered = frame.toDF(*(f"c{i}" for i in range(len(names))))
    schema = T.StructType(numbered.schema.fields + [T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = pieces(path)
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                lists = part.column(at)
                counts = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
                data, sizes = coder.decode_slice(lists.flatten().to_numpy(zero_copy_only=False), counts)
                whole, ends = data.tobytes(), np.cumsum(sizes).tolist()
                texts = [whole[e - s: e].decode("utf-8", "replace") for e, s in zip(ends, sizes.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, "text"])

    read = numbered.mapInArrow(run, schema)
    kept = [F.col(f"c{i}").alias(n) for i, n in enumerate(names) if n != into]
    return read.select(*kept, F.col("text").alias(into))

