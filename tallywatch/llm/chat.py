"""Conversations brought into legal order of turns at least cost, and rendered.

A legal conversation is an optional system turn, then user and assistant in turn, the last one by the assistant. The
automaton of that has four states: nothing yet, after system, after user, after assistant. Each given turn is either
emitted, under its own role or another one, with empty turns inserted before it where the automaton asks for them, or
merged into the turn before. Every choice has a cost, and dynamic programming over the states finds the cheapest path.

A step of the program is a 4 x 4 matrix of costs that only depends on the turn's role, and steps combine like products
of matrices. So a conversation of any length is cut into segments of at most SEGMENT turns: each gives one matrix, the
matrices of a conversation give the states at the segments' borders, and the segments are then repaired apart.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tallywatch.llm.links import stored

ROLES = ("system", "user", "assistant")
# Other names of the roles.
ALIASES = {
    "human": "user", "prompter": "user", "question": "user",
    "bot": "assistant", "ai": "assistant", "gpt": "assistant", "model": "assistant", "answer": "assistant",
    "instruction": "system", "developer": "system",
}
UNKNOWN = 3

# Costs. Giving a turn without a known role any role is cheap.
MERGE, INSERT, RELABEL, NAME = 1, 2, 4, 1

START, SYSTEM, USER, ASSISTANT = range(4)
LEGAL = {(START, 0): SYSTEM, (START, 1): USER, (SYSTEM, 1): USER, (USER, 2): ASSISTANT, (ASSISTANT, 1): USER}
NEVER = 1 << 40

SEGMENT = 4096
SEGMENT_CHARS = 4 << 20

OPEN, CLOSE = "<|{role}|>\n", "<|end|>\n"


def _insertions() -> dict[tuple[int, int], tuple[int, ...]]:
    """The shortest run of empty turns between every two states."""
    found = {(s, s): () for s in range(4)}
    for length in (1, 2):
        for start in range(4):
            for roles in itertools.product(range(3), repeat=length):
                state: int | None = start
                for role in roles:
                    state = LEGAL.get((state, role)) if state is not None else None
                if state is not None:
                    found.setdefault((start, state), roles)
    return found


INSERTIONS = _insertions()


def _relabel(given: int, role: int) -> int:
    return NAME if given == UNKNOWN else RELABEL * (given != role)


def _choices() -> tuple[np.ndarray, dict[tuple[int, int, int], tuple[tuple[int, ...], int]]]:
    """Cost of each given role from state to state, and the choice: empty turns before it, and its role (-1: merged)."""
    cost, choice = np.full((4, 4, 4), NEVER, np.int64), {}
    for given in range(4):
        for state in range(4):
            options = []
            if state != START:
                options.append((MERGE + _relabel(given, state - 1), state, ((), -1)))
            for (begin, middle), inserted in INSERTIONS.items():
                for role in range(3):
                    if begin == state and (middle, role) in LEGAL:
                        price = INSERT * len(inserted) + _relabel(given, role)
                        options.append((price, LEGAL[middle, role], (inserted, role)))
            for price, after, what in options:
                if price < cost[given, state, after]:
                    cost[given, state, after], choice[given, state, after] = price, what
    return cost, choice


COST, CHOICE = _choices()
CLOSING = np.array([INSERT * len(INSERTIONS[s, ASSISTANT]) if (s, ASSISTANT) in INSERTIONS else NEVER for s in range(4)])


def role_code(role: str | None) -> int:
    name = (role or "").strip().lower()
    name = ALIASES.get(name, name)
    return ROLES.index(name) if name in ROLES else UNKNOWN


@lru_cache(maxsize=4096)
def segment_matrix(codes: tuple[int, ...]) -> np.ndarray:
    """Least cost of a run of turns from every state to every state."""
    total = np.where(np.eye(4, dtype=bool), 0, NEVER)
    for code in codes:
        total = np.minimum((total[:, :, None] + COST[code][None]).min(axis=1), NEVER)
    return total


def border_states(matrices: list[np.ndarray]) -> tuple[list[int], int]:
    """The states before, between and after the segments of a conversation on its cheapest path, and the cost."""
    costs, back = np.array([0, NEVER, NEVER, NEVER]), []
    for matrix in matrices:
        through = costs[:, None] + matrix
        back.append(through.argmin(axis=0))
        costs = np.minimum(through.min(axis=0), NEVER)
    state = int((costs + CLOSING).argmin())
    cost, states = int((costs + CLOSING)[state]), [state]
    for pointers in reversed(back):
        states.append(int(pointers[states[-1]]))
    return states[::-1], cost


@lru_cache(maxsize=4096)
def segment_path(codes: tuple[int, ...], entry: int, leave: int) -> list[tuple[tuple[int, ...], int]]:
    """The choice for every turn of a segment on the cheapest path between two states."""
    costs, back = np.where(np.arange(4) == entry, 0, NEVER), []
    for code in codes:
        through = costs[:, None] + COST[code]
        back.append(through.argmin(axis=0))
        costs = np.minimum(through.min(axis=0), NEVER)
    path, state = [], leave
    for code, pointers in zip(reversed(codes), reversed(back)):
        before = int(pointers[state])
        path.append(CHOICE[code, before, state])
        state = before
    return path[::-1]


PIECES = (
    ("piece", T.LongType()), ("turn_step", T.LongType()), ("given_turn", T.LongType()), ("role", T.StringType()),
    ("action", T.StringType()), ("rendered", T.StringType()),
)


def _pieces(rows: dict[str, list], entry: int, leave: int, last: bool) -> list[tuple]:
    """Pieces of the repaired turns of a segment; turn_step counts the turns begun in it."""
    out: list[tuple] = []
    step, role, first = 0, ROLES[entry - 1] if entry != START else None, entry == START

    def begin(code: int, action: str, given, text: str) -> None:
        nonlocal step, role, first
        step, role = step + 1, ROLES[code]
        out.append((len(out), step, given, role, action, ("" if first else CLOSE) + OPEN.format(role=role) + text))
        first = False

    path = segment_path(tuple(rows["code"]), entry, leave)
    for code, given, text, (inserted, chosen) in zip(rows["code"], rows["turn"], rows["text"], path):
        text = (text or "").replace("<|", "< |")
        for role_inserted in inserted:
            begin(role_inserted, "insert", None, "")
        if chosen < 0:
            out.append((len(out), step, given, role, "merge", "\n" + text))
        else:
            begin(chosen, "keep" if chosen == code else "relabel", given, text)
    if last:
        for role_inserted in INSERTIONS[leave, ASSISTANT]:
            begin(role_inserted, "insert", None, "")
        out[-1] = (*out[-1][:-1], out[-1][-1] + CLOSE)
    return out


def _runs(batches: Iterator[pa.RecordBatch], by: str) -> Iterator[dict[str, list]]:
    """Columns of each run of rows with one value of `by`, which may go on from batch to batch."""
    held: dict[str, list] = {}
    for batch in batches:
        columns = {name: batch[name].to_pylist() for name in batch.schema.names}
        begin, values = 0, columns[by]
        for at in range(batch.num_rows + 1):
            ends = at == batch.num_rows
            if not ends:
                ends = values[at] != (values[begin] if at > begin else held[by][0] if held else values[at])
            if ends:
                if at > begin:
                    for name, column in columns.items():
                        held.setdefault(name, []).extend(column[begin:at])
                if at < batch.num_rows and held:
                    yield held
                    held = {}
                begin = at
    if held:
        yield held


def _per_run(frame: DataFrame, by: str, then: list[str], function, schema: T.StructType) -> DataFrame:
    """What `function` makes of the rows of each value of `by`, in order of `then`: tuples in the columns of `schema`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []
        arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema.fields])
        for rows in _runs(batches, by):
            waiting += function(rows)
            if len(waiting) >= SEGMENT:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*waiting), arrow)], schema=arrow)
                waiting = []
        if waiting:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*waiting), arrow)], schema=arrow)

    return frame.repartition(by).sortWithinPartitions(by, *then).mapInArrow(run, schema)


def repair(
    spark: SparkSession, turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """The repaired conversations in pieces: key, segment, piece, turn, given_turn, role, action and rendered.

    A piece is a given turn or an inserted empty one; `turn` numbers the repaired turns of a conversation from 0, and
    merged pieces share the turn they were merged into. The rendered conversation is `rendered` of all its pieces in the
    order of (segment, piece); kept in pieces, a conversation of any size has rows of bounded size. Given turns are taken
    in the order of `turn`, NULL first, then a hash of role and text; equal rows stay as many as they are. A NULL key is a
    conversation too, a NULL or unknown role can become any, a NULL text is empty. "<|" in texts is parted by a space, so
    that no text can close a turn.
    """
    plain = turns.select(
        turns[key].alias("key"), turns[turn].cast("bigint").alias("turn"), turns[role].cast("string").alias("role"),
        turns[text].alias("text"), F.xxhash64(turns[role], turns[text]).alias("tie"),
    )
    # No key, turn or hash holds a segment together: the sorted rows are cut wherever partitions end.
    ordered = plain.repartitionByRange("key", "turn", "tie").sortWithinPartitions("key", "turn", "tie")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, segment, position, chars, held = TaskContext.get().partitionId(), -1, 0, 0, object()
        for batch in batches:
            segments, positions, codes = [], [], []
            for conversation, name, words in zip(*(batch[c].to_pylist() for c in ("key", "role", "text"))):
                if conversation != held or position >= SEGMENT or chars >= SEGMENT_CHARS:
                    segment, position, chars, held = segment + 1, 0, 0, conversation
                segments.append(segment)
                positions.append(position)
                codes.append(role_code(name))
                position, chars = position + 1, chars + len(words or "")
            yield pa.RecordBatch.from_arrays(
                [batch["key"], batch["turn"], batch["text"], pa.array(codes, pa.int32()),
                 pa.array([(part << 32) + s for s in segments], pa.int64()), pa.array(positions, pa.int32())],
                names=["key", "turn", "text", "code", "segment", "position"])

    rows = stored(spark, ordered.mapInArrow(cut, T.StructType([
        plain.schema["key"], plain.schema["turn"], plain.schema["text"], T.StructField("code", T.IntegerType()),
        T.StructField("segment", T.LongType()), T.StructField("position", T.IntegerType()),
    ])), "turns")

    long = T.LongType()

    def measure(run: dict[str, list]) -> list[tuple]:
        return [(run["segment"][0], run["key"][0], segment_matrix(tuple(run["code"])).ravel().tolist())]

    matrices = stored(spark, _per_run(
        rows.select("segment", "position", "key", "code"), "segment", ["position"], measure,
        T.StructType([T.StructField("segment", long), rows.schema["key"], T.StructField("matrix", T.ArrayType(long))]),
    ), "matrices")

    def border(run: dict[str, list]) -> list[tuple]:
        states, _ = border_states([np.array(m).reshape(4, 4) for m in run["matrix"]])
        n = len(states) - 1
        return [(run["segment"][i], states[i], states[i + 1], i == n - 1) for i in range(n)]

    borders = _per_run(matrices, "key", ["segment"], border, T.StructType([
        T.StructField("segment", long), T.StructField("entry", T.IntegerType()), T.StructField("leave", T.IntegerType()),
        T.StructField("last", T.BooleanType()),
    ]))

    def settle(run: dict[str, list]) -> list[tuple]:
        segment = run["segment"][0]
        return [(segment, *p) for p in _pieces(run, run["entry"][0], run["leave"][0], run["last"][0])]

    pieces = _per_run(rows.join(borders, "segment").drop("key"), "segment", ["position"], settle, T.StructType(
        [T.StructField("segment", long)] + [T.StructField(n, t) for n, t in PIECES]))
    pieces = stored(spark, pieces, "pieces")
    begun = pieces.groupBy("segment").agg(F.max("turn_step").alias("n")).join(matrices.select("segment", "key"), "segment")
    before = Window.partitionBy("key").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    begun = begun.select("segment", "key", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("turns_before"))
    return pieces.join(begun, "segment").select(
        "key", "segment", "piece", (F.col("turns_before") + F.col("turn_step") - 1).alias("turn"), "given_turn", "role",
        "action", "rendered",
    )
