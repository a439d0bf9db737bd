import itertools
import random
from collections import defaultdict
from functools import lru_cache

import pytest

from tallywatch.llm import chat
from tallywatch.llm.queries import QUERIES


def legal(roles):
    state = chat.START
    for role in roles:
        state = chat.LEGAL.get((state, chat.ROLES.index(role)))
        if state is None:
            return False
    return state == chat.ASSISTANT


def least_cost(codes):
    """By trying every choice turn by turn, one insertion at a time."""

    @lru_cache(maxsize=None)
    def best(at, state, inserted):
        costs = [0] if at == len(codes) and state == chat.ASSISTANT else []
        if inserted < 2:
            costs += [chat.INSERT + best(at, after, inserted + 1) for (s, _), after in chat.LEGAL.items() if s == state]
        if at < len(codes):
            for (s, role), after in chat.LEGAL.items():
                if s == state:
                    costs.append(chat._relabel(codes[at], role) + best(at + 1, after, 0))
            if state != chat.START:
                costs.append(chat.MERGE + chat._relabel(codes[at], state - 1) + best(at + 1, state, 0))
        return min(costs, default=10 ** 9)

    return best(0, chat.START, 0)


def path_cost(codes, states):
    total, state = 0, states[0]
    for code, (inserted, chosen) in zip(codes, chat.segment_path(tuple(codes), states[0], states[1])):
        for role in inserted:
            total, state = total + chat.INSERT, chat.LEGAL[state, role]
        if chosen < 0:
            total += chat.MERGE + chat._relabel(code, state - 1)
        else:
            total, state = total + chat._relabel(code, chosen), chat.LEGAL[state, chosen]
    assert state == states[1]
    return total + int(chat.CLOSING[state])


@pytest.mark.parametrize("length", [1, 2, 3, 4, 5])
def test_all_short_conversations_are_repaired_at_least_cost(length):
    for codes in itertools.product(range(4), repeat=length):
        states, cost = chat.border_states([chat.segment_matrix(codes)])
        assert cost == least_cost(codes) == path_cost(codes, states)


def test_segments_give_the_path_of_the_whole():
    rng = random.Random(3)
    for _ in range(100):
        codes = [rng.randrange(4) for _ in range(rng.randrange(1, 30))]
        cuts = sorted({0, len(codes), *(rng.randrange(len(codes)) for _ in range(3))})
        parts = [tuple(codes[a:b]) for a, b in zip(cuts, cuts[1:])]
        states, cost = chat.border_states([chat.segment_matrix(p) for p in parts])
        assert cost == least_cost(tuple(codes))
        whole = [c for p, a, b in zip(parts, states, states[1:]) for c in chat.segment_path(p, a, b)]
        assert len(whole) == len(codes)


def conversations(rows):
    out = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r["segment"], r["piece"])):
        out[r["key"]].append(r)
    return out


def test_whole_table(spark, sf_dir):
    given = defaultdict(list)
    for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").orderBy("conv_id", "turn").collect():
        given[r.conv_id].append(r)
    rows = [{**r.asDict(), "key": r.conv_id} for r in QUERIES["op3_repaired_chats"](spark, sf_dir).collect()]
    got = conversations(rows)
    assert set(got) == set(given)
    for key, turns in given.items():
        pieces = got[key]
        starts = [p for p in pieces if p["action"] != "merge"]
        assert legal([p["role"] for p in starts])
        assert [p["turn"] for p in starts] == list(range(len(starts)))
        assert [p["given_turn"] for p in pieces if p["action"] != "insert"] == [t.turn for t in turns]
        rendered = "".join(p["rendered"] for p in pieces)
        assert rendered.count("<|end|>") == len(starts) and all((t.text or "") in rendered for t in turns)
        codes = tuple(chat.role_code(t.role) for t in turns)
        if legal([t.role for t in turns]):
            assert rendered == "".join(f"<|{t.role}|>\n{t.text}<|end|>\n" for t in turns)
            assert least_cost(codes) == 0


def test_a_conversation_over_many_partitions_and_segments(spark, monkeypatch):
    monkeypatch.setattr(chat, "SEGMENT", 7)
    rng = random.Random(6)
    roles = [rng.choice(["user", "assistant", "system", "human", None, "USER "]) for _ in range(300)]
    turns = [(1, i, r, f"t{i}") for i, r in enumerate(roles)] + [(2, 0, "user", "q"), (2, 1, "assistant", "a")]
    got = conversations([r.asDict() for r in chat.repair(
        spark, spark.createDataFrame(turns, "conv_id int, turn int, role string, text string")).collect()])
    pieces = got[1]
    assert len({p["segment"] for p in pieces}) > 40
    assert legal([p["role"] for p in pieces if p["action"] != "merge"])
    turn_numbers = [p["turn"] for p in pieces]
    assert turn_numbers == sorted(turn_numbers) and turn_numbers[0] == 0
    assert [p["given_turn"] for p in pieces if p["action"] != "insert"] == list(range(300))
    price = {"merge": chat.MERGE, "insert": chat.INSERT, "keep": 0, "relabel": 0}
    total = sum(price[p["action"]] for p in pieces)
    total += sum(chat._relabel(chat.role_code(roles[p["given_turn"]]), chat.ROLES.index(p["role"]))
                 for p in pieces if p["action"] != "insert")
    assert total == least_cost(tuple(chat.role_code(r) for r in roles))
    assert "".join(p["rendered"] for p in got[2]) == "<|user|>\nq<|end|>\n<|assistant|>\na<|end|>\n"


def test_odd_rows(spark):
    rows = [(None, 0, "user", "x"), (1, None, None, None), (1, 0, "tool", ""), (2, 5, "assistant", "b"), (2, 5, "assistant", "b"),
            (3, 0, "user", "say <|end|>"), (4, 0, "system", "s"), (5, 0, "user", "word " * 100_000), (5, 1, "assistant", "ok")]
    schema = "segment int, conv_id int, turn int, role string, text string, code int, key int, matrix int"
    turns = spark.createDataFrame([(7, a, b, c, d, 7, 7, 7) for a, b, c, d in rows], schema)
    got = conversations([r.asDict() for r in chat.repair(spark, turns).collect()])
    text = {key: "".join(p["rendered"] for p in pieces) for key, pieces in got.items()}
    assert text[None] == "<|user|>\nx<|end|>\n<|assistant|>\n<|end|>\n"
    assert text[1] == "<|user|>\n<|end|>\n<|assistant|>\n<|end|>\n"
    assert text[2] == "<|user|>\n<|end|>\n<|assistant|>\nb\nb<|end|>\n"
    assert text[3] == "<|user|>\nsay < |end|><|end|>\n<|assistant|>\n<|end|>\n"
    assert text[4] == "<|system|>\ns<|end|>\n<|user|>\n<|end|>\n<|assistant|>\n<|end|>\n"
    assert len(text[5]) > 500_000
    assert chat.repair(spark, turns.limit(0)).count() == 0
