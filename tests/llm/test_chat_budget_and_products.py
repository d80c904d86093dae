"""Budget of chat windows, exact products of large integers."""

from __future__ import annotations

import numpy as np
import pytest

from smartmaint.llm import chat_format, tokens, topk


def test_no_window_exceeds_the_budget_unless_one_turn_with_its_system_turn_does(spark):
    rng = np.random.default_rng(5)
    rows = [(1, 0, "system", "be kind " * 20)]
    rows += [(1, i, "user" if i % 2 else "assistant", f"turn {i} " + "word " * int(rng.choice([1, 5, 60, 90, 170]))) for i in range(1, 90)]
    rows += [(2, 0, "system", "long " * 150), (2, 1, "user", "hi"), (2, 2, "assistant", "there " * 100), (2, 3, "user", "x " * 400)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    budget = 200
    found = chat_format.format_conversations(df, tokens.default_path(), budget=budget, history=60, segment=64).collect()
    tok = tokens.word_tokenizer(tokens.default_path())
    per_conv = {1: [], 2: []}
    for w in sorted(found, key=lambda w: (w.conv_id, w.segment, w.window)):
        turns = chat_format.read_turns(w.formatted)
        fresh = turns[w.repeated:]
        per_conv[w.conv_id] += fresh
        own = sum(len(tok.ids(chat_format.START + r + "\n" + chat_format.escape(t) + chat_format.END)) // 4 for r, t in fresh)
        system = [r for r, _ in turns[:w.repeated]] == ["system"]  # it stays, whatever its length
        assert w.tokens <= budget or len(fresh) == 1 and (w.repeated == 0 and own == w.tokens or system)
    for conv, turns in per_conv.items():
        assert turns == [(r, t) for c, _, r, t in rows if c == conv]
    assert any(w.repeated > 1 for w in found)


def test_history_is_cut_by_tokens_alone(spark):
    rows = [(1, i, "user", "a") for i in range(200)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = chat_format.format_conversations(df, tokens.default_path(), budget=1200, history=600, segment=2000).collect()
    assert max(w.repeated for w in found) > 32 and all(w.tokens <= 1200 for w in found)
    with pytest.raises(ValueError):
        chat_format.format_conversations(df, tokens.default_path(), history=600, segment=64)


@pytest.mark.parametrize("bits", [20, 26, 30, 31, 40, 62, 70, 200])
def test_products_of_large_integers(bits):
    rng = np.random.default_rng(bits)
    q, x = (np.floor(rng.uniform(-1, 1, (9, 16)) * 2.0 ** bits) for _ in range(2))
    q[0], x[0] = 0, 0
    q[1, 1:], q[1, 0] = 0, -1
    low, high = -(1 << 63), (1 << 63) - 1
    want = [[min(high, max(low, sum(int(a) * int(b) for a, b in zip(r, s)))) for s in x] for r in q]
    assert topk.products(q, x).tolist() == want


def test_products_at_the_edge_of_64_bits():
    q = np.array([[2.0 ** 31, 2.0 ** 31], [2.0 ** 31, -1.0], [-(2.0 ** 31), -(2.0 ** 31)]])
    x = np.array([[2.0 ** 31, 2.0 ** 31], [2.0 ** 32, 1.0], [2.0 ** 32, 0.0]])
    low, high = -(1 << 63), (1 << 63) - 1
    want = [[min(high, max(low, sum(int(a) * int(b) for a, b in zip(r, s)))) for s in x] for r in q]
    assert topk.products(q, x).tolist() == want


def test_large_values_stay_vectorised():
    import time
    rng = np.random.default_rng(1)
    q, x = (np.floor(rng.uniform(-1, 1, (512, 128)) * 2.0 ** 27) for _ in range(2))
    began = time.process_time()
    got = topk.products(q, x)
    assert time.process_time() - began < 20  # nested loops take a minute
    assert int(got[5, 7]) == sum(int(a) * int(b) for a, b in zip(q[5], x[7]))
