"""Temporaries of the toxicity fit stay small beside what it keeps."""

import tracemalloc

import numpy as np
import pyarrow as pa

from smartmaint.llm import toxicity
from smartmaint.llm.words import text_bytes, word_bounds


def _words(n):
    rng = np.random.default_rng(3)
    return ["".join(map(chr, rng.integers(97, 123, int(rng.integers(1, 15))))) for _ in range(n)] + ["größe", "x" * 5000, "naïve", "日本語"]


def test_subwords_are_made_some_words_at_a_time(monkeypatch):
    raw, at = text_bytes(pa.array([" ".join(_words(120_000))], pa.large_string()))
    starts, ends, _ = word_bounds(raw, at)
    tracemalloc.start()
    rows, bounds = toxicity.subwords(raw, starts, ends)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 3.5 * rows.nbytes
    assert len(bounds) == len(starts) + 1 and bounds[-1] == len(rows)
    monkeypatch.setattr(toxicity, "WORD_BYTES_AT_ONCE", 1 << 40)
    whole, whole_bounds = toxicity.subwords(raw, starts, ends)
    assert (rows == whole).all() and (bounds == whole_bounds).all()


def test_sums_in_slices_equal_those_of_whole_arrays(monkeypatch):
    rng = np.random.default_rng(5)
    table, rows = rng.normal(size=100).astype(np.float32), rng.integers(0, 100, 1000)
    bounds = np.sort(np.concatenate(([0, 0, 7, 14, 1000, 1000], rng.integers(0, 1001, 60))))
    total = np.concatenate(([0.0], np.cumsum(table[rows], dtype=np.float64)))
    for at_once in (1, 7, 999, 1000, 4096):
        monkeypatch.setattr(toxicity, "ROWS_AT_ONCE", at_once)
        assert (toxicity._sums(table, rows, bounds) == np.diff(total[bounds])).all()
    assert len(toxicity._sums(table, rows[:0], np.zeros(1, int))) == 0
