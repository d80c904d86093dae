"""Word caches of an idle worker."""

from __future__ import annotations

import time

from smartmaint.llm import tokens


def test_word_caches_go_when_no_task_follows(monkeypatch):
    monkeypatch.setattr(tokens, "IDLE_SECONDS", 0.3)
    tok = tokens.word_tokenizer(tokens.default_path(), special=True)
    ids = tok.ids("Some words, some more words")
    tokens.rest()
    assert tokens.word_tokenizer(tokens.default_path(), special=True) is tok  # the next task comes in time
    time.sleep(0.6)
    assert tok.chunks and not tokens._RESTING
    tokens.rest()
    time.sleep(0.8)
    assert not tok.chunks and not tok.pieces and not tok.chunks.old
    assert tok.ids("Some words, some more words") == ids
