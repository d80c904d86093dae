"""Training order of token shards, sequence by sequence."""

from __future__ import annotations

import random

import numpy as np

from smartmaint.llm import shards, tokens


def test_every_sequence_lies_in_the_slot_that_the_permutation_gives(spark):
    rng = random.Random(21)
    texts = [" ".join(rng.choice(["red", "green", "blue", "house", "tree", "river"]) + str(rng.randrange(50))
                      for _ in range(rng.randrange(0, 120))) for _ in range(60)] + [None, ""]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    length, sequences = 32, 8
    back = shards.training_shards(docs, tokens.default_path(), length=length, sequences=sequences).orderBy("shard").collect()
    tok = tokens.word_tokenizer(tokens.default_path(), special=True)
    flat = [i for t in texts for i in np.frombuffer(tok.ids(t), "<u4").tolist() + [shards.END_ID]]
    n = -(-len(flat) // length)
    flat += [shards.PAD_ID] * (n * length - len(flat))
    want = np.array(flat, "<u2").reshape(n, length)
    slots = shards.feistel(np.arange(n), n)
    assert sorted(slots.tolist()) == list(range(n)) and slots.tolist() != list(range(n))
    placed = np.empty_like(want)
    placed[slots] = want
    assert b"".join(r.payload for r in back) == placed.tobytes()
    assert sum(r.sequences for r in back) == n
