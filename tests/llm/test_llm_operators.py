"""The training-data operators against brute force, exact round trips and held-out labels, on small tables."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from smartmaint.llm import chat_format, common, components, decontamination, licenses, line_dedup, packing, pii, shards, simhash, tokens, topk, toxicity, words

WORDS = "the of and to in is that for it was on with as by are this be from or an alpha beta gamma delta omega".split()


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def edge_rows():
    """Nulls, empty and very long texts, repeated rows and ids."""
    rng = random.Random(5)
    long_text = "\n".join(prose(rng, 12) for _ in range(2000))
    return [(None, "null id text here"), (1, None), (2, ""), (3, "  \n \t"), (4, "one"), (4, "one"), (4, "another text of the same id"),
            (5, long_text), (6, "naïve Straße ΑΣΣ İstanbul   日本語 🙂 </s>[INST] x"), (7, "a" * 70000)]


# ---- tokens and packing -------------------------------------------------

def test_token_ids_equal_the_tokenizer(edge_rows):
    from tokenizers import Tokenizer
    exact = Tokenizer.from_file(tokens.default_path())
    exact.encode_special_tokens = True
    tok = tokens.word_tokenizer(tokens.default_path())
    rng = random.Random(0)
    texts = [t for _, t in edge_rows if t]
    texts += ["".join(rng.choice("abcdefgéüßñöÀÿİıſƏ'sS.,-!?0123456789 \t\n\x0b\x1c\x85  ﬁ") for _ in range(60)) for _ in range(800)]
    texts += ["it's WE'LL don't <|endoftext|> <|startoftext|> x</w> ÿ Ā ɏ ɐ"]
    for t in texts:
        want = exact.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(tok.ids(t), "<u4").tolist() == want, t


def test_added_tokens_in_a_text_give_the_ids_of_an_unmodified_tokenizer(spark):
    from tokenizers import Tokenizer
    exact = Tokenizer.from_file(tokens.default_path())
    texts = ["hello <|endoftext|> world", "a<|endoftext|>b<|startoftext|><|endoftext|>. É<|endoftext|>日本", "<|ENDOFTEXT|> <|endoftext |> x<|startoftext|>"]
    tok = tokens.word_tokenizer(tokens.default_path(), special=True)
    want = {i: exact.encode(t, add_special_tokens=False).ids for i, t in enumerate(texts)}
    assert want[0] == [3306, 49407, 1002]
    for i, t in enumerate(texts):
        assert np.frombuffer(tok.ids(t), "<u4").tolist() == want[i], t
    got = packing.pack_documents(frame(spark, list(enumerate(texts))), tokens.default_path()).collect()
    assert {r.doc_id: np.frombuffer(r.ids, "<u4").tolist()[:-1] for r in got} == want


def test_cache_generations_keep_values():
    g = tokens.Generations(lambda k: k * 2, 3)
    assert [g[i] for i in [1, 2, 3, 4, 1, 5, 6, 1, 2]] == [2, 4, 6, 8, 2, 10, 12, 2, 4]
    assert len(g) + len(g.old) <= 6


def test_differencing_balances_and_respects_capacity():
    rng = random.Random(1)
    for n, cap in ((1, 100), (7, 100), (60, 100), (400, 300)):
        sizes = [rng.randrange(1, 100) for _ in range(n)]
        got = packing.pack_group(sizes, cap)
        assert sorted(itertools.chain(*got)) == list(range(n))
        assert max(sum(sizes[i] for i in w) for w in got) <= cap
    sizes = [rng.randrange(1, 50) for _ in range(300)]
    loads = [sum(sizes[i] for i in w) for w in packing.differencing(sizes, 20)]
    assert max(loads) - min(loads) <= 10
    assert packing.pack_group([100, 100, 100], 100) == [[0], [1], [2]]


def test_packing_round_trip(spark, edge_rows):
    rng = random.Random(2)
    rows = edge_rows + [(100 + i, prose(rng, rng.randrange(1, 900))) for i in range(60)]
    docs = frame(spark, rows).withColumn("length", F.lit("clash")).withColumn("ids", F.lit(1))
    got = packing.pack_documents(docs.repartition(3), tokens.default_path()).collect()
    tok = tokens.word_tokenizer(tokens.default_path())
    end = (1).to_bytes(4, "little")
    want = Counter((i, tok.ids(t) + end) for i, t in rows)
    by_seq, whole = defaultdict(list), Counter()
    for r in got:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        by_seq[r.sequence_id].append(r)
    for seq in by_seq.values():
        at = 0
        for r in sorted(seq, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    # pieces of documents with one id and length may come in any order: their multiset must fit
    pieces = Counter((r.doc_id, r.start, r.ids) for r in got)
    for (i, ids), n in want.items():
        total = len(ids) // 4
        starts = sorted({r.start for r in got if r.doc_id == i and r.doc_tokens == total})
        for a, b in zip(starts, starts[1:] + [total]):
            whole[(i, a, ids[4 * a:4 * b])] += n
    assert whole == pieces
    assert packing.pack_documents(frame(spark, []), tokens.default_path()).count() == 0


# ---- line dedup ---------------------------------------------------------

def _line_dedup_by_hand(rows, min_words=8):
    docs = {(i, t) for i, t in rows if t is not None}
    lines = defaultdict(list)
    low = lambda t: xxhash.xxh64_intdigest(t.encode(), 42) & ((1 << 30) - 1)
    key = lambda i, t, n: (i is None, i if i is not None else 0, low(t), n)
    for i, t in docs:
        for n, line in enumerate(t.split("\n")):
            w = tuple(x for x in re.split(r"[\x20\x09-\x0D]+", line) if x)
            if w:
                lines[w].append((key(i, t, n), i, t, n))
    first = {w: min(p[0] for p in ps) for w, ps in lines.items()}
    gone = set()
    for w, ps in lines.items():
        near = len(w) >= min_words and any(
            len(v) >= min_words and v != w and first[v] < first[w] and line_dedup.within_one_edit(list(v), list(w)) for v in lines)
        gone |= {(i, t, n) for k, i, t, n in ps if near or k != first[w]}
    return Counter((i, t if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if (i, t, n) not in gone)) for i, t in rows)


def test_line_dedup_equals_brute_force(spark, edge_rows):
    rng = random.Random(3)
    pool = [prose(rng, n) for n in (3, 5, 8, 9, 9, 12, 30) for _ in range(3)]
    rows = list(edge_rows)
    for i in range(10, 70):
        out = []
        for _ in range(rng.randrange(1, 7)):
            w = rng.choice(pool).split(" ")
            op = rng.randrange(5)
            if op == 1:
                w[rng.randrange(len(w))] = "changed" + str(rng.randrange(3))
            elif op == 2:
                w.insert(rng.randrange(len(w) + 1), "extra" + str(rng.randrange(3)))
            elif op == 3:
                del w[rng.randrange(len(w))]
            out.append(rng.choice([" ", "  ", "\t"]).join(w))
        rows.append((i, "\n".join(out)))
    rows.append(rows[-1])
    got = line_dedup.dedup_lines(frame(spark, rows).withColumn("words", F.lit(1)).withColumn("place", F.lit("x")))
    assert got.columns == ["doc_id", "text", "words", "place", "__removed"]
    assert Counter((r.doc_id, r.text) for r in got.collect()) == _line_dedup_by_hand(rows)
    assert line_dedup.dedup_lines(frame(spark, [])).count() == 0


def test_line_dedup_joins_beyond_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "BROADCAST_ROWS", 0)
    base = "a b c d e f g h i j"
    rows = [(1, base), (2, base + " k"), (3, "x\n" + base.replace("e", "E")), (4, "x\nkept line")]
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(frame(spark, rows)).collect()}
    assert got == {1: base, 2: "", 3: "x", 4: "kept line"}


def test_word_edit_distance():
    near = line_dedup.within_one_edit
    assert near(list("abc"), list("abc")) and near(list("abc"), list("axc")) and near(list("abc"), list("abxc")) and near(list("abc"), list("bc"))
    assert not near(list("abcd"), list("bcda")) and not near(list("abc"), list("xyc")) and not near(list("abc"), list("abcde"))


# ---- personal data ------------------------------------------------------

BASE = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def _luhn(x):
    return sum((2 * int(c) - 9 if int(c) > 4 else 2 * int(c)) if i % 2 else int(c) for i, c in enumerate(reversed(x))) % 10 == 0


def _base_spans(text):
    out = []
    for rank, (kind, pattern) in enumerate(BASE):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            if (kind == "ip" and any(int(p) > 255 for p in m.group().split("."))) or (kind == "card" and not (12 <= len(d) <= 19 and _luhn(d))) \
                    or (kind == "phone" and not 9 <= len(d) <= 15):
                continue
            out.append((m.start(), rank, m.end(), kind))
    return [(k, s, e) for s, _, e, k in sorted(out)]


def test_base_spans_equal_the_contract(spark, edge_rows):
    rng = random.Random(4)
    rows = list(edge_rows) + [(20, "a@b.c@d.e x@y@z.w é🙂 q@w.e_d@e.f"), (21, "1.2.3.4.5.6.7.8 300.1.1.1 000255.1.2.3 1.2.3.0004"),
                              (22, "4539 1488 0343 6467 4539-1488-0343-6467 45391488034364671"), (23, "+1 (988) 555-2485 ++49 30 1234567. +1"),
                              (24, "1" * 30000 + "." * 10 + "a" * 30000 + "@" + "b." * 9000)]
    rows += [(30 + i, "".join(rng.choice(["1", "23", ".", "@", "+", " ", "-", "a", "é", "(", ")", "4539148803436467", "\n"]) for _ in range(60)))
             for i in range(150)]
    docs = frame(spark, rows).withColumn("row", F.lit(1)).withColumn("kind", F.lit("clash"))
    got = pii.find_pii(docs, ["doc_id", "row", "kind"]).collect()
    have = Counter((r.doc_id, tuple((s.kind, s.start, s.end) for s in r.spans if s.kind in pii.BASE_KINDS)) for r in got)
    assert have == Counter((i, tuple(_base_spans(t))) for i, t in rows)
    assert pii.find_pii(frame(spark, []), ["doc_id"]).count() == 0


def test_ibans_need_their_checksum_and_context_scores(spark):
    rows = [(1, "konto DE89 3704 0044 0532 0130 00 ok"), (2, "DE89370400440532013001"), (3, "serial GB82WEST12345698765432"), (4, "GB82WEST12345698765432")]
    got = {r.doc_id: [(s.kind, s.start, s.end, s.score) for s in r.spans if s.kind == "iban"] for r in pii.find_pii(frame(spark, rows), ["doc_id"]).collect()}
    assert got[1] == [("iban", 6, 33, 1.0)] and got[2] == [] and got[3] == []
    assert got[4] == [("iban", 0, 22, 0.8)]


def test_ibans_end_where_their_country_says(spark):
    de, gb, no = "DE89370400440532013000", "GB82 WEST 1234 5698 7654 32", "NO93 8601 1117 947"
    spaced = "DE89 3704 0044 0532 0130 00"
    texts = [f"{de} Please pay", f"{spaced} BIC COBADEFF", f"{de} {spaced} {gb} {no} {de}", f"{no} 2024 {gb} X", f"{de}0 {spaced}0 ZZ{de[2:]}"]
    want = [[de], [spaced], [de, spaced, gb, no, de], [no, gb], []]
    got = {r.doc_id: [texts[r.doc_id][s.start:s.end] for s in r.spans if s.kind == "iban"]
           for r in pii.find_pii(frame(spark, list(enumerate(texts))), ["doc_id"]).collect()}
    assert got == dict(enumerate(want))
    codes = [c for v in pii.IBAN_LENGTHS.values() for c in v.split()]
    assert len(codes) == len(set(codes))


# ---- exact search -------------------------------------------------------

def test_top_k_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD", 40)
    monkeypatch.setattr(topk, "STRIP", 8)
    monkeypatch.setattr(topk, "FAN", 2)
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 6) / 8]) for i in range(330)]  # many ties
    rows += [(1000, None), (1001, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (1100, [float("nan")] * 6), (1200, [float("inf")] + [0.0] * 5), (None, [1.0] * 6),
             (1300, [1.0, 2.0]), (1301, [0.5, 0.5]), (1400, []), (1500, [1e30] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("clash")).repartition(5)
    got = defaultdict(list)
    for r in topk.top_k(df).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    good = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    cut = lambda v: min((1 << 63) - 1, max(-(1 << 63), v))
    for q, a in good:
        if q % 100 == 0:
            s = sorted((-cut(sum(x * y for x, y in zip(a, b))), i) for i, b in good if i != q and len(b) == len(a))[:10]
            assert sorted(got.pop(q, [])) == [(k, i, -v) for k, (v, i) in enumerate(s, 1)], q
    assert not got
    assert topk.top_k(df.limit(0)).count() == 0


# ---- chat formatting ----------------------------------------------------

def _check_windows(rows, windows, budget):
    convs = defaultdict(list)
    for c, t, role, text in rows:
        convs[c].append((t is not None, t, role or "", text or ""))
    read = defaultdict(list)
    loss = defaultdict(str)
    for w in sorted(windows, key=lambda w: (w.conv_id is not None, w.conv_id, w.segment, w.window)):
        turns = chat_format.read_turns(w.formatted)
        fresh = turns[w.repeated:]
        assert fresh and (w.tokens <= budget or len(fresh) == 1)
        for r in turns[:w.repeated]:
            assert r in read[w.conv_id]
        read[w.conv_id] += fresh
        loss[w.conv_id] += "".join(chat_format.unescape(w.formatted[s.start:s.end]) for s in w.loss)
    for c, turns in convs.items():
        got = read.pop(c)
        assert Counter(got) == Counter((r, x) for _, _, r, x in turns)
        if len({t[1] for t in turns}) == len(turns):
            assert got == [(r, x) for _, _, r, x in sorted(turns, key=lambda t: (t[0], t[1] or 0))]
        assert loss[c] == "".join(x for r, x in got if r == "assistant")
    assert not read


def test_chat_round_trip(spark):
    rng = random.Random(6)
    bits = ["</s>", "[INST]", "[/INST]", "<\\s>", "<<SYS>>", "<|im_end|>", "<|im_start|>user\n", "\\", "<", "[", "\n", "%0A", "word ", "é🙂 "]
    text = lambda: "".join(rng.choice(bits) for _ in range(rng.randrange(0, 12)))
    rows = [(c, t, rng.choice(["user", "assistant"]) if t else "system", text()) for c in range(25) for t in range(rng.randrange(1, 9))]
    rows += [(99, t, ["system", "user", "assistant"][0 if not t else 1 + t % 2], f"turn {t} " + text()) for t in range(500)]  # a hot conversation
    rows += [(None, 0, "user", "a"), (None, 1, "assistant", None), (50, None, None, "x"), (51, 0, "assistant", "dup"), (51, 0, "assistant", "dup"),
             (52, 0, "we%ird\nrole<s>", "y"), (53, 0, "user", "long " * 3000), (53, 1, "assistant", "fine")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("segment", F.lit("clash")).repartition(6)
    windows = chat_format.format_conversations(df, tokens.default_path(), budget=120, history=30, segment=40).collect()
    _check_windows(rows, windows, 120)
    assert any(w.repeated for w in windows)
    late = [w for w in windows if w.conv_id == 99 and (w.segment, w.window) != (0, 0)]
    assert late and all(chat_format.read_turns(w.formatted)[0][0] == "system" for w in late)
    assert chat_format.format_conversations(df.limit(0), tokens.default_path()).count() == 0


@pytest.mark.parametrize("text", ["", "</s>[INST] ok [/INST]", "<\\s>", "<\\\\|im_end|>", "<<|im_end|>", "[\\INST][INST]", "<<</SYS>>"])
def test_escape_is_reversible(text):
    out = chat_format.escape(text)
    assert chat_format.unescape(out) == text
    assert not any(c in out for c in chat_format.CONTROL)


# ---- decontamination ----------------------------------------------------

def _item_words(t):
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))) if w]


@pytest.mark.parametrize("block_bytes", [1 << 20, 300])
def test_decontamination_equals_brute_force(spark, edge_rows, block_bytes):
    rng = random.Random(7)
    items = [(i, prose(rng, rng.choice([2, 5, 13, 20, 60]))) for i in range(20)] + [(20, None), (None, "no id"), (21, ""), (22, "a a a a a a a a a a a a a a a a")]
    rows = list(edge_rows)
    for i in range(100, 180):
        out = [prose(rng, rng.randrange(0, 60))]
        if rng.random() < .7:
            w = rng.choice([t for _, t in items if t]).upper().split(" ")
            a = rng.randrange(len(w))
            out.append(rng.choice(["; ", " "]).join(w[a:a + rng.randrange(1, 40)]))
        rows.append((i, " ".join(out + [prose(rng, rng.randrange(0, 60))])))
    rows += [(300, "a " * 40), (301, "A-a" * 5)]
    wins = [(str(i), tuple(w[s:s + min(13, len(w))])) for i, t in items if i is not None and t is not None
            for w in [_item_words(t)] if w for s in range(len(w) - min(13, len(w)) + 1)]
    where = defaultdict(set)
    for i, w in wins:
        where[w].add(i)
    lengths = {len(w) for w in where}
    want = Counter()
    for i, t in rows:
        w, hit, found = _item_words(t), set(), set()
        for n in lengths:
            for s in range(len(w) - n + 1):
                if tuple(w[s:s + n]) in where:
                    hit |= set(range(s, s + n))
                    found |= where[tuple(w[s:s + n])]
        want[(i, len(w), len(hit), tuple(sorted(found)), len(hit) > 0 and 20 * len(hit) >= len(w))] += 1
    docs = frame(spark, rows).withColumn("n_hit", F.lit("clash")).withColumn("c0", F.lit(1)).withColumn("__words", F.lit(2))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.find_contamination(docs, bench, keep=["doc_id"], block_bytes=block_bytes).collect()
    assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r.item_ids), r.contaminated) for r in got) == want
    texts = dict(items)
    for r in got:
        for m in r.matches:
            assert m.words >= min(13, len(_item_words(texts[int(m.item_id)])))
    if block_bytes > 300:
        kept = decontamination.remove_contaminated(docs, bench)
        assert kept.columns == docs.columns
        assert Counter(r.doc_id for r in kept.collect()) == Counter({k: v for k, v in Counter(x[0] for x in want.elements() if not x[4]).items()})
        assert decontamination.find_contamination(docs, bench.limit(0), keep=["doc_id"]).filter("contaminated").count() == 0
        assert decontamination.find_contamination(docs.limit(0), bench).count() == 0


def test_longest_match_and_place(spark):
    item = " ".join(f"w{i}" for i in range(40))
    docs = frame(spark, [(1, "x y " + " ".join(f"W{i}" for i in range(5, 35)) + " z")])
    r = decontamination.find_contamination(docs, spark.createDataFrame([(7, item)], "item_id long, text string"), keep=["doc_id"]).first()
    assert [tuple(m) for m in r.matches] == [("7", 5, 2, 30)] and r.n_hit == 30 and r.n_words == 33


def test_word_hashes_tell_words_apart():
    texts = ["Ab ab, aB é É x" + "y" * 5000 + " x" + "Y" * 5000 + " a b ab", None, "", "zz"]
    raw, rows = words.text_bytes(pa.array(texts))
    s, e, first = words.word_bounds(raw, rows)
    got = [words.LOWER[raw[a:b]].tobytes() for a, b in zip(s, e)]
    assert got == [w.encode() for t in texts for w in _item_words(t)]
    h = words.word_hashes(raw, s, e, chunk=64)
    assert len(set(h.tolist())) == len(set(got)) and (np.diff(first) == [len(_item_words(t)) for t in texts]).all()


# ---- licenses -----------------------------------------------------------

def test_license_windows_and_containment(spark, edge_rows):
    rng = random.Random(8)
    rows = list(edge_rows)
    want = defaultdict(set)
    for i, (name, text) in enumerate(licenses.TEMPLATES):
        pad = prose(rng, 300 + i)
        rows.append((100 + i, pad + " " + text.upper() + "\n" + pad))
        want[100 + i].add(name)
        rows.append((200 + i, " ".join(text.split()[:3]) + " " + pad))  # too little of it
    hot = " ".join(t for _, t in licenses.TEMPLATES) * 50
    rows.append((300, hot))
    want[300] = {n for n, _ in licenses.TEMPLATES}
    docs = frame(spark, rows).withColumn("band", F.lit(1)).withColumn("name", F.lit("clash"))
    got = licenses.scan_licenses(docs, keep=["doc_id", "band", "name"]).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
    for r in got:
        assert {x.name for x in r.licenses} == want[r.doc_id], r.doc_id
        assert all(0.8 <= x.containment <= 1 for x in r.licenses)
    assert licenses.scan_licenses(docs.limit(0)).count() == 0


def test_usual_statements_short_templates_and_whole_texts_match(spark):
    rng = random.Random(81)
    stated = [("Licensed under the MIT License", "MIT"), ("distributed under the ISC license.", "ISC"), ("under the GNU Lesser General Public License v2.1", "LGPL-2.1"),
              ("GNU Affero General Public License, version 3", "AGPL-3.0"), ("licensed under the GNU General Public License, version 2.", "GPL-2.0"),
              ("released under the CC0 1.0 Universal", "CC0-1.0"), ("Licensed under CC-BY-SA 4.0", "CC-BY-SA-4.0"), (licenses._BODIES[0][1], "MIT")]
    docs = frame(spark, [(i, f"{prose(rng, 40)}\n{t}\n{prose(rng, 40)}") for i, (t, _) in enumerate(stated)])
    got = {r.doc_id: [x.name for x in r.licenses] for r in licenses.scan_licenses(docs).collect()}
    assert got == {i: [n] for i, (_, n) in enumerate(stated)}
    long_text = prose(rng, 600)
    templates = spark.createDataFrame([("whole", long_text), ("reserved", "All rights reserved."), ("one", "Zork!"), ("none", "!"), ("null", None)],
                                      "name string, text string")
    rows = [(1, f"{prose(rng, 30)} ALL rights, reserved {prose(rng, 30)}"), (2, f"{prose(rng, 700)} {long_text} zork"),
            (3, "all rights are reserved, overall rights reserved"), (4, None), (5, long_text[:len(long_text) // 2]), (6, "zork"), (6, "zork")]
    found = licenses.scan_licenses(frame(spark, rows), templates).collect()
    assert Counter((r.doc_id, tuple(x.name for x in r.licenses)) for r in found) == Counter(
        [(1, ("reserved",)), (2, ("one", "whole")), (3, ()), (4, ()), (5, ()), (6, ("one",)), (6, ("one",))])
    assert [(x.word, x.containment) for r in found if r.doc_id == 1 for x in r.licenses] == [(30, 1.0)]


def test_window_sizes_leave_room_for_half_a_window():
    for t in range(1, 300):
        s = licenses.window_size(t)
        assert s + max(1, s // 2) - 1 <= t < 2 * s + s - 1


# ---- SimHash ------------------------------------------------------------

def _fp(text):
    w = (text or "").encode().lower().split()
    sh = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    import xxhash
    hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)) if hs else 0


def _components(nodes, linked):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in itertools.combinations(nodes, 2):
        if linked(a, b):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_simhash_equals_brute_force(spark, edge_rows):
    rng = random.Random(9)
    rows = list(edge_rows)
    for i in range(100, 140):
        base = prose(rng, rng.randrange(2, 300)).split()
        rows.append((i, " ".join(base)))
        for j in range(rng.randrange(3)):
            w = list(base)
            w[rng.randrange(len(w))] = "changed"
            rows.append((i * 10 + j, " ".join(w).upper()))
    fps = {(i, t): _fp(t) for i, t in rows}
    root = _components(sorted(set(fps.values())), lambda a, b: (a ^ b).bit_count() <= 3)
    least = {}
    for (i, _), f in fps.items():
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    docs = frame(spark, rows).withColumn("fp", F.lit("clash")).withColumn("root", F.lit(1)).repartition(4)
    got = simhash.near_duplicates(docs).collect()
    assert Counter((r.doc_id, r.fingerprint, r.component) for r in got) == Counter((i, f"{fps[i, t]:016x}", least.get(root[fps[i, t]])) for i, t in rows)
    kept = simhash.keep_representatives(docs)
    assert kept.columns == docs.columns
    kept = kept.collect()
    assert len(kept) == len(set(root.values()))
    assert Counter(root[fps[r.doc_id, r.text]] for r in kept) == Counter(set(root.values()))
    assert {r.doc_id for r in kept if r.doc_id is not None} <= set(least.values())
    assert simhash.near_duplicates(docs.limit(0)).count() == 0 and simhash.keep_representatives(docs.limit(0)).count() == 0


def test_every_pair_within_the_radius_meets_in_a_table():
    rng = random.Random(10)
    for free in ((1 << 64) - 1, rng.getrandbits(64), 0b1011):
        masks = simhash.covering_masks(free)
        bits = [b for b in range(64) if free >> b & 1]
        for _ in range(400):
            d = sum(1 << b for b in rng.sample(bits, min(len(bits), rng.randrange(1, 4))))
            assert any(not d & m for m in masks)


def test_hot_buckets_are_refined(spark):
    rng = random.Random(11)
    centre = rng.getrandbits(64)
    fps = {centre ^ sum(1 << b for b in rng.sample(range(64), k)) for k in (1, 2, 2, 3, 6) for _ in range(40)} | {rng.getrandbits(64) for _ in range(50)}
    df = spark.createDataFrame([(simhash._signed(f),) for f in fps], "fp long")
    links = simhash.link_forest(df, max_bucket=4).collect()
    assert all(((a ^ b) & (2**64 - 1)).bit_count() <= 3 for a, b in links)
    want = _components(sorted(fps), lambda a, b: (a ^ b).bit_count() <= 3)
    joined = {frozenset((a & (2**64 - 1), b & (2**64 - 1))) for a, b in links}
    got = _components(sorted(fps), lambda a, b: frozenset((a, b)) in joined)
    assert got == want


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(60)] + [(200, 200 + i) for i in range(1, 40)] + [(500, 501), (501, 500), (7, 7)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{200 + i: 200 for i in range(40)}, 500: 500, 501: 500}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- toxicity -----------------------------------------------------------

def test_toxicity_learns_held_out_and_misspelt_words(spark, edge_rows):
    rng = random.Random(12)
    bad = ["wurgle", "snarkfit", "blortish"]
    rows, labels = [], []
    for i in range(1200):
        t = prose(rng, rng.randrange(5, 120)).split()
        toxic = rng.random() < .25
        if toxic:
            t.insert(rng.randrange(len(t)), rng.choice(bad) + rng.choice(["", "s", "ed"]))
        rows.append((i, " ".join(t)))
        labels.append(int(toxic))
    fit, test = slice(0, 800), slice(800, 1200)
    model = toxicity.fit(pa.array([t for _, t in rows[fit]]), np.array(labels[fit]))
    s = toxicity.scores(model, pa.array([t for _, t in rows[test]]))
    y = np.array(labels[test])
    assert ((s >= toxicity.THRESHOLD) == y).mean() > .93
    odd = toxicity.scores(model, pa.array([prose(rng, 20) + " wurglle snarkfitt " + prose(rng, 20), prose(rng, 42)]))
    assert odd[0] > .3 > odd[1]
    docs = frame(spark, edge_rows).withColumn("score", F.lit("clash")).withColumn("c0", F.lit(1))
    scored = toxicity.score_documents(docs, model, docs.columns)
    assert scored.filter("score BETWEEN 0 AND 1").count() == len(edge_rows)
    kept = toxicity.remove_toxic(docs, model)
    assert kept.columns == docs.columns and 0 < kept.count() <= len(edge_rows)
    assert toxicity.score_documents(docs.limit(0), model, ["doc_id"]).count() == 0


def test_toxicity_without_both_labels():
    for y, low, high in (([], .05, .15), ([0, 0, 0, 0], 0, .05), ([1, 1, 1, 1], .7, 1)):
        m = toxicity.fit(pa.array(["x"] * len(y), pa.string()), np.array(y))
        assert low <= toxicity.scores(m, pa.array(["a b", None]))[0] <= high


def test_held_out_rows_are_never_sampled(spark):
    docs = frame(spark, [(i, f"text {i}") for i in range(200)] + [(None, "x")])
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(3, 1), (5, None), (None, 1)], "doc_id long, label int")
    texts, y, _ = toxicity.labelled_sample(docs, labels.filter(~toxicity.is_held_out(F.col("doc_id"))), rows=50)
    ids = [int(t.split()[1]) for t in texts.to_pylist()]
    assert len(ids) == 50 and all(zlib.crc32(str(i).encode()) % 4 != 2 for i in ids)
    assert all(v == (1 if i == 3 else i % 2) for i, v in zip(ids, y))
    assert len(toxicity.labelled_sample(docs, labels, size=40)[0]) < 10


def test_long_labelled_texts_do_not_end_the_sample(spark):
    rows = [(i, f"text {i}") for i in range(300)]
    first = [r.doc_id for r in frame(spark, rows).orderBy(F.xxhash64("doc_id"), "doc_id").limit(5).collect()]
    rows = [(i, "x" * 20_000 if i in first else t) for i, t in rows]
    docs = frame(spark, rows + rows[:50])
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, label int")
    texts, y, _ = toxicity.labelled_sample(docs, labels, size=16_000)
    assert sorted(int(t.split()[1]) for t in texts.to_pylist()) == [i for i in range(300) if i not in first]
    assert [int(t.split()[1]) % 2 for t in texts.to_pylist()] == y.tolist()
    tight, _, _ = toxicity.labelled_sample(frame(spark, [(i, "y" * (15 if i in first else 1)) for i, _ in rows]), labels, size=960)
    assert sum(map(len, tight.to_pylist())) <= 960 and len(tight) == 300
    only_long = labels.withColumn("label", F.col("doc_id").isin(first).cast("int"))
    texts, y, weights = toxicity.labelled_sample(docs, only_long, size=100_000)
    assert sum(map(len, texts.to_pylist())) <= 100_000 and 1 <= y.sum() <= 5
    assert np.isclose(weights[y == 1].sum(), 5) and np.isclose(weights[y == 0].sum(), 295)
    assert set(toxicity.labelled_sample(docs, only_long, size=16_000)[1]) == {0}  # no toxic text fits: nothing to learn, no crash


def test_one_positive_in_ten_thousand_labels(spark):
    rng = random.Random(21)
    rows = [(i, prose(rng, 8) + (" snarkfit wurgle" if i == 77 else "")) for i in range(10_000)]
    labels = spark.createDataFrame([(i, int(i == 77)) for i, _ in rows], "doc_id long, label int")
    texts, y, weights = toxicity.labelled_sample(frame(spark, rows), labels)
    assert y.sum() == 1 and 3500 <= len(y) <= toxicity.SAMPLE_ROWS and np.isclose(weights.sum(), 10_000)
    s = toxicity.scores(toxicity.fit(texts, y, weights), pa.array([t for _, t in rows[:200]]))
    assert (s[[i for i in range(200) if i != 77]] < toxicity.THRESHOLD).all()


def test_rare_labels_are_learnt_and_long_clean_texts_stay_clean(spark):
    rng = random.Random(22)
    bad = ["wurgle", "snarkfit", "blortish"]
    rows = [(i, prose(rng, 40) + (f" {rng.choice(bad)} {rng.choice(bad)} " + prose(rng, 5) if i % 100 == 0 else "")) for i in range(8000)]
    labels = spark.createDataFrame([(i, int(i % 100 == 0)) for i, _ in rows], "doc_id long, label int")
    texts, y, weights = toxicity.labelled_sample(frame(spark, rows), labels)
    assert y.sum() == 80
    model = toxicity.fit(texts, y, weights)
    toxic = toxicity.scores(model, pa.array([prose(rng, 60) + f" {b} {b}s " + prose(rng, 60) for b in bad]))
    assert (toxic >= toxicity.THRESHOLD).all()
    joined = " ".join(t for i, t in rows if i % 100)  # some 300,000 words
    assert toxicity.scores(model, pa.array([joined, joined[:700_000], prose(rng, 30)], pa.large_string())).max() < toxicity.THRESHOLD


def test_many_items_with_one_preamble_cost_no_pairs(spark):
    rng = random.Random(23)
    preamble = prose(rng, 20)
    items = [(f"i{k:04d}", f"{preamble} {prose(rng, 14)}") for k in range(1500)]
    docs = [(i, f"{prose(rng, 5)} {preamble} unseen {prose(rng, 20)}") for i in range(150)] + [(900, items[7][1]), (901, prose(rng, 60)), (902, None)]
    bench = spark.createDataFrame(items, "item_id string, text string")
    for block_bytes in (decontamination.BLOCK_BYTES, 60_000):
        found = decontamination.find_contamination(frame(spark, docs), bench, matches=False, block_bytes=block_bytes).collect()
        assert all(r.n_items == 1500 and r.n_hit == 20 and r.item_ids == [i for i, _ in items] for r in found if r.doc_id < 150)
        by = {r.doc_id: r for r in found}
        assert (by[900].n_hit, by[900].contaminated, by[901].n_items, by[902].n_words) == (34, True, 0, 0)
        assert not any(r.matches for r in found)


def test_line_places_of_rows_that_share_an_id(spark):
    rows = [(None, "same long line\nx1"), (None, "same long line\ny2"), (5, "dup line\na"), (5, "dup line\nb")]
    got = line_dedup.dedup_lines(frame(spark, rows).withColumn("__removed", F.lit("mine")).withColumn("__id", F.lit(1)))
    assert got.columns == ["doc_id", "text", "__removed", "__id", "___removed"]
    have = Counter((r.doc_id, r.text) for r in got.collect())
    assert have == _line_dedup_by_hand(rows) and sum("line" in t for _, t in have) == 2
    assert all(r["__removed"] == "mine" for r in got.collect())
    again = line_dedup.dedup_lines(got)
    assert again.columns[-1] == "____removed" and again.count() == 4


def test_every_sequence_lies_at_its_slot(spark):
    rng = random.Random(24)
    rows = [(i, prose(rng, rng.randrange(1, 300))) for i in range(120)]
    out = shards.training_shards(frame(spark, rows).coalesce(1), tokens.default_path(), length=32, sequences=8, key=5).orderBy("shard").collect()
    tok = tokens.word_tokenizer(tokens.default_path(), special=True)
    stream = b"".join(np.frombuffer(tok.ids(t), "<u4").astype("<u2").tobytes() + np.array([shards.END_ID], "<u2").tobytes() for _, t in rows)
    n = -(-len(stream) // 64)
    stream += np.full((n * 64 - len(stream)) // 2, shards.PAD_ID, "<u2").tobytes()
    slots = shards.feistel(np.arange(n), n, 5)
    want = [b""] * n
    for i, s in enumerate(slots.tolist()):
        want[s] = stream[64 * i:64 * i + 64]
    assert b"".join(bytes(r.payload) for r in out) == b"".join(want)


# ---- token shards -------------------------------------------------------

@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000, 4097])
def test_feistel_is_a_permutation(n):
    out = shards.feistel(np.arange(n), n)
    assert sorted(out.tolist()) == list(range(n))
    if n > 100:
        assert (shards.feistel(np.arange(n), n, key=1) != out).any() and (out != np.arange(n)).mean() > .9


def test_shards_round_trip_and_resume(spark, edge_rows, tmp_path):
    rng = random.Random(13)
    rows = list(edge_rows) + [(100 + i, prose(rng, rng.randrange(1, 200))) for i in range(80)]
    docs = frame(spark, rows).withColumn("slot", F.lit("clash")).withColumn("ids", F.lit(1)).repartition(3)
    out = shards.training_shards(docs, tokens.default_path(), length=64, sequences=8)
    path = str(tmp_path / "shards")
    shards.write_shards(out, path)
    back = spark.read.parquet(path).orderBy("shard").collect()
    total = sum(r.sequences for r in back)
    assert [r.first_slot for r in back] == list(range(0, total, 8)) and all(r.sequences == 8 for r in back[:-1])
    assert all(len(r.payload) == r.sequences * r.stride == r.sequences * 128 and zlib.crc32(r.payload) == r.payload_crc32 for r in back)
    tok = tokens.word_tokenizer(tokens.default_path())
    want = Counter()
    for _, t in rows:
        want.update(np.frombuffer(tok.ids(t), "<u4").tolist() + [shards.END_ID])
    have = Counter(np.frombuffer(b"".join(r.payload for r in back), "<u2").tolist())
    have.subtract({shards.PAD_ID: total * 64 - sum(r.tokens for r in back)})
    assert {k: v for k, v in have.items() if v} == dict(want)
    whole = b"".join(r.payload for r in back)
    seqs = shards.read_sequences(spark, path, 13, 30, sequences=8).orderBy("slot").collect()
    assert [r.slot for r in seqs] == list(range(13, 30))
    assert b"".join(bytes(r.ids) for r in seqs) == whole[13 * 128:30 * 128]
    assert shards.training_shards(docs.limit(0), tokens.default_path()).count() == 0


# ---- pipeline -----------------------------------------------------------

def test_pipeline_stages_keep_columns_and_take_effect(spark, tmp_path):
    import corpus_pipeline
    rng = random.Random(14)
    item = prose(rng, 30)
    near = prose(rng, 400).split()
    docs = [(i, prose(rng, 60), "en", "s", 0) for i in range(40)]
    docs += [(50, " ".join(near), "en", "s", 0), (51, " ".join(near[:200] + ["new", "words"] + near[201:]), "en", "s", 0), (52, prose(rng, 20) + " " + item, "en", "s", 0),
             (53, prose(rng, 40) + "\nshared line of text that goes on", "en", "s", 0), (54, "shared line of text that goes on\n" + prose(rng, 40), "en", "s", 0),
             (55, None, None, None, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").withColumn("score", F.lit("extra"))
    df.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    cur = spark.read.parquet(str(tmp_path / "documents.parquet"))
    columns, ids = cur.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, cur, str(tmp_path))
        assert out.columns == columns, name
        cur = common.materialize(out)
        ids[name] = {r.doc_id for r in cur.collect()}
        if name == "toxicity":  # without labels nothing is learnt and nothing rejected
            assert ids[name] == {d[0] for d in docs}
        if name == "line_dedup":
            text = {r.doc_id: r for r in cur.collect()}
            assert "shared line" in text[53].text and "shared line" not in text[54].text and text[54].n_chars == len(text[54].text)
    assert {d[0] for d in docs} == ids["line_dedup"]
    assert len(ids["simhash_near_dedup"]) < len(ids["line_dedup"]) and 50 in ids["simhash_near_dedup"]
    assert ids["simhash_near_dedup"] - ids["benchmark_decontamination"] == {52}
    packed = corpus_pipeline.STAGES[-1][1](spark, cur, str(tmp_path))
    assert {r.doc_id for r in packed.select("doc_id").collect()} == ids["benchmark_decontamination"]


def test_oracle_sql_names_registered_queries():
    from smartmaint.llm import queries
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES) and "pipeline" in queries.QUERIES
    assert sorted(int(q[2:].split("_")[0]) for q in queries.QUERIES if q.startswith("op")) == list(range(1, 14))
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")
