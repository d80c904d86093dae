"""Operators 11 to 13 against brute force, with nulls, ties, repeated rows, empty tables and clashing names."""

from __future__ import annotations

import hashlib
import random
import re
import struct

import pytest
import xxhash
from pyspark.sql import functions as F

from smartmaint.llm import conversation_repair as cr
from smartmaint.llm import fingerprints as fp
from smartmaint.llm import merkle

# --- operator 11 ---------------------------------------------------------------------------------------------------

STEP = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def faults_of(rows):
    seen, out = set(), []
    for role, text in rows:
        bare = text.rstrip(" \t\n\v\f\r")
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def brute_repair(rows):
    """(cost, audit, lines) of the cheapest repair with the least audit, by trying every edit from every state."""
    faults = faults_of(rows)
    memo = {}

    def best(i, q, inserts):
        if (i, q, inserts) in memo:
            return memo[i, q, inserts]
        found = [(0, "", ())] if i == len(rows) and q in ("", "a") else []
        if inserts < 3:
            for name in ("user", "assistant"):
                if (q, name[0]) in STEP:
                    c, a, t = best(i, STEP[q, name[0]], inserts + 1)
                    found.append((c + 5, "I" + a, (name + ":", *t)))
        if i < len(rows):
            role, text = rows[i]
            c, a, t = best(i + 1, q, 0)
            found.append((c + 2, "D" + a, t))
            if faults[i] not in ("blank", "duplicate"):
                more = 5 * (faults[i] == "truncated")
                for label, cost, name in (("K", 0, role), ("R", 1, "user"), ("R", 1, "assistant")):
                    if (q, name[:1]) in STEP:
                        c, a, t = best(i + 1, STEP[q, name[:1]], 0)
                        found.append((c + cost + more, label + a, (f"{name}:{text}", *t)))
        memo[i, q, inserts] = min(found, default=(10 ** 6, "~", ()))
        return memo[i, q, inserts]

    return best(0, "", 0)


def random_conversations(seed, n):
    rng = random.Random(seed)
    texts = ["", " ", "Yes.", "No!", "And then", "Why?", "Fine. ", "half a"]
    rows = []
    for conv in [None, *range(n)]:
        for turn in range(rng.randint(1, 12)):
            rows.append((conv, None if rng.random() < 0.05 else turn, rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""]),
                         rng.choice([*texts, f"Turn {turn}.", f"Turn {turn}.", f"Turn {turn}", None]), "x"))
    return rows


@pytest.mark.parametrize("segment", [2, 3, 4096])
def test_repair_equals_brute_force(spark, segment):
    rows = random_conversations(segment, 25)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, no string")
    fixed = cr.repair_conversations(df, segment=segment)
    order = {}
    for r in fixed.rows.collect():
        order.setdefault(r["conv_id"], []).append((r["no"], r["turn"], r["role"], r["text"]))
    assert sum(map(len, order.values())) == len(rows)
    got = {}
    for r in fixed.repaired().orderBy("segment", "step").collect():
        got.setdefault(r["conv_id"], []).append(r)
    marks = {}
    for r in fixed.faults.orderBy("no").collect():
        marks.setdefault(r["conv_id"], []).append(["", "blank", "duplicate", "truncated"][r["fault"]])
    for conv, placed in order.items():
        placed.sort()
        assert [p[0] for p in placed] == list(range(len(placed)))
        turns = [p[1] if p[1] is not None else -1 for p in placed]
        assert turns == sorted(turns)
        plain = [(p[2], p[3]) for p in placed]
        assert marks[conv] == faults_of(plain)
        cost, audit, lines = brute_repair(plain)
        edits = got[conv]
        assert "".join(e["edit"] for e in edits) == audit
        assert sum(e["cost"] for e in edits) == cost
        assert tuple(f"{e['role']}:{e['text']}" for e in edits if e["edit"] != "D") == lines
        assert re.fullmatch("(s?(ua)+)?", "".join(e["role"][0] for e in edits if e["edit"] != "D"))


def test_repair_of_one_long_conversation_crosses_segments(spark):
    rng = random.Random(5)
    rows = [(1, t, rng.choice(["user", "assistant", "system"]), rng.choice([f"Say {t}.", f"Say {t}", ""])) for t in range(150)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    edits = cr.repair_conversations(df, segment=4).repaired().orderBy("segment", "step").collect()
    cost, audit, lines = brute_repair([(r, x) for _, _, r, x in rows])
    assert "".join(e["edit"] for e in edits) == audit and sum(e["cost"] for e in edits) == cost
    assert tuple(f"{e['role']}:{e['text']}" for e in edits if e["edit"] != "D") == lines


def test_repair_of_nothing(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert cr.repair_conversations(df).edits.count() == 0


def test_query_returns_conversations_without_rows(spark, tmp_path):
    import zlib
    lost = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows = [(lost, 0, "user", "Gone."), (None, None, None, None), (7, 1, "user", "Hello."), (7, 4, "assistant", "Yes.")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r["conv_id"]: r for r in cr.op11_conversation_repair(spark, str(tmp_path)).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    assert (got[lost]["audit"], got[lost]["cost"], got[lost]["repaired_sha256"]) == ("", 0, empty)
    assert set(got) == {lost, None, 7} and got[None]["gaps"] == 0


# --- operator 12 ---------------------------------------------------------------------------------------------------


def h(*hexes):
    return hashlib.sha256("".join(hexes).encode()).hexdigest()


def brute_tree(leaves):
    """Root and each leaf's siblings of a binary tree over hex digests."""
    proofs, level, where = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for leaf, i in enumerate(where):
            if i ^ 1 < len(level):
                proofs[leaf].append(level[i ^ 1])
        level = [h(*level[i:i + 2]) for i in range(0, len(level), 2)]
        where = [i // 2 for i in where]
    return level[0], proofs


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 13, 31, 64])
def test_log_is_in_postorder_and_places_are_closed_form(n):
    leaves = [hashlib.sha256(bytes([i])).digest() for i in range(n)]
    levels = (n - 1).bit_length()
    log = merkle.append_log(leaves, levels)
    assert len(log) == merkle.subtree_size(n, levels)
    row = leaves
    for level in range(levels + 1):
        assert [log[merkle.place(level, i, n)] for i in range(len(row))] == row
        row = [merkle.parent(*row[i:i + 2]) for i in range(0, len(row), 2)]
    assert log[-1].hex() == brute_tree([x.hex() for x in leaves])[0]


@pytest.mark.parametrize("bits", [1, 2, 10])
def test_manifest_equals_brute_force(spark, bits):
    rng = random.Random(bits)
    rows = [(rng.choice([None, *range(-5, 60)]), rng.choice(["a", "b", None]), rng.choice([None, "en", "de", "é", ""]),
             rng.choice([None, 3, 12345678901]), rng.choice([None, "", "tëxt", f"t{i}"]), i) for i in range(70)]
    rows += [(4, "a", "en", 3, "same", 0)] * 3
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string, no int").repartition(5)
    got = merkle.proofs(merkle.merkle_manifest(df, bits=bits, keep={"no": F.col("no")}))
    got = got.withColumn("folded", merkle.folded_root(F.col("leaf"), F.col("proof"))).withColumn("ph", merkle.proof_hash(F.col("proof"))).collect()

    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def leaf(r):
        return h(*(field(v) for v in (r[0], r[1], r[2], r[3], r[4])))

    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        own = sorted(((r[0] is not None, r[0] or 0, leaf(r)) for r in rows if r[2] == lang))
        trees[lang] = (own, *brute_tree([x[2] for x in own]))
    root, up = brute_tree([trees[x][1] for x in langs])
    want = []
    for lang, path in zip(langs, up):
        own, subroot, proofs = trees[lang]
        for (known, doc, digest), p in zip(own, proofs):
            want.append((doc if known else None, digest, subroot, root, h(*p, *path)))
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(((r["id"], r["leaf"], r["subroot"], r["root"], r["ph"]) for r in got), key=key) == sorted(want, key=key)
    assert all(r["folded"] == root for r in got)


def test_manifest_finds_tampering_and_takes_an_empty_table(spark, tmp_path):
    rows = [(i, "s", "en", 10 * i, f"text {i}") for i in range(60)] + [(None, None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    import zlib
    for r in merkle.op12_merkle_manifest(spark, str(tmp_path)).collect():
        touched = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
        assert r["verified"] == (not touched) and (r["folded_root"] == r["root"]) == (not touched)
    assert merkle.proofs(merkle.merkle_manifest(df.limit(0))).count() == 0


# --- operator 13 ---------------------------------------------------------------------------------------------------


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def brute_fingerprint(text):
    """Packed hexadecimal fingerprint by plain loops over bins."""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text)) if w]
    hashed = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]

    def chain(ws):
        v = 42
        for w in ws:
            v = xxhash.xxh64_intdigest(struct.pack("<Q", w), v)
        return v

    shingles = [chain(hashed[i:i + 5]) for i in range(len(hashed) - 4)] if len(hashed) >= 5 else [chain(hashed)]
    bins = {}
    for x in map(signed, shingles):
        j, low = (x >> 56) + 128, x & ((1 << 56) - 1)
        bins[j] = min(bins.get(j, 1 << 60), low)
    out = []
    for j, w in enumerate(fp._walks()):
        at = j
        t = 0
        while at not in bins:
            at = (w + (w >> 8) * t) & 255
            t += 1
        out.append(bins[at] & 255)
    return bytes(out).hex()


TEXTS = ["", " \n\t", "one", "Two WORDS", "a b c d e", "A b C d E", "ünïcode wörds in a röw ÀB", "x " * 3000, " ".join(f"w{i}" for i in range(2000)), None]


def test_fingerprints_equal_brute_force(spark):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, fingerprint string")
    got = {r["id"]: r["f"] for r in fp.fingerprints(df).select("id", fp.as_text(F.col("fingerprint")).alias("f")).collect()}
    assert got == {i: brute_fingerprint(t or "") for i, t in enumerate(TEXTS)}
    assert got[4] == got[5] and got[0] == got[1] == got[9]
    assert fp.fingerprints(df.limit(0)).count() == 0


def test_walks_meet_every_bin():
    for w in fp._walks():
        assert len({(w + (w >> fp.BIN_BITS) * t) & (fp.BINS - 1) for t in range(fp.BINS)}) == fp.BINS


def test_likeness_is_unbiased(spark):
    rng = random.Random(3)
    rows = []
    for i in range(200):
        words = [f"w{rng.randrange(10 ** 6)}" for _ in range(rng.choice([40, 150, 600]))]
        other = list(words)
        for _ in range(int(len(words) * i / 2000)):
            other[rng.randrange(len(words))] = f"v{rng.randrange(10 ** 6)}"
        a, b = ({tuple(x[k:k + 5]) for k in range(len(x) - 4)} for x in (words, other))
        rows.append((" ".join(words), " ".join(other), len(a & b) / len(a | b)))
    df = spark.createDataFrame(rows, "a string, b string, j double")
    df = fp.with_fingerprint(fp.with_fingerprint(df, F.col("a"), "fa"), F.col("b"), "fb")
    r = df.select((fp.likeness(F.col("fa"), F.col("fb")) - F.col("j")).alias("e")).agg(F.avg("e"), F.stddev("e"), F.max(F.abs("e"))).first()
    assert abs(r[0]) < 0.01 and r[1] < 0.04 and r[2] < 0.15


def test_edited_texts_and_neighbours(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, "Two WORDS"), (None, "null id one two three four"), (None, None), (2, "other text of id two")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df.withColumn("next_fp", F.lit(1)).write.parquet(f"{tmp_path}/documents.parquet")
    got = fp.op13_fingerprints(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    chain = sorted({(i is not None, i or 0, t or "") for i, t in rows}, reverse=True)
    ids = [c[:2] for c in chain]
    for k, (known, i, t) in enumerate(chain):
        if ids.count((known, i)) > 1 or ids.count(ids[(k + 1) % len(ids)]) > 1:
            continue  # ties go by a hash
        n = len(t)
        e = t[:n - n // 3] + chain[(k + 1) % len(chain)][2][:n // 3]
        for r in got:
            if r["doc_id"] == (i if known else None):
                assert (r["n_chars"], r["edited_sha256"]) == (n, hashlib.sha256(e.encode()).hexdigest())
                assert (r["fingerprint"], r["edited_fingerprint"]) == (brute_fingerprint(t), brute_fingerprint(e))
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    df.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert fp.op13_fingerprints(spark, f"{tmp_path}/none").count() == 0
