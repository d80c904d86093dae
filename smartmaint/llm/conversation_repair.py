"""Operator 11, conversation structure repair by prefix-doubling path ranking.

A conversation's rows go by turn. A repair edits them, row by row, into roles
that read ``(s?(ua)+)?`` (initials): Keep costs 0, Rerole to user or assistant
1, Delete 2 (the only choice for blank rows and repeats of an earlier role and
text), Insert of an empty user or assistant row 5; a row that stays without an
end mark costs 5 more. Of all cheapest repairs the one with the ASCII-least
audit (the edits' initials in order) is taken.

1. The grammar has four states, so a conversation of n rows has 4 (n + 1)
   nodes. The cost DP gives each node its cheapest cost to the end; an arc is
   optimal if its cost plus its target's is its node's.
2. Nodes are ranked by the least audit of length 1, 2, 4, … that starts in
   them: a rank of length 2k is that of the pair (own rank, rank of the node k
   edits on). An initial fixes an arc's target, so one pointer a node will do.
3. Ranks select each node's arc (initial, then rank of its target), and
   doubled pointers read the whole least path off at once.

A long conversation is cut into segments of ``SEGMENT`` rows, dealt to tasks
by (conversation, segment). Segments are tied together by two scans with
doubling strides over short rows: (min, +) products of their 4 x 4 cost
matrices give the costs behind each segment, compositions of their state maps
the state in which the least path enters it. So no task holds more than some
segments' short rows; texts are only joined to the finished edits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from smartmaint.llm.common import materialize, numbered, table
from smartmaint.llm.line_dedup import small

SEGMENT = 4096
CHUNK = 16_384  # rows that are solved together, whole segments
DELETE, REROLE, INSERT, OPEN_END = 2, 1, 5, 5
INF = 1 << 40
ZERO, S, U, A = range(4)  # grammar states: nothing yet, after system, after user, after assistant
FINAL = (0, 2 * INSERT, INSERT, 0)  # cheapest ends behind the last row
# state reached by keeping a row of initial none, s, u, a
KEPT = np.array([[-1, S, U, -1], [-1, -1, U, -1], [-1, -1, -1, A], [-1, -1, U, -1]])
OTHER = np.array([U, U, A, U])  # state reached by a rerole or an insert
EDITS = np.array(["", "D", "I", "K", "R"])
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
SPACES = " \t\n\v\f\r"


@dataclass
class Segments:
    """Rows of whole segments: initial (0 none, 1 s, 2 u, 3 a), fault; first row and length of each segment."""
    initial: np.ndarray
    fault: np.ndarray
    first: np.ndarray
    length: np.ndarray
    last: np.ndarray  # the conversation ends with it

    def __post_init__(self):
        self.forced = (self.fault == BLANK) | (self.fault == DUPLICATE)
        self.extra = np.where(self.fault == TRUNCATED, OPEN_END, 0)
        self.end = self.first + self.length + np.arange(len(self.first))  # place behind each segment's rows
        self.row_at = np.arange(len(self.initial)) + np.repeat(np.arange(len(self.first)), self.length)


def cost_to_go(seg: Segments, behind: np.ndarray) -> np.ndarray:
    """Cheapest cost from each (place, state) to the end, given those behind each segment."""
    togo = np.empty((len(seg.initial) + len(seg.first), 4), np.int64)
    togo[seg.end] = behind
    order = np.argsort(-seg.length, kind="stable")
    lengths = -seg.length[order]
    for t in range(1, int(seg.length.max(initial=0)) + 1):
        on = order[:np.searchsorted(lengths, -t, "right")]
        at = seg.end[on] - t
        row = at - on
        after = togo[at + 1]
        best = after + DELETE
        kept = KEPT[:, seg.initial[row]].T
        keep = np.where(kept >= 0, np.take_along_axis(after, np.maximum(kept, 0), 1), INF) + seg.extra[row][:, None]
        rerole = after[:, OTHER] + REROLE + seg.extra[row][:, None]
        best = np.where(seg.forced[row][:, None], best, np.minimum(best, np.minimum(keep, rerole)))
        u, a = np.minimum(best[:, U], best[:, A] + INSERT), np.minimum(best[:, A], best[:, U] + INSERT)
        best[:, U], best[:, A] = u, a
        best[:, ZERO] = np.minimum(best[:, ZERO], u + INSERT)
        best[:, S] = np.minimum(best[:, S], u + INSERT)
        togo[at] = np.minimum(best, INF)
    return togo


def optimal_arcs(seg: Segments, togo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each node (4 * place + state) and edit D, I, K, R: whether it is optimal, and the node it leads to."""
    places = len(togo)
    row = np.full(places, -1)
    row[seg.row_at] = np.arange(len(seg.initial))
    here = row >= 0
    initial, extra = np.where(here, seg.initial[row], 0), np.where(here, seg.extra[row], 0)
    free = here & ~np.where(here, seg.forced[row], False)
    may_insert = here.copy()
    may_insert[seg.end[seg.last]] = True
    at, q = np.arange(places)[:, None], np.arange(4)[None, :]
    ahead = np.minimum(at + 1, places - 1)
    kept = KEPT[:, initial].T
    target = np.stack([ahead * 4 + q, at * 4 + OTHER[q], ahead * 4 + np.maximum(kept, 0), ahead * 4 + OTHER[q] + 0 * at])
    cost = np.stack([np.full((places, 4), DELETE), np.full((places, 4), INSERT), np.repeat(extra[:, None], 4, 1),
                     np.repeat(extra[:, None] + REROLE, 4, 1)])
    allowed = np.stack([np.repeat(here[:, None], 4, 1), np.repeat(may_insert[:, None], 4, 1), free[:, None] & (kept >= 0), np.repeat(free[:, None], 4, 1)])
    best = allowed & (togo.reshape(-1)[target] + cost == togo[None])
    return best.reshape(4, -1), target.reshape(4, -1)


def least_paths(best: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edit (1 to 4 as in ``EDITS``, 0 at an end) and next node on the least optimal path from every node."""
    nodes = np.arange(best.shape[1])
    ends = ~best.any(0)
    label = np.where(ends, 0, best.argmax(0) + 1)
    jump = np.where(ends, nodes, target[np.maximum(label - 1, 0), nodes])
    rank = label
    while (label[jump] > 0).any():  # audits of length 1, 2, 4, …
        rank = np.unique(rank * (int(rank.max()) + 1) + rank[jump], return_inverse=True)[1]
        jump = jump[jump]
    by_rank = np.where(best, np.arange(4)[:, None] * (len(nodes) + 1) + rank[target], 5 * (len(nodes) + 1))
    edit = by_rank.argmin(0)
    return np.where(ends, 0, edit + 1), np.where(ends, nodes, target[edit, nodes])


def walk(edit: np.ndarray, after: np.ndarray, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Nodes with an edit on the paths from the entries, by doubled pointers: entry's number, step, node; and each path's last node."""
    jumps, depth = [after], (edit > 0).astype(np.int64)
    while (edit[jumps[-1]] > 0).any():
        depth = depth + depth[jumps[-1]]
        jumps.append(jumps[-1][jumps[-1]])
    who, step, node = np.arange(len(entry)), np.zeros(len(entry), np.int64), entry
    for k in reversed(range(len(jumps))):
        far = depth[node] > 1 << k
        who, step, node = (np.concatenate((x, y)) for x, y in ((who, who[far]), (step, step[far] + (1 << k)), (node, jumps[k][node[far]])))
    real = edit[node] > 0
    order = np.lexsort((step[real], who[real]))
    return who[real][order], step[real][order], node[real][order], jumps[-1][entry]


def _chunks(batches: Iterator[pa.RecordBatch], segment: int) -> Iterator[tuple[pa.Table, Segments]]:
    """Whole segments of a sorted partition, some ``CHUNK`` rows at a time."""
    held: list[pa.RecordBatch] = []

    def solved(t: pa.Table) -> tuple[pa.Table, Segments]:
        col = {c: t.column(c).to_numpy() for c in ("no", "initial", "fault", "total")}
        first = np.flatnonzero(col["no"] % segment == 0)
        length = np.diff(np.append(first, t.num_rows))
        last = (col["total"][first] <= segment) | (col["no"][first] + segment >= col["total"][first])
        return t, Segments(col["initial"].astype(int), col["fault"].astype(int), first, length, last)

    for b in batches:
        starts = np.flatnonzero(b.column("no").to_numpy(zero_copy_only=False) % segment == 0)
        cut = int(starts[-1]) if len(starts) else 0
        if len(starts) and sum(x.num_rows for x in held) + cut >= CHUNK:
            t = pa.Table.from_batches([*held, b.slice(0, cut)])
            if t.num_rows:
                yield solved(t.combine_chunks())
            held = [b.slice(cut)]
        else:
            held.append(b)
    if held and (t := pa.Table.from_batches(held)).num_rows:
        yield solved(t.combine_chunks())


def _ids(t: pa.Table, seg: Segments) -> list[pa.Array]:
    at = pa.array(seg.first)
    return [t.column("conv_id").combine_chunks().take(at), t.column("segment").combine_chunks().take(at)]


def _behind(t: pa.Table, seg: Segments) -> np.ndarray:
    given = t.column("behind").combine_chunks().take(pa.array(seg.first)).to_pylist()
    return np.array([v or FINAL for v in given], np.int64).reshape(-1, 4)


def _matrices(batches: Iterator[pa.RecordBatch], segment: int) -> Iterator[pa.RecordBatch]:
    """Cheapest cost of each segment from each state to each state."""
    for t, seg in _chunks(batches, segment):
        cols = []
        for q in range(4):
            unit = np.full((len(seg.first), 4), INF)
            unit[:, q] = 0
            cols.append(cost_to_go(seg, unit)[seg.first + np.arange(len(seg.first))])
        m = np.stack(cols, 2).reshape(len(seg.first), 16)  # from state, to state
        yield pa.RecordBatch.from_arrays([*_ids(t, seg), pa.array(m.tolist(), pa.list_(pa.int64()))], names=["conv_id", "segment", "m"])


def _solve(t: pa.Table, seg: Segments) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    togo = cost_to_go(seg, _behind(t, seg))
    return togo, *least_paths(*optimal_arcs(seg, togo))


def _maps(batches: Iterator[pa.RecordBatch], segment: int) -> Iterator[pa.RecordBatch]:
    """State in which the least path leaves each segment, for each state it may enter in."""
    for t, seg in _chunks(batches, segment):
        _, edit, after = _solve(t, seg)
        entry = ((seg.first + np.arange(len(seg.first)))[:, None] * 4 + np.arange(4)).reshape(-1)
        out = (walk(edit, after, entry)[3] % 4).reshape(-1, 4)
        yield pa.RecordBatch.from_arrays([*_ids(t, seg), pa.array(out.tolist(), pa.list_(pa.int32()))], names=["conv_id", "segment", "f"])


def _edits(batches: Iterator[pa.RecordBatch], segment: int) -> Iterator[pa.RecordBatch]:
    for t, seg in _chunks(batches, segment):
        _, edit, after = _solve(t, seg)
        enter = np.array([v or 0 for v in t.column("enter").combine_chunks().take(pa.array(seg.first)).to_pylist()], np.int64)
        who, step, node, _ = walk(edit, after, (seg.first + np.arange(len(seg.first))) * 4 + enter)
        row = node // 4 - who
        kind = edit[node]
        inserted = kind == 2
        extra = np.where(inserted, 0, seg.extra[np.minimum(row, len(seg.extra) - 1)])
        cost = np.select([kind == 1, inserted, kind == 3], [DELETE, INSERT, extra], REROLE + extra)
        role = np.where(after[node] % 4 == U, "user", "assistant")
        conv, segment_no = (c.take(pa.array(who)) for c in _ids(t, seg))
        no = t.column("no").to_numpy()[np.minimum(row, len(seg.extra) - 1)]
        yield pa.RecordBatch.from_arrays(
            [conv, segment_no, pa.array(step), pa.array(EDITS[kind].tolist(), pa.string()), pa.array(no, mask=inserted),
             pa.array(role.tolist(), pa.string(), mask=(kind == 1) | (kind == 3)), pa.array(cost, pa.int64())],
            names=["conv_id", "segment", "step", "edit", "no", "role", "cost"])


def _scan(rows: DataFrame, value: str, combine, step: int) -> DataFrame:
    """``value`` of each segment combined with those of all segments after (step 1) or before (step -1) it, in doubling strides."""
    far = rows.agg(F.max("segment")).first()[0] or 0
    stride = 1
    while stride <= far:
        other = rows.select(F.col("conv_id").alias("__conv"), (F.col("segment") - step * stride).alias("__segment"), F.col(value).alias("__value"))
        met = rows.join(other, rows["conv_id"].eqNullSafe(other["__conv"]) & (F.col("segment") == F.col("__segment")), "left")
        rows = materialize(met.select(rows["conv_id"], "segment", F.when(F.col("__value").isNull(), F.col(value)).otherwise(
            combine(F.col(value), F.col("__value"))).alias(value)))
        stride *= 2
    return rows


def _product(a: Column, b: Column) -> Column:
    """(min, +) product of two 4 x 4 matrices in row order."""
    return F.array(*[F.least(F.lit(INF), *[F.get(a, F.lit(4 * i + k)) + F.get(b, F.lit(4 * k + j)) for k in range(4)])
                     for i in range(4) for j in range(4)])


def classified(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, no, total, initial, fault) of numbered rows (conv_id, turn, role, text, no, total)."""
    bare = F.rtrim("text", F.lit(SPACES))
    first = F.substring("role", 1, 1)
    code = F.when(first == "s", 1).when(first == "u", 2).when(first == "a", 3).otherwise(0)
    short = rows.select("conv_id", "turn", "no", "total", first.alias("letter"), code.cast("byte").alias("initial"), (bare == "").alias("blank"),
                        F.right(bare, F.lit(1)).isin(".", "!", "?").alias("ended"),
                        F.xxhash64("conv_id", "role", "text").alias("h1"), F.xxhash64(F.lit(7), "conv_id", "role", "text").alias("h2"))
    again = small(materialize(short.filter(~F.col("blank")).groupBy("h1", "h2").agg(F.min("no").alias("seen"), F.count("*").alias("n"))
                              .filter("n > 1").drop("n")))
    fault = F.when(F.col("blank"), BLANK).when(F.col("no") > F.col("seen"), DUPLICATE).when(~F.col("ended"), TRUNCATED).otherwise(0)
    return materialize(short.join(again, ["h1", "h2"], "left").select("conv_id", "turn", "no", "total", "letter", "initial",
                                                                     fault.cast("byte").alias("fault")))


@dataclass
class Repair:
    """``rows``: numbered (conv_id, turn, role, text, no, total); ``faults``: their short form with ``fault``
    (0 none, 1 blank, 2 duplicate, 3 truncated); ``edits``: (conv_id, segment, step, edit, no, role, cost) in the
    order (segment, step), ``no`` null for inserts, ``role`` where an edit sets one."""
    rows: DataFrame
    faults: DataFrame
    edits: DataFrame

    def repaired(self) -> DataFrame:
        """``edits`` with ``role`` and ``text`` of the row that stays (for deleted ones: of the row that goes)."""
        r = self.rows.select(F.col("conv_id").alias("__conv"), F.col("no").alias("__no"), F.col("role").alias("__role"), "text")
        e = self.edits
        met = e.join(r, e["conv_id"].eqNullSafe(r["__conv"]) & (e["no"] == r["__no"]), "left")
        return met.select(*[e[c] for c in e.columns if c != "role"], F.coalesce(e["role"], "__role").alias("role"),
                          F.coalesce("text", F.lit("")).alias("text"))


def repair_conversations(turns: DataFrame, segment: int = SEGMENT) -> Repair:
    """Cheapest repair of every conversation (columns conv_id, turn, role, text; others are ignored).

    Rows go by turn (nulls first), ties by role and a hash of the text, so
    repeated rows are rows of their own (and duplicates). Null roles and texts
    count as one space: such a row has no legal initial, such a text is blank.
    A null id is a conversation. Roles are told by their first character.
    An empty table gives empty results.
    """
    space = F.lit(" ")
    src = turns.select(turns["conv_id"].alias("conv_id"), turns["turn"].alias("turn"), F.coalesce(turns["role"].cast("string"), space).alias("role"),
                       F.coalesce(turns["text"].cast("string"), space).alias("text")).withColumn("th", F.xxhash64("text"))
    rows = numbered(src, ["turn", "role", "th"], over=segment).drop("th")
    faults = classified(rows)
    own = F.floor(F.col("no") / segment).alias("segment")
    short = faults.select("conv_id", own, "no", "total", "initial", "fault")
    long = F.col("total") > segment
    kind = dict(turns.dtypes)["conv_id"]
    deal = lambda df: df.repartition("conv_id", "segment").sortWithinPartitions("conv_id", "segment", "no")
    unknown = F.lit(None).cast("array<long>").alias("behind")
    if not short.filter(long).isEmpty():
        many = materialize(short.filter(long))
        m = materialize(deal(many.select("*", unknown)).mapInArrow(lambda b: _matrices(b, segment), f"conv_id {kind}, segment long, m array<long>"))
        # costs from the start of each segment to the end of the conversation
        start = _scan(m, "m", _product, 1).select("conv_id", "segment", F.array(*[
            F.least(*[F.get("m", F.lit(4 * i + k)) + FINAL[k] for k in range(4)]) for i in range(4)]).alias("behind"))
        start = start.select(F.col("conv_id").alias("__conv"), (F.col("segment") - 1).alias("__segment"), "behind")
        start = small(materialize(start))
        many = many.join(start, many["conv_id"].eqNullSafe(start["__conv"]) & (many["segment"] == start["__segment"]), "left").drop("__conv", "__segment")
        many = materialize(many.select("conv_id", "segment", "no", "total", "initial", "fault", "behind"))
        f = materialize(deal(many).mapInArrow(lambda b: _maps(b, segment), f"conv_id {kind}, segment long, f array<int>"))
        f = _scan(f, "f", lambda own, before: F.transform(before, lambda q: F.get(own, q)), -1)
        enter = small(materialize(f.select(F.col("conv_id").alias("__conv"), (F.col("segment") + 1).alias("__segment"), F.get("f", F.lit(ZERO)).alias("enter"))))
        many = many.join(enter, many["conv_id"].eqNullSafe(enter["__conv"]) & (many["segment"] == enter["__segment"]), "left").drop("__conv", "__segment")
        single = short.filter(~long).select("*", unknown, F.lit(0).alias("enter"))
        short = single.unionByName(many.select(*single.columns))
    else:
        short = short.select("*", unknown, F.lit(0).alias("enter"))
    edits = deal(short).mapInArrow(lambda b: _edits(b, segment),
                                   f"conv_id {kind}, segment long, step long, edit string, no long, role string, cost long")
    return Repair(rows, faults, materialize(edits))


def damaged(turns: DataFrame) -> DataFrame:
    """``conversations`` rows with the contract's damage (nulls: one space)."""
    space = F.lit(" ")
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    hit = F.crc32(key.cast("binary")) % 20
    copies = F.when(hit == 0, 0).when(hit == 3, 2).otherwise(1)
    return turns.select(
        "conv_id", "turn", F.when(hit == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(hit == 1, F.lit("")).when(hit == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.array_repeat(F.lit(1), copies)).alias("copy")).drop("copy")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audit and digest of each conversation; a task streams its rows and holds one conversation's edits (a byte each)."""
    current, audit, digest, any_row = (), bytearray(), hashlib.sha256(), False
    out: list[tuple] = []

    def flush(conv: pa.DataType) -> pa.RecordBatch:
        cols = list(zip(*out)) or [(), (), ()]
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(cols[0], conv), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.string())],
                                          names=["conv_id", "audit", "repaired_sha256"])

    kind = pa.int64()
    for b in batches:
        kind = b.schema.field(0).type
        for conv, edit, role, text in zip(*(c.to_pylist() for c in b.columns)):
            if current != (conv,):
                if current:
                    out.append((*current, audit.decode(), digest.hexdigest()))
                current, audit, digest, any_row = (conv,), bytearray(), hashlib.sha256(), False
            audit += edit.encode()
            if edit != "D":
                digest.update((("\n" if any_row else "") + f"{role}:{text}").encode())
                any_row = True
        yield flush(kind)
    if current:
        out.append((*current, audit.decode(), digest.hexdigest()))
        yield flush(kind)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cost, audit and digest of the repair of every damaged conversation.

    A digest runs over a conversation's texts in order, so one task streams
    each conversation for it; the repair itself is made segment by segment.
    """
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    fixed = repair_conversations(damaged(turns))
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    spans = fixed.faults.groupBy("conv_id").agg(
        (F.max(wide("turn")) - F.min(wide("turn")) + 1 - F.countDistinct("turn")).cast("decimal(38,0)").alias("gaps"),
        *[F.count_if(F.col("fault") == k).alias(c) for c, k in (("blank", BLANK), ("duplicate", DUPLICATE), ("truncated", TRUNCATED))])
    # neighbours meet under the number of the first of them
    pair = F.array(F.struct(F.col("no").alias("at"), F.lit(0).alias("side")), F.struct((F.col("no") - 1).alias("at"), F.lit(1).alias("side")))
    sides = fixed.faults.select("conv_id", "letter", F.explode(pair).alias("p")).select("conv_id", "letter", "p.*")
    pairs = sides.groupBy("conv_id", "at").agg(F.max(F.when(F.col("side") == 0, F.col("letter"))).alias("a"),
                                               F.max(F.when(F.col("side") == 1, F.col("letter"))).alias("b")).filter("a IS NOT NULL AND b IS NOT NULL")
    legal = F.concat("a", "b").isin("su", "ua", "au")
    stream = fixed.repaired().repartition("conv_id").sortWithinPartitions("conv_id", "segment", "step").select("conv_id", "edit", "role", "text")
    kind = dict(turns.dtypes)["conv_id"]
    digests = stream.mapInArrow(_digests, f"conv_id {kind}, audit string, repaired_sha256 string")
    parts = [turns.select("conv_id").distinct(), spans, pairs.groupBy("conv_id").agg(F.count_if(~legal).alias("illegal")),
             fixed.edits.groupBy("conv_id").agg(F.sum("cost").alias("cost")), digests]
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p, allowMissingColumns=True)
    longs = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    top = F.lit((1 << 63) - 1).cast("decimal(38,0)")
    return whole.groupBy("conv_id").agg(
        *[F.least(F.coalesce(F.max(c), F.lit(0)).cast("decimal(38,0)"), top).cast("long").alias(c) for c in longs],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"), F.coalesce(F.max("repaired_sha256"), F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def _oracle() -> str:
    crc = ("xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || "
           "coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda c: CAST(ascii(c) AS BIGINT))), lambda r, c: list_reduce([xor(r, c), 0, 0, 0, 0, 0, 0, 0, 0], "
           "lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 20")
    state = "{{'c': CAST({c} AS BIGINT), 'a': {a}, 't': {t}}}".format
    line = "{role} || ':' || {text} || chr(10) || {q}.t".format

    def step(own: str, kept: list[tuple[str, str]], other: str, role: str) -> str:
        keep = " ".join(f"WHEN initial = '{i}' THEN {state(c=f'{q}.c + extra', a=f"'K' || {q}.a", t=line(role='role', text='text', q=q))}" for i, q in kept)
        rerole = state(c=f"{other}.c + 1 + extra", a=f"'R' || {other}.a", t=line(role=f"'{role}'", text="text", q=other))
        return (f"list_min([{state(c=f'{own}.c + 2', a=f"'D' || {own}.a", t=f'{own}.t')}, CASE WHEN forced THEN NULL {keep} END, "
                f"CASE WHEN NOT forced THEN {rerole} END])")

    def insert(q: str, role: str) -> str:
        return state(c=f"{q}.c + 5", a=f"'I' || {q}.a", t=f"'{role}:' || chr(10) || {q}.t")

    end = {"z": (0, "", ""), "s": (10, "II", "user:\n assistant:\n"), "u": (5, "I", "assistant:\n"), "a": (0, "", "")}
    first = ", ".join(state(c=c, a=f"'{a}'", t="'" + t.replace("\n ", "' || chr(10) || '").replace("\n", "' || chr(10) || '") + "'") + f" AS {q}"
                      for q, (c, a, t) in end.items())
    return f"""
WITH RECURSIVE hit AS (SELECT *, {crc} AS k FROM conversations),
rows0 AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
           CASE WHEN k = 1 THEN '' WHEN k = 2 THEN translate(coalesce(text, ' '), '.!?', '') ELSE coalesce(text, ' ') END AS text,
           unnest(range(CASE WHEN k = 3 THEN 2 ELSE 1 END)) FROM hit WHERE k <> 0),
num AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM rows0),
f AS (SELECT conv_id, turn, role, text, i, role[1] AS initial, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare,
             row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again, lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM num),
d AS (SELECT *, CASE WHEN bare = '' THEN 1 WHEN again THEN 2 WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault FROM f),
e AS (SELECT *, fault IN (1, 2) AS forced, CASE WHEN fault = 3 THEN 5 ELSE 0 END AS extra FROM d),
r AS (
  SELECT conv_id, max(i) AS i, {first} FROM e GROUP BY conv_id
  UNION ALL
  SELECT conv_id, i - 1, list_min([z, {insert('u', 'user')}]), list_min([s, {insert('u', 'user')}]), u, a FROM (
    SELECT conv_id, i, z, s, list_min([u, {insert('a', 'assistant')}]) AS u, list_min([a, {insert('u', 'user')}]) AS a FROM (
      SELECT r.conv_id, r.i, {step('z', [('s', 's'), ('u', 'u')], 'u', 'user')} AS z, {step('s', [('u', 'u')], 'u', 'user')} AS s,
             {step('u', [('a', 'a')], 'a', 'assistant')} AS u, {step('a', [('u', 'u')], 'u', 'user')} AS a
      FROM r JOIN e ON e.conv_id IS NOT DISTINCT FROM r.conv_id AND e.i = r.i))),
best AS (SELECT conv_id, z FROM r WHERE i = 0),
g AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
             count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
             count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM e GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(z.c, 0) AS cost, coalesce(z.a, '') AS audit,
       sha256(coalesce(left(z.t, greatest(length(z.t) - 1, 0)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM c.conv_id"""


ORACLE = _oracle()
