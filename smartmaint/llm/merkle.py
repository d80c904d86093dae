"""Operator 12, a Merkle manifest of a data set as a postorder append log.

Every row is a leaf; per group (null: a group) the leaves ascend by id, and
every 2 consecutive nodes of a level become their parent (a last single one
too) until one remains, the group's subroot. The subroots, in the order of
the groups, are the leaves of one more tree, whose last node is the root.

Aligned builders: a block of 2^BLOCK_BITS leaves that starts at a multiple of
its length is one task's work. The builder appends a node as soon as it is
complete: a leaf when it comes, a parent right after its last child. So nodes
lie in postorder, and the place of a node follows from subtree sizes alone:

    place(level, i) = nodes of the full subtrees to its left + its own subtree - 1

Block roots are the leaves of the next tier's blocks, so a tree of n leaves
has log(n) / BLOCK_BITS tiers and no task ever holds more than a block, however
many rows a group has. A proof reads the siblings of a leaf at their places,
tier by tier; what lies above a block is found once for the whole block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from smartmaint.llm.common import materialize, numbered, table
from smartmaint.llm.line_dedup import small

BLOCK_BITS = 10
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
SEGMENT_SCHEMA = "tree long, block long, total long, leaves int, levels int, nodes binary"
SEGMENTS = pa.schema([("tree", pa.int64()), ("block", pa.int64()), ("total", pa.int64()), ("leaves", pa.int32()), ("levels", pa.int32()),
                      ("nodes", pa.binary())])
FLUSH = 64  # segments in an Arrow batch


def leaf_hash(fields: list[Column]) -> Column:
    """Hex digest of a row: each field as ``-`` if null, else its UTF-8 byte count, a colon and its text (integers: decimal)."""
    texts = [c.cast("string") for c in fields]
    return F.sha2(F.concat(*[F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t))
                             for t in texts]), 256)


def parent(*children: bytes) -> bytes:
    """Digest of the children's hex digests, concatenated."""
    return hashlib.sha256("".join(c.hex() for c in children).encode()).digest()


def append_log(leaves: Iterable[bytes], levels: int) -> list[bytes]:
    """All nodes of the tree of ``levels`` levels above its leaves, in completion order."""
    log: list[bytes] = []
    open_: list[tuple[int, bytes]] = []  # complete nodes that wait for their parent

    def add(level: int, node: bytes) -> None:
        log.append(node)
        open_.append((level, node))

    for leaf in leaves:
        add(0, leaf)
        while len(open_) > 1 and open_[-2][0] == open_[-1][0]:
            (level, left), (_, right) = open_[-2:]
            del open_[-2:]
            add(level + 1, parent(left, right))
    while open_ and (len(open_) > 1 or open_[0][0] < levels):  # the right edge: last runs may hold one node
        level, node = open_.pop()
        left = [open_.pop()[1]] if open_ and open_[-1][0] == level else []
        add(level + 1, parent(*left, node))
    return log


def subtree_size(leaves: int, level: int) -> int:
    """Nodes of a subtree of ``level`` levels above ``leaves`` leaves."""
    return sum(-(-leaves // (1 << k)) for k in range(level + 1))


def place(level: int, i: int, n: int) -> int:
    """Postorder place of node ``i`` of a level in a log of ``n`` leaves."""
    before = i << level
    return 2 * before - before.bit_count() + subtree_size(min(1 << level, n - before), level) - 1


def siblings(i: int, n: int, levels: int) -> list[tuple[str, int]]:
    """For each level above leaf ``i``: the side its sibling stands on (``-``: it has none) and the sibling's place."""
    out = []
    for level in range(levels):
        j = (i >> level) ^ 1
        out.append(("-", -1) if j << level >= n else ("L" if j < i >> level else "R", place(level, j, n)))
    return out


def _build(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """One segment of the log for each aligned block of the leaves (tree, block, no, total, digest), sorted by place."""
    block, leaves, total = None, [], 0
    out: list[tuple] = []

    def done() -> None:
        levels = min(bits, (total - 1).bit_length())
        out.append((*block, total, len(leaves), levels, b"".join(append_log(leaves, levels))))

    def flush() -> pa.RecordBatch:
        cols = list(zip(*out)) or [()] * len(SEGMENTS)
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, SEGMENTS)], schema=SEGMENTS)

    for b in batches:
        for tree, no, n, digest in zip(*(b.column(c).to_pylist() for c in ("tree", "no", "total", "digest"))):
            if block != (tree, no >> bits):
                if leaves:
                    done()
                block, leaves, total = (tree, no >> bits), [], n
                if len(out) >= FLUSH:
                    yield flush()
            leaves.append(digest)
    if leaves:
        done()
    yield flush()


def _path(segment: dict, i: int) -> list[str]:
    """The siblings of leaf ``i`` of a segment, as side and hex digest, then those above the segment."""
    nodes = segment["nodes"]
    own = [side if side == "-" else side + nodes[32 * at:32 * at + 32].hex() for side, at in siblings(i, segment["leaves"], segment["levels"])]
    return own + segment["above"]


@dataclass
class Manifest:
    """``rows``: the leaves (tree, no, total, id, digest, kept columns); ``groups``: (group, tree);
    ``tiers`` and ``top``: log segments (tree, block, leaves, levels, nodes), lowest tier first;
    ``bits``: leaves in a block, as a power of two."""
    rows: DataFrame
    groups: DataFrame
    tiers: list[DataFrame]
    top: list[DataFrame]
    bits: int


def _log(leaves: DataFrame, bits: int) -> list[DataFrame]:
    """Segments of all tiers over ``leaves`` (tree, no, total, digest)."""
    most = leaves.agg(F.max("total")).first()[0] or 0
    tiers = []
    while most:
        blocks = leaves.withColumn("block", F.shiftright("no", bits)).repartition("tree", "block").sortWithinPartitions("tree", "no")
        tiers.append(materialize(blocks.mapInArrow(lambda b: _build(b, bits), SEGMENT_SCHEMA)))
        if most <= 1 << bits:
            break
        most = -(-most // (1 << bits))
        leaves = tiers[-1].select("tree", F.col("block").alias("no"), F.ceil(F.col("total") / (1 << bits)).cast("long").alias("total"),
                                  F.expr("substring(nodes, -32, 32)").alias("digest"))
    return tiers


def merkle_manifest(docs: DataFrame, fields: list[str] | None = None, group_col: str = "lang", id_col: str = "doc_id",
                    keep: dict[str, Column] | None = None, bits: int = BLOCK_BITS) -> Manifest:
    """The manifest of all rows of ``docs``; ``keep`` adds named expressions over ``docs`` to the leaf rows.

    Leaves ascend by id within their group (null ids first); rows equal in id
    go by digest, and wholly equal rows are leaves of their own. Groups go by
    their text's UTF-8 bytes, null first. Fields are strings or integers (others are hashed in
    Spark's text form); null and empty texts differ. Whole texts are hashed, but
    only digests are shuffled. Columns that ``fields`` does not name play no
    part, whatever their names. An empty table has no leaves and no segments.
    """
    cols = [docs[c] for c in (fields or FIELDS)]
    rows = docs.select(docs[group_col].cast("string").alias("grp"), docs[id_col].alias("id"), F.unhex(leaf_hash(cols)).alias("digest"),
                       *[c.alias(f"keep_{k}") for k, c in (keep or {}).items()])
    rows = numbered(rows, ["id", "digest"])
    roots = rows.groupBy("grp").agg(F.max("total").alias("n"))
    groups = materialize(numbered(roots.select(F.lit(0).cast("long").alias("all"), "grp"), ["grp"])
                         .select("grp", F.col("no").alias("tree"), F.col("total").alias("trees")))
    near = small(groups.select(F.col("grp").alias("__grp"), "tree"))
    rows = materialize(rows.join(near, rows["grp"].eqNullSafe(near["__grp"])).drop("grp", "__grp"))
    tiers = _log(rows.select("tree", "no", "total", "digest"), bits)
    if not tiers:
        return Manifest(rows, groups, [], [], bits)
    subroots = _roots(tiers).join(groups, "tree").select(
        F.lit(0).cast("long").alias("tree"), F.col("tree").alias("no"), F.col("trees").alias("total"), "digest")
    return Manifest(rows, groups, tiers, _log(materialize(subroots), bits), bits)


def _roots(tiers: list[DataFrame]) -> DataFrame:
    """(tree, digest): the last node of each tree."""
    return tiers[-1].select("tree", F.expr("substring(nodes, -32, 32)").alias("digest"))


def _leaf_paths(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """A row for each leaf of each segment: the siblings on its way up."""
    for b in batches:
        for k in range(b.num_rows):
            s = b.slice(k, 1).to_pylist()[0]
            n, first = s["leaves"], s["block"] << bits
            yield pa.RecordBatch.from_arrays(
                [pa.array([s["tree"]] * n, pa.int64()), pa.array(range(first, first + n), pa.int64()),
                 pa.array([_path(s, i) for i in range(n)], pa.list_(pa.string())),
                 *[pa.array([s[c]] * n, pa.string()) for c in ("subroot", "root")]],
                names=["tree", "block", "above", "subroot", "root"])


def _descend(tiers: list[DataFrame], above: DataFrame, bits: int) -> DataFrame:
    """Paths above the blocks of the lowest tier, from those above the highest one's (tree, block, above, subroot, root)."""
    schema = "tree long, block long, above array<string>, subroot string, root string"
    for segments in reversed(tiers[1:]):
        above = materialize(segments.join(above, ["tree", "block"]).mapInArrow(lambda b: _leaf_paths(b, bits), schema))
    return above


def _extract(batches: Iterator[pa.RecordBatch], kept: list[str], bits: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    """Proofs of the leaves that follow each segment's row in a sorted partition."""
    segment = None
    for b in batches:
        leaf, paths, subroots, roots = [], [], [], []
        whole = b.column("segment")
        for at, (no, digest) in enumerate(zip(b.column("no").to_pylist(), b.column("digest").to_pylist())):
            if no is None:
                segment = whole[at].as_py()
            else:
                leaf.append(at)
                paths.append(_path(segment, no - (segment["block"] << bits)))
                subroots.append(segment["subroot"])
                roots.append(segment["root"])
        rows = b.take(pa.array(leaf, pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [rows.column("id"), *[rows.column(c) for c in kept], pa.array([d.hex() for d in rows.column("digest").to_pylist()], pa.string()),
             pa.array(paths, pa.list_(pa.string())), pa.array(subroots, pa.string()), pa.array(roots, pa.string())], names=names)


def proofs(manifest: Manifest) -> DataFrame:
    """One row per leaf: ``id``, the kept columns, ``leaf``, ``proof``, ``subroot`` and ``root`` (hex digests).

    ``proof`` lists one entry a level, from the leaf to the root: ``L`` or ``R`` (where the sibling
    stands) and the sibling's digest, or ``-`` where a node has none.
    An empty manifest gives no rows.
    """
    rows, bits = manifest.rows, manifest.bits
    kept = [c for c in rows.columns if c.startswith("keep_")]
    types = dict(rows.dtypes)
    schema = ", ".join(["id " + types["id"], *[f"{c} {types[c]}" for c in kept]]) + \
        ", leaf string, proof array<string>, subroot string, root string"
    if not manifest.tiers:
        return rows.select("id", *kept, F.hex("digest").alias("leaf"), F.array().cast("array<string>").alias("proof"),
                           F.lit("").alias("subroot"), F.lit("").alias("root"))
    root = _roots(manifest.top).select("tree", F.lit(0).cast("long").alias("block"), F.array().cast("array<string>").alias("above"),
                                       F.lit("").alias("subroot"), F.lower(F.hex("digest")).alias("root"))
    # the paths of the top tree's leaves stand above the group trees' roots
    top = _descend([None, *manifest.top], root, bits).select(F.col("block").alias("tree"), "above", "root")
    start = _roots(manifest.tiers).join(top, "tree").select(
        "tree", F.lit(0).cast("long").alias("block"), "above", F.lower(F.hex("digest")).alias("subroot"), "root")
    above = _descend(manifest.tiers, start, bits)
    segments = manifest.tiers[0].join(above, ["tree", "block"]).select(
        "tree", "block", F.struct("block", "leaves", "levels", "nodes", "above", "subroot", "root").alias("segment"))
    # a segment, then its leaves: one partition streams them, a batch and a segment at a time
    both = rows.withColumn("block", F.shiftright("no", bits)).unionByName(segments, allowMissingColumns=True)
    dealt = both.repartition("tree", "block").sortWithinPartitions("tree", "block", F.col("no").asc_nulls_first())
    names = ["id", *kept, "leaf", "proof", "subroot", "root"]
    return dealt.mapInArrow(lambda b: _extract(b, kept, bits, names), schema)


def folded_root(leaf: Column, proof: Column) -> Column:
    """The root that a leaf's hex digest and a proof lead to."""
    def up(node: Column, s: Column) -> Column:
        other = F.substring(s, 2, 64)
        return F.sha2(F.when(s.startswith("L"), F.concat(other, node)).when(s.startswith("R"), F.concat(node, other)).otherwise(node), 256)
    return F.aggregate(proof, leaf, up)


def proof_hash(proof: Column) -> Column:
    """Digest of a proof's siblings, level by level."""
    return F.sha2(F.array_join(F.transform(F.filter(proof, lambda s: s != "-"), lambda s: F.substring(s, 2, 64)), ""), 256)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document, and the root that its (tampered) leaf folds to."""
    docs = table(spark, sf_dir, "documents")
    more = (docs["n_chars"].cast("decimal(20,0)") + 1).alias("n_chars")
    tampered = F.crc32(docs["doc_id"].cast("string").cast("binary")) % 7 == 0
    changed = F.when(tampered, F.unhex(leaf_hash([more if c == "n_chars" else docs[c] for c in FIELDS])))
    rows = proofs(merkle_manifest(docs.select(*FIELDS), keep={"changed": changed}))
    shown = F.coalesce(F.lower(F.hex("keep_changed")), F.col("leaf"))
    out = rows.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", proof_hash(F.col("proof")).alias("proof_sha256"),
                      folded_root(shown, F.col("proof")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def _oracle() -> str:
    field = "CASE WHEN {c} IS NULL THEN '-' ELSE strlen({v}) || ':' || {v} END"
    parts = {c: field.format(c=c, v=f"CAST({c} AS VARCHAR)") for c in FIELDS}
    leaf = " || ".join(parts.values())
    more = " || ".join((parts | {"n_chars": field.format(c="n_chars", v="CAST(CAST(n_chars AS HUGEINT) + 1 AS VARCHAR)")}).values())
    # crc32, bit by bit, over the bytes of the decimal id
    crc = ("xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), "
           "lambda c: CAST(ascii(c) AS BIGINT))), lambda r, c: list_reduce([xor(r, c), 0, 0, 0, 0, 0, 0, 0, 0], "
           "lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)")
    levels = """WITH RECURSIVE {n}(grp, lvl, i, h) AS (
      {base}
      UNION ALL
      SELECT grp, min(lvl) + 1, i // 2, sha256(string_agg(h, '' ORDER BY i))
      FROM (SELECT *, count(*) OVER (PARTITION BY grp) AS n FROM {n}) WHERE n > 1 GROUP BY grp, i // 2)"""
    walk = """SELECT l.{key}, list(CASE WHEN s.h IS NULL THEN '-' WHEN s.i < {at} >> CAST(s0.lvl AS INTEGER) THEN 'L' || s.h ELSE 'R' || s.h END ORDER BY s0.lvl) AS path
      FROM {leaves} l JOIN (SELECT grp, lvl FROM {n} GROUP BY 1, 2 HAVING count(*) > 1) s0 ON s0.grp IS NOT DISTINCT FROM {grp}
      LEFT JOIN {n} s ON s.grp IS NOT DISTINCT FROM s0.grp AND s.lvl = s0.lvl AND s.i = xor({at} >> CAST(s0.lvl AS INTEGER), 1) GROUP BY l.{key}"""
    return f"""
WITH RECURSIVE leaf AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, h) - 1 AS i, row_number() OVER () AS r
  FROM (SELECT doc_id, lang, sha256({leaf}) AS h, CASE WHEN {crc} % 7 = 0 THEN sha256({more}) END AS h2 FROM documents)),
t AS ({levels.format(n='u', base='SELECT lang, 0, i, h FROM leaf')} SELECT * FROM u),
sub AS (SELECT grp, arg_max(h, lvl) AS h FROM t GROUP BY grp),
subs AS (SELECT grp, h, row_number() OVER (ORDER BY grp NULLS FIRST) - 1 AS i FROM sub),
tt AS ({levels.format(n='v', base="SELECT '', 0, i, h FROM subs")} SELECT * FROM v),
own AS ({walk.format(key='r', leaves='leaf', n='t', at='l.i', grp='l.lang')}),
up AS ({walk.format(key='i', leaves='subs', n='tt', at='l.i', grp="''")}),
p AS (SELECT l.doc_id, l.h AS leaf, s.h AS subroot, (SELECT arg_max(h, lvl) FROM tt) AS root,
             list_concat(coalesce(own.path, []), coalesce(up.path, [])) AS path, coalesce(l.h2, l.h) AS shown
      FROM leaf l JOIN subs s ON s.grp IS NOT DISTINCT FROM l.lang LEFT JOIN own ON own.r = l.r LEFT JOIN up ON up.i = s.i),
f AS (SELECT *, list_reduce(list_concat([shown], path), lambda a, s: sha256(CASE s[1] WHEN 'L' THEN s[2:] || a WHEN 'R' THEN a || s[2:] ELSE a END)) AS folded_root FROM p)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(list_filter(path, lambda s: s <> '-'), lambda s: s[2:]), '')) AS proof_sha256,
       folded_root, folded_root = root AS verified FROM f"""


ORACLE = _oracle()
