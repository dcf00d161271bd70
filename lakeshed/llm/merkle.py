"""A Merkle manifest of a table: the root, each row's proof and whether a row as seen now still folds to it.

Rows are leaves in order within their group's tree; runs of ``FANOUT`` nodes
become one, up to the tree's subroot, and the subroots in order make the root in
the same way.  The proofs come by butterfly exchange:

1. Leaves are sorted by range and numbered on the way; blocks of
   ``FANOUT**LEVELS`` consecutive leaves, aligned, are one group each, whose task
   hashes the block's own subtree to its top.
2. In round r, blocks that lie at the same place of the subtrees of one aligned
   run (blocks b, b + FANOUT**r, ...) swap the tops they have; each hashes the
   run's parent for itself and adds the others' tops to its proof.  So after the
   last round every block has its upper proof and the subroot, and nothing goes
   downwards.  The last, ragged subtree has no block at some places; its last
   block answers for them.
3. Subroots go the same way up to the root, and blocks finish their leaves'
   proofs from their own leaves and the upper proof.

A round is one shuffle of a row for each block; no group is larger than a block
or a run.  The number of rounds (from the largest tree) is all that the driver
learns.

Digests are hex text, as they go into the next hash.

Defined results: null fields are hashed as ``-``; trees are in order of their
UTF-8 bytes, the null group first; rows in order of the key, null first, equal
keys in order of their leaf; repeated rows are leaves of their own; empty and
long texts are leaves like others; an empty table gives no rows; other columns
are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeshed.llm.common import partitions_for, stored, table

FANOUT = 3
LEVELS = 7
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest_of(*fields: Column) -> Column:
    """Of all fields: ``-`` for a null, else the number of UTF-8 bytes, a colon and the value."""
    said = [x.cast("string") for x in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(x).cast("string"), F.lit(":"), x), F.lit("-")) for x in said]), 256)


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _levels(nodes: list[str], alone: bool, levels: int) -> list[list[str]]:
    """The block's nodes level by level; a tree's only block ends at its root, others rise by ``levels``."""
    out = [nodes]
    while len(out[-1]) > 1 if alone else len(out) <= levels:
        below = out[-1]
        out.append([_hash("".join(below[k : k + FANOUT])) for k in range(0, len(below), FANOUT)])
    return out


def _paths(levels: list[list[str]]) -> list[str]:
    """Each leaf's siblings within the block, from below upwards."""
    above = [""] * len(levels[-1])
    for nodes in reversed(levels[:-1]):
        above = ["".join(nodes[k // FANOUT * FANOUT : k]) + "".join(nodes[k + 1 : k // FANOUT * FANOUT + FANOUT]) + above[k // FANOUT] for k in range(len(nodes))]
    return above


def _folded(node: str, siblings: str, places: tuple[tuple[int, int], ...]) -> str:
    """The root that a leaf and its siblings give; ``places``: (position, number of leaves) in each tree on the way."""
    at = 0
    for index, count in places:
        while count > 1:
            left = index % FANOUT
            others = min(FANOUT, count - (index - left)) - 1
            run = siblings[at : at + 64 * others]
            node = _hash(run[: 64 * left] + node + run[64 * left :])
            at += 64 * others
            index, count = index // FANOUT, -(-count // FANOUT)
    return node


def _placed(rows: DataFrame, order: list[str], levels: int) -> DataFrame:
    """Adds position (in the tree) and block; rows are sorted by range and numbered as they are written."""
    spark = rows.sparkSession
    keys = ["tree", *order, "leaf"]
    parts = partitions_for(spark, 160 * rows.count())

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, place = None, 0
        for batch in batches:
            places = []
            for now in batch.column(0).to_pylist():
                place = place + 1 if now == tree else 0
                tree = now
                places.append(place)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places, pa.int64())], [*batch.schema.names, "place"])

    dealt = rows.select("tree", *[c for c in rows.columns if c != "tree"]).repartitionByRange(parts, *keys)
    ordered = dealt.withColumn("part", F.spark_partition_id()).sortWithinPartitions(*keys)
    numbered = stored(ordered.mapInArrow(number, f"{_schema(ordered)}, place long"), "merkle-leaves")
    counts = numbered.groupBy("tree", "part").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select("tree", "part", F.coalesce(before, F.lit(0)).alias("_before"))
    out = numbered.join(counts, ["tree", "part"]).withColumn("position", F.col("_before") + F.col("place")).drop("_before", "place", "part")
    return stored(out.withColumn("block", F.floor(F.col("position") / FANOUT**levels)), "merkle-blocks")


def _schema(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def _tops(placed: DataFrame, levels: int) -> DataFrame:
    """tree, block, leaves, top: one row for each block."""

    def top(group: pa.Table) -> pa.Table:
        group = group.sort_by("position")
        block = group.column("block")[0].as_py()
        found = _levels(group.column("leaf").to_pylist(), block == 0, levels)[-1][0]
        return pa.table({"tree": group.column("tree")[:1], "block": group.column("block")[:1], "leaves": pa.array([len(group)], pa.int64()), "top": pa.array([found])})

    return placed.select("tree", "block", "position", "leaf").groupBy("tree", "block").applyInArrow(top, "tree string, block long, leaves long, top string")


def _exchanged(blocks: DataFrame) -> DataFrame:
    """tree, block, leaves (of the tree), top (the subroot), upper (siblings above the block, from below upwards)."""
    trees = blocks.groupBy("tree").agg(F.count("*").alias("count"), F.sum("leaves").alias("_leaves"))
    state = blocks.join(trees, "tree").select("tree", "block", F.col("_leaves").alias("leaves"), "count", "top", F.lit("").alias("upper"))
    most = trees.agg(F.max("count")).first()[0] or 0
    alone, state = state.filter("count = 1"), state.filter("count > 1")
    width = 1
    while width < most:
        block = F.col("block")
        place, here = block % width, F.floor(block / width)
        answers = (block == F.col("count") - 1) & (here % FANOUT > 0)
        state = state.withColumns({"_at": here, "_run": F.floor(here / FANOUT), "_place": place, "_to": F.explode(F.sequence(place, F.when(answers, F.lit(width - 1).cast("long")).otherwise(place)))})
        peers = F.array_sort(F.collect_list(F.struct("_at", "top")).over(Window.partitionBy("tree", "_run", "_to")))
        state = state.withColumn("_peers", peers).filter("_to = _place")
        others = F.filter("_peers", lambda x: x["_at"] != F.col("_at"))
        open_ = F.ceil(F.col("count") / width) > 1
        top = F.when(open_, F.sha2(F.array_join(F.col("_peers.top"), ""), 256)).otherwise(F.col("top"))
        upper = F.concat("upper", F.array_join(F.transform(others, lambda x: x["top"]), ""))
        state = state.select("tree", "block", "leaves", "count", top.alias("top"), upper.alias("upper"))
        width *= FANOUT
    return stored(state.union(alone).drop("count"), "merkle-upper")


def _finished(placed: DataFrame, uppers: DataFrame, schema: str, levels: int) -> DataFrame:
    """Each leaf's columns but tree and leaf, then what ``schema`` names of leaf, subroot, root, siblings, proof_sha256, folded_root, verified.

    ``uppers`` has tree, block, leaves, top, upper, and for the way from the
    subroot on: root, place, trees (where the subroot stands and of how many).
    """
    said = [c for c in placed.columns if c not in ("tree", "leaf", "seen", "position", "block")]
    names = [x.split()[0] for x in schema.split(", ")]

    def finish(leaves: pa.Table, upper: pa.Table) -> pa.Table:
        leaves = leaves.sort_by("position")
        (way,) = upper.to_pylist()
        nodes = leaves.column("leaf").to_pylist()
        siblings = [own + way["upper"] for own in _paths(_levels(nodes, leaves.column("block")[0].as_py() == 0, levels))]
        found = {"leaf": nodes, "siblings": siblings, "subroot": [way["top"]] * len(nodes), "root": [way["root"]] * len(nodes)}
        if "folded_root" in names:
            seen = [b or a for a, b in zip(nodes, leaves.column("seen").to_pylist(), strict=True)]
            found["folded_root"] = [_folded(x, s, ((p, way["leaves"]), (way["place"], way["trees"]))) for x, s, p in zip(seen, siblings, leaves.column("position").to_pylist(), strict=True)]
            found["proof_sha256"] = [_hash(s) for s in siblings]
            found["verified"] = [x == way["root"] for x in found["folded_root"]]
        return pa.table({c: leaves.column(c) for c in [*said, "position"]} | {c: pa.array(found[c]) for c in names if c != "position"}).select([*said, *names])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in placed.schema if f.name in said)
    return placed.groupBy("tree", "block").cogroup(uppers.groupBy("tree", "block")).applyInArrow(finish, f"{kinds}, {schema}")


def manifest(rows: DataFrame, order: list[str], levels: int = LEVELS, proofs: bool = True) -> DataFrame:
    """The columns of ``rows`` but tree and seen, then leaf, subroot, root, proof_sha256, folded_root, verified and, with ``proofs``, siblings.

    ``rows`` has tree (the group's name; trees are in its order), ``order`` (the
    key within a tree), leaf (a digest) and seen: the digest to be verified, null
    if it is the leaf.  Verified means that seen, folded with the leaf's siblings,
    gives the root.
    """
    placed = _placed(rows, order, levels)
    uppers = _exchanged(stored(_tops(placed, levels), "merkle-tops"))
    subroots = uppers.filter("block = 0").select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("top").alias("leaf"))
    above = _placed(subroots, ["name"], levels)
    tops = _exchanged(stored(_tops(above, levels), "merkle-tops"))
    proven = _finished(above, tops.withColumns({"root": F.col("top"), "place": F.lit(0), "trees": F.lit(1)}), "position long, root string, siblings string", levels)
    proven = proven.crossJoin(F.broadcast(tops.agg(F.max("leaves").alias("trees"))))  # one row
    ways = uppers.join(proven.select(F.col("name").alias("tree"), F.col("position").alias("place"), "root", "trees", "siblings"), "tree")
    ways = ways.withColumn("upper", F.concat("upper", "siblings")).drop("siblings")
    return _finished(placed, ways, "leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean" + ", siblings string" * proofs, levels)


def leaves_of(docs: DataFrame, seen: dict[str, Column] | None = None, when: Column | None = None) -> DataFrame:
    """tree, doc_id, source, leaf, seen: rows of ``docs`` as leaves; ``seen`` replaces fields of the rows where ``when`` holds."""
    fields = {c: F.col(c) for c in FIELDS}
    now = digest_of(*(fields | (seen or {})).values())
    tree = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))
    return docs.select(tree.alias("tree"), "doc_id", "source", digest_of(*fields.values()).alias("leaf"), (F.when(when, now) if seen else F.lit(None).cast("string")).alias("seen"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*FIELDS)
    rows = stored(leaves_of(docs, {"text": F.translate("text", "\n", "")}, F.crc32(F.col("doc_id").cast("string")) % 2 == 0), "merkle-rows")
    return manifest(rows, ["doc_id"], proofs=False).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "source")


def _crc32_sql(text: str) -> str:
    """The unsigned CRC-32 of a text of ASCII digits."""
    bits = "list_reduce([xor({c}, {b}), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT)), lambda a, d: {bits.format(c='a', b='d')}), 4294967295)"


def _field_sql(name: str, value: str = "") -> str:
    value = value or f"{name}::VARCHAR"
    return f"coalesce(octet_length(encode({value})) || ':' || {value}, '-')"


_LEVELS_SQL = """{name} AS (
  SELECT tree, 0 AS level, row_number() OVER (PARTITION BY tree ORDER BY {order}) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n, leaf AS node FROM {rows}
  UNION ALL
  SELECT tree, level + 1, pos // 3, (any_value(n) + 2) // 3, sha256(string_agg(node, '' ORDER BY pos)) FROM {name} WHERE n > 1 GROUP BY tree, level, pos // 3)"""
#: Each leaf with the runs on its way: what stands left of it, what right.
_WAYS_SQL = """{name} AS (
  SELECT l.tree, l.pos AS leaf_pos, s.level, coalesce(string_agg(s.node, '' ORDER BY s.pos) FILTER (s.pos < l.pos // (3 ** s.level)::BIGINT), '') AS lefts, coalesce(string_agg(s.node, '' ORDER BY s.pos) FILTER (s.pos > l.pos // (3 ** s.level)::BIGINT), '') AS rights
  FROM {nodes} l JOIN {nodes} s ON s.tree = l.tree AND s.n > 1 AND s.pos // 3 = l.pos // (3 ** (s.level + 1))::BIGINT WHERE l.level = 0 GROUP BY ALL)"""

ORACLE = "\n".join(
    (
        "WITH RECURSIVE rows_ AS (",
        f"  SELECT doc_id, source, coalesce('=' || source, '') AS tree, sha256({' || '.join(_field_sql(c) for c in FIELDS)}) AS leaf,",
        f"    CASE WHEN {_crc32_sql('doc_id::VARCHAR')} % 2 = 0 THEN sha256({' || '.join(_field_sql(c) for c in FIELDS[:-1])} || {_field_sql('text', 'replace(text, chr(10), ' + chr(39) * 2 + ')')}) END AS seen FROM documents),",
        _LEVELS_SQL.format(name="nodes", order="doc_id NULLS FIRST, leaf", rows="rows_") + ",",
        "subroots AS (SELECT '' AS tree, tree AS name, node AS leaf FROM nodes WHERE n = 1),",
        _LEVELS_SQL.format(name="tops", order="name", rows="subroots") + ",",
        _WAYS_SQL.format(name="low", nodes="nodes") + ",",
        _WAYS_SQL.format(name="high", nodes="tops") + ",",
        "placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM rows_),",
        "sources AS (SELECT *, row_number() OVER (ORDER BY name) - 1 AS pos FROM subroots),",
        "steps AS (",
        "  SELECT p.tree, p.pos, w.level, w.lefts, w.rights FROM placed p JOIN low w ON w.tree = p.tree AND w.leaf_pos = p.pos UNION ALL",
        "  SELECT p.tree, p.pos, 1000 + w.level, w.lefts, w.rights FROM placed p JOIN sources s ON s.name = p.tree JOIN high w ON w.leaf_pos = s.pos),",
        "ordered AS (SELECT *, row_number() OVER (PARTITION BY tree, pos ORDER BY level) AS step FROM steps),",
        "proofs AS (SELECT tree, pos, sha256(string_agg(lefts || rights, '' ORDER BY step)) AS proof, max(step) AS steps FROM ordered GROUP BY tree, pos),",
        "fold AS (",
        "  SELECT tree, pos, 0::BIGINT AS step, coalesce(seen, leaf) AS node FROM placed UNION ALL",
        "  SELECT f.tree, f.pos, o.step, sha256(o.lefts || f.node || o.rights) FROM fold f JOIN ordered o ON o.tree = f.tree AND o.pos = f.pos AND o.step = f.step + 1)",
        "SELECT p.doc_id, p.leaf, s.leaf AS subroot, r.node AS root, coalesce(q.proof, sha256('')) AS proof_sha256, f.node AS folded_root, f.node = r.node AS verified, p.source",
        "FROM placed p JOIN sources s ON s.name = p.tree JOIN tops r ON r.n = 1 LEFT JOIN proofs q ON q.tree = p.tree AND q.pos = p.pos JOIN fold f ON f.tree = p.tree AND f.pos = p.pos AND f.step = coalesce(q.steps, 0)",
    )
)
