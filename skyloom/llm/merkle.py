"""Merkle manifest of a dataset, built and opened by sibling-shift self-joins.

Every row is a leaf. Per group (``source``) the leaves stand in the order of their ids; runs of ``arity`` nodes become one
node until one is left, the subroot. The subroots, in the order of their groups, become the root in the same way.

At every level each node computes the indices of its siblings (XOR with 1 in a binary tree, otherwise the shifts of its
slot within its run) and an equijoin of the level with itself fetches their digests. Both sides are dealt by run, once per
level, so a group with a third of all rows is spread like any other. Rows of slot zero then emit the parents. Proofs are
put together from the top down: a node's proof is its siblings followed by the proof of its parent.

Leaf indices come from a range partitioning by group and id with counts per partition, so no group is sorted in one task.

Defined results: null fields count as ``-``; null ids come first in their group; a null group is one of its own and comes
first; equal ids are ordered by their leaf (repeated rows have equal leaves and proofs of their own places); texts are
hashed whole; other columns do not take part; an empty table has no tree and gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyloom.llm.common import query, table
from skyloom.session import durable

ARITY = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER = 5


def digest(value: Column) -> Column:
    """SHA-256 as 32 bytes."""
    return F.unhex(F.sha2(value, 256))


def hex_text(value: Column) -> Column:
    return F.lower(F.hex(value))


def leaf_of(values: list[Column]) -> Column:
    """Digest of the fields of a row, each with its length in bytes."""
    texts = [v.cast("string") for v in values]
    return digest(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]))


@contextmanager
def joined_by_run(spark: SparkSession) -> Iterator[None]:
    """Let a join of runs and siblings use the partitioning by run alone."""
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def ranked(rows: DataFrame, group: str, order: list[Column]) -> DataFrame:
    """``rows`` with ``idx`` (from 0) and ``n``: place and number of rows in the group.

    Rows are range-partitioned by group and order; a partition's rows of a group are counted, and the counts before it
    are its offset. Windows see one range of one group at most.
    """
    placed = durable(rows.repartitionByRange(F.col(group), *order).withColumn("part", F.spark_partition_id()), "ranges")
    counts = placed.groupBy(group, "part").agg(F.count(F.lit(1)).alias("here"))
    w = Window.partitionBy(group)
    before = w.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(group, "part", F.coalesce(F.sum("here").over(before), F.lit(0)).alias("offset"),
                            F.sum("here").over(w).alias("n"))
    place = F.row_number().over(Window.partitionBy(group, "part").orderBy(*order)) - 1
    return placed.withColumn("place", place).join(offsets, [group, "part"]).withColumn(
        "idx", F.col("offset") + F.col("place")).drop("part", "place", "offset")


def opened(nodes: DataFrame, arity: int = ARITY) -> DataFrame:
    """``nodes(key, idx, n, node)`` with the siblings ``before`` and ``after`` each node in its run, as concatenated digests."""
    dealt = nodes.select("key", F.floor(F.col("idx") / arity).alias("run"), "idx", "n", "node").repartition("key", "run")
    if arity == 2:
        siblings = F.array(F.col("idx").bitwiseXOR(F.lit(1).cast("long")))
    else:
        siblings = F.transform(
            F.sequence(F.lit(1), F.lit(arity - 1)), lambda s: F.col("run") * arity + (F.col("idx") + s) % arity)
    asked = dealt.select("*", F.explode_outer(F.filter(siblings, lambda k: k < F.col("n"))).alias("sibling"))
    given = dealt.select("key", "run", F.col("idx").alias("sibling"), F.col("node").alias("other"))
    met = asked.join(given, ["key", "run", "sibling"], "left")
    others = F.sort_array(F.collect_list(F.when(F.col("other").isNotNull(), F.struct("sibling", "other"))))
    listed = met.groupBy("key", "run", "idx", "n", "node").agg(others.alias("others"))

    def joined(test):
        side = F.filter("others", test)
        return F.aggregate(side, F.lit(b""), lambda all_, one: F.concat(all_, one["other"]))

    return listed.select("key", "run", "idx", "n", "node", joined(lambda o: o["sibling"] < F.col("idx")).alias("before"),
                         joined(lambda o: o["sibling"] > F.col("idx")).alias("after"))


def parents(level: DataFrame, arity: int = ARITY) -> DataFrame:
    """The next level: rows of slot zero hash themselves and their siblings."""
    whole = digest(hex_text(F.concat("node", "after")))
    return level.where(F.col("n") > 1).where(F.col("idx") % arity == 0).select(
        "key", F.col("run").alias("idx"), F.ceil(F.col("n") / arity).alias("n"), whole.alias("node"))


def levels(leaves: DataFrame, arity: int = ARITY) -> list[DataFrame]:
    """All levels of the trees over ``leaves(key, idx, n, node)``, each ``key, run, idx, n, node, before, after``."""
    found, nodes = [], leaves
    with joined_by_run(leaves.sparkSession):
        while True:
            found.append(durable(opened(nodes, arity), "level"))
            nodes = parents(found[-1], arity)
            if not found[-1].where("n > 1").limit(1).count():
                return found


NO_STEPS = "CAST(array() AS array<struct<before: binary, after: binary>>)"


def proofs(found: list[DataFrame], above: DataFrame | None = None) -> DataFrame:
    """``key, idx, node, top, steps`` of the lowest level: the siblings from each node up, as steps (before, after).

    ``above(key, steps, top)`` goes on from the tree of each key; without it trees end at their own top.
    """
    below = None
    with joined_by_run(found[0].sparkSession):
        for number, level in reversed(list(enumerate(found))):
            tops = level.where("n = 1").select("key", "idx", "node")
            if above is None:
                tops = tops.select("*", F.col("node").alias("top"), F.expr(NO_STEPS).alias("steps"))
            else:
                tops = tops.join(above, "key").select("key", "idx", "node", "top", "steps")
            if below is None:
                made = tops
            else:
                step = F.array(F.struct("before", "after"))
                rest = below.select("key", F.col("idx").alias("run"), "top", F.col("steps").alias("rest"))
                inner = level.where("n > 1").repartition("key", "run").join(rest, ["key", "run"]).select(
                    "key", "idx", "node", "top", F.concat(step, "rest").alias("steps"))
                made = inner.unionAll(tops)
            below = durable(made, "proofs") if number else made
    return below


def proof_text(steps: Column) -> Column:
    """All siblings of a proof, level by level and left to right, as hex text."""
    return hex_text(F.aggregate(steps, F.lit(b""), lambda all_, s: F.concat(all_, s["before"], s["after"])))


def folded(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and the siblings of a proof give."""
    def up(node, s):
        return digest(hex_text(F.concat(s["before"], node, s["after"])))

    return F.aggregate(steps, leaf, up)


def manifest(rows: DataFrame, keep: list[Column], group: Column, order: Column, leaf: Column, arity: int = ARITY,
             shown: Column | None = None) -> DataFrame:
    """Columns ``keep`` with ``leaf, subroot, root, proof_sha256, folded_root, verified`` per row (digests as hex text).

    ``shown`` is the leaf that is checked against the proof, by default the one in the tree.
    """
    row = F.struct(*keep).alias("row")
    key = F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))  # null groups first
    narrow = durable(rows.select(row, key.alias("key"), order.alias("at"), leaf.alias("node"),
                                 (leaf if shown is None else shown).alias("shown")), "leaves")
    placed = durable(ranked(narrow, "key", [F.col("at").asc_nulls_first(), F.col("node").asc()]), "placed")
    trees = levels(placed.select("key", "idx", "n", "node"), arity)
    subroots = trees[0].where("n = 1").select("key", "node")
    for level in trees[1:]:
        subroots = subroots.unionAll(level.where("n = 1").select("key", "node"))
    groups = durable(ranked(subroots.select(F.lit("").alias("all"), F.col("key").alias("group"), "node"), "all",
                            [F.col("group").asc()]), "groups")
    top = levels(groups.select(F.col("all").alias("key"), "idx", "n", "node"), arity)
    over = proofs(top).select("idx", "steps", F.col("top").alias("root"))
    above = durable(groups.join(over, "idx").select(
        F.col("group").alias("key"), F.struct("node", "root").alias("top"), "steps"), "above")
    done = proofs(trees, above)
    with joined_by_run(rows.sparkSession):
        opened_ = done.join(placed.select("key", "idx", "row", "shown"), ["key", "idx"]).select(
            "row", F.col("node").alias("leaf"), F.col("top.node").alias("subroot"), F.col("top.root").alias("root"),
            F.sha2(proof_text(F.col("steps")), 256).alias("proof_sha256"), folded(F.col("shown"), F.col("steps")).alias("folded"))
        out = durable(opened_, "opened")
    return out.select(
        "row.*", hex_text(F.col("leaf")).alias("leaf"), hex_text(F.col("subroot")).alias("subroot"),
        hex_text(F.col("root")).alias("root"), "proof_sha256", hex_text(F.col("folded")).alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"))


ORACLE = rf"""
WITH RECURSIVE tab AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(range(8), lambda a, b:
    CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, i) AS v FROM range(256) r(i))),
base AS (SELECT doc_id, coalesce('=' || source, '') AS key, list_aggregate(list_transform([doc_id::VARCHAR, source, lang, n_chars::VARCHAR],
    lambda v: coalesce(strlen(v) || ':' || v, '-')), 'string_agg', '') AS head, text,
  xor(list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
    lambda a, b: xor(a >> 8, t[xor(a, b) % 256 + 1]), 4294967295), 4294967295) AS crc FROM documents, tab),
leaves AS (SELECT doc_id, key, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
  CASE WHEN crc % {TAMPER} = 0 THEN sha256(head || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '-')) ELSE sha256(head || coalesce(strlen(text) || ':' || text, '-')) END AS shown FROM base),
placed AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM leaves),
tree(key, lv, idx, node, n) AS (
  SELECT key, 0, idx, leaf, count(*) OVER (PARTITION BY key) FROM placed
  UNION ALL SELECT key, max(lv) + 1, idx // {ARITY}, sha256(string_agg(node, '' ORDER BY idx)), (max(n) + {ARITY - 1}) // {ARITY}
  FROM tree WHERE n > 1 GROUP BY key, idx // {ARITY}),
tops AS (SELECT key, node, lv, row_number() OVER (ORDER BY key) - 1 AS idx FROM tree WHERE n = 1),
over(lv, idx, node, n) AS (
  SELECT 0, idx, node, count(*) OVER () FROM tops
  UNION ALL SELECT max(lv) + 1, idx // {ARITY}, sha256(string_agg(node, '' ORDER BY idx)), (max(n) + {ARITY - 1}) // {ARITY}
  FROM over WHERE n > 1 GROUP BY idx // {ARITY}),
root AS (SELECT node AS root FROM over WHERE n = 1),
steps AS (
  SELECT p.key, p.idx, t.lv, coalesce(string_agg(t.node, '' ORDER BY t.idx) FILTER (t.idx < p.idx // pow({ARITY}, t.lv)::BIGINT), '') AS before,
    coalesce(string_agg(t.node, '' ORDER BY t.idx) FILTER (t.idx > p.idx // pow({ARITY}, t.lv)::BIGINT), '') AS after
  FROM placed p JOIN tree t ON t.key = p.key AND t.n > 1 AND t.idx // {ARITY} = p.idx // pow({ARITY}, t.lv + 1)::BIGINT GROUP BY 1, 2, 3
  UNION ALL
  SELECT p.key, p.idx, 1000 + o.lv, coalesce(string_agg(o.node, '' ORDER BY o.idx) FILTER (o.idx < s.idx // pow({ARITY}, o.lv)::BIGINT), ''),
    coalesce(string_agg(o.node, '' ORDER BY o.idx) FILTER (o.idx > s.idx // pow({ARITY}, o.lv)::BIGINT), '')
  FROM placed p JOIN tops s ON s.key = p.key JOIN over o ON o.n > 1 AND o.idx // {ARITY} = s.idx // pow({ARITY}, o.lv + 1)::BIGINT GROUP BY 1, 2, 3),
paths AS (SELECT key, idx, string_agg(before || after, '' ORDER BY lv) AS proof, list(before ORDER BY lv) AS b, list(after ORDER BY lv) AS a
  FROM steps GROUP BY 1, 2),
fold AS (SELECT p.doc_id, p.key, p.idx, p.leaf, sha256(coalesce(proof, '')) AS proof_sha256,
  CASE WHEN b IS NULL THEN shown ELSE list_reduce(range(len(b)), lambda x, i: sha256(b[i::BIGINT + 1] || x || a[i::BIGINT + 1]), shown) END AS folded_root
  FROM placed p LEFT JOIN paths USING (key, idx))
SELECT f.doc_id, f.leaf, s.node AS subroot, root, proof_sha256, folded_root, folded_root = root AS verified
FROM fold f JOIN tops s USING (key), root
"""


@query("op12_merkle_manifest", ORACLE)
def op12_merkle_manifest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    named = [F.col(c) for c in FIELDS]
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER == 0
    leaf = leaf_of(named)
    shown = F.when(tampered, leaf_of([*named[:-1], lower])).otherwise(leaf)
    return manifest(docs, [F.col("doc_id")], F.col("source"), F.col("doc_id"), leaf, shown=shown)
