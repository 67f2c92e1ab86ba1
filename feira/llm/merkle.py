"""Merkle trees over documents, one per source and one over the sources, with a proof for every document."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feira.llm.tables import stored

# Consecutive nodes that become one.
FAN = 3
# Leaves below one node this many levels up share the siblings above it and climb in one row.
FAMILY_LEVELS = 4
# A tree of leaves that a long can number has no more levels.
MOST_LEVELS = 40
# Begins of ranges are broadcast up to this many rows, and joined by key beyond.
FEW = 50_000
# Key of the tree over the sources. Keys of sources begin with "n" (NULL) or "s", so they sort like sources.
TOP = "t"

LINE_BREAK = "\n"
ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


def _part(column: Column) -> Column:
    value = column.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value), F.lit(":"), value))


def leaf(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    """SHA-256 of the five columns, each with its length; 32 bytes."""
    return F.unhex(F.sha2(F.concat(*map(_part, (doc_id, source, lang, n_chars, text))), 256))


def _digest(nodes: Column) -> Column:
    """SHA-256 over the hexadecimal texts of some nodes."""
    return F.unhex(F.sha2(_hex(nodes), 256))


def _hex(nodes: Column) -> Column:
    return F.array_join(F.transform(nodes, lambda x: F.lower(F.hex(x))), "")


def _height(leaves: Column) -> Column:
    """Levels above the leaves until one node remains."""
    powers = F.array(*[F.lit(FAN**k) for k in range(MOST_LEVELS) if FAN**k < 1 << 63])
    return F.size(F.filter(powers, lambda x: x < leaves))


def _parents(nodes: Column) -> Column:
    runs = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / FAN).cast("int"))
    return F.transform(runs, lambda i: _digest(F.slice(nodes, i * FAN + 1, F.lit(FAN))))


def _run(nodes: Column, at: Column) -> Column:
    """The run of the node at a place."""
    return F.slice(nodes, at - at % FAN + 1, F.lit(FAN))


def _others(run: Column, slot: Column) -> Column:
    return F.filter(run, lambda x, k: k != slot)


def _folded(run: Column, slot: Column, node: Column) -> Column:
    """The parent of a run after `node` has taken its slot."""
    return _digest(F.transform(run, lambda x, k: F.when(k == slot, node).otherwise(x)))


def leaves(docs: DataFrame, changed: Callable[[Column, Column], Column]) -> DataFrame:
    """(tree, doc_id, leaf, changed, row) per document; `changed` is the leaf after tampering, NULL if none.

    `changed(doc_id, text)` is the text found later.
    """
    columns = [F.col(f"`{c}`") for c in ("doc_id", "source", "lang", "n_chars", "text")]
    later = changed(columns[0], columns[4])
    return docs.select(
        F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n")).alias("tree"),
        "doc_id",
        leaf(*columns).alias("leaf"),
        F.when(~later.eqNullSafe(columns[4]), leaf(*columns[:4], later)).alias("changed"),
        F.monotonically_increasing_id().alias("row"),
    )


def placed(rows: DataFrame, order: list[str], label: str) -> DataFrame:
    """`rows` of a written table with `pos`, the place in the tree by `order`, and `leaves`, the rows of the tree.

    `order` tells rows of a tree apart, so that ranges cut large trees and equal keys alike. The sorted
    copy is written; each range then begins a tree at the number of its rows in earlier ranges.
    """
    copy = stored(
        rows.repartitionByRange("tree", *order)
        .sortWithinPartitions("tree", *order)
        .withColumn("place", F.monotonically_increasing_id()),
        label,
    )
    task = F.shiftright("place", 33).alias("task")
    of_tree = Window.partitionBy("tree")
    before = of_tree.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    begins = stored(
        copy.groupBy("tree", task)
        .agg(F.min("place").alias("first"), F.count("*").alias("n"))
        .select(
            "tree",
            "task",
            (F.col("first") - F.coalesce(F.sum("n").over(before), F.lit(0))).alias("zero"),
            F.sum("n").over(of_tree).alias("leaves"),
        ),
        f"{label}-begins",
    )
    # One row per range and tree in it.
    if begins.count() <= FEW:
        begins = F.broadcast(begins)
    return (
        copy.withColumn("task", task)
        .join(begins, ["tree", "task"])
        .withColumn("pos", F.col("place") - F.col("zero"))
        .drop("task", "place", "zero")
    )


def families(leaves: DataFrame) -> DataFrame:
    """Documents in order, FAN ** FAMILY_LEVELS a row, climbed as far as they share no sibling.

    (tree, family, height, members, folds, node): members are (doc_id, leaf, path) with the siblings met
    so far, folds the nodes that the changed leaves lead to, node the true one.
    """
    df = (
        leaves.groupBy("tree", F.expr(f"pos div {FAN**FAMILY_LEVELS}").alias("family"))
        .agg(
            F.sort_array(F.collect_list(F.struct("pos", "doc_id", "leaf", "changed"))).alias("m"),
            F.first("leaves").alias("leaves"),
        )
        .select(
            "tree",
            "family",
            _height(F.col("leaves")).alias("height"),
            "m",
            F.col("m.leaf").alias("nodes0"),
            F.transform("m", lambda x: F.coalesce(x["changed"], x["leaf"])).alias("folds0"),
            F.transform("m", lambda x: F.lit("")).alias("paths0"),
        )
    )
    for level in range(FAMILY_LEVELS):
        # A name for each level: inside a lambda, a name that the same select gives anew would mean the new column.
        nodes, folds, paths = (F.col(f"{c}{level}") for c in ("nodes", "folds", "paths"))

        def place(i: Column, step: int = FAN**level) -> Column:
            return F.floor(i / step).cast("int")

        def path(x: Column, i: Column) -> Column:
            return F.concat(x, _hex(_others(_run(nodes, place(i)), place(i) % FAN)))

        def fold(x: Column, i: Column) -> Column:
            return _folded(_run(nodes, place(i)), place(i) % FAN, x)

        climbs = F.col("height") > level
        df = df.select(
            "tree",
            "family",
            "height",
            "m",
            F.when(climbs, _parents(nodes)).otherwise(nodes).alias(f"nodes{level + 1}"),
            F.when(climbs, F.transform(folds, fold)).otherwise(folds).alias(f"folds{level + 1}"),
            F.when(climbs, F.transform(paths, path)).otherwise(paths).alias(f"paths{level + 1}"),
        )
    nodes, folds, paths = (F.col(f"{c}{FAMILY_LEVELS}") for c in ("nodes", "folds", "paths"))
    members = F.zip_with(
        "m",
        paths,
        lambda m, path: F.struct(
            m["doc_id"].alias("doc_id"), m["leaf"].alias("leaf"), F.unhex(path).alias("path")
        ),
    )
    return df.select("tree", "family", "height", members.alias("members"), folds.alias("folds"), nodes[0].alias("node"))


def _runs(nodes: DataFrame, first: int) -> tuple[list[DataFrame], DataFrame]:
    """The runs of all levels from `first` on, and the last node of each tree.

    `nodes` are (tree, pos, height, node) on level `first`, or on the last level of lower trees.
    """
    levels, ends, level = [], [], first
    while True:
        ends.append(nodes.filter(F.col("height") <= level).select("tree", "node"))
        nodes = nodes.filter(F.col("height") > level)
        if nodes.isEmpty():
            break
        runs = stored(
            nodes.groupBy("tree", F.expr(f"pos div {FAN}").alias("pos"))
            .agg(F.first("height").alias("height"), F.sort_array(F.collect_list(F.struct("pos", "node"))).alias("m"))
            .select("tree", F.lit(level).alias("level"), "pos", "height", F.col("m.node").alias("nodes")),
            f"merkle-level-{level}",
        )
        levels.append(runs)
        nodes = runs.select("tree", "pos", "height", _digest(F.col("nodes")).alias("node"))
        level += 1
    ended = ends[0]
    for more in ends[1:]:
        ended = ended.unionByName(more)
    return levels, ended


def _up(last: Column, level: Column, pos: Column) -> list[Column]:
    """Where a node hangs in its tree; at the end of a tree, where its source hangs in the upper tree."""
    return [
        F.when(last, F.when(F.col("tops") > 0, F.lit(TOP))).otherwise(F.col("tree")).alias("up_tree"),
        F.when(last, 0).otherwise(level).cast("int").alias("up_level"),
        F.when(last, F.col("rank")).otherwise(pos).cast("long").alias("up_pos"),
    ]


CLIMB = f"""
WITH RECURSIVE climb (tree, family, up_tree, up_level, up_pos, path, folds) AS (
  SELECT tree, family, up_tree, up_level, up_pos, X'' AS path, folds FROM {{starts}}
  UNION ALL
  SELECT c.tree, c.family, r.up_tree, r.up_level, r.up_pos,
         concat(c.path, unhex(array_join(
           transform(filter(r.nodes, (x, k) -> k <> c.up_pos % {FAN}), x -> hex(x)), ''))),
         transform(c.folds, f -> unhex(sha2(array_join(
           transform(r.nodes, (x, k) -> lower(hex(if(k = c.up_pos % {FAN}, f, x)))), ''), 256)))
  FROM climb AS c JOIN {{runs}} AS r
    ON r.tree = c.up_tree AND r.level = c.up_level AND r.pos = c.up_pos DIV {FAN}
)
SELECT tree, family, path, folds FROM climb WHERE up_tree IS NULL"""


def climbed(spark: SparkSession, starts: DataFrame, runs: DataFrame) -> DataFrame:
    """Every family at the root, with the siblings met on the way.

    A recursive query: each turn joins the families with the runs their nodes stand in, appends the
    other nodes of the run, and folds. A turn moves one node hash per document and one path per family.
    """
    before = spark.conf.get(ROW_LIMIT)
    # The default stops a recursive query at a million rows.
    spark.conf.set(ROW_LIMIT, "-1")
    try:
        return stored(spark.sql(CLIMB, starts=starts, runs=runs), "merkle-climb")
    finally:
        spark.conf.set(ROW_LIMIT, before)


def line_breaks_lost(doc_id: Column, text: Column) -> Column:
    """Texts without line breaks where the checksum of the id is even; the given ones elsewhere."""
    even = F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 2 == 0
    return F.when(even, F.replace(text, F.lit(LINE_BREAK), F.lit(""))).otherwise(text)


def manifest(docs: DataFrame, changed: Callable[[Column, Column], Column] = line_breaks_lost) -> DataFrame:
    """Per document the leaf, subroot, root, digest of the proof, and the root its text as `changed` leads to.

    NULL ids come first in their source; rows with equal ids are ordered by leaf, and equal rows are
    leaves of their own with equal digests. A document that is alone in its table is the root, with an
    empty proof. A NULL text stays NULL; a NULL id is never tampered with. Other columns are not read. A
    table without rows gives no rows.
    """
    spark = docs.sparkSession
    plain = stored(leaves(docs, changed), "merkle-leaves")
    packs = stored(families(placed(plain, ["doc_id", "leaf", "row"], "merkle-order")), "merkle-families")
    nodes = packs.select("tree", F.col("family").alias("pos"), "height", "node")
    levels, ends = _runs(nodes, FAMILY_LEVELS)
    ends = stored(ends, "merkle-subroots")

    upper = placed(ends.select(F.lit(TOP).alias("tree"), F.col("tree").alias("source"), "node"), ["source"], "merkle-sources")
    sources = stored(upper.withColumn("height", _height(F.col("leaves"))), "merkle-ranks")
    tops, last = _runs(sources.select("tree", "pos", "height", "node"), 0)
    root = last.select("node").first()
    ranks = sources.select(F.col("source").alias("tree"), F.col("pos").alias("rank"), F.col("height").alias("tops"), F.col("node").alias("subroot"))

    starts = packs.join(ranks, "tree").select(
        "tree", "family", *_up(F.col("height") <= FAMILY_LEVELS, F.lit(FAMILY_LEVELS), F.col("family")), "folds"
    )
    runs = [
        runs.join(ranks, "tree").select(
            "tree", "level", "pos", *_up(F.col("height") == F.col("level") + 1, F.col("level") + 1, F.col("pos")), "nodes"
        )
        for runs in levels
    ] + [
        runs.select(
            "tree",
            "level",
            "pos",
            F.when(F.col("height") > F.col("level") + 1, F.col("tree")).alias("up_tree"),
            (F.col("level") + 1).alias("up_level"),
            F.col("pos").alias("up_pos"),
            "nodes",
        )
        for runs in tops
    ]
    empty = "tree string, level int, pos long, up_tree string, up_level int, up_pos long, nodes array<binary>"
    linked = spark.createDataFrame([], empty)
    for level in runs:
        linked = linked.unionByName(level)
    ended = climbed(spark, stored(starts, "merkle-starts"), stored(linked, "merkle-nodes"))

    each = F.arrays_zip(F.col("members"), F.col("fold"))
    rows = (
        packs.drop("folds", "node")
        .join(ended.withColumnRenamed("folds", "fold"), ["tree", "family"])
        .join(ranks, "tree")
        .select("path", "subroot", F.explode(each).alias("x"))
    )

    def text(node: Column) -> Column:
        return F.lower(F.hex(node))

    proof = F.concat(F.col("x.members.path"), F.col("path"))
    whole = F.lit(bytes(root[0]).hex() if root else None)
    return rows.select(
        F.col("x.members.doc_id").alias("doc_id"),
        text(F.col("x.members.leaf")).alias("leaf"),
        text(F.col("subroot")).alias("subroot"),
        whole.alias("root"),
        F.sha2(text(proof), 256).alias("proof_sha256"),
        text(F.col("x.fold")).alias("folded_root"),
        (text(F.col("x.fold")) == whole).alias("verified"),
    )


# The same in DuckDB, a leaf at a time.
ORACLE = r"""
WITH RECURSIVE sums AS (
  SELECT doc_id, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda a, b: list_reduce(
      list_prepend(xor(a, b), range(8)), lambda r, i: CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384) ELSE r // 2 END)
  ) AS inverted
  FROM (SELECT DISTINCT doc_id FROM documents)
),
parts AS (
  SELECT row_number() OVER () AS doc, d.doc_id, d.source,
    concat(CASE WHEN d.doc_id IS NULL THEN '-' ELSE concat(strlen(d.doc_id::VARCHAR), ':', d.doc_id) END,
           CASE WHEN source IS NULL THEN '-' ELSE concat(strlen(source), ':', source) END,
           CASE WHEN lang IS NULL THEN '-' ELSE concat(strlen(lang), ':', lang) END,
           CASE WHEN n_chars IS NULL THEN '-' ELSE concat(strlen(n_chars::VARCHAR), ':', n_chars) END) AS head,
    text, CASE WHEN s.inverted % 2 = 1 THEN replace(text, chr(10), '') ELSE text END AS found
  FROM documents AS d LEFT JOIN sums AS s ON s.doc_id = d.doc_id
),
leaves AS (
  SELECT doc, doc_id, source,
    sha256(concat(head, CASE WHEN text IS NULL THEN '-' ELSE concat(strlen(text), ':', text) END)) AS leaf,
    sha256(concat(head, CASE WHEN found IS NULL THEN '-' ELSE concat(strlen(found), ':', found) END)) AS later
  FROM parts
),
nodes AS (
  SELECT source, 0 AS level, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, doc) - 1 AS pos,
    count(*) OVER (PARTITION BY source) AS n, leaf AS node, doc
  FROM leaves
  UNION ALL
  SELECT source, level + 1, pos // 3, (any_value(n) + 2) // 3, sha256(string_agg(node, '' ORDER BY pos)), NULL
  FROM nodes WHERE n > 1 GROUP BY source, level, pos // 3
),
subroots AS (SELECT source, node FROM nodes WHERE n = 1),
upper_nodes AS (
  SELECT source, 0 AS level, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS pos,
    count(*) OVER () AS n, node
  FROM subroots
  UNION ALL
  SELECT NULL, level + 1, pos // 3, (any_value(n) + 2) // 3, sha256(string_agg(node, '' ORDER BY pos))
  FROM upper_nodes WHERE n > 1 GROUP BY level, pos // 3
),
root AS (SELECT node FROM upper_nodes WHERE n = 1),
linked AS (
  SELECT true AS low, source, level, pos, n, node FROM nodes
  UNION ALL
  SELECT false, NULL, level, pos, n, node FROM upper_nodes
),
runs AS (
  SELECT low, source, level, pos // 3 AS run, list(node ORDER BY pos) AS members FROM linked WHERE n > 1 GROUP BY ALL
),
places AS (SELECT source, pos, n FROM upper_nodes WHERE level = 0),
climb AS (
  SELECT l.doc, l.doc_id, l.source, l.leaf, true AS low, 0 AS level, p.pos, p.n, l.later AS fold, '' AS proof
  FROM leaves AS l JOIN nodes AS p ON p.doc = l.doc
  UNION ALL
  SELECT * FROM (
    SELECT c.doc, c.doc_id, c.source, c.leaf, true, c.level + 1, r.run, (c.n + 2) // 3,
      sha256(concat(array_to_string(r.members[1:c.pos % 3], ''), c.fold, array_to_string(r.members[c.pos % 3 + 2:], ''))),
      concat(c.proof, array_to_string(r.members[1:c.pos % 3], ''), array_to_string(r.members[c.pos % 3 + 2:], ''))
    FROM climb AS c JOIN runs AS r ON r.low AND r.source IS NOT DISTINCT FROM c.source AND r.level = c.level AND r.run = c.pos // 3
    WHERE c.low AND c.n > 1
    UNION ALL
    SELECT c.doc, c.doc_id, c.source, c.leaf, false, 0, p.pos, p.n, c.fold, c.proof
    FROM climb AS c JOIN places AS p ON p.source IS NOT DISTINCT FROM c.source WHERE c.low AND c.n = 1
    UNION ALL
    SELECT c.doc, c.doc_id, c.source, c.leaf, false, c.level + 1, r.run, (c.n + 2) // 3,
      sha256(concat(array_to_string(r.members[1:c.pos % 3], ''), c.fold, array_to_string(r.members[c.pos % 3 + 2:], ''))),
      concat(c.proof, array_to_string(r.members[1:c.pos % 3], ''), array_to_string(r.members[c.pos % 3 + 2:], ''))
    FROM climb AS c JOIN runs AS r ON NOT r.low AND r.level = c.level AND r.run = c.pos // 3
    WHERE NOT c.low AND c.n > 1
  ) AS steps
)
SELECT c.doc_id, c.leaf, s.node AS subroot, root.node AS root, sha256(c.proof) AS proof_sha256, c.fold AS folded_root,
  c.fold = root.node AS verified
FROM climb AS c JOIN subroots AS s ON s.source IS NOT DISTINCT FROM c.source, root
WHERE NOT c.low AND c.n = 1"""
