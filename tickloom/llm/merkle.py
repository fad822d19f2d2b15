"""Merkle manifest of a table, with proofs by descent through content-addressed records.

Leaves are ranked within their group by two-level counting: a range-partitioned, sorted table gives
every row a place in its partition, and the partitions' counts give the places before. Runs of
``fan`` consecutive nodes become one node, level by level, and every node formed is stored as a
record digest -> children, level by level. Proofs come from the root downwards: a request for leaves is (digest,
place, path); joining the records by digest replaces it by one request per child, whose rank
digit is its place among the children, and whose path gains the children not taken. All leaves
share the requests of their common ancestors. At the leaves the paths are reversed and folded.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.text import ascii_lower, stored

FAN = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_STEP = "struct<left:string,right:string>"
_PATH = f"array<{_STEP}>"


def digest(*parts: Column) -> Column:
    """SHA-256 of the parts one after the other, as lower-case hex text."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value with its length in bytes before it, ``-`` for null, so that no two rows read alike."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(**changed: Column) -> Column:
    return digest(*(field(changed.get(c, F.col(c))) for c in FIELDS))


def tampered(doc_id: Column) -> Column:
    """Whether 3 divides the crc32 of the id's digits; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 0, F.lit(False))


def ranked(rows: DataFrame, group: list[str], order: list[str], label: str) -> DataFrame:
    """``rows`` written down with ``n``, the rows in their group, and ``rank``, their place in it from 0.

    Groups and places follow the columns' order, null first. Rows equal in ``order`` are split by an
    arbitrary number, so that no value has to fit into one partition. Windows see one
    row per partition and group, never the rows themselves.
    """
    split = rows.withColumn("_split", F.monotonically_increasing_id())
    keys = [*group, *order, "_split"]
    placed = split.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_split")
    placed = placed.withColumn("_at", F.monotonically_increasing_id())
    part = F.shiftright("_at", 33)
    placed = stored(placed.withColumn("_part", part), label)
    counted = placed.groupBy(*group, "_part").agg(F.count(F.lit(1)).alias("_count"), F.min("_at").alias("_first"))
    whole = Window.partitionBy(*group)
    before = F.coalesce(F.sum("_count").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counted = counted.select(
        *(F.col(g).alias(f"_group{i}") for i, g in enumerate(group)), F.col("_part").alias("_in"),
        F.sum("_count").over(whole).alias("n"), (before - F.col("_first")).alias("_shift"),
    )
    same = [F.col("_part") == F.col("_in"), *(F.col(g).eqNullSafe(F.col(f"_group{i}")) for i, g in enumerate(group))]
    joined = placed.join(counted, reduce(Column.__and__, same))
    return joined.select(*rows.columns, "n", (F.col("_at") + F.col("_shift")).alias("rank"))


@dataclass
class Tree:
    """Roots of all groups and, for every height from 1 on, the records of the nodes formed."""

    roots: DataFrame
    records: list[DataFrame]


def build(nodes: DataFrame, group: list[str], fan: int, label: str) -> Tree:
    """Trees over ``nodes`` (group, n, rank, digest): one root and its height per group.

    A level holds a ``fan``-th of the one below and is written down before the next is made. A
    group with one node left is done and leaves the loop.
    """
    done = [nodes.where("n = 1").select(*group, F.lit(0).alias("height"), "digest")]
    records: list[DataFrame] = []
    height, rest = 0, nodes.where("n > 1").select(*group, "n", "rank", "digest")
    largest = rest.agg(F.max("n")).first()[0] or 1
    while largest > 1:
        height, largest = height + 1, -(-largest // fan)
        runs = rest.groupBy(*group, "n", F.floor(F.col("rank") / fan).alias("run")).agg(
            F.sort_array(F.collect_list(F.struct("rank", "digest"))).alias("found")
        )
        children = F.col("found.digest")
        formed = runs.select(
            *group, F.ceil(F.col("n") / fan).alias("n"), F.col("run").alias("rank"), children.alias("children"),
            digest(F.array_join(children, "")).alias("digest"),
        )
        formed = stored(formed, f"{label}-{height}")
        records.append(formed.select("digest", "children"))
        done.append(formed.where("n = 1").select(*group, F.lit(height).alias("height"), "digest"))
        rest = formed.where("n > 1").select(*group, "n", "rank", "digest")
    return Tree(reduce(DataFrame.unionByName, done), records)


def _children(requests: DataFrame, records: DataFrame, fan: int) -> DataFrame:
    """One request per child: its rank from the digits so far and its own, its path with the others.

    Equal digests have equal children, so records are looked up by their content alone, each kept once. The
    record's table is the smaller side; a digest asked for by many requests is split by
    adaptive execution.
    """
    known = records.groupBy("digest").agg(F.first("children").alias("children"))
    found = requests.join(known, "digest")
    opened = found.select("*", F.posexplode("children").alias("digit", "child"))
    step = F.struct(
        F.array_join(F.slice("children", F.lit(1), F.col("digit")), "").alias("left"),
        F.array_join(F.slice("children", F.col("digit") + 2, F.lit(fan)), "").alias("right"),
    )
    rank = (F.col("rank") * fan + F.col("digit")).alias("rank")
    kept = [c for c in requests.columns if c not in ("digest", "rank", "path", "height")]
    path = F.concat("path", F.array(step.cast(_STEP))).alias("path")
    return opened.select(*kept, (F.col("height") - 1).alias("height"), F.col("child").alias("digest"), rank, path)


def descend(requests: DataFrame, tree: Tree, fan: int, label: str, stop: int = 0) -> DataFrame:
    """Requests at the roots carried down to nodes of height ``stop``, each with its rank and path.

    A request waits until the level of its own root is reached, so shallow trees cost no steps.
    """
    current = requests
    for height in range(len(tree.records), stop, -1):
        waiting = current.where(F.col("height") < height)
        opened = _children(current.where(F.col("height") == height), tree.records[height - 1], fan)
        current = stored(waiting.unionByName(opened), f"{label}-{height - 1}")
    return current


def fold(leaf: Column, path: Column) -> Column:
    """The root's digest recomputed from a leaf and its path, the leaf's own run first."""
    return F.aggregate(path, leaf, lambda now, step: digest(step["left"], now, step["right"]))


def manifest(docs: DataFrame, altered: Column | None = None, altered_text: Column | None = None, fan: int = FAN) -> DataFrame:
    """doc_id, lang, rank, leaf, subroot, root, path, proof_sha256, folded_root and verified of every row.

    A leaf stands for doc_id, source, lang, n_chars and text. Each lang has a tree over its leaves
    by doc_id (null first, equal ids by leaf), and one tree stands over the langs in their order, null first.
    ``path`` lists, from the leaf's run to the root, the digests left and right of the node
    on the way. Where ``altered`` holds, the leaf that is folded is that of ``altered_text``.
    Null and empty texts have leaves of their own, equal rows have equal leaves
    and each its own path, an empty table gives no row, and other columns are not read.
    """
    altered = F.lit(False) if altered is None else altered
    changed = F.col("text") if altered_text is None else altered_text
    original = leaf_digest()
    rows = docs.select("lang", "doc_id", original.alias("leaf"), F.when(altered, leaf_digest(text=changed)).alias("shown"))
    leaves = ranked(rows, ["lang"], ["doc_id", "leaf"], "merkle-leaves")
    leaves = stored(leaves, "merkle-ranked")
    below = build(leaves.withColumnRenamed("leaf", "digest"), ["lang"], fan, "merkle-node")
    subroots = stored(ranked(below.roots, [], ["lang"], "merkle-langs"), "merkle-subroots")
    above = build(subroots, [], fan, "merkle-top")
    root = above.roots.first()
    root_digest = root["digest"] if root else ""
    start = above.roots.select("height", "digest", F.lit(0).cast("long").alias("rank"), F.array().cast(_PATH).alias("path"))
    tops = descend(start, above, fan, "merkle-way").select("rank", "path")
    requests = subroots.join(tops, "rank").select(
        "lang", "height", F.col("digest").alias("subroot"), "digest", F.lit(0).cast("long").alias("rank"), "path"
    )
    # The last step is left to the rows themselves: eight leaves share one path.
    runs = descend(requests, below, fan, "merkle-path", stop=1)
    if below.records:
        known = below.records[0].groupBy("digest").agg(F.first("children").alias("children"))
        runs = runs.join(known, "digest", "left")
    else:
        runs = runs.withColumn("children", F.lit(None).cast("array<string>"))
    runs = runs.select(F.col("lang").alias("_lang"), F.col("rank").alias("_run"), "subroot", "path", "children")
    run = F.floor(F.col("rank") / fan)
    joined = leaves.join(runs, F.col("lang").eqNullSafe(F.col("_lang")) & (run == F.col("_run")))
    place = (F.col("rank") % fan).cast("int")
    last = F.struct(
        F.array_join(F.slice("children", F.lit(1), place), "").alias("left"),
        F.array_join(F.slice("children", place + 2, F.lit(fan)), "").alias("right"),
    ).cast(_STEP)
    down = F.when(F.col("children").isNull(), F.col("path")).otherwise(F.concat("path", F.array(last)))
    proved = joined.withColumn("path", F.reverse(down))
    siblings = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")
    proved = proved.withColumns(
        {"proof_sha256": digest(siblings), "folded_root": fold(F.coalesce("shown", "leaf"), F.col("path")), "root": F.lit(root_digest)}
    )
    columns = ["doc_id", "lang", "rank", "leaf", "subroot", "root", "path", "proof_sha256", "folded_root"]
    return proved.select(*columns, (F.col("folded_root") == F.col("root")).alias("verified"))


def lower_case_tampering(docs: DataFrame) -> DataFrame:
    """The manifest held against rows whose text was lower-cased where 3 divides the id's crc32."""
    return manifest(docs, tampered(F.col("doc_id")), ascii_lower(F.col("text")))
