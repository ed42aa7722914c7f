"""A Merkle manifest of a dataset from concatenated level strings.

Leaves of a group are in order, and every FAN consecutive nodes of a level become their hash, up to the group's root; the
groups' roots, in order, become the dataset's root likewise. An aligned block of FAN ** LEVELS nodes keeps each level as one
string of hex digests, so that parents are hashes of substrings of fixed width, and the siblings of a node are the
substrings to its left and right within its run. The tops of blocks are the nodes of the next round ("roots recurse"), so no
task ever holds more of a group than one block. Level strings are held as the bytes of their hex text, whose
substrings cost no scan.

A path is an array of (left, right), from the leaf's run to the root: the siblings' digests, concatenated.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medlattice.llm.common import settle

FAN = 3
LEVELS = 5
BLOCK = FAN ** LEVELS
HEX = 64
PATH = "array<struct<left:string,right:string>>"


def leaf_hash(*fields: Column) -> Column:
    """Hex SHA-256 of the fields in turn: ``-`` if null, else the byte count of the value's text, ``:`` and that text."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def _parents(level: Column) -> Column:
    """The next level: the hash of each run of FAN nodes, the last run may have fewer."""
    runs = F.sequence(F.lit(0), F.floor((F.length(level) - 1) / (FAN * HEX)).cast("int"))
    return F.array_join(F.transform(runs, lambda i: F.sha2(F.substring(level, i * FAN * HEX + 1, F.lit(FAN * HEX)), 256)), "").cast("binary")


def _places(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Adds ``place`` (from 0) in its key's order and ``n``, the key's rows, without moving a key into one task: sorted ranges are written
    once, and the table of each range's keys, one row for each, gives what comes before."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(parts, key, *order).sortWithinPartitions(key, *order)
    number = F.spark_partition_id()
    ranged = settle(ranged.withColumn("__part", number).withColumn("__row", F.monotonically_increasing_id() - F.shiftleft(number.cast("long"), 33)), "ordered")
    runs = ranged.groupBy(key, "__part").agg(F.count("*").alias("__many"), F.min("__row").alias("__first"))
    by = Window.partitionBy(key)
    before = F.sum("__many").over(by.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    runs = settle(runs.select(key, "__part", (F.coalesce(before, F.lit(0)) - F.col("__first")).alias("__shift"), F.sum("__many").over(by).alias("n")), "runs")
    return (ranged.join(runs, [key, "__part"]).withColumn("place", F.col("__row") + F.col("__shift"))
            .drop("__part", "__row", "__shift"))


def _blocks(nodes: DataFrame) -> DataFrame:
    """(key, n, place, node, payload) -> one row for each aligned block: its payloads in order, its level strings
    that were hashed, from below, and ``top``. A block of a larger key goes up LEVELS levels, an only block until one node is left."""
    block = F.floor(F.col("place") / BLOCK).alias("block")
    rows = nodes.groupBy("key", "n", block).agg(F.sort_array(F.collect_list(F.struct("place", "node", "payload"))).alias("items"))
    rows = rows.select("key", "n", "block", F.transform("items", lambda x: x["payload"]).alias("payloads"),
                       F.array_join(F.transform("items", lambda x: x["node"]), "").cast("binary").alias("l0"))
    for j in range(LEVELS):
        up = (F.col("n") > BLOCK) | (F.length(f"l{j}") > HEX)
        rows = rows.withColumn(f"l{j + 1}", F.when(up, _parents(F.col(f"l{j}"))))
    hashed = F.array_compact(F.array(*[F.when(F.col(f"l{j + 1}").isNotNull(), F.col(f"l{j}")) for j in range(LEVELS)]))
    top = F.coalesce(*[F.col(f"l{j}") for j in range(LEVELS, -1, -1)]).cast("string")
    return settle(rows.select("key", "n", "block", "payloads", hashed.alias("levels"), top.alias("top")), "blocks")


def _up(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The tables of blocks, from below, and (key, top) of each key."""
    tables, tops = [], None
    while True:
        tables.append(_blocks(nodes))
        done = tables[-1].where(F.col("n") <= BLOCK).select("key", "top")
        tops = done if tops is None else tops.union(done)
        more = tables[-1].where(F.col("n") > BLOCK)
        if more.isEmpty():
            return tables, tops
        nodes = more.select("key", F.ceil(F.col("n") / BLOCK).alias("n"), F.col("block").alias("place"), F.col("top").alias("node"),
                            F.lit(None).cast("int").alias("payload"))


def _segment(level: Column, place: Column) -> Column:
    """The siblings at ``place`` of a level: digests to the left and to the right within its run."""
    place = place.cast("int")
    run = F.floor(place / FAN).cast("int") * FAN
    left = F.substring(level, run * HEX + 1, (place - run) * HEX)
    right = F.substring(level, (place + 1) * HEX + 1, (run + FAN - 1 - place) * HEX)
    return F.struct(left.cast("string").alias("left"), right.cast("string").alias("right"))


def _down(tables: list[DataFrame], above: DataFrame) -> DataFrame:
    """(key, place, payload, crown, path) of the lowest nodes; ``above`` has (key, crown, path), the path above each key."""
    known = None
    for table in reversed(tables):
        rows = table.where(F.col("n") <= BLOCK).join(above, "key")
        if known is not None:
            upper = known.select("key", F.col("place").alias("block"), "crown", "path")
            rows = rows.unionByName(table.where(F.col("n") > BLOCK).join(upper, ["key", "block"]))

        def item(payload, i):
            own = F.transform("levels", lambda level, j: _segment(level, F.floor(i / F.pow(F.lit(float(FAN)), j))))
            return F.struct((F.col("block") * BLOCK + i).alias("place"), payload.alias("payload"), F.concat(own, F.col("path")).alias("path"))

        known = rows.select("key", "crown", F.inline(F.transform("payloads", item))).select("key", "place", "payload", "crown", "path")
    return known


@dataclass
class Manifest:
    """Blocks of the groups' trees and of the tree over their roots, as tables in the shared folder."""

    groups: list[DataFrame]
    crown: list[DataFrame]
    subroots: DataFrame  # group, subroot, place, n
    root: DataFrame  # key (empty), root: one row, none for an empty dataset

    def proofs(self) -> DataFrame:
        """The rows of the manifest's table with ``subroot``, ``root`` and ``path`` (from the leaf to the root)."""
        end = self.root.select("key", F.struct("root").alias("crown"), F.array().cast(PATH).alias("path"))
        over = _down(self.crown, end).select(F.col("payload.key").alias("key"), F.struct(F.col("payload.subroot").alias("subroot"), "crown.root").alias("crown"), "path")
        rows = _down(self.groups, settle(over, "subroots"))
        names = [f"payload.{c}" for c in rows.schema["payload"].dataType.names if c not in ("subroot", "root", "path")]
        return rows.select(*names, "crown.subroot", "crown.root", "path")


def build_manifest(rows: DataFrame, group_col: str = "source", order_cols: tuple[str, ...] = ("doc_id",), leaf_col: str = "leaf") -> Manifest:
    """The trees over ``rows`` (one leaf each, with all columns that proofs should carry).

    A group's leaves ascend by ``order_cols`` (null first), ties by leaf; rows that repeat both are leaves of their own, in any order, which gives
    the same digests. Groups are in bytewise order of their text, null first. A lone leaf is its group's subroot, a lone
    subroot the root. No rows: no subroots and no root. Columns named subroot, root or path give way to the proofs' own.
    """
    key = F.coalesce(F.concat(F.lit("1"), F.col(group_col).cast("string")), F.lit("0"))
    nodes = settle(rows.select(key.alias("key"), *[F.col(c).alias(f"o{i}") for i, c in enumerate(order_cols)], F.col(leaf_col).alias("node"),
                               F.struct(*rows.columns).alias("payload")), "leaves")
    placed = _places(nodes, "key", [*[f"o{i}" for i in range(len(order_cols))], "node"])
    groups, tops = _up(placed.select("key", "n", "place", "node", "payload"))
    tops = tops.select(F.lit("").alias("one"), "key", F.col("top").alias("node"))
    over = _places(settle(tops, "tops"), "one", ["key"])
    over = settle(over.select(F.col("one").alias("key"), "n", "place", "node", F.struct("key", F.col("node").alias("subroot")).alias("payload")), "tops")
    crown, root = _up(over)
    name = F.when(F.col("payload.key") != "0", F.expr("substring(payload.key, 2)"))
    return Manifest(groups, crown, over.select(name.alias(group_col), "payload.subroot", "place", "n"), root.select("key", F.col("top").alias("root")))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def siblings(path: Column) -> Column:
    """All siblings' digests of a path, from the leaf to the root and from left to right, concatenated."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")
