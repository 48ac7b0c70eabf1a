"""Sharding by a hierarchical weighted hash tree: every row descends region, rack and shard by weighted hash draws.

At each node every child draws -ln(u) / weight with u from a hash of the row's key and the child's name; the smallest draw
wins, so children win in proportion to their weights. A draw depends on nothing but key and child: changing a weight moves
rows only between the children of the nodes on its path, and rows in subtrees whose weights stay as they were stay where
they are. A shard opened as a region of its own changes no other subtree and takes rows only into itself.

Null keys draw like any other key (the one of the empty string), null text has no bytes. Equal rows get slots of their
own. Empty tables give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import once

ROWS_PER_BUCKET = 50_000


@dataclass(frozen=True)
class Node:
    """A region, rack or shard. Shards have a number and a weight, the others the sum of their children's."""

    name: str
    children: list[Node] = field(default_factory=list)
    shard: int | None = None
    own_weight: float = 1.0

    @property
    def weight(self) -> float:
        return sum(c.weight for c in self.children) if self.children else self.own_weight


def tree(shards: int, per_rack: int = 4, racks: int = 2, weights: dict[int, float] | None = None) -> Node:
    """Shards in order, ``per_rack`` to a rack and ``racks`` racks to a region."""
    weights = weights or {}
    leaf = [Node(f"s{i}", shard=i, own_weight=weights.get(i, 1.0)) for i in range(shards)]
    rack = [Node(f"k{i}", leaf[i * per_rack : (i + 1) * per_rack]) for i in range(-(-shards // per_rack))]
    region = [Node(f"r{i}", rack[i * racks : (i + 1) * racks]) for i in range(-(-len(rack) // racks))]
    return Node("all", region)


def draw(key: Column, name: Column, weight: Column) -> Column:
    """-ln(u) / weight, with u from the first 52 bits of a digest."""
    bits = F.conv(F.substring(F.md5(F.concat(key, F.lit(":"), name)), 1, 13), 16, 10).cast("double")
    return -F.log((bits + 0.5) / float(1 << 52)) / weight


def _levels(node: Node) -> list[list[Node]]:
    """Inner nodes by depth."""
    out, level = [], [node]
    while inner := [n for n in level if n.children]:
        out.append(inner)
        level = [c for n in inner for c in n.children]
    return out


def place(df: DataFrame, key: str, root: Node, name: str) -> DataFrame:
    """``df`` with the number of the shard that column ``key`` (a string) descends to: one choice per level."""
    df = df.withColumn("_node", F.lit(root.name))
    for level in _levels(root):
        children = F.create_map(*[x for n in level for x in (F.lit(n.name), F.array(*[
            F.struct(F.lit(c.name).alias("name"), F.lit(float(c.weight)).alias("weight")) for c in n.children if c.weight > 0]))])
        drawn = F.array_min(F.transform(children[F.col("_node")], lambda c: F.struct(draw(F.col(key), c["name"], c["weight"]).alias("draw"), c["name"].alias("name"))))
        df = once(df.withColumnRenamed("_node", "_above").withColumn("_node", F.col("_above")), "_chosen", drawn["name"])
        # a shard higher up than others has no children and stays chosen
        df = df.withColumn("_node", F.coalesce("_chosen", "_above")).drop("_chosen", "_above")
    numbers = F.create_map(*[x for leaf in _leaves(root) for x in (F.lit(leaf.name), F.lit(leaf.shard))])
    return df.withColumn(name, numbers[F.col("_node")].cast("int")).drop("_node")


def _leaves(node: Node) -> list[Node]:
    return [leaf for c in node.children for leaf in _leaves(c)] if node.children else [node]


def key_string(key: str) -> Column:
    return F.coalesce(F.col(key).cast("string"), F.lit(""))


def slots(rows: DataFrame, shard: str, order: Column, n_rows: int) -> DataFrame:
    """``rows`` with ``slot``: numbers without gaps from 0 in each shard, in the order of the digest ``order`` (hex).

    Rows are numbered within buckets that share the first digits of the digest, behind the counts of the buckets before.
    The number of digits follows the number of rows, so a bucket holds some tens of thousands; the slots do not depend on it.
    """
    digits = 1
    while 16 ** digits * ROWS_PER_BUCKET < n_rows and digits < 8:
        digits += 1
    marked = rows.withColumn("_order", order).withColumn("_bucket", F.substring("_order", 1, digits))
    counts = marked.groupBy(shard, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(shard).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(F.col(shard).alias("_s"), F.col("_bucket").alias("_b"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    numbered = marked.withColumn("_at", F.row_number().over(Window.partitionBy(shard, "_bucket").orderBy("_order")))
    joined = numbered.join(counts, (F.col(shard) == F.col("_s")) & (F.col("_bucket") == F.col("_b")))
    return joined.withColumn("slot", (F.col("_before") + F.col("_at") - 1).cast("long")).drop("_order", "_bucket", "_s", "_b", "_before", "_at")


def assign(docs: DataFrame, key: str = "doc_id", root: Node | None = None, name: str = "shard") -> DataFrame:
    """``docs`` with the shard each row descends to in the tree ``root`` (16 equal shards if not given)."""
    names = docs.columns
    # numbered names, so that no column of the table clashes with those of the descent
    safe = docs.toDF(*[f"c{i}" for i in range(len(names))])
    placed = place(once(safe, "_key", key_string(f"c{names.index(key)}")), "_key", root or tree(16), "_shard")
    return placed.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names) if c != name], F.col("_shard").alias(name))


def shard_report(docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = 16) -> DataFrame:
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key), (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"), F.lit("key").alias("law"))
    rows = assign(assign(rows, key, tree(shards)), key, tree(shards + 1), "grown_shard")
    numbered = slots(rows, "shard", F.md5(F.concat_ws(":", key_string(key), F.col("text_crc32"), F.col("size"))), docs.count())
    return numbered.select(key, "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def _draw_sql(key: str, c: Node) -> str:
    return f"-ln((('0x' || substr(md5({key} || ':{c.name}'), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0) / {c.weight!r}"


def _place_sql(key: str, node: Node) -> str:
    if node.shard is not None:
        return str(node.shard)
    if len(node.children) == 1:
        return _place_sql(key, node.children[0])
    best = f"least({', '.join(_draw_sql(key, c) for c in node.children)})"
    return "CASE " + " ".join(f"WHEN {_draw_sql(key, c)} = {best} THEN {_place_sql(key, c)}" for c in node.children) + " END"


def report_sql(source: str = "documents", shards: int = 16, columns: str = "doc_id, size, text_crc32, law, shard, slot, grown_shard") -> str:
    """DuckDB SQL of ``shard_report``; its checksum is built from the bits of each byte."""
    return f"""
WITH RECURSIVE bytes AS (SELECT i, CASE WHEN i & 1 = 1 THEN xor(i >> 1, 3988292384) ELSE i >> 1 END AS c, 1 AS k FROM (SELECT unnest(range(256))::BIGINT AS i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bytes WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY i) AS t FROM bytes WHERE k = 8),
d AS (SELECT doc_id, coalesce(doc_id::VARCHAR, '') AS k, coalesce(text, '') AS body FROM {source}),
x AS (SELECT doc_id, k, strlen(body)::BIGINT + 1 AS size,
  xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(body)), '..'), lambda h: ('0x' || h)::BIGINT)),
    lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) AS text_crc32 FROM d, crc_table),
p AS (SELECT *, 'key' AS law, {_place_sql('k', tree(shards))} AS shard, {_place_sql('k', tree(shards + 1))} AS grown_shard FROM x),
s AS (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY md5(k || ':' || text_crc32 || ':' || size)) - 1 AS slot FROM p)
SELECT {columns} FROM s"""
