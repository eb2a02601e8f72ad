"""Hierarchical weighted hash tree: region, rack and shard are drawn level by level.

At each node a child draws ``-ln(u) / weight`` with ``u`` hashed from the key and the
child's path; the smallest draw wins, so a child wins in proportion to its weight, and a
changed weight moves keys only into or out of that child. Rows therefore move only inside
subtrees whose weights change.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from talweg.llm.common import ready, table

#: Rows of a shard that are numbered together; a parameter of ``assign``.
CELL_ROWS = 4096
#: Racks in a region and shards in a rack of the first, symmetric part of the tree.
REGIONS, RACKS, SHARDS = 2, 2, 2


@dataclass(frozen=True)
class Leaf:
    region: int
    rack: int
    shard: int
    weight: float = 1.0


def tree(shards: int) -> list[Leaf]:
    """Shards 0 to 7 fill two regions of two racks of two; each later one opens a region.

    A shard that opens its own region is the only thing under the changed weight, so
    one more shard takes rows only into itself. Fewer than 8 shards have no such order:
    they are refused.
    """
    first = REGIONS * RACKS * SHARDS
    if shards < first:
        raise ValueError(f"the tree starts with {first} shards")
    block = [Leaf(s // (RACKS * SHARDS), s // SHARDS % RACKS, s) for s in range(first)]
    return block + [Leaf(REGIONS + s - first, 0, s) for s in range(first, shards)]


def _uniform(key: Column, path: str) -> Column:
    """A number in (0, 1) from 52 bits of a digest of the key and a node's path."""
    bits = F.conv(F.substring(F.md5(F.concat(key, F.lit(f"/{path}"))), 1, 13), 16, 10).cast("double")
    return (bits + 0.5) / float(2**52)


def _draw(key: Column, children: list[tuple[int, str, float]]) -> Column:
    """Number of the child with the smallest draw; children are (number, path, weight)."""
    if len(children) == 1:
        return F.lit(children[0][0])
    draws = [
        F.struct((-F.log(_uniform(key, path)) / weight).alias("d"), F.lit(number).alias("c"))
        for number, path, weight in children
    ]
    return F.least(*draws)["c"]


def _weights(leaves: list[Leaf], name) -> dict:
    sums: dict = {}
    for leaf in leaves:
        sums[name(leaf)] = sums.get(name(leaf), 0.0) + leaf.weight
    return sums


def _choose(of: Column, options: dict[int, Column]) -> Column:
    chosen = F.lit(None).cast("int")
    for number, column in options.items():
        chosen = F.when(of == number, column).otherwise(chosen)
    return chosen


def place(df: DataFrame, key: Column, leaves: list[Leaf], out: str) -> DataFrame:
    """Add the shard that the tree gives each key. A null key is the key with no text.

    Leaves of weight 0 get nothing. Shards are numbered by the leaves.
    """
    leaves = [leaf for leaf in leaves if leaf.weight > 0]
    key = F.coalesce(key.cast("string"), F.lit(""))
    regions = _weights(leaves, lambda x: x.region)
    racks = _weights(leaves, lambda x: (x.region, x.rack))
    df = df.withColumn("_region", _draw(key, [(r, f"{r}", w) for r, w in regions.items()]))
    df = df.withColumn(
        "_rack",
        _choose(
            F.col("_region"),
            {r: _draw(key, [(k, f"{q}/{k}", w) for (q, k), w in racks.items() if q == r]) for r in regions},
        ),
    )
    shard = F.lit(None).cast("int")
    for region, rack in racks:
        below = [(x.shard, f"{region}/{rack}/{x.shard}", x.weight) for x in leaves if (x.region, x.rack) == (region, rack)]
        shard = F.when((F.col("_region") == region) & (F.col("_rack") == rack), _draw(key, below)).otherwise(shard)
    return df.withColumn(out, shard).drop("_region", "_rack")


def assign(docs: DataFrame, shards: int = 8, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Shard, slot in the shard and shard after growth of every document.

    Slots are gapless in each shard, without sorting a shard in one task: rows are numbered in hashed
    cells, and the running sum of the cell sizes is added. Only ids and sizes are shuffled.
    Null text has size 1 and the checksum of no bytes; rows with the same id share a shard and have
    their own slots; an empty table gives an empty result. Other columns are ignored.
    """
    cells = max(1, -(-docs.count() // (shards * cell_rows)))
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    cell = F.conv(F.substring(F.md5(F.concat(key, F.lit("/cell"))), 1, 7), 16, 10).cast("long") % cells

    def placed(df: DataFrame) -> DataFrame:
        return place(df.withColumn("cell", cell), F.col("doc_id"), tree(shards), "shard")

    rows = placed(
        docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    )
    rows = place(rows, F.col("doc_id"), tree(shards + 1), "grown_shard")
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed(docs.select("doc_id")).groupBy("shard", "cell").agg(F.count(F.lit(1)).alias("n"))
        .select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    )
    inside = Window.partitionBy("shard", "cell").orderBy("doc_id", "size", "text_crc32")
    return (
        rows.withColumn("place", F.row_number().over(inside) - 1)
        .join(starts, ["shard", "cell"])
        .select(
            "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
            (F.col("start") + F.col("place")).cast("long").alias("slot"), "grown_shard",
        )
    )


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 7 under the ``key`` law."""
    return assign(table(spark, sf_dir, "documents"))


def _sql_draw(children: list[tuple[int, str, float]]) -> str:
    if len(children) == 1:
        return str(children[0][0])
    draws = ", ".join(
        f"{{'d': -ln((('0x' || substr(md5(k || '/{path}'), 1, 13))::BIGINT::DOUBLE + 0.5) / {2**52}.0) / {weight!r}, 'c': {number}}}"
        for number, path, weight in children
    )
    return f"least({draws}).c"


def _sql_place(leaves: list[Leaf]) -> str:
    regions, racks = _weights(leaves, lambda x: x.region), _weights(leaves, lambda x: (x.region, x.rack))
    arms = []
    for region in regions:
        inner = " ".join(
            f"WHEN {k} THEN " + _sql_draw([(x.shard, f"{region}/{k}/{x.shard}", x.weight) for x in leaves if (x.region, x.rack) == (region, k)])
            for r, k in racks if r == region
        )
        arms.append(f"WHEN {region} THEN CASE {_sql_draw([(k, f'{region}/{k}', w) for (r, k), w in racks.items() if r == region])} {inner} END")
    return f"CASE {_sql_draw([(r, str(r), w) for r, w in regions.items()])} {' '.join(arms)} END"


OP1_SQL = f"""
WITH steps AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i::UBIGINT, [j::UBIGINT FOR j IN range(8)]),
      lambda c, j: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::UBIGINT) ELSE c // 2 END) AS c
    FROM range(256) r(i))),
sized AS (
  SELECT doc_id, coalesce(doc_id::VARCHAR, '') AS k, octet_length(encode(coalesce(text, ''))) + 1 AS size,
    xor(list_reduce(list_prepend(4294967295::UBIGINT,
      list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::UBIGINT)),
      lambda c, b: xor(c // 256, t[(xor(c, b) % 256 + 1)::BIGINT])), 4294967295::UBIGINT)::BIGINT AS text_crc32
  FROM documents, steps),
placed AS (
  SELECT *, {_sql_place(tree(8))} AS shard, {_sql_place(tree(9))} AS grown_shard,
    ('0x' || substr(md5(k || '/cell'), 1, 7))::BIGINT
      % (SELECT greatest(1, (count(*) + {8 * CELL_ROWS - 1}) // {8 * CELL_ROWS}) FROM documents) AS cell
  FROM sized)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY cell, doc_id, size, text_crc32) - 1 AS slot, grown_shard
FROM placed
"""

QUERIES = {"op1_sharding": ready(op1_sharding)}
ORACLES = {"op1_sharding": OP1_SQL}
