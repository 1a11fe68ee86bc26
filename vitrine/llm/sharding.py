"""Sharding by a hierarchical weighted hash tree, as expressions only.

A tree has regions, racks and shards with weights; a node weighs as much as its shards. A row descends from the root: at each
level every child draws ``-ln(u) / weight`` with ``u`` hashed from the key and the child's name, and the smallest draw
wins. A child's draw does not depend on its siblings, so when weights change, rows move only into, or within, subtrees whose
weights change. :func:`grow` appends a shard as a region of its own: then no other draw changes and rows move into the
new shard only, at any number of shards.

Slots number the rows of a shard without a window over the whole shard: rows are counted by (shard, bucket), the counts
are summed up (shards x buckets rows at most, whatever the input), and ranks inside a bucket are added. Repeated rows are
collapsed to a count before the shuffle, and expanded in chunks.

Defined cases: a null text has no bytes and checksum 0; a null key hashes as the empty string; equal (key, size,
checksum) rows get consecutive slots; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

#: Rows of one group that a task expands at once.
CHUNK = 100_000


@dataclass(frozen=True)
class Topology:
    """``regions[r][k]``: the (shard, weight) pairs of rack ``k`` in region ``r``."""

    regions: tuple[tuple[tuple[tuple[int, float], ...], ...], ...] = field(default=())

    @staticmethod
    def even(regions: int, racks: int, shards: int) -> Topology:
        number = iter(range(regions * racks * shards))
        return Topology(tuple(tuple(tuple((next(number), 1.0) for _ in range(shards)) for _ in range(racks)) for _ in range(regions)))

    @property
    def n_shards(self) -> int:
        return sum(len(rack) for region in self.regions for rack in region)

    def grow(self, weight: float = 1.0) -> Topology:
        """One shard more, in a new region."""
        return Topology((*self.regions, (((self.n_shards, weight),),)))

    def children(self) -> dict[str, list[tuple[str, float]]]:
        """Children and weights by node name; the root is the empty name, a shard is named by its number."""
        out: dict[str, list[tuple[str, float]]] = {"": []}
        for r, region in enumerate(self.regions):
            out[""].append((f"r{r}", sum(w for rack in region for _, w in rack)))
            out[f"r{r}"] = [(f"r{r}k{k}", sum(w for _, w in rack)) for k, rack in enumerate(region)]
            out |= {f"r{r}k{k}": [(str(s), w) for s, w in rack] for k, rack in enumerate(region)}
        return out


def _draw(key: Column, child: Column) -> Column:
    u = (F.shiftrightunsigned(F.xxhash64(key, child["name"]), 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(u) / child["weight"]


def _winner(key: Column, children: Column) -> Column:
    return F.array_min(F.transform(children, lambda c: F.struct(_draw(key, c).alias("draw"), c["name"].alias("name"))))["name"]


def _literal(children: list[tuple[str, float]]) -> Column:
    return F.array(*[F.struct(F.lit(n).alias("name"), F.lit(float(w)).alias("weight")) for n, w in children if w > 0])


def add_shard(df: DataFrame, topology: Topology, key: str, out: str = "shard") -> DataFrame:
    """``df`` with the shard number of each row; three levels, one draw per child of the chosen nodes."""
    tree = topology.children()
    regions, racks = tree.pop(""), {n: c for n, c in tree.items() if "k" not in n}
    shards = {n: c for n, c in tree.items() if "k" in n}
    lookup = lambda nodes: F.create_map(*[x for n, c in nodes.items() for x in (F.lit(n), _literal(c))])
    k = F.coalesce(F.col(key).cast("string"), F.lit(""))
    step = df.withColumn("__region", _winner(k, _literal(regions)))
    step = step.withColumn("__rack", _winner(k, F.element_at(lookup(racks), F.col("__region"))))
    return step.withColumn(out, _winner(k, F.element_at(lookup(shards), F.col("__rack"))).cast("int")).drop("__region", "__rack")


def place(df: DataFrame, topology: Topology, key: str = "doc_id", text: str = "text", buckets: int = 256) -> DataFrame:
    """(key, size, text_crc32, shard, slot, grown_shard) of every row; only these narrow columns are shuffled."""
    raw = F.col(text).cast("string").cast("binary")
    narrow = df.select(F.col(key), (F.coalesce(F.octet_length(raw), F.lit(0)).cast("long") + 16).alias("size"), F.coalesce(F.crc32(raw), F.lit(0)).cast("long").alias("text_crc32"))
    same = narrow.groupBy(key, "size", "text_crc32").agg(F.count("*").alias("copies"))
    placed = add_shard(add_shard(same, topology, key, "shard"), topology.grow(), key, "grown_shard")
    # Written once: texts are read and draws are made one time for both the sums and the ranks.
    placed = cut(placed.withColumn("bucket", F.pmod(F.xxhash64(key, "size", "text_crc32"), F.lit(buckets)).cast("int")))
    sums = placed.groupBy("shard", "bucket").agg(F.sum("copies").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("shard", "bucket").orderBy(F.col(key).asc_nulls_first(), "size", "text_crc32").rowsBetween(Window.unboundedPreceding, -1)
    ranked = placed.withColumn("rank", F.coalesce(F.sum("copies").over(inside), F.lit(0)))
    # At most shards x buckets rows.
    first = ranked.join(F.broadcast(base), ["shard", "bucket"]).withColumn("first", F.col("base") + F.col("rank"))
    cols = [key, "size", "text_crc32", "shard", "grown_shard"]
    few = first.where(F.col("copies") <= CHUNK).select(*cols, F.explode(F.sequence("first", F.col("first") + F.col("copies") - 1)).alias("slot"))
    parts = first.where(F.col("copies") > CHUNK).select(*cols, "first", "copies", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(copies - 1) div {CHUNK}"))).alias("part"))
    spread = parts.repartition(key, "part").withColumn("from", F.col("first") + F.col("part") * CHUNK)
    many = spread.select(*cols, F.explode(F.sequence("from", F.least(F.col("from") + CHUNK, F.col("first") + F.col("copies")) - 1)).alias("slot"))
    return few.unionByName(many).select(key, "size", "text_crc32", "shard", "slot", "grown_shard")
