"""Connected components of links between integer ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def components(links: DataFrame) -> DataFrame:
    """``id, component``: for every id in the links (columns a, b), the smallest id it reaches.

    Each id points to a smaller one of its component. In a round it looks at where its neighbours'
    parents point; the least such id goes to the id itself, to its parent and to its parent's
    parent, so whole trees are hooked and not only their members, and every id skips to its
    parent's parent. A path of n ids in any order takes about log2(n) rounds. Rounds run until nothing points elsewhere,
    each over a written table; links and ids stay distributed, and the driver sees one number a round.
    A link of an id with itself makes it a component; without links there are none.
    """
    links = staged(links.select("a", "b").distinct(), "links")
    both = links.union(links.select("b", "a"))
    parents = staged(both.groupBy(F.col("a").alias("id")).agg(
        F.least(F.min("b"), F.first("a")).alias("parent")), "parents")
    while True:
        above = parents.select(F.col("id").alias("parent"), F.col("parent").alias("grand"))
        known = parents.join(above, "parent").select("id", "parent", "grand")
        near = both.join(known.select(F.col("id").alias("b"), "grand"), "b").groupBy(
            F.col("a").alias("id")).agg(F.min("grand").alias("near"))
        low = F.least("grand", "near")
        moves = known.join(near, "id").select(F.explode(F.array(
            F.struct(F.col("id"), low.alias("to"), F.col("parent").alias("was")),
            *(F.struct(F.col(c).alias("id"), F.col("near").alias("to"), F.lit(None).cast("long").alias("was"))
              for c in ("parent", "grand")))).alias("move")).select("move.*")
        moved = staged(moves.groupBy("id").agg(F.min("to").alias("parent"), F.max("was").alias("was")), "parents")
        parents = moved.drop("was")
        if not moved.filter("parent <> was").limit(1).count():
            return parents.withColumnRenamed("parent", "component")
