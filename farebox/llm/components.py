"""Connected components of a link table, by repeated star contraction.

Every round gives each vertex the smallest label among its own and its
neighbours', then follows labels of labels (pointer jumping), so the number of
rounds grows with the logarithm of a component's width.  Each round is two
aggregations over the links that still join different labels; links inside one
label are dropped.  Rounds are cut with tables in the shared folder, so a lost
executor costs at most one round.  Nothing but a count reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import staged


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): every id that occurs in ``links`` with the smallest id
    reachable from it.  Links may repeat; null ends are ignored."""
    links = (links.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
             .select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")))
    # label: id -> smaller id it is known to be joined with; every round contracts
    parts: list[DataFrame] = []
    now = staged(links.distinct(), "links")
    while not now.isEmpty():
        # each vertex hooks to its smallest neighbour if that is smaller
        both = now.select("hi", "lo").unionByName(now.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        hook = both.groupBy("hi").agg(F.min("lo").alias("to")).filter("to < hi")
        hook = staged(hook.select(F.col("hi").alias("id"), "to"), "hooks")
        flat = jumped(hook)
        parts.append(flat)
        ends = (now.join(flat.select(F.col("id").alias("hi"), F.col("to").alias("hi2")), "hi", "left")
                .join(flat.select(F.col("id").alias("lo"), F.col("to").alias("lo2")), "lo", "left")
                .select(F.coalesce("hi2", "hi").alias("x"), F.coalesce("lo2", "lo").alias("y")))
        now = staged(ends.filter("x != y").select(F.greatest("x", "y").alias("hi"), F.least("x", "y").alias("lo"))
                     .distinct(), "links")
    ids = links.select(F.col("hi").alias("id")).unionByName(links.select(F.col("lo").alias("id"))).distinct()
    out = ids.withColumn("component", F.col("id"))
    for flat in parts:
        out = (out.join(flat.select(F.col("id").alias("component"), "to"), "component", "left")
               .select("id", F.coalesce("to", "component").alias("component")))
    return out


def jumped(hook: DataFrame) -> DataFrame:
    """Follow ``to`` until it is a root: (id, to) with to never an id."""
    while True:
        further = hook.select(F.col("id").alias("to"), F.col("to").alias("further"))
        out = staged(hook.join(further, "to", "left")
                     .select("id", F.coalesce("further", "to").alias("to"), F.col("further").isNotNull().alias("moved")),
                     "jumps")
        hook = out.select("id", "to")
        if out.filter("moved").isEmpty():
            return hook
