"""Connected components of a link table, in rounds of hooking and contraction.

Each round hooks every node to its smallest neighbour, follows the hooks to
their roots by pointer jumping and contracts the links onto the roots; every
node that is not smaller than all its neighbours disappears.  The number of
rounds is logarithmic.  Links are never collected; every round is staged in
the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chorus.llm.common import stage


def _roots(hooks: DataFrame) -> DataFrame:
    """(node, up) with ``up`` replaced by the root of the hook chain.  Hooks
    point to strictly smaller nodes, so chains end."""
    hooks = stage(hooks)
    while True:
        above = hooks.select(F.col("node").alias("_n"), F.col("up").alias("_up"))
        jumped = stage(hooks.join(above, F.col("up") == F.col("_n"), "left")
                       .select("node", F.coalesce("_up", "up").alias("up"),
                               (F.col("_up") < F.col("up")).alias("_moved")))
        moved = jumped.filter("_moved").limit(1).count()
        hooks = jumped.select("node", "up")
        if not moved:
            return hooks


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): root is the same for
    exactly the nodes that links connect, and is one of them."""
    links = stage(links.filter("a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    rounds: list[DataFrame] = []
    while links.limit(1).count():
        both = links.union(links.select("b", "a"))
        least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("_low"))
        roots = _roots(least.filter("_low < node")
                       .select("node", F.col("_low").alias("up")))
        rounds.append(roots)
        a = roots.toDF("_na", "_ra")
        b = roots.toDF("_nb", "_rb")
        links = stage(
            links.join(a, F.col("a") == F.col("_na"), "left")
            .join(b, F.col("b") == F.col("_nb"), "left")
            .select(F.coalesce("_ra", "a").alias("x"), F.coalesce("_rb", "b").alias("y"))
            .filter("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
            .distinct())
    if not rounds:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    # A node hooked in round k has its root of round k; that root may be
    # hooked again in a later round.
    out = rounds[0]
    for later in rounds[1:]:
        step = later.toDF("_n", "_r")
        moved = out.join(step, F.col("up") == F.col("_n"), "left") \
            .select("node", F.coalesce("_r", "up").alias("up"))
        out = stage(moved.union(later))
    own = out.select(F.col("up").alias("node"), "up").distinct()
    return out.union(own).select("node", F.col("up").alias("root"))
