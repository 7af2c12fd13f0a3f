"""Connected components by joins over staged tables, without collecting links."""

from pyspark.sql import functions as F

from auditloom.storage import few_tasks, staged


def connected_components(links, max_rounds=100):
    """(node, root) for every node of ``links`` (a, b); the root is the smallest node reachable.

    Each round every node looks at the grandparents of its neighbours, hooks its parent and
    itself to the smallest of them, and jumps to its own grandparent, so the number of rounds grows
    with the logarithm of the longest path. Minima are combined before each shuffle, and a
    round is written to the shared folder before the next one reads it.
    """
    edges = staged(
        links.select(F.col("a").alias("u"), F.col("b").alias("v"))
        .unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v"))), "edges")
    rows = 2 * edges.count()   # a round makes two offers for each node, and no more nodes than edges
    parents = staged(few_tasks(
        edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("_least"))
        .select("node", F.least("node", "_least").alias("parent"), F.lit(True).alias("changed")), rows), "parents")
    for _ in range(max_rounds):
        if parents.where("changed").isEmpty():
            return parents.select("node", F.col("parent").alias("root"))
        upper = parents.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
        nodes = parents.select("node", "parent").join(upper, "parent")
        near = edges.join(nodes.select(F.col("node").alias("v"), "grand"), "v").groupBy("u").agg(
            F.min("grand").alias("least"))
        nodes = nodes.join(near.withColumnRenamed("u", "node"), "node")
        offers = nodes.select(F.explode(F.array(
            F.struct("node", F.least("parent", "grand", "least").alias("parent"), F.col("parent").alias("old")),
            F.struct(F.col("parent").alias("node"), F.col("least").alias("parent"),
                     F.lit(None).cast("bigint").alias("old")))).alias("o")).select("o.*")
        parents = staged(few_tasks(
            offers.groupBy("node").agg(F.min("parent").alias("parent"), F.max("old").alias("old"))
            .select("node", "parent", (F.col("parent") != F.col("old")).alias("changed")), rows), "parents")
    raise RuntimeError(f"no end after {max_rounds} rounds")
