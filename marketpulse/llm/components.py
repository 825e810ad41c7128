"""Connected components of a graph given by its links, by alternating star contractions."""

from pyspark.sql import functions as F

from marketpulse.llm.common import stored


def _smallest(pairs, label):
    """The smallest neighbour of each node, stored: the join that follows then has two plain
    shuffles, and Spark splits the one of a node with very many links."""
    return stored(pairs.groupBy("u").agg(F.min("v").alias("m")), label)


def _large_star(links):
    """Every node links its larger neighbours to the smallest node it knows."""
    both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    best = _smallest(both, "components-large").select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(best, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links):
    """Every node links itself and its smaller neighbours to the smallest of them."""
    best = _smallest(links, "components-small")
    moved = links.join(best, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(best.select("u", F.col("m").alias("v")))


def connected(links):
    """node and root (the smallest node of its component) for all nodes that have a link.

    `links` has two columns of numbers in either order; repeated links and links of a node
    with itself are allowed and change nothing. Each round is written to the shared scratch
    folder; the number of rounds grows with the logarithm of the longest chain.
    """
    a, b = links.columns
    links = (
        links.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    )
    links = stored(links, "components")
    state = None
    while True:
        seen = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if seen == state or not seen[0]:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
                links.select("v", "v").distinct()
            )
        state = seen
        links = stored(_large_star(links).distinct(), "components-half")
        links = stored(_small_star(links).distinct(), "components")
