"""Connected components of a table of links, by rounds of joins."""

from pyspark.sql import functions as F

from barworks.session import delete_path, scratch_path, write_and_reread


def connected_components(links):
    """(node, component): the smallest node reachable, for every node of ``links`` (a, b).

    Alternates two steps until neither changes the links: every node hands its
    smallest neighbour to its larger neighbours, then to its smaller ones. Rounds
    grow with the logarithm of the nodes. The only groups are aggregates to one
    row, combined before the shuffle; hot nodes meet in joins, which adaptive
    execution splits. Each round is a written table. Self-links and nulls are dropped.
    """
    spark = links.sparkSession
    paths = [scratch_path(spark, "components")]
    links = write_and_reread(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), paths[0])
    state = None
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("least")).select(F.col("u").alias("node"), F.least("u", "least").alias("least"))
        large = (both.filter("v > u").join(least, F.col("u") == F.col("node"))
                 .select(F.col("v").alias("u"), F.col("least").alias("v")).filter("u <> v").distinct())
        large = write_and_reread(large, scratch_path(spark, "components"))
        small_least = large.groupBy("u").agg(F.min("v").alias("least")).withColumnRenamed("u", "node")
        small = large.join(small_least, F.col("u") == F.col("node"))
        small = small.select(F.when(F.col("v") == F.col("least"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("least").alias("v"))
        paths.append(scratch_path(spark, "components"))
        links = write_and_reread(small.filter("u <> v").distinct(), paths[-1])
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
        if len(paths) > 2:
            delete_path(spark, paths.pop(0))
    nodes = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
