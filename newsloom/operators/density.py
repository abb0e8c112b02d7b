"""Topics by density: how many there are, and which rows belong to none, follows from the data.

1. Neighbours. The core distance of a row is that to its min_samples-th nearest other row. Neighbours are
   joined by the mutual reachability distance: the largest of their distance and both core distances.
2. A minimum spanning forest of those links, by rounds in which every component takes its shortest link
   to another (a table of labels, a table of links between different labels).
3. The condensed tree. Links are taken from the shortest on. A component that reaches min_size rows is a
   cluster; later, small components fall to the cluster they meet, and two clusters that meet are the
   children of a new one. Links come in bands of at most BAND links, one band a round; within a band each
   component of its links is worked on by itself.
4. Selection. The stability of a cluster is the sum over its rows of 1 / distance at which they leave it less
   1 / distance at which it begins; a cluster is a topic if it is more stable than the best choice among its
   descendants together. The tree is walked level by level, on tables.

Rows that leave before a selected cluster begins are outliers. Trees of the forest that no link connects meet
at an infinite distance, so each begins as a cluster of all its rows. A whole that never splits has no topic:
the cluster of all rows of a connected forest cannot be selected. Equal distances are ordered by
seq, so the result does not depend on partitions. Rows without a direction (null or zero vectors) are outliers.
Equal vectors are one row of more weight: they count as each other's neighbours and belong together.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions.vectors import keyed
from newsloom.operators import corpus
from newsloom.operators.neighbours import CELL_ROWS, components, kept, nearest_neighbours, unit_rows
from newsloom.sources.stages import scratch

OUTLIER = -1
BAND = 1_000_000
# Rows at no distance leave a cluster at this one, so that stabilities are finite.
LEAST_DISTANCE = 1e-6


def reachability(rows: DataFrame, k: int, min_samples: int, folder: str, cell_rows: int = CELL_ROWS) -> DataFrame:
    """a, b (a < b), d: the links of each row with its k nearest, at their mutual reachability distance. rows: seq, vector, weight."""
    near = kept(nearest_neighbours(rows, max(k, min_samples), folder=folder, cell_rows=cell_rows), folder, "neighbours")
    weights = rows.select("seq", "weight")
    counted = near.join(weights.select(F.col("seq").alias("other"), F.col("weight").alias("w")), "other")
    so_far = Window.partitionBy("seq").orderBy("distance", "other").rowsBetween(Window.unboundedPreceding, 0)
    reach = counted.withColumn("have", F.sum("w").over(so_far)).join(weights, "seq").withColumn("have", F.col("have") + F.col("weight") - 1)
    core = reach.groupBy("seq").agg(F.max("weight").alias("weight"), F.min(F.when(F.col("have") >= min_samples, F.col("distance"))).alias("at"), F.max("distance").alias("far"))
    core = kept(core.select("seq", F.when(F.col("weight") > min_samples, 0.0).otherwise(F.coalesce("at", "far")).alias("core")), folder, "cores")
    pairs = near.groupBy(F.least("seq", "other").alias("a"), F.greatest("seq", "other").alias("b")).agg(F.min("distance").alias("d"))
    pairs = pairs.join(core.select(F.col("seq").alias("a"), F.col("core").alias("ca")), "a").join(core.select(F.col("seq").alias("b"), F.col("core").alias("cb")), "b")
    return kept(pairs.select("a", "b", F.greatest("d", "ca", "cb").alias("d")), folder, "links")


def spanning_forest(vertices: DataFrame, links: DataFrame, folder: str) -> DataFrame:
    """The links of the minimum spanning forest; of equal lengths the smaller (a, b) first. Each round at least halves the components that have a link."""
    label, forest, n = vertices.select("seq", F.col("seq").alias("root")), None, 0
    live = links.withColumns({"ra": F.col("a"), "rb": F.col("b")})
    while True:
        sides = live.select(F.col("ra").alias("root"), "d", "a", "b", F.col("rb").alias("to")).unionByName(live.select(F.col("rb").alias("root"), "d", "a", "b", F.col("ra").alias("to")))
        best = kept(sides.groupBy("root").agg(F.min(F.struct("d", "a", "b", "to")).alias("e")), folder, f"shortest-{n}")
        if best.isEmpty():
            break
        found = best.select("e.a", "e.b", "e.d").distinct()
        forest = found if forest is None else forest.unionByName(found)
        joined = components(best.select(F.col("root").alias("seq")), best.select(F.col("root").alias("a"), F.col("e.to").alias("b")), f"{folder}/round-{n}")
        to = joined.select(F.col("seq").alias("root"), F.col("component").alias("into"))
        label = kept(label.join(to, "root", "left").select("seq", F.coalesce("into", "root").alias("root")), folder, f"roots-{n}")
        ra, rb = to.select(F.col("root").alias("ra"), F.col("into").alias("na")), to.select(F.col("root").alias("rb"), F.col("into").alias("nb"))
        live = kept(live.join(ra, "ra").join(rb, "rb").where("na != nb").select("a", "b", "d", F.col("na").alias("ra"), F.col("nb").alias("rb")), folder, f"live-{n}")
        n += 1
    return links.limit(0) if forest is None else kept(forest, folder, "forest")


def condense(links: pd.DataFrame, min_size: int) -> tuple[list, list]:
    """One component of a band: what became of each root at its start, and the clusters that met.

    links: e (the link's number), ra, rb, d in the order of e, with sa, sb, ca, cb: size and cluster (or null) of both
    roots. A cluster that a link makes is named by it, 2 e. Roots: (root, into, size, cluster, fell, distance): fell and
    distance are set where the root, small at the start, fell to a cluster. Meetings: (child, parent, distance).
    """
    up, size, cluster, small, fell, met = {}, {}, {}, {}, {}, []
    for side in "ab":
        for x, s, c in zip(links["r" + side], links["s" + side], links["c" + side], strict=True):
            up[x], size[x], cluster[x] = x, s, None if pd.isna(c) else int(c)
            small[x] = [x] if cluster[x] is None else []

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for e, a, b, d in zip(links["e"], links["ra"], links["rb"], links["d"], strict=True):
        a, b = sorted((find(a), find(b)))
        before = [c for c in (cluster[a], cluster[b]) if c is not None]
        up[b] = a
        size[a] += size[b]
        small[a] += small.pop(b)
        if len(before) == 2 or (not before and size[a] >= min_size):
            met += [(c, 2 * e, d) for c in before]
            cluster[a] = 2 * e
        elif before:
            cluster[a] = before[0]
        if cluster[a] is not None:
            fell |= {m: (cluster[a], d) for m in small[a]}
            small[a] = []
    return [(x, find(x), size[find(x)], cluster[find(x)], *fell.get(x, (None, None))) for x in up], met


CONDENSED = "root long, into long, size long, cluster long, fell long, distance double, child long, parent long"


def condensed_tree(rows: DataFrame, forest: DataFrame, min_size: int, folder: str, band: int = BAND) -> tuple[DataFrame, DataFrame]:
    """(seq, weight, fell, distance: the cluster a row falls to and where; child, parent, distance: clusters that met). rows: seq, weight."""
    ordered = kept(corpus.renumbered(forest.select("a", "b", "d"), "d", "a", "b", column="e"), folder, "ordered")
    total = ordered.count()
    own = F.when(F.col("weight") >= min_size, F.col("seq") * 2 + 1)
    points = rows.select("seq", "weight", F.col("seq").alias("root"), own.alias("fell"), F.when(own.isNotNull(), F.lit(LEAST_DISTANCE)).alias("distance"))
    state = rows.select(F.col("seq").alias("root"), F.col("weight").alias("size"), own.alias("cluster"))
    meetings = None
    for n in range(-(-total // band)):
        part = ordered.where(F.col("e").between(n * band, (n + 1) * band - 1))
        for side in "ab":
            at = points.select(F.col("seq").alias(side), F.col("root").alias("r" + side))
            roots = state.select(F.col("root").alias("r" + side), F.col("size").alias("s" + side), F.col("cluster").alias("c" + side))
            part = part.join(at, side).join(roots, "r" + side)
        part = kept(part, folder, f"band-{n}")
        ends = part.select(F.col("ra").alias("seq")).union(part.select("rb")).distinct()
        joined = components(ends, part.select(F.col("ra").alias("a"), F.col("rb").alias("b")), f"{folder}/band-roots-{n}")

        def work(pdf: pd.DataFrame) -> pd.DataFrame:
            roots, met = condense(pdf.sort_values("e"), min_size)
            out = [(*r, None, None) for r in roots] + [(None, None, None, None, None, d, c, p) for c, p, d in met]
            return pd.DataFrame(out, columns=[c.split()[0] for c in CONDENSED.split(", ")]).astype({c.split()[0]: "Int64" for c in CONDENSED.split(", ") if c.endswith("long")})

        done = kept(part.join(joined.withColumnRenamed("seq", "ra"), "ra").groupBy("component").applyInPandas(work, CONDENSED), folder, f"condensed-{n}")
        found = done.where("child is not null").select("child", "parent", "distance")
        meetings = found if meetings is None else meetings.unionByName(found)
        moved = done.where("root is not null")
        named = moved.select("root", "into", F.col("fell").alias("f"), F.col("distance").alias("at"))
        points = points.join(named, "root", "left").select("seq", "weight", F.coalesce("into", "root").alias("root"), F.coalesce("fell", "f").alias("fell"), F.coalesce("distance", "at").alias("distance"))
        points = kept(points, folder, f"points-{n}")
        state = state.join(moved.select("root"), "root", "left_anti").unionByName(moved.select(F.col("into").alias("root"), "size", "cluster").distinct())
        state = kept(state, folder, f"state-{n}")
    if meetings is None:
        meetings = rows.sparkSession.createDataFrame([], "child long, parent long, distance double")
    return points.drop("root"), meetings


def chosen(points: DataFrame, meetings: DataFrame, folder: str) -> DataFrame:
    """cluster, owner: the topic each cluster's rows belong to, null for those of no topic."""
    closeness = lambda d: 1 / F.greatest(d, F.lit(LEAST_DISTANCE))
    direct = points.where("fell is not null").groupBy(F.col("fell").alias("cluster")).agg(F.sum("weight").alias("own_size"), F.sum(F.col("weight") * closeness(F.col("distance"))).alias("own_sum"))
    born = meetings.select(F.col("child").alias("cluster"), "parent", closeness(F.col("distance")).alias("birth"))
    split = meetings.groupBy(F.col("parent").alias("cluster")).agg(F.count("*").alias("n"), F.max(closeness(F.col("distance"))).alias("end"))
    names = direct.select("cluster").union(split.select("cluster")).distinct()
    tree = names.join(direct, "cluster", "left").join(born, "cluster", "left").join(split, "cluster", "left")
    tree = kept(tree.fillna({"own_size": 0, "own_sum": 0.0, "birth": 0.0, "n": 0}), folder, "tree")
    alone = tree.where("parent is null").limit(2).count() == 1  # one whole, which cannot be selected

    def valued(nodes: DataFrame) -> DataFrame:
        size = F.col("own_size") + F.col("under")
        own = F.col("own_sum") + F.col("under") * F.coalesce("end", F.lit(0.0)) - size * F.col("birth")
        wins = (own >= F.col("best")) & ~(F.col("parent").isNull() & F.lit(alone))
        return nodes.select("cluster", "parent", size.alias("size"), wins.alias("wins"), F.when(wins, own).otherwise(F.col("best")).alias("value"))

    level = kept(valued(tree.where("n = 0").withColumns({"under": F.lit(0).cast("bigint"), "best": F.lit(0.0)})), folder, "level-0")
    levels, all_ = [level], level
    while True:
        # Clusters all of whose children have a value, and that have none themselves.
        sums = all_.where("parent is not null").groupBy(F.col("parent").alias("cluster")).agg(F.count("*").alias("have"), F.sum("size").alias("under"), F.sum("value").alias("best"))
        ready = tree.join(sums, "cluster").where("have = n").join(all_.select("cluster"), "cluster", "left_anti")
        level = kept(valued(ready), folder, f"level-{len(levels)}")
        if level.isEmpty():
            break
        levels.append(level)
        all_ = kept(all_.unionByName(level), folder, f"valued-{len(levels)}")
    own = F.when(F.col("wins"), F.col("cluster"))
    top = kept(all_.where("parent is null").select("cluster", own.alias("owner")), folder, "owners-0")
    out, n = top, 0
    while not top.isEmpty():
        n += 1
        above = top.select(F.col("cluster").alias("parent"), "owner")
        top = kept(all_.join(above, "parent").select("cluster", F.coalesce("owner", own).alias("owner")), folder, f"owners-{n}")
        out = out.unionByName(top)
    return out


def density_topics(df: DataFrame, min_size: int, min_samples: int | None = None, neighbours: int = 15, vector="vector", folder: str | None = None, band: int = BAND, cell_rows: int = CELL_ROWS) -> DataFrame:
    """The rows with TOPIC_ID: 0, 1, … from the largest topic down (of equal ones that of the smallest seq first), -1 for outliers. df: seq, vector."""
    folder = folder or scratch(df.sparkSession, "density")
    min_size, min_samples = max(2, min_size), max(1, min_samples if min_samples is not None else min_size)
    rows = unit_rows(df.select("seq", F.col(vector).alias("vector"))).select("seq", F.transform("vector", lambda x: F.round(x, 9)).alias("vector"))
    rows = kept(keyed(rows), folder, "rows")
    firsts = kept(rows.groupBy("same").agg(F.min("seq").alias("seq"), F.count("*").alias("weight"), F.min_by("vector", "seq").alias("vector")), folder, "distinct")
    links = reachability(firsts, neighbours, min_samples, folder, cell_rows)
    forest = spanning_forest(firsts, links, folder)
    points, meetings = condensed_tree(firsts, forest, min_size, folder, band)
    points = kept(points, folder, "fallen")
    placed = points.join(chosen(points, meetings, folder).withColumnRenamed("cluster", "fell"), "fell").where("owner is not null").select(F.col("seq").alias("first"), "owner")
    members = kept(rows.select("seq", "same").join(firsts.select("same", F.col("seq").alias("first")), "same").select("seq", "first").join(placed, "first").select("seq", "owner"), folder, "members")
    sizes = members.groupBy("owner").agg(F.count("*").alias("n"), F.min("seq").alias("least"))
    numbers = corpus.renumbered(sizes, F.desc("n"), "least", column="TOPIC").select("owner", F.col("TOPIC").cast("int").alias("TOPIC_ID"))
    named = members.join(numbers, "owner").select("seq", "TOPIC_ID")
    return df.join(named, "seq", "left").withColumn("TOPIC_ID", F.coalesce("TOPIC_ID", F.lit(OUTLIER)))
