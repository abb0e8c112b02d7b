"""Exact neighbours and density topics against plain, single-machine versions."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsloom.operators import neighbours
from newsloom.operators.density import LEAST_DISTANCE, density_topics
from newsloom.sources.stages import scratch

ROWS = "seq long, vector array<double>"


def unit(v):
    return np.asarray(v, float) / np.linalg.norm(v)


def made(seed, n, centres, dims, spread, stray=9):
    rng = np.random.default_rng(seed)
    c = rng.normal(size=(centres, dims))
    return [(k * 3 % 1009 + 1009 * (k // 1009), [float(x) for x in c[k % centres] + rng.normal(size=dims) * (spread if k % stray else 1.5)]) for k in range(n)]


def distances(rows):
    v = np.round(np.stack([unit(v) for _, v in rows]), 9)
    v = v / np.linalg.norm(v, axis=1, keepdims=True)
    return np.sqrt(np.round(np.maximum(2 - 2 * v @ v.T, 0), 12))


def plain_topics(rows, min_size, min_samples, k):
    """The same rules written top down, over all pairs in one process."""
    rows = sorted(rows)
    groups = {}
    for seq, v in rows:
        groups.setdefault(tuple(np.round(unit(v), 9)), []).append(seq)
    firsts = sorted((min(s), list(v), len(s)) for v, s in groups.items())
    n, weight = len(firsts), [w for *_, w in firsts]
    d = distances([(s, v) for s, v, _ in firsts])
    near = [sorted((j for j in range(n) if j != i), key=lambda j: (d[i, j], j))[: max(k, min_samples)] for i in range(n)]
    core = []
    for i in range(n):
        have, at = weight[i] - 1, 0.0 if weight[i] > min_samples else None
        for j in near[i]:
            have += weight[j]
            if at is None and have >= min_samples:
                at = d[i, j]
        core.append(at if at is not None else (d[i, near[i][-1]] if near[i] else 0.0))
    links = sorted({(max(d[i, j], core[i], core[j]), min(i, j), max(i, j)) for i in range(n) for j in near[i]})
    up = list(range(n))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    forest = []
    for w, a, b in links:
        if find(a) != find(b):
            up[find(a)] = find(b)
            forest.append((w, a, b))
    trees = {}
    for i in range(n):
        trees.setdefault(find(i), []).append(i)
    size = lambda part: sum(weight[i] for i in part)
    close = lambda x: 1 / max(x, LEAST_DISTANCE)

    def parts(nodes, edges):
        """What the longest link splits a tree into."""
        w, a, b = edges[-1]
        rest, seen, todo = edges[:-1], {a}, [a]
        while todo:
            x = todo.pop()
            for _, p, q in rest:
                for y in ((q,) if p == x else (p,) if q == x else ()):
                    if y not in seen:
                        seen.add(y)
                        todo.append(y)
        return w, [([i for i in nodes if (i in seen) == side], [e for e in rest if (e[1] in seen) == side]) for side in (True, False)]

    def cluster(nodes, edges, birth):
        """(stability, children, members) of the cluster that begins with these rows."""
        total, now, left = 0.0, (nodes, edges), len(nodes)
        while left:
            nodes, edges = now
            if not edges:
                total += weight[nodes[0]] * (1 / LEAST_DISTANCE - birth)
                return total, [], list(nodes)
            w, halves = parts(nodes, edges)
            big = [h for h in halves if size(h[0]) >= min_size]
            if len(big) == 2:
                return total + size(nodes) * (close(w) - birth), [(h, close(w)) for h in big], None
            if not big:
                return total + size(nodes) * (close(w) - birth), [], None
            gone = next(h for h in halves if h is not big[0])
            total += size(gone[0]) * (close(w) - birth)
            now = big[0]

    def best(nodes, edges, birth, may):
        own, children, _ = cluster(nodes, edges, birth)
        under = [best(*h, at, True) for h, at in children]
        below = sum(v for v, _ in under)
        if may and own >= below:
            return own, [nodes]
        return below, [t for _, ts in under for t in ts]

    wholes = [(t, [e for e in forest if e[1] in t]) for t in map(set, trees.values()) if size(t) >= min_size]
    topics = [t for nodes, edges in wholes for t in best(sorted(nodes), edges, 0.0, len(wholes) > 1)[1]]
    named = [sorted(s for i in t for s in groups[tuple(firsts[i][1])]) for t in topics]
    return sorted(named, key=lambda t: (-len(t), t[0]))


def topics_of(df):
    out = {}
    for r in df.where("TOPIC_ID >= 0").collect():
        out.setdefault(r["TOPIC_ID"], []).append(r["seq"])
    assert sorted(out) == list(range(len(out)))
    return [sorted(out[t]) for t in sorted(out)]


@pytest.mark.parametrize(("seed", "n", "spread", "min_size", "min_samples", "k", "band"), [(1, 260, 0.15, 5, 5, 15, 10**6), (2, 200, 0.5, 4, 1, 15, 40), (3, 150, 0.3, 6, 3, 4, 10**6)])
def test_density_topics(spark, seed, n, spread, min_size, min_samples, k, band):
    rows = made(seed, n, 6, 8, spread)
    rows += [(5000 + i, rows[0][1]) for i in range(7)] + [(6000 + i, [2 * x for x in rows[3][1]]) for i in range(2)]  # copies
    df = spark.createDataFrame([*rows, (7000, None), (7001, [0.0] * 8)], ROWS)
    out = density_topics(df, min_size, min_samples, k, band=band, cell_rows=40)
    assert out.count() == len(rows) + 2 and out.where("seq >= 7000 and TOPIC_ID != -1").count() == 0
    assert topics_of(out) == plain_topics(rows, min_size, min_samples, k)


def test_density_query(spark, sf):
    from newsloom.plans.queries import QUERIES

    rows = [(r["vec_id"], [float(x) for x in r["embedding"]]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert topics_of(QUERIES["density_topics"](spark, sf)) == plain_topics(rows, 10, 10, 15)


def test_nothing_one_and_all_alike(spark):
    assert density_topics(spark.createDataFrame([], ROWS), 3).count() == 0
    assert topics_of(density_topics(spark.createDataFrame([(1, [1.0, 0.0])], ROWS), 3)) == []
    same = [(k, [0.6, 0.8]) for k in range(50)]
    assert topics_of(density_topics(spark.createDataFrame(same, ROWS), 3)) == plain_topics(same, 3, 3, 15) == []


@pytest.mark.parametrize("threshold", [0.2, 0.6, 0.93])
def test_similar_pairs_and_links(spark, threshold):
    rows = made(4, 400, 12, 6, 0.2)
    df = spark.createDataFrame(rows, ROWS).withColumn("g", F.col("seq") % 3)
    v = np.stack([unit(x) for _, x in rows])
    cosine = np.round(v @ v.T, 9)
    want = {(min(a, b), max(a, b)) for (i, (a, _)), (j, (b, _)) in itertools.combinations(enumerate(rows), 2) if a % 3 == b % 3 and cosine[i, j] >= threshold}
    pairs = neighbours.similar_pairs(df, threshold, F.col("g"), cell_rows=30)
    got = [(r["a"], r["b"]) for r in pairs.collect()]
    assert len(got) == len(set(got)) and set(got) == want
    links = neighbours.similar_links(df, threshold, F.col("g"), cell_rows=30)
    whole = [dict(map(tuple, neighbours.components(df, x, scratch(spark, "t")).collect())) for x in (links, spark.createDataFrame(sorted(want) or [(0, 0)], "a long, b long"))]
    assert whole[0] == whole[1]


def test_a_dense_group_gives_few_links(spark):
    rng = np.random.default_rng(0)
    rows = [(k, [1.0, *map(float, rng.normal(size=5) * 0.01)]) for k in range(600)]
    assert neighbours.similar_links(spark.createDataFrame(rows, ROWS), 0.9).count() <= 2 * 600


def test_nearest_neighbours(spark):
    rows = made(5, 300, 7, 5, 0.4)
    got = {}
    for r in neighbours.nearest_neighbours(spark.createDataFrame(rows, ROWS), 6, cell_rows=20).collect():
        got.setdefault(r["seq"], []).append((r["distance"], r["other"]))
    d = np.sqrt(np.round(np.maximum(2 - 2 * (v := np.stack([unit(x) for _, x in rows])) @ v.T, 0), 12))
    for i, (s, _) in enumerate(rows):
        assert sorted(got[s]) == sorted((d[i, j], rows[j][0]) for j in range(len(rows)) if j != i)[:6]


def test_rows_without_near_ones_are_sent_a_few_times(spark):
    """Where every cell is open a row is sent once for 16,000 rows, and all pairs are looked at."""
    rng = np.random.default_rng(8)
    v = rng.normal(size=(5000, 16))
    df = spark.createDataFrame([(k, [float(x) for x in r]) for k, r in enumerate(v)], ROWS)
    cells = neighbours.Cells(neighbours.unit_rows(df), scratch(spark, "t"))
    assert cells.reached(cells.rows.withColumn("radius", F.lit(neighbours.chord(0.1)))).count() == 5000
    v /= np.linalg.norm(v, axis=1)[:, None]
    assert neighbours.similar_pairs(df, 0.6).count() == np.triu(np.round(v @ v.T, 9) >= 0.6, 1).sum()


def test_blocks_of_several_cells(spark):
    """Visitors meet blocks of cells, in parts; a run's bars rise; directions are found by the numbers as they are, nulls left out."""
    rng = np.random.default_rng(21)
    v = np.concatenate([rng.normal(size=(700, 8)), np.ones((300, 8)) + rng.normal(size=(300, 8)) * 1e-3])
    v = v / np.linalg.norm(v, axis=1)[:, None]
    block = neighbours.Block(np.arange(1000), np.arange(1000) % 3, v)
    opened = np.ones((1000, 3), bool)
    d = neighbours.apart(v @ v.T)
    np.fill_diagonal(d, 9)
    got = {}
    for row, col, value in block.nearest(np.arange(1000), v, np.full(1000, np.inf), opened, 4):
        for r, c, x in zip(row.tolist(), block.ids[col].tolist(), value.tolist(), strict=True):
            got.setdefault(r, []).append((x, c))
    assert all(sorted(got[i]) == sorted(zip(d[i].tolist(), range(1000), strict=True))[:4] for i in range(1000))
    pairs = {(r, c) for row, col, x in block.pairs(np.arange(1000), v, 0.8, opened) for r, c in zip(row[x >= 0.8].tolist(), block.ids[col][x >= 0.8].tolist(), strict=True)}
    assert pairs == {(i, j) for i, j in np.argwhere(v @ v.T >= 0.8).tolist() if i != j}
    rows = neighbours.unit_rows(spark.createDataFrame([(1, [3.0, 4.0]), (2, None), (3, [0.0, 0.0]), (4, [1.0, None]), (5, []), (6, [2.0])], ROWS)).collect()
    assert {r["seq"]: r["vector"] for r in rows} == {1: [0.6, 0.8], 6: [1.0]}


def test_a_long_path_takes_few_rounds(spark, tmp_path):
    """A path whose numbers rise is one component; the rounds don't follow its length."""
    path = spark.createDataFrame([(k, k + 1) for k in range(300)] + [(1000, 1001)], "a long, b long")
    vertices = spark.range(302).union(spark.range(1000, 1002)).withColumnRenamed("id", "seq")
    got = {r["seq"]: r["component"] for r in neighbours.components(vertices, path, str(tmp_path)).collect()}
    assert got == {k: 0 for k in range(301)} | {301: 301, 1000: 1000, 1001: 1000}
    assert len(list(tmp_path.iterdir())) < 20
