"""Exact neighbours of unit vectors: pivots, cells, and joins that the triangle inequality prunes.

Some rows, picked by a hash of their key, are pivots. Each row belongs to the cell of its nearest pivot. Rows
within a distance r of a row can only lie in cells whose pivot is no further from it than r and the cell's
radius together: a row visits those cells and no others, so nothing within r is missed. Distances are those
of unit vectors, sqrt(2 - 2 cosine).

Neighbouring cells make a block of a sixth of the rows, HELD_ROWS at most; one of more rows is split by hash. A task holds
one block, and a part of the visitors, as many at most, streams past it; within the block a visitor meets the cells
that are open to it. So vectors are sent a dozen times, and beyond six times HELD_ROWS once for so many rows; they travel packed,
some thousand in a row. Products are taken in single precision, and what may be near enough again in double precision.
Pivots are MAX_PIVOTS vectors at most, which is what the driver and the tasks hold of the whole; rows are never gathered.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions.vectors import first_of_each, matrix
from newsloom.sources.stages import scratch

CELL_ROWS = 16_000
HELD_ROWS = 100_000
MAX_PIVOTS = 2000
# Visitors and members whose products are taken together, members of which only the largest product is looked at first,
# pairs that the nearest are picked from, and numbers that exact products are taken of at a time.
RUN, TILE, SUB = 256, 4096, 256
PICKED = 500_000
EXACT = 4_000_000
# Squares of distances are rounded to twelve digits, so a distance is known to this much.
SLACK = 1e-6


def kept(df: DataFrame, folder: str, name: str) -> DataFrame:
    """The frame written to the folder and read again."""
    df.write.mode("overwrite").parquet(f"{folder}/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")


def chord(cosine: float) -> float:
    """The distance of unit vectors of this cosine."""
    return float(np.sqrt(max(0.0, 2 - 2 * cosine)))


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rounded, so that they do not depend on which rows were multiplied together."""
    return np.sqrt(np.round(np.maximum(2 - 2 * (a @ b.T), 0), 12))


def exact(a: np.ndarray, b: np.ndarray, row: np.ndarray, col: np.ndarray) -> np.ndarray:
    """The products of pairs of rows, a run of pairs at a time."""
    step = max(1, EXACT // max(a.shape[1], 1))
    return np.concatenate([np.zeros(0), *[np.einsum("ij,ij->i", a[row[k : k + step]], b[col[k : k + step]]) for k in range(0, len(row), step)]])


def apart(cosine: np.ndarray) -> np.ndarray:
    """Rounded, as _distances() are."""
    return np.sqrt(np.round(np.maximum(2 - 2 * cosine, 0), 12))


class Block:
    """The members that a task holds, cell by cell."""

    def __init__(self, ids: np.ndarray, cells: np.ndarray, vectors: np.ndarray):
        by = np.argsort(cells, kind="stable")
        self.ids, self.vectors, cells = ids[by], vectors[by], cells[by]
        self.low = self.vectors.astype(np.float32)
        # What a product in single precision of unit vectors may be off, twice over.
        self.loose = (vectors.shape[1] + 8) * 2.0**-23
        cuts = [*np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]]).tolist(), len(cells)]
        self.tiles = []  # cell, start, end, and what its largest products are taken of
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            full = hi - (hi - lo) % SUB
            self.tiles += [(int(cells[lo]), at, min(at + TILE, full), SUB) for at in range(lo, full, TILE)]
            self.tiles += [(int(cells[lo]), full, hi, hi - full)] if full < hi else []

    def _hits(self, low, who, bar, tile, k):
        """Rows of low and places of members whose product reaches the row's bar, and the products. With k, a bar that most of a tile reaches is raised first."""
        _, lo, hi, sub = tile
        product = (low[who] @ self.low[lo:hi].T).reshape(len(who), -1, sub)
        row, run = np.nonzero(product.max(2) >= bar[who][:, None])
        if k and hi - lo > k + 1 and 2 * len(row) > product.size // sub:
            flat = product.reshape(len(who), -1)
            # One more, as the row itself may be among them.
            bar[who] = np.maximum(bar[who], np.partition(flat, flat.shape[1] - k - 1, axis=1)[:, flat.shape[1] - k - 1] - 2 * self.loose)
            row, run = np.nonzero(product.max(2) >= bar[who][:, None])
        picked = product[row, run]
        i, j = np.nonzero(picked >= bar[who][row][:, None])
        return who[row[i]], lo + run[i] * sub + j, picked[i, j]

    def pairs(self, seqs, vectors, least, opened):
        """(row, place of a member, cosine) of all pairs whose cosine is at least `least` (and of some just below it), without a row itself."""
        low = vectors.astype(np.float32)
        bar = np.full(len(low), least - self.loose, np.float32)
        for run in range(0, len(low), RUN):
            for tile in self.tiles:
                who = run + np.flatnonzero(opened[run : run + RUN, tile[0]])
                if len(who):
                    row, col, _ = self._hits(low, who, bar, tile, None)
                    ok = self.ids[col] != seqs[row]
                    if ok.any():
                        row, col = row[ok], col[ok]
                        yield row, col, exact(vectors, self.vectors, row, col)

    def nearest(self, seqs, vectors, radii, opened, k: int):
        """(row, place of a member, distance): the k nearest of each row within its radius; of equal distances the smaller seq."""
        low = vectors.astype(np.float32)
        bar = (1 - np.minimum(radii, 3.0) ** 2 / 2 - self.loose).astype(np.float32)
        top = np.full((len(low), k), -np.inf, np.float32)

        def best(found):
            row, col, value = (np.concatenate(x) for x in zip(*found, strict=True))
            new = np.isnan(value)
            value[new] = apart(exact(vectors, self.vectors, row[new], col[new]))
            by = np.flatnonzero(value <= radii[row])
            by = by[first_of_each(row[by], k, value[by], self.ids[col[by]])]
            return row[by], col[by], value[by]

        for run in range(0, len(low), RUN):
            found, n = [], 0
            for tile in self.tiles:
                who = run + np.flatnonzero(opened[run : run + RUN, tile[0]])
                if not len(who):
                    continue
                row, col, product = self._hits(low, who, bar, tile, k)
                ok = self.ids[col] != seqs[row]
                row, col, product = row[ok], col[ok], product[ok]
                if not len(row):
                    continue
                # The k largest products so far: what is less by more than products may be off is none of the k nearest.
                by = np.lexsort((-product, row))
                r, p = row[by], product[by]
                start = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
                nth = np.arange(len(r)) - np.repeat(start, np.diff(np.r_[start, len(r)]))
                rows = r[start]
                more = np.full((len(rows), k), -np.inf, np.float32)
                more[np.repeat(np.arange(len(rows)), np.diff(np.r_[start, len(r)]))[nth < k], nth[nth < k]] = p[nth < k]
                top[rows] = np.sort(np.concatenate([top[rows], more], axis=1), axis=1)[:, -k:]
                bar[rows] = np.maximum(bar[rows], top[rows, 0] - 2 * self.loose)
                found.append((row, col, np.full(len(row), np.nan)))
                n += len(row)
                if n > PICKED:
                    found = [best(found)]
                    n = 0
            if found:
                yield best(found)


def _bundled(code: np.ndarray) -> list[np.ndarray]:
    """The places of each distinct code."""
    by = np.argsort(code, kind="stable")
    return np.split(by, np.flatnonzero(code[by][1:] != code[by][:-1]) + 1) if len(by) else []


def _bytes(x: np.ndarray, kind) -> bytes:
    return np.ascontiguousarray(x, kind).tobytes()


PACKED = "grp string, span int, block int, part int, kind int, copies int, ids binary, own binary, vectors binary"
KEYS = ["grp", "span", "block", "part"]


class Cells:
    """The rows of one table (seq, grp, vector) in cells; only rows of the same grp are ever compared."""

    def __init__(self, rows: DataFrame, folder: str, cell_rows: int = CELL_ROWS, held_rows: int = HELD_ROWS):
        self.folder, self.cell_rows = folder, cell_rows
        rows = kept(rows, folder, "unit")
        self.largest = rows.groupBy("grp").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
        self.held = max(cell_rows, min(held_rows, -(-self.largest // 6)))
        n = int(min(max(1, -(-self.largest // cell_rows)), MAX_PIVOTS))
        picked = rows.select("seq").orderBy(F.xxhash64("seq"), "seq").limit(n)
        picked = rows.join(F.broadcast(picked), "seq").orderBy(F.xxhash64("seq"), "seq").limit(n).select("vector").collect()
        self.pivots = np.array([r["vector"] for r in picked], float) if picked else np.zeros((1, 1))
        self.rows = kept(rows.mapInArrow(self._placer(), "seq long, grp string, vector array<double>, cell int, away double"), folder, "cells")
        self.sizes = kept(self.rows.groupBy("grp", "cell").agg(F.count("*").alias("n")), folder, "cell-sizes")
        edge = {r["cell"]: r["r"] for r in self.rows.groupBy("cell").agg(F.max("away").alias("r")).collect()}  # a row a pivot
        self.radius = np.array([edge.get(c, -1e9) for c in range(n)])

    def _placer(self):
        pivots = self.pivots

        def place(it):
            for batch in it:
                if batch.num_rows:
                    d = _distances(matrix(batch.column(2)), pivots)
                    cell = d.argmin(1)
                    yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32)), pa.array(d[np.arange(len(d)), cell])], ["seq", "grp", "vector", "cell", "away"])

        return place

    def _opener(self):
        pivots, radius = self.pivots, self.radius

        def opened(vectors: np.ndarray, radii: np.ndarray) -> np.ndarray:
            """Which cells may hold a row within the radius of each vector."""
            return _distances(vectors, pivots) <= radius[None, :] + radii[:, None] + 3 * SLACK

        return opened

    def reached(self, visitors: DataFrame) -> DataFrame:
        """The visitors (seq, grp, vector, radius) once for each cell that may hold a row within their radius: how many pairs the cells leave open."""
        opening = self._opener()

        def reach(it):
            for batch in it:
                if batch.num_rows:
                    row, cell = np.nonzero(opening(matrix(batch.column(2)), np.asarray(batch.column(3))))
                    yield pa.RecordBatch.from_arrays([*[c.take(pa.array(row)) for c in batch.columns], pa.array(cell.astype(np.int32))], ["seq", "grp", "vector", "radius", "cell"])

        return visitors.select("seq", "grp", "vector", "radius").mapInArrow(reach, "seq long, grp string, vector array<double>, radius double, cell int")

    def compared(self, visitors: DataFrame, work, schema: str, own: bool = False) -> DataFrame:
        """work(block, seqs, vectors, radii, opened) yields record batches for some visitors and a block that holds cells opened to them.

        visitors: seq, grp, vector, radius, cell. With `own` a row visits its own cell alone, or rows of it where these are many.
        """
        held = 2 * self.cell_rows if own else self.held
        span = 1 if own else max(1, self.held // self.cell_rows)
        n = len(self.radius)
        spans = -(-n // span)
        total = self.sizes.groupBy("grp", F.floor(F.col("cell") / span).cast("int").alias("span")).agg(F.sum("n").alias("n"))
        layout = total.groupBy("grp").agg(F.sum("n").alias("total"), F.map_from_entries(F.collect_list(F.struct("span", "n"))).alias("of"))
        many = F.transform(F.sequence(F.lit(0), F.lit(spans - 1)), lambda k: F.ceil(F.coalesce(F.try_element_at("of", k.cast("int")), F.lit(0)) / held).cast("int"))
        layout = layout.select("grp", many.alias("blocks"), (F.lit(1) if own else F.ceil(F.col("total") / held)).cast("int").alias("parts"))
        layout = kept(layout, self.folder, f"layout-{int(own)}")
        parts = 1 if own else max(1, -(-self.largest // held))
        hashed = F.xxhash64("seq").alias("hash")

        def bundles(batch, row, of, other):
            """The places of row numbers, with their span and block or part, that travel together."""
            group = np.asarray(pc.dictionary_encode(batch.column(2)).indices)[row]
            return _bundled((group.astype(np.int64) * spans + of) * (int(other.max(initial=0)) + 1) + other)

        def out(lines):
            names = [c.split()[0] for c in PACKED.split(", ")]
            kinds = [pa.string(), *[pa.int32()] * 5, *[pa.binary()] * 3]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*lines, strict=True), kinds, strict=True)], names)

        def parted(batch):
            vectors, hashes = matrix(batch.column(3)), np.asarray(batch.column(1))
            return np.asarray(batch.column(0)), hashes, vectors, np.asarray(batch.column(5).flatten()).reshape(batch.num_rows, -1), np.asarray(batch.column(6))

        def members(it):
            for batch in it:
                if batch.num_rows:
                    seqs, hashes, vectors, blocks, copies = parted(batch)
                    cells = np.asarray(batch.column(4))
                    of, row = cells // span, np.arange(len(cells))
                    block = hashes % blocks[row, of]
                    yield out([(batch.column(2)[int(b[0])].as_py(), of[b[0]], block[b[0]], -1, 0, copies[b[0]], _bytes(seqs[b], np.int64), _bytes(cells[b], np.int32), _bytes(vectors[b], float)) for b in bundles(batch, row, of, block)])

        def guests(it):
            for batch in it:
                if batch.num_rows:
                    seqs, hashes, vectors, blocks, deals = parted(batch)
                    radii = np.asarray(batch.column(4))
                    if own:
                        row, of = np.arange(len(seqs)), np.asarray(batch.column(7))
                    else:
                        reach = np.logical_or.reduceat(opening(vectors, radii), np.arange(0, n, span), axis=1)
                        row, of = np.nonzero(reach & (blocks > 0))
                    # A row of its own cell meets the block it is in.
                    part = hashes[row] % blocks[row, of] if own else (hashes[row] >> 20) % deals[row]
                    lines = []
                    for b in bundles(batch, row, of, part):
                        r, first = row[b], int(row[b[0]])
                        place = (part[b[0]], 0) if own else (-1, part[b[0]])
                        lines.append((batch.column(2)[first].as_py(), of[b[0]], *place, 1, blocks[first, of[b[0]]], _bytes(seqs[r], np.int64), _bytes(radii[r], float), _bytes(vectors[r], float)))
                    if lines:
                        yield out(lines)

        opening = self._opener()
        held_rows = self.rows.select("seq", hashed, "grp", "vector", "cell").join(layout, "grp").select("seq", "hash", "grp", "vector", "cell", "blocks", "parts")
        passing = visitors.select("seq", hashed, "grp", "vector", "radius", "cell").join(layout, "grp").select("seq", "hash", "grp", "vector", "radius", "blocks", "parts", "cell")
        each = lambda to: F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias(to)
        rest = ["kind", "ids", "own", "vectors"]
        held_rows = held_rows.mapInArrow(members, PACKED).select("grp", "span", "block", each("part"), *rest)
        passing = passing.mapInArrow(guests, PACKED)
        passing = passing.select("grp", "span", "block", "part", *rest) if own else passing.select("grp", "span", each("block"), "part", *rest)
        conf = self.rows.sparkSession.conf
        tasks = max(spans * parts, int(conf.get("spark.sql.shuffle.partitions")))
        place = F.pmod(F.pmod(F.xxhash64("grp"), F.lit(tasks)) + (F.col("span") + F.col("block") * spans) * parts + F.col("part"), F.lit(tasks)).cast("int")
        both = held_rows.unionByName(passing).repartitionById(tasks, place).sortWithinPartitions(*KEYS, "kind")

        def run(it):
            key, held, block = None, [], None
            for batch in it:
                for i in range(batch.num_rows):
                    *now, kind = (batch.column(c)[i].as_py() for c in range(5))
                    if now != key:
                        key, held, block = now, [], None
                    ids = np.frombuffer(batch.column(5)[i].as_buffer(), np.int64)
                    vectors = np.frombuffer(batch.column(7)[i].as_buffer(), float).reshape(len(ids), -1)
                    if kind == 0:
                        held.append((ids.copy(), np.frombuffer(batch.column(6)[i].as_buffer(), np.int32).copy(), vectors.copy()))
                    elif held or block:
                        if block is None:
                            block, held = Block(*(np.concatenate(x) for x in zip(*held, strict=True))), []
                        radii = np.frombuffer(batch.column(6)[i].as_buffer(), float)
                        opened = np.ones((len(ids), n), bool) if own else opening(vectors, radii)
                        yield from work(block, ids, vectors, radii, opened)

        return both.mapInArrow(run, schema)


def unit_rows(df: DataFrame, group=None) -> DataFrame:
    """seq, grp, vector (double, unit): rows without a direction have no neighbours and are left out."""
    rows = df.select("seq", F.coalesce((F.lit("") if group is None else group).cast("string"), F.lit("")).alias("grp"), F.col("vector").cast("array<double>").alias("vector")).where("vector is not null")

    def divide(it):
        # In Arrow, as an expression takes the size anew for each number; numbers are added up in their order, as in norm().
        for batch in it:
            vectors = batch.column(2)
            flat, lengths = vectors.flatten(), np.asarray(pc.list_value_length(vectors), np.int64)
            values, starts = np.array(flat.to_numpy(zero_copy_only=False), float), np.cumsum(lengths) - lengths
            total = np.zeros(len(lengths))
            for j in range(int(lengths.max(initial=0))):
                more = np.flatnonzero(lengths > j)
                total[more] += values[starts[more] + j] ** 2
            size, row = np.sqrt(total), np.repeat(np.arange(len(lengths)), lengths)
            whole = ~(size <= 0)
            if flat.null_count:
                whole[row[np.asarray(flat.is_null())]] = False
            values = (values / size[row])[whole[row]]
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(lengths[whole])].astype(np.int32)), pa.array(values))
            yield pa.RecordBatch.from_arrays([*[batch.column(c).filter(pa.array(whole)) for c in range(2)], lists], ["seq", "grp", "vector"])

    return rows.mapInArrow(divide, f"seq {df.schema['seq'].dataType.simpleString()}, grp string, vector array<double>")


def similar_pairs(df: DataFrame, threshold: float, group=None, folder: str | None = None, cell_rows: int = CELL_ROWS) -> DataFrame:
    """a, b, cosine: all pairs (a < b) of a group whose cosine is at least the threshold. df: seq, vector.

    Nothing is missed: the join is exact at every threshold above 0.
    """
    cells = Cells(unit_rows(df, group), folder or scratch(df.sparkSession, "similar"), cell_rows)
    radius = chord(threshold) + SLACK

    def work(block, seqs, vectors, _, opened):
        for row, col, cosine in block.pairs(seqs, vectors, threshold, opened):
            cosine = np.round(cosine, 9)
            ok = (cosine >= threshold) & (block.ids[col] < seqs[row])
            if ok.any():
                yield pa.RecordBatch.from_arrays([pa.array(block.ids[col[ok]]), pa.array(seqs[row[ok]]), pa.array(cosine[ok])], ["a", "b", "cosine"])

    return cells.compared(cells.rows.withColumn("radius", F.lit(radius)), work, "a long, b long, cosine double")


def similar_links(df: DataFrame, threshold: float, group=None, folder: str | None = None, cell_rows: int = CELL_ROWS) -> DataFrame:
    """a, b: links that connect exactly the rows that similar_pairs() connects, but no more than a few for each row a block.

    Within a block a link is left out if the rows it joins are connected by links given before, so a
    dense group of rows costs its size, not its square.
    """
    cells = Cells(unit_rows(df, group), folder or scratch(df.sparkSession, "similar"), cell_rows)
    radius = chord(threshold) + SLACK

    def work(block, seqs, vectors, _, opened):
        ids = block.ids
        if not hasattr(block, "up"):
            block.up = np.arange(len(ids))
        up = block.up

        def find(i):
            while up[i] != i:
                up[i] = up[up[i]]
                i = up[i]
            return i

        firsts, a, b = np.full(len(seqs), -1), [], []
        for row, col, cosine in block.pairs(seqs, vectors, threshold, opened):
            ok = np.round(cosine, 9) >= threshold
            by = np.argsort(row[ok], kind="stable")
            row, col = row[ok][by], col[ok][by]
            cuts = [*np.flatnonzero(np.r_[True, row[1:] != row[:-1]]), len(row)] if len(row) else [0]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                near, at = col[lo:hi], row[lo]
                if firsts[at] < 0:
                    firsts[at] = near[0]
                    a.append(seqs[at])
                    b.append(ids[near[0]])
                first = firsts[at]
                top = find(first)
                for m in near[up[near] != top]:
                    other = find(m)
                    if other != top:
                        up[other] = top
                        a.append(ids[first])
                        b.append(ids[m])
                    else:
                        up[m] = top
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(np.array(a, np.int64)), pa.array(np.array(b, np.int64))], ["a", "b"])

    return cells.compared(cells.rows.withColumn("radius", F.lit(radius)), work, "a long, b long")


def nearest_neighbours(df: DataFrame, k: int, group=None, folder: str | None = None, cell_rows: int = CELL_ROWS) -> DataFrame:
    """seq, other, distance: the k nearest other rows of each row, exactly; of equal distances the smaller seq. df: seq, vector.

    A first look at the row's own cell bounds how far the k nearest can be; the second visits every cell within that.
    """
    cells = Cells(unit_rows(df, group), folder or scratch(df.sparkSession, "nearest"), cell_rows)

    def work(block, seqs, vectors, radii, opened):
        for row, col, value in block.nearest(seqs, vectors, radii, opened, k):
            yield pa.RecordBatch.from_arrays([pa.array(seqs[row]), pa.array(block.ids[col]), pa.array(value)], ["seq", "other", "distance"])

    def best(found: DataFrame) -> DataFrame:
        return found.groupBy("seq").agg(F.slice(F.array_sort(F.collect_list(F.struct("distance", "other"))), 1, k).alias("near"))

    schema = "seq long, other long, distance double"
    looked = cells.compared(cells.rows.withColumn("radius", F.lit(float("inf"))), work, schema, own=True)
    bound = looked.groupBy("seq").agg(F.count("*").alias("n"), F.max("distance").alias("far")).where(F.col("n") >= k).select("seq", (F.col("far") + SLACK).alias("radius"))
    bound = kept(bound, cells.folder, "bounds")
    visitors = cells.rows.join(bound, "seq", "left").withColumn("radius", F.coalesce("radius", F.lit(2.0 + SLACK)))
    return best(cells.compared(visitors, work, schema)).select("seq", F.explode("near").alias("n")).select("seq", F.col("n.other").alias("other"), F.col("n.distance").alias("distance"))


def components(vertices: DataFrame, links: DataFrame, folder: str) -> DataFrame:
    """seq, component: the smallest seq that links (a, b) connect each vertex to.

    In a round every root hangs from the smallest root a link leads it to, paths are halved until all lead to their end, and
    links are carried over to what is left, so a long path takes a few rounds too.
    """
    ends = lambda x, y: (F.greatest(x, y).alias("a"), F.least(x, y).alias("b"))
    label, n = vertices.select("seq", F.col("seq").alias("component")), 0
    live = kept(links.select(*ends("a", "b")).where("a != b").distinct(), folder, "links-0")
    while not live.isEmpty():
        n, halved = n + 1, 0
        up = kept(live.groupBy("a").agg(F.min("b").alias("up")), folder, f"up-{n}-0")
        while True:
            halved += 1
            further = up.select(F.col("a").alias("up"), F.col("up").alias("further"))
            up = kept(up.join(further, "up", "left").select("a", F.coalesce("further", "up").alias("up"), F.col("further").isNotNull().alias("moved")), folder, f"up-{n}-{halved}")
            if up.where("moved").isEmpty():
                break
            up = up.select("a", "up")
        to = up.select(F.col("a").alias("component"), "up")
        label = kept(label.join(to, "component", "left").select("seq", F.coalesce("up", "component").alias("component")), folder, f"component-{n}")
        of = lambda c: up.select(F.col("a").alias(c), F.col("up").alias(f"{c}_up"))
        moved = live.join(of("a"), "a").join(of("b"), "b", "left")  # a is larger, so it hangs from another
        live = kept(moved.select(*ends("a_up", F.coalesce("b_up", "b"))).where("a != b").distinct(), folder, f"links-{n}")
    return label
