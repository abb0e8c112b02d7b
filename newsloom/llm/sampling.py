"""SentencePiece encoding and decoding (operator 7).

Forward filtering sums the weight of all segmentations up to each node of the piece lattice;
backward sampling then draws a whole segmentation from the end. A segmentation's chance is
proportional to exp(alpha * sum of its pieces' log-probabilities). Draws are a hash of the seed,
the row's key, the chunk's place in the text and the node, so a row is segmented alike in any
batch or partition. Node weights are turned into integers before the draw for the same reason.

Decoding joins the pieces; byte pieces are their bytes, so every text comes back exactly, those
with U+2581 or characters outside the vocabulary too.

Null texts are encoded as empty ones: no ids, decoded as "". A null key counts as 0. Repeated
rows, having the same key, get the same ids; an empty table gives an empty one; texts of any length are taken whole,
chunk by chunk; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from newsloom.llm.frames import batches, texts
from newsloom.llm.kernels import mix, slices
from newsloom.llm.pieces import MARK, MODEL, Lattice, Vocabulary

ALPHA = 1.0
SEED = 17
SLICE_BYTES = 2_000_000
ONE = float(1 << 30)  # a node's weights as integers; 2**33 edges fit a sum of 63 bits


def _forward(lattice: Lattice, chunks):
    """Edges with, for each, its integer weight among those of the same end, added up over all edges."""
    start, end, piece, first, points = lattice.edges(chunks)
    total = np.zeros(len(points) + 1)
    weight = np.zeros(len(end), np.int64)
    score = lattice.score[piece]
    for e, heads in lattice.levels(end, first):
        c = total[start[e]] + score[e]
        top = np.maximum.reduceat(c, heads)
        width = np.diff(np.append(heads, len(e)))
        x = np.exp(c - np.repeat(top, width))
        s = np.add.reduceat(x, heads)
        total[end[e[heads]]] = top + np.log(s)
        weight[e] = np.maximum(1, np.floor(x / np.repeat(s, width) * ONE)).astype(np.int64)
    return start, end, piece, first, points, weight


class Graph:
    """Lattices of stored chunks, one after the other: first and last node of each, edges by end node.

    An edge is its piece, which tells where it starts, and `upto`: its weight plus those before it
    of the same end, at most 2**30 or so.
    """

    def __init__(self, lattice: Lattice):
        self.first = self.last = np.zeros(0, np.int64)
        self.node_lo = np.zeros(1, np.int64)
        self.piece = np.zeros(0, np.uint16 if lattice.unknown < 1 << 16 else np.int32)
        self.upto = np.zeros(0, np.uint32)
        self.odd, self.points = np.zeros(0, np.int64), np.zeros(0, np.uint32)  # unknown edges and their characters

    def extend(self, lattice: Lattice, chunks: list[str]):
        start, end, piece, first, points, weight = _forward(lattice, chunks)
        nodes, edges = len(self.node_lo) - 1, len(self.piece)
        join = np.concatenate
        lo = np.searchsorted(end, np.arange(len(points) + 1))
        cum = np.concatenate([[0], np.cumsum(weight)])
        odd = np.flatnonzero(piece == lattice.unknown)
        self.first, self.last = join([self.first, first[:-1] + nodes]), join([self.last, first[1:] - 1 + nodes])
        self.node_lo = join([self.node_lo[:-1], lo + edges])
        self.upto = join([self.upto, (cum[1:] - cum[lo[end]]).astype(np.uint32)])
        self.piece = join([self.piece, piece.astype(self.piece.dtype)])
        self.odd, self.points = join([self.odd, odd + edges]), join([self.points, points[start[odd]]])

    def characters(self, edges):
        """The characters of unknown edges."""
        return self.points[np.searchsorted(self.odd, edges)]


def graph_of(lattice: Lattice, units) -> tuple[Graph, np.ndarray]:
    """The graph that holds all units, and the place of each in it; kept for later batches of the task."""
    store = lattice.store
    place = store.find(units.hashes)
    new = np.flatnonzero(place < 0)
    if not lattice.kept or store.full(len(new)):
        store.clear()
        lattice.kept[:] = [Graph(lattice)]
        new = np.arange(len(units.hashes))
    if len(new):
        lattice.kept[0].extend(lattice, units.texts(new))
        place[new] = store.add(units.hashes[new])
    return lattice.kept[0], place


def sample(column, keys, lattice: Lattice, seed=SEED):
    """(ids, first id of each document) of the sampled segmentations."""
    units = lattice.units(column)
    inverse, first_chunk = units.inverse, units.first
    n_docs = len(first_chunk) - 1
    if not len(inverse):
        return np.zeros(0, np.int32), np.zeros(n_docs + 1, np.int64)
    graph, place = graph_of(lattice, units)
    upto, node_lo = graph.upto, graph.node_lo

    n = len(inverse)
    doc = np.repeat(np.arange(n_docs), np.diff(first_chunk))
    within = np.arange(n) - first_chunk[doc]
    base = mix(mix(keys.astype(np.uint64) + np.uint64(seed))[doc] ^ mix(within.astype(np.uint64) + np.uint64(0x51ED)))
    occ = np.argsort(inverse, kind="stable")
    node = graph.last[place][inverse[occ]]
    floor = graph.first[place][inverse[occ]]
    steps = []
    while len(occ):
        lo, hi = node_lo[node], node_lo[node + 1]
        u = mix(base[occ] ^ ((node - floor).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
        draw = ((u >> np.uint64(32)) * upto[hi - 1]) >> np.uint64(32)  # 32 bits of u by 31 of the sum
        edge = lo
        going = np.flatnonzero(upto[edge] <= draw)
        while len(going):
            edge[going] += 1
            going = going[(upto[edge[going]] <= draw[going]) & (edge[going] + 1 < hi[going])]
        piece = graph.piece[edge].astype(np.int32)
        width = np.ones(len(edge), np.int64)
        odd = np.flatnonzero(piece == lattice.unknown)
        points = graph.characters(edge[odd])
        width[odd] = lattice.unknown_bytes(points)
        steps.append((occ, piece, width, odd, points))
        node = node - lattice.size[piece]
        more = node > floor
        occ, node, floor = occ[more], node[more], floor[more]

    length = np.zeros(n, np.int64)
    for o, _, width, _, _ in steps:
        length[o] += width
    stop = np.cumsum(length)
    ids = np.empty(int(stop[-1]), np.int32)
    at = stop.copy()
    for o, piece, width, odd, points in steps:
        at[o] -= width
        ids[at[o]] = piece
        if len(odd):
            values, back = np.unique(points, return_inverse=True)
            codes = [(MARK if v == 0xD800 else chr(v)).encode() for v in values.tolist()]
            for k in range(4):
                has = np.array([len(c) > k for c in codes])[back]
                byte = np.array([c[k] if len(c) > k else 0 for c in codes])[back]
                ids[at[o[odd[has]]] + k] = lattice.byte_ids[byte[has]]
    return ids, np.concatenate([[0], stop])[first_chunk]


class Decoder:
    """Bytes of every id."""

    def __init__(self, vocabulary: Vocabulary):
        self.table = [p.replace(MARK, " ").encode() if ok else b"" for p, ok in zip(vocabulary.pieces, vocabulary.normal, strict=True)]
        for b, i in enumerate(vocabulary.byte_ids):
            self.table[i] = bytes([b])

    def text(self, ids: list[int]) -> str:
        table = self.table
        return b"".join([table[i] for i in ids])[1:].decode("utf-8", "replace")


def _keys(column):
    return np.asarray(column.cast(pa.int64()).fill_null(0)).view(np.uint64)


ENCODED = "doc_id bigint, n_pieces bigint, ids array<int>"
DIGEST = "doc_id bigint, n_pieces bigint, ids_sha256 string, lossless boolean"


def _setup(vocabulary, alpha):
    return Lattice(vocabulary, vocabulary.rank_log_probabilities() * alpha)


def encode(docs: DataFrame, doc_id="doc_id", text="text", model: str = MODEL, alpha=ALPHA, seed=SEED, check=False) -> DataFrame:
    """One row per document: the ids of its sampled segmentation; with `check`, whether they decode to the text."""
    known = Vocabulary.load(model)

    def run(batch, made):
        lattice, decoder = made
        for part in slices(batch, 1, SLICE_BYTES):
            ids, first = sample(part.column(1), _keys(part.column(0)), lattice, seed)
            lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids, pa.int32()))
            columns = [part.column(0).cast(pa.int64()), pa.array(np.diff(first), pa.int64()), lists]
            if check:
                columns.append(pa.array([decoder.text(ids[first[k] : first[k + 1]].tolist()) == (t or "") for k, t in enumerate(part.column(1).to_pylist())]))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_pieces", "ids", "lossless"][: len(columns)])

    return batches(texts(docs, doc_id, text), run, ENCODED + ", lossless boolean" * check, setup=lambda: (_setup(known, alpha), Decoder(known)))


def decode(encoded: DataFrame, doc_id="doc_id", ids="ids", model: str = MODEL) -> DataFrame:
    """One row per document: doc_id and its text. Null ids give an empty text."""
    known = Vocabulary.load(model)

    def run(batch, decoder):
        out = [decoder.text(x or []) for x in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(out, pa.string())], ["doc_id", "text"])

    return batches(texts(encoded, doc_id, ids), run, "doc_id bigint, text string", setup=lambda: Decoder(known))


def round_trip(docs: DataFrame, doc_id="doc_id", text="text", model: str = MODEL, alpha=ALPHA, seed=SEED) -> DataFrame:
    """Encode and decode every text: the number of ids, their digest (little-endian int32), and whether the text came back."""
    known = Vocabulary.load(model)

    def run(batch, made):
        lattice, decoder = made
        for part in slices(batch, 1, SLICE_BYTES):
            ids, first = sample(part.column(1), _keys(part.column(0)), lattice, seed)
            shas, same = [], []
            for k, t in enumerate(part.column(1).to_pylist()):
                own = ids[first[k] : first[k + 1]]
                shas.append(hashlib.sha256(own.astype("<i4").tobytes()).hexdigest())
                same.append(decoder.text(own.tolist()) == (t or ""))
            yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), pa.array(np.diff(first), pa.int64()), pa.array(shas), pa.array(same)], [c.split()[0] for c in DIGEST.split(", ")])

    return batches(texts(docs, doc_id, text), run, DIGEST, setup=lambda: (_setup(known, alpha), Decoder(known)))
