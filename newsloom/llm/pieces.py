"""The piece lattice: vocabulary, chunks of texts, and all vocabulary matches in them.

A text is written as SentencePiece writes it: a space in front, spaces as U+2581. Chunks are the
parts between which no piece reaches over (a run of spaces with what follows it; a line feed), so
each distinct chunk of a batch is worked on once. Aho-Corasick enumerates the matches; dynamic
programming runs over all chunks at once, one end position at a time.

A character without a piece of its own is one unknown edge that costs the least piece score less
10; it is written as the byte pieces of its UTF-8 form. A U+2581 of the text itself is always
unknown, so that decoding can tell it from a space.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece

from newsloom.llm.kernels import buffer, strings, word_hashes

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
OWN_MARK = "\ud800"  # stands for a U+2581 of the text itself; no text can hold it
UNKNOWN_PENALTY = 10.0
LONG_CHUNK = 64
STORED_CHUNKS = 600_000


@dataclass
class Vocabulary:
    """pieces and scores by id; byte_ids[b] is the id of byte b; normal marks the ids that match text."""

    pieces: list[str]
    scores: np.ndarray
    normal: np.ndarray
    byte_ids: np.ndarray

    @staticmethod
    def load(model: str = MODEL) -> Vocabulary:
        """Read on the driver; executors get the pieces with the task."""
        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        n = sp.get_piece_size()
        odd = [sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in range(n)]
        byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        return Vocabulary([sp.id_to_piece(i) for i in range(n)], np.array([sp.get_score(i) for i in range(n)], float), ~np.array(odd), np.array(byte_ids, np.int32))

    def rank_log_probabilities(self) -> np.ndarray:
        """For scores that are negated merge ranks: log of 1 / (rank + 1), normalised (Zipf's law)."""
        p = 1 / (1 - np.minimum(self.scores, 0))
        return np.log(p / p[self.normal].sum())


@dataclass
class Units:
    """Distinct chunks of a batch by hash, the number of each chunk in the texts, each text's first chunk."""

    body: bytes
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    inverse: np.ndarray
    first: np.ndarray

    def texts(self, pick) -> list[str]:
        body = self.body
        return [body[a:b].decode().replace(MARK, OWN_MARK).replace(" ", MARK) for a, b in zip(self.starts[pick].tolist(), self.ends[pick].tolist(), strict=True)]


class Store:
    """Chunks a task has met, by hash, in a bounded number; beyond it the store starts anew.

    `find` gives a hash its place in the arrays that the owner keeps beside.
    """

    def __init__(self, limit: int):
        self.limit = limit
        self.clear()

    def clear(self):
        self.hashes, self.places = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def find(self, hashes):
        """The place of each hash, -1 where it is new."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.places[at], -1)

    def full(self, more: int) -> bool:
        return len(self.hashes) + more > self.limit

    def add(self, hashes):
        """Places, from the number of known ones on, for new hashes."""
        places = len(self.hashes) + np.arange(len(hashes))
        both = np.concatenate([self.hashes, hashes])
        order = np.argsort(both, kind="stable")
        self.hashes, self.places = both[order], np.concatenate([self.places, places])[order]
        return places


class Lattice:
    """What a worker keeps of a vocabulary: the automaton and the tables by id."""

    def __init__(self, vocabulary: Vocabulary, scores: np.ndarray):
        self.pieces = vocabulary.pieces
        self.byte_ids = vocabulary.byte_ids
        self.finder = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        self.size = np.zeros(len(self.pieces) + 1, np.int64)
        self.single = np.zeros(0x110000, bool)
        self.score = np.append(scores, scores[vocabulary.normal].min() - UNKNOWN_PENALTY)
        self.unknown = len(self.pieces)
        whole = True
        for i in np.flatnonzero(vocabulary.normal):
            p = self.pieces[i]
            self.finder.add_word(p, int(i))
            self.size[i] = len(p)
            if len(p) == 1:
                self.single[ord(p)] = True
            whole &= "\n" not in p and MARK not in p.lstrip(MARK)
        self.size[self.unknown] = 1
        self.split = whole  # pieces never reach over the chunks' borders
        self.finder.make_automaton()
        self.store = Store(STORED_CHUNKS)
        self.kept: list = []  # what the owner of the store keeps of the stored chunks

    def units(self, column) -> Units:
        """The chunks of a column of texts."""
        column = strings(column)
        column = pc.if_else(pc.equal(column, ""), column, pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), column, pa.scalar("", pa.large_string())))
        raw, offsets = buffer(column)
        none = np.zeros(0, np.int64)
        if not len(raw):
            return Units(b"", none, none, np.zeros(0, np.uint64), none, np.zeros(len(offsets), np.int64))
        begin = np.zeros(len(raw) + 1, bool)
        begin[offsets] = True
        if self.split:
            space, line = raw == 32, raw == 10
            begin[0] = True
            begin[1:-1] |= (space[1:] & ~space[:-1]) | line[1:] | line[:-1]
        starts = np.flatnonzero(begin[:-1])
        ends = np.append(starts[1:], len(raw))
        hashes, at, inverse = np.unique(word_hashes(raw, starts, ends), return_index=True, return_inverse=True)
        return Units(raw.tobytes(), starts[at], ends[at], hashes, inverse, np.searchsorted(starts, offsets))

    def chunks(self, column):
        """Distinct chunks of a column of texts, and for each document its chunks: (list, inverse, first)."""
        units = self.units(column)
        return units.texts(np.arange(len(units.hashes))), units.inverse, units.first

    def edges(self, chunks: list[str]):
        """All matches in the chunks, by end and then longest first.

        Nodes are character places of the chunks, each followed by one place for its end:
        (start node, end node, piece or unknown, first node of each chunk, characters).
        """
        joined = "\0".join(chunks) + "\0"
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        first = np.concatenate([[0], np.cumsum(sizes + 1)])
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
        found = np.fromiter(chain.from_iterable(self.finder.iter(joined)), np.int64).reshape(-1, 2)
        end, piece = found[:, 0] + 1, found[:, 1]
        lone = ~self.single[points]
        lone[first[1:] - 1] = False
        lone = np.flatnonzero(lone)
        if len(lone):
            at = np.searchsorted(end, lone + 1, "right")
            end, piece = np.insert(end, at, lone + 1), np.insert(piece, at, self.unknown)
        return end - self.size[piece], end, piece, first, points

    def levels(self, end, first):
        """Edges of each end place in the chunk, chunks up to LONG_CHUNK: lists of edge numbers and group starts.

        Longer chunks come one by one, node by node.
        """
        sizes = np.diff(first) - 1
        chunk = np.searchsorted(first, end, "right") - 1
        level = end - first[chunk]
        long = sizes[chunk] > LONG_CHUNK
        order = np.argsort(np.where(long, LONG_CHUNK + 1, level), kind="stable")
        cuts = np.searchsorted(np.where(long, LONG_CHUNK + 1, level)[order], np.arange(1, LONG_CHUNK + 3))
        for k in range(LONG_CHUNK):
            e = order[cuts[k] : cuts[k + 1]]
            if len(e):
                yield e, np.flatnonzero(np.concatenate([[True], end[e][1:] != end[e][:-1]]))
        rest = order[cuts[LONG_CHUNK] :]
        if len(rest):
            for e in np.split(rest, np.flatnonzero(np.diff(end[rest])) + 1):
                yield e, np.zeros(1, np.int64)

    def unknown_bytes(self, points):
        """UTF-8 length of the characters; 3 for the stand-in of U+2581."""
        return 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)

    def best(self, chunks):
        """Viterbi: score and number of ids of each chunk's best path; of equal paths the one with the longer last piece."""
        start, end, piece, first, points = self.edges(chunks)
        best, count = np.zeros(len(points) + 1), np.zeros(len(points) + 1, np.int64)
        ids = np.where(piece == self.unknown, self.unknown_bytes(points)[start], 1)
        score = self.score[piece]
        for e, heads in self.levels(end, first):
            c = best[start[e]] + score[e]
            top = np.maximum.reduceat(c, heads)
            width = np.diff(np.append(heads, len(e)))
            place = np.where(c == np.repeat(top, width), np.arange(len(e)), len(e))
            pick = e[np.minimum.reduceat(place, heads)]
            best[end[pick]] = top
            count[end[pick]] = count[start[pick]] + ids[pick]
        last = first[1:] - 1
        return best[last], count[last]

    def best_of(self, units: Units):
        """best() of each unit, kept for later batches of the task."""
        place = self.store.find(units.hashes)
        new = np.flatnonzero(place < 0)
        if self.store.full(len(new)):
            self.store.clear()
            self.kept.clear()
            new = np.arange(len(units.hashes))
        if len(new) or not self.kept:
            score, count = self.best(units.texts(new)) if len(new) else (np.zeros(0), np.zeros(0, np.int64))
            place[new] = self.store.add(units.hashes[new])
            if self.kept:
                score, count = np.concatenate([self.kept[0], score]), np.concatenate([self.kept[1], count])
            self.kept[:] = [score, count]
        return self.kept[0][place], self.kept[1][place]
