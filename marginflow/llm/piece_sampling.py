"""Sampled segmentations over a SentencePiece vocabulary, and lossless decoding.

Forward filtering gives, for every place of the piece lattice, the summed weight
of all segmentations up to it; backward sampling then walks from the end, and
chooses each piece by its share of that weight. The draws are a hash of the
row's key and the draw's number, so a row's segmentation does not depend on
batches, partitions or retries.

A piece has the word mark only at its start (or is made of marks), so the
lattice falls apart where a mark follows another character; the lattice of each
distinct part is filtered once, and all its occurrences are sampled together in
numpy. The vocabulary's merge ranks stand for frequencies: a piece's weight is
1 / (rank + RANK_OFFSET) to the power ``alpha``. Characters without a piece, and
the word mark itself where the text holds it, are written as byte pieces.
"""

from __future__ import annotations

import re
import zlib
from itertools import islice
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginflow.llm.common import HANDED_ON, text_slices

MARK = "▁"
RANK_OFFSET = 2.7
ALPHA = 1.0
#: Distinct parts whose lattices a worker keeps; they shrink to the half met first when there are more.
CACHE_PARTS = 250_000
#: Bits of the filters that spare most lookups of a substring.
FILTER_LOG2 = 21
#: Occurrences that are sampled at once.
OCCURRENCES = 400_000

_PART = re.compile(" *[^ ]+| +")


class Lattices:
    """The filtered lattices of all parts seen, in flat arrays.

    Node numbers run over all parts, one for each place between characters. The
    pieces that end at a node are consecutive edges with their cumulative shares,
    longest piece first; a draw steps along them, mostly no further than the first."""

    def __init__(self, model: bytes, alpha: float = ALPHA):
        from sentencepiece import SentencePieceProcessor
        sp = SentencePieceProcessor(model_proto=model)
        n = sp.get_piece_size()
        self.pieces: dict[str, tuple[int, float]] = {}
        self.bytes_of: list[bytes] = [b""] * n
        self.piece_bytes: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None  # the same in flat arrays
        self.byte_id = np.zeros(256, dtype=np.int32)
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_id[value], self.bytes_of[i] = i, bytes([value])
            elif not (sp.is_control(i) or sp.is_unknown(i)):
                text = piece.replace(MARK, " ")
                rank = max(-sp.get_score(i), 0.0)
                rank = 0.0 if rank > n else rank  # user-defined pieces have no rank
                self.pieces[text] = (i, -alpha * log(rank + RANK_OFFSET))
                self.bytes_of[i] = text.encode()
        self.byte_weight = -alpha * log(n + RANK_OFFSET)
        #: by length: the pieces' hashes in order, their ids and weights
        self.by_length = []
        for size in range(1, max(map(len, self.pieces)) + 1):
            own = [(_text_hash(t), *v) for t, v in self.pieces.items() if len(t) == size]
            own.sort()
            self.by_length.append((np.array([x[0] for x in own], dtype=np.uint64),
                                   np.array([x[1] for x in own], dtype=np.int32), np.array([x[2] for x in own])))
        #: by some bits of a hash: whether a piece may have it, and whether a longer piece may begin so
        self.may_be, self.may_go_on = (np.zeros(1 << FILTER_LOG2, dtype=bool) for _ in range(2))
        for text in self.pieces:
            h = 0
            for i, c in enumerate(text, 1):
                h = (h ^ ord(c)) * int(_MIX) & 0xFFFFFFFFFFFFFFFF
                (self.may_be if i == len(text) else self.may_go_on)[h >> (64 - FILTER_LOG2)] = True
        self.clear()

    def clear(self) -> None:
        self.end: dict[str, int] = {}
        #: parts, nodes and edges before each call of ``learn``
        self.marks: list[tuple[int, int, int]] = []
        self.share = np.zeros(0, dtype=np.float32)
        self.first_edge = np.zeros(0, dtype=np.int32)
        self.back = np.zeros(0, dtype=np.int32)
        self.piece = np.zeros(0, dtype=np.int32)
        self.is_start = np.zeros(0, dtype=bool)

    def shrink(self, parts: int) -> None:
        """Keeps at most so many parts: those met first, which are met often."""
        while self.marks and self.marks[-1][0] > parts:
            self.marks.pop()
        if not self.marks or self.marks[-1][0] == 0:
            self.clear()
            return
        n, nodes, edges = self.marks.pop()
        self.end = dict(islice(self.end.items(), n))
        self.first_edge, self.is_start = self.first_edge[:nodes].copy(), self.is_start[:nodes].copy()
        self.share, self.back, self.piece = (x[:edges].copy() for x in (self.share, self.back, self.piece))

    def _edges(self, points: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, ...]:
        """(first place, length, piece, weight) of every piece in the characters
        ``points``, of which ``left`` remain in the part at each."""
        h = np.zeros(len(points), dtype=np.uint64)
        alive = np.arange(len(points))
        out = []
        for size, (hashes, ids, weights) in enumerate(self.by_length, 1):
            alive = alive[left[alive] >= size]
            if not len(alive):
                break
            own = (h[alive] ^ points[alive + size - 1]) * _MIX
            h[alive] = own
            bits = (own >> np.uint64(64 - FILTER_LOG2)).astype(np.int64)
            if len(hashes):
                likely = np.flatnonzero(self.may_be[bits])
                found = np.minimum(np.searchsorted(hashes, own[likely]), len(hashes) - 1)
                hit = hashes[found] == own[likely]
                place, found = alive[likely[hit]], found[hit]
                out.append((place, np.full(len(place), size), ids[found], weights[found]))
                if size == 1:  # characters without a piece are written as bytes, coded as -(code point) - 1
                    place = np.delete(alive, likely[hit])
                    c = points[place].astype(np.int64)
                    width = 1 + (c >= 0x80) + (c >= 0x800) + (c >= 0x10000)
                    out.append((place, np.ones(len(place), dtype=int), (-c - 1).astype(np.int32), self.byte_weight * width))
            alive = alive[self.may_go_on[bits]]
        return tuple(np.concatenate(x) for x in zip(*out))

    def learn(self, parts: list[str]) -> None:
        """Filters the lattices of parts not seen before, all together: places with
        the same distance from their part's start are summed at once."""
        base, n = len(self.is_start), np.array([len(p) for p in parts])
        points = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        first = np.cumsum(n) - n
        part = np.repeat(np.arange(len(parts)), n)
        begin, size, piece, weight = self._edges(points, (first + n)[part] - np.arange(len(points)))
        origin = begin + part[begin]  # a part of n characters has n + 1 nodes
        node = origin + size
        layer = begin + size - first[part[begin]]
        nodes = len(points) + len(parts)
        by_node = np.argsort(node * 64 - size)
        origin, node, piece, weight, layer = (x[by_node] for x in (origin, node, piece, weight, layer))
        small = layer.max() < 1 << 15  # short keys are sorted in linear time
        order = np.argsort(layer.astype(np.int16) if small else layer, kind="stable")
        from_, to_, weight, layer = (x[order] for x in (origin, node, weight, layer))
        total = np.zeros(nodes)
        share = np.empty(len(node), dtype=np.float32)
        cuts = np.append(np.flatnonzero(np.append(True, layer[1:] != layer[:-1])), len(layer))
        for a, b in zip(cuts[:-1], cuts[1:]):
            w, to = total[from_[a:b]] + weight[a:b], to_[a:b]
            heads = np.flatnonzero(np.append(True, to[1:] != to[:-1]))
            run = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, b - a)))
            most = np.maximum.reduceat(w, heads)
            w = np.exp(w - most[run])
            sums = np.add.reduceat(w, heads)
            total[to[heads]] = most + np.log(sums)
            so_far = np.cumsum(w)
            before = (so_far - w)[heads]
            w = (so_far - before[run]) / sums[run]
            w[np.append(heads[1:], b - a) - 1] = 1.0
            share[order[a:b]] = w
        self.first_edge = np.concatenate([self.first_edge, (len(self.share) + np.searchsorted(
            node, np.arange(nodes))).astype(np.int32)])
        self.share = np.concatenate([self.share, share])
        self.back = np.concatenate([self.back, (base + origin).astype(np.int32)])
        self.piece = np.concatenate([self.piece, piece])
        starts = np.zeros(len(total), dtype=bool)
        starts[first + np.arange(len(parts))] = True
        self.is_start = np.concatenate([self.is_start, starts])
        self.marks.append((len(self.end), base, self.first_edge[base]))
        self.end.update(zip(parts, (base + first + n + np.arange(len(parts))).tolist()))

    def in_bytes(self, ids: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Replaces coded characters by their byte pieces; ``count`` are the ids of each occurrence."""
        coded = np.flatnonzero(ids < 0)
        if not len(coded):
            return ids, count
        spelled = [self.byte_id[list(chr(-c - 1).encode("utf-8", "surrogatepass"))] for c in ids[coded].tolist()]
        widths = np.ones(len(ids), dtype=np.int64)
        widths[coded] = [len(x) for x in spelled]
        out = np.repeat(ids, widths)
        ends = np.cumsum(widths)
        at = np.repeat(ends[coded] - widths[coded], widths[coded])
        out[at + np.concatenate([np.arange(len(x)) for x in spelled])] = np.concatenate(spelled)
        owner = np.repeat(np.arange(len(count)), count)
        return out, np.bincount(owner, widths, minlength=len(count)).astype(np.int64)

    def sample(self, ends: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of all occurrences, one after the other, and how many each has."""
        node, alive = ends.astype(np.int64), np.arange(len(ends))
        count = np.zeros(len(ends), dtype=np.int64)
        drawn = []
        step = 0
        while True:
            alive = alive[~self.is_start[node[alive]]]
            if not len(alive):
                break
            draw = _uniform(seeds[alive], step)
            edge = self.first_edge[node[alive]].astype(np.int64)
            over = np.flatnonzero(self.share[edge] <= draw)  # the last share of a node is 1
            while len(over):
                edge[over] += 1
                over = over[self.share[edge[over]] <= draw[over]]
            drawn.append((alive, self.piece[edge]))
            node[alive] = self.back[edge]
            count[alive] += 1
            step += 1
        last = np.cumsum(count) - 1
        out = np.empty(int(count.sum()), dtype=np.int32)
        for step, (who, piece) in enumerate(drawn):
            out[last[who] - step] = piece
        return self.in_bytes(out, count)


_MIX = np.uint64(0x9E3779B97F4A7C15)


def _text_hash(text: str) -> int:
    h = 0
    for c in text:
        h = (h ^ ord(c)) * int(_MIX) & 0xFFFFFFFFFFFFFFFF
    return h


def _uniform(seeds: np.ndarray, step: int) -> np.ndarray:
    """Draws in [0, 1) from each seed and a draw's number (splitmix64)."""
    x = seeds + np.uint64((step + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)) * (1.0 / (1 << 53))


_lattices: dict[tuple[int, float], Lattices] = {}


def lattices(model: bytes, alpha: float) -> Lattices:
    key = (zlib.crc32(model), alpha)
    if key not in _lattices:
        _lattices.clear()
        _lattices[key] = Lattices(model, alpha)
    return _lattices[key]


def sample_ids(lat: Lattices, texts: list[str | None], seeds: list[int]) -> list[np.ndarray]:
    """A sampled segmentation of each text (null: empty), from its row's seed."""
    out: list[np.ndarray] = []
    at = 0
    while at < len(texts):
        found, first = [], at
        parts_so_far = 0
        while at < len(texts) and (at == first or parts_so_far < OCCURRENCES):
            found.append(_PART.findall(" " + texts[at]) if texts[at] else [])
            parts_so_far += len(found[-1])
            at += 1
        new = set().union(*found).difference(lat.end)
        if new and len(lat.end) + len(new) > CACHE_PARTS:
            lat.shrink(CACHE_PARTS // 2)
            new = set().union(*found).difference(lat.end)
        if new:
            lat.learn(list(new))
        ends, sizes = [lat.end[p] for parts in found for p in parts], [len(parts) for parts in found]
        n = np.array(sizes)
        row = np.repeat(np.array(seeds[first:at], dtype=np.int64).view(np.uint64), n)
        place = np.arange(len(ends), dtype=np.uint64) - np.repeat(np.cumsum(n) - n, n).astype(np.uint64)
        ids, count = lat.sample(np.array(ends, dtype=np.int64), row + place * np.uint64(0xD6E8FEB86659FD93))
        per_text = np.add.reduceat(np.append(count, 0), np.minimum(np.cumsum(n) - n, len(count))) if len(n) else n
        per_text = np.where(n > 0, per_text, 0)
        out += np.split(ids, np.cumsum(per_text)[:-1])
    return out


def decode(lat: Lattices, ids) -> str:
    """The text of a segmentation: its pieces' bytes without the first mark."""
    return b"".join([lat.bytes_of[i] for i in ids])[1:].decode("utf-8", "surrogatepass")


#: Ids that are decoded at once.
DECODED = 1 << 18


def decode_all(lat: Lattices, ids: np.ndarray, ends: np.ndarray) -> list[str]:
    """The texts of many segmentations: row i has the ids up to ``ends[i]`` from where the one before ends."""
    if lat.piece_bytes is None:
        size = np.array([len(x) for x in lat.bytes_of])
        lat.piece_bytes = np.frombuffer(b"".join(lat.bytes_of), np.uint8), np.cumsum(size) - size, size
    data, first, size = lat.piece_bytes
    out, row, begin = [], 0, 0
    while row < len(ends):
        stop = max(int(np.searchsorted(ends, begin + DECODED, "right")), row + 1)
        part = ids[begin:ends[stop - 1]]
        n = size[part]
        upto = np.cumsum(n)
        text = data[np.repeat(first[part] - (upto - n), n) + np.arange(upto[-1] if len(upto) else 0)].tobytes()
        cuts = np.append(0, upto)[ends[row:stop] - begin].tolist()
        at = 0
        for cut in cuts:
            out.append(text[at + 1:cut].decode("utf-8", "surrogatepass"))
            at = cut
        row, begin = stop, int(ends[stop - 1])
    return out


def encode(docs: DataFrame, model: bytes, alpha: float = ALPHA, seed: int = 0, id_col: str = "doc_id",
           text_col: str = "text", keep_ids: bool = True) -> DataFrame:
    """``doc_id``, ``n_pieces``, ``ids_crc32``, ``lossless`` (the pieces decode to the
    text) and, with ``keep_ids``, the sampled ``ids`` of every row.

    The same id, text and ``seed`` always give the same pieces; a null id has a
    seed of its own. Null and empty texts have no pieces; repeated rows each get
    a row; an empty table gives no rows; further columns are ignored."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # one vocabulary file
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["doc_id", "n_pieces", "ids_crc32", "lossless", *(["ids"] if keep_ids else [])]

    def run(batches):
        lat = lattices(shipped.value, alpha)
        for batch in text_slices(batches, 1, 2 * HANDED_ON):
            texts = batch.column(1).to_pylist()
            found = sample_ids(lat, texts, batch.column(2).to_pylist())
            ends = np.cumsum([len(x) for x in found]).astype(np.int32)
            ids = np.concatenate([np.zeros(0, np.int32), *found]).astype(np.int32)
            columns = [batch.column(0), pa.array([len(x) for x in found], pa.int64()),
                       pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in found], pa.int64()),
                       pa.array([x == (t or "") for x, t in zip(decode_all(lat, ids, ends), texts)], pa.bool_())]
            if keep_ids:
                columns.append(pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(ids)))
            yield pa.RecordBatch.from_arrays(columns, names)

    return (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                        F.xxhash64(F.lit(seed), F.col(id_col).cast("string")).alias("seed"))
            .mapInArrow(run, f"doc_id {kind}, n_pieces long, ids_crc32 long, lossless boolean"
                        + (", ids array<int>" if keep_ids else "")))


def decode_pieces(rows: DataFrame, model: bytes, ids_col: str = "ids") -> DataFrame:
    """``rows`` with a column ``text`` decoded from ``ids_col`` (null ids: null)."""
    shipped = rows.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("string")
    def text_of(ids: pa.Array) -> pa.Array:
        if not len(ids):
            return pa.array([], pa.string())
        lat = lattices(shipped.value, ALPHA)
        missing = np.asarray(ids.is_null())
        sizes = np.where(missing, 0, np.asarray(ids.value_lengths().fill_null(0)))
        return pa.array(decode_all(lat, np.asarray(ids.flatten()), np.cumsum(sizes)), pa.string(), mask=missing)

    return rows.withColumn("text", text_of(F.col(ids_col)))
