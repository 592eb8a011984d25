"""Best-fit packing of tokenised documents into fixed-length sequences.

The method is bin completion: take the largest document left, enumerate the
undominated fillings of the room beside it, and branch over them, least waste
first; a branch ends when its waste cannot beat the incumbent, and the first
incumbent is best-fit decreasing.

Only the lengths matter, and there are at most ``capacity`` different ones, so
the search runs over a histogram of at most ``capacity`` counts whatever the
corpus size: one step places as many equal sequences as the counts allow. Spark
does what grows: it tokenises, counts, numbers the pieces of each length, and
looks every piece up in the resulting plan. The plan's size is bounded by the
capacity alone (see ``plan_rows``), so it may be broadcast.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marginflow.llm.common import HANDED_ON, text_slices, written

CAPACITY = 2048
#: Entries of the word cache of one Python worker; a full cache keeps the half it met first.
CACHE_WORDS = 500_000
#: Words (about) that are looked up before the unknown ones are encoded together.
WINDOW_WORDS = 500_000
#: Words of letters only that are encoded in one call.
BLOCK = 400
#: How many next-smaller lengths are tried at each depth of one filling.
WIDTHS = (8, 4, 2)
#: Nodes of the branch and bound; the incumbent is returned when they are used up.
NODES = 6000

_ASCII_MARKS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


# --- token ids ---------------------------------------------------------------------

class WordEncoder:
    """Token ids of texts by a tokenizer that never joins across white space.

    Each distinct word is encoded once and kept as its little-endian unsigned
    32-bit ids, so a text's ids are a join of kept strings. Words of letters only
    are encoded many to a call and told apart by their end-of-word pieces. A word is looked up
    with A-Z lower-cased when the tokenizer lower-cases anyway, and a run of
    ASCII marks after a letter or digit is encoded apart, as the tokenizer
    splits there too. Texts that may hold a special token's string keep their case.
    """

    def __init__(self, tokenizer_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.ids: dict[bytes, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, missing: set[bytes]) -> None:
        stems, new = [], set()
        for w in missing:
            s = w.rstrip(_ASCII_MARKS)
            if len(s) in (0, len(w)) or b"<|" in w or not (s[-1:].isalnum() or s.decode()[-1].isalnum()):
                new.add(w)
            else:
                stems.append((w, s, w[len(s):]))
                new.add(s)
                new.add(w[len(s):])
        new = new.difference(self.ids)
        letters = [w for w in new if w.isalpha() or (not w.isascii() and w.decode().isalpha())]
        rest = list(new.difference(letters))
        for at in range(0, len(letters), BLOCK):
            block = letters[at:at + BLOCK]
            ids = np.asarray(self._ids([b" ".join(block).decode()])[0], dtype="<u4")
            ends = ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()
            if len(ends) == len(block):  # one end-of-word piece each
                joined = ids.tobytes()
                self.ids.update(zip(block, [joined[a:b] for a, b in zip([0, *ends], ends)]))
            else:
                rest += block
        for w, ids in zip(rest, self._ids([w.decode() for w in rest])):
            self.ids[w] = np.asarray(ids, dtype="<u4").tobytes()
        known = self.ids
        known.update([(w, known[s] + known[marks]) for w, s, marks in stems])

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """The ids of each text; a null text has none. Texts are split some at a time."""
        at = 0
        while at < len(texts):
            get, rows, wanted, words, end = self.ids.get, [], set(), 0, at
            while end < len(texts) and (end == at or len(wanted) < CACHE_WORDS // 8 and words < WINDOW_WORDS):
                raw = (texts[end] or "").encode()
                ws = ([w if b"<|" in w else w.lower() for w in raw.split()] if b"<|" in raw else raw.lower().split())
                parts = list(map(get, ws, repeat(b"")))
                holes = [] if all(parts) else [(i, ws[i]) for i, p in enumerate(parts) if not p]
                wanted.update([w for _, w in holes])
                rows.append((parts, holes))
                words += len(ws)
                end += 1
            wanted = wanted.difference(self.ids)  # a known word may have no ids
            if len(self.ids) + 2 * len(wanted) > CACHE_WORDS:
                # what was met first is what is met often; the rest makes room
                self.ids = dict(islice(self.ids.items(), CACHE_WORDS // 2))
            if wanted:
                self._learn(wanted)
            for parts, holes in rows:
                for i, w in holes:
                    parts[i] = self.ids.get(w, b"")
                yield b"".join(parts)
            at = end


_encoders: dict[int, WordEncoder] = {}


def _encoder(tokenizer_json: str) -> WordEncoder:
    key = zlib.crc32(tokenizer_json.encode())
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = WordEncoder(tokenizer_json)
    return _encoders[key]


PIECES = ("piece int, start long, length long, ids_crc32 long, "
          "part int, nth long")


def token_pieces(docs: DataFrame, tokenizer_json: str, capacity: int = CAPACITY,
                 end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
                 keep_ids: bool = False) -> DataFrame:
    """One row per piece: a document's ids, then ``end_id``, cut after every
    ``capacity`` ids. ``part`` and ``nth`` number the pieces of each length
    within the input partition. ``keep_ids`` adds the ids themselves."""
    shipped = docs.sparkSession.sparkContext.broadcast(tokenizer_json)  # one vocabulary file
    end = np.asarray([end_id], dtype="<u4").tobytes()

    def pieces(batches):
        encoder, part, seen = _encoder(shipped.value), TaskContext.get().partitionId(), {}
        for batch in text_slices(batches, 1, 2 * HANDED_ON):
            out: list[list] = [[] for _ in range(8)]
            texts = batch.column(1).to_pylist()
            for doc, ids in zip(batch.column(0).to_pylist(), encoder.encode(texts)):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    cut = ids[at:at + 4 * capacity]
                    n = len(cut) // 4
                    nth = seen[n] = seen.get(n, -1) + 1
                    row = (doc, piece, at // 4, n, zlib.crc32(cut), part, nth, cut)
                    for column, value in zip(out, row):
                        column.append(value)
            types = [batch.schema.field(0).type, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            arrays = [pa.array(c, t) for c, t in zip(out, types)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"]
            if keep_ids:
                ends = np.cumsum([0, *out[3]]).astype(np.int32)
                ids = np.frombuffer(b"".join(out[7]), "<u4").astype(np.int32)
                arrays.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(ids)))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(pieces, f"doc_id {kind}, " + PIECES + (", ids array<int>" if keep_ids else "")))


# --- bin completion over a histogram ------------------------------------------------

class _Room:
    """Counts per length, with the lengths that still have pieces in order."""

    def __init__(self, counts: dict[int, int]):
        self.count = {n: c for n, c in counts.items() if c > 0}
        self.lengths = sorted(self.count)

    def take(self, n: int, k: int) -> None:
        self.count[n] = self.count.get(n, 0) - k
        if not self.count[n]:
            del self.count[n]
            self.lengths.remove(n)
        elif self.count[n] == -k:  # given back to a length that had none
            self.lengths.insert(bisect_right(self.lengths, n), n)


def _fill(room: _Room, used: dict[int, int], left: int, below: int, depth: int):
    """Fillings of ``left`` from lengths up to ``below``, larger lengths first.

    A length that closes the room exactly dominates every other way to use that
    room, so it alone is tried. Beyond the first depths the best fit is taken.
    """
    if left in room.count and left <= below and room.count[left] > used.get(left, 0):
        yield {**used, left: used.get(left, 0) + 1}, 0
        return
    i, tried, width = bisect_right(room.lengths, min(left, below)) - 1, 0, 1
    if depth < len(WIDTHS):
        width = WIDTHS[depth]
    while i >= 0 and tried < width:
        n = room.lengths[i]
        if room.count[n] > used.get(n, 0):
            tried += 1
            more = 1 if depth < len(WIDTHS) else min(left // n, room.count[n] - used.get(n, 0))
            yield from _fill(room, {**used, n: used.get(n, 0) + more}, left - more * n, n, depth + 1)
        i -= 1
    if not tried:
        yield used, left


def _completions(room: _Room, capacity: int, wasted: int) -> list[tuple[dict[int, int], int]]:
    """Undominated sequences that hold the largest length left, least waste first.

    With equal waste, fewer and larger pieces come first (small ones fit
    anywhere later). A sequence whose waste alone exceeds the bound is dropped;
    the best one always stays.
    """
    n = room.lengths[-1]
    found = {}
    for used, left in _fill(room, {n: 1}, capacity - n, n, 0):
        found[tuple(sorted(used.items(), reverse=True))] = left
        if not left and len(found) >= 4 * WIDTHS[0]:
            break
    ranked = sorted(found.items(), key=lambda f: (f[1], [(-a, b) for a, b in f[0]]))
    kept = [(dict(f), left) for f, left in ranked if left <= wasted]
    return kept or [(dict(ranked[0][0]), ranked[0][1])]


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Best-fit decreasing over a histogram: (pieces per length, how many such sequences)."""
    room, out = _Room(counts), []
    while room.lengths:
        used, left = {}, capacity
        while (i := bisect_right(room.lengths, left) - 1) >= 0:
            while i >= 0 and room.count[room.lengths[i]] <= used.get(room.lengths[i], 0):
                i -= 1
            if i < 0:
                break
            n = room.lengths[i]
            k = min(left // n, room.count[n] - used.get(n, 0))
            used[n] = used.get(n, 0) + k
            left -= k * n
        times = min(room.count[n] // k for n, k in used.items())
        for n, k in used.items():
            room.take(n, k * times)
        out.append((used, times))
    return out


def least_sequences(counts: dict[int, int], capacity: int) -> int:
    """A lower bound on the sequences: by total length, and by pieces over half."""
    total = -(-sum(n * c for n, c in counts.items()) // capacity)
    return max(total, sum(c for n, c in counts.items() if 2 * n > capacity))


def bin_completion(counts: dict[int, int], capacity: int = CAPACITY,
                   nodes: int = NODES) -> list[tuple[dict[int, int], int]]:
    """Sequences for a histogram of lengths: (pieces per length, multiplicity)."""
    incumbent = best_fit(counts, capacity)
    best, bound = sum(t for _, t in incumbent), least_sequences(counts, capacity)
    total = sum(n * c for n, c in counts.items())
    room, path, frames = _Room(counts), [], []
    wasted = done = placed = 0
    while best > bound and nodes > 0:
        if room.lengths and done + -(-(total - placed) // capacity) < best:
            nodes -= 1
            # the waste that a better solution than the incumbent can still afford
            frames.append(iter(_completions(room, capacity, (best - 1) * capacity - total - wasted)))
        elif not room.lengths and done < best:
            best, incumbent = done, [(dict(u), t) for u, t, _ in path]
        step = None
        while frames and step is None:
            if len(path) == len(frames):  # undo the step this frame took before
                used, times, left = path.pop()
                for n, k in used.items():
                    room.take(n, -k * times)
                done, placed = done - times, placed - times * (capacity - left)
                wasted -= times * left
            step = next(frames[-1], None)
            if step is None:
                frames.pop()
        if step is None:
            break
        used, left = step
        times = min(room.count[n] // k for n, k in used.items())
        for n, k in used.items():
            room.take(n, k * times)
        path.append((used, times, left))
        done, placed, wasted = done + times, placed + times * (capacity - left), wasted + times * left
    return incumbent


def plan_rows(patterns: list[tuple[dict[int, int], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, pieces a sequence, first sequence, offset).

    A sequence holds at most sqrt(2 * capacity) different lengths, and each
    pattern uses up some length, so the rows are bounded by the capacity."""
    rows, used, first = [], {}, 0
    for pattern, times in patterns:
        offset = 0
        for n, k in sorted(pattern.items(), reverse=True):
            a = used.get(n, 0)
            rows.append((n, a, a + k * times, k, first, offset))
            used[n] = a + k * times
            offset += n * k
        first += times
    return rows


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to ``token_pieces`` rows.

    Every piece is placed exactly once, each sequence is gapless from offset 0,
    and no sequence exceeds ``capacity``. Rows with equal contents are separate
    pieces; an empty input gives an empty result.
    """
    spark = pieces.sparkSession
    pieces = written(pieces, "pieces")
    by_part = pieces.groupBy("part", "length").count()
    histogram = {r["length"]: r["n"] for r in   # at most `capacity` rows
                 by_part.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    plan = spark.createDataFrame(
        plan_rows(bin_completion(histogram, capacity)) if histogram else [],
        "length long, first_rank long, end_rank long, per_sequence long, first_sequence long, base long")
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = by_part.select("part", "length", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("skip"))
    ranked = pieces.join(starts, ["part", "length"]).withColumn("rank", F.col("skip") + F.col("nth"))
    within = F.col("rank") - F.col("first_rank")
    return (ranked.join(F.broadcast(plan), "length")  # bounded by the capacity
            .where((F.col("rank") >= F.col("first_rank")) & (F.col("rank") < F.col("end_rank")))
            .withColumn("sequence_id", F.col("first_sequence") + F.floor(within / F.col("per_sequence")))
            .withColumn("offset", F.col("base") + (within % F.col("per_sequence")) * F.col("length"))
            .select(*[c for c in pieces.columns if c not in ("part", "nth")], "sequence_id", "offset"))


def pack_documents(docs: DataFrame, tokenizer_json: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Tokenise and pack: one row per piece of each document, with ``keep_ids`` its ``ids``.

    Null and empty texts are one piece that holds the end id alone; a null id
    stays null; repeated rows are packed each; an empty table gives no rows;
    further columns of ``docs`` are ignored.
    """
    return pack(token_pieces(docs, tokenizer_json, capacity, keep_ids=keep_ids), capacity)
