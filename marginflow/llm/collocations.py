"""Phrase collocation mining by Rabin-Karp fingerprints.

Texts are hashed in windows of bytes with numpy: a prefix polynomial over a window
gives the fingerprint of any word in one subtraction, and one over the words'
fingerprints gives that of every n-gram. A task adds up equal fingerprints, and the
shuffle deals packed arrays of them by range, so a frequent phrase is one entry a task.

A phrase is as frequent as its rarest part at most. So words are counted first, then
bigrams of frequent words, then trigrams of frequent bigrams; each level leaves a
bitmap of its frequent fingerprints, of a fixed size, that may hold more than these.
A last pass counts what all bitmaps let through, with a pointer to one occurrence and
half of a second, independent fingerprint. Only frequent phrases are materialised, by their
pointers; what a pointer finds is hashed again and compared. A fingerprint whose second
ones differ stands for several phrases: these are counted by their text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginflow.llm.common import written

LONGEST = 4
MIN_COUNT = 30
#: A phrase goes if a longer one has this percentage of its occurrences.
COVERED = 80
TOP = 2000
SCALE = 2_000_000
#: Bytes of text that are hashed at once, and entries that a task holds before it adds them up.
WINDOW, ENTRIES = 1 << 20, 1 << 21
#: Input partitions that a task reads: what they share is added up before the shuffle.
SPLITS = 3
#: Bits of a fingerprint, beside its range, by which the levels below the last pass count.
LEVEL_BITS = 24
#: log2 of the bits of a level's bitmap. More bits let fewer rare n-grams through; results do not depend on it.
FILTER_BITS = 26
#: Bytes of text for each range of fingerprints; a range's entries are added up in memory.
RANGE_BYTES = 32 << 20

_BREAKS, _BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
_SEPARATOR = re.compile(rb"[.,;:!?\n\x0b\x0c\r \t]")
_TO_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")

_ENTRY = np.dtype([("fp", "u8"), ("low", "u4"), ("high", "u4"), ("count", "i8"), ("n", "u1"),
                   ("key", "i8"), ("at", "u4"), ("size", "u4")])


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of a polynomial's value over all bits."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Polynomial:
    """A polynomial in an odd base modulo 2^64; bytes stand for random coefficients,
    upper and lower case of A to Z for the same."""

    def __init__(self, seed: int):
        draw = np.random.default_rng(seed)
        self.table = draw.integers(0, 1 << 64, 256, dtype=np.uint64)
        self.table[65:91] = self.table[97:123]
        self.base = int(draw.integers(0, 1 << 63)) << 1 | 1
        self._powers = self._inverse = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self._powers) < n:
            for name, base in (("_powers", self.base), ("_inverse", pow(self.base, -1, 1 << 64))):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))

    def spans(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The polynomial's value for each values[start:end], by prefix sums."""
        self._grow(len(values) + 1)
        prefix = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self._powers[:len(values)], out=prefix[1:])
        return (prefix[ends] - prefix[starts]) * self._inverse[starts]

    def words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return _mixed(self.spans(self.table[data], starts, ends) + (ends - starts).astype(np.uint64))

    def ngrams(self, words: np.ndarray, n: int, seeds: np.ndarray) -> np.ndarray:
        """Fingerprints of words[i:i + n] for each i, one apart for each ``seeds[i]``."""
        i = np.arange(max(len(words) - n + 1, 0))
        return _mixed(_mixed(self.spans(words, i, i + n) + np.uint64(n)) ^ seeds[:len(i)])

    def seed(self, lang: str) -> int:
        """Sets a language's fingerprints apart; never the fingerprint of a word of its name."""
        data = np.frombuffer(lang.encode(), np.uint8)
        return int(_mixed(self.words(data, np.array([0]), np.array([len(data)])) + np.uint64(self.base))[0])


@dataclass
class _Words:
    """The words of a window: where they are in its bytes, their piece, document and
    text, and whether they are only there as what stands before."""
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    piece: np.ndarray
    open_piece: int
    doc: np.ndarray
    shift: np.ndarray   # what turns a place in the window into one in the document's text, for each document
    context: np.ndarray


_KIND = np.zeros(256, np.uint8)
_KIND[list(_BLANKS)] = 1
_KIND[list(_BREAKS)] = 2


def _parsed(texts: list[bytes], context: int = 0, offset: int = 0) -> _Words:
    """``context``: the bytes at the beginning (of one text) that were counted before;
    ``offset``: where that text begins in its document."""
    data = np.frombuffer(b"\n".join(texts), np.uint8)
    begins = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]]) if texts else np.zeros(0, np.int64)
    kind = _KIND[data]
    edge = np.diff(np.concatenate([[0], (kind == 0).view(np.int8), [0]]))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    breaks = np.flatnonzero(kind == 2)
    return _Words(data, starts, ends, np.searchsorted(breaks, starts), len(breaks),
                  np.searchsorted(begins, starts, "right") - 1, offset - begins, starts < context)


def _long(text: bytes) -> Iterator[_Words]:
    """A text in windows that end between words; each is led by what its n-grams need."""
    start = counted = 0
    while True:
        cut, limit = len(text), counted + WINDOW
        if limit < len(text):
            cut = 1 + max(text.rfind(bytes([c]), counted, limit) for c in _BREAKS + _BLANKS)
            if cut <= counted:
                found = _SEPARATOR.search(text, limit)
                cut = found.end() if found else len(text)
        w = _parsed([text[start:cut]], counted - start, start)
        yield w
        if cut == len(text):
            return
        last = w.starts[w.piece == w.open_piece][-(LONGEST - 1):]
        start, counted = (start + int(last[0]) if len(last) else cut), cut


def _windows(texts: list[str | None]) -> Iterator[tuple[list[int], _Words]]:
    """(rows, words) of all texts, short ones together."""
    rows, held, size = [], [], 0
    for i, text in enumerate(texts):
        data = (text or "").encode()
        if size + len(data) > WINDOW and held:
            yield rows, _parsed(held)
            rows, held, size = [], [], 0
        if len(data) > WINDOW:
            for w in _long(data):
                yield [i], w
        elif data:
            rows.append(i)
            held.append(data)
            size += len(data)
    if held:
        yield rows, _parsed(held)


@dataclass(frozen=True)
class _Hashes:
    """Both fingerprints; ``bits`` of the first are used (fewer only to test collisions)."""
    first: Polynomial
    second: Polynomial
    bits: int

    def cut(self, fps: np.ndarray) -> np.ndarray:
        return fps & np.uint64((1 << 64) - (1 << (64 - self.bits)))


def _hashes(bits: int) -> _Hashes:
    return _Hashes(Polynomial(11), Polynomial(23), bits)


def _has(bitmap: np.ndarray, fps: np.ndarray) -> np.ndarray:
    at = fps >> np.uint64(64 - FILTER_BITS)
    return (bitmap[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _counted(w: _Words, n: int) -> np.ndarray:
    """Whether words i to i + n - 1 are one piece's, and counted in this window."""
    last = np.arange(n - 1, max(len(w.starts), n - 1))
    return (w.piece[:len(last)] == w.piece[last]) & ~w.context[last]


def _candidates(hashes: _Hashes, w: _Words, seeds: np.ndarray, level: int, bitmap: np.ndarray | None,
                words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, fingerprint) of the ``level``-grams whose two parts of one word fewer pass ``bitmap``."""
    ok = _counted(w, level)
    if bitmap is not None:
        below = _has(bitmap, hashes.cut(hashes.first.ngrams(words, level - 1, seeds)))
        ok &= below[:-1][:len(ok)] & below[1:][:len(ok)]
    i = np.flatnonzero(ok)
    return i, hashes.cut(hashes.first.ngrams(words, level, seeds))[i]


def _added(parts: list[np.ndarray]) -> np.ndarray:
    """Entries, one for each fingerprint: counts added up, the pointer with the least key."""
    rows = np.concatenate(parts)
    rows = rows[np.lexsort((rows["at"], rows["key"], rows["fp"]))]
    first = np.flatnonzero(np.concatenate([[True], rows["fp"][1:] != rows["fp"][:-1]])) if len(rows) else []
    out = rows[first]
    if len(out):
        out["count"] = np.add.reduceat(rows["count"], first)
        out["low"] = np.minimum.reduceat(rows["low"], first)
        out["high"] = np.maximum.reduceat(rows["high"], first)
    return out


def _pairs_added(fps: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    fp, count = np.concatenate(fps), np.concatenate(counts)
    order = np.argsort(fp)
    fp, count = fp[order], count[order]
    if not len(fp):
        return fp, count
    first = np.flatnonzero(np.concatenate([[True], fp[1:] != fp[:-1]]))
    return fp[first], np.add.reduceat(count, first)


def _planes(a: np.ndarray) -> bytes:
    """The first bytes of all items, then the second ones, and so on: sorted or small numbers compress well."""
    return a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes()


def _of_planes(data: bytes, kind: np.dtype) -> np.ndarray:
    kind = np.dtype(kind)
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(kind.itemsize, -1).T).view(kind).ravel()


def _dealt(fps: np.ndarray, ranges: int) -> Iterator[tuple[int, slice]]:
    """(range, slice) of sorted fingerprints; ``ranges`` is a power of two above 1."""
    of = (fps >> np.uint64(65 - ranges.bit_length())).astype(np.int64)
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(of)) + 1, [len(fps)]])
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if a < b:
            yield int(of[a]), slice(a, b)


def _seeds(polynomial: Polynomial, langs: list[str], known: dict) -> np.ndarray:
    for x in set(langs) - known.keys():
        known[x] = polynomial.seed(x)
    return np.array([known[x] for x in langs], np.uint64)


def _by_range(blobs: DataFrame) -> DataFrame:
    return blobs.repartition("range").sortWithinPartitions("range")


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[dict]]]:
    """(range, rows) from a partition sorted by range."""
    at, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if at is not None and row["range"] != at:
                yield at, held
                held = []
            at = row["range"]
            held.append(row)
    if at is not None:
        yield at, held


def _level(docs: DataFrame, hashes: _Hashes, level: int, below, ranges: int, min_count: int) -> np.ndarray:
    """The bitmap of the fingerprints of ``level``-grams that occur ``min_count`` times or
    more, and of others that begin like them: only the first bits are counted by. Each
    range fills its own stretch of the bitmap, which is all the driver gets."""
    bits = ranges.bit_length() - 1
    cut = np.uint64(64 - bits - LEVEL_BITS)
    small = np.dtype("u1" if min_count < 256 else "u4")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = None if below is None else np.frombuffer(below.value, np.uint8)
        known, fps, counts = {}, [], []

        def flush() -> Iterator[pa.RecordBatch]:
            fp, n = _pairs_added(fps, counts)
            n = np.minimum(n, min_count).astype(small)
            low = (fp & np.uint64((1 << LEVEL_BITS) - 1)).astype(np.uint32)
            for r, s in _dealt(fp << cut, ranges):
                yield pa.RecordBatch.from_pydict({"range": pa.array([r], pa.int32()),
                                                  "fps": pa.array([_planes(low[s])], pa.binary()),
                                                  "counts": pa.array([n[s].tobytes()], pa.binary())})

        for batch in batches:
            langs = _seeds(hashes.first, batch.column(0).to_pylist(), known)
            for rows, w in _windows(batch.column(1).to_pylist()):
                seeds = langs[rows][w.doc]
                words = hashes.first.words(w.data, w.starts, w.ends)
                _, found = _candidates(hashes, w, seeds, level, bitmap, words)
                fp, n = np.unique(found >> cut, return_counts=True)
                fps.append(fp)
                counts.append(n)
                if sum(map(len, fps)) > 2 * ENTRIES:
                    fp, n = _pairs_added(fps, counts)
                    fps, counts = [fp], [n]
                    if len(fp) > ENTRIES:
                        yield from flush()
                        fps, counts = [], []
        if fps:
            yield from flush()

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r, rows in _grouped(batches):
            fp, n = _pairs_added([_of_planes(x["fps"], "u4") for x in rows],
                                 [np.frombuffer(x["counts"], small).astype(np.int64) for x in rows])
            stretch = np.zeros((1 << FILTER_BITS) // ranges, np.uint8)
            stretch[fp[n >= min_count] >> np.uint32(LEVEL_BITS + bits - FILTER_BITS)] = 1
            yield pa.RecordBatch.from_pydict({"range": pa.array([r], pa.int32()),
                                              "bits": pa.array([np.packbits(stretch, bitorder="little").tobytes()])})

    tallied = _by_range(docs.select("lang", "text").mapInArrow(count, "range int, fps binary, counts binary"))
    bitmap = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    # one row a range and 2^FILTER_BITS bits in all, whatever the input
    for row in tallied.mapInArrow(frequent, "range int, bits binary").collect():
        part = np.frombuffer(row["bits"], np.uint8)
        bitmap[row["range"] * len(part):][:len(part)] = part
    return bitmap


_FOUND = "n int, fp long, a long, key long, at long, size long, clear boolean, lang string, words long"


def _occurrences(docs: DataFrame, hashes: _Hashes, bitmaps, ranges: int, min_count: int) -> DataFrame:
    """The frequent fingerprints of all lengths: count, a pointer to an occurrence (the
    hash of the text, place and size in bytes), and whether all occurrences agree in the
    second fingerprint (``clear``). Rows with ``n`` = 0 hold the words of a language in a task."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps = [np.frombuffer(b.value, np.uint8) for b in bitmaps]
        known, check_known, held, totals = {}, {}, [], {}

        def rows_of(ranges_: list, blobs: list, langs: list, words: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({
                "range": pa.array(ranges_, pa.int32()), "entries": pa.array(blobs, pa.binary()),
                "lang": pa.array(langs, pa.string()), "words": pa.array(words, pa.int64())})

        for batch in batches:
            names, texts, keys = (batch.column(i) for i in range(3))
            names = names.to_pylist()
            langs = _seeds(hashes.first, names, known)
            checks = _seeds(hashes.second, names, check_known)
            keys = keys.to_numpy(zero_copy_only=False)
            for rows, w in _windows(texts.to_pylist()):
                seeds, check_seeds, key = langs[rows][w.doc], checks[rows][w.doc], keys[rows][w.doc]
                words = hashes.first.words(w.data, w.starts, w.ends)
                second = hashes.second.words(w.data, w.starts, w.ends)
                for d, n in zip(*np.unique(w.doc[~w.context], return_counts=True)):
                    name = names[rows[d]]
                    totals[name] = totals.get(name, 0) + int(n)
                for n in range(1, LONGEST + 1):
                    if n == LONGEST:
                        i, fp = _candidates(hashes, w, seeds, n, maps[-1], words)
                    else:
                        i, fp = _candidates(hashes, w, seeds, n, None, words)
                        passed = _has(maps[n - 1], fp)
                        i, fp = i[passed], fp[passed]
                    if not len(i):
                        continue
                    order = np.argsort(fp)
                    i, fp = i[order], fp[order]
                    check = (hashes.second.ngrams(second, n, check_seeds)[i] >> np.uint64(32)).astype(np.uint32)
                    first = np.flatnonzero(np.concatenate([[True], fp[1:] != fp[:-1]]))
                    one = i[first]
                    entries = np.empty(len(first), _ENTRY)
                    entries["fp"], entries["n"], entries["key"] = fp[first], n, key[one]
                    entries["count"] = np.diff(first, append=len(fp))
                    entries["low"], entries["high"] = (f.reduceat(check, first) for f in (np.minimum, np.maximum))
                    entries["at"] = w.starts[one] + w.shift[w.doc[one]]
                    entries["size"] = w.ends[one + n - 1] - w.starts[one]
                    held.append(entries)
                if sum(map(len, held)) > ENTRIES:
                    held = [_added(held)]
                    if len(held[0]) > ENTRIES // 2:
                        for r, s in _dealt(held[0]["fp"], ranges):
                            yield rows_of([r], [_planes(held[0][s])], [None], [0])
                        held = []
        if held:
            entries = _added(held)
            for r, s in _dealt(entries["fp"], ranges):
                yield rows_of([r], [_planes(entries[s])], [None], [0])
        if totals:
            at = [known[x] % ranges for x in totals]
            yield rows_of(at, [None] * len(at), list(totals), list(totals.values()))

    names = [x.split()[0] for x in _FOUND.split(", ")]
    types = [pa.int32()] + 5 * [pa.int64()] + [pa.bool_(), pa.string(), pa.int64()]

    def table(columns: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _grouped(batches):
            totals: dict[str, int] = {}
            for x in rows:
                if x["lang"] is not None:
                    totals[x["lang"]] = totals.get(x["lang"], 0) + x["words"]
            if totals:
                nothing = [None] * len(totals)
                yield table([[0] * len(totals), *6 * [nothing], list(totals), list(totals.values())])
            blobs = [_of_planes(x["entries"], _ENTRY) for x in rows if x["entries"] is not None]
            if blobs:
                e = _added(blobs)
                e = e[e["count"] >= min_count]
                nothing = [None] * len(e)
                fp = np.ascontiguousarray(e["fp"]).view(np.int64)
                yield table([e["n"].astype(np.int32), fp, e["count"], e["key"], e["at"].astype(np.int64),
                             e["size"].astype(np.int64), e["low"] == e["high"], nothing, nothing])

    blobs = docs.select("lang", "text", "key").mapInArrow(count, "range int, entries binary, lang string, words long")
    return _by_range(blobs).mapInArrow(frequent, _FOUND)


def _phrase(data: bytes) -> bytes:
    """A phrase as it is returned: lower case, one space between words."""
    return b" ".join(x for x in data.translate(_TO_LOWER).replace(b"\t", b" ").split(b" ") if x)


def _materialised(docs: DataFrame, found: DataFrame, hashes: _Hashes) -> DataFrame:
    """(lang, phrase, n, f, fp, same) of the clear fingerprints: the text that each pointer
    finds, and whether it gives the fingerprint again."""
    pointers = found.where("n > 0 AND clear").select("key", F.struct("n", "fp", "a", "at", "size").alias("p"))
    keys = written(pointers.select("key").distinct(), "pointer-keys")
    # copies of a text have one key; they are taken together before their phrases are
    texts = docs.join(keys, "key", "left_semi").groupBy("key").agg(F.min(F.struct("text", "lang")).alias("d"))
    grouped = pointers.groupBy("key").agg(F.collect_list("p").alias("ps"))  # at most the n-grams of one text

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for batch in batches:
            for text, lang, ps in zip(*(c.to_pylist() for c in batch.columns)):
                data = text.encode()
                phrases = [_phrase(data[p["at"]:p["at"] + p["size"]]) for p in ps]
                w = _parsed(phrases)
                words = hashes.first.words(w.data, w.starts, w.ends)
                seeds = np.full(len(words), _seeds(hashes.first, [lang], known)[0], np.uint64)
                first = np.searchsorted(w.doc, np.arange(len(phrases)))
                counts = np.bincount(w.doc, minlength=len(phrases))
                want = np.array([p["n"] for p in ps])
                fps = np.zeros(len(ps), np.uint64)
                for n in range(1, LONGEST + 1):
                    mine = np.flatnonzero((want == n) & (counts == n))
                    fps[mine] = hashes.cut(hashes.first.ngrams(words, n, seeds))[first[mine]]
                same = (fps.view(np.int64) == np.array([p["fp"] for p in ps])) & (counts == want)
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array([lang] * len(ps), pa.string()),
                    "phrase": pa.array([x.decode(errors="replace") for x in phrases], pa.string()),
                    "n": pa.array(want, pa.int32()), "f": pa.array([p["a"] for p in ps], pa.int64()),
                    "fp": pa.array([p["fp"] for p in ps], pa.int64()), "same": pa.array(same)})

    return (texts.join(grouped, "key").select("d.text", "d.lang", "ps")
            .mapInArrow(read, "lang string, phrase string, n int, f long, fp long, same boolean"))


def _by_text(docs: DataFrame, doubtful: DataFrame, hashes: _Hashes, min_count: int) -> DataFrame:
    """(lang, phrase, n, f) of the phrases behind fingerprints that several share, by their text."""
    slots = (doubtful.select(F.shiftrightunsigned("fp", 64 - FILTER_BITS).alias("at"))
             .groupBy(F.shiftright("at", 5).alias("slot"))
             .agg(F.expr("bit_or(shiftleft(1L, int(at % 32)))").alias("bits")))
    words = np.zeros(1 << (FILTER_BITS - 5), np.uint32)
    for row in slots.toLocalIterator():  # at most 2^(FILTER_BITS - 5) rows
        words[row["slot"]] = row["bits"]
    bitmap = docs.sparkSession.sparkContext.broadcast(words.astype("<u4").tobytes())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, wanted = {}, np.frombuffer(bitmap.value, np.uint8)
        for batch in batches:
            names = batch.column(0).to_pylist()
            langs = _seeds(hashes.first, names, known)
            for rows, w in _windows(batch.column(1).to_pylist()):
                data, seeds = w.data.tobytes(), langs[rows][w.doc]
                hashed = hashes.first.words(w.data, w.starts, w.ends)
                found: dict[tuple, int] = {}
                for n in range(1, LONGEST + 1):
                    i, fp = _candidates(hashes, w, seeds, n, None, hashed)
                    passed = _has(wanted, fp)
                    for j, f in zip(i[passed].tolist(), fp[passed].view(np.int64).tolist()):
                        key = f, names[rows[w.doc[j]]], n, _phrase(data[w.starts[j]:w.ends[j + n - 1]])
                        found[key] = found.get(key, 0) + 1
                if found:
                    fps, lang, n, phrase = zip(*found)
                    yield pa.RecordBatch.from_pydict({
                        "fp": pa.array(fps, pa.int64()), "lang": pa.array(lang, pa.string()),
                        "n": pa.array(n, pa.int32()), "phrase": pa.array([p.decode() for p in phrase]),
                        "f": pa.array(list(found.values()), pa.int64())})

    return (docs.select("lang", "text").mapInArrow(count, "fp long, lang string, n int, phrase string, f long")
            .join(doubtful, "fp", "left_semi").groupBy("lang", "phrase", "n").agg(F.sum("f").alias("f"))
            .where(F.col("f") >= min_count))


def frequent_phrases(docs: DataFrame, min_count: int = MIN_COUNT, lang_col: str = "lang", text_col: str = "text",
                     bits: int = 64) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, n, f): every phrase of one to four words that occurs ``min_count``
    times or more in a language; and (lang, words): each language's word occurrences.

    Texts are lower-cased (A to Z), split into pieces at ``.,;:!?`` and line ends and
    these into words at spaces and tabs; occurrences lie within pieces and may overlap.
    A null text is empty, a null language ``und``; repeated rows count each; texts of any
    length are read whole, some at a time; an empty table gives no rows; further columns
    are ignored. Counts are exact: see the module's notes on collisions."""
    spark = docs.sparkSession
    docs = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(text_col, F.lit("")).alias("text"))
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = 1 << min((max(8 * partitions, size // RANGE_BYTES) - 1).bit_length(), FILTER_BITS - 3)
    docs = docs.coalesce(-(-docs.rdd.getNumPartitions() // SPLITS))
    hashes, bitmaps = _hashes(bits), []
    for level in range(1, LONGEST):
        bitmap = _level(docs, hashes, level, bitmaps[-1] if bitmaps else None, ranges, min_count)
        bitmaps.append(spark.sparkContext.broadcast(bitmap.tobytes()))
    keyed = docs.withColumn("key", F.xxhash64("text", "lang"))
    found = written(_occurrences(keyed, hashes, bitmaps, ranges, min_count), "frequent-fingerprints")
    phrases = written(_materialised(keyed, found, hashes), "frequent-phrases")
    doubtful = written(found.where("n > 0 AND NOT clear").select("fp")
                       .unionByName(phrases.where("NOT same").select("fp")), "doubtful-fingerprints")
    clear = phrases.where("same").select("lang", "phrase", "n", "f")
    if not doubtful.isEmpty():
        clear = clear.unionByName(_by_text(docs, doubtful, hashes, min_count))
    words = found.where("n = 0").groupBy("lang").agg(F.sum("words").alias("words"))
    return clear, words


def _score(a: Column, parts: Column) -> Column:
    """floor(SCALE * a / parts) without overflow."""
    whole = F.lit(SCALE).cast("decimal(7,0)") * a.cast("decimal(19,0)")
    return F.call_function("div", whole, parts.cast("decimal(20,0)"))


def top_collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, covered: int = COVERED,
                     lang_col: str = "lang", text_col: str = "text", bits: int = 64) -> DataFrame:
    """Each language's best phrases of two to four words: ``lang``, ``rank``, ``phrase``,
    ``a`` (occurrences), ``l`` and ``r`` (those of the two parts of the cut that scores
    lowest, ties to the first cut), ``n`` (words of the language) and ``score``, that is
    floor(2000000 a / (l + r)).

    A phrase whose words lie in a longer frequent phrase with at least ``covered`` percent
    of its occurrences is dropped. Ties in ``score`` go by ``a``, then by phrase. Input
    rows as for ``frequent_phrases``."""
    found, words = frequent_phrases(docs, min_count, lang_col, text_col, bits)
    found = written(found, "phrases")
    split = F.split("phrase", " ")
    longer = found.where("n > 1")

    cuts = longer.select("lang", "phrase", F.col("f").alias("a"), "n", F.explode(F.sequence(F.lit(1), F.col("n") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice(split, 1, F.col("k")), " ").alias("left"),
                       F.array_join(F.slice(split, F.col("k") + 1, F.col("n")), " ").alias("right"))
    left = found.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = found.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    scored = (cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"])
              .withColumn("score", _score(F.col("a"), F.col("l") + F.col("r")))
              .groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")))

    inner = F.expr("""flatten(transform(sequence(2, n - 1), m ->
        transform(sequence(1, n - m + 1), i -> array_join(slice(split(phrase, ' '), i, m), ' '))))""")
    covers = (longer.where("n > 2").select("lang", F.explode(F.array_distinct(inner)).alias("phrase"), "f")
              .groupBy("lang", "phrase").agg(F.max("f").alias("cover")))
    kept = (scored.join(covers, ["lang", "phrase"], "left")
            .where(F.col("cover").isNull()
                   | (F.lit(100).cast("decimal(3,0)") * F.col("cover").cast("decimal(19,0)")
                      < F.lit(covered).cast("decimal(10,0)") * F.col("a").cast("decimal(19,0)"))))
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    best = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(words, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", F.col("words").alias("n"),
        F.col("cut.score").cast("long").alias("score"))
