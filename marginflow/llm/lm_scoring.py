"""Scoring of documents by a gated recurrent language model trained on the corpus.

* Word counts cover every training token: a Spark aggregation to a written table.
* The model is a GRU over the most frequent ``VOCABULARY`` words; its softmax is
  factored: first a word's class, then the word in its class. All other words
  fall into bands by rank, each a symbol of input and output: a band holds as many
  ranks as all before it, and the last one also the words outside the head. A word
  of count c has probability c / N' of its band of N' tokens; in the last, with V'
  types, (c + 1) / (N' + V' + 1).
* Training starts from one model, fitted to a small sample; then every task
  trains a replica by truncated backpropagation over all the training documents
  of its partition, and the replicas are averaged, a bounded number at a time.
* Scoring lays documents end to end in parallel streams and reads them window by
  window; the state is carried from window to window and reset where a document
  begins, so a score is the log-likelihood of the complete document.

Words outside the ``HEAD`` most frequent are not looked up in the tasks: they
are joined with the counts, so no table that grows with the corpus is broadcast.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginflow.llm.common import written

#: What ends a document; no word holds white space.
END = b"\n"
HEAD = 131_072
#: Steps of the grid of counts for each doubling.
GRID = 32
#: Longer words are never part of the head, which bounds its size in bytes.
HEAD_WORD_BYTES = 64
VOCABULARY = 2048
CLASSES = 32
HIDDEN = 16
WINDOW = 32
STREAMS = 512
#: Documents (about) that the common starting model is fitted to.
WARM_UP_DOCS = 600
RATE = 0.02
CLIP = 1.0
#: Words that a counting task holds before it hands them on.
COUNT_WORDS = 400_000
#: Replicas that are averaged by one task.
FAN_IN = 32
#: Model values in one row of a replica.
SLICE = 4096
#: Tokens that are laid out in streams at once.
LAYOUT_TOKENS = 4_000_000


def tokens(text: str | None) -> list[bytes]:
    """The A-Z lower-cased words of a text, and one end (null: the end alone)."""
    ws = (text or "").encode("utf-8", "surrogatepass").lower().split()
    ws.append(END)
    return ws


# --- counts -------------------------------------------------------------------------

def count_words(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, n) over all texts, words as bytes."""
    def run(batches):
        held: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                held.update(tokens(text.as_py()))
                if len(held) > COUNT_WORDS:
                    yield _counts(held)
                    held.clear()
        yield _counts(held)

    return (docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "word binary, n long")
            .groupBy("word").agg(F.sum("n").alias("n")))


def _counts(held: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(held.keys()), pa.binary()), pa.array(list(held.values()), pa.int64())],
                                      ["word", "n"])


@dataclass
class Head:
    """The most frequent words, most frequent first; of them the first ``size`` are the vocabulary."""

    words: list[bytes]
    counts: np.ndarray
    total: int
    types: int
    size: int

    def __post_init__(self):
        self.number = {w: i for i, w in enumerate(self.words)}
        self.base = np.log10((self.counts + 1) / (self.total + self.types + 1))
        ranks = np.arange(self.size, len(self.words))
        band = np.log2(ranks / max(self.size, 1)).astype(np.int64)
        last = int(band.max(initial=0))
        #: symbols by head number, with that of words outside (-1) at the end
        self.symbol_of = np.concatenate([np.arange(self.size), self.size + band, [self.size + last]]).astype(np.int32)
        inside = int(self.counts[:self.size].sum())
        #: tokens of each band, and types of the last
        self.band_totals = np.bincount(band, self.counts[self.size:], minlength=last + 1).astype(np.int64)
        self.band_totals[last] = self.total - inside - self.band_totals[:last].sum()
        self.last_types = self.types - self.size - int((band < last).sum())
        own = np.append(np.zeros(self.size, dtype=np.int64), band)
        self.within = np.where(own < last, np.log10(self.counts / np.maximum(self.band_totals, 1)[own]),
                               np.log10((self.counts + 1) / self.last_total))

    @property
    def last_total(self) -> int:
        """What the counts in the last band, each plus one, and one unseen word come to."""
        return int(self.band_totals[-1]) + self.last_types + 1

    def encode(self, texts: list, collect: bool = True) -> tuple[np.ndarray, np.ndarray, list[Counter]]:
        """Head numbers of all tokens (-1: outside), tokens a text, and, with ``collect``,
        the words outside of each."""
        numbers, sizes, outside = [], [], []
        get = self.number.get
        for t in texts:
            ws = tokens(t)
            own = np.fromiter(map(get, ws, repeat(-1)), dtype=np.int32, count=len(ws))
            if collect:
                outside.append(Counter([ws[i] for i in np.flatnonzero(own < 0).tolist()]))
            numbers.append(own)
            sizes.append(len(ws))
        return (np.concatenate(numbers) if numbers else np.zeros(0, dtype=np.int32)), np.array(sizes), outside


def head_of(counts: DataFrame, size: int = HEAD, vocabulary: int = VOCABULARY) -> Head:
    """The words above the lowest count that at most ``size`` of them reach, among counts
    of a fixed grid: what a task sends to the driver is bounded."""
    total = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    short = counts.where(F.octet_length("word") <= HEAD_WORD_BYTES)
    level = F.floor(F.log2("n") * GRID)
    by_level = short.groupBy(level.alias("level")).count().collect()  # at most GRID * 63 rows
    least, taken = None, 0
    for r in sorted(by_level, key=lambda r: -r["level"]):
        if taken + r["count"] > size:
            break
        least, taken = r["level"], taken + r["count"]
    rows = short.where(level >= least).collect() if least is not None else []  # at most `size` words of bounded length
    rows.sort(key=lambda r: (-r["n"], bytes(r["word"])))
    return Head([bytes(r["word"]) for r in rows], np.array([r["n"] for r in rows], dtype=np.int64),
                total["n"] or 0, total["v"], min(vocabulary, len(rows)))


# --- the model ----------------------------------------------------------------------

def _log_softmax(e: np.ndarray, picked: np.ndarray, gradient: bool) -> tuple[np.ndarray, np.ndarray | None]:
    """Log probability of the picked column of each row, and its gradient to the scores ``e``
    (which are overwritten). Scores start from log frequencies; capped, they cannot overflow."""
    np.minimum(e, 60, out=e)
    rows = np.arange(len(e))
    out = e[rows, picked]
    np.exp(e, out=e)
    total = e @ np.ones(e.shape[1], dtype=e.dtype)
    out -= np.log(total)
    if not gradient:
        return out, None
    e *= (-1 / total)[:, None]
    e[rows, picked] += 1
    return out, e


class Network:
    """A GRU with a class-factored softmax. Symbols from ``size`` on stand for the bands of other words."""

    def __init__(self, head: Head, hidden: int = HIDDEN, classes: int = CLASSES, seed: int = 7):
        self.size, self.hidden = head.size, hidden
        mass = np.append(head.counts[:head.size], np.maximum(head.band_totals, 1)).astype(float)
        order = np.argsort(-mass, kind="stable")
        share = np.cumsum(np.sqrt(mass[order]))
        by_order = np.minimum((share / share[-1] * classes).astype(int), classes - 1)
        by_order = np.unique(by_order, return_inverse=True)[1]  # classes of equal root frequency, none empty
        self.class_of = np.empty(len(mass), dtype=np.int64)
        self.class_of[order] = by_order
        self.members = [order[by_order == c] for c in range(by_order.max() + 1)]
        self.place = np.empty(len(mass), dtype=np.int64)
        for m in self.members:
            self.place[m] = np.arange(len(m))
        self.first = np.cumsum([0, *(len(m) for m in self.members)])
        rng, h, n, c = np.random.default_rng(seed), hidden, len(mass), len(self.members)
        by_class = np.array([mass[m].sum() for m in self.members])
        word_bias = np.concatenate([np.log(mass[m] / mass[m].sum()) for m in self.members])
        normal = lambda *shape: (rng.standard_normal(shape) / np.sqrt(h)).astype(np.float32)
        self.p = {
            "embed": normal(n, h) * 0.5, "wx": normal(h, 3 * h), "wh": normal(h, 3 * h), "b": np.zeros(3 * h, np.float32),
            "wc": normal(h, c) * 0.1, "bc": np.log(by_class / by_class.sum()).astype(np.float32),
            "ww": normal(n, h) * 0.1, "bw": word_bias.astype(np.float32),
        }

    def flat(self) -> np.ndarray:
        return np.concatenate([self.p[k].ravel() for k in sorted(self.p)])

    def load(self, values: np.ndarray) -> None:
        at = 0
        for k in sorted(self.p):
            n = self.p[k].size
            self.p[k] = values[at:at + n].reshape(self.p[k].shape).astype(np.float32)
            at += n

    def states(self, inputs: np.ndarray, starts: np.ndarray, state: np.ndarray, keep: list | None = None):
        """States of a window (steps, streams); ``keep`` gathers what backpropagation needs."""
        p, n = self.p, self.hidden
        x = p["embed"][inputs]
        gx = x @ p["wx"] + p["b"]
        out = np.empty((*inputs.shape, n), dtype=x.dtype)
        state = state.copy()
        for t in range(len(inputs)):
            state[starts[t]] = 0
            gh = state @ p["wh"]
            zr = gx[t, :, :2 * n] + gh[:, :2 * n]
            np.negative(zr, out=zr)  # the logistic function, in place
            np.exp(zr, out=zr)
            zr += 1
            np.reciprocal(zr, out=zr)
            z, r = zr[:, :n], zr[:, n:]
            new = r * gh[:, 2 * n:]
            new += gx[t, :, 2 * n:]
            np.tanh(new, out=new)
            if keep is not None:
                keep.append((state, z, r, new, gh[:, 2 * n:]))
            state = np.multiply(z, state - new, out=out[t])
            state += new
            state = state.copy()  # the next step's start may clear some of it
        return out, state, x

    def log_probabilities(self, h: np.ndarray, targets: np.ndarray, grad: dict | None = None) -> np.ndarray:
        """Natural log probability of each target after its state (rows of ``h``).
        With ``grad``, the gradients of their sum are added to it, that of ``h`` as "h"."""
        p = self.p
        cls = self.class_of[targets]
        out, d = _log_softmax(h @ p["wc"] + p["bc"], cls, grad is not None)
        if grad is not None:
            grad["wc"] += h.T @ d
            grad["bc"] += np.ones(len(d), dtype=d.dtype) @ d
            grad["h"] = d @ p["wc"].T
        order = np.argsort(cls, kind="stable")
        ends = np.searchsorted(cls[order], np.arange(len(self.members) + 1))
        at, sorted_h = self.place[targets[order]], h[order]
        for c in range(len(self.members)):
            own = slice(ends[c], ends[c + 1])
            if ends[c] == ends[c + 1] or len(self.members[c]) == 1:
                continue
            s = slice(self.first[c], self.first[c + 1])
            rows, hc = order[own], sorted_h[own]
            lp, d = _log_softmax(hc @ p["ww"][s].T + p["bw"][s], at[own], grad is not None)
            out[rows] += lp
            if grad is not None:
                grad["ww"][s] += d.T @ hc
                grad["bw"][s] += np.ones(len(d), dtype=d.dtype) @ d
                grad["h"][rows] += d @ p["ww"][s]
        return out

    def backward(self, inputs, starts, kept, x, dh, grad) -> None:
        """Adds the gradients of a window from those of its states; it ends at the window's start."""
        p, n = self.p, self.hidden
        dgx = np.empty((*inputs.shape, 3 * n), dtype=x.dtype)
        dgh = np.empty_like(dgx)
        after = np.zeros_like(dh[0])
        recurrent = np.ascontiguousarray(p["wh"].T)
        for t in range(len(inputs) - 1, -1, -1):
            before, z, r, new, candidate = kept[t]
            d = dh[t] + after
            d_z = d * z
            d -= d_z                    # d (1 - z)
            own, through = dgx[t], dgh[t]
            np.multiply(d, 1 - new * new, out=own[:, 2 * n:])
            np.multiply(before - new, d * z, out=own[:, :n])
            np.multiply(own[:, 2 * n:] * candidate, r * (1 - r), out=own[:, n:2 * n])
            through[:] = own
            through[:, 2 * n:] *= r
            after = through @ recurrent
            after += d_z
            after[starts[t]] = 0
        grad["wh"] += np.concatenate([k[0] for k in kept]).T @ dgh.reshape(-1, 3 * n)
        flat = dgx.reshape(-1, 3 * n)
        grad["wx"] += x.reshape(-1, n).T @ flat
        grad["b"] += np.ones(len(flat), dtype=flat.dtype) @ flat
        dx = flat @ p["wx"].T
        order = np.argsort(inputs.ravel(), kind="stable")
        symbols = inputs.ravel()[order]
        heads = np.flatnonzero(np.append(True, symbols[1:] != symbols[:-1]))
        grad["embed"][symbols[heads]] += np.add.reduceat(dx[order], heads, axis=0)


class Adam:
    def __init__(self, net: Network, rate: float):
        self.net, self.rate, self.steps = net, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in net.p.items()}
        self.v = {k: np.zeros_like(v) for k, v in net.p.items()}

    def ascend(self, grad: dict) -> None:
        self.steps += 1
        a, b = 0.9, 0.99
        scale = self.rate * np.sqrt(1 - b ** self.steps) / (1 - a ** self.steps) / np.sqrt(1 + self.steps / 200)
        for k, v in self.net.p.items():
            g = np.clip(grad[k], -CLIP, CLIP)
            self.m[k] += (1 - a) * (g - self.m[k])
            self.v[k] += (1 - b) * (g * g - self.v[k])
            v += np.float32(scale) * self.m[k] / (np.sqrt(self.v[k]) + np.float32(1e-8))


# --- documents as streams -----------------------------------------------------------

def streams_of(sizes: np.ndarray, streams: int = STREAMS) -> list[list[int]]:
    """Documents dealt to streams of about equal length, long ones first."""
    heap = [(0, s) for s in range(min(streams, max(len(sizes), 1)))]
    out: list[list[int]] = [[] for _ in heap]
    for i in np.argsort(-sizes, kind="stable").tolist():
        length, s = heap[0]
        out[s].append(i)
        heapq.heapreplace(heap, (length + int(sizes[i]), s))
    return out


def laid_out(symbols: np.ndarray, sizes: np.ndarray, end: int, streams: int = STREAMS):
    """(inputs, targets, owners, starts) as (steps, streams) arrays; owner -1: nothing there.

    The input of a place is the symbol before its target, the end at a document's start."""
    at = np.cumsum(sizes) - sizes
    # no more streams than the longest document lets fill: the rest would be empty places
    streams = max(1, min(streams, int(sizes.sum()) // int(sizes.max())))
    order = streams_of(sizes, streams)
    steps = max(int(sizes[o].sum()) for o in order)
    shape = (len(order), steps)
    targets, inputs = np.zeros(shape, dtype=symbols.dtype), np.full(shape, end, dtype=symbols.dtype)
    owners, starts = np.full(shape, -1, dtype=np.int32), np.zeros(shape, dtype=bool)
    for s, own in enumerate(order):
        if not own:
            continue
        row = np.concatenate([symbols[at[i]:at[i] + sizes[i]] for i in own])
        first = np.cumsum(sizes[own]) - sizes[own]
        targets[s, :len(row)] = row
        inputs[s, 1:len(row)] = row[:-1]
        inputs[s, first] = end
        starts[s, first] = True
        owners[s, :len(row)] = np.repeat(own, sizes[own])
    return inputs.T, targets.T, owners.T, starts.T


def folded(symbols: np.ndarray, sizes: np.ndarray, end: int, streams: int = STREAMS):
    """(inputs, targets, starts) as (steps, streams) arrays: all documents end to end,
    folded into equal streams. A document that a fold cuts goes on with a new state."""
    inputs = np.append(symbols.dtype.type(end), symbols[:-1])
    starts = np.zeros(len(symbols), dtype=bool)
    first = np.cumsum(sizes) - sizes
    inputs[first], starts[first] = end, True
    streams = max(1, min(streams, len(symbols) // WINDOW))
    steps = -(-len(symbols) // streams)
    fill = streams * steps - len(symbols)  # the last stream is filled up from the beginning
    again = np.arange(fill) % len(symbols)
    return tuple(np.append(x, x[again]).reshape(streams, steps).T for x in (inputs, symbols, starts))


def train(net: Network, optimiser: Adam, symbols: np.ndarray, sizes: np.ndarray, end: int) -> None:
    """One pass over documents by backpropagation through ``WINDOW`` steps; the state
    is carried from window to window."""
    inputs, targets, starts = folded(symbols, sizes, end)
    state = np.zeros((inputs.shape[1], net.hidden), dtype=np.float32)
    for a in range(0, len(inputs), WINDOW):
        s = slice(a, a + WINDOW)
        kept: list = []
        h, state, x = net.states(inputs[s], starts[s], state, kept)
        grad = {k: np.zeros_like(v) for k, v in net.p.items()}
        net.log_probabilities(h.reshape(-1, net.hidden), targets[s].ravel(), grad)
        dh = grad.pop("h").reshape(h.shape)
        net.backward(inputs[s], starts[s], kept, x, dh, grad)
        scale = np.float32(1 / targets[s].size ** 0.5)
        optimiser.ascend({k: g * scale for k, g in grad.items()})


def score(net: Network, symbols: np.ndarray, sizes: np.ndarray, end: int) -> np.ndarray:
    """log10 probability of each document's symbols, complete."""
    out = np.zeros(len(sizes))
    inputs, targets, owners, starts = laid_out(symbols, sizes, end)
    width = (owners >= 0).any(axis=0)
    inputs, targets, owners, starts = (x[:, width] for x in (inputs, targets, owners, starts))
    state = np.zeros((inputs.shape[1], net.hidden), dtype=np.float32)
    for a in range(0, len(inputs), WINDOW):
        s = slice(a, a + WINDOW)
        live = owners[s] >= 0
        busy = live.any(axis=0)
        h, now, _ = net.states(inputs[s][:, busy], starts[s][:, busy], state[busy])
        state[busy] = now
        live, own = live[:, busy], owners[s][:, busy]
        lp = net.log_probabilities(h[live], targets[s][:, busy][live])
        out += np.bincount(own[live], lp.astype(np.float64), minlength=len(out))
    return out / np.log(10)


# --- on Spark -----------------------------------------------------------------------

def _symbols(head: Head, numbers: np.ndarray) -> np.ndarray:
    return head.symbol_of[numbers]


def end_symbol(head: Head) -> int:
    return int(head.symbol_of[head.number.get(END, -1)])


def _chunks(texts: list) -> Iterator[list]:
    """Texts in runs of about ``LAYOUT_TOKENS`` tokens (judged by their characters)."""
    held, n = [], 0
    for t in texts:
        held.append(t)
        n += len(t or "") // 5 + 1
        if n > LAYOUT_TOKENS:
            yield held
            held, n = [], 0
    if held:
        yield held


def fit(training: DataFrame, head: Head, id_col: str = "doc_id", text_col: str = "text") -> Network:
    """The network after one pass of all training documents over all partitions."""
    spark = training.sparkSession
    net = Network(head)
    end = end_symbol(head)
    rows = training.select(F.col(text_col).cast("string").alias("text"), F.col(id_col).cast("string").alias("id"))
    known = spark.sparkContext.broadcast(head)
    share = WARM_UP_DOCS / max(training.count(), 1)
    draw = F.pmod(F.xxhash64(F.coalesce("id", F.lit("")), F.lit(11)), F.lit(1_000_000)) / 1_000_000

    def replica(start: np.ndarray):
        def run(batches):
            own = Network(known.value)
            own.load(start)
            optimiser = Adam(own, RATE)
            trained = 0
            for batch in batches:
                for texts in _chunks(batch.column(0).to_pylist()):
                    numbers, sizes, _ = known.value.encode(texts, collect=False)
                    train(own, optimiser, _symbols(known.value, numbers), sizes, end)
                    trained += len(numbers)
            if trained:
                values = own.flat().astype(np.float32)
                cuts = range(0, len(values), SLICE)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([TaskContext.get().partitionId()] * len(cuts), pa.int64()), pa.array(range(len(cuts)), pa.int64()),
                     pa.array([float(trained)] * len(cuts)), pa.array([values[a:a + SLICE].tobytes() for a in cuts], pa.binary())],
                    ["part", "slice", "weight", "values"])
        return run

    schema = "part long, slice long, weight double, values binary"
    # filtered in parallel; then a bounded sample, in a fixed order, for one task
    warm = (rows.where(draw < share).repartition(1).sortWithinPartitions("id", "text").select("text")
            .mapInArrow(replica(net.flat()), schema).collect())
    if warm:
        net.load(_joined(warm))
    averaged = written(rows.select("text").mapInArrow(replica(net.flat()), schema), "replicas")
    parts = averaged.agg(F.max("part")).first()[0]
    while parts is not None and parts > 0:  # FAIN_IN replicas at most meet in one group
        averaged = written(averaged.withColumn("part", F.floor(F.col("part") / FAN_IN))
                           .groupBy("part", "slice").applyInPandas(_average, schema), "replicas")
        parts = parts // FAN_IN
    last = averaged.collect()  # one model
    if last:
        net.load(_joined(last))
    return net


def _average(rows: pd.DataFrame) -> pd.DataFrame:
    w = rows["weight"].to_numpy()
    values = np.stack([np.frombuffer(v, dtype=np.float32) for v in rows["values"]])
    mean = (values * (w / w.sum())[:, None]).sum(axis=0).astype(np.float32)
    return pd.DataFrame({"part": [rows["part"].iloc[0]], "slice": [rows["slice"].iloc[0]], "weight": [w.sum()],
                         "values": [mean.tobytes()]})


def _joined(rows: list) -> np.ndarray:
    return np.frombuffer(b"".join(bytes(r["values"]) for r in sorted(rows, key=lambda r: r["slice"])), dtype=np.float32)


def score_documents(docs: DataFrame, training: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``
    for every row of ``docs``, learned from the rows of ``training``.

    Null, empty and blank texts are the end token alone; repeated rows each get a
    row; a null id stays null; without training rows every word is unknown; an
    empty ``docs`` gives no rows; further columns are ignored."""
    spark = docs.sparkSession
    counts = written(count_words(training, text_col), "word-counts")
    head = head_of(counts)
    net = fit(training, head, id_col, text_col)
    end = end_symbol(head)
    known, model = spark.sparkContext.broadcast(head), spark.sparkContext.broadcast(net)  # HEAD words; VOCABULARY rows

    def run(batches):
        head, part, row = known.value, TaskContext.get().partitionId(), 0
        for batch in batches:
            ids = batch.column(0).to_pylist()
            texts = batch.column(1).to_pylist()
            at = 0
            for some in _chunks(texts):
                numbers, sizes, outside = head.encode(some)
                owner = np.repeat(np.arange(len(some)), sizes)
                inside = numbers >= 0
                base = np.bincount(owner[inside], head.base[numbers[inside]], minlength=len(some)).astype(np.float64)
                rare = numbers >= head.size
                lp = score(model.value, _symbols(head, numbers), sizes, end)
                lp += np.bincount(owner[rare], head.within[numbers[rare]], minlength=len(some))
                keys = (part << 33) + np.arange(row, row + len(some))
                row += len(some)
                flat = [w for c in outside for w in c]
                offsets = np.cumsum([0, *(len(c) for c in outside)]).astype(np.int32)
                words = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.binary()))
                times = pa.ListArray.from_arrays(pa.array(offsets), pa.array([n for c in outside for n in c.values()], pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), pa.array(ids[at:at + len(some)], batch.column(0).type),
                     pa.array(sizes, pa.int64()), pa.array(np.bincount(owner[inside], minlength=len(some)), pa.int64()),
                     pa.array(base), pa.array(lp), words, times],
                    ["key", "doc_id", "n_tokens", "head_known", "head_base", "head_score", "words", "times"])
                at += len(some)

    kind = docs.schema[id_col].dataType.simpleString()
    scored = written(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"key long, doc_id {kind}, n_tokens long, head_known long, head_base double, head_score double, "
             "words array<binary>, times array<long>"), "scored")
    tail = scored.select("key", F.explode(F.arrays_zip("words", "times")).alias("t")).select(
        "key", F.col("t.words").alias("word"), F.col("t.times").alias("times"))
    found = tail.join(counts, "word", "left").withColumn("c", F.coalesce("n", F.lit(0)))
    base_total, tail_total = head.total + head.types + 1, head.last_total
    sums = found.groupBy("key").agg(
        F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("tail_known"),
        F.sum(F.col("times") * F.log10((F.col("c") + 1) / F.lit(float(base_total)))).alias("tail_base"),
        F.sum(F.col("times") * F.log10((F.col("c") + 1) / F.lit(float(tail_total)))).alias("tail_score"))
    zero = F.lit(0.0)
    return (scored.drop("words", "times").join(sums, "key", "left").select(
        "doc_id", "n_tokens", (F.col("head_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        F.lit(head.total).cast("long").alias("train_tokens"),
        (F.col("head_base") + F.coalesce("tail_base", zero)).alias("base_score"),
        (F.col("head_score") + F.coalesce("tail_score", zero)).alias("score")))
