"""Quality rules: gradient-boosted trees over statistics of each document.

Statistics come from one pass over the whole text in numpy-backed tasks. The
trees are fitted on a bounded sample of labelled documents (``sample_rows``,
chosen by a hash of the id), as histograms over quantile bins, with monotonic
constraints: on a constrained statistic a split is only allowed if its leaves
keep the order, and a split's middle value bounds all leaves below it. The
fitted trees are flattened into node arrays, and a batch of documents walks all
of them by array indexing.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 20_000
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
THRESHOLD = 0.5

#: Statistic -> +1 (quality may only rise with it), -1 (only fall), 0 (free).
STATISTICS = {
    "n_words": 0, "mean_word_chars": 0, "symbol_share": -1, "dup_line_share": -1, "repeat_word_share": -1,
    "distinct_word_share": 0, "digit_share": -1, "upper_share": 0, "punctuation_share": 0, "letter_word_share": 1,
    "lines": 0, "mean_line_words": 0, "ended_line_share": 1, "short_word_share": 0, "top_word_share": -1,
    "top_char_share": -1,
}
_SYMBOLS = b"#*$%&|<>"
_OTHER_MARKS = b"!\"'()+,-./:;=?@[\\]^_`{}~"
_WORD_LETTER = re.compile(r"[^\W\d_]")
_POWERS = np.array([pow(0x9E3779B97F4A7C15, i + 1, 1 << 64) for i in range(WINDOW)], dtype=np.uint64)


def repeated_words(ws: list) -> int:
    """Words in ``WINDOW``-word windows that occur twice or more, the first included.

    Windows are compared by 64-bit polynomials of the words' 64-bit hashes, and
    equal ones once more word by word."""
    n = len(ws) - WINDOW + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, ws), dtype=np.int64, count=len(ws)).view(np.uint64)
    w = np.zeros(n, dtype=np.uint64)
    for i in range(WINDOW):
        w += h[i:i + n] * _POWERS[i]
    order = np.argsort(w, kind="stable")
    same = w[order[1:]] == w[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(n, dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    seen: dict = {}
    for i in np.flatnonzero(twice).tolist():
        seen.setdefault(tuple(ws[i:i + WINDOW]), []).append(i)
    edge = np.zeros(len(ws) + 1, dtype=np.int64)
    for at in seen.values():
        if len(at) > 1:
            np.add.at(edge, at, 1)
            np.add.at(edge, np.array(at) + WINDOW, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """The exact counts (n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)
    and the values of ``STATISTICS``, in order. A null text counts as empty."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    ws = raw.split()
    n = len(ws)
    spaces = sum(map(raw.count, (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")))
    word_chars = len(text) - spaces
    counts = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256) if raw else np.zeros(256, dtype=np.int64)
    n_symbols = int(counts[list(_SYMBOLS)].sum())
    seen, n_dup, lines, ended = set(), 0, 0, 0
    for line in raw.split(b"\n"):
        if not line or line.isspace():
            continue
        lines += 1
        ended += line.rstrip()[-1:] in b".!?\"'"
        if line in seen:
            n_dup += 1
        else:
            seen.add(line)
    n_repeat = repeated_words(ws)
    exact = [n, word_chars, n_symbols, n_dup, n_repeat]
    if not n:
        return exact, [0.0] * len(STATISTICS)
    often: dict = {}
    for w in ws:
        often[w] = often.get(w, 0) + 1
    chars, no_space = max(word_chars, 1), counts.copy()
    no_space[[9, 10, 11, 12, 13, 32]] = 0
    values = [n, word_chars / n, n_symbols / chars, n_dup / lines, n_repeat / n, len(often) / n,
              counts[48:58].sum() / chars, counts[65:91].sum() / chars, counts[list(_OTHER_MARKS)].sum() / chars,
              sum(c for w, c in often.items() if w.isalpha() or _WORD_LETTER.search(w.decode("utf-8", "replace"))) / n,
              lines, n / lines, ended / lines, sum(c for w, c in often.items() if len(w) <= 3) / n,
              max(often.values()) / n, no_space.max() / max(len(raw) - spaces, 1)]
    return exact, [float(x) for x in values]


def base_fails(n_words: int, n_repeat_words: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words


# --- boosted trees ------------------------------------------------------------------

@dataclass
class Trees:
    """Flat node arrays of all trees: a node with feature -1 is a leaf and leads to itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    prior: float

    def probability(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.prior)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                f = self.feature[node]
                go_left = x[rows, np.maximum(f, 0)] <= self.threshold[node]
                node = np.where(f < 0, node, np.where(go_left, self.left[node], self.right[node]))
            total += self.value[node]
        return 1 / (1 + np.exp(-total))


def fit_trees(x: np.ndarray, y: np.ndarray, monotone: list[int], rounds: int = 80, depth: int = 3,
              rate: float = 0.15, bins: int = 64, min_rows: int = 20, ridge: float = 1.0) -> Trees:
    """Logistic boosting over quantile bins under monotonic constraints. Without
    rows of both classes the trees are empty and the prior decides."""
    prior = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    nodes: list[list] = []
    roots = []
    if len(y) >= 2 * min_rows and 0 < y.sum() < len(y):
        cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T)], axis=1)
        total = np.full(len(y), prior)
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-total))
            g, h = y - p, p * (1 - p)

            def leaf(rows, lo, hi):
                return float(np.clip(g[rows].sum() / (h[rows].sum() + ridge), lo, hi))

            def grow(rows, level, lo, hi):
                me = len(nodes)
                nodes.append([-1, 0.0, me, me, 0.0])
                best = (1e-6, None)
                if level < depth and len(rows) >= 2 * min_rows:
                    gs, hs = g[rows].sum(), h[rows].sum()
                    for f, sign in enumerate(monotone):
                        if not len(cuts[f]):
                            continue
                        k = len(cuts[f]) + 1
                        b = binned[rows, f]
                        gl, hl, nl = (np.cumsum(np.bincount(b, w, minlength=k))[:-1] for w in (g[rows], h[rows], None))
                        vl = np.clip(gl / (hl + ridge), lo, hi)
                        vr = np.clip((gs - gl) / (hs - hl + ridge), lo, hi)
                        gain = (2 * vl * gl - vl ** 2 * (hl + ridge) + 2 * vr * (gs - gl) - vr ** 2 * (hs - hl + ridge))
                        bad = (nl < min_rows) | (len(rows) - nl < min_rows) | ((vr - vl) * sign < 0)
                        gain = np.where(bad, -np.inf, gain) - gs ** 2 / (hs + ridge)
                        i = int(gain.argmax())
                        if gain[i] > best[0]:
                            best = (gain[i], (f, i, (vl[i] + vr[i]) / 2 if sign else None))
                if best[1] is None:
                    value = rate * leaf(rows, lo, hi)
                    nodes[me][4] = value
                    total[rows] += value
                    return me
                f, i, middle = best[1]
                goes = binned[rows, f] <= i
                bounds = [(lo, hi), (lo, hi)]
                if middle is not None:
                    bounds = [(lo, middle), (middle, hi)] if monotone[f] > 0 else [(middle, hi), (lo, middle)]
                left = grow(rows[goes], level + 1, *bounds[0])
                right = grow(rows[~goes], level + 1, *bounds[1])
                nodes[me][:4] = [f, float(cuts[f][i]), left, right]
                return me

            roots.append(grow(np.arange(len(y)), 0, -np.inf, np.inf))
    flat = list(zip(*nodes)) if nodes else [(), (), (), (), ()]
    return Trees(*(np.array(c, dtype=t) for c, t in zip(flat, ("i8", "f8", "i8", "i8", "f8"))),
                 np.array(roots, dtype="i8"), depth, prior)


# --- on Spark -----------------------------------------------------------------------

def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "quality") -> Trees:
    """Trees from about ``sample_rows`` labelled documents (all, if there are fewer).

    Rows with a null id or label are left out; a repeated id takes its smallest label."""
    known = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).alias("__id")).agg(F.min(label_col).cast("int").alias("__y")))
    share = sample_rows / max(known.count(), 1)
    draw = F.pmod(F.xxhash64(F.col("__id").cast("string"), F.lit(23)), F.lit(1_000_000)) / 1_000_000
    known = known.where(draw < share)

    def run(batches):
        for batch in batches:
            values = [statistics(t)[1] for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(values, pa.list_(pa.float64()))],
                                             ["id", "y", "x"])

    # the labels' side is bounded by sample_rows
    sample = (docs.join(F.broadcast(known), F.col(id_col) == F.col("__id"))
              .select(F.col("__id").cast("string").alias("id"), F.col("__y").alias("y"),
                      F.col(text_col).cast("string").alias("text"))
              .mapInArrow(run, "id string, y int, x array<double>")
              .orderBy("id", "x").toPandas())
    x = np.array(sample["x"].tolist(), dtype=np.float64).reshape(-1, len(STATISTICS))
    return fit_trees(x, sample["y"].to_numpy(dtype=np.float64), list(STATISTICS.values()))


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judge(docs: DataFrame, model: Trees, threshold: float = THRESHOLD, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """``doc_id``, the counts, ``base_failed``, ``quality_score`` and ``kept`` for every row.

    A null text counts as empty, and fails the base rule; repeated rows each get
    a row; an empty table gives no rows; further columns are ignored."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # a few hundred nodes

    def run(batches):
        for batch in batches:
            found = [statistics(t) for t in batch.column(1).to_pylist()]
            exact = np.array([e for e, _ in found], dtype=np.int64).reshape(-1, len(COUNTS))
            failed, p = verdicts(found, shipped.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c) for c in exact.T), pa.array(failed), pa.array(p),
                 pa.array(~failed & (p >= threshold))],
                ["doc_id", *COUNTS, "base_failed", "quality_score", "kept"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in COUNTS)
                        + ", base_failed boolean, quality_score double, kept boolean"))


def verdicts(found: list, model: Trees) -> tuple[np.ndarray, np.ndarray]:
    failed = np.array([base_fails(e[0], e[4]) for e, _ in found], dtype=bool)
    x = np.array([v for _, v in found], dtype=np.float64).reshape(-1, len(STATISTICS))
    return failed, model.probability(x)


def keep_good(docs: DataFrame, model: Trees, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that pass the base rule and the trees."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("boolean")
    def good(texts: pa.Array) -> pa.Array:
        failed, p = verdicts([statistics(t) for t in texts.to_pylist()], shipped.value)
        return pa.array(~failed & (p >= threshold))

    return docs.where(good(F.col(text_col).cast("string")))
