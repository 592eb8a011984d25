"""SimHash near-duplicates: a binary-trie self-join within a Hamming budget.

1. Each text gets a 64-bit fingerprint from its word shingles.
2. Two fingerprints within ``bits`` differing bits agree on at least ``AGREE`` of
   ``BLOCKS`` bit blocks, so for every choice of ``AGREE`` blocks the distinct
   fingerprints that share those blocks form one binary trie over the other
   bits. The tries are spread over the cluster; a very large one is split into
   chunks and its pairs of chunks are joined apart.
3. Inside a task, node pairs are traversed together, level by level in numpy:
   differing bits accumulate, and a pair whose error exceeds the budget is
   dropped with everything below it. Pairs that are connected already are not
   opened again, so a dense group costs no quadratic output: a task returns a
   spanning star for each connected set, which keeps every connection.
4. Components are found by contraction: each fingerprint moves to its smallest
   neighbour, edges are relabelled, and the rounds end when no edge is left.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginflow.llm.common import join_hot, written

BLOCKS = (11, 11, 11, 11, 10, 10)
SEED = 42
#: Fingerprints of one trie that a task joins at once; more are joined chunk by chunk.
CHUNK = 8192
#: Node pairs that a task opens at once.
FRONTIER = 100_000
#: Shingle hashes that are folded into bit counts at once.
FOLD = 250_000

_LANES = np.uint64(0x0101010101010101)


# --- fingerprints -------------------------------------------------------------------

def shingle_hashes(text: str | None, size: int, seed: int = SEED) -> np.ndarray:
    """XXH64 of each word shingle of the A-Z lower-cased text, repeats included."""
    ws = (text or "").encode().lower().split()
    joined = b" ".join(ws)
    if len(ws) <= size:
        return np.array([xxhash.xxh64_intdigest(joined, seed)] if ws else [], dtype=np.uint64)
    ends = np.cumsum([len(w) + 1 for w in ws]) - 1
    starts = [0, *(ends[:-size] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], seed) for a, b in zip(starts, ends[size - 1:].tolist())],
                    dtype=np.uint64)


def majority_bits(hashes: list[np.ndarray]) -> np.ndarray:
    """For each array, the bits that are set in over half of its hashes (none: 0).

    Bits are counted eight to a word: one masked shift holds eight byte-wide
    counters, which are summed over at most 255 hashes before they could overflow."""
    sizes = np.array([len(h) for h in hashes])
    out = np.zeros(len(hashes), dtype=np.uint64)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    h = np.concatenate([hashes[i] for i in full])
    firsts = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
    blocks = [np.arange(a, a + n, 255) for a, n in zip(firsts, sizes[full])]
    cuts, per_doc = np.concatenate(blocks), np.cumsum([0, *(len(b) for b in blocks)])[:-1]
    for j in range(8):
        lanes = np.add.reduceat((h >> np.uint64(j)) & _LANES, cuts)
        counts = np.add.reduceat(lanes.astype("<u8").view(np.uint8).reshape(-1, 8).astype(np.int64),
                                 per_doc, axis=0)
        bits = (2 * counts > sizes[full][:, None]).astype(np.uint64)
        out[full] |= np.bitwise_or.reduce(bits << np.arange(j, 64, 8, dtype=np.uint64), axis=1)
    return out


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id``, ``text_hash`` and the fingerprint ``fp`` (its 64 bits as a long) per row."""
    def run(batches):
        for batch in batches:
            texts, done, waiting, n = batch.column(2), [], [], 0
            for t in texts:
                waiting.append(shingle_hashes(t.as_py(), shingle))
                n += len(waiting[-1])
                if n > FOLD:
                    done.append(majority_bits(waiting))
                    waiting, n = [], 0
            done.append(majority_bits(waiting))
            fp = np.concatenate(done).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fp)],
                                             ["doc_id", "text_hash", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"),
                        F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, f"doc_id {kind}, text_hash long, fp long"))


# --- the trie self-join -------------------------------------------------------------

def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int64)


class _Sets:
    """Connected sets of the positions 0..n-1, as the smallest position of each."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self.run_end: np.ndarray | None = None

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        label = self.label
        while True:
            la, lb = label[a], label[b]
            apart = la != lb
            if not apart.any():
                break
            a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
            np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
            while True:
                up = label[label]
                if (up == label).all():
                    break
                label[:] = up
        self.run_end = None

    def ends(self) -> np.ndarray:
        """For each position, where the run of equal labels from it ends."""
        if self.run_end is None:
            last = np.flatnonzero(np.append(self.label[1:] != self.label[:-1], True)) + 1
            self.run_end = np.repeat(last, np.diff(last, prepend=0))
        return self.run_end


def trie_links(v: np.ndarray, key_bits: int, bits: int) -> np.ndarray:
    """Connected sets of the sorted, distinct 64-bit values ``v``, as the position
    of each set's first value. Values link if their first ``key_bits`` bits agree
    and at most ``bits`` bits differ."""
    n = len(v)
    sets = _Sets(n)
    if n < 2:
        return sets.label
    key = v >> np.uint64(64 - key_bits) if key_bits else np.zeros(n, dtype=np.uint64)
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    last = np.append(first[1:], n)
    many = last - first > 1
    first, last = first[many], last[many]
    stack = [(key_bits, first, last, first, last, np.zeros(len(first), dtype=np.int64))]
    while stack:
        depth, a0, a1, b0, b1, err = stack.pop()
        end = sets.ends()  # both nodes inside one connected set: nothing to add
        open_ = ~((sets.label[a0] == sets.label[b0]) & (end[a0] >= a1) & (end[b0] >= b1))
        a0, a1, b0, b1, err = (x[open_] for x in (a0, a1, b0, b1, err))
        alone = (a1 - a0 == 1) & (b1 - b0 == 1)
        near = alone & (a0 != b0)
        near[near] = _popcount(v[a0[near]] ^ v[b0[near]]) <= bits
        found_a, found_b = [a0[near]], [b0[near]]
        rest = ~alone
        whole = rest & (err + (64 - depth) <= bits)  # whatever the bits below are, all link
        for lo, hi, to in zip(np.append(a0[whole], b0[whole]), np.append(a1[whole], b1[whole]),
                              np.append(a0[whole], a0[whole])):
            found_a.append(np.full(hi - lo, to))
            found_b.append(np.arange(lo, hi))
        a, b = np.concatenate(found_a), np.concatenate(found_b)
        if len(a):
            sets.join(a, b)
        rest &= ~whole
        a0, a1, b0, b1, err = (x[rest] for x in (a0, a1, b0, b1, err))
        if not len(a0):
            continue
        bit = np.uint64(63 - depth)
        one = np.uint64(1) << bit

        def middle(lo, hi):  # where the values with this bit set begin
            split = ((v[lo] >> bit) | np.uint64(1)) << bit
            return np.clip(np.searchsorted(v, split), lo, hi)

        am, bm, same = middle(a0, a1), middle(b0, b1), (a0 == b0) & (a1 == b1)
        children = [(a0, am, b0, bm, err, None), (am, a1, bm, b1, err, None),
                    (a0, am, bm, b1, err + 1, None), (am, a1, b0, bm, err + 1, ~same)]
        parts = []
        for x0, x1, y0, y1, e, only in children:
            keep = (x1 > x0) & (y1 > y0) & (e <= bits) & ~((x0 == y0) & (x1 - x0 == 1))
            if only is not None:
                keep &= only
            parts.append([x[keep] for x in (x0, x1, y0, y1, e)])
        a0, a1, b0, b1, err = (np.concatenate(x) for x in zip(*parts))
        for at in range(0, len(a0), FRONTIER):
            s = slice(at, at + FRONTIER)
            stack.append((depth + 1, a0[s], a1[s], b0[s], b1[s], err[s]))
        del one
    return sets.label


def _layouts(bits: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """For each choice of blocks that must agree: the key's bits, and the (shift,
    width) of all blocks with the chosen ones first."""
    agree = len(BLOCKS) - bits
    if agree < 1:
        raise ValueError(f"at most {len(BLOCKS) - 1} differing bits are supported")
    shifts = [64 - sum(BLOCKS[:i + 1]) for i in range(len(BLOCKS))]
    out = []
    for chosen in itertools.combinations(range(len(BLOCKS)), agree):
        order = [*chosen, *(i for i in range(len(BLOCKS)) if i not in chosen)]
        out.append((sum(BLOCKS[i] for i in chosen), [(shifts[i], BLOCKS[i]) for i in order]))
    return out


def _arranged(fp, blocks):
    """The fingerprint with its blocks in another order, JVM-side."""
    out, at = F.lit(0).cast("long"), 64
    for shift, width in blocks:
        at -= width
        part = F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
        out = out.bitwiseOR(F.shiftleft(part, at))
    return out


def near_links(distinct: DataFrame, bits: int = 4, chunk: int = CHUNK) -> DataFrame:
    """Edges (a, b) between the fingerprints of column ``fp`` (each once) that connect
    exactly what a link of at most ``bits`` differing bits connects."""
    layouts = _layouts(bits)
    rows = distinct.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("layout"), _arranged(F.col("fp"), blocks).alias("value"))
        for i, (_, blocks) in enumerate(layouts)])).alias("t")).select("fp", "t.*")
    key = F.lit(None).cast("long")
    for i, (width, _) in enumerate(layouts):
        key = F.when(F.col("layout") == i, F.shiftrightunsigned("value", 64 - width)).otherwise(key)
    rows = rows.withColumn("key", key)
    # tries beyond one chunk: each row goes to every pair of chunks that its own takes part in
    large = (rows.groupBy("layout", "key").count().where(F.col("count") > chunk)
             .select("layout", "key", F.ceil(F.col("count") / chunk).cast("int").alias("chunks")))
    rows = rows.join(large, ["layout", "key"], "left")
    own = F.pmod(F.xxhash64("fp"), F.coalesce("chunks", F.lit(1))).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.coalesce("chunks", F.lit(1)) - 1),
                        lambda x: F.least(x, own) * F.coalesce("chunks", F.lit(1)) + F.greatest(x, own))
    rows = rows.select("fp", "layout", "value", "key", F.explode(pairs).alias("pair"))

    def run(batches) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in itertools.chain(batches, [None]):
            # tries are whole between two batches' ends only if the sort key changes there
            if batch is not None:
                if batch.num_rows:
                    held.append(np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]))
                if sum(x.shape[1] for x in held) < 4 * FRONTIER:
                    continue
            if not held:
                continue
            rows_ = np.concatenate(held, axis=1)
            cut = rows_.shape[1]
            if batch is not None:
                group = rows_[1:4]
                change = np.flatnonzero((group[:, 1:] != group[:, :-1]).any(axis=0)) + 1
                cut = change[-1] if len(change) else 0
            held = [rows_[:, cut:]]
            fp, layout, _, pair, value = rows_[:, :cut]
            for lay, pr in sorted(set(zip(layout.tolist(), pair.tolist()))):
                mine = np.flatnonzero((layout == lay) & (pair == pr))
                v = value[mine].view(np.uint64)
                order = np.argsort(v)
                label = trie_links(v[order], layouts[lay][0], bits)
                linked = np.flatnonzero(label != np.arange(len(label)))
                if len(linked):
                    f = fp[mine][order]
                    yield pa.RecordBatch.from_arrays([pa.array(f[linked]), pa.array(f[label[linked]])], ["a", "b"])

    columns = [F.col(c).cast("long").alias(c) for c in ("fp", "layout", "key", "pair", "value")]
    return (rows.select(*columns).repartition("layout", "key", "pair")
            .sortWithinPartitions("layout", "key", "pair")
            .mapInArrow(run, "a long, b long"))


def connected(edges: DataFrame) -> DataFrame:
    """(node, root): every node of the edges, with the smallest node of its component.

    Each round moves a node to the neighbour (or itself) of least hash, by a hash of that round's own, and
    relabels the edges; so the graph shrinks by a share of its nodes a round, chains in any order
    included, and the moves are composed from the last round back. Each round is a written table."""
    edges = written(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                    .where("a <> b").distinct(), "edges")
    moves = []
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        turn = F.lit(len(moves))
        move = written(both.groupBy("a").agg(F.min_by("b", F.xxhash64("b", turn)).alias("m"))
                       .select(F.col("a").alias("node"), F.when(F.xxhash64("m", turn) < F.xxhash64("a", turn), F.col("m"))
                               .otherwise(F.col("a")).alias("to")), "moves")
        moves.append(move)
        a = move.select(F.col("node").alias("a"), F.col("to").alias("ta"))
        b = move.select(F.col("node").alias("b"), F.col("to").alias("tb"))
        edges = written(edges.join(a, "a").join(b, "b").where("ta <> tb")
                        .select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct(), "edges")
    if not moves:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = moves[-1].select("node", F.col("to").alias("root"))
    for move in reversed(moves[:-1]):
        later = roots.select(F.col("node").alias("to"), F.col("root").alias("later"))
        roots = move.join(later, "to", "left").select("node", F.coalesce("later", "to").alias("root"))
    roots = written(roots, "roots")
    least = roots.groupBy("root").agg(F.min("node").alias("least"))
    return join_hot(roots, least, "root").select("node", F.col("least").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = 4, bits: int = 4, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``doc_id``, ``text_hash``, ``fp`` and ``component_id`` for every row of ``docs``.

    ``component_id`` is the smallest id that links of at most ``bits`` differing
    bits reach from the row (itself included). Null and blank texts have
    fingerprint 0 and link like any other; texts shorter than a shingle are one
    shingle; repeated rows each get a row; a null id is never the smallest unless
    its component has no other; an empty table gives no rows; further columns
    are ignored. Ids are of any type that can be ordered.
    """
    fps = written(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    least = written(fps.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "distinct-fingerprints")
    roots = written(connected(near_links(least.select("fp"), bits)), "roots")
    rooted = least.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    rooted = written(rooted, "rooted-fingerprints")
    smallest = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    component = written(join_hot(rooted, smallest, "root").select("fp", "component_id"), "components")
    return join_hot(fps, component, "fp")


def drop_near_duplicates(docs: DataFrame, shingle: int = 4, bits: int = 4, id_col: str = "doc_id",
                         text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each near-duplicate component: that of the smallest id
    (equal ids: of the smallest text hash). All columns of ``docs`` are kept."""
    found = near_duplicates(docs, shingle, bits, id_col, text_col)
    kept = (found.groupBy("fp", "component_id")  # pre-aggregated: few rows for each component
            .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("first"))
            .groupBy("component_id", F.when(F.col("component_id").isNull(), F.col("fp")).alias("fp"))
            .agg(F.min("first").alias("first"))
            .select(F.col("first.doc_id").alias("__kept_id"), F.col("first.text_hash").alias("__kept_hash")))
    text_hash = F.xxhash64(docs[text_col])
    return (docs.withColumn("__hash", text_hash)
            .join(kept, F.col(id_col).eqNullSafe(F.col("__kept_id"))
                  & (F.col("__hash") == F.col("__kept_hash")), "left_semi")
            .dropDuplicates([id_col, "__hash"]).drop("__hash").select(*docs.columns))
