"""Language identification by bit-sliced Bloom filters of character n-grams.

One filter serves all languages: a slot holds a bitmask with one bit for each
language, and an n-gram's languages are the bitwise AND of its slots. A text's
n-grams are looked up together; for each language the hits are counted,
corrected for the hits that its filter's fill would give by chance, and the
language with the largest corrected share decides.

Fitting counts n-grams by Spark over a bounded sample of labelled documents
(``sample_docs`` a language, chosen by a hash of the id); an n-gram enters a
language's filter if enough of its documents hold it, in proportion to the
language that holds it most. The filter has a fixed number of slots, so what is
collected and broadcast is bounded whatever the corpus size.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GRAM = 3
SLOTS_LOG2 = 18
PROBES = 2
SAMPLE_DOCS = 4000
MIN_SHARE = 0.02
MIN_RELATIVE = 0.35
UNDETERMINED = "und"
#: Languages that a model can tell apart; a slot has a mask word for each 64 of them.
MAX_LANGUAGES = 1024
#: Code points that are turned into n-grams at once.
BLOCK = 1_000_000

_LETTER = regex.compile(r"\p{L}")
_folds: list[np.ndarray] = []


def _fold() -> np.ndarray:
    """Code point -> lower-cased letter, or a space for anything but a letter."""
    if not _folds:
        table = np.full(0x110000, 32, dtype=np.uint32)
        for i in range(0x110000):
            c = chr(i)
            if c.isalpha():
                low = c.lower()
                table[i] = ord(low) if len(low) == 1 else i
        _folds.append(table)
    return _folds[0]


def gram_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the character n-grams of all texts, and the text of each.

    Texts are lower-cased; what is no letter counts as a space, and n-grams with
    more than one space are left out."""
    pad = " " * GRAM
    joined = pad + pad.join(texts) + pad
    points = _fold()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
    sizes = np.array([len(t) + GRAM for t in texts])
    owner = np.repeat(np.arange(len(texts)), sizes)
    n = len(owner)
    letter = points != 32
    letters = np.zeros(n, dtype=np.int8)
    h = np.zeros(n, dtype=np.uint64)
    for i in range(GRAM):
        s = slice(1 + i, 1 + i + n)  # from one place after the text before
        letters += letter[s]
        h = (h ^ points[s]) * np.uint64(0x9E3779B97F4A7C15)
    keep = np.flatnonzero(letters >= GRAM - 1)
    h = h[keep]
    h ^= h >> np.uint64(29)
    return h * np.uint64(0xBF58476D1CE4E5B9), owner[keep]


def slots_of(h: np.ndarray, probe: int) -> np.ndarray:
    """The slot of each hash for one probe: its own bits of the hash."""
    return ((h >> np.uint64(64 - SLOTS_LOG2 * (probe + 1))) & np.uint64((1 << SLOTS_LOG2) - 1)).astype(np.int64)


@dataclass
class Model:
    """``masks[i // 64, slot]`` has bit i % 64 set if the slot belongs to ``languages[i]``'s filter."""

    languages: list[str]
    masks: np.ndarray

    def __post_init__(self):
        self.masks = np.atleast_2d(self.masks)
        bits = [(self.masks[i // 64] >> np.uint64(i % 64)) & np.uint64(1) for i in range(len(self.languages))]
        #: the chance that an n-gram outside a filter is found in it
        self.by_chance = np.array([float(b.mean()) ** PROBES for b in bits])

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score (0 to 1) of each text; ``und`` and 0 without a letter."""
        langs, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        known = [i for i, t in enumerate(texts) if t and _LETTER.search(t)]
        at = 0
        while at < len(known) and self.languages:
            end, n = at, 0
            while end < len(known) and (end == at or n < BLOCK):
                n += len(texts[known[end]])
                end += 1
            share = self._shares([texts[i] for i in known[at:end]])
            best = share.argmax(axis=1)
            for i, b, s in zip(known[at:end], best, share.max(axis=1)):
                langs[i], scores[i] = self.languages[b], s
            at = end
        return langs, scores

    def _shares(self, texts: list[str]) -> np.ndarray:
        h, owner = gram_hashes(texts)
        slots = [slots_of(h, probe) for probe in range(PROBES)]
        n = np.maximum(np.bincount(owner, minlength=len(texts)), 1)
        share = np.empty((len(texts), len(self.languages)))
        for i in range(len(self.languages)):
            if i % 64 == 0:
                found = self.masks[i // 64][slots[0]]
                for other in slots[1:]:
                    found &= self.masks[i // 64][other]
            hits = np.bincount(owner[(found & np.uint64(1 << i % 64)) != 0], minlength=len(texts))
            share[:, i] = (hits / n - self.by_chance[i]) / max(1 - self.by_chance[i], 1e-9)
        return np.clip(share, 0, 1)


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, min_share: float = MIN_SHARE,
        min_relative: float = MIN_RELATIVE, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang") -> Model:
    """A model from the rows with a text and a label: about ``sample_docs`` documents a
    language (all, if it has fewer), chosen by a hash of the id. Languages are
    numbered by name; more than ``MAX_LANGUAGES`` labels are an error. Rows of a null id
    are drawn by their text."""
    labelled = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(
        F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n"))
             .orderBy("lang").limit(MAX_LANGUAGES + 1).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((0, 1 << SLOTS_LOG2), dtype=np.uint64))
    number = {x: i for i, x in enumerate(languages)}
    share = F.element_at(F.create_map(*[v for x in languages for v in (F.lit(x), F.lit(sample_docs / sizes[x]))]), F.col("lang"))
    by_text = F.when(F.col("id").isNull(), F.col("text"))  # a null adds nothing to the hash
    draw = F.pmod(F.xxhash64(F.coalesce("id", F.lit("")), by_text, F.lit(17)), F.lit(1_000_000)) / 1_000_000
    sample = labelled.where(draw < share).select("text", "lang")

    def count(batches):
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at in range(0, len(texts), 500):
                own = np.array([number[x] for x in langs[at:at + 500]])
                h, owner = gram_hashes(texts[at:at + 500])
                order = np.lexsort((owner, h))
                h, owner = h[order], owner[order]
                new = np.append(True, (h[1:] != h[:-1]) | (owner[1:] != owner[:-1]))[:len(h)]
                grams, inverse = np.unique(h[new], return_inverse=True)
                docs_with = np.bincount(inverse * len(languages) + own[owner[new]],
                                        minlength=len(grams) * len(languages)).reshape(-1, len(languages))
                i, j = np.nonzero(docs_with)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grams[i].view(np.int64)), pa.array(j.astype(np.int64)), pa.array(docs_with[i, j])],
                    ["gram", "language", "docs"])

    counted = (sample.mapInArrow(count, "gram long, language long, docs long")
               .groupBy("gram", "language").agg(F.sum("docs").alias("docs")))
    held = F.col("docs") / F.element_at(
        F.create_map(*[v for x, i in number.items() for v in (F.lit(i).cast("long"), F.lit(float(min(sizes[x], sample_docs))))]),
        F.col("language"))
    by_gram = counted.withColumn("held", held).groupBy("gram").agg(
        F.max("held").alias("most"), F.collect_list(F.struct("language", "held")).alias("by"))  # a language each
    own = F.filter("by", lambda x: (x["held"] >= min_share) & (x["held"] >= min_relative * F.col("most")))
    word = F.explode(F.sequence(F.lit(0), F.lit((len(languages) - 1) // 64))).alias("word")
    in_word = F.filter(own, lambda x: F.floor(x["language"] / 64) == F.col("word"))
    mask = F.aggregate(in_word, F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(
        F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(x["language"], F.lit(64)).cast("int"))))
    slots = F.array(*[F.shiftrightunsigned("gram", 64 - SLOTS_LOG2 * (p + 1)).bitwiseAND(
        F.lit((1 << SLOTS_LOG2) - 1).cast("long")) for p in range(PROBES)])
    filled = (by_gram.select("*", word).select("word", mask.alias("mask"), slots.alias("slots")).where("mask <> 0")
              .select("word", "mask", F.explode("slots").alias("slot"))
              .groupBy("word", "slot").agg(F.bit_or("mask").alias("mask")).toPandas())  # at most 2^SLOTS_LOG2 rows a word
    masks = np.zeros(((len(languages) + 63) // 64, 1 << SLOTS_LOG2), dtype=np.uint64)
    masks[filled["word"].to_numpy(dtype=np.int64), filled["slot"].to_numpy(dtype=np.int64)] = filled["mask"].to_numpy(dtype=np.int64).view(np.uint64)
    return Model(languages, masks)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` for every row, from its text alone.

    A null text, or one without a letter, is ``und`` with score 0; with equal
    scores the first language by name wins; repeated rows each get a row; an
    empty table gives no rows; further columns are ignored."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # 2^SLOTS_LOG2 longs

    def run(batches):
        for batch in batches:
            langs, scores = shipped.value.predict(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             ["doc_id", "lang_pred", "score"])

    return (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, lang_pred string, score double"))


def keep_identified(docs: DataFrame, model: Model, min_score: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose language is determined with at least
    ``min_score``; null and letterless texts go."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("boolean")
    def identified(texts: pa.Array) -> pa.Array:
        langs, scores = shipped.value.predict(texts.to_pylist())
        return pa.array([x != UNDETERMINED and s >= min_score for x, s in zip(langs, scores)], pa.bool_())

    return docs.where(identified(F.col(text_col).cast("string")))
