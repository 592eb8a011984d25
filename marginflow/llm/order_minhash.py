"""Order MinHash fingerprints of documents, in DataFrame operations only.

A text's words give k-mers, each numbered by its occurrence. The hash of (k-mer,
occurrence) falls into one of ``BUCKETS`` equal ranges, and each range gives one
signature: its ``PICKS`` smallest hashes are selected, put back into text order,
and hashed as a tuple. Two texts agree in a signature only if they share the
minimal k-mers and have them in the same order, so the share of equal signatures
falls with the edit distance, where a plain MinHash would not see a change of
order. (One hash split into ranges stands in for one permutation a signature.)

A range of fewer hashes is filled up from those that follow it, the first after
the last: a signature is of the first ``PICKS`` from the start of its range, so
it holds that many whatever the text's length, or all that the text has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginflow.llm.common import let, words

K = 3
PICKS = 2
BUCKETS_LOG2 = 5
BUCKETS = 1 << BUCKETS_LOG2
#: What a signature of an empty range looks like in the fingerprint.
EMPTY = "-" * 8
#: Groups of neighbouring ids for each shuffle partition.
GROUPS_PER_PARTITION = 4


def kmer_hashes(ws: Column, k: int = K) -> Column:
    """Hashes of the k-word sequences, in text order; fewer words: of all words together."""
    return let(F.transform(ws, lambda w: F.xxhash64(w)), lambda h: F.when(
        F.size(h) >= k, F.transform(F.sequence(F.lit(0), F.size(h) - k),
                                    lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(k)]))
    ).when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>")))


def _numbered_by_sorting(kmers: Column) -> Column:
    """xxhash64(k-mer, occurrence) in text order: equal k-mers are brought together,
    numbered from where their run starts, and put back."""
    def runs(s):
        starts = F.filter(F.sequence(F.lit(0), F.size(s) - 1),
                          lambda j: (j == 0) | (F.get(s, j)["h"] != F.get(s, j - 1)["h"]))
        return let(starts, lambda st: F.flatten(F.transform(st, lambda a, r: F.transform(
            F.sequence(a, F.coalesce(F.get(st, r + 1), F.size(s)) - 1),
            lambda j: F.struct(F.get(s, j)["i"].alias("i"), F.xxhash64(F.get(s, j)["h"], j - a).alias("u"))))))

    placed = let(F.sort_array(F.transform(kmers, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), runs)
    return F.transform(F.sort_array(placed), lambda x: x["u"])


def numbered(kmers: Column) -> Column:
    """Hashes of (k-mer, occurrence number), in text order."""
    return let(kmers, lambda k: F.when(
        F.size(F.array_distinct(k)) == F.size(k), F.transform(k, lambda h: F.xxhash64(h, F.lit(0)))
    ).otherwise(_numbered_by_sorting(k)))


def _bucket(u: Column) -> Column:
    return F.shiftrightunsigned(u, 64 - BUCKETS_LOG2).cast("int")


def signatures(text: Column, k: int = K, picks: int = PICKS, fill: bool = False) -> Column:
    """``BUCKETS`` signatures of a text, as 8 hexadecimal digits each (see ``EMPTY``);
    with ``fill``, only a text without words has empty ones."""
    ranges = F.sequence(F.lit(0), F.lit(BUCKETS - 1))

    def chosen(us, then):  # then(the smallest of each range in ascending order, the same in text order)
        def by_range(s):
            small = F.filter(s, lambda x, j: (j < picks) | (_bucket(x) != _bucket(F.get(s, j - picks))))
            return let(small, lambda m: let(
                F.transform(ranges, lambda b: F.array_max(F.filter(m, lambda x: _bucket(x) == b))),
                lambda most: let(F.filter(us, lambda x: x <= F.get(most, _bucket(x))), lambda z: then(m, z))))
        return let(F.sort_array(us), by_range)

    def filled(m, z, b):  # the first from the start of range b, in text order; ascending starts with the upper half
        half = BUCKETS // 2
        place = F.when(b < half, b).otherwise(b - BUCKETS)
        before = F.size(F.filter(m, lambda x: F.shiftright(x, 64 - BUCKETS_LOG2) < place))
        return let(F.slice(F.concat(m, m), before + 1, picks),
                   lambda own: F.filter(z, lambda x: F.array_contains(own, x)))

    def tuples(m, z):
        def own(b):
            within = F.filter(z, lambda x: _bucket(x) == b)
            return within if not fill else let(within, lambda t: F.when(
                F.size(t) < F.least(F.lit(picks), F.size(z)), filled(m, z, b)).otherwise(t))
        return F.transform(ranges, lambda b: let(
            own(b), lambda t: F.when(F.size(t) == 0, F.lit(EMPTY)).otherwise(
                F.lower(F.substring(F.lpad(F.hex(F.xxhash64(t)), 16, "0"), 9, 8)))))

    return let(numbered(kmer_hashes(words(text), k)), lambda us: chosen(us, tuples))


def likeness(a: Column, b: Column) -> Column:
    """Equal signatures among those that either text has; 1 for two texts without words."""
    pairs = F.zip_with(a, b, lambda x, y: F.when((x != F.lit(EMPTY)) | (y != F.lit(EMPTY)), (x == y).cast("int")))
    return let(F.array_compact(pairs), lambda p: F.when(F.size(p) == 0, F.lit(1.0)).otherwise(
        F.aggregate(p, F.lit(0), lambda s, x: s + x) / F.size(p)))


def _group_of(key: Column, bounds: list[int]) -> Column:
    """How many of the sorted bounds are at most the key, by binary search."""
    if not bounds:
        return F.lit(0)
    sorted_bounds, step = F.lit(bounds).cast("array<bigint>"), 1
    while step * 2 <= len(bounds):
        step *= 2

    def search(at: Column, step: int) -> Column:
        if not step:
            return at
        return let(at + F.when(F.get(sorted_bounds, at + (step - 1)) <= key, step).otherwise(0),
                   lambda x: search(x, step // 2))
    return search(F.lit(0), step)


def next_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, sigs, next_text, next_sigs): each document with the one after it by
    ascending id, the last one with the first. Null texts count as empty.

    Ids are dealt into groups of neighbours by quantiles of the ids alone, so the
    texts are shuffled once; each group also gets a copy of the next group's first
    row. A null id comes first; equal ids are ordered by their text."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                       F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("key"))
    groups = GROUPS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = rows.select("key").stat.approxQuantile("key", [i / groups for i in range(1, groups)], 0.5 / groups)
    bounds = sorted({int(x) for x in cuts})
    grouped = rows.withColumn("group", _group_of(F.col("key"), bounds))
    heads = grouped.groupBy("group").agg(F.min("key").alias("key")).orderBy("group").collect()  # a row a group
    before = [(h["key"], heads[i - 1]["group"]) for i, h in enumerate(heads)]
    copies = spark.createDataFrame(before, "key long, copied_to int")  # a row a group
    dealt = (grouped.join(F.broadcast(copies), "key", "left")
             .select("doc_id", "text", "key", F.explode(F.array_compact(F.array(
                 F.struct(F.lit(False).alias("copy"), F.col("group")),
                 F.when(F.col("copied_to").isNotNull(),
                        F.struct(F.lit(True).alias("copy"), F.col("copied_to").alias("group")))))).alias("place"))
             .select("doc_id", "text", "key", "place.copy", F.col("place.group").alias("group"))
             .repartition("group").withColumn("sigs", signatures(F.col("text"), fill=True)))
    order = Window.partitionBy("group").orderBy("copy", "key", "text")
    return (dealt.withColumn("next_text", F.lead("text").over(order)).withColumn("next_sigs", F.lead("sigs").over(order))
            .where(~F.col("copy")).select("doc_id", "text", "sigs", "next_text", "next_sigs"))


def compare_with_edit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's fingerprint beside that of its edited text, whose last quarter
    of code points is replaced by as many of the next document's first, and
    beside the next document's. Repeated rows each get a row; with a single row
    it is its own next; an empty table gives no rows; further columns are ignored."""
    n, cut = F.length("text"), F.floor(F.length("text") / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - cut), F.substring("next_text", F.lit(1), cut))
    both = next_documents(docs, id_col, text_col).withColumn("edited", edited)
    both = both.withColumn("edited_sigs", signatures(F.col("edited"), fill=True))
    return both.select(
        "doc_id", n.cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        F.array_join("sigs", "").alias("fingerprint"), F.array_join("edited_sigs", "").alias("edited_fingerprint"),
        likeness(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"),
        likeness(F.col("sigs"), F.col("next_sigs")).alias("near_next"))
