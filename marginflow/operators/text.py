"""Product-name text clustering: product rollup, TF-IDF, KMeans, cluster themes.

* products are rolled up first (one document per distinct name), so text work
  scales with the catalogue, not with transactions;
* TF-IDF: term counts inside each row -> vocabulary = top ``max_features`` terms
  by corpus count (a distributed top-k; its size is the ``max_features``
  parameter) -> smooth idf ln((1+n)/(1+df)) + 1 -> L2 normalisation inside the row;
* KMeans runs on vectors over the bounded vocabulary;
* a deterministic seeded assignment (centroids = TF-IDF vectors of the top-k
  products by sales) serves as the SQL-checkable clustering; the centroid of a
  cluster is the mean of its members' vectors, and its theme the top 6 terms.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginflow.constants import MAX_FEATURES, N_INIT, SEED, TEXT_K, TOP_TERMS
from marginflow.functions.columns import safe_div
from marginflow.functions.heavy import top_candidates
from marginflow.functions.text import ngrams_1_2, tokens
from marginflow.operators.kmeans import kmeans, nearest_centre, renumbered
from marginflow.session import written

NAME = "Product Name"


def product_rollup(tx: DataFrame, order_col: str = "_row_order") -> DataFrame:
    """Per product: total sales and profit, mean discount, first category/sub-category.

    "first" is the first value that is not NULL, by ``order_col`` (a unique number
    that gives the row order). Sums of nothing are 0; the mean discount is an exact
    decimal mean, so its digits do not depend on the partitioning. Raw rows are hash-aggregated
    by name and both categories; the few rows that remain of a product are then
    combined, so no raw row is sorted.
    """
    n = F.col(f"`{NAME}`")
    parts = (tx.where(n.isNotNull()).groupBy(n.alias(NAME), "Category", F.col("`Sub-Category`").alias("Sub_Category"))
               .agg(F.sum("Sales").alias("Sales"), F.sum("Profit").alias("Profit"),
                    F.sum(F.col("Discount").cast("decimal(38,6)")).alias("_discount"), F.count("Discount").alias("_discounts"),
                    F.min(order_col).alias("_first")))

    def first(c):
        return F.min_by(c, F.when(F.col(c).isNotNull(), F.col("_first"))).alias(c)

    prod = parts.groupBy(F.col(f"`{NAME}`")).agg(
        F.coalesce(F.sum("Sales"), F.lit(0.0)).alias("Sales"), F.coalesce(F.sum("Profit"), F.lit(0.0)).alias("Profit"),
        (F.sum("_discount").cast("decimal(24,6)") / F.nullif(F.sum("_discounts"), F.lit(0)).cast("decimal(12,0)"))
        .cast("double").alias("Discount"),
        first("Category"), first("Sub_Category"))
    return prod.withColumn("Margin_Pct", safe_div("Profit", "Sales") * 100)


def product_tokens(prod: DataFrame, stop_words: Sequence[str] | None = None) -> DataFrame:
    return prod.select(F.col(f"`{NAME}`"), tokens(F.col(f"`{NAME}`"), stop_words).alias("tokens"))


def product_terms(prod: DataFrame, stop_words: Sequence[str] | None = None) -> DataFrame:
    return prod.select(F.col(f"`{NAME}`"),
                       ngrams_1_2(tokens(F.col(f"`{NAME}`"), stop_words)).alias("terms"))


def _counted(terms: Column) -> Column:
    """[(term, tf)] of one document's n-grams, inside the row: the runs of the sorted terms."""
    ordered = F.array_sort(terms)
    starts = F.filter(F.sequence(F.lit(0), F.size(ordered) - 1), lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)))
    ends = F.concat(F.slice(starts, 2, F.size(starts)), F.array(F.size(ordered)))
    runs = F.zip_with(starts, ends, lambda a, b: F.struct(F.get(ordered, a).alias("term"), (b - a).alias("tf")))
    return F.when(F.size(terms) > 0, runs).otherwise(F.array().cast("array<struct<term:string,tf:int>>"))


def term_frequencies(prod: DataFrame, stop_words: Sequence[str] | None = None) -> DataFrame:
    """(Product Name, term, tf): n-gram counts per document, without a shuffle."""
    docs = product_terms(prod, stop_words)
    return docs.select(F.col(f"`{NAME}`"), F.inline(_counted(F.col("terms"))))


def vocabulary(prod: DataFrame, max_features: int = MAX_FEATURES,
               stop_words: Sequence[str] | None = None) -> DataFrame:
    """(term, idf, idx): the top ``max_features`` terms by corpus count (ties by
    term), smooth idf over all documents, and an alphabetical feature index."""
    # only terms that can be among the top are shuffled and counted
    terms = product_terms(prod, stop_words)
    tf = term_frequencies(prod, stop_words).join(top_candidates(terms, "terms", max_features), "term", "left_semi")
    top = (tf.groupBy("term").agg(F.sum("tf").alias("ctf"), F.count(F.lit(1)).alias("df"))
             .orderBy(F.desc("ctf"), "term").limit(max_features))
    n_docs = prod.agg(F.count(F.lit(1))).scalar()
    # <= max_features rows: the single-partition window is bounded
    return top.select("term", (F.log((n_docs + 1) / (F.col("df") + 1)) + 1).alias("idf"),
                      (F.row_number().over(Window.orderBy("term")) - 1).cast("int").alias("idx"))


def tfidf_weights(prod: DataFrame, vocab: DataFrame,
                  stop_words: Sequence[str] | None = None) -> DataFrame:
    """(Product Name, term, idx, weight): tf * idf over the vocabulary, L2-normalised
    per document. One row is one document, so counts, weights and norm stay inside
    the row; the vocabulary (``max_features`` rows) comes back as a literal map."""
    known = vocab.select("term", "idf", "idx").collect()
    if not known:
        return prod.select(F.col(f"`{NAME}`"), F.lit("").alias("term"), F.lit(0).alias("idx"),
                           F.lit(0.0).alias("weight")).where(F.lit(False))
    entries = F.create_map(*[x for r in known for x in (
        F.lit(r["term"]), F.struct(F.lit(r["idf"]).alias("idf"), F.lit(r["idx"]).alias("idx")))])
    docs = product_terms(prod, stop_words).withColumn(
        "terms", F.filter("terms", lambda t: F.map_contains_key(entries, t)))
    raw = F.transform(_counted(F.col("terms")), lambda e: F.struct(
        e["term"].alias("term"), F.element_at(entries, e["term"])["idx"].alias("idx"),
        (e["tf"] * F.element_at(entries, e["term"])["idf"]).alias("raw")))
    weighed = docs.select(F.col(f"`{NAME}`"), raw.alias("raw")).withColumn(
        "norm", F.sqrt(F.aggregate("raw", F.lit(0.0), lambda a, e: a + e["raw"] * e["raw"])))
    return (weighed.select(F.col(f"`{NAME}`"), "norm", F.inline("raw"))
                   .select(F.col(f"`{NAME}`"), "term", "idx", (F.col("raw") / F.col("norm")).alias("weight")))


def tfidf(prod: DataFrame, max_features: int = MAX_FEATURES,
          stop_words: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Returns (weights long form: Product Name, term, idx, weight; vocabulary: term, idf, idx)."""
    vocab = vocabulary(prod, max_features, stop_words)
    return tfidf_weights(prod, vocab, stop_words), vocab


def sparse_vectors(prod: DataFrame, vocab: DataFrame, stop_words: Sequence[str] | None = None,
                   out: str = "features") -> DataFrame:
    """One sparse TF-IDF vector per product over the vocabulary (empty when no term
    hits): term counts, times idf, L2-normalised, all inside the row."""
    from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
    from pyspark.ml.linalg import Vectors
    rows = vocab.orderBy("idx").collect()                    # max_features rows
    counts = CountVectorizerModel.from_vocabulary([r["term"] for r in rows], inputCol="terms", outputCol="_tf")
    weigh = ElementwiseProduct(scalingVec=Vectors.dense([r["idf"] for r in rows]), inputCol="_tf", outputCol="_raw")
    docs = weigh.transform(counts.transform(product_terms(prod, stop_words)))
    return Normalizer(p=2.0, inputCol="_raw", outputCol=out).transform(docs).select(F.col(f"`{NAME}`"), out)


def kmeans_text_clusters(prod: DataFrame, k: int = TEXT_K, n_init: int = N_INIT, seed: int = SEED,
                         max_features: int = MAX_FEATURES,
                         stop_words: Sequence[str] | None = None,
                         vocab: DataFrame | None = None) -> DataFrame:
    """KMeans over TF-IDF vectors; pass a precomputed vocabulary to reuse it.

    Clusters are numbered by the least product name in them."""
    if vocab is None:
        vocab = vocabulary(prod, max_features, stop_words)
    return _clustered(sparse_vectors(prod, vocab, stop_words), NAME, "features", "text_cluster", k, n_init, seed)


def _clustered(vectors: DataFrame, key: str, features: str, out: str, k: int, n_init: int, seed: int) -> DataFrame:
    vectors = written(vectors, "vectors")
    found = kmeans(vectors, features, k, n_init, seed, key=F.col(f"`{key}`"))
    if found is None:
        return vectors.select(F.col(f"`{key}`"), F.lit(None).cast("int").alias(out))
    return renumbered(nearest_centre(vectors, found.centres, features, out, found.unit), out, key)


def seeded_text_clusters(prod: DataFrame, weights: DataFrame, k: int = TEXT_K) -> DataFrame:
    """Assign each product to the nearest of k seed vectors: the top-k products by
    Sales (ties by name). Squared distance |x|^2 + |c|^2 - 2 x.c over sparse maps."""
    seeds = (prod.select(F.col(f"`{NAME}`"), "Sales")
                 .orderBy(F.desc("Sales"), F.col(f"`{NAME}`")).limit(k)
                 .withColumn("seed", F.row_number().over(
                     Window.orderBy(F.desc("Sales"), F.col(f"`{NAME}`"))) - 1))
    maps = weights.groupBy(F.col(f"`{NAME}`")).agg(
        F.map_from_entries(F.collect_list(F.struct("term", "weight"))).alias("m"))
    seed_maps = (seeds.join(maps, NAME, "left")
                      .agg(F.collect_list(F.struct(F.col("seed").alias("id"),
                                                   F.coalesce("m", F.create_map().cast(
                                                       "map<string,double>")).alias("m"))).alias("s"))
                      .scalar())
    docs = prod.select(F.col(f"`{NAME}`")).join(maps, NAME, "left").withColumn(
        "m", F.coalesce("m", F.create_map().cast("map<string,double>")))

    def sq(mcol):
        return F.aggregate(F.map_values(mcol), F.lit(0.0), lambda acc, v: acc + v * v)

    def dot(a, b):
        return F.aggregate(F.map_keys(a), F.lit(0.0),
                           lambda acc, t: acc + F.element_at(a, t) * F.coalesce(F.element_at(b, t),
                                                                                 F.lit(0.0)))

    # distances rounded to 1e-9 so exact ties (no shared terms) go to the lower seed id
    best = F.array_min(F.transform("_s", lambda s: F.struct(
        F.round(sq(F.col("m")) + sq(s.getField("m")) - 2 * dot(F.col("m"), s.getField("m")), 9)
        .alias("d"),
        s.getField("id").alias("id"))))
    return (docs.withColumn("_s", seed_maps)
                .select(F.col(f"`{NAME}`"), best.getField("id").cast("int").alias("text_cluster")))


def cluster_summary(prod: DataFrame, clusters: DataFrame) -> DataFrame:
    """Per text cluster: products, mean margin, total profit, total sales (by margin)."""
    return (prod.join(clusters, NAME)
                .groupBy("text_cluster")
                .agg(F.count(F.lit(1)).alias("n_products"), F.avg("Margin_Pct").alias("avg_margin"),
                     F.sum("Profit").alias("total_profit"), F.sum("Sales").alias("total_sales"))
                .orderBy("avg_margin", "text_cluster"))


def cluster_top_terms(weights: DataFrame, clusters: DataFrame, top: int = TOP_TERMS) -> DataFrame:
    """Top centroid terms per cluster (centroid = mean member vector)."""
    sizes = clusters.groupBy("text_cluster").agg(F.count(F.lit(1)).alias("_n"))
    cent = (weights.join(clusters, NAME).groupBy("text_cluster", "term")
                   .agg(F.sum("weight").alias("_s"))
                   .join(F.broadcast(sizes), "text_cluster")      # k rows
                   .select("text_cluster", "term", (F.col("_s") / F.col("_n")).alias("centroid_weight")))
    # rank on weights rounded to 1e-9, so mathematically equal weights tie and
    # fall back to term order instead of summation noise (k partitions x vocabulary rows)
    w = Window.partitionBy("text_cluster").orderBy(F.desc(F.round("centroid_weight", 9)), "term")
    return (cent.withColumn("term_rank", F.row_number().over(w))
                .where(F.col("term_rank") <= top))


def embedding_clusters(emb: DataFrame, k: int = TEXT_K, n_init: int = N_INIT, seed: int = SEED,
                       id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """KMeans on stored embedding vectors (the dense-vector variant of text clustering);
    clusters are numbered by the least id in them."""
    vectors = emb.select(id_col, F.col(vec_col).cast("array<double>").alias("features"))
    return _clustered(vectors, id_col, "features", "cluster", k, n_init, seed)
