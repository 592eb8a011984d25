"""URL filtering by rules, given ones and mined ones, in DataFrame operations only.

Given (host, path) rules decide the urls they fit. Those urls are labelled by
that, and FP-growth mines the token combinations that go with a label; rules
pruned by support and confidence, and by shorter rules that say the same,
decide the other urls. Tokens that are always together are mined as one. A mined
rule is filed under its rarest token, so a url is only compared with the rules
that its own tokens lead to.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginflow.llm.common import written

ALLOW, BLOCK = "allow", "block"
MIN_SUPPORT = 0.005
MIN_CONFIDENCE = 0.9
_LABEL = "verdict="


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def parse_rule(text: str) -> Rule:
    """A rule from e.g. ``block example.org/es/``."""
    verdict, where = text.split()
    host, slash, path = where.partition("/")
    if verdict not in (ALLOW, BLOCK):
        raise ValueError(f"unknown verdict in {text!r}")
    return Rule(verdict, host, slash + path)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host, up to ``?``, ``#`` or the end; empty without a host part."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens_of(url: Column) -> Column:
    """A url's distinct tokens: host labels, path segments, and names of query values."""
    query = F.regexp_extract(F.coalesce(_after_scheme(url), F.lit("")), r"^[^?#]*\?([^#]*)", 1)
    parts = [("h:", F.split(host_of(url), r"\.")), ("p:", F.split(F.lower(path_of(url)), "/")),
             ("q:", F.regexp_extract_all(query, F.lit(r"(?:^|&)([^&=]+)"), 1))]

    def named_by(kind: str):  # a lambda's second argument would be the index
        return lambda x: F.concat(F.lit(kind), x)

    named = [F.transform(F.filter(a, lambda x: x != ""), named_by(kind)) for kind, a in parts]
    return F.array_sort(F.array_distinct(F.concat(*named)))


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as a struct (size, name, verdict); null if none does.

    The list is the caller's, and part of the expression."""
    fits = []
    for r in rules:
        on_host = (host == r.host) | F.endswith(host, F.lit("." + r.host))
        fits.append(F.when(on_host & F.startswith(path, F.lit(r.path)),
                           F.struct(F.lit(len(r.name)).alias("size"), F.lit(r.name).alias("name"),
                                    F.lit(r.verdict).alias("verdict"))))
    return F.array_max(F.array_compact(F.array(*fits))) if fits else F.lit(None).cast(
        "struct<size:int,name:string,verdict:string>")


def token_classes(labelled: DataFrame, min_support: float = MIN_SUPPORT) -> DataFrame:
    """(token, class): the frequent tokens of rows (id, tokens), those that occur in the
    same rows under one name, the least of them.

    Tokens of a class are in the same combinations with the same counts, so one
    stands for all while rules are mined: a site's dozen query names, always together,
    would otherwise make a rule of each of their subsets."""
    held = labelled.select("id", F.explode("tokens").alias("token"))
    sets = held.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.expr("bit_xor(xxhash64(id))").alias("x"),
                                     F.expr("bit_xor(xxhash64(id, 1))").alias("y"))
    sets = written(sets.where(F.col("n") >= F.lit(min_support) * labelled.count()), "url-tokens")
    names = sets.groupBy("n", "x", "y").agg(F.min("token").alias("class"))
    return sets.join(names, ["n", "x", "y"]).select("token", "class")


def mine_rules(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
               classes: DataFrame | None = None) -> DataFrame:
    """(antecedent, verdict, confidence, support, rarest) from rows (tokens, verdict); with
    ``classes`` from rows (id, tokens, verdict), and the antecedents are classes.

    A rule is dropped if a part of its tokens alone gives the same verdict with
    at least its confidence. Parts are compared level by level: a combination inherits the best
    confidence from those of one token fewer, which are all frequent too."""
    items = F.col("tokens")
    if classes is not None:
        held = labelled.select("id", F.explode("tokens").alias("token")).join(classes, "token")
        sets = held.groupBy("id").agg(F.collect_set("class").alias("classes"))
        labelled = labelled.join(sets, "id", "left")
        items = F.coalesce("classes", F.array().cast("array<string>"))
    baskets = labelled.select(F.concat(items, F.array(F.concat(F.lit(_LABEL), "verdict"))).alias("items"))
    found = FPGrowth(itemsCol="items", minSupport=min_support).fit(baskets).freqItemsets
    label = F.filter("items", lambda x: F.startswith(x, F.lit(_LABEL)))
    antecedent = F.array_sort(F.filter("items", lambda x: ~F.startswith(x, F.lit(_LABEL))))
    found = written(found.select(antecedent.alias("antecedent"), F.get(label, F.lit(0)).alias("label"), "freq")
                    .where(F.size("antecedent") > 0), "url-itemsets")
    bare = found.where(F.col("label").isNull()).select("antecedent", F.col("freq").alias("n"))
    total = baskets.count()
    sets = written(found.where(F.col("label").isNotNull()).join(bare, "antecedent").select(
        "antecedent", F.substring("label", len(_LABEL) + 1, 100).alias("verdict"),
        (F.col("freq") / F.col("n")).alias("confidence"), (F.col("freq") / F.lit(total)).alias("support")), "url-rules")

    longest = sets.agg(F.max(F.size("antecedent"))).first()[0] or 0
    own = F.when(F.col("confidence") >= min_confidence, F.col("confidence"))
    none = F.lit(None).cast("double")
    kept, below = [], None
    for size in range(1, longest + 1):
        level = sets.where(F.size("antecedent") == size)
        if below is None:
            level = level.withColumn("part", none)
        else:
            parts = level.select("antecedent", "verdict", F.explode("antecedent").alias("token"))
            parts = parts.withColumn("shorter", F.array_remove("antecedent", F.col("token")))
            best = below.select(F.col("antecedent").alias("shorter"), "verdict", "best")
            best = parts.join(best, ["shorter", "verdict"]).groupBy("antecedent", "verdict").agg(F.max("best").alias("part"))
            level = level.join(best, ["antecedent", "verdict"], "left")
        level = written(level.withColumn("best", F.greatest(own, "part")), "url-rules-level")
        kept.append(level.where(own.isNotNull() & (F.col("part").isNull() | (F.col("part") < F.col("confidence")))))
        below = level
    if not kept:
        return sets.withColumn("rarest", F.lit(None).cast("string"))
    rules = kept[0]
    for level in kept[1:]:
        rules = rules.unionByName(level)
    rules = rules.drop("part", "best")
    often = bare.where(F.size("antecedent") == 1).select(F.col("antecedent")[0].alias("token"), "n")
    filed = (rules.select("antecedent", "verdict", F.explode("antecedent").alias("token")).join(often, "token")
             .groupBy("antecedent", "verdict").agg(F.min(F.struct("n", "token"))["token"].alias("rarest")))
    return rules.join(filed, ["antecedent", "verdict"])


def judge_urls(pages: DataFrame, rules: Sequence[Rule], min_support: float = MIN_SUPPORT,
               min_confidence: float = MIN_CONFIDENCE, default: str = ALLOW, url_col: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` (columns of these names are replaced).

    A null url, or one without ``://``, has an empty host and path, fits no rule
    and no mined combination, and gets ``default``. Of several mined rules that
    fit, the most confident decides, then the longest, the best supported, and
    the last by its tokens. Without labelled urls every other url gets
    ``default``; repeated rows each get a row; an empty table gives no rows."""
    url = F.col(url_col)
    # one url is judged once, whatever its rows
    urls = pages.where(url.isNotNull()).select(url.alias("__url")).distinct().select(
        "__url", fitting_rule(host_of(F.col("__url")), path_of(F.col("__url")), rules)["verdict"].alias("verdict"),
        tokens_of(F.col("__url")).alias("tokens"))
    urls = written(urls, "urls")
    labelled = urls.where(F.col("verdict").isNotNull()).withColumnRenamed("__url", "id")
    open_ = urls.where(F.col("verdict").isNull())
    if labelled.isEmpty():
        verdicts = open_.select("__url", F.lit(default).alias("__mined"))
    else:
        classes = written(token_classes(labelled, min_support), "url-token-classes")
        index = written(mine_rules(labelled, min_support, min_confidence, classes).select(
            F.col("rarest").alias("class"), "antecedent", F.col("verdict").alias("says"), "confidence", "support"), "url-index")
        # a url's classes, each with the last of its tokens there
        held = (open_.select("__url", F.explode("tokens").alias("token")).join(classes, "token")
                .groupBy("__url", "class").agg(F.max("token").alias("token")))
        owned = held.groupBy("__url").agg(F.map_from_entries(F.collect_list(F.struct("class", "token"))).alias("owned"))
        tokens = F.array_sort(F.transform("antecedent", lambda c: F.element_at("owned", c)))
        verdicts = (owned.select("__url", "owned", F.explode(F.map_keys("owned")).alias("class")).join(index, "class")
                    .where(F.forall("antecedent", lambda c: F.map_contains_key("owned", c)))
                    .groupBy("__url").agg(F.max(F.struct("confidence", F.size("antecedent"), "support", tokens,
                                                         "says"))["says"].alias("__mined")))
    host, path = host_of(url), path_of(url)
    fit = fitting_rule(host, path, rules)
    return (pages.join(verdicts, url == F.col("__url"), "left")
            .withColumns({"host": host, "path": path, "rule": fit["name"],
                          "verdict": F.coalesce(fit["verdict"], "__mined", F.lit(default))})
            .drop("__url", "__mined"))
