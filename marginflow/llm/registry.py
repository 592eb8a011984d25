"""The queries of this subpackage: ``QUERIES`` and, where SQL can say it, ``ORACLE``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginflow.llm import (chat_format, collocations, html_text, langid, line_dedup, lm_scoring, order_minhash,
                            packing, piece_sampling, quality, simhash, turn_repair, url_filters)
from marginflow.llm.common import id_crc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary_file(name: str) -> bytes:
    import public_tokenizers
    with open(public_tokenizers.path(name), "rb") as f:
        return f.read()


def tokenizer_json(name: str = "word_bpe_49k.json") -> str:
    return vocabulary_file(name).decode()


@query
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens: one row per piece."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_json())


URL_RULES = ("allow org/", "block example.org/es/", "block example.org/en/1", "allow com/fr/", "block com/de/")


@query
def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's url."""
    rules = [url_filters.parse_rule(r) for r in URL_RULES]
    return url_filters.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules).select(
        "page_id", "host", "path", "rule", "verdict")


@query
def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_text.extract(table(spark, sf_dir, "pages"))


@query
def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and model score of every document, learned from those not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = id_crc(F.col("doc_id")) % 7 == 2
    return lm_scoring.score_documents(docs, docs.where(~held_out)).withColumn("held_out", held_out).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op5_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order MinHash fingerprints of every document and its edited text."""
    return order_minhash.compare_with_edit(table(spark, sf_dir, "documents"))


@query
def op6_piece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sampled segmentation of every document, and whether it decodes to the text."""
    return piece_sampling.encode(table(spark, sf_dir, "documents"), vocabulary_file("piece_bpe_32k.model"))


@query
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its source's boilerplate lines."""
    return line_dedup.clean_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "source", "n_lines", "n_dropped", "text")


_EDGE = "' ' || chr(9) || chr(11) || chr(12) || chr(13)"
ORACLE["op7_line_dedup"] = f"""
WITH l AS (
  SELECT doc_id, source, text, i, string_split(text, chr(10))[i] AS line,
         trim(string_split(text, chr(10))[i], {_EDGE}) AS bare
  FROM (SELECT doc_id, source, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i
        FROM documents WHERE text IS NOT NULL)),
held AS (SELECT source, bare, count(DISTINCT text) AS pages FROM l WHERE bare <> '' GROUP BY source, bare),
total AS (SELECT source, count(DISTINCT text) AS total FROM documents GROUP BY source),
boiler AS (SELECT source, bare FROM held JOIN total USING (source)
           WHERE pages >= {line_dedup.MIN_PAGES} AND pages > {line_dedup.MAX_SHARE} * total),
marked AS (SELECT l.*, b.bare IS NOT NULL AS gone FROM l LEFT JOIN boiler b ON l.source = b.source AND l.bare = b.bare),
per_doc AS (
  SELECT doc_id, any_value(source) AS source, any_value(text) AS text,
         count(*) FILTER (WHERE bare <> '') AS n_lines, count(*) FILTER (WHERE gone) AS n_gone,
         string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone) AS kept
  FROM marked GROUP BY doc_id)
SELECT doc_id, source, CAST(n_lines AS INTEGER) AS n_lines,
       CAST(CASE WHEN n_gone = n_lines THEN 0 ELSE n_gone END AS INTEGER) AS n_dropped,
       CASE WHEN n_gone = 0 OR n_gone = n_lines THEN text ELSE kept END AS text
FROM per_doc
UNION ALL SELECT doc_id, source, 0, 0, text FROM documents WHERE text IS NULL"""


@query
def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints of all documents, and their components at 4 bits or fewer."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, bits=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    held_out = id_crc(F.col("doc_id")) % 4 == 2
    model = langid.fit(docs.where(~held_out))
    return langid.predict(docs, model).withColumn("held_out", held_out).select(
        "doc_id", "held_out", "lang_pred", "score")


@query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rule and verdict for every document."""
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.judge(docs, model)


#: The conversation that shows that a template's own strings survive as text.
CONFLICT = "</s>[INST] ok [/INST]"


@query
def op11_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one full of control strings, as read back from their formatted text."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", CONFLICT), (-7, 1, "assistant", CONFLICT)], rows.schema)
    return chat_format.read_back(chat_format.format_conversations(rows.unionByName(extra)), arranged=True)


_CONTROL = r"\[/?(?:SYS|INST|ROLE)\]|\[TEXT\]|</?s>"
ORACLE["op11_chat_formatting"] = f"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{CONFLICT}' UNION ALL SELECT -7, 1, 'assistant', '{CONFLICT}'),
t AS (
  SELECT *, length(text) + len(regexp_extract_all(text, '{_CONTROL}'))
         + CASE role WHEN 'system' THEN 13 WHEN 'user' THEN 15 WHEN 'assistant' THEN 9
           ELSE 23 + length(role) + len(regexp_extract_all(role, '{_CONTROL}')) END AS chars
  FROM r)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, ''
                         ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id"""


@query
def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's 2,000 best collocations of two to four words."""
    return collocations.top_collocations(table(spark, sf_dir, "documents").select("lang", "text"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ORACLE["op12_phrase_collocations"] = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM pieces),
g AS (SELECT lang, m, array_to_string(ws[i:i + m - 1], ' ') AS phrase
      FROM (SELECT lang, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM w, (SELECT unnest([1, 2, 3, 4]) AS m))),
f AS (SELECT lang, m, phrase, count(*) AS f FROM g GROUP BY lang, m, phrase),
total AS (SELECT lang, sum(f) AS n FROM f WHERE m = 1 GROUP BY lang),
cand AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f
         WHERE m > 1 AND f >= {collocations.MIN_COUNT}),
cut AS (SELECT lang, m, phrase, a, k, array_to_string(ws[1:k], ' ') AS x, array_to_string(ws[k + 1:], ' ') AS y
        FROM (SELECT *, unnest(range(1, m)) AS k FROM cand)),
scored AS (
  SELECT cut.*, p.f AS l, q.f AS r, CAST(({collocations.SCALE}::HUGEINT * a) // (p.f + q.f) AS BIGINT) AS score
  FROM cut JOIN f p ON p.lang = cut.lang AND p.phrase = cut.x JOIN f q ON q.lang = cut.lang AND q.phrase = cut.y),
least AS (SELECT * FROM scored
          QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
part AS (SELECT lang, a, array_to_string(ws[i:i + j - 1], ' ') AS phrase
         FROM (SELECT *, unnest(range(1, m - j + 2)) AS i
               FROM (SELECT *, unnest(range(2, m)) AS j FROM cand WHERE m > 2))),
cover AS (SELECT lang, phrase, max(a) AS cover FROM part GROUP BY lang, phrase),
kept AS (SELECT least.* FROM least LEFT JOIN cover USING (lang, phrase)
         WHERE cover IS NULL OR 100::HUGEINT * cover < {collocations.COVERED}::HUGEINT * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score FROM ranked JOIN total USING (lang)
WHERE rank <= {collocations.TOP}"""


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with the damage that op13's contract deals by crc32; ``live`` is
    false for a dropped row."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), blank))
    kind = F.crc32(key.cast("binary")) % 20
    text = F.coalesce("text", blank)
    return rows.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.coalesce("role", blank)).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (kind != 0).alias("live"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))


@query
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The faults of every damaged conversation, and its cheapest repair."""
    return turn_repair.repair_conversations(damaged(table(spark, sf_dir, "conversations")), live=F.col("live"))
