"""The operators over their whole tables, and SQL twins where SQL can express them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidyloom.llm.conversation_repair import damaged, repaired_conversations
from tidyloom.llm.decontaminate import contamination
from tidyloom.llm.interpolation import interpolated_scores
from tidyloom.llm.minhash import near_duplicates
from tidyloom.llm.near_vectors import linked_vectors
from tidyloom.llm.packing import packed
from tidyloom.llm.personal import KINDS, personal_spans, written
from tidyloom.llm.quotes import linked_conversations
from tidyloom.llm.redirects import judged
from tidyloom.llm.registry import ORACLES, QUERIES, query
from tidyloom.llm.spellings import spelling_variants
from tidyloom.llm.store import table
from tidyloom.llm.suffixes import without_repeats
from tidyloom.llm.token_counts import token_counts
from tidyloom.llm.toxicity import toxicity

__all__ = ["ORACLES", "QUERIES"]


def fold(of: int) -> Column:
    """The document's place in a split by its id."""
    return F.crc32(F.col("doc_id").cast("string")) % of


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("""
    WITH RECURSIVE vectors AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
    usable AS (
        SELECT vec_id, v FROM vectors
        WHERE len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
    links AS (
        SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
        WHERE list_cosine_similarity(a.v, b.v) >= 0.95),
    reach AS (SELECT vec_id AS a, vec_id AS b FROM vectors UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
    least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
    counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
    SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
    FROM vectors JOIN least ON least.a = vec_id LEFT JOIN counts ON counts.a = vec_id
""")
def op1_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """All vectors with a cosine of 0.95 or more to another."""
    return linked_vectors(table(spark, folder, "embeddings"))


@query()
def op2_interpolation(spark: SparkSession, folder: str) -> DataFrame:
    """Log-probability of every text, learned from six sevenths of them."""
    scored = interpolated_scores(table(spark, folder, "documents"), fold(7) != 2)
    return scored.select("doc_id", (fold(7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("""
    SELECT conv_id, turn, role, 0::BIGINT AS n_quotes, 0::BIGINT AS n_linked,
        CASE WHEN lag(turn) OVER w IS NOT NULL THEN conv_id END AS parent_conv, lag(turn) OVER w AS parent_turn,
        conv_id AS thread_conv, first_value(turn) OVER w AS thread_turn, row_number() OVER w - 1 AS depth, coalesce(text, '') AS text
    FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)
""")
def op3_quotes(spark: SparkSession, folder: str) -> DataFrame:
    """Threads of all messages; the given messages quote nothing, so the SQL has no quotes to follow."""
    return linked_conversations(table(spark, folder, "conversations"))


@query()
def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in windows of at most 2048 tokens."""
    pieces = packed(table(spark, folder, "documents"), tokenizer())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "tier", "step_id")


def tokenizer() -> str:
    """The tokenizer's file, in the same place on every machine."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query()
def op5_personal(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every text."""
    found = personal_spans(table(spark, folder, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))


@query(f"""
    WITH RECURSIVE texts AS (
        SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
    grams AS (
        SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w ELSE [w[i], w[i + 1]] END AS g
        FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM texts WHERE len(w) > 0)),
    sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
    links AS (
        SELECT a.doc_id AS a, b.doc_id AS b FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
        JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
        GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
    reach AS (SELECT doc_id AS a, doc_id AS b FROM texts UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
    least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
    SELECT t.doc_id, coalesce(s.n, 0) AS n_shingles, l.component_id, t.doc_id = l.component_id AS kept
    FROM texts t JOIN least l ON l.a = t.doc_id LEFT JOIN sizes s ON s.doc_id = t.doc_id
""")
def op6_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Near copies by circulant MinHash over two-word shingles."""
    return near_duplicates(table(spark, folder, "documents"), shingle_words=2)


@query()
def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every text; labels of the held-out fold are never read."""
    scored = toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"), fold(5) != 0)
    return scored.select("doc_id", (fold(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query(f"""
    WITH item_words AS (
        SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
    windows AS (
        SELECT DISTINCT item_id, w[i:i + least(len(w), 13) - 1] AS g
        FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM item_words WHERE len(w) > 0)),
    doc_words AS (
        SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
    places AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM doc_words),
    lengths AS (SELECT DISTINCT len(g) AS n FROM windows),
    found AS (
        SELECT p.doc_id, p.i, len(g) AS n, item_id FROM (
            SELECT doc_id, i, w[i:i + n - 1] AS d FROM places, lengths WHERE i + n - 1 <= len(w)) p JOIN windows ON g = d),
    hits AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM found) GROUP BY doc_id),
    items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
              FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM found) GROUP BY doc_id)
    SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
        sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM doc_words d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
""")
def op9_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark windows in every text."""
    found = contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    names = F.array_join(F.array_sort(F.transform("items", lambda item: item.cast("string"))), ",")
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


@query()
def op8_suffixes(spark: SparkSession, folder: str) -> DataFrame:
    """Texts without passages of 100 bytes that occur earlier."""
    cut = without_repeats(table(spark, folder, "documents"))
    return cut.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def contaminated() -> Column:
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


PAGE_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


@query("""
    WITH RECURSIVE parsed AS (
        SELECT page_id, url, html, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
    hosts AS (
        SELECT page_id, html, url, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
            regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM parsed),
    rules AS (FROM (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')) r(verdict, rule_host, rule_path)),
    own AS (
        SELECT page_id, h.host, h.path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule, arg_max(verdict, length(rule_host || rule_path)) AS verdict
        FROM hosts h LEFT JOIN rules r ON (h.host = rule_host OR ends_with(h.host, '.' || rule_host)) AND starts_with(h.path, rule_path)
        GROUP BY page_id, h.host, h.path)
    SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict, NULL::VARCHAR AS alias_rule FROM own
""")
def op10_redirects(spark: SparkSession, folder: str) -> DataFrame:
    """Every page's verdict; the given pages name no canonical address, so the SQL has no aliases to follow."""
    return judged(table(spark, folder, "pages"), PAGE_RULES)


@query()
def op11_repair(spark: SparkSession, folder: str) -> DataFrame:
    """The cheapest repair of every conversation, after the damage."""
    return repaired_conversations(table(spark, folder, "conversations"), damaged)


@query()
def op12_spellings(spark: SparkSession, folder: str) -> DataFrame:
    """Every frequent word of all texts with its likely spelling."""
    return spelling_variants(table(spark, folder, "documents"), damage_every=97)


@query()
def op13_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every text."""
    import public_tokenizers

    counted = token_counts(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"), "n_widened")
