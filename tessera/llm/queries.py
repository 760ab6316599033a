"""The registered queries of this subpackage: each applies one operator, with
its production parameters, to a whole table and returns its full result.

``REGISTRY`` maps a name to (query, DuckDB SQL or None). SQL is given where it
can state the result; the other queries are tested against plain Python.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.alignment import token_alignment
from tessera.llm.context_mixing import language_model_scores
from tessera.llm.decontaminate import decontaminate
from tessera.llm.exact_dedup import exact_duplicates
from tessera.llm.licenses import scan_licences
from tessera.llm.line_dedup import drop_repeated_lines
from tessera.llm.ngram_join import ngram_jaccard_join
from tessera.llm.packing import pack_documents
from tessera.llm.quality_qda import quality_scores
from tessera.llm.secrets import base_spans, scan_secrets, span_text
from tessera.llm.source_divergence import source_divergence
from tessera.llm.suffix_dedup import repeated_spans
from tessera.llm.url_filter import RULES, SOFT, SOFT_LIMIT, STRICT, judge_urls


def workers_import(spark: SparkSession) -> None:
    """Python workers find this package where the driver found it (a shared
    folder, or one machine); an installed or shipped package is found anyway."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([*filter(None, known), root])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    workers_import(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """A vocabulary file (op2's by default), installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by 3-word shingles at a Jaccard similarity of 0.9."""
    return ngram_jaccard_join(table(spark, sf_dir, "documents"), shingle_words=3, percent=90)


SQL_OP1 = """
WITH RECURSIVE d AS (
    SELECT doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w
    FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 2), ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
    SELECT x, y FROM pairs JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
    WHERE 100 * common >= 90 * (p.n + q.n - common)),
reach AS (
    SELECT doc_id AS node, doc_id AS seen FROM documents
    UNION SELECT node, y FROM reach JOIN links ON seen = x),
components AS (SELECT node AS doc_id, min(seen) AS component_id FROM reach GROUP BY node)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id,
       (SELECT count(*) FROM links WHERE x = doc_id) AS n_links
FROM components LEFT JOIN sizes USING (doc_id)
"""


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in sequences of at most 4096 tokens."""
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal documents."""
    return exact_duplicates(table(spark, sf_dir, "documents"))


SQL_OP3 = """
WITH plain AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS text_sha256
    FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, text_sha256
FROM plain WINDOW same AS (PARTITION BY text_sha256)
"""


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score of every document."""
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    found = scan_secrets(table(spark, sf_dir, "documents"))
    digest = F.sha2(span_text(base_spans(F.col("spans"))), 256).alias("base_sha256")
    return found.select("doc_id", "n_assign", "n_access", "n_hex", digest, span_text(F.col("spans")).alias("spans"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without lines that at least five of them hold."""
    cleaned = drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


SQL_OP6 = """
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i
    FROM documents),
keys AS (
    SELECT doc_id, i, line,
           translate(regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
    FROM lines),
often AS (
    SELECT k, max(doc_id) AS last_doc FROM keys
    WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
judged AS (
    SELECT doc_id, i, line, (o.k IS NOT NULL AND doc_id < last_doc) AS gone
    FROM keys LEFT JOIN often o USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents against the benchmark's ten-word windows."""
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest, "contaminated")


SQL_OP7 = """
WITH d AS (
    SELECT doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') AS w
    FROM documents),
b AS (
    SELECT CAST(item_id AS VARCHAR) AS item_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') AS w
    FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, list_slice(w, s + 1, s + 10) AS words
    FROM (SELECT item_id, w, unnest(range(greatest(len(w) - 10, 0) + 1)) AS s FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT len(words) AS n FROM windows),
spots AS (
    SELECT doc_id, n, s, list_slice(w, s + 1, s + n) AS words
    FROM (SELECT doc_id, w, n, unnest(range(greatest(len(w) - n + 1, 0))) AS s FROM d, sizes)),
hits AS (SELECT doc_id, s, n, item_id FROM spots JOIN windows USING (words)),
hit_words AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit
    FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id),
hit_items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
    FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strings of 400 bytes that occur twice in the documents."""
    found = repeated_spans(table(spark, sf_dir, "documents")).drop("spans")
    return found.withColumns({"n_kept": F.col("n_bytes") - F.col("n_removed"), "repeated": F.col("n_removed") > 0})


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of the documents, as files source/lang/doc_id."""
    docs = table(spark, sf_dir, "documents")
    path = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("none")), F.col("doc_id").cast("string"))
    found = scan_licences(docs.select(path.alias("path"), "text"))
    doc_id = F.element_at(F.split("path", "/"), -1).cast("long").alias("doc_id")
    return found.select(doc_id, "path", "licence", F.round("score", 6).alias("score"), "how", "source_dir", "licence_file")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict on every page's URL."""
    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url")).drop("terms")


def _sql_op10() -> str:
    hit = "regexp_matches(lower(coalesce(url, '')), '(^|[^\\p{{L}}\\p{{N}}]){}([^\\p{{L}}\\p{{N}}]|$)')"
    strict = " OR ".join(hit.format(t) for t in STRICT)
    soft = " + ".join(f"(CASE WHEN {hit.format(t)} THEN {w} ELSE 0 END)" for t, w in SOFT.items())
    cases = []
    for action, rule in sorted(RULES, key=lambda r: -len(r[1])):
        host, _, path = rule.partition("/")
        cases.append((f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{path}')", action, rule))
    rules = " ".join(f"WHEN {c} THEN '{r}'" for c, _, r in cases)
    verdicts = " ".join(f"WHEN {c} THEN '{a}'" for c, a, _ in cases)
    return f"""
WITH parts AS (
    SELECT page_id, url,
           translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages)
SELECT page_id, host, path, CASE {rules} END AS rule,
       CASE {verdicts} WHEN {strict} THEN 'block' WHEN {soft} >= {SOFT_LIMIT} THEN 'block' ELSE 'allow' END AS verdict
FROM parts
"""


def op11_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's probability by a model of those that aren't held out."""
    return language_model_scores(table(spark, sf_dir, "documents"), F.crc32(F.col("doc_id").cast("string")) % 7 == 2)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of two vocabularies, aligned in every document."""
    docs = table(spark, sf_dir, "documents")
    return token_alignment(docs, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the sources of each language differ in their words."""
    return source_divergence(table(spark, sf_dir, "documents"))


SQL_OP13 = """
WITH d AS (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents),
words AS (
    SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
kept AS (
    SELECT lang, term, count(*) AS lang_n FROM words GROUP BY ALL HAVING count(DISTINCT r) >= 3),
used AS (SELECT lang, source, term, count(*) AS n FROM words GROUP BY ALL),
cells AS (
    SELECT lang, source, term, coalesce(n, 0) AS n, lang_n
    FROM (SELECT DISTINCT lang, source FROM d) JOIN kept USING (lang) LEFT JOIN used USING (lang, source, term)),
totals AS (SELECT lang, source, sum(n) AS total, count(*) AS v, sum(lang_n) AS lang_total FROM cells GROUP BY ALL),
probabilities AS (
    SELECT lang, source, term, n,
           1 + (CAST(1000000000 AS HUGEINT) * (n + 1)) // (total + v) AS p,
           1 + (CAST(1000000000 AS HUGEINT) * (lang_n + 1)) // (lang_total + v) AS q
    FROM cells JOIN totals USING (lang, source)),
groups AS (SELECT DISTINCT lang, source FROM d),
pairs AS (
    SELECT g.lang, g.source, h.source AS item, coalesce(value, 0) AS value
    FROM groups g JOIN groups h ON g.lang = h.lang AND g.source <> h.source
    LEFT JOIN (
        SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
        FROM probabilities a JOIN probabilities b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
        GROUP BY ALL) x ON x.lang = g.lang AND x.source = g.source AND x.item = h.source),
parts AS (
    SELECT lang, source, 'pair' AS part, item, value FROM pairs
    UNION ALL
    SELECT lang, source, 'term', term, ((p - q) * (p - q)) // q FROM probabilities WHERE n > 0 AND p > q),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 200
"""


REGISTRY = {
    "op1_ngram_join": (op1_ngram_join, SQL_OP1),
    "op2_packing": (op2_packing, None),
    "op3_exact_dedup": (op3_exact_dedup, SQL_OP3),
    "op4_quality": (op4_quality, None),
    "op5_secrets": (op5_secrets, None),
    "op6_line_dedup": (op6_line_dedup, SQL_OP6),
    "op7_decontamination": (op7_decontamination, SQL_OP7),
    "op8_suffix_dedup": (op8_suffix_dedup, None),
    "op9_licenses": (op9_licenses, None),
    "op10_url_filter": (op10_url_filter, _sql_op10()),
    "op11_language_model": (op11_language_model, None),
    "op12_token_alignment": (op12_token_alignment, None),
    "op13_source_divergence": (op13_source_divergence, SQL_OP13),
}
