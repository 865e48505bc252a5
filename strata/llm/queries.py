"""The registered queries of the corpus operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import divergence as DV
from strata.llm import exact_dedup as XD
from strata.llm import importance as IR
from strata.llm import line_dedup as LD
from strata.llm import lm_score as LM
from strata.llm import mixing as MX
from strata.llm import near_dedup as ND
from strata.llm import packing as PK
from strata.llm import quality as QU
from strata.llm import token_counts as TC
from strata.llm import toxicity as TX
from strata.llm import url_filter as UF
from strata.llm import warc as WA
from strata.llm.common import LOWER, UPPER, table


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = LD.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(F.col("__row.doc_id").alias("doc_id"), "n_lines", "n_dropped",
                      F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = TC.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path())
    return counts.withColumn("over_limit", F.col("n_tokens") > 2048)


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ND.near_classes(table(spark, sf_dir, "documents")).drop("text_md5")


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return LM.score_texts(table(spark, sf_dir, "documents"), tokenizer_path())


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return PK.pack(table(spark, sf_dir, "documents"), tokenizer_path(), with_ids=False).drop("ids")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TX.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QU.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return XD.exact_dedup(table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return MX.mix(table(spark, sf_dir, "documents")).select(
        F.col("__doc").alias("doc_id"), "size", "source_size", "target", "taken")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = WA.write_packages(table(spark, sf_dir, "pages"))
    return WA.read_packages(manifest, with_payload=False).drop("url", "payload")


#: The rules of op12 (fixed values): host, path, action.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return IR.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return UF.judge(table(spark, sf_dir, "pages"), UF.rules_frame(spark, URL_RULES))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return DV.audit(table(spark, sf_dir, "documents"))


_LOW = f"translate({{}}, '{UPPER}', '{LOWER}')"

OP1_SQL = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
keyed AS (SELECT *, {_LOW.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key FROM lines),
hot AS (SELECT key, max(doc_id) AS newest FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (SELECT k.*, h.key IS NOT NULL AND k.doc_id <> h.newest AS dropped FROM keyed k LEFT JOIN hot h ON k.key = h.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

OP3_SQL = f"""
WITH d AS (SELECT doc_id, sha256({_LOW.format("coalesce(text, '')")}) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, d.text_sha256
FROM d JOIN g USING (text_sha256)
"""

OP10_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
w AS (SELECT payload_digest, max(page_id) AS keep FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
       CASE WHEN w.keep <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN w.keep <> p.page_id THEN w.keep END AS refers_to
FROM p LEFT JOIN w ON p.payload_digest = w.payload_digest AND p.payload_bytes >= 1000
"""

_CHAR_OF = "CASE WHEN (k & 1) = 1 THEN xor(k >> 1, 3988292384) ELSE k >> 1 END"

# crc32 byte by byte over the hex form of distinct features; the table of 256 remainders is made by its rule
OP11_SQL = f"""
WITH RECURSIVE rem(b, k, i) AS (
  SELECT range, range::BIGINT, 0 FROM range(256)
  UNION ALL SELECT b, {_CHAR_OF}, i + 1 FROM rem WHERE i < 8),
crc_table AS MATERIALIZED (SELECT list(k ORDER BY b) AS tab FROM rem WHERE i = 8),
word_lists AS (
  SELECT 0 AS side, doc_id AS id, {{words}} AS w FROM documents
  UNION ALL SELECT 1, item_id, {{words}} FROM benchmark),
numbered AS MATERIALIZED (SELECT row_number() OVER () AS row_no, * FROM word_lists),
singles AS MATERIALIZED (SELECT row_no, side, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM numbered),
runs AS (
  SELECT row_no, side, word, lead(word) OVER r AS w2, lead(word, 2) OVER r AS w3 FROM singles WINDOW r AS (PARTITION BY row_no ORDER BY pos)),
features AS (
  SELECT row_no, side, word AS feature FROM runs
  UNION ALL SELECT row_no, side, word || ' ' || w2 FROM runs WHERE w2 IS NOT NULL
  UNION ALL SELECT row_no, side, word || ' ' || w2 || ' ' || w3 FROM runs WHERE w3 IS NOT NULL),
counted AS MATERIALIZED (SELECT row_no, side, feature, count(*) AS n FROM features GROUP BY ALL),
hexed AS (SELECT DISTINCT feature, hex(encode(feature)) AS h FROM counted),
buckets AS MATERIALIZED (
  SELECT feature, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(0, length(h), 2), lambda i:
      ((strpos('0123456789ABCDEF', h[i + 1]) - 1) * 16 + strpos('0123456789ABCDEF', h[i + 2]) - 1)::BIGINT)),
    lambda c, b: xor(c >> 8, tab[1 + (xor(c, b) & 255)])), 4294967295) % 10000 AS bucket
  FROM hexed, crc_table),
sums AS (
  SELECT bucket, coalesce(sum(n) FILTER (WHERE side = 0), 0)::BIGINT AS s, coalesce(sum(n) FILTER (WHERE side = 1), 0)::BIGINT AS t
  FROM counted JOIN buckets USING (feature) GROUP BY bucket),
totals AS (SELECT sum(s)::BIGINT AS big_s, sum(t)::BIGINT AS big_t FROM sums),
gains AS (
  SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * (big_s + 10000)::DOUBLE) / ((s + 1)::DOUBLE * (big_t + 10000)::DOUBLE)))::BIGINT AS gain
  FROM sums, totals),
weighed AS (
  SELECT row_no, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight
  FROM counted JOIN buckets USING (feature) JOIN gains USING (bucket) WHERE side = 0 GROUP BY row_no),
scored AS (
  SELECT id AS doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM numbered LEFT JOIN weighed USING (row_no) WHERE side = 0),
ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_words >= 20)
SELECT s.doc_id, s.n_features, s.weight, s.score, CASE WHEN place <= 5 * n // 100 THEN place END AS rank
FROM scored s LEFT JOIN ranked USING (doc_id)
""".format(words=f"regexp_extract_all({_LOW.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

_RULE_ROWS = ", ".join(f"('{h}', '{p}', '{a}')" for h, p, a in URL_RULES)

OP12_SQL = f"""
WITH rules(rule_host, rule_path, action) AS (VALUES {_RULE_ROWS}),
u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, {_LOW.format("regexp_extract(rest, '^([^/?#]*)', 1)")} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
fits AS (
  SELECT p.*, r.*, row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC NULLS LAST, length(rule_host) DESC) AS place
  FROM parts p LEFT JOIN rules r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, host, path, rule_host || rule_path AS rule, coalesce(action, 'allow') AS verdict FROM fits WHERE place = 1
"""

OP13_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS doc, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
hits AS MATERIALIZED (
  SELECT doc, lang, source, unnest(regexp_extract_all({_LOW.format('text')}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS MATERIALIZED (SELECT lang, term FROM hits GROUP BY lang, term HAVING count(DISTINCT doc) >= 10),
counts AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM hits JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM d),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
group_n AS (SELECT g.lang, g.source, coalesce(sum(n), 0)::HUGEINT AS total FROM groups g LEFT JOIN counts c USING (lang, source) GROUP BY ALL),
p AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 2) // (g.total + 2 * s.v) AS p
  FROM group_n g JOIN sizes s USING (lang) JOIN kept k USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
q AS (
  SELECT lang, term, 1 + 1000000000::HUGEINT * (sum(n)::HUGEINT + 2) // (any_value(t.total) + 2 * any_value(s.v)) AS q
  FROM counts JOIN sizes s USING (lang) JOIN (SELECT lang, sum(total)::HUGEINT AS total FROM group_n GROUP BY lang) t USING (lang) GROUP BY lang, term),
pair_sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p))::BIGINT AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair_sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value
  FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item))::INTEGER AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""

#: name -> (query, DuckDB SQL or None)
QUERIES = {
    "op1_line_dedup": (op1_line_dedup, OP1_SQL),
    "op2_token_counts": (op2_token_counts, None),
    "op4_near_dedup": (op4_near_dedup, None),
    "op5_lm_scoring": (op5_lm_scoring, None),
    "op6_packing": (op6_packing, None),
    "op7_toxicity": (op7_toxicity, None),
    "op8_quality_rules": (op8_quality_rules, None),
    "op3_exact_dedup": (op3_exact_dedup, OP3_SQL),
    "op9_mixing": (op9_mixing, None),
    "op10_warc": (op10_warc, OP10_SQL),
    "op11_importance": (op11_importance, OP11_SQL),
    "op12_url_filter": (op12_url_filter, OP12_SQL),
    "op13_divergence": (op13_divergence, OP13_SQL),
}
