"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from corpusloom.llm.anchored_pii import pii_spans
from corpusloom.llm.byte_bpe import encode_documents
from corpusloom.llm.common import documents
from corpusloom.llm.compression_bands import quality_rules
from corpusloom.llm.dictionary_quality import score_documents, train
from corpusloom.llm.minhash import fingerprint_edits
from corpusloom.llm.simhash import simhash_groups
from corpusloom.llm.source_mixing import choose
from corpusloom.llm.substring_dedup import remove_repeats
from corpusloom.llm.token_files import token_files
from corpusloom.llm.url_equivalence import judge_urls, parse_rules
from corpusloom.llm.word_passages import WIDTH

BYTE_BPE = "byte_bpe_multi_50k.tiktoken"
WORD_BPE = "word_bpe_49k.json"
END_ID = 2
RULES = ["block net/", "allow example.net/en/", "block example.com/de/", "allow org/fr/"]
#: Relative weights by level; what isn't named weighs 1.
WEIGHTS = {
    "domain": {"web": 4, "news": 3, "books": 2},
    "lang": {"en": 5, "fr": 2, "de": 2},
    "source": {"src0": 3},
}
SEED = 17


def domain_of_source():
    """The domain, which the table lacks, from the number in the source's name."""
    return F.element_at(F.array(*map(F.lit, ("web", "news", "books", "forum"))), F.pmod(F.coalesce(F.expr("try_cast(regexp_extract(source, '([0-9]+)$', 1) AS int)"), F.lit(3)), F.lit(4)) + 1)


def op1_substring_dedup(spark, sf_dir):
    return remove_repeats(documents(spark, sf_dir), with_kept=True, passage_words=WIDTH)


def op2_dictionary_quality(spark, sf_dir):
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5))
    scored = score_documents(docs, train(docs, labels, fold != 0), threshold=0.3)
    return scored.select("doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def op3_compression_bands(spark, sf_dir):
    return quality_rules(documents(spark, sf_dir))


def op4_anchored_pii(spark, sf_dir):
    return pii_spans(documents(spark, sf_dir), with_text=True)


def op5_minhash(spark, sf_dir):
    return fingerprint_edits(documents(spark, sf_dir))


def op6_url_equivalence(spark, sf_dir):
    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), parse_rules(RULES))


def op7_token_files(spark, sf_dir):
    return token_files(documents(spark, sf_dir), public_tokenizers.path(WORD_BPE), END_ID)


def op8_simhash(spark, sf_dir):
    return simhash_groups(documents(spark, sf_dir))


def op9_source_mixing(spark, sf_dir):
    return choose(documents(spark, sf_dir), WEIGHTS, SEED, max_epochs=2, share=(3, 5), domain=domain_of_source())


def op10_byte_bpe(spark, sf_dir):
    return encode_documents(documents(spark, sf_dir), public_tokenizers.path(BYTE_BPE), public_tokenizers.PATTERN, with_ids=False)


QUERIES = {f.__name__: f for f in (op1_substring_dedup, op2_dictionary_quality, op3_compression_bands, op4_anchored_pii, op5_minhash, op6_url_equivalence, op7_token_files, op8_simhash, op9_source_mixing, op10_byte_bpe)}
OP6_SQL = r"""
WITH RECURSIVE p AS (
    SELECT page_id, url, html, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), links AS (
    SELECT url AS source, replace(unnest(list_concat(
        list_transform(list_filter(regexp_extract_all(html, '(?i)<link\b[^>]*>'), lambda x: regexp_matches(x, '(?i)\brel\s*=\s*("([^">]*\s)?canonical[\s"]|''([^''>]*\s)?canonical[\s'']|canonical[\s/>])')),
            lambda x: regexp_extract(x, '(?i)\bhref\s*=\s*["'']?([^"''\s>]+)', 1)),
        list_transform(list_filter(regexp_extract_all(html, '(?i)<meta\b[^>]*>'), lambda x: regexp_matches(x, '(?i)\bhttp-equiv\s*=\s*["'']?refresh\b')),
            lambda x: regexp_extract(x, '(?i)\burl\s*=\s*["'']?([^"''\s>]+)', 1)))), '&amp;', '&') AS t,
        regexp_extract(url, '^[^:/?#]*://[^/?#]*') AS origin, regexp_extract(url, '^[^:/?#]*://[^/?#]*([^?#]*)', 1) AS page
    FROM pages WHERE regexp_matches(html, '(?i)canonical|http-equiv')
), targets AS (
    SELECT source, CASE WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN t
        WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*:') OR t = '' OR origin = '' THEN NULL
        WHEN starts_with(t, '//') THEN regexp_extract(source, '^[^:/?#]*:') || t
        WHEN starts_with(t, '/') THEN origin || t
        WHEN starts_with(t, '#') THEN regexp_replace(source, '(?s)#.*$', '') || t
        WHEN starts_with(t, '?') THEN origin || page || t
        ELSE origin || CASE WHEN page = '' THEN '/' ELSE regexp_replace(page, '[^/]*$', '') END || t END AS target
    FROM links
), urls AS (
    SELECT url FROM pages UNION SELECT source FROM targets WHERE target IS NOT NULL UNION SELECT target FROM targets WHERE target IS NOT NULL
), parts AS (
    SELECT url, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
        regexp_extract(regexp_replace(url, '(?s)#.*$', ''), '(?s)\?.*$') AS query
    FROM (SELECT url, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM urls)
), named AS (
    SELECT url, host, path,
        CASE WHEN contains(url, '://') THEN translate(substr(url, 1, instr(url, '://') - 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') || '://' || host
            || CASE WHEN path = '' THEN '/' ELSE path END || query END AS node,
        CASE WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
            WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
            WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
            WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
    FROM parts
), edges AS (
    SELECT s.node AS a, t.node AS b FROM targets e JOIN named s ON s.url = e.source JOIN named t ON t.url = e.target
), both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges), reach AS (
    SELECT a AS node, a AS r FROM both_ways UNION SELECT reach.node, b FROM reach JOIN both_ways ON reach.r = both_ways.a
), roots AS (SELECT node, min(r) AS root FROM reach GROUP BY node), placed AS (
    SELECT n.*, coalesce(root, n.node) AS root FROM named n LEFT JOIN roots USING (node)
), decided AS (
    SELECT root, bool_or(rule IN ('example.net/en/', 'org/fr/')) AS ok, bool_or(rule IN ('net/', 'example.com/de/')) AS no
    FROM placed WHERE rule IS NOT NULL GROUP BY root
)
SELECT p.page_id, coalesce(n.host, '') AS host, coalesce(n.path, '') AS path, n.rule,
    CASE WHEN n.rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN n.rule IS NOT NULL THEN 'block'
        WHEN coalesce(d.no, false) AND NOT coalesce(d.ok, false) THEN 'block' ELSE 'allow' END AS verdict
FROM p LEFT JOIN placed n ON n.url IS NOT DISTINCT FROM p.url LEFT JOIN decided d ON d.root = n.root
"""


def _fill_sql(parent: str, name: str, kids: str) -> str:
    """SQL for one level: ``kids`` has the parent's columns, name, w, cap and total."""
    by = f"PARTITION BY {parent}" if parent else ""
    cols = f"{parent}, {name}" if parent else name
    return f"""
SELECT {cols}, least(cap, part + CASE WHEN short = 0 AND place <= total - given THEN 1 ELSE 0 END) AS total FROM (
    SELECT *, sum(part) OVER ({by}) AS given, row_number() OVER ({by} ORDER BY short, md5({name}), {name}) AS place FROM (
        SELECT *, CASE WHEN short = 1 THEN cap ELSE w * free // free_w END AS part FROM (
            SELECT *, total - sum(CASE WHEN short = 1 THEN cap ELSE 0 END) OVER ({by}) AS free,
                sum(CASE WHEN short = 1 THEN 0 ELSE w END) OVER ({by}) AS free_w FROM (
                SELECT *, min(CASE WHEN cap * (all_w - prev_w) <= w * (total - prev_cap) THEN 1 ELSE 0 END)
                    OVER ({by} ORDER BY cap::DOUBLE / w, {name} ROWS UNBOUNDED PRECEDING) AS short FROM (
                    SELECT *, sum(w) OVER ({by}) AS all_w,
                        coalesce(sum(w) OVER ({by} ORDER BY cap::DOUBLE / w, {name} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prev_w,
                        coalesce(sum(cap) OVER ({by} ORDER BY cap::DOUBLE / w, {name} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prev_cap
                    FROM ({kids}))))))"""


OP9_SQL = r"""
WITH rows_ AS (
    SELECT doc_id, ['web', 'news', 'books', 'forum'][coalesce(try_cast(regexp_extract(source, '([0-9]+)$', 1) AS INT), 3) % 4 + 1] AS domain,
        coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS n_tokens
    FROM documents
), leaves AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS supply, sum(n_tokens)::BIGINT * 2 AS cap FROM rows_ GROUP BY ALL),
b1 AS (@1), b2 AS (@2), b3 AS (@3),
plan AS (
    SELECT l.domain, l.lang, l.source, total::BIGINT AS budget, CASE WHEN supply > 0 THEN total // supply ELSE 0 END::BIGINT AS epochs, CASE WHEN supply > 0 THEN total % supply ELSE 0 END::BIGINT AS rest
    FROM leaves l JOIN b3 USING (domain, lang, source)
), ordered AS (
    SELECT r.*, budget, epochs, rest, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY md5('17:' || epochs || ':' || doc_id), doc_id, n_tokens ROWS UNBOUNDED PRECEDING) AS upto
    FROM rows_ r JOIN plan USING (domain, lang, source)
)
SELECT doc_id, domain, lang, source, n_tokens, budget AS leaf_budget, epochs + CASE WHEN rest > 0 AND 2 * upto - n_tokens <= 2 * rest THEN 1 ELSE 0 END AS copies FROM ordered
"""
OP9_SQL = OP9_SQL.replace(
    "@1", _fill_sql("", "domain", "SELECT domain, sum(cap)::BIGINT AS cap, CASE domain WHEN 'web' THEN 4 WHEN 'news' THEN 3 WHEN 'books' THEN 2 ELSE 1 END AS w, (SELECT (sum(supply) * 3 // 5)::BIGINT FROM leaves) AS total FROM leaves GROUP BY domain")
).replace(
    "@2", _fill_sql("domain", "lang", "SELECT domain, lang, sum(cap)::BIGINT AS cap, CASE lang WHEN 'en' THEN 5 WHEN 'fr' THEN 2 WHEN 'de' THEN 2 ELSE 1 END AS w, any_value(total) AS total FROM leaves JOIN b1 USING (domain) GROUP BY domain, lang")
).replace(
    "@3", _fill_sql("domain, lang", "source", "SELECT domain, lang, source, sum(cap)::BIGINT AS cap, CASE source WHEN 'src0' THEN 3 ELSE 1 END AS w, any_value(total) AS total FROM leaves JOIN b2 USING (domain, lang) GROUP BY domain, lang, source")
)

ORACLE_SQL: dict[str, str] = {"op6_url_equivalence": OP6_SQL, "op9_source_mixing": OP9_SQL}
