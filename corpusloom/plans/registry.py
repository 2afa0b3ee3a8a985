"""One query per operator, and the same in DuckDB SQL where SQL can say it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.config import DEFAULT, STRICT
from corpusloom.functions import text as tx
from corpusloom.functions import udfs
from corpusloom.functions.text import stable_round
from corpusloom.operators import align, augment, extract, manifest, metrics, nbest, quality, split
from corpusloom.plans import fixtures as fx
from corpusloom.plans.catalog import ORACLE_SQL, QUERIES, query  # noqa: F401
from corpusloom.plans.fixtures import SEG, TURNS, WORDS, table
from corpusloom.storage import shared_folder

def filtered(spark, sf_dir, profile=DEFAULT) -> DataFrame:
    return quality.filter_segments(fx.segments(spark, sf_dir), fx.report(spark, sf_dir), profile)


# --- text in SQL ---------------------------------------------------------------------------------------------------
NORM = lambda c: f"trim(regexp_replace(coalesce({c}, ''), '[\\x09-\\x0d\\x1c-\\x20\\x85\\p{{Z}}]+', ' ', 'g'), ' ')"
PLAIN = lambda c: f"lower(trim(regexp_replace({NORM(c)}, '[^0-9A-Za-z가-힣]+', ' ', 'g'), ' '))"
WORDS_OF = lambda c: f"list_filter(string_split({NORM(c)}, ' '), lambda w: w <> '')"
_list = lambda names: "[" + ", ".join(f"'{n}'" for n in names) + "]"
ROMAN = lambda c: f"""array_to_string(list_transform(string_split({c}, ''), lambda ch: CASE WHEN ch <> '' AND unicode(ch) BETWEEN 44032 AND 55203 THEN
    {_list(tx.INITIALS)}[(unicode(ch) - 44032) // 588 + 1] || {_list(tx.VOWELS)}[((unicode(ch) - 44032) % 588) // 28 + 1] || {_list(tx.FINALS)}[(unicode(ch) - 44032) % 28 + 1]
    ELSE lower(ch) END), '')"""  # noqa: E731
SENTENCES = lambda c: f"""CASE WHEN {NORM(c)} = '' THEN [] WHEN regexp_matches({NORM(c)}, '[.!?。！？]')
    THEN list_filter(string_split(regexp_replace({NORM(c)}, '([.!?。！？]) +', '\\1' || chr(30), 'g'), chr(30)), lambda x: x <> '')
    ELSE list_transform(range(0, len({WORDS_OF(c)}), 12), lambda k: array_to_string(list_slice({WORDS_OF(c)}, k + 1, k + 12), ' ')) END"""  # noqa: E731

# --- segments, files, speakers -------------------------------------------------------------------------------------
STATS = f"""{SEG}, per AS (
    SELECT speaker_id, count(*) AS utterances, sum(duration_sec) / 3600 AS h, avg(score) AS s, avg(coverage) AS c, arg_min(category_code, manifest_index) AS category_code
    FROM ok GROUP BY speaker_id
), sev AS (
    SELECT speaker_id, severity_label FROM (SELECT speaker_id, severity_label, count(*) AS n, min(manifest_index) AS f FROM ok WHERE severity_label NOT IN ('', 'unknown') GROUP BY ALL)
    QUALIFY row_number() OVER (PARTITION BY speaker_id ORDER BY n DESC, f) = 1
), stats AS (
    SELECT speaker_id, category_code, utterances, SR(h, 3) AS total_hours, SR(s, 4) AS mean_score, SR(c, 4) AS mean_coverage,
        SR(1 - (0.7::DOUBLE * s + 0.3::DOUBLE * c), 4) AS severity_proxy, coalesce(severity_label, 'unknown') AS actual_severity
    FROM per LEFT JOIN sev USING (speaker_id)
)"""
SPLIT = f"""{STATS}, binned AS (
    SELECT *, ['lower_proxy', 'mid_proxy', 'higher_proxy'][least((row_number() OVER (ORDER BY severity_proxy, speaker_id) - 1) * 3 // count(*) OVER (), 2) + 1] AS severity_bucket FROM stats
), keyed AS (
    SELECT *, CASE WHEN actual_severity = 'unknown' THEN severity_bucket ELSE actual_severity END AS severity_key, category_code AS category_key FROM binned
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY severity_key, category_key ORDER BY md5('42:' || speaker_id), speaker_id) - 1 AS place, count(*) OVER (PARTITION BY severity_key, category_key) AS n FROM keyed
), sized AS (
    SELECT *, CASE WHEN n >= 3 THEN greatest(1, round_even(n * 0.1::DOUBLE, 0)) ELSE round_even(n * 0.1::DOUBLE, 0) END::BIGINT AS d FROM placed
), split AS (
    SELECT * EXCLUDE (place, n, d), CASE WHEN place < n - 2 * d THEN 'train' WHEN place < n - d THEN 'dev' ELSE 'test' END AS split FROM sized
)"""


@query(f"WITH {SPLIT} SELECT * FROM split")
def speaker_split(spark, sf_dir):
    return split.build_split(filtered(spark, sf_dir))


@query(f"WITH {SEG} SELECT source_audio_path, speaker_id, score, duration_sec, coverage, text FROM ok")
def segment_filter(spark, sf_dir):
    return filtered(spark, sf_dir).select("source_audio_path", "speaker_id", "score", "duration_sec", "coverage", "text")


QUALITY = f"""{SEG}, own AS (
    SELECT source_audio_path, count(*) AS segment_count, SR(avg(score), 4) AS avg_score, SR(median(score), 4) AS median_score, SR(max(score), 4) AS max_score, SR(min(score), 4) AS min_score,
        SR(sum(duration_sec), 3) AS usable_duration_sec FROM @ok GROUP BY source_audio_path
), quality AS (
    SELECT own.*, SR(coalesce(coverage_ratio, 0), 4) AS coverage_ratio, coalesce(whisper_segment_count, 0) AS whisper_segment_count, coalesce(matched_whisper_segments, 0) AS matched_whisper_segments,
        SR(coalesce(matched_whisper_segments::DOUBLE / nullif(whisper_segment_count, 0), 0), 4) AS matched_whisper_ratio
    FROM own LEFT JOIN rep USING (source_audio_path)
), strict AS (
    SELECT seg.*, coverage_ratio AS coverage FROM seg JOIN rep USING (source_audio_path) WHERE score >= 0.6 AND duration_sec BETWEEN 2 AND 20 AND coverage_ratio >= 0.7
), good AS (SELECT * FROM quality WHERE segment_count >= 3 AND avg_score >= 0.55 AND coverage_ratio >= 0.7 AND matched_whisper_ratio >= 0.6)"""
# ``strict`` comes before its use where the gate needs it
STRICT_CTE = QUALITY[QUALITY.index(", strict AS (") : QUALITY.index(", good AS (")]
GATE = QUALITY.replace(STRICT_CTE, "").replace(", own AS (", STRICT_CTE + ", own AS (", 1).replace("@ok", "strict")


@query(f"WITH {QUALITY.replace('@ok', 'ok')} SELECT * FROM quality")
def file_quality(spark, sf_dir):
    return quality.file_quality(filtered(spark, sf_dir), fx.report(spark, sf_dir))


@query(f"WITH {GATE} SELECT source_audio_path, speaker_id, score, duration_sec, text FROM strict WHERE source_audio_path IN (SELECT source_audio_path FROM good)")
def source_file_gate(spark, sf_dir):
    rows = filtered(spark, sf_dir, STRICT)
    kept = quality.gate_files(rows, quality.file_quality(rows, fx.report(spark, sf_dir)), STRICT)
    return kept.select("source_audio_path", "speaker_id", "score", "duration_sec", "text")


@query(f"WITH {GATE} SELECT source_audio_path, segment_count, avg_score FROM quality WHERE source_audio_path NOT IN (SELECT source_audio_path FROM good)")
def dropped_files(spark, sf_dir):
    rows = filtered(spark, sf_dir, STRICT)
    return quality.dropped_files(quality.file_quality(rows, fx.report(spark, sf_dir)), STRICT).select("source_audio_path", "segment_count", "avg_score")


@query(f"WITH {GATE} SELECT source_audio_path, avg_score FROM quality WHERE source_audio_path NOT IN (SELECT source_audio_path FROM good) ORDER BY source_audio_path LIMIT 10")
def dropped_examples(spark, sf_dir):
    return dropped_files(spark, sf_dir).select("source_audio_path", "avg_score").orderBy("source_audio_path").limit(10)


@query(f"WITH {STATS} SELECT * FROM stats")
def speaker_stats(spark, sf_dir):
    return split.speaker_stats(filtered(spark, sf_dir))


@query(f"WITH {STATS} SELECT speaker_id, actual_severity FROM stats")
def severity_mode(spark, sf_dir):
    return split.speaker_stats(filtered(spark, sf_dir)).select("speaker_id", "actual_severity")


_BINS = "least(({p}) * {k} // n, {k} - 1) + 1"


@query(f"""WITH {STATS}, p AS (SELECT speaker_id, row_number() OVER (ORDER BY severity_proxy, speaker_id) - 1 AS p, count(*) OVER () AS n FROM stats)
SELECT speaker_id, 'all' AS bins_1, ['lower_proxy', 'higher_proxy'][{_BINS.format(p='p', k=2)}] AS bins_2, ['lower_proxy', 'mid_proxy', 'higher_proxy'][{_BINS.format(p='p', k=3)}] AS bins_3,
    format('bin_{{:02d}}', {_BINS.format(p='p', k=4)} - 1) AS bins_4, format('bin_{{:02d}}', {_BINS.format(p='p', k=5)} - 1) AS bins_5 FROM p""")
def severity_bins_k(spark, sf_dir):
    rows = split.speaker_stats(filtered(spark, sf_dir)).select("speaker_id", "severity_proxy")
    placed = split.with_position(rows, ["severity_proxy", "speaker_id"], "at", "n")
    label = lambda k: split.bin_label(split.bin_index(F.col("at"), F.col("n"), k), k).alias(f"bins_{k}")
    return placed.select("speaker_id", *map(label, range(1, 6)))


@query("""SELECT n, n - 2 * d AS n_train, d AS n_dev, d AS n_test FROM (
    SELECT range AS n, CASE WHEN range >= 3 THEN greatest(1, round_even(range * 0.1::DOUBLE, 0)) ELSE round_even(range * 0.1::DOUBLE, 0) END::BIGINT AS d FROM range(61))""")
def split_counts(spark, sf_dir):
    train, dev, test = split.split_counts(F.col("id"))
    return spark.range(61).select(F.col("id").alias("n"), train.alias("n_train"), dev.alias("n_dev"), test.alias("n_test"))


@query(f"""WITH {SPLIT} SELECT split, count(*) AS n_rows, count(DISTINCT speaker_id) AS n_speakers, SR(sum(duration_sec) / 3600, 3) AS total_hours
FROM ok JOIN split USING (speaker_id) GROUP BY split""")
def split_summary(spark, sf_dir):
    rows = filtered(spark, sf_dir)
    return split.split_summary(split.training_rows(rows, split.build_split(rows)))


@query(f"WITH {SEG} SELECT count(*) AS files, sum(whisper_segment_count)::BIGINT AS whisper_segment_count, sum(matched_whisper_segments)::BIGINT AS matched_whisper_segments, round(avg(coverage_ratio), 6) AS mean_coverage FROM rep")
def report_summary(spark, sf_dir):
    return align.report_summary(fx.report(spark, sf_dir))


@query(f"""WITH {GATE}, kept AS (SELECT * FROM strict WHERE source_audio_path IN (SELECT source_audio_path FROM good))
SELECT count(*) AS n_rows, count(DISTINCT speaker_id) AS n_speakers, SR(sum(duration_sec) / 3600, 3) AS total_hours, (SELECT count(*) FROM quality) AS quality_files,
    (SELECT count(*) FROM quality WHERE source_audio_path NOT IN (SELECT source_audio_path FROM good)) AS dropped_files FROM kept""")
def global_summary(spark, sf_dir):
    rows = filtered(spark, sf_dir, STRICT)
    q = quality.file_quality(rows, fx.report(spark, sf_dir))
    return split.global_summary(quality.gate_files(rows, q, STRICT), q, quality.dropped_files(q, STRICT))


@query(f"""WITH {SPLIT} SELECT source_audio_path, manifest_index, speaker_id, split, severity_proxy, severity_bucket, CASE WHEN actual_severity = 'unknown' THEN severity_bucket ELSE actual_severity END AS resolved_severity
FROM ok JOIN split USING (speaker_id)""")
def training_rows(spark, sf_dir):
    # numbered once, for the statistics as for the rows; texts aren't used
    numbered = fx.numbered(spark, sf_dir, "source_audio_path", "speaker_id", "category_code", "severity_label", "score", "duration_sec", "ord")
    rows = quality.filter_segments(numbered, fx.report(spark, sf_dir))
    return split.training_rows(rows, split.build_split(rows)).select("source_audio_path", "manifest_index", "speaker_id", "split", "severity_proxy", "severity_bucket", "resolved_severity")


@query(f"""WITH {SPLIT}, j AS (SELECT split, category_code AS c, CASE WHEN actual_severity = 'unknown' THEN severity_bucket ELSE actual_severity END AS s FROM (SELECT speaker_id, category_code FROM ok) JOIN (SELECT * EXCLUDE (category_code) FROM split) USING (speaker_id))
SELECT split, 'category' AS kind, c AS value, count(*) AS n FROM j GROUP BY ALL UNION ALL SELECT split, 'severity', s, count(*) FROM j GROUP BY ALL""")
def split_histograms(spark, sf_dir):
    rows = filtered(spark, sf_dir)
    rows = split.training_rows(rows, split.build_split(rows)).select("split", "category_code", "resolved_severity")
    sets = rows.groupingSets([["split", "category_code"], ["split", "resolved_severity"]], "split", "category_code", "resolved_severity").agg(F.count("*").alias("n"), F.grouping("category_code").alias("g"))
    return sets.select("split", F.when(F.col("g") == 0, "category").otherwise("severity").alias("kind"), F.when(F.col("g") == 0, F.col("category_code")).otherwise(F.col("resolved_severity")).alias("value"), "n")


@query(f"""WITH {SEG} SELECT 'source_split' AS kind, source_split AS value, count(*) AS n FROM seg GROUP BY ALL UNION ALL SELECT 'category_code', category_code, count(*) FROM seg GROUP BY ALL
UNION ALL SELECT 'severity_label', severity_label, count(*) FROM seg GROUP BY ALL""")
def manifest_counts(spark, sf_dir):
    return manifest.manifest_counts(fx.segments(spark, sf_dir))


@query(f"WITH {SEG} SELECT count(*) FILTER (duration_sec > 30) AS over_30, count(*) FILTER (duration_sec > 300) AS over_300 FROM seg")
def duration_buckets(spark, sf_dir):
    return manifest.duration_buckets(fx.segments(spark, sf_dir))


@query(f"""WITH {SEG} SELECT category_code, example_rank, source_audio_path FROM (
    SELECT category_code, row_number() OVER (PARTITION BY category_code ORDER BY manifest_index) AS example_rank, source_audio_path FROM seg WHERE duration_sec > 30) WHERE example_rank <= 20""")
def capped_examples(spark, sf_dir):
    rows = fx.segments(spark, sf_dir).where("duration_sec > 30")
    return manifest.capped_examples(rows, "category_code", ["ord"], "source_audio_path")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 500 OFFSET 100")
def choose_records(spark, sf_dir):
    return nbest.choose_records(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"], 500, 100)


@query(f"WITH {SEG} SELECT manifest_index, source_audio_path, text FROM seg WHERE manifest_index < 40000 AND manifest_index >= 100 AND manifest_index < 30000 AND (manifest_index - 100) % 4 = 1")
def select_rows_chain(spark, sf_dir):
    rows = fx.indexed(fx.segments(spark, sf_dir))
    return nbest.select_rows(rows, limit=40000, start=100, end=30000, shards=4, shard=1).select("manifest_index", "source_audio_path", "text")


@query(f"WITH {SEG} SELECT manifest_index, score FROM seg")
def shard_union(spark, sf_dir):
    rows = fx.indexed(fx.segments(spark, sf_dir)).select("manifest_index", "score")
    return nbest.merge_shards([nbest.select_rows(rows, shards=4, shard=k) for k in range(4)])


@query(f"WITH {SEG} SELECT manifest_index, text FROM seg WHERE score >= 0.35")
def resume_antijoin(spark, sf_dir):
    rows = fx.indexed(fx.segments(spark, sf_dir))
    return nbest.not_done(rows, rows.where("score < 0.35")).select("manifest_index", "text")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)")
def source_semijoin(spark, sf_dir):
    labels = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.col("o_orderkey").alias("audio_path"))
    return manifest.with_audio(labels, table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("path")))[0].select("o_orderkey", "o_custkey")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def missing_audio(spark, sf_dir):
    labels = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderkey").alias("audio_path"))
    return manifest.with_audio(labels, table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("path")))[1].select("o_orderkey")


# --- metrics -------------------------------------------------------------------------------------------------------
@query(f"WITH {TURNS}, t AS (SELECT {PLAIN('ref')} AS r, {PLAIN('hyp')} AS h FROM turns) SELECT sum(levenshtein(r, h))::BIGINT AS edits, sum(length(r))::BIGINT AS ref_chars, round(sum(levenshtein(r, h))::DOUBLE / sum(length(r)), 9) AS cer FROM t")
def cer_corpus(spark, sf_dir):
    pairs = fx.turns(spark, sf_dir).select(tx.match_text(F.col("ref")).alias("r"), tx.match_text(F.col("hyp")).alias("h"))
    return metrics.corpus_cer(pairs, "r", "h")


@query(f"""WITH RECURSIVE {TURNS}, t AS (SELECT row_number() OVER () AS id, {WORDS_OF('ref')} AS r, {WORDS_OF('hyp')} AS h FROM turns), dp AS (
    SELECT id, r, h, 0 AS i, range(0, len(h) + 1) AS row FROM t
    UNION ALL
    SELECT id, r, h, i + 1, list_transform(range(1, len(tmp) + 1), lambda j: j - 1 + list_min(list_transform(list_slice(tmp, 1, j), lambda x, k: x - k + 1)))
    FROM (SELECT id, r, h, i, list_concat([i + 1], list_transform(range(1, len(h) + 1), lambda j: least(row[j + 1] + 1, row[j] + CASE WHEN r[i + 1] = h[j] THEN 0 ELSE 1 END))) AS tmp FROM dp WHERE i < len(r))
), e AS (SELECT sum(row[len(row)])::BIGINT AS edits, sum(len(r))::BIGINT AS ref_words FROM dp WHERE i = len(r)) SELECT edits, ref_words, round(edits::DOUBLE / ref_words, 9) AS wer FROM e""")
def wer_corpus(spark, sf_dir):
    return metrics.corpus_wer(fx.turns(spark, sf_dir), "ref", "hyp")


@query(f"""WITH {TURNS}, t AS (SELECT conv_id, turn, {NORM('ref')} AS r, {NORM('hyp')} AS h, {PLAIN('ref')} AS rp, {PLAIN('hyp')} AS hp, length(hyp) / 8.0::DOUBLE AS d FROM turns), n AS (
    SELECT *, greatest(1, len(list_filter(string_split(h, ' '), lambda w: w <> ''))) AS a, greatest(1, len(list_filter(string_split(r, ' '), lambda w: w <> ''))) AS b, greatest(1, length(hp)) AS ca, greatest(1, length(rp)) AS cb FROM t)
SELECT conv_id, turn, round(1 - least(abs(a - b)::DOUBLE / b, 1), 9) AS by_words, round(1 - least(abs(ca - cb)::DOUBLE / cb, 1), 9) AS by_chars,
    round(1 - least(abs(d - cb / 7.0::DOUBLE) / greatest(cb / 7.0::DOUBLE, 1), 1), 9) AS by_duration FROM n""")
def length_scores(spark, sf_dir):
    words, chars, lasting = tx.length_scores(F.col("hyp"), F.col("ref"), F.length("hyp") / 8.0)
    return fx.turns(spark, sf_dir).select("conv_id", "turn", F.round(words, 9).alias("by_words"), F.round(chars, 9).alias("by_chars"), F.round(lasting, 9).alias("by_duration"))


@query()
def seq_ratio(spark, sf_dir):
    return fx.turns(spark, sf_dir).select("conv_id", "turn", udfs.seq_ratio("hyp", "ref").alias("ratio"))


@query()
def group_match_score(spark, sf_dir):
    words = F.size(tx.words_of(F.col("hyp")))
    return fx.turns(spark, sf_dir).select("conv_id", "turn", udfs.group_match_score("hyp", words, F.length("hyp") / 8.0, "ref").alias("group_score"))


def _alignment(spark, sf_dir):
    """Conversations as files: the user's turns are what was recognised, the others' sentences the transcript."""
    rows = table(spark, sf_dir, "conversations").withColumn("path", F.col("conv_id").cast("string"))
    heard = rows.where("role = 'user'").select(
        F.col("path").alias("source_audio_path"), F.col("turn").cast("int").alias("chunk_index"), (F.col("turn") * 10.0).alias("start_sec"), (F.col("turn") * 10.0 + 8).alias("end_sec"), "text",
        F.transform(tx.words_of(F.col("text")), lambda w, i: F.struct((F.col("turn") * 10 + i * 0.3).alias("start"), (F.col("turn") * 10 + i * 0.3 + 0.2).alias("end"), w.alias("text"))).alias("words"),
    )
    said = rows.where("role <> 'user'").groupBy(F.col("path").alias("source_audio_path")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"]), " ").alias("t"))
    return align.align(heard, said.select("source_audio_path", tx.split_sentences(F.col("t")).alias("sentences")))


@query()
def aligned_segments(spark, sf_dir):
    return _alignment(spark, sf_dir)[0]


@query()
def align_steps(spark, sf_dir):
    return _alignment(spark, sf_dir)[1]


# --- text ----------------------------------------------------------------------------------------------------------
@query(f"SELECT doc_id, {NORM('text')} AS normal FROM documents")
def text_normalize(spark, sf_dir):
    return fx.texts(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", tx.normalize_text(F.col("text")).alias("normal"))


@query(f"SELECT doc_id, {NORM('regexp_replace(lower(nfc_normalize(' + NORM('text') + ')), $$[\\p{P}\\p{S}\\p{C}]$$, $$$$, $$g$$)')} AS normal FROM documents")
def asr_normalize(spark, sf_dir):
    return fx.texts(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", udfs.asr_normalize("text").alias("normal"))


_SYLLABLES = "SELECT range AS id, chr((44032 + (range * 37) % 11172)::INT) || chr((44032 + (range * 91 + 5) % 11172)::INT) || ' Ab' AS s FROM range(12000)"


@query(f"WITH t AS ({_SYLLABLES}) SELECT id, s, {ROMAN('s')} AS roman FROM t")
def hangul_romanize(spark, sf_dir):
    c = lambda x: F.decode(F.unhex(F.hex((F.lit(44032) + x % 11172).cast("bigint"))), "UTF-16BE")
    rows = spark.range(12000).select("id", F.concat(c(F.col("id") * 37), c(F.col("id") * 91 + 5), F.lit(" Ab")).alias("s"))
    return rows.select("id", "s", tx.romanize_hangul(F.col("s")).alias("roman"))


@query(f"""WITH {TURNS}, t AS (SELECT conv_id, turn, list_filter(string_split({PLAIN('hyp')}, ' '), lambda w: w <> '') AS h, list_distinct(list_filter(string_split({PLAIN('ref')}, ' '), lambda w: w <> '')) AS r FROM turns)
SELECT conv_id, turn, len(r)::BIGINT AS ref_tokens, round(CASE WHEN len(r) > 0 THEN len(list_filter(r, lambda w: list_contains(h, w)))::DOUBLE / len(r) ELSE 0 END, 9) AS overlap FROM t""")
def match_tokens(spark, sf_dir):
    h, r = tx.match_tokens(F.col("hyp")), tx.match_tokens(F.col("ref"))
    return fx.turns(spark, sf_dir).select("conv_id", "turn", F.size(F.array_distinct(r)).cast("bigint").alias("ref_tokens"), F.round(tx.token_overlap(h, r), 9).alias("overlap"))


@query(f"WITH s AS (SELECT doc_id, {SENTENCES('text')} AS s FROM documents) SELECT doc_id, unnest(range(len(s))) AS pos, unnest(s) AS sentence FROM s")
def split_sentences(spark, sf_dir):
    rows = fx.texts(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", F.posexplode(tx.split_sentences(F.col("text"))).alias("pos", "sentence"))
    return rows.select("doc_id", F.col("pos").cast("bigint").alias("pos"), "sentence")


_LINES = f"SELECT doc_id, i, {NORM('line')} AS line FROM (SELECT doc_id, unnest(range(len(l))) AS i, unnest(l) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))"


@query(f"""WITH l AS ({_LINES}), d AS (SELECT doc_id, line, min(i) AS f FROM l WHERE line <> '' GROUP BY ALL)
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY f) AS line_rank, line FROM d""")
def order_preserving_dedupe(spark, sf_dir):
    rows = fx.texts(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", F.posexplode(tx_distinct_lines()).alias("pos", "c"))
    return rows.select("doc_id", F.col("c.rank").cast("bigint").alias("line_rank"), F.col("c.text").alias("line"))


def tx_distinct_lines():
    return nbest.distinct_candidates(F.split("text", "\n"))


@query(f"""WITH c AS (SELECT conv_id, {NORM('text')} AS text, min(turn) AS f FROM conversations GROUP BY ALL), r AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY f, text) AS candidate_rank, text FROM c WHERE text <> '') SELECT * FROM r WHERE candidate_rank <= 5""")
def topk_candidates(spark, sf_dir):
    return nbest.top_candidates(table(spark, sf_dir, "conversations"), "conv_id", "turn", "text", 5)


# --- JSON, paths and names -----------------------------------------------------------------------------------------
_DOC = "'{\"a\": {\"b\": \"' || CASE WHEN event_id % 3 = 0 THEN ' ' ELSE event_type END || '\"}, \"c\": ' || event_id || '}'"


@query(f"""WITH t AS (SELECT event_id, {_DOC} AS doc FROM events), v AS (SELECT event_id, {NORM("doc->>'$.x.y'")} AS v1, {NORM("doc->>'$.a.b'")} AS v2, {NORM("doc->>'$.c'")} AS v3 FROM t)
SELECT event_id, CASE WHEN v1 <> '' THEN v1 WHEN v2 <> '' THEN v2 ELSE v3 END AS value, CASE WHEN v1 <> '' THEN 'x.y' WHEN v2 <> '' THEN 'a.b' ELSE 'c' END AS path FROM v""")
def fallback_first_path(spark, sf_dir):
    kind = F.when(F.col("event_id") % 3 == 0, " ").otherwise(F.col("event_type"))
    doc = F.concat(F.lit('{"a": {"b": "'), kind, F.lit('"}, "c": '), F.col("event_id").cast("string"), F.lit("}"))
    rows = table(spark, sf_dir, "events").select("event_id", doc.alias("doc"))
    value, path = tx.first_path(F.col("doc"), ["x.y", "a.b", "c"])
    return rows.select("event_id", value.alias("value"), path.alias("path"))


@query("SELECT event_id, (props->>'$.k')::BIGINT AS k FROM events")
def json_strict_parse(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", tx.get_any_case(F.col("props"), "K").cast("bigint").alias("k"))


_CATEGORY = "CASE WHEN p_partkey % 5 = 0 THEN p_name ELSE p_brand || ' . ' || p_name || '.x' END"


@query(f"WITH t AS (SELECT p_partkey, {_CATEGORY} AS s FROM part) SELECT p_partkey, CASE WHEN contains(s, '.') THEN trim(string_split(s, '.')[1]) ELSE s END AS code, CASE WHEN contains(s, '.') THEN trim(substr(s, instr(s, '.') + 1)) ELSE s END AS name FROM t")
def category_split(spark, sf_dir):
    rows = table(spark, sf_dir, "part")
    s = F.when(F.col("p_partkey") % 5 == 0, F.col("p_name")).otherwise(F.concat("p_brand", F.lit(" . "), "p_name", F.lit(".x")))
    code, name = tx.category(F.col("s"))
    return rows.select("p_partkey", s.alias("s")).select("p_partkey", code.alias("code"), name.alias("name"))


_STEM = "CASE c_custkey % 4 WHEN 0 THEN 'a-b-c' WHEN 1 THEN 'a-b-c-d-S' || c_custkey WHEN 2 THEN 'a-b-c-d-S' || c_custkey || '-e-f-M--N' ELSE 'a-b-c-d-S' || c_custkey || '-e-f-M-' || c_nationkey || '-N' END"
_LABEL = "CASE WHEN c_custkey % 3 = 0 THEN '{\"Patient_info\": {\"SpeakerName\": \"' || c_name || '\", \"Sex\": \" \"}}' ELSE '{}' END"


@query(f"""WITH t AS (SELECT c_custkey, {_STEM} AS stem, CASE WHEN c_custkey % 3 = 0 THEN c_name ELSE '' END AS given FROM customer), p AS (SELECT *, string_split(stem, '-') AS p FROM t), v AS (
    SELECT c_custkey, CASE WHEN given <> '' THEN {NORM('given')} WHEN len(p) > 4 THEN p[5] ELSE stem END AS speaker_code, coalesce(p[8], '') AS sex, coalesce(p[9], '') AS age, coalesce(p[10], '') AS area FROM p)
SELECT *, array_to_string(list_filter([speaker_code, sex, age, area], lambda x: x <> ''), '-') AS speaker_id FROM v""")
def speaker_meta_parse(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.expr(_STEM).alias("stem"), F.expr(_LABEL).alias("doc"))
    return rows.select("c_custkey", *(c.alias(n) for n, c in tx.speaker_meta(F.col("doc"), F.col("stem")).items()))


@query("""SELECT page_id, regexp_replace('/data/1.x/원천데이터/' || substr(p, instr(p, '/') + 1), '([^/])\\.[^./]*$', '\\1') || '.wav' AS audio_path
FROM (SELECT page_id, regexp_extract(url, '://[^/]*/([^?#]*)', 1) || '/01.name/' || page_id || '.tar.json' AS q, 'TL/' || regexp_replace(q, '/+', '/', 'g') AS p FROM pages)""")
def audio_path_rewrite(spark, sf_dir):
    tail = F.regexp_replace(F.concat(F.regexp_extract("url", "://[^/]*/([^?#]*)", 1), F.lit("/01.name/"), F.col("page_id").cast("string"), F.lit(".tar.json")), "/+", "/")
    rows = table(spark, sf_dir, "pages").select("page_id", F.concat(F.lit("/data/1.x/라벨링데이터_TL/"), tail).alias("p"))
    return rows.select("page_id", tx.audio_path(F.col("p"), manifest.LABEL_PREFIX, "원천데이터").alias("audio_path"))


# --- extraction ----------------------------------------------------------------------------------------------------
PADDED = f"""{SEG}, tot AS (SELECT source_audio_path, floor(sum(duration_sec) * 16000)::BIGINT AS total_samples FROM seg GROUP BY ALL), pad AS (
    SELECT *, greatest(lo + 0.05::DOUBLE, end_sec + 0.15::DOUBLE) AS hi FROM (SELECT *, greatest(0, start_sec - 0.15::DOUBLE) AS lo FROM timed JOIN tot USING (source_audio_path))
), cut AS (SELECT *, greatest(0, floor(lo * 16000))::BIGINT AS a, least(total_samples, ceil(hi * 16000)::BIGINT) AS b FROM pad)"""


def _totals(rows):
    return rows.groupBy("source_audio_path").agg(F.floor(stable_round(F.sum("duration_sec"), 6) * 16000).alias("total_samples"))


@query(f"WITH {PADDED.replace('floor(sum(duration_sec) * 16000)', 'floor(SR(sum(duration_sec), 6) * 16000)')} SELECT manifest_index, round(lo, 6) AS lo, round(hi, 6) AS hi, a AS start_sample, b AS end_sample, greatest(0, trunc(start_sec * 16000))::BIGINT AS start_frame, least(total_samples, trunc(end_sec * 16000)::BIGINT) AS end_frame FROM cut")
def pad_and_frames(spark, sf_dir):
    rows = fx.timed(fx.indexed(fx.segments(spark, sf_dir)))
    lo, hi = extract.padded_range(F.col("start_sec"), F.col("end_sec"))
    rows = rows.join(_totals(rows), "source_audio_path").withColumns({"lo": lo, "hi": hi})
    a, b = extract.sample_range(F.col("lo"), F.col("hi"), F.col("total_samples"), 16000)
    f, g = extract.frame_range(F.col("start_sec"), F.col("end_sec"), F.lit(16000), F.col("total_samples"))
    return rows.select("manifest_index", F.round("lo", 6).alias("lo"), F.round("hi", 6).alias("hi"), a.alias("start_sample"), b.alias("end_sample"), f.alias("start_frame"), g.alias("end_frame"))


@query(f"WITH {SEG} SELECT manifest_index, format('audio/{{:03d}}/{{:08d}}_', manifest_index % 256, manifest_index) || replace('s/' || speaker_id, '/', '_') || '.flac' AS path FROM seg")
def shard_path(spark, sf_dir):
    rows = fx.indexed(fx.segments(spark, sf_dir))
    return rows.select("manifest_index", tx.shard_path(F.col("manifest_index"), F.concat(F.lit("s/"), F.col("speaker_id").cast("string"))).alias("path"))


@query("SELECT event_id, format('{:02d}:{:02d}:{:02d}', s // 3600, (s % 3600) // 60, s % 60) AS eta FROM (SELECT event_id, greatest(0, floor(value * 40 - 100))::BIGINT AS s FROM events)")
def eta_format(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", tx.clock(F.col("value") * 40 - 100).alias("eta"))


@query(f"WITH {PADDED.replace('floor(sum(duration_sec) * 16000)', 'floor(SR(sum(duration_sec), 6) * 4000)').replace('FROM seg GROUP BY ALL)', 'FROM seg WHERE score >= 0.1 GROUP BY ALL)').replace('FROM timed JOIN tot', 'FROM timed LEFT JOIN tot')} SELECT count(*) FILTER (total_samples IS NOT NULL AND b > a) AS ok_rows, count(*) FILTER (total_samples IS NULL OR b <= a) AS error_rows FROM cut")
def extract_ok_err(spark, sf_dir):
    rows = fx.timed(fx.indexed(fx.segments(spark, sf_dir)))
    known = rows.where("score >= 0.1").groupBy("source_audio_path").agg(F.floor(stable_round(F.sum("duration_sec"), 6) * 4000).alias("total_samples"))
    return extract.outcome_counts(extract.extraction_plan(rows, known))


# --- time ----------------------------------------------------------------------------------------------------------
@query(f"""WITH {WORDS}, w AS (SELECT user_id, event_id AS id, start, "end" FROM words), s AS (SELECT user_id, event_id AS id, start + 1800 AS start, start + 5400 AS "end" FROM words)
SELECT w.user_id, w.id AS l_id, s.id AS r_id FROM w JOIN s ON w.user_id = s.user_id AND w."end" > s.start AND w.start < s."end\"""")
def interval_overlap(spark, sf_dir):
    words = fx.event_words(spark, sf_dir).withColumnRenamed("event_id", "id")
    ranges = words.select("user_id", "id", (F.col("start") + 1800).alias("start"), (F.col("start") + 5400).alias("end"))
    return align.interval_join(words.select("user_id", "id", "start", "end"), ranges, "user_id", 3600.0)


@query(f"""WITH s AS (SELECT doc_id, {SENTENCES('text')} AS s FROM documents), u AS (SELECT doc_id, unnest(range(len(s))) AS pos, unnest(s) AS sentence FROM s),
w AS (SELECT doc_id, pos, sentence, greatest(1, length({PLAIN('sentence')}))::DOUBLE AS w FROM u), c AS (SELECT *, sum(w) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS c, sum(w) OVER (PARTITION BY doc_id) AS t FROM w)
SELECT doc_id, pos, round(2.0::DOUBLE + 60 * (c - w) / t, 6) AS sub_start, round(CASE WHEN c = t THEN 62 ELSE 2.0::DOUBLE + 60 * c / t END, 6) AS sub_end FROM c""")
def time_split(spark, sf_dir):
    rows = fx.texts(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", F.posexplode(tx.split_sentences(F.col("text"))).alias("pos", "sentence"), F.lit(2.0).alias("s"), F.lit(62.0).alias("e"))
    out = align.share_time(rows, ["doc_id"], "pos", "s", "e", "sentence")
    return out.select("doc_id", F.col("pos").cast("bigint").alias("pos"), F.round("sub_start", 6).alias("sub_start"), F.round("sub_end", 6).alias("sub_end"))


@query(f"""WITH {WORDS} SELECT event_id, round(greatest(0, lead(start) OVER w - "end"), 6) AS gap FROM words WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""".replace("greatest(0, lead(start) OVER w - \"end\")", "CASE WHEN lead(start) OVER w IS NOT NULL THEN greatest(0, lead(start) OVER w - \"end\") END"))
def pause_gap(spark, sf_dir):
    rows = align.pause_gaps(fx.event_words(spark, sf_dir), "user_id", ["ts", "event_id"])
    return rows.select("event_id", F.round("gap", 6).alias("gap"))


@query("SELECT event_id, (row_number() OVER (ORDER BY ts, event_id) - 1) // 192 AS batch_id FROM events")
def batch_ids(spark, sf_dir):
    return nbest.batch_ids(table(spark, sf_dir, "events").select("event_id", "ts"), ["ts", "event_id"], 192).select("event_id", "batch_id")


# --- generated records ---------------------------------------------------------------------------------------------
_BODY = "replace(replace(text, '\"', ''''), chr(10), ' ')"
_GENERATED = {
    0: "'{\"Instruction\": \"write it down\", \"input\": \"' || @b || '\", \"cc\": \"pain here\", \"pi\": \"since May\", \"A&P\": \"rest\"}'",
    1: "'{\"instruction\": \"write it down\", \"input\": \"' || @b || '\", \"output\": \"CC: a' || chr(92) || 'nPI: b' || chr(92) || 'nA&P: c\"}'",
    2: "'{\"instruction\": \"write it down\", \"input\": \"' || @b || '\", \"status\": \"ok\", \"cc\": \"a\", \"pi\": \"b\", \"ap\": \"c\"}'",
    3: "'{\"instruction\": \"write it down\", \"input\": \"' || @b || '\", \"cc\": \"a\"}'",
    4: "'SKIP: ' || @b",
    5: "'no object in here: ' || @b",
    6: "'Sure. ```json' || chr(10) || '{\"instruction\": \"write it down\", \"input\": \"' || @b || '\", \"cc\": \"a\", \"pi\": \"b\", \"ap\": \"c\"}' || chr(10) || '``` Done {\"x\":'",
}
_CASES = "CASE doc_id % 7 " + " ".join(f"WHEN {k} THEN {v}" for k, v in _GENERATED.items()) + " END"


def _generated(spark, sf_dir):
    body = F.replace(F.replace(F.col("text"), F.lit('"'), F.lit("'")), F.lit("\n"), F.lit(" "))
    rows = fx.texts(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", body.alias("b"))
    return rows.select("doc_id", F.expr(_CASES.replace("@b", "b").replace("chr(", "char(").replace("'''", "\\''")).alias("generated_text"))


_STATUS = f"CASE WHEN doc_id % 7 IN (0, 1, 6) THEN CASE WHEN length(trim({_BODY})) >= 5 THEN 'valid' ELSE 'validation_failed' END WHEN doc_id % 7 IN (2, 3) THEN 'validation_failed' WHEN doc_id % 7 = 4 THEN 'skip' ELSE 'json_parse_failed' END"


@query(f"SELECT doc_id, CASE WHEN doc_id % 7 IN (0, 1) THEN length(trim({_BODY})) >= 5 ELSE false END AS valid FROM documents")
def llm_validity(spark, sf_dir):
    return _generated(spark, sf_dir).select("doc_id", augment.valid_strict(F.col("generated_text")).alias("valid"))


@query(f"SELECT {_STATUS} AS status, count(*) AS n FROM documents GROUP BY ALL")
def status_counts(spark, sf_dir):
    return augment.status_counts(augment.classify(_generated(spark, sf_dir)))


@query(f"SELECT doc_id, {_STATUS} AS status FROM documents")
def json_salvage(spark, sf_dir):
    return augment.classify(_generated(spark, sf_dir)).select("doc_id", "status")


@query(f"SELECT 'write it down' AS instruction, CASE WHEN doc_id % 7 = 0 THEN '' ELSE '' END || {_BODY} AS input, CASE doc_id % 7 WHEN 0 THEN 'CC: pain here' || chr(10) || 'PI: since May' || chr(10) || 'A&P: rest' ELSE 'CC: a' || chr(10) || 'PI: b' || chr(10) || 'A&P: c' END AS output FROM documents WHERE {_STATUS} = 'valid'")
def accepted_records(spark, sf_dir):
    return augment.accepted(augment.classify(_generated(spark, sf_dir)))


@query(f"SELECT {_STATUS} AS reason, count(*) AS n FROM documents WHERE {_STATUS} <> 'valid' GROUP BY ALL")
def invalid_log(spark, sf_dir):
    return augment.rejected(augment.classify(_generated(spark, sf_dir))).groupBy("reason").agg(F.count("*").alias("n"))


@query("""SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'mild' WHEN 1 THEN 'L' || c_nationkey WHEN 2 THEN c_mktsegment ELSE 'unknown' END AS severity_label,
    CASE c_custkey % 4 WHEN 0 THEN 'Patient_info.Severity' WHEN 1 THEN 'x.y[1].my_level' WHEN 2 THEN '중증도' ELSE 'missing' END AS severity_source FROM customer""")
def recursive_severity(spark, sf_dir):
    shapes = F.expr("""CASE c_custkey % 4 WHEN 0 THEN '{"Patient_info": {"Severity": " mild "}, "Grade": "x"}'
        WHEN 1 THEN concat('{"x": {"y": [{"a": 1}, {"my_level": "L', c_nationkey, '"}]}, "grade": "late"}')
        WHEN 2 THEN concat('{"b": {"Level": ""}, "중증도": "', c_mktsegment, '"}') ELSE '{"a": [1, 2], "b": null}' END""")
    value, path = manifest.severity(F.col("doc"))
    rows = table(spark, sf_dir, "customer").select("c_custkey", shapes.alias("doc"))
    return rows.select("c_custkey", value.alias("severity_label"), path.alias("severity_source"))


@query(f"WITH {TURNS}, t AS (SELECT conv_id, turn, {PLAIN('ref')} AS r, {PLAIN('hyp')} AS h FROM turns) SELECT conv_id, turn, round(levenshtein(r, h)::DOUBLE / nullif(length(r), 0), 9) AS cer FROM t")
def sql_functions(spark, sf_dir):
    """The functions under their SQL names."""
    from corpusloom.functions.sql import register_sql

    register_sql(spark)
    return fx.turns(spark, sf_dir).selectExpr("conv_id", "turn", "round(cer(hangul_romanize(lower(trim(regexp_replace(ref, '[^0-9A-Za-z가-힣]+', ' ')))), hangul_romanize(lower(trim(regexp_replace(hyp, '[^0-9A-Za-z가-힣]+', ' '))))), 9) AS cer")


# --- streams -------------------------------------------------------------------------------------------------------
@query("SELECT event_id, user_id, event_type, upper(event_type) AS kind FROM events")
def stream_append(spark, sf_dir):
    """Run twice on one checkpoint: the second run finds nothing new, and the table has each event once."""
    from corpusloom.streaming.append import append_new

    folder = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    source = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    source.write.parquet(f"{folder}/in")
    for _ in range(2):
        stream = spark.readStream.schema(source.schema).option("maxFilesPerTrigger", 4).parquet(f"{folder}/in")
        append_new(stream, f"{folder}/out", f"{folder}/checkpoint", lambda df: df.withColumn("kind", F.upper("event_type")), "event_id").awaitTermination()
    return spark.read.parquet(f"{folder}/out")


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY ALL")
def stream_windows(spark, sf_dir):
    from corpusloom.streaming.append import windowed_counts

    rows = windowed_counts(table(spark, sf_dir, "events"), "ts", "event_type", "1 hour", "10 minutes")
    return rows.select(F.col("window.start").alias("window_start"), "event_type", "n")


from corpusloom.plans import roundtrips  # noqa: E402, F401
