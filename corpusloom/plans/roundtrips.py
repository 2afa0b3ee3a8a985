"""Queries that write through the sinks and read back through the sources, that plug in models, and alignments whose outcome is known."""

from __future__ import annotations

import io
import json
import uuid
import wave
from dataclasses import asdict

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom import plugins, schemas
from corpusloom.config import PROFILES
from corpusloom.functions import text as tx
from corpusloom.functions import udfs
from corpusloom.functions.text import stable_round
from corpusloom.operators import align, augment, extract, manifest, nbest, quality, split
from corpusloom.plans import fixtures as fx
from corpusloom.plans import registry as rg
from corpusloom.plans.catalog import query
from corpusloom.plans.fixtures import SEG, table
from corpusloom.sources import files, sinks
from corpusloom.storage import evenly, read_bytes, shared_folder, write_bytes


def scratch(spark, name: str) -> str:
    """A new folder in the shared one."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def one_row(spark, **values) -> DataFrame:
    return spark.createDataFrame([tuple(values.values())], list(values))


# --- JSON lines, CSV, summaries ------------------------------------------------------------------------------------
@query(f"WITH {SEG} SELECT manifest_index, source_audio_path, score, duration_sec, text, CASE WHEN manifest_index % 7 = 0 THEN NULL ELSE severity_label END AS severity_label FROM seg")
def jsonl_round_trip(spark, sf_dir):
    """JSON lines sorted over all files, written with nulls and read strictly."""
    rows = fx.numbered(spark, sf_dir, "source_audio_path", "score", "duration_sec", "text", "severity_label")
    rows = rows.select("manifest_index", "source_audio_path", "score", "duration_sec", "text", F.when(F.col("manifest_index") % 7 != 0, F.col("severity_label")).alias("severity_label"))
    sinks.write_jsonl(rows, path := scratch(spark, "jsonl"), ["manifest_index"], compression="gzip")
    return files.read_jsonl(spark, path, rows.schema, strict=True)


def _lines(spark, sf_dir) -> str:
    """Events as JSON lines, blank after each fifth, in files whose names follow their order."""
    rows = table(spark, sf_dir, "events").select("event_id", F.to_json(F.struct("event_id", "event_type")).alias("line"))
    blank = rows.where("event_id % 5 = 4").select("event_id", F.lit(1).alias("place"), F.lit("  ").alias("line"))
    both = rows.select("event_id", F.lit(0).alias("place"), "line").unionByName(blank)
    both.orderBy("event_id", "place").select("line").write.text(path := scratch(spark, "lines"))
    return path


_EVENT = "event_id bigint, event_type string"


@query("SELECT event_id, event_type, event_id + event_id // 5 AS manifest_index FROM events")
def jsonl_physical_index(spark, sf_dir):
    return files.read_indexed(spark, _lines(spark, sf_dir), schemas.table(_EVENT))


@query("SELECT event_id, event_type, event_id AS manifest_index FROM events")
def jsonl_logical_index(spark, sf_dir):
    return files.read_indexed(spark, _lines(spark, sf_dir), schemas.table(_EVENT), count_blank=False)


@query("SELECT count(*) AS n_lines FROM events")
def line_count(spark, sf_dir):
    return one_row(spark, n_lines=files.count_lines(spark, _lines(spark, sf_dir)))


@query(f"WITH {SEG} SELECT manifest_index, text FROM seg")
def shard_outputs(spark, sf_dir):
    """Four shards' outputs, of which a fifth was never written, read as one table."""
    rows, folder = fx.indexed(fx.segments(spark, sf_dir)).select("manifest_index", "text"), scratch(spark, "shards")
    for k in range(4):
        sinks.write_jsonl(nbest.select_rows(rows, shards=4, shard=k), f"{folder}/{k}")
    return files.read_existing(spark, [f"{folder}/{k}" for k in range(5)], rows.schema)


@query(f"WITH {rg.SPLIT} SELECT speaker_id::VARCHAR AS speaker_id, split, severity_bucket, actual_severity, utterances::VARCHAR AS utterances FROM split")
def csv_round_trip(spark, sf_dir):
    """CSV with a fixed header, sorted by speaker."""
    columns = ["speaker_id", "split", "severity_bucket", "actual_severity", "utterances"]
    sinks.write_csv(split.build_split(rg.filtered(spark, sf_dir)), path := scratch(spark, "csv"), columns, ["speaker_id"])
    return spark.read.option("header", True).csv(path).select(*columns)


_KEPT = f"{rg.GATE}, kept AS (SELECT * FROM strict WHERE source_audio_path IN (SELECT source_audio_path FROM good))"


@query(f"WITH {_KEPT} SELECT count(*) AS n_rows, count(DISTINCT speaker_id) AS n_speakers, SR(sum(duration_sec) / 3600, 3) AS total_hours, (SELECT count(*) FROM strict) AS before_gate FROM kept")
def summary_files(spark, sf_dir):
    """A build's summary as JSON, found again beside the second of three manifests, and the same facts from its Markdown."""
    rows = rg.filtered(spark, sf_dir, rg.STRICT)
    q = quality.file_quality(rows, fx.report(spark, sf_dir))
    facts = sinks.summary_of(split.global_summary(quality.gate_files(rows, q, rg.STRICT), q, quality.dropped_files(q, rg.STRICT)))
    folder = scratch(spark, "summary")
    sinks.write_json(f"{folder}/b/summary.json", facts | {"before_gate": rows.count()})
    sinks.write_markdown(f"{folder}/b/summary.md", "Build", facts)
    found = sinks.first_summary(None, f"{folder}/a/train.jsonl", f"{folder}/b/dev.jsonl", f"{folder}/c/test.jsonl")
    said = dict(x[2:].split(": ") for x in read_bytes(f"{folder}/b/summary.md").decode().splitlines() if x.startswith("- "))
    if {k: str(v) for k, v in facts.items()} != said:
        raise ValueError(f"{said} instead of {facts}")
    return one_row(spark, **{k: found[k] for k in ("n_rows", "n_speakers", "total_hours", "before_gate")})


@query(f"WITH c AS (SELECT status, count(*) AS n FROM (SELECT {rg._STATUS} AS status FROM documents) GROUP BY ALL) SELECT sum(n)::BIGINT AS processed_count, coalesce(sum(n) FILTER (status = 'valid'), 0)::BIGINT AS valid_count, coalesce(sum(n) FILTER (status = 'skip'), 0)::BIGINT AS skip_count, coalesce(sum(n) FILTER (status NOT IN ('valid', 'skip')), 0)::BIGINT AS invalid_count FROM c")
def progress_state(spark, sf_dir):
    """Counters saved half-way and at the end, loaded and checked against what was written."""
    counts = sinks.histogram(augment.status_counts(augment.classify(rg._generated(spark, sf_dir))), "status")
    path = f"{scratch(spark, 'progress')}/progress.json"
    done = sinks.load_progress(path)
    for status, n in counts.items():
        done = {k: done[k] + n * (k == "processed_count" or k == ({"valid": "valid", "skip": "skip"}.get(status, "invalid") + "_count")) for k in done}
        sinks.save_progress(path, **done)
    found = sinks.load_progress(path)
    sinks.check_progress(found, counts["valid"], sum(counts.values()))
    return one_row(spark, **found)


@query(f"WITH {SEG} SELECT count(*) AS rows_written_this_run, 'm/large' AS model_name, 'rows.jsonl' AS written, 'rows.meta.json' AS meta_name FROM seg")
def run_metadata(spark, sf_dir):
    folder = scratch(spark, "run")
    rows = fx.segments(spark, sf_dir).select("text")
    sinks.write_jsonl(rows, f"{folder}/rows.jsonl")
    path = sinks.write_run_meta(f"{folder}/rows.jsonl", f"{folder}/manifest.jsonl", "m/large", files.count_lines(spark, f"{folder}/rows.jsonl"))
    meta = json.loads(read_bytes(path))
    last = lambda p: p.rpartition("/")[2]
    return one_row(spark, rows_written_this_run=meta["rows_written_this_run"], model_name=meta["model_name"], written=last(meta["output_path"]), meta_name=last(path))


@query(f"WITH {rg.PADDED.replace('floor(sum(duration_sec) * 16000)', 'floor(SR(sum(duration_sec), 6) * 4000)').replace('FROM seg GROUP BY ALL)', 'FROM seg WHERE score >= 0.1 GROUP BY ALL)').replace('FROM timed JOIN tot', 'FROM timed LEFT JOIN tot')} SELECT manifest_index, total_samples IS NOT NULL AND b > a AS ok, CASE WHEN total_samples IS NULL THEN 'source_missing' WHEN b <= a THEN 'empty_segment' END AS reason FROM cut")
def outcome_manifests(spark, sf_dir):
    """The manifests of an extraction, rows that worked and errors apart, each sorted by number."""
    rows = fx.timed(fx.numbered(spark, sf_dir, "source_audio_path", "speaker_id", "category_code", "severity_label", "score", "duration_sec", "source_split", "text"))
    known = rows.where("score >= 0.1").groupBy("source_audio_path").agg(F.floor(stable_round(F.sum("duration_sec"), 6) * 4000).alias("total_samples"))
    folder = scratch(spark, "outcomes")
    sinks.write_outcomes(extract.extraction_plan(rows, known, in_order=True), f"{folder}/ok", f"{folder}/errors", compression="gzip", ranged=True)
    schema = schemas.table("manifest_index bigint, ok boolean, error string")
    both = files.read_jsonl(spark, f"{folder}/ok", schema).unionByName(files.read_jsonl(spark, f"{folder}/errors", schema))
    return both.select("manifest_index", "ok", F.nullif(F.substring_index("error", ":", 1), F.lit("")).alias("reason"))


@query("SELECT round(sum(floor(l_extendedprice * 1000)) / 1073741824, 3) AS gib FROM lineitem")
def byte_total(spark, sf_dir):
    sizes = table(spark, sf_dir, "lineitem").select(F.floor(F.col("l_extendedprice") * 1000).alias("size_bytes"))
    return one_row(spark, gib=sinks.total_gib(sizes))


@query("""SELECT 's' || user_id AS audio_path, arg_max(value, event_id) AS coverage_ratio FROM events GROUP BY ALL""")
def report_map(spark, sf_dir):
    """A report document in which files come up again and again: the last entry counts."""
    entries = table(spark, sf_dir, "events").select("event_id", F.concat(F.lit("s"), F.col("user_id").cast("string")).alias("audio_path"), F.col("value").alias("coverage_ratio"))
    sinks.write_report(entries, path := f"{scratch(spark, 'report')}/report.json", ["event_id"], ["audio_path", "coverage_ratio"])
    return files.read_report(spark, path, schemas.table("audio_path string, coverage_ratio double"))


# --- audio ---------------------------------------------------------------------------------------------------------
RATE = 8000


def _wav(frames: int, channels: int) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(channels)
        w.setsampwidth(2)
        w.setframerate(RATE)
        w.writeframes(b"\x01\x00" * frames * channels)
    return out.getvalue()


def _recordings(spark, sf_dir) -> str:
    """A WAV file per customer, of 100 frames and more, written by the tasks; the work is in the files, not in the table's bytes."""
    folder = scratch(spark, "wav")
    rows = evenly(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"))

    def run(batches):
        made = set()
        for b in batches:
            for key, nation in zip(b["c_custkey"], b["c_nationkey"]):
                fs, path = files.open_fs(f"{folder}/{int(key) % 16:02d}/{key}.wav")
                if (parent := path.rpartition("/")[0]) not in made:
                    fs.create_dir(parent, recursive=True)
                    made.add(parent)
                with fs.open_output_stream(path) as out:
                    out.write(_wav(100 * (1 + int(key) % 50), 1 + int(nation) % 2))
            yield b[["c_custkey"]]

    rows.mapInPandas(run, "c_custkey bigint").count()
    return folder


@query("SELECT c_custkey || '.wav' AS name, 8000::BIGINT AS sample_rate, 1 + (c_nationkey % 2)::BIGINT AS channels, 2::BIGINT AS sample_width, (1 + c_custkey % 50) / 80.0::DOUBLE AS duration_sec, 44 + 200 * (1 + c_custkey % 50) * (1 + c_nationkey % 2) AS size_bytes FROM customer")
def audio_headers(spark, sf_dir):
    meta = files.read_audio_meta(spark, _recordings(spark, sf_dir))
    return meta.select(F.element_at(F.split("path", "/"), -1).alias("name"), "sample_rate", "channels", "sample_width", "duration_sec", "size_bytes")


@query("SELECT c_custkey || '.wav' AS name, 44 + 200 * (1 + c_custkey % 50) * (1 + c_nationkey % 2) AS size_bytes FROM customer")
def file_listing(spark, sf_dir):
    return files.list_files(spark, _recordings(spark, sf_dir), "*.wav").select(F.element_at(F.split("path", "/"), -1).alias("name"), "size_bytes")


_RANGES = """r AS (
    SELECT c_custkey AS manifest_index, c_custkey % 9 = 0 AS gone, 100 * (1 + c_custkey % 50) AS n, 1 + c_nationkey % 2 AS ch, (c_custkey % 7) / 40.0::DOUBLE AS a, (c_custkey % 7) / 40.0::DOUBLE + (c_custkey % 4) / 20.0::DOUBLE AS b FROM customer
), f AS (SELECT *, least(n, trunc(a * 8000)::BIGINT) AS first, least(n, trunc(b * 8000)::BIGINT) AS stop FROM r)"""


def _ranges(spark, sf_dir, form: str = "wav") -> tuple[str, DataFrame]:
    """The folder of the ranges cut out of the recordings, and the table that writes them as it is read."""
    folder, key = _recordings(spark, sf_dir), F.col("c_custkey")
    start = (key % 7) / F.lit(40.0)
    path = F.concat(F.lit(folder + "/"), F.when(key % 9 == 0, F.lit("gone/")).otherwise(F.concat(F.lpad((key % 16).cast("string"), 2, "0"), F.lit("/"))), key.cast("string"), F.lit(".wav"))
    segments = table(spark, sf_dir, "customer").select(key.alias("manifest_index"), path.alias("source_audio_path"), F.concat(F.format_string("audio/%03d/", key % 256), key.cast("string"), F.lit(f".{form}")).alias("audio_path"), start.alias("start_sec"), (start + (key % 4) / F.lit(20.0)).alias("end_sec"))
    return f"{folder}/cut", sinks.write_ranges(segments, f"{folder}/cut")


@query(f"WITH {_RANGES} SELECT manifest_index, NOT gone AND stop > first AS ok, CASE WHEN gone THEN 'source_missing' WHEN stop <= first THEN 'empty_segment' END AS reason, CASE WHEN NOT gone AND stop > first THEN 44 + 2 * ch * (stop - first) END AS size_bytes FROM f")
def wav_ranges(spark, sf_dir):
    """Ranges cut out of recordings, of which every ninth isn't there and some ranges are empty: a row for each, good or bad."""
    out = _ranges(spark, sf_dir)[1]
    return out.select("manifest_index", "ok", F.nullif(F.substring_index(F.coalesce("error", F.lit("")), ":", 1), F.lit("")).alias("reason"), "size_bytes")


@query(f"""WITH {_RANGES} SELECT manifest_index || '.wav' AS name, round((stop - first) / 8000.0::DOUBLE, 6) AS duration_sec FROM f WHERE NOT gone AND stop > first""")
def wav_range_files(spark, sf_dir):
    """The files that ``wav_ranges`` makes, by their own headers."""
    cut, rows = _ranges(spark, sf_dir)
    rows.write.format("noop").mode("overwrite").save()
    return files.read_audio_meta(spark, cut).select(F.element_at(F.split("path", "/"), -1).alias("name"), F.round("duration_sec", 6).alias("duration_sec"))


@query(f"WITH {_RANGES} SELECT manifest_index, NOT gone AND stop > first AS ok, CASE WHEN NOT gone AND stop > first THEN manifest_index || '.flac' END AS name, CASE WHEN NOT gone AND stop > first THEN 'fLaC' END AS mark FROM f")
def flac_ranges(spark, sf_dir):
    """The same ranges as FLAC files, listed after they were written."""
    cut, rows = _ranges(spark, sf_dir, "flac")
    done = rows.select("manifest_index", "ok", F.element_at(F.split("audio_path", "/"), -1).alias("name"))
    done.write.parquet(f"{cut}-rows")  # writes the files
    there = files.read_heads(spark, cut, "*.flac", 4, "path string, mark string, size_bytes bigint", lambda head: (head.decode("latin-1"),))
    there = there.select(F.element_at(F.split("path", "/"), -1).alias("name"), "mark")
    return spark.read.parquet(f"{cut}-rows").join(there, "name", "left").select("manifest_index", "ok", "name", "mark")


def _labels(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Label documents read from a tree, one per nation in one of two splits, and the listing of the recordings that exist."""
    root = scratch(spark, "labels")
    rows = table(spark, sf_dir, "nation").collect()  # a fixed table of 25 rows
    for r in rows:
        k = r.n_nationkey
        top = "1.Training" if k % 3 else "2.Validation"
        name = f"a-b-c-d-S{k}-e-f-M-{20 + k}-N" if k % 4 else f"plain{k}"
        doc = {"Transcript" if k % 2 else "text": " " if k % 11 == 5 else f"{r.n_name} \n says", "Patient_info": {"SpeakerName": f"P{k}" if k % 5 == 0 else "", "Severity": "mild" if k % 3 == 0 else ""}, "x": [{"grade": k if k % 6 == 1 else None}], "File_id": f"F{k}"}
        write_bytes(f"{root}/{top}/라벨링데이터_TL/0{r.n_regionkey}. Region {r.n_regionkey}/{name}.json", json.dumps(doc, ensure_ascii=False).encode())
        write_bytes(f"{root}/{top}/other/{name}.json", b"{}")
    plain = files.read_labels(spark, root, ["1.Training", "2.Validation"], manifest.LABEL_PREFIX)
    listing = plain.select(tx.audio_path(F.col("label_path"), manifest.LABEL_PREFIX, "원천데이터").alias("path"), F.lit(16000).cast("bigint").alias("sample_rate"), F.lit(1).cast("bigint").alias("channels"), F.lit(2).cast("bigint").alias("sample_width"), F.lit(1.23456).alias("duration_sec"), F.lit(99).cast("bigint").alias("size_bytes"))
    return plain, listing.where(~F.col("path").endswith("plain8.wav"))


_NAME = "CASE WHEN n_nationkey % 4 <> 0 THEN 'a-b-c-d-S' || n_nationkey || '-e-f-M-' || (20 + n_nationkey) || '-N' ELSE 'plain' || n_nationkey END"


@query(f"SELECT CASE WHEN n_nationkey % 3 <> 0 THEN '1.Training' ELSE '2.Validation' END AS split_dir, '0' || n_regionkey || '. Region ' || n_regionkey AS category_dirname, {_NAME} || '.json' AS name FROM nation")
def label_documents(spark, sf_dir):
    rows = _labels(spark, sf_dir)[0]
    parts = F.split("label_path", "/")
    return rows.select("split_dir", F.element_at(parts, -2).alias("category_dirname"), F.element_at(parts, -1).alias("name"))


@query(f"""WITH t AS (SELECT *, {_NAME} AS stem FROM nation), c AS (
    SELECT *, CASE WHEN n_nationkey % 5 = 0 THEN 'P' || n_nationkey WHEN n_nationkey % 4 <> 0 THEN 'S' || n_nationkey ELSE stem END AS speaker_code, CASE WHEN n_nationkey % 4 <> 0 THEN '-M-' || (20 + n_nationkey) || '-N' ELSE '' END AS rest FROM t)
SELECT stem || '.wav' AS audio, n_name || ' says' AS text, CASE WHEN n_nationkey % 2 = 1 THEN 'Transcript' ELSE 'text' END AS transcript_source, CASE WHEN n_nationkey % 3 <> 0 THEN 'training' ELSE 'validation' END AS source_split,
    '라벨링데이터_TL' AS source_label_dir, '0' || n_regionkey AS category_code, 'Region ' || n_regionkey AS category_name, 'F' || n_nationkey AS file_id, 1.235 AS duration_sec, speaker_code, speaker_code || rest AS speaker_id,
    CASE WHEN n_nationkey % 3 = 0 THEN 'mild' WHEN n_nationkey % 6 = 1 THEN n_nationkey::VARCHAR ELSE 'unknown' END AS severity_label,
    CASE WHEN n_nationkey % 3 = 0 THEN 'Patient_info.Severity' WHEN n_nationkey % 6 = 1 THEN 'x[0].grade' ELSE 'missing' END AS severity_source
FROM c WHERE n_nationkey % 11 <> 5 AND stem <> 'plain8'""")
def file_manifest(spark, sf_dir):
    """The wide record of every label that has a transcript and a recording."""
    labels, listing = _labels(spark, sf_dir)
    rows = manifest.file_records(labels, listing, "원천데이터")
    return rows.select(F.element_at(F.split("audio_path", "/"), -1).alias("audio"), "text", "transcript_source", "source_split", "source_label_dir", "category_code", "category_name", "file_id", F.col("duration_sec").cast("decimal(4,3)").alias("duration_sec"), "speaker_code", "speaker_id", "severity_label", "severity_source")


# --- N-best --------------------------------------------------------------------------------------------------------
@query("SELECT vec_id, 'shard' || vec_id // 100 AS feature_shard_path, vec_id % 100 AS feature_index_in_shard, CASE WHEN vec_id % 100 < 90 THEN round(embedding[1]::DOUBLE, 6) END AS first_value FROM embeddings")
def feature_rows(spark, sf_dir):
    """Rows with their features from shards, of which the last places are missing."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.concat(F.lit("shard"), F.floor(F.col("vec_id") / 100).cast("string")).alias("feature_shard_path"), (F.col("vec_id") % 100).alias("feature_index_in_shard"), F.col("embedding").alias("features"))
    rows.where("feature_index_in_shard < 90").drop("vec_id").write.partitionBy("feature_shard_path").parquet(path := scratch(spark, "features"))
    shards = spark.read.parquet(path)
    near = nbest.for_locality(rows.withColumn("manifest_index", F.col("vec_id")), 8).drop("features")
    return nbest.with_features(near, shards).select("vec_id", "feature_shard_path", "feature_index_in_shard", F.round(F.element_at("features", 1).cast("double"), 6).alias("first_value"))


class _Echo:
    """Stands for a model: the text as it is, in capitals and again; samples are numbered."""

    def beams(self, rows: pd.DataFrame, n: int):
        return [[t or "", (t or "").upper(), t or ""][:n] for t in rows["text"]]

    def samples(self, rows: pd.DataFrame, n: int):
        return [[f"{t} {k}" for k in range(n)] for t in rows["text"]]

    def generate(self, messages):
        return [f"{m[0]['role']}: {m[1]['content']}" for m in messages]

    def transcribe(self, rows: pd.DataFrame):
        return pd.DataFrame({"source_audio_path": rows["path"], "text": rows["path"] + " heard"})


@query("""WITH t AS (SELECT p_partkey, trim(regexp_replace(p_name, '\\s+', ' ', 'g')) AS a FROM part), c AS (
    SELECT p_partkey, unnest([a, upper(a)]) AS text, unnest([1, 2]) AS rank FROM t), k AS (SELECT p_partkey, text, min(rank) AS f FROM c WHERE text <> '' GROUP BY ALL)
SELECT p_partkey, row_number() OVER (PARTITION BY p_partkey ORDER BY f)::INT AS rank, text, 'beam' AS source, 'whisper' AS nbest_model_name, 'a/b' AS nbest_adapter_path, 5 AS nbest_num_beams, 3 AS nbest_num_return_sequences, false AS nbest_sampling_fallback FROM k""")
def candidate_rows(spark, sf_dir):
    """Each row's candidates, normalised, without repeats, with how they were made."""
    rows = nbest.with_run_columns(plugins.generate_candidates(table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("text")), _Echo, 3), "whisper", "a/b", 5, 3)
    runs = ["nbest_model_name", "nbest_adapter_path", "nbest_num_beams", "nbest_num_return_sequences", "nbest_sampling_fallback"]
    return rows.select("p_partkey", F.explode("nbest_candidates").alias("c"), *runs).select("p_partkey", "c.rank", "c.text", "c.source", *runs)


@query("""WITH t AS (SELECT p_partkey, trim(regexp_replace(p_name, '\\s+', ' ', 'g')) AS a FROM part)
SELECT p_partkey, unnest([a, upper(a), a || ' 0', a || ' 1']) AS text, unnest(['beam', 'beam', 'sample', 'sample']) AS source FROM t WHERE a <> upper(a)""")
def sampled_rows(spark, sf_dir):
    """With sampling, rows short of candidates are filled up."""
    rows = plugins.generate_candidates(table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("text")), _Echo, 4, sampling=True)
    return rows.select("p_partkey", F.explode("nbest_candidates").alias("c")).select("p_partkey", "c.text", "c.source").where(F.col("text") != "")


@query("SELECT b, g, s, (SELECT max(d) FROM range(1, 13) x(d) WHERE d <= least(b, g, s) AND b % d = 0) AS beam_groups FROM range(1, 13) x(b), range(1, 13) y(g), range(1, 13) z(s)")
def beam_groups(spark, sf_dir):
    rows = [(b, g, s, nbest.beam_groups(b, g, s)) for b in range(1, 13) for g in range(1, 13) for s in range(1, 13)]
    return spark.createDataFrame(rows, "b bigint, g bigint, s bigint, beam_groups bigint")


@query("SELECT 'test.org--model-' || n_nationkey || '.jsonl' AS name FROM nation")
def output_names(spark, sf_dir):
    rows = table(spark, sf_dir, "nation").select("n_nationkey").collect()  # a fixed table of 25 rows
    return spark.createDataFrame([(nbest.output_name("test", f"org/model-{r.n_nationkey}"),) for r in rows], "name string")


@query("SELECT p_partkey || '.wav' AS source_audio_path, p_partkey || '.wav heard' AS text FROM part")
def transcribed(spark, sf_dir):
    paths = table(spark, sf_dir, "part").select(F.concat(F.col("p_partkey").cast("string"), F.lit(".wav")).alias("path"))
    return plugins.transcribe(paths, _Echo, "source_audio_path string, text string")


_PROMPT = "'- 입력 데이터: ' || '{\"n_nationkey\":' || n_nationkey || ',\"n_name\":\"' || n_name || '\"}'"


@query(f"SELECT n_nationkey, 'system' AS first_role, 'write notes' AS first_content, 'user' AS second_role, {_PROMPT} AS second_content, 'system: ' || {_PROMPT} AS generated_text FROM nation")
def chat_prompts(spark, sf_dir):
    rows = plugins.generate_texts(augment.prompts(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), "write notes"), _Echo)
    m = F.col("messages")
    return rows.select("n_nationkey", m[0]["role"].alias("first_role"), m[0]["content"].alias("first_content"), m[1]["role"].alias("second_role"), m[1]["content"].alias("second_content"), "generated_text")


@query("SELECT sum(p_size)::BIGINT AS total_params, sum(p_size) FILTER (p_partkey % 3 = 0)::BIGINT AS trainable_params, round(100.0::DOUBLE * sum(p_size) FILTER (p_partkey % 3 = 0) / sum(p_size), 4) AS trainable_percent FROM part")
def parameter_counts(spark, sf_dir):
    return nbest.parameter_counts(table(spark, sf_dir, "part").select(F.col("p_name").alias("name"), F.col("p_size").alias("n"), (F.col("p_partkey") % 3 == 0).alias("trainable")))


@query("SELECT * FROM (VALUES ('default', 0.35::DOUBLE, 1.0::DOUBLE, 30.0::DOUBLE, 0.45::DOUBLE, 3, 0.28::DOUBLE, 42), ('strict', 0.6::DOUBLE, 2.0::DOUBLE, 20.0::DOUBLE, 0.7::DOUBLE, 3, 0.28::DOUBLE, 42)) v(profile, min_segment_score, min_duration_sec, max_duration_sec, min_coverage, severity_bins, align_min_score, seed)")
def config_profiles(spark, sf_dir):
    names = ("min_segment_score", "min_duration_sec", "max_duration_sec", "min_coverage", "severity_bins", "align_min_score", "seed")
    rows = [(k, *(asdict(p)[n] for n in names)) for k, p in PROFILES.items()]
    return spark.createDataFrame(rows, "profile string, min_segment_score double, min_duration_sec double, max_duration_sec double, min_coverage double, severity_bins int, align_min_score double, seed int")


# --- splits --------------------------------------------------------------------------------------------------------
@query("""SELECT c_custkey AS speaker_id, CASE row_number() OVER (ORDER BY md5('42:' || c_custkey), c_custkey) WHEN 1 THEN 'dev' WHEN 2 THEN 'test' ELSE 'train' END AS split FROM customer""")
def donor_repair(spark, sf_dir):
    """All speakers in one split: each empty split gets one of them, those of least md5."""
    speakers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("speaker_id"), F.lit("train").alias("split"), F.md5(F.concat(F.lit("42:"), F.col("c_custkey").cast("string"))).alias("clm__md5"))
    return split.require_splits(split.fill_empty_splits(speakers)).select("speaker_id", "split")


@query("""SELECT c_custkey AS speaker_id, CASE WHEN c_custkey % 10 < 7 THEN CASE WHEN row_number() OVER (PARTITION BY c_custkey % 10 < 7 ORDER BY md5('42:' || c_custkey), c_custkey) = 1 THEN 'dev' ELSE 'train' END ELSE 'test' END AS split FROM customer""")
def donor_repair_one(spark, sf_dir):
    """Only one split is empty, and the largest of the others gives."""
    speakers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("speaker_id"), F.when(F.col("c_custkey") % 10 < 7, "train").otherwise("test").alias("split"), F.md5(F.concat(F.lit("42:"), F.col("c_custkey").cast("string"))).alias("clm__md5"))
    return split.fill_empty_splits(speakers).select("speaker_id", "split")


# --- alignments whose outcome is known -----------------------------------------------------------------------------
def _sentences(spark, sf_dir) -> DataFrame:
    """(path, i, s, words, chars): all sentences of a conversation in order."""
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("path"), "turn", F.posexplode(tx.split_sentences(F.col("text"))).alias("at", "s"))
    place = F.row_number().over(Window.partitionBy("path").orderBy("turn", "at")) - 1
    return rows.select("path", place.alias("i"), "s")


def _self_alignment(spark, sf_dir, size: int) -> tuple[DataFrame, DataFrame]:
    """Each ``size`` sentences were heard as they are, at about seven characters a second (7.01, so that no time ends in a tie of rounding), words evenly spaced: nothing else can be the best path."""
    rows = _sentences(spark, sf_dir)
    heard = rows.groupBy("path", F.floor(F.col("i") / size).cast("int").alias("chunk_index")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "s"))), lambda x: x["s"]), " ").alias("text"))
    start = F.col("chunk_index") * 1000.0
    span = F.greatest(F.lit(1), F.length(tx.match_text(F.col("text")))) / 7.01
    words = tx.words_of(F.col("text"))
    timed = F.transform(words, lambda w, k: F.struct((start + span * k / F.size(words)).alias("start"), (start + span * (k + 0.4137) / F.size(words)).alias("end"), w.alias("text")))
    chunks = heard.select(F.col("path").alias("source_audio_path"), "chunk_index", start.alias("start_sec"), (start + span).alias("end_sec"), "text", timed.alias("words"))
    texts = rows.groupBy(F.col("path").alias("source_audio_path")).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "s"))), lambda x: x["s"]).alias("sentences"))
    return align.align(chunks, texts)


_SELF = f"""u AS (SELECT conv_id, turn, unnest(range(len(s))) AS pos, unnest(s) AS s FROM (SELECT conv_id, turn, {rg.SENTENCES('text')} AS s FROM conversations)), n AS (
    SELECT conv_id::VARCHAR AS source_audio_path, row_number() OVER (PARTITION BY conv_id ORDER BY turn, pos) - 1 AS i, s, len({rg.WORDS_OF('s')}) AS w, {rg.PLAIN('s')} AS p FROM u), g AS (
    SELECT *, i // @k AS c, count(*) OVER p AS size, sum(w) OVER p AS all_w, coalesce(sum(w) OVER (PARTITION BY source_audio_path, i // @k ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
        string_agg(s, ' ' ORDER BY i) OVER (PARTITION BY source_audio_path, i // @k ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS whole,
        array_to_string(list_filter(list(p ORDER BY i) OVER (PARTITION BY source_audio_path, i // @k ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), lambda x: x <> ''), ' ') AS whole_p
    FROM n WINDOW p AS (PARTITION BY source_audio_path, i // @k)), t AS (
    SELECT *, c * 1000.0::DOUBLE AS a, greatest(1, length(whole_p)) / 7.01::DOUBLE AS d FROM g), r AS (
    SELECT *, CASE WHEN before = 0 THEN a ELSE a + d * before / all_w END AS s0, CASE WHEN before + w = all_w THEN a + d ELSE a + d * (before + w - 0.5863::DOUBLE) / all_w END AS e0 FROM t)"""
_SEGMENTS = """SELECT source_audio_path, (c + 1)::BIGINT AS source_segment_index, size::BIGINT AS sentence_count_in_group, s AS text, s AS asr_text, whole AS chunk_asr_text, round(s0, 3) AS start_sec, round(e0, 3) AS end_sec, round(e0 - s0, 3) AS duration_sec,
    e0 - s0 > 20 AS too_long_for_whisper, w::BIGINT AS asr_word_count, all_w::BIGINT AS chunk_asr_word_count, round(CASE WHEN whole_p = '' THEN 0.75::DOUBLE ELSE 1.0::DOUBLE END - 0.2::DOUBLE * least(abs(d - greatest(1, length(whole_p)) / 7.0::DOUBLE) / greatest(1, greatest(1, length(whole_p)) / 7.0::DOUBLE), 1), 4) AS chunk_score,
    round(CASE WHEN p = '' THEN 0.75::DOUBLE ELSE 1.0::DOUBLE END - 0.2::DOUBLE * least(abs(e0 - s0 - greatest(1, length(p)) / 7.0::DOUBLE) / greatest(1, greatest(1, length(p)) / 7.0::DOUBLE), 1), 4) AS score FROM r"""
_COLUMNS = ["source_audio_path", "source_segment_index", "sentence_count_in_group", "text", "asr_text", "chunk_asr_text", "start_sec", "end_sec", "duration_sec", "too_long_for_whisper", "asr_word_count", "chunk_asr_word_count", "chunk_score"]


@query(f"WITH {_SELF.replace('@k', '1')} {_SEGMENTS}")
def aligned_to_itself(spark, sf_dir):
    return _self_alignment(spark, sf_dir, 1)[0].select(*_COLUMNS, "score")


@query(f"WITH {_SELF.replace('@k', '2')} {_SEGMENTS}")
def aligned_by_pairs(spark, sf_dir):
    """Two sentences a chunk: matched as a group, split at the words where the first one ends."""
    return _self_alignment(spark, sf_dir, 2)[0].select(*_COLUMNS, "score")


@query(f"""WITH {_SELF.replace('@k', '2')} SELECT source_audio_path, count(*) AS reference_sentence_count, count(DISTINCT c) AS whisper_segment_count, count(*) AS matched_reference_sentences, 1.0::DOUBLE AS coverage_ratio,
    count(DISTINCT c) AS matched_whisper_segments, 0 AS skipped_whisper_segments, 0 AS skipped_reference_sentences FROM r GROUP BY ALL""")
def aligned_report(spark, sf_dir):
    return _self_alignment(spark, sf_dir, 2)[1]


_PIECES = f"""w AS (SELECT conv_id, turn, {rg.WORDS_OF('text')} AS w FROM conversations), k AS (SELECT conv_id, turn, w, unnest(range(0, len(w), 6)) AS k FROM w), p AS (
    SELECT conv_id, turn, k // 6 AS piece, array_to_string(list_slice(w, k + 1, k + 6), ' ') AS ref, array_to_string(list_slice(w, k + 1, k + 5), ' ') AS hyp FROM k), n AS (
    SELECT *, {rg.PLAIN('ref')} AS r, {rg.PLAIN('hyp')} AS h FROM p)"""


@query(f"""WITH {_PIECES} SELECT conv_id, turn, piece, round(CASE WHEN r = '' OR h = '' THEN 0 ELSE 0.8::DOUBLE * 2 * length(h) / (length(h) + length(r))
    + 0.2::DOUBLE * len(list_filter(list_distinct(string_split(r, ' ')), lambda x: list_contains(string_split(h, ' '), x))) / len(list_distinct(string_split(r, ' '))) END, 9) AS ratio FROM n""")
def prefix_ratio(spark, sf_dir):
    """Similarity of six words with their first five, where the longest common substring is the whole shorter text."""
    words = tx.words_of(F.col("text"))
    pieces = table(spark, sf_dir, "conversations").select("conv_id", "turn", words.alias("w")).where(F.size("w") > 0)
    pieces = pieces.select("conv_id", "turn", "w", F.explode(F.sequence(F.lit(0), F.floor((F.size("w") - 1) / 6).cast("int"))).alias("piece"))
    part = lambda n: F.array_join(F.slice("w", F.col("piece") * 6 + 1, n), " ")
    return pieces.select("conv_id", "turn", F.col("piece").cast("bigint").alias("piece"), F.round(udfs.seq_ratio(part(5), part(6)), 9).alias("ratio"))


# --- streams -------------------------------------------------------------------------------------------------------
@query("""WITH e AS (SELECT *, event_id % 3 AS part FROM events), m AS (SELECT max(ts) FILTER (part = 0) - INTERVAL 10 MINUTE AS closed, max(ts) - INTERVAL 10 MINUTE AS last FROM e), w AS (
    SELECT part, event_type, time_bucket(INTERVAL 1 HOUR, ts) AS window_start FROM e)
SELECT window_start, event_type, count(*) AS n FROM w, m WHERE window_start + INTERVAL 1 HOUR <= last AND (part < 2 OR window_start + INTERVAL 1 HOUR > closed) GROUP BY ALL""")
def stream_late_windows(spark, sf_dir):
    """Three batches, all over the whole time. Windows that the first batch's watermark closes come out with the second; rows of the
    third that are of such windows are late and left out. Only closed windows come out.
    """
    from corpusloom.streaming.append import windowed_counts

    folder, events = scratch(spark, "late"), table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    for k in range(3):
        events.where(F.col("event_id") % 3 == k).coalesce(1).write.parquet(f"{folder}/in/batch={k}")
    schema = events.schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("latestFirst", "false").parquet(f"{folder}/in/*")
    counts = windowed_counts(stream, "ts", "event_type", "1 hour", "10 minutes").select(F.col("window.start").alias("window_start"), "event_type", "n")
    counts.writeStream.outputMode("append").format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{folder}/out").select("window_start", "event_type", "n")


@query("""WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 2 HOUR THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)), s AS (
    SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 2 HOUR AS session_end, count(*) AS n FROM s GROUP BY user_id, k""")
def session_windows(spark, sf_dir):
    from corpusloom.streaming.append import sessions

    rows = sessions(table(spark, sf_dir, "events"), "ts", "user_id", "2 hours", "10 minutes")
    return rows.select("user_id", F.col("session_window.start").alias("session_start"), F.col("session_window.end").alias("session_end"), "n")
