"""Invariants and hand-derived values of the table operators."""

import gzip
import hashlib
import io
import json
import os
import random
import re
import struct
import tracemalloc
import wave

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from corpusloom import storage
from corpusloom.config import DEFAULT, PROFILES, STRICT
from corpusloom.functions.udfs import Comparable
from corpusloom.operators import align, augment, extract, manifest, metrics, nbest, quality, split
from corpusloom.operators.ranking import with_position, with_position_in
from corpusloom.plans import fixtures as fx
from corpusloom.plugins import generate_candidates, generate_texts, merge_candidates, transcribe
from corpusloom.sources import files, flac, sinks
from corpusloom.streaming.append import append_new, sessions, windowed_counts


def test_profiles():
    assert PROFILES["strict"].min_segment_score == 0.6 and STRICT.file_filter and not DEFAULT.file_filter
    assert DEFAULT.with_options(min_coverage=0, seed=None).min_coverage == 0  # zero is a value
    for bad in ({"train_ratio": 0.5}, {"nonsense": 1}, {"severity_bins": 0}):
        with pytest.raises(ValueError):
            DEFAULT.with_options(**bad)


def test_positions(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"), (F.col("id") % 3).alias("g"))
    rows = with_position(df, ["v"], "p").collect()
    assert sorted(r.p for r in rows) == list(range(1000)) and all(r.p == r.v for r in rows)
    by = {}
    for r in sorted(with_position_in(df, ["g"], ["v"], "p").collect(), key=lambda r: (r.g, r.v)):
        assert r.p == by.get(r.g, 0) and r.p_of == (334 if r.g == 0 else 333)
        by[r.g] = r.p + 1
    assert with_position(df.limit(0), ["v"], "p").count() == 0


# --- split
def test_split_counts(spark):
    want = {0: (0, 0, 0), 1: (1, 0, 0), 2: (2, 0, 0), 3: (1, 1, 1), 4: (2, 1, 1), 5: (3, 1, 1), 10: (8, 1, 1), 15: (11, 2, 2), 20: (16, 2, 2), 25: (21, 2, 2), 35: (27, 4, 4)}
    df = spark.createDataFrame([(n,) for n in want], "n bigint")
    assert {r[0]: tuple(r)[1:] for r in df.select("n", *split.split_counts(F.col("n"))).collect()} == want


def test_bins(spark):
    df = spark.createDataFrame([(k, 0.5 if k < 2 else k / 10) for k in range(6)], "speaker_id int, severity_proxy double")
    got = {k: [r.severity_bucket for r in split.severity_bins(df, k).orderBy("severity_proxy", "speaker_id").collect()] for k in (1, 2, 3, 4)}
    assert got[1] == ["all"] * 6 and got[2] == ["lower_proxy"] * 3 + ["higher_proxy"] * 3 and got[3] == ["lower_proxy"] * 2 + ["mid_proxy"] * 2 + ["higher_proxy"] * 2
    assert got[4] == ["bin_00", "bin_00", "bin_01", "bin_02", "bin_02", "bin_03"]


def test_split_is_disjoint_and_sized(spark, small):
    rows = quality.filter_segments(fx.segments(spark, small), fx.report(spark, small))
    speakers = split.build_split(rows)
    strata = speakers.groupBy("severity_key", "category_key").pivot("split", list(split.SPLITS)).count().na.fill(0).collect()
    for s in strata:
        n = s.train + s.dev + s.test
        d = max(1, round(n * 0.1)) if n >= 3 else round(n * 0.1)
        assert (s.train, s.dev, s.test) == (n - 2 * d, d, d)
    out = split.training_rows(rows, speakers)
    assert out.count() == rows.count() and out.groupBy("speaker_id").agg(F.countDistinct("split").alias("n")).where("n > 1").isEmpty()


def test_mode_ties_and_unknown(spark):
    rows = [("a", "x", 2), ("a", "y", 1), ("a", "y", 5), ("a", "x", 9), ("b", "unknown", 1), ("b", "", 2), ("c", None, 1), ("c", "z", 7), ("c", "unknown", 0), ("c", "unknown", 3)]
    df = spark.createDataFrame([(s, v, 0.5, 0.5, 1.0, "cat", o) for s, v, o in rows], "speaker_id string, severity_label string, score double, coverage double, duration_sec double, category_code string, ord int")
    assert {r.speaker_id: r.actual_severity for r in split.speaker_stats(df).collect()} == {"a": "y", "b": "unknown", "c": "z"}


def test_empty_splits_are_filled(spark):
    df = spark.createDataFrame([(k, "train", f"{k:02d}") for k in range(5)], "speaker_id int, split string, clm__md5 string")
    got = {r.speaker_id: r.split for r in split.fill_empty_splits(df).collect()}
    assert got == {0: "dev", 1: "test", 2: "train", 3: "train", 4: "train"}


def test_guards(spark):
    df = lambda *names: spark.createDataFrame([(n,) for n in names], "split string")
    assert split.require_splits(df("train", "dev", "test")).count() == 3 and split.require_splits(df("train"), allow_empty=True).count() == 1
    for bad in (df("train"), df("train").limit(0)):
        with pytest.raises(ValueError):
            split.require_splits(bad)
    assert sinks.check_run(False) == "errorifexists" and sinks.check_run(True, resume=True) == "append" and sinks.check_run(True, overwrite=True) == "overwrite"
    with pytest.raises(FileExistsError):
        sinks.check_run(True)
    with pytest.raises(ValueError):
        sinks.check_run(True, True, True)
    sinks.check_progress({"valid_count": 1, "processed_count": 2}, 1, 2)
    for written, selected in ((0, 2), (1, 1)):
        with pytest.raises(ValueError):
            sinks.check_progress({"valid_count": 1, "processed_count": 2}, written, selected)


def test_quality_edges(spark):
    seg = spark.createDataFrame([("f", 0.35, 1.0), ("f", 0.3499, 5.0), ("f", 0.9, 30.0), ("g", 0.9, 5.0), ("h", 0.9, 30.01)], "source_audio_path string, score double, duration_sec double")
    rep = spark.createDataFrame([("f", 0.45, 4, 3), ("z", 1.0, 1, 1)], "source_audio_path string, coverage_ratio double, whisper_segment_count int, matched_whisper_segments int")
    kept = quality.filter_segments(seg, rep)
    assert sorted(r.score for r in kept.collect()) == [0.35, 0.9]  # limits are inclusive; a file without report has coverage 0
    q = {r.source_audio_path: r for r in quality.file_quality(seg, rep).collect()}
    assert q["g"].matched_whisper_ratio == 0.0 and q["f"].matched_whisper_ratio == 0.75 and q["f"].segment_count == 3 and q["f"].median_score == 0.35
    audio = spark.createDataFrame([(None, "s"), ("", "s"), ("own", "s"), ("gone", "s"), (" ", "no")], "audio_path string, source_audio_path string")
    listing = spark.createDataFrame([("s",), ("own",)], "path string")
    assert quality.existing_audio(audio, listing).count() == 3


# --- alignment
def words_of(text, start, step=0.4):
    return [{"start": start + k * step, "end": start + k * step + 0.3, "text": w} for k, w in enumerate(text.split())]


def test_alignment_matches_groups():
    said = ["the cat sat on the mat.", "it was warm.", "then the dog came in.", "nobody knew why."]
    heard = ["the cat sat on the mat it was warm", "zzz qqq", "then the dog came in"]
    chunks = align.make_chunks((10.0 * k, 10.0 * k + 4, t, words_of(t, 10.0 * k)) for k, t in enumerate(heard))
    steps = align.align_steps(chunks, said)
    assert [s.chunk for s in steps if s.chunk is not None] == [0, 1, 2]  # every chunk once, in order
    sentences = [j for s in steps if s.sentence is not None for j in range(s.sentence, s.sentence + s.size)]
    assert sentences == [0, 1, 2, 3]  # and every sentence
    assert align.align_file("f", chunks, [], DEFAULT) == []
    rows = align.align_file("f", chunks, said)
    assert rows[-1]["kind"] == "report" and rows[-1]["reference_sentence_count"] == 4
    assert all(r["start_sec"] < r["end_sec"] for r in rows if r["kind"] == "segment")


def brute_best(chunks, refs, profile):
    from functools import lru_cache

    @lru_cache(None)
    def best(i, j):
        if i == 0 and j == 0:
            return 0.0
        options = []
        if i:
            options.append(best(i - 1, j) + profile.align_skip_chunk)
            for g in range(1, min(profile.align_group, j) + 1):
                score = chunks[i - 1].score(Comparable(" ".join(refs[j - g : j])))
                if score >= profile.align_min_score:
                    options.append(best(i - 1, j - g) + score)
        if j:
            options.append(best(i, j - 1) + profile.align_skip_sentence)
        return max(options)

    return best(len(chunks), len(refs))


def test_alignment_is_optimal():
    rng = random.Random(3)
    vocabulary = "ab cd ef gh ij kl".split()
    text = lambda: " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 6)))
    for _ in range(25):
        refs = [text() for _ in range(rng.randint(0, 6))]
        chunks = align.make_chunks((k * 3.0, k * 3.0 + 2, text(), []) for k in range(rng.randint(0, 6)))
        steps = align.align_steps(chunks, refs)
        assert sum(s.score for s in steps) == pytest.approx(brute_best(chunks, refs, DEFAULT))


def plain_steps(chunks, sentences, profile):
    """The program without any bound: every text compared, offers made cell by cell, the first of equal ones kept."""
    n, m, best, came = len(chunks), len(sentences), {(0, 0): 0.0}, {}

    def offer(to, value, step, origin):
        if to not in best or value > best[to]:
            best[to], came[to] = value, (origin, step)

    for i in range(n + 1):
        for j in range(m + 1):
            here = best[i, j]
            if i < n:
                offer((i + 1, j), here + profile.align_skip_chunk, ("skip_chunk", i, None, 0), (i, j))
            if j < m:
                offer((i, j + 1), here + profile.align_skip_sentence, ("skip_sentence", None, j, 1), (i, j))
            for g in range(1, min(profile.align_group, m - j) + 1) if i < n else ():
                score = chunks[i].score(Comparable(" ".join(sentences[j : j + g])))
                if score >= profile.align_min_score:
                    offer((i + 1, j + g), here + score, ("match", i, j, g), (i, j))
    path, at = [], (n, m)
    while at in came:
        at, step = came[at]
        path.append(step)
    return path[::-1]


def test_alignment_steps_without_bounds():
    """Bounds and the order of comparison change no step, ties included."""
    rng = random.Random(4)
    for case in range(60):
        vocabulary = rng.choice(["a b", "ab cd ef gh ij kl", "the cat sat on a mat while it rained all day long", "é ê 1 가나"]).split()
        text = lambda: " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, rng.choice([2, 8, 60]))))  # noqa: B023, E731
        refs = [text() for _ in range(rng.randint(0, 9))]
        heard = [rng.choice([*refs, text()]) for _ in range(rng.randint(0, 7))]
        chunks = align.make_chunks((k * 3.0, k * 3.0 + rng.choice([0.5, 2.0, 9.0]), t, []) for k, t in enumerate(heard))
        assert [(s.action, s.chunk, s.sentence, s.size) for s in align.align_steps(chunks, refs)] == plain_steps(chunks, refs, DEFAULT), case


def test_golden_alignment():
    """A file worked out by hand: seven characters a second, so durations fit; the middle chunk is noise, the third sentence isn't heard."""
    said = ["abcd efgh.", "ijkl mnop.", "qrst uvwx yzab cdef ghij klmn opqr stuv.", "wxyz 1234."]
    seconds = 9 / 7
    word = lambda t, a, b: {"start": a, "end": b, "text": t}
    heard = [
        (0.0, seconds, "abcd efgh", [word("abcd", 0.0, 0.5), word("efgh", 0.6, 1.2)]),
        (10.0, 10.0 + 19 / 7, "ijkl mnop wxyz 1234", [word("ijkl", 10.0, 10.4), word("mnop", 10.5, 11.0), word("wxyz", 11.5, 12.0), word("1234", 12.1, 12.6)]),
    ]
    rows = align.align_file("f", align.make_chunks(heard), [said[0], said[1], said[3]])
    got = [(r["text"], r["asr_text"], r["start_sec"], r["end_sec"], r["score"], r["chunk_score"], r["source_segment_index"], r["sentence_count_in_group"]) for r in rows[:-1]]
    assert got == [
        ("abcd efgh.", "abcd efgh", 0.0, 1.286, 1.0, 1.0, 1, 1),
        ("ijkl mnop.", "ijkl mnop", 10.0, 11.0, 0.9556, 1.0, 2, 2),  # a second for nine characters: 0.2 * (9 / 7 - 1) / (9 / 7) is lost
        ("wxyz 1234.", "wxyz 1234", 11.5, 12.714, 0.9889, 1.0, 2, 2),
    ]
    assert (rows[-1]["coverage_ratio"], rows[-1]["matched_whisper_segments"], rows[-1]["skipped_reference_sentences"]) == (1.0, 2, 0)
    # a sentence that nothing of what was heard is like costs its skip, and no more
    steps = align.align_steps(align.make_chunks(heard[:1]), [said[0], said[2]])
    assert [(s.action, s.size) for s in steps] == [("match", 1), ("skip_sentence", 1)]


def test_time_shares():
    parts = align.by_text_length(1.0, 9.0, ["aa", "bbbbbb", ""])
    assert [round(b - a, 6) for a, b, _ in parts] == [round(8 * w / 9, 6) for w in (2, 6, 1)] and parts[-1][1] == 9.0
    assert align.by_text_length(2.0, 2.0, ["a"]) == [] and align.by_text_length(1.0, 2.0, []) == []


def test_pauses():
    chunk = align.Chunk(0.0, 6.0, "a b c d", [{"start": s, "end": s + 0.5, "text": t} for s, t in ((0.0, "a"), (0.6, "b"), (3.0, "c"), (3.6, "d"))])
    assert align.by_pauses(chunk, ["a b", "c d"], 0.25) == [(0.0, 1.1, "a b"), (3.0, 6.0, "c d")]
    few = align.Chunk(0.0, 6.0, "a", [{"start": 0.0, "end": 1.0, "text": "a"}])
    assert align.by_pauses(few, ["x", "y"], 0.25) == align.by_text_length(0.0, 6.0, ["x", "y"])
    backwards = align.Chunk(0.0, 6.0, "a b", [{"start": 5.0, "end": 5.5, "text": "a"}, {"start": 0.0, "end": 0.0, "text": "b"}])
    assert align.by_pauses(backwards, ["x", "y"], 0.25)[0][1] <= 6.0


def test_subchunks():
    words = words_of("a b c", 0.0, 1.0)
    chunk = align.Chunk(0.0, 3.0, "a b c", words)
    assert chunk.within(0.3, 2.0).text == "b" and chunk.within(10, 11).text == "" and align.Chunk(0, 1, "x y", []).within(0, 1).text == "x y"
    got = align.make_chunks([(0, 1, " ", []), (1, 2, "t", [{"start": None, "end": 1, "text": "q"}, {"start": 1, "end": 2, "text": " "}, {"start": 1, "end": 2, "text": " w "}])])
    assert len(got) == 1 and got[0].words == [{"start": 1.0, "end": 2.0, "text": "w"}]


def test_align_tables(spark):
    chunks = spark.createDataFrame(
        [("f", 1, 5.0, 8.0, "good night all", []), ("f", 0, 0.0, 4.0, "good morning all", [(0.0, 0.5, "good"), (0.6, 1.0, "morning"), (1.1, 2.0, "all")]), ("g", 0, 0.0, 1.0, "x", None)],
        "source_audio_path string, chunk_index int, start_sec double, end_sec double, text string, words array<struct<start:double,end:double,text:string>>",
    )
    said = spark.createDataFrame([("f", ["good morning all.", "good night all."]), ("g", []), ("h", ["alone."])], "source_audio_path string, sentences array<string>")
    segments, report = align.align(chunks, said)
    assert [r.text for r in segments.orderBy("start_sec").collect()] == ["good morning all.", "good night all."]
    assert {r.source_audio_path: r.coverage_ratio for r in report.collect()} == {"f": 1.0, "h": 0.0}


def test_align_holds_a_file_at_a_time(spark):
    """A batch of a few MB of words: as Python objects all at once it would take far more than is held at a time."""
    text, n = "one two three four five six seven eight nine ten.", 40
    words = [{"start": k / 10, "end": k / 10 + 0.05, "text": "w%d" % k} for k in range(500)]
    chunk = {"chunk_index": 0, "start_sec": 0.0, "end_sec": 100.0, "text": text, "words": words}
    one = pa.array([[chunk]])
    batch = pa.RecordBatch.from_arrays([pa.array([f"f{k}" for k in range(n)]), pa.array([[text]] * n), pa.concat_arrays([one] * n)], names=["source_audio_path", "sentences", "chunks"])
    schema = to_arrow_schema(T.StructType.fromDDL(align.SEGMENT_SCHEMA))
    tracemalloc.start()
    got = [b.num_rows for b in align.align_batches(iter([batch, batch]), schema)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(got) == 2 * 2 * n and max(got) <= align.ROWS_HELD + 1 and peak < 3e6, (got, peak)  # as pandas makes it, the batch alone: 5 MB


def test_interval_join(spark):
    rng = random.Random(8)
    make = lambda n: [(rng.choice("ab"), k, s := rng.uniform(-20, 40), s + rng.choice([0, 0.5, 3, 25, 80, 1e4, -2])) for k in range(n)]
    left, right = make(40), make(40)
    df = lambda rows: spark.createDataFrame(rows, "k string, id int, start double, end double")
    got = [tuple(r) for r in align.interval_join(df(left), df(right), "k", 7.0).collect()]
    want = {(a[0], a[1], b[1]) for a in left for b in right if a[0] == b[0] and a[3] > b[2] and a[2] < b[3]}
    assert len(got) == len(set(got)) and set(got) == want


# --- extraction, N-best, metrics
def test_padding(spark):
    df = spark.createDataFrame([(0, "s", "p", 0.05, 1.0), (1, "s", "p", 5.0, 4.0), (2, "none", "p", 0.0, 1.0), (3, "s", "p", 9.0, 10.0)], "manifest_index bigint, source_audio_path string, speaker_id string, start_sec double, end_sec double")
    sources = spark.createDataFrame([("s", 20000)], "source_audio_path string, total_samples bigint")
    done = spark.createDataFrame([(0,)], "manifest_index bigint")
    rows = {r.manifest_index: r for r in extract.extraction_plan(df, sources, DEFAULT, done).collect()}
    assert (rows[0].start_sample, rows[0].end_sample, rows[0].resumed) == (0, 18400, True)
    assert rows[1].error.startswith("empty_segment") and rows[2].error == "source_missing: none" and rows[3].error.startswith("empty_segment")
    assert rows[0].ok and len({len(r) for r in rows.values()}) == 1


def test_selection(spark):
    df = spark.range(100).select(F.col("id").alias("manifest_index"))
    pick = lambda **k: sorted(r[0] for r in nbest.select_rows(df, **k).collect())
    assert pick() == list(range(100)) and pick(limit=5) == list(range(5)) and pick(limit=50, start=10, end=20) == list(range(10, 20))
    shards = [pick(start=3, shards=4, shard=k) for k in range(4)]
    assert sorted(sum(shards, [])) == list(range(3, 100)) and shards[1][0] == 4
    with pytest.raises(ValueError):
        pick(shards=2, shard=2)
    done = nbest.not_done(df, df.where("manifest_index < 40"))
    assert sorted(r[0] for r in done.union(df.where("manifest_index < 40")).collect()) == list(range(100))


def test_candidates(spark):
    df = spark.createDataFrame([(["a", " a ", "", "b", None, "b c", "b  c"],)], "t array<string>")
    assert [tuple(x) for x in df.select(nbest.distinct_candidates(F.col("t"))).first()[0]] == [(1, "a"), (2, "b"), (3, "b c")]
    assert [tuple(x) for x in df.select(nbest.distinct_candidates(F.col("t"), 2)).first()[0]] == [(1, "a"), (2, "b")]
    once = merge_candidates([], ["x", " x", "", "y"], "beam")
    assert [(c["rank"], c["text"]) for c in once] == [(1, "x"), (2, "y")] and merge_candidates(once, ["x", "y"], "sample") == once
    assert nbest.beam_groups(5, 3, 5) == 1 and nbest.beam_groups(6, 4, 5) == 3 and nbest.output_name("m", "a/b") == "m.a--b.jsonl"


def test_batches_and_choice(spark):
    df = spark.range(25).select("id")
    assert [r.n for r in nbest.batch_ids(df, ["id"], 10).groupBy("batch_id").agg(F.count("*").alias("n")).orderBy("batch_id").collect()] == [10, 10, 5]
    assert [r.id for r in nbest.choose_records(df, ["id"], 3, 4).collect()] == [4, 5, 6] and nbest.choose_records(df, None, 0, -3).count() == 25


def test_rates(spark):
    df = spark.createDataFrame([("a b c", "a x c"), ("d", ""), (None, "z")], "r string, h string")
    assert tuple(metrics.corpus_wer(df, "r", "h").first()) == (3, 4, 0.75)
    assert metrics.corpus_cer(df, "r", "h").first().edits == 3
    assert metrics.corpus_wer(df.limit(0), "r", "h").first().wer is None


# --- manifest, sources, sinks, streams, models
def wav(seconds, rate=8000, channels=1, width=2):
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(channels)
        w.setsampwidth(width)
        w.setframerate(rate)
        w.writeframes(bytes(int(seconds * rate) * channels * width))
    return out.getvalue()


def test_headers():
    assert files.wav_header(wav(1.5, 16000, 2, 2)) == (16000, 2, 2, 1.5)
    law = b"RIFF\0\0\0\0WAVEfmt " + struct.pack("<IHHIIHH", 16, 7, 1, 8000, 8000, 1, 8) + b"LIST" + struct.pack("<I", 3) + b"abc\0" + b"data" + struct.pack("<I", 4000)
    assert files.wav_header(law) == (8000, 1, 1, 0.5) and files.wav_header(b"RIFF") is None and files.wav_header(b"x" * 100) is None
    source = sinks.WavSource(io.BytesIO(wav(2.0)))
    assert files.wav_header(source.cut(0.5, 9.0))[3] == 1.5 and source.cut(3.0, 4.0) is None and files.wav_header(source.cut(0.0, 0.25))[3] == 0.25


def test_manifest_end_to_end(spark, tmp_path):
    for split_dir in ("1.Training", "2.Validation"):
        for name, doc in (("a-b-c-d-S1-e-f-M-60-X", '{"Transcript": " hello  there ", "Patient_info": {"Grade": "2"}}'), ("noaudio", '{"text": "x"}'), ("empty", '{"text": " "}'), ("deep", '{"Text": "t", "z": [{"level": "L"}]}')):
            label, audio = tmp_path / split_dir / "라벨링데이터" / "01.cat" / f"{name}.json", tmp_path / split_dir / "원천데이터" / "01.cat" / f"{name}.wav"
            label.parent.mkdir(parents=True, exist_ok=True)
            audio.parent.mkdir(parents=True, exist_ok=True)
            label.write_text(doc)
            if name != "noaudio":
                audio.write_bytes(wav(1.0))
    (tmp_path / "1.Training" / "other").mkdir()
    (tmp_path / "1.Training" / "other" / "q.json").write_text("{}")
    labels = files.read_labels(spark, str(tmp_path), ["1.Training", "2.Validation"], "라벨링데이터")
    assert labels.count() == 8
    meta = files.read_audio_meta(spark, str(tmp_path))
    rows = manifest.file_records(labels, meta, "원천데이터")
    got = {(r.source_split, r.speaker_code): r for r in rows.collect()}
    assert len(got) == 4 and got["training", "S1"].text == "hello there" and got["training", "S1"].severity_source == "Patient_info.Grade"
    r = got["validation", "deep"]
    assert (r.severity_label, r.severity_source, r.category_code, r.category_name, r.duration_sec, r.sample_rate) == ("L", "z[0].level", "01", "cat", 1.0, 8000)
    counts = {(r.kind, r.value): r.n for r in manifest.manifest_counts(rows).collect()}
    assert counts["source_split", "training"] == 2 and counts["severity_label", "2"] == 2
    assert files.list_files(spark, str(tmp_path), "*.wav").count() == 6


def test_json_lines(spark, tmp_path):
    from corpusloom.schemas import NBEST, table

    assert NBEST["nbest_candidates"].dataType.elementType.fieldNames() == ["rank", "text", "source", "score"]
    path = tmp_path / "a.jsonl"
    path.write_text('{"x": 1}\n\n{"x": 2}\n   \n{"x": 3}\n')
    schema = table("x bigint")
    assert sorted(r.x for r in files.read_jsonl(spark, str(path), schema).collect()) == [1, 2, 3]
    index = lambda **k: {r.x: r.manifest_index for r in files.read_indexed(spark, str(path), schema, **k).collect()}
    assert index() == {1: 0, 2: 2, 3: 4} and index(count_blank=False) == {1: 0, 2: 1, 3: 2}
    assert files.count_lines(spark, str(path)) == 3
    assert files.read_existing(spark, [str(path), str(tmp_path / "no")], schema).count() == 3 and files.read_existing(spark, [str(tmp_path / "no")], schema).count() == 0
    (tmp_path / "bad.jsonl").write_text("{\n")
    with pytest.raises(Exception):
        files.read_jsonl(spark, str(tmp_path / "bad.jsonl"), schema, strict=True).collect()
    report = tmp_path / "r.json"
    report.write_text('{"files": [{"audio_path": "f", "coverage_ratio": 0.1}, {"audio_path": "f", "coverage_ratio": 0.9}]}')
    assert [tuple(r) for r in files.read_report(spark, str(report), table("audio_path string, coverage_ratio double")).collect()] == [("f", 0.9)]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(2, None, True), (1, "e", False)], "manifest_index bigint, error string, ok boolean")
    sinks.write_outcomes(df, str(tmp_path / "ok"), str(tmp_path / "err"))
    assert '"error":null' in "".join(p.read_text() for p in (tmp_path / "ok").glob("part*"))
    assert spark.read.json(str(tmp_path / "err")).count() == 1
    sinks.write_csv(df, str(tmp_path / "csv"), ["ok", "manifest_index"])
    assert spark.read.csv(str(tmp_path / "csv"), header=True).columns == ["ok", "manifest_index"]
    p = str(tmp_path / "p.json")
    assert sinks.load_progress(p) == dict.fromkeys(sinks.COUNTERS, 0)
    sinks.save_progress(p, valid_count=3)
    assert sinks.load_progress(p)["valid_count"] == 3
    sinks.write_json(str(tmp_path / "d" / "summary.json"), {"가": 1})
    sinks.write_markdown(str(tmp_path / "s.md"), "T", {"a": 1, "b": {"c": 2}})
    assert sinks.first_summary(None, str(tmp_path / "x" / "m.jsonl"), str(tmp_path / "d" / "m.jsonl")) == {"가": 1} and "  - c: 2" in (tmp_path / "s.md").read_text()
    assert sinks.histogram(df.groupBy("ok").agg(F.count("*").alias("n")), "ok") == {False: 1, True: 1} and sinks.summary_of(df.limit(1))["ok"] is not None
    wavs = tmp_path / "원 천"
    wavs.mkdir()
    (wavs / "s.wav").write_bytes(wav(1.0))
    (wavs / "broken.wav").write_bytes(b"RIFF....WAVEfmt ")
    rows = [(0, "s.wav", "audio/0.wav", 0.5, 9.0), (1, "s.wav", "audio/1.wav", 0.0, 0.5), (2, "s.wav", "audio/2.wav", 3.0, 4.0), (3, "none.wav", "audio/3.wav", 0.0, 1.0), (4, "broken.wav", "audio/4.wav", 0.0, 1.0)]
    segments = spark.createDataFrame([(k, f"{wavs}/{s}", t, a, b) for k, s, t, a, b in rows], "manifest_index bigint, source_audio_path string, audio_path string, start_sec double, end_sec double")
    got = {r.manifest_index: r for r in sinks.write_ranges(segments, str(tmp_path / "cut")).collect()}
    assert [got[k].ok for k in range(5)] == [True, True, False, False, False] and got[0].size_bytes == got[1].size_bytes == 44 + 8000
    assert [got[k].error.split(":")[0] for k in (2, 3, 4)] == ["empty_segment", "source_missing", "load_failed"]
    assert {r.duration_sec for r in files.read_audio_meta(spark, str(tmp_path / "cut")).collect()} == {0.5}
    meta = {r.path.rpartition("/")[2]: r for r in files.read_audio_meta(spark, str(wavs)).collect()}
    assert meta["s.wav"].duration_sec == 1.0 and meta["s.wav"].size_bytes == 16044 and meta["broken.wav"].sample_rate is None


def test_listing_by_folders(spark, tmp_path):
    """Files are listed by tasks and shared out evenly: a scan would make a task of each, with bytes as they are set here."""
    for k in range(60):
        p = tmp_path / "원 천" / f"d{k % 3}" / f"e{k % 2}=x" / f"{k}.wav"
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(wav(1.0))
    for name in (".hidden.wav", "_left.wav", "a.txt", "_k=1.wav", "b.wave"):
        (tmp_path / "원 천" / name).write_bytes(wav(1.0))
    (tmp_path / "원 천" / "_temporary").mkdir()
    (tmp_path / "원 천" / "_temporary" / "x.wav").write_bytes(b"")
    (tmp_path / "원 천" / "link.wav").symlink_to(tmp_path / "nowhere")
    names = lambda glob: {r.path for r in files.list_files(spark, str(tmp_path), glob).collect()}
    real = {str(p) for p in tmp_path.rglob("*") if p.is_file() and not p.name.startswith((".", "_left", "x.wav"))}
    assert names("*") == real and len(real) == 63
    assert names("{1,2?}.wav") == {p for p in real if re.search("/(1|2.)[.]wav$", p)} and names("[^a-b]*.wav") == {p for p in real if p.endswith(".wav")}
    assert [tuple(r) for r in files.list_files(spark, str(tmp_path / "원 천" / "b.wave")).collect()] == [(str(tmp_path / "원 천" / "b.wave"), 16044)]
    with pytest.raises(Exception, match="none"):
        files.list_files(spark, str(tmp_path / "none"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    meta = files.read_audio_meta(spark, str(tmp_path))
    assert meta.rdd.getNumPartitions() == storage.task_count(spark) and meta.count() == 61 and {r.duration_sec for r in meta.collect()} == {1.0}
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_ranges_are_shared_out_by_number(spark, tmp_path):
    (tmp_path / "s.wav").write_bytes(wav(1.0))
    rows = spark.range(400).select(F.col("id").alias("manifest_index"), F.lit(f"{tmp_path}/s.wav").alias("source_audio_path"), F.concat(F.lit("a/"), F.col("id").cast("string"), F.lit(".wav")).alias("audio_path"), (F.col("id") / 1000).alias("start_sec"), F.lit(0.9).alias("end_sec"))
    out = sinks.write_ranges(rows, f"{tmp_path}/cut")
    assert out.rdd.getNumPartitions() == storage.task_count(spark) and out.where("ok").count() == 400 and len(list((tmp_path / "cut" / "a").iterdir())) == 400


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_outcomes_in_one_pass(spark, tmp_path, compression):
    """Both sides sorted over all files, written by a plan that runs once; a side without rows is an empty folder."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    rows = spark.range(3000).select(F.col("id").alias("manifest_index"), F.col("id").cast("string").alias("source_audio_path"), F.lit("s").alias("speaker_id"), F.lit(0.0).alias("start_sec"), (F.col("id") % 5 - 1.0).alias("end_sec"))
    sources = spark.range(3000).where("id % 3 > 0").select(F.col("id").cast("string").alias("source_audio_path"), F.lit(90000).alias("total_samples"))
    plan = extract.extraction_plan(rows.repartition(7), sources, in_order=True).repartitionByRange("manifest_index")
    for ranged in (True, False):
        ok, err = (f"{tmp_path}/{compression}{ranged}/{x}" for x in ("ok", "err"))
        sinks.write_outcomes(plan, ok, err, compression=compression, ranged=ranged)
        for path, wanted in ((ok, [k for k in range(3000) if k % 3]), (err, list(range(0, 3000, 3)))):
            parts = sorted(p for p in os.listdir(path) if p.startswith("part"))
            lines = [x for p in parts for x in (gzip.open if compression == "gzip" else open)(f"{path}/{p}", "rt").read().splitlines()]
            assert [json.loads(x)["manifest_index"] for x in lines] == wanted and os.path.exists(f"{path}/_SUCCESS") and len(parts) > 1
            assert set(json.loads(lines[0])) == (set(plan.columns) if path == ok else {"ok", "manifest_index", "error"})
    counted = plan.mapInPandas(count, plan.schema)
    sinks.write_outcomes(counted, f"{tmp_path}/o", f"{tmp_path}/e", ranged=True)
    assert seen.value == 3000  # twice as many where each side runs the plan, and more to find ranges
    sinks.write_outcomes(plan.where("ok"), f"{tmp_path}/o", f"{tmp_path}/e")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert spark.read.text(f"{tmp_path}/e").count() == 0 and spark.read.text(f"{tmp_path}/o").count() == 2000


def test_numbered_segments(spark, small):
    rows = fx.numbered(spark, small, "text", "score", "source_audio_path", "ord")
    same = fx.indexed(fx.segments(spark, small)).select("text", "score", "source_audio_path", "ord", "manifest_index")
    assert rows.count() > 0 and rows.exceptAll(same).isEmpty() and same.exceptAll(rows).isEmpty()


def test_reports_in_pieces(spark, tmp_path):
    """Cuts at any byte, in strings, escapes, nested values and between them, give what a JSON parser gives; what can't be cut is read whole."""
    from corpusloom.schemas import table
    from corpusloom.sources import listed

    rng = random.Random(5)
    odd = ['"', "\\", "\\\"", "]}", ',{"files": [', "한글 é", "", "a\n\t/", "\\" * 70]
    value = lambda k: {"audio_path": f"p{rng.randrange(40)}" + rng.choice(odd), "coverage_ratio": rng.choice([None, k / 8, -1e-7]), "x": [{"files": [k, [rng.choice(odd)]]}, rng.choice(odd)]}
    rows = [value(k) if k % 17 else None for k in range(150)]
    doc = {"n": [1, [2]], "a": {"files": [{"audio_path": "no"}]}, "not \"files": [{"audio_path": "no"}], "files": rows, "z": ["files", {"b": []}], "e": {}}
    schema = table("audio_path string, coverage_ratio double")
    want = sorted(map(repr, {(r or {}).get("audio_path"): ((r or {}).get("audio_path"), (r or {}).get("coverage_ratio")) for r in rows}.values()))
    got = lambda path, **k: sorted(repr(tuple(r)) for r in files.read_report(spark, str(path), schema, **k).collect())
    for n, (indent, ascii_only) in enumerate([(None, True), (3, False)]):
        path = tmp_path / f"r{n}.json"
        path.write_text(json.dumps(doc, indent=indent, ensure_ascii=ascii_only), "utf-8")
        size = path.stat().st_size
        for piece in (61, 997, size - 1, 1 << 22):
            at = files.list_files(spark, str(path))
            parts = listed.cut_list(spark, at, "files", piece)
            assert parts is not None and [json.loads(r.text) for r in sorted(parts.collect(), key=lambda r: r["at"])] == rows, (n, piece)
        assert got(path, piece=500) == want
        calls = lambda f, **k: [f(str(path), s, min(37, size - s), **k) for s in range(0, size, 37)]
        assert sum(c[0] for c in calls(listed.change)) % 2 == 0
    text = json.dumps(doc)
    (tmp_path / "r.json.gz").write_bytes(gzip.compress(text.encode()))
    (tmp_path / "wide.json").write_bytes(text.encode("utf-16"))
    assert got(tmp_path / "r.json.gz") == want and got(tmp_path / "wide.json") == want
    (tmp_path / "empty.json").write_text('{"files": [ ], "b": 1}')
    assert got(tmp_path / "empty.json") == []
    for n in (1, 2):
        (tmp_path / "two").mkdir(exist_ok=True)
        (tmp_path / "two" / f"{n}.json").write_text(json.dumps({"files": [{"audio_path": "f", "coverage_ratio": n / 2}]}) + "\n")
    assert got(tmp_path / "two", piece=5) == ["('f', 1.0)"]
    for broken in ('{"files": [{"audio_path": "a"}', '[{"files": [{"audio_path": "a"}]}]', '{"files": []} {"files": []}', '{"files": [], "files": []}', '{"\\u0066iles": []}'):
        (tmp_path / "b.json").write_text(broken)
        assert listed.cut_list(spark, files.list_files(spark, str(tmp_path / "b.json")), "files", 9) is None, broken


def test_report_is_one_document(spark, tmp_path):
    rows = spark.range(2000).repartition(5).select("id", F.concat(F.lit('"é'), F.col("id") % 7).alias("audio_path"), F.when(F.col("id") % 3 > 0, F.col("id") / 4).alias("coverage_ratio"))
    for n in (2000, 1, 0):
        sinks.write_report(rows.where(F.col("id") < n), f"{tmp_path}/r/{n}.json", ["id"], ["audio_path", "coverage_ratio"])
        found = json.loads((tmp_path / "r" / f"{n}.json").read_text("utf-8"))["files"]
        assert [(x["audio_path"], x.get("coverage_ratio")) for x in found] == [(f'"é{k % 7}', k / 4 if k % 3 else None) for k in range(n)]
    assert sorted(p.name for p in (tmp_path / "r").iterdir() if not p.name.startswith(".")) == ["0.json", "1.json", "2000.json"]


def read_flac(data):
    """(rate, samples) of a FLAC stream of fixed predictors, by the format's description; checks all sums."""
    assert data[:8] == b"fLaC\x80\x00\x00\x22"
    rest = int.from_bytes(data[18:26], "big")
    rate, channels, depth, n = rest >> 44, (rest >> 41 & 7) + 1, (rest >> 36 & 31) + 1, rest & (1 << 36) - 1
    at, blocks, number = 42, [], 0
    while at < len(data):
        start = at
        assert data[at : at + 2] == b"\xff\xf8" and data[at + 2] == 0x70 and data[at + 3] >> 4 == channels - 1
        lead = data[at + 4]
        more = 0 if lead < 0x80 else 8 - (lead ^ 0xFF).bit_length() - 1
        value = lead if lead < 0x80 else lead & (0x3F >> more)
        for b in data[at + 5 : at + 5 + more]:
            value = value << 6 | b & 0x3F
        assert value == number
        at += 5 + more
        size = int.from_bytes(data[at : at + 2], "big") + 1
        assert flac.crc8(data[start : at + 2]) == data[at + 2]
        bits = "".join(f"{b:08b}" for b in data[at + 3 :][: 2 * channels * size + 64])
        p, block = 0, []

        def take(k, sign=False):
            nonlocal p
            v = int(bits[p : p + k] or "0", 2)
            p += k
            return v - (1 << k) if sign and v >> (k - 1) else v

        for _ in range(channels):
            kind = take(8) >> 1
            if kind == 0:
                block.append([take(16, True)] * size)
            elif kind == 1:
                block.append([take(16, True) for _ in range(size)])
            else:
                order = kind & 7
                x = [take(16, True) for _ in range(order)]
                assert take(6) == 0
                k = take(4)
                while len(x) < size:
                    q = bits.index("1", p) - p
                    p += q + 1
                    u = q << k | take(k)
                    r = -(u + 1) // 2 if u & 1 else u // 2
                    x.append(r + [0, *x[-1:], 2 * x[-1] - x[-2] if order == 2 else 0, 3 * x[-1] - 3 * x[-2] + x[-3] if order == 3 else 0, 4 * x[-1] - 6 * x[-2] + 4 * x[-3] - x[-4] if order == 4 else 0][order] if order else r)
                block.append(x)
        at += 3 + (p + 7) // 8
        assert flac.crc16(data[start:at]) == int.from_bytes(data[at : at + 2], "big")
        at, number = at + 2, number + 1
        blocks.append(np.array(block, np.int16).T)
    out = np.concatenate(blocks) if blocks else np.zeros((0, channels), np.int16)
    assert len(out) == n and depth == 16 and hashlib.md5(out.astype("<i2").tobytes()).digest() == data[26:42]
    return rate, out


def test_flac_round_trip():
    rng = np.random.default_rng(1)
    t = np.arange(9000)
    tone = (8000 * np.sin(t / 20) + rng.normal(0, 30, 9000)).astype(np.int16)
    for x in (tone, tone[:1], tone[:3], np.zeros(5000, np.int16), rng.integers(-32768, 32768, 5000).astype(np.int16), np.array([-32768, 32767] * 50, np.int16), np.zeros(0, np.int16), (t * 3).astype(np.int16)):
        for channels in (1, 2):
            wide = np.stack([x, x[::-1]], axis=1)[:, :channels]
            data = flac.encode_flac(wide, 16000)
            rate, got = read_flac(data)
            assert rate == 16000 and (got == wide).all()
    assert len(flac.encode_flac(tone[:, None], 16000)) < 0.6 * 2 * len(tone) and len(flac.encode_flac(tone[:0, None], 8000)) == 42
    assert flac._number(0x7F) == b"\x7f" and [flac._number(k) for k in (0x80, 0x7FF, 0x800, 0xFFFF, 0x10000)] == [chr(k).encode() for k in (0x80, 0x7FF, 0x800, 0xFFFF, 0x10000)]
    source = sinks.WavSource(io.BytesIO(wav(1.0, 8000, 2)))
    assert read_flac(source.cut(0.25, 0.75, "flac"))[1].shape == (4000, 2)


def test_stream_resumes(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = spark.range(50).withColumn("k", F.col("id") % 20)
    rows.where("id < 30").write.parquet(src)
    go = lambda c: append_new(spark.readStream.schema(rows.schema).parquet(src), out, str(tmp_path / c), lambda df: df, "k").awaitTermination()
    go("c1")
    rows.where("id >= 30").write.mode("append").parquet(src)
    go("c1")
    go("lost")  # a new checkpoint replays everything; no key comes up twice
    assert sorted(r.k for r in spark.read.parquet(out).collect()) == list(range(20))


def test_windows(spark, small, tmp_path):
    events = spark.read.parquet(f"{small}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    assert windowed_counts(events, "ts", "event_type", "1 hour", "1 minute").agg(F.sum("n")).first()[0] == events.count()
    assert windowed_counts(events, "ts", "event_type", "1 hour", "1 minute", "30 minutes").agg(F.sum("n")).first()[0] == 2 * events.count()
    stream = spark.readStream.schema(events.schema).parquet(f"{small}/events.parquet*")
    q = sessions(stream, "ts", "user_id", "1 hour", "1 minute").writeStream.outputMode("complete").format("memory").queryName("s").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.sql("SELECT sum(n) FROM s").first()[0] == events.count()


def test_models_are_plugged_in(spark):
    class Echo:
        def beams(self, rows, n):
            return [[t] * n for t in rows["text"]]

        def samples(self, rows, n):
            return [[f"{t} {k}" for k in range(n)] for t in rows["text"]]

        def generate(self, messages):
            return [m[1]["content"] for m in messages]

        def transcribe(self, rows):
            return pd.DataFrame({"source_audio_path": rows["path"], "text": rows["path"].str.upper()})

    df = spark.createDataFrame([(0, "a")], "i int, text string")
    row = generate_candidates(df, Echo, 3, sampling=True).first()
    assert [(c.rank, c.text, c.source) for c in row.nbest_candidates] == [(1, "a", "beam"), (2, "a 0", "sample"), (3, "a 1", "sample")]
    named = nbest.with_run_columns(generate_candidates(df, Echo, 3), "m", None, 5, 3).first()
    assert (named.nbest_model_name, named.nbest_adapter_path, named.nbest_num_beams, named.nbest_sampling_fallback) == ("m", "", 5, False)
    assert len(generate_candidates(df, Echo, 3).first().nbest_candidates) == 1
    assert generate_texts(augment.prompts(df, "sys"), Echo).first().generated_text == '- 입력 데이터: {"i":0,"text":"a"}'
    assert transcribe(spark.createDataFrame([("p",)], "path string"), Echo, "source_audio_path string, text string").first().text == "P"


def test_augmentation(spark):
    texts = ['{"instruction": "write it", "input": "long enough", "cc": "a", "pi": "b", "ap": "c"}', "SKIP", "none", '{"input": "x"}']
    df = spark.createDataFrame([(t, f"q{k}") for k, t in enumerate(texts)], "generated_text string, qa_id string")
    done = augment.classify(df)
    assert [r.status for r in done.collect()] == ["valid", "skip", "json_parse_failed", "validation_failed"]
    good = augment.accepted(done).first().asDict()
    assert good == {"instruction": "write it", "input": "long enough", "output": "CC: a\nPI: b\nA&P: c", "source_qa_id": "q0"}
    assert augment.rejected(done).columns == ["reason", "source_qa_id", "source_domain", "source_q_type", "generated_text"]
    assert [r[0] for r in df.select(augment.valid_strict(F.col("generated_text"))).collect()] == [True, False, False, False]


def test_another_name_for_unknown_severity(spark):
    profile = DEFAULT.with_options(unknown_severity="n/a")
    speakers = spark.createDataFrame([("s", "train", 0.1, "mid_proxy", "n/a"), ("t", "dev", 0.2, "lower_proxy", "unknown")], "speaker_id string, split string, severity_proxy double, severity_bucket string, actual_severity string")
    rows = spark.createDataFrame([("s",), ("t",)], "speaker_id string")
    assert {r.speaker_id: r.resolved_severity for r in split.training_rows(rows, speakers, profile).collect()} == {"s": "mid_proxy", "t": "unknown"}


def test_salvage_runs_once(spark):
    rows = augment.classify(spark.createDataFrame([('{"instruction": "write it", "input": "pain here", "cc": "a", "pi": "b", "ap": "c"}',), ("SKIP",), (None,)], "generated_text string"))
    for out, n in ((augment.accepted(rows), 1), (augment.rejected(rows), 2)):
        assert out._jdf.queryExecution().executedPlan().toString().count("[json_salvage(") == 1 and out.count() == n
