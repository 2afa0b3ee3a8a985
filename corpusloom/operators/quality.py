"""Segment and source-file filters, and the metrics they use."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.config import DEFAULT, Profile
from corpusloom.functions.text import stable_round


def with_coverage(segments: DataFrame, report: DataFrame) -> DataFrame:
    """Each segment with its file's coverage; 0 for files that the report lacks."""
    known = report.select("source_audio_path", F.col("coverage_ratio").alias("coverage"))
    return segments.join(known, "source_audio_path", "left").withColumn("coverage", F.coalesce("coverage", F.lit(0.0)))


def filter_segments(segments: DataFrame, report: DataFrame, profile: Profile = DEFAULT) -> DataFrame:
    """Score, duration and coverage limits, all inclusive; the limits on the segment's own columns come before the join."""
    ok = (F.col("score") >= profile.min_segment_score) & F.col("duration_sec").between(profile.min_duration_sec, profile.max_duration_sec)
    return with_coverage(segments.where(ok), report).where(F.col("coverage") >= profile.min_coverage)


def existing_audio(segments: DataFrame, files: DataFrame) -> DataFrame:
    """Segments whose own audio, or source audio where that is blank, is in the listing ``files`` (path)."""
    path = F.when(F.trim(F.coalesce("audio_path", F.lit(""))) != "", F.col("audio_path")).otherwise(F.col("source_audio_path"))
    return segments.withColumn("clm__path", path).join(files.select(F.col("path").alias("clm__path")), "clm__path", "left_semi").drop("clm__path")


def file_quality(segments: DataFrame, report: DataFrame) -> DataFrame:
    """Per source file: number, mean, median, greatest and least score, usable seconds, and the report's counts (0 where absent)."""
    own = segments.groupBy("source_audio_path").agg(
        F.count("*").alias("segment_count"),
        stable_round(F.avg("score"), 4).alias("avg_score"),
        stable_round(F.median("score"), 4).alias("median_score"),
        stable_round(F.max("score"), 4).alias("max_score"),
        stable_round(F.min("score"), 4).alias("min_score"),
        stable_round(F.sum("duration_sec"), 3).alias("usable_duration_sec"),
    )
    counts = [c for c in ("reference_sentence_count", "matched_reference_sentences", "skipped_reference_sentences", "whisper_segment_count", "matched_whisper_segments", "skipped_whisper_segments") if c in report.columns]
    both = own.join(report.select("source_audio_path", "coverage_ratio", *counts), "source_audio_path", "left")
    ratio = F.coalesce(F.try_divide("matched_whisper_segments", "whisper_segment_count"), F.lit(0.0))
    return both.select(
        *own.columns,
        stable_round(F.coalesce("coverage_ratio", F.lit(0.0)), 4).alias("coverage_ratio"),
        *(F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in counts),
        stable_round(ratio, 4).alias("matched_whisper_ratio"),
    )


def good_files(quality: DataFrame, profile: Profile) -> DataFrame:
    return quality.where(
        (F.col("segment_count") >= profile.file_min_segments)
        & (F.col("avg_score") >= profile.file_min_score)
        & (F.col("coverage_ratio") >= profile.file_min_coverage)
        & (F.col("matched_whisper_ratio") >= profile.file_min_matched)
    )


def gate_files(segments: DataFrame, quality: DataFrame, profile: Profile) -> DataFrame:
    """Only segments of good files, if the profile says so."""
    return segments.join(good_files(quality, profile), "source_audio_path", "left_semi") if profile.file_filter else segments


def dropped_files(quality: DataFrame, profile: Profile) -> DataFrame:
    return quality.join(good_files(quality, profile), "source_audio_path", "left_anti")
