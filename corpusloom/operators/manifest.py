"""The file manifest: labels matched with audio, and its summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import udfs
from corpusloom.functions.text import audio_path, category, first_path, speaker_meta, stable_round

TRANSCRIPT_PATHS = ["Transcript", "transcript", "Text", "text"]
_LEVELS = ("Severity", "SeverityLevel", "SeverityGrade", "Grade", "Level")
SEVERITY_GROUPS = {"Patient_info": _LEVELS, "Disease_info": _LEVELS, "Test_info": _LEVELS[:4], "Meta_info": _LEVELS[:1]}
SEVERITY_PATHS = [f"{g}.{k}" for g, keys in SEVERITY_GROUPS.items() for k in keys]
LABEL_PREFIX = "라벨링데이터"


def with_audio(labels: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(labels whose ``audio_path`` is in the listing ``files`` (path), the others)."""
    known = files.select(F.col("path").alias("audio_path")).distinct()
    return labels.join(known, "audio_path", "left_semi"), labels.join(known, "audio_path", "left_anti")


def severity(doc: Column, paths: list[str] = SEVERITY_PATHS, unknown: str = "unknown") -> tuple[Column, Column]:
    """Value and path: a listed path, else a search of the whole document, else (unknown, missing).

    The search is a Python UDF, so it gets the document only where no listed path has a value.
    """
    value, path = first_path(doc, paths)
    found = udfs.severity_lookup(F.when(value == "", doc))
    out = F.when(value != "", value).when(found["value"] != "", found["value"]).otherwise(F.lit(unknown))
    return out, F.when(value != "", path).when(found["value"] != "", found["path"]).otherwise(F.lit("missing"))


def file_records(labels: DataFrame, files: DataFrame, audio_dir: str, unknown: str = "unknown") -> DataFrame:
    """The wide record per label (label_path, split_dir, doc) that has audio and a transcript.

    ``files``: path, sample_rate, channels, sample_width, duration_sec, size_bytes.
    """
    doc = F.col("doc")
    text, source = first_path(doc, TRANSCRIPT_PATHS)
    level, level_source = severity(doc, unknown=unknown)
    parts = F.split("label_path", "/")
    folder, name = F.element_at(parts, -2), F.element_at(parts, -1)
    code, title = category(folder)
    field = lambda p: F.trim(F.coalesce(F.get_json_object(doc, "$." + p), F.lit("")))
    rows = labels.withColumn("audio_path", audio_path(F.col("label_path"), LABEL_PREFIX, audio_dir))
    rows = rows.withColumn("text", text).where("text <> ''")
    rows = rows.join(files.withColumnRenamed("path", "audio_path"), "audio_path")
    extra = {
        "file_id": "File_id", "play_time": "playTime", "disease_type": "Disease_info.Type", "subcategory1": "Disease_info.Subcategory1", "subcategory2": "Disease_info.Subcategory2",
        "subcategory3": "Disease_info.Subcategory3", "subcategory6": "Disease_info.Subcategory6", "test_method": "Test_info.TestMethod", "speaker_name": "Patient_info.SpeakerName",
    }
    return rows.select(
        "audio_path", "label_path", "text", source.alias("transcript_source"),
        F.when(F.col("split_dir").startswith("1."), "training").otherwise("validation").alias("source_split"),
        F.try_element_at(F.filter(parts, lambda p: p.startswith(LABEL_PREFIX)), F.lit(1)).alias("source_label_dir"),
        folder.alias("category_dirname"), code.alias("category_code"), title.alias("category_name"), level.alias("severity_label"), level_source.alias("severity_source"),
        stable_round(F.col("duration_sec"), 3).alias("duration_sec"), "sample_rate", "channels", F.col("sample_width").alias("sample_width_bytes"), "size_bytes",
        *(field(p).alias(n) for n, p in extra.items()),
        *(c.alias(n) for n, c in speaker_meta(doc, F.regexp_replace(name, r"\.[^.]*$", "")).items()),
    )


def manifest_counts(files: DataFrame, columns: tuple[str, ...] = ("source_split", "category_code", "severity_label")) -> DataFrame:
    """Counts by each column, in long form (kind, value, n), in one pass by grouping sets."""
    view = files.select(*columns)
    sets = view.groupingSets([[F.col(c)] for c in columns], *columns).agg(F.count("*").alias("n"), F.grouping_id().alias("g"))
    top = (1 << len(columns)) - 1
    kind = F.coalesce(*(F.when(F.col("g") == top - (1 << (len(columns) - 1 - k)), F.lit(c)) for k, c in enumerate(columns)))
    value = F.coalesce(*(F.when(kind == c, F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in columns))
    return sets.select(kind.alias("kind"), value.alias("value"), "n")


def duration_buckets(files: DataFrame) -> DataFrame:
    return files.agg(F.count_if(F.col("duration_sec") > 30.0).alias("over_30"), F.count_if(F.col("duration_sec") > 300.0).alias("over_300"))


def capped_examples(rows: DataFrame, kind: str, order: list[str], show: str, limit: int = 20) -> DataFrame:
    """The first ``limit`` rows of each kind by ``order``: (kind, rank, show). A top-k, so the sort keeps only k rows a task."""
    from pyspark.sql.window import Window

    rank = F.row_number().over(Window.partitionBy(kind).orderBy(*order))
    return rows.select(F.col(kind), rank.alias("example_rank"), F.col(show)).where(F.col("example_rank") <= limit)

