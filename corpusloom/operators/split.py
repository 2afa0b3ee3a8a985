"""Speaker statistics and the speaker-disjoint, stratified split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.config import DEFAULT, Profile
from corpusloom.functions.text import stable_round
from corpusloom.operators.ranking import with_position, with_position_in
from corpusloom.storage import checkpointed

SPLITS = ("train", "dev", "test")


def speaker_stats(segments: DataFrame, unknown: str = DEFAULT.unknown_severity, first_columns: tuple[str, ...] = ("category_code",)) -> DataFrame:
    """Per speaker: utterances, hours, means, severity proxy, most frequent severity, and columns of its first segment by ``ord``.

    Ties of severities go to the one seen first. Sums are made per speaker and severity, combined before the shuffle,
    and only then per speaker.
    """
    parts = segments.groupBy("speaker_id", "severity_label").agg(
        F.count("*").alias("n"),
        F.sum("score").alias("score"),
        F.sum("coverage").alias("coverage"),
        F.sum("duration_sec").alias("seconds"),
        F.min(F.struct("ord", *first_columns)).alias("first"),
    )
    label = F.trim(F.coalesce("severity_label", F.lit("")))
    known = (label != "") & (label != unknown)
    rank = F.when(known, F.struct(-F.col("n"), F.col("first.ord")))
    out = parts.groupBy("speaker_id").agg(
        F.min("first").alias("first"),
        F.sum("n").alias("utterances"),
        F.sum("seconds").alias("seconds"),
        (F.sum("score") / F.sum("n")).alias("score"),
        (F.sum("coverage") / F.sum("n")).alias("coverage"),
        F.min_by(label, rank).alias("actual_severity"),
    )
    return out.select(
        "speaker_id",
        *(F.col("first")[c].alias(c) for c in first_columns),
        "utterances",
        stable_round(F.col("seconds") / 3600.0, 3).alias("total_hours"),
        stable_round(F.col("score"), 4).alias("mean_score"),
        stable_round(F.col("coverage"), 4).alias("mean_coverage"),
        stable_round(1.0 - (0.7 * F.col("score") + 0.3 * F.col("coverage")), 4).alias("severity_proxy"),
        F.coalesce("actual_severity", F.lit(unknown)).alias("actual_severity"),
    )


def bin_label(index: Column, bins: int) -> Column:
    names = {1: ["all"], 2: ["lower_proxy", "higher_proxy"], 3: ["lower_proxy", "mid_proxy", "higher_proxy"]}.get(bins)
    if names:
        return F.element_at(F.array(*map(F.lit, names)), index.cast("int") + 1)
    return F.format_string("bin_%02d", index.cast("int"))


def bin_index(at: Column, total: Column, bins: int) -> Column:
    """The bin, from 0 on, of the place ``at`` among ``total``: of equal numbers, unlike ``ntile`` the odd ones are spread."""
    return F.least(F.floor(at * bins / total), F.lit(bins - 1))


def severity_bins(speakers: DataFrame, bins: int, name: str = "severity_bucket") -> DataFrame:
    """Bins of equal numbers by severity proxy, ties by speaker."""
    placed = with_position(speakers, ["severity_proxy", "speaker_id"], "clm__at", "clm__n")
    return placed.withColumn(name, bin_label(bin_index(F.col("clm__at"), F.col("clm__n"), bins), bins)).drop("clm__at", "clm__n")


def split_counts(n: Column, profile: Profile = DEFAULT) -> tuple[Column, Column, Column]:
    """How many of n go to train, dev and test: rounded half to even, from 3 on at least one to dev and test each."""
    n = F.greatest(n.cast("bigint"), F.lit(0))
    share = lambda r: F.when(n >= 3, F.greatest(F.lit(1), F.bround(n * F.lit(r)).cast("bigint"))).otherwise(F.bround(n * F.lit(r)).cast("bigint"))
    dev, test = share(profile.dev_ratio), share(profile.test_ratio)
    return n - dev - test, dev, test


def split_speakers(speakers: DataFrame, profile: Profile = DEFAULT) -> DataFrame:
    """Adds ``split``: by strata of severity (or bin, where unknown) and category, in the order of md5(seed:speaker)."""
    severity = F.when(F.col("actual_severity").isin("", profile.unknown_severity), F.col("severity_bucket")).otherwise(F.col("actual_severity"))
    keyed = speakers.select(
        "*",
        severity.alias("severity_key"),
        F.when(F.coalesce("category_code", F.lit("")) == "", "unknown").otherwise(F.col("category_code")).alias("category_key"),
        F.md5(F.concat(F.lit(f"{profile.seed}:"), F.col("speaker_id").cast("string"))).alias("clm__md5"),
    )
    placed = with_position_in(keyed, ["severity_key", "category_key"], ["clm__md5", "speaker_id"], "clm__at")
    train, dev, _ = split_counts(F.col("clm__at_of"), profile)
    split = F.when(F.col("clm__at") < train, "train").when(F.col("clm__at") < train + dev, "dev").otherwise("test")
    return placed.withColumn("split", split).drop("clm__at", "clm__at_of")


def fill_empty_splits(speakers: DataFrame) -> DataFrame:
    """Each split without a speaker gets one from the largest (ties: train, dev, test): the one of least md5.

    At most two speakers move; what comes to the driver is three counts and those two rows.
    """
    counts = {s: 0 for s in SPLITS} | dict(speakers.groupBy("split").count().collect())
    moved: dict = {}
    for need in SPLITS:
        if counts[need]:
            continue
        donor = max(SPLITS, key=lambda s: counts[s])
        gone = [k for k in moved]
        pool = speakers.where(F.col("split") == donor)
        row = (pool.where(~F.col("speaker_id").isin(gone)) if gone else pool).orderBy("clm__md5", "speaker_id").select("speaker_id").first()
        if row:
            moved[row[0]] = need
            counts[need] += 1
            counts[donor] -= 1
    out = F.col("split")
    for k, s in moved.items():
        out = F.when(F.col("speaker_id") == F.lit(k), s).otherwise(out)
    return speakers.withColumn("split", out)


def build_split(segments: DataFrame, profile: Profile = DEFAULT) -> DataFrame:
    """Speaker rows with bins and split, from filtered segments with coverage."""
    # the statistics are few rows at the end of a long plan, which range bounds and rows would each run
    stats = severity_bins(checkpointed(speaker_stats(segments, profile.unknown_severity)), profile.severity_bins)
    return fill_empty_splits(split_speakers(stats, profile)).drop("clm__md5")


def training_rows(segments: DataFrame, speakers: DataFrame, profile: Profile = DEFAULT) -> DataFrame:
    """Segments with their speaker's split, proxy, bin and resolved severity: the bin where the severity isn't known."""
    resolved = F.when(F.col("actual_severity").isin("", profile.unknown_severity), F.col("severity_bucket")).otherwise(F.col("actual_severity"))
    known = speakers.select("speaker_id", "split", "severity_proxy", "severity_bucket", resolved.alias("resolved_severity"))
    return segments.join(known, "speaker_id")


def split_summary(rows: DataFrame) -> DataFrame:
    """Per split: rows, speakers, hours; one row a split."""
    return rows.groupBy("split").agg(
        F.count("*").alias("n_rows"), F.countDistinct("speaker_id").alias("n_speakers"), stable_round(F.sum("duration_sec") / 3600.0, 3).alias("total_hours")
    )


def require_splits(speakers: DataFrame, allow_empty: bool = False) -> DataFrame:
    """``speakers``, or a ValueError if there is none or, unless allowed, a split is without one."""
    there = {r[0] for r in speakers.select("split").distinct().collect()}
    if not there:
        raise ValueError("no speaker is left after the filters")
    if not allow_empty and set(SPLITS) - there:
        raise ValueError(f"empty splits: {sorted(set(SPLITS) - there)}")
    return speakers


def global_summary(rows: DataFrame, quality: DataFrame, dropped: DataFrame) -> DataFrame:
    """One row: segments, speakers, hours and kept and dropped files of a build."""
    files = quality.agg(F.count("*").alias("quality_files")).crossJoin(dropped.agg(F.count("*").alias("dropped_files")))
    whole = rows.agg(F.count("*").alias("n_rows"), F.countDistinct("speaker_id").alias("n_speakers"), stable_round(F.coalesce(F.sum("duration_sec"), F.lit(0.0)) / 3600.0, 3).alias("total_hours"))
    return whole.crossJoin(files)  # single rows
