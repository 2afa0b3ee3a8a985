"""Row selection, resuming and candidate lists for N-best datasets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.functions.text import normalize_text
from corpusloom.operators.ranking import with_position


def select_rows(indexed: DataFrame, limit: int = 0, start: int = 0, end: int | None = None, shards: int = 1, shard: int = 0) -> DataFrame:
    """By ``manifest_index`` (0 on, without gaps): the first ``limit`` (0: all), of these [start, end), of these each ``shards``-th by place in the slice."""
    if shards < 1 or not 0 <= shard < shards or start < 0:
        raise ValueError("shard must be within [0, shards), and start from 0 on")
    at, out = F.col("manifest_index"), indexed
    top = min((x for x in (limit if limit > 0 else None, end) if x is not None), default=None)
    if top is not None:
        out = out.where(at < top)
    if start:
        out = out.where(at >= start)
    return out.where(F.pmod(at - start, F.lit(shards)) == shard) if shards > 1 else out


def choose_records(records: DataFrame, order: list[str] | None, limit: int = 0, start: int = 0) -> DataFrame:
    """Offset and limit in an order (0: no limit; negative starts count as 0)."""
    if start > 0 and limit <= 0 and order:
        # an offset alone would bring all rows through one task
        return with_position(records, order, "clm__at").where(F.col("clm__at") >= start).drop("clm__at")
    out = records.orderBy(*order) if order else records
    out = out.offset(start) if start > 0 else out
    return out.limit(limit) if limit > 0 else out


def for_locality(rows: DataFrame, parts: int) -> DataFrame:
    """Rows of a feature shard together and in its order, so that readers open each shard once."""
    return rows.repartitionByRange(parts, "feature_shard_path").sortWithinPartitions("feature_shard_path", "feature_index_in_shard", "manifest_index")


def with_features(rows: DataFrame, features: DataFrame) -> DataFrame:
    """Rows with the column ``features`` of their place in a shard; those without a shard, or that it lacks, have null.

    ``features``: feature_shard_path, feature_index_in_shard, features. Each shard is read once, by the tasks that scan it, instead of being
    copied to and kept open by those that want its rows.
    """
    return rows.join(features.select("feature_shard_path", "feature_index_in_shard", "features"), ["feature_shard_path", "feature_index_in_shard"], "left")


def parameter_counts(parameters: DataFrame) -> DataFrame:
    """One row from (name, n, trainable): total, trainable and the trainable percentage, null without parameters."""
    total, open_ = F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.when(F.col("trainable"), F.col("n"))), F.lit(0))
    return parameters.agg(total.alias("total_params"), open_.alias("trainable_params")).withColumn("trainable_percent", F.round(F.try_divide(100.0 * F.col("trainable_params"), F.col("total_params")), 4))


def not_done(rows: DataFrame, done: DataFrame, key: str = "manifest_index") -> DataFrame:
    return rows.join(done.select(key).distinct(), key, "left_anti")


def merge_shards(shards: list[DataFrame]) -> DataFrame:
    """Shard outputs as one table; columns that some lack become null."""
    out = shards[0]
    for s in shards[1:]:
        out = out.unionByName(s, allowMissingColumns=True)
    return out


def batch_ids(rows: DataFrame, order: list[str], size: int) -> DataFrame:
    """Adds batch_id: the number of the row's batch of ``size`` in the given order."""
    return with_position(rows, order, "clm__at").withColumn("batch_id", F.floor(F.col("clm__at") / size)).drop("clm__at")


def distinct_candidates(texts: Column, limit: int = 0) -> Column:
    """Normalised texts without empties and repeats, first places kept, as (rank, text), cut to ``limit``."""
    kept = F.array_distinct(F.filter(F.transform(texts, normalize_text), lambda t: t != ""))
    ranked = F.transform(kept, lambda t, i: F.struct((i + 1).cast("int").alias("rank"), t.alias("text")))
    return F.slice(ranked, 1, limit) if limit else ranked


def top_candidates(rows: DataFrame, group: str, order: str, text: str, limit: int) -> DataFrame:
    """Per group the first ``limit`` different texts in order: (group, rank, text). Repeats are combined before they are ranked."""
    firsts = rows.select(group, F.col(order).alias("clm__o"), normalize_text(F.col(text)).alias("text")).where("text <> ''").groupBy(group, "text").agg(F.min("clm__o").alias("clm__o"))
    rank = F.row_number().over(Window.partitionBy(group).orderBy("clm__o", "text"))
    return firsts.select(group, rank.alias("candidate_rank"), "text").where(F.col("candidate_rank") <= limit)


def with_run_columns(rows: DataFrame, model: str, adapter: str | None, beams: int, sequences: int) -> DataFrame:
    """The columns that say how a row's candidates were made."""
    return rows.withColumns(
        {
            "nbest_model_name": F.lit(model),
            "nbest_adapter_path": F.lit(adapter or ""),
            "nbest_num_beams": F.lit(beams).cast("int"),
            "nbest_num_return_sequences": F.lit(sequences).cast("int"),
        }
    )


def beam_groups(beams: int, groups: int, sequences: int) -> int:
    """The most groups, up to all three numbers, that divide the beams."""
    g = max(1, min(beams, groups, sequences))
    while beams % g:
        g -= 1
    return g


def output_name(manifest_stem: str, model_or_adapter: str) -> str:
    return f"{manifest_stem}.{model_or_adapter.replace('/', '--')}.jsonl"
