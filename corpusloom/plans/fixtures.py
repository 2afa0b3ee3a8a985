"""Views of the driver's tables in the shapes that the operators take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.functions.text import stable_round
from corpusloom.operators.ranking import with_position
from corpusloom.storage import spread

ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Some columns of a table whose texts are costly to work on."""
    return spread(table(spark, sf_dir, name).select(*columns))


#: What a segment's columns, but for those of ``ORDER`` alone, are made from.
FROM = {"speaker_id": "c_custkey", "category_code": "c_mktsegment", "severity_label": "o_orderpriority", "source_split": "l_linestatus", "text": "p_name"}


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with their order, customer and part.

    Orders meet their customers before the lines, which are several times as many, so lines are shuffled by part and by order alone.
    """
    t = lambda n: table(spark, sf_dir, n)
    people = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
    return t("lineitem").join(t("part"), F.col("l_partkey") == F.col("p_partkey")).join(people, F.col("l_orderkey") == F.col("o_orderkey"))


def _made() -> dict:
    """The columns of a segment, by name."""
    return {
        "source_audio_path": F.col("l_orderkey"),
        "speaker_id": F.col("c_custkey"),
        "category_code": F.col("c_mktsegment"),
        "severity_label": F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "unknown").otherwise(F.col("o_orderpriority")),
        "score": F.col("l_quantity") / 50,
        "duration_sec": F.col("l_extendedprice") / 3000,
        "source_split": F.when(F.col("l_linestatus") == "F", "training").otherwise("validation"),
        "text": F.col("p_name"),
        "ord": F.struct(*ORDER),
    }


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A segment per order line: its file is the order, its speaker the customer; ``ord`` orders them."""
    return _lines(spark, sf_dir).select(*(c.alias(n) for n, c in _made().items()))


def numbered(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """``indexed(segments(...))`` with some of its columns: rows are put in order before the columns are made, so nothing moves twice over or unused."""
    placed = with_position(_lines(spark, sf_dir).select(*ORDER, *(FROM[c] for c in columns if c in FROM)), ORDER, "manifest_index")
    made = _made()
    return placed.select(*(made[c].alias(c) for c in columns), "manifest_index")


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("source_audio_path"))
    out = rows.agg(F.count("*").alias("whisper_segment_count"), F.count_if(F.col("l_returnflag") != "R").alias("matched_whisper_segments"))
    return out.withColumn("coverage_ratio", F.col("matched_whisper_segments") / F.col("whisper_segment_count"))


def indexed(df: DataFrame) -> DataFrame:
    """With manifest_index, the place by ``ord``; its first field goes before the whole, as whole numbers are sorted faster than structs."""
    return with_position(df, [f"ord.{ORDER[0]}", "ord"], "manifest_index")


def timed(df: DataFrame) -> DataFrame:
    """Segments with start_sec and end_sec: one after the other in their file. What is numbered by ``ord`` goes by that number, so ``ord`` isn't shuffled."""
    place = Window.partitionBy("source_audio_path").orderBy("manifest_index" if "manifest_index" in df.columns else "ord")
    upto = place.rowsBetween(Window.unboundedPreceding, 0)
    ends = df.withColumn("end_sec", stable_round(F.sum("duration_sec").over(upto), 3))
    before = F.lag("end_sec").over(place)
    return ends.withColumn("start_sec", F.coalesce(before, F.lit(0.0)))


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation turn with the one before it as its reference: conv_id, turn, ref, hyp."""
    before = F.lag("text").over(Window.partitionBy("conv_id").orderBy("turn"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", before.alias("ref"), F.col("text").alias("hyp"))
    return rows.where("ref IS NOT NULL")


def event_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as timed words: seconds since the user's first event, lasting ``value`` seconds."""
    ts = F.col("ts").cast("timestamp")
    first = F.min(ts).over(Window.partitionBy("user_id"))
    rows = table(spark, sf_dir, "events")
    start = (F.unix_micros(ts) - F.unix_micros(first)) / 1000000.0
    return rows.select("event_id", "user_id", "ts", start.alias("start"), (start + F.col("value")).alias("end"))


# The same in SQL.
SEG = """seg AS (
    SELECT l_orderkey AS source_audio_path, c_custkey AS speaker_id, c_mktsegment AS category_code,
        CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'unknown' ELSE o_orderpriority END AS severity_label,
        l_quantity / 50 AS score, l_extendedprice / 3000 AS duration_sec,
        CASE WHEN l_linestatus = 'F' THEN 'training' ELSE 'validation' END AS source_split, p_name AS text,
        row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) - 1 AS manifest_index
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey
), rep AS (
    SELECT l_orderkey AS source_audio_path, count(*) AS whisper_segment_count, count(*) FILTER (l_returnflag <> 'R') AS matched_whisper_segments,
        (count(*) FILTER (l_returnflag <> 'R'))::DOUBLE / count(*) AS coverage_ratio
    FROM lineitem GROUP BY l_orderkey
), ok AS (
    SELECT seg.*, coalesce(coverage_ratio, 0) AS coverage FROM seg LEFT JOIN rep USING (source_audio_path)
    WHERE score >= @score AND duration_sec BETWEEN @short AND @long AND coalesce(coverage_ratio, 0) >= @cover
), timed AS (
    SELECT *, coalesce(lag(end_sec) OVER (PARTITION BY source_audio_path ORDER BY manifest_index), 0) AS start_sec
    FROM (SELECT *, round(round(sum(duration_sec) OVER (PARTITION BY source_audio_path ORDER BY manifest_index ROWS UNBOUNDED PRECEDING), 9) + 1e-9, 3) AS end_sec FROM seg)
)"""
for _k, _v in (("@score", "0.35"), ("@short", "1"), ("@long", "30"), ("@cover", "0.45")):
    SEG = SEG.replace(_k, _v)
TURNS = "turns AS (SELECT * FROM (SELECT conv_id, turn, lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS ref, text AS hyp FROM conversations) WHERE ref IS NOT NULL)"
WORDS = """words AS (
    SELECT event_id, user_id, ts, s AS start, s + value AS "end"
    FROM (SELECT *, (epoch_us(ts) - min(epoch_us(ts)) OVER (PARTITION BY user_id)) / 1000000.0::DOUBLE AS s FROM events)
)"""
