"""Prompts for, and salvage and validation of, generated records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import udfs
from corpusloom.functions.text import get_any_case

SOURCE_KEYS = ("qa_id", "domain", "q_type")
DEFAULT_INSTRUCTION = "다음 환자의 진술을 바탕으로 핵심 증상을 파악하고, 의사가 보기 편한 구조화된 의료 문진표를 작성하세요."


def prompts(items: DataFrame, system: str) -> DataFrame:
    """Adds messages: the system text and the row as JSON."""
    user = F.concat(F.lit("- 입력 데이터: "), F.to_json(F.struct(*items.columns)))
    one = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    return items.withColumn("messages", F.array(one("system", F.lit(system)), one("user", user)))


def has_sections(text: Column) -> Column:
    return text.startswith("CC:") & text.contains("\nPI:") & text.contains("\nA&P:")


def valid_strict(doc: Column) -> Column:
    """Validity of a JSON object of strings, in built-in expressions; what isn't strict JSON is the salvage's."""
    keys = F.transform(F.map_keys(F.from_json(doc, "map<string,string>")), F.lower)
    field = lambda n: F.trim(F.coalesce(get_any_case(doc, n), F.lit("")))
    fine = lambda t: (F.length(t) >= 5) & (t != "...") & (F.upper(t) != "SKIP") & ~t.contains(udfs.PLACEHOLDERS[0]) & ~t.contains(udfs.PLACEHOLDERS[1])
    section = {k: F.trim(F.coalesce(get_any_case(doc, *names), F.lit(""))) for k, names in udfs.SECTIONS.items()}
    whole = F.concat_ws("\n", *(F.concat(F.lit(k + ": "), v) for k, v in section.items()))
    complete = (section["CC"] != "") & (section["PI"] != "") & (section["A&P"] != "")
    out = F.when(complete, whole).otherwise(field("output"))
    need = F.array_contains(keys, "instruction") & F.array_contains(keys, "input")
    bar = F.arrays_overlap(keys, F.array(F.lit("qa_id"), F.lit("status")))
    return F.coalesce(need & ~bar & fine(field("instruction")) & fine(field("input")) & fine(out) & has_sections(out), F.lit(False))


def classify(outputs: DataFrame, text: str = "generated_text") -> DataFrame:
    """Adds status (valid, skip, json_parse_failed, validation_failed) and the salvaged object as ``record``."""
    return outputs.withColumn("clm__r", udfs.json_salvage_once(F.col(text))).select("*", F.col("clm__r.status").alias("status"), F.col("clm__r.json").alias("record")).drop("clm__r")


def accepted(classified: DataFrame) -> DataFrame:
    """instruction, input, output and the source keys that the table has, of valid rows."""
    pick = lambda name: F.coalesce(*(F.nullif(F.get_json_object("record", f"$.{k}"), F.lit("")) for k in (name, name.capitalize(), name.upper())))
    kept = [F.col(k).alias("source_" + k) for k in SOURCE_KEYS if k in classified.columns]
    return classified.where("status = 'valid'").select(
        F.coalesce(pick("instruction"), F.lit(DEFAULT_INSTRUCTION)).alias("instruction"), F.coalesce(pick("input"), F.lit("")).alias("input"), udfs.section_output("record").alias("output"), *kept
    )


def rejected(classified: DataFrame, text: str = "generated_text") -> DataFrame:
    kept = [(F.col(k) if k in classified.columns else F.lit(None).cast("string")).alias("source_" + k) for k in SOURCE_KEYS]
    return classified.where("status <> 'valid'").select(F.col("status").alias("reason"), *kept, F.col(text).alias("generated_text"))


def status_counts(classified: DataFrame) -> DataFrame:
    return classified.groupBy("status").agg(F.count("*").alias("n"))
