"""Word and character error rates over a corpus: all edits over all reference units."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import word_edits, words_of


def corpus_wer(pairs: DataFrame, reference: str, hypothesis: str) -> DataFrame:
    """(edits, ref_words, wer); wer is null if there is no reference word."""
    r, h = words_of(F.col(reference)), words_of(F.col(hypothesis))
    counts = pairs.select(word_edits(r, h).cast("bigint").alias("e"), F.size(r).cast("bigint").alias("n"))
    return _rate(counts, "ref_words", "wer")


def corpus_cer(pairs: DataFrame, reference: str, hypothesis: str) -> DataFrame:
    """(edits, ref_chars, cer) by code points; nulls count as empty."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    counts = pairs.select(F.levenshtein(text(reference), text(hypothesis)).cast("bigint").alias("e"), F.length(text(reference)).cast("bigint").alias("n"))
    return _rate(counts, "ref_chars", "cer")


def _rate(counts: DataFrame, units: str, name: str) -> DataFrame:
    out = counts.agg(F.coalesce(F.sum("e"), F.lit(0)).alias("edits"), F.coalesce(F.sum("n"), F.lit(0)).alias(units))
    return out.withColumn(name, F.round(F.try_divide(F.col("edits").cast("double"), F.col(units)), 9))


def pair_wer(reference: Column, hypothesis: Column) -> Column:
    r = words_of(reference)
    return F.try_divide(word_edits(r, words_of(hypothesis)).cast("double"), F.size(r))
