"""The functions under SQL names: as SQL functions where an expression will do, which Catalyst inlines, else as UDFs."""

from __future__ import annotations

from pyspark.sql import SparkSession

from corpusloom.functions import udfs
from corpusloom.functions.text import FINALS, INITIALS, VOWELS, WS


def _array(names: list[str]) -> str:
    return "array(" + ", ".join(f"'{n}'" for n in names) + ")"


_ROMAN = f"""array_join(transform(split(s, ''), c -> CASE WHEN ascii(c) BETWEEN 44032 AND 55203 THEN concat(
    element_at({_array(INITIALS)}, CAST((ascii(c) - 44032) div 588 + 1 AS INT)), element_at({_array(VOWELS)}, CAST(((ascii(c) - 44032) % 588) div 28 + 1 AS INT)), element_at({_array(FINALS)}, (ascii(c) - 44032) % 28 + 1))
    ELSE lower(c) END), '')"""
_WORDS = f"filter(split(trim(regexp_replace(@, r'{WS}', ' ')), ' '), w -> w <> '')"
_CODE = "decode(unhex(lpad(hex(array_position(p.v, w) + 65536), 8, '0')), 'UTF-32')"
_WER = f"""transform(array(named_struct('r', {_WORDS.replace('@', 'reference')}, 'h', {_WORDS.replace('@', 'hypothesis')},
    'v', array_distinct(concat({_WORDS.replace('@', 'reference')}, {_WORDS.replace('@', 'hypothesis')})))),
    p -> try_divide(CAST(levenshtein(array_join(transform(p.r, w -> {_CODE}), ''), array_join(transform(p.h, w -> {_CODE}), '')) AS DOUBLE), size(p.r)))[0]"""

FUNCTIONS = {
    "hangul_romanize(s STRING) RETURNS STRING": _ROMAN,
    "cer(reference STRING, hypothesis STRING) RETURNS DOUBLE": "try_divide(CAST(levenshtein(reference, hypothesis) AS DOUBLE), length(reference))",
    "wer(reference STRING, hypothesis STRING) RETURNS DOUBLE": _WER,
}


def register_sql(spark: SparkSession) -> None:
    for head, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    udfs.register(spark)
