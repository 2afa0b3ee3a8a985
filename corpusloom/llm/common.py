"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from corpusloom.storage import spread

#: Separators between words: space and U+0009 to U+000D, the set that ``bytes.split()`` uses.
SPACE_CHARS = " \t\n\x0b\x0c\r"


def shared_dir(spark: SparkSession) -> str:
    """The folder that every executor can reach, as ``spark.checkpoint.dir`` names it.

    Where the setting is absent (local tests) a temporary folder is created once and used as
    the checkpoint folder of the context.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        named = "file://" + tempfile.mkdtemp(prefix="corpusloom-")
        spark.sparkContext.setCheckpointDir(named)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut by a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def map_columns(df: DataFrame, columns: Sequence[str], schema: str, fn: Callable[..., dict[str, list]]) -> DataFrame:
    """Apply ``fn`` to Arrow batches: one Python list per named column in, a dict of lists out."""
    return map_batches(df, columns, schema, lambda lists: (fn(*x) for x in lists))


def map_batches(df: DataFrame, columns: Sequence[str], schema: str, fn: Callable, as_lists: bool = True) -> DataFrame:
    """Apply ``fn`` to the iterator of a partition's batches (lists, or Arrow arrays); it yields dicts of lists or arrays."""
    names = list(columns)
    kinds = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(kinds)

    def run(batches):
        lists = ([b.column(n).to_pylist() if as_lists else b.column(n) for n in names] for b in batches)
        for out in fn(lists):
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    return df.select(*names).mapInArrow(run, kinds)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores added where ``df`` has a column of that name already."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n in taken:
            n += "_"
        taken.add(n)
        out.append(n)
    return out


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def text_or_empty(name: str = "text"):
    return F.coalesce(F.col(name), F.lit(""))
