"""Interfaces for the neural models, which stay outside; their inputs and outputs are ordinary tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame


class Transcriber(Protocol):
    """Makes chunk rows (schemas.ASR_CHUNKS) from rows with an audio path."""

    def transcribe(self, files: pd.DataFrame) -> pd.DataFrame: ...


class CandidateGenerator(Protocol):
    """Texts per row: ``beams(rows, n)``, and ``samples(rows, n)`` to fill up with."""

    def beams(self, rows: pd.DataFrame, n: int) -> list[list[str]]: ...

    def samples(self, rows: pd.DataFrame, n: int) -> list[list[str]]: ...


class TextGenerator(Protocol):
    """One text per list of chat messages."""

    def generate(self, messages: list[list[dict]]) -> list[str]: ...


class Decoder(Protocol):
    """Mono samples of an audio path at a rate, or of a range of it."""

    def load(self, path: str, rate: int, start: float | None, end: float | None): ...


def transcribe(files: DataFrame, make: Callable[[], Transcriber], schema) -> DataFrame:
    """A model is built once per task by ``make`` and fed a batch at a time."""

    def run(batches: Iterator[pd.DataFrame]):
        model = make()
        for b in batches:
            yield model.transcribe(b)

    return files.mapInPandas(run, schema)


def merge_candidates(known: list[dict], texts: list[str], source: str, scores: list[float] | None = None) -> list[dict]:
    """``known`` with those normalised texts that are new and not empty; ranks go on."""
    seen, out = {" ".join(c["text"].split()) for c in known}, list(known)
    for k, t in enumerate(texts):
        t = " ".join(t.split())
        if t and t not in seen:
            seen.add(t)
            out.append({"rank": len(out) + 1, "text": t, "source": source, "score": None if scores is None else round(float(scores[k]), 4)})
    return out


def generate_candidates(rows: DataFrame, make: Callable[[], CandidateGenerator], sequences: int, sampling: bool = False) -> DataFrame:
    """Adds nbest_candidates; with ``sampling``, a batch in which any row is short is filled up with samples."""
    from pyspark.sql import types as T

    kind = T.ArrayType(T.StructType.fromDDL("rank int, text string, source string, score double"))
    schema = T.StructType([*rows.schema.fields, T.StructField("nbest_candidates", kind), T.StructField("nbest_sampling_fallback", T.BooleanType())])

    def run(batches):
        model = make()
        for b in batches:
            lists = [merge_candidates([], t, "beam") for t in model.beams(b, sequences)]
            if sampling and any(len(x) < sequences for x in lists):
                lists = [merge_candidates(x, t, "sample") for x, t in zip(lists, model.samples(b, max(4, 2 * sequences)))]
            yield b.assign(nbest_candidates=[x[:sequences] for x in lists], nbest_sampling_fallback=sampling)

    return rows.mapInPandas(run, schema)


def generate_texts(rows: DataFrame, make: Callable[[], TextGenerator]) -> DataFrame:
    """Adds generated_text from the column messages."""
    from pyspark.sql import types as T

    schema = T.StructType([*rows.schema.fields, T.StructField("generated_text", T.StringType())])

    def run(batches):
        model = make()
        for b in batches:
            yield b.assign(generated_text=model.generate([list(m) for m in b["messages"]]))

    return rows.mapInPandas(run, schema)
