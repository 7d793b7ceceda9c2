"""Sentences of every document with their places, by a tagger that is trained on the documents themselves."""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterline.llm.boundaries import COUNTED_INSIDE, PARTNERS, Model, count_text, sentences, told
from quarterline.sources import files

#: Keys that a task counts before it passes them on.
MOST_COUNTED = 500_000
#: A word has to occur so often inside paragraphs to be known; a rarer one is judged as words in general.
LEAST = 2


def train(documents: DataFrame) -> Model:
    """Counts over all documents, added up before they reach the driver. The model knows every word that occurs at least
    LEAST times inside paragraphs; those must fit on the driver and on each executor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def said() -> pa.RecordBatch:
            resolved = told(counts)
            counts.clear()
            columns = [pa.array(map(_written, resolved), pa.string()), pa.array(resolved.values(), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=["key", "n"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                count_text(text, counts)
                if len(counts) > MOST_COUNTED:
                    yield said()
        yield said()

    said = documents.select("text").mapInArrow(run, "key string, n long")
    keys = said.groupBy("key").agg(F.sum("n").alias("n"))
    part = F.split("key", _BETWEEN)
    partner = F.create_map(*(F.lit(x) for pair in PARTNERS.items() for x in pair))
    told_of = F.when(F.get(part, F.lit(0)).isin(*PARTNERS), F.concat(F.element_at(partner, F.get(part, F.lit(0))), F.lit(_BETWEEN), F.get(part, F.lit(1))))
    # A word has a handful of keys; one that tells of all words is a group of its own.
    words = keys.groupBy(F.coalesce(told_of, "key").alias("word")).agg(
        F.collect_list(F.struct("key", "n")).alias("keys"), F.bool_or(told_of.isNull()).alias("general"),
        F.sum(F.when(F.get(part, F.lit(0)).isin(*COUNTED_INSIDE), F.col("n"))).alias("inside"),
    )
    known = words.where((F.col("inside") >= LEAST) | F.col("general")).select(F.inline("keys")).toArrow()
    return Model(Counter(dict(zip(map(_read, known["key"].to_pylist()), known["n"].to_pylist(), strict=True))))


_BETWEEN = "\x1f"


def _written(key: tuple) -> str:
    """A key as text: its parts between separators, which are white space and stand in none but by accident."""
    return _BETWEEN.join([x.replace(_BETWEEN, " ") if isinstance(x, str) else str(int(x)) for x in key])


def _read(text: str) -> tuple:
    name, *rest = text.split(_BETWEEN)
    if name in "uv":
        return name, rest[0], rest[1] == "1"
    return (name, int(rest[0]), rest[1] == "1") if name == "a" else (name, *rest)


def save(model: Model, spark: SparkSession, path: str) -> None:
    """Keep a trained model, so that the sentences of later texts don't depend on their company. Fails if it is there."""
    if not files.write_text(spark, path, json.dumps([[*k, n] for k, n in model.counts.items()])):
        raise FileExistsError(path)


def load(spark: SparkSession, path: str) -> Model:
    return Model(Counter({tuple(k): n for *k, n in json.loads(files.read_text(spark, path))}))


def sentence_spans(documents: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, start_char, end_char: one row per sentence, in code points, end exclusive, white space around left out.

    Null, empty and blank texts have none; a text that is no prose is one sentence, whatever its length. Whole texts,
    one pass after training, no shuffle. Without a model one is trained on the documents themselves.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model or train(documents))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = shared.value
        for batch in batches:
            found = [sentences(t, tagger) if t else [] for t in batch.column(1).to_pylist()]
            flat = np.fromiter(chain.from_iterable(chain.from_iterable(found)), np.int64).reshape(-1, 2)
            place = np.repeat(np.arange(len(found)), [len(spans) for spans in found])
            ids = batch.column(0).take(pa.array(place))
            yield pa.RecordBatch.from_arrays([ids, pa.array(flat[:, 0]), pa.array(flat[:, 1])], names=["doc_id", "start_char", "end_char"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, start_char long, end_char long")
