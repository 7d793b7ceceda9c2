"""Token ids and token counts of every document."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

from quarterline.llm.bpe import Transducer, decode_stream, merge_pairs, parse_ranks, sufficient_lookahead

VOCABULARIES = "/opt/tokenizers"
RANKS = "byte_bpe_50k.tiktoken"
#: A vocabulary beyond this isn't broadcast.
LARGEST_VOCABULARY = 64 << 20


@lru_cache(maxsize=4)
def _vocabulary(path: str) -> tuple[bytes, int]:
    file = Path(path).read_bytes()
    if len(file) > LARGEST_VOCABULARY:
        raise ValueError(f"{path} is larger than {LARGEST_VOCABULARY} bytes")
    return file, sufficient_lookahead(merge_pairs(parse_ranks(file)))


_ENCODERS: dict[tuple[int, int], Transducer] = {}


def _encoder(shared: Broadcast) -> Transducer:
    """One per Python worker."""
    file, lookahead = shared.value
    key = (hash(file), lookahead)
    if key not in _ENCODERS:
        _ENCODERS[key] = Transducer(parse_ranks(file), lookahead)
    return _ENCODERS[key]


def _shared(df: DataFrame, vocabularies: str) -> Broadcast:
    """The vocabulary file read by the driver, so that executors need no file of their own."""
    return df.sparkSession.sparkContext.broadcast(_vocabulary(f"{vocabularies}/{RANKS}"))


def token_ids(documents: DataFrame, vocabularies: str = VOCABULARIES) -> DataFrame:
    """doc_id and ids, without special tokens; null and empty texts have the empty list. Whole texts, one pass, no
    shuffle; strings that look like special tokens are ordinary text."""
    shared = _shared(documents, vocabularies)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(shared).encode
        for batch in batches:
            encoded = [encode(t) if t else b"" for t in batch.column(1).to_pylist()]
            ends = np.cumsum([0, *(len(e) // 4 for e in encoded)], dtype=np.int64)
            # Offsets are 32-bit: a batch of more ids than that goes out in several.
            cuts = [0]
            for i in range(1, len(encoded) + 1):
                if i == len(encoded) or ends[i + 1] - ends[cuts[-1]] > 1 << 24:
                    cuts.append(i)
            for a, b in zip(cuts, cuts[1:], strict=False):
                ids = pa.array(np.frombuffer(b"".join(encoded[a:b]), np.int32))
                lists = pa.ListArray.from_arrays(pa.array((ends[a : b + 1] - ends[a]).astype(np.int32)), ids)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), lists], names=["doc_id", "ids"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def token_counts(documents: DataFrame, vocabularies: str = VOCABULARIES) -> DataFrame:
    """doc_id and n_tokens; 0 for null and empty texts."""
    shared = _shared(documents, vocabularies)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(shared).encode
        for batch in batches:
            counts = [len(encode(t)) // 4 if t else 0 for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], names=["doc_id", "n_tokens"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long")


def decoded(encoded: DataFrame, vocabularies: str = VOCABULARIES) -> DataFrame:
    """doc_id and text of doc_id, ids."""
    shared = _shared(encoded, vocabularies)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = {i: t for t, i in _encoder(shared).ranks.items()}
        for batch in batches:
            texts = ["".join(decode_stream(ids or (), tokens)) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(documents: DataFrame, vocabularies: str = VOCABULARIES) -> DataFrame:
    """doc_id, n_tokens, the text decoded from its ids (empty for null), and whether that is the text. Encoded once and
    decoded in the same pass, no shuffle."""
    shared = _shared(documents, vocabularies)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared)
        tokens = {i: t for t, i in encoder.ranks.items()}
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            ids = [np.frombuffer(encoder.encode(t), np.int32) for t in texts]
            back = ["".join(decode_stream(x.tolist(), tokens)) for x in ids]
            columns = [pa.array(map(len, ids), pa.int64()), pa.array(back, pa.string()), pa.array([a == b for a, b in zip(texts, back, strict=True)])]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "n_tokens", "text", "same"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, text string, same boolean")
