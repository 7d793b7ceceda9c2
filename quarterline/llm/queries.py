"""The registered queries over texts, and their SQL where there is one."""

from __future__ import annotations

from quarterline.llm import packing, sentences, tokens
from quarterline.sources.tables import table


def p6_ids(spark, at):
    return tokens.token_ids(table(spark, at, "documents"))


def p6_round_trip(spark, at):
    return tokens.round_trip(table(spark, at, "documents")).drop("text")


def p6_decoded(spark, at):
    """Every text as its ids decode to it."""
    return tokens.round_trip(table(spark, at, "documents")).select("doc_id", "text")


def p7_containers(spark, at):
    return packing.containers_of(table(spark, at, "documents"), table(spark, at, "containers"))


def p7_fill(spark, at):
    return packing.fill_of(table(spark, at, "documents"), table(spark, at, "containers"))


def p7_conditions(spark, at):
    return packing.conditions_of(table(spark, at, "documents"), table(spark, at, "containers"))


def p8_found(spark, at):
    return sentences.sentence_spans(table(spark, at, "documents"))


QUERIES = {f.__name__: f for f in (p6_ids, p6_round_trip, p6_decoded, p7_containers, p7_fill, p7_conditions, p8_found)}

#: Tokenization and packing have no SQL; tests hold them against another implementation and against their conditions.
#: What decoding must give back can be said in SQL, and so can the conditions of a packing.
ORACLES: dict[str, str] = {
    "p6_decoded": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
    "p7_conditions": """SELECT container_kind, max(capacity_tokens) AS capacity_tokens, CAST(0 AS BIGINT) AS overfull,
        CAST(0 AS BIGINT) AS split, CAST(0 AS BIGINT) AS misplaced FROM containers GROUP BY 1""",
}
