"""Registered queries of the operators, each over its whole table, and their DuckDB SQL."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import decontam, langid, licenses, linededup, onepermutation, packing, pieces, repair, resampling, simhash, suffix, tokenbin, toxicity
from .common import read_table, ship

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(ship(spark), sf_dir, "documents")


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.leaks(_docs(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "coverage", "tiles")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": lambda s, d: linededup.line_dedup(_docs(s, d)),
    "op2_license_scan": lambda s, d: licenses.license_scan(_docs(s, d)),
    "op3_document_fingerprints": lambda s, d: onepermutation.document_fingerprints(_docs(s, d)),
    "op4_simhash": lambda s, d: simhash.near_duplicates(_docs(s, d)),
    "op5_token_bin": lambda s, d: tokenbin.token_bin(_docs(s, d), BYTE_BPE),
    "op6_decontamination": op6,
    "op7_piece_sampling": lambda s, d: pieces.round_trip(_docs(s, d), PIECES),
    "op8_suffix_dedup": lambda s, d: suffix.suffix_dedup(_docs(s, d)),
    "op9_language_id": lambda s, d: langid.identify(_docs(s, d)),
    "op10_toxicity": lambda s, d: toxicity.toxicity(_docs(s, d), read_table(s, d, "labels")),
    "op11_conversation_repair": lambda s, d: repair.conversation_repair(read_table(s, d, "conversations")),
    "op12_importance_resampling": lambda s, d: resampling.resample(_docs(s, d), read_table(s, d, "benchmark")),
    "op13_packing": lambda s, d: packing.digests(packing.pack(_docs(s, d), WORD_BPE)),
}
ORACLE_SQL = {
    "op1_line_dedup": linededup.ORACLE_SQL,
    "op2_license_scan": licenses.ORACLE_SQL,
}
