"""Operators for training data: near duplicates, chat logs, packing, rules, tokens, shards."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    bpe,
    chat,
    embeddings,
    langid,
    merkle,
    minhash,
    packing,
    quality,
    secrets,
    sharding,
    suffixes,
    trie,
    windows,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        minhash.op1_minhash_dedup,
        chat.op2_chat_format,
        packing.op3_best_fit_packing,
        embeddings.op4_embedding_dedup,
        quality.op5_quality_rules,
        bpe.op6_bpe,
        sharding.op7_hilbert_shards,
        langid.op8_language_id,
        suffixes.op9_suffix_dedup,
        secrets.op10_secret_scan,
        merkle.op11_merkle_manifest,
        trie.op12_prefix_trie,
        windows.op13_ordered_packing,
    )
    return {build.__name__: build for build in found}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_chat_format": chat.OP2_SQL,
        "op11_merkle_manifest": merkle.OP11_SQL,
        "op12_prefix_trie": trie.OP12_SQL,
    }
