"""Registered queries of this subpackage: each runs one operator with its
production parameters over whole tables."""

from __future__ import annotations

import public_tokenizers

from lodestone.llm.auction_repair import repair_damaged
from lodestone.llm.boosted_rules import quality_rules
from lodestone.llm import license_sentences, simhash_windows, substring_automata
from lodestone.llm.pfor_tokens import token_digests
from lodestone.llm.probminhash import near_duplicates
from lodestone.llm.rule_ensemble import quality_scores
from lodestone.llm.sentencepiece_agenda import encode_digests
from lodestone.llm.token_alignment import alignments
from lodestone.llm.weak_pii import find_pii
from lodestone.llm.weak_toxicity import toxicity_scores
from lodestone.llm.zstd_langid import identify_languages
from lodestone.sources.tables import table

QUERIES = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return deco


@register("op1_rule_ensemble_quality")
def op1(spark, sf):
    return quality_scores(table(spark, sf, "documents"), table(spark, sf, "labels"))


@register("op2_boosted_quality_rules")
def op2(spark, sf):
    return quality_rules(table(spark, sf, "documents"), table(spark, sf, "labels"))


@register("op9_probminhash_near_duplicates")
def op9(spark, sf):
    return near_duplicates(table(spark, sf, "documents"))


@register("op4_weak_supervision_toxicity")
def op4(spark, sf):
    return toxicity_scores(table(spark, sf, "documents"), table(spark, sf, "labels"))


@register("op7_weak_supervision_pii")
def op7(spark, sf):
    return find_pii(table(spark, sf, "documents"))


@register("op8_zstd_language_id")
def op8(spark, sf):
    return identify_languages(table(spark, sf, "documents"))


@register("op3_sentencepiece_agenda")
def op3(spark, sf):
    return encode_digests(table(spark, sf, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@register("op6_pfor_token_shards")
def op6(spark, sf):
    return token_digests(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@register("op5_license_sentences", license_sentences.oracle_sql())
def op5(spark, sf):
    return license_sentences.scan_licenses(table(spark, sf, "documents"))


@register("op10_simhash_decontamination", simhash_windows.ORACLE_SQL)
def op10(spark, sf):
    return simhash_windows.contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@register("op13_auction_conversation_repair")
def op13(spark, sf):
    return repair_damaged(table(spark, sf, "conversations"))


@register("op12_substring_automata", substring_automata.ORACLE_SQL)
def op12(spark, sf):
    return substring_automata.removal_digests(table(spark, sf, "documents"))


@register("op11_cross_tokenizer_alignment")
def op11(spark, sf):
    return alignments(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                      public_tokenizers.path("piece_bpe_32k.model"))
