"""The queries of this folder: each operator over its whole table."""

from __future__ import annotations

from forkcast.llm import bpe_automaton, chat, decontam, importance, license_join, lsh_forest, oracles, prefix_trie, quality_pu, rules_cascade, secret_scan, substring, url_rules, warc
from forkcast.llm.registry import ORACLE, QUERIES, register, table
from forkcast.sources.sinks import scratch_path
from pyspark.sql import functions as F

__all__ = ["ORACLE", "QUERIES"]


def tokenizer_path() -> str:
    """The vocabulary file of op3."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@register("op1_pu_quality")
def op1(spark, sf_dir):
    """Quality scores of all documents."""
    return quality_pu.digests(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


register("op2_chat_format", chat.SQL)(chat.query)


@register("op3_bpe_automaton")
def op3(spark, sf_dir):
    """Token ids of all documents, and what they decode to."""
    return bpe_automaton.digests(table(spark, sf_dir, "documents"), tokenizer_path())


@register("op4_secret_scan")
def op4(spark, sf_dir):
    """Secrets in all documents."""
    return secret_scan.digests(secret_scan.scan(table(spark, sf_dir, "documents")))


@register("op5_rules_cascade", oracles.RULES_CASCADE)
def op5(spark, sf_dir):
    """Quality rules over all documents."""
    found = rules_cascade.judge(table(spark, sf_dir, "documents"))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return found.withColumn("base_failed", failed).withColumn("kept", F.col("kept") & ~failed)


@register("op6_url_rules")
def op6(spark, sf_dir):
    """Verdicts on the urls of all pages."""
    return url_rules.judge(table(spark, sf_dir, "pages"))


@register("op7_license_join", oracles.LICENSE_JOIN)
def op7(spark, sf_dir):
    """License phrases and notices in all documents."""
    return license_join.digests(license_join.scan(table(spark, sf_dir, "documents")))


@register("op8_spaced_seed_decontam")
def op8(spark, sf_dir):
    """Benchmark items that documents leak."""
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op9_minhash_near_dedup", oracles.NEAR_DUPLICATES)
def op9(spark, sf_dir):
    """Near-duplicate components of all documents (similarity 0.85 or more)."""
    return lsh_forest.near_duplicates(table(spark, sf_dir, "documents"), least_percent=85)


@register("op10_count_min_substring", oracles.REPEATS)
def op10(spark, sf_dir):
    """What is left of all documents without passages that earlier ones have."""
    return substring.digests(table(spark, sf_dir, "documents"))


@register("op11_prefix_trie", oracles.PREFIX_TRIE)
def op11(spark, sf_dir):
    """The prefix trie of all conversations, grown from shared heads."""
    said, conversations = prefix_trie.share_heads(prefix_trie.turns(table(spark, sf_dir, "conversations")))
    return prefix_trie.digests(*prefix_trie.build(said, conversations))


@register("op12_importance_resampling", oracles.IMPORTANCE)
def op12(spark, sf_dir):
    """Documents drawn towards the benchmark's distribution."""
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op13_warc_index", oracles.WARC)
def op13(spark, sf_dir):
    """All pages written as archives, read back and indexed.

    The pages carry no capture time; a page's is its id in seconds after 2020 began."""
    path = scratch_path(spark, "warc")
    seconds = F.lit(1577836800) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(1_000_000_000))
    warc.write(table(spark, sf_dir, "pages"), path, warc.capture_date(seconds))
    return warc.digests(warc.index(warc.read(spark, path)))
