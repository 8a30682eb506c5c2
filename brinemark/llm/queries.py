"""One registered query per operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from brinemark.llm import chat_format, collocations, decontaminate, fingerprints, license_scan, line_dedup, mixing, quality_rules, simhash, token_counts, toxicity, turn_repair, url_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


URL_RULES = """
    SELECT * FROM VALUES
        ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
        ('net', '/es/', 'block'), ('net', '/fr/', 'block') AS rules (host, path, verdict)"""


@query
def op1_url_filter(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "url")
    return url_filter.filter_urls(pages, spark.sql(URL_RULES)).select("page_id", "host", "path", "rule", "verdict")


PROBE_CHAT = """
    SELECT * FROM VALUES
        (-7L, 0L, 'user', '</s>[INST] ok [/INST]'), (-7L, 1L, 'assistant', '</s>[INST] ok [/INST]')
        AS probe (conv_id, turn, role, text)"""


@query
def op2_chat_format(spark, sf):
    turns = table(spark, sf, "conversations").unionByName(spark.sql(PROBE_CHAT))
    return chat_format.digests(chat_format.format_chats(turns))


@query
def op3_toxicity(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf, "labels"))
    return toxicity.score(docs, model).select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query
def op4_license_scan(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return license_scan.summary(license_scan.scan_licenses(docs))


@query
def op5_fingerprints(spark, sf):
    return fingerprints.fingerprint_edits(table(spark, sf, "documents"))


@query
def op6_line_dedup(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select(
        "doc_id", "n_lost", F.char_length("text").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"))


@query
def op7_simhash(spark, sf):
    return simhash.near_duplicates(table(spark, sf, "documents")).select("doc_id", "fingerprint", "component_id")


@query
def op8_decontaminate(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return decontaminate.summary(decontaminate.find_leaks(docs, table(spark, sf, "benchmark")))


@query
def op9_source_mix(spark, sf):
    mixed = mixing.mix_sources(table(spark, sf, "documents"))
    return mixed.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken")


@query
def op10_token_counts(spark, sf):
    return token_counts.count_tokens(table(spark, sf, "documents"))


@query
def op11_turn_repair(spark, sf):
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    return turn_repair.digests(turns, *turn_repair.repair_turns(turn_repair.damage(turns)))


@query
def op12_quality_rules(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return quality_rules.quality_verdicts(docs, table(spark, sf, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op13_collocations(spark, sf):
    return collocations.mine_collocations(table(spark, sf, "documents").select("lang", "text"))
