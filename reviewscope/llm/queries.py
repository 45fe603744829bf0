"""Registered queries of the training-data operators and their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewscope.llm import chat_format, collocations, decontaminate, html_extract, language_id, lexical_search, mixing, near_dedup, outliers, secret_scan, sharding, substring_dedup, suffix_dedup
from reviewscope.llm.common import read_table
from reviewscope.llm.sql import CHATS_SQL, COLLOCATIONS_SQL, SEARCH_SQL, SECRETS_SQL, SUFFIXES_SQL

LLM_QUERIES = {}
LLM_SQL = {
    "op1_secret_scan": SECRETS_SQL, "op2_chat_format": CHATS_SQL, "op11_suffix_dedup": SUFFIXES_SQL,
    "op12_lexical_search": SEARCH_SQL, "op13_collocations": COLLOCATIONS_SQL,
}


def query(run):
    LLM_QUERIES[run.__name__] = run
    return run


@query
def op1_secret_scan(spark, sf_dir):
    found = secret_scan.scan_secrets(read_table(spark, sf_dir, "documents"))
    kinds = [r.kind for r in secret_scan.BASE_RULES]

    def of(*names):
        return F.filter("spans", lambda s: s["kind"].isin(*names))

    return found.select(
        "doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in kinds],
        F.sha2(secret_scan.span_text(of(*kinds)), 256).alias("base_sha256"),
        secret_scan.span_text(F.col("spans")).alias("spans"),
    )


@query
def op2_chat_format(spark, sf_dir):
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = r"\### Assistant: </turn> ok"
    added = spark.createDataFrame([(-7, 0, "user", control), (-7, 1, "assistant", control)], rows.schema)
    chats = chat_format.canonical_turns(chat_format.gather_turns(rows.unionByName(added)), "chat")
    out = chat_format.format_chats(chats).select(
        "conv_id", "formatted",
        chat_format.read_back(F.col("formatted")).alias("turns"),
        chat_format.masked_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


@query
def op3_substring_dedup(spark, sf_dir):
    found = substring_dedup.dedup_passages(read_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "n_removed", F.coalesce(F.sha2("kept_text", 256), F.col("words_sha256")).alias("kept_sha256"),
    )


@query
def op4_decontamination(spark, sf_dir):
    found = decontaminate.find_leaks(read_table(spark, sf_dir, "documents").select("doc_id", "text"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", (F.size("leaked_items") == 0).alias("kept"), F.col("leaked_items").alias("item_ids"), "leaked_tokens")


@query
def op5_sharding(spark, sf_dir):
    return sharding.shard_documents(read_table(spark, sf_dir, "documents")).drop("group")


@query
def op6_source_mixing(spark, sf_dir):
    mixed = mixing.mix_sources(read_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies", F.round("rate", 6).alias("rate"))


@query
def op10_quality_outliers(spark, sf_dir):
    judged = outliers.judge_quality(read_table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("d2", 4).alias("distance"),
    )


@query
def op7_near_dedup(spark, sf_dir):
    return near_dedup.near_duplicates(read_table(spark, sf_dir, "documents")).drop("text_class")


@query
def op8_language_id(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    models = language_id.fit_languages(docs.where(~language_id.held_out("doc_id")))
    found = language_id.identify(docs.select("doc_id", "text"), models)
    return found.select("doc_id", language_id.held_out("doc_id").alias("held_out"), "lang_pred", "score", "rejected")


@query
def op9_html_extraction(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = html_extract.extract_pages(pages, weights=html_extract.fit_weights(pages))
    return found.select("page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars"))


@query
def op11_suffix_dedup(spark, sf_dir):
    found = suffix_dedup.dedup_bytes(read_table(spark, sf_dir, "documents"), keep="none")
    return found.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.coalesce(F.sha2("kept", 256), F.col("text_sha256")).alias("kept_sha256"),
    )


@query
def op12_lexical_search(spark, sf_dir):
    return lexical_search.rank_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@query
def op13_collocations(spark, sf_dir):
    return collocations.collocations(read_table(spark, sf_dir, "documents"))
