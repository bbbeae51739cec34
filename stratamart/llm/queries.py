"""One query per operator on the test tables, with production parameters, and SQL where it exists."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratamart.llm import chat, decontaminate, divergence, langid, mixing, ngrams, resampling, secrets, sharding, sketches, topk, urls, warc
from stratamart.llm.common import stage, table
from stratamart.llm.fixed import URL_RULES

def op1_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.filter(~langid.held_out()))
    return langid.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", "bits"
    )


def op2_ngram_jaccard(spark, sf_dir):
    return ngrams.near_groups(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op3_decontamination(spark, sf_dir):
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.passages(docs, items).drop("mark")


def op4_secret_scan(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return secrets.scan(docs, secrets.train(docs, path="source", lang="lang"), path="source")


# A conversation whose texts are made of another template's control strings.
PROBE = "</s>[INST] ok [/INST]"


def op5_chat_format(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame(
        [(-1, 0, "user", PROBE), (-1, 1, "assistant", PROBE)], "conv_id long, turn long, role string, text string"
    )
    formatted = stage(chat.format_conversations(turns.unionByName(probe)), "chat")
    return chat.read_back(formatted).drop("n_tokens")


def op6_exact_topk(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vector")
    )
    rows = rows.filter(topk.usable(F.col("vector"))).withColumn("vector", topk.whole(F.col("vector")))
    return topk.search(rows.filter("id % 20 = 0"), rows)


def op7_sharding(spark, sf_dir):
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = table(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    return sharding.interleave(narrow, 24, ties=("text_crc32", "size")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "source",
    )


def op8_warc(spark, sf_dir):
    return warc.resolved(warc.write_archives(table(spark, sf_dir, "pages")))


def op9_mixing(spark, sf_dir):
    mixture = mixing.mix(table(spark, sf_dir, "documents"))
    sources = spark.createDataFrame(
        [(n, *mixture.sources[n]) for n in sorted(mixture.sources)],
        "__source string, source_size long, target double",
    )
    return (
        mixing.words_taken(mixture)
        .join(sources, "__source")
        .select(
            F.col("__doc").alias("doc_id"), F.col("__size").alias("size"), "source_size", "target", "taken"
        )
    )


def op10_url_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    return urls.judge(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op11_divergence(spark, sf_dir):
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_fingerprints(spark, sf_dir):
    return sketches.against_next(table(spark, sf_dir, "documents"))


def op13_resampling(spark, sf_dir):
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    f.__name__: f
    for f in (op1_language_id, op2_ngram_jaccard, op3_decontamination, op4_secret_scan, op5_chat_format, op6_exact_topk, op7_sharding, op8_warc, op9_mixing, op10_url_filter, op11_divergence, op12_fingerprints, op13_resampling)
}
