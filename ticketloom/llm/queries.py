"""The operators of this subpackage as named queries over the given tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.llm import audit, chat, language, packing, pieces, search, secret_scan, simhash, toxicity, urls, vectors, warc

from ticketloom.session import new_work_dir

WORD_TOKENIZER = "word_bpe_49k.json"
PIECE_MODEL = "piece_bpe_32k.model"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return packing.pack(docs, public_tokenizers.path(WORD_TOKENIZER), capacity=4096, end_id=1)


def op2_embedding_near_dedup(spark, sf_dir):
    return vectors.near_vectors(read_table(spark, sf_dir, "embeddings"), min_cosine=0.95)


def op3_chat_formatting(spark, sf_dir):
    return chat.link_quotations(read_table(spark, sf_dir, "conversations"))


def op4_language_id(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return language.identify(docs, language.fit(docs))


URL_RULES = [
    urls.Rule("allow", "com", "/"),
    urls.Rule("block", "example.com", "/en/"),
    urls.Rule("allow", "www.example.com", "/en/"),
    urls.Rule("block", "net", "/es/"),
    urls.Rule("block", "net", "/fr/"),
]


def op5_url_filters(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages")
    return urls.judge(pages, URL_RULES, urls.fit(pages, URL_RULES, cut_urls_per_class=None))


def op6_warc(spark, sf_dir):
    folder = new_work_dir(spark, "warc")
    warc.write_archives(warc.with_revisits(read_table(spark, sf_dir, "pages"), min_bytes=0), folder)
    # A response's length is that of the payload read back.
    read = F.when(F.col("record_type") == "response", F.octet_length("payload").cast("long"))
    return warc.read_archives(spark, folder, fail_fast=True).select(
        warc.page_id_of("record_id").alias("page_id"),
        F.coalesce(read, "payload_bytes").alias("payload_bytes"),
        F.substring("payload_digest", 6, 32).alias("payload_digest"),
        "record_type",
        warc.page_id_of("refers_to").alias("refers_to"),
    )


def op7_toxicity(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model)


def op8_simhash_near_dedup(spark, sf_dir):
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle_words=4, max_bits=4)
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op9_nearest_neighbours(spark, sf_dir):
    return vectors.nearest_neighbours(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op10_sentencepiece(spark, sf_dir):
    path = public_tokenizers.path(PIECE_MODEL)
    encoded = pieces.encode(read_table(spark, sf_dir, "documents"), path)
    return pieces.decode(encoded, path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


def op11_lexical_search(spark, sf_dir):
    index = search.build_index(read_table(spark, sf_dir, "documents"))
    return search.search(index, read_table(spark, sf_dir, "benchmark"), k=20)


def op12_secret_scan(spark, sf_dir):
    found, findings = secret_scan.scan(read_table(spark, sf_dir, "documents")), F.col("findings")
    number = lambda kind: F.size(F.filter(findings, lambda f: f["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = ("assign", "access", "hex")
    return found.select(
        "doc_id",
        *[number(kind) for kind in base],
        F.sha2(secret_scan.joined(findings, base), 256).alias("base_sha256"),
        secret_scan.joined(findings).alias("spans"),
    )


def op13_filter_audit(spark, sf_dir):
    return audit.audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_embedding_near_dedup": op2_embedding_near_dedup,
    "op3_chat_formatting": op3_chat_formatting,
    "op4_language_id": op4_language_id,
    "op5_url_filters": op5_url_filters,
    "op6_warc": op6_warc,
    "op7_toxicity": op7_toxicity,
    "op8_simhash_near_dedup": op8_simhash_near_dedup,
    "op9_nearest_neighbours": op9_nearest_neighbours,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_lexical_search": op11_lexical_search,
    "op12_secret_scan": op12_secret_scan,
    "op13_filter_audit": op13_filter_audit,
}
