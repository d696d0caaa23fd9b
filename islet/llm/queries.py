"""The operators' queries over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from islet.llm import cascade, chat, decontaminate, exact_substrings, infill, langid, mixing, order_minhash, packing, prefix_trie, setsketch, templates, warc
from islet.llm.common import staged_path, table


def op1_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as WARC records, read back from the archives."""
    path = staged_path(spark, "warc")
    pages = table(spark, sf_dir, "pages")
    warc.write(pages.select(F.col("page_id").alias("key"), F.col("url").alias("uri"), F.col("html").cast("binary").alias("payload")), path)
    back = warc.restore(warc.read(spark, path, with_payload=False))
    kind = pages.schema["page_id"].dataType
    return back.select(
        F.col("key").cast(kind).alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"), "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )


def op2_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, their edited texts and their next documents."""
    d = order_minhash.edits(table(spark, sf_dir, "documents"))
    own, edited, after = (F.col(f"{x}signature") for x in ("", "edited_", "next_"))
    return d.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        order_minhash.as_string(own).alias("fingerprint"), order_minhash.as_string(edited).alias("edited_fingerprint"),
        order_minhash.likeness(own, edited).alias("near_edited"), order_minhash.likeness(own, after).alias("near_next"),
    )


def op3_induced_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, strings of 400 bytes; besides, passages of over 50 words
    that stand anywhere else, which can be shorter."""
    return exact_substrings.summary(table(spark, sf_dir, "documents"))


def op4_sainte_lague(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, 150% of their words, weights 5, 2, 1 by source."""
    plan = mixing.mix(table(spark, sf_dir, "documents"), ["doc_id"])
    return plan.select("row.doc_id", "size", "source_size", "target", "taken")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items, windows of ten words."""
    found = decontaminate.find(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op6_language_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, by a model of those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.filter(~langid.held_out()).select("text", "lang"))
    found = langid.label(docs.select("doc_id", "text"), model)
    return found.select(F.col("row.doc_id").alias("doc_id"), "lang_pred", "score").withColumn("held_out", langid.held_out())


def op7_site_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages, their sites' templates counted over all of them."""
    found = templates.extract(table(spark, sf_dir, "pages"))
    return found.select("row.page_id", "row.url", "text", F.length("text").cast("long").alias("n_chars"))


def op8_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations with an assistant turn, each against the reply of the
    next one."""
    pairs = chat.preference(chat.with_rejected(chat.gather(table(spark, sf_dir, "conversations"))))
    return pairs.drop("chosen", "rejected")


#: The rules (verdict, host, path).
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def op9_bloom_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All page urls by five rules."""
    found = cascade.judge(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return found.select("row.page_id", "host", "path", "rule", "verdict")


def op10_setsketch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, five-word shingles, similarity of 0.75 or more."""
    return setsketch.near_dedup(table(spark, sf_dir, "documents")).drop("text_key")


def op11_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as fill-in-middle texts, and back."""
    found = infill.fill_in_middle(table(spark, sf_dir, "documents"), ["doc_id"])
    digest = lambda x: F.sha2(x.cast("binary"), 256)
    return found.select(
        "row.doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"),
        digest(infill.restored(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )


def op12_tournament_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 1024 tokens."""
    return packing.pack(table(spark, sf_dir, "documents")).drop("ids")


def op13_centroid_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, rebuilt on the first turns of each hundred's first."""
    turns = prefix_trie.rebuilt(prefix_trie.numbered(table(spark, sf_dir, "conversations")))
    return prefix_trie.trie(turns)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_warc_revisits, op2_order_minhash, op3_induced_suffixes, op4_sainte_lague, op5_decontaminate, op6_language_spans, op7_site_templates, op8_preference_pairs, op9_bloom_cascade, op10_setsketch_dedup, op11_infill, op12_tournament_packing, op13_centroid_trie)
}
