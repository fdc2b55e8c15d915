"""The registered queries of the training-data operators: whole tables in, the contracts' columns out."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tulha.llm import (
    bpe,
    chat,
    decontaminate,
    filter_audit,
    jaccard_join,
    main_text,
    mixing,
    neighbours,
    personal_data,
    resampling,
    secrets,
    token_counts,
    toxicity,
)
from tulha.llm.tables import table


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    base = [r.kind for r in secrets.BASE_RULES]
    found = found.select("doc_id", "spans", F.filter("spans", lambda s: s["kind"].isin(base)).alias("base_spans"))
    digest = F.sha2(joined_spans("base_spans"), 256).alias("base_sha256")
    return found.select("doc_id", *_counts("base_spans", base), digest, joined_spans("spans").alias("spans"))


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every maximal conversation, rendered."""
    return chat.format_chats(table(spark, sf_dir, "conversations"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, of its source line, and of each line of its text."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), ["source", "text"], ["doc_id"])


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document with its class of near copies and its number of links."""
    found = jaccard_join.jaccard_classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "n_links", "n_copies", "n_grams")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows found in every document."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest, "contaminated")


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return main_text.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score for every document."""
    found = toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.mix_documents(table(spark, sf_dir, "documents"), keep=["doc_id"])


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = personal_data.find_personal_data(documents, personal_data.learn(documents))
    return found.select("doc_id", *_counts("base_spans", personal_data.BASE_KINDS), F.sha2(joined_spans("base_spans"), 256).alias("base_sha256"), joined_spans("spans").alias("spans"))


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest 20 of every twentieth vector among all others."""
    vectors = neighbours.clean_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return neighbours.nearest(vectors.filter("vec_id % 20 = 0"), vectors)


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids and the bytes they decode to, as digests."""
    encoded = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    decoded = bpe.decode(encoded)
    return decoded.select("doc_id", bpe.n_tokens("ids").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's weight towards the benchmark, and its rank in the draw."""
    found = resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove of each source, in every order."""
    return filter_audit.audit_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _counts(column: str, kinds: Sequence[str]) -> list[Column]:
    """n_<kind> for each kind of the spans."""
    own = F.transform(column, lambda s: s["kind"])
    return [(F.size(own) - F.size(F.array_remove(own, k))).cast("long").alias(f"n_{k}") for k in kinds]


def joined_spans(column: str) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secrets": op1_secrets,
    "op2_chat_format": op2_chat_format,
    "op3_token_counts": op3_token_counts,
    "op4_ngram_jaccard": op4_ngram_jaccard,
    "op5_decontamination": op5_decontamination,
    "op6_main_text": op6_main_text,
    "op7_toxicity": op7_toxicity,
    "op8_mixing": op8_mixing,
    "op9_personal_data": op9_personal_data,
    "op10_neighbours": op10_neighbours,
    "op11_byte_bpe": op11_byte_bpe,
    "op12_resampling": op12_resampling,
    "op13_filter_audit": op13_filter_audit,
}
