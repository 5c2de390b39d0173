"""Registered queries of the operators: thin calls over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnframe.llm import oracle
from churnframe.llm.common import table


def op1_html_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnframe.llm.html_template import extract
    out = extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", F.col("main_text").alias("text"),
                      F.length("main_text").cast("long").alias("n_chars"))


def op2_bpe_forced_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnframe.llm.bpe import encode_decode, sha256
    coded = encode_decode(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return coded.select("doc_id", F.col("bpe_n_tokens").alias("n_tokens"),
                        sha256("bpe_ids").alias("ids_sha256"),
                        sha256("bpe_decoded").alias("decoded_sha256"))


def op3_simhash_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnframe.llm.decontaminate import contaminated_documents
    return contaminated_documents(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                  table(spark, sf_dir, "benchmark"))


def op4_pii_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnframe.llm import pii
    out = pii.detect(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", *[pii.count_kind(F.col("base_spans"), k).alias(f"n_{k}") for k in pii.BASE_KINDS],
                      F.sha2(pii.span_text(F.col("base_spans")), 256).alias("base_sha256"),
                      pii.span_text(F.col("all_spans")).alias("spans"))


def op5_secret_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnframe.llm import secrets_scan as ss
    out = ss.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", *[ss.count_kind(F.col("base_spans"), k).alias(f"n_{k}") for k in ss.BASE_KINDS],
                      F.sha2(ss.span_text(F.col("base_spans")), 256).alias("base_sha256"),
                      ss.span_text(F.col("all_spans")).alias("spans"))


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnframe.llm.ngram_join import with_components
    return with_components(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnframe.llm.line_dedup import line_verdicts
    lines = line_verdicts(table(spark, sf_dir, "documents").select("doc_id", "text"))
    gone = F.sort_array(F.collect_list(F.when(F.col("removed"), F.col("line"))))
    return lines.groupBy(F.col("doc").alias("doc_id")).agg(
        F.count_if(F.col("n") > 0).alias("n_lines"), F.count_if("removed").alias("n_removed"),
        F.array_join(gone.cast("array<string>"), ",").alias("removed_lines"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnframe.llm.quality_rules import judge
    return judge(table(spark, sf_dir, "documents"), carry=["doc_id"])


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnframe.llm.bigru import predict, train
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    fitted = train(docs.filter(~held).select("doc_id", "text", "lang"))
    out = predict(docs.select("doc_id", held.alias("held_out"), "text"), fitted)
    return out.select("doc_id", "held_out", "lang_pred", "score")


def op10_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnframe.llm.ordinal import score, train
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    # grades: 0 toxic, 1 low quality, 2 good
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)
    model = train(docs, table(spark, sf_dir, "labels"), grade)
    out = score(docs, model, keep_at=model.keep_at() if model else 0.5)
    return out.select("doc_id", "expected_grade", F.get("tails", F.lit(0)).alias("p_not_toxic"),
                      F.get("tails", F.lit(1)).alias("p_good"), "kept")


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnframe.llm.collocations import collocations
    return collocations(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnframe.llm.align import align_tokenizers
    return align_tokenizers(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnframe.llm.chat_format import digest, format_chats
    hard = r"\### Assistant: </turn> ok"
    own = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)],
                                "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return digest(format_chats(rows))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_template": op1_html_template,
    "op2_bpe_forced_boundaries": op2_bpe_forced_boundaries,
    "op3_simhash_decontamination": op3_simhash_decontamination,
    "op4_pii_weak_supervision": op4_pii_weak_supervision,
    "op5_secret_entropy": op5_secret_entropy,
    "op6_ngram_jaccard": op6_ngram_jaccard,
    "op7_line_dedup": op7_line_dedup,
    "op8_quality_rules": op8_quality_rules,
    "op9_language_id": op9_language_id,
    "op10_ordinal_quality": op10_ordinal_quality,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_tokenizer_alignment": op12_tokenizer_alignment,
    "op13_chat_format": op13_chat_format,
}

ORACLE: dict[str, str] = {
    "op3_simhash_decontamination": oracle.OP3,
    "op6_ngram_jaccard": oracle.OP6,
    "op7_line_dedup": oracle.OP7,
    "op8_quality_rules": oracle.OP8,
    "op11_phrase_collocations": oracle.OP11,
    "op13_chat_format": oracle.OP13,
}
