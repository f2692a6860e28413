"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import oracle, quality_classifier, toxicity
from strata.llm.common import read_table
from strata.llm.decontam import benchmark_hits
from strata.llm.fill_middle import fill_middle, restored
from strata.llm.html_extract import extract
from strata.llm.line_dedup import line_report
from strata.llm.packing import byte_bpe_encoder, pack
from strata.llm.quality_rules import judge
from strata.llm.sampling import id_crc
from strata.llm.secret_scan import KINDS, find_secrets, span_text
from strata.llm.simhash import near_duplicates
from strata.llm.substring_dedup import remove_repeats
from strata.llm.token_counts import Vocabulary, token_counts
from strata.llm.vector_codes import compress, with_label_error

PIECE_COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
QUALITY_THRESHOLD = 0.3


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def bpe_encoder(path: str | None = None):
    return byte_bpe_encoder(path or tokenizer_path("byte_bpe_50k.json"))


def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"), bpe_encoder).select(*PIECE_COLUMNS)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(read_table(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    known = read_table(spark, sf_dir, "labels").where(id_crc() % 3 != 1)
    scored = toxicity.score(docs, toxicity.fit(docs, known))
    return scored.select("doc_id", (id_crc() % 3 == 1).alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"), "offending")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = benchmark_hits(read_table(spark, sf_dir, "documents"),
                           read_table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"),
                        lambda acc, x: acc + (x["e"] - x["s"]).cast("long"))
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"))


def op8_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read_table(spark, sf_dir, "pages")).withColumn(
        "n_chars", F.char_length("text").cast("long"))


def piece_vocabulary(path: str | None = None) -> Vocabulary:
    return Vocabulary.from_piece_file(path or tokenizer_path("piece_bpe_32k.model"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read_table(spark, sf_dir, "documents"), piece_vocabulary)


def quality_model(docs: DataFrame, labels: DataFrame) -> quality_classifier.QualityModel:
    """Learned from the labels whose id remainder modulo 5 is not 0."""
    return quality_classifier.fit(docs, labels.where(id_crc() % 5 != 0))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = quality_model(docs, read_table(spark, sf_dir, "labels"))
    return quality_classifier.score(docs, model, ["doc_id"]).select(
        "doc_id", (id_crc() % 5 == 0).alias("held_out"), "score",
        (F.col("score") >= QUALITY_THRESHOLD).cast("int").alias("predicted"))


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle(read_table(spark, sf_dir, "documents"), ["doc_id"])
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restored(), 256).alias("restored_sha256"))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(read_table(spark, sf_dir, "documents"), keep=["doc_id"])
    base = F.filter("secrets", lambda s: s["odds"].isNull())

    def count(kind: str):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, KINDS), F.sha2(span_text(base), 256).alias("base_sha256"),
                        span_text(F.col("secrets")).alias("spans"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = compress(read_table(spark, sf_dir, "embeddings"), keep=["vec_id", "label"])
    return with_label_error(found.rows).select("vec_id", "code", "error", "label_error",
                                               F.lit(found.digest()).alias("codebooks_sha256"))


QUERIES = {
    "op1_pack": op1_pack,
    "op2_line_dedup": op2_line_dedup,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_quality_rules": op4_quality_rules,
    "op5_toxicity": op5_toxicity,
    "op6_simhash": op6_simhash,
    "op7_decontaminate": op7_decontaminate,
    "op8_html_extract": op8_html_extract,
    "op9_token_counts": op9_token_counts,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_fill_middle": op11_fill_middle,
    "op12_secret_scan": op12_secret_scan,
    "op13_vector_codes": op13_vector_codes,
}
ORACLE = {
    "op3_substring_dedup": oracle.SUBSTRING_DEDUP,
    "op4_quality_rules": oracle.QUALITY_RULES,
    "op7_decontaminate": oracle.DECONTAMINATE,
    "op11_fill_middle": oracle.FILL_MIDDLE,
}
