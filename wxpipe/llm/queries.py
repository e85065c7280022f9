"""The registered queries of this subpackage: one per operator, over whole tables.

Their SQL is in :mod:`.oracles`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ball_codes import encode
from .benchmark_scan import contamination, is_contaminated
from .chat_format import format_conversations, read_loss, read_turns
from .chosen_path import near_duplicates
from .common import read_table
from .hard_negatives import hard_negatives
from .host_rules import host_rules
from .line_join import line_report
from .packing import pack
from .oracles import ORACLES as ORACLES
from .page_diff import extract
from .piece_sampling import sample_pieces
from .quality_fm import THRESHOLD, fit_quality, is_held_out, with_quality
from .repeat_index import repeated_strings
from .toxic_votes import THRESHOLD as TOXIC
from .toxic_votes import fit_toxicity, is_unlearned, with_toxicity

_ODD_TURN = "\\### Assistant: </turn> ok"


def op9_repeat_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_strings(read_table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op1_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (read_table(spark, sf_dir, t) for t in ("documents", "labels"))
    model = fit_quality(docs, labels, metadata=("n_chars",))
    scored = with_quality(docs.select("doc_id", "text", "n_chars"), model)
    return scored.select(
        "doc_id",
        is_held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.createDataFrame(
        [(-7, 0, "user", _ODD_TURN), (-7, 1, "assistant", _ODD_TURN)],
        "conv_id long, turn long, role string, text string",
    )
    read = (
        format_conversations(turns.unionByName(odd))
        .withColumn("turns", read_turns(F.col("formatted")))
        .withColumn("loss", F.array_join(read_loss(F.col("formatted"), F.col("loss_spans")), ""))
    )
    line = lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", line), ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        F.col("n_blocks").cast("long").alias("n_blocks"),
    )


def op3_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules(read_table(spark, sf_dir, "documents"))


def op4_page_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = extract(read_table(spark, sf_dir, "pages"))
    return pages.withColumn("n_chars", F.length("text").cast("long"))


def op5_benchmark_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = (read_table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return contamination(docs, items).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        is_contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


def op6_piece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_pieces(read_table(spark, sf_dir, "documents"))


def op7_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"), shingle=3, percent=85)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"))


def op10_line_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(read_table(spark, sf_dir, "documents"))


def op11_threshold_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    flipped = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(
        read_table(spark, sf_dir, "embeddings"), anchor=F.col("vec_id") % 100 == 0, label=flipped
    )


def op12_ball_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = encode(read_table(spark, sf_dir, "embeddings"))
    return codes.select(
        F.col("id").alias("vec_id"),
        "code",
        "error",
        "label_error",
        F.lit(books.sha256()).alias("codebooks_sha256"),
    )


def op13_toxic_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (read_table(spark, sf_dir, t) for t in ("documents", "labels"))
    scored = with_toxicity(docs.select("doc_id", "text"), fit_toxicity(docs, labels))
    return scored.select(
        "doc_id",
        is_unlearned("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= TOXIC).cast("int").alias("predicted"),
    )


QUERIES = {
    "op1_quality_fm": op1_quality_fm,
    "op2_chat_format": op2_chat_format,
    "op3_host_rules": op3_host_rules,
    "op4_page_diff": op4_page_diff,
    "op5_benchmark_scan": op5_benchmark_scan,
    "op6_piece_sampling": op6_piece_sampling,
    "op7_chosen_path": op7_chosen_path,
    "op8_packing": op8_packing,
    "op9_repeat_index": op9_repeat_index,
    "op10_line_join": op10_line_join,
    "op11_threshold_join": op11_threshold_join,
    "op12_ball_codes": op12_ball_codes,
    "op13_toxic_votes": op13_toxic_votes,
}
