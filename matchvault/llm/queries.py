"""The registered queries of this package, each with its SQL where SQL can state the result."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchvault.llm.chunks import repeated_chunks
from matchvault.llm.decontaminate import contaminated
from matchvault.llm.hyperlang import predict_language, prototypes
from matchvault.llm.jaccard import jaccard_groups
from matchvault.llm.kneser_ney import score, train
from matchvault.llm.periodic import collapse_runs, looped
from matchvault.llm.pieces import decode, encode
from matchvault.llm.resample import resampled
from matchvault.llm.ring import bounded_shards
from matchvault.llm.secrets_scan import listed, secret_spans
from matchvault.llm.simhash import as_text, edited_fingerprints, likeness, within_radius
from matchvault.llm.spelling import damaged, letter_runs, spelling_forms, word_counts
from matchvault.llm.store import small_batches, written
from matchvault.llm.suffixes import repeated_spans, without_spans

QUERIES = {}
ORACLES = {}


def query(name, sql=None):
    """Register ``fn(spark, sf_dir)`` under ``name`` with the SQL it must agree with."""

    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark, sf_dir, name, **batches):
    small_batches(spark, **batches)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_ngram_jaccard_join")
def op1_ngram_jaccard_join(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", rows=1000, size="4m", read=512)
    return jaccard_groups(docs).drop("version")


@query("op8_suffix_array_dedup")
def op8_suffix_array_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return without_spans(docs, repeated_spans(docs)).drop("kept")


@query("op2_content_chunk_dedup")
def op2_content_chunk_dedup(spark, sf_dir):
    found = repeated_chunks(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return found.select(
        "doc_id", "n_bytes", "n_chunks", "n_repeated", F.size("spans").cast("long").alias("n_spans"),
        removed.alias("n_removed"),
        F.array_join(F.transform("spans", lambda x: F.concat_ws(":", x["start"], x["end"])), ",").alias("spans"),
    )


@query("op4_simhash_fingerprints")
def op4_simhash_fingerprints(spark, sf_dir):
    prints = written(edited_fingerprints(table(spark, sf_dir, "documents")))
    pairs = within_radius(prints)
    near = pairs.select(F.explode(F.array("a", "b")).alias("print")).groupBy("print").agg(F.count("*").alias("n_near"))
    return prints.join(near, "print", "left").select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("print")).alias("fingerprint"),
        as_text(F.col("edited_print")).alias("edited_fingerprint"),
        likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
        likeness(F.col("print"), F.col("next_print")).alias("near_next"),
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
    )


@query("op7_consistent_hash_sharding")
def op7_consistent_hash_sharding(spark, sf_dir):
    placed = bounded_shards(table(spark, sf_dir, "documents"), 8)
    return placed.withColumns({"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")})


@query("op9_entropy_secret_scan")
def op9_entropy_secret_scan(spark, sf_dir):
    found = secret_spans(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    base = F.filter("found", lambda x: x["rank"] < 3)
    counts = [F.expr(f"cast(size(filter(found, x -> x.rank = {r})) AS long)").alias(f"n_{k}")
              for r, k in enumerate(("assign", "access", "hex"))]
    return found.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("found")).alias("spans"))


@query("op10_hyperdimensional_language_id")
def op10_hyperdimensional_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    part = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    learned = docs.where((part != 1) & F.col("lang").isNotNull())
    rows = docs.select("doc_id", "text", F.coalesce(part == 1, F.lit(False)).alias("held_out"))
    return predict_language(rows, *prototypes(learned))


@query("op6_importance_resampling")
def op6_importance_resampling(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return resampled(docs, table(spark, sf_dir, "labels")).drop("text")


@query("op3_benchmark_decontamination")
def op3_benchmark_decontamination(spark, sf_dir):
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.groupBy("doc_id", "item_id").agg(
        F.max("score").alias("score"), F.max("question_overlap").alias("question_overlap"),
        F.max("answer_overlap").alias("answer_overlap"),
    )


@query("op5_sampled_pieces")
def op5_sampled_pieces(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    spelled = decode(encode(docs))
    return spelled.select(
        "doc_id", F.size("pieces").cast("long").alias("n_pieces"), F.xxhash64("pieces").alias("pieces_hash"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.coalesce("text", F.lit("")) == F.col("decoded")).alias("lossless"),
    )


@query("op13_spelling_variants")
def op13_spelling_variants(spark, sf_dir):
    runs = letter_runs(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return spelling_forms(word_counts(damaged(runs, 199)))


@query("op12_periodic_runs")
def op12_periodic_runs(spark, sf_dir):
    found = collapse_runs(looped(table(spark, sf_dir, "documents")))
    # The greatest length, then the smallest start and period.
    top = F.array_min(F.transform("runs", lambda r: F.struct(-r["length"], r["start"], r["period"])))
    found = found.withColumn("top", top)
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.expr("top.start").alias("start"),
        F.expr("-top.col1").alias("length"), F.expr("top.period").alias("period"),
        F.expr("(1000 * -top.col1) div top.period").alias("exponent_milli"),
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query("op11_kneser_ney_score")
def op11_kneser_ney_score(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", size="16m").select("doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1, F.lit(False))
    model = train(docs.where(~held_out))
    return score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score", "score",
    )
