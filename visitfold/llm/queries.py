"""Named queries of the operators over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitfold.llm import (
    ann,
    line_dedup,
    lm,
    mixing,
    ngram_join,
    packing,
    periodic,
    quality,
    simhash,
    spelling,
    substring_dedup,
    url_filter,
    warc,
)
from visitfold.llm.common import WORD, prepared


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mixture(table(spark, sf_dir, "documents"))
    return mixed.select(
        *("doc_id", "size", "source_size", "target", "taken", "copies"),
        F.array_join(F.col("shards").cast("array<string>"), ",").alias("shards"),
    )


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = simhash.near_duplicates(docs.select("doc_id", "text"))
    return found.select(
        F.col("doc.doc_id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    found = warc.read_archives(spark, warc.write_archives(pages), payload=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def byte_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = packing.cut_pieces(docs, byte_bpe()).select(
        F.col("doc.doc_id").alias("doc_id"), "piece", "start", "length", F.crc32("ids").alias("ids_crc32")
    )
    return packing.pack(pieces)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        F.col("n_lines").cast("long").alias("n_lines"),
        F.size("removed").cast("long").alias("n_removed"),
        F.array_join(F.col("removed").cast("array<string>"), ",").alias("removed_lines"),
    )


def op6_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where("vec_id % 50 = 0"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality.quality(docs.select("doc_id", "text"))
    return judged.select(
        F.col("doc.doc_id").alias("doc_id"),
        *("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"),
        *("base_failed", "kept", "longest_repeat", "n_covered"),
    )


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = substring_dedup.remove_repeats(docs)
    return rows.select(
        F.col("doc.doc_id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


# Fixed value: the rules that the query states.
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    listed = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in URL_RULES)
    rules = spark.sql(f"SELECT * FROM VALUES {listed} AS rules(host, path, verdict)")
    judged = url_filter.judge_urls(pages, rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm.score(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return scored.select(
        F.col("doc.doc_id").alias("doc_id"),
        *("held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"),
    )


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    words = spelling.word_counts(docs, damaged=spelling.DAMAGED)
    return spelling.forms(words).select("word", "form", "root", "n", "n_near", "form_n")


def op12_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = ngram_join.similar_texts(docs)
    return found.select(F.col("doc.doc_id").alias("doc_id"), "n_shingles", "component_id")


def with_planted_repeats(docs: DataFrame) -> DataFrame:
    """doc_id and text; one text in ten repeats a block of its words from some word on.

    Which, where and how long the block is follows from the checksum of the document's number.
    """
    number = docs.withColumn("h", F.crc32(F.col("doc_id").cast("string").cast("binary")))
    planted = F.coalesce((F.col("h") % 10 == 0) & F.col("text").rlike(WORD), F.lit(False))
    others = number.where(~planted).select("doc_id", "text")
    chosen = number.where(planted).withColumn("words", F.regexp_extract_all("text", F.lit(f"({WORD})")))
    placed = chosen.withColumn("n", F.size("words")).withColumn("g", F.floor(F.col("h") / 10))
    placed = placed.withColumn("a", (F.col("g") % F.col("n")).cast("int")).withColumn(
        "p", F.expr("cast(1 + floor((n - a) / (3 + g % 8)) as int)")
    )
    block = F.expr("array_repeat(slice(words, a + 1, p), cast(ceil((n - a) / p) as int))")
    repeated = F.concat(F.expr("slice(words, 1, a)"), F.slice(F.flatten(block), F.lit(1), F.col("n") - F.col("a")))
    return placed.select("doc_id", F.array_join(repeated, " ").alias("text")).unionByName(others)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_planted_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic.periodic_runs(docs)
    lines = F.transform("runs", lambda run: F.concat_ws(",", run["start"], run["length"], run["period"]))
    listed = F.array_join(F.transform(lines, lambda line: F.concat(line, F.lit("\n"))), "")
    return found.select(
        F.col("doc.doc_id").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        *("start", "length", "period"),
        F.floor(1000 * F.col("length") / F.col("period")).alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {
    "op1_source_mixing": op1_source_mixing,
    "op2_simhash": op2_simhash,
    "op3_warc": op3_warc,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_line_dedup": op5_line_dedup,
    "op6_learned_partitions": op6_learned_partitions,
    "op7_quality_rules": op7_quality_rules,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_url_filters": op9_url_filters,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_ngram_jaccard": op12_ngram_jaccard,
    "op13_periodic_runs": op13_periodic_runs,
}
