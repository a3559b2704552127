"""Registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftwell.llm import (
    alignment,
    bpe,
    language,
    licenses,
    merkle,
    mixing,
    near_duplicates,
    neighbours,
    personal_data,
    token_counts,
    top_scores,
    url_lists,
    vector_codes,
)

TOKEN_LIMIT = 512


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    """A public vocabulary file; every machine has the package."""
    import public_tokenizers

    return public_tokenizers.path(name)


def held_out(doc_id: Column) -> Column:
    """A quarter of the documents, never learned from. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang", held_out(F.col("doc_id")).alias("held_out"))
    model = language.train(docs.filter("NOT held_out"))
    found = language.identify(docs.select("doc_id", "held_out", "text"), model, out="language")
    return found.select("doc_id", "held_out", F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"), F.size("language.spans").alias("n_spans"))


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "class_size", "is_kept")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(_table(spark, sf_dir, "documents"))


def encoded(docs: DataFrame) -> DataFrame:
    path = tokenizer("word_bpe_49k.json")
    ids = bpe.encode(docs.select("doc_id", "text"), path).select("doc_id", "ids")
    both = bpe.decode(ids, path)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data.find(_table(spark, sf_dir, "documents").select("doc_id", "text"), kept=["doc_id"])
    names = F.array(*[F.lit(k) for k in personal_data.KINDS])

    def shown(spans: str) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")

    def count(number: int) -> Column:
        return F.size(F.filter("personal_data.strict", lambda s: s["kind"] == number)).cast("long")

    counts = [count(number).alias(f"n_{kind}") for number, kind in enumerate(personal_data.KINDS)]
    return found.select("doc_id", *counts, F.sha2(shown("personal_data.strict"), 256).alias("base_sha256"), shown("personal_data.spans").alias("spans"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(docs, tokenizer("byte_bpe_50k.json"))
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return counted.select("doc_id", n_bytes.alias("n_bytes"), "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(_table(spark, sf_dir, "documents").select("doc_id", "text"), out="scan")
    return found.select(
        "doc_id",
        F.size("scan.matches").cast("long").alias("n_matches"),
        F.array_join("scan.licenses", ",").alias("licenses"),
        F.col("scan.best").alias("best"),
        F.col("scan.best_dice").alias("best_dice"),
    )


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = merkle.edited_pairs(_table(spark, sf_dir, "documents"))
    printed = pairs.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        F.inline(
            F.array(
                F.struct(
                    merkle.fingerprint(F.col("text")).alias("fingerprint"),
                    merkle.fingerprint(F.col("edited")).alias("edited_fingerprint"),
                    merkle.fingerprint(F.col("next")).alias("next_fingerprint"),
                )
            )
        ),
    )
    pieces = [merkle.piece_digests(F.col(c)).alias(n) for c, n in (("fingerprint", "own"), ("edited_fingerprint", "edited"), ("next_fingerprint", "next"))]
    digests = printed.select("*", F.inline(F.array(F.struct(*pieces))))
    return digests.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        merkle.likeness(F.col("own"), F.col("edited")).alias("near_edited"),
        merkle.likeness(F.col("own"), F.col("next")).alias("near_next"),
    )


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(_table(spark, sf_dir, "embeddings"), queries="vec_id % 50 = 0", k=5)


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with a time of fetch within 2024, drawn from the page's number."""
    day = F.expr("make_dt_interval(cast(pmod(page_id * 7919, 366) AS int), 0, cast(pmod(page_id * 104729, 1440) AS int))")
    return _table(spark, sf_dir, "pages").select("page_id", "url", (F.lit("2024-01-01 00:00:00").cast("timestamp") + day).alias("fetched_at"))


def list_entries(pages: DataFrame) -> DataFrame:
    """Dated list entries drawn from the hosts, domains and first path segments that ``pages`` has."""
    named = pages.select(F.inline(url_lists.keys(F.col("url")))).select("key").distinct()
    number = named.withColumn("n", F.conv(F.substring(F.md5(F.col("key").cast("binary")), 1, 6), 16, 10).cast("int"))

    def entry(action: str, day) -> Column:
        since = F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(days=day)
        return F.struct(F.lit(action).alias("action"), since.alias("since"))

    n = F.col("n")
    in_path = F.contains("key", F.lit("/"))
    listed = (
        F.when(in_path & (n % 5 == 0), F.array(entry("allow", n % 300)))
        .when(~in_path & (n % 3 == 0), F.array(entry("block", n % 200), entry("remove", n % 200 + 60), entry("block", n % 200 + 150)))
        .when(~in_path & (n % 3 == 1), F.array(entry("allow", n % 100), entry("block", n % 100 + 120)))
    )
    return number.select("key", F.inline(listed))


def op9_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = captures(spark, sf_dir)
    judged = url_lists.judge(pages, list_entries(pages.select("url")))
    utc = F.to_timestamp_ntz(F.date_format("url_verdict.since", "yyyy-MM-dd HH:mm:ss"))
    return judged.select("page_id", "url_verdict.verdict", "url_verdict.key", utc.alias("since"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op11_top_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = top_scores.top_scores(_table(spark, sf_dir, "embeddings"), queries="vec_id % 20 = 0", k=20)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return alignment.weighed_alignments(docs, tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"), kept=["doc_id"])


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vector_codes.compress(_table(spark, sf_dir, "embeddings"))
    return found.select(F.col("id").alias("vec_id"), "code", "error", "label_error", "codebooks_sha256")


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    listed = (
        op1_licenses,
        op2_language,
        op3_fingerprints,
        op4_minhash,
        op5_bpe,
        op6_personal_data,
        op7_token_counts,
        op8_neighbours,
        op9_url_lists,
        op10_mixing,
        op11_top_scores,
        op12_alignment,
        op13_vector_codes,
    )
    return {query.__name__: query for query in listed}
