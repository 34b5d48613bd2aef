"""The queries of this subpackage: (spark, folder of the tables) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import alignment, bpe, neardup, packing, pii, prefix_trie, quality, simhash, token_files, topk, toxicity, url_filter, warc

URL_RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filters(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    judged = url_filter.judge_urls(pages, url_filter.rules_table(spark, URL_RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def _learnt_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labels that a model may be fitted on; the other fifth is held out."""
    return _table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id")))


def held_out(doc_id):
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def op2_quality(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    model = quality.train(docs, _learnt_from(spark, sf_dir))
    return quality.rate(docs, model).select("*", held_out(F.col("doc_id")).alias("held_out"))


def op3_toxicity(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, _learnt_from(spark, sf_dir))
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), toxicity.toxicity(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op4_bpe(spark, sf_dir):
    coded = bpe.encode(_table(spark, sf_dir, "documents"), decoded=True)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_pii(spark, sf_dir):
    return pii.replace_personal_data(_table(spark, sf_dir, "documents"), key="corpus")


def op6_simhash(spark, sf_dir):
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint(F.col("fingerprint")).alias("fingerprint"), "component_id")


def op7_packing(spark, sf_dir):
    return packing.pack(_table(spark, sf_dir, "documents"))


def op8_topk(spark, sf_dir):
    vectors = topk.integer_vectors(_table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, vectors.where("id % 50 = 0"))


def op9_neardup(spark, sf_dir):
    return neardup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op10_warc(spark, sf_dir):
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def op11_token_alignment(spark, sf_dir):
    return alignment.align(_table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark, sf_dir):
    turns = prefix_trie.numbered(prefix_trie.named_turns(_table(spark, sf_dir, "conversations")))
    trie = prefix_trie.build(*prefix_trie.with_shared_openings(turns))
    digests = prefix_trie.member_digests(trie.ends)
    nobody = F.sha2(F.lit("").cast("binary"), 256)
    return trie.nodes.join(digests, ["conv_id", "depth"], "left").withColumn("ends_sha256", F.coalesce("ends_sha256", nobody))


def op13_token_files(spark, sf_dir):
    return token_files.round_trip(_table(spark, sf_dir, "documents"))


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def all_queries():
    return {name: f for name, f in globals().items() if name.startswith("op") or name == "pipeline"}
