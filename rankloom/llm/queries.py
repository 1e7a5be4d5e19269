"""Registered queries of the subpackage: thin digests over the operators, whole tables."""

from __future__ import annotations


from rankloom.llm.common import documents

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op7_sharding(spark, sf_dir):
    from rankloom.llm.sharding import assign_shards, base_tree
    return assign_shards(documents(spark, sf_dir), base_tree(), base_tree(extra=1))


@query
def op3_bpe(spark, sf_dir):
    import public_tokenizers
    from rankloom.llm.bpe import round_trip
    return round_trip(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op4_token_counts(spark, sf_dir):
    import public_tokenizers
    from rankloom.llm.token_counts import token_counts
    return token_counts(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def language_model(docs):
    """Learned from the documents that the contract does not hold out."""
    from rankloom.llm.language import fold, learn
    return learn(docs.filter(fold() != 1))


@query
def op9_language(spark, sf_dir):
    from pyspark.sql import functions as F
    from rankloom.llm.language import fold, predict
    docs = documents(spark, sf_dir)
    rows = docs.select("doc_id", F.coalesce(fold() == 1, F.lit(False)).alias("held_out"), "text")
    return predict(rows, language_model(docs)).drop("text")


@query
def op10_pii(spark, sf_dir):
    from rankloom.llm.pii import find_pii
    return find_pii(documents(spark, sf_dir))


@query
def op6_decontamination(spark, sf_dir):
    from rankloom.llm.decontaminate import contamination
    return contamination(documents(spark, sf_dir),
                         spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@query
def op8_quality(spark, sf_dir):
    from rankloom.llm.quality import judge
    return judge(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query
def op2_jaccard_join(spark, sf_dir):
    from rankloom.llm.jaccard import jaccard_components
    return jaccard_components(documents(spark, sf_dir))


@query
def op1_substring_dedup(spark, sf_dir):
    from rankloom.llm.substrings import remove_repeats
    return remove_repeats(documents(spark, sf_dir))


@query
def op5_line_dedup(spark, sf_dir):
    from rankloom.llm.lines import line_report
    return line_report(documents(spark, sf_dir))


@query
def op13_url_filters(spark, sf_dir):
    from rankloom.llm.urls import filter_urls
    return filter_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"),
                       spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query
def op12_prefix_trie(spark, sf_dir):
    from rankloom.llm.trie import prefix_trie
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


@query
def op11_alignment(spark, sf_dir):
    import public_tokenizers
    from rankloom.llm.alignment import align
    return align(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"),
                 public_tokenizers.path("piece_bpe_32k.model"))
