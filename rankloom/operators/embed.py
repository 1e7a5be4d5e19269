"""Item text embeddings: Spark ML Word2Vec models, trained by ``skipgram``.

The reference tokenizes one concatenated document per item.  Here the work runs
on the per-review parts (``docs.item_text_parts``): the token list of a document
is the concatenation of its parts' token lists, and the document vector
(Word2VecModel.transform = sum of in-vocabulary word vectors / number of tokens)
is a sum over parts, so it is aggregated per item with partial aggregation and
no task ever holds a hot item's whole text.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Word2Vec, Word2VecModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.operators import skipgram
from rankloom.operators.docs import joined_words, kept_words, stop_words_remover, word_counts  # noqa: F401
from rankloom.operators.skew import semi_join
from rankloom.operators.topk import nearest
from rankloom.session import scratch_path
from rankloom.sources.models import fit_or_load, load_model, save_model
from rankloom.sources.tables import kept

# The reference's Word2Vec settings and document filters.
VECTOR_SIZE, MIN_COUNT, MAX_ITER, WINDOW, STEP = 50, 50, 5, 5, 0.025
MIN_CHARS, MIN_REVIEWS, MIN_TOKENS = 50, 5, 3
PROBE_WORDS = ("battery", "camera", "wireless")


def part_tokens(parts: DataFrame) -> DataFrame:
    """Stop-word-free tokens of every part, with the numbers its item needs.

    A document's tokens are its parts' tokens one after another, but for the empty
    tokens that end it (``Tokenizer`` drops those).  Every part keeps them here and
    counts them in ``endEmpties``: of the last part an item needs only that number, to
    take as many empty tokens back out of its sums.  ``tokensText`` is ``tokens`` joined by
    spaces, the cheaper column to hand on.
    """
    rows = parts.select(
        "asin", "unixReviewTime", "reviewerID", F.md5("text").alias("partKey"), "overall",
        F.length("text").alias("chars"), F.lower("text").alias("_t"))
    # three functions: what a query does not read is not made
    rows = rows.withColumns({"_n": word_counts("_t"), "tokens": kept_words("_t"),
                             "tokensText": joined_words("_t")})
    return rows.select("asin", "unixReviewTime", "reviewerID", "partKey", "overall", "chars",
                       F.col("_n.endEmpties").alias("endEmpties"), "tokens",
                       F.col("_n.nTokens").alias("nTokens"), "tokensText")


def _token_aggregates() -> list:
    last = F.max_by("endEmpties", F.struct("unixReviewTime", "reviewerID", "partKey"))
    return [F.count(F.lit(1)).alias("reviewCount"), F.avg("overall").alias("avgRating"),
            (F.sum("chars") + F.count(F.lit(1)) - 1).alias("docChars"),
            (F.sum("nTokens") - last).alias("docTokens"), last.alias("lastEmpties")]


def item_token_stats(tokens: DataFrame) -> DataFrame:
    """(asin, reviewCount, avgRating, docChars, docTokens): numbers only are shuffled."""
    return tokens.groupBy("asin").agg(*_token_aggregates()).drop("lastEmpties")


def embeddable_items(stats: DataFrame, min_chars: int = MIN_CHARS, min_reviews: int = MIN_REVIEWS,
                     min_tokens: int = MIN_TOKENS) -> DataFrame:
    """Items with enough text, reviews and tokens."""
    return stats.filter((F.col("docChars") > min_chars) & (F.col("reviewCount") >= min_reviews)
                        & (F.col("docTokens") > min_tokens))


def embeddable_parts(tokens: DataFrame, items: DataFrame) -> DataFrame:
    """Parts of the given items: the training sentences."""
    return semi_join(tokens, items, "asin")


def word2vec_estimator(vector_size: int = VECTOR_SIZE, min_count: int = MIN_COUNT,
                       max_iter: int = MAX_ITER, window: int = WINDOW, step: float = STEP,
                       partitions: int | None = None, seed: int = 42) -> Word2Vec:
    w2v = Word2Vec(inputCol="tokens", outputCol="vector", vectorSize=vector_size,
                   minCount=min_count, maxIter=max_iter, windowSize=window, stepSize=step, seed=seed)
    if partitions:
        w2v.setNumPartitions(partitions)
    return w2v


def word2vec_model(spark: SparkSession, words: list[str], vectors: np.ndarray,
                   **params) -> Word2VecModel:
    """A Spark ML model of the given vectors: a model fitted to one word is saved, its table
    (word, vector) is replaced, and it is loaded.  Without a word the fit raises, as ever."""
    least = params.get("min_count", MIN_COUNT)
    one = spark.createDataFrame([(words[:1] * max(least, 1),)], "tokens array<string>")
    path = scratch_path(spark, f"word2vec-{uuid.uuid4().hex}")
    save_model(word2vec_estimator(**params).fit(one), path)
    floats = pa.array(np.ascontiguousarray(vectors, np.float32).reshape(-1))
    starts = pa.array(np.arange(len(words) + 1, dtype=np.int32) * vectors.shape[1], pa.int32())
    table = pa.table({"word": pa.array(words, pa.string()),
                      "vector": pa.ListArray.from_arrays(starts, floats)})
    spark.createDataFrame(table).write.mode("overwrite").parquet(f"{path}/data")
    return load_model(Word2VecModel, path)


def train_word2vec(parts: DataFrame, **params) -> Word2VecModel:
    """Fit on the parts' token lists (one sentence per review text).

    Training runs on ``partitions`` parallel model copies (default: the cluster's
    default parallelism), merged after every iteration (``skipgram.train``; Spark ML's own
    fit lets the tasks of an executor write into one copy, pair by pair).
    """
    # read twice, made once; as texts where there are: a text without words has no row here
    tokens = "tokensText" if "tokensText" in parts.columns else "tokens"
    sentences = kept(parts.filter(F.col("nTokens") > 0).select(tokens), "sentences", compression="zstd")
    params.setdefault("partitions", parts.sparkSession.sparkContext.defaultParallelism)
    settings = {"vector_size": VECTOR_SIZE, "min_count": MIN_COUNT, "max_iter": MAX_ITER,
                "window": WINDOW, "step": STEP, **params}
    words, vectors = skipgram.train(sentences, tokens=tokens, **settings)
    return word2vec_model(parts.sparkSession, words, vectors, **params)


def word2vec_fit_or_load(path: str, parts: DataFrame, mode: str = "reuse", **params) -> Word2VecModel:
    return fit_or_load(path, lambda: train_word2vec(parts, **params), Word2VecModel, mode)


def item_embeddings(model: Word2VecModel, tokens: DataFrame, **filters) -> DataFrame:
    """(asin, embedding array<double>, avgRating, reviewCount) per embeddable item.

    Each part's mean vector (the model's own transform) times its token count is
    summed per item, with the item's numbers in the same aggregation, and divided by
    the item's token count: vectors and numbers are shuffled, never text.  The empty
    token may be in the vocabulary; those that end a document are taken out again.
    """
    none = model.getVectors().filter(F.col("word") == "").select("vector").first()   # one word
    empty = F.array(*[F.lit(float(x)) for x in none[0]]) if none else None
    vec = model.transform(tokens)
    scaled = array_to_vector(F.transform(vector_to_array("vector"),
                                         lambda x: x * F.col("nTokens").cast("double")))
    agg = vec.withColumn("_v", scaled).drop("tokens", "tokensText", "vector").groupBy("asin").agg(
        Summarizer.sum(F.col("_v")).alias("_s"), *_token_aggregates())
    total = vector_to_array("_s")
    if empty is not None:
        total = F.zip_with(total, empty, lambda x, e: x - e * F.col("lastEmpties"))
    emb = F.transform(total, lambda x: x / F.col("docTokens").cast("double"))
    return embeddable_items(agg, **filters).select("asin", emb.alias("embedding"), "avgRating",
                                                   "reviewCount")


def probe_words(model: Word2VecModel, n: int = 3) -> list[str]:
    """The reference's probe words that are in the vocabulary, else its first ``n`` words
    that are not empty, by name."""
    words = model.getVectors().filter(F.col("word") != "").select("word")
    known = [r["word"] for r in words.filter(F.col("word").isin(list(PROBE_WORDS))).collect()]
    return sorted(known) or [r["word"] for r in words.orderBy("word").limit(n).collect()]


def synonyms(model: Word2VecModel, words=None, n: int = 5) -> DataFrame:
    """(query, word, similarity): the ``n`` nearest words of every probe word that is in the
    vocabulary, in one pass over the vectors (see ``topk.nearest``)."""
    words = probe_words(model) if words is None else words
    vectors = model.getVectors().select("word", vector_to_array("vector").alias("vector"))
    return nearest(vectors, vectors.filter(F.col("word").isin(list(words))), n, "word",
                   "vector").drop("rank")
