"""Language identification, word first, backing off to shorter character n-grams.

Learning counts the words of every labelled training text (in the tasks first, then one
shuffle of the counts) and, from the words, their character n-grams with word borders.  The
model keeps the most frequent words and n-grams of every language by that language's own
counts: at most ``MAX_WORDS`` words and ``MAX_GRAMS`` n-grams of each length a language, so
that no language displaces another's.  Its size (it is collected and broadcast) is bounded
by the number of languages times ``MAX_WORDS + len(LENGTHS) * MAX_GRAMS`` features, whatever
the corpus.  All counts come from all training texts.

Scoring: a known word adds its smoothed log frequency in each language, taken relative to
the mean over the languages.  An unseen word is cut into n-grams of the longest length of
which the model knows one; their mean stands for the word.  The language with the largest
sum wins, the first in alphabetical order on a tie; the score is its share after softmax.

Defined results: a null text, or one without letters, is ``und`` with score 0; so is every
text if nothing was learned.  Rows with a null label or key are not learned from; a null key
is not held out.  Equal rows give equal results; further columns of the input are kept off.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import Counter
from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.llm.common import slices, stash

MAX_WORDS, MAX_GRAMS, LENGTHS = 60_000, 30_000, (5, 4, 3, 2, 1)
MAX_LANGUAGES = 512
BUCKETS = 1024             # parts, by hash, of a count class that does not fit whole
FLUSH = 250_000            # distinct (language, word) a task holds before it hands them on
CACHE_WORDS = 250_000
SLICE_BYTES = 4 << 20
UNKNOWN = "und"

#: runs of letters
WORDS = re.compile(r"[^\W\d_]+")


def letters(text: str | None) -> list[str]:
    """The words of a text; none if what looks like words are numerals only."""
    words = WORDS.findall(text.lower()) if text else []
    return words if any(c.isalpha() for w in words for c in w) else []


def grams(word: str, n: int) -> list[str]:
    w = f" {word} "
    return [w[i:i + n] for i in range(len(w) - n + 1)] if n > 1 else list(word)


def word_counts(docs: DataFrame, text: str, label: str) -> DataFrame:
    """(lang, word, n) over all rows; each task adds up its own before they are shuffled."""
    def run(batches):
        held: dict[str, Counter] = {}

        def hand_on():
            for lang, words in held.items():
                keys = list(words)
                for i in range(0, len(keys), 50_000):
                    part = keys[i:i + 50_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(part), pa.string()), pa.array(part, pa.string()),
                         pa.array([words[k] for k in part], pa.int64())], ["lang", "word", "n"])
            held.clear()

        for batch in batches:
            for i, (t, lang) in enumerate(zip(batch.column("t"), batch.column("l"))):
                held.setdefault(lang.as_py(), Counter()).update(WORDS.findall(t.as_py().lower()))
                if i % 100 == 99 and sum(map(len, held.values())) > FLUSH:
                    yield from hand_on()
        yield from hand_on()

    rows = (docs.select(F.col(text).alias("t"), F.col(label).alias("l"))
            .filter(F.col("t").isNotNull() & F.col("l").isNotNull()))
    return (rows.mapInArrow(run, "lang string, word string, n long")
            .groupBy("lang", "word").agg(F.sum("n").alias("n")))


def gram_counts(words: DataFrame) -> DataFrame:
    """(size, feature, lang, n) of the words' character n-grams."""
    def run(batches):
        for batch in batches:
            held: Counter = Counter()
            for lang, word, n in zip(*(c.to_pylist() for c in batch.columns)):
                for size in LENGTHS:
                    for g in grams(word, size):
                        held[size, g, lang] += n
            keys = list(held)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.int32()),
                 pa.array([k[1] for k in keys], pa.string()),
                 pa.array([k[2] for k in keys], pa.string()),
                 pa.array(list(held.values()), pa.int64())], ["size", "feature", "lang", "n"])

    return (words.select("lang", "word", "n")
            .mapInArrow(run, "size int, feature string, lang string, n long")
            .groupBy("size", "feature", "lang").agg(F.sum("n").alias("n")))


class Table(Mapping):
    """Features with a number per language: places in one array, not tuples of objects."""

    def __init__(self, width: int):
        self.width, self.place, self.values = width, {}, array("d")

    def add(self, feature: str, values) -> None:
        self.place[feature] = len(self.values)
        self.values.extend(values)

    def get(self, feature, default=None):
        at = self.place.get(feature)
        return default if at is None else tuple(self.values[at:at + self.width])

    def __getitem__(self, feature):
        at = self.place[feature]
        return tuple(self.values[at:at + self.width])

    def __contains__(self, feature):
        return feature in self.place

    def __iter__(self):
        return iter(self.place)

    def __len__(self):
        return len(self.place)


@dataclass
class Model:
    langs: list[str]
    tables: dict[int, Table]     # by n-gram length; 0: words
    unseen: int = 0


def _frequent(counts: DataFrame, most: dict[int, int]) -> DataFrame:
    """(size, feature, by) of the features of each size that are among the most frequent of
    a language, at most ``most[size]`` of each: whole count classes (eighths of a doubling)
    from the top, and of the first that does not fit as many buckets of the feature's hash
    as do."""
    counts = counts.withColumn("level", F.floor(F.log2("n") * 8).cast("int")).withColumn(
        "bucket", F.pmod(F.xxhash64("feature"), F.lit(BUCKETS)).cast("int"))
    histogram: dict[tuple[int, str], dict[int, int]] = {}
    for r in counts.groupBy("size", "lang", "level").count().collect():
        histogram.setdefault((r["size"], r["lang"]), {})[r["level"]] = r["count"]
    left, edge = {}, {}
    for which, bins in histogram.items():
        left[which], edge[which] = most[which[0]], -1
        for lv in sorted(bins, reverse=True):
            if bins[lv] > left[which]:
                edge[which] = lv
                break
            left[which] -= bins[lv]
    spark = counts.sparkSession

    def joined(limits: dict[tuple[int, str], int], name: str, df: DataFrame) -> DataFrame:
        rows = spark.createDataFrame([(*k, v) for k, v in limits.items()],
                                     f"size int, lang string, {name} int")
        return df.join(F.broadcast(rows), ["size", "lang"])

    counts, cut = joined(edge, "edge", counts), dict.fromkeys(histogram, 0)
    full = set()
    for r in (counts.filter("level = edge").groupBy("size", "lang", "bucket").count()
              .orderBy("size", "lang", "bucket").collect()):
        which = (r["size"], r["lang"])
        if which not in full and r["count"] <= left[which]:
            left[which] -= r["count"]
            cut[which] = r["bucket"] + 1
        else:
            full.add(which)
    keep = (F.col("level") > F.col("edge")) | (
        (F.col("level") == F.col("edge")) & (F.col("bucket") < F.col("cut")))
    return (joined(cut, "cut", counts).groupBy("size", "feature")
            .agg(F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by"),
                 F.max(keep).alias("keep")).filter("keep").drop("keep"))


def learn(docs: DataFrame, text: str = "text", label: str = "lang") -> Model:
    """The model of all rows that have a text and a label."""
    words = stash(word_counts(docs, text, label), "language-words")
    totals = {r["lang"]: r["n"] for r in
              words.groupBy("lang").agg(F.sum("n").alias("n")).limit(MAX_LANGUAGES + 1).collect()}
    if len(totals) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} labels")
    langs = sorted(totals)
    counts = stash(words.select(F.lit(0).alias("size"), F.col("word").alias("feature"),
                                "lang", "n").unionByName(gram_counts(words)), "language-counts")
    sums: dict[tuple[int, str], int] = {
        (r["size"], r["lang"]): r["n"]
        for r in counts.groupBy("size", "lang").agg(F.sum("n").alias("n")).collect()}
    most = {0: MAX_WORDS} | dict.fromkeys(LENGTHS, MAX_GRAMS)
    tables = {s: Table(len(langs)) for s in most}
    # at most MAX_WORDS + len(LENGTHS) * MAX_GRAMS rows a language
    for r in stash(_frequent(counts, most), "language-features").toLocalIterator():
        logs = [math.log((r["by"].get(x, 0) + 0.5) / (sums.get((r["size"], x), 0) + 1.0))
                for x in langs]
        mean = sum(logs) / len(logs)
        tables[r["size"]].add(r["feature"], [v - mean for v in logs])
    return Model(langs, tables)


class Scorer:
    """A worker's model with a bounded table of the words it has met."""

    def __init__(self, model: Model):
        self.model, self.none = model, (0.0,) * len(model.langs)
        self.steps = [(n, model.tables[n].get) for n in LENGTHS]
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.values = array("d")

    def word(self, w: str) -> tuple[float, ...]:
        if (known := self.model.tables[0].get(w)) is not None:
            return known
        for n, get in self.steps:
            rows = [v for v in map(get, grams(w, n)) if v is not None]
            if rows:
                return tuple([sum(c) / len(rows) for c in zip(*rows)])
        return self.none

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        langs = self.model.langs
        if not langs:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        if len(self.index) > CACHE_WORDS:
            self.forget()
        rows = [letters(t) for t in texts]
        get, places = self.index.get, []
        for r in rows:
            found = list(map(get, r))
            if None in found:
                for w in {w for w, i in zip(r, found) if i is None}:
                    self.index[w] = len(self.index)
                    self.values.extend(self.word(w))
                found = list(map(get, r))
            places.append(found)
        table = np.array(self.values).reshape(-1, len(langs))
        out, scores = [], []
        for found in places:
            if not found:
                out.append(UNKNOWN)
                scores.append(0.0)
                continue
            total = table[found].sum(0)
            best = int(total.argmax())
            out.append(langs[best])
            scores.append(float(1.0 / np.exp(total - total[best]).sum()))
        return out, scores


def predict(docs: DataFrame, model: Model, text: str = "text", pred: str = "lang_pred",
            score: str = "score") -> DataFrame:
    """All columns of ``docs`` but earlier ones of those names, plus the prediction, from
    the text alone."""
    docs = docs.drop(pred, score)
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text)

    def run(batches):
        scorer = Scorer(shipped.value)
        for batch in batches:
            col = batch.column(place)
            sizes = pa.compute.fill_null(pa.compute.binary_length(col), 0).to_pylist()
            for a, b in slices(sizes, SLICE_BYTES):
                langs, scores = scorer.predict(col.slice(a, b - a).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(a, b - a) for c in batch.columns),
                     pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                    [*batch.schema.names, pred, score])

    schema = docs.schema
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return docs.mapInArrow(run, f"{kinds}, `{pred}` string, `{score}` double")


def fold(key: str = "doc_id"):
    """0, 1 or 2 from the key as text; 1 is held out of learning.  Null for a null key."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 3
