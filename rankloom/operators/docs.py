"""Item text: per-item documents, tokens and stop-word removal.

Three shapes are offered.  ``item_documents`` is the classic one-row-per-item
table with the concatenated text.  ``item_document_chunks`` is the same text in chunks of
bounded size, for items of any size.  ``item_text_parts`` keeps one row per review;
token and embedding work runs on it and aggregates numbers and vectors per item, so
no task ever has to hold the texts of a very popular item.
"""

from __future__ import annotations

from hashlib import md5

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.ml.feature import StopWordsRemover, Tokenizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankloom.sources.tables import kept

MIN_DOC_CHARS = 10
CHUNK_CHARS = 1 << 16
_BATCH_CHARS = 4 << 20
_PACK_BYTES, _PACK_GROUPS, _PACK_LEVEL = 64 << 20, 512, 6   # a task's rows compressed at once, and how
_CUT_BYTES = 1 << 20          # text that is cut into tokens at once
_CHUNKS = pa.schema([("asin", pa.string()), ("part", pa.int32()), ("at", pa.int64()),
                     ("chars", pa.int64()), ("text", pa.string()), ("edge", pa.bool_())])
_PACKED = pa.schema([("group", pa.int32()), ("size", pa.int64()), ("rows", pa.binary())])
_CUT = pa.schema([("asin", pa.string()), ("at", pa.int64()), ("text", pa.string())])
_DOCS = pa.schema([("asin", pa.string()), ("combinedText", pa.string()), ("reviewCount", pa.int64()),
                   ("avgRating", pa.float64())])
_JOINED = pa.schema([("asin", pa.string()), ("combinedText", pa.string()), ("gapless", pa.bool_()),
                     ("longest", pa.int64())])

# Spark ML's default English stop-word list (StopWordsRemover,
# "english"), as text for the SQL oracle; the operator loads Spark's own list.
ENGLISH_STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his "
    "himself she her hers herself it its itself they them their theirs themselves what which "
    "who whom this that these those am is are was were be been being have has had having do "
    "does did doing a an the and but if or because as until while of at by for with about "
    "against between into through during before after above below to from up down in out on "
    "off over under again further then once here there when where why how all any both each "
    "few more most other some such no nor not only own same so than too very s t can will "
    "just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd "
    "they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't "
    "wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't "
    "shouldn't mustn't can't couldn't cannot could here's how's let's ought that's there's "
    "what's when's where's who's why's would"
).split(" ")


def review_text() -> Column:
    """reviewText, else summary (an empty string counts as present)."""
    return F.coalesce(F.col("reviewText"), F.col("summary"))


def _texts(clean: DataFrame) -> DataFrame:
    return (clean.filter(F.col("reviewText").isNotNull() | F.col("summary").isNotNull())
            .select("asin", "unixReviewTime", "reviewerID", "overall",
                    review_text().alias("text")))


def _pack(batches):
    """Rows, whose first columns are their group and key, to (group, size, rows): those of a group in about
    ``_PACK_BYTES`` of input as one compressed Arrow stream of that size."""
    codec = pa.Codec("zstd", _PACK_LEVEL)
    held, waiting = [], 0

    def out():
        table = pa.Table.from_batches(held).combine_chunks()
        # by key within a group, too: equal keys side by side are short
        order = pc.sort_indices(table, [(c, "ascending") for c in table.column_names[:2]])
        rows = table.drop_columns(table.column_names[:1]).take(order).combine_chunks()
        group = table.column(0).take(order).to_numpy()
        starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        done, size = [], 0
        for start, end in zip(starts, [*starts[1:], len(group)]):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows.schema) as stream:
                stream.write_table(rows.slice(start, end - start))
            plain = sink.getvalue()
            done.append((int(group[start]), plain.size, codec.compress(plain, asbytes=True)))
            size += len(done[-1][2])
            if size > _BATCH_CHARS:
                yield _batch(done, _PACKED)
                done, size = [], 0
        if done:
            yield _batch(done, _PACKED)

    for batch in batches:
        if batch.num_rows:
            if held and waiting + batch.nbytes > _PACK_BYTES:
                yield from out()
                held, waiting = [], 0
            held.append(batch)
            waiting += batch.nbytes
    if held:
        yield from out()


def _batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), schema)], schema=schema)


def _dealt(rows: DataFrame, key: str) -> DataFrame:
    """(group, size, rows): ``rows`` in groups of keys, compressed, one group after another in each
    task.  Texts are shuffled (and spilled) in this form, a fraction of their bytes; with some
    groups a partition, a task unpacks a part of its rows at a time (``_grouped``)."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = max(parts, min(8 * parts, _PACK_GROUPS))
    named = rows.select(F.pmod(F.xxhash64(key), F.lit(groups)).cast("int").alias("_group"), key,
                        *[c for c in rows.columns if c != key])
    return (named.mapInArrow(_pack, "group int, size long, rows binary").repartition("group")
            .sortWithinPartitions("group"))


def _grouped(batches):
    """The rows of every group of ``_dealt`` as a table."""
    codec = pa.Codec("zstd")

    def table(held):
        return pa.concat_tables([pa.ipc.open_stream(codec.decompress(rows.as_buffer(), size)).read_all()
                                 for size, rows in held])

    group, held = None, []
    for batch in batches:
        for g, size, rows in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            if held and g != group:
                yield table(held)
                held = []
            group = g
            held.append((size, rows))
    if held:
        yield table(held)


def _runs(table: pa.Table, order: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, first, same): the rows in ``order``, nulls first, and of each row in that order
    whether it is the first of its first column's value, and equal to the one before in all."""
    at = pc.sort_indices(table.select(order), [(c, "ascending") for c in order], null_placement="at_start")
    same, first = np.ones(len(table), bool), None
    for c in order:
        code = table.column(c).take(at).combine_chunks().dictionary_encode("encode")
        code = (code.combine_chunks() if isinstance(code, pa.ChunkedArray) else code).indices.to_numpy()
        same[1:] &= code[1:] == code[:-1]
        same[:1] = False
        first = ~same if first is None else first
    return at.to_numpy().copy(), first, same


def _items(batches):
    """(asin, texts, ratings) of every item of rows that ``_dealt`` dealt by item, its texts in the
    order of a document."""
    for table in _grouped(batches):
        at, first, same = _runs(table, ["asin", "unixReviewTime", "reviewerID"])
        text = table.column("text").cast(pa.large_string())
        tied = np.flatnonzero(same | np.append(same[1:], False))
        if len(tied):                  # the md5 of a text decides
            keys = [md5(t.encode()).digest() for t in text.take(at[tied]).to_pylist()]
            run = np.cumsum(~same)[tied].tolist()
            at[tied] = at[tied][sorted(range(len(tied)), key=lambda i: (run[i], keys[i]))]
        text, places = text.take(at), np.flatnonzero(first)
        asins = table.column("asin").take(at[places]).to_pylist()
        ratings = table.column("overall").take(at)
        for asin, start, end in zip(asins, places.tolist(), [*places[1:].tolist(), len(at)]):
            yield asin, text.slice(start, end - start).to_pylist(), ratings.slice(start, end - start).to_pylist()


def _long_enough(texts: list[str], min_chars: int) -> bool:
    return sum(map(len, texts)) + len(texts) - 1 > min_chars


def _in_batches(rows, schema: pa.Schema, text: int):
    """Rows as record batches of about ``_BATCH_CHARS`` characters of their column ``text``."""
    done, waiting = [], 0
    for row in rows:
        done.append(row)
        waiting += len(row[text])
        if waiting > _BATCH_CHARS:
            yield _batch(done, schema)
            done, waiting = [], 0
    if done:
        yield _batch(done, schema)


def _document_rows(clean: DataFrame) -> DataFrame:
    return _texts(clean).withColumn("overall", F.col("overall").cast("double"))


def item_documents(clean: DataFrame, min_chars: int = MIN_DOC_CHARS) -> DataFrame:
    """(asin, combinedText, reviewCount, avgRating) for items with > ``min_chars`` chars.

    Texts are joined with a space in (unixReviewTime, reviewerID, md5 of text) order, so
    the document is the same on every run.  Texts are shuffled once, compressed and dealt by item
    (``_dealt``), and sorted where they arrive: no text is in an aggregate's buffer.  The length filter is
    computed from the parts (sum of lengths + separators) before the concatenation.
    """
    def join(batches):
        def found():
            for asin, texts, ratings in _items(batches):
                if _long_enough(texts, min_chars):
                    ratings = [x for x in ratings if x is not None]
                    yield asin, " ".join(texts), len(texts), sum(ratings) / len(ratings) if ratings else None

        return _in_batches(found(), _DOCS, 1)

    return _dealt(_document_rows(clean), "asin").mapInArrow(
        join, "asin string, combinedText string, reviewCount long, avgRating double")


def _hot_items(rows: DataFrame) -> list:
    """Items with more characters than a fair partition: fewer than there are partitions.  One
    aggregate over numbers."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sizes = kept(rows.groupBy("asin").agg(F.sum(F.length("text") + F.lit(1)).alias("chars")), "item-sizes")
    top = sizes.filter("asin IS NOT NULL").orderBy(F.desc("chars"), "asin").limit(parts).collect()
    total = sizes.agg(F.sum("chars")).first()[0]
    return [r["asin"] for r in top if r["chars"] * parts > total]


def item_document_chunks(clean: DataFrame, min_chars: int = MIN_DOC_CHARS,
                         chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """(asin, at, text): the documents of ``item_documents`` in chunks of at most
    ``chunk_chars`` characters; an item's texts one after another by ``at`` (the place of the
    chunk's first character) are its document.

    Items up to a fair partition's share of all characters are whole in a task: their texts are
    dealt by item, compressed, and cut where they arrive.  The few larger ones (``_hot_items``)
    are spread over many tasks (``_spread_chunks``).
    """
    if chunk_chars <= min_chars:
        raise ValueError("a chunk must be longer than min_chars")
    rows = _document_rows(clean)
    hot = _hot_items(rows)

    def cut(batches):
        def found():
            for asin, texts, _ in _items(batches):
                if _long_enough(texts, min_chars):
                    text = " ".join(texts)
                    for at in range(0, len(text), chunk_chars):
                        yield asin, at, text[at:at + chunk_chars]

        return _in_batches(found(), _CUT, 2)

    is_hot = F.coalesce(F.col("asin").isin(hot), F.lit(False))
    whole = _dealt(rows.filter(~is_hot) if hot else rows, "asin").mapInArrow(
        cut, "asin string, at long, text string")
    return whole.unionByName(_spread_chunks(rows.filter(is_hot), min_chars, chunk_chars)) if hot else whole


def _spread_chunks(texts: DataFrame, min_chars: int, chunk_chars: int) -> DataFrame:
    """``item_document_chunks`` of hot items.

    Segmented concatenation: parts are range-sorted by item and order, so a hot item is
    spread over many tasks, and texts are shuffled once.  A task joins what it reads in order and
    writes chunks with their place in its own share of the item.  Only an item that goes on
    from one range into the next needs more: what came before it, a prefix sum over ranges
    (one row a range).
    """
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["asin", "unixReviewTime", "reviewerID", F.md5("text")]
    rows = texts.repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def join(batches):
        part = TaskContext.get().partitionId()
        done, waiting = [], 0
        item, held, size, at, inner, total = None, [], 0, 0, False, 0

        def flush(edge: bool) -> None:
            nonlocal held, size, at, waiting
            done.append((item, part, at, size, "".join(held), edge))
            at, waiting, held, size = at + size, waiting + size, [], 0

        def out():
            nonlocal done, waiting
            rows, done, waiting = done, [], 0
            return pa.RecordBatch.from_arrays(
                [pa.array(x, f.type) for x, f in zip(zip(*rows), _CHUNKS)], schema=_CHUNKS)

        for batch in batches:
            for asin, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if asin != item:
                    # an item that neither begins nor ends the range is whole: decided here
                    if item is not None and (not inner or total > min_chars):
                        flush(not inner)
                    inner, item, held, size, at, total = item is not None, asin, [], 0, 0, 0
                else:
                    text = " " + text
                total += len(text)
                while size + len(text) > chunk_chars:
                    held.append(text[:chunk_chars - size])
                    text, size = text[chunk_chars - size:], chunk_chars
                    flush(not inner)
                held.append(text)
                size += len(text)
                if waiting > _BATCH_CHARS:
                    yield out()
        if item is not None:
            flush(True)
            yield out()

    found = kept(rows.select("asin", "text").mapInArrow(
        join, "asin string, part int, at long, chars long, text string, edge boolean"),
        "item-chunks", compression="zstd")
    # the first and the last item of each range: at most two rows a range
    shares = (found.groupBy("asin", "part")
              .agg(F.sum("chars").alias("chars"), F.max("edge").alias("edge")).filter("edge"))
    before = Window.partitionBy("asin").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shares = shares.select(
        "asin", "part", (F.coalesce(F.sum("chars").over(before), F.lit(0))
                         + F.count(F.lit(1)).over(before)).alias("before"),
        (F.sum("chars").over(Window.partitionBy("asin"))
         + F.count(F.lit(1)).over(Window.partitionBy("asin")) - 1).alias("total"))
    joined = found.join(F.broadcast(shares), ["asin", "part"], "left")
    goes_on = F.coalesce(F.col("before") > 0, F.lit(False))
    first = goes_on & (F.col("at") == 0)           # the blank between the shares comes with it
    return joined.filter(F.coalesce(F.col("total") > min_chars, F.lit(True))).select(
        "asin", (F.col("at") + F.coalesce("before", F.lit(0)) - first.cast("int")).alias("at"),
        F.concat(F.when(first, " ").otherwise(""), "text").alias("text")).filter(F.col("text") != "")


def joined_chunks(chunks: DataFrame) -> DataFrame:
    """(asin, combinedText, gapless, longest): the chunks of every item joined by their places,
    whether each begins where the one before it ends, and the characters of the longest one.
    One shuffle of the chunks, compressed, which are sorted where they arrive."""
    def join(batches):
        def found():
            for table in _grouped(batches):
                at, first, _ = _runs(table, ["asin", "at", "text"])
                text, begins = table.column("text").cast(pa.large_string()).take(at), table.column("at").take(at)
                places = np.flatnonzero(first)
                asins = table.column("asin").take(at[places]).to_pylist()
                for asin, start, end in zip(asins, places.tolist(), [*places[1:].tolist(), len(at)]):
                    texts = text.slice(start, end - start).to_pylist()
                    ats, sizes = begins.slice(start, end - start).to_pylist(), [len(t) for t in texts]
                    gapless = all(a + n == b for a, n, b in zip(ats, sizes, ats[1:]))
                    yield asin, "".join(texts), gapless, max(sizes)

        return _in_batches(found(), _JOINED, 1)

    return _dealt(chunks.select("asin", "at", "text"), "asin").mapInArrow(
        join, "asin string, combinedText string, gapless boolean, longest long")


def item_text_stats(clean: DataFrame, min_chars: int = MIN_DOC_CHARS) -> DataFrame:
    """(asin, reviewCount, avgRating, docChars) for items whose joined text would be longer
    than ``min_chars``.  One grouped aggregate over numbers: no text in any buffer."""
    stats = _texts(clean).select("asin", "overall", F.length("text").alias("chars")).groupBy("asin").agg(
        F.count(F.lit(1)).alias("reviewCount"), F.avg("overall").alias("avgRating"),
        (F.sum("chars") + F.count(F.lit(1)) - 1).alias("docChars"))
    return stats.filter(F.col("docChars") > min_chars)


def item_text_parts(clean: DataFrame) -> DataFrame:
    """One row per review text: (asin, unixReviewTime, reviewerID, overall, text).  Parts
    stay where they were scanned; per-item figures are aggregated from numbers."""
    return _texts(clean)


def tokenizer(input_col: str, output_col: str) -> Tokenizer:
    """Lower case, split on single whitespace characters (Spark ML ``Tokenizer``)."""
    return Tokenizer(inputCol=input_col, outputCol=output_col)


def stop_words_remover(input_col: str, output_col: str) -> StopWordsRemover:
    return StopWordsRemover(inputCol=input_col, outputCol=output_col, caseSensitive=False,
                            stopWords=StopWordsRemover.loadDefaultStopWords("english"))


def split_tokens(text, keep_trailing: bool = False) -> Column:
    """Native equivalent of ``Tokenizer`` on one text.

    ``Tokenizer`` splits with Java's ``String.split("\\\\s")``: inner and leading
    empty tokens stay, trailing empty tokens are dropped, and an all-whitespace
    string gives no tokens.  ``keep_trailing`` keeps the trailing empties, which is
    what a part sees when it is followed by more text in the same document.
    """
    t = F.lower(F.col(text) if isinstance(text, str) else text)
    if keep_trailing:
        return F.split(t, r"\s", -1)
    trimmed = F.regexp_replace(t, r"\s+$", "")
    return (F.when(t == "", F.array(F.lit("")))
            .when(trimmed == "", F.array().cast("array<string>"))
            .otherwise(F.split(trimmed, r"\s", -1)))


def item_tokens(docs: DataFrame, text_col: str = "combinedText") -> DataFrame:
    """docs + ``rawTokens`` via Spark ML's Tokenizer."""
    return tokenizer(text_col, "rawTokens").transform(docs)


def _cut(texts: pa.Array, stop: pa.Array):
    """(tokens, kept, first, last, starts, blank) of texts split on single blanks, all texts'
    tokens one after another, each with the blank that ends it: whether it is no stop word
    (``stop`` has these with every blank), the places of every text's first and last token, where
    tokens begin, and which bytes are blanks.  A text of n blanks has n + 1 tokens."""
    n = len(texts)
    _, bounds, data = texts.buffers()
    bounds = np.frombuffer(bounds, np.int64 if pa.types.is_large_string(texts.type) else np.int32)
    bounds = bounds[texts.offset:texts.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data or b"", np.uint8)[bounds[0]:bounds[-1]]
    bounds -= bounds[0]
    blank = data == 32
    blank |= data - np.uint8(9) < 5              # with the blank, Java's \\s: one byte each in UTF-8
    at = np.flatnonzero(blank)
    last = np.searchsorted(at, bounds[1:]) + np.arange(n)
    first = np.append(0, last[:-1] + 1)
    inner = np.ones(len(at) + n, bool)
    inner[first] = False
    starts = np.empty(len(inner) + 1, np.int64)
    starts[:-1][inner] = at + 1
    starts[first], starts[-1] = bounds[:-1], bounds[-1]
    tokens = pa.Array.from_buffers(pa.large_string(), len(inner), [
        None, pa.py_buffer(starts), pa.py_buffer(data)])
    kept = ~pc.is_in(tokens, stop).to_numpy(zero_copy_only=False)
    return tokens, kept, first, last, starts, blank


def _shares(texts: pa.Array):
    """``texts`` without nulls in slices of about ``_CUT_BYTES``; a longer text is a slice."""
    texts = texts.fill_null("")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        done = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, done + _CUT_BYTES, "right")))
        yield texts.slice(at, end - at)
        at = end


def _kept(texts: pa.Array, stop: pa.Array):
    """(bytes, places, sizes) of every share: the tokens that are no stop words, each with the
    byte that ends it (a blank), where they begin, and how many each text has."""
    for share in _shares(texts):
        tokens, kept, first, last, starts, _ = _cut(share, stop)
        data = np.frombuffer(tokens.buffers()[2] or b"", np.uint8)
        # every token ends with a blank: a text's last one gets it
        spaced = np.insert(data, starts[last + 1], 32)
        starts = starts + np.append(0, np.cumsum(np.bincount(last, minlength=len(kept))))
        tokens = pa.Array.from_buffers(pa.large_string(), len(kept), [
            None, pa.py_buffer(starts), pa.py_buffer(spaced)]).filter(pa.array(kept))
        places = np.frombuffer(tokens.buffers()[1], np.int64)[:len(tokens) + 1]
        data = np.frombuffer(tokens.buffers()[2] or b"", np.uint8)[:places[-1]]
        yield data, places, np.add.reduceat(kept, first, dtype=np.int64)


def _words(texts: pa.Array, stop: pa.Array) -> pa.Array:
    """The tokens that are no stop words, a list for each text."""
    out, sizes = [], [np.zeros(1, np.int64)]
    for data, places, n in _kept(texts, stop):
        ends = np.zeros(len(data), bool)
        ends[places[1:] - 1] = True
        out.append(pa.Array.from_buffers(pa.string(), len(places) - 1, [
            None, pa.py_buffer((places - np.arange(len(places))).astype(np.int32)), pa.py_buffer(data[~ends])]))
        sizes.append(n)
    ends = np.cumsum(np.concatenate(sizes)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.concat_arrays(out) if out else pa.array([], pa.string()),
                                    mask=texts.is_null() if texts.null_count else None)


def _joined_words(texts: pa.Array, stop: pa.Array) -> pa.Array:
    """The tokens that are no stop words, joined by single spaces."""
    out = [pa.array([], pa.string())]
    for data, places, n in _kept(texts, stop):
        data = data.copy()
        data[places[1:] - 1] = 32
        ends = places[np.append(0, np.cumsum(n))]
        row = pa.Array.from_buffers(pa.large_string(), len(n), [None, pa.py_buffer(ends), pa.py_buffer(data)])
        # without the space after the last one
        out.append(pc.binary_slice(row.cast(pa.large_binary()), 0, -1).cast(pa.string()))
    joined = pa.concat_arrays(out)
    return pc.if_else(texts.is_null(), pa.scalar(None, pa.string()), joined) if texts.null_count else joined


def _word_counts(texts: pa.Array, stop: pa.Array) -> pa.Array:
    """(nTokens, endEmpties): the number of ``_words`` and how many empty tokens end each text."""
    counts, empties = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for share in _shares(texts):
        _, kept, first, last, starts, blank = _cut(share, stop)
        counts.append(np.add.reduceat(kept, first, dtype=np.int64))
        # tokens after the one with the last byte that is no blank: found among the bytes from
        # the text's end, in as many steps as the longest run of blanks at an end
        at, begin = starts[last + 1] - 1, starts[first]
        n = np.zeros(len(first), np.int64)
        open_ = np.arange(len(first))
        while len(open_):
            here = at[open_] - n[open_]
            open_ = open_[(here >= begin[open_]) & blank[here]] if len(blank) else open_[:0]
            n[open_] += 1
        empties.append(n + (starts[last + 1] - begin == n))    # of blanks alone: one more
    nulls = texts.is_null().to_numpy(zero_copy_only=False)
    return pa.StructArray.from_arrays([pa.array(np.concatenate(x), pa.int64(), mask=nulls)
                                       for x in (counts, empties)], ["nTokens", "endEmpties"])


def _english() -> list[str]:
    """English stop words, alone and with each blank after them."""
    return [w.lower() + b for w in StopWordsRemover.loadDefaultStopWords("english")
            for b in ("", " ", "\t", "\n", "\x0b", "\f", "\r")]


def kept_words(lowered) -> Column:
    """The tokens of a lower-cased text without English stop words, trailing empties kept: as
    ``split_tokens(keep_trailing=True)`` and ``stop_words_remover``, in Arrow batches."""
    stop = _english()

    def words(texts: pa.Array) -> pa.Array:
        return _words(texts, pa.array(stop, pa.large_string()))

    return F.arrow_udf(words, "array<string>")(lowered)


def joined_words(lowered) -> Column:
    """``kept_words`` joined by single spaces: ``array_join`` of them, without making the tokens."""
    stop = _english()

    def joined(texts: pa.Array) -> pa.Array:
        return _joined_words(texts, pa.array(stop, pa.large_string()))

    return F.arrow_udf(joined, "string")(lowered)


def word_counts(lowered) -> Column:
    """(nTokens, endEmpties) of ``kept_words``, without making the tokens."""
    stop = _english()

    def counts(texts: pa.Array) -> pa.Array:
        return _word_counts(texts, pa.array(stop, pa.large_string()))

    return F.arrow_udf(counts, "nTokens long, endEmpties long")(lowered)
