"""Benchmark decontamination.

The normalised n-word windows of all benchmark items form a hash set; every
window of the training texts is looked up in it, and what the hash suggests is
verified word by word. The set joins as a table: Spark broadcasts it while it is
known to be small, and shuffles by window hash once it is not. Everything is
done with built-in functions.

Defined results: a null text has no words; an item of fewer than `n` words, but
not none, is one window; empty and null items are in no document; items of
equal text are found together; an item or document that appears in several rows
is counted once, and each document row gets a result. `decontaminate` keeps all
columns of the documents, whatever they are called but `doc_key` and `__hit_words`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.llm.tables import ascii_lower, narrow

# Between words of [^\x00-\x2F\x3A-\x60\x7B-\x7F].
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The same words where upper-case letters are still in the text.
CASED_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The words of a text, A-Z in lower case; none for null."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), BETWEEN, -1), "")


def benchmark_windows(items: DataFrame, n: int, item_id: str, text: str) -> DataFrame:
    """window (its words), width, hash, item_ids of each different window."""
    words = narrow(items, item_id=item_id, text=text).select("item_id", words_of(F.col("text")).alias("words"))
    width = F.least(F.size("words"), F.lit(n))
    return (
        words.where(F.size("words") > 0)
        .select("item_id", "words", width.alias("width"), F.explode(F.sequence(F.lit(1), F.size("words") - width + 1)).alias("at"))
        .select("item_id", "width", F.expr("slice(words, at, width)").alias("window"))
        .groupBy("window", "width")
        .agg(F.collect_set(F.col("item_id").cast("string")).alias("item_ids"))
        .withColumn("hash", F.xxhash64(F.transform("window", lambda word: F.xxhash64(word))))
    )


def hits(docs: DataFrame, items: DataFrame, n: int = 10, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_key, at (1 is a document's first word), width, item_ids: each place where a window occurs.

    `doc_key` is the document's id and text hash as a struct, the same as `document_key` gives.
    """
    windows = benchmark_windows(items, n, item_id, item_text)
    # At most n different widths.
    widths = sorted(row.width for row in windows.select("width").distinct().collect())
    words = narrow(docs, doc_id=doc_id, text=text).select(document_key("doc_id", "text").alias("doc_key"), words_of(F.col("text")).alias("words"))
    hashed = words.withColumn("hashes", F.transform("words", lambda word: F.xxhash64(word)))
    found = None
    for width in widths:
        # Not a filter on the number of words: it would split the text once more.
        windows_of = F.expr(
            f"if(size(hashes) >= {width}, transform(sequence(1, size(hashes) - {width - 1}), at -> xxhash64(slice(hashes, at, {width}))), array())"
        )
        # The array is a column of its own, so that generating its rows and looking them up is one compiled
        # loop, in which the words are only touched for a hit. The outer form keeps the planner from testing
        # the array's size beforehand, which would compute it twice, and the two comparisons keep the words
        # out of the join's key.
        windowed = hashed.select("doc_key", "words", windows_of.alias("hashes"))
        scanned = windowed.select("doc_key", "words", F.posexplode_outer("hashes").alias("place", "hash"))
        known = windows.where(F.col("width") == width)
        words_there = F.slice("words", F.col("place") + 1, width)
        matched = scanned.join(known, "hash").where((words_there >= F.col("window")) & (words_there <= F.col("window")))
        part = matched.select("doc_key", (F.col("place") + 1).alias("at"), F.lit(width).alias("width"), "item_ids")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return words.select("doc_key", F.lit(0).alias("at"), F.lit(0).alias("width"), F.array().cast("array<string>").alias("item_ids")).where("false")
    return found


def document_key(doc_id: str, text: str) -> Column:
    """Tells documents apart even where ids repeat or are missing."""
    return F.struct(F.col(doc_id).alias("id"), F.xxhash64(text).alias("hash"))


def contamination(docs: DataFrame, items: DataFrame, n: int = 10, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_key, n_hit (words inside windows), items (ids found, as sorted strings) of each document with a hit."""
    places = hits(docs, items, n, doc_id, text, item_id, item_text)
    covered = places.select("doc_key", "item_ids", F.explode(F.sequence("at", F.col("at") + F.col("width") - 1)).alias("word"))
    # Two steps, the first of them combined within each task: a word counts once, however many windows cover it.
    by_word = covered.groupBy("doc_key", "word").agg(F.collect_set("item_ids").alias("item_ids"))
    return by_word.groupBy("doc_key").agg(
        F.count("*").alias("n_hit"), F.array_sort(F.array_distinct(F.flatten(F.flatten(F.collect_set("item_ids"))))).alias("items")
    )


def measure(docs: DataFrame, items: DataFrame, n: int = 10, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, n_words, n_hit and items of every document."""
    found = contamination(docs, items, n, doc_id, text, item_id, item_text)
    every = narrow(docs, doc_id=doc_id, text=text).select(
        "doc_id",
        document_key("doc_id", "text").alias("doc_key"),
        F.size(words_of(F.col("text"))).cast("long").alias("n_words"),
    )
    joined = every.join(found, every.doc_key == found.doc_key, "left")
    return joined.select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items")
    )


def decontaminate(docs: DataFrame, items: DataFrame, n: int = 10, remove: str = "documents", doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents, with all their columns, without the contaminated ones, or without the words inside windows.

    `remove="spans"` leaves the characters between removed words in place.
    """
    key = document_key(doc_id, text)
    if remove == "documents":
        found = contamination(docs, items, n, doc_id, text, item_id, item_text).select("doc_key")
        return docs.join(found, key == F.col("doc_key"), "left_anti")
    if remove != "spans":
        raise ValueError("remove is 'documents' or 'spans'")
    places = hits(docs, items, n, doc_id, text, item_id, item_text)
    covered = places.select("doc_key", F.explode(F.sequence("at", F.col("at") + F.col("width") - 1)).alias("word")).distinct()
    spans = covered.groupBy("doc_key").agg(F.collect_list("word").alias("__hit_words"))
    joined = docs.join(spans, key == F.col("doc_key"), "left")
    gaps, words = F.split(F.col(text), CASED_WORD, -1), F.regexp_extract_all(F.col(text), F.lit(f"({CASED_WORD})"), F.lit(1))
    kept = F.transform(words, lambda word, i: F.when(F.array_contains("__hit_words", i + 1), "").otherwise(word))
    rebuilt = F.array_join(F.zip_with(gaps, kept, lambda gap, word: F.concat(gap, F.coalesce(word, F.lit("")))), "")
    cleaned = F.when(F.col("__hit_words").isNull(), F.col(text)).otherwise(rebuilt)
    return joined.select(*(cleaned.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns))
