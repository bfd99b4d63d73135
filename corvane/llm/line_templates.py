"""Line dedup by a tree of log templates.

Each line goes down a tree of fixed depth: by its number of words, then by its
leading words, of which those with a digit count as a variable. Within a leaf, a
word is a constant at its place if it stands there in `min_docs` documents at
least; all others are variable fields. A line's template is its leaf with the
variable fields generalised. A template is *recurring* if it comes in
`min_docs` documents and at least half of its words, three at least, are
constants; its lines are dropped from all documents but the first that has it.

A template without variable fields is a whole line, and the more constants it
has, the fewer documents it takes: a line of three words or more recurs from
`min_docs` documents on, less one for every two words, and from two at least (so
16 words do with the usual ten). Copies of a document count once there: counted
are different texts, and all copies of the first keep the line.

All of it is built-in functions. What is shuffled is a row per line, and a row
per word only for lines in leaves that enough documents share; counts are
combined within each task first, so a line in a third of all documents is not a
hot key.

Defined results: lines are separated by line feeds; a line without a word is
never dropped; a line that its document repeats counts once towards the
template and is dropped, or kept, in each place; the first document is that
with the smallest id, then text hash; null texts stay null and empty ones
empty; rows of equal id and text are one document, so the first of them keeps
its lines in each row. Other columns, of whatever name, are kept by `drop_recurring_lines`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.llm.tables import narrow
from corvane.session import shared_folder

DEPTH = 3
VARIABLE = "<*>"


def line_words(line: Column) -> Column:
    """The words of a line: what white space [\\x20\\x09-\\x0D] separates."""
    return F.filter(F.split(line, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def general(word: Column) -> Column:
    return F.when(word.rlike("[0-9]"), F.lit(VARIABLE)).otherwise(word)


def document_lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc (id and text hash), line_no, words of each line with a word."""
    lines = narrow(docs, id=id_col, text=text_col).select(
        F.struct("id", F.xxhash64("text").alias("hash")).alias("doc"), F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line")
    )
    return lines.where(F.col("line").rlike(r"[^\x20\x09-\x0D]")).select("doc", "line_no", line_words(F.col("line")).alias("words"))


def leaf_of(words: Column) -> Column:
    return F.xxhash64(F.size(words), F.transform(F.slice(words, 1, DEPTH), general))


def line_keys(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc, line_no, leaf, n (words), k1, k2 (the words' hash) of each line with a word: a table, so that texts are split for it once."""
    words = F.col("words")
    keys = document_lines(docs, id_col, text_col).select(
        "doc", "line_no", leaf_of(words).alias("leaf"), F.size(words).alias("n"), F.xxhash64(words).alias("k1"), F.xxhash64(F.lit(1), words).alias("k2")
    )
    path = shared_folder(docs.sparkSession, "line_keys") + "/keys"
    keys.write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def recurring_lines(
    docs: DataFrame, min_docs: int = 10, id_col: str = "doc_id", text_col: str = "text", keys: DataFrame | None = None
) -> DataFrame:
    """doc, line_no, template, n_docs, first_doc of each line whose template recurs. `keys`: the documents' `line_keys`, if at hand."""
    spark = docs.sparkSession
    folder = shared_folder(spark, "templates")

    def kept(df: DataFrame, name: str) -> DataFrame:
        """Written once: read several times below, and of a size that the planner then knows."""
        df.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    lines = document_lines(docs, id_col, text_col).withColumn("leaf", leaf_of(F.col("words")))
    # Leaves that enough documents share; a document's lines of a leaf count once.
    keys = line_keys(docs, id_col, text_col) if keys is None else keys
    leaves = keys.groupBy("leaf", "doc").agg(F.lit(1).alias("one")).groupBy("leaf").agg(F.count("*").alias("n")).where(F.col("n") >= min_docs)
    candidates = kept(lines.join(kept(leaves.select("leaf"), "leaves"), "leaf", "left_semi"), "candidates")
    words = candidates.select("leaf", "doc", F.posexplode("words").alias("place", "word"))
    seen = words.groupBy("leaf", "place", "word", "doc").agg(F.lit(1).alias("one"))
    # For each leaf, the constants of each place: as many sets as its lines have words, some of them empty.
    constants = (
        seen.groupBy("leaf", "place", "word")
        .agg(F.count("*").alias("n"))
        .groupBy("leaf", "place")
        .agg(F.collect_set(F.when(F.col("n") >= min_docs, F.col("word"))).alias("fixed"))
        .groupBy("leaf")
        .agg(F.array_sort(F.collect_list(F.struct("place", "fixed"))).alias("places"))
        .select("leaf", F.col("places.fixed").alias("constants"))
    )
    fixed = F.zip_with("words", "constants", lambda w, c: F.array_contains(c, w))
    marked = candidates.join(constants, "leaf").withColumn("fixed", fixed)
    n_fixed = F.size(F.filter("fixed", lambda x: x))
    templated = kept(marked.where((n_fixed >= 3) & (2 * n_fixed >= F.size("words"))).select(
        "doc", "line_no", F.array_join(F.zip_with("words", "fixed", lambda w, f: F.when(f, w).otherwise(VARIABLE)), " ").alias("template")
    ), "templated")
    by_doc = templated.groupBy("template", "doc").agg(F.lit(1).alias("one"))
    recurring = by_doc.groupBy("template").agg(F.count("*").alias("n_docs"), F.min("doc").alias("first_doc")).where(F.col("n_docs") >= min_docs)
    return templated.join(recurring, "template").select("doc", "line_no", "template", "n_docs", "first_doc")


def repeated_lines(keys: DataFrame, min_docs: int = 10) -> DataFrame:
    """doc, line_no, n_texts, first_doc of each line (of `line_keys`) that stands in as many different texts as its length takes."""
    path = shared_folder(keys.sparkSession, "whole_lines") + "/lines"
    lines = keys.where("n >= 3").drop("leaf")
    by_text = lines.groupBy("k1", "k2", "n", F.col("doc.hash").alias("text")).agg(F.lit(1).alias("one"))
    counts = by_text.groupBy("k1", "k2", "n").agg(F.count("*").alias("n_texts")).where("n_texts >= 2")
    counts.where(F.col("n_texts") >= min_docs - F.floor(F.col("n") / 2)).drop("n").write.parquet(path)
    # Written, so that Spark knows its size and sends it to the tasks if it is small. First documents are sought for these lines only.
    repeated = lines.join(keys.sparkSession.read.parquet(path), ["k1", "k2"])
    first = repeated.groupBy("k1", "k2").agg(F.min("doc").alias("first_doc"))
    return repeated.join(first, ["k1", "k2"]).select("doc", "line_no", "n_texts", "first_doc")


def dropped_lines(docs: DataFrame, min_docs: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc, lines: the numbers of the lines that a document loses."""
    keys = line_keys(docs, id_col, text_col)
    by_template = recurring_lines(docs, min_docs, id_col, text_col, keys).where("doc <> first_doc").select("doc", "line_no")
    whole = repeated_lines(keys, min_docs).where("doc.hash <> first_doc.hash").select("doc", "line_no")
    return by_template.unionByName(whole).groupBy("doc").agg(F.array_sort(F.collect_set("line_no")).alias("lines"))


def drop_recurring_lines(docs: DataFrame, min_docs: int = 10, id_col: str = "doc_id", text_col: str = "text", keep_lines: str | None = None) -> DataFrame:
    """The documents, with all their columns, without their recurring lines.

    `keep_lines` names a column to add: the numbers of the lines dropped.
    """
    # All columns in one, where none of them can clash with those of the lines.
    packed = docs.select(F.struct(*(F.col(f"`{c}`").alias(c) for c in docs.columns)).alias("row"))
    row = lambda c: F.col("row").getField(c)
    key = F.struct(row(id_col).alias("id"), F.xxhash64(row(text_col)).alias("hash"))
    joined = packed.join(dropped_lines(docs, min_docs, id_col, text_col), key == F.col("doc"), "left")
    rest = F.filter(F.split(row(text_col), "\n", -1), lambda line, i: ~F.array_contains("lines", i))
    text = F.when(F.col("lines").isNull(), row(text_col)).otherwise(F.array_join(rest, "\n"))
    added = [] if keep_lines is None else [F.coalesce("lines", F.array().cast("array<int>")).alias(keep_lines)]
    return joined.select(*(text.alias(c) if c == text_col else row(c).alias(c) for c in docs.columns), *added)
