"""Personal data, and the terms that disclose it.

Four kinds of values are found by patterns. All words of a document that holds a
value are the value's context. How strongly a term t reveals a value e is their
pointwise mutual information over documents, log(N n(e,t) / (n(e) n(t))), against
the information of the value itself, log(N / n(e)): at a share of 1 the term gives
the value away. Of a value in one document that is the information of the term
itself, log(N / n(t)). Terms that reach `threshold` of a value's information are
marked wherever they stand in the documents of that value, and generalised along
with the values.

All of it is built-in functions. The spans of a text come from one pass per
kind over the text between and within the matches. Of documents with a value,
each word becomes a row with its place; terms so frequent that no count with a
value could make them telling are left out before (value, term) pairs are
counted, combined within each task before they are sent.

Defined results: a null text has no spans; values and terms in texts of any
length are found; equal values count once per document for the statistics, and
documents of equal id and text count as one, in all counts; other columns stay as they are in
`sanitise`. Every start is the position of a code point from 0, every end is
exclusive. The patterns are written so that no text makes them backtrack: a
run of word characters is left at its end or not entered at all.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corvane.llm.tables import ascii_lower, narrow
from corvane.session import shared_folder

# The same matches as of the plain patterns, found in time linear in the text:
# a match begins at the start of its run of characters, or where the last match ended.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# A character without which a text has no match.
SIGN = {"email": "@", "ip": ".", "phone": "+"}
# Words of letters that are no part of an address or number.
TERM = r"(?<![\p{L}\p{N}@._%+-])\p{L}{2,}+(?![\p{N}@_%+-]|\.[\p{L}\p{N}])"


@dataclass(frozen=True)
class Disclosure:
    threshold: float = 0.8


def _luhn(digits: Column) -> Column:
    """Whether the digits pass the Luhn test."""
    reverse = F.reverse(digits)
    value = lambda i: F.substring(reverse, i, F.lit(1)).cast("int") * (2 - i % 2)
    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda s, i: s + value(i) - F.when(value(i) > 9, 9).otherwise(0))
    return total % 10 == 0


def _holds(kind: str, value: Column) -> Column:
    """What a match must fulfil beyond its pattern."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    n = F.length(digits)
    if kind == "ip":
        # Three digits at most once leading zeros are gone, so that any number can be compared.
        return F.forall(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "").rlike("^(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return n.between(13, 19) & F.when(n.between(13, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return n.between(9, 15)
    return F.lit(True)


def matches(docs: DataFrame, kind: str) -> DataFrame:
    """doc, kind, start, end, value: the valid matches of a kind in (doc, text) rows."""
    text = F.col("text")
    found = F.regexp_extract_all(text, F.lit(f"({PATTERNS[kind]})"), F.lit(1))
    gaps = F.split(text, PATTERNS[kind], -1)
    sign = text.contains(SIGN[kind]) if kind in SIGN else text.rlike("[0-9]")
    parts = docs.where(sign).select("doc", found.alias("found"), gaps.alias("gaps")).where(F.size("found") > 0)
    rows = parts.select("doc", "gaps", F.posexplode("found").alias("i", "value")).select(
        "doc", "i", "value", F.length(F.get("gaps", F.col("i"))).alias("gap")
    )
    # Rows of the same id and text say the same; one of them is enough. A text's matches are summed up in order.
    so_far = Window.partitionBy("doc").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = rows.distinct().withColumn("end", F.sum(F.col("gap") + F.length("value")).over(so_far).cast("int"))
    return ends.where(_holds(kind, F.col("value"))).select(
        "doc",
        F.lit(kind).alias("kind"),
        (F.col("end") - F.length("value")).alias("start"),
        "end",
        "value",
    )


def _words(docs: DataFrame) -> DataFrame:
    """doc, term, start, end: each word of (doc, text) rows."""
    found, gaps = F.regexp_extract_all("text", F.lit(f"({TERM})"), F.lit(1)), F.split("text", TERM, -1)
    both = F.zip_with(found, gaps, lambda w, g: F.struct(w.alias("word"), F.length(g).alias("gap")))
    # One gap more than words: the last pair has none.
    rows = docs.select("doc", F.posexplode(both).alias("i", "w")).where("w.word is not null").select("doc", "i", "w.word", "w.gap")
    so_far = Window.partitionBy("doc").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = rows.withColumn("end", F.sum(F.col("gap") + F.length("word")).over(so_far).cast("int"))
    return ends.select("doc", ascii_lower(F.col("word")).alias("term"), (F.col("end") - F.length("word")).alias("start"), "end")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc (id and text hash), text."""
    return narrow(docs, id=id_col, text=text_col).select(F.struct("id", F.xxhash64("text").alias("hash")).alias("doc"), "text")


def find_spans(docs: DataFrame, rule: Disclosure = Disclosure(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc, kind, start, end: the values of all kinds, and the terms (kind `term`) that disclose them."""
    spark = docs.sparkSession
    folder = shared_folder(spark, "disclosure")

    def kept(df: DataFrame, name: str) -> DataFrame:
        """Written once: read several times below, and of a size that the planner then knows."""
        df.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    keyed = _keyed(docs, id_col, text_col)
    n_docs = keyed.select("doc").distinct().count()
    if n_docs < keyed.count():
        keyed = keyed.dropDuplicates(["doc"])
    parts = [matches(keyed, kind) for kind in PATTERNS]
    values = kept(parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3]), "values")
    holding = values.select("doc", F.struct("kind", "value").alias("entity")).distinct()
    holding = kept(holding.join(holding.groupBy("entity").agg(F.count("*").alias("n_entity")), "entity"), "holding")
    words = kept(_words(keyed.join(holding.select("doc").distinct(), "doc", "left_semi")), "words")
    every = keyed.select(F.explode(F.array_distinct(F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(f"({TERM})"), F.lit(1)))).alias("term"))
    n_term = every.groupBy("term").agg(F.count("*").alias("n_term"))
    information = F.log(F.lit(n_docs) / F.col("n_entity"))
    # n_both is n_entity at most: no term above this count can be telling of a value. The margin is for rounding.
    can_tell = lambda n_entity: F.log(F.lit(n_docs) / F.col("n_term")) >= rule.threshold * F.log(F.lit(n_docs) / n_entity) - 1e-9
    most = holding.agg(F.max("n_entity")).first()[0] or 1
    doc_terms = words.select("doc", "term").distinct().join(n_term.where(can_tell(F.lit(most))), "term")
    pairs = kept(holding.join(doc_terms, "doc").where((information > 0) & can_tell(F.col("n_entity"))), "pairs")
    together = pairs.groupBy("entity", "term", "n_entity", "n_term").agg(F.count("*").alias("n_both"))
    shared = F.log(F.lit(n_docs) * F.col("n_both") / (F.col("n_entity") * F.col("n_term")))
    telling = together.where(shared >= rule.threshold * information).select("entity", "term")
    marked = pairs.join(telling, ["entity", "term"], "left_semi").select("doc", "term").distinct()
    disclosed = words.join(marked, ["doc", "term"], "left_semi")
    return values.select("doc", "kind", "start", "end").unionByName(
        disclosed.select("doc", F.lit("term").alias("kind"), "start", "end")
    )


_SPANS = "array<struct<rank:int,start:int,end:int,kind:string>>"


def document_spans(docs: DataFrame, rule: Disclosure = Disclosure(), id_col: str = "doc_id", text_col: str = "text", into: str = "spans") -> DataFrame:
    """The documents with a column, `into`: rank, start, end, kind of each span, by kind as listed (terms last), then start."""
    order = [*PATTERNS, "term"]
    rank = F.array_position(F.array(*map(F.lit, order)), F.col("kind")).cast("int")
    found = find_spans(docs, rule, id_col, text_col).groupBy(F.col("doc").alias("__doc")).agg(
        F.array_sort(F.collect_list(F.struct(rank.alias("rank"), "start", "end", "kind"))).alias("__spans")
    )
    key = F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("hash"))
    return docs.join(found, key == F.col("__doc"), "left").select(
        *(F.col(f"`{c}`") for c in docs.columns), F.coalesce("__spans", F.array().cast(_SPANS)).alias(into)
    )


def sanitise(docs: DataFrame, rule: Disclosure = Disclosure(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with all values replaced by their kind and all disclosing terms by `[term]`; of spans that overlap the first counts."""
    spotted = document_spans(docs, rule, id_col, text_col, into="__found")
    in_order = F.array_sort(F.transform("__found", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    text = F.col(text_col)
    done = F.aggregate(
        in_order,
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.when(s["start"] < acc["at"], acc).otherwise(
            F.struct(
                s["end"].alias("at"),
                F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit("["), s["kind"], F.lit("]")).alias("out"),
            )
        ),
        lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))),
    )
    return spotted.select(*(done.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns))
