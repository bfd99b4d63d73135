"""One query for each operator, over its whole table, with SQL twins where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.llm import pieces, warc
from corvane.llm.collocations import frequent_phrases, score, top_phrases
from corvane.llm.contamination import measure
from corvane.llm.disclosure import PATTERNS, document_spans
from corvane.llm.filter_audit import audit, flag_documents
from corvane.llm.licences import scan
from corvane.llm.line_templates import drop_recurring_lines
from corvane.llm.main_text import main_text
from corvane.llm.quality import judge_text
from corvane.llm.sharding import assign_shards
from corvane.llm.similar import similar_groups
from corvane.llm.tables import table
from corvane.llm.top_vectors import top_vectors
from corvane.session import shared_folder

OP1 = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
h AS (SELECT page_id, octet_length(b) AS n, sha256(b) AS d FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY d) AS first FROM h)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
  CASE WHEN n >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 100 AND first <> page_id THEN first END AS refers_to
FROM f"""

# Windows of ten words of both sides, by position, joined on their words.
OP2 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
g AS (SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS gram
    FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
k AS (SELECT DISTINCT k FROM g),
s AS (SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS gram
    FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, k WHERE len(w) >= k)),
h AS (SELECT s.doc_id, s.i, s.k, g.item_id FROM s JOIN g ON s.gram = g.gram AND s.k = g.k),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)"""

OP6 = r"""
WITH l AS (SELECT doc_id, generate_subscripts(a, 1) - 1 AS line_no, unnest(a) AS line
    FROM (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents WHERE text IS NOT NULL)),
w AS (SELECT doc_id, line_no, list_filter(string_split_regex(line, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
    FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
f AS (SELECT *, len(words) || ' ' || array_to_string(
    list_transform(words[1:3], lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '<*>' ELSE x END), ' ') AS leaf FROM w),
c AS (SELECT * FROM f WHERE leaf IN (SELECT leaf FROM f GROUP BY leaf HAVING count(DISTINCT doc_id) >= 10)),
e AS (SELECT doc_id, line_no, leaf, generate_subscripts(words, 1) AS place, unnest(words) AS word FROM c),
k AS (SELECT leaf, place, word FROM e GROUP BY ALL HAVING count(DISTINCT doc_id) >= 10),
t AS (SELECT doc_id, line_no, string_agg(coalesce(k.word, '<*>'), ' ' ORDER BY place) AS template, count(k.word) AS n_fixed, count(*) AS n
    FROM e LEFT JOIN k USING (leaf, place, word) GROUP BY doc_id, line_no),
q AS (SELECT * FROM t WHERE n_fixed >= 3 AND 2 * n_fixed >= n),
r AS (SELECT template, min(doc_id) AS first FROM q GROUP BY template HAVING count(DISTINCT doc_id) >= 10),
h AS (SELECT doc_id, line_no, len(words) AS n, array_to_string(words, ' ') AS line, min(doc_id) OVER (PARTITION BY text) AS copy_of
    FROM w JOIN documents USING (doc_id) WHERE len(words) >= 3),
g AS (SELECT line, min(copy_of) AS first FROM h GROUP BY line, n
    HAVING count(DISTINCT copy_of) >= 2 AND count(DISTINCT copy_of) >= 10 - n // 2),
d AS (SELECT doc_id, line_no FROM q JOIN r USING (template) WHERE doc_id <> first
    UNION SELECT doc_id, line_no FROM h JOIN g USING (line) WHERE copy_of <> first)
SELECT x.doc_id, count(line_no) AS n_lines, count(d.doc_id) AS n_dropped,
  coalesce(string_agg(CASE WHEN d.doc_id IS NOT NULL THEN line_no END::VARCHAR, ',' ORDER BY line_no), '') AS dropped,
  sha256(coalesce(string_agg(CASE WHEN d.doc_id IS NULL THEN line END, chr(10) ORDER BY line_no), '')) AS kept_sha256
FROM documents x LEFT JOIN l USING (doc_id) LEFT JOIN d USING (doc_id, line_no) GROUP BY x.doc_id"""


# The masks of all documents, then every order of the five filters as it stands.
OP11 = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS copy FROM d),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    CASE WHEN len(w) < 200 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN copy THEN 16 ELSE 0 END AS mask
    FROM w LEFT JOIN l USING (doc_id)),
c AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY part, mask),
f AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(f, b)),
o AS (SELECT f1.f || f2.f || f3.f || f4.f || f5.f AS filter_order, [f1.b, f2.b, f3.b, f4.b, f5.b] AS bits
    FROM f f1, f f2, f f3, f f4, f f5 WHERE f1.b | f2.b | f3.b | f4.b | f5.b = 31),
s AS (SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INTEGER AS before
    FROM (SELECT *, unnest(range(1, 6)) AS step FROM o)),
r AS (SELECT part, filter_order, step, bit,
    sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & before > 0 AND mask & bit > 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN toxic ELSE 0 END) AS toxic_lost
    FROM c, s GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
  unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM r"""


# Every query against every row.
OP12 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 5"""

# All windows of one to five words counted, without any pruning.
OP13 = r"""
WITH p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS p
    FROM (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)),
w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM p),
t AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang),
g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
    FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest(range(1, 6)) AS k)) GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS w FROM g WHERE k >= 2),
s AS (SELECT lang, phrase, k, a, array_to_string(w[i:i + m - 1], ' ') AS inner_phrase
    FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM c)) WHERE k > m),
x AS (SELECT lang, phrase FROM c WHERE NOT EXISTS (
    SELECT 1 FROM s WHERE s.lang = c.lang AND s.inner_phrase = c.phrase AND 100 * s.a >= 100 * c.a)),
u AS (SELECT lang, phrase, a, array_to_string(w[1:m], ' ') AS first, array_to_string(w[m + 1:], ' ') AS rest, m
    FROM (SELECT c.*, unnest(range(1, k)) AS m FROM c JOIN x USING (lang, phrase))),
v AS (SELECT u.lang, u.phrase, a, l.f AS l, r.f AS r, n, m, (1000::HUGEINT * a * n::HUGEINT) // (l.f::HUGEINT * r.f) AS score
    FROM u JOIN g l ON l.lang = u.lang AND l.phrase = u.first JOIN g r ON r.lang = u.lang AND r.phrase = u.rest JOIN t ON t.lang = u.lang),
z AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, m) = 1),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM z)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM o WHERE rank <= 2000"""


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back: length, digest and kind of its record."""
    path = shared_folder(spark, "warc")
    pages = table(spark, sf_dir, "pages")
    warc.write_archive(warc.mark_revisits(pages, "page_id", "url", "html"), path)
    ends = warc.read_archive(spark, path, with_data=False).where("last")
    return ends.select(
        F.col("record_id").cast("long").alias("page_id"),
        F.col("bytes_so_far").alias("payload_bytes"),
        F.col("sha256_so_far").alias("payload_digest"),
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far every document consists of windows of ten words from benchmark items, and of which items."""
    measured = measure(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return measured.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's main text."""
    return main_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's SentencePiece ids and the text they decode to, as digests."""
    import public_tokenizers

    vocabulary = pieces.load_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    docs = table(spark, sf_dir, "documents").select("doc_id", pieces.round_trip(F.col("text"), vocabulary).alias("r"))
    return docs.select(
        "doc_id",
        F.size("r.ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("r.ids", ","), 256).alias("ids_sha256"),
        F.sha2("r.text", 256).alias("decoded_sha256"),
    )


def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's licence notices: families, and lines with the family of each."""
    found = scan(table(spark, sf_dir, "documents"))
    places = F.array_join(F.transform("places", lambda p: F.concat_ws(":", p["line_no"], p["family"])), ",")
    return found.select("doc_id", "n_candidates", "n_confirmed", F.array_join("families", ",").alias("families"), places.alias("places"))


def op6_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's lines whose template recurs in ten documents or more, and a digest of the text without them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.size(F.split(F.coalesce("text", F.lit("")), "\n", -1)).cast("long").alias("n_lines"))
    kept = drop_recurring_lines(docs, keep_lines="dropped")
    return kept.select(
        "doc_id",
        "n_lines",
        F.size("dropped").cast("long").alias("n_dropped"),
        F.array_join("dropped", ",").alias("dropped"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


def op7_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard and slot, near-equal bytes in 24 shards, equal texts together."""
    placed = assign_shards(table(spark, sf_dir, "documents"), shards=24)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's personal data, and the terms that disclose it, as spans."""
    docs = document_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [F.expr(f"cast(size(filter(spans, s -> s.kind = '{kind}')) as long)").alias(f"n_{kind}") for kind in PATTERNS]
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind"] != "term")
    return docs.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def op9_similar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's n-gram count and the smallest document that links of similarity 0.85 lead to."""
    groups = similar_groups(table(spark, sf_dir, "documents"), n=4, percent=85)
    return groups.select("doc_id", F.col("n_ngrams").alias("n_shingles"), "component_id")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's base figures and verdict."""
    judged = table(spark, sf_dir, "documents").select("doc_id", judge_text(F.col("text")).alias("q"))
    figures = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judged.select("doc_id", *(f"q.{name}" for name in figures))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes in every order of them, by language."""
    steps = audit(flag_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))
    return steps.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def op12_top_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best other vectors of every fiftieth, by exact inner product."""
    return top_vectors(table(spark, sf_dir, "embeddings"), asks="vec_id % 50 = 0", k=5)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's 2000 strongest phrases of two to five words."""
    ranked = top_phrases(score(frequent_phrases(table(spark, sf_dir, "documents"))))
    return ranked.select(F.col("part").alias("lang"), F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


QUERIES = {"op1_warc": op1_warc, "op2_decontamination": op2_decontamination, "op3_main_text": op3_main_text, "op4_pieces": op4_pieces, "op5_licences": op5_licences, "op6_line_templates": op6_line_templates, "op7_shards": op7_shards, "op8_personal_data": op8_personal_data, "op9_similar": op9_similar, "op10_quality": op10_quality, "op11_filter_audit": op11_filter_audit, "op12_top_vectors": op12_top_vectors, "op13_collocations": op13_collocations}
SQL: dict[str, str] = {"op1_warc": OP1, "op2_decontamination": OP2, "op6_line_templates": OP6, "op11_filter_audit": OP11, "op12_top_vectors": OP12, "op13_collocations": OP13}
