"""Registered queries on messages."""

from __future__ import annotations

from pyspark.sql import functions as F

from checkset.standins import (
    GROUPS_SQL,
    MESSAGES_SQL,
    POINTS_SQL,
    VALID_MESSAGES_SQL,
    message_lines,
    messages,
    point_lines,
    table,
    user_groups,
)
from corvane.functions import tokens as tk
from corvane.operators import mentions as mn
from corvane.operators import messages as ms
from corvane.operators.ordering import with_position
from checkset.spread import spread
from corvane.plans.message_report import message_report
from corvane.session import shared_folder
from corvane.sources import lines as ln
from corvane.sources.fetch import fetch
from corvane.sources.results import ResultStore, reused
from corvane.sources.tables import read_user_groups

MIN_USERS = 20
# Separates the tokens of a text in the shown results; no token holds it.
JOIN = "\u0001"


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _normalised(text: str) -> str:
    return f"""CASE WHEN regexp_matches(replace({text}, '&amp;', ' '), {_quoted(tk.NAMED_ENTITY)})
         THEN replace({text}, '&amp;', ' and ') ELSE {text} END"""


def _folded(token: str) -> str:
    return f"CASE WHEN regexp_matches({token}, {_quoted(tk.URL)}) THEN {token} ELSE lower({token}) END"


PAIRS_SQL = f"""
raw AS (SELECT user_id, unnest(regexp_extract_all({_normalised('text')}, {_quoted(tk.PLAIN_TOKEN)})) AS raw
        FROM messages),
pairs AS (SELECT DISTINCT user_id, {_folded('raw')} AS token FROM raw),
mentions AS (SELECT token, count(*) AS n_all FROM pairs GROUP BY token),
frequent AS (SELECT * FROM mentions WHERE n_all >= {MIN_USERS}),
counted AS (
  SELECT coalesce(group_id, 7) AS group_id, token, n_all, count(*) AS n_k
  FROM pairs JOIN frequent USING (token) LEFT JOIN user_groups USING (user_id) GROUP BY 1, 2, 3),
popular AS (SELECT *, log2(n_k / n_all) AS p FROM counted),
ranked AS (
  SELECT group_id, row_number() OVER (PARTITION BY group_id ORDER BY p DESC, token) AS rank, token, p FROM popular)"""
TOKENS_SQL = f"WITH {MESSAGES_SQL}, {GROUPS_SQL}, {PAIRS_SQL}"


def _pairs(spark, sf_dir):
    return mn.user_tokens(messages(spark, sf_dir))


def _grouped_pairs(spark, sf_dir):
    """The pairs with the groups of their users, which a row per message meets, not one per pair."""
    lists = _stored(spark, ms.group_lists(user_groups(spark, sf_dir)), "group_lists")
    return mn.user_tokens(messages(spark, sf_dir), group_lists=lists)


def _frequent_mentions(spark, sf_dir):
    """Mentions of frequent tokens by group, from stored pairs: texts are tokenised once."""
    pairs = _stored(spark, _grouped_pairs(spark, sf_dir), "pairs")
    counted = mn.group_mentions(pairs)
    return mn.frequent_pairs(counted, mn.frequent(mn.mentions(pairs), MIN_USERS))


def _stored(spark, df, label):
    return ResultStore(spark, shared_folder(spark, label)).write("table", df)


def s01_text_scan(spark, sf_dir):
    path = shared_folder(spark, "lines")
    point_lines(spark, sf_dir).write.text(path)
    return ln.read_lines(spark, path)


def s03_user_groups(spark, sf_dir):
    path = shared_folder(spark, "groups")
    user_groups(spark, sf_dir).write.parquet(path)
    return read_user_groups(spark, path)


def s06_line_count(spark, sf_dir):
    return ln.count_lines(message_lines(spark, sf_dir))


def s09_results_roundtrip(spark, sf_dir):
    posts = ms.posts_per_group(messages(spark, sf_dir), user_groups(spark, sf_dir))
    store = ResultStore(spark, shared_folder(spark, "results"))
    store.write("counts_per_part", posts)
    return store.read("counts_per_part")


def s07_reuse(spark, sf_dir):
    """Three results of lines that are parsed once, kept meanwhile and given up."""
    store = ResultStore(spark, shared_folder(spark, "reuse"))
    with reused(ms.ingest(message_lines(spark, sf_dir))) as ingested:
        counts = {
            "lines": ingested,
            "messages": ingested.filter(F.col("status") == ms.VALID),
            "users": ingested.filter(F.col("status") == ms.VALID).select("user_id").distinct(),
        }
        stored = [store.write(name, df.agg(F.lit(name).alias("result"), F.count("*").alias("n"))) for name, df in counts.items()]
    return stored[0].unionByName(stored[1]).unionByName(stored[2])


def s08_bounded_fetch(spark, sf_dir):
    """The groups, fetched under the bound that their number states, as a lookup that the posts are named by."""
    groups = fetch(user_groups(spark, sf_dir).select("group_id").distinct(), len(ms.GROUPS))
    names = F.create_map(*[part for r in groups for part in (F.lit(r["group_id"]), F.lit(f"group {r['group_id']}"))])
    posts = ms.posts_per_group(messages(spark, sf_dir), user_groups(spark, sf_dir))
    return posts.select(F.coalesce(F.try_element_at(names, F.col("group_id")), F.lit("no group")).alias("name"), "n_posts")


def t01_ingest(spark, sf_dir):
    ingested = ms.ingest(message_lines(spark, sf_dir))
    shown = [F.coalesce(c, F.lit("")).alias(c) for c in ("user_id", "text")]
    return ingested.select("status", *shown)


def t02_valid(spark, sf_dir):
    ingested = ms.ingest(message_lines(spark, sf_dir))
    return ingested.groupBy("status").agg(F.count("*").alias("n"))


def t03_user_text(spark, sf_dir):
    return ms.valid_messages(ms.ingest(message_lines(spark, sf_dir)))


def t04_distinct_users(spark, sf_dir):
    return ms.count_users(messages(spark, sf_dir))


def t05_user_group(spark, sf_dir):
    authors = table(spark, sf_dir, "documents").select(
        "doc_id", F.expr("CAST(doc_id DIV 7 AS STRING)").alias("user_id")
    )
    return ms.with_group(authors, user_groups(spark, sf_dir)).select("doc_id", "user_id", "group_id")


def t06_posts_per_group(spark, sf_dir):
    posts = ms.posts_per_group(messages(spark, sf_dir), user_groups(spark, sf_dir))
    return with_position(posts, ["group_id"], ResultStore(spark, shared_folder(spark, "ordered")), "posts")


def t07_entities(spark, sf_dir):
    pages = spread(table(spark, sf_dir, "pages").select("page_id", "html"))
    return pages.select("page_id", tk.normalise_entities(F.col("html")).alias("html"))


def t07_decoded(spark, sf_dir):
    """Entities turned into characters; some names are spelled as numbers first, so that both kinds occur."""
    pages = spread(table(spark, sf_dir, "pages").select("page_id", "html"))
    html = F.replace(F.replace("html", F.lit("&quot;"), F.lit("&#34;")), F.lit("&middot;"), F.lit("&#183;&#xyz;&nosuch;"))
    return pages.select("page_id", tk.normalise_entities(html, decode=True).alias("html"))


def t09_emoticons(spark, sf_dir):
    """All tokens but emoticons folded; some full stops become emoticons first."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    text = F.replace("text", F.lit(". "), F.lit(" :D XD 8-P http://A.b/C "))
    return mn.message_tokens(docs.select("doc_id", text.alias("text")), keep_case="emoticon").select("doc_id", F.array_join("tokens", JOIN).alias("tokens"))


def t08_tokens(spark, sf_dir):
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    raw = docs.select("doc_id", tk.raw_tokens(F.col("text")).alias("t"))
    return raw.select("doc_id", F.size("t").cast("bigint").alias("n_tokens"), F.array_join("t", JOIN).alias("tokens"))


def t09_fold(spark, sf_dir):
    pages = spread(table(spark, sf_dir, "pages").select("page_id", F.col("html").alias("text")))
    return mn.message_tokens(pages).select("page_id", F.array_join("tokens", JOIN).alias("tokens"))


def t10_user_tokens(spark, sf_dir):
    return _pairs(spark, sf_dir)


def t11_mentions(spark, sf_dir):
    return mn.mentions(_pairs(spark, sf_dir))


def t12_n_tokens(spark, sf_dir):
    return mn.count_tokens(mn.mentions(_pairs(spark, sf_dir)))


def t13_frequent(spark, sf_dir):
    return mn.frequent(mn.mentions(_pairs(spark, sf_dir)), MIN_USERS)


def t14_top20(spark, sf_dir):
    return mn.top_tokens(t13_frequent(spark, sf_dir))


def t15_frequent_user_tokens(spark, sf_dir):
    # The pairs feed both sides of the join: stored, so that texts are tokenised once.
    pairs = _stored(spark, _pairs(spark, sf_dir), "pairs")
    return mn.frequent_pairs(pairs, mn.frequent(mn.mentions(pairs), MIN_USERS)).select("user_id", "token", "n_all")


def t16_group_mentions(spark, sf_dir):
    # Stored, as the few users with several groups are counted in a second read.
    return mn.group_mentions(_stored(spark, _grouped_pairs(spark, sf_dir), "pairs"))


def t17_popularity(spark, sf_dir):
    popular = mn.popularity(_frequent_mentions(spark, sf_dir))
    return popular.withColumn("rel_popularity", F.round("rel_popularity", 6))


def t18_top10_per_group(spark, sf_dir):
    popular = mn.popularity(_frequent_mentions(spark, sf_dir))
    top = mn.top_per_group(popular)
    return top.withColumn("rel_popularity", F.round("rel_popularity", 6)).withColumn(
        "rank", F.col("rank").cast("bigint")
    )


def t19_report(spark, sf_dir):
    store = ResultStore(spark, shared_folder(spark, "report"))
    results = message_report(message_lines(spark, sf_dir), user_groups(spark, sf_dir), store, MIN_USERS)
    shown = [
        results[name].select(F.lit(name).alias("result"), F.lit("").alias("item"), F.col("n").cast("double").alias("value"))
        for name in ("num_tweets", "num_unique_users", "num_of_tokens", "num_freq_tokens")
    ]
    for name, item, value in (
        ("counts_per_part", ["group_id"], "n_posts"),
        ("top20", ["token"], "n_all"),
        ("popular_10_in_each_group", ["group_id", "rank", "token"], "rel_popularity"),
    ):
        shown.append(
            results[name].select(
                F.lit(name).alias("result"),
                F.concat_ws(" ", *item).alias("item"),
                F.round(F.col(value).cast("double"), 6).alias("value"),
            )
        )
    union = shown[0]
    for df in shown[1:]:
        union = union.unionByName(df)
    return union


QUERIES = {
    f.__name__: f
    for f in (
        s01_text_scan,
        s03_user_groups,
        s06_line_count,
        s07_reuse,
        s08_bounded_fetch,
        s09_results_roundtrip,
        t01_ingest,
        t02_valid,
        t03_user_text,
        t04_distinct_users,
        t05_user_group,
        t06_posts_per_group,
        t07_entities,
        t07_decoded,
        t08_tokens,
        t09_fold,
        t09_emoticons,
        t10_user_tokens,
        t11_mentions,
        t12_n_tokens,
        t13_frequent,
        t14_top20,
        t15_frequent_user_tokens,
        t16_group_mentions,
        t17_popularity,
        t18_top10_per_group,
        t19_report,
    )
}

POSTS_SQL = """
SELECT coalesce(group_id, 7) AS group_id, count(*) AS n_posts
FROM messages LEFT JOIN user_groups USING (user_id) GROUP BY 1 ORDER BY 1"""
STATUS_SQL = """
CASE source WHEN 'src0' THEN 'not_a_message' WHEN 'src1' THEN 'broken' WHEN 'src3' THEN 'incomplete'
            WHEN 'src4' THEN 'broken' ELSE 'valid' END"""

SQL = {
    "s01_text_scan": f"WITH {POINTS_SQL} SELECT x || ' ' || y AS value FROM points",
    "s03_user_groups": f"WITH {GROUPS_SQL} SELECT user_id, group_id FROM user_groups",
    "s06_line_count": "SELECT count(*) AS n FROM documents",
    "s09_results_roundtrip": f"WITH {MESSAGES_SQL}, {GROUPS_SQL} {POSTS_SQL}",
    "s07_reuse": f"""WITH {VALID_MESSAGES_SQL}
SELECT 'lines' AS result, count(*) AS n FROM documents UNION ALL SELECT 'messages', count(*) FROM messages
UNION ALL SELECT 'users', count(DISTINCT user_id) FROM messages""",
    "s08_bounded_fetch": f"""WITH {MESSAGES_SQL}, {GROUPS_SQL}
SELECT CASE WHEN group_id = 7 THEN 'no group' ELSE 'group ' || group_id END AS name, n_posts FROM ({POSTS_SQL})""",
    "t01_ingest": f"""
SELECT {STATUS_SQL} AS status,
       CASE WHEN source IN ('src0', 'src1', 'src3', 'src4') THEN '' ELSE CAST(doc_id // 7 AS VARCHAR) END AS user_id,
       CASE WHEN source IN ('src0', 'src1', 'src4') THEN '' ELSE text END AS text
FROM documents""",
    "t02_valid": f"SELECT {STATUS_SQL} AS status, count(*) AS n FROM documents GROUP BY 1",
    "t03_user_text": f"WITH {VALID_MESSAGES_SQL} SELECT user_id, text FROM messages",
    "t04_distinct_users": f"WITH {MESSAGES_SQL} SELECT count(DISTINCT user_id) AS n FROM messages",
    "t05_user_group": f"""WITH {GROUPS_SQL}
SELECT doc_id, CAST(doc_id // 7 AS VARCHAR) AS user_id, coalesce(group_id, 7) AS group_id
FROM documents LEFT JOIN user_groups ON user_id = CAST(doc_id // 7 AS VARCHAR)""",
    "t06_posts_per_group": f"WITH {MESSAGES_SQL}, {GROUPS_SQL} SELECT *, row_number() OVER (ORDER BY group_id) AS position FROM ({POSTS_SQL})",
    "t07_entities": f"SELECT page_id, {_normalised('html')} AS html FROM pages",
    "t07_decoded": r"""
WITH spelled AS (SELECT page_id, replace(replace(html, '&quot;', '&#34;'), '&middot;', '&#183;&#xyz;&nosuch;') AS h FROM pages),
chars AS (SELECT page_id, h, replace(replace(replace(h, '&#34;', '"'), '&#183;', '·'), '&copy;', '©') AS d FROM spelled)
SELECT page_id, CASE WHEN regexp_matches(replace(h, '&amp;', ' '), '&[a-zA-Z0-9]+;') THEN replace(d, '&amp;', ' and ') ELSE d END AS html FROM chars""",
    "t09_emoticons": rf"""
WITH raw AS (SELECT doc_id, regexp_extract_all({_normalised("replace(text, '. ', ' :D XD 8-P http://A.b/C ')")}, {_quoted(tk.PLAIN_TOKEN)}) AS t FROM documents)
SELECT doc_id, array_to_string(list_transform(t, lambda x: CASE WHEN regexp_matches(x,
    '[<>]?[:;=8][-oO*'']?[)\]([dDpP/:}}{{@|\\]|[)\]([dDpP/:}}{{@|\\][-oO*'']?[:;=8][<>]?') THEN x ELSE lower(x) END), '{JOIN}') AS tokens FROM raw""",
    "t08_tokens": f"""
WITH raw AS (SELECT doc_id, regexp_extract_all({_normalised('text')}, {_quoted(tk.PLAIN_TOKEN)}) AS t FROM documents)
SELECT doc_id, len(t) AS n_tokens, array_to_string(t, '{JOIN}') AS tokens FROM raw""",
    "t09_fold": f"""
WITH raw AS (SELECT page_id, regexp_extract_all({_normalised('html')}, {_quoted(tk.PLAIN_TOKEN)}) AS t FROM pages)
SELECT page_id, array_to_string(list_transform(t, lambda x: {_folded('x')}), '{JOIN}') AS tokens FROM raw""",
    "t10_user_tokens": f"{TOKENS_SQL} SELECT user_id, token FROM pairs",
    "t11_mentions": f"{TOKENS_SQL} SELECT token, n_all FROM mentions",
    "t12_n_tokens": f"{TOKENS_SQL} SELECT count(*) AS n FROM mentions",
    "t13_frequent": f"{TOKENS_SQL} SELECT token, n_all FROM frequent",
    "t14_top20": f"{TOKENS_SQL} SELECT token, n_all FROM frequent ORDER BY n_all DESC, token LIMIT 20",
    "t15_frequent_user_tokens": f"{TOKENS_SQL} SELECT user_id, token, n_all FROM pairs JOIN frequent USING (token)",
    "t16_group_mentions": f"""{TOKENS_SQL}
SELECT coalesce(group_id, 7) AS group_id, token, count(*) AS n_k
FROM pairs LEFT JOIN user_groups USING (user_id) GROUP BY 1, 2""",
    "t17_popularity": f"{TOKENS_SQL} SELECT group_id, token, n_k, n_all, round(p, 6) AS rel_popularity FROM popular",
    "t18_top10_per_group": f"""{TOKENS_SQL}
SELECT group_id, rank, token, round(p, 6) AS rel_popularity FROM ranked WHERE rank <= 10""",
    "t19_report": f"""WITH {VALID_MESSAGES_SQL}, {GROUPS_SQL}, {PAIRS_SQL}, posts AS ({POSTS_SQL})
SELECT 'num_tweets' AS result, '' AS item, CAST(count(*) AS DOUBLE) AS value FROM documents
UNION ALL SELECT 'num_unique_users', '', count(DISTINCT user_id) FROM messages
UNION ALL SELECT 'num_of_tokens', '', count(*) FROM mentions
UNION ALL SELECT 'num_freq_tokens', '', count(*) FROM frequent
UNION ALL SELECT 'counts_per_part', CAST(group_id AS VARCHAR), n_posts FROM posts
UNION ALL SELECT 'top20', token, n_all FROM (SELECT * FROM frequent ORDER BY n_all DESC, token LIMIT 20)
UNION ALL SELECT 'popular_10_in_each_group', group_id || ' ' || rank || ' ' || token, round(p, 6)
          FROM ranked WHERE rank <= 10""",
}
