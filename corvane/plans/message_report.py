"""The seven results on a corpus of raw message lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.operators import mentions as mn
from corvane.operators import messages as ms
from corvane.sources.results import ResultStore

RESULTS = (
    "num_tweets",
    "num_unique_users",
    "counts_per_part",
    "num_of_tokens",
    "num_freq_tokens",
    "top20",
    "popular_10_in_each_group",
)


def message_report(
    lines: DataFrame,
    user_groups: DataFrame,
    store: ResultStore,
    min_users: int = mn.MIN_USERS,
    strict: bool = False,
) -> dict[str, DataFrame]:
    """Run the whole job and return the stored result tables by name.

    Five tables are written on the way: the ingested lines, in a folder per
    status, one row per author, one per grouped user, one per author and token, and one per token. Every
    result is then read from those, so lines are parsed once, and messages
    tokenised once; losing an executor later recomputes neither.
    """
    ingested = ms.ingest(lines).withColumn("value", F.when(F.col("status") != ms.VALID, F.col("value")))
    ingested = store.write("ingested", ingested, partition_by="status")
    messages = ms.valid_messages(ingested, strict)

    users = store.write("users", ms.posts_per_user(messages))
    group_lists = store.write("group_lists", ms.group_lists(user_groups))
    pairs = store.write("pairs", mn.user_tokens(messages, group_lists=group_lists))
    tokens = store.write("tokens", mn.mentions(pairs))
    frequent = mn.frequent(tokens, min_users)
    by_group = mn.frequent_pairs(mn.group_mentions(pairs), frequent)

    results = {
        "num_tweets": ingested.agg(F.count("*").alias("n")),
        "num_unique_users": users.agg(F.count("*").alias("n")),
        "counts_per_part": ms.group_posts(users, user_groups),
        "num_of_tokens": mn.count_tokens(tokens),
        "num_freq_tokens": mn.count_tokens(frequent),
        "top20": mn.top_tokens(frequent),
        "popular_10_in_each_group": mn.top_per_group(mn.popularity(by_group)),
    }
    return {name: store.write(name, df) for name, df in results.items()}
