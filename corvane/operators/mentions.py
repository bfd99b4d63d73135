"""Mentions: the number of distinct users who ever used a token, overall and per group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvane.functions import tokens as tk
from corvane.operators.messages import NO_GROUP, with_group

MIN_USERS = 100


def message_tokens(messages: DataFrame, **grammar) -> DataFrame:
    """`messages` plus `tokens array<string>`, in text order, case folded."""
    return messages.withColumn("tokens", tk.tokens(F.col("text"), **grammar))


def user_tokens(
    messages: DataFrame, keep_case: str = "url", decode_entities: bool = False, group_lists: DataFrame | None = None
) -> DataFrame:
    """The distinct (user, token) pairs, with their user's `group_id` and `groups` if `group_lists` are given.

    The text's different raw tokens are exploded and folded row by row, which stays
    in generated code; `distinct` drops repeats within each task before the one
    shuffle, whose key holds the token, so no user and no token is a hot key.

    With groups, a row per message meets the group table, not one per pair, and
    holds the message's different tokens. That join deals messages out by user,
    so pairs are formed and made distinct where they are, without a shuffle of
    their own; only where a busy user's partition was split (see `session`)
    they get one as above. The join is a merge join at any size, as its
    shuffle costs less than the one that it saves. A `group_lists` read from a
    table lets Spark split; straight from an aggregation, it would not.
    """
    raw = F.array_distinct(tk.raw_tokens(F.col("text"), decode_entities)).alias("raw")
    said = messages.select("user_id", raw)
    groups = []
    if group_lists is not None:
        groups = ["group_id", "groups"]
        said = said.join(group_lists.select("user_id", *groups).hint("merge"), "user_id", "left")
        listed_once = F.when(F.col("groups").isNull(), F.coalesce("group_id", F.lit(NO_GROUP)))
        said = said.withColumn("group_id", listed_once)
    # `explode` would have the optimiser filter on the array's size, below the join and by tokenising the text once more.
    return (
        said.select("user_id", *groups, F.explode_outer("raw").alias("raw"))
        .filter(F.col("raw").isNotNull())
        .select("user_id", *groups, tk.fold_case(F.col("raw"), keep_case).alias("token"))
        .distinct()
    )


def mentions(pairs: DataFrame) -> DataFrame:
    """`token, n_all`: users per token."""
    return pairs.groupBy("token").agg(F.count("*").alias("n_all"))


def count_tokens(token_table: DataFrame) -> DataFrame:
    """One row, `n`: how many tokens the table lists."""
    return token_table.agg(F.count("*").alias("n"))


def frequent(token_table: DataFrame, min_users: int = MIN_USERS) -> DataFrame:
    """Tokens used by at least `min_users` users."""
    return token_table.filter(F.col("n_all") >= min_users)


def top_tokens(frequent_tokens: DataFrame, k: int = 20) -> DataFrame:
    """The `k` most mentioned; equal counts in token order."""
    return frequent_tokens.select("token", "n_all").orderBy(F.desc("n_all"), "token").limit(k)


def frequent_pairs(pairs: DataFrame, frequent_tokens: DataFrame) -> DataFrame:
    """The (user, token) pairs, or the `group_mentions` of all pairs, whose token is frequent, with its `n_all`."""
    return pairs.join(frequent_tokens.select("token", "n_all"), "token")


def group_mentions(pairs: DataFrame, user_groups: DataFrame | None = None) -> DataFrame:
    """`group_id, token, n_k`, and `n_all` if the pairs carry it: users of the group who used the token.

    Pairs that carry their groups (`user_tokens` with `group_lists`) are counted
    as they are, combined in each task. Others meet their user's group here: what is
    looked up, and shuffled if the groups are many, are users and tokens, no texts.
    Counted first and restricted to frequent tokens then, pairs are joined by user
    only; restricted first, they would be shuffled by token, too.
    """
    key = ["group_id", "token", *(c for c in ("n_all",) if c in pairs.columns)]
    if user_groups is not None:
        return with_group(pairs, user_groups).groupBy(*key).agg(F.count("*").alias("n_k"))
    # `group_id` is null where `groups` is not. That is rare, and a stored table's statistics tell where: the rest is not read twice.
    once = pairs.filter(F.col("group_id").isNotNull()).select(*key, F.lit(1).cast("bigint").alias("n"))
    often = pairs.filter(F.col("group_id").isNull()).select(*key[1:], F.inline("groups")).select(*key, "n")
    return once.unionByName(often).groupBy(*key).agg(F.sum("n").alias("n_k"))


def popularity(counted: DataFrame) -> DataFrame:
    """`group_id, token, n_k, n_all, rel_popularity` from `group_mentions` with `n_all`.

    rel_popularity = log2(n_k / n_all). A group that never used a token has
    no row, as its value would be minus infinity.
    """
    value = F.log2(F.col("n_k") / F.col("n_all")).alias("rel_popularity")
    return counted.filter("n_k > 0").select("group_id", "token", "n_k", "n_all", value)


def top_per_group(ranked: DataFrame, k: int = 10) -> DataFrame:
    """The `k` relatively most popular tokens of each group: `group_id, rank, token, rel_popularity`."""
    order = Window.partitionBy("group_id").orderBy(F.desc("rel_popularity"), "token")
    return (
        ranked.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("group_id", "rank", "token", "rel_popularity")
    )
