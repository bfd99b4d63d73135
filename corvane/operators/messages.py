"""Raw JSON lines to messages, their authors and the authors' groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VALID = "valid"
INCOMPLETE = "incomplete"  # a message without user.id_str or text
NOT_A_MESSAGE = "not_a_message"  # readable, but without the key created_at
BROKEN = "broken"  # not one JSON value

NO_GROUP = 7
GROUPS = tuple(range(8))


def _extract(line: Column) -> Column:
    """One parse of a line: `struct<status, user_id, text>`.

    The parser takes single quotes and the like for errors but would stop
    reading after a complete value. So the line is parsed as the first element
    of an array whose second element is the line's own hash: it must be found
    right behind the line, which junk and extra values prevent. A key that is
    present with a null value differs from a missing one here.
    """
    mark = F.xxhash64(line)
    parsed = F.try_parse_json(F.concat(F.lit("["), line, F.lit(","), mark.cast("string"), F.lit("]")))

    def fields(v: Column) -> Column:
        whole = F.try_variant_get(v, "$[1]", "bigint") == mark
        has_key = F.variant_get(v, "$[0].created_at", "variant").isNotNull()
        user_id = F.try_variant_get(v, "$[0].user.id_str", "string")
        text = F.try_variant_get(v, "$[0].text", "string")
        status = (
            F.when(~F.coalesce(whole, F.lit(False)), F.lit(BROKEN))
            .when(~has_key, F.lit(NOT_A_MESSAGE))
            .when(user_id.isNull() | text.isNull(), F.lit(INCOMPLETE))
            .otherwise(F.lit(VALID))
        )
        return F.struct(status.alias("status"), user_id.alias("user_id"), text.alias("text"))

    return F.transform(F.array(parsed), fields)


def ingest(lines: DataFrame) -> DataFrame:
    """Every line with what it turned out to be: `value, status, user_id, text`.

    `inline` keeps later filters on `status` above the parse, so that a line
    is parsed once however the result is used.
    """
    if lines.sparkSession.conf.get("spark.sql.variant.allowDuplicateKeys") != "true":
        raise RuntimeError("repeated keys would make a line broken: call session.configure first")
    return lines.select("value", F.inline(_extract(F.col("value"))))


def valid_messages(ingested: DataFrame, strict: bool = False) -> DataFrame:
    """`user_id, text` of the valid messages.

    A message without author or text is left in the ingested table for
    inspection; with `strict` it fails the job.
    """
    if strict:
        checked = F.when(
            F.col("status") == INCOMPLETE,
            F.raise_error(F.concat(F.lit("message without user.id_str or text: "), F.col("value"))).cast("string"),
        ).otherwise(F.col("status"))
        ingested = ingested.withColumn("status", checked)
    return ingested.filter(F.col("status") == VALID).select("user_id", "text")


def quarantine(ingested: DataFrame) -> DataFrame:
    """The lines that are no usable message, each with the reason."""
    return ingested.filter(F.col("status") != VALID).select("status", "value")


def posts_per_user(messages: DataFrame) -> DataFrame:
    """`user_id, n_posts`; combined before the shuffle, so a busy author costs no more than others."""
    return messages.groupBy("user_id").agg(F.count("*").alias("n_posts"))


def count_users(messages: DataFrame) -> DataFrame:
    """One row, `n`: the exact number of distinct authors."""
    return messages.select("user_id").distinct().agg(F.count("*").alias("n"))


def with_group(rows: DataFrame, user_groups: DataFrame) -> DataFrame:
    """`rows` with the `group_id` of their user; users in no group get 7.

    `user_groups` names each user once.

    Spark broadcasts the group table while it is known to be under
    `spark.sql.autoBroadcastJoinThreshold`. A larger one is joined by shuffle,
    and a hot user's partition is split at run time (see `session`).
    """
    looked_up = rows.join(user_groups.select("user_id", "group_id"), "user_id", "left")
    return looked_up.withColumn("group_id", F.coalesce("group_id", F.lit(NO_GROUP)))


def group_lists(user_groups: DataFrame) -> DataFrame:
    """`user_id, group_id, groups`, one row per listed user: what `with_group` would join, held in one row.

    `groups` is null for a user listed once, and `group_id` says it all. A user
    listed more often has `groups`, `array<struct<group_id, n>>`, instead.
    """
    listed = (
        user_groups.filter(F.col("user_id").isNotNull())
        .groupBy("user_id", F.coalesce("group_id", F.lit(NO_GROUP)).alias("group_id"))
        .agg(F.count("*").alias("n"))
    )
    by_user = listed.groupBy("user_id").agg(
        F.sum("n").alias("n"), F.min("group_id").alias("group_id"), F.collect_set(F.struct("group_id", "n")).alias("groups")
    )
    once = F.col("n") == 1
    return by_user.select("user_id", F.when(once, F.col("group_id")).alias("group_id"), F.when(~once, F.sort_array("groups")).alias("groups"))


def group_posts(per_user: DataFrame, user_groups: DataFrame) -> DataFrame:
    """`group_id, n_posts` in group order, from `posts_per_user`. Only one row per author meets the group table."""
    return (
        with_group(per_user, user_groups)
        .groupBy("group_id")
        .agg(F.sum("n_posts").alias("n_posts"))
        .orderBy("group_id")
    )


def posts_per_group(messages: DataFrame, user_groups: DataFrame) -> DataFrame:
    return group_posts(posts_per_user(messages), user_groups)
