import re
import collections
import math
import random

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from corvane import schemas
from corvane.operators import mentions as mn
from corvane.operators import messages as ms
from corvane.plans.message_report import RESULTS, message_report
from corvane.sources.lines import lines_from, rows_to_frame
from corvane.sources.results import ResultStore

WORDS = ["the", "Cat", "dog", "RT", "to", "of", "and", "sun", "http://A.b/C", ":D"]
FOLDED = {w: w if w.startswith("http") else w.lower() for w in WORDS}


def corpus(seed=3, users=40, posts=300):
    """Posts of which a third are by one user, and that user's all hold one token."""
    rng = random.Random(seed)
    out = []
    for i in range(posts):
        hot = i % 3 == 0
        words = rng.choices(WORDS, k=rng.randint(1, 6)) + (["hot"] if hot else [])
        out.append(("u0" if hot else f"u{rng.randint(1, users)}", words))
    return out


GROUP_OF = {f"u{i}": i % 7 for i in range(30)}


def brute_force(posts, min_users):
    users = collections.defaultdict(set)
    for user, words in posts:
        for w in words:
            users[FOLDED.get(w, w)].add(user)
    n_all = {t: len(u) for t, u in users.items()}
    frequent = {t: n for t, n in n_all.items() if n >= min_users}
    ranked = collections.defaultdict(list)
    for t, n in frequent.items():
        per_group = collections.Counter(GROUP_OF.get(u, 7) for u in users[t])
        for g, k in per_group.items():
            ranked[g].append((math.log(k / n) / math.log(2), t))
    top = {g: sorted(rows, key=lambda r: (-r[0], r[1]))[:10] for g, rows in ranked.items()}
    return users, n_all, frequent, top


@pytest.fixture
def posts():
    return corpus()


@pytest.fixture
def frames(spark, posts):
    messages = rows_to_frame(spark, [(u, " ".join(w)) for u, w in posts], schemas.MESSAGES)
    groups = rows_to_frame(spark, list(GROUP_OF.items()), schemas.USER_GROUPS)
    return messages, groups


def test_counts_match_brute_force(frames, posts):
    messages, _ = frames
    users, n_all, frequent, _ = brute_force(posts, 20)
    pairs = mn.user_tokens(messages)
    assert {tuple(r) for r in pairs.collect()} == {(u, t) for t, us in users.items() for u in us}
    table = mn.mentions(pairs)
    assert {r["token"]: r["n_all"] for r in table.collect()} == n_all
    assert mn.count_tokens(table).first()["n"] == len(n_all)
    assert {r["token"]: r["n_all"] for r in mn.frequent(table, 20).collect()} == frequent


def test_threshold_is_inclusive_and_ties_are_in_token_order(spark):
    rows = [("of", 149), ("for", 149), ("he", 100), ("no", 99), ("B", 149)]
    table = spark.createDataFrame(rows, "token string, n_all bigint")
    top = mn.top_tokens(mn.frequent(table, 100)).collect()
    assert [tuple(r) for r in top] == [("B", 149), ("for", 149), ("of", 149), ("he", 100)]


def test_group_mentions_match_brute_force(frames, posts):
    messages, groups = frames
    users, n_all, frequent, _ = brute_force(posts, 20)
    pairs = mn.user_tokens(messages)
    want = collections.Counter((GROUP_OF.get(u, 7), t) for t, us in users.items() for u in us)
    assert {(r["group_id"], r["token"]): r["n_k"] for r in mn.group_mentions(pairs, groups).collect()} == want
    kept = mn.frequent_pairs(pairs, mn.frequent(mn.mentions(pairs), 20))
    counted = {(r["group_id"], r["token"]): (r["n_k"], r["n_all"]) for r in mn.group_mentions(kept, groups).collect()}
    assert counted == {(g, t): (n, n_all[t]) for (g, t), n in want.items() if t in frequent}


def test_popularity_of_a_token_sums_to_one(frames):
    messages, groups = frames
    pairs = mn.user_tokens(messages)
    popular = mn.popularity(mn.group_mentions(mn.frequent_pairs(pairs, mn.mentions(pairs)), groups))
    sums = popular.groupBy("token").agg(F.sum(F.pow(F.lit(2.0), "rel_popularity")).alias("s")).collect()
    assert sums and all(abs(r["s"] - 1) < 1e-12 for r in sums)


@pytest.mark.parametrize(
    "n_k, n_all, expected",
    [(22, 132, -2.584962500721156), (7, 132, -4.23703919730085), (24, 149, -2.6342060197410055), (98, 284, -1.5350372753894739)],
)
def test_popularity_values(spark, n_k, n_all, expected):
    rows = [(3, "t", n_k, n_all), (4, "t", 0, n_all)]
    rows = mn.popularity(spark.createDataFrame(rows, "group_id int, token string, n_k bigint, n_all bigint")).collect()
    assert len(rows) == 1 and abs(rows[0]["rel_popularity"] - expected) < 1e-12


def test_top_per_group_ties(spark):
    ranked = spark.createDataFrame(
        [(1, "b", -1.0), (1, "a", -1.0), (1, "c", -0.5), (2, "z", -3.0)], "group_id int, token string, rel_popularity double"
    )
    top = mn.top_per_group(ranked, k=2).collect()
    assert sorted((r["group_id"], r["rank"], r["token"]) for r in top) == [(1, 1, "c"), (1, 2, "a"), (2, 1, "z")]


def test_whole_report(spark, posts, tmp_path, frames):
    import json

    lines = [json.dumps({"created_at": "x", "user": {"id_str": u}, "text": " ".join(w)}) for u, w in posts]
    lines += ["{", '{"limit":1}']
    store = ResultStore(spark, str(tmp_path / "out"))
    results = message_report(lines_from(spark, lines), frames[1], store, min_users=20)
    assert tuple(results) == RESULTS
    users, n_all, frequent, top = brute_force(posts, 20)

    def single(name):
        return store.read(name).first()["n"]

    assert single("num_tweets") == len(lines)
    assert single("num_unique_users") == len({u for u, _ in posts})
    assert single("num_of_tokens") == len(n_all)
    assert single("num_freq_tokens") == len(frequent)
    per_group = collections.Counter(GROUP_OF.get(u, 7) for u, _ in posts)
    assert {r["group_id"]: r["n_posts"] for r in store.read("counts_per_part").collect()} == per_group
    assert sorted(-r["n_all"] for r in store.read("top20").collect()) == sorted(-n for n in frequent.values())[:20]
    found = collections.defaultdict(list)
    for r in store.read("popular_10_in_each_group").orderBy("group_id", "rank").collect():
        found[r["group_id"]].append((r["rel_popularity"], r["token"]))
    assert found.keys() == top.keys()
    for g in top:
        assert [t for _, t in found[g]] == [t for _, t in top[g]]
        assert all(abs(a - b) < 1e-12 for (a, _), (b, _) in zip(found[g], top[g]))


def test_texts_stay_out_of_the_shuffles(frames, spark, tmp_path, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    messages, groups = frames
    paths = [str(tmp_path / n) for n in ("m", "g")]
    for df, path in zip((messages, groups), paths):
        df.write.parquet(path)
    messages, groups = (spark.read.parquet(p) for p in paths)
    pairs = mn.user_tokens(messages)
    frequent = mn.frequent(mn.mentions(pairs), 20)
    top = mn.top_per_group(mn.popularity(mn.group_mentions(mn.frequent_pairs(pairs, frequent), groups)))
    plan = plan_of(top)
    assert "Python" not in plan and "Arrow" not in plan and "Broadcast" not in plan
    formatted = spark._jvm.PythonSQLUtils.explainString(top._jdf.queryExecution(), "formatted")
    shuffled = re.findall(r"\) Exchange\nInput \[\d+\]: \[([^\]]*)\]", formatted)
    assert len(shuffled) >= 5 and not any("text" in columns or "raw" in columns for columns in shuffled)
    assert plan.count("WindowGroupLimit") == 2
    assert "TakeOrderedAndProject" in plan_of(mn.top_tokens(frequent))


def test_groups_are_counted_before_pairs_meet_the_frequent_tokens(frames, posts, spark, tmp_path, settings):
    """Counting first gives the counts of the frequent pairs, and shuffles pairs by user or not at all, never by token."""
    messages, groups = frames
    twice = groups.unionByName(groups.where("user_id = 'u0'"))
    pairs = mn.user_tokens(messages)
    frequent = mn.frequent(mn.mentions(pairs), 20)
    columns = ["group_id", "token", "n_k", "n_all"]
    first = mn.frequent_pairs(mn.group_mentions(pairs, twice), frequent).select(columns)
    last = mn.group_mentions(mn.frequent_pairs(pairs, frequent), twice).select(columns)
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, last.collect()))


@pytest.mark.parametrize("job", ["query", "report"])
def test_no_pair_is_shuffled_by_token(spark, tmp_path, settings, monkeypatch, frames, posts, job):
    import json

    from checkset import message_queries as mq

    settings(spark__sql__adaptive__enabled="false")
    seen = []
    joined = mn.frequent_pairs
    monkeypatch.setattr(mn, "frequent_pairs", lambda rows, frequent: seen.append(rows.columns) or joined(rows, frequent))
    if job == "query":
        monkeypatch.setattr(mq, "messages", lambda *_: frames[0])
        monkeypatch.setattr(mq, "user_groups", lambda *_: frames[1])
        mq.t17_popularity(spark, "").collect()
    else:
        lines = [json.dumps({"created_at": "x", "user": {"id_str": u}, "text": " ".join(w)}) for u, w in posts]
        message_report(lines_from(spark, lines), frames[1], ResultStore(spark, str(tmp_path / "out")), min_users=20)
    assert seen and all("user_id" not in columns for columns in seen)


def listed_often(spark, tmp_path):
    """Users listed twice in one group, in two groups, without a group or a name; stored, as the jobs do."""
    rows = [*GROUP_OF.items(), ("u1", 1), ("u2", 2), ("u2", 2), ("u2", 5), ("u3", None), (None, 4), (None, 4), ("u39", None)]
    groups = spark.createDataFrame(rows, "user_id string, group_id int")
    return groups, ResultStore(spark, str(tmp_path / "store")).write("lists", ms.group_lists(groups))


def test_pairs_with_groups_give_the_counts_of_the_lookup(frames, spark, tmp_path):
    """One row per user, token and all the user's groups: each counts as often as a lookup of the pairs would find it."""
    groups, lists = listed_often(spark, tmp_path)
    messages = frames[0].unionByName(spark.createDataFrame([(None, "sun sun"), ("u2", ""), ("u2", None)], "user_id string, text string"))
    plain, grouped = mn.user_tokens(messages), mn.user_tokens(messages, group_lists=lists)
    assert sorted(map(str, grouped.select("user_id", "token").collect())) == sorted(map(str, plain.collect()))
    for some, same in ((plain, grouped), [mn.frequent_pairs(p, mn.mentions(plain)) for p in (plain, grouped)]):
        want = mn.group_mentions(some, groups)
        found = mn.group_mentions(same)
        assert found.columns == want.columns and found.dtypes == want.dtypes
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))


def shuffled_columns(spark, df):
    formatted = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return re.findall(r"\) Exchange\nInput \[\d+\]: \[([^\]]*)\]", formatted)


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_report_shuffles_a_row_per_message_and_no_pairs(frames, posts, spark, tmp_path, settings, monkeypatch, threshold):
    """With group tables of any size, pairs are formed behind the one shuffle by user, and only counts are shuffled then."""
    import json

    settings(spark__sql__autoBroadcastJoinThreshold=threshold)
    written = {}
    write = ResultStore.write
    monkeypatch.setattr(ResultStore, "write", lambda self, name, df, **more: written.setdefault(name, df) and write(self, name, df, **more))
    lines = [json.dumps({"created_at": "x", "user": {"id_str": u}, "text": " ".join(w)}) for u, w in posts]
    message_report(lines_from(spark, lines), frames[1], ResultStore(spark, str(tmp_path / "out")), min_users=20)
    pairs = shuffled_columns(spark, written["pairs"])
    assert pairs and not any("token" in columns or "text" in columns for columns in pairs)
    assert plan_of(written["pairs"]).count("regexp_extract_all") == 1
    later = shuffled_columns(spark, written["popular_10_in_each_group"])
    assert later and not any("user_id" in columns for columns in later)


def test_a_busy_users_messages_are_split(frames, spark, tmp_path, settings):
    messages, groups = frames
    messages.repartition(8).write.parquet(str(tmp_path / "m"))
    settings(
        spark__sql__files__openCostInBytes="1",
        spark__sql__files__maxPartitionBytes="4k",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="1k",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="1k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.2",
    )
    lists = ResultStore(spark, str(tmp_path / "store")).write("lists", ms.group_lists(groups))
    pairs = mn.user_tokens(spark.read.parquet(str(tmp_path / "m")), group_lists=lists)
    assert sorted(map(tuple, pairs.select("user_id", "token").collect())) == sorted(map(tuple, mn.user_tokens(messages).collect()))
    pairs.collect()
    assert "skew=true" in plan_of(pairs)


def test_only_users_with_several_groups_are_read_twice(frames, spark, tmp_path):
    """The second read asks for a null group, which the statistics of stored pairs answer; a list has none."""
    lists = ResultStore(spark, str(tmp_path / "store")).write("lists", ms.group_lists(frames[1]))
    pairs = ResultStore(spark, str(tmp_path / "store")).write("pairs", mn.user_tokens(frames[0], group_lists=lists))
    assert "IsNull(group_id)" in plan_of(mn.group_mentions(pairs))
