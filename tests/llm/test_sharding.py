import zlib
from collections import Counter, defaultdict

from corvane.llm.sharding import assign_shards, longest_first


def test_longest_first_by_hand():
    placed = longest_first([("a", 7), ("b", 6), ("c", 5), ("d", 4), ("e", 4), ("f", 2)], 3)
    assert placed == {"a": 0, "b": 1, "c": 2, "d": 2, "e": 1, "f": 0}


def check(spark, rows, shards):
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, shard int")
    out = assign_shards(df, shards).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in out) == Counter(
        (i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows
    )
    texts, where = dict(rows), defaultdict(set)
    for r in out:
        where[texts[r.doc_id] or ""].add(r.shard)
    assert all(len(s) == 1 for s in where.values())
    slots = defaultdict(list)
    loads = Counter({s: 0 for s in range(shards)})
    for r in out:
        slots[r.shard].append(r.slot)
        loads[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) <= set(range(shards))
    return loads


def test_even_loads(spark):
    loads = check(spark, [(i, "word " * (i % 50)) if i % 7 else (i, "x" * i) for i in range(3000)], 4)
    assert max(loads.values()) - min(loads.values()) < 0.02 * sum(loads.values())


def test_hot_group_stays_together(spark):
    loads = check(spark, [(i, "hot text " * 20) for i in range(1000)] + [(i, f"text {i} " * 10) for i in range(1000, 3000)], 8)
    rest = sorted(loads.values())[:-1]
    assert rest[-1] - rest[0] < 0.05 * sum(rest)


def test_null_empty_repeated_and_tied(spark):
    check(spark, [(None, None), (None, None), (1, None), (2, ""), (3, "same"), (3, "same"), (4, "same"), (5, "a" * 100_000)], 3)


def test_empty_table(spark):
    assert check(spark, [], 3) == {0: 0, 1: 0, 2: 0}
