import random

import pytest

from corvane.llm.components import smallest_label
from corvane.llm.similar import similar_groups


def brute(rows, n, percent):
    def grams(text):
        w = [x for x in (text or "").encode().lower().split()]
        return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()

    sets = [grams(t) for _, t in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                group[root(i)] = root(j)
    names = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            names[root(i)] = min(d, names.get(root(i), d))
    return sorted(((d, len(s), names.get(root(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


def mutated(rng, words, share):
    return " ".join(rng.choice("abcdefgh") * 3 + str(rng.randrange(99)) if rng.random() < share else w for w in words)


def corpus(seed=1):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choices(words, k=30))
    rows = []
    for _ in range(60):
        base = rng.choices(words, k=rng.randrange(5, 120))
        rows.append(" ".join(base))
        for _ in range(rng.randrange(4)):
            rows.append(mutated(rng, base, rng.choice([0.01, 0.03, 0.05])))
        if rng.random() < 0.3:
            rows.append(" ".join(base) + " " + passage)
        if rng.random() < 0.3:
            rows.append("  " + "\n".join(base).upper() + "\t")
    hot = rng.choices(words, k=80)
    rows += [mutated(rng, hot, 0.02) for _ in range(60)] + [" ".join(hot)] * 30
    rows += [None, "", " \n\t", None, "one", "ONE", "one two three", "One  two three", "a b c d", "x " * 3000, "é É", "É é"]
    rng.shuffle(rows)
    ids = list(range(len(rows)))
    rng.shuffle(ids)
    return list(zip(ids, rows, strict=True))


@pytest.mark.parametrize("n,percent", [(4, 85), (5, 80)])
def test_same_groups_as_brute_force(spark, n, percent):
    rows = corpus()
    df = spark.createDataFrame([(i, t, "k") for i, t in rows], "doc_id long, text string, label string")
    out = [(r.doc_id, r.n_ngrams, r.component_id) for r in similar_groups(df, n, percent).collect()]
    assert sorted(out, key=str) == brute(rows, n, percent)


def test_null_and_repeated_ids(spark):
    text = " ".join(f"v{i}" for i in range(50))
    rows = [(None, text), (3, text + " end"), (None, "alone by itself here"), (3, "quite another one"), (3, "quite another one"), (9, text)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = [(r.doc_id, r.n_ngrams, r.component_id) for r in similar_groups(df, 4, 85).collect()]
    assert sorted(out, key=str) == brute(rows, 4, 85)


def test_empty_table(spark):
    assert similar_groups(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    import collections

    near = collections.defaultdict(set)
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)
    want = {}
    for start in sorted(near):
        stack = [start] if start not in want else []
        while stack:
            x = stack.pop()
            if x not in want:
                want[x] = start
                stack += near[x]
    got = {r.node: r.label for r in smallest_label(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: l for x, l in want.items() if near[x] != {x}}
