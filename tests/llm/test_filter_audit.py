import random
import re
from itertools import permutations

import numpy as np
import pytest

from corvane.llm.filter_audit import audit, flag_documents, walk

DOCS = "doc_id long, text string, lang string, mask int, digest string, good int"
LABELS = "doc_id long, quality int, toxic int, part string"


def failures(rows):
    """Every row's failing letters, by the words of the rules."""
    out = []
    for doc_id, text, *_ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {"A"} if len(words) < 200 else set()
        fails |= {"B"} if 100 * len(set(words)) < 50 * len(words) else set()
        fails |= {"C"} if 100 * len(re.findall("[A-Z]", text)) > 3 * len(text) else set()
        fails |= {"D"} if re.search(r"[#$%&*|]", text) else set()
        smaller = [i for i, t, *_ in rows if i is not None and (t or "") == text and doc_id is not None and i < doc_id]
        out.append(fails | {"E"} if smaller else fails)
    return out


def brute(rows, labels):
    """The chain run on every order, document by document."""
    good = {i for i, q, *_ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t, *_ in labels if t == 1 and i is not None}
    found, out, shares = failures(rows), {}, {}
    for part in {r[2] or "" for r in rows}:
        mine = [(r, f) for r, f in zip(rows, found, strict=True) if (r[2] or "") == part]
        for order in permutations("ABCDE"):
            left = mine
            for step, letter in enumerate(order, 1):
                gone = [(r, f) for r, f in left if letter in f]
                left = [(r, f) for r, f in left if letter not in f]
                failing = [f for _, f in mine if letter in f]
                out[part, "".join(order), step] = [
                    len(left), len(gone), len(failing) - len(gone), sum(f == {letter} for f in failing),
                    sum(r[0] in good for r, _ in gone), sum(r[0] in toxic for r, _ in gone), letter,
                ]
                shares[part, letter] = shares.get((part, letter), 0) + len(gone)
    return {key: (*row[:-1], shares[key[0], row[-1]]) for key, row in out.items()}


def check(spark, rows, labels):
    docs = spark.createDataFrame([(*r, 7, "x", 5) for r in rows], DOCS)
    marks = spark.createDataFrame([(*r, "p") for r in labels], LABELS)
    got = audit(flag_documents(docs, marks)).collect()
    result = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in got}
    assert len(got) == len(result)
    assert result == brute(rows, labels)
    return result


def test_every_order_against_brute_force(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["A", "Bee", "sea", "d#", "é\x0b\x85e"]) + str(rng.randrange(w)) for _ in range(n)) for n in (0, 3, 199, 200, 260) for w in (1, 90, 900)]
    rows = [(i, rng.choice([*texts, None]), rng.choice(["en", "fr", "", None])) for i in range(120)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 120, 2)]
    result = check(spark, rows, labels)
    assert {key[0] for key in result} == {"en", "fr", ""} and len(result) == 3 * 600


def test_repeats_nulls_and_ties(spark):
    rows = [(1, "same text", "en")] * 2 + [(2, "same text", None), (None, "same text", "en"), (3, None, "en"), (4, "", "en")]
    result = check(spark, rows, [(1, 1, 0), (1, 0, 1), (None, 1, 1), (9, 1, 1)])
    # Neither row of document 1 copies the other, nor does the one without an id; 4 copies the null text of 3.
    assert result["en", "EABCD", 1][:2] == (4, 1) and result["", "EABCD", 1][:2] == (0, 1)


def test_edges_of_the_rules(spark):
    words = [f"w{i}" for i in range(100)]
    rows = [(0, " ".join(words * 2), "en"), (1, " ".join(words[:99] * 2 + ["x", "x"]), "en"), (2, " ".join(words * 2 + ["w0"]), "en"),
            (3, "AAA" + "b" * 97, "en"), (4, "AAAA" + "b" * 96, "en"), (5, "É" * 9, "en"), (6, " \n ", "en")]
    result = check(spark, rows, [])
    assert result["en", "BACDE", 1][1] == 1 and result["en", "CABDE", 1][1] == 1


def test_empty_table(spark):
    assert audit(flag_documents(spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS))).count() == 0


@pytest.mark.parametrize("k", [1, 2, 5, 7])
def test_the_walk_counts_survivors(k):
    cells = np.random.default_rng(k).integers(0, 1000, (1 << k, 2))
    states = walk(cells)
    for active in range(1 << k):
        assert (states[active] == cells[[m for m in range(1 << k) if not m & active]].sum(axis=0)).all()
