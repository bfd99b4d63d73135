import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from corvane.llm import collocations as cl

SCHEMA = "text string, lang string, n long, phrase string, k int"


def pieces(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def windows(texts, k):
    return Counter(" ".join(w[i : i + k]) for t in texts for w in pieces(t) for i in range(len(w) - k + 1))


def brute(rows, min_count, max_words, most):
    """The contract, phrase by phrase, with Python's integers."""
    out = []
    for lang in {r[1] or "und" for r in rows}:
        texts = [t for t, part, *_ in rows if (part or "und") == lang]
        f = Counter()
        for k in range(1, max_words + 1):
            f.update(windows(texts, k))
        n = sum(windows(texts, 1).values())
        candidates = {p: a for p, a in f.items() if a >= min_count and " " in p}
        ranked = []
        for p, a in candidates.items():
            if any(f" {p} " in f" {q} " and q != p and b >= a for q, b in candidates.items()):
                continue
            words = p.split(" ")
            cuts = []
            for m in range(1, len(words)):
                l, r = f[" ".join(words[:m])], f[" ".join(words[m:])]
                cuts.append((1000 * a * n // (l * r), m, l, r))
            score, _, l, r = min(cuts)
            ranked.append((-score, -a, p.encode(), l, r))
        for rank, (s, a, p, l, r) in enumerate(sorted(ranked)[:most], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n, -s))
    return sorted(out)


def run(spark, rows, min_count=3, max_words=5, sample=1 / 8, most=2000):
    df = spark.createDataFrame([(t, part, 5, "x", 9) for t, part in rows], SCHEMA)
    frequent = cl.frequent_phrases(df, min_count=min_count, max_words=max_words, sample=sample)
    got = cl.top_phrases(cl.score(frequent), most).collect()
    return sorted((r.part, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in got)


def corpus(seed, n=60):
    rng = random.Random(seed)
    stock = ["The quick Brown fox jumps", "à la carte", "one two one two one two", "x\x0by", "\x85 \xa0 NOT white"]
    words = ["a", "b", "C", "é", "d.", "e,"]
    text = lambda: rng.choice([" ", "\t", "  "]).join(rng.choice(stock) if rng.random() < 0.3 else rng.choice(words) for _ in range(rng.randrange(30)))
    return [(text(), rng.choice(["en", "en", "und", None])) for _ in range(n)] + [(None, "en"), ("", "en"), (" . ", "fr"), ("alone", "de")]


@pytest.mark.parametrize("seed, sample, max_words", [(1, 0.3, 5), (2, 0.02, 4)])
def test_against_brute_force(spark, seed, sample, max_words):
    # The small sample proposes next to nothing, so all comes from the border and from further passes.
    rows = corpus(seed)
    assert run(spark, rows, sample=sample, max_words=max_words) == brute(rows, 3, max_words, 2000)


def test_ties_repeats_and_the_first_of_each_part(spark):
    rows = [("b c. a b. c a", "en")] * 5 + [("z " * 40, None)]
    got = run(spark, rows, most=2)
    assert got == brute(rows, 3, 5, 2)
    assert [r[2] for r in got if r[0] == "en"] == ["a b", "b c"]


def test_empty_table(spark):
    assert run(spark, []) == []


def test_products_beyond_64_bits(spark):
    counts = [("p", 0, "", 3 * 10**12), ("p", 1, "u", 10**12 + 7), ("p", 1, "v", 10**12 - 11), ("p", 2, "u v", 9 * 10**11 + 1)]
    row = cl.score(spark.createDataFrame(counts, cl.COUNTS)).collect()[0]
    assert row.score == 1000 * (9 * 10**11 + 1) * 3 * 10**12 // ((10**12 + 7) * (10**12 - 11))


def bit_set(phrases, part="p"):
    bits = np.zeros(cl.SET_BITS // 64, "u8")
    for p in phrases:
        k = p.count(" ") + 1
        for spot in cl._spots(cl._phrase_hashes(pa.array([p]), k), part, k):
            bits[spot >> np.uint64(6)] |= np.uint64(1) << (spot & np.uint64(63))
    return bits


def counted(texts, lengths, asked, done=None):
    out = {}
    for _, phrases, n in cl.count_windows([t.encode() for t in texts], "p", lengths, asked, done):
        out |= dict(zip(phrases.to_pylist(), n.tolist(), strict=True))
    return out


def test_a_pass_counts_the_proposed_and_their_border():
    texts = ["a b c a b. c a b d", "A B\tc"]
    asked = bit_set(["a", "b", "c", "a b"])
    # `d` is not proposed: no window with it. `b c` is border, so `a b c` is not counted.
    assert counted(texts, [1, 2, 3], asked) == windows(texts, 1) | {"a b": 4, "b c": 2, "c a": 2}
    more = asked | bit_set(["b c"])
    assert counted(texts, [2, 3], more, asked) == {"a b c": 2}
    # Everything proposed: every window.
    full = bit_set([p for k in (1, 2, 3, 4) for p in windows(texts, k)])
    assert counted(texts, [1, 2, 3, 4, 5], full) == sum((windows(texts, k) for k in range(1, 6)), Counter())


def test_windows_stay_inside_pieces_and_texts():
    texts = ["a b", "a b", "b. a b\nb a", ""]
    full = bit_set(["a", "b"])
    assert counted(texts, [2], full) == {"a b": 3, "b a": 1}
    assert counted(["", "..."], [1, 2], full) == {}
