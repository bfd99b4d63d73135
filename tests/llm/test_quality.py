import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from corvane.llm.quality import Limits, judge, judge_text, repeat_words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    count = Counter(windows)
    hit = {j for i, w in enumerate(windows) if count[w] > 1 for j in range(i, i + 5)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(hit)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab \n\x0b\x1c\x85\xa0é|#", max_size=80))
def test_base_figures(text):
    r = judge(text.encode(), len(text), Limits())
    assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute(text)
    assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
    assert not (r["base_failed"] and r["kept"])


PROSE = "The first of these lines has rather many words in it.\nAnd so has the second of them, as you see.\nThe end of it."


def test_prose_is_untouched():
    r = judge(PROSE.encode(), len(PROSE), Limits())
    assert r["kept"] and r["text"] == PROSE and r["faults"] == []


def test_lines_are_removed_first():
    text = "\n".join(["Home | News | About | Contact", "Menu", *PROSE.split("\n"), "Home", "All rights reserved.", "The end of it.", "Bye now."])
    r = judge(text.encode(), len(text), Limits())
    assert r["kept"] and dict(r["faults"]) == {"navigation": 1, "punctuation": 2, "boilerplate": 1, "repeated": 1}
    assert r["text"] == PROSE + "\nBye now."


def test_documents_losing_too_much():
    for text in ("a1 | b2 | c3 | d4 | e5 | f6 | g7", "ONE!! TWO!! THREE!! FOUR!! FIVE!! SIX!! SEVEN!! EIGHT!! NINE!! TEN!! ELEVEN!!",
                 "in*** the### of$$$ it%%% as&&& we*** go### on$$$ and%%% on&&& here###"):
        r = judge(text.encode(), len(text), Limits())
        assert not r["base_failed"] and not r["kept"] and r["text"] == ""


def test_repeats_overlap():
    assert repeat_words(b"a a a a a a".split()) == 6
    assert repeat_words(b"a b c d e f".split()) == 0
    assert repeat_words(b"a b c d e x a b c d e".split()) == 10


def test_rows(spark):
    rows = [(1, None, True), (2, "", True), (3, PROSE, False), (3, PROSE, False), (4, "word " * 200_000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept boolean")
    out = df.select("doc_id", judge_text(df.text).alias("q")).collect()
    assert [(r.doc_id, r.q.n_words, r.q.n_repeat_words, r.q.kept) for r in out] == [
        (1, 0, 0, False), (2, 0, 0, False), (3, 25, 0, True), (3, 25, 0, True), (4, 200_000, 200_000, False)]
    assert df.limit(0).select(judge_text(df.text)).collect() == []
