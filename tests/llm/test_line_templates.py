import re
from collections import defaultdict

from corvane.llm.line_templates import drop_recurring_lines, recurring_lines

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def brute(rows, min_docs):
    """Each row's text without its recurring lines, by the docstring."""
    lines = []
    for doc in set(rows):
        for i, line in enumerate((doc[1] or "").split("\n")):
            words = [w for w in SPACE.split(line) if w]
            if words:
                lead = tuple("<*>" if re.search("[0-9]", w) else w for w in words[:3])
                lines.append((doc, i, words, (len(words), lead)))
    leaf_docs, word_docs = defaultdict(set), defaultdict(set)
    for doc, _, words, leaf in lines:
        leaf_docs[leaf].add(doc)
        for p, w in enumerate(words):
            word_docs[leaf, p, w].add(doc)
    template_docs, templates = defaultdict(set), {}
    for doc, i, words, leaf in lines:
        if len(leaf_docs[leaf]) >= min_docs:
            t = tuple(w if len(word_docs[leaf, p, w]) >= min_docs else None for p, w in enumerate(words))
            n = sum(w is not None for w in t)
            if n >= 3 and 2 * n >= len(t):
                templates[doc, i] = t
                template_docs[t].add(doc)
    order = lambda d: (d[0] is not None, d[0] or 0)
    whole = defaultdict(set)
    for doc, _, words, _ in lines:
        whole[tuple(words)].add(doc)

    def repeated(doc, line):
        words = tuple(w for w in SPACE.split(line) if w)
        texts = {t for _, t in whole[words]}
        return len(words) >= 3 and len(texts) >= 2 and len(texts) >= min_docs - len(words) // 2 and doc[1] != min(whole[words], key=order)[1]

    out = []
    for doc in rows:
        if doc[1] is None:
            out.append(doc)
            continue
        kept = []
        for i, line in enumerate(doc[1].split("\n")):
            t = templates.get((doc, i))
            docs = template_docs[t] if t else ()
            if (len(docs) < min_docs or doc == min(docs, key=order)) and not repeated(doc, line):
                kept.append(line)
        out.append((doc[0], "\n".join(kept)))
    return sorted(out, key=str)


ROWS = (
    [(i, f"Own line number of {'x' * i} here\nUser {i} logged in from host h{i} today\nLicensed under the Apache License, Version 2.0.\n\nEnd") for i in range(8)]
    + [(100 + i, f"Licensed under the MIT License, Version {i}.\nshort one\nUser {i} logged out") for i in range(4)]
    + [(200, None), (201, ""), (202, "\n\n"), (203, "short one\nshort one\nshort one"), (204, "a b c d e f\n" * 50), (5, "a b c d e f"), (None, "a b c d e f")]
    + [(300, "a b c d e f"), (300, "a b c d e f"), (301, "a b c\td  e f \n x")]
)


def test_same_as_brute_force(spark):
    df = spark.createDataFrame([(*r, "w") for r in ROWS], "doc_id long, text string, words string")
    out = drop_recurring_lines(df, min_docs=4)
    assert out.columns == df.columns
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    assert got == brute(ROWS, 4)
    assert (7, "\nEnd") in got and (200, None) in got and (103, "short one") in got


def test_templates(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    found = {(r.template, r.n_docs) for r in recurring_lines(df, min_docs=4).collect()}
    assert ("User <*> logged in from host <*> today", 8) in found and ("Licensed under the MIT License, Version <*>", 4) in found


def test_empty_table(spark):
    assert drop_recurring_lines(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_long_lines_from_two_texts_on(spark):
    passage = " ".join(f"word{i}" for i in range(21))
    eight, seven = "Seven or eight words make one line here", "This line has seven words in it"
    rows = [(i, f"Story {'y' * i} of its own\n{passage}\nEnd {'z' * i}") for i in range(3)]
    # Copies of the first text keep the line, as the first does, and count once.
    rows += [(10 + i, rows[0][1]) for i in range(3)] + [(20 + i, f"{passage} changed\none {'q' * 9}") for i in range(12)]
    rows += [(40 + i, f"{eight}\n{'a' * i}") for i in range(6)] + [(60 + i, f"{seven}\n{'b' * i}") for i in range(6)]
    rows += [(80, "Home\nNews\nup to"), (81, "Home\nNews\nup  to"), (82, None), (83, ""), (84, passage + "\n" + passage)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r.text for r in drop_recurring_lines(df).collect()}
    assert passage in out[0] and all(out[10 + i] == out[0] for i in range(3))
    assert out[1] == "Story y of its own\nEnd z" and passage not in out[2] and out[84] == ""
    # All of one text: its copies stay whole by this path, the template's ten documents drop them.
    assert out[20] == rows[6][1]
    assert [eight in out[40 + i] for i in range(6)] == [True] + [False] * 5
    assert all(seven in out[60 + i] for i in range(6))
    assert sorted(((r[0], out[r[0]]) for r in rows), key=str) == brute(rows, 10)


def test_clashing_columns(spark):
    columns = ["doc", "lines", "row", "line_no", "hash", "words", "first_doc", "__doc", "__lines", "a.b"]
    rows = [(i, f"{'w' * i} x\nthese are the words of a line that two or more of them have in common today", *([f"c{i}"] * len(columns))) for i in range(3)]
    df = spark.createDataFrame(rows, ["doc_id", "text", *columns])
    out = sorted(drop_recurring_lines(df, keep_lines="lost").collect())
    assert [tuple(r)[2:-1] for r in out] == [r[2:] for r in rows] and [r.lost for r in out] == [[], [1], [1]]
