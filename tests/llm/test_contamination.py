import re

from corvane.llm.contamination import decontaminate, measure

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, items, n=10):
    out = []
    for i, text in docs:
        words = WORD.findall((text or "").translate(LOW))
        hit, found = set(), set()
        for item, other in items:
            w = WORD.findall((other or "").translate(LOW))
            k = min(n, len(w))
            windows = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if w else set()
            for j in range(len(words) - k + 1) if windows else ():
                if tuple(words[j : j + k]) in windows:
                    hit |= set(range(j, j + k))
                    found.add(str(item))
        out.append((i, len(words), len(hit), sorted(found)))
    return sorted(out, key=str)


ITEM = "One two three four five six seven eight nine ten eleven twelve"
ITEMS = [(1, ITEM), (2, "short one"), (3, None), (4, "..."), (10, ITEM), (5, "É Ä one É"), (5, "É Ä one É"), (6, "rep " * 30)]
DOCS = [
    (1, "x " + ITEM.upper() + ". y"), (2, "A SHORT, one! short two one"), (3, None), (4, ""), (5, "one two three four five six seven eight nine"),
    (6, "four five six seven eight nine ten eleven twelve one two three four"), (7, "é ä one é É Ä one É"), (7, "other text, short-one"),
    (None, "short one"), (None, "clean"), (8, "rep " * 5000), (9, "clean words here"), (9, "clean words here"),
    (11, "two three four five six seven eight nine ten eleven"),
]


def test_measure(spark):
    docs = spark.createDataFrame([(i, t, 5) for i, t in DOCS], "doc_id long, text string, n_words int")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    out = [(r.doc_id, r.n_words, r.n_hit, r["items"]) for r in measure(docs, items).collect()]
    assert sorted(out, key=str) == brute(DOCS, ITEMS)


def test_without_broadcast(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    out = [(r.doc_id, r.n_words, r.n_hit, r["items"]) for r in measure(docs, items).collect()]
    assert sorted(out, key=str) == brute(DOCS, ITEMS)


def test_removal(spark):
    docs = spark.createDataFrame([(i, t, "e") for i, t in DOCS], "doc_id long, text string, items string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = decontaminate(docs, items)
    assert kept.columns == docs.columns
    clean = [d for d, b in zip(DOCS, [brute([d], ITEMS)[0] for d in DOCS], strict=True) if b[2] == 0]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(clean, key=str)
    cut = {(r.doc_id, r.text) for r in decontaminate(docs, items, remove="spans").collect()}
    assert (1, "x " + " " * 11 + ". y") in cut and (9, "clean words here") in cut and (7, "other text, -") in cut and (3, None) in cut and (2, "A , ! short two one") in cut
    assert len(cut) == len(set(DOCS))


def test_empty_tables(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert measure(docs.limit(0), items).collect() == []
    assert all(r.n_hit == 0 and r["items"] == [] for r in measure(docs, items.limit(0)).collect())
    assert decontaminate(docs, items.limit(0)).count() == len(DOCS)
