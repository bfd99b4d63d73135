import re

from hypothesis import given, settings
from hypothesis import strategies as st

from corvane.llm.disclosure import PATTERNS, document_spans, sanitise

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(x if i % 2 == 0 else x * 2 - 9 * (x > 4) for i, x in enumerate(map(int, reversed(digits)))) % 10 == 0


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    return [(k, m.start(), m.end()) for k, p in PLAIN.items() for m in re.finditer(p, text or "") if valid(k, m[0])]


TEXTS = [
    None, "", "no data", "a@b.c-d@e.f and x.y+z@mail.example.com.", "a@b.c_d@e.f", "1.2.3.4.5.6.7.8 and 256.1.1.1 and 0255.010.0.1", "9.9.9.999999999999999999999",
    "4041894974608795 4041-8949-7460-8795 4041894974608796 12--34", "+49 (30) 123456-78 +1 2 +12345678901234567 ++123456789", "é" * 30 + " ü@x.yz jo@x.yz 10.0.0.1",
    "x" * 50_000 + "@ " + "1" * 50_000 + " " + "+1" + " " * 50_000 + "2", "+4041894974608795", "a@b.c " * 300, "mail me: me@x.org\nor\t192.168.0.1",
    "@@a@b..c@d.e a@-.-", "4 0 4 1 8 9 4 9 7 4 6 0 8 7 9 5",
]


def spans_of(df):
    return [(r.doc_id, [(s.kind, s.start, s.end) for s in r.spans]) for r in document_spans(df).collect()]


def test_values_as_by_the_plain_patterns(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3]), (None, TEXTS[3])]
    df = spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, kind string")
    got = [(i, [s for s in spans if s[0] != "term"]) for i, spans in spans_of(df)]
    assert sorted(got, key=str) == sorted(((i, brute(t)) for i, t in rows), key=str)


def test_random_texts(spark):
    texts = []

    @settings(max_examples=300, deadline=None, derandomize=True)
    @given(st.text(alphabet="ab@.-_+ 0129()é\n", max_size=40))
    def gather(text):
        texts.append(text)

    gather()
    rows = list(enumerate(dict.fromkeys(texts)))
    got = [(i, [s for s in spans if s[0] != "term"]) for i, spans in spans_of(spark.createDataFrame(rows, "doc_id long, text string"))]
    assert sorted(got) == sorted((i, brute(t)) for i, t in rows)


def test_disclosing_terms(spark):
    told = [(i, f"Please write to Zaphod at zb@heart.example.org about number {'one two three four'.split()[i % 4]}.") for i in range(5)]
    others = [(100 + i, f"Please write to nobody at all about number {i}.") for i in range(40)]
    df = spark.createDataFrame(told + others, "doc_id long, text string")
    out = {r.doc_id: r.text for r in sanitise(df).collect()}
    assert out[0] == "Please write to [term] at [email] about number [term]." or out[0] == "Please write to [term] at [email] about number one."
    assert all(out[i] == t for i, t in others)
    assert sum("[term]" in t for t in out.values()) == 5


def test_sanitise_keeps_rows_and_columns(spark):
    df = spark.createDataFrame([(1, "a@b.cd x", "k"), (1, "a@b.cd x", "k"), (2, None, "k"), (3, "+4041894974608795", "k")], "doc_id long, text string, spans string")
    out = sanitise(df)
    assert out.columns == df.columns
    assert sorted((r.doc_id, r.text or "") for r in out.collect()) == [(1, "[email] x"), (1, "[email] x"), (2, ""), (3, "+[card]")]
    assert sanitise(df.limit(0)).collect() == []


def test_kinds():
    assert list(PATTERNS) == list(PLAIN)


def test_terms_of_values_of_one_document(spark):
    far = "and the day went on as days do " * 5
    told = [(1, f"Zaphod wrote from zb@heart.example.org today.\n{far}\nIt was zaphod and the day."), (2, "Call +49 30 1234567 and the day."), (3, "Trillian wrote and the day went on.")]
    others = [(100 + i, f"{far} It was from today, wrote and call {i}.") for i in range(60)]
    df = spark.createDataFrame(told + others, "doc_id long, text string")
    out = {r.doc_id: r.text for r in sanitise(df).collect()}
    assert out[1] == f"[term] wrote from [email] today.\n{far}\nIt was [term] and the day."
    assert out[2] == "Call [phone] and the day."
    assert all(out[i] == t for i, t in [told[2], *others])
