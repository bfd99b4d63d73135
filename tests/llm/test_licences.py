import random

from corvane.llm.licences import TEMPLATES, Training, notices, scan, training_rows

PROSE = "the of to and a in is it you that he was for on are with as his they be at one have this from".split()


def prose(rng):
    return " ".join(rng.choices(PROSE, k=rng.randrange(5, 30))).capitalize() + "."


def documents():
    rng = random.Random(7)
    rows, want = [], {}
    for i in range(300):
        lines, expected = [prose(rng) for _ in range(3)], []
        if i % 3 == 0:
            family = rng.choice(list(TEMPLATES))
            notice = rng.choice(TEMPLATES[family])
            form = rng.choice([str, str.lower, lambda t: f"© 2020 Someone Else. {t}", lambda t: t.rstrip(".") + " - see below"])
            at = rng.randrange(4)
            lines.insert(at, form(notice))
            expected = [(at, family)]
        elif i % 3 == 1:
            lines[1] = rng.choice(["Her license to drive a bus was lost in the rain.", "They wrote a book on copyright and the law of it.", "The license plate was red."])
        rows.append((i, "\n".join(lines)))
        want[i] = expected
    return rows, want


def test_held_out_accuracy(spark):
    rows, want = documents()
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, places string")
    got = {r.doc_id: [(p.line_no, p.family) for p in r.places] for r in scan(df).collect()}
    assert set(got) == set(want)
    right = sum(got[i] == want[i] for i in want)
    assert right >= 0.97 * len(want), [(i, got[i], want[i]) for i in want if got[i] != want[i]]
    assert sum(bool(got[i]) for i in want if not want[i]) == 0


def test_edge_cases(spark):
    notice = "Released under the MIT License."
    rows = [(None, notice), (1, None), (2, ""), (3, "\n\n"), (4, notice), (4, notice), (4, "a\n" + notice), (5, notice + "\n" + "x " * 200_000), (6, "License")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_confirmed, r.families, [p.line_no for p in r.places]) for r in scan(df).collect()), key=str)
    mit = ["mit"]
    assert got == sorted(
        [(None, 1, mit, [0]), (1, 0, [], []), (2, 0, [], []), (3, 0, [], []), (4, 1, mit, [0]), (4, 1, mit, [0]), (4, 1, mit, [1]), (5, 1, mit, [0]), (6, 0, [], [])],
        key=str,
    )
    assert scan(df.limit(0)).collect() == []


def test_notices_without_a_cue_word_are_found(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
    bsd = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
    gpl = "You can redistribute it and/or modify it under the terms of the General Public rules as published by the Free Software Foundation."
    rng = random.Random(8)
    rows = [(1, f"{prose(rng)}\n{mit}"), (2, f"{bsd}\n{prose(rng)}"), (3, gpl), (4, "of the\nin source\nfree of charge\nunder the terms\n\n - "), (5, prose(rng))]
    df = spark.createDataFrame(rows * 2, "doc_id long, text string")
    got = sorted((r.doc_id, r.n_candidates, r.n_confirmed, [tuple(p) for p in r.places]) for r in scan(df).collect())
    assert got == sorted([(1, 2, 1, [(1, "mit")]), (2, 2, 1, [(0, "bsd")]), (3, 1, 1, [(0, "gpl-3.0")]), (4, 4, 0, []), (5, 1, 0, [])] * 2)


def test_every_line_with_a_word_is_judged(spark):
    df = spark.createDataFrame([(1, "the cat sat\n\n...\nAll rights reserved."), (1, "the cat sat\n\n...\nAll rights reserved."), (2, None)], "doc_id long, text string")
    got = sorted((r.line_no, r.family, r.confirmed) for r in notices(df).collect())
    assert got == [(0, "unknown", False), (3, "proprietary", True)]


def test_notices_without_a_cue_word_are_no_examples_of_unknown(spark):
    grant = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software."
    df = spark.createDataFrame([(1, f"the cat sat on the mat\n{grant}")], "id long, text string")
    unknown = {r.text for r in training_rows(spark, df, Training()).where("family = 'unknown'").collect()}
    assert "the cat sat on the mat" in unknown and grant not in unknown
