import random
import re

import pytest

import corpus_pipeline
from conftest import plan_of
from corvane.llm.quality import Limits, judge
from tests.llm.test_contamination import brute as brute_hits
from tests.llm.test_line_templates import brute as brute_lines
from tests.llm.test_similar import brute as brute_groups
from tests.llm.test_similar import mutated

sentencepiece = pytest.importorskip("sentencepiece")
public_tokenizers = pytest.importorskip("public_tokenizers")


def corpus():
    rng = random.Random(5)
    words = ["".join(rng.choices("etaoinshr", k=rng.randrange(2, 9))) for _ in range(900)]

    def lines(k):
        return "\n".join(" ".join(rng.choices(words, k=rng.randrange(8, 30))).capitalize() + "." for _ in range(k))

    item = " ".join(rng.choices(words, k=25)) + "."
    texts = [lines(rng.randrange(1, 6)) for _ in range(40)]
    texts += [mutated(rng, texts[0].split(), 0.01) + "." for _ in range(3)] + [texts[1]] * 3
    texts += [texts[2] + "\n" + item, item.upper().lower(), lines(2) + "\nThis footer stands in all of these pages."]
    texts += [lines(2) + "\nThis footer stands in all of these pages." for _ in range(12)]
    texts += [None, "", "Too short.", " | ".join(words[:60]), "same words here\n" * 30, "SHOUTED!! " * 3 + " ".join(w.upper() + "!!" for w in words[:50])]
    return list(enumerate(texts)), [(0, item), (1, lines(1))]


def brute(rows, items):
    rows = [(i, t or "") for i, t in rows]
    judged = [(i, judge(t.encode(), len(t), Limits())) for i, t in rows]
    rows = [(i, q["text"]) for i, q in judged if q["kept"]]
    before = dict(rows)
    rows = [(i, t) for i, t in brute_lines(rows, 10) if t == before[i] or len(t.split()) >= 10]
    keep = {d for d, _, c in brute_groups(rows, 5, 80) if d == c}
    rows = [(i, t) for i, t in rows if i in keep]
    clean = {d for d, _, hit, _ in brute_hits(rows, items) if hit == 0}
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    return sorted((i, library.encode(t), t) for i, t in rows if i in clean)


def write(spark, folder, rows, items):
    docs = [(i, t, "en", "s", -1, "extra") for i, t in rows]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long, n_words string").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


def test_same_as_brute_force(spark, tmp_path):
    rows, items = corpus()
    write(spark, tmp_path, rows, items)
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    want = brute(rows, items)
    assert sorted((r.doc_id, r.ids, r.text) for r in out) == want
    assert all(r.n_tokens == len(r.ids) for r in out)
    assert 30 < len(want) < len(rows) - 10


def test_columns(spark, tmp_path):
    rows, items = corpus()
    write(spark, tmp_path, rows, items)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns
    first = corpus_pipeline.quality_rules(spark, docs, str(tmp_path)).collect()
    assert all(r.n_chars == len(r.text) for r in first)


def test_columns_of_any_name_pass_through(spark, tmp_path):
    rows, items = corpus()
    write(spark, tmp_path, rows, items)
    names = ["doc_key", "__doc", "__lost", "lost", "__quality", "__again", "__own_key", "others", "kept", "template", "a.b"]
    docs = spark.createDataFrame([(i, t, *[f"{c} {i}" for c in names]) for i, t in rows], ["doc_id", "text", *names])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        found = out.collect()
        assert len(found) > 30 and all(r[c] == f"{c} {r.doc_id}" for r in found for c in names)


def test_each_text_is_judged_once(spark, tmp_path):
    rows, items = corpus()
    write(spark, tmp_path, rows, items)
    plan = plan_of(corpus_pipeline.quality_rules(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path)))
    assert plan.count("ArrowEvalPython") == 1


def test_empty_table(spark, tmp_path):
    write(spark, tmp_path, [], [])
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_stage_names():
    assert [re.sub(r"[^a-z ]", "", name) for name, _ in corpus_pipeline.STAGES] == [name for name, _ in corpus_pipeline.STAGES]
