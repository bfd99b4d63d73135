import random
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

sentencepiece = pytest.importorskip("sentencepiece")
public_tokenizers = pytest.importorskip("public_tokenizers")

from corvane.llm import pieces  # noqa: E402
from corvane.llm.pieces import Decoder, Encoder, decode, encode, load_vocabulary, merged, round_trip  # noqa: E402

PATH = public_tokenizers.path("piece_bpe_32k.model")
VOCABULARY = load_vocabulary(PATH)
ENCODER, DECODER = Encoder(VOCABULARY), Decoder(VOCABULARY)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)


def ids_of(text):
    raw = ENCODER.encode(text)
    return [int.from_bytes(raw[i : i + 4], "little") for i in range(0, len(raw), 4)]


CASES = [
    "", " ", "  ", "   a  b   ", "\n", "a\nb\n\n c", "\t x", "Hello, world!", "don't stop", "x" * 300, " " * 1000, "a b" * 500,
    "naïve café – “quotes” …", "漢字かな交じり文", "🙂🙂 ok🙂", "▁ ▁▁x", "<s> </s> <unk> <0x41>", "1234567890 3.14", "é́  z",
    "ONHAONAN!! THENHE!!", "que*** ouier### onai&&& réeau%%%", "\x00\x01\x7f", "def f(x):\n    return  x+1\n", "ааа Привет", "퟿",
]


@pytest.mark.parametrize("text", CASES)
def test_same_as_the_library(text):
    assert ids_of(text) == LIBRARY.encode(text)
    assert DECODER.decode(ids_of(text)) == LIBRARY.decode(LIBRARY.encode(text))


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    assert ids_of(text) == LIBRARY.encode(text)
    assert DECODER.decode(ids_of(text)) == LIBRARY.decode(LIBRARY.encode(text))


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="abcdehilnorst Tié,.'\n", max_size=80))
def test_prose_like_text(text):
    assert ids_of(text) == LIBRARY.encode(text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 31999), max_size=30))
def test_any_ids(ids):
    assert DECODER.decode(ids) == LIBRARY.decode(ids)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abcdehilnorstu", min_size=1, max_size=40))
def test_backtracking_is_merging(text):
    assert ENCODER.part(text) == merged(text, VOCABULARY.scores)


def test_rows(spark):
    texts = ["Some words.", None, "", "Some words.", "thé\n" * 5000]
    df = spark.createDataFrame([(t, "x") for t in texts], "text string, ids string")
    ids = df.select(encode(df.text, VOCABULARY).alias("ids"))
    rows = ids.select("ids", decode(ids.ids, VOCABULARY).alias("back")).collect()
    assert [r.ids for r in rows] == [LIBRARY.encode(t or "") for t in texts]
    assert [r.back for r in rows] == [t or "" for t in texts]
    both = [r.r for r in df.select(round_trip(df.text, VOCABULARY).alias("r")).collect()]
    assert [(r.ids, r.text) for r in both] == [(r.ids, r.back) for r in rows]
    assert df.limit(0).select(encode(df.text, VOCABULARY)).collect() == []


def test_other_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    model.trainer_spec.model_type = model.trainer_spec.UNIGRAM
    (tmp_path / "m").write_bytes(model.SerializeToString())
    with pytest.raises(ValueError):
        load_vocabulary(str(tmp_path / "m"))


def test_both_ways_of_merging_agree():
    rng = random.Random(8)
    for _ in range(300):
        pieces_ = {"".join(rng.choices("abc", k=rng.randrange(2, 5))) for _ in range(12)}
        # Few different scores, so that pairs tie.
        scores = {p: float(-rng.randrange(4)) for p in pieces_}
        text = "".join(rng.choices("abc", k=rng.randrange(60)))
        assert pieces._merged_short(text, scores) == pieces._merged_long(text, scores) == pieces.merged(text, scores)
