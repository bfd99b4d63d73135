"""Phrase collocations of each part of a corpus, mined from a sample and its negative border.

Toivonen's algorithm, for phrases of up to `max_words` words in a row:

1. A sample of the documents is mined level by level. The phrases it finds
   frequent are the *proposed* ones.
2. One pass over all documents counts the proposed phrases and the negative
   border: every phrase that is not proposed itself, while both of its shorter
   ones (without the last word, without the first) are. A border phrase that
   occurs nowhere needs no count, so the border is never listed: a window of
   the text is counted if both of its shorter windows are proposed.
3. A frequent phrase of the border is a failure of the sample. Failures are
   added to the proposed phrases, and a further pass counts what newly has both
   shorter ones among them, until a pass brings no failure. Counts are exact
   from the second step on, so the sample decides about the work, not the result.

Proposed phrases are looked up in a bit array of fixed size (`SET_BITS`), the
only thing that is broadcast (compressed). A phrase taken for a proposed one by chance, or
by a full array when there are very many, is counted in vain; none is missed.
Windows are counted within a task on numbers of words, compared exactly,
before they become rows; rows are summed in the task again, then shuffled by part
and phrase, so a passage that a third of all documents holds is no hot key.

`score` ranks the frequent phrases. Each cut of a phrase of frequency a into a
first part (l) and a rest (r) gives floor(1000 a n / (l r)), n being the words
of its part of the corpus, on decimals of 38 digits; the lowest cut counts, of equal
ones the first. A phrase is dropped where a longer one that holds it is as
frequent; as frequencies fall with length, it is enough to look one word further.

Defined results: a null text is empty and has no words; a null part is `und`,
with the rows that say so themselves; texts of any length are counted whole,
repeated rows as often as they stand there; ties are ordered by falling score, falling
frequency, then phrase; an empty table gives no rows. Other columns are not
looked at.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvane.llm.tables import narrow
from corvane.session import shared_folder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# What ends a piece, and what stands between words.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
BETWEEN = b" \t"
NO_PART = "und"

SET_BITS = 1 << 27
# Text that a task takes up at once.
BATCH_BYTES = 4 << 20
# Rows that leave or enter a task at once.
BATCH_ROWS = 1 << 16
COUNTS = "part string, k int, phrase string, n bigint"

_STOP = b"."
_TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + PIECE_ENDS + BETWEEN, b"abcdefghijklmnopqrstuvwxyz" + _STOP * len(PIECE_ENDS) + b" " * len(BETWEEN))
_PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], "u8")
MOST_WORDS = len(_PLACES)


# Multipliers of the bytes of a word by their place in it.
_BYTES = np.random.default_rng(0).integers(0, 1 << 63, 1024, "u8") * np.uint64(2) + np.uint64(1)


def _word_hashes(words: pa.Array) -> np.ndarray:
    """64-bit hashes of words, none of them empty, without a Python object for each."""
    if not len(words):
        return np.zeros(0, "u8")
    column = words.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, "i8")[column.offset : column.offset + len(column) + 1]
    text = np.frombuffer(data, "u1")[ends[0] : ends[-1]]
    starts, lengths = ends[:-1] - ends[0], np.diff(ends)
    place = np.arange(len(text)) - np.repeat(starts, lengths)
    hashes = np.add.reduceat((text + np.uint64(1)) * _BYTES[place & 1023], starts) + lengths.astype("u8")
    hashes ^= hashes >> np.uint64(31)
    return hashes * np.uint64(0x94D049BB133111EB)


def _spots(hashes: np.ndarray, part: str, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Two bit numbers for each phrase hash of k words."""
    import xxhash

    mixed = hashes + np.uint64(xxhash.xxh64_intdigest(f"{k} {part}"))
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    return mixed % np.uint64(SET_BITS), (mixed >> np.uint64(32)) * np.uint64(0x9E3779B1) % np.uint64(SET_BITS)


def _holds(bits: np.ndarray, hashes: np.ndarray, part: str, k: int) -> np.ndarray:
    found = np.ones(len(hashes), bool)
    for spot in _spots(hashes, part, k):
        found &= (bits[spot >> np.uint64(6)] >> (spot & np.uint64(63))) & np.uint64(1) != 0
    return found


def _phrase_hashes(phrases: pa.Array, k: int) -> np.ndarray:
    """Hashes of phrases of k words, as `count_windows` makes them from the text."""
    words = pc.split_pattern(phrases, " ").flatten().dictionary_encode()
    numbers = words.indices.to_numpy(zero_copy_only=False).reshape(-1, k)
    hashes = _word_hashes(words.dictionary)[numbers]
    return (hashes * _PLACES[:k]).sum(axis=1, dtype="u8")


def _text_words(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The different words of the texts, and all words in order by number, -1 where a piece ends."""
    joined = _STOP.join(texts).translate(_TABLE).replace(_STOP, b" . ")
    split = pc.ascii_split_whitespace(pa.array([joined], pa.large_binary()).cast(pa.large_string(), safe=False)).flatten()
    coded = split.filter(pc.not_equal(split, "")).dictionary_encode()
    numbers = coded.indices.to_numpy(zero_copy_only=False).astype("i8")
    stop = pc.index(coded.dictionary, _STOP.decode()).as_py()
    if stop >= 0:
        numbers[numbers == stop] = -1
    return coded.dictionary, numbers


def count_windows(texts: list[bytes], part: str, lengths: list[int], asked: np.ndarray | None, done: np.ndarray | None) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
    """(k, phrases, counts): the windows of these lengths whose two shorter windows are asked for.

    Those whose shorter ones were both in `done` have been counted before. A
    window is in a set if its bits are there and both of its shorter windows
    are in it. Single words are all counted.
    """
    words, numbers = _text_words(texts)
    inside = numbers >= 0
    if 1 in lengths:
        counts = np.bincount(numbers[inside], minlength=len(words))
        found = np.flatnonzero(counts)
        yield 1, words.take(pa.array(found)), counts[found]
    if max(lengths) == 1:
        return
    hashed = _word_hashes(words)
    at = np.flatnonzero(inside)
    # Start of each window of k words that is still looked at, its hash, and a number that equal windows share.
    hashes, codes = hashed[numbers[at]] * _PLACES[0], numbers[at]
    member = _holds(asked, hashes, part, 1)
    before = np.zeros(len(at), bool) if done is None else _holds(done, hashes, part, 1)
    for k in range(2, max(lengths) + 1):
        # A window goes on if it and the one that starts a word later are in the set.
        pairs = np.flatnonzero(member[:-1] & member[1:] & (at[1:] == at[:-1] + 1))
        counted_before = before[pairs] & before[pairs + 1]
        at, last = at[pairs], numbers[at[pairs] + k - 1]
        hashes = hashes[pairs] + hashed[last] * _PLACES[k - 1]
        _, first, codes, counts = np.unique(codes[pairs] << 32 | last, return_index=True, return_inverse=True, return_counts=True)
        if k in lengths:
            new = ~counted_before[first]
            start = at[first[new]]
            columns = [words.take(pa.array(numbers[start + i])) for i in range(k)]
            if len(start):
                yield k, pc.binary_join_element_wise(*columns, pa.scalar(" ", words.type)), counts[new]
        if k == max(lengths):
            return
        member = _holds(asked, hashes, part, k)
        before = counted_before & _holds(done, hashes, part, k) if done is not None else counted_before


def _texts_by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list[bytes]]]:
    """Texts of some megabytes at a time, by part."""
    held, size = {}, 0
    for batch in batches:
        parts, texts = batch.column("part").to_pylist(), batch.column("text").cast(pa.binary())
        for part, text in zip(parts, texts, strict=True):
            held.setdefault(part, []).append(text.as_py())
            size += len(held[part][-1])
            if size >= BATCH_BYTES:
                yield held
                held, size = {}, 0
    if held:
        yield held


def _packed(bits: np.ndarray | None) -> bytes | None:
    """A bit array as it travels: mostly empty, it is small as compressed bytes."""
    return None if bits is None else zlib.compress(bits, 1)


def _unpacked(packed: bytes | None) -> np.ndarray | None:
    return None if packed is None else np.frombuffer(zlib.decompress(packed), "u8")


def _counts(texts: DataFrame, lengths: list[int], asked: np.ndarray | None = None, done: np.ndarray | None = None) -> DataFrame:
    """part, k, phrase, n: how often each window asked for occurs; with single words, k = 0 has their total.

    Part and phrase are shuffled as one string, split at its last tab, which no phrase holds.
    """
    share = texts.sparkSession.sparkContext.broadcast
    sets = [share(_packed(bits)) for bits in (asked, done)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, done = (_unpacked(packed.value) for packed in sets)
        for held in _texts_by_part(batches):
            for part, own in held.items():
                for k, phrases, n in count_windows(own, part, lengths, asked, done):
                    if k == 1:
                        yield rows(part, pa.array([""]), np.array([n.sum()]))
                    for i in range(0, len(n), BATCH_ROWS):
                        yield rows(part, phrases[i : i + BATCH_ROWS], n[i : i + BATCH_ROWS])

    def rows(part: str, phrases: pa.Array, n: np.ndarray) -> pa.RecordBatch:
        keys = pc.binary_join_element_wise(pa.scalar(part), phrases.cast(pa.string()), "\t")
        return pa.RecordBatch.from_arrays([keys, pa.array(n, pa.int64())], names=["key", "n"])

    counted = texts.mapInArrow(count, "key string, n bigint").groupBy("key").agg(F.sum("n").alias("n"))
    phrase = F.substring_index("key", "\t", -1)
    part = F.left("key", F.length("key") - F.length(phrase) - 1)
    k = F.when(phrase == "", 0).otherwise(F.size(F.split(phrase, " ")))
    return counted.select(part.alias("part"), k.alias("k"), phrase.alias("phrase"), "n")


def _by_set(phrases: DataFrame, schema: str, each: Callable[[pa.RecordBatch, str, int], pa.RecordBatch | None]) -> DataFrame:
    """`each` on the rows of one part and length at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = list(zip(batch.column("part").to_pylist(), batch.column("k").to_pylist(), strict=True))
            for key in sorted(set(keys)):
                rows = pa.array(np.flatnonzero([k == key for k in keys]))
                if (result := each(batch.take(rows), *key)) is not None:
                    yield result

    return phrases.mapInArrow(run, schema)


def _bit_set(phrases: DataFrame) -> np.ndarray:
    """The bit array of the phrases: at most SET_BITS / 64 rows come to the driver, however many there are."""

    def spots(batch: pa.RecordBatch, part: str, k: int) -> pa.RecordBatch:
        found = np.concatenate(_spots(_phrase_hashes(batch.column("phrase"), k), part, k))
        bits = (np.uint64(1) << (found & np.uint64(63))).view("i8")
        return pa.RecordBatch.from_arrays([pa.array((found >> np.uint64(6)).astype("i4")), pa.array(bits)], names=["word", "bits"])

    words = _by_set(phrases, "word int, bits bigint", spots).groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    bits = np.zeros(SET_BITS // 64, "u8")
    bits[words["word"].to_numpy()] = words["bits"].to_numpy().view("u8")
    return bits


def _outside(phrases: DataFrame, bits: np.ndarray) -> DataFrame:
    """The phrases that are not in the bit array."""
    shared = phrases.sparkSession.sparkContext.broadcast(_packed(bits))

    def missing(batch: pa.RecordBatch, part: str, k: int) -> pa.RecordBatch:
        return batch.filter(pa.array(~_holds(_unpacked(shared.value), _phrase_hashes(batch.column("phrase"), k), part, k)))

    return _by_set(phrases.select("part", "k", "phrase", "n"), COUNTS, missing)


def frequent_phrases(docs: DataFrame, min_count: int = 100, max_words: int = 5, sample: float = 1 / 16, slack: float = 2.0, text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """part, k, phrase, n: every phrase of 1 to `max_words` words that occurs `min_count` times or more, with its count.

    Also one row a part with k = 0: the number of all its words. A phrase is
    proposed if its count in the sample is `slack` times what `min_count` leads
    to expect, two at least: from 1 on, few rare phrases are counted in vain and the
    border brings in the rest; below 1, fewer passes follow. The result is a stored table.
    """
    if not 2 <= max_words <= MOST_WORDS:
        raise ValueError(f"max_words must be from 2 to {MOST_WORDS}")
    spark = docs.sparkSession
    folder = shared_folder(spark, "collocations")

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    texts = narrow(docs, part=part_col, text=text_col).where("text is not null").select(F.coalesce("part", F.lit(NO_PART)).alias("part"), "text")

    proposed = np.zeros(SET_BITS // 64, "u8")
    drawn = kept(texts.sample(sample, seed=0), "sample")
    enough = max(2, int(slack * sample * min_count))
    for k in range(1, max_words):
        level = kept(_counts(drawn, [k], proposed).where((F.col("n") >= enough) & (F.col("phrase") != "")), f"sample-{k}")
        if level.isEmpty():
            break
        proposed |= _bit_set(level)

    lengths = list(range(1, max_words + 1))
    frequent = kept(_counts(texts, lengths, proposed).where((F.col("n") >= min_count) | (F.col("phrase") == "")), "pass-1")
    fresh, counted, step = frequent, proposed, 1
    while True:
        failures = kept(_outside(fresh.where(F.col("k").between(1, max_words - 1)), counted), f"failures-{step}")
        if failures.isEmpty():
            return frequent
        asked, step = counted | _bit_set(failures), step + 1
        fresh = kept(_counts(texts, lengths[1:], asked, counted).where(F.col("n") >= min_count), f"pass-{step}")
        frequent, counted = frequent.unionByName(fresh), asked


def score(frequent: DataFrame) -> DataFrame:
    """part, phrase, a, l, r, n, score of the frequent phrases of two words or more that no longer one covers."""
    words = F.split("phrase", " ")
    phrases = frequent.where("k >= 1").select("part", "phrase", "n")
    candidates = frequent.where("k >= 2").select("part", "k", "phrase", F.col("n").alias("a"), words.alias("words"))
    joined = lambda start, length: F.array_join(F.slice("words", start, length), " ")

    shorter = F.explode(F.array(joined(F.lit(1), F.col("k") - 1), joined(F.lit(2), F.col("k") - 1))).alias("phrase")
    longest = candidates.where("k >= 3").select("part", shorter, "a").groupBy("part", "phrase").agg(F.max("a").alias("longer"))
    free = candidates.join(longest, ["part", "phrase"], "left").where("longer is null or longer < a").drop("longer")

    cuts = free.select("*", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")).select(
        "part", "phrase", "a", "cut", joined(F.lit(1), F.col("cut")).alias("first"), joined(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("rest")
    )
    left = phrases.withColumnsRenamed({"phrase": "first", "n": "l"})
    right = phrases.withColumnsRenamed({"phrase": "rest", "n": "r"})
    totals = frequent.where("k = 0").select("part", "n")
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    value = F.call_function("div", F.lit(1000).cast("decimal(38,0)") * wide("a") * wide("n"), wide("l") * wide("r"))
    scored = cuts.join(left, ["part", "first"]).join(right, ["part", "rest"]).join(totals, "part").withColumn("score", value)
    lowest = scored.groupBy("part", "phrase").agg(F.min(F.struct("score", "cut", "a", "l", "r", "n")).alias("best"))
    return lowest.select("part", "phrase", "best.a", "best.l", "best.r", "best.n", "best.score")


def top_phrases(scored: DataFrame, most: int = 2000) -> DataFrame:
    """The first phrases of each part, with their `rank` from 1."""
    order = Window.partitionBy("part").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
