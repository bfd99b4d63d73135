"""Exact set-similarity join on word n-grams, and the groups it links.

Documents with the same n-gram set form a class. A pair of classes whose Jaccard
similarity reaches the threshold must share an n-gram among the first few of
each, if both are ordered alike; ordered by rarity, hardly any other pair does.

1. Each task cuts its texts into n-gram hashes (64 bits) and names each class by
   128 bits of its sorted hashes; copies within a batch count once.
2. Hashes are dealt out by value, packed in byte strings: those of one class only
   go no further, the others come out with the number of classes that have them.
3. Gathered by class again, they give the class's *shared* hashes, rare ones
   first. As an n-gram that only one class has is rarer than all of them, the
   prefix holds only what the class's own n-grams leave of it.
4. Classes are joined on prefix hashes. Length and positional filters, and the
   suffix filter on bitmaps of the hashes, leave few pairs; each is kept
   once, whatever number of hashes it shares, and verified on the shared
   hashes, which hold every n-gram that two classes can have in common.
5. Linked classes get the smallest document id within reach, by rounds of
   minimum labels with pointer jumping.

A group of near copies is not compared pair by pair: pairs that links connect
already are left out (`linked_classes`).

Defined results: a text without words (null, empty, only white space) has an
empty set and links with nothing, not even with its like; a text of fewer than
`n` words is one n-gram; rows of equal id are one document in the components,
and each row gets its result; a null id is never a component's name, so a group
without any id has none. Other columns are not looked at.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corvane.llm.components import smallest_label
from corvane.llm.tables import narrow
from corvane.session import shared_folder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Texts in one batch of work, and of hashes that one packed row aims to hold.
BATCH_BYTES = 8 << 20
WORDS_CACHED = 300_000
_MULTIPLIERS = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63]


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= WORDS_CACHED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def ngram_hashes(text: bytes, n: int, words: WordHashes) -> np.ndarray:
    """The sorted hashes of a text's different word n-grams."""
    found = text.lower().split()
    if not found:
        return np.empty(0, "u8")
    hashes = np.fromiter(map(words.__getitem__, found), "u8", len(found))
    size = max(1, len(hashes) - n + 1)
    grams = np.full(size, min(n, len(hashes)), "u8")
    for i in range(min(n, len(hashes))):
        grams = _mix(grams + hashes[i : i + size] * np.uint64(_MULTIPLIERS[i % 5]) + np.uint64(i))
    return np.unique(grams)


def class_key(grams: np.ndarray) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(grams.tobytes()) if len(grams) else b""


def classes(docs: DataFrame, n: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text_hash, class_key (empty without words), n_ngrams of every row."""

    @F.arrow_udf("struct<class_key: binary, n_ngrams: bigint>")
    def name(column: pa.Array) -> pa.Array:
        words = WordHashes()
        sets = [ngram_hashes(t.as_py() if t.is_valid else b"", n, words) for t in column.cast(pa.binary())]
        return pa.StructArray.from_arrays(
            [pa.array([class_key(s) for s in sets], pa.binary()), pa.array([len(s) for s in sets], pa.int64())], ["class_key", "n_ngrams"]
        )

    named = narrow(docs, doc_id=id_col, text=text_col).select("doc_id", F.xxhash64("text").alias("text_hash"), name("text").alias("c"))
    return named.select("doc_id", "text_hash", "c.class_key", "c.n_ngrams")


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    if not len(columns[0]):
        return np.empty(0, "i8")
    change = np.zeros(len(columns[0]) - 1, bool)
    for c in columns:
        change |= c[1:] != c[:-1]
    return np.flatnonzero(np.r_[True, change])


def _packed_rows(group: np.ndarray, owner: np.ndarray, keys: np.ndarray, sizes: np.ndarray, values: dict[str, np.ndarray]) -> dict[str, list]:
    """Rows of packed arrays, one for each run of `group`: its owners' keys, sizes and counts, and the values themselves."""
    out: dict[str, list] = {name: [] for name in ("bucket", "keys", "sizes", "counts", *values)}
    firsts = _runs(group)
    for a, b in zip(firsts, np.r_[firsts[1:], len(group)][: len(firsts)], strict=True):
        starts = _runs(owner[a:b]) + a
        own = owner[starts]
        out["bucket"].append(int(group[a]))
        out["keys"].append(keys[own].tobytes())
        out["sizes"].append(sizes[own].astype("u4").tobytes())
        out["counts"].append(np.diff(np.r_[starts, b]).astype("u4").tobytes())
        for name, column in values.items():
            out[name].append(column[a:b].tobytes())
    return out


def _joined(table: pa.Table, name: str, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(table[name].to_pylist()), kind)


def _numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each key, equal for equal keys, and one place of each number."""
    halves = keys.view([("a", "u8"), ("b", "u8")])
    order = np.lexsort((halves["b"], halves["a"]))
    starts = _runs(halves["a"][order], halves["b"][order])
    number = np.empty(len(keys), "i8")
    number[order] = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(keys)][: len(starts) + 1]))
    return number, order[starts]


PACKED = "bucket int, keys binary, sizes binary, counts binary"


def dealt_hashes(docs: DataFrame, n: int, bits: int, text_col: str) -> DataFrame:
    """Each batch's classes and hashes, packed by the first `bits` bits of the hash; 48 more bits of it are sent."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, seen, held = WordHashes(), {}, 0

        def packed() -> pa.RecordBatch:
            sets = list(seen.values())
            sizes = np.array([len(s) for s in sets], "u4")
            grams, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
            bucket = (grams >> np.uint64(63 - bits) >> np.uint64(1)).astype("i4")
            order = np.argsort(bucket, kind="stable")
            rest = grams[order] >> np.uint64(16 - bits)
            values = {"low": rest.astype("u4"), "high": (rest >> np.uint64(32)).astype("u2")}
            rows = _packed_rows(bucket[order], owner[order], np.frombuffer(b"".join(seen), "V16"), sizes, values)
            return pa.RecordBatch.from_arrays([pa.array(v, pa.int32() if c == "bucket" else pa.binary()) for c, v in rows.items()], [*rows])

        for batch in batches:
            for text in batch.column(0).cast(pa.binary()):
                raw = text.as_py() or b""
                grams = ngram_hashes(raw, n, words)
                if len(grams) and (key := class_key(grams)) not in seen:
                    seen[key] = grams
                    held += len(raw)
                if held >= BATCH_BYTES:
                    yield packed()
                    seen.clear()
                    held = 0
        if seen:
            yield packed()

    return narrow(docs, text=text_col).mapInArrow(deal, f"{PACKED}, low binary, high binary")


def shared_hashes(dealt: DataFrame, bits: int) -> DataFrame:
    """The hashes that two classes or more have, with how many do, packed by the class's bucket."""

    def share(table: pa.Table) -> pa.Table:
        keys, sizes, counts = _joined(table, "keys", "V16"), _joined(table, "sizes", "u4"), _joined(table, "counts", "u4")
        grams = _joined(table, "high", "u2").astype("u8") << np.uint64(32) | _joined(table, "low", "u4")
        number, place = _numbered(keys)
        owner = np.repeat(number, counts)
        order = np.lexsort((owner, grams))
        grams, owner = grams[order], owner[order]
        once = _runs(grams, owner)
        grams, owner = grams[once], owner[once]
        runs = np.diff(np.r_[_runs(grams), len(grams)])
        df = np.repeat(runs, runs)
        many = df > 1
        grams, owner, df = grams[many] | np.uint64(table["bucket"][0].as_py() << 48), owner[many], df[many].astype("u4")
        bucket = (keys[place].view([("a", "u8"), ("b", "u8")])["a"] & np.uint64((1 << bits) - 1)).astype("i4")[owner] if len(owner) else owner.astype("i4")
        order = np.lexsort((owner, bucket))
        rows = _packed_rows(bucket[order], owner[order], keys[place], sizes[place], {"grams": grams[order], "df": df[order]})
        return pa.table({c: pa.array(v, pa.int32() if c == "bucket" else pa.binary()) for c, v in rows.items()})

    return dealt.groupBy("bucket").applyInArrow(share, f"{PACKED}, grams binary, df binary")


def ordered_classes(shared: DataFrame, percent: int) -> DataFrame:
    """class_key, n_ngrams, grams (its shared hashes, rare ones first), n_prefix, bitmap.

    Only classes whose prefix holds a shared hash: no other can link. `bitmap`
    has a bit for each value that ten bits of a shared hash take: 1,024 bits in 16 numbers.
    """

    def arrange(table: pa.Table) -> pa.Table:
        keys, sizes, counts = _joined(table, "keys", "V16"), _joined(table, "sizes", "u4"), _joined(table, "counts", "u4")
        number, place = _numbered(keys)
        owner = np.repeat(number, counts)
        grams, df = _joined(table, "grams", "u8"), _joined(table, "df", "u4")
        order = np.lexsort((grams, df, owner))
        grams, owner = grams[order], owner[order]
        starts = _runs(owner)
        out: dict[str, list] = {c: [] for c in ("class_key", "n_ngrams", "grams", "n_prefix", "bitmap")}
        for a, b in zip(starts, np.r_[starts[1:], len(owner)][: len(starts)], strict=True):
            i = place[owner[a]]
            size = int(sizes[i])
            own = size - int(b - a)  # n-grams that no other class has: rarer than any of these
            prefix = size - -(-percent * size // 100) + 1 - own
            if prefix > 0:
                out["class_key"].append(keys[i].tobytes())
                out["n_ngrams"].append(size)
                out["grams"].append(grams[a:b].tobytes())
                out["n_prefix"].append(min(prefix, int(b - a)))
                bits_set = np.zeros(1024, "u1")
                bits_set[(grams[a:b] & np.uint64(1023)).astype("i8")] = 1
                out["bitmap"].append(np.packbits(bits_set).view("i8").tolist())
        kinds = {"n_ngrams": pa.int32(), "n_prefix": pa.int32(), "bitmap": pa.list_(pa.int64())}
        return pa.table({c: pa.array(v, kinds.get(c, pa.binary())) for c, v in out.items()})

    return shared.groupBy("bucket").applyInArrow(arrange, "class_key binary, n_ngrams int, grams binary, n_prefix int, bitmap array<bigint>")


def prefix_rows(ordered: DataFrame) -> DataFrame:
    """gram, class_key, n (n-grams), pos (the gram's place among them, rare ones first), shared (n-grams that other classes have), bitmap."""

    @F.arrow_udf("array<struct<gram: bigint, pos: int>>")
    def prefixes(grams: pa.Array, n_prefix: pa.Array, n_ngrams: pa.Array) -> pa.Array:
        rows = []
        for raw, p, n in zip(grams.to_pylist(), n_prefix.to_pylist(), n_ngrams.to_pylist(), strict=True):
            own = n - len(raw) // 8
            rows.append([{"gram": g, "pos": own + i} for i, g in enumerate(np.frombuffer(raw, "i8")[:p].tolist())])
        return pa.array(rows, pa.list_(pa.struct([("gram", pa.int64()), ("pos", pa.int32())])))

    inner = ordered.select(
        "class_key", F.col("n_ngrams").alias("n"), (F.length("grams") / 8).cast("int").alias("shared"), "bitmap", F.explode(prefixes("grams", "n_prefix", "n_ngrams")).alias("p")
    )
    return inner.select("p.gram", "class_key", "n", "p.pos", "shared", "bitmap")


def may_link(percent: int) -> Column:
    """Length, positional and suffix filters for a prefix hash that two classes, a_... and b_..., share.

    The suffix filter bounds what the classes can have in common from above: a bit
    that only one bitmap has stands for an n-gram that the other class lacks.
    """
    n, m = F.col("a_n").cast("long"), F.col("b_n").cast("long")
    least = percent * (n + m)
    behind = F.least(n - F.col("a_pos"), m - F.col("b_pos"))

    def alone(x: str, y: str) -> Column:
        parts = [F.bit_count(F.get(f"{x}_bitmap", F.lit(i)).bitwiseAND(F.bitwise_not(F.get(f"{y}_bitmap", F.lit(i))))) for i in range(16)]
        return sum(parts[1:], parts[0])

    return (
        (100 * F.least(n, m) >= percent * F.greatest(n, m))
        & ((100 + percent) * behind >= least)
        & ((100 + percent) * (F.col("a_shared") - alone("a", "b")) >= least)
        & ((100 + percent) * (F.col("b_shared") - alone("b", "a")) >= least)
    )


def verified(pairs: DataFrame, ordered: DataFrame, percent: int) -> DataFrame:
    """a, b: the pairs that reach the threshold; each pair is verified once."""

    @F.arrow_udf("boolean")
    def reaches(a: pa.Array, b: pa.Array, n: pa.Array, m: pa.Array) -> pa.Array:
        found = []
        for x, y, i, j in zip(a.to_pylist(), b.to_pylist(), n.to_pylist(), m.to_pylist(), strict=True):
            both = len(np.intersect1d(np.frombuffer(x, "u8"), np.frombuffer(y, "u8"), assume_unique=True))
            found.append(100 * both >= percent * (i + j - both))
        return pa.array(found, pa.bool_())

    once = pairs.select(F.least("a_class_key", "b_class_key").alias("a"), F.greatest("a_class_key", "b_class_key").alias("b")).distinct()
    sets = ordered.select("class_key", "grams", "n_ngrams")
    with_a = once.join(sets.withColumnsRenamed({"class_key": "a", "grams": "a_grams", "n_ngrams": "a_n"}), "a")
    with_b = with_a.join(sets.withColumnsRenamed({"class_key": "b", "grams": "b_grams", "n_ngrams": "b_n"}), "b")
    return with_b.where(reaches("a_grams", "b_grams", "a_n", "b_n")).select("a", "b")


def linked_classes(ordered: DataFrame, percent: int) -> DataFrame:
    """node (class key), label: the groups of classes that links connect.

    First each class meets one other in each of its prefix hashes only, the next
    in an order that differs from hash to hash; that joins most of a group of
    near copies at a cost in proportion to its members. Then the pairs across the
    groups so found follow: of a hash's classes, those outside its commonest
    group meet all.
    """
    spark = ordered.sparkSession
    folder = shared_folder(spark, "similar")
    rows = prefix_rows(ordered)

    def side(name: str) -> list[Column]:
        return [F.col(c).alias(f"{name}_{c}") for c in rows.columns if c != "gram"]

    in_order = Window.partitionBy("gram").orderBy(F.xxhash64("gram", "class_key"), "class_key")
    others = [F.lead(c).over(in_order).alias(f"b_{c}") for c in rows.columns if c != "gram"]
    near = rows.select(*side("a"), *others).where("b_class_key is not null")
    verified(near.where(may_link(percent)), ordered, percent).write.parquet(f"{folder}/first")
    first = spark.read.parquet(f"{folder}/first")
    groups = smallest_label(first)
    placed = rows.join(groups, rows.class_key == groups.node, "left").select(*rows.columns, F.coalesce("label", "class_key").alias("label"))
    common = placed.groupBy("gram").agg(F.mode("label", True).alias("common"), F.min("label").alias("low"), F.max("label").alias("high"))
    mixed = placed.join(common.where("low <> high").select("gram", "common"), "gram")
    a = mixed.select("gram", "common", *side("a"), F.col("label").alias("a_label"))
    b = mixed.where("label <> common").select("gram", *side("b"), F.col("label").alias("b_label"))
    # Of two classes outside the commonest group, the smaller is on the left.
    met = (F.col("a_label") != F.col("b_label")) & ((F.col("a_label") == F.col("common")) | (F.col("a_class_key") < F.col("b_class_key")))
    across = a.join(b, (a.gram == b.gram) & met & may_link(percent))
    verified(across, ordered, percent).write.parquet(f"{folder}/second")
    return smallest_label(first.unionByName(spark.read.parquet(f"{folder}/second")))


def similar_groups(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash, class_key, n_ngrams, component_id: of every row, its set's size and the smallest id that links reach."""
    spark = docs.sparkSession
    folder = shared_folder(spark, "similar")
    bits = min(16, max(6, (int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length()))
    dealt = dealt_hashes(docs, n, bits, text_col)
    ordered_classes(shared_hashes(dealt, bits), percent).write.parquet(f"{folder}/classes")
    groups = linked_classes(spark.read.parquet(f"{folder}/classes"), percent)
    rows = classes(docs, n, id_col, text_col)
    named = rows.join(groups, rows.class_key == groups.node, "left").select(
        "doc_id", "text_hash", "class_key", "n_ngrams", F.when(F.col("n_ngrams") > 0, F.coalesce("label", "class_key")).alias("label")
    )
    ids = named.where("label is not null").groupBy("label").agg(F.min("doc_id").alias("component_id"))
    return named.join(ids, "label", "left").select(
        "doc_id",
        "text_hash",
        "class_key",
        "n_ngrams",
        F.when(F.col("n_ngrams") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def one_of_each(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, with all their columns, of which each group keeps the one with the smallest id.

    Rows of equal id and text count as one document. Of documents without words
    all stay, and so do those without an id unless one with an id links with them.
    """
    groups = similar_groups(docs, n, percent, id_col, text_col)
    keepers = groups.where(F.col("component_id").eqNullSafe(F.col("doc_id")) | F.col("component_id").isNull())
    keepers = keepers.select(F.struct(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash")).alias("__key")).distinct()
    keyed = docs.withColumn("__own_key", F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("hash")))
    kept = keyed.join(keepers, keyed["__own_key"] == keepers["__key"], "left_semi")
    again = F.row_number().over(Window.partitionBy("__own_key").orderBy("__own_key"))
    return kept.withColumn("__again", again).where(F.col("__again") == 1).select(*(F.col(f"`{c}`") for c in docs.columns))
