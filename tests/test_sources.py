import pytest

from corvane import session
from checkset.spread import spread
from corvane.sources.lines import count_lines, lines_from, read_lines
from corvane.session import release, shared_folder
from corvane.sources.results import ResultStore, reused
from corvane.sources.tables import read_user_groups


def test_lines_from_files_and_rows(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\n\ntwo\n")
    (tmp_path / "b.txt").write_text("three")
    assert sorted(r["value"] for r in read_lines(spark, str(tmp_path)).collect()) == ["", "one", "three", "two"]
    assert count_lines(read_lines(spark, str(tmp_path))).first()["n"] == 4
    assert count_lines(lines_from(spark, ["x", None])).first()["n"] == 2


def test_results_are_named_and_replaced(spark, tmp_path):
    store = ResultStore(spark, str(tmp_path / "out"))
    store.write("n", spark.createDataFrame([(1,)], "n bigint"))
    written = store.write("n", spark.createDataFrame([(2,)], "n bigint"))
    assert written.first()["n"] == store.read("n").first()["n"] == 2
    parts = store.write("p", spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int"), partition_by="k")
    assert parts.columns == ["v", "k"] and parts.filter("k = 'b'").first()["v"] == 2


def test_user_groups(spark, tmp_path):
    df = spark.createDataFrame([("7", 3)], "user_id string, group_id int")
    df.write.parquet(str(tmp_path / "g"))
    assert [tuple(r) for r in read_user_groups(spark, str(tmp_path / "g")).collect()] == [("7", 3)]


def test_shared_folder_is_the_one_the_session_names(spark):
    a, b = session.shared_folder(spark, "x"), session.shared_folder(spark, "x")
    assert a != b and a.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_spread_leaves_inputs_in_many_pieces_alone(spark):
    many = spark.range(0, 100, 1, 16)
    assert spread(many) is many
    few = spread(spark.range(0, 100, 1, 1))
    assert few.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism and few.count() == 100


def test_configure_sets_runtime_settings(spark):
    session.configure(spark)
    for key, value in session.RUNTIME_SETTINGS.items():
        assert spark.conf.get(key) == value
    with pytest.raises(Exception):
        spark.conf.get("spark.no.such.setting")


def test_released_folders_are_gone(spark):
    path = shared_folder(spark, "released")
    spark.range(3).write.parquet(path)
    shared_folder(spark, "never-written")
    assert release(spark) >= 1 and release(spark) == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_reused_tables_are_given_up(spark):
    with reused(spark.range(5)) as kept:
        assert kept.count() == 5 and kept.is_cached
    assert not kept.is_cached
