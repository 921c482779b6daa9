import pytest

from hustings import session
from hustings.command import dependency, main, root_of
from hustings.functions import names as N
from hustings.operators import relational as R
from hustings.sources import writers
from hustings.sources.writers import nested_map, write_csv


@pytest.mark.parametrize("argv", [[], ["run"], ["run", "q01_contest_counts", "/nowhere", "--output", "x"], ["wrap", "a.csv", "b.csv", "--output", "x"], ["wrap", "/nowhere.csv", "--output", "x"]])
def test_wrong_calls_end_before_anything_is_read(argv, capsys):
    with pytest.raises(SystemExit) as e:
        main(argv)
    assert e.value.code == 2


def test_root_and_dependencies(tmp_path):
    assert (root_of(__file__) / "hustings").is_dir() and root_of(tmp_path) is None
    with pytest.raises(SystemExit, match="missing dependency: no_such_module"):
        dependency("no_such_module", "this test")


def test_run_and_wrap(spark, tmp_path):
    spark.createDataFrame([(i, "a" * i) for i in range(3)], "n_nationkey int, n_name string").write.parquet(str(tmp_path / "nation.parquet"))
    spark.createDataFrame([(i, i % 2, 9950.0 + i) for i in range(9)], "c_custkey int, c_nationkey int, c_acctbal double").write.parquet(str(tmp_path / "customer.parquet"))
    assert main(["run", "q07_semi_in", str(tmp_path), "--output", str(tmp_path / "out.csv"), "--format", "csv"]) == 0
    lines = (tmp_path / "out.csv").read_text().splitlines()
    assert lines[0] == "n_nationkey,n_name" and len(lines) == 3
    assert main(["wrap", str(tmp_path / "out.csv"), "--output", str(tmp_path / "out.js")]) == 0
    assert (tmp_path / "out.js").read_text().startswith("window.TABLE = `n_nationkey,n_name")


def test_one_file_in_order(spark, tmp_path):
    write_csv(spark.range(50).repartition(4), str(tmp_path / "a.csv"), ["id"], ["id"], single=True)
    assert (tmp_path / "a.csv").read_text().split() == ["id", *map(str, range(50))]
    assert not [p for p in tmp_path.iterdir() if p.name.startswith(".a.csv-")]


def test_no_large_table_is_nested_into_one_task(spark, monkeypatch):
    monkeypatch.setattr(writers, "SINGLE_FILE_ROWS", 2)
    assert nested_map(spark.range(2), [], "id", "id", "id", "m").count() == 1
    with pytest.raises(ValueError):
        nested_map(spark.range(3), [], "id", "id", "id", "m")


def test_the_collation_ranks_marks_as_listed(spark):
    assert spark.range(1).select(R.in_order(N.PUNCTUATION)).first()[0] == list(range(1, len(N.PUNCTUATION) + 1))


def test_the_shared_folder_must_be_named_off_local_masters(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default: default)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())
