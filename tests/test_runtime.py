import os
from types import SimpleNamespace

import pytest
from statloom import runtime


def test_the_shared_folder_is_the_one_that_the_session_names(spark):
    named = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: "hdfs://x/shared" if k == "spark.checkpoint.dir" else d))
    assert runtime.shared_dir(named) == "hdfs://x/shared"
    assert runtime.shared_dir(spark) and runtime.shared_dir(spark) == runtime.shared_dir(spark)


def test_scratch_tables_go(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(runtime, "shared_dir", lambda _: f"file://{tmp_path}/shared")
    left = lambda: [f for _, _, files in os.walk(tmp_path) for f in files if f.endswith(".parquet")]
    runtime.clear(spark)
    df = runtime.materialize(spark.range(10), "numbers")
    assert df.count() == 10 and left()
    runtime.release(df)
    assert not left()
    runtime.materialize(spark.range(3), "numbers")
    runtime.clear(spark)
    assert not left()


def test_empty_results_can_be_written_and_read(spark):
    assert runtime.materialize(spark.range(0), "none").count() == 0


def test_slots(spark):
    assert runtime.slots(spark) == 4 and runtime.slots(spark, 9) == 9


def unnamed(master):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: d), sparkContext=SimpleNamespace(getConf=lambda: {}, master=master))


def test_a_folder_of_our_own_on_one_machine_alone():
    assert runtime.shared_dir(unnamed("local[4]")).startswith("file:///") and runtime.shared_dir(unnamed("local")) == runtime.shared_dir(unnamed("local[*]"))
    for master in ("yarn", "spark://h:7077", "local-cluster[3,2,3000]"):
        with pytest.raises(RuntimeError):
            runtime.shared_dir(unnamed(master))
