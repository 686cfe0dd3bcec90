from types import SimpleNamespace

import pytest

from pressroom.session import numbered, scratch_path, write_and_read


def session(master, setting):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: setting),
        sparkContext=SimpleNamespace(master=master),
    )


def test_scratch_is_the_named_folder_or_local():
    a, b = (scratch_path(session("yarn", "s3://shared/"), "x") for _ in range(2))
    assert a.startswith("s3://shared/pressroom/x-") and a != b
    assert "/pressroom-" in scratch_path(session("local[8]", None), "x")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(session("yarn", None), "x")


def test_write_and_read(spark):
    df = spark.range(10).withColumnRenamed("id", "n")
    back = write_and_read(df, "test")
    assert back.columns == ["n"] and back.count() == 10


def test_scratch_can_be_cleared(spark, monkeypatch, tmp_path):
    from pressroom import session

    monkeypatch.setattr(session, "scratch_path", lambda _, name: f"{tmp_path}/pressroom/{name}-1")
    write_and_read(spark.range(3), "test")
    assert [p.name for p in tmp_path.iterdir()] == ["pressroom"]
    assert session.clear_scratch(spark) and not list(tmp_path.iterdir())


def test_numbered_is_local(spark):
    df = numbered(spark, ["a", "b"], "i", "v")
    assert [tuple(r) for r in df.collect()] == [(0, "a"), (1, "b")]
    assert "LocalRelation" in df._jdf.queryExecution().optimizedPlan().toString()
