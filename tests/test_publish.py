"""Publication through views: no gap, all or none, recovery."""

import threading

import pytest
from pyspark.sql import functions as F

from ledgerlens.sources import publish
from ledgerlens.sources import tables as T


def write(spark, names, run, value, extra=False):
    for name in names:
        df = spark.range(3).select(F.lit(value).alias("v"), "id")
        T.write_table(df.withColumn("more", F.lit(1)) if extra else df, publish.version_name(name, run))


def values(spark, names):
    return [sorted({r.v for r in spark.table(n).collect()}) for n in names]


@pytest.fixture
def names(scratch_db):
    return [f"{scratch_db}.a", f"{scratch_db}.b"]


def test_publish_and_republish(spark, names):
    for i, run in enumerate(("r1", "r2", "r3")):
        write(spark, names, run, i, extra=i > 0)
        publish.publish(spark, names, run)
        assert values(spark, names) == [[i], [i]]
        assert publish.published(spark, names) == (run, f"r{i}" if i else "")
    assert not T.table_exists(spark, publish.version_name(names[0], "r1"))
    assert T.table_exists(spark, publish.version_name(names[0], "r2"))  # a slow reader can finish
    publish.unpublish(spark, names)
    assert not any(T.table_exists(spark, n) for n in names)


def killed_at(monkeypatch, step):
    run, calls = publish._run, []

    def dying(spark, sql):
        if len(calls) == step:
            raise KeyboardInterrupt("died")
        calls.append(sql)
        run(spark, sql)

    monkeypatch.setattr(publish, "_run", dying)


@pytest.mark.parametrize("step", range(7))
def test_death_at_each_step(spark, names, monkeypatch, step):
    """Two runs are published, the third dies: without any clean-up readers see
    all old or all new, and so they do after recovery."""
    for i, run in enumerate(("r1", "r2")):
        write(spark, names, run, i)
        publish.publish(spark, names, run)
    write(spark, names, "r3", 2, extra=True)
    killed_at(monkeypatch, step)
    with pytest.raises(KeyboardInterrupt):
        publish.publish(spark, names, "r3")
    monkeypatch.undo()
    want = [[1], [1]] if step < 3 else [[2], [2]]
    assert values(spark, names) == want
    publish.recover(spark, names)
    assert values(spark, names) == want
    assert spark.table(names[0]).columns == (["v", "id"] if step < 3 else ["v", "id", "more"])
    publish.discard(spark, names, "r3")
    assert values(spark, names) == want


@pytest.mark.parametrize("step", range(6))
def test_death_in_the_first_publication(spark, names, monkeypatch, step):
    write(spark, names, "r1", 5)
    killed_at(monkeypatch, step)
    with pytest.raises(KeyboardInterrupt):
        publish.publish(spark, names, "r1")
    monkeypatch.undo()
    publish.recover(spark, names)
    if step < 4:  # before the pointer names the run
        assert not any(T.table_exists(spark, n) for n in names)
    else:
        assert values(spark, names) == [[5], [5]]
    publish.publish(spark, names, "r1")
    assert values(spark, names) == [[5], [5]]


@pytest.mark.parametrize("step", range(8))
def test_plain_tables_are_taken_over(spark, names, monkeypatch, step):
    for name in names:
        T.write_table(spark.range(3).select(F.lit(-1).alias("v"), "id"), name)
    write(spark, names, "r1", 0)
    killed_at(monkeypatch, step)
    with pytest.raises(KeyboardInterrupt):
        publish.publish(spark, names, "r1")
    monkeypatch.undo()
    publish.recover(spark, names)
    assert values(spark, names) in ([[-1], [-1]], [[0], [0]])
    publish.publish(spark, names, "r1")
    assert values(spark, names) == [[0], [0]]


def test_reader_never_meets_a_gap(spark, names):
    write(spark, names, "r0", 0)
    publish.publish(spark, names, "r0")
    stop, seen, failures = threading.Event(), [], []

    def read():
        while not stop.is_set():
            try:
                seen.append(values(spark, names))
            except Exception as e:  # noqa: BLE001
                failures.append(e)

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for i in range(1, 5):
            write(spark, names, f"r{i}", i)
            publish.publish(spark, names, f"r{i}")
    finally:
        stop.set()
        reader.join()
    assert failures == []
    assert len(seen) > 1 and all(len(v) == 1 for both in seen for v in both)


def test_changed_type_is_refused(spark, names):
    write(spark, names, "r1", 1)
    publish.publish(spark, names, "r1")
    write(spark, names, "r2", "text")
    with pytest.raises(ValueError, match="column v"):
        publish.publish(spark, names, "r2")
    publish.discard(spark, names, "r2")
    assert values(spark, names) == [[1], [1]]
