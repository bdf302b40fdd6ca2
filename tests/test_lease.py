"""One writer at a time."""

import threading
import time

import pytest
from pyspark.sql import functions as F

from voxloom.plans.lease import Held, Lease
from voxloom.plans.pipeline import Run


class Clock:
    now = 1000.0

    def __call__(self):
        return self.now


def test_one_holder_until_the_end_of_its_term(spark, tmp_path):
    clock = Clock()
    a, b = (Lease(spark, str(tmp_path), 10, name, clock) for name in "ab")
    with a.held():
        assert a.acquire() is a and a.holder() == ("a", 1010.0)
        with pytest.raises(Held, match="a holds"):
            b.acquire()
        clock.now += 8
        a.renew()
        clock.now += 8
        with pytest.raises(Held):
            b.acquire()
        clock.now += 8
        with pytest.raises(Held, match="ran out"):
            a.check()
        b.acquire()
        for lost in (a.check, a.renew, a.acquire):
            with pytest.raises(Held):
                lost()
    assert b.holder()[0] == "b"  # what a released wasn't its own any more
    b.release()
    assert b.holder() is None and a.acquire()


@pytest.mark.parametrize("ended", [False, True])
def test_of_many_writers_one_gets_it(spark, tmp_path, ended):
    clock = Clock()
    if ended:
        Lease(spark, str(tmp_path), 5, "old", clock).acquire()
        clock.now += 6
    for _ in range(5):
        won, writers, gate = [], [Lease(spark, str(tmp_path), 60, clock=clock) for _ in range(8)], threading.Barrier(8)

        def take(w, gate=gate, won=won):
            gate.wait()
            try:
                won.append(w.acquire())
            except Held:
                pass

        threads = [threading.Thread(target=take, args=(w,)) for w in writers]
        for t in threads:
            t.start()
        for t in threads:
            t.join()
        assert len(won) <= 1 and sum(w.holder() is not None and w.holder()[0] == w.owner for w in writers) == len(won)
        if won:
            won[0].release()


def test_two_runs_over_one_folder(spark, tmp_path):
    started, go = threading.Event(), threading.Event()

    def slow(df):
        started.set()
        go.wait(60)
        return df.withColumn("x", F.col("id") + 1)

    results = []
    first = Run(spark, str(tmp_path), [("slow", slow)])
    thread = threading.Thread(target=lambda: results.append(first.execute(spark.range(3)).count()))
    thread.start()
    started.wait(60)
    with pytest.raises(Held):
        Run(spark, str(tmp_path), [("slow", lambda df: df)]).execute(spark.range(3))
    go.set()
    thread.join(120)
    assert results == [3] and first.log().count() == 1
    assert Run(spark, str(tmp_path), [("slow", lambda df: 1 / 0)]).execute(spark.range(9)).count() == 3  # committed, and free again


def test_a_run_that_lost_its_lease_commits_nothing(spark, tmp_path):
    def slower_than_its_lease(df):
        time.sleep(0.6)
        Lease(spark, str(tmp_path), 60, "other").acquire()
        return df

    run = Run(spark, str(tmp_path), [("s", slower_than_its_lease)], lease_seconds=0.5)
    with pytest.raises(Held):
        run.execute(spark.range(3))
    assert run.log().count() == 0
