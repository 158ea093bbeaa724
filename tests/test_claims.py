"""Claims, leases, retries and dead letters."""

import threading

from pyspark.sql import functions as F

from postmill.operators import claims as CL
from postmill.session import work_dir


def at(minute):
    return (F.lit("2024-06-01 12:00:00").cast("timestamp") + F.expr(f"interval {minute} minutes"))


def ids(df):
    return sorted(r.id for r in df.collect())


def test_claims_never_share_rows_and_can_be_repeated(spark):
    path, queue = work_dir(spark, "claims"), spark.range(10)
    a = ids(CL.claim(queue, path, "a", "x", 4, at(0), 600))
    b = ids(CL.claim(queue, path, "b", "y", 4, at(1), 600))
    assert a == [0, 1, 2, 3] and b == [4, 5, 6, 7]
    assert ids(CL.claim(queue, path, "a", "x", 4, at(2), 600)) == a
    assert ids(CL.claim(queue, path, "c", "z", 4, at(2), 600)) == [8, 9]
    assert ids(CL.claim(queue, path, "d", "z", 4, at(2), 600)) == []


def test_expired_leases_come_back_and_die_in_the_end(spark):
    path, queue = work_dir(spark, "claims"), spark.range(3)
    for number in range(3):
        got = CL.claim(queue, path, f"c{number}", "x", 5, at(20 * number), 600, max_tries=3).collect()
        assert sorted((r.id, r.tries) for r in got) == [(i, number + 1) for i in range(3)]
    assert ids(CL.claim(queue, path, "late", "x", 5, at(60), 600, max_tries=3)) == []
    assert sorted((r.id, r.tries) for r in CL.dead_letters(spark, path).collect()) == [(0, 3), (1, 3), (2, 3)]


def test_acknowledgements(spark):
    path, queue = work_dir(spark, "claims"), spark.range(6)
    CL.claim(queue, path, "a", "x", 4, at(0), 600)
    done = spark.createDataFrame([(0,), (1,), (5,)], "id bigint")
    assert ids(CL.acknowledge(done, path, "a", at(1))) == [2, 3]
    assert ids(CL.acknowledge(done, path, "a", at(1))) == [2, 3]
    left = queue.filter("id > 1")
    assert ids(CL.claim(left, path, "b", "y", 9, at(20), 600)) == [2, 3, 4, 5]
    # the first owner comes late: its rows are another's now
    assert ids(CL.acknowledge(spark.createDataFrame([(2,)], "id bigint"), path, "a", at(21))) == [2, 3, 4, 5]
    assert ids(CL.acknowledge(left, path, "b", at(21))) == []


def test_released_rows_are_free_at_once(spark):
    path, queue = work_dir(spark, "claims"), spark.range(3)
    CL.claim(queue, path, "a", "x", 2, at(0), 600)
    CL.release(spark.createDataFrame([(1,)], "id bigint"), path, "a", at(1))
    got = CL.claim(queue, path, "b", "y", 5, at(2), 600).collect()
    assert sorted((r.id, r.tries) for r in got) == [(1, 2), (2, 1)]


def test_a_second_writer_takes_the_new_state(spark, monkeypatch):
    """Another claim is published between reading the state and publishing one's own."""
    path, queue = work_dir(spark, "claims"), spark.range(6)
    publish, calls = CL._publish, []

    def late(spark_, path_, number, folder):
        calls.append(number)
        if len(calls) == 1:
            monkeypatch.setattr(CL, "_publish", publish)
            other = threading.Thread(target=lambda: CL.claim(queue, path, "other", "y", 2, at(0), 600).collect())
            other.start()
            other.join()
        return publish(spark_, path_, number, folder)

    monkeypatch.setattr(CL, "_publish", late)
    assert ids(CL.claim(queue, path, "mine", "x", 2, at(0), 600)) == [2, 3]
    assert sorted((r.id, r.claim_id) for r in CL.state(spark, path).collect()) == [(0, "other"), (1, "other"), (2, "mine"), (3, "mine")]


def test_old_versions_go(spark):
    path = work_dir(spark, "claims")
    for n in range(12):
        CL.claim(spark.range(n + 1), path, f"c{n}", "x", 1, at(0), 600).collect()
    assert len(ids(CL.state(spark, path))) == 12
