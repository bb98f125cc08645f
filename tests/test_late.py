from __future__ import annotations

import datetime as dt
import random
import tempfile

import pytest

from claimflow.streaming import late

HOUR = dt.timedelta(hours=1)
START = dt.datetime(2024, 1, 1)


class Feed:
    def __init__(self, spark):
        self.spark, self.root = spark, tempfile.mkdtemp(prefix="late-")

    def send(self, *rows):
        """Rows of (key, minutes since the start or None, value) as one batch."""
        full = [(k, None if m is None else START + dt.timedelta(minutes=m), v) for k, m, v in rows]
        df = self.spark.createDataFrame(full, "k string, ts timestamp, v int")
        df.coalesce(1).write.mode("append").parquet(f"{self.root}/in")
        self.run()

    def run(self, **kw):
        sdf = self.spark.readStream.schema("k string, ts timestamp, v int").parquet(f"{self.root}/in")
        late.dedup_with_late_rows(sdf, ["k"], "ts", HOUR, f"{self.root}/out", f"{self.root}/{kw.get('ckpt', 'ckpt')}")

    def got(self, outcome):
        return sorted(((r.k, r.v) for r in late.read_outcome(self.spark, f"{self.root}/out", outcome).collect()), key=repr)

    def counts(self):
        return sorted(map(tuple, late.read_counts(self.spark, f"{self.root}/out").collect()))


@pytest.fixture
def feed(spark):
    return Feed(spark)


def expected(batches):
    first, behind, seen, greatest = [], [], {}, None
    for rows in batches:
        mark = None if greatest is None else greatest - 60
        seen = {k: m for k, m in seen.items() if mark is None or m + 60 >= mark}
        on_time = [r for r in rows if r[1] is not None and (mark is None or r[1] >= mark)]
        behind += [(k, v) for k, m, v in rows if (k, m, v) not in on_time]
        for k, m, v in sorted(on_time, key=lambda r: (r[1], r[2])):
            if k not in seen:
                seen[k] = m
                first.append((k, v))
        greatest = max([m for _, m, _ in rows if m is not None] + ([greatest] if greatest is not None else []), default=None)
    return sorted(first, key=repr), sorted(behind, key=repr)


def test_random_batches(feed):
    rng = random.Random(3)
    batches = []
    for b in range(6):
        rows = [(f"k{rng.randint(0, 30)}", b * 40 + rng.randint(-100, 30), b * 100 + i) for i in range(40)]
        batches.append([*rows, ("none", None, b)])
        feed.send(*batches[-1])
    first, behind = expected(batches)
    assert feed.got("first") == first and feed.got("late") == behind
    assert len(behind) > 10
    for _, n, *parts in feed.counts():
        assert n == 41 == sum(parts)
    assert sum(c[2] for c in feed.counts()) == len(first) and sum(c[4] for c in feed.counts()) == len(behind)


def test_late_rows_carry_the_watermark(feed):
    feed.send(("a", 120, 1))
    feed.send(("a", 125, 2), ("b", 59, 3), ("c", 60, 4))
    assert feed.got("first") == [("a", 1), ("c", 4)] and feed.got("late") == [("b", 3)]
    row = late.read_outcome(feed.spark, f"{feed.root}/out", "late").first()
    assert row["_watermark"] == START + HOUR
    assert feed.counts() == [(0, 1, 1, 0, 0), (1, 3, 1, 1, 1)]


def test_a_batch_tried_again_counts_once(feed, monkeypatch):
    feed.send(("a", 0, 1), ("b", 5, 2))
    with monkeypatch.context() as m, pytest.raises(Exception):
        m.setattr(late, "publish", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        feed.send(("a", 1, 3), ("c", 2, 4))
    feed.run()
    assert feed.got("first") == [("a", 1), ("b", 2), ("c", 4)] and [c[1:] for c in feed.counts()] == [(2, 2, 0, 0), (2, 1, 1, 0)]
    feed.run(ckpt="other")  # the stream's log is lost after the batches were finished: nothing is written twice
    assert [c[0] for c in feed.counts()] == [0, 1] and len(feed.got("first")) == 3


def test_only_late_or_no_rows(feed, spark):
    feed.send(("a", None, 1))
    assert feed.got("first") == [] and feed.got("late") == [("a", 1)]
    feed.send((None, 5, 2), (None, 6, 3))
    assert feed.got("first") == [(None, 2)]
    with pytest.raises(FileNotFoundError):
        late.read_outcome(spark, f"{feed.root}/nothing", "first")
