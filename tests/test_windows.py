"""Closed months and late rows of a stream against plain Python."""

import datetime as dt
import random
import shutil
from collections import defaultdict

from newsloom.streaming import windows as W

SCHEMA = "k string, ts timestamp, value double"


def feed(spark, tmp_path, batches, upto):
    (tmp_path / "in").mkdir(exist_ok=True)
    for n, rows in enumerate(batches[:upto]):
        if not (tmp_path / "in" / f"{n}.parquet").exists():
            spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("overwrite").parquet(str(tmp_path / "one"))
            shutil.copy(next((tmp_path / "one").glob("part-*")), tmp_path / "in" / f"{n}.parquet")
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))


def plain(batches, late=dt.timedelta(hours=1)):
    """Each run is one batch of rows; the watermark of a batch is that of all before it, and months close after a batch."""
    open_, closed, left, newest = defaultdict(lambda: [0, 0]), {}, [], None
    end = lambda m: dt.datetime(int(m[:4]) + (m[5:] == "12"), int(m[5:]) % 12 + 1, 1)
    for rows in batches:
        mark = newest - late if newest else dt.datetime(1970, 1, 1)
        for k, ts, v in rows:
            if k is None or ts is None:
                continue
            m = f"{ts:%Y-%m}"
            if end(m) <= mark:
                left.append((k, m, ts, v))
            else:
                open_[k, m][0] += 1
                open_[k, m][1] += round((v or 0) * 100)
            newest = max(newest or ts, ts)
        for (k, m), (n, c) in list(open_.items()):
            if end(m) <= newest - late:
                closed[k, m] = (n, c)
                del open_[k, m]
    return closed, sorted(left, key=str)


def batches_of_rows():
    rng = random.Random(1)
    day = lambda m, d, h=3: dt.datetime(2024, m, d, h)
    row = lambda m: (rng.choice("abc"), day(m, rng.randint(1, 28)), rng.choice([None, round(rng.uniform(-5, 5), 2)]))
    return [
        [row(1) for _ in range(60)],
        [row(m) for m in (1, 2, 2, 3) for _ in range(9)] + [(None, day(2, 2), 1.0), ("a", None, 1.0)],
        [("a", day(1, 5), 7.5), ("b", day(4, 1, 0), 1.0), ("c", day(2, 9), 2.0)],  # January and February are closed by now
        [row(5) for _ in range(5)] + [("zz", day(3, 31, 23), 1.0)],
        [("a", day(6, 30), 1.0)],
    ]


def test_months_close_once_and_late_rows_are_kept(spark, tmp_path):
    batches = batches_of_rows()
    for n in range(1, len(batches) + 1):
        W.keep_periods(W.closed_periods(feed(spark, tmp_path, batches, n), "k"), str(tmp_path / "t")).awaitTermination()
    closed, late = plain(batches)
    got = [tuple(r) for r in W.closed_table(spark, str(tmp_path / "t")).collect()]
    assert len(got) == len({r[:2] for r in got}) and {r[:2]: r[2:] for r in got} == closed
    assert sorted((tuple(r) for r in W.late_rows(spark, str(tmp_path / "t")).collect()), key=str) == late and late


def test_state_falls_when_months_close(spark, tmp_path):
    batches = [[("a", dt.datetime(2024, m, d), 1.0) for m in range(1, 7) for d in range(1, 28)], [("a", dt.datetime(2024, 7, 20), 1.0)]]
    held = []
    for n in (1, 2):
        query = W.keep_periods(W.closed_periods(feed(spark, tmp_path, batches, n), "k", salts=1), str(tmp_path / "t"))
        query.awaitTermination()
        held.append([p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]][-1])
    assert held[-1] <= held[0] and W.closed_table(spark, str(tmp_path / "t")).count() == 6
    assert query.recentProgress[-1]["stateOperators"][0]["customMetrics"].get("numDroppedRowsByWatermark", 0) == 0
