import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from webglean.operators import traffic

START = datetime(2024, 1, 1)


def simulate(times, rate):
    """A token bucket stepped through one request after the other; times and grants in seconds."""
    tokens, updated, now, out = float(rate), 0.0, 0.0, []
    for t in times:
        now = max(now, t)
        tokens = min(rate, tokens + (now - updated) * rate)
        updated = now
        if tokens < 1:
            now += (1 - tokens) / rate
            tokens, updated = 1.0, now
        tokens -= 1
        out.append(now)
    return out


def log(spark, rows):
    shaped = [(k, START + timedelta(microseconds=t), i) for k, t, i in rows]
    return spark.createDataFrame(shaped, "key string, ts timestamp, seq int")


def test_full_bucket_then_steady(spark):
    waits = traffic.rate_schedule(log(spark, [("k", 0, i) for i in range(15)]), "key", "ts", "seq", 10).orderBy("seq").collect()
    assert [r.wait_us for r in waits] == [0] * 10 + [100_000 * i for i in range(1, 6)]
    assert waits[-1].granted_at - waits[-1].ts == timedelta(seconds=0.5)


def test_no_limit_and_impossible_rates(spark):
    df = log(spark, [("k", 0, i) for i in range(100)])
    assert traffic.rate_schedule(df, "key", "ts", "seq", 0).agg(F.max("wait_us")).first()[0] == 0
    with pytest.raises(ValueError):
        traffic.rate_schedule(df, "key", "ts", "seq", 0.5)


@pytest.mark.parametrize("hot_rows", [1_000_000, 40])
@pytest.mark.parametrize("rate", [1, 2.5, 7])
def test_schedule_equals_simulation(spark, rate, hot_rows):
    rng, rows = random.Random(rate), []
    for key, n in (("hot", 300), ("b", 30), ("c", 20), (None, 60), ("same", 50)):
        t = 0
        for _ in range(n):
            t += 0 if key == "same" else rng.choice([0, 0, 1000, 300_000, 900_000, 5_000_000])
            rows.append((key, t, len(rows)))
    got = traffic.rate_schedule(log(spark, rows), "key", "ts", "seq", rate, hot_rows).collect()
    assert len(got) == len(rows)
    waits = {r.seq: r.wait_us for r in got}
    for key in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == key]
        for (_, t, i), grant in zip(mine, simulate([r[1] / 1e6 for r in mine], rate)):
            assert waits[i] == pytest.approx(grant * 1e6 - t, abs=2)


@pytest.mark.parametrize("rate", [1, 2.5, 3, 6.1, 7, 11])
def test_split_keys_get_the_same_waits(spark, rate):
    rng, now, rows = random.Random(9), 0, []
    for i in range(3000):
        now += rng.choice([0, 0, 1, 33_333, 142_857, 700_001])
        rows.append(("k" if i % 3 else "l", now, i))
    df = log(spark, rows)
    whole, split = (
        {r.seq: r.wait_us for r in traffic.rate_schedule(df, "key", "ts", "seq", rate, n).collect()}
        for n in (1_000_000, 100)
    )
    assert whole == split


def test_rows_without_a_start_are_not_in_flight(spark):
    t = [START + timedelta(seconds=s) for s in range(6)]
    rows = [("k", t[0], t[4]), ("k", t[1], t[5]), ("k", None, t[0]), ("k", t[3], None)]
    df = spark.createDataFrame(rows, "key string, s timestamp, e timestamp")
    assert traffic.peak_in_flight(df, "key", "s", "e").first().peak == 3


def brute_peak(spans):
    steps = sorted([(s, 1) for s, _ in spans] + [(e, -1) for _, e in spans])
    high = now = 0
    for _, step in steps:
        now += step
        high = max(high, now)
    return high


@pytest.mark.parametrize("hot_rows", [1_000_000, 50])
def test_peak_equals_brute_force(spark, hot_rows):
    rng, spans = random.Random(3), {}
    for key, n in (("hot", 200), ("b", 10), (None, 40), ("one", 1)):
        starts = [rng.randint(0, 60) for _ in range(n)]
        spans[key] = [(s, s + rng.randint(0, 8)) for s in starts]
    rows = [(k, START + timedelta(seconds=s), START + timedelta(seconds=e)) for k, v in spans.items() for s, e in v]
    df = spark.createDataFrame(rows, "key string, s timestamp, e timestamp")
    got = {r.key: (r.peak, r.within_cap) for r in traffic.peak_in_flight(df, "key", "s", "e", 10, hot_rows).collect()}
    assert got == {k: (brute_peak(v), brute_peak(v) <= 10) for k, v in spans.items()}
    with pytest.raises(ValueError):
        traffic.peak_in_flight(df, "key", "s", "e", 0)
