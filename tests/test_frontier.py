import datetime as dt
import random

from murmur.operators import frontier as fr
from murmur.schema import FRONTIER

EVENTS = "url string, seq bigint, kind string, date date"
DAY = dt.date(2024, 1, 1)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_seed_never_resets(spark):
    old = spark.createDataFrame([("1", DAY, "https://x/1", 1, 0, DAY)], FRONTIER)
    found = spark.createDataFrame(
        [("https://x/1", DAY, 9), ("https://x/2", DAY + dt.timedelta(1), 8), ("https://x/2", DAY, 7)], "url string, date date, seq bigint"
    )
    assert rows(fr.seed(old, found)) == [("1", DAY, "https://x/1", 1, 0, DAY), ("2", DAY, "https://x/2", 0, 0, None)]


def test_events_against_a_loop(spark):
    rng = random.Random(6)
    urls = [f"https://x/{i}" for i in range(12)]
    start = [(str(i), DAY, u, *rng.choice([(0, 0, None), (1, 2, DAY), (1, 0, DAY)])) for i, u in enumerate(urls)]
    events = [
        (rng.choice([*urls, urls[0], urls[0], "https://unknown"]), s, rng.choice(["ok"] * 7 + ["failed"]), DAY + dt.timedelta(s % 40))
        for s in range(200)
    ]
    state = {r[2]: list(r) for r in start}
    failed, late = set(), []
    for url, seq, kind, day in events:
        if url in failed:
            late.append((url, seq, kind, day))
            continue
        if kind == "failed":
            failed.add(url)
        row = state.get(url)
        if row is None or (row[3] == 1 and row[4] == 0):
            continue
        row[3], row[5] = 1, day
        row[4] = 0 if kind == "failed" else row[4] + 1
    log = spark.createDataFrame(events, EVENTS).repartition(4)
    out = fr.apply_events(spark.createDataFrame(start, FRONTIER), log)
    assert rows(out) == sorted((tuple(r) for r in state.values()), key=repr)
    got = fr.late_events(log).select("url", "seq", "kind", "date")
    assert rows(got) == sorted(late, key=repr)


def test_lists(spark):
    df = spark.createDataFrame(
        [("1", DAY, "b", 1, 3, DAY), ("2", DAY, "a", 1, 1, DAY), ("3", DAY, "c", 0, 0, None), ("4", DAY, "d", 1, 0, DAY)], FRONTIER
    )
    assert [r["url"] for r in fr.recheck(df).collect()] == ["a", "b"]
    assert [r["url"] for r in fr.pending(df).collect()] == ["c"]
