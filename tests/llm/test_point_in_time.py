"""Point-in-time features against brute force, with clients cut into slices and not."""

import math
import random
from datetime import datetime, timedelta

import pytest

from pairscore.llm.point_in_time import DAY, MEASURES, point_in_time

CLICKS = "click_id long, ts timestamp_ntz, arrived_at timestamp_ntz, client_id long, kind string, value double, props string"
SALES = "sale_id long, client_id long, status string, total double, sold_at timestamp_ntz, arrived_at timestamp_ntz, priority int"
LINES = "sale_id long, line_no int, item_id long, vendor_id long, quantity int, amount double, discount double, flag string, shipped_at timestamp_ntz"
MOMENTS = "client long, id long, t_us long"
START = datetime(2024, 3, 29)


def us(t):
    return (t - datetime(1970, 1, 1)) // timedelta(microseconds=1)


def made(seed, n):
    """Few clients, close times, many ties, nulls everywhere, full repeats, dates that slices begin with."""
    rnd = random.Random(seed)
    maybe = lambda v, p=0.05: None if rnd.random() < p else v
    time = lambda: START + timedelta(seconds=rnd.choice([3600, 43_200, 7]) * rnd.randrange(0, 900))
    late = lambda t: maybe(None if t is None else t + timedelta(seconds=rnd.choice([0, 60, 40_000, 300_000])))
    client = lambda: maybe(rnd.choice([1, 1, 1, 2, 3]))
    clicks, sales, lines = [], [], []
    for i in range(n):
        t = maybe(time())
        clicks.append((maybe(i // 2), t, late(t), client(), maybe(rnd.choice(["click", "purchase"])), maybe(rnd.choice([1.005, -3.335, float("nan"), 7.0])), "{}"))
    clicks += clicks[: n // 5]
    for i in range(n // 2):
        t = maybe(time())
        sales.append((i, client(), "open", maybe(rnd.random() * 100), t, late(t), 1))
    for _ in range(n):
        shipped = maybe(START + timedelta(days=rnd.randrange(0, 30)))
        lines.append((maybe(rnd.randrange(n // 2)), 1, maybe(rnd.randrange(4)), 1, 1, maybe(rnd.random() * 50), 0.0, "kept", shipped))
    lines += lines[: n // 5]
    moments = [(s[1], s[0], us(s[4]) + rnd.choice([0, 5, 200_000]) * 1_000_000) for s in sales if s[4] is not None]
    return clicks, sales, lines, moments + moments[:3] + [(None, 5, 5), (1, 6, None)]


def brute(clicks, sales, lines, moments, windows=(2, 14), delay=240, horizon=7):
    def to_cents(x):
        return 0 if x is None or not math.isfinite(x) else math.floor(100 * x + 0.5)

    rows = []
    once = list({tuple("nan" if isinstance(v, float) and math.isnan(v) else v for v in c): c for c in clicks}.values())
    wait = delay * 60_000_000
    for client, id_, t in moments:
        if client is None or t is None:
            continue
        label = any(s[1] == client and s[4] is not None and t < us(s[4]) <= t + horizon * DAY for s in sales)
        for d in windows:
            within = lambda ts, known: ts is not None and known is not None and t - d * DAY < us(ts) <= t and us(known) + wait <= t  # noqa: B023, E731
            c = [x for x in once if x[3] == client and within(x[1], x[2])]
            s = [x for x in sales if x[1] == client and within(x[4], x[5])]
            ids = {x[0] for x in s}
            n = [x for x in lines if x[0] in ids and x[8] is not None and us(x[8]) <= t]
            last = max(((x[1], x[0] is not None, x[0] or 0, x[0]) for x in c), default=(None,))[-1]
            rows.append((id_, d, t, label, len(c), sum(x[4] == "purchase" for x in c), sum(to_cents(x[5]) for x in c), last, len(s), sum(to_cents(x[3]) for x in s), len(n), len({x[2] for x in n if x[2] is not None}), sum(to_cents(x[5]) for x in n)))
    return rows


def got(spark, clicks, sales, lines, moments, **options):
    found = point_in_time(spark.createDataFrame(moments, MOMENTS), spark.createDataFrame(clicks, CLICKS), spark.createDataFrame(sales, SALES), spark.createDataFrame(lines, LINES), **options)
    return [tuple(r) for r in found.select("id", "d", "t_us", "label", *MEASURES).collect()]


def order(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize(("slice_rows", "few"), [(50_000, 5_000), (40, 5_000), (3, 5_000), (3, 0)])
def test_against_brute_force(spark, slice_rows, few):
    given = made(slice_rows, 160)
    assert order(got(spark, *given, slice_rows=slice_rows, few=few)) == order(brute(*given))


@pytest.mark.parametrize("seed", [1, 2])
def test_other_windows(spark, seed):
    given = made(seed, 120)
    options = {"windows": (1, 3, 30), "horizon_days": 2}
    assert order(got(spark, *given, slice_rows=10, delay_minutes=0, **options)) == order(brute(*given, (1, 3, 30), 0, 2))


def test_one_instant(spark):
    """All facts of a client at one moment, which is also where a slice begins."""
    t = START
    clicks = [(i, t, t, 1, "purchase", 1.0, "{}") for i in range(50)]
    sales = [(i, 1, "open", 2.0, t, t, 1) for i in range(20)]
    lines = [(i % 20, 1, i % 3, 1, 1, 1.0, 0.0, "kept", t) for i in range(60)]
    moments = [(1, i, us(t) + k * DAY) for i, k in enumerate([0, 1, 2, 13, 14, 15])]
    for slice_rows in (5, 1_000):
        assert order(got(spark, clicks, sales, lines, moments, slice_rows=slice_rows)) == order(brute(clicks, sales, lines, moments))


def test_empty_tables(spark):
    assert got(spark, [], [], [], []) == []
    assert got(spark, [], [], [], [(1, 2, 3)]) == [(2, d, 3, False, 0, 0, 0, None, 0, 0, 0, 0, 0) for d in (2, 14)]


def test_extra_columns(spark):
    clicks, sales, lines, moments = made(9, 60)
    frames = [spark.createDataFrame(r, s) for r, s in ((moments, MOMENTS), (clicks, CLICKS), (sales, SALES), (lines, LINES))]
    want = [tuple(r) for r in point_in_time(*frames).collect()]
    for name in ("at", "known", "parts", "client", "salt", "place"):
        frames = [f if name in f.columns else f.selectExpr("*", f"1 AS {name}") for f in frames]
    assert order([tuple(r) for r in point_in_time(*frames, slice_rows=10).collect()]) == order(want)


def test_times_do_not_depend_on_the_session_zone(spark):
    given = made(4, 60)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert order(got(spark, *given)) == order(brute(*given))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
