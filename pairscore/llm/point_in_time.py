"""Features of clients as they were known at given moments, without looking ahead.

Clicks, sales and the lines of sales become known some time after they happen. A fact counts for a moment ``t`` and a
window of ``d`` days if it happened in ``(t - d, t]`` and was known by ``t``: it is active from ``at``, when it is known,
until ``ts + d``. All facts and all moments of a client are dealt to one place and sorted by time there
(``repartitionAndSortWithinPartitions``); a generator sweeps over them with a heap of what expires next, running sums, and
a map from items to how many active lines have them.

A client of more than ``slice_rows`` facts is cut into slices of time, each a group of its own: days, and days of many
facts into equal parts. Whatever happens exactly as a slice begins belongs to its boundary. A slice is seeded with the
rows that are active at its boundary: those that expire within it come one by one, all that outlive it as sums, which
prefix sums over the slices give; an item of which some line outlives the slice is in those sums too, and comes by itself
only where the slice has lines of it that come and go. So each fact is in a slice when it becomes active and in one per
window when it expires, however long it stays, and no group grows with the input, unless one instant does.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import Staged

DAY = 86_400_000_000  # microseconds
#: Facts from which on a client is cut into slices, and the facts that a slice should have at most.
SLICE_ROWS = 50_000
#: Rows that a task should sweep.
TASK_ROWS = 250_000
#: Clients cut into slices up to which their slices are broadcast (below 10 MB); more of them are joined by shuffling.
FEW = 5_000

SEED, HELD, CLICK, SALE, LINE, LABEL, MOMENT = range(7)
_FIRST = -(2**63)
_SALT = 64
_TWO_64 = 2**64
MEASURES = ("n_clicks", "n_purchases", "click_cents", "last_click_id", "n_sales", "sale_cents", "n_lines", "n_items", "line_cents")
_SUMS = ("n_clicks", "n_purchases", "click_cents", "n_sales", "sale_cents", "n_lines", "line_cents")


def micros(df: DataFrame, name: str) -> Column:
    """Microseconds since 1970 of a time, which is in UTC if it has no zone."""
    col = F.col(name)
    if dict(df.dtypes)[name] != "timestamp_ntz":
        return F.unix_micros(col)
    seconds = F.unix_date(col.cast("date")).cast("long") * 86_400 + F.hour(col) * 3_600 + F.minute(col) * 60
    return seconds * 1_000_000 + (F.extract(F.lit("SECONDS"), col) * 1_000_000).cast("long")


def cents(col: Column) -> Column:
    x = F.floor(100 * col.cast("double") + 0.5)
    finite = col.isNotNull() & ~F.isnan(col.cast("double")) & (F.abs(col.cast("double")) != float("inf"))
    return F.when(finite, x).otherwise(F.lit(0)).cast("long")


def _facts(moments: DataFrame, clicks: DataFrame, sales: DataFrame, lines: DataFrame, delay_us: int, horizon_us: int, longest_us: int) -> DataFrame:
    """kind, client, at, ts, id, n, cents: all that a sweep needs. A fact that is known too late for any window is left out."""
    seen = clicks.distinct()  # of fully equal rows one counts
    own = seen.select("client_id", micros(seen, "ts").alias("ts"), micros(seen, "arrived_at").alias("known"), "click_id", (F.col("kind") == "purchase").alias("bought"), cents(F.col("value")).alias("cents"))
    as_long = lambda *cols: [c.cast("long").alias(n) for c, n in zip(cols, ("client", "at", "ts", "id", "n", "cents"), strict=True)]
    kind = lambda k: F.lit(k).alias("kind")
    least = F.lit(_FIRST).cast("long")
    clicked = own.where("known is not null").select(kind(CLICK), *as_long(F.col("client_id"), F.greatest("ts", F.col("known") + delay_us), F.col("ts"), F.coalesce(F.col("click_id"), least), F.coalesce(F.col("bought").cast("long"), F.lit(0)), F.col("cents")))
    sold = sales.select("sale_id", F.col("client_id"), micros(sales, "sold_at").alias("ts"), micros(sales, "arrived_at").alias("known"), cents(F.col("total")).alias("cents"))
    sold = sold.where(F.col("client_id").isNotNull() & F.col("ts").isNotNull())
    at = F.greatest("ts", F.col("known") + delay_us)
    none = F.lit(0)
    bought = sold.where("known is not null").select(kind(SALE), *as_long(F.col("client_id"), at, F.col("ts"), none, none, F.col("cents")))
    coming = sold.select(kind(LABEL), *as_long(F.col("client_id"), F.col("ts") - horizon_us, F.col("ts"), none, none, none))
    # repeats are summed up before the join, so that a sale of very many lines sends one row for each item and day
    each = lines.where("sale_id is not null and shipped_at is not null").groupBy("sale_id", "item_id", micros(lines, "shipped_at").alias("shipped"))
    each = each.agg(F.count("*").alias("n"), F.sum(cents(F.col("amount"))).alias("line_cents"))
    with_sale = each.join(sold.where("known is not null").select("sale_id", "client_id", "ts", "known"), "sale_id")
    listed = with_sale.select(kind(LINE), *as_long(F.col("client_id"), F.greatest("ts", F.col("known") + delay_us, "shipped"), F.col("ts"), F.col("item_id"), F.col("n"), F.col("line_cents")))
    facts = clicked.unionByName(bought).unionByName(listed).where(F.col("client").isNotNull() & F.col("ts").isNotNull() & F.col("at").isNotNull() & (F.col("at") < F.col("ts") + longest_us))
    asked = moments.select(kind(MOMENT), *as_long(F.col("client"), F.col("t_us"), F.col("t_us"), F.col("id"), none, none))
    return facts.unionByName(coming).unionByName(asked)


def _day(us: Column) -> Column:
    return ((us - F.pmod(us, F.lit(DAY))) / F.lit(DAY)).cast("long")


def _place(us: Column, parts: Column) -> Column:
    """The place of a time: 2 k + 1 within slice k, 2 k if it is the moment at which k begins. Slices of a client rise with
    time; ``parts`` has the number of parts of its days."""
    day, within = _day(us), F.pmod(us, F.lit(DAY))
    n = F.coalesce(F.try_element_at(parts, day), F.lit(1)).cast("long")
    part = F.floor((within * n) / F.lit(DAY)).cast("long")  # below 2 ** 53: a day has 8.64e10 microseconds, n is at most 2 ** 16
    part = F.when(F.ceil(part * F.lit(DAY) / n).cast("long") > within, part - 1).otherwise(part)
    begins = F.ceil(part * F.lit(DAY) / n).cast("long")
    return 2 * (day * 65_536 + part) + F.when(within == begins, 0).otherwise(1)


def _meet(facts: DataFrame, clients: DataFrame, few: bool) -> DataFrame:
    """Facts with a row for each client to be cut, nulls for the others. Those rows are broadcast only if they are few,
    else copied so often that a client's facts meet them in many tasks."""
    if few:
        return facts.join(F.broadcast(clients), "client", "left")
    copies = clients.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALT - 1))))
    salted = facts.withColumn("salt", F.pmod(F.xxhash64("kind", "at", "id"), F.lit(_SALT)).cast("int"))
    return salted.join(copies, ["client", "salt"], "left").drop("salt")


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def _slices(facts: DataFrame, hot: DataFrame, few: bool, windows_us: Sequence[int], slice_rows: int) -> DataFrame:
    """client, parts: of each client to be cut, the parts of each of its days, by what becomes active, expires or is asked
    on it; one row with a null client stands for all others. Facts are counted by day before they are shuffled."""
    own, lasting = F.col("hot").isNotNull(), F.col("kind").isin(CLICK, SALE, LINE)
    ends = [F.when(own & lasting, _day(F.col("ts") + w)).alias(f"day{i}") for i, w in enumerate(windows_us)]
    told = _meet(facts, hot.withColumn("hot", F.lit(True)), few).select(F.when(own, F.col("client")).alias("client"), F.when(own, _day(F.col("at"))).alias("day"), *ends)
    names = ["day", *(f"day{i}" for i in range(len(windows_us)))]
    counted = told.groupBy("client", *names).agg(F.count("*").alias("n"))
    days = counted.select("client", "n", F.explode(F.array(*names)).alias("day")).groupBy("client", "day").agg(F.sum("n").alias("n"))
    parts = days.withColumn("parts", F.least(F.ceil(F.col("n") / slice_rows), F.lit(65_536)).cast("int"))
    return parts.groupBy("client").agg(F.map_from_entries(F.collect_list(F.when(F.col("day").isNotNull(), F.struct("day", "parts")))).alias("parts"))


_FACT = ("client", "at", "kind", "ts", "id", "n", "cents")


def _uncut(facts: DataFrame) -> DataFrame:
    return facts.select("client", F.lit(_FIRST).cast("long").alias("part"), "at", "kind", F.lit(-1).alias("w"), "ts", "id", "n", "cents", F.lit(None).cast("array<bigint>").alias("sums"))


def _placed(told: DataFrame, windows_us: Sequence[int]) -> DataFrame:
    """Facts with, for clients that are cut, the places where they become active and, if they do, expire from each window."""
    lasting = F.col("kind").isin(CLICK, SALE, LINE)
    ends = [F.when(F.col("parts").isNotNull() & lasting & (F.col("at") < F.col("ts") + w), _place(F.col("ts") + w, F.col("parts"))).alias(f"end{i}") for i, w in enumerate(windows_us)]
    cut = F.col("parts").isNotNull()
    return told.select(*_FACT, F.when(cut, _place(F.col("at"), F.col("parts"))).alias("place"), *ends, cut.cast("int").alias("cut"))


def _slice_of(place: Column) -> Column:
    return F.shiftright(place, 1)


def _cut(placed: DataFrame, n_windows: int) -> DataFrame:
    """client, part, at, kind, w, ts, id, n, cents, sums: what is swept, by client and part. ``w`` tells the only window
    that a row is for, -1 stands for all; ``sums`` is that of a seed."""
    none, first, zero = F.lit(None).cast("array<bigint>").alias("sums"), F.lit(_FIRST).cast("long").alias("at"), F.lit(0).cast("long")
    inside = placed.where((F.col("kind") == MOMENT) | (F.col("place") % 2 != 0)).select("client", _slice_of(F.col("place")).alias("part"), "at", "kind", F.lit(-1).alias("w"), "ts", "id", "n", "cents", none)
    expiring = [
        placed.where((F.col(f"end{i}") % 2 != 0) & (F.col(f"end{i}") > F.col("place"))).select("client", _slice_of(F.col(f"end{i}")).alias("part"), first, "kind", F.lit(i).alias("w"), "ts", "id", "n", "cents", none)
        for i in range(n_windows)
    ]
    held = _held(placed, n_windows)
    items = held.where("cov = 1 and own and place % 2 <> 0").select("client", _slice_of(F.col("place")).alias("part"), first, F.lit(HELD).alias("kind"), "w", zero.alias("ts"), F.col("item").alias("id"), zero.alias("n"), zero.alias("cents"), none)
    return _union([inside, *expiring, items, _sums(placed, held, n_windows)])


def _held(placed: DataFrame, n_windows: int) -> DataFrame:
    """client, w, item, place, own, cov, delta: where something of an item begins or ends, whether (1 or 0) some line of it
    is active from before that place until after it, and the difference to the place before. Between two such places
    nothing changes. ``own`` tells that a line becomes active or expires within that very slice."""
    lines, marks = placed.where((F.col("kind") == LINE) & F.col("id").isNotNull()), []
    for w in range(n_windows):
        own = lines.where(f"end{w} is not null").select("client", F.lit(w).alias("w"), F.col("id").alias("item"), "place", F.col(f"end{w}").alias("end"))
        mark = lambda place, until, is_own: own.select("client", "w", "item", place.alias("place"), until.alias("until"), F.lit(is_own).alias("own"))  # noqa: B023, E731
        never = F.lit(None).cast("long")
        marks += [mark(F.col("place"), never, True), mark(F.col("place") + 1, F.col("end"), False), mark(F.col("end"), never, True)]
    each = _union(marks).groupBy("client", "w", "item", "place").agg(F.max("until").alias("until"), F.max("own").alias("own"))
    order = Window.partitionBy("client", "w", "item").orderBy("place")
    until = F.max("until").over(order.rowsBetween(Window.unboundedPreceding, 0))
    covered = each.withColumn("cov", F.coalesce((until > F.col("place")).cast("int"), F.lit(0)))
    return covered.withColumn("delta", F.col("cov") - F.coalesce(F.lag("cov").over(order), F.lit(0)))


def _sums(placed: DataFrame, held: DataFrame, n_windows: int) -> DataFrame:
    """A seed for each slice in which something is asked: per window the sums over what outlives the slice and the number of
    items held throughout, the last click and the last coming sale so far. Facts are summed up by their places before they
    are shuffled; steps up and down follow from these sums."""
    zero = F.lit(0).cast("long")
    when = lambda k, value: F.coalesce(F.when(F.col("kind") == k, value), zero)
    one = F.lit(1).cast("long")
    weights = (when(CLICK, one), when(CLICK, F.col("n")), when(CLICK, F.col("cents")), when(SALE, one), when(SALE, F.col("cents")), when(LINE, F.col("n")), when(LINE, F.col("cents")))
    measured = [f"m{k}" for k in range(len(_SUMS))]
    # (ts, id) as one number, since only such are aggregated by hashing
    click = F.when(F.col("kind") == CLICK, F.col("ts").cast("decimal(20,0)") * F.expr(f"{_TWO_64}") + (F.col("id").cast("decimal(20,0)") - _FIRST))
    ends = [f"end{w}" for w in range(n_windows)]
    moves = placed.groupBy("client", "place", *ends).agg(*[F.sum(x).alias(m) for x, m in zip(weights, measured, strict=True)], F.max(click.cast("decimal(38,0)")).alias("click"), F.max(F.when(F.col("kind") == LABEL, F.col("ts"))).alias("sale"), F.max(F.col("kind") == MOMENT).alias("asked"))
    no_click, no_sale = F.lit(None).cast("decimal(38,0)").alias("click"), F.lit(None).cast("long").alias("sale")
    nothing = [zero.alias(m) for m in measured]
    any_ = F.lit(-1).alias("w")
    steps = [
        moves.select("client", (F.col("place") + 1).alias("place"), any_, *nothing, zero.alias("items"), "click", "sale", F.lit(False).alias("asked")),
        moves.where("asked").select("client", (_slice_of(F.col("place")) * 2 + 1).alias("place"), any_, *nothing, zero.alias("items"), no_click, no_sale, "asked"),
        held.where("delta <> 0").select("client", "place", "w", *nothing, F.col("delta").cast("long").alias("items"), no_click, no_sale, F.lit(False).alias("asked")),
    ]
    for w, end in enumerate(ends):
        lives = moves.where(F.col(end) > F.col("place"))
        for place, sign in ((F.col("place") + 1, 1), (F.col(end), -1)):
            steps.append(lives.select("client", place.alias("place"), F.lit(w).alias("w"), *[(F.col(m) * sign).alias(m) for m in measured], zero.alias("items"), no_click, no_sale, F.lit(False).alias("asked")))
    of = lambda w, c: F.sum(F.when(F.col("w") == w, F.col(c)).otherwise(zero))
    names = [f"s{w}_{m}" for w in range(n_windows) for m in (*measured, "items")]
    by_place = _union(steps).groupBy("client", "place").agg(*[of(w, m).alias(f"s{w}_{m}") for w in range(n_windows) for m in (*measured, "items")], F.max("click").alias("click"), F.max("sale").alias("sale"), F.max("asked").alias("asked"))
    so_far = Window.partitionBy("client").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    last = F.max("click").over(so_far)
    told = by_place.select("client", "place", "asked", *[F.sum(n).over(so_far).alias(n) for n in names], last.alias("last"), F.max("sale").over(so_far).alias("sale")).where("asked")
    last_ts = F.expr(f"(last - pmod(last, {_TWO_64})) div {_TWO_64}")
    last_id = (F.pmod(F.col("last"), F.expr(f"{_TWO_64}")) + _FIRST).cast("long")
    return told.select("client", _slice_of(F.col("place")).alias("part"), F.lit(_FIRST).cast("long").alias("at"), F.lit(SEED).alias("kind"), any_, zero.alias("ts"), zero.alias("id"), zero.alias("n"), zero.alias("cents"), F.array(*names, last_ts, last_id, "sale").alias("sums"))


def sweep(rows: Iterable[tuple], windows_us: Sequence[int]) -> Iterator[tuple]:
    """(id, t, label, measures of each window ...) for each moment, from ((client, part, at, kind), (w, ts, id, n, cents, sums))
    sorted by its first part. Memory is that of what is active at once."""
    windows = list(enumerate(windows_us))
    n = len(_SUMS) + 1
    group, serial = None, 0
    for (client, part, at, kind), (w, ts, id_, count, amount, given) in rows:
        if group != (client, part):
            group = (client, part)
            sums = [[0] * n for _ in windows]  # the last one counts items
            heaps: list[list[tuple]] = [[] for _ in windows]
            items: list[dict[int, int]] = [{} for _ in windows]
            last, coming = None, None
        if kind == MOMENT:
            out = [id_, at, coming is not None and coming > at]
            for i, length in windows:
                own, heap, held, gone = sums[i], heaps[i], items[i], at - length
                while heap and heap[0][0] <= gone:
                    _, _, what, item, k, c = heapq.heappop(heap)
                    if what == CLICK:
                        own[0] -= 1
                        own[1] -= k
                        own[2] -= c
                    elif what == SALE:
                        own[3] -= 1
                        own[4] -= c
                    else:
                        own[5] -= k
                        own[6] -= c
                        if item is not None:
                            left = held[item] - 1
                            if left:
                                held[item] = left
                            else:
                                del held[item]
                                own[7] -= 1
                # the latest click expires last
                latest = last[1] if last and last[0] > gone and last[1] != _FIRST else None
                out += own[0], own[1], own[2], latest, own[3], own[4], own[5], own[7], own[6]
            yield tuple(out)
        elif kind == LABEL:
            if coming is None or ts > coming:
                coming = ts
        elif kind == SEED:
            for i, _ in windows:
                sums[i] = list(given[i * n : i * n + n])
            last = None if given[-3] is None else (given[-3], given[-2])
            coming = given[-1]
        elif kind == HELD:
            items[w][id_] = 1  # counted by the seed, and never gone here
        else:
            if kind == CLICK and (last is None or (ts, id_) > last):
                last = (ts, id_)
            serial += 1
            for i, length in windows:
                if (w == i or w < 0) and ts + length > at:
                    own = sums[i]
                    heapq.heappush(heaps[i], (ts, serial, kind, id_, count, amount))
                    if kind == CLICK:
                        own[0] += 1
                        own[1] += count
                        own[2] += amount
                    elif kind == SALE:
                        own[3] += 1
                        own[4] += amount
                    else:
                        own[5] += count
                        own[6] += amount
                        if id_ is not None:
                            held = items[i]
                            if id_ in held:
                                held[id_] += 1
                            else:
                                held[id_] = 1
                                own[7] += 1


def point_in_time(
    moments: DataFrame, clicks: DataFrame, sales: DataFrame, lines: DataFrame,
    windows: Sequence[int] = (2, 14), delay_minutes: int = 240, horizon_days: int = 7, slice_rows: int = SLICE_ROWS, few: int = FEW,
) -> DataFrame:
    """Per moment (``client``, ``id``, ``t_us``, all long, in microseconds of UTC) and window of ``d`` days: ``id, d, t_us,
    label`` and the measures. ``label`` tells whether the client has a sale in ``(t, t + horizon_days]``, whenever it arrived.

    Moments without a client or time have no rows; repeated moments have rows each. Of fully equal clicks one counts; sales
    and lines count as often as they are there. Facts without a client, a time or an arrival, and lines without a sale or a
    date, count nowhere (a sale without arrival still counts for labels). A null or non-finite amount counts as 0 cents; a
    null click_id is the smallest, and given as null. Columns beyond those of the tables only tell clicks apart. Facts are
    written once to the shared folder."""
    windows_us = [d * DAY for d in windows]
    asked = moments.where(F.col("client").isNotNull() & F.col("t_us").isNotNull())
    staged = Staged(moments.sparkSession)
    facts = staged.keep(_facts(asked, clicks, sales, lines, delay_minutes * 60_000_000, horizon_days * DAY, max(windows_us)), dictionary=False)
    total = facts.count()
    hot = staged.keep(facts.groupBy("client").agg(F.count("*").alias("n")).where(F.col("n") > slice_rows).select("client"))
    n_hot = hot.count()
    rows = _uncut(facts)
    if n_hot:
        slices = staged.keep(_slices(facts, hot, n_hot <= few, windows_us, slice_rows)).where("client is not null")
        placed = staged.keep(_placed(_meet(facts, slices, n_hot <= few), windows_us), dictionary=False, by="cut")
        rows = _union([_uncut(placed.where("cut = 0")), _cut(placed.where("cut = 1"), len(windows_us))])
    n_parts = max(int(moments.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / TASK_ROWS))
    keyed = rows.rdd.map(lambda r: (r[:4], r[4:]))
    dealt = keyed.repartitionAndSortWithinPartitions(n_parts, lambda k: hash(k[:2]))
    swept = dealt.mapPartitions(lambda it: sweep(it, windows_us))
    fields = ", ".join(f"{m}_{i} long" for i in range(len(windows)) for m in MEASURES)
    wide = moments.sparkSession.createDataFrame(swept, f"id long, t_us long, label boolean, {fields}", verifySchema=False)
    each = [F.struct(F.lit(d).alias("d"), *[F.col(f"{m}_{i}").alias(m) for m in MEASURES]) for i, d in enumerate(windows)]
    return wide.select("id", "t_us", "label", F.inline(F.array(*each)))
