"""Event behaviour: sessions, activity, retention, funnels, streaks, as-of, RFM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kelda.functions.ordered import (
    BUSY,
    CHUNK,
    as_of,
    chunk_time,
    fill_days,
    is_chunked,
    match,
    ordered,
    running_sum,
    sorted_ranks,
    tile_of,
)
from kelda.functions.times import micros, seconds
from kelda.sources.landing import publish
from kelda.sources.scratch import scratch_path

MICRO = 1_000_000


def _apart(later: str | Column, earlier: str | Column) -> Column:
    return micros(later) - micros(earlier)


def sessionize(
    ev: DataFrame, key: str, ts: str, gap: str, grain: str = "hour", busy: int = BUSY
) -> DataFrame:
    """Add ``session_start``; a session begins when the gap is greater than ``gap``.

    Where a key is cut into chunks, a chunk whose first event follows the previous chunk
    closely enough hands its first session the start it inherits; inheritance passes through
    chunks that are one session end to end.
    """
    limit = seconds(gap) * MICRO
    events = chunk_time(ev, [key], ts, grain, busy)
    order = ordered(events, [key], [ts])
    previous = F.lag(ts).over(order)
    begins = previous.isNull() | (_apart(ts, previous) > limit)
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    local = events.withColumn("_begin", F.when(begins, F.col(ts))).withColumn(
        "session_start", F.max("_begin").over(so_far)
    )
    if not is_chunked(events):
        return local.select(*ev.columns, "session_start")
    by_key = Window.partitionBy(key).orderBy(CHUNK)
    before = by_key.rowsBetween(Window.unboundedPreceding, -1)
    joined = F.coalesce(_apart("_first", F.lag("_last").over(by_key)) <= limit, F.lit(False))
    own = F.when(~F.col("_joined") | (F.col("_start") > F.col("_first")), F.col("_start"))
    chunks = (
        local.where(F.col(CHUNK).isNotNull())
        .groupBy(key, CHUNK)
        .agg(
            F.min(ts).alias("_first"),
            F.max(ts).alias("_last"),
            F.max("session_start").alias("_start"),
        )
        .withColumn("_joined", joined)
        .withColumn("_own", own)
        .withColumn("_inherited", F.last("_own", ignorenulls=True).over(before))
        .select(key, CHUNK, F.when(F.col("_joined"), F.col("_first")).alias("_first"), "_inherited")
    )
    start = F.when(
        F.col("session_start") == F.col("_first"), F.col("_inherited")
    ).otherwise(F.col("session_start"))
    return (
        match(local, chunks, [key, CHUNK])
        .withColumn("session_start", start)
        .select(*ev.columns, "session_start")
    )


def sessions(
    ev: DataFrame,
    key: str,
    ts: str,
    gap: str,
    measures: dict[str, Column] | None = None,
    grain: str = "hour",
    busy: int = BUSY,
) -> DataFrame:
    """One row per session: start, last event, number of events and further aggregates."""
    extra = [agg.alias(name) for name, agg in (measures or {}).items()]
    return sessionize(ev, key, ts, gap, grain, busy).groupBy(key, "session_start").agg(
        F.max(ts).alias("session_end"), F.count("*").alias("n_events"), *extra
    )


def user_days(ev: DataFrame, key: str, ts: str) -> DataFrame:
    """One row per key and active day: what the day-level metrics work on."""
    return ev.select(key, F.to_date(ts).alias("day")).distinct()


def _by_day(key: str):
    return Window.partitionBy(key).orderBy("day")


def active_users(ev: DataFrame, key: str, ts: str, days: Sequence[int]) -> DataFrame:
    """Exact distinct keys active in the last N days, for every day of the data.

    An active day covers itself and the N-1 days after it, up to the key's next active
    day, which covers on its own. A day's count is then a running sum of entries and exits:
    two rows per active day, not N.
    """
    covered = user_days(ev, key, ts).withColumn("_next", F.lead("day").over(_by_day(key)))
    moves = [
        F.struct(F.lit(n).alias("n"), at.alias("day"), F.lit(step).alias("step"))
        for n in days
        for at, step in (
            (F.col("day"), 1),
            (F.least(F.date_add("day", n), F.col("_next")), -1),
        )
    ]
    step = lambda n: F.when(F.col("m.n") == n, F.col("m.step"))
    net = (
        covered.select(F.explode(F.array(*moves)).alias("m"))
        .groupBy("m.day")
        .agg(
            F.max(F.when(F.col("m.step") == 1, F.col("m.day"))).alias("_active"),
            *[F.sum(step(n)).alias(f"_{n}") for n in days],
        )
    )
    # From here on there is one row per calendar day; exits may lie past the last active one.
    so_far = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (
        fill_days(net)
        .select(
            "day",
            *[F.coalesce(F.sum(f"_{n}").over(so_far), F.lit(0)).alias(f"active_{n}d") for n in days],
            F.max("_active").over(whole).alias("_last"),
        )
        .where(F.col("day") <= F.col("_last"))
        .drop("_last")
    )


def lifecycle(ev: DataFrame, key: str, ts: str, lapse_days: int) -> DataFrame:
    """State per key and day: new, continuing, returned, lapsed.

    Active days are ``new`` (the first), ``continuing`` (at most ``lapse_days`` after the
    one before) or ``returned``. ``lapsed`` is the day that completes ``lapse_days`` days
    without activity, if the data reaches that far.
    """
    by_day = _by_day(key)
    last_day = ev.agg(F.to_date(F.max(ts))).scalar()
    seen = (
        user_days(ev, key, ts)
        .withColumn("_prev", F.lag("day").over(by_day))
        .withColumn("_next", F.lead("day").over(by_day))
    )
    active = (
        F.when(F.col("_prev").isNull(), "new")
        .when(F.datediff("day", "_prev") <= lapse_days, "continuing")
        .otherwise("returned")
    )
    lapse = F.date_add("day", lapse_days)
    lapses = F.when(
        F.col("_next").isNull(), lapse <= last_day
    ).otherwise(F.col("_next") > lapse)
    states = F.array(
        F.struct(F.col("day").alias("day"), active.alias("state")),
        F.when(lapses, F.struct(lapse.alias("day"), F.lit("lapsed").alias("state"))),
    )
    return seen.select(key, F.explode(states).alias("s")).where("s is not null").select(
        key, "s.day", "s.state"
    )


def retention(ev: DataFrame, key: str, ts: str) -> DataFrame:
    """Active keys by first active day and days since then, with the cohort's size."""
    first = F.min("day").over(Window.partitionBy(key))
    aged = user_days(ev, key, ts).withColumn("cohort", first)
    counted = aged.groupBy("cohort", F.datediff("day", "cohort").alias("day_offset")).agg(
        F.count("*").alias("active")
    )
    # One row per cohort and offset: both are days.
    size = F.max(F.when(F.col("day_offset") == 0, F.col("active"))).over(
        Window.partitionBy("cohort")
    )
    return counted.withColumn("cohort_size", size)


def funnel(
    ev: DataFrame, key: str, ts: str, type: str, steps: Sequence[str], within: str, chunk: str = "1 day"
) -> DataFrame:
    """Furthest step per key that follows, in order and within T, some event of step 1.

    Steps follow one another at strictly later times; keys without step 1 do not appear.
    For each step the latest start that can reach it is carried along, which is all later
    steps need. Starts are handled in chunks of time: a chunk also sees the first T of the
    next one, and nothing later can matter to it. A chunk is never shorter than T.
    """
    limit = seconds(within) * MICRO
    width = max(seconds(chunk) * MICRO, limit)
    at = micros(ts)
    own = F.floor(at / width)
    places = F.when(at - own * width <= limit, F.array(own, own - 1)).otherwise(F.array(own))
    rows = (
        ev.where(F.col(type).isin(*steps))
        .select(key, F.col(type).alias("_type"), at.alias("_at"), own.alias("_own"), places.alias("_places"))
        .select(key, "_type", "_at", "_own", F.explode("_places").alias(CHUNK))
    )
    earlier = Window.partitionBy(key, CHUNK).orderBy("_at").rangeBetween(
        Window.unboundedPreceding, -1
    )
    here = F.col("_own") == F.col(CHUNK)
    rows = rows.withColumn("_s1", F.when(here & (F.col("_type") == steps[0]), F.col("_at")))
    for i, step in enumerate(steps[1:], start=2):
        rows = rows.withColumn("_start", F.max(f"_s{i - 1}").over(earlier))
        reached = (F.col("_type") == step) & (F.col("_at") - F.col("_start") <= limit)
        rows = rows.withColumn(f"_s{i}", F.when(reached, F.col("_start")))
    furthest = F.coalesce(
        *[F.when(F.col(f"_s{i}").isNotNull(), i) for i in range(len(steps), 0, -1)]
    )
    return (
        rows.groupBy(key).agg(F.max(furthest).alias("furthest")).where("furthest is not null")
    )


def funnel_counts(furthest: DataFrame, steps: Sequence[str]) -> DataFrame:
    """Keys that got at least as far as each step."""
    reached = F.sequence(F.lit(1), F.col("furthest"))
    names = F.array(*[F.lit(s) for s in steps])
    return (
        furthest.select(F.explode(reached).alias("step"))
        .groupBy("step")
        .agg(F.count("*").alias("n"))
        .select("step", F.element_at(names, F.col("step")).alias("name"), "n")
    )


def streaks(ev: DataFrame, key: str, ts: str) -> DataFrame:
    """Runs of consecutive active days."""
    place = F.row_number().over(_by_day(key))
    run = F.unix_date("day") - place
    return (
        user_days(ev, key, ts)
        .withColumn("_run", run)
        .groupBy(key, "_run")
        .agg(
            F.min("day").alias("first_day"),
            F.max("day").alias("last_day"),
            F.count("*").alias("days"),
        )
        .drop("_run")
    )


def transitions(
    ev: DataFrame, key: str, ts: str, type: str, tie: str, grain: str = "hour", busy: int = BUSY
) -> DataFrame:
    """How often each event type directly follows another, over all keys.

    Where a key is cut into chunks, pairs across chunk borders are counted apart and added.
    """
    events = chunk_time(ev.select(key, ts, type, tie), [key], ts, grain, busy)

    def pairs(rows: DataFrame, first: str, last: str, window) -> DataFrame:
        return rows.select(
            F.col(last).alias("from_type"),
            F.lead(first).over(window).alias("to_type"),
            F.lead(F.lit(True)).over(window).alias("_pair"),
        )

    found = pairs(events, type, type, ordered(events, [key], [ts, tie]))
    if is_chunked(events):
        order = F.struct(ts, tie)
        edges = events.where(F.col(CHUNK).isNotNull()).groupBy(key, CHUNK).agg(
            F.min_by(type, order).alias("_first"), F.max_by(type, order).alias("_last")
        )
        by_key = Window.partitionBy(key).orderBy(CHUNK)
        found = found.unionByName(pairs(edges, "_first", "_last", by_key))
    return found.where("_pair").groupBy("from_type", "to_type").agg(F.count("*").alias("n"))


def last_before(
    target: DataFrame,
    source: DataFrame,
    key: str,
    ts: str,
    values: Sequence[str],
    tie: str | None = None,
    prefix: str = "last_",
    grain: str = "hour",
    busy: int = BUSY,
) -> DataFrame:
    """Each target event with the latest source event at or before it; null where none."""
    found = as_of(target, source, (key, key), (ts, ts), values, "_found", grain, tie, busy)
    return found.select(
        *target.columns, *[F.col(f"_found.`{v}`").alias(f"{prefix}{v}") for v in values]
    )


def rfm(
    orders: DataFrame,
    as_of_day: Column,
    key: str = "o_custkey",
    ts: str = "o_orderdate",
    amount: Column | None = None,
    pieces: int | None = None,
) -> DataFrame:
    """Recency, frequency and monetary quintiles, 5 the best; ties are broken by key.

    Quintiles need each customer's place among all others, and a window over all of them
    would be one task. The three measures are stacked and ranked by one sample sort (see
    ``sorted_ranks``; ``pieces`` is the number of its ranges): by measure, value and key, so a value
    that very many customers share is cut as well. The key may be of any type with an order.
    """
    amount = amount if amount is not None else F.col("o_totalprice").cast("decimal(18,2)")
    per_key = publish(
        orders.groupBy(key).agg(
            F.datediff(as_of_day, F.max(ts)).alias("recency_days"),
            F.count("*").alias("frequency"),
            F.sum(amount).alias("monetary"),
        ),
        scratch_path(orders.sparkSession, "customers"),
    )
    rows = per_key.count()
    wide = "decimal(28,2)"
    values = {"r": -F.col("recency_days").cast(wide), "f": F.col("frequency").cast(wide), "m": F.col("monetary").cast(wide)}
    measures = F.array(*[F.struct(F.lit(k).alias("measure"), v.alias("value")) for k, v in enumerate(values.values())])
    stacked = per_key.select("*", F.explode(measures).alias("_m")).select(
        *per_key.columns, F.col("_m.measure").alias("_measure"), F.col("_m.value").alias("_value")
    )
    ranked = sorted_ranks(stacked, ["_measure", "_value", key], "_rank", pieces)
    # Every measure has a place for each customer.
    tile = tile_of(F.col("_rank") - F.col("_measure") * rows, F.lit(rows), 5)
    return ranked.groupBy(key, "recency_days", "frequency", "monetary").agg(
        *[F.max(F.when(F.col("_measure") == k, tile)).alias(f"{n}_score") for k, n in enumerate(values)]
    )


def repeat_rate(orders: DataFrame, group: str, key: str = "o_custkey") -> DataFrame:
    """Share of each group's customers with more than one order."""
    per_key = orders.groupBy(group, key).agg(F.count("*").alias("_n"))
    return per_key.groupBy(group).agg(
        F.count("*").alias("customers"),
        F.count_if(F.col("_n") > 1).alias("repeaters"),
        (F.count_if(F.col("_n") > 1).cast("double") / F.count("*")).alias("repeat_rate"),
    )


def bounce_rate(sessions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Share of sessions with a single event."""
    single = F.count_if(F.col("n_events") == 1)
    return sessions.groupBy(*by).agg(
        F.count("*").alias("sessions"),
        single.alias("bounces"),
        (single.cast("double") / F.count("*")).alias("bounce_rate"),
    )


def peak_concurrency(iv: DataFrame, start: str, end: str, grain: str = "hour") -> DataFrame:
    """Most intervals open at one time, for every day; intervals are half-open.

    Starts and ends are netted per instant, and the running count is taken per chunk of
    time with the open count carried in.
    """
    moves = F.array(
        F.struct(F.col(start).alias("at"), F.lit(1).alias("step")),
        F.struct(F.col(end).alias("at"), F.lit(-1).alias("step")),
    )
    net = (
        iv.where(F.col(start) < F.col(end))
        .select(F.explode(moves).alias("m"))
        .groupBy("m.at")
        .agg(F.sum("m.step").alias("_net"))
    )
    chunked = net.withColumn(CHUNK, F.date_trunc(grain, "at"))
    counted = running_sum(chunked, [], ["at"], "_net", "_open")
    daily = counted.groupBy(F.to_date("at").alias("day")).agg(
        F.max("_open").alias("_peak"),
        F.sum("_net").alias("_net"),
        F.min(F.col("at")).alias("_first"),
    )
    # One row per calendar day from here on.
    before = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    filled = fill_days(daily).withColumn(
        "_carried", F.coalesce(F.sum("_net").over(before), F.lit(0))
    )
    # What was open overnight counts unless the first move is at midnight itself.
    overnight = F.when(
        F.col("_first").isNull() | (F.col("_first") > F.col("day").cast("timestamp_ntz")),
        F.col("_carried"),
    )
    return filled.select("day", F.greatest("_peak", overnight).alias("peak"))
