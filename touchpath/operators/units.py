"""W1-W4, P14, P15, J10 on long rows: conversions and the channel steps of their chains, without an array of touches.

A chain is two tables here. ``heads`` has one row per conversion, with what its
touches sum up to. ``steps`` counts, per chain, how often a touch on one channel
follows one on another (``from_channel`` NULL at the chain's start), so it holds
every touch of the chain and every transition, whatever the chain's length.

A concatenated chain puts the customer's chains of the last days before a
conversion's own. Those chains are the same for all conversions of a customer
and day, and a chain stands in as many concatenations as conversions follow
within the window. So the sums over concatenated chains are sums over
(customer, day) rows, weighted by later conversions; the concatenations, whose
size is conversions times touches, are never built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchpath.functions.dates import utc_date

KEYS = ["customer_id", "chain_no"]
HEAD_COLUMNS = [*KEYS, "conversion_id", "conversion_timestamp", "first_event", "purchase_date", "purchase_value",
                "own_len", "first_channel", "last_channel"]


def conversion_id(session_id, end_ts):
    """Session id and day of its last event."""
    return F.concat(session_id, F.lit("."), F.replace(utc_date(end_ts).cast("string"), F.lit("-"), F.lit("")))


def chain_heads(sessions: DataFrame) -> DataFrame:
    """One row per closed chain (T5 without its array)."""
    closing = F.when(F.col("closes") == 1, F.struct("session_id", "last", F.element_at("channels", -1).alias("channel")))
    grouped = sessions.groupBy(*KEYS).agg(
        F.max(closing).alias("closing"), F.min(F.struct("first_ts", "session_id", F.col("channels")[0].alias("channel"))).alias("opening"),
        F.min("touches_before").alias("touches_before"), F.sum(F.size("channels")).alias("own_len")).where(F.col("closing").isNotNull())
    end_ts = F.col("closing.last.last_event_timestamp")
    return grouped.select(
        *KEYS, conversion_id(F.col("closing.session_id"), end_ts).alias("conversion_id"), end_ts.alias("conversion_timestamp"),
        utc_date("opening.first_ts").alias("first_event"), utc_date(end_ts).alias("purchase_date"),
        F.col("closing.last.session_revenue").alias("purchase_value"), "own_len", F.col("opening.channel").alias("first_channel"),
        F.col("closing.channel").alias("last_channel"), "touches_before")


def chain_touches(sessions: DataFrame, heads: DataFrame) -> DataFrame:
    """W1 + W5 as long rows: (customer, chain, position, channel) of every touch of a closed chain, positions from 1.

    A touch's position is a difference of two prefix sums over the customer's
    touches, so no task orders a whole chain.
    """
    start = heads.select(*KEYS, F.col("touches_before").alias("start"))
    return (sessions.join(start, KEYS).select(*KEYS, "touches_before", "start", F.posexplode("channels").alias("i", "channel_name"))
            .select(*KEYS, (F.col("touches_before") - F.col("start") + F.col("i") + 1).alias("position"), "channel_name"))


def chain_steps(sessions: DataFrame) -> DataFrame:
    """(customer, chain, from_channel, channel_name, n): every touch with the channel of the touch before it in the chain."""
    before = F.concat(F.array(F.when(F.col("previous.closes") == 0, F.col("previous.channel"))), F.slice("channels", F.lit(1), F.size("channels") - 1))
    steps = sessions.select(*KEYS, F.explode(F.arrays_zip(before.alias("a"), F.col("channels").alias("b"))).alias("s"))
    return steps.groupBy(*KEYS, F.col("s.a").alias("from_channel"), F.col("s.b").alias("channel_name")).agg(F.count(F.lit(1)).alias("n"))


def raw_units(sessions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(heads, steps) of the raw chains from ``numbered_sessions``; steps of an unclosed tail have no head."""
    return chain_heads(sessions).select(*HEAD_COLUMNS), chain_steps(sessions)


def merged_units(heads: DataFrame, steps: DataFrame, gap_days: int) -> tuple[DataFrame, DataFrame]:
    """W3 + A7: chains whose purchases follow each other within ``gap_days`` become one.

    Islands are numbered on one row per (customer, purchase date). A merged
    chain keeps the conversion of its last chain; where one of its chains
    follows another, the first step comes from the last channel before it.
    """
    by_day = Window.partitionBy("customer_id").orderBy("purchase_date")
    days = heads.select("customer_id", "purchase_date").distinct()
    opens = F.coalesce((F.datediff("purchase_date", F.lag("purchase_date").over(by_day)) > gap_days).cast("int"), F.lit(0))
    days = days.withColumn("opens", opens).withColumn("rank", F.sum("opens").over(by_day) + 1).drop("opens")
    order = Window.partitionBy("customer_id", "rank").orderBy("conversion_timestamp", "chain_no")
    placed = heads.join(days, ["customer_id", "purchase_date"]).withColumn("before", F.lag("last_channel").over(order))
    whole = Window.partitionBy("customer_id", "rank")
    placed = placed.withColumn("unit_no", F.max(F.struct("conversion_timestamp", "chain_no")).over(whole)["chain_no"])
    at = F.struct("conversion_timestamp", "chain_no")
    merged = placed.groupBy("customer_id", "rank", "unit_no").agg(
        F.max_by(F.struct("conversion_id", "conversion_timestamp", "last_channel"), at).alias("end"), F.min("first_event").alias("first_event"),
        F.max("purchase_date").alias("purchase_date"), F.sum("purchase_value").alias("purchase_value"), F.sum("own_len").alias("own_len"),
        F.min_by("first_channel", at).alias("first_channel"))
    merged = merged.select("customer_id", F.col("unit_no").alias("chain_no"), "end.conversion_id", "end.conversion_timestamp", "first_event", "purchase_date",
                           "purchase_value", "own_len", "first_channel", F.col("end.last_channel").alias("last_channel"))
    moved = (steps.join(placed.select(*KEYS, "unit_no", "before"), KEYS)
             .groupBy("customer_id", F.col("unit_no").alias("chain_no"), F.coalesce("from_channel", "before").alias("from_channel"), "channel_name")
             .agg(F.sum("n").alias("n")))
    return merged, moved


def with_prefixes(heads: DataFrame, within_days: int) -> DataFrame:
    """W4 + J10 summed up: each conversion with what the chains of the days before put in front of its own.

    Adds ``prefix_len``, ``prefix_first``, ``prefix_last``, ``chain_len``,
    ``later`` (conversions that put this chain in front of theirs), ``next_first``
    (first channel of the chain that follows this one in its day's block: chains
    of a day stand in reverse order) and ``joint`` (on one row of a day: the step
    from the block of the day before in time, and how many concatenations hold
    it). Windows run over one row per customer and day. Without concatenation
    (``within_days`` 0) every prefix is empty.
    """
    if within_days == 0:
        none = F.lit(None).cast("string")
        joint = F.lit(None).cast("struct<from_channel:string,channel_name:string,n:bigint>")
        return heads.select("*", F.lit(0).cast("long").alias("prefix_len"), none.alias("prefix_first"), none.alias("prefix_last"),
                            F.lit(0).cast("long").alias("later"), none.alias("next_first"), joint.alias("joint"), F.col("own_len").alias("chain_len"))
    days = (heads.groupBy("customer_id", "purchase_date")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("own_len").alias("len"), F.max(F.struct("chain_no", "first_channel")).alias("head"),
                 F.min(F.struct("chain_no", "last_channel")).alias("tail"))
            .withColumn("dn", F.unix_date("purchase_date")))
    w = Window.partitionBy("customer_id").orderBy("dn")
    past, to_here = w.rangeBetween(-within_days, -1), w.rangeBetween(Window.unboundedPreceding, 0)
    first, last = F.col("head.first_channel"), F.col("tail.last_channel")
    days = days.select(
        "*", F.coalesce(F.sum("len").over(past), F.lit(0)).alias("prefix_len"), F.first(first).over(past).alias("prefix_first"),
        F.last(last).over(past).alias("prefix_last"), F.coalesce(F.sum("n").over(w.rangeBetween(1, within_days)), F.lit(0)).alias("later"),
        F.sum("n").over(to_here).alias("upto"), F.sum("n").over(w.rangeBetween(Window.unboundedPreceding, within_days)).alias("reached"))
    # two neighbouring blocks both stand before the conversions after the later one and within reach of the earlier one
    held = F.greatest(F.lag("reached").over(w) - F.col("upto"), F.lit(0))
    days = days.select("customer_id", "purchase_date", "prefix_len", "prefix_first", "prefix_last", "later", F.col("head.chain_no").alias("head_no"),
                       F.when(held > 0, F.struct(F.lag(last).over(w).alias("from_channel"), first.alias("channel_name"), held.alias("n"))).alias("joint"))
    in_block = Window.partitionBy("customer_id", "purchase_date").orderBy("chain_no")
    return (heads.withColumn("next_first", F.lag("first_channel").over(in_block)).join(days, ["customer_id", "purchase_date"])
            .withColumn("joint", F.when(F.col("chain_no") == F.col("head_no"), F.col("joint"))).drop("head_no")
            .withColumn("chain_len", F.col("own_len") + F.col("prefix_len")))


def channel_measures(conversions: DataFrame, steps: DataFrame, within_days: int) -> DataFrame:
    """One row of sums per channel over all (concatenated) chains.

    ``conversions`` comes from ``with_prefixes``. A channel's touches of a chain
    count once in it and once in each conversion of the following days, so they
    are summed per (customer, day, channel), carried to those days and met there
    by the day's conversions: at most ``within_days`` rows per day and channel.
    """
    value, length = F.col("purchase_value"), F.col("chain_len")
    share = lambda c: c / length
    worth = value.cast("double")
    per_day = conversions.groupBy("customer_id", "purchase_date").agg(
        F.count(F.lit(1)).alias("day_chains"), F.sum(value).alias("day_value"), F.sum(length).alias("day_len"),
        F.sum(share(F.lit(1.0))).alias("day_share"), F.sum(share(worth)).alias("day_share_value"))
    held = (steps.groupBy(*KEYS, "channel_name").agg(F.sum("n").alias("n"))
            .join(conversions.select(*KEYS, "purchase_date", "purchase_value", "chain_len", "last_channel"), KEYS))
    assists = F.col("n") - F.when(F.col("channel_name") == F.col("last_channel"), 1).otherwise(0) > 0
    own = held.groupBy("customer_id", "purchase_date", "channel_name").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("chains"), F.sum(length).alias("len"), F.count(F.when(assists, 1)).alias("assisted"),
        F.sum(F.when(assists, value)).alias("assisted_value"), F.sum(share(F.col("n"))).alias("share"), F.sum(share(F.col("n") * worth)).alias("share_value"))
    sums = ["chains", "len", "assisted", "assisted_value", "share", "share_value"]
    carried = own.select("customer_id", "channel_name", "n", *sums, "purchase_date", F.explode(F.sequence(F.lit(0), F.lit(within_days))).alias("on"))
    here = F.col("on") == 0
    met = (carried.groupBy("customer_id", "channel_name", F.date_add("purchase_date", F.col("on")).alias("purchase_date"))
           .agg(F.sum(F.when(here, F.col("n"))).alias("n"), F.sum(F.when(~here, F.col("n"))).alias("before"),
                *[F.sum(F.when(here, F.col(c))).alias(c) for c in sums])
           .join(per_day, ["customer_id", "purchase_date"]))
    zero = lambda c: F.coalesce(c, F.lit(0))
    inside = F.col("before").isNotNull()  # in front of every chain of the day: each holds the channel, and not as its last touch
    touches = met.select("channel_name", (zero(F.col("n")) + zero(F.col("before") * F.col("day_chains"))).alias("appearances"),
                         *[F.when(inside, F.col(f"day_{d}")).otherwise(F.col(c)).alias(c) for c, d in
                           (("chains", "chains"), ("len", "len"), ("assisted", "chains"), ("assisted_value", "value"))],
                         *[(zero(F.col(c)) + zero(F.col("before") * F.col(f"day_{c}"))).alias(c) for c in ("share", "share_value")])
    touches = touches.groupBy("channel_name").agg(*[F.sum(c).alias(c) for c in touches.columns[1:]])

    mono = length == 1
    role = lambda channel, kind: F.struct(channel.alias("channel_name"), F.lit(kind).alias("role"))
    ends = conversions.select(value, mono.alias("mono"), F.explode(F.array(
        role(F.coalesce("prefix_first", "first_channel"), "first"), role(F.col("last_channel"), "last"))).alias("r"))
    first, last = F.col("r.role") == "first", F.col("r.role") == "last"
    ends = ends.groupBy(F.col("r.channel_name").alias("channel_name")).agg(
        F.count(F.when(last & F.col("mono"), 1)).alias("mono"), F.count(F.when(first & ~F.col("mono"), 1)).alias("first"),
        F.sum(F.when(first & ~F.col("mono"), value)).alias("first_value"), F.count(F.when(last, 1)).alias("last"), F.sum(F.when(last, value)).alias("last_value"),
        F.count(F.when(first, 1)).alias("opens"), F.sum(F.when(first, worth)).alias("opens_value"), F.sum(F.when(last, worth)).alias("closes_value"))
    return touches.join(ends, "channel_name", "left")


def stats_of(measures: DataFrame) -> DataFrame:
    """A9-A11 + P27: the channel statistics (as ``stats.channel_stats`` of the chains themselves)."""
    n = lambda c: F.coalesce(F.col(c), F.lit(0))
    assisted = F.when(F.col("assisted") > 0, F.col("assisted"))
    return measures.select(
        "channel_name", F.col("appearances").alias("nr_appearances"), F.col("chains").alias("nr_chains"), n("mono").alias("nr_mono_touch_chains"),
        n("first").alias("nr_first_touch_chains"), n("first_value").alias("first_touch_chains_value"), n("last").alias("nr_last_touch_chains"),
        n("last_value").alias("last_touch_chains_value"), assisted.alias("nr_assisted_chains"), F.col("assisted_value").alias("assisted_chains_value"),
        (F.col("len") / F.col("chains")).alias("mean_chain_len"), F.try_divide(assisted, n("last")).alias("assisted_per_last_touch"),
        F.try_divide(n("first"), n("last")).alias("first_per_last_touch"))


def heuristics_of(measures: DataFrame) -> DataFrame:
    """M1-M3: first, last and linear touch credit (as ``models.heuristic_attribution`` of the paths)."""
    n = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    return measures.select(
        "channel_name", n("opens").alias("first_touch_conversions"), n("opens_value").alias("first_touch_value"), n("last").alias("last_touch_conversions"),
        n("closes_value").alias("last_touch_value"), F.col("share").alias("linear_touch_conversions"), F.col("share_value").alias("linear_touch_value"))


def transitions_of(conversions: DataFrame, steps: DataFrame, start: str = "(start)", conversion: str = "(conversion)") -> DataFrame:
    """M4: transition counts and values over all (concatenated) chains (as ``models.markov_transitions`` of the paths)."""
    none = F.lit(0.0)

    def edge(a, b, n, v=none):
        return F.struct(a.alias("from_state"), b.alias("to_state"), n.cast("bigint").alias("n"), v.alias("v"))

    one, last = F.lit(1), F.col("last_channel")
    kinds = F.array(
        edge(F.lit(start), F.coalesce("prefix_first", "first_channel"), one),
        edge(last, F.lit(conversion), one, F.coalesce(F.col("purchase_value").cast("double"), none)),
        edge(F.col("prefix_last"), F.col("first_channel"), F.when(F.col("prefix_last").isNotNull(), 1).otherwise(0)),
        edge(last, F.col("next_first"), F.when(F.col("next_first").isNotNull(), F.col("later")).otherwise(0)),
        edge(F.col("joint.from_channel"), F.col("joint.channel_name"), F.coalesce("joint.n", F.lit(0))))
    inside = (steps.where(F.col("from_channel").isNotNull()).join(conversions.select(*KEYS, "later"), KEYS)
              .select(F.col("from_channel").alias("from_state"), F.col("channel_name").alias("to_state"), (F.col("n") * (F.col("later") + 1)).alias("n"),
                      none.alias("v")))
    every = conversions.select(F.explode(kinds).alias("e")).select("e.*").where("n > 0").union(inside)
    return every.groupBy("from_state", "to_state").agg(F.sum("n").alias("nr_transitions"), F.sum("v").alias("transition_value"))
