"""Mixing sources to target weights by Pfair scheduling, in DataFrame operations only.

The documents of a source are put in hash order and cut into blocks; a stream slot takes a
block. Every block has a window of slots, and at every slot the released block with the
earliest deadline runs. Nothing is left out and nothing repeated.

By default a source weighs as the square root of its rows, exactly, whatever the number
of sources. Of sources i with n_i rows, b_i blocks and weight w_i = sqrt(n_i), the ideal
stream has min(b_i, v w_i) blocks of each at virtual time v, and t(v) of all. Block k is released
at floor(t(k / w_i)) and due at ceil(t((k + 1) / w_i)). Of the blocks with both in a range of
slots the ideal stream runs as many there at most as there are slots, so every block meets
its window, and after any number of slots a source is less than one block from the ideal. A
source that has run dry leaves its share to the others.

With given integer shares, in a period of P slots a source with share s gets s blocks; its
block k is released at floor(k P / s) and due at ceil((k + 1) P / s). As the shares add up
to P, every block meets its window, so after t slots a source is less than one block from
t s / P, and at the period's end exactly there. A period is repeated as long as every source
has blocks for it; the next period gives a source that runs dry the blocks it has left, and
then the shares of the others make up the period.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from enrollspark.llm.common import number_rows, private, stage

BLOCK = 64  # documents in a block
RUN = 256  # slots that are scheduled in a row


def epochs(blocks: list[int], shares: list[int]) -> list[tuple[int, int, list[int], list[int]]]:
    """(first slot, repeats, shares in a period, first block of each class), until no block is left."""
    left, slot, out = list(blocks), 0, []
    while any(left):
        own = [s if n else 0 for s, n in zip(shares, left)]
        repeats = min(n // s for s, n in zip(own, left) if s)
        if not repeats:  # a class runs dry within a period
            own, repeats = [min(s, n) for s, n in zip(own, left)], 1
        out.append((slot, repeats, own, [b - n for b, n in zip(blocks, left)]))
        left = [n - repeats * s for n, s in zip(left, own)]
        slot += repeats * sum(own)
    return out


def _table(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A small table from literals."""
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")))


def edf_slots(periods: DataFrame) -> DataFrame:
    """(epoch, cls, k, slot) of one period each: earliest deadline first over released blocks.

    ``periods`` has epoch and shares, an array by class. Ties go to the smaller class.
    """
    p = F.aggregate("shares", F.lit(0), lambda a, x: a + x)

    def pick(done, t, total):
        ready = F.transform(
            F.arrays_zip(F.col("shares").alias("s"), done.alias("d")),
            lambda x, i: F.when(
                (x["d"] < x["s"]) & (F.floor(x["d"] * total / x["s"]) <= t),
                F.struct(F.ceil((x["d"] + 1) * total / x["s"]).alias("due"), i.alias("cls")),
            ),
        )
        return F.array_min(ready)["cls"]

    def step(acc, t):
        c = pick(acc["done"], t, F.col("total"))
        return F.struct(
            F.transform(acc["done"], lambda d, i: F.when(i == c, d + 1).otherwise(d)).alias("done"),
            F.concat(acc["out"], F.array(c)).alias("out"),
        )

    start = F.struct(F.transform("shares", lambda x: F.lit(0)).alias("done"), F.array().cast("array<int>").alias("out"))
    d = periods.withColumn("total", p).withColumn("run", F.aggregate(F.sequence(F.lit(0), F.col("total") - 1), start, step, lambda a: a["out"]))
    d = d.select("epoch", F.posexplode("run").alias("slot", "cls"))
    w = Window.partitionBy("epoch", "cls").orderBy("slot")
    return d.withColumn("k", F.row_number().over(w) - 1)


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def _time(pieces: Column, slots: Column) -> Column:
    """Virtual time at which the ideal stream has run ``slots``; a hair later, so that rounding never holds a block back."""
    return F.array_max(F.transform(pieces, lambda p: (slots - p["a"]) / p["w"])) * F.lit(1 + 1e-12)


def _begun(n: Column, w: Column, v: Column) -> Column:
    """How many of a source's ``n`` blocks the ideal stream began before virtual time ``v``: those with k / w < v."""
    guess = F.least(n, F.greatest(F.lit(0), F.ceil(v * w).cast("int")))
    return F.when((guess < n) & (guess / w < v), guess + 1).when((guess > 0) & ((guess - 1) / w >= v), guess - 1).otherwise(guess)


def _stream(sizes: DataFrame, block: int) -> DataFrame:
    """One row for the stream: its sources' names, blocks (n) and weights (w) in order, the pieces of t(v), and how many slots it has."""
    s = sizes.select("name", F.ceil(F.col("rows") / block).cast("int").alias("n"), F.sqrt("rows").alias("w"))
    s = stage(s, "weights")
    one = s.agg(F.array_sort(F.collect_list(F.struct(F.col("name").isNotNull().alias("named"), "name", "n", "w"))).alias("all"))
    # t(v) is the least of its pieces a + v w, one for each set of sources that are not dry, as it rises ever slower
    dry = s.groupBy((F.col("n") / F.col("w")).alias("v")).agg(F.sum("n").alias("n"), F.sum("w").alias("w"))
    before, after = Window.orderBy("v").rowsBetween(Window.unboundedPreceding, -1), Window.orderBy("v").rowsBetween(0, Window.unboundedFollowing)
    pieces = dry.select(F.coalesce(F.sum("n").over(before), F.lit(0)).cast("double").alias("a"), F.sum("w").over(after).alias("w"))
    pieces = pieces.agg(F.collect_list(F.struct("a", "w")).alias("pieces")).withColumn("one", F.lit(0))
    one = one.withColumn("one", F.lit(0)).join(pieces, "one")
    return one.select(
        "one", F.col("all.name").alias("name"), F.col("all.n").alias("n"), F.col("all.w").alias("w"), "pieces",
        F.aggregate("all", F.lit(0).cast("long"), lambda acc, x: acc + x["n"]).alias("total"),
    )


def _spread(rows: DataFrame, runs: int) -> DataFrame:
    """A row for each run, in enough partitions: by number, as their bytes say nothing of their work."""
    tasks = 4 * rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(max(1, min(runs, tasks)), "run")


def _behind(stream: DataFrame, runs: int, run: int) -> DataFrame:
    """(run, behind): for every run the array of how many blocks begun are not done after each of its slots.

    A slot always runs a block, so that is the blocks begun less the slots, whichever blocks they are.
    """
    spark = stream.sparkSession
    d = spark.range(runs).select(F.col("id").alias("run"), F.lit(0).alias("one")).join(stream, "one")
    after = F.sequence(F.col("run") * run + 1, F.least((F.col("run") + 1) * run, F.col("total")))

    def count(slots: Column) -> Column:
        return _bound(
            _time(F.col("pieces"), slots), lambda v: F.aggregate(F.zip_with("n", "w", lambda n, w: _begun(n, w, v)), F.lit(0).cast("long"), lambda acc, x: acc + x) - slots
        )

    return _spread(d, runs).select("run", F.transform(after, count).alias("behind"))


def _states(stream: DataFrame, runs: int, run: int) -> DataFrame:
    """(run, done): how many blocks of each source the schedule has done when a run begins, for every run but the first.

    Of each source at most the last block begun is not done. Of these blocks, earliest
    deadline first leaves the ones with the latest deadlines undone, as many as are behind;
    but blocks that began up to any slot can't be left beyond the number
    that was behind at some slot since, when at most so many were waiting.
    """
    spark = stream.sparkSession
    behind = stage(_behind(stream, runs, run), "behind")
    d = _spread(spark.range(1, runs).select(F.col("id").alias("run"), F.lit(0).alias("one")).join(stream, "one"), runs)
    d = d.select("run", "pieces", _time(F.col("pieces"), F.col("run") * run).alias("v"), F.posexplode(F.arrays_zip("n", "w")).alias("i", "x"))
    d = d.select("run", "pieces", "i", F.col("x.w").alias("w"), _begun(F.col("x.n"), F.col("x.w"), F.col("v")).alias("begun"))
    # the slot in which the last block began
    u = (F.col("begun") - 1) / F.col("w")
    d = d.withColumn("t", F.floor(F.array_min(F.transform("pieces", lambda p: p["a"] + u * p["w"]))))
    d = d.withColumn("t", F.when((F.col("t") > 0) & (u < _time(F.col("pieces"), F.col("t"))), F.col("t") - 1).when(u < _time(F.col("pieces"), F.col("t") + 1), F.col("t")).otherwise(F.col("t") + 1))
    d = d.select("run", "i", "begun", (F.col("begun") / F.col("w")).alias("due"), F.when(F.col("begun") > 0, F.col("t")).alias("t"))
    # the least number behind since then: in its own run from its slot on, and in the runs between
    own = behind.select(F.col("run").alias("own"), F.col("behind").alias("there"))
    last = behind.select((F.col("run") + 1).alias("run"), F.array_min("behind").alias("low"))
    d = d.join(own, F.floor(F.col("t") / run) == F.col("own"), "left").join(last, "run")
    here = F.array_min(F.slice("there", (F.col("t") % run + 1).cast("int"), run))
    d = d.withColumn("low", F.when(F.col("own") + 1 == F.col("run"), here).otherwise(F.col("low"))).drop("there")
    since = Window.partitionBy("i", "begun").orderBy("run").rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("low", F.min("low").over(since))
    every = d.groupBy("run").agg(F.array_sort(F.collect_list(F.struct("i", "begun", "due", "t", "low"))).alias("all"))  # a struct for each source
    every = every.withColumn("room", F.array_sort(F.transform(F.filter("all", lambda x: x["begun"] > 0), lambda x: F.struct(x["t"].alias("t"), x["i"].alias("i"), x["low"].alias("low")))))
    every = every.withColumn("latest", F.reverse(F.array_sort(F.transform("room", lambda x: F.struct(F.get("all", x["i"])["due"].alias("due"), x["i"].alias("i"))))))
    every = every.withColumn("place", F.col("room.i")).withColumn("room", F.col("room.low"))
    total = F.aggregate("all", F.lit(0).cast("long"), lambda acc, x: acc + x["begun"])
    # written out, so that the arrays aren't made anew in every step below
    every = _spread(stage(every.select("run", F.col("all.begun").alias("begun"), "room", "latest", "place", (total - F.col("run") * run).alias("left")), "waiting"), runs)

    def leave(acc: Column, x: Column) -> Column:
        at = F.array_position("place", x["i"]).cast("int")

        def put(ok: Column) -> Column:
            return F.struct(
                F.transform(acc["room"], lambda r, k: F.when(ok & (k + 1 >= at), r - 1).otherwise(r)).alias("room"),
                (acc["left"] - ok.cast("long")).alias("left"),
                F.when(ok, F.concat(acc["out"], F.array(x["i"]))).otherwise(acc["out"]).alias("out"),
            )

        return _bound((acc["left"] > 0) & (F.array_min(F.slice(acc["room"], at, F.size("room"))) > 0), put)

    start = F.struct(F.col("room"), F.col("left"), F.array().cast("array<int>").alias("out"))
    out = every.select("run", "begun", F.aggregate("latest", start, leave, lambda acc: acc["out"]).alias("undone"))
    flat = out.select("run", "undone", F.posexplode("begun").alias("i", "begun"))
    flat = flat.select("run", "i", (F.col("begun") - F.array_contains("undone", F.col("i")).cast("int")).alias("done"))
    return flat.groupBy("run").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "done"))), lambda x: x["done"]).alias("done"))


def weighted_slots(sizes: DataFrame, block: int, run: int = RUN) -> DataFrame:
    """(name, block, slot) of every block of every source, from (name, rows): earliest deadline first over released blocks.

    Deadlines are compared by virtual time, which rises with the slot; ties go to the
    name first in order, null before all. The stream is cut into runs of at least ``run``
    slots, and of a slot for each source. What earliest deadline first has done when a run begins follows from
    the windows alone (``_states``), so each run is scheduled on its own, in any task, and the
    order is that of one schedule over the whole stream: every block meets its window,
    and a source is less than one block from its ideal after every slot.
    """
    stream = stage(_stream(sizes, block), "stream")
    spark = stream.sparkSession
    size = stream.select("total", F.size("n").alias("sources")).first()
    run = max(run, size["sources"])
    runs = -(-size["total"] // run)
    zero = spark.range(1 if runs else 0).select(F.col("id").alias("run"), F.lit(0).alias("one")).join(stream, "one")
    d = zero.select("run", F.transform("n", lambda _: F.lit(0)).alias("done"))
    if runs > 1:
        d = d.union(_states(stream, runs, run))
    d = _spread(d.withColumn("one", F.lit(0)).join(stream, "one"), runs)

    def step(acc: Column, end: Column) -> Column:
        # a block is released where the ideal stream begins it before the slot's end; one that rounding holds back comes after these
        best = F.array_min(
            F.transform(
                acc["done"],
                lambda k, i: F.when(k < F.get("n", i), F.struct((k / F.get("w", i) >= end).alias("late"), ((k + 1) / F.get("w", i)).alias("due"), i.alias("i"), k.alias("k"))),
            )
        )

        def ran(p: Column) -> Column:
            return F.struct(
                F.transform(acc["done"], lambda k, i: F.when(i == p["i"], k + 1).otherwise(k)).alias("done"),
                F.concat(acc["out"], F.array(F.struct(p["i"].alias("i"), p["k"].alias("k")))).alias("out"),
            )

        return _bound(best, ran)

    ends = F.transform(F.sequence(F.col("run") * run + 1, F.least((F.col("run") + 1) * run, F.col("total"))), lambda t: _time(F.col("pieces"), t))
    start = F.struct("done", F.array().cast("array<struct<i:int,k:int>>").alias("out"))
    made = d.select("run", "name", F.posexplode(F.aggregate(ends, start, step, lambda acc: acc["out"])).alias("at", "job"))
    return stage(made.select(F.get("name", F.col("job.i")).alias("name"), F.col("job.k").cast("long").alias("block"), (F.col("run") * run + F.col("at")).alias("slot")), "slots")


def _mix_by_size(docs: DataFrame, key: str, source: str, block: int) -> DataFrame:
    """mix_sources with every source's weight from its rows."""
    name, n, b, s, place, position = private(docs, "name", "n", "block", "slot", "place", "position")
    sizes = docs.groupBy(F.col(source).cast("string").alias("name")).agg(F.count(F.lit(1)).alias("rows"))
    slots = weighted_slots(sizes, block).select(F.col("name").alias(f"{s}_s"), F.col("block").alias(f"{s}_b"), F.col("slot").alias(s))
    d = number_rows(docs.withColumn(name, F.col(source).cast("string")), name, [F.xxhash64(F.col(key)), F.col(key)], n)
    d = d.withColumn(b, F.floor(F.col(n) / block)).withColumn(place, F.col(n) % block)
    d = d.join(slots, F.col(name).eqNullSafe(F.col(f"{s}_s")) & (F.col(b) == F.col(f"{s}_b")))
    d = d.withColumn(position, F.col(s) * block + F.col(place))
    return d.select(*[F.col(f"`{c}`") for c in docs.columns], F.col(b).cast("long").alias(b), F.col(s).cast("long").alias(s), F.col(place).cast("int").alias(place), F.col(position).cast("long").alias(position))


def mix_sources(
    docs: DataFrame,
    shares: dict[str, int] | None = None,
    key: str = "doc_id",
    source: str = "source",
    block: int = BLOCK,
) -> DataFrame:
    """Add block, slot, place and position: where each row stands in the mixed stream.

    ``block`` numbers the blocks of the row's source, ``slot`` those of the stream;
    ``place`` is the row's place in its block, and ``position``, slot * block + place,
    rises along the stream. ``shares`` gives integer target weights by source; a
    source it doesn't name joins the pool, whose share is 1. Without it every
    source weighs as the square root of its rows. A null source is a source of its own; rows with null or
    repeated keys keep a place each, in any order among equals; an empty table
    gives an empty result. ``docs`` is read more than once, so give a table or
    a cheap plan.
    """
    if shares is None:
        return _mix_by_size(docs, key, source, block)
    spark = docs.sparkSession
    cls, name, n, slots, period, b, s, place, position = private(docs, "cls", "name", "n", "slots", "period", "block", "slot", "place", "position")
    named = sorted(shares)
    classes = _table(spark, [{"name": v, "cls": i} for i, v in enumerate(named)], "name string, cls int")
    # as many rows as there are named sources
    keyed = docs.join(F.broadcast(classes.withColumnsRenamed({"cls": cls, "name": name})), F.col(source).cast("string").eqNullSafe(F.col(name)), "left")
    keyed = keyed.withColumn(cls, F.coalesce(F.col(cls), F.lit(len(named)))).drop(name)
    count = {r[cls]: r["count"] for r in keyed.groupBy(cls).count().collect()}  # a row for each class
    rows = [count.get(i, 0) for i in range(len(named) + 1)]
    own = [shares[v] for v in named] + [1]
    runs = epochs([-(-r // block) for r in rows], own)

    schedule = edf_slots(_table(spark, [{"epoch": e, "shares": r[2]} for e, r in enumerate(runs)], "epoch int, shares array<int>"))
    # a row for each slot of at most twice as many periods as classes
    schedule = stage(schedule.select(F.col("epoch").alias(f"{slots}_e"), F.col("cls").alias(f"{slots}_c"), F.col("k").alias(f"{slots}_k"), F.col("slot").alias(slots)), "slots")
    parts = [
        {"cls": c, "runs": [{"epoch": e, "first": first[c], "blocks": repeats * r[c], "share": r[c], "slot": at, "total": sum(r)} for e, (at, repeats, r, first) in enumerate(runs) if r[c]]}
        for c in range(len(rows))
    ]
    run = "struct<epoch:int,first:bigint,blocks:bigint,share:bigint,slot:bigint,total:bigint>"
    plan = _table(spark, parts, f"cls int, runs array<{run}>").select(F.col("cls").alias(f"{period}_c"), F.col("runs").alias(period))

    d = number_rows(keyed, cls, [F.xxhash64(F.col(key)), F.col(key)], n)
    d = d.withColumn(b, F.floor(F.col(n) / block)).withColumn(place, F.col(n) % block)
    d = d.join(F.broadcast(plan), F.col(cls) == F.col(f"{period}_c"))
    d = d.withColumn(period, F.filter(period, lambda x: (F.col(b) >= x["first"]) & (F.col(b) < x["first"] + x["blocks"]))[0])
    d = d.withColumn(n, F.col(b) - F.col(f"{period}.first"))
    at = (
        (F.col(f"{period}.epoch") == F.col(f"{slots}_e"))
        & (F.col(cls) == F.col(f"{slots}_c"))
        & ((F.col(n) % F.col(f"{period}.share")).cast("int") == F.col(f"{slots}_k"))
    )
    d = d.join(F.broadcast(schedule), at)
    d = d.withColumn(s, F.col(f"{period}.slot") + F.floor(F.col(n) / F.col(f"{period}.share")) * F.col(f"{period}.total") + F.col(slots))
    d = d.withColumn(position, F.col(s) * block + F.col(place))
    return d.select(*[F.col(f"`{c}`") for c in docs.columns], F.col(b).cast("long").alias(b), F.col(s).cast("long").alias(s), F.col(place).cast("int").alias(place), F.col(position).cast("long").alias(position))


def mixed_order(docs: DataFrame, shares: dict[str, int] | None = None, block: int = BLOCK) -> DataFrame:
    """The rows in the order of the mixed stream: partitions are ranges of it, and their files in name order are the stream.

    The schedule is made over ids and sources alone; texts move once to meet their
    position and once into order. Ids should be unique; rows with a repeated id all
    stay and stand where one of them was scheduled, rows without an id come last.
    """
    at, k = private(docs, "position", "key")
    ids = docs.filter("doc_id is not null").groupBy("doc_id").agg(F.min("source").alias("source"))  # of several sources the first in order
    where = mix_sources(stage(ids, "sources"), shares, block=block).select(F.col("doc_id").alias(k), F.col("position").alias(at))
    d = docs.join(stage(where, "positions"), F.col("doc_id") == F.col(k), "left").drop(k)
    return d.repartitionByRange(F.col(at).asc_nulls_last()).sortWithinPartitions(F.col(at).asc_nulls_last()).drop(at)
