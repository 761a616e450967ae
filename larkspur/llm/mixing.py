"""Sources mixed to target weights by Pfair scheduling, in DataFrame operations alone.

A source's documents, in a seeded random order, are cut into blocks of ``block_rows``. With shares a of a period of Q slots,
block j of a source may not start before slot floor(j * Q / a), its release, and must have started before
ceil((j + 1) * Q / a), its deadline. Of the sources whose next block is released, each slot takes the one with the
earliest deadline. As the shares sum to Q, every block meets its deadline, and after any number of slots a source is less
than one block away from its weight. Releases and deadlines repeat after Q slots, so one period is scheduled, as a fold
over its slots, and block j takes the slot of block j mod a, shifted by whole periods.

Nothing is dropped: a source that has run out leaves its slots empty, the others go on in their order. ``on_target`` says
that no source had run out yet. ``position`` numbers all rows of the mixture from 0; it is computed from the period and
the sources' sizes, without sorting the table.

A row's rank in its source is its rank in one of many ranges of the random order plus the rows of the ranges before, so a
source with a third of all rows is ranked by many tasks. Rows are shuffled once. What is broadcast, up to a checked size, is
the period: Q rows with three numbers for each source. Q is ``resolution`` slots (four for each source if that is more), and a slot for
each source whose weight is too small for one; the fold
takes Q steps over all sources, so this is made for up to some thousand sources.

Defined results: a null source is a source of its own; null ids count as empty text in the order; rows of one id follow each
other by text; an empty table gives an empty mixture. All columns stay; one named
like an added column gets the prefix ``own_``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.workspace import materialize

ADDED = ("block", "slot", "position", "on_target")
#: Rows of one range of a source's random order.
RANGE_ROWS = 20_000
#: Entries of the period (sources times slots, some 40 bytes each) that are broadcast at most.
BROADCAST_ENTRIES = 1_000_000


def _name(source: Column) -> Column:
    """A source's name with null told apart."""
    return F.when(source.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), source.cast("string")))


def tempered(n: Column) -> Column:
    """Weight by the square root of the size, in whole millionths: small sources gain, none takes over."""
    return F.round(F.sqrt(n.cast("double")) * 1_000_000).cast("long")


def shares(sizes: DataFrame, weight: Column, resolution: int) -> DataFrame:
    """Per source (s, n): its share ``a`` of a period of ``q`` slots, by largest remainder, at least one slot."""
    whole = Window.partitionBy()
    weighed = sizes.withColumn("m", weight).withColumns(
        {
            "slots": F.greatest(F.lit(resolution), 4 * F.count("*").over(whole)).cast("long"),
            "total": F.sum("m").over(whole).cast("decimal(38,0)"),
        }
    )
    exact = F.col("m").cast("decimal(20,0)") * F.col("slots").cast("decimal(10,0)")
    cut = weighed.withColumns({"base": F.floor(exact / F.col("total")).cast("long"), "over": exact % F.col("total")})
    left = F.col("slots") - F.sum("base").over(whole)
    place = F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(F.desc("over"), "s"))
    dealt = cut.withColumns({"left": left, "place": place})
    more = F.when(F.col("place") <= F.col("left"), 1).otherwise(0)
    dealt = dealt.withColumn("a", F.greatest(F.lit(1), F.col("base") + more).cast("long"))
    return dealt.select("s", "n", F.sum("a").over(whole).alias("q"), "a")


def period(shared: DataFrame) -> DataFrame:
    """One period: for block j of source s its slot, release and deadline, the blocks of each source before the slot, and
    the shares and sizes of all sources."""
    one = shared.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("s", "a", "n"))).alias("sources"))

    def step(state, t):
        # Of released blocks, the earliest deadline, then the first source.
        waiting = F.transform(
            F.arrays_zip(state.done, F.col("sources.a").alias("a")),
            lambda x, i: F.when(
                F.floor(x.done * F.col("q") / x.a) <= t,
                F.struct(F.ceil((x.done + 1) * F.col("q") / x.a).alias("deadline"), i.alias("i")),
            ),
        )
        pick = F.array_min(waiting).i
        done = F.transform(state.done, lambda d, i: F.when(i == pick, d + 1).otherwise(d))
        return F.struct(done.alias("done"), F.concat(state.picks, F.array(pick)).alias("picks"))

    start = F.struct(
        F.transform("sources", lambda _: F.lit(0).cast("long")).alias("done"), F.array().cast("array<int>").alias("picks")
    )
    picks = F.aggregate(F.sequence(F.lit(0).cast("long"), F.col("q") - 1), start, step).picks
    slots = one.withColumn("picks", picks).select("q", "sources", "picks", F.posexplode("picks").alias("slot", "pick"))
    before = F.transform("sources", lambda _, i: F.size(F.filter(F.slice("picks", 1, F.col("slot")), lambda p: p == i)))
    j = F.element_at(before, F.col("pick") + 1).cast("long")
    mine = F.element_at("sources", F.col("pick") + 1)
    return slots.select(
        mine.s.alias("s"), mine.a.alias("a"), "q", j.alias("j"), F.col("slot").cast("long").alias("slot"),
        F.floor(j * F.col("q") / mine.a).alias("release"), F.ceil((j + 1) * F.col("q") / mine.a).alias("deadline"),
        F.transform(F.arrays_zip("sources", before.alias("before")), lambda x: F.struct(
            x.sources.a.alias("a"), x.sources.n.alias("n"), x.before.cast("long").alias("before"))).alias("others"),
    )


def mix_sources(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    block_rows: int = 16,
    resolution: int = 1000,
    seed: int = 0,
    source_col: str = "source",
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The documents with block (of the source), slot, position (from 0) and on_target.

    ``weights`` gives each source's target weight, above 0; without it, sources weigh as the root of their size.
    """
    kept = dict(zip(docs.columns, docs.columns, strict=True))
    for name in set(ADDED) & set(docs.columns):
        while kept[name] in {*ADDED, *docs.columns}:
            kept[name] = "own_" + kept[name]
    row = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    at = {c: F.col("row").getField(c) for c in (source_col, id_col, text_col)}
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(at[id_col].cast("string"), F.lit(""))).cast("binary"))
    row = row.withColumns({"s": _name(at[source_col]), "o": order})
    sizes = materialize(row.groupBy("s").agg(F.count("*").alias("n")), "sizes")
    if weights is None:
        weight = tempered(F.col("n"))
    else:
        given = F.create_map(*(F.lit(x) for name, w in weights.items() for x in ("+" + name, round(w * 1_000_000))))
        weight = F.coalesce(given[F.col("s")], F.raise_error(F.concat(F.lit("no weight for source "), "s"))).cast("long")
        if min(weights.values()) <= 0:
            raise ValueError("weights must be above 0")
    plan = materialize(period(shares(sizes, weight, resolution)), "period")
    # The period is broadcast up to a checked size, joined plainly beyond it.
    entries = plan.agg(F.coalesce(F.sum(F.size("others")), F.lit(0))).first()[0]
    beside = F.broadcast if entries <= BROADCAST_ENTRIES else (lambda df: df)

    # Ranks within a source: ranges of the order, counted, then ranked each on its own.
    ranges = F.ceil(F.col("n") / RANGE_ROWS).cast("long")
    place = F.floor(F.conv(F.substring("o", 1, 8), 16, 10).cast("long") * ranges / (1 << 32)).cast("long")
    ranged = row.join(beside(sizes), "s").withColumn("range", place)
    counted = ranged.groupBy("s", "range").agg(F.count("*").alias("rows"))
    above = Window.partitionBy("s").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counted = counted.select("s", "range", F.coalesce(F.sum("rows").over(above), F.lit(0)).alias("above"))
    text = F.col("row").getField(text_col)
    within = F.row_number().over(Window.partitionBy("s", "range").orderBy("o", at[id_col], text)) - 1
    ranked = ranged.withColumn("within", within).join(counted, ["s", "range"])
    ranked = ranked.withColumn("rank", F.col("within") + F.col("above"))

    block = F.floor(F.col("rank") / block_rows)
    blocks = ranked.withColumn("block", block).join(beside(plan.select("s", "a").distinct()), "s")
    blocks = blocks.withColumns({"j": F.col("block") % F.col("a"), "turn": F.floor(F.col("block") / F.col("a"))})
    placed = blocks.drop("a").join(beside(plan), ["s", "j"])
    # Rows of every source in the slots before, each at most all it has.
    earlier = F.aggregate(
        F.transform("others", lambda x: F.least(x.n, block_rows * (F.col("turn") * x.a + x.before))),
        F.lit(0).cast("long"),
        lambda total, x: total + x,
    )
    # A source has run out before this slot if it would have had more blocks by then than it has.
    short = F.exists("others", lambda x: F.col("turn") * x.a + x.before > F.ceil(x.n / block_rows))
    return placed.select(
        *[F.col("row").getField(c).alias(name) for c, name in kept.items()],
        F.col("block").cast("long").alias("block"),
        (F.col("turn") * F.col("q") + F.col("slot")).cast("long").alias("slot"),
        (earlier + F.col("rank") % block_rows).cast("long").alias("position"),
        (~short).alias("on_target"),
    )
