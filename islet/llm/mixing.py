"""Mixing sources to target weights by Sainte-Lague apportionment.

Sizes are words.  Targets share the budget by weight; a target that passes
``cap`` times its source stops there and the excess is shared anew.  Each
source is dealt by a seeded hash into shards, and every (source, shard) cell
stands for election with votes in proportion to its words and its source's
target.  The budget's blocks of equally many words go to the highest quotients
votes / (2k + 1), which gives integer quotas per shard.  A cell's documents,
in seeded order, form a ring of words cut into blocks; the cell gives its
first blocks, all the way round as often as its quota asks.  A source has
shards by its own rows, and what its cells cannot give of their quotas its
other cells give, so that a source gives its whole blocks however it is dealt.

Only built-in functions.  The rows shuffle once as (id, size), the driver sees
a few sums a round.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from islet.llm.common import stage

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
BUDGET, CAP = 1.5, 2  # times the size of all sources, of one source
BLOCK_WORDS = 32
SHARD_DOCS = 200_000  # a hot source spreads over shards of about so many documents
SEED = 42


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def rank_sources(sources: DataFrame, weights=WEIGHTS) -> DataFrame:
    """sources(source, ..) -> also rank from 0, by code point, null last, and
    weight.  Sorted by ranges, with an offset per range."""
    parts = 8
    cut = sources.repartitionByRange(parts, F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id())
    cut = stage(cut, "sources")
    before = cut.groupBy("part").agg(F.count(F.lit(1)).alias("n")).withColumn("before", F.sum("n").over(Window.orderBy("part")) - F.col("n"))
    own = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())) - 1
    pick = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    return cut.withColumn("own", own).join(before.select("part", "before"), "part").select(*sources.columns, (F.col("own") + F.col("before")).cast("long").alias("rank")).withColumn("weight", pick)


def with_targets(sources: DataFrame, budget: float = BUDGET, cap: float = CAP) -> DataFrame:
    """Adds target: weight * level, or cap * source_size where that is less.
    Each round closes the sources that the last level filled."""
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    goal, level = budget * total, None
    most = F.col("source_size") * float(cap)
    while True:
        full = F.lit(False) if level is None else most < F.col("weight") * F.lit(level)
        spent, weights = sources.agg(F.coalesce(F.sum(F.when(full, most)), F.lit(0.0)), F.sum(F.when(~full, F.col("weight")))).first()
        new = (goal - spent) / weights if weights else float("inf")
        if new == level or not weights:
            break
        level = new
    share = F.col("weight") * F.lit(level if level is not None else 0.0)
    return sources.withColumn("target", F.when(most < share, most).otherwise(share).cast("double"))


def sainte_lague(cells: DataFrame, seats: int, order: list[str]) -> DataFrame:
    """cells(votes, ..) -> also quota: the cell's number among the ``seats``
    highest quotients votes / (2k + 1), k from 0; ties go by ``order``.

    A level with fewer quotients above it than seats, and one with as many or
    more, close in on each other, 32 levels a round; the few quotients between
    them are then listed and sorted."""
    stats = cells.agg(F.coalesce(F.sum("votes"), F.lit(0.0)), F.count(F.lit(1)), F.max("votes")).first()
    votes, n, top = stats
    if not votes or seats <= 0:
        return cells.withColumn("quota", F.lit(0).cast("long"))

    def above(level) -> Column:  # quotients of at least this level
        return F.floor((F.col("votes") / F.lit(level) + 1) / 2)

    def counts(levels):
        return cells.agg(*[F.sum(above(x)) for x in levels]).first()

    lo, hi = votes / (2.0 * (seats + n)) * 0.999, top * 1.001
    if seats > n:
        hi = min(hi, votes / (2.0 * (seats - n)) * 1.001)
    many, few = counts([lo, hi])
    for _ in range(16):
        if many - few <= 10_000 or not lo < (lo + hi) / 2 < hi:
            break
        levels = [lo * (hi / lo) ** (i / 33) for i in range(1, 33)]
        for level, c in zip(levels, counts(levels)):
            if c >= seats:
                lo, many = level, c
            else:
                hi, few = level, c
                break
    between = cells.select(*order, "votes", F.explode(F.when(above(lo) > above(hi), F.sequence(above(hi), above(lo) - 1))).alias("k"))
    last = between.withColumn("quotient", F.col("votes") / (2 * F.col("k") + 1)).orderBy(F.desc("quotient"), *order).limit(int(seats - few))
    last = last.groupBy(*order).agg(F.count(F.lit(1)).alias("more"))
    return cells.join(last, order, "left").withColumn("quota", (above(hi) + F.coalesce("more", F.lit(0))).cast("long")).drop("more")


def words_to_give(quotas: DataFrame, cap: float = CAP, block_words: int = BLOCK_WORDS) -> DataFrame:
    """quotas(rank, shard, words, quota) -> also give, in words.

    A source gives its cells' blocks, at most the whole blocks in ``cap`` times
    its words.  A cell gives its quota up to ``cap`` times its words; the rest
    goes to the source's other cells in order of their (seeded) shards, a cell
    after the other up to that bound, so a cell's last block can be partial."""
    of = Window.partitionBy("rank")
    before = of.orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    whole = F.least(F.sum("quota").over(of), F.floor(F.sum("words").over(of) * float(cap) / block_words)) * block_words
    room = F.floor(F.col("words") * float(cap))
    first = quotas.withColumn("whole", whole).withColumn("room", room).withColumn("own", F.least(F.col("quota") * block_words, "room"))
    # own sums to less than whole if cells are full, to more by rounding
    left = first.withColumn("left", F.col("whole") - F.sum("own").over(of)).withColumn("spare", F.when(F.col("left") < 0, F.col("own")).otherwise(F.col("room") - F.col("own")))
    share = F.greatest(F.lit(0), F.least("spare", F.abs("left") - (F.sum("spare").over(before) - F.col("spare"))))
    return left.withColumn("give", (F.col("own") + F.signum("left") * share).cast("long")).drop("whole", "room", "own", "left", "spare")


def mix(docs: DataFrame, carry: list[str], text: str = "text", source: str = "source", doc_id: str = "doc_id", weights=WEIGHTS, budget: float = BUDGET, cap: float = CAP, block_words: int = BLOCK_WORDS, shard_docs: int = SHARD_DOCS, seed: int = SEED) -> DataFrame:
    """docs -> (row, size, source_size, target, taken).

    ``row`` is a struct of the columns named by ``carry``.  ``taken`` is how
    many of the document's words the mix takes, repeats counted: never over
    ``cap`` times its size, 0 for null and empty texts.  Null sources are one
    source, the last.  Rows that repeat an id are documents of their own, in
    no set order among equals.  An empty table gives no rows.
    """
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(doc_id).cast("string")))
    sized = stage(docs.select(F.struct(*carry).alias("row"), F.col(doc_id).alias("id"), F.col(source).cast("string").alias("source"), n_words(F.col(text)).alias("size"), key.alias("key")), "sizes")
    sources = rank_sources(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n")), weights)
    sources = stage(with_targets(stage(sources, "ranked"), budget, cap), "targets")
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    named = sources.select(F.col("source").alias("of"), "source_size", "rank", "target", F.ceil(F.col("n") / shard_docs).alias("shards"))
    rows = sized.join(named, sized["source"].eqNullSafe(named["of"])).drop("of", "source")
    rows = rows.withColumn("shard", F.conv(F.substring("key", 1, 8), 16, 10).cast("long") % F.col("shards"))
    cells = stage(rows.groupBy("rank", "shard").agg(F.sum("size").alias("words"), F.first("target").alias("target"), F.first("source_size").alias("source_size")).withColumn("votes", F.when(F.col("source_size") > 0, F.col("target") * F.col("words") / F.col("source_size")).otherwise(0.0)), "cells")
    quotas = sainte_lague(cells, int(budget * total / block_words + 0.5), ["rank", "shard"])
    quotas = words_to_give(quotas.select("rank", "shard", "words", "quota"), cap, block_words)
    ring = Window.partitionBy("rank", "shard").orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.join(quotas, ["rank", "shard"]).withColumn("start", F.sum("size").over(ring) - F.col("size"))
    rounds = F.when(F.col("words") > 0, F.floor(F.col("give") / F.col("words"))).otherwise(0)
    rest = F.col("give") - rounds * F.col("words")
    taken = rounds * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("start")))
    return rows.select("row", "size", "source_size", "target", taken.cast("long").alias("taken"))
