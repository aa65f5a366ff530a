"""Mixing sources to target weights by entropy balancing.

Of all document rates that give every source its target of words, with none above a limit, the ones closest in entropy to
one common rate q are r = min(limit, q * exp(lambda * size)), with one lambda for each source. The lambdas solve a convex
dual by Newton's method: every iteration is an aggregate over (source, size) cells, whose documents share a rate. Rates are
then rounded into copies, within a cell by the documents' hashes.

All sums of rates are decimals, so they do not depend on the order of rows, and a rerun gives the same copies.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assaylake.session import settle

#: Weights of the sources in code point order, repeating; the mix's words in hundredths of all; most copies of a document.
WEIGHTS, PERCENT, LIMIT = (5, 2, 1), 150, 2
#: Newton ends when no source is further from its target than this share of it.
NEAR, ITERATIONS = 1e-9, 100
#: Times that the words left over by rounding are made up for.
ROUNDS = 4
#: The most frequent cells are split into blocks of so many documents; any other cell has at most one row of HOT.
HOT, BLOCK = 2000, 1024
EXACT = "decimal(38,9)"


def sizes(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """doc_id, source, size (words) and a hash that deals rows out."""
    body = F.col(f"`{text}`").cast("string")
    return docs.select(
        F.col(f"`{key}`").alias("doc_id"),
        F.col(f"`{source}`").cast("string").alias("source"),
        F.coalesce(F.regexp_count(body, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("bigint").alias("size"),
        F.xxhash64(F.col(f"`{key}`"), body).alias("hash"),
    )


def ranked(sources: DataFrame) -> DataFrame:
    """`sources` with `rank`, from 0 in code point order, null last: numbered within ranges, plus the rows of earlier ranges."""
    cut = settle(sources.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()), "source-ranges")
    counts = cut.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))  # a row a range
    within = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last()))
    return cut.withColumn("rank", within).join(before, "part").withColumn("rank", F.col("rank") - 1 + F.col("before")).drop("part", "before")


def with_targets(sources: DataFrame, weights: Sequence[float] = WEIGHTS, percent: float = PERCENT, limit: int = LIMIT) -> DataFrame:
    """`sources` (source, source_size) with `target`: `percent` of all sizes shared by weight, and what is above `limit` times
    a source's size shared again among the others, until none is above."""
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    known = settle(ranked(sources).withColumn("weight", weight), "sources")
    most = (limit * F.col("source_size")).cast("double")
    level = 0.0
    while True:  # one pair of numbers per round; the level only rises
        full = F.col("weight") * level > most
        row = known.agg(
            F.sum("source_size").alias("all"), F.sum(F.when(full, F.col("source_size") * limit).otherwise(0)).alias("held"), F.sum(F.when(~full, F.col("weight"))).alias("open")
        ).first()
        left = (row["all"] or 0) * percent / 100 - (row["held"] or 0)
        raised = left / row["open"] if row["open"] else float("inf")
        if raised <= level or raised == float("inf"):
            break
        level = raised
    return known.withColumn("target", F.least(F.col("weight") * level, most)).drop("weight", "rank", "n")


def _rate(tilt: Column, size: Column, base: float, limit: int) -> Column:
    """min(limit, base * exp(tilt * size)), the exponent bounded first so that nothing overflows."""
    return F.least(F.lit(float(limit)), F.lit(base) * F.exp(F.least(tilt * size, F.lit(50.0))))


def tilts(cells: DataFrame, sources: DataFrame, base: float, limit: int = LIMIT) -> DataFrame:
    """`sources` with the `tilt` (lambda) that gives each its target, from `cells` (source, size, n).

    Newton's step on the dual: its slope is the words that the rates give beyond the target, its curvature the sum of
    rate * size**2 over the documents below the limit. Slopes rise with lambda, so each also narrows a bracket; a step that
    leaves the bracket, or has no curvature, becomes the bracket's middle.
    """
    least = cells.where("size > 0").groupBy("source").agg(F.min("size").cast("double").alias("least"))
    state = sources.join(least.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")), "left").drop("of")
    # at the bracket's ends even the smallest document, which moves least, has come to the limit, or low enough
    low = F.least(F.lit(0.0), F.log(F.col("target") / (F.lit(base) * F.col("source_size"))) / F.col("least"))
    high = F.log(F.lit(limit / base)) / F.col("least")
    solvable = (F.col("target") > 0) & (F.col("target") < limit * F.col("source_size"))
    state = state.withColumns({"solvable": F.coalesce(solvable, F.lit(False)), "low": low, "high": high})
    state = settle(state.withColumn("tilt", F.when(F.col("solvable"), F.lit(0.0))).drop("least"), "tilts")
    points = cells.withColumnsRenamed({"source": "of"}).where("size > 0")
    for _ in range(ITERATIONS):
        met = points.join(state.where("solvable"), F.col("source").eqNullSafe(F.col("of")))
        rate = _rate(F.col("tilt"), F.col("size"), base, limit)
        words = (F.col("n") * F.col("size") * rate).cast(EXACT)
        curve = F.when(rate < limit, F.col("n") * F.col("size") * F.col("size") * rate).otherwise(0.0).cast(EXACT)
        slopes = met.groupBy("of").agg(F.sum(words).cast("double").alias("words"), F.sum(curve).cast("double").alias("curve"))
        joined = state.join(slopes, F.col("source").eqNullSafe(F.col("of")), "left").drop("of")
        beyond = F.col("words") - F.col("target")
        low, high = F.when(beyond < 0, F.col("tilt")).otherwise(F.col("low")), F.when(beyond > 0, F.col("tilt")).otherwise(F.col("high"))
        moved = joined.withColumns({"low": low, "high": high, "step": F.col("tilt") - F.try_divide(beyond, F.col("curve"))})
        inside = (F.col("step") > F.col("low")) & (F.col("step") < F.col("high"))
        fresh = F.when(inside, F.col("step")).otherwise((F.col("low") + F.col("high")) / 2)
        done = F.abs(beyond) <= NEAR * F.col("target")
        moved = moved.withColumn("tilt", F.when(done, F.col("tilt")).otherwise(fresh)).withColumn("done", done).drop("words", "curve", "step")
        moved = settle(moved, "tilts")
        state = moved.drop("done")
        if moved.where("solvable and not done").isEmpty():
            break
    return state.drop("low", "high")


def copies(cells: DataFrame, limit: int = LIMIT) -> DataFrame:
    """`cells` (source, target, size > 0, n, rate) with `taken`, the copies of all documents of a cell, from 0 to limit * n.

    Down the sizes of a source, the running sum of rates is rounded; that leaves the source at most half its largest size
    from its target. What is left is made up by whole copies of the largest cells that fit, as change is given, and ROUNDS - 1
    times more after a copy that goes beyond it, as long as that comes nearer. A source has as many cells as different sizes,
    at most its longest text's words, however many documents it has.
    """
    down = Window.partitionBy("source").orderBy(F.desc("size"))
    so_far = F.sum((F.col("n") * F.col("rate")).cast(EXACT)).over(down.rowsBetween(Window.unboundedPreceding, 0))
    upto = cells.withColumn("upto", F.floor(so_far + F.lit(0.5)))
    taken = F.col("upto") - F.lag("upto", 1, 0).over(down)
    # rounding the sum may ask a full cell for one copy too many
    first = upto.withColumn("taken", F.greatest(F.lit(0), F.least(limit * F.col("n"), taken)).cast("bigint")).drop("upto")

    def change(state: Column, cell: Column) -> Column:
        left, given = state["left"], state["given"]
        wanted = (left / cell["size"]).cast("bigint")  # towards zero
        more = F.greatest(-cell["taken"], F.least(limit * cell["n"] - cell["taken"], wanted))
        noted = F.concat(given, F.array(F.struct(cell["size"].alias("size"), more.alias("more"))))
        paid = F.struct((left - more * cell["size"]).cast("bigint").alias("left"), noted.alias("given"))
        return F.when(more == 0, state).otherwise(paid)

    def settled(cells: Column, given: Column) -> Column:
        by_size = F.map_from_entries(given)
        one = lambda c: F.struct(c["size"].alias("size"), c["n"].alias("n"), (c["taken"] + F.coalesce(F.element_at(by_size, c["size"]), F.lit(0))).alias("taken"))
        return F.when(F.size(given) == 0, cells).otherwise(F.transform(cells, one))

    listed = first.groupBy("source").agg(
        F.sort_array(F.collect_list(F.struct("size", "n", "taken")), asc=False).alias("cells"),
        (F.round(F.first("target")).cast("bigint") - F.sum(F.col("taken") * F.col("size"))).alias("left"),
    )
    none = F.array().cast("array<struct<size:bigint,more:bigint>>")
    for again in range(ROUNDS):
        cells, left = F.col("cells"), F.col("left")
        if again:
            # what is left is less than any copy that could still go or come: take the smallest one beyond it, then give change
            room = F.filter("cells", lambda c: (c["size"] > F.abs(left)) & F.when(left > 0, c["taken"] < limit * c["n"]).otherwise(c["taken"] > 0))
            more = F.when(left > 0, F.lit(1)).otherwise(F.lit(-1)).cast("bigint")
            beyond = F.get(room, F.size(room) - 1)
            listed = listed.withColumn("beyond", F.when((left != 0) & (F.size(room) > 0), F.array(F.struct(beyond["size"].alias("size"), more.alias("more")))).otherwise(none))
            cells = settled(F.col("cells"), F.col("beyond"))
            left = left - F.coalesce(F.get("beyond", F.lit(0))["size"] * F.get("beyond", F.lit(0))["more"], F.lit(0))
        tried = listed.withColumns({"try": cells, "rest": left})
        tried = tried.withColumn("paid", F.aggregate("try", F.struct(F.col("rest").alias("left"), none.alias("given")), change))
        better = F.abs("paid.left") < F.abs("left")
        listed = tried.select(
            "source",
            F.when(better, settled(F.col("try"), F.col("paid.given"))).otherwise(F.col("cells")).alias("cells"),
            F.when(better, F.col("paid.left")).otherwise(F.col("left")).alias("left"),
        )
        listed = settle(listed, "change")
    given = listed.select(F.col("source").alias("of"), F.inline("cells")).select("of", F.col("size").alias("at"), F.col("taken").alias("fixed"))
    fixed = first.join(given, F.col("source").eqNullSafe(F.col("of")) & (F.col("size") == F.col("at")))
    return fixed.withColumn("taken", F.col("fixed")).drop("of", "at", "fixed")


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    percent: float = PERCENT,
    limit: int = LIMIT,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """Of every row: doc_id, size (words), source, source_size, target (of its source), rate, copies and taken (words).

    Sources in code point order, null last, have the weights in turn; see `with_targets`. Null texts have no words; rows
    without words have rate and copies 0, as have sources without words. The empty source is one of its own. Null and
    repeated ids are rows like any other; equal rows may differ in copies by one, and which of them has more is not fixed. Other
    columns are ignored; an empty table gives no rows.

    Texts are read once; 40 bytes a row are shuffled once to count cells, combined before, and once to choose within them.
    """
    rows = settle(sizes(docs, key, text, source), "sizes")
    cells = settle(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "cells")
    total = cells.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    sources = settle(with_targets(total, weights, percent, limit), "targets")
    base = percent / 100
    tilted = tilts(cells, sources, base, limit).withColumnRenamed("source", "of")
    met = cells.join(tilted, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    plain = F.when(F.col("target") > 0, F.lit(float(limit))).otherwise(0.0)  # a source at its limit, or without words
    rate = F.when(F.col("size") == 0, 0.0).when(F.col("solvable"), _rate(F.col("tilt"), F.col("size"), base, limit)).otherwise(plain)
    rated = settle(met.withColumn("rate", rate).drop("solvable", "tilt"), "rates")
    counted = copies(rated.where("size > 0"), limit).unionByName(rated.where("size = 0").withColumn("taken", F.lit(0).cast("bigint")))
    counted = settle(counted, "cell-copies")

    # blocks of the most frequent cells, so that no cell's documents must meet in one task
    frequent = cells.where(F.col("n") > BLOCK).orderBy(F.desc("n"), "size", "source").limit(HOT)
    split = frequent.select(F.col("source").alias("of"), F.col("size").alias("at"), F.ceil(F.col("n") / BLOCK).alias("blocks"))
    dealt = rows.join(F.broadcast(split), F.col("source").eqNullSafe(F.col("of")) & (F.col("size") == F.col("at")), "left")
    dealt = dealt.withColumn("block", F.pmod("hash", F.coalesce("blocks", F.lit(1)))).drop("of", "at", "blocks")
    blocks = dealt.groupBy("source", "size", "block").agg(F.count(F.lit(1)).alias("here"))
    of, at = F.col("source").eqNullSafe(F.col("of")), F.col("size") == F.col("at")
    blocks = blocks.join(counted.withColumnsRenamed({"source": "of", "size": "at"}), of & at).drop("of", "at")
    # every document has the whole copies of its cell, and the rest goes to the blocks by their share, and there by hash
    along = Window.partitionBy("source", "size").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    share = F.floor(F.sum(F.col("here").cast("decimal(38,0)")).over(along) * (F.col("taken") % F.col("n")) / F.col("n"))
    blocks = blocks.withColumn("share", share)
    blocks = blocks.withColumn("extra", F.col("share") - F.lag("share", 1, 0).over(Window.partitionBy("source", "size").orderBy("block")))
    blocks = blocks.withColumn("each", F.floor(F.col("taken") / F.col("n")))
    chosen = blocks.select(F.col("source").alias("of"), F.col("size").alias("at"), F.col("block").alias("in"), "source_size", "target", "rate", "each", "extra")
    order = F.row_number().over(Window.partitionBy("source", "size", "block").orderBy("hash", "doc_id"))
    out = dealt.withColumn("order", order).join(chosen, of & at & (F.col("block") == F.col("in")))
    count = (F.col("each") + F.when(F.col("order") <= F.col("extra"), 1).otherwise(0)).cast("bigint")
    return out.withColumn("copies", count).select(
        "doc_id", "size", "source", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )
