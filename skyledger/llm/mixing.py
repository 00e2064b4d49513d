"""Mixing sources to target weights: Efraimidis-Spirakis sampling to word budgets.

Every row gets the key ``-ln(u) / weight``: ``u`` is uniform, drawn from the id,
the text and a seed, and the weight is the text's quality. The rows with the
lowest keys of a source are a weighted sample without replacement. A source takes
as many complete epochs as fit its target; for the rest it takes rows in key order
by their prefix sum, up to where the sum is nearest to the target.

Sorting a whole source is not needed for that: sums over ``CELLS`` cells of the
key range tell in which cell the budget ends, only that cell is sorted, and what
comes out is a cut, a key per source. Applying it is a scan.

Targets: all sources share the total size by weight; a target stops at ``MOST``
times its source's size and the excess is shared again.

A null text has size 0. Rows of size 0 come with complete epochs only. Null
sources are one source, after all others. Rows equal in id and text are equal
to the mix: where the budget ends among them, it takes as many as fit. Of an empty
table nothing is taken. Other columns are ignored or, in ``mixed_rows``, passed on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skyledger.llm.common import Scratch

#: Weights of the sources in order, repeating.
WEIGHTS = (1, 2, 3)
#: Times its size that a source, and so a document, may contribute.
MOST = 3
#: Cells of the key range of a source.
CELLS = 4096
SEED = "mix-1"
#: Sources up to which the plan, a row per source, is broadcast.
BROADCAST_SOURCES = 100_000


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def quality_weight(text: Column) -> Column:
    """0.05 to 1: lower where symbols make up more of the text."""
    plain = F.length(F.translate(text, "#*$%&|<>!", "")) / F.length(text)
    return F.when(F.length(text) > 0, F.greatest(plain * plain, F.lit(0.05))).otherwise(1.0)


def uniform(doc_id: Column, text: Column) -> Column:
    """In (0, 1], from 48 bits of a digest."""
    parts = [F.coalesce(c, F.lit("")) for c in (doc_id.cast("string"), F.md5(text.cast("binary")))]
    bits = F.conv(F.substring(F.md5(F.concat_ws("/", F.lit(SEED), *parts)), 1, 12), 16, 10)
    return (bits.cast("double") + 1) / float(1 << 48)


def measured(docs: DataFrame, *more: Column) -> DataFrame:
    """``source, size, key`` of each row, and further columns."""
    text = F.col("text")
    return docs.select(
        *more,
        F.col("source").cast("string").alias("source"),
        n_words(text).alias("size"),
        (-F.ln(uniform(F.col("doc_id"), text)) / quality_weight(text)).alias("key"),
    )


def _cell() -> Column:
    # Any increasing function of the key would do; this one makes cells alike.
    return F.floor((1 - F.exp(-F.col("key"))) * CELLS)


def targets(sizes: DataFrame) -> DataFrame:
    """Adds ``target`` to ``source, source_size``, one row per source.

    A source takes the lesser of its cap and its weight times a common level. In
    order of cap by weight, sources are capped as long as the level that is left
    for all later ones reaches theirs; the first that is not sets the level.
    """
    ranked = sizes.withColumn(
        "nth", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    )
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("nth") % len(WEIGHTS) + 1).cast("int"))
    ranked = ranked.select("*", weight.alias("weight"), (F.col("source_size") * MOST).alias("cap"))
    here = W.orderBy(F.col("cap") / F.col("weight"), "nth").rowsBetween(W.unboundedPreceding, -1)
    whole = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)

    def left(column: str, capped: str) -> Column:
        return F.sum(column).over(whole) - F.coalesce(F.sum(capped).over(here), F.lit(0))

    levels = ranked.withColumn("level", left("source_size", "cap") / left("weight", "weight"))
    open_ = F.col("cap") > F.col("level") * F.col("weight")
    first = F.min(F.when(open_, F.struct(F.col("cap") / F.col("weight"), "nth", "level")))
    target = F.when(open_, first.over(whole)["level"] * F.col("weight"))
    return levels.select(
        "source", "source_size", F.coalesce(target, F.col("cap").cast("double")).alias("target")
    )


def _join(rows: DataFrame, plan: DataFrame, wide: bool) -> DataFrame:
    plan = plan.withColumnRenamed("source", "plan_source")
    on = F.col("source").eqNullSafe(F.col("plan_source"))
    return rows.join(plan if wide else F.broadcast(plan), on).drop("plan_source")


class Mix:
    """The plan of a mix: target, epochs and cut of each source."""

    def __init__(self, rows: DataFrame, scratch: Scratch):
        """``rows``: ``source, size, key`` of all documents."""
        cells = scratch.keep(
            rows.groupBy("source", _cell().alias("cell")).agg(F.sum("size").alias("size")), "cells"
        )
        sizes = cells.groupBy("source").agg(F.sum("size").alias("source_size"))
        epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
        budget = scratch.keep(
            targets(sizes)
            .withColumn("epochs", F.coalesce(epochs, F.lit(0)))
            .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")),
            "budget",
        )
        self.wide = budget.count() > BROADCAST_SOURCES
        along = W.partitionBy("source").orderBy("cell")
        until = F.sum("size").over(along)
        ending = (
            _join(cells.withColumn("until", until), budget, self.wide)
            .where(F.col("until") > F.col("rest"))
            .groupBy("source")
            .agg(F.min(F.struct("cell", (F.col("until") - F.col("size")).alias("before"))).alias("end"))
            .select("source", "end.cell", "end.before")
            .withColumnsRenamed({"source": "end_source", "cell": "end_cell"})
        )
        ends = F.col("source").eqNullSafe(F.col("end_source"))
        plan = scratch.keep(budget.join(ending, ends, "left").drop("end_source"), "plan")
        # Rows with the same key are equal in id and text, and so in size.
        last = (
            _join(rows.withColumn("cell", _cell()), plan, self.wide)
            .where((F.col("cell") == F.col("end_cell")) & (F.col("size") > 0))
            .groupBy("source", "key", "size", "before", "rest")
            .agg(F.count(F.lit(1)).alias("n"))
        )
        in_order = W.partitionBy("source").orderBy("key").rowsBetween(W.unboundedPreceding, -1)
        sooner = F.col("before") + F.coalesce(F.sum(F.col("n") * F.col("size")).over(in_order), F.lit(0))
        fits = F.floor((F.col("rest") - sooner) / F.col("size") + 0.5)
        cut = (
            last.withColumn("taken", F.least(fits, F.col("n")))
            .where(F.col("taken") > 0)
            .groupBy("source")
            .agg(F.max(F.struct("key", "taken", "n")).alias("cut"))
            .select(F.col("source").alias("cut_source"), "cut")
        )
        cuts = F.col("source").eqNullSafe(F.col("cut_source"))
        self.plan = scratch.keep(
            plan.join(cut, cuts, "left").select(
                "source",
                "source_size",
                "target",
                "epochs",
                "end_cell",
                F.col("cut.key").alias("cut_key"),
                F.col("cut.taken").alias("cut_taken"),
                F.when(F.col("cut.taken") < F.col("cut.n"), True).otherwise(False).alias("split"),
            ),
            "cuts",
        )
        self.split = not self.plan.where("split").isEmpty()
        scratch.drop("cells", "budget", "plan")

    def copies(self, rows: DataFrame) -> DataFrame:
        """Adds the plan's columns and ``copies``, how often the mix takes each row."""
        rows = _join(rows, self.plan, self.wide)
        at_cut = F.col("cut_key").isNotNull() & (F.col("key") == F.col("cut_key"))
        # Cells before the one where the budget ends are taken whole.
        sooner = (_cell() < F.col("end_cell")) | (F.col("key") < F.col("cut_key"))
        extra = (F.col("size") > 0) & F.coalesce(sooner, F.lit(False))
        if not self.split:
            return rows.withColumn("copies", F.col("epochs") + (extra | at_cut).cast("long"))
        equal = at_cut & F.col("split")
        nth = F.row_number().over(W.partitionBy("source").orderBy("key"))
        some = rows.where(equal).withColumn("copies", F.col("epochs") + (nth <= F.col("cut_taken")).cast("long"))
        rest = rows.where(~equal).withColumn("copies", F.col("epochs") + (extra | at_cut).cast("long"))
        return rest.unionByName(some)


def mix(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of every row; ``taken`` counts
    the words the mix takes of it, repeats included."""
    rows = scratch.keep(measured(docs, F.col("doc_id").cast("long").alias("doc_id")), "rows")
    taken = Mix(rows, scratch).copies(rows)
    return taken.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def mixed_rows(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows of the mix, all columns, each as often as the mix takes it."""
    plan = Mix(scratch.keep(measured(docs), "rows"), scratch)
    rows = plan.copies(measured(docs, F.struct(*docs.columns).alias("row")))
    again = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return rows.where(F.col("copies") > 0).select("row", again.alias("copy")).select("row.*")
