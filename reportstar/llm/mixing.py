"""Mix sources to target weights by Poisson replication.

A source with ``n`` rows and weight ``w`` gets the mean rate ``w / sum of weights * rows / n``, so that
the mix has as many rows as the input on average. The copies of a row are a Poisson number with that
mean: the inverse distribution function at a number in [0, 1) from the md5 of seed and ``doc_id``, looked up in a table
of the ranges that stand for each number of copies.
Rows are repeated by that number and sorted globally by the md5 of seed, ``doc_id`` and copy.

A null source is a source of its own with the default weight. Null ``doc_id`` counts as an empty text in
the hash; repeated rows have equal numbers of copies. Weight 0 removes a source. Texts are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reportstar.llm.common import free_name
from reportstar.operators.lookup import BROADCAST_BYTES, BROADCAST_ROWS, stage_measured

SEED = "mix-1"
#: Target share of the source that holds a third of the rows; all others share the rest equally.
TARGET = {"src0": 0.1}
DEFAULT = 0.05
#: Cells of [0, 1) in which numbers and ranges of the distribution meet.
CELLS = 1024


def uniform(*parts: Column) -> Column:
    """52 bits of the md5 of the joined parts as a number in [0, 1)."""
    digest = F.md5(F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts)))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def rates(docs: DataFrame, weights: dict[str, float], default: float) -> DataFrame:
    """``s, rate``: mean copies of every source of positive weight."""
    known = F.create_map(*(x for k, w in weights.items() for x in (F.lit(k), F.lit(float(w))))) if weights else None
    weight = F.lit(float(default)) if known is None else F.coalesce(known[F.col("s")], F.lit(float(default)))
    sizes = docs.groupBy(F.col("source").cast("string").alias("s")).agg(F.count("*").alias("n")).withColumn("w", weight)
    rows, total = sizes.agg(F.sum("n"), F.sum("w")).first()
    rate = (F.col("w") / F.lit(total) * F.lit(rows) / F.col("n")).cast("double")
    return sizes.filter("w > 0").select("s", rate.alias("rate"))


def ranges(rates: DataFrame) -> DataFrame:
    """``s, cell, low, high, copies``: the numbers in [0, 1) that stand for so many copies, by cells of ``1 / CELLS``.

    The distribution function of a source is a running sum over ``rate + 12 * sqrt(rate) + 30`` steps. Steps that add nothing to a
    double are left out, so a source has some ``24 * sqrt(rate)`` ranges, each in the cells that it touches.
    """
    steps = F.col("rate") + 12 * F.sqrt("rate") + 30
    rows = rates.select("s", "rate", F.explode(F.sequence(F.lit(0), steps.cast("int"))).alias("k"))
    upto = Window.partitionBy("s").orderBy("k")
    factorial = F.sum(F.when(F.col("k") > 0, F.log(F.col("k").cast("double"))).otherwise(0.0)).over(upto)
    rows = rows.withColumn("p", F.exp(F.col("k") * F.log("rate") - F.col("rate") - factorial))
    rows = rows.withColumn("high", F.sum("p").over(upto))
    rows = rows.withColumn("low", F.coalesce(F.lag("high").over(upto), F.lit(0.0)))
    # Beyond the last step, where a number lies once in 10**16 rows, one more copy.
    last = F.lead("k").over(upto).isNull()
    pieces = F.array(F.struct("low", "high", F.col("k").alias("copies")), F.struct(F.col("high").alias("low"), F.lit(2.0).alias("high"), (F.col("k") + 1).alias("copies")))
    rows = rows.withColumn("pieces", F.when(last, pieces).otherwise(F.slice(pieces, 1, 1))).select("s", F.inline("pieces"))
    rows = rows.filter("high > low and low < 1")
    cell = lambda x: F.least(F.floor(x * CELLS), F.lit(CELLS - 1)).cast("int")
    return rows.select("s", F.explode(F.sequence(cell(F.col("low")), cell(F.col("high")))).alias("cell"), "low", "high", "copies")


def mix_sources(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    default: float = DEFAULT,
    seed: str = SEED,
    copy_name: str | None = None,
    key_name: str | None = None,
) -> DataFrame:
    """Rows of ``docs`` by their copies in a global random order, with the columns of ``docs``.

    ``copy_name`` and ``key_name`` also keep the number of the copy, from 1, and the key of the order.
    The ranges are stored and measured. Up to a bound they are broadcast; beyond, rows and ranges meet by source and cell, and adaptive
    execution splits the source that holds most rows.
    """
    copy, key = copy_name or free_name(docs, "mix_copy"), key_name or free_name(docs, "mix_key")
    names = {c: free_name(docs, f"mix_{c}") for c in ("s", "cell", "low", "high", "copies")}
    drawn = free_name(docs, "mix_u")
    table, rows, size = stage_measured(ranges(rates(docs, TARGET if weights is None else weights, default)), "poisson_ranges")
    table = table.select(*(F.col(c).alias(name) for c, name in names.items()))
    if rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES:
        table = F.broadcast(table)
    u, at = F.col(drawn), {c: F.col(name) for c, name in names.items()}
    same = F.col("source").cast("string").eqNullSafe(at["s"]) & (F.floor(u * CELLS).cast("int") == at["cell"]) & (u >= at["low"]) & (u < at["high"])
    mixed = docs.withColumn(drawn, uniform(F.lit(seed), F.col("doc_id"))).join(table, same).filter(at["copies"] > 0)
    mixed = mixed.withColumn(copy, F.explode(F.sequence(F.lit(1), at["copies"])))
    parts = [F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col(copy)]
    mixed = mixed.withColumn(key, F.md5(F.concat_ws("|", *(p.cast("string") for p in parts)))).orderBy(key)
    extra = [c for c, asked in ((copy, copy_name), (key, key_name)) if asked]
    return mixed.select(*(F.col(f"`{c}`") for c in docs.columns), *extra)
