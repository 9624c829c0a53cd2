"""Relationships of the star schema, and whether the data keeps them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reportstar.staging import stage

Tables = dict[str, DataFrame]

#: Ids in one bitmap, as Spark's functions have them.
BITS = 32768
#: A bitmap is used where there is at least one id to so many numbers: then it takes no more room than the ids.
SPREAD = 64


def _columns(spark: SparkSession, tables: Tables) -> DataFrame:
    """Catalogue of the bundle: ``table, rank, column, position``, a row per column."""
    listed = [(name, rank, c, at) for rank, (name, df) in enumerate(tables.items()) for at, c in enumerate(df.columns)]
    return spark.createDataFrame(listed, "table string, rank int, column string, position int")


def relationships_table(spark: SparkSession, tables: Tables) -> DataFrame:
    """Foreign keys found by joining the facts' columns with the primary keys of the dimensions.

    The key of a dimension leads its columns. Where two dimensions lead with one name, the later is meant.
    """
    listed = _columns(spark, tables)
    keys = (
        listed.filter(F.col("table").startswith("dim_") & (F.col("position") == 0) & F.col("column").endswith("_id"))
        .groupBy("column")
        .agg(F.max_by("table", "rank").alias("toTable"))
    )
    uses = listed.filter(F.col("table").startswith("fact_"))
    return (
        uses.join(keys, "column")
        .orderBy("rank", "position")
        .select(
            F.col("table").alias("fromTable"),
            F.col("column").alias("fromColumn"),
            "toTable",
            F.col("column").alias("toColumn"),
            F.lit("manyToOne").alias("cardinality"),
            F.lit(True).alias("active"),
        )
    )


def relationships(tables: Tables) -> list[dict]:
    """The rows of ``relationships_table``: one per foreign key column of the schema."""
    spark = next(iter(tables.values())).sparkSession
    return [r.asDict() for r in relationships_table(spark, tables).collect()]


def _ids(df: DataFrame, column: str, *more: Column) -> DataFrame:
    return df.select(*more, F.col(column).cast("bigint").alias("id"))


def _dense(tables: Tables) -> set[str]:
    """Dimensions whose ids lie close together, so that a bitmap over them is no larger than a list."""
    dims = [name for name in tables if name.startswith("dim_")]
    ends = [
        _ids(tables[name], tables[name].columns[0]).agg(F.lit(name).alias("name"), F.count("id").alias("n"), F.min("id").alias("low"), F.max("id").alias("high"))
        for name in dims
    ]
    found = reduce(DataFrame.unionByName, ends).collect() if ends else []
    return {r["name"] for r in found if r["n"] and r["high"] - r["low"] < SPREAD * r["n"] + BITS}


def _references(tables: Tables, found: Sequence[dict]) -> DataFrame:
    """``fromTable, fromColumn, toTable, id`` of every fact row and key; each fact is scanned once."""
    parts = []
    for fact in dict.fromkeys(r["fromTable"] for r in found):
        pairs = [
            F.struct(
                F.lit(r["fromColumn"]).alias("fromColumn"),
                F.lit(r["toTable"]).alias("toTable"),
                F.col(r["fromColumn"]).cast("bigint").alias("id"),
            )
            for r in found
            if r["fromTable"] == fact
        ]
        parts.append(tables[fact].select(F.lit(fact).alias("fromTable"), F.inline(F.array(*pairs))))
    return reduce(DataFrame.unionByName, parts)


def _keys(tables: Tables, names: Sequence[str]) -> DataFrame:
    """``toTable, id`` of the dimensions."""
    return reduce(DataFrame.unionByName, [_ids(tables[n], tables[n].columns[0], F.lit(n).alias("toTable")) for n in names])


def _bitmaps(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bitmaps of ``id`` per key and range of ``BITS`` ids, reduced map-side; rows without an id have no range.

    ``is_key`` tells rows of dimensions: ``present`` has their ids, ``all`` those of every row. ``n`` counts the
    rows of dimensions, ``used`` the others.
    """
    at = F.bitmap_bit_position("id")
    return rows.groupBy(*keys, F.bitmap_bucket_number("id").alias("range")).agg(
        F.bitmap_count(F.bitmap_construct_agg(at)).alias("all"),
        F.bitmap_count(F.bitmap_construct_agg(F.when(F.col("is_key"), at))).alias("present"),
        F.count_if("is_key").alias("n"),
        F.count_if(~F.col("is_key")).alias("used"),
    )


def _in_ranges(rows: DataFrame, ranges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows whose id lies in one of the few ``ranges``."""
    found = ranges.select(*[F.col(k).alias(f"r_{k}") for k in keys], F.col("range").alias("r_range"))
    same = F.bitmap_bucket_number("id") == F.col("r_range")
    for k in keys:
        same = same & (F.col(k) == F.col(f"r_{k}"))
    return rows.join(found, same, "left_semi")


def key_report(tables: Tables) -> DataFrame:
    """Per dimension: rows, distinct keys, keys that occur more than once, rows without a key.

    Dense ids are counted in bitmaps; ids are grouped in those ranges only that hold more rows than ids.
    """
    names, dense = [n for n in tables if n.startswith("dim_")], _dense(tables)
    reports = []
    if dense:
        keys = _keys(tables, [n for n in names if n in dense]).withColumn("is_key", F.lit(True))
        maps = stage(_bitmaps(keys, ["toTable"]), "key_bitmaps")
        full = maps.filter("range is not null")
        crowded = full.filter(F.col("n") > F.col("present"))
        twice = _in_ranges(keys, crowded, ["toTable"]).groupBy("toTable", "id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        repeated = twice.groupBy(F.col("toTable").alias("t")).agg(F.count(F.lit(1)).alias("again"))
        rows = maps.groupBy("toTable").agg(
            F.sum("n").alias("rows"), F.sum(F.when(F.col("range").isNotNull(), F.col("present")).otherwise(0)).alias("keys"),
            F.sum(F.when(F.col("range").isNull(), F.col("n")).otherwise(0)).alias("null_keys"))
        rows = rows.join(repeated, F.col("toTable") == F.col("t"), "left") if not crowded.isEmpty() else rows.withColumn("again", F.lit(0))
        reports.append(rows.select(F.col("toTable").alias("table"), "rows", "keys", F.coalesce("again", F.lit(0)).cast("bigint").alias("repeated_keys"), "null_keys"))
    if others := [n for n in names if n not in dense]:
        known = F.col("id").isNotNull()
        counts = _keys(tables, others).groupBy("toTable", "id").agg(F.count(F.lit(1)).alias("n"))
        reports.append(counts.groupBy(F.col("toTable").alias("table")).agg(
            F.sum("n").alias("rows"),
            F.count_if(known).alias("keys"),
            F.count_if(known & (F.col("n") > 1)).alias("repeated_keys"),
            F.sum(F.when(~known, F.col("n")).otherwise(0)).alias("null_keys"),
        ))
    return reduce(DataFrame.unionByName, reports)


_RELATION = ("fromTable", "fromColumn", "toTable")


def integrity(tables: Tables) -> DataFrame:
    """Per relationship: fact rows, rows with a NULL key, rows whose key has no dimension row.

    Keys to dense ids meet them as bitmaps: a range whose ids all are in the dimension has no orphan. Fact rows are
    counted by id in the other ranges only.
    """
    found, dense = relationships(tables), _dense(tables)
    parts = []
    if mapped := [r for r in found if r["toTable"] in dense]:
        parts.append(_integrity_by_bitmap(tables, mapped))
    if others := [r for r in found if r["toTable"] not in dense]:
        used = _references(tables, others).groupBy(*_RELATION, "id").agg(F.count(F.lit(1)).alias("n"))
        keys = _keys(tables, sorted({r["toTable"] for r in others})).filter("id is not null").distinct().withColumn("present", F.lit(True))
        met = used.join(keys, ["toTable", "id"], "left")
        null_key = F.col("id").isNull()
        parts.append(met.groupBy(*_RELATION).agg(
            F.sum("n").alias("rows"),
            F.sum(F.when(null_key, F.col("n")).otherwise(0)).alias("null_keys"),
            F.sum(F.when(~null_key & F.col("present").isNull(), F.col("n")).otherwise(0)).alias("orphans"),
        ))
    return reduce(DataFrame.unionByName, parts)


def _integrity_by_bitmap(tables: Tables, found: Sequence[dict]) -> DataFrame:
    used = _references(tables, found).withColumn("is_key", F.lit(False))
    # The keys of a dimension are given to each relationship that needs them.
    uses = F.inline(F.array(*[F.struct(*[F.lit(r[c]).alias(c) for c in _RELATION]) for r in found]))
    dims = _keys(tables, sorted({r["toTable"] for r in found})).withColumnRenamed("toTable", "of")
    keys = dims.select("of", "id", uses).filter("toTable = of").select(*_RELATION, "id", F.lit(True).alias("is_key"))
    maps = stage(_bitmaps(used.unionByName(keys), _RELATION), "reference_bitmaps")
    open_ranges = maps.filter("range is not null and all > present")
    report = maps.groupBy(*_RELATION).agg(
        F.sum("used").alias("rows"), F.sum(F.when(F.col("range").isNull(), F.col("used")).otherwise(0)).alias("null_keys"))
    # Relationships of facts without rows are not reported, as before.
    report = report.filter("rows > 0")
    if open_ranges.isEmpty():
        return report.withColumn("orphans", F.lit(0).cast("bigint"))
    near = _in_ranges(used, open_ranges, _RELATION).groupBy(*_RELATION, "id").agg(F.count(F.lit(1)).alias("n"))
    known = _in_ranges(keys, open_ranges, _RELATION).select(*_RELATION, "id").distinct()
    lost = near.join(known, [*_RELATION, "id"], "left_anti").groupBy(*_RELATION).agg(F.sum("n").alias("orphans"))
    return report.join(lost, list(_RELATION), "left").select(*_RELATION, "rows", "null_keys", F.coalesce("orphans", F.lit(0)).alias("orphans"))


def orphans(fact: DataFrame, column: str, dim: DataFrame, key: str) -> DataFrame:
    """Keys of the fact that the dimension lacks, with their row counts."""
    used = fact.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    known = dim.select(F.col(key).alias("__key"))
    return used.join(known, F.col(column) == F.col("__key"), "left_anti")
