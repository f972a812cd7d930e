"""Table operators: dedup with aliases, upsert, reuse, reconciliation, contiguity, histories, selections, folds."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from packloom.functions import constants as C

from .lineage import cut


def first_with_aliases(rows: DataFrame, key: Column, order: list[str], identity: str) -> DataFrame:
    """Each row with the first of its key: kept itself, or an alias of it.

    Firsts come from an aggregate and a join, so a key of many rows is no window in one task.
    """
    rows = rows.withColumn("_key", key)
    first = rows.groupBy("_key").agg(F.min_by(identity, F.struct(*order)).alias("kept_id"), F.count("*").alias("in_group"))
    return rows.join(first, "_key").withColumn("is_alias", F.col(identity) != F.col("kept_id")).drop("_key")


def duplicate_contents(rows: DataFrame, digest: Column, order: list[str], identity: str) -> DataFrame:
    """Rows whose content an earlier row has, with that row."""
    return first_with_aliases(rows, digest, order, identity).where("is_alias")


def upsert(old: DataFrame, new: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Catalog merge by key: the last of the new rows wins over the old; action is added, updated or kept.

    Among rows of one key the greatest by `order` is the last.
    """
    columns = [c for c in new.columns if c != key]
    last = lambda df: df.groupBy(key).agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("v"))
    merged = last(old).withColumnRenamed("v", "o").join(last(new).withColumnRenamed("v", "n"), key, "full")
    action = F.when(F.col("o").isNull(), "added").when(F.col("n").isNull(), "kept").otherwise("updated")
    return merged.select(key, F.coalesce("n", "o").alias("v"), action.alias("action")).select(key, "v.*", "action")


def reuse_inventory(requests: DataFrame, catalog: DataFrame) -> DataFrame:
    """Action of each request (screen_ord, asset_ord, key, excluded): exclude, generate or reuse.

    The first screen generates all it asks for; on later ones only the first request of a key that the catalog
    hasn't is generated. This closed form equals the ordered fold over screens for all but framed panels.
    """
    order = F.struct("screen_ord", "asset_ord")
    first = requests.where("not excluded").groupBy("key").agg(F.min(order).alias("first"))
    known = catalog.select("key").distinct().withColumn("in_catalog", F.lit(True))
    out = requests.join(first, "key", "left").join(known, "key", "left")
    made = (F.col("screen_ord") == 0) | ((order == F.col("first")) & F.col("in_catalog").isNull())
    action = F.when(F.col("excluded"), "exclude").when(made, "generate").otherwise("reuse")
    return out.select("screen_ord", "asset_ord", "key", action.alias("action"))


def missing(required: DataFrame, present: DataFrame, key: str) -> DataFrame:
    return required.join(present.select(key), key, "left_anti")


def memoised(wanted: DataFrame, cache: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows of `wanted` with the cached answer of their key, rows that are yet to be answered); the cache has one row a key."""
    return wanted.join(cache, key), wanted.join(cache.select(key), key, "left_anti")


def contiguity(rows: DataFrame, group: str, index: str) -> DataFrame:
    """Whether each group's indices are 1..n, each once."""
    n = F.count("*")
    ok = (F.min(index) == 1) & (F.max(index) == n) & (F.count_distinct(index) == n)
    return rows.groupBy(group).agg(n.alias("n"), F.min(index).alias("least"), F.max(index).alias("most"), ok.alias("contiguous"))


def changes(rows: DataFrame, group: str, order: list[str], signature: str, last: int | None = None) -> DataFrame:
    """Rows whose signature differs from the one before in their group; the last so many of each."""
    w = Window.partitionBy(group).orderBy(*order)
    out = rows.withColumn("_before", F.lag(signature).over(w)).where(~F.col(signature).eqNullSafe(F.col("_before"))).drop("_before")
    if last is None:
        return out
    newest = Window.partitionBy(group).orderBy(*(F.desc(c) for c in order))
    return out.withColumn("_k", F.row_number().over(newest)).where(F.col("_k") <= last).drop("_k")


def runs(rows: DataFrame, line: list[str], position: str, label: str) -> DataFrame:
    """Runs of equal labels at consecutive positions of a line: start, end, length."""
    w = Window.partitionBy(*line, label).orderBy(position)
    island = F.col(position) - F.row_number().over(w)
    out = rows.withColumn("_island", island).groupBy(*line, label, "_island")
    return out.agg(F.min(position).alias("start"), F.max(position).alias("end"), F.count("*").alias("length")).drop("_island")


def inner_runs(found: DataFrame, line: list[str]) -> DataFrame:
    """Runs without the first and last of lines that have more than two."""
    w = Window.partitionBy(*line)
    k = F.row_number().over(w.orderBy("start"))
    n = F.count("*").over(w)
    return found.withColumn("_k", k).withColumn("_n", n).where((F.col("_n") <= 2) | ((F.col("_k") > 1) & (F.col("_k") < F.col("_n")))).drop("_k", "_n")


def packed_sheets(groups: DataFrame, by: str, order: list[str], size: str, name: str, capacity: int | Column, oversized: bool = False) -> DataFrame:
    """Next-fit packing of indivisible groups into sheets of a capacity, in order.

    A group over the capacity has no sheet, or one of its own where oversized groups are to be packed too. A category's
    groups stream through one task in sorted order, and what is kept is the sheet and its fill.
    """
    most = capacity if isinstance(capacity, Column) else F.lit(capacity)
    rows = groups.select(F.col(by).alias("by"), F.col(name).cast("string").alias("name"), F.col(size).cast("int").alias("size"), most.cast("long").alias("most"), *(F.col(c).alias(f"by{k}") for k, c in enumerate(order)))
    rows = rows.repartition("by").sortWithinPartitions("by", *(f"by{k}" for k in range(len(order))), "size", "name").select("by", "name", "size", "most")

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sheet, fill = object(), 1, 0
        for batch in batches:
            sheets = []
            for key, n, limit in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if key != at:
                    at, sheet, fill = key, 1, 0
                if n is None or limit is None or (n > limit and not oversized):
                    sheets.append(None)
                    continue
                fits = fill + n <= limit or (oversized and not fill)
                sheet, fill = (sheet, fill + n) if fits else (sheet + 1, n)
                sheets.append(sheet)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(sheets, pa.int32()), batch.column(2)], names=["by", "name", "sheet", "size"])

    kind = groups.schema[by].dataType.simpleString()
    return rows.mapInArrow(fold, f"by {kind}, name string, sheet int, size int").select(F.col("by").alias(by), "name", "sheet", "size")


def concurrency(events: DataFrame, run: str, order: list[str], event: str, most: int = C.CONCURRENCY_MOST, least: int = C.CONCURRENCY_LEAST) -> DataFrame:
    """Concurrency left after each run's events: every failure that doesn't repeat the event before it costs one."""
    w = Window.partitionBy(run).orderBy(*order)
    fails = F.col(event).isin(*C.FALLBACK_EVENTS)
    counted = events.withColumn("_down", fails & ~F.col(event).eqNullSafe(F.lag(event).over(w)))
    steps = F.count_if("_down")
    return counted.groupBy(run).agg(F.greatest(F.lit(least), most - steps).cast("int").alias("effective"), steps.alias("degradations"), F.count("*").alias("events"))


def budget_fold(jobs: DataFrame, run: str, order: list[str], cost: str, identity: str, budget: float) -> DataFrame:
    """Jobs in order, taken while the budget lasts; one too dear is passed over, a cheaper one later may still fit.

    A run's jobs stream through one task in sorted order, and what is kept is the sum spent. Null cost: taken is null.
    """
    price = F.col(cost).cast("double")
    rows = jobs.select(F.col(run).alias("run"), F.col(identity).alias("id"), price.alias("cost"), *(F.col(c).alias(f"by{k}") for k, c in enumerate(order)))
    rows = rows.repartition("run").sortWithinPartitions("run", *(f"by{k}" for k in range(len(order))), "cost", "id").select("run", "id", "cost")

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = object(), 0.0
        for batch in batches:
            taken, spent = [], []
            for key, x in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if key != at:
                    at, total = key, 0.0
                fits = None if x is None else total + x <= budget
                total += x if fits else 0.0
                taken.append(fits)
                spent.append(total)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(taken, pa.bool_()), pa.array(spent, pa.float64())], names=["run", "id", "cost", "taken", "spent"])

    kinds = dict(rows.dtypes)
    return rows.mapInArrow(fold, f"run {kinds['run']}, id {kinds['id']}, cost double, taken boolean, spent double").select(F.col("run").alias(run), F.col("id").alias(identity), "cost", "taken", "spent")


def risk_wave(jobs: DataFrame, by: str, priority: str, order: list[str], effective: int = C.CONCURRENCY_MOST, high_risk: int = C.HIGH_RISK_MOST) -> DataFrame:
    """Jobs of the next wave of each group, by risk and order: while jobs of high risk are pending only these, and few of them.

    Limits are pushed below the sort, so the second window sees a few rows a group.
    """
    risky = F.col(priority) < C.RISK_OTHER
    first = jobs.withColumn("_risky", risky).withColumn("slot", F.row_number().over(Window.partitionBy(by, "_risky").orderBy(priority, *order)))
    few = first.where(F.col("slot") <= effective).where(~F.col("_risky") | (F.col("slot") <= high_risk))
    out = few.withColumn("_any", F.bool_or("_risky").over(Window.partitionBy(by)))
    return out.where(~F.col("_any") | F.col("_risky")).drop("_risky", "_any")


def positions(rows: DataFrame, by: str, order: list[str], columns: int, per_page: int) -> DataFrame:
    """Page, row and column of each item of a sheet laid out row by row."""
    k = F.row_number().over(Window.partitionBy(by).orderBy(*order)) - 1
    return rows.withColumn("_k", k).withColumn("page", F.floor(F.col("_k") / per_page).cast("int")).withColumn("row", F.floor(F.pmod("_k", F.lit(per_page)) / columns).cast("int")).withColumn("column", F.pmod("_k", F.lit(columns)).cast("int")).drop("_k")


def tree_depths(nodes: DataFrame, identity: str, parent: str) -> DataFrame:
    """Depth and root of each node of a forest by parent pointers; nodes that reach no root (cycles, unknown parents) are invalid.

    One join a level, until a level is empty: nodes of a cycle are in no level, so the loop ends.
    """
    edges = nodes.select(F.col(identity).alias("node"), F.col(parent).alias("parent"))
    level = cut(edges.where("parent is null").select("node", F.lit(0).alias("depth"), F.col("node").alias("root")))
    out = level
    while True:
        level = cut(edges.alias("e").join(level.alias("l"), F.col("e.parent") == F.col("l.node")).select(F.col("e.node"), (F.col("l.depth") + 1).alias("depth"), F.col("l.root")))
        if level.isEmpty():
            break
        out = out.unionByName(level)
    return edges.join(out, "node", "left").select(F.col("node").alias(identity), F.col("parent").alias(parent), "depth", "root", F.col("depth").isNotNull().alias("valid"))
