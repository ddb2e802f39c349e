"""Skew-safe building blocks shared by the operators.

A single scheme, house, source or user may own a third of all rows, so nothing here
gathers a whole group into one task:

* totals per group are pre-aggregated on the map side and joined back, and AQE splits
  the hot key of that join;
* order-dependent work (running sums, carry-forward, previous row, dense positions) is
  done inside blocks of the order key, and only one summary row per block crosses
  between blocks;
* "first row per key" is a ranked filter, which Spark cuts to one row per key inside
  each map task before the shuffle (WindowGroupLimit).
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

Names = Iterable[str]


def _names(cols: Names | str) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only in a local session that sets none."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None and spark.conf.get("spark.master", "").startswith("local"):
        folder = tempfile.mkdtemp(prefix="folioscope-")
    if folder is None:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return folder.rstrip("/")


def settle(df: DataFrame) -> DataFrame:
    """Write once, read many: a Parquet copy in the cluster's shared folder.

    Used where several branches would otherwise recompute the same joins. The folder is ``shared_folder``'s. Columns
    are compressed, and the planner knows the true size of the copy: a checkpoint kept rows uncompressed and the estimate
    of the plan it was made by, so that tables of millions of rows were broadcast.
    """
    fields = df.schema.fields
    void = [isinstance(f.dataType, T.NullType) for f in fields]  # Parquet has no such column
    places = [f"c{i}" for i in range(len(fields))]  # any names, also repeated ones
    path = f"{shared_folder(df.sparkSession)}/settled-{uuid.uuid4().hex}"
    written = df.toDF(*places).drop(*[p for p, v in zip(places, void) if v])
    written.write.parquet(path)
    read = df.sparkSession.read.schema(written.schema).parquet(path)
    return read.select(*[F.lit(None).alias(f.name) if v else F.col(p).alias(f.name) for p, f, v in zip(places, fields, void)])


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt over as many tasks as a shuffle of the cluster has.

    For costly work on each row of a small file, which comes in one split whatever the number of its rows.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def read_whole(df: DataFrame) -> DataFrame:
    """The same rows, for which a shuffle below hands over all columns, so that several readings share one shuffle.

    Spark writes a shuffle once for several readings only if all of them take the same columns. The condition holds for
    every row; it depends on the task, so it stays above the shuffle, and the hash in it is never looked at.
    """
    return df.filter((F.spark_partition_id() >= 0) | (F.xxhash64(*df.columns) == 0))


ROWS_PER_TASK = 1 << 20


def tasks_for(rows: int, spark: SparkSession, per_task: int = ROWS_PER_TASK) -> int:
    """Tasks for a shuffle of this many rows: as many as the cluster's, more where one would hold over ``per_task`` rows.

    Narrow rows compress to a few bytes, so that shuffles cut by bytes gather millions of them in one task.
    """
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // per_task))


def exploded(df: DataFrame, items: Column, name: str, position: str | None = None) -> DataFrame:
    """One row per non-null array element.

    The outer form is used on purpose: for the plain one Spark infers a filter on the array's size
    and pushes it down, which evaluates a costly array expression once more.
    """
    made = F.posexplode_outer(items).alias(position, name) if position else F.explode_outer(items).alias(name)
    return df.select("*", made).filter(F.col(name).isNotNull())


def first_rows(df: DataFrame, keys: Names, order: Iterable[Column | str], n: int = 1) -> DataFrame:
    """The first ``n`` rows of every key in ``order``."""
    w = Window.partitionBy(*_names(keys)).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(w)).filter(F.col("__rank") <= n).drop("__rank")


def last_rows(df: DataFrame, keys: Names) -> DataFrame:
    """One row per key: the last line of a lookup (by ``line``), so that no join with it can multiply rows.

    A table without line numbers keeps the greatest row, which no order of reading can change.
    """
    keys = _names(keys)
    rest = [F.desc_nulls_last(c) for c in df.columns if c not in keys and c != "line"]
    return first_rows(df, keys, [F.desc("line"), *rest] if "line" in df.columns else rest or keys)


def with_group_totals(df: DataFrame, keys: Names, totals: Mapping[str, Column],
                      rows: DataFrame | None = None) -> DataFrame:
    """Attach aggregates of each group to its rows: pre-aggregate, then join back."""
    keys = _names(keys)
    summary = (df if rows is None else rows).groupBy(*keys).agg(
        *[expr.alias(name) for name, expr in totals.items()]
    )
    return null_safe_join(df, summary, keys, "left")


def null_safe_join(left: DataFrame, right: DataFrame, keys: Names, how: str = "left") -> DataFrame:
    """Join on same-named keys where null equals null; right key columns are dropped."""
    keys = _names(keys)
    renamed = right.select(
        *[F.col(k).alias(f"__r_{k}") for k in keys],
        *[F.col(c) for c in right.columns if c not in keys],
    )
    condition = None
    for k in keys:
        part = left[k].eqNullSafe(renamed[f"__r_{k}"])
        condition = part if condition is None else condition & part
    joined = left.join(renamed, condition, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"__r_{k}" for k in keys])


def ordered_scan(
    df: DataFrame,
    keys: Names,
    order: Iterable[str],
    block: Column,
    *,
    sums: Mapping[str, Column] | None = None,
    lasts: Mapping[str, Column] | None = None,
    previous: Mapping[str, Column] | None = None,
    position: str | None = None,
    bundle_bits: int = 12,
    levels: int = 1,
    known: DataFrame | None = None,
    shared: bool = False,
) -> DataFrame:
    """Order-dependent columns without putting a group into one task.

    ``order`` must be unique within ``keys`` and ``block`` must never decrease along it;
    the block bounds how many rows one task sorts together. The summaries of the blocks are scanned in the same
    way: a whole-numbered block goes into a bundle of at most 2**bundle_bits, bundles into bundles of bundles, for
    ``levels`` levels, and only the last level's summaries of a key meet in one window. One level keeps that window
    below 2**12 rows for 2**36 rows of a key in blocks of 2**12; blocks of other types are scanned in one window.

    sums      inclusive running sum (nulls count as 0)
    lasts     last non-null value up to and including the row
    previous  value of the row before (a non-null struct or scalar)
    position  dense 0-based position
    known     a table with at most one row per key, whose other columns are added: they come with what earlier blocks
              hand on, so that rows do not move for them (null without a row, or where a key is null)
    shared    several scans of the same rows share one shuffle of all their columns
    """
    keys, order = _names(keys), list(order)
    sums, lasts, previous = dict(sums or {}), dict(lasts or {}), dict(previous or {})
    if position:
        sums[position] = F.lit(1).cast("long")
    columns = df.columns
    work, at, restored = _solid(df.withColumn("__scan_block", block), [*keys, "__scan_block"])
    keys_at = [c for k in keys for c in at[k]]
    block_at = [*keys_at, *at["__scan_block"]]

    within = Window.partitionBy(*block_at).orderBy(*order)
    upto = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = {}
    for name, expr in sums.items():
        local[f"__scan_s_{name}"] = F.coalesce(F.sum(expr).over(upto), F.lit(0))
    for name, expr in lasts.items():
        local[f"__scan_l_{name}"] = F.last(expr, ignorenulls=True).over(upto)
    for name, expr in previous.items():
        local[f"__scan_p_{name}"] = F.lag(expr).over(within)
        local[f"__scan_f_{name}"] = F.row_number().over(within) == 1
    dealt = read_whole(work.drop(*restored).repartition(*block_at)).withColumns(restored) if shared else work
    rows = dealt.withColumns(local).drop(*[k for k in [*keys, "__scan_block"] if k in restored])

    place = F.struct(*order)
    parts = []
    for name, expr in sums.items():
        parts.append(F.coalesce(F.sum(expr), F.lit(0)).alias(f"__scan_s_{name}"))
    for name, expr in lasts.items():
        parts.append(F.max(F.when(expr.isNotNull(), F.struct(*order, expr.alias("__v")))).alias(f"__scan_l_{name}"))
    for name, expr in previous.items():
        parts.append(F.max_by(expr, place).alias(f"__scan_p_{name}"))
    blocks = work.groupBy(*block_at).agg(*parts)
    blocks = blocks.withColumn("__scan_block", restored.get("__scan_block", F.col("__scan_block")))

    whole = isinstance(blocks.schema["__scan_block"].dataType, T.IntegralType)
    carried = _carried_in(blocks, keys_at, "__scan_block", sums, lasts, previous, bundle_bits, levels if whole else 0)
    carried, _, _ = _solid(carried, ["__scan_block"])
    carried = carried.select(*block_at, *[c for c in carried.columns if c.startswith("__scan_c_")])
    more = [] if known is None else [c for c in known.columns if c not in keys]
    if more:
        carried = carried.withColumns({k: restored[k] for k in keys if k in restored}).join(known, keys, "left").select(*carried.columns, *more)
    joined = rows.join(carried, block_at, "left").withColumns({k: restored[k] for k in keys if k in restored})

    out = {}
    for name in sums:
        out[name] = F.col(f"__scan_s_{name}") + F.col(f"__scan_c_s_{name}")
    for name in lasts:
        out[name] = F.coalesce(F.col(f"__scan_l_{name}"), F.col(f"__scan_c_l_{name}"))
    for name in previous:
        out[name] = F.when(F.col(f"__scan_f_{name}"), F.col(f"__scan_c_p_{name}")).otherwise(F.col(f"__scan_p_{name}"))
    if position:
        out[position] = out[position] - 1
    return joined.withColumns(out).select(*columns, *[name for name in out if name not in columns], *more)


def _solid(df: DataFrame, cols: Names) -> tuple[DataFrame, dict[str, list[str]], dict[str, Column]]:
    """Columns that hold the same as ``cols`` and are never null, what stands for each, and how to get it back.

    A null-safe join shuffles by expressions, so rows that a window has dealt by the same columns would move once more.
    Equal plain columns let them stay where they are. Columns that can't be null stand for themselves.
    """
    made, at, restored = {}, {}, {}
    for c in cols:
        field = df.schema[c]
        value, missing = f"__scan_v_{c}", f"__scan_n_{c}"
        if not field.nullable:
            at[c] = [c]
        elif isinstance(field.dataType, (T.NumericType, T.StringType)):
            spare = F.lit("" if isinstance(field.dataType, T.StringType) else 0).cast(field.dataType)
            made |= {value: F.coalesce(c, spare), missing: F.col(c).isNull()}
            at[c], restored[c] = [value, missing], F.when(~F.col(missing), F.col(value))
        else:  # a structure is never null, and equal where its fields are null alike
            made[value] = F.struct(F.col(c).alias("v"))
            at[c], restored[c] = [value], F.col(value)["v"]
    return df.withColumns(made), at, restored


def _carried_in(parts: DataFrame, keys: list[str], place: str, sums: Names, lasts: Names, previous: Names,
                bits: int, levels: int) -> DataFrame:
    """What the parts of a key before each part (in the order of ``place``) hand on to it: keys, place, ``__scan_c_*``.

    With levels left, parts are scanned inside bundles of places, and each bundle takes what the bundles before it
    hand on. ``__scan_p_*`` of a part is its last row's value, which may be null, so a bundle's first part is marked.
    """
    bundle = f"{place}_"
    if levels:
        parts = parts.withColumn(bundle, F.shiftright(F.col(place).cast("long"), bits))
    group = [*keys, bundle] if levels else keys
    between = Window.partitionBy(*group).orderBy(place)
    before = between.rowsBetween(Window.unboundedPreceding, -1)
    handed = {}
    for name in sums:
        handed[f"__scan_c_s_{name}"] = F.coalesce(F.sum(f"__scan_s_{name}").over(before), F.lit(0))
    for name in lasts:
        handed[f"__scan_c_l_{name}"] = F.last(f"__scan_l_{name}", ignorenulls=True).over(before)["__v"]
    for name in previous:
        handed[f"__scan_c_p_{name}"] = F.lag(f"__scan_p_{name}").over(between)
    if not levels:
        return parts.select(*keys, place, *[expr.alias(name) for name, expr in handed.items()])
    inside = parts.select(*group, place, (F.row_number().over(between) == 1).alias("__scan_first"),
                          *[expr.alias(name) for name, expr in handed.items()])
    merged = [F.sum(f"__scan_s_{name}").alias(f"__scan_s_{name}") for name in sums]
    merged += [F.max(f"__scan_l_{name}").alias(f"__scan_l_{name}") for name in lasts]
    merged += [F.max_by(F.struct(f"__scan_p_{name}"), place)[f"__scan_p_{name}"].alias(f"__scan_p_{name}") for name in previous]
    outer = _carried_in(parts.groupBy(*group).agg(*merged), keys, bundle, sums, lasts, previous, bits, levels - 1)
    outer = outer.select(*group, *[F.col(c).alias(f"{c}_out") for c in handed])
    both = null_safe_join(inside, outer, group, "left")
    own, out = [F.col(c) for c in handed], [F.col(f"{c}_out") for c in handed]
    joined = []
    for name, a, b in zip(handed, own, out):
        value = a + b if name.startswith("__scan_c_s_") else F.coalesce(a, b) if name.startswith("__scan_c_l_") else F.when(
            F.col("__scan_first"), b).otherwise(a)
        joined.append(value.alias(name))
    return both.select(*keys, place, *joined)


def levels_for(max_position: int, block_bits: int = 12, fan_bits: int = 12) -> int:
    """How many array levels a group of this many positions needs."""
    levels = 1
    while max_position >> (block_bits + fan_bits * (levels - 1)):
        levels += 1
    return levels


def first_reaching(
    points: DataFrame, queries: DataFrame, keys: Names, *, position: str, level: str, threshold: str,
    out: str, block_bits: int = 12, fan_bits: int = 12, levels: int = 3,
) -> DataFrame:
    """For every query row: the first later point of its group whose ``level`` reaches ``threshold``.

    Adds ``out`` (the position of that point, or null) and ``<out>_level``.

    ``points`` carry a dense ``position`` per group. They are folded into blocks of at most
    2**block_bits points, the blocks into bundles of 2**fan_bits, and so on, so a query meets
    one array per level instead of every later row of its group: up to the first bundle that
    reaches the threshold, then down again to the row. Each step is a plain equi-join that
    yields one row per query. Three levels keep every array short up to 2**36 rows in one group;
    ``levels_for`` picks fewer when the measured positions allow it.
    """
    keys = _names(keys)
    shifts = [block_bits + fan_bits * i for i in range(levels)]

    # tables[i]: bucket at shift[i] -> array of (child position, max level), in order
    tables = []
    child = points.select(*keys, F.col(position).alias("__pos"), F.col(level).alias("__lvl"))
    child_shift = 0
    for i, shift in enumerate(shifts):
        grouping = [*keys]
        top = i == len(shifts) - 1
        bucket = F.lit(0).cast("long") if top else F.shiftright("__pos", shift - child_shift)
        table = (
            child.withColumn("__bucket", bucket)
            .groupBy(*grouping, "__bucket")
            .agg(F.array_sort(F.collect_list(F.struct("__pos", "__lvl"))).alias("__members"),
                 F.max("__lvl").alias("__lvl"))
        )
        tables.append(table.select(*keys, "__bucket", "__members"))
        child = table.select(*keys, F.col("__bucket").alias("__pos"), "__lvl")
        child_shift = shift

    def pick(members: str, after: Column) -> Column:
        hit = F.filter(
            F.col(members), lambda m: (m["__pos"] > after) & (m["__lvl"] >= F.col(threshold))
        )
        return F.get(hit, F.lit(0))

    work = queries
    # up: own block, then the bundle of blocks, then the bundle of bundles
    for i, shift in enumerate(shifts):
        top = i == len(shifts) - 1
        below = 0 if i == 0 else shifts[i - 1]
        own = F.lit(0).cast("long") if top else F.shiftright(F.col(position), shift)
        table = tables[i].withColumnRenamed("__bucket", f"__b{i}")
        work = null_safe_join(work.withColumn(f"__b{i}", own), table, [*keys, f"__b{i}"], "left")
        after = F.col(position) if i == 0 else F.shiftright(F.col(position), below)
        work = work.withColumn(f"__up{i}", pick("__members", after)).drop("__members", f"__b{i}")
    # down: from the highest bundle that was needed to the row
    work = work.withColumn("__found", F.lit(None))
    for i in range(len(shifts) - 1, 0, -1):
        further = [F.col("__found")["__pos"]] if i < len(shifts) - 1 else []
        needed = F.coalesce(F.col(f"__up{i}")["__pos"], *further)
        table = tables[i - 1].withColumnRenamed("__bucket", "__b")
        work = null_safe_join(work.withColumn("__b", needed), table, [*keys, "__b"], "left")
        work = work.withColumn(
            "__found", F.when(F.col("__b").isNotNull(), pick("__members", F.lit(-1).cast("long")))
        ).drop("__members", "__b")
    scratch = ["__found", "__hit"] + [f"__up{i}" for i in range(len(shifts))]
    return (
        work.withColumn("__hit", F.coalesce(F.col("__up0"), F.col("__found")))
        .withColumns({out: F.col("__hit")["__pos"], f"{out}_level": F.col("__hit")["__lvl"]})
        .drop(*scratch)
    )


def grid(left: DataFrame, right: DataFrame, keys: Names, left_id: str, right_id: str,
         left_rows: int = 1024, right_rows: int = 512, packed: int = 0):
    """Cogroup two sides of every key in bounded tiles, for work that must see all pairs.

    Rows of a key are spread by hash over tiles of about ``left_rows`` x ``right_rows``; a row is
    copied once per tile of the other side, never once per partner. Both ids must be distinct
    within their key. With ``packed``, keys of one tile are dealt over that many groups, each of several keys, which the
    function must tell apart by its own; keys of more tiles keep theirs. Returns a cogrouped pair ready for applyInPandas.
    """
    keys = _names(keys)
    n_left = left.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / left_rows).alias("__nl"))
    n_right = right.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / right_rows).alias("__nr"))
    tiles = n_left.join(n_right, keys)

    def spread(df: DataFrame, row_id: str, own: str, own_n: str, other: str, other_n: str) -> DataFrame:
        placed = df.join(tiles, keys).withColumn(own, F.pmod(F.xxhash64(row_id), F.col(own_n)))
        copies = F.sequence(F.lit(0).cast("bigint"), F.col(other_n).cast("bigint") - 1)
        out = placed.withColumn(other, F.explode(copies))
        out = out if packed else out.drop("__nl", "__nr")
        return out.toDF(*out.columns)  # fresh columns: both sides may come from one table

    rows = spread(left, left_id, "__tr", "__nl", "__tc", "__nr")
    cols = spread(right, right_id, "__tc", "__nr", "__tr", "__nl")
    tile = [*keys, "__tr", "__tc"]
    if packed:  # one tile is a key of its own; all keys that need no more share a fixed number of groups
        whole = (F.col("__nl") == 1) & (F.col("__nr") == 1)
        unit = F.when(whole, F.pmod(F.xxhash64(*keys), F.lit(packed))).otherwise(F.xxhash64(*keys))
        rows, cols = (df.withColumns({"__unit": unit, "__whole": whole}) for df in (rows, cols))
        rows, cols = rows.toDF(*rows.columns), cols.toDF(*cols.columns)
        tile = ["__unit", "__whole", "__tr", "__tc"]
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # tiles are small in bytes and long in work
    rows, cols = rows.repartition(parts, *tile), cols.repartition(parts, *tile)
    return rows.groupBy(*tile).cogroup(cols.groupBy(*tile))


def contained_pairs(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                    prefix_only: bool = False) -> DataFrame:
    """Rows of both sides where one key contains the other (or starts with it).

    A contained text starts with a short gram of the text around it, so both directions are
    equi-joins on grams of up to three characters, filtered by the real test.
    """
    def head(c: str) -> Column:
        return F.substring(c, 1, 3)

    def grams(c: str) -> Column:
        starts = F.sequence(F.lit(1), F.lit(1) if prefix_only else F.length(c))
        each = F.transform(starts, lambda i: F.array(*[F.substring(F.col(c), i, n) for n in (1, 2, 3)]))
        return F.array_distinct(F.flatten(each))

    def direction(small: DataFrame, small_key: str, big: DataFrame, big_key: str) -> DataFrame:
        a = small.filter(F.length(small_key) > 0).withColumn("__g", head(small_key))
        b = big.filter(F.length(big_key) > 0).withColumn("__g", F.explode(grams(big_key)))
        inside = F.col(big_key).startswith(F.col(small_key)) if prefix_only else F.col(big_key).contains(F.col(small_key))
        return a.join(b, "__g").filter(inside).drop("__g")

    cols = [*left.columns, *right.columns]
    both = direction(left, left_key, right, right_key).select(*cols).unionByName(
        direction(right, right_key, left, left_key).select(*cols))
    return both.distinct()
