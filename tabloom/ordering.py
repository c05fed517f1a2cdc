"""Exact ranks, running totals and order statistics without a single-task window.

Three ideas carry the whole library:

* a total order is a range repartition plus one offset per partition (`ordered_index`,
  `running_totals`); the partition numbers are pinned first, because the sampled range
  bounds would otherwise differ between two evaluations of the same plan;
* a quantile, or any k-th value, needs no sort of the facts: a sketch brackets it in one
  scan and the few rows inside the bracket decide it exactly (`quantile_table`, `kth_rows`);
* a random split needs no sort either: the keys' hashes are uniform, so counts per hash
  prefix locate the cut-off hash, and the split is a plain comparison (`hash_cuts`).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .columns import col, listed, melt
from .session import driver_table, measured_size, pin, row_bytes

# Above these sizes a lookup table is joined by shuffle (AQE splits skewed keys) instead of broadcast.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * 1024 * 1024
# One window task may rank this many pre-aggregated rows; larger groups are range-partitioned.
WINDOW_ROWS = 1_000_000
# Columns sketched in one scan; a task holds one sketch per column and class.
SKETCH_COLUMNS = 32
# Classes whose brackets and bins are constants of one pass over the columns; more are joined.
CLASS_LITERALS = 64
# Bracketed values that a task holds before it hands them on.
HELD_VALUES = 1 << 20
# Slices of an order whose bounds are constants of one expression, and sampled keys for each of them.
MOST_SLICES = 2000
SAMPLED_A_SLICE = 50
# monotonically_increasing_id keeps the row's place inside its partition in the low 33 bits.
PLACE_BITS = 33


def is_small(table: DataFrame) -> bool:
    """True when a table's counted rows and bytes allow a broadcast."""
    rows, size = measured_size(table, BROADCAST_ROWS)
    return rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES


def column_parts(table: DataFrame, names: Sequence[str]) -> dict[str, DataFrame]:
    """The rows of a pinned (column_name, value, ...) table per column, each with its measured
    size. The smallest come first against one broadcast budget, so that one column of many
    values does not make the others shuffle."""
    sizes = {r["column_name"]: (r["n"], r["b"]) for r in table.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("n"), F.sum(row_bytes(table)).alias("b")).collect()}
    parts, used = {}, 0
    for n in sorted(names, key=lambda n: sizes.get(n, (0, 0))[1]):
        rows, size = sizes.get(n, (0, 0))
        used += size
        part = table.filter(F.col("column_name") == n).drop("column_name").withColumnRenamed("value", n)
        part._measured = (rows, used)
        parts[n] = part
    return parts


def attach(facts: DataFrame, lookup: DataFrame, on: str | Sequence[str], how: str = "left",
           part_of: DataFrame | None = None, null_safe: bool = True) -> DataFrame:
    """Equi-join of facts with a lookup table, broadcast only after its size is checked.

    part_of names a pinned table that bounds the lookup's size. A missing key meets a missing
    key unless null_safe is off, which is cheaper where the lookup has none.
    """
    names = listed(on)
    small = is_small(lookup if part_of is None else part_of)
    if not null_safe:
        return facts.join(F.broadcast(lookup) if small else lookup, names, how)
    renamed = lookup.select(
        *[col(n).alias(f"_on_{n}") if n in names else col(n) for n in lookup.columns]
    )
    matches = [col(n).eqNullSafe(col(f"_on_{n}")) for n in names]
    condition = matches[0]
    for m in matches[1:]:
        condition = condition & m
    side = F.broadcast(renamed) if small else renamed
    return facts.join(side, condition, how).drop(*[f"_on_{n}" for n in names])


def ordered_index(
    df: DataFrame, order: str | Sequence[str] | Sequence[Column], group: str | Sequence[str] | None = None,
    name: str = "row_index",
) -> DataFrame:
    """0-based position of every row in a total order, per group if one is given.

    The order should be unique within the group. A hot group spreads over many partitions.
    """
    groups = listed(group)
    keys = [o if isinstance(o, Column) else col(o) for o in (listed(order) if isinstance(order, str) else order)]
    by = [col(g) for g in groups] + keys
    placed = pin(
        df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_place", F.monotonically_increasing_id())
    ).withColumns({
        "_slice": F.shiftright("_place", PLACE_BITS),
        "_place": F.col("_place").bitwiseAND(F.lit((1 << PLACE_BITS) - 1)),
    })
    slices = placed.groupBy(*groups, "_slice").agg(F.count(F.lit(1)).alias("_rows"), F.min("_place").alias("_first"))
    before = Window.partitionBy(*([col(g) for g in groups] or [F.lit(0)])).orderBy("_slice").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = pin(slices.select(
        *groups, "_slice", (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_start")))
    return (
        attach(placed, starts, [*groups, "_slice"], null_safe=bool(groups))
        .withColumn(name, F.col("_place") + F.col("_start"))
        .drop("_place", "_slice", "_start")
    )


def sliced_index(df: DataFrame, order: str | Sequence[str], name: str = "row_index") -> DataFrame:
    """0-based position of every row in a total order, which should be unique; missing keys come first.

    A sample of the keys gives bounds, which are constants from then on: the slice of a row is an expression of its keys, the same
    however often a task runs. A narrow scan counts the slices, and one shuffle by slice numbers the rows. Nothing is written, and
    columns that nobody asks for are not read. More than MOST_SLICES slices are numbered over a written table instead.
    """
    keys = listed(order)
    narrow = df.select(F.struct(*[col(k).alias(f"k{i}") for i, k in enumerate(keys)]).alias("k"))
    n = narrow.count()
    slices = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(n / WINDOW_ROWS) if WINDOW_ROWS else 1)
    if slices > MOST_SLICES:
        return ordered_index(df, keys, name=name)
    sampled = [r["k"] for r in narrow.sample(min(1.0, SAMPLED_A_SLICE * slices / max(n, 1)), 7).sort("k").collect()]
    at = sorted({len(sampled) * i // slices for i in range(1, slices)}) if sampled else []
    ends = [F.struct(*[literal(v, f.dataType).alias(f"k{j}") for j, (v, f) in enumerate(zip(sampled[i], narrow.schema["k"].dataType.fields))])
            for i in at]
    own = F.struct(*[col(k).alias(f"k{i}") for i, k in enumerate(keys)])
    place = F.size(F.filter(F.array(*ends), lambda e: e <= own)) if ends else F.lit(0)
    sizes = {r["s"]: r["n"] for r in df.select(place.alias("s")).groupBy("s").agg(F.count(F.lit(1)).alias("n")).collect()}
    starts = [sum(sizes.get(j, 0) for j in range(i)) for i in range(len(ends) + 1)]
    sliced = df.withColumn("_slice", place)
    nth = F.row_number().over(Window.partitionBy("_slice").orderBy(*[col(k).asc_nulls_first() for k in keys]))
    start = F.element_at(F.array(*[F.lit(v).cast("long") for v in starts]), F.col("_slice") + 1)
    return sliced.withColumn(name, start + nth - 1).drop("_slice")


def running_totals(
    df: DataFrame, order: str | Sequence[str], sums: dict[str, str], group: str | Sequence[str] | None = None,
) -> DataFrame:
    """Add, for each {new: source}, the sum of source over all rows strictly earlier in the order."""
    groups, keys = listed(group), listed(order)
    by = [col(g) for g in groups] + [col(k) for k in keys]
    sliced = pin(df.repartitionByRange(*by).withColumn("_slice", F.spark_partition_id()))
    per_slice = sliced.groupBy(*groups, "_slice").agg(*[F.sum(s).alias(f"_t_{n}") for n, s in sums.items()])
    across = Window.partitionBy(*([col(g) for g in groups] or [F.lit(0)])).orderBy("_slice").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = pin(per_slice.select(
        *groups, "_slice", *[F.coalesce(F.sum(f"_t_{n}").over(across), F.lit(0)).alias(f"_s_{n}") for n in sums]))
    within = Window.partitionBy("_slice", *groups).orderBy(*[col(k) for k in keys]).rowsBetween(
        Window.unboundedPreceding, -1)
    joined = attach(sliced, starts, [*groups, "_slice"])
    return joined.withColumns(
        {n: F.coalesce(F.sum(s).over(within), F.lit(0)) + F.col(f"_s_{n}") for n, s in sums.items()}
    ).drop("_slice", *[f"_s_{n}" for n in sums])


def _around(shares: Sequence[float], slack: float) -> list[float]:
    """Lower and upper end of each share's bracket, one after the other."""
    return [e for s in shares for e in (max(s - slack, 0.0), min(s + slack, 1.0))]


def _slot(i: int, lo: Column, hi: Column, pos: Column) -> Column:
    return F.struct(F.lit(i).alias("slot"), lo.alias("lo"), hi.alias("hi"), pos.cast("double").alias("pos"),
                    F.floor(pos).alias("k"), F.ceil(pos).alias("k2"))


def _count_bracketed(facts: DataFrame, keys: list[str], slots: int) -> DataFrame:
    """Counts per key, region and value: (keys, region, x, c).

    facts hold keys, value and an array of brackets. The ends passed number a value's region;
    only inside a bracket are values told apart (x), any other region is a single row.
    """
    ends, inside = F.lit(0), F.lit(False)
    for i in range(slots):
        lo, hi = F.col("_slots")[i]["lo"], F.col("_slots")[i]["hi"]
        ends = ends + (F.col("value") >= lo).cast("int") + (F.col("value") > hi).cast("int")
        inside = inside | F.col("value").between(lo, hi)
    return (
        facts.select(*keys, ends.alias("region"), F.when(inside, F.col("value")).alias("x"))
        .groupBy(*keys, "region", "x").agg(F.count(F.lit(1)).alias("c")))


def _rank_counts(counts: DataFrame, keys: list[str], largest: int, slots: int, slack: float) -> DataFrame:
    """Add `before`, the number of smaller values of the key."""
    if 2 * slack * slots * largest <= WINDOW_ROWS:
        w = Window.partitionBy(*keys).orderBy("region", "x").rowsBetween(Window.unboundedPreceding, -1)
        return counts.withColumn("before", F.coalesce(F.sum("c").over(w), F.lit(0)))
    return running_totals(counts, ["region", "x"], {"before": "c"}, keys)


def _pick(slotted: DataFrame, keys: list[str]) -> DataFrame:
    """Exact values v and v2 at ranks k and k2 (0-based) from ranked counts next to their slots."""
    def at(rank: str, what: str) -> Column:
        hit = (F.col("before") <= F.col(rank)) & (F.col(rank) < F.col("before") + F.col("c"))
        return F.max(F.when(hit, F.col(what)))

    out = slotted.select(*keys, "x", "before", "c", F.inline("_slots")).groupBy(*keys, "slot", "pos", "k", "k2").agg(
        at("k", "x").alias("v"), at("k2", "x").alias("v2"), at("k", "before").alias("before"), at("k", "c").alias("ties"))
    missed = F.raise_error(F.lit("the sketch missed a quantile: raise accuracy"))
    return out.withColumns({"v": F.coalesce("v", missed), "v2": F.coalesce("v2", missed)})


def clean_doubles(columns: Sequence[str]) -> list[Column]:
    """The columns as doubles c0, c1, ...; NaN counts as missing."""
    return [F.nanvl(col(n).cast("double"), F.lit(None).cast("double")).alias(f"c{i}") for i, n in enumerate(columns)]


def class_aggregates(df: DataFrame, columns: Sequence[str], by: str | None, stats: dict[str, Callable[[Column], Column]]):
    """(classes, stats per class and column) on the driver: one aggregate per SKETCH_COLUMNS columns over columns as they are. None
    if there are more than CLASS_LITERALS classes. Without `by` there is one class."""
    classes: list = []
    found: dict[tuple, dict] = {}
    for lo in range(0, len(columns), SKETCH_COLUMNS):
        chunk = columns[lo:lo + SKETCH_COLUMNS]
        facts = df.select(*([col(by).alias("class")] if by else []), *clean_doubles(chunk))
        rows = facts.groupBy(*(["class"] if by else [])).agg(
            *[f(F.col(f"c{i}")).alias(f"{i}|{s}") for i in range(len(chunk)) for s, f in stats.items()]).limit(CLASS_LITERALS + 1).collect()
        if len(rows) > CLASS_LITERALS:
            return None
        classes = [r["class"] for r in rows] if by else [None]
        for c, r in zip(classes, rows):
            found |= {(c, lo + i): {s: r[f"{i}|{s}"] for s in stats} for i in range(len(chunk))}
    return classes, found


def classed_columns(df: DataFrame, columns: Sequence[str], by: str | None, classes: Sequence) -> DataFrame:
    """(class number, c0, c1, ...): what a pass in numpy reads."""
    number = F.lit(0)
    if by:
        number = F.lit(-1)
        for i, c in enumerate(classes):
            number = F.when(col(by).eqNullSafe(literal(c, df.schema[by].dataType)), i).otherwise(number)
    return df.select(number.cast("int").alias("class"), *clean_doubles(columns))


def _bracketed_values(facts: DataFrame, brackets: dict[tuple[int, int], list[tuple[float, float]]]) -> DataFrame:
    """(class, column, bracket, region, x, c) of one pass: how many values lie below each bracket (region 0, x missing) and
    how often each value inside occurs (region 1). Everything else stays where it is."""
    import numpy as np
    import pyarrow as pa

    def scan(batches):
        below: dict[tuple, int] = {}
        inside: dict[tuple, list] = {}
        held = 0

        def flush():
            rows = [(*at, 0, None, n) for at, n in below.items() if n]
            for at, parts in inside.items():
                values, counts = np.unique(np.concatenate(parts), return_counts=True)
                rows += [(*at, 1, v, c) for v, c in zip(values.tolist(), counts.tolist())]
            below.clear()
            inside.clear()
            kinds = [pa.int32()] * 4 + [pa.float64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                                             ["class", "column", "bracket", "region", "x", "c"])

        for batch in batches:
            classes = batch.column(0).to_numpy(zero_copy_only=False)
            own = {c: classes == c for c in np.unique(classes).tolist()}
            for j in range(batch.num_columns - 1):
                values = batch.column(j + 1).to_numpy(zero_copy_only=False).astype(float)
                for c, mine in own.items():
                    part = values[mine] if len(own) > 1 else values
                    for b, (lo, hi) in enumerate(brackets.get((c, j), ())):
                        at = (c, j, b)
                        below[at] = below.get(at, 0) + int((part < lo).sum())
                        hits = part[(part >= lo) & (part <= hi)]
                        if len(hits):
                            inside.setdefault(at, []).append(hits)
                            held += len(hits)
            if held > HELD_VALUES:
                yield from flush()
                held = 0
        yield from flush()

    made = facts.mapInArrow(scan, "class int, column int, bracket int, region int, x double, c long")
    return made.groupBy("class", "column", "bracket", "region", "x").agg(F.sum("c").alias("c"))


def quantile_table(
    df: DataFrame, columns: Sequence[str], qs: Sequence[float], by: str | None = None,
    extras: dict[str, Callable[[Column], Column]] | None = None, names: Sequence[str] | None = None, accuracy: int = 10_000,
) -> DataFrame:
    """Exact interpolated quantiles: (by, column_name, extras..., one column per q); every column (and class) has a row, with NULL
    quantiles where it has no value.

    One aggregate sketches all columns as they are; extras are further aggregates of it. The brackets are constants of the second
    pass, which counts what lies below them and hands on only the values inside. Groups no larger than the accuracy are ranked
    whole; beyond it the sketch's error bound sets the bracket. More than CLASS_LITERALS classes are joined with their brackets.
    """
    names = list(names) if names else [f"q{i}" for i in range(len(qs))]
    extras, slack = extras or {}, 4.0 / accuracy
    own = {"_n": F.count, "_min": F.min, "_max": F.max, "_ends": lambda c: F.percentile_approx(c, _around(qs, slack), accuracy)}
    sketched = class_aggregates(df, columns, by, own | extras)
    if sketched is None:
        return _joined_quantiles(df, columns, qs, by, extras, names, accuracy)
    classes, stats = sketched
    brackets: dict[tuple[int, int], list[tuple[float, float]]] = {}
    asked = []
    for i, c in enumerate(classes):
        for j in range(len(columns)):
            known = stats[c, j]
            if not known["_n"]:
                continue
            slots: dict[tuple[float, float], list] = {}
            for s, q in enumerate(qs):
                ends = (known["_min"], known["_max"]) if known["_n"] <= accuracy else tuple(known["_ends"][2 * s:2 * s + 2])
                pos = float(q) * (known["_n"] - 1)
                slots.setdefault(ends, []).append((s, pos, math.floor(pos), math.ceil(pos)))
            brackets[i, j] = list(slots)
            asked += [(i, j, b, wanted) for b, wanted in enumerate(slots.values())]
    spark, exact = df.sparkSession, {}
    if asked:
        plan = driver_table(spark, asked, "class int, column int, bracket int, _slots array<struct<slot:int,pos:double,k:bigint,k2:bigint>>")
        keys = ["class", "column", "bracket"]
        counts = _bracketed_values(classed_columns(df, columns, by, classes), brackets)
        largest = max(stats[classes[i], j]["_n"] for i, j in brackets)
        ranked = _rank_counts(counts, keys, largest, 1, slack)
        for r in _pick(attach(ranked, plan, keys, "inner", null_safe=False), keys).collect():
            exact[r["class"], r["column"], r["slot"]] = r["v"] + (r["v2"] - r["v"]) * (r["pos"] - r["k"])
    shape = df.select(*([col(by)] if by else []), F.lit("").alias("column_name"),
                      *[f(F.lit(0.0)).over(Window.partitionBy(F.lit(0))).alias(n) for n, f in extras.items()],
                      *[F.lit(0.0).alias(n) for n in names]).schema
    shape = T.StructType([T.StructField(f.name, f.dataType) for f in shape.fields])
    rows = [(*([c] if by else []), columns[j], *[stats[c, j][n] for n in extras], *[exact.get((i, j, s)) for s in range(len(qs))])
            for i, c in enumerate(classes) for j in range(len(columns))]
    return spark.createDataFrame(rows, shape)


def _joined_quantiles(df: DataFrame, columns: Sequence[str], qs: Sequence[float], by: str, extras: dict, names: list[str],
                      accuracy: int) -> DataFrame:
    """quantile_table for many classes: every value is joined with the brackets of its class and column."""
    keys = listed(by) + ["column_name"]
    if len(columns) > SKETCH_COLUMNS:
        # A columnar scan reads every column once, however they are grouped.
        chunks = [columns[i:i + SKETCH_COLUMNS] for i in range(0, len(columns), SKETCH_COLUMNS)]
        return reduce(DataFrame.unionByName, [_joined_quantiles(df, c, qs, by, extras, names, accuracy) for c in chunks])
    slack = 4.0 / accuracy
    flat = df.select(col(by), *clean_doubles(columns))
    facts = flat.unpivot([col(by)], [F.col(f"c{i}").alias(n) for i, n in enumerate(columns)], "column_name", "value")
    sketched = pin(facts.groupBy(*keys).agg(
        F.count("value").alias("_n"), F.min("value").alias("_min"), F.max("value").alias("_max"),
        *[f(F.col("value")).alias(n) for n, f in extras.items()],
        F.percentile_approx("value", _around(qs, slack), accuracy).alias("_ends"),
    ))
    few, ends = F.col("_n") <= accuracy, F.col("_ends")
    slots = sketched.filter("_n > 0").select(*keys, F.array(*[
        _slot(i, F.when(few, F.col("_min")).otherwise(ends[2 * i]), F.when(few, F.col("_max")).otherwise(ends[2 * i + 1]),
              F.lit(float(q)) * (F.col("_n") - 1))
        for i, q in enumerate(qs)]).alias("_slots"))
    largest = sketched.agg(F.max("_n")).first()[0] or 0
    known = facts.filter(F.col("value").isNotNull())
    counts = _count_bracketed(attach(known, slots, keys, "inner", part_of=sketched), keys, len(qs))
    ranked = _rank_counts(counts, keys, largest, len(qs), slack)
    exact = _pick(attach(ranked, slots, keys, "inner", part_of=sketched), keys)
    value = F.col("v") + (F.col("v2") - F.col("v")) * (F.col("pos") - F.col("k"))
    wide = exact.groupBy(*keys).agg(
        *[F.max(F.when(F.col("slot") == i, value)).alias(n) for i, n in enumerate(names)])
    return attach(sketched.drop("_n", "_min", "_max", "_ends"), wide, keys, part_of=sketched)


def quantile_values(df: DataFrame, columns: Sequence[str], qs: Sequence[float]) -> dict[str, list[float]]:
    """The same quantiles on the driver, one short list per column."""
    table = quantile_table(df, columns, qs)
    return {r["column_name"]: [r[f"q{i}"] for i in range(len(qs))] for r in table.collect()}


def kth_rows(df: DataFrame, order: Sequence[str], positions: Sequence[int], accuracy: int = 10_000) -> list[tuple]:
    """Order keys of the rows at the given 0-based positions of a total order.

    The leading column is decided by bracketing. Few rows that tie with it are ranked by the
    other columns; many are bracketed in turn.
    """
    if not positions:
        return []
    head, rest = order[0], list(order[1:])
    slack = 4.0 / accuracy
    facts = df.select(col(head).alias("value"))
    n = facts.count()
    shares = [p / max(n - 1, 1) for p in positions]
    kind = df.schema[head].dataType
    ends, least, most = facts.agg(
        F.percentile_approx("value", _around(shares, slack), accuracy), F.min("value"), F.max("value")).first()
    slots = F.array(*[
        _slot(i, literal(least if n <= accuracy else ends[2 * i], kind), literal(most if n <= accuracy else ends[2 * i + 1], kind),
              F.lit(p))
        for i, p in enumerate(positions)]).alias("_slots")
    counts = _count_bracketed(facts.select("value", slots), [], len(positions))
    ranked = _rank_counts(counts, [], n, len(positions), slack).select("*", slots)
    found = sorted(_pick(ranked, []).collect(), key=lambda r: r["slot"])
    if not rest:
        return [(r["v"],) for r in found]
    wanted = F.lit(False)
    for r in found:
        wanted = wanted | ((col(head) == literal(r["v"], kind)) & (F.col("_nth") == r["k"] - r["before"]))
    nth = F.row_number().over(Window.partitionBy(col(head)).orderBy(*[col(c) for c in rest])) - 1
    if all(r["ties"] <= WINDOW_ROWS for r in found):
        ties = df.select(*[col(c) for c in order]).filter(col(head).isin([literal(r["v"], kind) for r in found]))
        rows = ties.withColumn("_nth", nth).filter(wanted).collect()
        at = {(r[0], r["_nth"]): tuple(r)[:-1] for r in rows}
        return [at[r["v"], r["k"] - r["before"]] for r in found]
    out = []
    for r in found:
        ties = df.filter(col(head) == literal(r["v"], kind))
        out.append((r["v"], *kth_rows(ties, rest, [r["k"] - r["before"]], accuracy)[0]))
    return out


def literal(value, kind: T.DataType) -> Column:
    """A collected value as a literal of its column's type; wall-clock times go through text."""
    if isinstance(kind, T.TimestampNTZType):
        return F.lit(value.isoformat(sep=" ")).cast(kind)
    return F.lit(value).cast(kind)


def at_or_after(df: DataFrame, order: Sequence[str], bound: tuple) -> Column:
    """Lexicographic `order >= bound` as a plain predicate."""
    name, value = order[0], literal(bound[0], df.schema[order[0]].dataType)
    if len(order) == 1:
        return col(name) >= value
    return (col(name) > value) | ((col(name) == value) & at_or_after(df, order[1:], bound[1:]))


def row_hash(key: str, seed: int) -> Column:
    """Pseudo-random text per row that depends only on the key and the seed."""
    return F.md5(F.concat(col(key).cast("string"), F.lit(f":{seed}")))


def hash_cuts(
    df: DataFrame, key: str, seed: int, takes: Callable[[Column], Sequence[Column]], by: str | None = None,
) -> DataFrame:
    """Per group, the hashes at which the first takes(n)[0], takes(n)[1], ... rows (in hash order) end.

    Returns (by, cuts array). Counts per hash prefix find the prefix holding each cut; only
    the rows of that prefix (about the square root of the input) are ranked.
    """
    group = by or "_all"
    hashed = df.select((col(by) if by else F.lit(0)).alias(group), row_hash(key, seed).alias("h"))
    rows = df.count()
    digits = max(1, math.ceil(math.log(max(rows, 16), 16) / 2))
    hashed = hashed.withColumn("prefix", F.substring("h", 1, digits))
    prefixes = pin(hashed.groupBy(group, "prefix").agg(F.count(F.lit(1)).alias("c")))
    sizes = prefixes.groupBy(group).agg(F.sum("c").alias("n"))
    wanted = sizes.select(group, F.posexplode(F.array(*[t.cast("long") for t in takes(F.col("n"))])).alias("slot", "take"))
    w = Window.partitionBy(group).orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)
    spans = prefixes.withColumn("before", F.coalesce(F.sum("c").over(w), F.lit(0)))
    # A take of zero ends before every hash; its edge has no prefix.
    # Every prefix holds a row, so that groups are no more than prefixes: one check bounds all.
    bound = prefixes if is_small(prefixes) else None
    edges = pin(
        attach(wanted, spans, group, "inner", part_of=prefixes)
        .filter((F.col("before") < F.col("take")) & (F.col("take") <= F.col("before") + F.col("c"))
                | ((F.col("take") == 0) & (F.col("before") == 0)))
        .select(group, F.when(F.col("take") > 0, F.col("prefix")).alias("prefix"), "slot",
                (F.col("take") - F.col("before")).alias("nth")))
    near = attach(hashed, edges.filter(F.col("prefix").isNotNull()), [group, "prefix"], "inner", part_of=bound or edges)
    nth = F.row_number().over(Window.partitionBy(group, "slot").orderBy("h"))
    found = near.withColumn("_nth", nth).filter(F.col("_nth") == F.col("nth")).select(group, "slot", "h")
    none = edges.filter(F.col("prefix").isNull()).select(group, "slot", F.lit("").alias("h"))
    cuts = pin(
        found.unionByName(none).groupBy(group)
        .agg(F.array_sort(F.collect_list(F.struct("slot", "h"))).alias("s")).select(group, F.col("s.h").alias("cuts")))
    if bound is not None:
        cuts._measured = bound._measured
    return cuts


def hash_block(
    df: DataFrame, key: str, seed: int, takes: Callable[[Column], Sequence[Column]], by: str | None = None,
    name: str = "block",
) -> DataFrame:
    """Number of cuts before each row's hash: a map over the facts, which are not shuffled."""
    cuts = hash_cuts(df, key, seed, takes, by)
    h = row_hash(key, seed)
    if by is None:
        found = cuts.first()
        passed = [(h > F.lit(c)).cast("int") for c in (found["cuts"] if found else [])]
        return df.withColumn(name, sum(passed, F.lit(0)))
    joined = attach(df, cuts, by)
    return joined.withColumn(name, F.size(F.filter("cuts", lambda c: h > c))).drop("cuts")
