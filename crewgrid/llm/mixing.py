"""Mixing sources to target weights by capped water-filling.

Every source wants its weight's share of all words. A source stops at
`epochs` times its own words; what it can't take goes to the others by
weight, until no target is over its source's stop. A source then gives
floor(target / size) whole repetitions of its documents, and of one more
repetition a prefix of its documents in seeded hash order whose words come
nearest the rest (the error is half a document at most).

Nulls and odd input: a null text has size 0; a null source is a source of
its own, last in order; a null doc_id is hashed as the word null. Repeated
rows are documents of their own; equal ones are interchangeable. A document without
words is taken as often as others of its place, never over the cap. Without
words all targets are 0. Extra columns pass through `mixed` and are ignored
by `mix`; working names are chosen among those that no column has, and a column
of the name asked for as `reps` is refused.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import discard, table, unused, written

WEIGHTS, EPOCHS, SEED = (5, 2, 1), 3, "mix-1"
#: Range partitions when sources are numbered: so many counts reach the driver.
RANGES = 64
#: Digits of a row's key, and how many of them divide a source at a time, until the range where its fraction ends has so few rows.
KEY, DIGITS, RANGE_ROWS = 48, 3, 20_000
#: Up to so many sources are sent to all tasks (about 100 bytes each); beyond, rows are joined by a shuffle.
BROADCAST_SOURCES = 100_000


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def numbered(sources: DataFrame) -> DataFrame:
    """Adds __i: the place of __s by code point, nulls last. Ranges are numbered side by side; only their counts meet."""
    ranged = written(sources.repartitionByRange(RANGES, F.col("__s").asc_nulls_last()).withColumn("__r", F.spark_partition_id()), "sources")
    at, starts = 0, {}
    for r, n in sorted(ranged.groupBy("__r").count().collect()):
        starts[r], at = at, at + n
    start = F.coalesce(*[F.when(F.col("__r") == r, F.lit(n)) for r, n in starts.items()], F.lit(0))
    place = F.row_number().over(W.partitionBy("__r").orderBy(F.col("__s").asc_nulls_last())) - 1
    return ranged.withColumn("__i", start + place).drop("__r")


def targets(sources: DataFrame, weights=WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """sources: __s, __size. Adds __target. Each pass clamps the sources that are over their stop and shares the rest anew."""
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("__i") % len(weights) + 1).cast("int"))
    rows = written(numbered(sources).withColumn("__w", weight.cast("long")), "weights")
    stop = epochs * F.col("__size")
    level, last = -1.0, None
    total = rows.agg(F.sum("__size")).first()[0] or 0
    while level != last:  # the level only rises; two equal ones in turn mean that no more source is clamped
        last = level
        held = F.col("__w") * F.lit(level) > stop
        taken, free = rows.agg(F.sum(F.when(held, stop)), F.sum(F.when(~held, F.col("__w")))).first()
        if not free:
            break
        rest, share = total - (taken or 0), free
        level = rest / share
    held = F.col("__w") * F.lit(last) > stop
    open_to = F.col("__w") * F.lit(float(rest)) / F.lit(float(share)) if total else F.lit(0.0)
    return rows.withColumn("__target", F.when(held, stop.cast("double")).otherwise(open_to)).select("__s", "__size", "__target")


def order_key(doc_id: Column, text: Column, seed: str) -> Column:
    """48 hexadecimal digits: the seeded hash of the id, then a hash of the text, so that only equal texts of one id tie."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))))
    return F.concat(h, F.lower(F.lpad(F.hex(F.xxhash64(text)), 16, "0")))


def _small(by: DataFrame) -> DataFrame:
    """A table of one row a source, for joins: sent to all tasks if its count allows, else shuffled."""
    return F.broadcast(by) if by.count() <= BROADCAST_SOURCES else by


def cuts(rows: DataFrame, weights=WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """rows: __s, __n, __k (a written table). One row a source: __size, __target, __whole, and where its fraction of a repetition ends: at the key
    __cut, of whose __of equal rows __taken are in; smaller keys are in.

    The words before each of 4,096 ranges of keys tell in which range the fraction ends; that one is divided again until it has few rows."""
    by = targets(rows.groupBy("__s").agg(F.sum("__n").alias("__size")), weights, epochs)
    whole = F.when(F.col("__size") > 0, F.floor(F.col("__target") / F.col("__size"))).otherwise(0).cast("int")
    by = by.withColumn("__whole", whole).withColumn("__rest", F.col("__target") - F.col("__whole") * F.col("__size"))
    by = written(by.withColumns({"__before": F.lit(0).cast("long"), "__cut": F.lit("")}), "targets")
    for at in range(0, KEY, DIGITS):
        # Sources whose fraction is nothing are done.
        open_to = _small(by.where("__rest > 0").select(F.col("__s").alias("__t"), "__before", "__cut", "__rest"))
        within = rows.join(open_to, F.col("__s").eqNullSafe(F.col("__t")) & F.startswith("__k", "__cut")).withColumn("__b", F.substring("__k", at + 1, DIGITS))
        ranges = within.groupBy("__t", "__b").agg(F.sum("__n").alias("__words"), F.count("*").alias("__rows"), F.max("__before").alias("__start"), F.max("__rest").alias("__r"))
        earlier = F.sum("__words").over(W.partitionBy("__t").orderBy("__b").rowsBetween(W.unboundedPreceding, -1))
        ranges = ranges.withColumn("__start", F.col("__start") + F.coalesce(earlier, F.lit(0))).where("__start <= __r")
        ends = ranges.groupBy("__t").agg(F.max_by(F.struct("__b", "__start", "__rows"), "__b").alias("__e"))
        ends = by.join(ends, F.col("__s").eqNullSafe(F.col("__t")), "left").withColumns({"__before": F.coalesce("__e.__start", "__before"), "__cut": F.concat("__cut", F.coalesce("__e.__b", F.lit("")))})
        ends = written(ends.select(*by.columns, F.col("__e.__rows").alias("__rows")), "targets")
        most = ends.agg(F.max("__rows")).first()[0]
        discard(by)
        written_at, by = ends.written_at, ends.drop("__rows")
        by.written_at = written_at
        if not most or most <= RANGE_ROWS:
            break
    open_to = _small(by.where("__rest > 0").select(F.col("__s").alias("__t"), "__before", "__cut", "__rest"))
    last = rows.join(open_to, F.col("__s").eqNullSafe(F.col("__t")) & F.startswith("__k", "__cut"))
    last = last.groupBy("__t", "__k").agg(F.max("__n").alias("__n"), F.count("*").alias("__of"), F.max("__before").alias("__before"), F.max("__rest").alias("__rest"))
    earlier = F.sum(F.col("__n") * F.col("__of")).over(W.partitionBy("__t").orderBy("__k").rowsBetween(W.unboundedPreceding, -1))
    left = F.col("__rest") - F.col("__before") - F.coalesce(earlier, F.lit(0))
    # A row is in if at least half of it is within the rest.
    taken = F.when(F.col("__n") == 0, F.when(left >= 0, F.col("__of")).otherwise(0)).otherwise(F.least(F.col("__of"), F.greatest(F.lit(0), F.floor((2 * left - F.col("__n")) / (2 * F.col("__n"))) + 1)))
    last = last.withColumn("__taken", taken.cast("long")).where("__taken > 0").groupBy("__t").agg(F.max_by(F.struct("__k", "__taken", "__of"), "__k").alias("__e"))
    out = by.join(last, F.col("__s").eqNullSafe(F.col("__t")), "left")
    # In a range of which nothing is in, the cut is the range's first digits: they come before all its keys.
    out = out.select("__s", "__size", "__target", "__whole", F.coalesce("__e.__k", "__cut").alias("__cut"), F.coalesce("__e.__taken", F.lit(0)).alias("__taken"), F.coalesce("__e.__of", F.lit(0)).alias("__of"))
    out = written(out, "cuts")
    discard(by)
    return out


def _taken(docs: DataFrame, source: str, key: str, ends: DataFrame, size: str, target: str, reps: str) -> DataFrame:
    """docs with size, target and reps, decided row by row from its source's cut."""
    place, part, whole, cut, taken, of, start = unused(docs, "place", "part", "whole", "cut", "taken", "of", "start")
    s = unused(docs, "by")[0]
    ends = ends.toDF(s, size, target, whole, cut, taken, of)
    split = (F.col(key) == F.col(cut)) & (F.col(taken) < F.col(of))
    rows = docs.join(_small(ends), docs[source].eqNullSafe(ends[s])).drop(s)
    in_ = (F.col(key) < F.col(cut)) | ((F.col(key) == F.col(cut)) & (F.col(taken) > 0))
    columns = [*docs.columns, size, target, reps]
    sure = rows.where(~split).withColumn(reps, F.col(whole) + in_.cast("int")).select(columns)
    if not ends.where(F.col(taken) < F.col(of)).limit(1).count():
        return sure
    # Equal rows of which some are in: numbered within the tasks that read them, with the counts of the tasks before.
    some = written(rows.where(split).withColumn(part, F.spark_partition_id()), "equal")
    counts = some.groupBy(F.col(source).alias(s), F.col(part).alias(place)).agg(F.count("*").alias(start))
    before = F.sum(start).over(W.partitionBy(s).orderBy(place).rowsBetween(W.unboundedPreceding, -1))
    counts = counts.withColumn(start, F.coalesce(before, F.lit(0)))
    some = some.join(counts, F.col(source).eqNullSafe(F.col(s)) & (F.col(part) == F.col(place)))
    number = F.col(start) + F.row_number().over(W.partitionBy(source, part).orderBy(key))
    return sure.unionByName(some.withColumn(reps, F.col(whole) + (number <= F.col(taken)).cast("int")).select(columns))


def mixed(docs: DataFrame, weights=WEIGHTS, epochs: int = EPOCHS, seed: str = SEED, reps: str = "__reps") -> DataFrame:
    """docs with doc_id, source, text and others; adds `reps`, the times that the mix takes the document. Only ids, counts and keys are shuffled."""
    if reps in docs.columns:
        raise ValueError(f"documents have a column {reps}")
    key = order_key(F.col("doc_id"), F.col("text"), seed)
    rows = written(docs.select(F.col("source").alias("__s"), n_words(F.col("text")).alias("__n"), key.alias("__k")), "sizes")
    ends = cuts(rows, weights, epochs)
    discard(rows)
    k, size, target = unused(docs, "key", "size", "target")
    return _taken(docs.withColumn(k, key), "source", k, ends, size, target, reps).select(*docs.columns, reps)


def mix(docs: DataFrame, weights=WEIGHTS, epochs: int = EPOCHS, seed: str = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document."""
    key = order_key(F.col("doc_id"), F.col("text"), seed)
    rows = written(docs.select("doc_id", F.col("source").alias("__s"), n_words(F.col("text")).alias("__n"), key.alias("__k")), "sizes")
    out = _taken(rows, "__s", "__k", cuts(rows, weights, epochs), "source_size", "target", "reps")
    return out.select("doc_id", F.col("__n").alias("size"), "source_size", "target", (F.col("__n") * F.col("reps")).alias("taken"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


#: Water-filling in closed form: by rising stop for each unit of weight, the clamped sources are a prefix.
OP4_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS n,
         md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null')) AS h
  FROM documents),
s AS (
  SELECT source, sum(n)::BIGINT AS size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS i FROM d GROUP BY source),
w AS (SELECT source, size, CASE i WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM s),
c AS (
  SELECT *, sum(size) OVER () AS total,
         coalesce(sum(3 * size) OVER (ORDER BY 3 * size / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS clamped,
         sum(w) OVER (ORDER BY 3 * size / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_w
  FROM w),
f AS (SELECT min(3 * size / w) AS first_open FROM c WHERE w * (total - clamped) <= 3 * size * open_w),
l AS (SELECT (total - clamped)::DOUBLE AS rest, open_w::DOUBLE AS open_w
      FROM c, f WHERE 3 * size / w = first_open ORDER BY clamped LIMIT 1),
t AS (SELECT source, size, CASE WHEN 3 * size / w < first_open THEN (3 * size)::DOUBLE WHEN total = 0 THEN 0.0 ELSE w * rest / l.open_w END AS target
      FROM c, f, l),
p AS (
  SELECT d.doc_id, d.n, t.size, t.target, CASE WHEN t.size > 0 THEN floor(t.target / t.size) ELSE 0 END AS whole,
         sum(d.n) OVER (PARTITION BY d.source ORDER BY d.h, d.doc_id, d.n ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, n AS size, size AS source_size, target,
       (n * (whole + CASE WHEN 2 * upto - n <= 2 * (target - whole * size) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM p"""
