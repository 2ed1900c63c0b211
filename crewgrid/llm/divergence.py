"""Source divergence audit: how far each source's use of words is from that of the other sources of its language.

Plain relational. Every document's terms are exploded twice in one pass, all of them and
the distinct ones, so that one aggregation gives a term's occurrences and its documents
by (lang, source). A second one keeps a language's terms and has each with its counts by
source. Groups are crossed with their language's kept terms (an equi-join on the language
and a share of the terms, so that a large language is many keys), which gives zeros where
a source lacks a term; that table joins itself on (lang, term), one order of each pair,
and sums. Windows rank.

Work grows with kept terms times the square of a language's sources, as the result itself
does with that square. Only counts are shuffled, never texts.

Nulls and odd input: null text, lang and source are ''. A repeated row is a document of its own; ids aren't read.
A group without terms has pairs, and none of its terms are listed; a language without kept
terms gives pairs of value 0. Texts of any length are one row's arrays of terms. An
empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import lower_ascii, shuffles, table, written

TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: Documents of its language that a kept term is in; ranks of the terms' part.
LEAST, TOP = 10, 10


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(1000000000 * (count + 2) / (total + 2 * kept)), in decimals, as the product may pass 64 bits."""
    wide = "decimal(20,0)"
    return F.lit(1).cast("long") + _div(F.lit(1_000_000_000).cast("decimal(10,0)") * (count + 2).cast(wide), (total + 2 * kept).cast(wide))


def _apart(p: Column, q: Column) -> Column:
    return _div((p - q) * (p - q), p + q)


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents with it)."""
    terms = docs.select("lang", "source", F.regexp_extract_all(lower_ascii(F.col("text")), F.lit(TERM), 0).alias("terms"))
    both = terms.select("lang", "source", F.posexplode(F.array("terms", F.array_distinct("terms"))).alias("distinct", "terms"))
    each = both.select("lang", "source", "distinct", F.explode("terms").alias("term"))
    return each.groupBy("lang", "source", "term").agg(F.sum(1 - F.col("distinct")).alias("n"), F.sum("distinct").alias("docs"))


def divergence(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """docs: text, lang, source. lang, source, part, item, value, rank."""
    docs = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")))
    counts = F.map_from_entries(F.collect_list(F.struct("source", "n")))
    kept = term_counts(docs).groupBy("lang", "term").agg(F.sum("n").alias("of_lang"), F.sum("docs").alias("docs"), counts.alias("counts"))
    kept = written(kept.where(F.col("docs") >= least).drop("docs"), "kept-terms")

    langs = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("of_lang").alias("lang_total"))
    totals = kept.select("lang", F.explode("counts").alias("source", "n")).groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = docs.select("lang", "source").distinct().join(langs, "lang", "left").join(totals, ["lang", "source"], "left").na.fill(0)
    groups = written(groups, "groups")

    shares = shuffles(docs.sparkSession)
    terms = kept.withColumn("share", F.pmod(F.xxhash64("term"), F.lit(shares)))
    crossed = terms.join(groups.withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shares - 1).cast("long")))), ["lang", "share"])
    n = F.coalesce(F.try_element_at("counts", F.col("source")), F.lit(0))
    p, q = _share(n, F.col("total"), F.col("kept")), _share(F.col("of_lang"), F.col("lang_total"), F.col("kept"))
    dense = written(crossed.select("lang", "source", "term", n.alias("n"), p.alias("p"), q.alias("q")), "dense")

    one, other = (dense.select("lang", "term", F.col("source").alias(s), F.col("p").alias(v)) for s, v in (("source", "p"), ("item", "q")))
    met = one.join(other, ["lang", "term"]).where(F.col("source") < F.col("item"))
    sums = met.groupBy("lang", "source", "item").agg(F.sum(_apart(F.col("p"), F.col("q"))).alias("value"))
    sums = written(sums, "divergences")
    both = sums.unionByName(sums.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    names = groups.select("lang", "source")
    pairs = names.join(names.withColumnRenamed("source", "item"), "lang").where(F.col("source") != F.col("item"))
    pairs = pairs.join(both, ["lang", "source", "item"], "left").na.fill(0, ["value"])

    above = dense.where((F.col("n") > 0) & (F.col("p") > F.col("q"))).select("lang", "source", F.col("term").alias("item"), _apart(F.col("p"), F.col("q")).alias("value"))
    place = F.row_number().over(W.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    pairs = pairs.withColumn("rank", place)
    above = above.withColumn("rank", place).where(F.col("rank") <= top)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("part", F.lit("pair")).select(columns).unionByName(above.withColumn("part", F.lit("term")).select(columns))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
o AS (SELECT doc, lang, source, unnest(terms) AS term FROM d),
v AS (SELECT lang, term, count(*) AS n FROM o GROUP BY ALL HAVING count(DISTINCT doc) >= 10),
l AS (SELECT lang, count(*) AS v, sum(n) AS total FROM v GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM o SEMI JOIN v USING (lang, term) GROUP BY ALL),
t AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
p AS (
  SELECT g.lang, g.source, v.term, coalesce(c.n, 0) AS n,
         1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 2) // (coalesce(t.total, 0) + 2 * l.v)::HUGEINT AS p, 1 + 1000000000::HUGEINT * (v.n + 2) // (l.total + 2 * l.v)::HUGEINT AS q
  FROM g JOIN v USING (lang) JOIN l USING (lang) LEFT JOIN t USING (lang, source) LEFT JOIN c USING (lang, source, term)),
s AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
x AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM x)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM r WHERE part = 'pair' OR rank <= 10"""
