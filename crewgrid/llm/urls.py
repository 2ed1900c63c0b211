"""URL filters: rules first, then an empirical-Bayes reputation of the host.

Labelled pages give each host a count of outcomes and of bad ones. A host's
rate is shrunk to its registered domain's, that to its suffix's, that to the
rate of all pages, each by a beta-binomial prior whose strength is estimated
from the spread of the level's own groups (method of moments). A host is
blocked where the lower posterior bound of its bad rate is over `max_bad`.

A host's suffix is its last label, or its last two if `suffixes` lists them (co.uk); its
registered domain has one label more. A port is no part of either, and an IP address
is its own domain and suffix.

Nulls and odd input: a null url or one without `://` has an empty host and
path, fits no rule and gets the verdict of the overall rate. Null labels do
not count. Repeated pages are judged and counted each. An empty table gives
an empty result. Extra columns of the inputs are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lower_ascii, table, written

RULES = (("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/"))
MAX_BAD, Z = 0.25, 1.645
#: Public suffixes of two labels. A parameter: give a longer list where the corpus needs it.
SUFFIXES = (
    "ac.uk", "co.uk", "gov.uk", "org.uk", "com.au", "net.au", "org.au", "com.br", "org.br", "co.in", "co.jp", "ne.jp", "or.jp", "co.kr", "or.kr", "com.cn", "com.mx", "co.nz",
    "com.tr", "com.tw", "co.za", "blogspot.com", "github.io", "gitlab.io", "wordpress.com",
)
#: Up to so many rules become one expression; longer lists are joined on the host's suffixes.
INLINE_RULES = 256
#: Up to so many hosts are sent to all executors (about 60 bytes each); beyond, hosts are joined by a shuffle.
BROADCAST_HOSTS = 100_000


def parts(url: Column) -> tuple[Column, Column]:
    """Host in lower case and path."""
    host = F.regexp_extract(url, "://([^/?#]*)", 1)
    path = F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1)
    return lower_ascii(F.coalesce(host, F.lit(""))), F.coalesce(path, F.lit(""))


def split_rule(rule: str) -> tuple[str, str]:
    host, slash, path = rule.partition("/")
    return host, slash + path


def with_rules(pages: DataFrame, rules) -> DataFrame:
    """Adds rule and rule_verdict: of the rules that fit, the longest; of equally long ones, the last in the list."""
    if len(rules) <= INLINE_RULES:
        found = [F.lit(None).cast("string")]
        said = [F.lit(None).cast("string")]
        for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
            host, path = split_rule(rule)
            fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
            found.append(F.when(fits, F.lit(rule)))
            said.append(F.when(fits, F.lit(verdict)))
        return pages.withColumns({"rule": F.coalesce(*found[::-1]), "rule_verdict": F.coalesce(*said[::-1])})
    listed = pages.sparkSession.createDataFrame([(*split_rule(r), r, v, i) for i, (v, r) in enumerate(rules)], "r_host string, r_path string, rule string, rule_verdict string, place long")
    places = pages.select("host", "path").distinct()
    suffixes = F.expr("transform(sequence(1, size(split(host, '[.]'))), i -> array_join(slice(split(host, '[.]'), i, 1 + size(split(host, '[.]')) - i), '.'))")
    best = (
        places.withColumn("r_host", F.explode(suffixes)).join(listed, "r_host").where(F.expr("startswith(path, r_path)"))
        .groupBy("host", "path").agg(F.max_by(F.struct("rule", "rule_verdict"), F.struct(F.length("rule"), "place")).alias("b"))
        .select("host", "path", "b.rule", "b.rule_verdict")
    )
    return pages.join(best, ["host", "path"], "left")


def _level(groups: DataFrame, key: str, prior: str) -> DataFrame:
    """Posterior mean of each group about its parent's mean `prior`; the prior's strength comes from the spread of the level's rates."""
    # Of groups with outcomes: weighted spread of the rates about their priors, less what sampling alone gives.
    s = groups.where("n > 0").agg(
        F.sum("n").alias("nn"), F.count("*").alias("g"),
        F.sum(F.expr(f"n * power(bad / n - {prior}, 2)")).alias("ss"),
        F.sum(F.expr(f"n * {prior} * (1 - {prior})")).alias("pq"),
        F.sum(F.expr("cast(n as double) * n")).alias("n2"),
    )
    within = F.expr("pq / nn")
    between = (F.col("ss") - F.col("g") * within) / F.greatest(F.col("nn") - F.col("n2") / F.col("nn"), F.lit(1.0))
    k = s.select(F.coalesce(F.when(between > 0, F.least(F.greatest(within / between - 1, F.lit(1.0)), F.lit(10000.0))), F.lit(10000.0))).first()[0]
    return groups.withColumns({f"{key}_mean": (F.col("bad") + k * F.col(prior)) / (F.col("n") + k), f"{key}_k": F.lit(k)})


def levels(host: Column, suffixes=SUFFIXES) -> tuple[Column, Column]:
    """Registered domain and suffix."""
    name = F.regexp_replace(host, ":[0-9]*$", "")
    last = lambda n: F.substring_index(name, ".", -n)
    listed, address = last(2).isin(*suffixes), name.rlike(r"^([0-9]+[.]){3}[0-9]+$|^\[")
    return F.when(address, name).when(listed, last(3)).otherwise(last(2)), F.when(address, name).when(listed, last(2)).otherwise(last(1))


def host_reputation(labelled: DataFrame, max_bad: float = MAX_BAD, z: float = Z, suffixes=SUFFIXES) -> DataFrame:
    """labelled: host, bad (1, 0 or null: no outcome). One row a host: n, bad, mean, bound, blocked."""
    hosts = labelled.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).cast("long").alias("bad"))
    domain, suffix = levels(F.col("host"), suffixes)
    hosts = written(hosts.withColumns({"domain": domain, "suffix": suffix}), "hosts")
    overall = hosts.agg(((F.coalesce(F.sum("bad"), F.lit(0)) + 1) / (F.coalesce(F.sum("n"), F.lit(0)) + 2)).alias("overall")).first()[0]
    suffixes = hosts.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = _level(suffixes.withColumn("overall", F.lit(overall)), "suffix", "overall").select("suffix", "suffix_mean")
    domains = hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    domains = _level(domains.join(suffixes, "suffix"), "domain", "suffix_mean").select("domain", "domain_mean")
    out = _level(hosts.join(domains, "domain"), "host", "domain_mean")
    deviation = F.expr("sqrt(host_mean * (1 - host_mean) / (n + host_k + 1))")
    out = out.withColumn("bound", F.col("host_mean") - F.lit(z) * deviation)
    return out.select("host", "n", "bad", F.col("host_mean").alias("mean"), "bound", (F.col("bound") > max_bad).alias("blocked"))


def url_filter(pages: DataFrame, outcomes: DataFrame, rules=RULES, max_bad: float = MAX_BAD, z: float = Z, suffixes=SUFFIXES) -> DataFrame:
    """pages: page_id, url, doc_id (what the page shows, or null); outcomes: doc_id, bad. Returns page_id, host, path, rule, verdict."""
    host, path = parts(F.col("url"))
    judged = pages.select("page_id", host.alias("host"), path.alias("path"), F.col("doc_id").alias("shown"))
    known = outcomes.where("doc_id is not null").groupBy("doc_id").agg(F.max("bad").cast("long").alias("bad"))
    # Pages that show no document have no outcome and no part in the join.
    labelled = judged.where("shown is not null").join(known, F.col("shown") == F.col("doc_id"), "left").select("host", "bad")
    labelled = labelled.unionByName(judged.where("shown is null").select("host", F.lit(None).cast("long").alias("bad")))
    hosts = written(host_reputation(labelled, max_bad, z, suffixes).select("host", "blocked"), "reputation")
    hosts = F.broadcast(hosts) if hosts.count() <= BROADCAST_HOSTS else hosts
    ruled = with_rules(judged.drop("shown"), rules)
    return ruled.join(hosts, "host", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("rule_verdict", F.when(F.col("blocked"), "block").otherwise("allow")).alias("verdict")
    )


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages. A page shows the document whose id is the number after the language in its path; quality 0 is a bad outcome."""
    pages = table(spark, sf_dir, "pages").select(
        "page_id", "url", F.expr("try_cast(nullif(regexp_extract(url, '://[^/?#]*/[a-z]+/([0-9]+)', 1), '') as bigint)").alias("doc_id")
    )
    outcomes = table(spark, sf_dir, "labels").select("doc_id", (1 - F.col("quality")).alias("bad"))
    return url_filter(pages, outcomes)


def _level_sql(name: str, rows: str, key: str, prior: str) -> str:
    """The SQL of _level over the relation `rows`."""
    return f"""
    {name}_k AS (
      SELECT coalesce(CASE WHEN b > 0 THEN least(greatest(w / b - 1, 1.0), 10000.0) END, 10000.0) AS k
      FROM (SELECT w, (ss - g * w) / greatest(nn - n2 / nn, 1.0) AS b
            FROM (SELECT sum(n)::DOUBLE AS nn, count(*) AS g, sum(n * power(bad / n - {prior}, 2)) AS ss,
                         sum(n * {prior} * (1 - {prior})) / sum(n) AS w, sum(n::DOUBLE * n) AS n2
                  FROM {rows} WHERE n > 0))),
    {name} AS (SELECT r.*, (bad + k * {prior}) / (n + k) AS {key}_mean, k AS {key}_k FROM {rows} r CROSS JOIN {name}_k)"""


def _level_of(n: int) -> str:
    """The SQL of the host's last n labels, or n + 1 if its last two are a listed suffix; of an address itself."""
    name = "regexp_replace(host, ':[0-9]*$', '')"
    last = lambda k: f"array_to_string(string_split({name}, '.')[-{k}:], '.')"
    listed = ", ".join(f"'{s}'" for s in SUFFIXES)
    return f"CASE WHEN regexp_matches({name}, '^([0-9]+[.]){{3}}[0-9]+$|^\\[') THEN {name} WHEN {last(2)} IN ({listed}) THEN {last(n + 1)} ELSE {last(n)} END"


def op9_sql() -> str:
    fits = lambda r: (lambda h, p: f"((host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}'))")(*split_rule(r))
    longest = sorted(RULES, key=lambda r: -len(r[1]))
    pick = lambda i: "CASE " + " ".join(f"WHEN {fits(r[1])} THEN '{r[i]}'" for r in longest) + " END"
    return f"""
    WITH p AS (
      SELECT page_id, translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path,
             try_cast(nullif(regexp_extract(url, '://[^/?#]*/[a-z]+/([0-9]+)', 1), '') AS BIGINT) AS shown
      FROM pages),
    o AS (SELECT doc_id, max(1 - quality) AS bad FROM labels GROUP BY doc_id),
    h0 AS (
      SELECT host, count(bad) AS n, coalesce(sum(bad), 0)::BIGINT AS bad, {_level_of(2)} AS domain, {_level_of(1)} AS suffix
      FROM p LEFT JOIN o ON shown = doc_id GROUP BY host),
    al AS (SELECT (sum(bad) + 1) / (sum(n) + 2) AS overall FROM h0),
    s0 AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad, any_value(overall) AS overall FROM h0 CROSS JOIN al GROUP BY suffix),
    {_level_sql('s1', 's0', 'suffix', 'overall')},
    d0 AS (SELECT domain, any_value(suffix_mean) AS suffix_mean, sum(n) AS n, sum(bad) AS bad
           FROM (SELECT h0.*, s1.suffix_mean FROM h0 JOIN s1 USING (suffix)) GROUP BY domain),
    {_level_sql('d1', 'd0', 'domain', 'suffix_mean')},
    h1 AS (SELECT h0.*, d1.domain_mean FROM h0 JOIN d1 USING (domain)),
    {_level_sql('h2', 'h1', 'host', 'domain_mean')},
    r AS (SELECT host, host_mean - {Z} * sqrt(host_mean * (1 - host_mean) / (n + host_k + 1)) > {MAX_BAD} AS blocked FROM h2)
    SELECT page_id, p.host AS host, path, {pick(1).replace('(host', '(p.host').replace('(host,', '(p.host,')} AS rule,
           coalesce({pick(0).replace('(host', '(p.host').replace('(host,', '(p.host,')}, CASE WHEN blocked THEN 'block' ELSE 'allow' END) AS verdict
    FROM p LEFT JOIN r ON p.host = r.host"""
