"""Pages judged by rules and, where none fits, by the reputation of their host.

A host's share of bad pages is a beta-binomial estimate: what its labelled pages say, shrunk towards its
registered domain, that towards the public suffix, that towards all pages. How strongly a level is shrunk
comes from the data: the more its groups differ beyond chance, the weaker. A page is blocked if
the lower bound of its host's share lies above a limit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starcart.llm.words import stored

# Rules as (verdict, host, path); a rule is written host + path.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
# Public suffixes of two labels.
SECOND_LEVEL = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "co.jp", "co.nz", "com.br", "co.in", "co.za")

LIMIT = 0.5  # share of bad pages
SURENESS = 1.645  # standard deviations below the mean
WEAKEST, STRONGEST = 1.0, 10_000.0  # pseudo-counts of a prior
_STEPS = 20
_LEAST, _MOST = 1 / (STRONGEST + 1), 1 / (WEAKEST + 1)
GRID = [_LEAST * (_MOST / _LEAST) ** (i / _STEPS) for i in range(_STEPS + 1)]  # correlations

_URL = r"://([^/?#]*)([^?#]*)"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, _URL, 1)
    return F.translate(F.coalesce(host, F.lit("")), _UPPER, _UPPER.lower())


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest fitting rule, as a struct (rule, verdict), or null."""
    out = None
    for verdict, name, start in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(start)
        found = F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, found) if out is None else out.when(fits, found)
    return out


def suffix_of(host: Column) -> Column:
    """The public suffix: two labels where they are listed, else the last one."""
    plain = F.regexp_replace(host, ":[0-9]*$", "")
    two = F.regexp_extract(plain, r"([^.]*\.[^.]*)$", 1)
    return F.when(two.isin(*SECOND_LEVEL), two).otherwise(F.regexp_extract(plain, r"([^.]*)$", 1))


def domain_of(host: Column, suffix: Column) -> Column:
    """The suffix and one label more."""
    plain = F.regexp_replace(host, ":[0-9]*$", "")
    three = F.regexp_extract(plain, r"([^.]*\.[^.]*\.[^.]*)$", 1)
    two = F.regexp_extract(plain, r"([^.]*\.[^.]*)$", 1)
    longer = F.when(suffix.contains("."), three).otherwise(two)
    return F.when(longer == "", plain).otherwise(longer)


def strength(groups: DataFrame) -> DataFrame:
    """One row: the pseudo-count of a prior over groups ``(n, bad, prior)``, by weighted moments.

    With correlation r between pages of a group, the squared distance of bad from n * prior has the mean
    n p (1 - p) v, v = 1 + (n - 1) r; the pseudo-count is 1 / r - 1. A group's moment counts with its own
    information, (n - 1) / v**2, so that no group has more than 1 / r**2, however many pages it holds. The
    weights depend on r: the weighted sums are taken at each r of a grid, all in one aggregation, and r is
    where they last change sign.
    """
    n, prior = F.col("n"), F.col("prior")
    ratio = F.pow(F.col("bad") - n * prior, F.lit(2.0)) / (n * prior * (1 - prior))
    sums = []
    for r in GRID:
        v = 1 + (n - 1) * r
        sums.append(F.sum(F.when(n > 1, r * (n - 1) * (ratio - v) / (v * v))))
    # rounded, so that r does not depend on the order of the sums
    one = groups.agg(F.transform(F.array(*sums), lambda x: F.round(F.coalesce(x, F.lit(0.0)), 6)).alias("sums"))
    at = F.col("sums")
    r = F.lit(GRID[0])
    for j, (here, above) in enumerate(zip(GRID, GRID[1:], strict=False)):
        part = at[j] / (at[j] - at[j + 1])
        r = F.when((at[j] > 0) & (at[j + 1] <= 0), here * F.pow(F.lit(above / here), part)).otherwise(r)
    r = F.when(at[len(GRID) - 1] > 0, GRID[-1]).otherwise(r)
    return one.select((1 / F.round(r, 9) - 1).alias("k"))


def _shrunk(groups: DataFrame) -> DataFrame:
    """Groups with their posterior ``mean`` and pseudo-count ``k``."""
    one = F.broadcast(strength(groups))  # a single row
    return groups.join(one, how="cross").withColumn(
        "mean", (F.col("k") * F.col("prior") + F.col("bad")) / (F.col("k") + F.col("n"))
    )


def reputations(outcomes: DataFrame) -> DataFrame:
    """``host, share, bound`` from rows ``(host, n, bad)``: labelled pages and bad ones per host.

    share is the posterior mean of the share of bad pages, bound its lower bound. A host without labelled pages
    has its domain's share; without any labelled page all have a share of one half.
    """
    hosts = outcomes.withColumn("suffix", suffix_of(F.col("host")))
    hosts = stored(hosts.withColumn("domain", domain_of(F.col("host"), F.col("suffix"))), "hosts")
    sums = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    domains = hosts.groupBy("domain", "suffix").agg(*sums)
    suffixes = domains.groupBy("suffix").agg(*sums)
    everything = suffixes.agg(
        ((F.sum("bad") + 1) / (F.sum("n") + 2)).alias("prior"), (F.sum("n") + 3).alias("pages")
    )
    everything = F.broadcast(everything)  # a single row
    # each level is asked for its groups and for their strength: stored, it is worked out once
    suffixes = stored(_shrunk(suffixes.join(everything.select("prior"), how="cross")), "suffixes")
    of_suffix = suffixes.select("suffix", F.col("mean").alias("prior"))
    domains = stored(_shrunk(domains.join(of_suffix, "suffix")), "domains")
    of_domain = domains.select("domain", F.col("mean").alias("prior"))
    known = _shrunk(hosts.join(of_domain, "domain")).join(everything.select("pages"), how="cross")
    # of the host's share, and of the mean that all shares are shrunk towards in the end
    sd = F.sqrt(
        F.col("mean") * (1 - F.col("mean")) * (1 / (F.col("k") + F.col("n") + 1) + 1 / F.col("pages"))
    )
    return known.select("host", F.col("mean").alias("share"), (F.col("mean") - SURENESS * sd).alias("bound"))


def document_of(path: Column) -> Column:
    """The number of the document a page shows: the last part of its path."""
    return F.regexp_extract(path, r"/([0-9]{1,18})(\.html)?/?$", 1).try_cast("long")


def judged(pages: DataFrame, labels: DataFrame, limit: float = LIMIT) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict, share.

    Labels of a page are those of the document it shows; a page is bad if its quality is 0 or it is
    toxic. host and path are empty for a null url or one without ``://``; such pages form a host of
    their own. Repeated pages count each; several labels of one document are one, the worst.
    """
    read = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    worst = (
        labels.select("doc_id", "quality", "toxic")
        .groupBy(F.col("doc_id").cast("long").alias("shown"))
        .agg(F.max(F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0)).alias("worst"))
    )
    labelled = read.select("host", document_of(F.col("path")).alias("shown")).join(worst, "shown")
    bad = labelled.groupBy("host").agg(F.count("*").alias("n"), F.sum("worst").alias("bad"))
    hosts = read.groupBy("host").agg(F.count("*").alias("pages")).join(bad, "host", "left")
    outcomes = hosts.select(
        "host", *(F.coalesce(c, F.lit(0)).cast("double").alias(c) for c in ("n", "bad"))
    )
    known = reputations(outcomes)
    own = F.when(F.col("bound") > limit, "block").otherwise("allow")
    rule = rule_of(F.col("host"), F.col("path"))
    return read.join(known, "host", "left").select(
        "page_id",
        "host",
        "path",
        rule["rule"].alias("rule"),
        F.coalesce(rule["verdict"], own).alias("verdict"),
        "share",
    )


def _level_sql(name: str) -> str:
    """Strength and means of one level, with the same grid of correlations as ``strength``."""
    sums = []
    for j, r in enumerate(GRID):
        v = f"(1 + (n - 1) * {r!r})"
        ratio = "pow(bad - n * prior, 2.0) / (n * prior * (1 - prior))"
        sums.append(f"round(coalesce(sum({r!r} * (n - 1) * ({ratio} - {v}) / ({v} * {v})) filter (n > 1), 0.0), 6) as at{j}")
    last = len(GRID) - 1
    # from the last change of sign back to the first
    changes = [
        f"when at{j} > 0 and at{j + 1} <= 0 then {GRID[j]!r} * pow({GRID[j + 1] / GRID[j]!r}, at{j} / (at{j} - at{j + 1}))"
        for j in reversed(range(last))
    ]
    found = f"case when at{last} > 0 then {GRID[last]!r} {' '.join(changes)} else {GRID[0]!r} end"
    return f"""
  {name}_at as (select {", ".join(sums)} from {name}),
  {name}_k as (select 1 / round({found}, 9) - 1 as k from {name}_at),
  {name}_mean as (select t.*, (k * prior + bad) / (k + n) as mean, k from {name} t, {name}_k)"""


ORACLE_SQL = f"""
with read as (
    select page_id,
      translate(coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
      coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') as path
    from pages),
  worst as (
    select doc_id, max(case when quality = 0 or toxic = 1 then 1 else 0 end) as worst
    from labels group by doc_id),
  labelled as (
    select host, count(*) as n, sum(worst) as bad
    from read join worst
      on try_cast(regexp_extract(path, '/([0-9]{{1,18}})(\\.html)?/?$', 1) as bigint) = doc_id
    group by host),
  hosts as (
    select host, regexp_replace(host, ':[0-9]*$', '') as plain,
      regexp_extract(regexp_replace(host, ':[0-9]*$', ''), '([^.]*\\.[^.]*)$', 1) as two,
      cast(coalesce(n, 0) as double) as n, cast(coalesce(bad, 0) as double) as bad
    from (select distinct host from read) left join labelled using (host)),
  named as (
    select *, case when two in ({", ".join(f"'{s}'" for s in SECOND_LEVEL)}) then two
      else regexp_extract(plain, '([^.]*)$', 1) end as suffix
    from hosts),
  placed as (
    select *, coalesce(nullif(case when contains(suffix, '.')
      then regexp_extract(plain, '([^.]*\\.[^.]*\\.[^.]*)$', 1) else two end, ''), plain) as domain
    from named),
  s as (
    select suffix, sum(n) as n, sum(bad) as bad,
      any_value((select (sum(bad) + 1) / (sum(n) + 2) from placed)) as prior
    from placed group by suffix),
  {_level_sql("s")},
  d as (
    select domain, sum(p.n) as n, sum(p.bad) as bad, any_value(m.mean) as prior
    from placed p join s_mean m using (suffix) group by domain, suffix),
  {_level_sql("d")},
  h as (select host, p.n, p.bad, m.mean as prior from placed p join d_mean m using (domain)),
  {_level_sql("h")},
  known as (
    select host, mean - {SURENESS} * sqrt(mean * (1 - mean) * (1 / (k + n + 1)
      + 1 / (select sum(n) + 3 from placed))) as bound from h_mean),
  ruled as (
    select page_id, host, path, bound, case
      when (host = 'example.net' or host like '%.example.net') and starts_with(path, '/en/')
        then 'example.net/en/'
      when (host = 'example.com' or host like '%.example.com') and starts_with(path, '/de/')
        then 'example.com/de/'
      when (host = 'org' or host like '%.org') and starts_with(path, '/fr/') then 'org/fr/'
      when (host = 'net' or host like '%.net') and starts_with(path, '/') then 'net/' end as rule
    from read left join known using (host))
select page_id, host, path, rule, case
    when rule in ('net/', 'example.com/de/') then 'block'
    when rule is not null then 'allow'
    when bound > {LIMIT} then 'block' else 'allow' end as verdict
from ruled
"""
