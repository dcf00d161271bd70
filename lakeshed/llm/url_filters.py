"""URL filters: rules by host and path, and for the rest an empirical-Bayes reputation of hosts.

Labelled pages are counted by host, registered domain and public suffix.  Each
level is a beta-binomial: a host's rate of bad pages is drawn around its
domain's, a domain's around its suffix's, a suffix's around the rate of all.
How closely children follow their parent is estimated by the method of moments
from all parents of a level together: with S the sum of n (k/n - m)**2 over a
parent's children and m the parent's own rate,

  rho = sum(S / (m (1 - m)) - (children - 1)) / sum(N - sum(n**2) / N - (children - 1))

clipped to ``RHO``; the prior of a child has the strength (1 - rho) / rho.  A
host's posterior is Beta(a, b), its bound a / (a + b) less ``Z`` standard
deviations: a page is blocked if even that lower bound of its host's rate of bad
pages is above ``MOST_BAD``.  Hosts without a labelled page have their domain's
mean and the prior's width, and so on upwards; with no labels at all the rate is
a half and nothing is blocked.

Sums of fractions are taken over decimals, so that they don't depend on the
order of rows.  Hosts are counted before anything is joined; the one join that
has a row for each page is on host against one row a host, which Spark splits
where a host is hot.  All of it is SQL expressions.

Defined results: a null URL, or one without ``://``, has an empty host and path
and fits no rule; such pages count as one host.  Ports and user names belong to
the host of the result, not to that of the reputation.  A page with several
outcomes is bad if one of them is; null outcomes count as none.  Repeated pages
count each time; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshed.llm.common import stored, table

#: (action, host, path): hosts are taken with all their subdomains, paths as prefixes.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: Public suffixes of two labels; all others have one.
SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "or.jp", "ne.jp", "ac.jp", "com.br", "com.cn", "com.tr", "com.mx", "co.in", "co.za", "co.kr")
Z = 1.645
MOST_BAD = 0.5
#: Least and largest correlation of a parent's children; their priors weigh 9,999 pages and 1/9 page.
RHO = (0.0001, 0.9)


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?``, ``#`` or end, A-Z in lower case."""
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def registered(host: Column, suffixes: Sequence[str] = SUFFIXES) -> tuple[Column, Column]:
    """(registered domain, public suffix) of a host; an address of numbers or a single label is its own domain, without a suffix."""
    name = F.regexp_replace(host, r"^[^@]*@|:[0-9]*$|\.+$", "")
    two = F.substring_index(name, ".", -2)
    is_two = two.isin(*suffixes)
    alone = name.rlike(r"^[0-9.]*$|^\[|^[^.]*$")
    domain = F.when(alone, name).when(is_two, F.substring_index(name, ".", -3)).otherwise(two)
    return domain, F.when(alone, F.lit("")).when(is_two, two).otherwise(F.substring_index(name, ".", -1))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """(rule as host and path, its action) of the longest rule that fits; of equal ones the first in code point order."""
    rule, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for act, its_host, its_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), [-ord(c) for c in r[1] + r[2]])):
        fits = ((host == its_host) | F.endswith(host, F.lit(f".{its_host}"))) & F.startswith(path, F.lit(its_path))
        rule, action = F.when(fits, F.lit(its_host + its_path)).otherwise(rule), F.when(fits, F.lit(act)).otherwise(action)
    return rule, action


def _square(top: Column, below: Column) -> Column:
    """top**2 / below to six digits, as a decimal."""
    return F.round(top.cast("double") * top / F.greatest(below, F.lit(1)), 6).cast("decimal(28,6)")


def _level(children: DataFrame, parent: list[str]) -> DataFrame:
    """Counts of the parents, and what each tells of its children's correlation: over, under."""
    out = children.groupBy(*parent).agg(
        F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.sum((F.col("n") > 0).cast("long")).alias("_children"),
        F.sum(_square(F.col("bad"), F.col("n"))).cast("double").alias("_squares"), F.sum(_square(F.col("n"), F.lit(1))).cast("double").alias("_sizes"),
    )
    n, bad, spare = F.col("n").cast("double"), F.col("bad").cast("double"), F.col("_children") - 1
    told = (F.col("_children") > 1) & (bad > 0) & (bad < n)
    share = bad / F.nullif(n, F.lit(0.0))
    over = F.when(told, (F.col("_squares") - bad * share) / (share * (1 - share)) - spare)
    under = F.when(told, n - F.col("_sizes") / n - spare)
    return out.withColumns({"over": F.round(over, 6).cast("decimal(28,6)"), "under": F.round(under, 6).cast("decimal(28,6)")}).drop("_children", "_squares", "_sizes")


def _strength(parents: DataFrame, name: str) -> DataFrame:
    """One row: the strength of the priors that these parents give their children."""
    over, under = F.sum("over").cast("double"), F.sum("under").cast("double")
    rho = F.coalesce(F.when(under > 0, over / under), F.lit(RHO[0]))
    return parents.agg(F.greatest(F.lit(RHO[0]), F.least(F.lit(RHO[1]), rho)).alias("_rho")).select(((1 - F.col("_rho")) / F.col("_rho")).alias(name))


def reputations(hosts: DataFrame, suffixes: Sequence[str] = SUFFIXES, z: float = Z) -> DataFrame:
    """host, n, bad, mean, bound: ``hosts`` has one row a host with its labelled pages n and the bad ones among them."""
    domain, suffix = registered(F.col("host"), suffixes)
    hosts = hosts.select("host", "n", "bad", domain.alias("domain"), suffix.alias("suffix"))
    domains = _level(hosts, ["suffix", "domain"])
    tops = _level(domains.select("suffix", "domain", "n", "bad"), ["suffix"])
    everything = _level(tops.select("suffix", "n", "bad"), [])
    facts = everything.select(((F.coalesce("bad", F.lit(0)) + 1.0) / (F.coalesce("n", F.lit(0)) + 2.0)).alias("_rate"))
    facts = facts.crossJoin(_strength(everything, "_of_suffix")).crossJoin(_strength(tops, "_of_domain")).crossJoin(_strength(domains, "_of_host"))  # single rows
    shrunk = lambda rate, strength: (F.col(rate) * F.col(strength) + F.col("bad")) / (F.col(strength) + F.col("n"))
    tops = tops.crossJoin(F.broadcast(facts)).select("suffix", "_of_domain", "_of_host", shrunk("_rate", "_of_suffix").alias("_top"))
    domains = domains.join(tops, "suffix").select("suffix", "domain", "_of_host", shrunk("_top", "_of_domain").alias("_mean"))
    a, b = F.col("_mean") * F.col("_of_host") + F.col("bad"), (1 - F.col("_mean")) * F.col("_of_host") + F.col("n") - F.col("bad")
    out = hosts.join(domains, ["suffix", "domain"]).withColumns({"_a": a, "_b": b}).withColumn("_all", F.col("_a") + F.col("_b"))
    out = out.withColumn("mean", F.col("_a") / F.col("_all"))
    return out.select("host", "n", "bad", "mean", (F.col("mean") - z * F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("_all") + 1))).alias("bound"))


def judged(pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, most_bad: float = MOST_BAD) -> DataFrame:
    """page_id, host, path, rule, verdict, n_labelled, n_bad, bound.

    ``pages`` has page_id and url; ``outcomes`` has page and bad (boolean), where
    ``page`` is what ``page_key`` gives for a URL.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    one = outcomes.filter("page is not null and bad is not null").groupBy("page").agg(F.max("bad").cast("long").alias("bad"))
    keyed = pages.select(host.alias("host"), page_key(F.col("url")).alias("page")).filter("page is not null")
    labelled = keyed.join(one, "page").select("host", F.lit(1).cast("long").alias("n"), "bad")
    every = pages.select(host.alias("host"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("bad"))
    hosts = stored(every.union(labelled).groupBy("host").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")), "url-hosts")  # each level reads them
    known = reputations(hosts)
    rule, action = rule_of(F.col("host"), F.col("path"), rules)
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"))
    verdict = F.coalesce(action, F.when(F.col("bound") > most_bad, F.lit("block")).otherwise(F.lit("allow")))
    return parsed.join(known, "host").select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"), F.col("n").alias("n_labelled"), F.col("bad").alias("n_bad"), F.round("bound", 4).alias("bound"))


def page_key(url: Column) -> Column:
    """The number that ends a URL's path, which names the document that it shows."""
    return F.try_to_number(F.nullif(F.regexp_extract(path_of(url), r"/([0-9]{1,18})(?:/|\.[a-z]+)?$", 1), F.lit("")), F.lit("9" * 18)).cast("long")


def op12_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page is bad if the document that it shows is labelled as of low quality or toxic."""
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    return judged(table(spark, sf_dir, "pages").select("page_id", "url"), labels)


_LEVEL = """
  SELECT {key}, sum(n)::BIGINT AS n, sum(bad)::BIGINT AS bad, sum((n > 0)::INT) AS children,
    sum(round(bad::DOUBLE * bad / greatest(n, 1), 6)::DECIMAL(28,6))::DOUBLE AS squares, sum(round(n::DOUBLE * n, 6)::DECIMAL(28,6))::DOUBLE AS sizes
  FROM {child} GROUP BY {group}"""
_TOLD = """
  SELECT *, CASE WHEN children > 1 AND bad > 0 AND bad < n THEN round((squares - bad::DOUBLE * (bad::DOUBLE / n)) / ((bad::DOUBLE / n) * (1 - bad::DOUBLE / n)) - (children - 1), 6)::DECIMAL(28,6) END AS over_,
    CASE WHEN children > 1 AND bad > 0 AND bad < n THEN round(n::DOUBLE - sizes / n - (children - 1), 6)::DECIMAL(28,6) END AS under_
  FROM {level}"""
_STRENGTH = "(SELECT (1 - rho) / rho FROM (SELECT greatest(0.0001::DOUBLE, least(0.9::DOUBLE, coalesce(CASE WHEN sum(under_)::DOUBLE > 0 THEN sum(over_)::DOUBLE / sum(under_)::DOUBLE END, 0.0001::DOUBLE))) AS rho FROM {told}))"

ORACLE = (
    r"""
WITH cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parsed AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
keyed AS (SELECT host, try_cast(nullif(regexp_extract(path, '/([0-9]{1,18})(?:/|\.[a-z]+)?$', 1), '') AS BIGINT) AS page FROM parsed),
outcomes AS (SELECT doc_id AS page, max((quality = 0 OR toxic = 1)::INT) AS bad FROM labels WHERE doc_id IS NOT NULL AND (quality = 0 OR toxic = 1) IS NOT NULL GROUP BY 1),
counted AS (SELECT host, count(o.page) AS n, coalesce(sum(o.bad), 0)::BIGINT AS bad FROM keyed k LEFT JOIN outcomes o ON k.page = o.page GROUP BY host),
named AS (SELECT *, regexp_replace(host, '^[^@]*@|:[0-9]*$|\.+$', '', 'g') AS name FROM counted),
hosts AS (
  SELECT host, n, bad, CASE WHEN regexp_matches(name, '^[0-9.]*$|^\[|^[^.]*$') THEN name ELSE regexp_extract(name, '([^.]*\.[^.]*)$', 1) END AS domain,
    CASE WHEN regexp_matches(name, '^[0-9.]*$|^\[|^[^.]*$') THEN '' ELSE regexp_extract(name, '([^.]*)$', 1) END AS suffix FROM named),
"""
    + f"domain_level AS ({_LEVEL.format(key='suffix, domain', child='hosts', group='suffix, domain')}), domain_told AS ({_TOLD.format(level='domain_level')}),\n"
    + f"suffix_level AS ({_LEVEL.format(key='suffix', child='domain_level', group='suffix')}), suffix_told AS ({_TOLD.format(level='suffix_level')}),\n"
    + f"all_level AS ({_LEVEL.format(key='0 AS one', child='suffix_level', group='one')}), all_told AS ({_TOLD.format(level='all_level')}),\n"
    + f"facts AS (SELECT (coalesce(bad, 0) + 1.0::DOUBLE) / (coalesce(n, 0) + 2.0::DOUBLE) AS rate, {_STRENGTH.format(told='all_told')} AS of_suffix, {_STRENGTH.format(told='suffix_told')} AS of_domain, {_STRENGTH.format(told='domain_told')} AS of_host FROM all_level),"
    + r"""
tops AS (SELECT suffix, (rate * of_suffix + bad) / (of_suffix + n) AS top FROM suffix_level, facts),
means AS (SELECT d.suffix, d.domain, (t.top * of_domain + d.bad) / (of_domain + d.n) AS m FROM domain_level d JOIN tops t USING (suffix), facts),
posterior AS (SELECT host, n, bad, m * of_host + bad AS a, (1 - m) * of_host + n - bad AS b FROM hosts JOIN means USING (suffix, domain), facts),
bounds AS (SELECT host, n, bad, a / (a + b) - 1.645::DOUBLE * sqrt(a / (a + b) * (1 - a / (a + b)) / (a + b + 1)) AS bound FROM posterior),
ruled AS (
  SELECT page_id, host, path, CASE
    WHEN (host = 'example.net' OR suffix(host, '.example.net')) AND prefix(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR suffix(host, '.example.com')) AND prefix(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR suffix(host, '.org')) AND prefix(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR suffix(host, '.net')) AND prefix(path, '/') THEN 'net/' END AS rule FROM parsed)
SELECT r.page_id, r.host, r.path, r.rule,
  CASE WHEN r.rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN r.rule IS NOT NULL OR b.bound > 0.5 THEN 'block' ELSE 'allow' END AS verdict,
  b.n AS n_labelled, b.bad AS n_bad, round(b.bound, 4) AS bound
FROM ruled r JOIN bounds b ON r.host = b.host
"""
)
