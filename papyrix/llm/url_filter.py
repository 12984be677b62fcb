"""URL filtering by rules and by the empirical-Bayes reputation of hosts, in DataFrame functions only.

A page's outcome is good (0) or bad (1). Outcomes are counted by host, by registered domain and by suffix. For these
levels a host goes without user and port. The suffix is the last label, or one of SUFFIXES if the host ends in it; the
registered domain has one label more. Bad rates are shrunk down the hierarchy by beta-binomial priors: the suffix's posterior mean, from
a prior at the corpus rate, is the mean of the prior of its domains, and theirs of their hosts'. Each level's prior
strength is estimated by moments from how much the rates at that level spread around their parents' (empirical Bayes),
within STRENGTH. A host is blocked if the lower bound (mean - Z standard deviations) of its posterior bad rate is above
the limit; one without labels of its own gets the posterior that its domain or suffix implies.

A rule (host, path, verdict) fits its host and all subdomains of it if the page's path begins with its path; the
longest rule wins and goes before the reputation.

Host: after the first :// up to /, ?, # or the end, A-Z lower-cased; path: from there up to ?, # or the end. A null url
or one without :// has empty host and path; such pages share the reputation of the empty host. A page that several
labels name counts once for each; a null label doesn't count. Without labels nothing is blocked but by rule. An empty
table gives an empty result.

Pages are read once, into narrow rows that are written. Outcomes are counted by host before the levels meet, and pages
meet one row per host: hosts with more than a 4,096th of all pages by broadcast, the others by a shuffle, so no task gets
all pages of a large host. Rows that repeat are judged each. Columns may have any names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papyrix.llm.common import UPPER, cut, join_counted

RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
# Suffixes of two labels under which different owners register.
SUFFIXES = (
    "ac.uk", "co.uk", "gov.uk", "org.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "ac.jp", "ne.jp", "or.jp", "co.kr", "com.cn", "com.hk", "com.tw",
    "com.sg", "co.in", "co.id", "co.za", "com.br", "org.br", "com.ar", "com.mx", "com.co", "com.pe", "com.tr", "com.ua", "blogspot.com", "wordpress.com",
    "github.io", "gitlab.io",
)
STRENGTH = (2.0, 200.0)
Z = 1.64
LIMIT = 0.5


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def site_of(host: Column) -> Column:
    """The host without user and port."""
    return F.regexp_replace(host, r"^[^@]*@|:\d*$", "")


def suffix_of(site: Column) -> Column:
    two = F.substring_index(site, ".", -2)
    return F.when(two.isin(*SUFFIXES), two).otherwise(F.substring_index(site, ".", -1))


def domain_of(site: Column) -> Column:
    two = F.substring_index(site, ".", -2)
    return F.when(two.isin(*SUFFIXES), F.substring_index(site, ".", -3)).otherwise(two)


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, or null. The rules are literals of the plan."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule_host, rule_path, verdict in sorted(rules, key=lambda r: len(r[0]) + len(r[1])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        out = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _level(counts: DataFrame, keys: list[str]) -> DataFrame:
    return counts.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))


def _shrunk(level: DataFrame, parents: DataFrame, on: list[str], name: str) -> DataFrame:
    """Posterior of each row of ``level`` from its parent's mean. One value, the prior's strength, is estimated over all."""
    rows = level.join(parents.select(*on, F.col("mean").alias("prior")), on)
    rate, prior, n = F.col("bad") / F.col("n"), F.col("prior"), F.col("n")
    # var(rate) = prior (1 - prior) (1/n + (1 - 1/n) / (strength + 1)) for a beta-binomial
    p = F.sum(F.when(n > 1, prior * (1 - prior) * (n - 1)))
    excess = F.sum(F.when(n > 1, n * (rate - prior) * (rate - prior) - prior * (1 - prior)))
    rho = F.least(F.greatest(excess / F.nullif(p, F.lit(0.0)), F.lit(1 / (STRENGTH[1] + 1))), F.lit(1 / (STRENGTH[0] + 1)))
    strength = rows.agg((1 / F.coalesce(rho, F.lit(1 / (STRENGTH[1] + 1))) - 1).alias("weight"), F.lit(1).alias("one"))
    return rows.withColumn("one", F.lit(1)).join(F.broadcast(strength), "one").withColumn("mean", (F.col("bad") + F.col("weight") * prior) / (n + F.col("weight"))).withColumn("total", n + F.col("weight"))


def host_reputation(labelled: DataFrame, z: float = Z) -> DataFrame:
    """labelled: (host, bad 0/1). One row per labelled site (level host), domain and suffix: level, name, mean, bound."""
    counts = cut(labelled.filter("bad is not null").groupBy(site_of(F.col("host")).alias("host")).agg(F.count("*").alias("n"), F.sum("bad").cast("double").alias("bad")))
    counts = counts.withColumn("domain", domain_of(F.col("host"))).withColumn("suffix", suffix_of(F.col("host")))
    root = counts.agg(F.coalesce(F.sum("bad") / F.nullif(F.sum("n"), F.lit(0)), F.lit(0.0)).alias("mean")).withColumn("root", F.lit(1))
    suffixes = cut(_shrunk(_level(counts, ["suffix"]).withColumn("root", F.lit(1)), root, ["root"], "suffix"))
    domains = cut(_shrunk(_level(counts, ["domain", "suffix"]), suffixes, ["suffix"], "domain"))
    hosts = _shrunk(_level(counts, ["host", "domain"]), domains, ["domain"], "host")
    rows = lambda df, level: df.select(F.lit(level).alias("level"), F.col(level).alias("name"), "mean", (F.col("mean") - z * F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("total") + 1))).alias("bound"))
    return rows(suffixes, "suffix").unionByName(rows(domains, "domain")).unionByName(rows(hosts, "host"))


def judge(pages: DataFrame, outcomes: DataFrame, key: str = "page_id", url: str = "url", rules: Sequence[tuple[str, str, str]] = RULES, limit: float = LIMIT, z: float = Z) -> DataFrame:
    """outcomes: (key, bad 0/1). One row per page: key, host, path, rule, verdict, bad_rate, bad_bound."""
    parsed = cut(pages.select(F.col(key).alias("_key"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path")))
    labelled = parsed.select("_key", "host").join(outcomes.select(F.col(key).alias("_key"), F.col("bad")), "_key")
    known = cut(host_reputation(labelled, z))
    # the levels meet at distinct hosts; pages are joined once, by host
    site = site_of(F.col("host"))
    hosts = parsed.groupBy("host").agg(F.count("*").alias("_pages")).select("*", site.alias("_site"), domain_of(site).alias("_domain"), suffix_of(site).alias("_suffix"))
    for level, name in (("host", "_site"), ("domain", "_domain"), ("suffix", "_suffix")):
        side = known.filter(F.col("level") == level).select(F.col("name").alias(name), F.struct("mean", "bound").alias(f"_by_{level}"))
        hosts = hosts.join(side, name, "left")
    found = cut(hosts.select("host", "_pages", F.coalesce("_by_host", "_by_domain", "_by_suffix").alias("_found")))
    out = join_counted(parsed, found, ["host"], "_pages")
    match = matching_rule(F.col("host"), F.col("path"), rules)
    out = out.withColumn("_match", match)
    verdict = F.coalesce(F.col("_match.verdict"), F.when(F.col("_found.bound") > limit, "block").otherwise("allow"))
    return out.select(F.col("_key").alias(key), "host", "path", F.col("_match.rule").alias("rule"), verdict.alias("verdict"), F.col("_found.mean").alias("bad_rate"), F.col("_found.bound").alias("bad_bound"))
