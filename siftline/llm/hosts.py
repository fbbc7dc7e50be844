"""URL filters by rules and by the reputation of hosts, shrunk through a chain of beta-binomial priors.

Everything is DataFrame expressions. Outcomes of labelled pages are counted per host
before anything is joined, and domains and suffixes are sums of hosts. Each level
draws its prior from the level above: the prior mean is the parent's posterior mean,
and the prior strength is the moment estimate over all members of the level.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftline.llm.common import written

# (verdict, host, path)
Rule = tuple[str, str, str]

URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
# Second-level names under which a country registers domains: fixed values.
SECOND_LEVEL = ("co", "com", "org", "net", "ac", "gov", "edu")
# Four numbers, or a bracket that begins an address of the longer kind.
ADDRESS = r"^([0-9]{1,3}(\.[0-9]{1,3}){3}|\[.*)$"

# Posterior bound: a host goes if its share of bad pages is above MAX_BAD even at Z deviations below its mean.
MAX_BAD = 0.25
Z = 1.645
MIN_STRENGTH, MAX_STRENGTH = 1.0, 1000.0


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (ASCII letters lowered) and path; both empty without ``://`` and for null."""
    host = F.translate(F.regexp_extract(url, URL, 1), string.ascii_uppercase, string.ascii_lowercase)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def bare_name(host: Column) -> Column:
    """The name in a host: without user, port and closing dots."""
    name = F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", "")
    return F.regexp_replace(name, r"\.+$", "")


def _address(name: Column) -> Column:
    return name.rlike(ADDRESS)


def registered_domain(host: Column, second_level: tuple[str, ...] = SECOND_LEVEL) -> Column:
    """The last two names of a host, three below a country's second-level name; an address and a single name stand for themselves."""
    name = bare_name(host)
    last_two = F.substring_index(name, ".", -2)
    country = (F.length(F.substring_index(name, ".", -1)) == 2) & F.substring_index(last_two, ".", 1).isin(*second_level)
    return F.when(_address(name), name).when(country, F.substring_index(name, ".", -3)).otherwise(last_two)


def suffix(host: Column) -> Column:
    """The last name of a host; an address is its own."""
    name = bare_name(host)
    return F.when(_address(name), name).otherwise(F.substring_index(name, ".", -1))


def rule_of(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, or nulls. The rules are a short list of the caller."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, at, under in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(under)
        name, verdict = F.when(fits, at + under).otherwise(name), F.when(fits, says).otherwise(verdict)
    return name, verdict


def outcomes(labels: DataFrame) -> DataFrame:
    """(page_id, bad): 1 for a page labelled toxic or of low quality. Pages without any label are left out."""
    bad = F.greatest(F.col("toxic"), 1 - F.col("quality"))  # skips nulls
    rows = labels.select(F.col("doc_id").alias("page_id"), bad.alias("bad")).where("page_id is not null and bad is not null")
    return rows.groupBy("page_id").agg(F.max("bad").alias("bad"))


def _strength(level: DataFrame) -> float:
    """How many pages a prior counts for: from the spread of a level's members around their parents' means."""
    expected = F.col("prior") * (1 - F.col("prior"))
    excess = F.sum(F.pow(F.col("k") - F.col("n") * F.col("prior"), 2) - F.col("n") * expected)
    row = level.select(excess.alias("excess"), F.sum(F.col("n") * (F.col("n") - 1) * expected).alias("pairs")).first()
    if not row.pairs or row.excess <= 0:
        return MAX_STRENGTH
    return min(max(row.pairs / row.excess - 1, MIN_STRENGTH), MAX_STRENGTH)


def _posterior(level: DataFrame, strength: float) -> Column:
    return (strength * F.col("prior") + F.col("k")) / (strength + F.col("n"))


def reputation(pages: DataFrame, bad_pages: DataFrame, second_level: tuple[str, ...] = SECOND_LEVEL) -> DataFrame:
    """(host, n, k, mean, bound) for every host of ``pages``: labelled and bad pages, posterior mean and lower bound.

    The bound takes the posterior for normal; near 0 and 1 and for few pages a quantile of the beta distribution is a
    little higher. ``second_level`` are the names under which countries register domains. Hosts without labels get what their domain says; without any label at all every mean is 0.
    """
    host, _ = host_and_path(F.col("url"))
    seen = pages.select("page_id", host.alias("host")).join(bad_pages, "page_id", "left")
    hosts = seen.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("k"))
    domain = registered_domain(F.col("host"), second_level)
    hosts = written(hosts.select("host", domain.alias("domain"), suffix(F.col("host")).alias("suffix"), "n", "k"), "hosts")

    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    total = hosts.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).first()
    overall = (total.k + 1) / (total.n + 2) if total.n else 0.0

    level = suffixes.withColumn("prior", F.lit(overall))
    level = level.select("suffix", _posterior(level, _strength(level)).alias("prior"))
    level = domains.join(level, "suffix")
    level = level.select("domain", _posterior(level, _strength(level)).alias("prior"))
    level = hosts.join(level, "domain")
    strength = _strength(level)
    mean = _posterior(level, strength)
    bound = mean - Z * F.sqrt(mean * (1 - mean) / (strength + F.col("n") + 1))
    return level.select("host", "n", "k", mean.alias("mean"), bound.alias("bound"))


def judge(pages: DataFrame, bad_pages: DataFrame, rules: list[Rule], max_bad: float = MAX_BAD) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every page: the rule's verdict, else that of the host's bound.

    A url that is null or has no ``://`` has the empty host, which has a reputation like any
    other. Null and repeated page ids are passed through; repeated pages count as often as
    they occur. Other columns are not looked at.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    scores = reputation(pages, bad_pages).select("host", (F.col("bound") > max_bad).alias("_bad"))
    rule, says = rule_of(F.col("host"), F.col("path"), rules)
    verdict = F.coalesce(says, F.when(F.col("_bad"), "block").otherwise("allow"))
    return rows.join(scores, "host").select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"))


def _sql_rules(rules: list[Rule]) -> str:
    fits = [
        f"when (host = '{at}' or ends_with(host, '.{at}')) and starts_with(path, '{under}') then '{at + under}'"
        for _, at, under in sorted(rules, key=lambda r: -len(r[1] + r[2]))
    ]
    return f"case {' '.join(fits)} end"


def oracle(rules: list[Rule], max_bad: float = MAX_BAD) -> str:
    """The same in SQL."""
    says = " ".join(f"when '{at + under}' then '{verdict}'" for verdict, at, under in rules)
    second = ", ".join(f"'{s}'" for s in SECOND_LEVEL)

    def strength(level: str) -> str:
        return f"""(select case when coalesce(sum(n * (n - 1) * prior * (1 - prior)), 0) = 0
            or sum(power(k - n * prior, 2) - n * prior * (1 - prior)) <= 0 then {MAX_STRENGTH}
            else least(greatest(sum(n * (n - 1) * prior * (1 - prior))
            / sum(power(k - n * prior, 2) - n * prior * (1 - prior)) - 1, {MIN_STRENGTH}), {MAX_STRENGTH}) end from {level})"""

    return f"""
with split as (
    select page_id,
        coalesce(translate(regexp_extract(url, '{URL}', 1), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '') as host,
        coalesce(regexp_extract(url, '{URL}', 2), '') as path
    from pages),
bad_pages as (
    select doc_id, max(greatest(toxic, 1 - quality)) as bad from labels
    where doc_id is not null and greatest(toxic, 1 - quality) is not null group by doc_id),
hosts as (
    select host, count(bad) as n, coalesce(sum(bad), 0) as k,
        regexp_replace(regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', ''), '[.]+$', '') as name
    from split left join bad_pages on page_id = doc_id group by host),
cut as (select *, regexp_matches(name, '{ADDRESS}') as address, string_split(name, '.') as names from hosts),
named as (
    select host, n, k, case when address then name else names[-1] end as suffix,
        case when address then name else array_to_string(case when length(names[-1]) = 2 and names[-2] in ({second})
        then names[-3:] else names[-2:] end, '.') end as domain
    from cut),
total as (select case when sum(n) = 0 then 0.0 else (sum(k) + 1) / (sum(n) + 2) end as overall from named),
suffixes as (
    select suffix, sum(n) as n, sum(k) as k, (select overall from total) as prior from named group by suffix),
suffix_means as (
    select suffix, (s * prior + k) / (s + n) as mean from suffixes, (select {strength("suffixes")} as s)),
domains as (
    select domain, suffix, sum(n) as n, sum(k) as k, any_value(mean) as prior
    from named join suffix_means using (suffix) group by domain, suffix),
domain_means as (
    select domain, (s * prior + k) / (s + n) as mean from domains, (select {strength("domains")} as s)),
leaves as (select host, n, k, mean as prior from named join domain_means using (domain)),
means as (
    select host, n, s, (s * prior + k) / (s + n) as mean from leaves, (select {strength("leaves")} as s)),
bounds as (select host, mean - {Z} * sqrt(mean * (1 - mean) / (s + n + 1)) as bound from means),
ruled as (select *, {_sql_rules(rules)} as rule from split join bounds using (host))
select page_id, host, path, rule,
    case rule {says} else case when bound > {max_bad} then 'block' else 'allow' end end as verdict
from ruled
"""
