"""URL filter: explicit rules, and an Empirical-Bayes reputation of hosts for the pages no rule covers.

Everything is DataFrame functions. Page outcomes are counted per host; a host's bad rate is shrunk to its registered
domain's, that to its suffix's, and that to the overall rate, each by a beta-binomial prior whose strength is
estimated by moments over the level below. A page is blocked when the lower bound of its host's posterior is high.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchmill.session import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Public suffixes of two labels; all others are taken to have one. A parameter, as such lists change.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "co.jp", "com.br", "co.nz", "co.in", "com.cn")


@dataclass(frozen=True)
class Rule:
    """``allow`` or ``block`` for a host with its subdomains and the paths that start with the rule's."""

    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.split("/", 1)[0]

    @property
    def path(self) -> str:
        return "/" + self.text.split("/", 1)[1] if "/" in self.text else ""


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or url."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://`` or url."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; of equally long ones, that with the longer host, then the first.

    Rules are a short list written into the plan.
    """
    ordered = sorted(rules, key=lambda r: (-len(r.text), -len(r.host)))
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in reversed(ordered):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        text, verdict = F.when(fits, rule.text).otherwise(text), F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


def domain_levels(host: Column, suffixes: Sequence[str] = TWO_LABEL_SUFFIXES) -> tuple[Column, Column]:
    """Registered domain and suffix of a host without its user and port; an address of four numbers is its own."""
    bare = F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", "")
    one, two, three = (F.substring_index(bare, ".", -n) for n in (1, 2, 3))
    number = bare.rlike(r"^[0-9]+(\.[0-9]+){3}$")
    wide = two.isin(*suffixes)
    return (
        F.when(number, bare).when(wide, three).otherwise(two),
        F.when(number, bare).when(wide, two).otherwise(one),
    )


def _spread(level: DataFrame, name: str) -> DataFrame:
    """One row with what the moments of a level need, as whole numbers: the order of rows can't change a digit."""
    seen = level.filter("n > 0")
    return seen.agg(
        F.lit(name).alias("level"), F.count("*").alias("groups"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"),
        F.coalesce(F.sum(F.col("n").cast("decimal(19,0)") * F.col("n").cast("decimal(19,0)")), F.lit(0)).cast("double").alias("squares"),
        F.coalesce(F.sum(F.floor(F.col("bad") * F.col("bad") / F.col("n") * 1e6)), F.lit(0)).cast("double").alias("between"),
    )


def prior_strength(groups: float, n: float, bad: float, squares: float, between: float) -> float:
    """Pseudo-pages of a level's prior: 1/rho - 1, rho being the moment estimate of the correlation within a group.

    rho is kept from 0.001 to 0.5, so that a prior weighs 1 to 999 pages; without two groups or with one outcome only it is 0.1.
    """
    if groups < 2 or bad <= 0 or bad >= n:
        return 9.0
    p = bad / n
    scatter = (between / 1e6 - p * bad) / (p * (1.0 - p))
    room = n - squares / n - (groups - 1.0)
    rho = (scatter - (groups - 1.0)) / room if room > 0 else 0.1
    return 1.0 / min(max(rho, 0.001), 0.5) - 1.0


def host_reputation(outcomes: DataFrame, z: float = 1.645) -> DataFrame:
    """(host, n, bad, posterior, bound) of every host in ``outcomes`` (host, bad: 1, 0 or null if not labelled).

    ``bound`` is the posterior mean less ``z`` posterior deviations. Counts are combined before the shuffle, so a host with
    most of the rows sends one row per task; three rows of moments go to the driver.
    """
    domain, suffix = domain_levels(F.col("host"))
    hosts = stage(
        outcomes.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).cast("long").alias("bad"))
        .select("host", domain.alias("domain"), suffix.alias("suffix"), "n", "bad"), "hosts",
    )
    sums = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    domains = hosts.groupBy("domain", "suffix").agg(*sums)
    ends = hosts.groupBy("suffix").agg(*sums)
    parts = reduce(DataFrame.unionAll, [_spread(hosts, "host"), _spread(domains, "domain"), _spread(ends, "suffix")])
    spread = {r["level"]: r for r in parts.collect()}
    k = {name: prior_strength(*(float(r[c]) for c in ("groups", "n", "bad", "squares", "between"))) for name, r in spread.items()}
    overall = (float(spread["host"]["bad"]) + 0.5) / (float(spread["host"]["n"]) + 1.0)

    def shrunk(mean: Column, level: str) -> Column:
        return (mean * k[level] + F.col("bad")) / (F.col("n") + k[level])

    ends = ends.select("suffix", shrunk(F.lit(overall), "suffix").alias("suffix_mean"))
    domains = domains.join(ends, "suffix").select("domain", "suffix", shrunk(F.col("suffix_mean"), "domain").alias("domain_mean"))
    posterior = shrunk(F.col("domain_mean"), "host")
    deviation = F.sqrt(F.col("posterior") * (1.0 - F.col("posterior")) / (F.col("n") + k["host"] + 1.0))
    return (
        hosts.join(domains, ["domain", "suffix"]).withColumn("posterior", posterior)
        .withColumn("bound", F.col("posterior") - z * deviation).select("host", "n", "bad", "posterior", "bound")
    )


def judge_urls(
    pages: DataFrame, rules: Sequence[Rule], outcomes: DataFrame | None = None, url: str = "url", threshold: float = 0.5, z: float = 1.645
) -> DataFrame:
    """``pages`` with host, path, rule, verdict, posterior and bound; columns of these names in the input are replaced.

    The longest rule that fits decides. Otherwise the host's reputation does: ``block`` if the posterior bound is over
    ``threshold``. ``outcomes`` holds labelled pages (host, bad); without it the pages that a rule judges are the labels.
    A null url, or one without ``://``, has empty host and path and is judged by the overall rate. Repeated rows are judged
    alike and all kept; an empty table gives an empty one.
    """
    host, path = host_of(F.col(url)), path_of(F.col(url))
    made = pages.withColumn("host", host).withColumn("path", path)
    text, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    made = made.withColumn("rule", text).withColumn("_verdict", verdict)
    if outcomes is None:
        outcomes = made.select("host", F.when(F.col("_verdict") == "block", 1).when(F.col("_verdict") == "allow", 0).alias("bad"))
    else:
        outcomes = outcomes.select("host", "bad").unionAll(made.select("host", F.lit(None).cast("int").alias("bad")))
    known = stage(host_reputation(outcomes, z).select("host", "posterior", "bound"), "reputation")
    by_host = F.when(F.col("bound") > threshold, "block").otherwise("allow")
    kept = [c for c in made.columns if c not in ("posterior", "bound", "verdict", "_verdict")]
    return made.select(*kept, "_verdict").join(known, "host").select(
        *kept, F.coalesce("_verdict", by_host).alias("verdict"), "posterior", "bound"
    )
