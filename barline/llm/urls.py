"""URL filters: host reputation by empirical Bayes, below rules of hosts and path prefixes.  DataFrame functions only.

A page's outcome is bad where its document is labelled toxic or of low quality; several labels of one document are as
bad as the worst.  Bad outcomes are shrunk through beta-binomial priors: a suffix towards all pages, a registered domain
towards its suffix, a host towards its domain.  What is shrunk never counts in its own prior: a domain's prior comes from
the other domains of its suffix, a host's from the other hosts of its domain.

A prior has two parts, ordinary members and strange ones.  Ordinary rates lie around the parent's, as closely as
moments over the ordinary members of the level tell, and less closely where the parent's rate is itself uncertain;
strange members may have any rate alike.  A member's counts decide how likely it is strange (``posterior``), so
a wholly bad host stands out among however many ordinary ones, while one or two bad pages make no bad host.

A page is blocked if the lower bound of its host's posterior rate, ``Z`` standard deviations below the mean, has more than
``LIFT`` times the odds of all pages; a host without outcomes has its domain's posterior as its own prior.

The rule that fits a page, the longest one, goes before the posterior.  Null and unparsable urls have an empty host and
path; their host is its own domain and suffix.  The registered domain is the last two labels, the suffix the last one,
or three and two where the last two are in ``suffixes``.  Repeated pages count as often as they come, null labels not at
all; without any label the rate is taken as a half, whose bound reaches nothing, and only rules block.  Only ``page_id`` and
``url`` of pages and ``doc_id``, ``toxic`` and ``quality`` of labels are read, so other columns may have any name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barline.llm.common import store

RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
SUFFIXES = ("co.uk", "org.uk", "com.au", "co.jp", "com.br")  # of two labels
Z = 2.0
LIFT = 3.0
STRANGE = 25.0  # squared distance, in variances, from which a member of a level is not ordinary
LEAST = 5  # outcomes from which a member counts in the share of strange ones
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def labels_of(host: Column, n: int) -> Column:
    """The last n labels of a host."""
    return F.substring_index(host, ".", -n)


def suffix_of(host: Column, suffixes=SUFFIXES) -> Column:
    return F.when(labels_of(host, 2).isin(*suffixes), labels_of(host, 2)).otherwise(labels_of(host, 1))


def domain_of(host: Column, suffixes=SUFFIXES) -> Column:
    return F.when(labels_of(host, 2).isin(*suffixes), labels_of(host, 3)).otherwise(labels_of(host, 2))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none does."""
    def first(of):
        fits = []
        for rule in sorted(rules, key=lambda r: -len(r[0])):
            name, _, rest = rule[0].partition("/")
            inside = (host == name) | F.endswith(host, F.lit("." + name))
            fits.append((inside & F.startswith(path, F.lit("/" + rest)), of(rule)))
        return F.coalesce(*(F.when(c, F.lit(v)) for c, v in fits), F.lit(None).cast("string"))

    return first(lambda r: r[0]), first(lambda r: r[1])


def outcomes(labels: DataFrame) -> DataFrame:
    """(doc_id, bad): 1 or 0 for each labelled document."""
    bad = F.when((F.col("toxic") == 1) | (F.col("quality") == 0), 1).when(F.col("toxic").isNotNull() | F.col("quality").isNotNull(), 0)
    return labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(bad).alias("bad")).where("bad IS NOT NULL")


def log_gamma(x: Column) -> Column:
    """ln of the gamma function for x > 0, by Stirling's series at x + 6; off by less than 1e-9 near 0 and relatively less above."""
    z = x + 6
    below = F.ln(x) + F.ln((x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5))
    return (z - 0.5) * F.ln(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * z * z * z * z * z) - below


def level(members: DataFrame) -> tuple[float, float]:
    """(rho, share): how far ordinary members of a level spread beyond chance, and how many members are strange.

    With counts (n, bad) of a member and (all_n, all_bad) of its parent, whose rate is p, sums of (bad - n p)^2 have about
    the mean sum n p (1 - p) (1 - n / all_n) (1 + (n - 1) rho), so an only child, which is
    ordinary, tells nothing.  A member further off than
    ``STRANGE`` allows without rho is not ordinary.  A level that tells nothing has the least rho: what its members differ
    by is then in the doubt about their parents.  The share starts at one in a hundred.
    """
    p = F.try_divide("all_bad", "all_n")
    rows = members.where("n > 0").select("n", "all_n", ((F.col("bad") - F.col("n") * p) * (F.col("bad") - F.col("n") * p)).alias("off"),
                                                       (F.col("n") * p * (1 - p) * (1 - F.try_divide("n", "all_n"))).alias("free"))
    rows = rows.withColumn("ordinary", (F.col("n") == F.col("all_n")) | (F.col("off") <= STRANGE * F.col("free")))
    row = rows.agg(
        F.sum(F.when(F.col("ordinary"), F.col("off") - F.col("free"))).alias("spread"), F.sum(F.when(F.col("ordinary"), F.col("free") * (F.col("n") - 1))).alias("more"),
        F.sum("n").alias("n"), F.count(F.when(F.col("n") >= LEAST, 1)).alias("members"), F.count(F.when(~F.col("ordinary") & (F.col("n") >= LEAST), 1)).alias("strange")).first()
    rho = row.spread / row.more if row.more else 0.0
    return min(max(rho, 1 / (2 + (row.n or 0))), 0.99), (1 + row.strange) / (100 + row.members)


def posterior(rows: DataFrame, n: Column, bad: Column, rho: float, share: float) -> DataFrame:
    """Adds ``mean`` and ``variance`` of a rate whose prior is p, doubt, rho and the share of strange members, given counts.

    The likelihood of the counts under both parts, up to the same factor, gives how likely the member is strange.
    """
    spread = F.least(F.lit(rho) + F.col("doubt"), F.lit(0.99))
    rows = rows.withColumns({"_n": n.cast("double"), "_bad": bad.cast("double"), "_s": 1 / spread - 1})
    rows = rows.withColumns({"_a": F.col("_s") * F.col("p"), "_b": F.col("_s") * (1 - F.col("p"))})
    n, bad, s, a, b = (F.col(c) for c in ("_n", "_bad", "_s", "_a", "_b"))
    good = n - bad
    alike = (log_gamma(bad + a) - log_gamma(a)) + (log_gamma(good + b) - log_gamma(b)) - (log_gamma(n + s) - log_gamma(s))
    any_rate = log_gamma(bad + 1) + log_gamma(good + 1) - log_gamma(n + 2)
    rows = rows.withColumn("_v", 1 / (1 + F.exp(F.least(alike - any_rate + math.log((1 - share) / share), F.lit(700.0)))))
    rows = rows.withColumns({"_m": (bad + a) / (n + s), "_x": (bad + 1) / (n + 2)})
    v, m, x = F.col("_v"), F.col("_m"), F.col("_x")
    rows = rows.withColumns({
        "mean": (1 - v) * m + v * x,
        "variance": (1 - v) * m * (1 - m) / (n + s + 1) + v * x * (1 - x) / (n + 3) + v * (1 - v) * (m - x) * (m - x)})
    return rows.drop("_n", "_bad", "_s", "_a", "_b", "_v", "_m", "_x")


def _prior(rows: DataFrame) -> DataFrame:
    """The posterior of a parent as the prior of its member: p, and the doubt about it as a share of p (1 - p)."""
    return rows.withColumn("p", F.col("mean")).withColumn("doubt", F.col("variance") / (F.col("mean") * (1 - F.col("mean")))).drop("mean", "variance")


def reputations(pages: DataFrame, labels: DataFrame) -> tuple[DataFrame, float]:
    """(host, n, bad, mean, variance) of every host of the pages, its posterior for a page being bad, and the rate of all.

    Pages (page_id, host) meet labels on the id; from there on there is a row per host or domain, and these are stored, so
    that no level counts again what is below it.  One row of sums per level comes to the driver.
    """
    judged = pages.join(outcomes(labels), F.col("page_id") == F.col("doc_id"), "left")
    hosts = store(judged.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")).withColumns(
        {"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))}), "url-hosts")
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    ends = store(domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")), "url-suffixes")
    whole = ends.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")).first()
    base = (whole.bad + 0.5) / (whole.n + 1)

    parent = [F.col("n").alias("all_n"), F.col("bad").alias("all_bad"), "p", "doubt"]
    others = F.col("all_n") - F.col("n"), F.col("all_bad") - F.col("bad")
    ends = ends.withColumns({"p": F.lit(base), "doubt": F.lit(0.0)})
    fit = level(ends.withColumns({"all_n": F.lit(whole.n), "all_bad": F.lit(whole.bad)}))
    known = store(domains.join(ends.select("suffix", *parent), "suffix"), "url-domains")
    domains = _prior(posterior(known, *others, *fit))
    fit = level(known)
    known = store(hosts.join(domains.select("domain", *parent), "domain"), "url-priors")
    hosts = _prior(posterior(known, *others, *fit))
    return posterior(hosts, F.col("n"), F.col("bad"), *level(known)).select("host", "n", "bad", "mean", "variance"), base


def judge(pages: DataFrame, labels: DataFrame, rules=RULES, z: float = Z, lift: float = LIFT) -> DataFrame:
    """page_id, host, path, rule, verdict and the bound of every page."""
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    known, base = reputations(parts.select("page_id", "host"), labels)
    odds = lift * base / (1 - base)
    bounds = known.select(F.col("host").alias("known"), (F.col("mean") - z * F.sqrt("variance")).alias("bound"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return parts.join(bounds, F.col("host") == F.col("known"), "left").select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("bound") > odds / (1 + odds), "block").otherwise("allow")).alias("verdict"), "bound")
