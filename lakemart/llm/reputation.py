"""Operator 8 — URL filter by empirical-Bayes host reputation.

Native DataFrame code.  The labelled pages of a host are binomial trials
(bad or not).  Rates shrink along host -> registered domain -> public suffix ->
all: each level's rate has a beta prior whose mean is the posterior mean of the
level above and whose strength ``k`` is fitted to the data by moments: with
``e = mu (1 - mu)`` over the groups of the level,

    rho = (sum n (p - mu)^2 - sum e) / sum (n - 1) e,     k = 1 / rho - 1,

``rho`` held within :data:`RHO`.  A host is blocked when the lower posterior
bound (mean - z * sd of its beta posterior) of its bad rate exceeds
``max_bad``: it takes evidence to block, so an unknown host is judged by its domain.

Fixed rules (``host/path``) go before the method: a rule fits its host and all
subdomains when the path starts with the rule's path; the longest rule wins.

Every grouping is a sum, pre-aggregated per task; the tables of hosts, domains and
suffixes are written and joined by their real size, so a host with a third
of all pages costs one partial row per task.

Defined cases: a null url, or one without ``://``, has empty host and path and counts as a
host of its own; pages without a labelled document are unlabelled; a label row with
both values null is no label; several labels of a document count as bad if
any is; an empty table or one without any label gives bad rate 0.5 before shrinkage
(nothing is blocked).  Other columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lakemart.llm.common import ascii_lower, materialize, own_names

#: Public suffixes of two labels (parameter); every other host's suffix is its last label.
TWO_LABEL_SUFFIXES = ("ac.uk", "co.jp", "co.nz", "co.uk", "com.au", "com.br", "org.uk")
RHO = (1e-4, 0.5)
Z = 1.645
MAX_BAD = 0.25
_WORK = ["host", "path", "rule", "verdict", "bad_mean", "bad_bound", "_lm_doc", "_lm_domain", "_lm_suffix"]


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return ascii_lower(F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), F.lit("")))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def rule_of(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest fitting rule (``host/path`` text), or null."""
    fits = []
    for r in sorted(rules, key=lambda x: (-len(x), x)):
        h, p = r.split("/", 1)
        fits.append(F.when(((host == h) | host.endswith("." + h)) & path.startswith("/" + p), F.lit(r)))
    return F.coalesce(*fits) if fits else F.lit(None).cast("string")


def registered_domain(host: Column, two_label: tuple[str, ...] = TWO_LABEL_SUFFIXES) -> tuple[Column, Column]:
    """(registered domain, public suffix) of a host."""
    suffix = F.when(F.substring_index(host, ".", -2).isin(list(two_label)), F.substring_index(host, ".", -2)) \
        .otherwise(F.substring_index(host, ".", -1))
    domain = F.when(F.substring_index(host, ".", -2).isin(list(two_label)), F.substring_index(host, ".", -3)) \
        .otherwise(F.substring_index(host, ".", -2))
    return domain, suffix


def _strength(groups: DataFrame, name: str) -> DataFrame:
    """One row: the prior strength of a level whose rows have ``n``, ``bad`` and the prior mean ``mu``."""
    e = F.col("mu") * (1 - F.col("mu"))
    rate = F.col("bad") / F.col("n")
    s = groups.where("n > 0").agg(F.sum(F.col("n") * (rate - F.col("mu")) * (rate - F.col("mu"))).alias("s"),
                                  F.sum(e).alias("e"), F.sum((F.col("n") - 1) * e).alias("f"))
    rho = F.when(F.col("f") > 0, (F.col("s") - F.col("e")) / F.col("f")).otherwise(F.lit(RHO[0]))
    return s.select((1 / F.least(F.greatest(rho, F.lit(RHO[0])), F.lit(RHO[1])) - 1).alias(name))


def host_posteriors(outcomes: DataFrame, z: float = Z) -> DataFrame:
    """``outcomes`` (``host``, ``bad``: 1, 0 or null) -> one row per host: ``n``, ``bad``, ``bad_mean``, ``bad_bound``."""
    domain, suffix = registered_domain(F.col("host"))
    hosts = materialize(
        outcomes.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).cast("long").alias("bad"))
        .withColumns({"_lm_domain": domain, "_lm_suffix": suffix}), "rep-hosts")
    domains = materialize(hosts.groupBy("_lm_domain", "_lm_suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")), "rep-domains")
    suffixes = materialize(domains.groupBy("_lm_suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")), "rep-suffixes")
    n, bad = suffixes.agg(F.sum("n"), F.sum("bad")).first()
    overall = bad / n if n else 0.5

    def shrunk(groups: DataFrame, mean: str) -> DataFrame:
        """Posterior mean per group; ``k`` is read back as one number."""
        k = _strength(groups, "k").first()["k"]
        return groups.withColumn(mean, (F.col("bad") + k * F.col("mu")) / (F.col("n") + k)), k

    s, _ = shrunk(suffixes.withColumn("mu", F.lit(float(overall))), "mean")
    s = materialize(s.select("_lm_suffix", F.col("mean").alias("mu")), "rep-suffix-means")
    d, _ = shrunk(domains.join(s, "_lm_suffix"), "mean")
    d = materialize(d.select("_lm_domain", F.col("mean").alias("mu")), "rep-domain-means")
    h = hosts.join(d, "_lm_domain")
    h, k = shrunk(h, "bad_mean")
    total = F.col("n") + k
    sd = F.sqrt(F.col("bad_mean") * (1 - F.col("bad_mean")) / (total + 1))
    return materialize(h.select("host", "n", "bad", "bad_mean", (F.col("bad_mean") - z * sd).alias("bad_bound")), "rep-posteriors")


def judge_pages(pages: DataFrame, labels: DataFrame, rules: dict[str, str], max_bad: float = MAX_BAD, z: float = Z) -> DataFrame:
    """``pages`` (with ``url``) plus ``host``, ``path``, ``rule``, ``verdict``, ``bad_mean``, ``bad_bound``.

    A page is labelled by the document that the last number of its path names.
    """
    pages = own_names(pages, _WORK)
    p = pages.withColumns({"host": url_host(F.col("url")), "path": url_path(F.col("url"))})
    doc = F.try_to_number(F.nullif(F.regexp_extract("path", r"/([0-9]{1,18})(?:\.[a-z]+)?/?$", 1), F.lit("")), F.lit("9" * 18)).cast("long")
    bad = F.when(F.col("quality").isNull() & F.col("toxic").isNull(), None).otherwise(
        (F.coalesce(F.col("quality"), F.lit(1)) == 0) | (F.coalesce(F.col("toxic"), F.lit(0)) == 1)).cast("int")
    known = labels.groupBy(F.col("doc_id").alias("_lm_doc")).agg(F.max(bad).alias("bad"))
    outcomes = p.select("host", doc.alias("_lm_doc")).join(known, "_lm_doc", "left")
    posterior = host_posteriors(outcomes.select("host", "bad"), z).select("host", "bad_mean", "bad_bound")
    rule = rule_of(F.col("host"), F.col("path"), rules)
    by_rule = F.create_map(*(F.lit(x) for kv in rules.items() for x in kv)) if rules else F.lit(None)
    return (p.join(posterior, "host").withColumn("rule", rule)
            .withColumn("verdict", F.when(F.col("rule").isNotNull(), by_rule[F.col("rule")] if rules else F.lit(None))
                        .when(F.col("bad_bound") > max_bad, "block").otherwise("allow")))
