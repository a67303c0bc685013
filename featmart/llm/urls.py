"""URL filter: rules on host and path, and for the rest boosted trees on lexical features.

A rule holds for its host and all subdomains where the path begins with the rule's path; of several the longest wins, of equally
long ones the first as text. URLs that a rule decides are the labelled ones. The trees learn from all of them: lengths, depth, share of
digits, entropy, numbers of parameters, and how often URLs with the same host suffix are blocked. Each suffix
is counted by itself; the counts are a table that is joined by suffix, broadcast only where a count shows it to be small.

A null URL or one without `://` has an empty host and path; its features are those of its text (null: of empty text). Without labels of
both kinds there is nothing to learn, and the verdict is that of the labels there are, `allow` if there are none. Repeated rows get the same
verdict; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..workdir import cut, small_side

ALLOW, BLOCK = "allow", "block"
FEW_SUFFIXES = 100_000
PRIOR_WEIGHT = 20.0
FEATURES = (
    "url_length", "host_length", "path_length", "query_length", "depth", "host_labels", "digit_ratio", "host_digit_ratio", "upper_ratio",
    "mark_ratio", "hyphens", "entropy", "host_entropy", "parameters", "has_fragment", "longest_segment", "top_rate", "domain_rate", "domain_log_count",
)


@dataclass(frozen=True)
class Rule:
    verdict: str
    prefix: str  # host, and path from the first slash

    @property
    def host(self) -> str:
        return self.prefix.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.prefix.partition("/")[2]


def parts(url: str) -> tuple[Column, Column]:
    """Host, with A-Z in lower case, and path."""
    rest = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def decided(rules: Sequence[Rule], what: str) -> Column:
    """`prefix` or `verdict` of the rule that holds for the columns host and path, else null. The list is part of the plan."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.prefix), [-ord(c) for c in r.prefix])):
        at_host = (F.col("host") == rule.host) | F.col("host").endswith(f".{rule.host}")
        out = F.when(at_host & F.col("path").startswith(rule.path), F.lit(getattr(rule, what))).otherwise(out)
    return out


def _entropy(text: str) -> float:
    n = len(text)
    return -sum(c / n * math.log2(c / n) for c in Counter(text).values()) if n else 0.0


def _lexical(url: str, host: str, path: str) -> list[float]:
    n = max(1, len(url))
    query = url.partition("#")[0].partition("?")[2]
    ascii_digits = lambda t: sum("0" <= c <= "9" for c in t)
    return [
        len(url), len(host), len(path), len(query), path.count("/"), host.count(".") + 1 if host else 0,
        ascii_digits(url) / n, ascii_digits(host) / max(1, len(host)), sum("A" <= c <= "Z" for c in url) / n,
        sum(not c.isalnum() for c in url) / n, host.count("-"), _entropy(url), _entropy(host),
        query.count("&") + 1 if query else 0, float("#" in url), max(map(len, path.split("/"))),
    ]


def suffixes() -> tuple[Column, Column]:
    """The last label of the host and the last two."""
    return F.substring_index("host", ".", -1), F.substring_index("host", ".", -2)


def suffix_counts(labelled: DataFrame) -> DataFrame:
    """Blocked and all labelled URLs per level and suffix."""
    pairs = F.explode(F.array(*[F.struct(F.lit(level).alias("level"), c.alias("suffix")) for level, c in enumerate(suffixes())]))
    return labelled.select("label", pairs.alias("at")).groupBy("at.level", "at.suffix").agg(F.sum("label").alias("blocked"), F.count(F.lit(1)).alias("n"))


def with_suffix_counts(rows: DataFrame, counts: DataFrame, share: float) -> DataFrame:
    """Add `rate_0`, `rate_1` (the share of blocked URLs with the same suffix, drawn to `share`) and `n_0`, `n_1`; `counts` is cut.

    A suffix is in `counts` once, so a hot one is split as a skewed join; suffixes without labels have the count 0.
    """
    for level, suffix in enumerate(suffixes()):
        side = counts.where(F.col("level") == level).select(F.col("suffix").alias("_fl_suffix"), F.col("blocked").alias("_fl_blocked"), F.col("n").alias("_fl_n"))
        n, blocked = F.coalesce("_fl_n", F.lit(0)), F.coalesce("_fl_blocked", F.lit(0.0))
        rows = rows.join(small_side(side, FEW_SUFFIXES), suffix == F.col("_fl_suffix"), "left")
        rows = rows.withColumns({f"rate_{level}": (blocked + PRIOR_WEIGHT * share) / (n + PRIOR_WEIGHT), f"n_{level}": n}).drop("_fl_suffix", "_fl_blocked", "_fl_n")
    return rows


def features() -> Column:
    """The feature vector of the columns url, host, path and those of with_suffix_counts."""

    @F.pandas_udf("array<double>")
    def vectors(url: pd.Series, host: pd.Series, path: pd.Series, top: pd.Series, domain: pd.Series, n: pd.Series) -> pd.Series:
        rows = [[*map(float, _lexical(u, h, p)), t, d, math.log1p(k)] for u, h, p, t, d, k in zip(url, host, path, top, domain, n)]
        return pd.Series(rows, dtype=object)

    return array_to_vector(vectors("url", "host", "path", "rate_0", "rate_1", "n_1"))


def judge(pages: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url: str = "url", trees: int = 12, depth: int = 4, seed: int = 5) -> DataFrame:
    """One row per page: id, host, path, rule, verdict and score, the trees' probability that the URL is to be blocked."""
    host, path = parts(url)
    rows = pages.select(F.col(id_col).alias("_fl_id"), F.coalesce(F.col(url), F.lit("")).alias("url"), host.alias("host"), path.alias("path"))
    rows = rows.withColumns({"rule": decided(rules, "prefix"), "by_rule": decided(rules, "verdict")})
    labelled = cut(rows.where("rule is not null").select("url", "host", "path", (F.col("by_rule") == BLOCK).cast("double").alias("label")), "labelled")
    total, ones = labelled.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if 0 < ones < total:
        counts, share = cut(suffix_counts(labelled), "suffixes"), ones / total
        training = cut(with_suffix_counts(labelled, counts, share).select(features().alias("features"), "label"), "url-features")
        model = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.3, seed=seed).fit(training)
        scored = model.transform(with_suffix_counts(rows, counts, share).withColumn("features", features()))
        scored = scored.withColumn("score", F.get(vector_to_array("probability"), F.lit(1)))
    else:
        scored = rows.withColumn("score", F.lit(float(total > 0 and ones == total)))
    verdict = F.coalesce("by_rule", F.when(F.col("score") >= 0.5, BLOCK).otherwise(ALLOW))
    return scored.select(F.col("_fl_id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"), "score")
