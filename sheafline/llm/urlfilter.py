"""URL verdicts: rules by host and path, else gradient-boosted trees on lexical features. DataFrame operations only.

Rules. The longest rule (of its host and path together) whose host is the url's or a parent domain of it, and whose path
begins the url's path, decides. The rules are a small fixed list, so they become one expression and no join.

Trees. Features of the url alone: lengths, depth, digit and hyphen shares, entropy of the host's characters, parameter
counts, and how the labelled urls of the same suffix (the host's last label) and of the same first path segment fared.
Spark's gradient-boosted trees are trained on labelled urls, at most ``most`` (20,000) with the smallest hashes, and then
compiled to plain CASE expressions, so that scoring is a projection inside generated code. Suffixes seen
rarely have no statistics, and each row is learned from with and without its own.

Labelled urls. Rows of (url, label), 1: block. Where a corpus has no others, the urls that rules decide are labelled by
them (``rule_labels``), and the trees carry what they have in common over to urls that no rule fits. Hosts can be held out
of training (``held_out``) to measure that (``measure``).

Defined results: a null url, or one without ``://``, has an empty host and path, fits no rule and is judged by the trees on
its empty features; urls of any length are read whole; a score of just 0 is allow; equal urls fare alike and are judged each;
without labelled urls of both kinds everything that no rule decides is allowed; an empty table gives no rows. Other columns
pass through, but those named host, path, rule or verdict are replaced.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (host, path, verdict)
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"))
FEATURES = tuple(f"_url_{x}" for x in ("length", "host_length", "path_length", "depth", "host_parts", "digit_share", "hyphens", "entropy", "params", "query_length", "longest_label", "suffix_share", "suffix_seen", "segment_share", "segment_seen"))
SUFFIXES = ("_url_suffix", "_url_segment")


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def with_parts(df: DataFrame, url: str = "url") -> DataFrame:
    """Append host and path."""
    rest = F.when(F.instr(F.col(url), "://") > 0, F.expr(f"substring({url}, instr({url}, '://') + 3)")).otherwise(F.lit(""))
    out = df.withColumn("_rest", F.coalesce(rest, F.lit("")))
    out = out.withColumn("host", ascii_lower(F.regexp_extract("_rest", r"\A[^/?#]*", 0)))
    return out.withColumn("path", F.regexp_extract(F.expr("substring(_rest, char_length(host) + 1)"), r"\A[^?#]*", 0)).drop("_rest")


def fits(rule: tuple[str, str, str]) -> Column:
    host, path, _ = rule
    return ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)


def with_rule(df: DataFrame, rules=RULES) -> DataFrame:
    """Append rule (like ``net/es/``, null if none fits) and _verdict."""
    order = sorted(rules, key=lambda r: (-len(r[0]) - len(r[1]), r))
    rule = verdict = None
    for r in order:
        rule = F.when(fits(r), r[0] + r[1]) if rule is None else rule.when(fits(r), r[0] + r[1])
        verdict = F.when(fits(r), r[2]) if verdict is None else verdict.when(fits(r), r[2])
    none = F.lit(None).cast("string")
    return df.withColumns({"rule": none if rule is None else rule, "_verdict": none if verdict is None else verdict})


def with_features(df: DataFrame, url: str = "url") -> DataFrame:
    """Append the lexical features (all but the suffix's) to a frame with host and path."""
    u = F.coalesce(F.col(url), F.lit(""))
    n = F.greatest(F.length(u), F.lit(1))
    query = F.regexp_extract(u, r"\?([^#]*)", 1)
    labels = F.split("host", r"\.")
    size = F.greatest(F.length("host"), F.lit(1))
    letters = [*"abcdefghijklmnopqrstuvwxyz0123456789-."]
    # the share of each character of the host; others count as one more
    share = F.transform(F.array(*map(F.lit, letters)), lambda c: (F.length("host") - F.length(F.replace(F.col("host"), c))) / size)
    entropy = F.aggregate(share, F.lit(0.0), lambda a, p: a - F.when(p > 0, p * F.log2(p)).otherwise(0.0))
    return df.withColumns({
        "_url_length": F.length(u).cast("double"), "_url_host_length": F.length("host").cast("double"), "_url_path_length": F.length("path").cast("double"),
        "_url_depth": (F.size(F.split("path", "/")) - 1).cast("double"), "_url_host_parts": F.size(labels).cast("double"),
        "_url_digit_share": (F.length(F.regexp_replace(u, "[^0-9]", "")) / n).cast("double"), "_url_hyphens": (F.length("host") - F.length(F.replace(F.col("host"), F.lit("-")))).cast("double"),
        "_url_entropy": entropy.cast("double"), "_url_params": F.when(query == "", 0).otherwise(F.size(F.split(query, "&"))).cast("double"), "_url_query_length": F.length(query).cast("double"),
        "_url_longest_label": F.array_max(F.transform(labels, F.length)).cast("double"), "_url_suffix": F.element_at(labels, -1), "_url_segment": F.split_part("path", F.lit("/"), F.lit(2)),
    })


def rule_labels(df: DataFrame, rules=RULES) -> DataFrame:
    """Append label to a frame with host and path: 1 if a rule blocks the url, 0 if one allows it, null if none fits."""
    return with_rule(df, rules).withColumn("label", F.when(F.col("_verdict") == "block", 1).when(F.col("_verdict") == "allow", 0)).drop("rule", "_verdict")


def held_out(folds: int = 5) -> Column:
    """Whether a url's host (without its first part if it has more than two) is one of the fold kept from training."""
    site = F.when(F.size(F.split("host", r"\.")) > 2, F.regexp_replace("host", r"\A[^.]*\.", "")).otherwise(F.col("host"))
    return F.pmod(F.xxhash64(site, F.lit("site")), F.lit(folds)) == 0


class Trees:
    """Boosted trees as one expression; stats, for each of SUFFIXES: value -> (labelled blocked, labelled urls)."""

    def __init__(self, score: str | None, stats: tuple[dict[str, tuple[float, float]], ...] = ({}, {}), prior: float = 0.0):
        self.score, self.stats, self.prior = score, stats, prior

    def suffix_features(self, df: DataFrame) -> DataFrame:
        """Smoothed share of blocked urls and number of urls by suffix."""
        new = {}
        for name, stats in zip(SUFFIXES, self.stats):
            pick = lambda i: F.coalesce(F.create_map(*(x for k, v in sorted(stats.items()) for x in (F.lit(k), F.lit(v[i]))))[F.col(name)], F.lit(0.0)) if stats else F.lit(0.0)  # noqa: B023, E731
            new |= {f"{name}_share": (pick(0) + 5 * self.prior) / (pick(1) + 5), f"{name}_seen": pick(1)}
        return df.withColumns(new)

    def blocked(self) -> Column:
        return F.expr(f"({self.score}) > 0") if self.score else F.lit(False)


def compile_trees(debug: str, weights: list[float]) -> str:
    """The ensemble's printed form as a sum of CASE expressions."""
    out = []
    for body, weight in zip(re.split(r"\n\s*Tree \d+[^\n]*\n", debug)[1:], weights):
        lines = [x.strip() for x in body.strip().split("\n")]

        def node() -> str:
            line = lines.pop(0)
            if line.startswith("Predict:"):
                return repr(float(line.split()[1]))
            k, bound = re.match(r"If \(feature (\d+) <= (\S+)\)", line).groups()
            yes = node()
            lines.pop(0)  # Else
            return f"CASE WHEN {FEATURES[int(k)]} <= {float(bound)!r} THEN {yes} ELSE {node()} END"

        out.append(f"{float(weight)!r} * ({node()})")
    return " + ".join(out)


def train(labelled: DataFrame, most: int = 20_000, max_suffixes: int = 200, least: int = 20, trees: int = 20, depth: int = 4) -> Trees:
    """Fit to ``labelled`` (url, host, path, label). Suffixes of fewer than ``least`` labelled urls, whose
    share would tell a row its own label, or beyond the ``max_suffixes`` most frequent, count as unseen."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    some = with_features(labelled.where("label is not null").orderBy(F.xxhash64("url"), "url").limit(most)).cache()
    try:
        total, bad = some.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
        if not 0 < bad < total:
            return Trees(None)
        prior = bad / total
        top = lambda name: {r[0]: (float(r["bad"]), float(r["n"])) for r in some.groupBy(name).agg(F.sum("label").alias("bad"), F.count("*").alias("n")).where(F.col("n") >= least).orderBy(F.desc("n"), name).limit(max_suffixes).collect()}
        out = Trees(None, tuple(map(top, SUFFIXES)), prior)
        # both kinds weigh the same, as the unwanted ones are few
        weighed = out.suffix_features(some).withColumn("_weight", F.when(F.col("label") == 1, 0.5 / prior).otherwise(0.5 / (1 - prior)))
        # each row again as if its suffix, and as if its segment, were unseen, so that the rest is learned for such urls
        weighed = reduce(DataFrame.unionByName, [weighed.withColumns({f"{n}_share": F.lit(prior), f"{n}_seen": F.lit(0.0)}) for n in SUFFIXES], weighed)
        table = VectorAssembler(inputCols=list(FEATURES), outputCol="_features").transform(weighed).select("_features", "_weight", F.col("label").cast("double"))
        model = GBTClassifier(featuresCol="_features", labelCol="label", weightCol="_weight", maxIter=trees, maxDepth=depth, stepSize=0.4, seed=7, maxBins=32).fit(table)
        out.score = compile_trees(model.toDebugString, list(model.treeWeights))
        return out
    finally:
        some.unpersist()


def scored(df: DataFrame, trees: Trees, url: str = "url") -> DataFrame:
    """Append _blocked, what the trees alone say of a frame with host and path."""
    return trees.suffix_features(with_features(df, url)).withColumn("_blocked", trees.blocked()).drop(*SUFFIXES, *FEATURES)


def judge(df: DataFrame, trees: Trees, rules=RULES, url: str = "url") -> DataFrame:
    """Append host, path, rule and verdict (allow or block)."""
    out = scored(with_rule(with_parts(df, url), rules), trees, url)
    return out.withColumn("verdict", F.coalesce(F.col("_verdict"), F.when(F.col("_blocked"), "block").otherwise("allow"))).drop("_verdict", "_blocked")


def measure(labelled: DataFrame, trees: Trees) -> dict[str, float]:
    """Precision and recall of the trees alone on ``labelled`` (url, host, path, label)."""
    hit = F.col("_blocked") & (F.col("label") == 1)
    both, said, bad, n = scored(labelled.where("label is not null"), trees).agg(F.count_if(hit), F.count_if("_blocked"), F.count_if(F.col("label") == 1), F.count("*")).first()
    return {"precision": both / max(said, 1), "recall": both / max(bad, 1), "urls": n}
