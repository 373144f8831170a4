"""URL filter by association rules (operator 3, native).

A url's tokens are its top-level domain, its site (the last two labels), its
host, the host's first label, the first folder, the names of the query's
parameters together, and the ending of the path.  Spark's FP-growth
mines token combinations together with the label of labelled urls, the label
being an item too.  Rules {tokens} -> label with enough support and confidence
stay, less those that a rule with fewer of the same tokens makes needless.
A url meets only the rules that an inverted index lists under its tokens: each
rule stands under its rarest token, and the rule's other tokens are then tested.
The most confident rule decides, then the better supported one.

Listed rules (host, path) come first: host and all its subdomains, if the path
starts with the rule's; the longest wins.

Defined results: a null url, or one without ``://``, has an empty host and
path and no rule; where no mined rule fires, the verdict is the ``default``.
Without labelled urls nothing is mined.  Repeated page_ids are judged row by
row; an empty table gives no rows; columns named like results are replaced,
others don't matter.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from stratum.llm.common import by_group, without
from stratum.sinks import materialize

LABEL = "label="


@dataclass(frozen=True)
class RuleConfig:
    support: float = 0.002          # share of the labelled urls that have a rule's tokens and label,
    least: int = 20                 # and at least so many urls
    confidence: float = 0.9
    default: str = "allow"


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    return F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1),
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def located(pages: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` with ``host`` and ``path``."""
    own = without(pages, ["host", "path"])
    return own.withColumns({"host": F.coalesce(host_of(F.col(url)), F.lit("")),
                            "path": F.coalesce(path_of(F.col(url)), F.lit(""))})


def listed(pages: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """``pages`` (with host and path) with ``rule`` and ``listed_verdict`` of
    the longest of the ``rules`` (verdict, host, path) that fits.  The list is
    a setting, tried in order of length for each url."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, host, path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1], r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule = F.when(fits, host + path).otherwise(rule)
        verdict = F.when(fits, decision).otherwise(verdict)
    return pages.withColumns({"rule": rule, "listed_verdict": verdict})


def tokens_of(url: Column) -> Column:
    """The tokens of a url (whose host and path are columns): at most seven, so
    that a frequent url has at most 2 ** 7 combinations."""
    labels = F.split("host", r"\.")
    n = F.size(labels)
    folder = F.coalesce(F.get(F.split("path", "/"), F.lit(1)), F.lit(""))
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^[^#]*?\?([^#]*)", 1)
    names = F.transform(F.split(query, "&"), lambda x: F.split_part(x, F.lit("="), F.lit(1)))
    kind = F.regexp_extract("path", r"\.([A-Za-z0-9]{1,8})$", 1)
    return F.array_compact(F.array(
        F.concat(F.lit("top:"), F.get(labels, n - 1)),
        F.when(n > 1, F.concat(F.lit("site:"), F.array_join(F.slice(labels, -2, 2), "."))),
        F.when(n > 2, F.concat(F.lit("host:"), F.col("host"))),
        F.when(n > 2, F.concat(F.lit("first:"), F.get(labels, F.lit(0)))),
        F.when(F.col("path").rlike("^/[^/]+/"), F.concat(F.lit("folder:"), folder)),
        F.when(query != "", F.concat(F.lit("query:"), F.array_join(F.array_sort(F.array_distinct(names)), "&"))),
        F.when(kind != "", F.concat(F.lit("kind:"), kind))))


def mine(labelled: DataFrame, config: RuleConfig) -> DataFrame:
    """``needs, verdict, confidence, support`` from rows with ``tokens`` and
    ``label``."""
    share = max(config.support, config.least / max(labelled.count(), 1))
    baskets = labelled.select(F.array_append("tokens", F.concat(F.lit(LABEL), F.col("label"))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min(share, 1.0), minConfidence=config.confidence).fit(baskets)
    found = (model.associationRules
             .where(F.get("consequent", F.lit(0)).startswith(LABEL))
             .where(~F.exists("antecedent", lambda x: x.startswith(LABEL)))
             .select(F.array_sort("antecedent").alias("needs"),
                     F.substring(F.get("consequent", F.lit(0)), len(LABEL) + 1, 1 << 20).alias("verdict"),
                     "confidence", "support"))
    found = materialize(found, "url_rules")
    # a rule is needless if a part of its tokens decides the same as confidently
    part = found.select(F.col("needs").alias("_needs"), F.col("verdict").alias("_verdict"),
                        F.col("confidence").alias("_confidence"))
    wider = (found.withColumn("_token", F.explode("needs"))
             .join(part.withColumn("_token", F.get("_needs", F.lit(0))), "_token")
             .where((F.col("verdict") == F.col("_verdict")) & (F.col("confidence") <= F.col("_confidence"))
                    & (F.size("_needs") < F.size("needs"))
                    & (F.size(F.array_except("_needs", "needs")) == 0)))
    return found.join(wider.select("needs", "verdict").distinct(), ["needs", "verdict"], "left_anti")


def index(rules: DataFrame, labelled: DataFrame) -> DataFrame:
    """The inverted index: each rule under the token of its own that the
    fewest labelled urls have."""
    spread = labelled.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    listed_ = rules.withColumn("token", F.explode("needs")).join(spread, "token", "left")
    rarest = listed_.groupBy("needs", "verdict").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).alias("key"))
    return rules.join(rarest.select("needs", "verdict", F.col("key.token").alias("token")), ["needs", "verdict"])


def match(urls: DataFrame, indexed: DataFrame) -> DataFrame:
    """The distinct ``tokens`` on which some rule fires, with the best rule's
    verdict, tokens and confidence."""
    hits = (urls.withColumn("token", F.explode("tokens")).join(indexed, "token")
            .where(F.size(F.array_except("needs", "tokens")) == 0))
    best = F.max(F.struct("confidence", "support", (-F.size("needs")).alias("_short"), "needs", "verdict"))
    return hits.groupBy("tokens").agg(best.alias("mined")).select(
        "tokens", F.col("mined.verdict").alias("mined_verdict"), F.col("mined.needs").alias("mined_tokens"),
        F.col("mined.confidence").alias("mined_confidence"))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], config: RuleConfig = RuleConfig(),
          labelled: DataFrame | None = None, url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule, verdict and the mined rule, if one decided.
    ``labelled``: (url, label) rows; by default the pages that a listed rule
    decides, under its verdict.  Of rules learned from these, one that an example
    contradicts doesn't fire: the list itself says otherwise."""
    made = ("host", "path", "rule", "listed_verdict", "verdict", "tokens", "mined_verdict", "mined_tokens",
            "mined_confidence")
    own = without(pages, made)
    known = listed(located(own, url), rules).withColumn("tokens", tokens_of(F.col(url)))
    if labelled is None:
        examples = known.where("rule IS NOT NULL").select("tokens", F.col("listed_verdict").alias("label"))
    else:
        examples = (located(labelled.select(F.col(url).alias("url"), "label").where("label IS NOT NULL"), "url")
                    .select(tokens_of(F.col("url")).alias("tokens"), "label"))
    examples = materialize(examples, "url_examples")
    is_open = F.col("rule").isNull() & (F.col("host") != "")
    # equal token sets are judged once; rows that share one are dealt to several tasks
    plain = [f.name for f in own.schema.fields if not isinstance(f.dataType, MapType)]
    salted, groups = by_group(known.where(is_open), ["tokens"], [F.col(f"`{c}`") for c in plain],
                              {"_n": (F.count, F.lit(1), F.sum)})
    groups = materialize(groups.select("tokens", "_salt"), "url_groups")
    none = known.sparkSession.createDataFrame(
        [], "tokens array<string>, mined_verdict string, mined_tokens array<string>, mined_confidence double")
    mined = none
    if not examples.isEmpty():
        found = mine(examples, config)
        if labelled is None:
            found = found.where("confidence = 1")
        mined = match(groups.select("tokens").distinct(), index(found, examples))
    verdicts = materialize(groups.join(mined, "tokens"), "url_verdicts")
    judged = salted.join(verdicts, ["tokens", "_salt"], "left").drop("_salt")
    judged = judged.unionByName(known.where(~is_open), allowMissingColumns=True)
    return (judged.withColumn("verdict", F.coalesce("listed_verdict", "mined_verdict", F.lit(config.default)))
            .drop("listed_verdict", "mined_verdict", "tokens"))
