"""URL verdicts from given host rules and from association rules mined from labels.

Tokens of an address are its scheme, host, words of the host's labels, path
segments (digits as #) and query keys. A token set is a rule if enough labelled
pages that have it are bad, and if the share of bad ones lies above a least one,
and well above that of all pages, even at the lower end of its range of chance.
Single tokens, such as a host, are counted by aggregation, so that a small but
certain host is a rule at every size. Sets of more tokens come from FP-growth
among the sets that a fixed share of all labelled pages has, so that their
number, and the frequent tokens that FP-growth brings to the driver, don't grow
with the pages. Addresses with the same tokens are judged once: rules hang on
their rarest token in an inverted index, an address's tokens look up its
candidates, and a rule matches if the address has all its tokens.

Everything is a DataFrame plan or Spark's own FP-growth. Nothing is keyed by a
single token of all pages: tokens are joined once for each distinct token set.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlab.sources.staging import stage

#: Verdict, host and path of the given rules.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
#: Bad pages of a rule, at every size; of a rule of several tokens also this share of all labelled pages.
LEAST_PAGES = 30
LEAST_SUPPORT = 0.005
LEAST_CONFIDENCE = 0.6
LEAST_LIFT = 1.5
#: The lower end of the confidence lies so many standard deviations down, and above this share.
DEVIATIONS = 3.0
LEAST_LOWER_END = 0.5
_BAD = "label=bad"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^(.*?)://([^/?#]*)([^?#]*)(?:\?([^#]*))?"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to a slash, question mark, hash or the end, A-Z lower-cased."""
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 3), F.lit(""))


def given_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, else null."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, of_host, of_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == of_host) | host.endswith(f".{of_host}")) & path.startswith(of_path)
        rule = F.when(fits, f"{of_host}{of_path}").otherwise(rule)
        verdict = F.when(fits, name).otherwise(verdict)
    return rule, verdict


def tokens_of(url: Column) -> Column:
    """Sorted distinct tokens of an address; none without ``://``."""

    def marked(kind: str, values: Column) -> Column:
        return F.transform(F.filter(values, lambda x: x != ""), lambda x: F.concat(F.lit(f"{kind}:"), x))

    host, lower = host_of(url), F.lower(path_of(url))
    keys = F.split(F.regexp_replace(F.coalesce(F.regexp_extract(url, _PARTS, 4), F.lit("")), r"=[^&]*", ""), "&")
    tokens = F.concat(
        marked("scheme", F.array(F.lower(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit(""))))),
        marked("host", F.array(host)),
        marked("word", F.split(host, r"[.\-]")),
        marked("path", F.split(F.regexp_replace(lower, r"[0-9]+", "#"), "/")),
        marked("key", keys),
    )
    return F.array_sort(F.array_distinct(tokens))


def labelled_tokens(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """``items`` of pages whose address holds the number of a labelled document.

    A document of low quality or a toxic one makes its page bad.
    """
    number = F.regexp_extract(path_of(F.col("url")), r"/([0-9]{1,18})(?=[/.]|$)", 1)
    # At most 18 digits, which fit a long.
    number = F.when(number != "", number).cast("long")
    shown = pages.select(number.alias("doc_id"), tokens_of(F.col("url")).alias("tokens"))
    marks = labels.groupBy("doc_id").agg(F.max((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    found = shown.join(marks, "doc_id").filter("bad IS NOT NULL")
    mark = F.when(F.col("bad"), F.lit(_BAD)).otherwise(F.lit("label=good"))
    return found.select(F.concat("tokens", F.array(mark)).alias("items"))


def _lower_end(n: Column, bad: Column) -> Column:
    """The least share of bad pages that ``bad`` of ``n`` speak for, by Wilson's interval."""
    z, share = DEVIATIONS, bad / n
    middle = share + z * z / (2 * n)
    spread = z * F.sqrt(share * (1 - share) / n + z * z / (4 * n * n))
    return (middle - spread) / (1 + z * z / n)


def mine(labelled: DataFrame, support: float | None = None, confidence: float = LEAST_CONFIDENCE) -> DataFrame:
    """``rule_id, tokens, confidence, support`` of the token sets that speak for a bad page.

    ``support`` takes the place of both least supports.
    """
    spark = labelled.sparkSession
    empty = "rule_id long, tokens array<string>, confidence double, support double"
    known = labelled.select("items", F.array_contains("items", _BAD).alias("bad"))
    n, bad = known.agg(F.count("*"), F.count_if("bad")).first()
    least = max(LEAST_PAGES, (support or 0.0) * n)
    if bad < least:
        return spark.createDataFrame([], empty)
    tokens = known.select(F.explode(F.filter("items", lambda x: ~x.startswith("label="))).alias("token"), "bad")
    single = tokens.groupBy("token").agg(F.count("*").alias("n"), F.count_if("bad").alias("bad"))
    single = single.select(F.array("token").alias("tokens"), "n", "bad")
    model = FPGrowth(
        itemsCol="items", minSupport=max(LEAST_SUPPORT if support is None else support, least / n), minConfidence=confidence
    ).fit(labelled)
    several = model.associationRules.filter((F.col("consequent") == F.array(F.lit(_BAD))) & (F.size("antecedent") > 1))
    both = F.round(F.col("support") * n)
    several = several.select(F.col("antecedent").alias("tokens"), F.round(both / F.col("confidence")).alias("n"), both.alias("bad"))
    rules = single.unionByName(several).filter(F.col("bad") >= least)
    share = F.col("bad") / F.col("n")
    sure = _lower_end(F.col("n"), F.col("bad")) >= max(LEAST_LOWER_END, LEAST_LIFT * bad / n)
    return stage(
        rules.filter((share >= confidence) & (share >= LEAST_LIFT * bad / n) & sure).select(
            F.xxhash64(F.array_sort("tokens")).alias("rule_id"),
            "tokens",
            share.alias("confidence"),
            (F.col("bad") / n).alias("support"),
        )
    )


def match(addresses: DataFrame, rules: DataFrame) -> DataFrame:
    """The best rule of each row of ``key, tokens`` that any rule matches: ``key, confidence, rule_tokens``."""
    needed = F.col("tokens").alias("needed")
    entries = rules.select("rule_id", needed, "confidence", "support", F.explode("tokens").alias("token"))
    spread = entries.groupBy("token").agg(F.count("*").alias("held"))
    rarest = F.min_by("token", F.struct("held", "token"))
    facts = [F.first(c).alias(c) for c in ("needed", "confidence", "support")]
    index = stage(entries.join(spread, "token").groupBy("rule_id").agg(rarest.alias("token"), *facts))
    if index.isEmpty():  # no token need be dealt out
        return addresses.limit(0).select("key", F.lit(None).cast("double").alias("confidence"), F.col("tokens").alias("rule_tokens"))
    looked = addresses.select("key", "tokens", F.explode("tokens").alias("token")).join(index, "token")
    matched = looked.filter(F.size(F.array_except("needed", "tokens")) == 0)
    best = F.struct("confidence", "support", F.array_sort("needed").alias("needed"))
    return matched.groupBy("key").agg(F.max(best).alias("_best")).select(
        "key", F.col("_best.confidence").alias("confidence"), F.col("_best.needed").alias("rule_tokens")
    )


def judge(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """``page_id, host, path, rule, verdict, confidence, rule_tokens`` of each page.

    The longest given rule that fits decides; else a page that a mined rule
    matches is blocked, with that rule's tokens and confidence; all others are
    allowed. Only ``page_id`` and ``url`` are read. A null address, or one
    without ``://``, has empty host and path, no tokens, and is allowed. Rows
    stay apart, also equal ones and those without id. Without labels no rule is
    mined; an empty table gives no rows.
    """
    url = F.col("url")
    key = F.concat_ws("\u0001", tokens_of(url))
    rows = pages.select("page_id", key.alias("key"), host_of(url).alias("host"), path_of(url).alias("path"))
    rules = mine(stage(labelled_tokens(pages.select("url"), labels)))
    distinct = rows.select("key").distinct().filter("key <> ''").select("key", F.split("key", "\u0001").alias("tokens"))
    found = stage(match(distinct, rules))
    rule, verdict = given_rule(F.col("host"), F.col("path"))
    mined = F.when(F.col("confidence").isNotNull(), "block").otherwise("allow")
    return rows.join(found, "key", "left").select(
        "page_id",
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(verdict, mined).alias("verdict"),
        "confidence",
        "rule_tokens",
    )
