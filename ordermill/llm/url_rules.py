"""URL filtering: given host and path rules, and association rules mined from labelled URLs with FP-growth."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import column, written

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The item that says a labelled URL is bad.
BAD = "label:block"
#: Of all labelled URLs, the share that must hold a rule's tokens and be bad; of those that hold them, the share that must be bad.
SUPPORT, CONFIDENCE = 0.02, 0.6


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def url_tokens(url: Column) -> Column:
    """The distinct tokens of a URL: scheme, host labels, path words, ending of the path, names in the query, fragment.

    Numbers count as one token, so that page numbers do not make every URL a kind of its own.
    """
    path = path_of(url)
    host = F.transform(F.filter(F.split(host_of(url), r"[.:]"), lambda x: x != ""), lambda x: F.concat(F.lit("host:"), x))
    words = F.transform(F.filter(F.split(F.lower(path), r"[/._\-]+"), lambda x: x != ""), lambda x: F.concat(F.lit("path:"), F.regexp_replace(x, r"[0-9]+", "0")))
    query = F.regexp_extract_all(url, F.lit(r"[?&]([^=&#]+)"), F.lit(1))
    names = F.transform(query, lambda x: F.concat(F.lit("query:"), F.lower(x)))
    scheme = F.array(F.concat(F.lit("scheme:"), F.lower(F.regexp_extract(url, r"^([A-Za-z]+)://", 1))))
    fragment = F.when(url.contains("#"), F.array(F.lit("fragment"))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(scheme, host, words, names, fragment))


def mined_rules(labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """rule (array of tokens), confidence, support and key of what FP-growth finds in ``labelled`` (url, bad).

    Only rules that say bad, by support and confidence; a rule goes if another with some of its tokens is as confident. Rows
    without url or label are left out. ``key`` is the rule's rarest token (ties: the first by code point), under which the index
    holds it.

    Before mining, two things that change no rule's figures make the combinations few. Tokens that too few bad URLs have can be
    in no rule and go. Tokens that always stand together are one item, as any of them tells the same: rules name them all. So
    a URL that occurs a thousand times, however many tokens it has, is one item, and not all combinations of its tokens.
    """
    rows = labelled.where("url is not null and bad is not null").select("bad", url_tokens(F.col("url")).alias("tokens"))
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "labelled")
    n, bad = rows.agg(F.count("*"), F.count_if("bad")).first()
    if not bad:
        return labelled.sparkSession.createDataFrame([], "rule array<string>, confidence double, support double, key string")
    held = rows.select("row", "bad", F.explode("tokens").alias("token"))
    marks = [F.bit_xor(F.xxhash64(F.lit(seed), "row")).alias(f"mark{seed}") for seed in (1, 2)]
    counts = held.groupBy("token").agg(F.count("*").alias("n"), F.count_if("bad").alias("bad"), *marks).where(F.col("bad") >= support * n)
    items = counts.groupBy("n", "mark1", "mark2").agg(F.min("token").alias("item"), F.collect_list("token").alias("tokens"))
    items = written(items.select("item", "n", "tokens"), "items")  # a URL has all tokens of an item, so an item has few
    own = held.join(items.select(F.col("item").alias("token")), "token").groupBy("row").agg(F.collect_list("token").alias("items"))
    none = F.array().cast("array<string>")
    baskets = rows.select("row", "bad").join(own, "row", "left").select(F.concat(F.coalesce("items", none), F.when(F.col("bad"), F.array(F.lit(BAD))).otherwise(none)).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(baskets)
    found = model.associationRules.where(F.array_contains("consequent", BAD)).select(F.array_sort("antecedent").alias("rule"), "confidence", "support")
    each = found.select("rule", "confidence", "support", F.explode("rule").alias("item")).join(items, "item")
    found = written(each.groupBy("rule", "confidence", "support").agg(
        F.array_sort(F.flatten(F.collect_list("tokens"))).alias("tokens"), F.min(F.struct("n", "item")).alias("rarest")), "rules")
    # a rule with a more general one at least as confident adds nothing; it holds the other's rarest item
    shared = found.select("rule", "confidence", F.explode("rule").alias("item"))
    general = found.select(F.col("rule").alias("less"), F.col("confidence").alias("as_sure"), F.col("rarest.item").alias("item"))
    covered = (shared.join(general, "item").where((F.size("less") < F.size("rule")) & (F.col("as_sure") >= F.col("confidence"))
                                                  & (F.size(F.array_except("less", "rule")) == 0)).select("rule").distinct())
    return found.join(covered, "rule", "left_anti").select(F.col("tokens").alias("rule"), "confidence", "support", F.col("rarest.item").alias("key"))


def matched(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The distinct urls of ``urls`` (url) that hold all tokens of a rule, with the surest such rule.

    An inverted index: every rule stands under its rarest token only, so a url meets few rules, and common tokens none.
    """
    tokens = urls.select("url").where("url is not null").distinct().withColumn("tokens", url_tokens(F.col("url")))
    held = tokens.select("url", "tokens", F.explode("tokens").alias("key")).join(rules, "key")
    return (held.where(F.size(F.array_except("rule", "tokens")) == 0).groupBy("url")
            .agg(F.max(F.struct("confidence", "support", "rule")).alias("best")).select("url", "best.rule", "best.confidence"))


def given_verdicts(pages: DataFrame, rules: Sequence[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, url, host, path, rule and given (verdict; null where no rule fits) for every row of ``pages``: see ``filter_urls``."""
    pages = pages.select(column(id_col).alias("page_id"), column(url_col).cast("string").alias("url"))
    host, path = F.col("host"), F.col("path")
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):  # the last that fits is the longest
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        rule, verdict = F.when(fits, rule_host + rule_path).otherwise(rule), F.when(fits, decision).otherwise(verdict)
    rows = pages.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    return rows.select("page_id", "url", "host", "path", rule.alias("rule"), verdict.alias("given"))


def filter_urls(pages: DataFrame, labelled: DataFrame, rules: Sequence[tuple[str, str, str]], support: float = SUPPORT,
                confidence: float = CONFIDENCE, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict, mined (tokens of the association rule that blocked it) for every row of ``pages``.

    ``rules`` are (verdict, host, path): a rule fits its host and all subdomains if the url's path starts with the rule's;
    the longest wins, ties by code point. Its host and path are ``rule``. Where none fits, the url is blocked if it holds all tokens of a
    mined rule, else allowed. ``labelled`` has url and bad (boolean).

    A null url, or one without ``://``, has an empty host and path and no given rule; null urls are allowed. Null and
    repeated ids give a row each; equal urls are looked up once, so a url that a third of all pages have is no burden. An
    empty table gives an empty result, empty labels no mined rules. Other columns are ignored, whatever their names.
    """
    rows = given_verdicts(pages, rules, id_col, url_col)
    best = matched(rows.select("url"), mined_rules(labelled, support, confidence)).select(F.col("url").alias("known"), F.col("rule").alias("mined"))
    rows = rows.join(best, F.col("url") == F.col("known"), "left")
    return rows.select("page_id", "host", "path", "rule", F.coalesce("given", F.when(F.col("mined").isNotNull(), "block").otherwise("allow")).alias("verdict"),
                       F.when(F.col("given").isNull(), F.col("mined")).alias("mined"))
