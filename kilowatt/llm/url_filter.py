"""URL filter: host and path rules, and for all other URLs the ratio of two
character language models. DataFrame functions only."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kilowatt.llm.shared import dealt, stored

#: (verdict, host and path prefix) of the rules that the query applies (fixed values).
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
#: Symbols of the models; any other character counts as ``*``, and ``^`` and ``$``
#: mark start and end.
_SYMBOLS = string.ascii_lowercase + string.digits + "./-_%~"
_ALL = "*^$" + _SYMBOLS


def host(url: Column) -> Column:
    """From behind the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; null or no ``://``: empty."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, string.ascii_uppercase, string.ascii_lowercase)


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(rules: tuple[tuple[str, str], ...], host_col: Column, path_col: Column) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none does. A rule
    fits its host and all subdomains where the path starts with the rule's."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, text in sorted(rules, key=lambda r: len(r[1])):
        name, _, rest = text.partition("/")
        fits = ((host_col == name) | host_col.endswith("." + name)) & path_col.startswith("/" + rest)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def _grams(text: Column) -> Column:
    """The text's character triples: two symbols of context and the symbol after
    them, from the first character (after start marks) to the end mark."""
    plain = F.regexp_replace(F.lower(text), r"(?s)[^a-z0-9./\-_%~]", "*")
    return F.regexp_extract_all(F.concat(F.lit("^^"), plain, F.lit("$")), F.lit("(?=(...))"), F.lit(1))


def _models(grams: DataFrame) -> DataFrame:
    """``grams(gram, kind)`` → ``(gram, ratio)`` for every possible triple:
    log probability under the accepted minus that under the rejected model.

    Either is a Markov model of variable order: counts of two, one and no
    symbols of context are interpolated, each order weighing as much as the
    number of different symbols seen after its context says (Witten-Bell); an
    unseen context leaves the shorter one. The table has as many rows as there
    are triples of symbols (91,125), whatever the input.
    """
    n = grams.groupBy("gram").agg(*[F.count_if(F.col("kind") == k).alias(k) for k in ("allow", "block")])
    symbol = lambda c: F.explode(F.array(*map(F.lit, _ALL))).alias(c)
    full = grams.sparkSession.range(1).select(symbol("a")).select("a", symbol("b")).select("a", "b", symbol("c"))
    table = stored(full.withColumn("gram", F.concat("a", "b", "c")).join(n, "gram", "left").na.fill(0, ["allow", "block"]), "triples")
    pairs = table.groupBy("b", "c").agg(*[F.sum(k).alias(k) for k in ("allow", "block")])
    singles = table.groupBy("c").agg(*[F.sum(k).alias(k) for k in ("allow", "block")])

    def context(rows: DataFrame, keys: list[str], level: int) -> DataFrame:
        return rows.groupBy(*keys).agg(*[x for k in ("allow", "block") for x in (
            F.sum(k).alias(f"{k}_n{level}"), F.count_if(F.col(k) > 0).alias(f"{k}_t{level}"))])

    total = context(singles, [], 0).first()
    rows = table.withColumnsRenamed({"allow": "allow_2", "block": "block_2"}).withColumns({c: F.lit(total[c]) for c in total.asDict()})
    rows = rows.join(pairs.withColumnsRenamed({"allow": "allow_1", "block": "block_1"}), ["b", "c"])
    rows = rows.join(singles.withColumnsRenamed({"allow": "allow_0", "block": "block_0"}), "c")
    rows = rows.join(context(table, ["a", "b"], 2), ["a", "b"]).join(context(pairs, ["b"], 1), "b")

    def probability(kind: str) -> Column:
        p = F.lit(1.0 / len(_ALL))
        for level in range(3):
            hits, n, t = (F.col(f"{kind}_{x}") for x in (level, f"n{level}", f"t{level}"))
            p = F.when(n > 0, (hits + t * p) / (n + t)).otherwise(p)
        return p

    return rows.select("gram", (F.log(probability("allow")) - F.log(probability("block"))).alias("ratio"))


def _threshold(scores: DataFrame) -> float:
    """The score from which on URLs are accepted: of all limits (in hundredths),
    the one with the best balance of accepted kept and rejected blocked, in the
    middle between the scores on its two sides. Both kinds must occur,
    otherwise everything is accepted."""
    bins = scores.select(F.greatest(F.lit(-2000), F.least(F.lit(2000), F.floor(F.col("score") * 100))).alias("bin"), "kind")
    bins = bins.groupBy("bin").agg(F.count_if(F.col("kind") == "allow").alias("a"), F.count_if(F.col("kind") == "block").alias("b"))
    before = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)  # 4,001 rows at most
    rows = bins.select("bin", F.coalesce(F.lag("bin").over(Window.orderBy("bin")) + 1, "bin").alias("below"), F.coalesce(F.sum("a").over(before), F.lit(0)).alias("lost"), F.coalesce(F.sum("b").over(before), F.lit(0)).alias("caught"),
                       F.sum("a").over(Window.partitionBy()).alias("all_a"), F.sum("b").over(Window.partitionBy()).alias("all_b"))
    best = rows.filter("all_a > 0 and all_b > 0").orderBy((F.col("caught") / F.col("all_b") - F.col("lost") / F.col("all_a")).desc(), "bin").first()
    return (best["below"] + best["bin"]) / 200 if best else float("-inf")


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: tuple[tuple[str, str], ...] = RULES) -> DataFrame:
    """One row per row of ``pages``: ``id_col``, ``host``, ``path``, ``rule``,
    ``verdict``, ``score``.

    The URLs that a rule decides are the examples: four fifths of them (by hash)
    give the counts of an accepted and a rejected model, one fifth the
    threshold. All others get the mean log ratio of their host's and path's
    characters and are accepted from the threshold on. Different URLs are judged
    once; a URL with many rows meets its verdict in a join whose sides can both
    be split. Null URLs are judged as empty ones. Without examples of both
    kinds, what no rule decides is allowed. Repeated rows get the same verdict.
    """
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"))
    urls = rows.select("url").distinct().select("url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    rule, says = rule_of(rules, F.col("host"), F.col("path"))
    urls = stored(urls.withColumn("rule", rule).withColumn("says", says).withColumn(
        "example", F.col("rule").isNotNull() & (F.pmod(F.xxhash64("url"), F.lit(5)) != 0)), "urls")
    text = F.concat("host", "path")
    ratios = stored(_models(dealt(urls.filter("example"), "url").select(F.explode(_grams(text)).alias("gram"), F.col("says").alias("kind"))), "ratios")
    spread = dealt(urls.filter("not example"), "url").select("url", "says", F.explode(_grams(text)).alias("gram"))
    scores = stored(spread.join(F.broadcast(ratios), "gram").groupBy("url", "says").agg(F.avg("ratio").alias("score")).select(
        F.col("url").alias("scored_url"), F.col("says").alias("kind"), "score"), "scores")
    limit = _threshold(scores.filter("kind is not null"))
    judged = urls.join(scores, F.col("url").eqNullSafe(F.col("scored_url")), "left").select(
        F.col("url").alias("judged_url"), "host", "path", "rule", F.coalesce("says", F.when(
            F.col("score") < F.lit(limit), "block").otherwise("allow")).alias("verdict"), F.when(F.col("rule").isNull(), F.col("score")).alias("score"))
    judged = stored(judged, "judged")
    return rows.join(judged, F.col("url").eqNullSafe(F.col("judged_url"))).select(
        F.col("id").alias(id_col), "host", "path", "rule", "verdict", "score")
