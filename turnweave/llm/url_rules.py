"""URL filters: a rule list first, then association rules mined by FP-growth.

A URL is a set of tokens: the labels of its host with what they belong to, its path segments, the keys of its
query. From labelled URLs Spark's FP-growth mines the token combinations that go with the label "block" by
minimum support and confidence. Rules that say no more than a shorter one are pruned. The rest is matched
through an inverted index: a rule stands under its rarest token, and a URL only tries the rules under tokens
it has.

Tokens that always go together, as those of a URL template do, are mined as one, since a minimal rule never has two
of them; each rule then stands for every choice among them. Their itemsets would double with each token.

Pruning is a join over the tasks, with support and confidence as given. Up to ``MAX_RULES`` minimal rules are
broadcast as an index; if there are more, they stay a table and are matched by a join on the indexed token.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import batched, product

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

MIN_SUPPORT, MIN_CONFIDENCE, MAX_ITEMS, MAX_RULES = 0.002, 0.8, 5, 100_000
#: Rules of an Arrow batch.
EXPAND_ROWS = 10_000
BLOCK, ALLOW = "block", "allow"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, _PARTS, 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def tokens_of(url: Column) -> Column:
    """The distinct tokens of a URL; numbers inside tokens count as one digit."""
    plain = lambda x: F.regexp_replace(x, "[0-9]+", "0")
    host, path = host_of(url), path_of(url)
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    ends = F.when(host != "", F.array(F.concat(F.lit("end:"), F.regexp_extract(host, r"([^.]*)$", 1)), F.concat(F.lit("site:"), plain(F.regexp_extract(host, r"([^.]*\.[^.]*)$", 1))))).otherwise(F.array().cast("array<string>"))
    segments = F.transform(F.filter(F.split(path, "/"), lambda x: x != ""), lambda x: F.concat(F.lit("path:"), plain(x)))
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^[^?#]*\?([^#]*)", 1)
    keys = F.transform(F.filter(F.split(query, "&"), lambda x: x != ""), lambda x: F.concat(F.lit("key:"), plain(F.regexp_extract(x, r"(?s)^([^=]*)", 1))))
    return F.array_distinct(F.concat(F.transform(labels, lambda x: F.concat(F.lit("host:"), plain(x))), ends, segments, keys))


def listed_rule(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule (``host/path`` prefix) that fits a host or its parent domains; null if none does."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        domain, _, rest = rule.partition("/")
        fits = ((host == domain) | F.endswith(host, F.lit("." + domain))) & F.startswith(path, F.lit("/" + rest))
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def mine_rules(labelled: DataFrame, url: str = "url", blocked: str = "blocked", min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, max_items: int = MAX_ITEMS, max_rules: int = MAX_RULES) -> list[tuple[frozenset[str], float]] | DataFrame:
    """(tokens, confidence) of the minimal rules for "block", mined from rows with a label; null labels are left out.

    Over ``max_rules`` of them are returned as a table ``tokens, confidence``.
    """
    from pyspark.ml.fpm import FPGrowth

    items = labelled.where(F.col(blocked).isNotNull()).select(F.concat(tokens_of(F.col(url)), F.array(F.when(F.col(blocked), BLOCK).otherwise(ALLOW))).alias("items")).persist()
    try:
        n = items.count()
        if not n:
            return []
        classes = always_together(items, min_support * n)
        model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(one_of_each(items, classes))
        rules = model.associationRules.where((F.element_at("consequent", 1) == BLOCK) & (F.size("antecedent") <= max_items))
        rules = rules.where(~F.array_contains("antecedent", ALLOW)).select(F.array_sort("antecedent").alias("tokens"), "confidence")
        rules = materialize(minimal(materialize(rules, "rules")), "minimal-rules")
        if classes:
            rules = materialize(with_each(rules, classes), "expanded-rules")
        rows = rules.limit(max_rules + 1).collect()
        return rules if len(rows) > max_rules else pruned([(frozenset(r["tokens"]), r["confidence"]) for r in rows])
    finally:
        items.unpersist()


def always_together(items: DataFrame, least: float) -> dict[str, list[str]]:
    """Tokens of at least ``least`` rows that stand in exactly the same rows: the first of them to all of them.

    Rows are told apart by two 64-bit hashes, of which a token has the sums. What is collected is bounded by the mean
    number of tokens over the support.
    """
    hashes = (F.xxhash64(F.lit(seed), "items").cast("decimal(20,0)").alias(f"h{seed}") for seed in (0, 1))
    rows = items.select(F.explode("items").alias("token"), *hashes).where(~F.col("token").isin(BLOCK, ALLOW))
    frequent = rows.groupBy("token").agg(F.count("*").alias("n"), F.sum("h0").alias("h0"), F.sum("h1").alias("h1")).where(F.col("n") >= least)
    classes = frequent.groupBy("n", "h0", "h1").agg(F.sort_array(F.collect_list("token")).alias("tokens")).where(F.size("tokens") > 1)
    return {r["tokens"][0]: r["tokens"] for r in classes.select("tokens").collect()}


def one_of_each(items: DataFrame, classes: dict[str, list[str]]) -> DataFrame:
    """``items`` with the first token of each class only; no minimal rule needs two of a class."""
    if not classes:
        return items
    others = items.sparkSession.sparkContext.broadcast(frozenset(t for c in classes.values() for t in c[1:]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [[t for t in row if t not in others.value] for row in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(kept, pa.list_(pa.string()))], ["items"])

    return items.mapInArrow(run, "items array<string>")


def with_each(rules: DataFrame, classes: dict[str, list[str]]) -> DataFrame:
    """Each rule over first tokens once for every choice of a token of their classes."""
    members = rules.sparkSession.sparkContext.broadcast(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tokens, confidence in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for part in batched(product(*(members.value.get(t, (t,)) for t in tokens)), EXPAND_ROWS):
                    yield pa.RecordBatch.from_arrays([pa.array(map(sorted, part), pa.list_(pa.string())), pa.array([confidence] * len(part), pa.float64())], ["tokens", "confidence"])

    return rules.select("tokens", "confidence").mapInArrow(run, "tokens array<string>, confidence double")


def minimal(rules: DataFrame) -> DataFrame:
    """``tokens`` (sorted), ``confidence`` without the rules that have all tokens of a shorter one and no more confidence."""
    parts = F.expr("transform(sequence(1L, shiftleft(1L, size(tokens)) - 2), m -> filter(tokens, (x, i) -> getbit(m, i) = 1))")
    part = rules.where(F.size("tokens") > 1).select(F.col("tokens").alias("whole"), F.col("confidence").alias("c"), F.explode(parts).alias("tokens"))
    less = part.join(rules, "tokens").where("confidence >= c").select(F.col("whole").alias("tokens")).distinct()
    return rules.join(less, "tokens", "left_anti").select("tokens", "confidence")


def pruned(rules: list[tuple[frozenset[str], float]]) -> list[tuple[frozenset[str], float]]:
    """Rules without those that have all tokens of a shorter rule and no more confidence."""
    kept: list[tuple[frozenset[str], float]] = []
    index: dict[str, list[int]] = {}
    for tokens, confidence in sorted(rules, key=lambda r: (len(r[0]), sorted(r[0]))):
        if any(kept[k][0] <= tokens and kept[k][1] >= confidence for t in tokens for k in index.get(t, ())):
            continue
        for t in tokens:
            index.setdefault(t, []).append(len(kept))
        kept.append((tokens, confidence))
    return kept


def inverted_index(rules: list[tuple[frozenset[str], float]]) -> dict[str, list[tuple[frozenset[str], float]]]:
    """Each rule under the token that the fewest rules have."""
    uses = Counter(t for tokens, _ in rules for t in tokens)
    index: dict[str, list[tuple[frozenset[str], float]]] = {}
    for tokens, confidence in rules:
        index.setdefault(min(tokens, key=lambda t: (uses[t], t)), []).append((tokens, confidence))
    return index


def best_confidence(tokens: list[str], index: dict[str, list[tuple[frozenset[str], float]]]) -> float | None:
    """Of the rules whose tokens are all there, the highest confidence."""
    have = set(tokens)
    return max((c for t in have for rule, c in index.get(t, ()) if rule <= have), default=None)


def matched(urls: DataFrame, mined: DataFrame) -> DataFrame:
    """``urls`` with ``confidence``: the best of the rules of a table whose tokens are all there."""
    of = mined.select(F.explode("tokens").alias("token"), F.col("tokens").alias("needed"), F.col("confidence").alias("c"))
    uses = of.groupBy("token").agg(F.count("*").alias("uses"))
    index = of.join(uses, "token").groupBy("needed", "c").agg(F.min(F.struct("uses", "token"))["token"].alias("token"))
    have = urls.select("tokens").distinct().select("tokens", F.explode("tokens").alias("token"))
    best = have.join(materialize(index, "rule-index"), "token").where(F.size(F.array_except("needed", "tokens")) == 0)
    return urls.join(best.groupBy("tokens").agg(F.max("c").alias("confidence")), "tokens", "left")


def judge_urls(df: DataFrame, rules: dict[str, str], mined: list[tuple[frozenset[str], float]] | DataFrame, key: str = "page_id", url: str = "url") -> DataFrame:
    """``key, host, path, rule, confidence, verdict`` of every row.

    A rule of the list decides; where none fits, a mined rule that matches blocks and else the row is allowed. A
    null url, or one without ``://``, has empty host and path, fits no rule and is allowed. Repeated rows stay.
    """
    out = df.select(F.col(key).alias("key"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"), tokens_of(F.col(url)).alias("tokens"))
    out = out.withColumn("rule", listed_rule(F.col("host"), F.col("path"), rules))
    if isinstance(mined, DataFrame):
        verdict = F.when(F.col("confidence").isNull(), ALLOW).otherwise(BLOCK)
        for rule, listed in rules.items():
            verdict = F.when(F.col("rule") == rule, listed).otherwise(verdict)
        return matched(out, mined).select(F.col("key").alias(key), "host", "path", "rule", "confidence", verdict.alias("verdict"))
    shared = df.sparkSession.sparkContext.broadcast(inverted_index(mined))
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            best, verdicts = [], []
            for tokens, rule in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
                c = best_confidence(tokens, index)
                best.append(c)
                verdicts.append(rules[rule] if rule is not None else ALLOW if c is None else BLOCK)
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in (0, 1, 2, 4)), pa.array(best, pa.float64()), pa.array(verdicts, pa.string())], ["key", "host", "path", "rule", "confidence", "verdict"])

    return out.mapInArrow(run, f"key {kind}, host string, path string, rule string, confidence double, verdict string").withColumnRenamed("key", key)
