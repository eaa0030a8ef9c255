"""Quality rules with risk-controlled cutoffs, in DataFrame functions only.

Each rule rejects documents whose score reaches a cutoff. A cutoff is used in a
stratum (language) only if the labelled documents there prove, by an exact
binomial bound, that the rule rejects at most ``alpha / number of rules`` of
good documents: the probability of seeing as few rejected good documents as
were seen, were the true share larger, is at most ``delta / tests``, where
tests counts all strata, rules and cutoffs (Bonferroni). Over all rules and
strata together the share of falsely rejected good documents then exceeds
``alpha`` in no stratum with probability ``1 - delta``. Of a rule's proven
cutoffs the lowest is taken; a stratum without enough labels has none.
The cutoffs tried are parameters, never read off the data, so all labelled
documents serve as holdout.

Defined results: null text counts as empty: no words, base_failed. Null lang is
a stratum of its own. Labels that are null or contradict each other for one
doc_id are left out; repeated equal labels count once. Repeated document rows
are judged one by one (as holdout they count as often as they occur). Empty
tables give an empty result or no cutoffs. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringcast.session import materialize

ALPHA, DELTA = 0.02, 0.05
#: rule -> (score, cutoffs): rejected at score >= cutoff
RULES: dict[str, tuple[str, tuple[float, ...]]] = {
    "symbols": ("n_symbols / n_words", (0.1, 0.25, 0.5, 1.0, 1.5, 2.0)),
    "repeats": ("n_repeat_words / n_words", (0.02, 0.05, 0.1, 0.15)),
    "lines": ("n_dup_lines / n_lines", (0.1, 0.2, 0.3, 0.5)),
    "long_words": ("word_chars / n_words", (8.0, 10.0, 12.0, 15.0)),
    "short_words": ("-word_chars / n_words", (-3.5, -3.0, -2.5, -2.0)),
}
BREAK = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"


def features(docs: DataFrame, window: int = 5) -> DataFrame:
    """doc_id, lang, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_lines, text_key of every document."""
    d = docs.select("doc_id", "lang", F.coalesce("text", F.lit("")).alias("text"))
    d = d.select(
        "doc_id", "lang", F.xxhash64("text").alias("text_key"),
        F.filter(F.split("text", BREAK), lambda x: x != "").alias("w"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD)).alias("lines"),
        F.length(F.regexp_replace("text", BREAK, "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"))
    parts = ", ".join(f"w[i + {k}]" for k in range(window))
    d = d.select(
        "doc_id", "lang", "text_key", "word_chars", "n_symbols",
        F.size("w").cast("long").alias("n_words"), F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr(f"if(size(w) >= {window}, transform(sequence(0, size(w) - {window}), i -> xxhash64({parts})), "
               "cast(array() as array<bigint>))").alias("h"))
    # only texts with a repeated window go on: windows sorted by hash, then place
    d = d.withColumn("s", F.expr("if(size(array_distinct(h)) < size(h), "
                                 "sort_array(transform(h, (x, i) -> struct(x as x, i as i))), null)"))
    d = d.withColumn("at", F.expr(
        "if(s is null, null, sort_array(transform(filter(sequence(0, size(s) - 1), k -> "
        "(k > 0 and s[k].x = s[greatest(k - 1, 0)].x) or "
        "(k < size(s) - 1 and s[k].x = s[least(k + 1, size(s) - 1)].x)), k -> s[k].i)))"))
    covered = F.expr(
        f"if(at is null, 0L, aggregate(at, struct(0L as n, -{window}L as last), (a, i) -> "
        f"struct(a.n + least({window}L, i - a.last) as n, cast(i as bigint) as last), a -> a.n))")
    return d.select("doc_id", "lang", "text_key", "n_words", "word_chars", "n_symbols", "n_lines",
                    "n_dup_lines", covered.alias("n_repeat_words"))


def _log_factorial(x: str) -> str:
    """SQL for ln(x!), by Stirling's series eight places up."""
    z = f"({x} + 9.0D)"
    low = " + ".join(f"ln({x} + {k}.0D)" for k in range(1, 9))
    return (f"(({z} - 0.5D) * ln({z}) - {z} + 0.9189385332046727D + 1 / (12 * {z}) - 1 / (360 * power({z}, 3)) "
            f"+ 1 / (1260 * power({z}, 5)) - ({low}))")


def log_binomial_cdf(n: str, k: str, p: str) -> Column:
    """ln P(Binomial(n, p) <= k) for k < n * p, else 0. Terms are summed from k
    downward; what is left when they have become negligible is bounded by the
    geometric series of the last ratio and added."""
    ratio = f"(({k} - {{j}} + 1) * (1 - {p}) / (({n} - {k} + {{j}}) * {p}))"
    steps = f"cast(least({k}, ceil(20 * sqrt({n})) + 100) as int)"
    total = (f"if({k} < 1, 1.0D, aggregate(sequence(1, greatest({steps}, 1)), struct(1.0D as s, 1.0D as t), "
             f"(a, j) -> struct(a.s + a.t * {ratio.format(j='j')} as s, a.t * {ratio.format(j='j')} as t), "
             f"a -> a.s + if({steps} < {k}, a.t / (1 - (1 - {p}) * {k} / (({n} - {k} + 1) * {p})), 0.0D)))")
    top = (f"{_log_factorial(n)} - {_log_factorial(k)} - {_log_factorial(f'({n} - {k})')} "
           f"+ {k} * ln({p}) + ({n} - {k}) * ln(1 - {p})")
    return F.expr(f"if({k} < {n} * {p}, {top} + ln({total}), 0.0D)")


def stratum() -> Column:
    """A language's key; null and the empty string are strata of their own."""
    return F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("-"))


def scores() -> list[Column]:
    """Each rule's score, null where it has none (no words, no lines)."""
    return [F.expr(f"{s.replace(' / ', ' / nullif(')}, 0)").cast("double").alias(rule)
            for rule, (s, _) in RULES.items()]


def cutoffs(found: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """One row per stratum with labels: stratum and, for each rule, its cutoff or null."""
    known = labels.filter("quality is not null and doc_id is not null").groupBy("doc_id") \
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("other")).filter("quality = other")
    held = found.join(known.select("doc_id", "quality"), "doc_id") \
        .select(stratum().alias("stratum"), "quality", *scores())
    counts = [F.count_if(F.col("quality") == 1).alias("n")]
    tries = [(rule, c) for rule, (_, values) in RULES.items() for c in values]
    for i, (rule, c) in enumerate(tries):
        hit = F.coalesce(F.col(rule) >= F.lit(c), F.lit(False))
        counts += [F.count_if((F.col("quality") == 1) & hit).alias(f"good_{i}"),
                   F.count_if((F.col("quality") == 0) & hit).alias(f"bad_{i}")]
    held = materialize(held.groupBy("stratum").agg(*counts), "rules-counts")
    tests = max(1, held.count()) * len(tries)
    rows = held.select("stratum", "n", F.explode(F.array(*(
        F.struct(F.lit(rule).alias("rule"), F.lit(float(c)).alias("cutoff"), F.col(f"good_{i}").alias("k"),
                 F.col(f"bad_{i}").alias("bad")) for i, (rule, c) in enumerate(tries)))).alias("x")) \
        .select("stratum", F.col("n").cast("double").alias("n"), "x.rule", "x.cutoff",
                F.col("x.k").cast("double").alias("k"), "x.bad")
    share = f"{alpha / len(RULES)!r}D"
    proven = rows.filter("bad > 0").filter(log_binomial_cdf("n", "k", share) <= F.log(F.lit(delta / tests)))
    return proven.groupBy("stratum").agg(*(
        F.min(F.when(F.col("rule") == rule, F.col("cutoff"))).alias("cut_" + rule) for rule in RULES))


def quality_rules(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA,
                  min_words: int = 10, max_repeat_percent: int = 20) -> DataFrame:
    """doc_id, n_words, the base measures, base_failed, kept, and text_key."""
    found = materialize(features(docs), "rules-features")
    cut = cutoffs(found, labels, alpha, delta)
    wide = found.withColumn("stratum", stratum()).join(cut, "stratum", "left")
    failed = F.expr(f"n_words < {min_words} or 100 * n_repeat_words > {max_repeat_percent} * n_words")
    hit = F.lit(False)
    for score, rule in zip(scores(), RULES):
        hit = hit | F.coalesce(score >= F.col("cut_" + rule), F.lit(False))
    return wide.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       failed.alias("base_failed"), (~failed & ~hit).alias("kept"), "text_key")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the rules keep, all columns as they are."""
    verdict = quality_rules(docs, labels).filter("kept").select("doc_id", "text_key").distinct()
    key = F.xxhash64(F.coalesce(docs.text, F.lit("")))
    return docs.join(verdict, docs.doc_id.eqNullSafe(verdict.doc_id) & (key == verdict.text_key), "left_semi")


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, lang, t, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
      list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
win AS (SELECT doc_id, i, [w[i], w[i+1], w[i+2], w[i+3], w[i+4]] AS g
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 5)),
hit AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1),
cover AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM hit) GROUP BY 1),
f AS (SELECT w.doc_id, lang, len(w)::BIGINT AS n_words,
      length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
      (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
      (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, len(l) AS n_lines,
      coalesce(n, 0)::BIGINT AS n_repeat_words FROM w LEFT JOIN cover USING (doc_id)),
s AS (SELECT *, coalesce('=' || lang, '-') AS stratum, SCORES FROM f),
rules(rule, cutoff) AS (VALUES VALUES_LIST),
known AS (SELECT doc_id, min(quality) AS quality FROM labels WHERE quality IS NOT NULL GROUP BY 1
          HAVING min(quality) = max(quality)),
x AS (SELECT stratum, quality, unnest(RULE_NAMES) AS rule, unnest(RULE_COLUMNS) AS score FROM s JOIN known USING (doc_id)),
c AS (SELECT stratum, r.rule, r.cutoff, count(*) FILTER (quality = 1) AS n,
      count(*) FILTER (quality = 1 AND score >= cutoff) AS k, count(*) FILTER (quality = 0 AND score >= cutoff) AS bad
      FROM x JOIN rules r USING (rule) GROUP BY ALL),
m AS (SELECT count(*) AS tests FROM c),
p AS (SELECT stratum, rule, min(cutoff) AS cutoff FROM c, m WHERE bad > 0 AND k < n * SHARE AND list_sum(list_transform(
      range(0, k + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(SHARE) + (n - i) * ln(1 - SHARE))))
      <= DELTA / tests GROUP BY ALL),
j AS (SELECT s.doc_id, bool_or(ROW_HIT) AS hit FROM s JOIN p USING (stratum) GROUP BY 1),
b AS (SELECT s.*, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed, coalesce(hit, FALSE) AS hit
      FROM s LEFT JOIN j USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT hit AS kept
FROM b"""


def oracle_sql() -> str:
    """The DuckDB form, with the production rules written in."""
    div = {r: s.replace(" / ", " / nullif(") + ", 0)" for r, (s, _) in RULES.items()}
    hit = " OR ".join(f"(rule = '{r}' AND s.{r} >= cutoff)" for r in RULES)
    return (ORACLE_SQL.replace("SCORES", ", ".join(f"{s} AS {r}" for r, s in div.items()))
            .replace("VALUES_LIST", ", ".join(f"('{r}', {c}::DOUBLE)" for r, (_, cs) in RULES.items() for c in cs))
            .replace("RULE_NAMES", str(list(RULES))).replace("RULE_COLUMNS", "[" + ", ".join(RULES) + "]")
            .replace("SHARE", f"{ALPHA / len(RULES)!r}::DOUBLE").replace("DELTA", repr(DELTA)).replace("ROW_HIT", hit))
