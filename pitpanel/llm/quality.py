"""Quality rules whose cutoffs are chosen under a bound on false rejection, with Spark expressions only.

Labelled documents are the holdout. For each stratum (language) and rule, candidate cutoffs form a fixed grid; a cutoff is
admissible if the number k of good documents it rejects, out of n good ones, would be at most that low with probability
delta / m or less were the true share of rejected good documents `risk` / 3 or more (exact binomial tail; m = all tests
over all strata, rules and cutoffs: Bonferroni). As each of the three rules keeps to a third of `risk`, all of them together
reject at most `risk` of a stratum's good documents (those that pass the base rule), with probability 1 - delta. That takes
at least log(m / delta) / -log(1 - risk / 3) good labels, about 1150 with the defaults and four strata; a stratum with fewer
keeps to the base rule. Of a rule's admissible cutoffs, the one that rejects the most bad holdouts less good ones is used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitpanel.llm.shared import SPACE, WORD, cut

SYMBOLS = r"[#*$%&|<>]"
#: Rule -> (numerator, denominator, grid of cutoffs in percent); a document with a greater percentage is rejected.
RULES = {
    "symbols": ("n_symbols", "word_chars", (0.1, 0.25, 0.5, 1, 2, 3, 5, 8, 12, 20, 30)),
    "dup_lines": ("n_dup_lines", "n_lines", (5, 10, 15, 20, 30, 40, 50, 60, 75)),
    "repeats": ("n_repeat_words", "n_words", (1, 2, 5, 10, 15, 20, 30, 40)),
}


def measures(docs: DataFrame) -> DataFrame:
    """docs -> its columns, n_words, word_chars, n_symbols, n_lines (with a word), n_dup_lines, n_repeat_words (all long)."""
    d = docs.withColumn("_t", F.coalesce("text", F.lit("")))
    d = d.withColumn("_w", F.regexp_extract_all("_t", F.lit(WORD), F.lit(0)))
    d = d.withColumn("_l", F.filter(F.split("_t", "\n", -1), lambda x: x.rlike(WORD)))
    # 3-word windows as (hash, place), ordered; equal hashes stand side by side
    triple = F.slice(F.transform("_w", lambda w, i: F.struct(
        F.xxhash64(w, F.get(F.col("_w"), i + 1), F.get(F.col("_w"), i + 2)).alias("h"), i.alias("i")
    )), 1, F.greatest(F.size("_w") - 2, F.lit(0)))
    d = d.withColumn("_s", F.array_sort(triple))
    d = d.withColumn("_p", F.array_sort(F.transform(F.filter(F.col("_s"), lambda x, k: (
        (x["h"] == F.get(F.col("_s"), k - 1)["h"]) | F.coalesce(x["h"] == F.get(F.col("_s"), k + 1)["h"], F.lit(False))
    )), lambda x: x["i"])))
    covered = F.aggregate("_p", F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")), lambda a, p: F.struct(
        (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last")
    ))["n"]
    return d.select(
        *docs.columns,
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.regexp_replace("_t", SPACE, "")).cast("long").alias("word_chars"),
        F.regexp_count("_t", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.size("_l").cast("long").alias("n_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def percent(rule: str) -> Column:
    over, of, _ = RULES[rule]
    return F.when(F.col(of) > 0, 100.0 * F.col(over) / F.col(of)).otherwise(F.lit(0.0))


def log_binomial_tail(k: Column, n: Column, p: float) -> Column:
    """log P(X <= k) of Binomial(n, p), its terms summed in logs from the first."""
    step = F.log(F.lit(p / (1 - p)))
    return F.aggregate(
        F.sequence(F.lit(0).cast("long"), k),
        F.struct(F.lit(0.0).alias("term"), F.lit(float("-inf")).alias("sum")),
        lambda a, i: F.struct(
            _term(a["term"], i, n, p, step).alias("term"),
            _add(a["sum"], _term(a["term"], i, n, p, step)).alias("sum"),
        ),
    )["sum"]


def _term(last: Column, i: Column, n: Column, p: float, step: Column) -> Column:
    return F.when(i == 0, n * F.log(F.lit(1 - p))).otherwise(last + F.log((n - i + 1) / i) + step)


def _add(x: Column, y: Column) -> Column:
    top = F.greatest(x, y)
    return top + F.log(F.exp(x - top) + F.exp(y - top))


def cutoffs(labelled: DataFrame, strata: str, risk: float, delta: float) -> DataFrame:
    """(stratum, quality, measures) -> stratum, rule, cutoff, n good, k good rejected, b others rejected, admissible: all tests."""
    grid = F.explode(F.array(*(
        F.struct(F.lit(r).alias("rule"), percent(r).alias("value"), F.array(*(F.lit(float(c)) for c in g)).alias("grid"))
        for r, (_, _, g) in RULES.items()
    )))
    rows = labelled.select(F.col(strata).alias("stratum"), (F.col("quality") == 1).alias("good"), grid.alias("r"))
    over = F.col("value") > F.col("cutoff")
    tests = rows.select("stratum", "good", "r.rule", "r.value", F.explode("r.grid").alias("cutoff")).groupBy("stratum", "rule", "cutoff").agg(
        F.count_if("good").alias("n"), F.count_if(F.col("good") & over).alias("k"), F.count_if(~F.col("good") & over).alias("b")
    )
    m = tests.agg(F.count("*").alias("m"))
    tests = tests.crossJoin(F.broadcast(m))  # one row
    # a share of rejected above `risk` is never admissible, which also bounds the terms
    risk = risk / len(RULES)
    return tests.withColumn("admissible", F.when(F.col("k") < risk * F.col("n"), log_binomial_tail(F.col("k"), F.col("n"), risk) <= F.log(F.lit(delta) / F.col("m"))).otherwise(False))


def apply_rules(docs: DataFrame, labels: DataFrame, strata: str = "lang", risk: float = 0.02, delta: float = 0.05) -> DataFrame:
    """docs, labels(doc_id, quality) -> the measures of docs, base_failed, kept.

    Null texts count as empty; rows of a stratum without admissible cutoffs (also a null one) fall back on the base rule;
    repeated labels of a document count once, as bad if any of them is (trials must be independent); null labels and labels
    without a document are ignored.
    """
    found = cut(measures(docs).drop("text"), "measures")
    known = labels.where("quality is not null").groupBy(F.col("doc_id").alias("_id")).agg(F.min("quality").alias("quality"))
    labelled = found.where(~base_failed()).join(known, found.doc_id == F.col("_id"))
    chosen = cutoffs(labelled, strata, risk, delta).where("admissible and b > k").groupBy("stratum", "rule").agg(F.max_by("cutoff", F.struct(F.col("b") - F.col("k"), "cutoff")).alias("cutoff"))
    chosen = chosen.groupBy("stratum").pivot("rule", list(RULES)).agg(F.first("cutoff"))
    chosen = cut(chosen.withColumnsRenamed({r: f"_{r}" for r in RULES}), "cutoffs")
    few = chosen.limit(100_001).count() <= 100_000  # rows by stratum
    out = found.join(F.broadcast(chosen) if few else chosen, found[strata].eqNullSafe(chosen["stratum"]), "left")
    bad = base_failed()
    for r in RULES:
        bad = bad | F.coalesce(percent(r) > F.col(f"_{r}"), F.lit(False))
    return out.select(*[c for c in found.columns], base_failed().alias("base_failed"), (~bad).alias("kept")).drop(strata)


def keep_good(docs: DataFrame, labels: DataFrame, strata: str = "lang", risk: float = 0.02, delta: float = 0.05) -> DataFrame:
    """The rows of docs that are kept, with their columns, whatever their names. Equal ids with different texts are judged one by one."""
    rows = docs.select(F.struct("*").alias("row"), "doc_id", F.xxhash64("text").alias("h"))
    judged = apply_rules(docs.select("doc_id", "text", strata, F.xxhash64("text").alias("h")), labels, strata, risk, delta)
    bad = judged.where("not kept").select("doc_id", "h").distinct()
    on = F.col("d.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("d.h") == F.col("b.h"))
    return rows.alias("d").join(bad.alias("b"), on, "left_anti").select("d.row.*")
