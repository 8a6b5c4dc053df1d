"""Weak supervision of text quality: rules vote or abstain, EM estimates how far each can be trusted.

DataFrame functions only. All features of a text are computed inside its own row, so nothing is
shuffled but the counts of vote patterns (at most 3 ** len(RULES) of them, whatever the input).

Defined results: a null or empty text has no words and base_failed is true; a null doc_id is kept as
it is; repeated rows give repeated results; an empty table gives an empty result; other columns of
the input are ignored. Windows are compared by a 64-bit hash within one document.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from .common import materialise, words

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

#: name -> (SQL for a vote against or none, SQL for a vote in favour or none); a text that fits neither is an abstention.
RULES = {
    "symbols": ("n_symbols * 30 > word_chars", None),
    "symbol_words": ("n_symbol_words * 10 > n_words", None),
    "letters": ("n_other * 20 > word_chars * 3", "n_other * 10 <= word_chars"),
    "marks": ("n_marks * 4 > n_words", None),
    "capitals": ("n_capitals * 5 > 2 * word_chars", None),
    "repeats": ("n_repeat_words * 5 > n_words", None),
    "lines": ("n_dup_lines > 1 and n_dup_lines * 4 > n_lines", None),
    "word_length": ("word_chars > 14 * n_words or word_chars < 2 * n_words", "word_chars between 3 * n_words and 9 * n_words"),
    "ends": ("n_ends = 0 or n_ends * 3 > n_words", "n_ends between 1 and n_words / 4"),
}


def base_features(docs: DataFrame, text: str = "text") -> DataFrame:
    """Append n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed and what the rules read."""
    t = F.coalesce(F.col(text), F.lit(""))
    out = docs.withColumn("_w", words(F.col(text))).withColumn("_l", F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    after = ", ".join(f"_w[i + {k}]" for k in range(1, WINDOW))
    out = out.withColumn("_h", F.expr(f"case when size(_w) > {WINDOW} then transform(slice(_w, 1, size(_w) - {WINDOW - 1}), (x, i) -> xxhash64(x, {after})) else cast(array() as array<bigint>) end"))
    # A text whose windows all differ is done; the others sort their windows and look at neighbours.
    out = out.withColumn("_s", F.expr("case when size(array_distinct(_h)) < size(_h) then sort_array(transform(_h, (h, i) -> struct(h as h, i as i))) end"))
    out = out.withColumn("_p", F.expr("case when _s is null then cast(array() as array<int>) else sort_array(transform(filter(_s, (x, k) -> (k > 0 and get(_s, k - 1).h = x.h) or get(_s, k + 1).h <=> x.h), x -> x.i)) end"))
    out = out.select(
        *docs.columns,
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.regexp_count(t, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.expr(f"aggregate(_p, struct(0 as at, 0L as n), (a, p) -> struct(p + {WINDOW} as at, a.n + {WINDOW} - greatest(0, a.at - p) as n)).n").alias("n_repeat_words"),
        F.size("_l").cast("long").alias("n_lines"),
        F.regexp_count(t, F.lit(r"\p{Lu}")).cast("long").alias("n_capitals"),
        F.regexp_count(t, F.lit(r"[.?!]")).cast("long").alias("n_ends"),
        F.regexp_count(t, F.lit(r"[?!]")).cast("long").alias("n_marks"),
        F.regexp_count(t, F.lit(r"[^\p{L}\x20\x09-\x0D]")).cast("long").alias("n_other"),  # characters of words that are no letters
        F.when(t.rlike(r"[#*$%&|<>]"), F.size(F.filter("_w", lambda w: w.rlike(r"[#*$%&|<>]")))).otherwise(0).cast("long").alias("n_symbol_words"),
    )
    return out.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def votes() -> Column:
    """One character for each rule: '-' against, '+' in favour, '0' abstains."""
    return F.concat(*(F.expr(f"case when {bad or 'false'} then '-' when {good or 'false'} then '+' else '0' end") for bad, good in RULES.values()))


#: What is believed of a rule before any text is seen, as rates of its votes on good and on bad texts, and with the weight of how
#: many texts. It says which class is the good one, and nothing else is held fixed.
PRIOR = {"good": {"-": 0.01, "+": 0.7}, "bad": {"-": 0.3, "+": 0.4}}
PRIOR_TEXTS, PRIOR_SHARE = 20, 0.9


def fit_label_model(patterns: dict[str, int], rounds: int = 200) -> tuple[float, list[dict[str, float]]]:
    """EM over counts of vote patterns (Dawid and Skene): the share of good texts, and for each rule
    the log odds that each of its votes, and its abstaining, give for a good text.

    A rule that fires where others do earns weight; one that fires alone among texts that all others take for good loses it.
    """
    rates = {c: [dict(PRIOR[c]) for _ in RULES] for c in PRIOR}
    share, total = PRIOR_SHARE, sum(patterns.values())
    for _ in range(rounds if total else 0):
        weights = log_odds(rates)
        seen = {c: [dict.fromkeys("-+", 0.0) for _ in RULES] for c in PRIOR}
        good = 0.0
        for pattern, n in patterns.items():
            p = posterior(pattern, share, weights)
            good += n * p
            for j, v in enumerate(pattern):
                if v != "0":
                    seen["good"][j][v] += n * p
                    seen["bad"][j][v] += n * (1 - p)
        share = (good + PRIOR_TEXTS * PRIOR_SHARE) / (total + PRIOR_TEXTS)
        for c, n in (("good", good), ("bad", total - good)):
            rates[c] = [{v: (x[v] + PRIOR_TEXTS * PRIOR[c][v]) / (n + PRIOR_TEXTS) for v in "-+"} for x in seen[c]]
    return share, log_odds(rates)


def log_odds(rates: dict[str, list[dict[str, float]]]) -> list[dict[str, float]]:
    return [{"-": math.log(g["-"] / b["-"]), "+": math.log(g["+"] / b["+"]), "0": math.log((1 - g["-"] - g["+"]) / (1 - b["-"] - b["+"]))} for g, b in zip(rates["good"], rates["bad"])]


def posterior(pattern: str, share: float, weights: list[dict[str, float]]) -> float:
    odds = math.log(share / (1 - share)) + sum(w[v] for v, w in zip(pattern, weights))
    return 1 / (1 + math.exp(-max(-700.0, min(700.0, odds))))


def quality_rules(docs: DataFrame, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """doc_id, the base columns, what the rules read, the votes, posterior and kept of every row of docs."""
    at = materialise(base_features(docs.select("doc_id", text), text).drop(text).withColumn("votes", votes()), "quality-rules")
    patterns = {r["votes"]: r["n"] for r in at.where(~F.col("base_failed")).groupBy("votes").agg(F.count("*").alias("n")).collect()}
    share, weights = fit_label_model(patterns)
    odds = F.lit(math.log(share / (1 - share)))
    for j, w in enumerate(weights):
        vote = F.substring("votes", j + 1, 1)
        odds = odds + F.when(vote == "+", F.lit(w["+"])).when(vote == "-", F.lit(w["-"])).otherwise(F.lit(w["0"]))
    return at.withColumn("posterior", 1 / (1 + F.exp(-odds))).withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))
