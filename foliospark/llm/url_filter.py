"""URL filters: domain rules first, then logistic regression on hashed character n-grams of host and path.

DataFrame functions only; the model is fitted in plain Python on the driver from a small labelled
table of at most MAX_LABELLED urls, and its BUCKETS whole-number weights go into the plan as one literal.

Defined results: a null url, or one without "://", has an empty host and path, fits no rule and is
judged by the model (an empty url has no n-grams: the bias alone, allow); repeated rows give repeated
results; other columns are kept, but for those
with the name of a result, which it replaces; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter

from pyspark.sql import DataFrame, functions as F

BUCKETS, GRAMS, SCALE = 4096, (3, 4, 5), 10_000
MAX_RULES, MAX_LABELLED = 1_000, 20_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: (verdict, host, path prefix).
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))

#: What the labelled table is made of: names that stand for unwanted and for wanted sites.
UNWANTED = ("casino", "casino-win", "free-bets", "bets", "betting", "poker", "slots", "jackpot", "cheap-pills", "pills", "pharmacy-deal", "viagra", "adult", "adult-x", "xxx", "porn", "escort", "sex-cams", "spam", "spam-farm", "link-farm", "ads", "ads-track", "adserver", "popunder", "track-click", "warez", "crack-keygen", "payday-loan", "free-money", "replica-watch", "miracle-diet")
WANTED = ("news", "journal", "library", "museum", "university", "school", "science", "research", "weather", "history", "garden", "kitchen", "recipes", "travel", "maps", "forum", "docs", "manual", "review", "market", "health", "city", "county", "theatre", "music", "books", "archive", "letters", "harbour", "mountain", "river", "football", "station", "gathering", "mother", "north", "south", "reading", "writing", "painting", "building", "engineering", "nation", "education", "translation", "conference", "institute", "federation", "athletics", "mathematics", "earth", "weatherman", "orchard", "brother", "leather", "thermal", "anthology", "therapy", "motion", "theory", "southern", "northern", "father", "notable")
PREFIXES, TOPS, FOLDERS, ENDS = ("", "www.", "m.", "blog."), ("com", "org", "net", "info"), ("en", "de", "fr", "es", "shop", "article"), ("", ".html", "/", "?page=2&ref=x", "#top", "?utm_source=feed")


def labelled_urls(seed: int = 7, each: int = 12, unwanted: tuple[str, ...] = UNWANTED, wanted: tuple[str, ...] = WANTED) -> list[tuple[str, int]]:
    """The labelled table that is used if no other is given: (url, 1 if unwanted), every name in `each` urls that otherwise look alike."""
    draw = random.Random(seed)
    rows = []
    for names, label in ((unwanted, 1), (wanted, 0)):
        for name in names:
            rows += [(f"http{draw.choice(('', 's'))}://{draw.choice(PREFIXES)}{name}.{draw.choice(('example.', 'site.', ''))}{draw.choice(TOPS)}/{draw.choice(FOLDERS)}/{draw.randrange(100_000)}{draw.choice(ENDS)}", label) for _ in range(each)]
    return rows


def parts(url: str | None) -> tuple[str, str]:
    rest = (url or "").partition("://")[2]
    host = rest
    for mark in "/?#":
        host = host.partition(mark)[0]
    path = rest[len(host):]
    for mark in "?#":
        path = path.partition(mark)[0]
    return host.translate(str.maketrans(UPPER, LOWER)), path


def buckets(host: str, path: str) -> list[int]:
    """Bucket of each n-gram, from the first three hex digits of its md5, so that any engine can hash alike."""
    s = f"^{host}{path}$" if host or path else ""
    return [int(hashlib.md5(s[i : i + n].encode()).hexdigest()[:3], 16) for n in GRAMS for i in range(len(s) - n + 1)]


def fit(rows: list[tuple[str, int]], rounds: int = 40, rate: float = 0.3, decay: float = 1e-4, seed: int = 7) -> tuple[list[int], int]:
    """Logistic regression by stochastic gradient descent over shares of buckets; weights and bias times SCALE, as whole numbers."""
    if len(rows) > MAX_LABELLED:
        raise ValueError(f"the labelled table has more than {MAX_LABELLED} rows")
    data = []
    for url, label in rows:
        found = Counter(buckets(*parts(url)))
        data.append(([(b, n) for b, n in found.items()], label))
    w, bias, draw = [0.0] * BUCKETS, 0.0, random.Random(seed)
    for k in range(rounds):
        draw.shuffle(data)
        step = rate / (1 + 0.1 * k)
        for x, y in data:
            z = bias + sum(w[b] * n for b, n in x)
            g = 1 / (1 + math.exp(-max(-30.0, min(30.0, z)))) - y
            bias -= step * g * 0.1
            for b, n in x:
                w[b] -= step * (g * n / 10 + decay * w[b])
    return [round(v * SCALE) for v in w], round(bias * SCALE)


def fit_table(labelled: DataFrame, url: str = "url", label: str = "label") -> tuple[list[int], int]:
    """The model of a labelled table: urls and 1 for unwanted ones, 0 for others; rows without a label are left out. An error
    beyond MAX_LABELLED rows."""
    rows = labelled.where(F.col(label).isin(0, 1)).select(url, F.col(label).cast("int")).limit(MAX_LABELLED + 1).collect()
    return fit(sorted((r[0] or "", r[1]) for r in rows))


_MODEL: dict = {}


def default_model() -> tuple[list[int], int]:
    if not _MODEL:
        _MODEL["it"] = fit(labelled_urls())
    return _MODEL["it"]


def url_filter(pages: DataFrame, rules=RULES, model: tuple[list[int], int] | None = None, url: str = "url") -> DataFrame:
    """pages with host, path, rule, score (log odds that the url is unwanted) and verdict.

    The longest fitting rule wins; of equally long ones the first in the order block, allow, then by text.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    weights, bias = model or default_model()
    out = pages.select(F.struct("*").alias("_in"), F.col(url).alias("_url"))
    out = out.withColumn("_r", F.when(F.instr("_url", "://") > 0, F.expr("substring(_url, instr(_url, '://') + 3)")).otherwise(F.lit("")))
    out = out.withColumn("_r", F.coalesce("_r", F.lit(""))).withColumn("_h", F.regexp_extract("_r", r"(?s)\A[^/?#]*", 0))
    out = out.withColumn("host", F.translate("_h", UPPER, LOWER)).withColumn("path", F.regexp_extract(F.expr("substring(_r, length(_h) + 1)"), r"(?s)\A[^?#]*", 0))
    ranked = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0] != "block", r[1] + r[2]))
    listed = F.array(*(F.struct(F.lit(v).alias("v"), F.lit(h).alias("h"), F.lit(p).alias("p")) for v, h, p in ranked)) if ranked else F.expr("cast(array() as array<struct<v:string,h:string,p:string>>)")
    out = out.withColumn("_f", F.get(F.filter(listed, lambda r: ((F.col("host") == r["h"]) | F.col("host").endswith(F.concat(F.lit("."), r["h"]))) & F.col("path").startswith(r["p"])), F.lit(0)))
    out = out.withColumn("_u", F.when((F.col("host") == "") & (F.col("path") == ""), F.lit("")).otherwise(F.concat(F.lit("^"), "host", "path", F.lit("$"))))
    out = out.withColumn("_wt", F.split(F.lit(",".join(map(str, weights))), ",").cast("array<long>"))
    sums = " + ".join(f"case when length(_u) >= {n} then aggregate(sequence(1, length(_u) - {n - 1}), 0L, (a, i) -> a + _wt[cast(conv(substring(md5(cast(substring(_u, i, {n}) as binary)), 1, 3), 16, 10) as int)]) else 0L end" for n in GRAMS)
    out = out.withColumn("_z", F.expr(f"{bias}L + {sums}"))
    out = out.withColumns({
        "rule": F.when(F.col("_f").isNotNull(), F.concat("_f.h", "_f.p")),
        "score": F.col("_z") / F.lit(float(SCALE)),
        "verdict": F.coalesce(F.col("_f.v"), F.when(F.col("_z") > 0, "block").otherwise("allow")),
    })
    results = ("host", "path", "rule", "score", "verdict")
    return out.select(*(F.col(f"_in.`{c}`") for c in pages.columns if c not in results), *results)


def oracle() -> str:
    weights, bias = default_model()
    grams = " union all ".join(f"select page_id, substr(u, i, {n}) as g from (select page_id, u, unnest(range(1, length(u) - {n} + 2)) as i from p where length(u) >= {n})" for n in GRAMS)
    ranked = sorted(RULES, key=lambda r: (-len(r[1] + r[2]), r[0] != "block", r[1] + r[2]))
    fits = lambda r: f"(host = '{r[1]}' or suffix(host, '.{r[1]}')) and starts_with(path, '{r[2]}')"
    return f"""
with r as (select page_id, case when contains(url, '://') then substr(url, instr(url, '://') + 3) else '' end as r from pages),
h as (select page_id, coalesce(r, '') as r, regexp_extract(coalesce(r, ''), '^[^/?#]*') as h from r),
u as (select page_id, translate(h, '{UPPER}', '{LOWER}') as host, regexp_extract(substr(r, length(h) + 1), '^[^?#]*') as path from h),
p as (select *, case when host = '' and path = '' then '' else '^' || host || path || '$' end as u from u),
g as ({grams}),
z as (select page_id, sum(list_extract([{", ".join(map(str, weights))}], cast('0x' || substr(md5(g), 1, 3) as integer) + 1)) as z from g group by page_id)
select page_id, host, path, case {" ".join(f"when {fits(r)} then '{r[1] + r[2]}'" for r in ranked)} end as rule,
case {" ".join(f"when {fits(r)} then '{r[0]}'" for r in ranked)} when coalesce(z, 0) + {bias} > 0 then 'block' else 'allow' end as verdict
from p left join z using (page_id)
"""
