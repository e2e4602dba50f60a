"""Operator 2, mixing to target weights with soft membership.

A multinomial classifier over hashed words, fitted on a bounded sample of a labelled table, gives each document a
probability for each domain. A document's expected tokens of a domain are its tokens times that probability. Document
rates, none negative, are fitted so that expected tokens by domain, summed over all documents at their rates, equal the
targets: projected gradient on least squares, each step one distributed sum of as many numbers as there are domains.
Distances are weighted by tokens and by the Gram matrix of the domains over documents whose rates are above 0, so
documents of equal probabilities get equal rates and a step that meets no bound lands on the target.

Everything is DataFrame functions; the driver sees sums by domain only. The probability of a domain is tempered by the
square root of a document's length, as word counts are far from independent.

A null or empty text has no tokens: prior probabilities, a rate like others, no weight in the sums. A very long text is
one row of words counted where it lies. Repeated rows each count. Other columns, whatever their names, are not read. Labels outside the targets are ignored; a domain without labelled rows is as likely as
its prior. An empty table gives no rows. Targets need not be reachable: rates then end near the nearest point, and the
gap that remains is logged. A greatest rate can be set and is off by default.
"""

from __future__ import annotations

import logging
import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.llm.common import table, written

#: Hash buckets of words, which is what is broadcast; most labelled rows of the classifier; words of all domains
#: together that each domain's counts are smoothed with.
BUCKETS, LABELLED_ROWS, SMOOTHING = 1 << 15, 20_000, 1000.0
#: The fit ends at this gap to the targets, as a share of all tokens, when a step moves the mean rate of a token by less
#: than MOVED, or, for targets out of reach, when PATIENCE passes together narrow the gap by less than PROGRESS of it.
#: Rates are written after each STEPS steps. Directions of the Gram matrix below FLAT of its largest, in which domains
#: are not told apart, are left out.
GAP, MOVED, STEPS, FLAT = 1e-9, 1e-6, 40, 1e-9
PATIENCE, PROGRESS = 12, 0.01
#: Greatest rate: none by default.
MOST = math.inf
#: Shares of tokens aimed at.
TARGETS = {"good": 0.9, "poor": 0.07, "toxic": 0.03}


def domain_of(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) by the labels; an id labelled twice takes its first domain by name."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor")
    known = labels.select("doc_id", domain.alias("domain")).where("doc_id is not null and domain is not null")
    return known.groupBy("doc_id").agg(F.min("domain").alias("domain"))


def word_rows(documents: DataFrame, *keep: str) -> DataFrame:
    """A row for each word with its bucket; one row with a null bucket for a text without words."""
    words = F.filter(F.split(F.coalesce("text", F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    rows = documents.select(*keep, F.explode_outer(words).alias("word"))
    bucket = F.when(F.col("word").isNotNull(), F.pmod(F.xxhash64("word"), F.lit(BUCKETS)))
    return rows.select(*keep, bucket.alias("bucket"))


def fit(documents: DataFrame, labels: DataFrame, domains: list[str], rows: int = LABELLED_ROWS) -> tuple[DataFrame, list[float]]:
    """Log-likelihood ratio of each bucket by domain (``w0``, ``w1``, …), and log priors; ``labels`` has doc_id and domain."""
    sample = labels.where(F.col("domain").isin(domains)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    marked = word_rows(documents.select("doc_id", "text").join(F.broadcast(sample), "doc_id"), "domain")
    count = lambda d: F.count(F.when(F.col("domain") == d, 1))
    counted = marked.where("bucket is not null").groupBy("bucket").agg(*[count(d).alias(f"n{k}") for k, d in enumerate(domains)])
    every = documents.sparkSession.range(BUCKETS).withColumnRenamed("id", "bucket").join(counted, "bucket", "left").na.fill(0)
    every = written(every)
    totals = every.agg(*[F.sum(f"n{k}") for k in range(len(domains))]).first()
    held = {r["domain"]: r["n"] for r in sample.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    priors = [np.log((held.get(d, 0) + 1) / (sum(held.values()) + len(domains))).item() for d in domains]
    # Against the share of the bucket in all domains; a bucket that no labelled text holds says nothing.
    pooled = sum((F.col(f"n{k}") for k in range(1, len(domains))), F.col("n0")) / F.lit(float(max(1, sum(t or 0 for t in totals))))
    logs = [
        F.when(pooled > 0, F.log((F.col(f"n{k}") + SMOOTHING * pooled) / (F.lit((totals[k] or 0) + SMOOTHING) * pooled))).otherwise(0.0).alias(f"w{k}")
        for k in range(len(domains))
    ]
    return every.select("bucket", *logs), priors


def memberships(documents: DataFrame, weights: DataFrame, priors: list[float]) -> DataFrame:
    """(doc_id, row, n_tokens, p0, p1, …): tokens and domain probabilities of each document."""
    n = len(priors)
    numbered = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.monotonically_increasing_id().alias("row"))
    scored = word_rows(numbered, "row", "doc_id").join(F.broadcast(weights), "bucket", "left")
    sums = scored.groupBy("row", "doc_id").agg(F.count("bucket").alias("n_tokens"), *[F.coalesce(F.sum(f"w{k}"), F.lit(0.0)).alias(f"s{k}") for k in range(n)])
    z = [F.lit(priors[k]) + F.col(f"s{k}") / F.sqrt(F.greatest(F.col("n_tokens"), F.lit(1)).cast("double")) for k in range(n)]
    top = F.greatest(*z) if n > 1 else z[0]
    parts = sums.select("row", "doc_id", "n_tokens", *[F.exp(z[k] - top).alias(f"e{k}") for k in range(n)])
    total = sum((F.col(f"e{k}") for k in range(1, n)), F.col("e0"))
    return parts.select("doc_id", "row", "n_tokens", *[(F.col(f"e{k}") / total).alias(f"p{k}") for k in range(n)])


def rate(steps: list[np.ndarray], n: int, most: float = MOST) -> Column:
    """(now, before): rates after all steps and after all but the last, down along probabilities, kept between 0 and ``most``."""
    start = F.struct(F.col("rate").alias("now"), F.col("rate").alias("before"))
    if not steps:
        return start
    history = F.array(*[F.array(*[F.lit(float(x)) for x in g]) for g in steps])
    dot = lambda g: sum((F.get(g, F.lit(k)) * F.col(f"p{k}") for k in range(1, n)), F.get(g, F.lit(0)) * F.col("p0"))
    down = lambda r, g: F.least(F.lit(most), F.greatest(F.lit(0.0), r - dot(g)))
    return F.aggregate(history, start, lambda r, g: F.struct(down(r["now"], g).alias("now"), r["now"].alias("before")))


def look(members: DataFrame, steps: list[np.ndarray], target: np.ndarray, most: float) -> tuple[np.ndarray, np.ndarray, float]:
    """One pass at the rates after ``steps``: gap to the target, Gram matrix of what rates can still lower, tokens moved."""
    n = len(target)
    pairs = [(a, b) for a in range(n) for b in range(a, n)]
    rated = members.select("n_tokens", *[f"p{k}" for k in range(n)], rate(steps, n, most).alias("r"))
    tokens, now = F.col("n_tokens").cast("double"), F.col("r.now")
    free = F.when((now > 0) & (now < most), tokens).otherwise(0.0)
    sums = rated.agg(
        *[F.sum(now * tokens * F.col(f"p{k}")) for k in range(n)],
        *[F.sum(free * F.col(f"p{a}") * F.col(f"p{b}")) for a, b in pairs],
        F.sum(F.abs(now - F.col("r.before")) * tokens),
    ).first()
    gram = np.zeros((n, n))
    for (a, b), x in zip(pairs, sums[n:-1], strict=True):
        gram[a, b] = gram[b, a] = x
    return np.array(sums[:n], float) - target, gram, sums[-1]


def fit_rates(members: DataFrame, shares: list[float], most: float = MOST) -> DataFrame:
    """The members with their ``rate``, expected tokens by domain matching ``shares`` of all tokens.

    A step is the gap times the inverse Gram matrix of the documents whose rates are still free to fall, found in the
    pass that finds the gap. One that widens the gap is taken back and halved.
    """
    total = float(members.agg(F.sum("n_tokens")).first()[0] or 0)
    members = members.withColumn("rate", F.lit(1.0))
    if not total:
        return members
    target = total * np.array(shares) / sum(shares)
    steps: list[np.ndarray] = []
    gap, gram, _ = look(members, steps, target, most)
    widths, part = [np.abs(gap).max()], 1.0
    while widths[-1] > GAP * total and (len(widths) <= PATIENCE or widths[-1] < (1 - PROGRESS) * widths[-1 - PATIENCE]):
        step = part * (np.linalg.pinv(gram, rcond=FLAT, hermitian=True) @ gap)
        next_gap, next_gram, moved = look(members, [*steps, step], target, most)
        if np.abs(next_gap).max() < widths[-1]:
            steps, gap, gram, part = [*steps, step], next_gap, next_gram, min(1.0, 2 * part)
            if len(steps) >= STEPS:
                members, steps = written(members.withColumn("rate", rate(steps, len(shares), most)["now"])), []
        else:
            part /= 2
        widths.append(np.abs(gap).max())
        if moved <= MOVED * total:
            break
    log = logging.getLogger(__name__)
    log.info("rates fitted in %d passes", len(widths))
    if widths[-1] > MOVED * total:
        log.warning("targets missed by these shares of tokens: %s", (gap / total).tolist())
    return members.withColumn("rate", rate(steps, len(shares), most)["now"])


def mix(documents: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, most: float = MOST) -> DataFrame:
    """(doc_id, n_tokens, rate, p_<domain> …) of every document; ``labels`` has doc_id and domain."""
    domains = sorted(targets)
    weights, priors = fit(documents, labels, domains)
    members = written(memberships(documents, weights, priors))
    rated = fit_rates(members, [targets[d] for d in domains], most)
    return rated.select("doc_id", "n_tokens", "rate", *[F.col(f"p{k}").alias(f"p_{d}") for k, d in enumerate(domains)])


def op2_mixing(spark, folder: str) -> DataFrame:
    return mix(table(spark, folder, "documents"), domain_of(table(spark, folder, "labels")))
