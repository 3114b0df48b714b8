"""Mixing to target weights with soft domain membership, in DataFrame expressions only.

A classifier learned from a labelled table (naive Bayes over hashed words) gives each document a probability for every
domain. Each document gets a rate, how often it is to be used (0: dropped, 1.5: once or twice). The expected tokens of
domain k are the sum of rate * tokens * probability of k. The rates are those nearest to `start`, nonnegative and at most
`most`, whose expected domain totals match the targets (least squares; the pull to `start` has the small weight `PULL`, and
a smaller one, down to `LEAST_PULL`, where it would keep the totals from the targets).
They are found by projected gradient steps: gradients of the domains' errors are collected in one multiplier per domain,
and a rate is the projection of `start` minus multipliers times probabilities onto its bounds. A step is scaled by the
Gram matrix of the probabilities of documents whose rate is inside the bounds, damped towards the tokens of each domain
until it makes the error smaller.
Each step needs one small aggregate over all documents; nothing is written between steps, and the rate stays an
expression of as many numbers as there are domains.

Steps end at the least-squares solution, to a share of `PRECISION`. If the targets cannot be met to `TOLERANCE` (a domain
has too few tokens for the bounds), the nearest totals are returned; `Fit` holds what was wanted and what is reached, and a
log line tells the difference.

The classifier may be fitted on a sample of at most about `SAMPLE_ROWS` labelled documents (a documented parameter);
probabilities, token counts and sums cover all documents and whole texts.

Nulls: a null text has no tokens and the domains' prior; labels with a null id or domain teach nothing. A document that
is labelled twice teaches twice. Without labels, or if a domain has no labelled documents, the known domains (or, if
there are none, equal probabilities of all) are used. Repeated rows are rated each and drawn each for itself, as are rows
without id; ties cannot occur, and an empty table gives no rows. Targets of domains that no document belongs to cannot be
met and are left out. Columns of the input with an output column's name are replaced.
"""

from __future__ import annotations

import json
import logging
import math
from collections.abc import Mapping, Sequence
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from refsync.sources.storage import stage

BUCKETS = 1 << 14
SAMPLE_ROWS = 20_000
SMOOTHING = 0.5
STEPS = 120
DAMPINGS = (0.0, 1e-3, 1e-2, 0.1, 1.0)
PRECISION = 1e-5
TOLERANCE = 1e-3
PULL, LEAST_PULL = 5e-4, 1e-6

log = logging.getLogger(__name__)

DOMAINS = ("good", "junk", "toxic")
#: Share of the token budget that each domain is to have.
TARGETS = {"good": 0.95, "junk": 0.05, "toxic": 0.0}


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits, and runs of other signs, as an array; empty for null."""
    spaced = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"([^\p{L}\p{N}\s]+)|\s+", " $1 ")
    return F.filter(F.split(spaced, " "), lambda t: t != "")


def _bucket(token: Column) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(BUCKETS)).cast("int")


def label_domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain number) from the columns quality and toxic."""
    domain = F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 0)
    return labels.select("doc_id", domain.alias("domain")).dropna()


def train(docs: DataFrame, labelled: DataFrame, domains: int, sample_rows: int = SAMPLE_ROWS, doc_id: str = "doc_id", text: str = "text") -> tuple[list[float], list[list[float]]]:
    """(log prior of each domain, for each domain the log-likelihoods of the buckets).

    `labelled` has (doc_id, domain number). The sample is drawn by a hash of the id; its ids are few enough to be sent
    to all tasks. The driver gets at most domains * BUCKETS sums.
    """
    labelled = labelled.toDF("labelled_id", "domain").groupBy("labelled_id", "domain").agg(F.count("*").alias("times"))
    found = labelled.groupBy("domain").agg(F.sum("times"), F.count("*")).collect()
    rows = {r[0]: r[1] for r in found}
    share = min(1.0, sample_rows / max(1, sum(r[2] for r in found)))
    drawn = F.pmod(F.xxhash64("labelled_id"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1
    # one row per drawn id and domain, however often it is labelled
    sample = docs.join(F.broadcast(labelled.filter(drawn)), docs[doc_id] == F.col("labelled_id"))
    words = sample.select("domain", "times", F.explode(tokens(docs[text])).alias("token"))
    counts = words.groupBy("domain", _bucket(F.col("token")).alias("bucket")).agg(F.sum("times").alias("n")).collect()
    table = [[SMOOTHING] * BUCKETS for _ in range(domains)]
    for domain, bucket, n in counts:
        table[domain][bucket] += n
    for own in table:
        whole = math.log(sum(own))
        own[:] = [math.log(x) - whole for x in own]
    first = next((k for k in range(domains) if rows.get(k)), 0)
    table = [own if rows.get(k) else list(table[first]) for k, own in enumerate(table)]  # the unknown have no words of their own
    known = sum(rows.values())
    prior = [math.log(rows[k] / known) if rows.get(k) else (-50.0 if known else 0.0) for k in range(domains)]
    return prior, table


def posteriors(words: Column, prior: Sequence[float], table: Sequence[Sequence[float]]) -> list[Column]:
    """Probability of each domain from an array of tokens."""
    domains = len(prior)
    # log-likelihoods relative to the first domain: domain 0 needs no sum
    relative = [F.from_json(F.lit(json.dumps([round(a - b, 4) for a, b in zip(own, table[0], strict=True)])), "array<double>") for own in table[1:]]
    if domains == 1:
        return [F.lit(1.0)]
    place = F.transform(words, lambda t: _bucket(t) + 1)
    start = F.struct(*[F.lit(p - prior[0]).cast("double").alias(f"s{k}") for k, p in enumerate(prior[1:], 1)])
    added = lambda acc, i: F.struct(*[(acc[f"s{k}"] + F.element_at(relative[k - 1], i)).alias(f"s{k}") for k in range(1, domains)])
    sums = F.aggregate(place, start, added)
    odds = [F.lit(1.0), *[F.exp(F.greatest(F.least(sums[f"s{k}"], F.lit(100.0)), F.lit(-100.0))) for k in range(1, domains)]]
    return odds


def classify(docs: DataFrame, prior: Sequence[float], table: Sequence[Sequence[float]], names: Sequence[str], text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """`docs` (or its columns `keep`) with n_tokens and p_<domain> columns."""
    outputs = {"n_tokens", "odds", *[f"p_{n}" for n in names]}
    own = [c for c in (docs.columns if keep is None else keep) if c not in outputs]
    words = docs.select(*own, tokens(docs[text]).alias("__words"))
    if len(names) == 1:
        return words.select(*own, F.size("__words").cast("bigint").alias("n_tokens"), F.lit(1.0).alias(f"p_{names[0]}"))
    odds = posteriors(F.col("__words"), prior, table)
    judged = words.select(*own, F.size("__words").cast("bigint").alias("n_tokens"), F.array(*odds).alias("odds"))
    whole = F.aggregate("odds", F.lit(0.0), lambda a, x: a + x)
    return judged.select(*own, "n_tokens", *[(F.col("odds")[k] / whole).alias(f"p_{n}") for k, n in enumerate(names)])


class Fit(NamedTuple):
    """Rates as an expression of n_tokens and p_<domain>, and the tokens wanted and reached per domain."""

    rate: Column
    wanted: dict[str, float]
    reached: dict[str, float]
    steps: int


def _rate(multipliers: Sequence[float], names: Sequence[str], start: float, most: float | None) -> Column:
    moved = F.lit(float(start))
    for n, m in zip(names, multipliers, strict=True):
        moved = moved - F.col(f"p_{n}") * F.lit(float(m))
    return F.greatest(F.lit(0.0), moved if most is None else F.least(F.lit(float(most)), moved))


def fit(judged: DataFrame, names: Sequence[str], targets: Mapping[str, float], budget_share: float | None = 1.0, start: float = 1.0, most: float | None = None) -> Fit:
    """Rates for a table with n_tokens and p_<domain>; the domain totals are to be targets[domain] * budget_share * all tokens.

    Without a budget (None) it is the largest one, up to all tokens, for which no domain would have to be used more than
    `most` times.
    """
    held_sums = [F.sum(F.col("n_tokens") * F.col(f"p_{n}")).alias(n) for n in names]
    held = judged.agg(*held_sums, F.sum("n_tokens").alias("all")).first()
    whole = float(held["all"] or 0)
    if not whole:
        return Fit(F.lit(float(start)), {}, {}, 0)
    present = [n for n in names if held[n] and held[n] > 1e-9 * whole]
    if budget_share is None:
        limits = [most * held[n] / (targets[n] * whole) for n in present if targets.get(n, 0.0) > 0 and most is not None]
        budget_share = min([1.0, *limits])
    wanted = np.array([targets.get(n, 0.0) * budget_share * whole for n in present])
    owned = np.array([held[n] for n in present])
    k = range(len(present))

    def reached(multipliers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens per domain, and the Gram matrix of the documents whose rate is inside the bounds."""
        rate = _rate(multipliers, present, start, most)
        inside = (F.col("rate") > 0) if most is None else (F.col("rate") > 0) & (F.col("rate") < most)
        p = [F.col(f"p_{n}") for n in present]
        sums = [F.sum(F.col("rate") * F.col("n_tokens") * p[i]).alias(f"s{i}") for i in k]
        gram = [F.sum(F.when(inside, F.col("n_tokens") * p[i] * p[j])).alias(f"g{i}_{j}") for i in k for j in k if i <= j]
        row = judged.select("n_tokens", *p, rate.alias("rate")).agg(*sums, *gram).first()
        both = np.array([[row[f"g{min(i, j)}_{max(i, j)}"] or 0.0 for j in k] for i in k])
        return np.array([row[f"s{i}"] for i in k]), both

    slope = lambda m, g: g - wanted - pull * owned * m
    met = lambda g: np.abs(g - wanted).max(initial=0) <= TOLERANCE * whole
    multipliers, pull = np.zeros(len(present)), PULL
    got, gram = reached(multipliers)
    steps = 0
    while steps < STEPS:
        error = slope(multipliers, got)
        if np.abs(error).sum() <= PRECISION * whole:
            if met(got) or pull <= LEAST_PULL:
                break
            pull /= 10  # the pull to `start` keeps the totals from the targets: weaken it
            continue
        # damped until the error falls; fully damped it is the plain step, in which a domain's error is divided by its tokens
        for damping in DAMPINGS:
            move = np.linalg.solve(gram + np.diag((pull + damping) * owned), error)
            new, new_gram = reached(multipliers + move)
            steps += 1
            if np.abs(slope(multipliers + move, new)).sum() < 0.95 * np.abs(error).sum():
                break
        multipliers, got, gram = multipliers + move, new, new_gram
    if not met(got):
        log.warning("targets cannot be met: wanted %s, reached %s tokens", dict(zip(present, wanted)), dict(zip(present, got)))
    told = lambda x: dict(zip(present, map(float, x), strict=True))
    return Fit(_rate(multipliers, present, start, most), told(wanted), told(got), steps)


def mix(docs: DataFrame, labelled: DataFrame, names: Sequence[str] = DOMAINS, targets: Mapping[str, float] | None = None, budget_share: float | None = 1.0, text: str = "text", keep: Sequence[str] | None = None, sample_rows: int = SAMPLE_ROWS, most: float | None = None) -> DataFrame:
    """`docs` (or its columns `keep`) with n_tokens, p_<domain> and rate.

    Only token counts and probabilities are written for the fit; columns of the input are judged again on their way out,
    so that no text is written between.
    """
    prior, table = train(docs, labelled, len(names), sample_rows, text=text)
    judged = stage(classify(docs, prior, table, names, text, [] if keep is None else keep), "mixing")
    rate = fit(judged, names, TARGETS if targets is None else targets, budget_share, most=most).rate
    return (classify(docs, prior, table, names, text) if keep is None else judged).withColumn("rate", rate)


def draw(mixed: DataFrame, doc_id: str = "doc_id", most: int | None = None) -> DataFrame:
    """Rows as often as their rate says: its whole part, and once more with its fraction as chance.

    The chance depends on the id and on the row's place in its partition, so rows without id or with a repeated one are
    drawn each for itself."""
    place = F.monotonically_increasing_id()
    chance = F.pmod(F.xxhash64(F.lit(11), mixed[doc_id], place), F.lit(1 << 30)) / float(1 << 30)
    copies = F.floor(F.col("rate") + chance)
    if most is not None:
        copies = F.least(copies, F.lit(most))
    return mixed.withColumn("__copies", copies.cast("int")).filter("__copies > 0").select("*", F.explode(F.sequence(F.lit(1), "__copies")).alias("copy")).drop("__copies")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates of all documents for 95 % good and 5 % junk tokens, none of them toxic."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labelled = label_domains(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return mix(docs, labelled, keep=["doc_id", "source"])


QUERIES = {"op5_mixing": op5_mixing}
SQL: dict[str, str] = {}
