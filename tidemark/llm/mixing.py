"""Mixing to target weights with soft domain membership, with DataFrame and SQL operations only.

A naive Bayes classifier from a labelled table gives each document a posterior over domains. Projected-gradient least
squares then fits nonnegative document rates so that the expected token totals of the domains match the targets. A
rate depends on the document's posterior and the gradients so far, so an iteration is one aggregation of a few numbers
per domain and the state is the short list of gradients: no shuffle of documents at any size.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, fresh
from tidemark.operators.materialize import materialize

FEATURES = 1 << 13       # hashed words
# Targets of the registered query: share of the expected tokens per domain (language).
TARGETS = {"en": 0.4, "de": 0.2, "es": 0.2, "fr": 0.2}


def words(text: Column) -> Column:
    """Words of a text (runs without white space), A-Z lower-cased; none for a null or empty text."""
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def _feature(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(FEATURES)).cast("int")


def _array(values: list) -> Column:
    """A constant array; the optimiser folds the parse into one literal."""
    kind = "array<array<double>>" if values and isinstance(values[0], list) else "array<double>"
    return F.from_json(F.lit(json.dumps(values)), kind)


def train(labelled: DataFrame, domains: list[str], text: str = "text", domain: str = "domain", key: str = "doc_id",
          max_docs: int = 20_000, alpha: float = 0.5) -> tuple[list[float], list[list[float]]]:
    """Log prior and per-domain log word table (``FEATURES`` numbers each, a bounded size) of the labelled rows.

    Sample bound: about ``max_docs`` rows, by a hash of the id. Rows with a null text or another domain are left out;
    a domain without rows gets the smoothed table and a small prior.
    """
    rows = labelled.select(F.col(key).alias("k"), F.col(text).alias("t"), F.col(domain).alias("d")) \
        .where(F.col("d").isin(domains) & F.col("t").isNotNull())
    n = labelled.where(F.col(domain).isin(domains)).count()
    if n > max_docs:
        rows = rows.where(F.pmod(F.xxhash64("k"), F.lit(1 << 20)) < int((1 << 20) * max_docs / n))
    counts = rows.select("d", F.explode(F.concat(F.array(F.lit(-1)), F.transform(words(F.col("t")), _feature))).alias("f")) \
        .groupBy("d", "f").agg(F.count("*").alias("n")).collect()
    docs = {d: 0 for d in domains}
    table = {d: [alpha] * FEATURES for d in domains}
    for r in counts:
        if r["f"] < 0:
            docs[r["d"]] = r["n"]
        else:
            table[r["d"]][r["f"]] += r["n"]
    prior = [math.log((docs[d] + alpha) / (sum(docs.values()) + alpha * len(domains))) for d in domains]
    logs = []
    for d in domains:
        total = math.log(sum(table[d]))
        logs.append([round(math.log(x) - total, 6) for x in table[d]])
    return prior, logs


def posterior(text: Column, prior: list[float], logs: list[list[float]]) -> Column:
    """Struct (tokens, p): word count and posterior per domain. No words: the prior."""
    def log_score(found: Column, start: float, row: list[float]) -> Column:
        table = _array(row)
        return F.aggregate(found, F.lit(start), lambda s, f: s + F.get(table, f))

    def score(found: Column) -> Column:
        sums = [log_score(found, p, row) for p, row in zip(prior, logs)]
        return F.struct(F.size(found).cast("long").alias("tokens"), F.array(*sums).alias("z"))

    def soften(s: Column) -> Column:
        top = F.array_max(s["z"])
        e = F.transform(s["z"], lambda x: F.exp(x - top))
        total = F.aggregate(e, F.lit(0.0), lambda a, x: a + x)
        return F.struct(s["tokens"].alias("tokens"), F.transform(e, lambda x: x / total).alias("p"))

    # transform over a one-element array names an intermediate result, so it is computed once.
    scored = F.transform(F.array(F.transform(words(text), _feature)), score)
    return F.transform(scored, soften)[0]


def rate(p: Column, gradients: list[list[float]]) -> Column:
    """Document rate after the projected steps: r <- max(0, r - p . gradient), from 1."""
    if not gradients:
        return F.lit(1.0)
    def step(r: Column, g: Column) -> Column:
        dot = F.aggregate(F.zip_with(p, g, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
        return F.greatest(F.lit(0.0), r - dot)
    return F.aggregate(_array(gradients), F.lit(1.0), step)


def fit_rates(scored: DataFrame, targets: list[float], total: float | None = None, steps: int = 60,
              tolerance: float = 1e-4) -> list[list[float]]:
    """Gradients of the least squares fit over ``scored`` (tokens, p).

    ``total`` is the wanted amount of expected tokens relative to the input; None: the smallest at which no domain has
    to shrink. The gradient of a domain is scaled by its share, which keeps step size 1 stable.
    """
    n = len(targets)
    def shares(gradients: list[list[float]]) -> tuple[float, list[float]]:
        r = scored.select("tokens", "p", rate(F.col("p"), gradients).alias("r"))
        row = r.agg(F.sum("tokens"), *[F.sum(F.col("tokens") * F.col("r") * F.col("p")[d]) for d in range(n)]).first()
        return float(row[0] or 0), [float(x or 0) for x in row[1:]]

    tokens, now = shares([])
    if not tokens:
        return []
    base = [x / tokens for x in now]
    if total is None:
        total = max([b / t for b, t in zip(base, targets) if t > 0 and b > 0], default=1.0)
    gradients: list[list[float]] = []
    for _ in range(steps):
        error = [x / tokens - t * total for x, t in zip(now, targets)]
        if max(abs(e) for e, b in zip(error, base) if b > 0) < tolerance:
            break
        gradients.append([e / b if b > 1e-9 else 0.0 for e, b in zip(error, base)])
        _, now = shares(gradients)
    return gradients


def copies(rate_column: Column, key: str, salt: int = 17, least: int = 1) -> Column:
    """Whole copies with the rate as their mean: the fraction is decided by a hash of the id (the same at each run)."""
    u = F.pmod(F.xxhash64(F.lit(salt), F.col(key)), F.lit(1 << 40)) / float(1 << 40)
    return F.greatest(F.lit(least), F.floor(rate_column + u).cast("int"))


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], key: str = "doc_id", text: str = "text",
        domain: str = "domain", total: float | None = None) -> DataFrame:
    """One row per input row: ``key``, ``tokens``, ``domain`` (the likeliest), ``p_domain``, ``rate``, ``copies``.

    Target weights are normalised. Null, empty and wordless texts have 0 tokens and the prior as posterior. Equal
    posteriors go to the domain named first in sorted order. Repeated rows and null ids count like any other row; no
    documents give no rows; without labelled rows the posterior is uniform; other columns are ignored. A domain that
    no document belongs to keeps its shortfall.
    """
    domains = sorted(targets)
    weights = [targets[d] / sum(targets.values()) for d in domains]
    prior, logs = train(labelled, domains, text, domain, key)
    scored = docs.select(F.col(key).alias("k"), posterior(F.col(text), prior, logs).alias("s")).select("k", "s.tokens", "s.p")
    scored = materialize(scored, "posteriors")
    gradients = fit_rates(scored, weights, total)
    out = scored.withColumn("rate", rate(F.col("p"), gradients))
    best = F.array_position("p", F.array_max("p")).cast("int")
    names = F.array(*[F.lit(d) for d in domains])
    return out.select(F.col("k").alias(key), "tokens", F.get(names, best - 1).alias("domain"),
                      F.array_max("p").alias("p_domain"), "rate", copies(F.col("rate"), "k").alias("copies"))


def mixed_documents(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], key: str = "doc_id",
                    text: str = "text", domain: str = "domain", total: float | None = None) -> DataFrame:
    """``docs`` with each row repeated by its copies (at least one); same columns, whatever their names. Texts are not shuffled."""
    domains = sorted(targets)
    weights = [targets[d] / sum(targets.values()) for d in domains]
    prior, logs = train(labelled, domains, text, domain, key)
    p = posterior(F.col(text), prior, logs)
    gradients = fit_rates(materialize(docs.select(p.alias("s")).select("s.tokens", "s.p"), "posteriors"), weights, total)
    # The one-element array names the posterior, which the fold over the gradients reads at every step.
    r = F.transform(F.array(p["p"]), lambda x: rate(x, gradients))[0]
    n = copies(r, key)
    copy, = fresh(docs.columns, "_copy")
    return docs.select("*", F.explode(F.array_repeat(F.lit(True), n)).alias(copy)).drop(copy)


def labelled_by_language(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.col("lang").alias("domain"))


def op2(docs: DataFrame) -> DataFrame:
    return mix(docs, labelled_by_language(docs), TARGETS)
