"""Mixing to target weights: soft domain membership, and document rates whose domain totals match the targets.

Everything that touches documents is a DataFrame expression; the driver sees one
number a domain and step, and bounded tables of word weights.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberscope.llm.common import stored


@dataclass(frozen=True)
class Settings:
    """``targets``: the share of all tokens that each domain shall hold; they are scaled to a sum of one.

    ``total``: tokens wanted as a multiple of those there are. ``most``: the largest rate.
    ``sample`` labelled documents at most teach the classifier. The fit ends when each domain's total
    is within ``tolerance`` (of the total) of its target or of the best that is reachable. After ``steps`` gradient steps,
    or one that takes less than ``least_gain`` off the largest difference, the rest is solved as one implicit step.
    """

    targets: dict[str, float] = field(default_factory=lambda: {"clean": 0.85, "poor": 0.1, "toxic": 0.05})
    total: float = 1.0
    most: float = 4.0
    buckets: int = 4096
    sample: int = 4000
    steps: int = 60
    tolerance: float = 0.002
    least_gain: float = 0.01


def domain_of_labels() -> Column:
    """toxic, else poor, else clean; null where the labels say nothing."""
    return F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "poor").when(F.col("quality") == 1, "clean")


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def n_tokens() -> Column:
    """Words of the text, at least one, so that an empty text has a weight too."""
    return F.greatest(F.size(words(F.col("text"))), F.lit(1)).cast("long")


def _numbers(values: list[float]) -> Column:
    """A constant array, written as one literal."""
    return F.split(F.lit(" ".join(map(repr, values))), " ").cast("array<double>")


def learn(docs: DataFrame, labels: DataFrame, s: Settings) -> tuple[list[str], list[float], list[list[float]]]:
    """Domains, log priors and log weights of word buckets by domain, from a bounded sample by hash.

    Each labelled document counts a bucket once, as far as it holds it. A domain without labels is left to its prior.
    """
    domains = sorted(s.targets)
    marked = labels.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), domain_of_labels().alias("domain")).where(F.col("domain").isin(domains))
    marked = marked.groupBy("doc_id").agg(F.min("domain").alias("domain"))
    seen = {r["domain"]: r["count"] for r in marked.groupBy("domain").count().collect()}
    per = [marked.where(F.col("domain") == d).orderBy(F.xxhash64("doc_id"), "doc_id").limit(s.sample // len(domains)) for d in domains]
    chosen = per[0]
    for x in per[1:]:
        chosen = chosen.union(x)
    held = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
    held = held.select("domain", F.explode(F.array_distinct(F.transform(words(F.col("text")), lambda w: F.pmod(F.xxhash64(w), F.lit(s.buckets))))).alias("bucket"))
    counts: dict[tuple[str, int], int] = {(r["domain"], r["bucket"]): r["n"] for r in held.groupBy("domain", "bucket").agg(F.count("*").alias("n")).collect()}
    all_seen = sum(seen.values())
    priors = [math.log((seen.get(d, 0) + 1) / (all_seen + len(domains))) for d in domains]
    weights = []
    for d in domains:
        total = sum(n for (k, _), n in counts.items() if k == d)
        weights.append([math.log((counts.get((d, b), 0) + 1) / (total + s.buckets)) for b in range(s.buckets)])
    return domains, priors, weights


def _looked_up(weights: Column) -> Column:
    return F.aggregate("_b", F.lit(0.0), lambda total, b: total + F.get(weights, b))


def posteriors(docs: DataFrame, domains: list[str], priors: list[float], weights: list[list[float]], s: Settings) -> DataFrame:
    """Add ``_p``: for each domain the posterior of naive Bayes, evidence being the mean over words times their root.

    Word counts enter by their square root, as words of one text are far from independent.
    """
    buckets = F.transform(words(F.col("text")), lambda w: F.pmod(F.xxhash64(w), F.lit(s.buckets)).cast("int"))
    out = docs.withColumn("_b", buckets)
    scale = F.greatest(F.sqrt(F.size("_b").cast("double")), F.lit(1.0))
    logits = []
    for prior, weight in zip(priors, weights, strict=True):
        # One weight table is the base of all; only differences matter.
        table = _numbers([round(w - v, 6) for w, v in zip(weight, weights[0], strict=True)])
        total = _looked_up(table) if weight is not weights[0] else F.lit(0.0)
        logits.append(total / scale + F.lit(prior))
    out = out.withColumn("_l", F.array(*logits)).drop("_b")
    out = out.withColumn("_l", F.transform("_l", lambda x: F.exp(x - F.array_max("_l"))))
    return out.withColumn("_p", F.transform("_l", lambda x: x / F.aggregate("_l", F.lit(0.0), lambda a, b: a + b))).drop("_l")


def dot(p: Column, values: list[float]) -> Column:
    return sum((p[i] * F.lit(v) for i, v in enumerate(values)), F.lit(0.0))


def rate(pulls: list[list[float]], s: Settings) -> Column:
    """The rate of a document after the given steps, from its posteriors alone: start at ``total``, step, project."""
    if not pulls:
        return F.lit(float(min(s.total, s.most)))
    table = F.array(*[_numbers(p) for p in pulls])
    move = lambda r, g: F.least(F.lit(s.most), F.greatest(F.lit(0.0), r - F.aggregate(F.zip_with("_p", g, lambda p, x: p * x), F.lit(0.0), lambda a, b: a + b)))
    return F.aggregate(table, F.lit(float(min(s.total, s.most))), move)


def solve(evaluate: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray, float, float]], curve: np.ndarray, goal: np.ndarray, most: float, near: float) -> tuple[np.ndarray, np.ndarray]:
    """The pull of one implicit step, so long that totals are those of the optimum within ``near``, and these totals.

    ``evaluate`` gives, for a pull: totals by domain, joint sums over documents whose rate
    is not at a bound, the sum of the dual terms, and that of pull times way to the bound it points at. For ever longer steps (1 / eps)
    the pull is the minimum of a convex function of one number a domain, found by Newton's
    method with backtracking. The last sum bounds the objective's distance from its minimum, and thus that of each total.
    """
    live = curve > 0
    enough = near**2 / (2 * curve.max())
    pull, eps = np.zeros(len(goal)), 0.1
    totals, joint, dual, way = evaluate(pull)
    for _ in range(500):
        force = np.where(live, eps * curve * pull - (totals - goal), 0.0)
        if np.abs(totals - goal).max() <= near or eps * way + most * np.abs(force).sum() <= enough:
            return pull, totals
        if most * np.abs(force).sum() <= enough / 2:
            eps /= 10
            continue
        size = np.sqrt(np.where(live, eps * curve + joint.diagonal(), 1.0))
        matrix = (joint + np.diag(eps * curve)) / np.outer(size, size)
        matrix[~live], matrix[:, ~live] = 0.0, 0.0
        matrix[~live, ~live] = 1.0
        move = -np.linalg.solve(matrix, force / size) / size
        value, slope, length = eps / 2 * curve @ pull**2 + dual + goal @ pull, force @ move, 1.0
        while True:
            got = evaluate(pull + length * move)
            gained = value - (eps / 2 * curve @ (pull + length * move) ** 2 + got[2] + goal @ (pull + length * move))
            if gained >= -0.1 * length * slope - 1e-13 * abs(value) or length < 1e-6:
                break
            length /= 4
        pull, (totals, joint, dual, way) = pull + length * move, got
    raise ArithmeticError("the rates of the mixture don't converge")


def fit(docs: DataFrame, domains: list[str], s: Settings) -> tuple[list[list[float]], list[float], list[float]]:
    """Steps of projected gradient descent on stored rows (_n tokens, _p posteriors); also targets and reached totals.

    Minimises the squares of domain totals less targets over rates between 0 and
    ``most``. A step is one aggregate over the rows; a rate is recomputed from all former
    steps, so nothing but the posteriors is kept. Domains are weighted by the
    inverse of their row of the token-weighted matrix of joint posteriors, which bounds the
    curvature by one and makes the step length one. Such steps get slow where posteriors are soft or a target is
    out of reach; an implicit step of the same form, r - p.pull cut to its bounds, then leads to the optimum (see solve).
    """
    k = range(len(domains))
    sums = docs.agg(*[F.sum(F.col("_n") * F.col("_p")[i]).alias(f"s{i}") for i in k], F.sum("_n").alias("n")).first()
    if not sums["n"]:
        return [], [0.0] * len(domains), [0.0] * len(domains)
    curve = [float(sums[f"s{i}"] or 0.0) for i in k]  # row sums: posteriors of a document sum to one
    scale = sum(s.targets[d] for d in domains)
    if scale <= 0 or min(s.targets.values()) < 0:
        raise ValueError("targets must be nonnegative and not all zero")
    goal = [s.targets[d] / scale * s.total * sums["n"] for d in domains]
    pulls: list[list[float]] = []
    before = math.inf
    while True:
        rows = docs.select("_n", "_p", rate(pulls, s).alias("_r"))
        got = rows.agg(*[F.sum(F.col("_r") * F.col("_n") * F.col("_p")[i]).alias(f"s{i}") for i in k]).first()
        off = [float(got[f"s{i}"] or 0.0) - goal[i] for i in k]
        worst = max(map(abs, off))
        if worst <= s.tolerance * sum(goal):
            return pulls, goal, [o + g for o, g in zip(off, goal, strict=True)]
        if len(pulls) >= s.steps or worst > (1 - s.least_gain) * before:
            break
        before = worst
        pulls.append([o / c if c > 0 else 0.0 for o, c in zip(off, curve, strict=True)])
    pairs = [(i, j) for i in k for j in k if i <= j]
    n, p = F.col("_n"), F.col("_p")

    def evaluate(pull: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, float]:
        steps = rows.select("_n", "_p", F.col("_r").alias("_q"), dot(p, pull.tolist()).alias("_x")).withColumn("_y", F.col("_q") - F.col("_x"))
        steps = steps.withColumn("_s", F.least(F.lit(s.most), F.greatest(F.lit(0.0), F.col("_y"))))
        free = (F.col("_y") > 0) & (F.col("_y") < s.most)
        row = steps.agg(
            *[F.sum(F.col("_s") * n * p[i]) for i in k],
            *[F.sum(F.when(free, n * p[i] * p[j]).otherwise(0.0)) for i, j in pairs],
            F.sum(n * F.col("_s") * (F.col("_y") - F.col("_s") / 2)),
            F.sum(n * F.col("_x") * (F.col("_s") - F.when(F.col("_x") > 0, 0.0).otherwise(s.most))),
        ).first()
        joint = np.zeros((len(domains), len(domains)))
        for (i, j), x in zip(pairs, row[len(domains) : -2], strict=True):
            joint[i, j] = joint[j, i] = x
        return np.array(row[: len(domains)]), joint, row[-2], row[-1]

    pull, totals = solve(evaluate, np.array(curve), np.array(goal), s.most, s.tolerance * sum(goal))
    return [*pulls, pull.tolist()], goal, totals.tolist()


def rates(docs: DataFrame, labels: DataFrame, keep: list[str], s: Settings = Settings()) -> tuple[DataFrame, list[str]]:
    """Columns ``keep`` of every document with _n, _p, _r (its rate) and _copies, and the names of the domains.

    _copies is the rate rounded up or down by a hash of id and text so that its expectation is
    the rate; equal rows are rounded alike. Null or empty texts count one token and have the prior's posteriors. No rows
    give no rows. A domain that no document can belong to keeps its shortfall.
    """
    domains, priors, weights = learn(docs, labels, s)
    hashed = docs.withColumn("_u", F.xxhash64(F.col("doc_id"), F.col("text"))).withColumn("_n", n_tokens())
    found = posteriors(hashed, domains, priors, weights, s)
    found = stored(found.select(*keep, "_u", "_n", "_p"), "posteriors")
    pulls, _, _ = fit(found, domains, s)
    out = found.withColumn("_r", rate(pulls, s))
    chance = F.pmod(F.col("_u"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    return out.withColumn("_copies", (F.floor("_r") + (chance < F.col("_r") - F.floor("_r")).cast("long")).cast("int")).drop("_u"), domains


def mix(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> DataFrame:
    """The mixed corpus: each row as often as its copies say, with the columns of ``docs``."""
    whole = docs.select("doc_id", "text", F.struct(*[docs[c] for c in docs.columns]).alias("_row"))
    out, _ = rates(whole, labels, ["_row"], s)
    return out.where("_copies > 0").withColumn("_i", F.explode(F.sequence(F.lit(1), "_copies"))).select("_row.*")


def mixture(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> DataFrame:
    """doc_id, n_tokens, p_<domain> for each domain, rate and copies of every document."""
    out, domains = rates(docs, labels, ["doc_id"], s)
    return out.select("doc_id", F.col("_n").alias("n_tokens"), *[F.col("_p")[i].alias(f"p_{d}") for i, d in enumerate(domains)], F.col("_r").alias("rate"), F.col("_copies").alias("copies"))
