"""Mixing to target weights with soft domain membership.

A classifier fitted on the labels table gives every document a posterior over
domains, by features that are scaled to the text's length, so that long texts too
stay between domains. Nonnegative rates r minimise the squared relative distance between the
expected domain tokens, sum of r * tokens * posterior, and the targets. Each step
of projected gradient (accelerated) is one narrow pass and one small aggregate
over the table of posteriors; a document's rate follows from its posterior and
the steps so far, so nothing per document is kept between steps or reaches the
driver.

Tokens are counted twice: as words of ``kernel`` (``tokens``) and as BPE tokens
(``bpe_tokens``). Words per BPE token differ by domain, so each count has its own
rates; only those by BPE tokens meet the targets in what ``token_orc`` writes.
"""

from __future__ import annotations

import logging

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernel as K
from .common import fresh, map_batches, one_text_each, table, trimmed, written
from .token_orc import VOCABULARY, encode, encoder

_log = logging.getLogger(__name__)
#: Target share of tokens of each domain; the total stays that of the input. The keys are the domains (letters, digits and _).
TARGETS = {"good": 0.90, "poor": 0.09, "toxic": 0.01}
DOMAINS = tuple(TARGETS)
#: The classifier is fitted on at most so many labelled documents, chosen by hash of the id.
LABELLED = 6000
BUCKETS = 1 << 16
#: Length of a text's vector of word features.
SCALE = 4.0
FIT_ROUNDS = 200
#: Word buckets are used that tell domains apart by so many standard deviations. By cross-validation 8 is better than 6 and 12 better still,
#: but at 12 a fit on some 90 labels is too soft to reach the targets.
EVIDENCE = 8.0
#: The solver stops after so many steps, if neither the targets nor a standstill are reached before; it says which.
STEPS = 200
TOLERANCE = 1e-3
#: Rates are written after so many steps, so that a step replays these at most.
REPLAYED = 20


def default_domain() -> Column:
    """The domain of a row of the labels table; toxic text is one domain, whatever its quality; null with a null label."""
    return F.when(F.col("quality").isNull() | F.col("toxic").isNull(), None).when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").otherwise("poor")


def features(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, word bucket, value; rows x 4 style features: symbols, capitals, digits, 1; words of each row).

    A value is the logarithm of a bucket's count; a row's values are scaled to a vector
    of length ``SCALE``, so that they don't grow with the text. The fit and its use
    both take these.
    """
    words = K.Words(raw, offsets)
    size = np.diff(offsets)
    part = lambda m: np.where(size == 0, 0, np.add.reduceat(np.r_[m, False], np.minimum(offsets[:-1], len(m)), dtype=np.int64)) / np.maximum(size, 1)
    symbol = ~K._IS_WORD[raw] & (raw > 32) & (raw != 46) & (raw != 44)
    style = np.stack([part(symbol), part((raw >= 65) & (raw <= 90)), part((raw >= 48) & (raw <= 57)), np.ones(len(size))], 1)
    key, count = np.unique(words.row.astype(np.int64) * BUCKETS + (words.hash & np.uint64(BUCKETS - 1)).astype(np.int64), return_counts=True)
    row, value = key // BUCKETS, np.log1p(count)
    value *= SCALE / np.sqrt(np.maximum(np.bincount(row, value * value, len(size)), 1e-12))[row]
    return row, key % BUCKETS, value, style, np.diff(words.first)


def _softmax(z: np.ndarray) -> np.ndarray:
    p = np.exp(z - z.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


class Classifier:
    """Softmax regression on ``features``."""

    def __init__(self, domains: tuple[str, ...], weights: np.ndarray, style: np.ndarray):
        self.domains, self.weights, self.style = domains, weights, style

    def posterior(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows x domains, words of each row)."""
        row, bucket, value, style, n = features(raw, offsets)
        z = style @ self.style
        for k in range(z.shape[1]):
            z[:, k] += np.bincount(row, self.weights[bucket, k] * value, len(n))
        return _softmax(z), n


def fit(docs: DataFrame, labels: DataFrame, limit: int = LABELLED, domains: tuple[str, ...] = DOMAINS, domain: Column | None = None) -> Classifier:
    """From at most ``limit`` labelled documents.

    ``domain`` is the domain's name as an expression over the labels table. Labels with a null, or of no
    known domain, and documents without text are not used; of several labels of a document
    the last domain in order counts, of several texts the smallest. Without any label all
    domains are equally likely.
    """
    k = len(domains)
    at = F.array_position(F.array(*map(F.lit, domains)), domain if domain is not None else default_domain()) - 1
    lab = labels.select(F.col("doc_id").cast("long").alias("doc_id"), at.alias("domain")).where("doc_id IS NOT NULL AND domain >= 0").groupBy("doc_id").agg(F.max("domain").alias("domain"))
    chosen = lab.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit).collect()
    of = {r.doc_id: int(r.domain) for r in chosen}
    weights, style = np.zeros((BUCKETS, k)), np.zeros((4, k))
    rows = one_text_each(docs, [*of]).sort_by("doc_id") if of else None
    if rows is None or not rows.num_rows:
        return Classifier(domains, weights, style)
    y = np.array([of[i] for i in rows["doc_id"].to_pylist()])
    parts = [(base, *features(r, o)) for base, r, o in K.chunks(*K.buffers(rows["text"].combine_chunks()))]
    row, bucket, value, shape = np.concatenate([p[1] + p[0] for p in parts]), *(np.concatenate([p[i] for p in parts]) for i in (2, 3, 4))
    # presence log-odds choose the buckets that tell domains apart; only these are fitted
    one = np.eye(k)[y]
    seen = np.stack([np.bincount(bucket, one[row, d], BUCKETS) for d in range(k)], 1)
    total = one.sum(0) + 1.0
    rate = (seen + 0.5) / total
    rest = (seen.sum(1, keepdims=True) - seen + 0.5) / (len(y) - one.sum(0) + 1.0)
    odds = np.log(rate / rest)
    z = (rate - rest) / np.sqrt(rate * (1 - np.minimum(rate, 0.999)) / total + 1e-9)
    strong = (np.abs(z).max(1) > EVIDENCE) & (np.abs(odds).max(1) > 1.5)
    use = strong[bucket]
    row, bucket, value = row[use], bucket[use], value[use]
    balance = (len(y) / (k * total))[y]
    g2w, g2s = np.full((BUCKETS, k), 1e-6), np.full((4, k), 1e-6)
    for _ in range(FIT_ROUNDS):  # full-batch AdaGrad
        s = shape @ style
        for d in range(k):
            s[:, d] += np.bincount(row, weights[bucket, d] * value, len(y))
        err = (_softmax(s) - one) * balance[:, None] / len(y)
        gw = np.stack([np.bincount(bucket, err[row, d] * value, BUCKETS) for d in range(k)], 1) + 1e-5 * weights * strong[:, None]
        gs = shape.T @ err
        g2w += gw**2
        g2s += gs**2
        weights -= 0.3 * gw / np.sqrt(g2w)
        style -= 0.3 * gs / np.sqrt(g2s)
    # the fit weighs classes equally; the prior is put back
    style[3] += np.log(total / total.sum())
    return Classifier(domains, weights, style)


def _schema(domains: tuple[str, ...], *more: str) -> str:
    return ", ".join(["doc_id long, tokens long, bpe_tokens long", *(f"p_{d} double" for d in domains), *more])


def posteriors(docs: DataFrame, model: Classifier, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, tokens, bpe_tokens, p): tokens are words as in ``kernel``, bpe_tokens those of the vocabulary, as ``bpe_count`` counts them; a text without words has 0 tokens and the prior of the style features."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    domains = model.domains

    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        raw, offsets = K.buffers(b.column("text"))
        found = [sent.value.posterior(r, o) for _, r, o in K.chunks(raw, offsets)]
        p, n = np.round(np.concatenate([x for x, _ in found]), 9), np.concatenate([x for _, x in found])
        enc = encoder(vocabulary)
        bpe = [len(encode(enc, x.as_py())) if x.is_valid else 0 for x in b.column("text")]
        return pa.record_batch([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(bpe, pa.int64()), *(pa.array(p[:, d]) for d in range(len(domains)))], ["doc_id", "tokens", "bpe_tokens", *(f"p_{d}" for d in domains)])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_batches(narrow, each, _schema(domains))


class Solution:
    """``steps`` of projected gradient, the ``shares`` that they reach, and whether the solver ``converged`` (``reached`` tells whether at the targets)."""

    def __init__(self, steps: list, shares: dict[str, float], reached: bool, converged: bool):
        self.steps, self.shares, self.reached, self.converged = steps, shares, reached, converged


def solve(members: DataFrame, targets: dict[str, float], domains: tuple[str, ...] = DOMAINS, steps: int = STEPS, tolerance: float = TOLERANCE, count: str = "tokens") -> Solution:
    """The steps of accelerated projected gradient from rate 1: (gradient step of each domain, momentum).

    The objective is half the sum over domains of (expected tokens - target)^2 over
    the domain's own curvature, so that rare domains converge as fast as common
    ones; the gradient is taken per token, so a document's next rate is a function
    of its posterior and the steps alone. Momentum starts afresh when the objective rises. Stops when every domain is within
    ``tolerance`` of its target (of 0.1 % of the total, if the target is less), when
    ten steps have not made the objective better by a thousandth (targets that the documents can't supply), or
    after ``steps``, which is logged as a warning. Without any
    tokens or targets there are no steps and all rates stay 1. ``count`` names the
    column of ``members`` that the shares are of.
    """
    share = np.array([max(float(targets.get(d, 0)), 0) for d in domains])
    p = [F.col(f"p_{d}") for d in domains]
    gram = members.agg(F.sum(count).alias("n"), *(F.sum(F.col(count) * a * b).alias(f"g{i}_{j}") for i, a in enumerate(p) for j, b in enumerate(p))).first()
    everything = float(gram["n"] or 0)
    if not everything or not share.sum():
        return Solution([], {}, True, True)
    goal = share / share.sum() * everything
    m = np.array([[gram[f"g{i}_{j}"] for j in range(len(p))] for i in range(len(p))])
    scale = 1 / np.sqrt(np.maximum(np.diag(m), 1e-12 * m.max()))
    near = 1 / np.maximum(goal, 1e-3 * everything)
    # the largest curvature of the objective in the per-token metric
    lipschitz = float(np.linalg.eigvalsh(np.diag(scale) @ m @ np.diag(scale)).max())
    done: list[tuple[list[float], float]] = []
    costs: list[float] = []
    written_at = 0
    t = 1.0

    def replayed(batches, steps):
        for b in batches:
            tokens, p = _members(b, count, domains)
            rate, ahead = replay(p, tokens, steps, _state(b))
            yield pa.record_batch([*b.columns[: 3 + len(domains)], pa.array(rate), pa.array(ahead)], [*b.schema.names[: 3 + len(domains)], "rate_now", "rate_ahead"])

    def expected(batches, steps):
        for b in batches:
            tokens, p = _members(b, count, domains)
            rate, ahead = replay(p, tokens, steps, _state(b))
            yield pa.record_batch([pa.array([x]) for x in [*(ahead * tokens) @ p, *(rate * tokens) @ p]], [f"e{i}" for i in range(2 * len(domains))])

    reached = still = False
    while True:
        sums = members.mapInArrow(lambda batches, now=done[written_at:]: expected(batches, now), ", ".join(f"e{i} double" for i in range(2 * len(domains))))
        got = np.array(sums.groupBy().sum().first(), float)
        at_ahead, at_rate = got[: len(domains)], got[len(domains) :]
        reached = bool((np.abs(at_rate - goal) * near).max() < tolerance)
        costs.append(float((scale**2 * (at_rate - goal) ** 2).sum()))
        still = len(costs) > 10 and min(costs[-10:]) > 0.999 * min(costs[:-10])
        if reached or still or len(done) >= steps:
            break
        if len(costs) > 1 and costs[-1] > costs[-2]:
            t = 1.0
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        done.append((((at_ahead - goal) * scale * scale / lipschitz).tolist(), (t - 1) / after))
        t = after
        if len(done) - written_at >= REPLAYED:
            members = written(members.mapInArrow(lambda batches, now=done[written_at:]: replayed(batches, now), _schema(domains, "rate_now double", "rate_ahead double")), "rates")
            written_at = len(done)
    shares = dict(zip(domains, (at_rate / everything).tolist(), strict=True))
    _log.log(logging.INFO if reached or still else logging.WARNING, "mixing by %s: %s after %d steps, shares %s", count, "targets reached" if reached else "standstill" if still else "not converged", len(done), shares)
    return Solution(done, shares, reached, reached or still)


def _members(b: pa.RecordBatch, count: str, domains: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray]:
    p = np.stack([b.column(f"p_{d}").to_numpy(zero_copy_only=False) for d in domains], 1)
    return b.column(count).to_numpy(zero_copy_only=False).astype(float), p


def _state(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray] | None:
    return (b.column("rate_now").to_numpy(), b.column("rate_ahead").to_numpy()) if "rate_now" in b.schema.names else None


def replay(p: np.ndarray, tokens: np.ndarray, steps: list, state: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(rate, the place where the next gradient is taken) of each document after the steps, from ``state`` or from 1; 1 for one without tokens."""
    rate, ahead = state or (np.ones(len(p)), np.ones(len(p)))
    for step, momentum in steps:
        new = np.maximum(ahead - p @ np.array(step), 0)
        rate, ahead = new, new + momentum * (new - rate)
    return np.where(tokens > 0, rate, 1.0), np.where(tokens > 0, ahead, 1.0)


def mixing_rates(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, vocabulary: str = VOCABULARY, domain: Column | None = None, **kw) -> DataFrame:
    """(doc_id, tokens, bpe_tokens, p_<domain>..., rate, bpe_rate) of every row.

    The domains are the keys of ``targets``, ``domain`` (see ``fit``) tells them from the labels. A rate is how often a document is expected to be taken: ``rate`` for targets in
    words, ``bpe_rate`` for targets in BPE tokens. A null or empty text has 0 of
    either and rates 1, one without words 0 tokens and rate 1; repeated rows are
    separate supply, null ids are carried, other columns are not read.
    """
    domains = tuple(targets) or DOMAINS
    members = written(posteriors(docs, fit(docs, labels, domains=domains, domain=domain), vocabulary), "posteriors")
    both = {count: solve(members, targets, domains, count=count, **kw).steps for count in ("tokens", "bpe_tokens")}

    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        rates = []
        for count, steps in both.items():
            tokens, p = _members(b, count, domains)
            rates.append(pa.array(np.round(replay(p, tokens, steps)[0], 6)))
        return pa.record_batch([*b.columns, *rates], [*b.schema.names, "rate", "bpe_rate"])

    return map_batches(members, each, _schema(domains, "rate double", "bpe_rate double"))


def mixed(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, count: str = "tokens", vocabulary: str = VOCABULARY, domain: Column | None = None, **kw) -> DataFrame:
    """The documents, each as often as its rate says: the whole part of the rate always, once more if a draw falls below the fraction.

    The draw is a hash of doc_id and text, so that it is the same on every run and
    rows of one doc_id with other texts have their own; equal rows share one. A row without an id draws
    by its text and its place in the input as well. ``count`` is what the targets are shares of: "tokens" (words) or "bpe_tokens".
    All columns stay. Texts never move: the last pass works out each row's rate
    again from its posterior and the steps.
    """
    domains = tuple(targets) or DOMAINS
    model = fit(docs, labels, domains=domains, domain=domain)
    steps = solve(written(posteriors(docs, model, vocabulary), "posteriors"), targets, domains, count=count, **kw).steps
    sent = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    hashed = F.when(F.col("doc_id").isNull(), F.xxhash64(F.lit("mix"), "text", F.monotonically_increasing_id())).otherwise(F.xxhash64(F.lit("mix"), F.col("doc_id").cast("long"), "text"))
    drawn = docs.withColumn(fresh(docs, "__draw"), F.pmod(hashed, F.lit(1 << 30)) / F.lit(float(1 << 30)))
    at = names.index("text")

    def take(batches):
        for b in batches:
            if not b.num_rows:
                continue
            raw, offsets = K.buffers(b.column(at))
            found = [sent.value.posterior(r, o) for _, r, o in K.chunks(raw, offsets)]
            p, n = np.round(np.concatenate([x for x, _ in found]), 9), np.concatenate([x for _, x in found])
            if count != "tokens":
                n = np.diff(offsets)  # only whether there are any matters; a text of any byte has BPE tokens
            rate = np.round(replay(p, n.astype(float), steps)[0], 6)
            times = np.floor(rate) + (b.column(len(names)).to_numpy(zero_copy_only=False) < rate - np.floor(rate))
            # a few rows at a time: copies of long texts shouldn't pile up in one batch
            where = np.repeat(np.arange(b.num_rows), times.astype(np.int64))
            for k in range(0, len(where), 2000):
                yield pa.record_batch(b.columns[:-1], names=b.schema.names[:-1]).take(pa.array(where[k : k + 2000]))

    return drawn.mapInArrow(trimmed(take), docs.schema)


def op6_mixing_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing_rates(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
