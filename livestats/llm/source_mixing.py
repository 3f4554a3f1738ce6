"""Mixing to target weights with soft membership; texts are handled in DataFrame operations only.

A labelled table says which domain some documents belong to.  A naive Bayes
classifier over word and word-ending indicators with evidence for or against a
domain in a bounded sample of it gives every document posterior probabilities
over the domains.  Marks, which a domain has far oftener than others, count in
full; the many other indicators say much the same thing again and again, so
their log ratios are scaled by the strength that predicts a held-out half best.
Nonnegative rates (expected copies) of the documents are then fitted so that
the expected tokens of each domain, sum(rate * tokens * posterior), match the
target weights: least squares, each domain weighed by the inverse of its
natural share, solved by projected gradient steps from rate 1.

The gradient at a document depends on its posteriors alone.  So a step needs
one sum for each domain, and the rate of a document is a fold over the residuals
of all steps.  Documents are first summed into cells of similar posteriors, which
hold the exact sums of tokens and of tokens times posterior; the steps run on the
driver over at most MAX_CELLS cells until the targets are met, the projected
gradient vanishes or MAX_STEPS are done, which is reported.  The shares that
the rates give the documents themselves are then summed exactly, and the fit is
repeated with aims shifted by what the cells say otherwise, until both agree;
where cells are too coarse for that, the steps go on over the documents.  What
they then still miss of a target is reported in a warning.

Defined cases: a NULL or empty text has no tokens and the prior posteriors;
labelled rows with a NULL id or domain are not learned from, several labels of
one document count each; domains without a target get weight 0, targets of
domains that no labelled row has are left out and the rest scaled to sum 1;
without labelled rows there is one domain, all rates are 1; NULL ids and
repeated rows are documents of their own; an empty table yields no rows.
"""

from __future__ import annotations

import math
import warnings

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, whole
from .order_minhash import let

#: Labelled rows that the classifier is fitted on at most.
MAX_ROWS = 8000
#: Indicators that the model holds at most, those with most evidence.
MAX_INDICATORS = 1 << 16
#: An indicator counts if its rates in a domain and in all others differ by that many deviations (the root of the
#: likelihood ratio); it is a mark if a domain with that evidence has it oftener than expected by the factor.
MARK_FACTOR, LEAST_DEVIATIONS = 2.0, 5.0
#: Strengths tried for the indicators that are no marks.
OFFSET_STEPS = 200
STRENGTHS = (0.0, *(2.0 ** -k for k in range(8, -1, -1)))
MAX_DOMAINS = 64
#: Texts whose posteriors round to the same levels share a cell of the fit, which holds their exact sums.
LEVELS = 1024
#: Cells that the driver takes at most.
MAX_CELLS = 1 << 16
MAX_STEPS = 300
#: Largest error of a share at which the targets are met; mean change of a rate at which no step helps any more.
TOLERANCE, STILL = 1e-7, 1e-9
#: Difference between the shares of the documents and of their cells that the fit leaves.
CLOSE = 1e-6
#: A share that misses its target by more is reported.
REPORTED = 1e-3

#: Domains of the labelled table and the shares of tokens they are mixed to.
DOMAIN = "CASE WHEN toxic = 1 THEN 'toxic' WHEN quality = 0 THEN 'low' WHEN quality = 1 THEN 'clean' END"
TARGETS = {"clean": 0.92, "low": 0.06, "toxic": 0.02}


def _words(text: Column) -> Column:
    return F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def indicators(words: Column) -> Column:
    """Distinct 64-bit hashes: each folded word without its marks, its last two letters, and repeats."""
    return let(words, lambda w: F.array_distinct(F.concat(
        F.transform(w, lambda x: F.xxhash64(F.lit("word"), F.rtrim(F.lower(x), F.lit(".,;:!?")))),
        F.transform(w, lambda x: F.xxhash64(F.lit("end"), F.substring(x, -2, 2))),
        F.transform(F.filter(w, lambda x, i: F.coalesce(F.get(w, i - 1) == x, F.lit(False))),
                    lambda x: F.xxhash64(F.lit("again"))))))


def _constant(values: list, kind: str) -> Column:
    return F.split(F.lit(",".join(map(repr, values))), ",").cast(f"array<{kind}>")


def places_of(hashes: list[int]) -> tuple[list[int], list[int]]:
    """Displacements and places of a perfect hash: each hash's number, from 1, at a place of its own."""
    n_places = 1 << max(10, (4 * len(hashes)).bit_length())
    while True:
        n_buckets = n_places // 4
        buckets: dict[int, list[tuple[int, int]]] = {}
        for k, x in enumerate(hashes, 1):
            buckets.setdefault(x % n_buckets, []).append((k, (x & (1 << 64) - 1) >> 24))
        shifts, place = [0] * n_buckets, [0] * n_places
        for bucket, entries in sorted(buckets.items(), key=lambda e: (-len(e[1]), e[0])):
            if len({x % n_places for _, x in entries}) < len(entries):
                break
            shift = next((d for d in range(n_places) if not any(place[(x + d) % n_places] for _, x in entries)), None)
            if shift is None:
                break
            shifts[bucket] = shift
            for k, x in entries:
                place[(x + shift) % n_places] = k
        else:
            return shifts, place
        n_places *= 2


class Domains:
    """Log priors, and the log-likelihood ratios of the indicators that count, for each domain."""

    def __init__(self, names: list[str], prior: list[float], weights: dict[int, list[float]]):
        self.names, self.prior, self.weights = names, prior, weights

    def found(self, hashes_of_text: Column) -> Column:
        """Numbers, from 1, of the indicators of a text that count."""
        own = sorted(self.weights)
        shifts, place = places_of(own)
        # constant arrays: displacements and places of a perfect hash, and one entry for each indicator that counts
        displaced, places, hashes = _constant(shifts, "int"), _constant(place, "int"), _constant([0, *own], "bigint")

        def at(x: Column) -> Column:
            moved = F.shiftrightunsigned(x, 24) + F.get(displaced, F.pmod(x, F.lit(len(shifts))).cast("int"))
            return F.get(places, F.pmod(moved, F.lit(len(place))).cast("int"))

        return F.filter(F.transform(F.filter(hashes_of_text, lambda x: F.get(hashes, at(x)) == x), at), lambda k: k > 0)

    def logits(self, found: Column) -> Column:
        """Prior and log ratios of the indicators found, summed for each domain."""
        own = sorted(self.weights)
        tables = [_constant([0.0, *(self.weights[x][k] for x in own)], "double") for k in range(len(self.names))]

        def adder(table: Column):
            return lambda s, x: s + F.get(table, x)

        return F.array(*[F.aggregate(found, F.lit(p), adder(t)) for p, t in zip(self.prior, tables, strict=True)])

    def posteriors(self, words: Column) -> Column:
        """Posterior probabilities of a text's domains; they sum to 1."""
        if len(self.names) < 2:
            return F.array(F.lit(1.0))
        def normal(z: Column) -> Column:
            e = let(F.array_max(z), lambda top: F.transform(z, lambda x: F.exp(x - top)))
            return let(e, lambda v: let(F.aggregate(v, F.lit(0.0), lambda s, x: s + x),
                                        lambda total: F.transform(v, lambda x: x / total)))

        return let(let(let(indicators(words), self.found), self.logits), normal)


def fit_domains(docs: DataFrame, labelled: DataFrame, max_rows: int = MAX_ROWS) -> Domains:
    """Naive Bayes over a bounded sample of ``labelled`` (``doc_id, domain``), by hash order."""
    some = labelled.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("domain").cast("string").alias("domain"))
    some = some.where("doc_id is not null and domain is not null").orderBy(
        F.xxhash64("doc_id"), "doc_id", "domain").limit(max_rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole().alias("text"))
    # bounded by max_rows; of equal texts of one domain one is learned from
    sample = stored(texts.join(F.broadcast(some), "doc_id").dropDuplicates(["domain", "text"]).select(
        "domain", (F.pmod(F.xxhash64(F.lit("half"), "text"), F.lit(2)) == 1).alias("held"),
        indicators(_words(F.col("text"))).alias("x")), "mixing-sample")
    n = {r["domain"]: r["n"] for r in sample.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(n) > MAX_DOMAINS:
        raise ValueError(f"more than {MAX_DOMAINS} domains")
    if not n:
        return Domains(["all"], [0.0], {})
    names, total = sorted(n), sum(n.values())
    prior = [n[k] / total for k in names]
    # how far the other indicators are to be trusted: fitted on one half, compared on the other
    strength = _strength(*_logits(sample.where("held"), *_fitted(sample.where(~F.col("held")), names, prior)))
    marks, others = _fitted(sample, names, prior)
    own, z, y = _logits(sample, marks, others)
    marks.prior = (np.array(marks.prior) + _offsets(own, z + strength * y)).tolist()
    scaled = {x: [strength * v for v in w] for x, w in others.weights.items()} if strength else {}
    return Domains(names, marks.prior, marks.weights | scaled)


def _evidence(here: Column, everywhere: Column, n: int, total: int) -> Column:
    """Likelihood ratio statistic of an indicator's rate in a domain of ``n`` rows against that in all others."""
    def part(seen: Column, rows: Column, of: int) -> Column:
        expected = rows * (of / total)
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    absent = F.lit(total) - everywhere
    return 2 * (part(here, everywhere, n) + part(everywhere - here, everywhere, total - n)
                + part(F.lit(n) - here, absent, n) + part(absent - F.lit(n) + here, absent, total - n))


def _fitted(sample: DataFrame, names: list[str], prior: list[float]) -> tuple[Domains, Domains]:
    """The marks, with the prior of texts without any, and the other indicators that count, with a prior of no weight."""
    n = {r["domain"]: r["n"] for r in sample.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(n.values())
    size = [n.get(k, 0) for k in names]
    found = sample.select("domain", F.explode("x").alias("x")).groupBy("x").agg(
        F.count(F.lit(1)).alias("all"), *[F.count_if(F.col("domain") == k).alias(f"n{i}") for i, k in enumerate(names)])
    evidence = [F.lit(0.0), F.lit(0.0), *[_evidence(F.col(f"n{i}"), F.col("all"), m, total)
                                          for i, m in enumerate(size) if 0 < m < total]]
    least = LEAST_DEVIATIONS ** 2
    is_mark = F.lit(False)
    for i, m in enumerate(size):
        if 0 < m < total:
            is_mark = is_mark | (F.col(f"n{i}") >= MARK_FACTOR * F.col("all") * (m / total)) & (
                _evidence(F.col(f"n{i}"), F.col("all"), m, total) >= least)
    best = found.withColumn("evidence", F.greatest(*evidence)).withColumn("mark", is_mark).where(
        F.col("evidence") >= least).orderBy(F.desc("evidence"), "x").limit(MAX_INDICATORS).collect()
    weights: tuple[dict, dict] = ({}, {})
    for r in best:  # drawn towards the expected count as by two more documents
        weights[not r["mark"]][r["x"]] = [math.log((r[f"n{i}"] + 2) / (m * r["all"] / total + 2))
                                          for i, m in enumerate(size)]
    marks, others = Domains(names, [], weights[0]), Domains(names, [0.0] * len(names), weights[1])
    # the prior is that of texts without marks
    plain = {r["domain"]: r["n"] for r in sample.where(F.size(marks.found(F.col("x"))) == 0).groupBy("domain").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    marks.prior = [math.log((plain.get(k, 0) + p) / (sum(plain.values()) + 1)) for k, p in zip(names, prior, strict=True)]
    return marks, others


def _logits(rows: DataFrame, marks: Domains, others: Domains) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every row of the bounded sample: its domain, and the logits by its marks and by its other indicators."""
    own = F.array_position(F.array(*map(F.lit, marks.names)), F.col("domain")).cast("int")
    got = rows.select(own.alias("own"), marks.logits(marks.found(F.col("x"))).alias("z"),
                      others.logits(others.found(F.col("x"))).alias("y")).collect()
    z, y = (np.array([r[k] for r in got], float).reshape(len(got), len(marks.names)) for k in "zy")
    return np.array([r["own"] - 1 for r in got], int), z, y


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _offsets(own: np.ndarray, z: np.ndarray) -> np.ndarray:
    """What to add to the prior so that the posteriors of the rows sum to the rows of each domain."""
    offsets = np.zeros(z.shape[1])
    n = np.bincount(own, minlength=z.shape[1])
    for _ in range(OFFSET_STEPS if len(own) else 0):
        step = np.log((n + 0.5) / (_softmax(z + offsets).sum(axis=0) + 0.5))
        offsets += step
        if np.abs(step).max() < 1e-6:
            break
    return offsets


def _strength(own: np.ndarray, z: np.ndarray, y: np.ndarray) -> float:
    """The strength of the other indicators under which the held-out domains are most likely."""
    def loss(strength: float) -> float:
        logits = z + strength * y
        p = _softmax(logits + _offsets(own, logits))[np.arange(len(own)), own]
        return -np.log(np.maximum(p, 1e-300)).sum()

    return min(STRENGTHS, key=loss) if len(own) and y.any() else 0.0


def membership(docs: DataFrame, domains: Domains, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, n_tokens, p`` of every document; a token is a word."""
    words = _words(whole())
    both = let(words, lambda w: F.struct(F.size(w).cast("long").alias("n"), domains.posteriors(w).alias("p")))
    return docs.select(F.col("doc_id").alias("doc_id"), both.alias("both"), *[c for c in keep if c != "doc_id"]).select(
        "doc_id", F.col("both.n").alias("n_tokens"), F.col("both.p").alias("p"), *[c for c in keep if c != "doc_id"])


def _rate(p: Column, steps: list[list[float]]) -> Column:
    """The rate after projected gradient steps with these (weighed) residuals."""
    if not steps:
        return F.lit(1.0)
    history = F.array(*[F.array(*map(F.lit, e)) for e in steps])
    return F.aggregate(history, F.lit(1.0), lambda w, e: F.greatest(F.lit(0.0), w - F.aggregate(
        F.zip_with(p, e, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)))


def fit_rates(members: DataFrame, names: list[str], targets: dict[str, float],
              max_steps: int = MAX_STEPS, gains: str | None = None) -> list[list[float]]:
    """The residuals of all steps; ``_rate`` folds them into rates.

    The domain that ``gains`` names gets what the others lose: their targets
    are at most their natural shares, and its own is the rest.
    """
    each = range(len(names))
    levels = LEVELS * 2
    while True:  # fewer levels if there are too many cells for the driver; the sums stay exact
        levels //= 2
        cells = members.where("n_tokens > 0").groupBy(F.transform("p", lambda x: F.round(x * levels)).alias("level")).agg(
            F.sum("n_tokens").alias("n"), F.array(*[F.sum(F.col("n_tokens") * F.get("p", k)) for k in each]).alias("m"))
        if levels == 1:  # every cell: MAX_DOMAINS domains have no more than 2081
            got = cells.select("n", "m").collect()
            break
        got = cells.select("n", "m").limit(MAX_CELLS + 1).collect()
        if len(got) <= MAX_CELLS:
            break
    n, m = np.array([r.n for r in got], float), np.array([r.m for r in got], float).reshape(len(got), len(names))
    natural = m.sum(axis=0).tolist()
    total = sum(x or 0.0 for x in natural)
    if not total:
        return []
    natural = [x / total for x in natural]
    if gains in names:
        targets = {k: min(targets.get(k, 0.0), s) for k, s in zip(names, natural, strict=True) if k != gains}
        targets[gains] = 1 - sum(targets.values())
    goal = [targets.get(k, 0.0) if s > 0 else 0.0 for k, s in zip(names, natural, strict=True)]
    if lost := [k for k, s in zip(names, natural, strict=True) if targets.get(k, 0.0) and not s]:
        warnings.warn(f"mixing: no text has any part in {lost}; the other targets are scaled to sum 1", stacklevel=2)
    if not sum(goal):
        return []
    goal = [g / sum(goal) for g in goal]
    p, shares, goals = m / n[:, None], np.array(natural), np.array(goal)

    def weighed(error: np.ndarray) -> np.ndarray:
        return np.divide(error, shares, out=np.zeros(len(names)), where=shares > 0)

    def fitted(aims: np.ndarray) -> tuple[list[list[float]], np.ndarray, float]:
        """The steps towards the aims over the cells, the shares that the cells have after them, and the last movement."""
        steps: list[list[float]] = []
        w, moved = np.ones(len(n)), np.inf
        for _ in range(max_steps):
            error = w @ m / total - aims  # one number for each domain
            step = weighed(error)
            new = np.maximum(0.0, w - p @ step)
            moved = np.abs(new - w) @ n / total  # the projected gradient
            if np.abs(error).max() < TOLERANCE or moved < STILL:
                return steps, w @ m / total, 0.0
            steps.append(step.tolist())
            w = new
        return steps, w @ m / total, moved

    def shares_after(steps: list[list[float]]) -> np.ndarray:
        """The shares of the documents themselves, by one pass over them."""
        got = members.withColumn("w", _rate(F.col("p"), steps)).agg(
            *[F.sum(F.col("w") * F.col("n_tokens") * F.get("p", k)).alias(f"s{k}") for k in each]).first()
        return np.array([x or 0.0 for x in got]) / total

    # what the documents have more or less than their cells is taken off the aims, until that changes no more
    aims, apart = goals, np.inf
    while True:
        steps, reached, moved = fitted(aims)
        exact = shares_after(steps)
        further = goals - (exact - reached)
        change = np.abs(further - aims).max()
        if change < CLOSE or change > apart / 2:
            break
        aims, apart = further, change
    if change >= CLOSE:  # cells too coarse for that: the steps go on over the documents
        moved = np.inf
        for _ in range(max_steps):
            if (left := np.abs(exact - goals).max()) < CLOSE:
                moved = 0.0
                break
            more = [*steps, weighed(exact - goals).tolist()]
            now = shares_after(more)
            moved = np.abs(now - exact).max()
            if np.abs(now - goals).max() > left:
                break
            steps, exact = more, now
            if moved < STILL:
                moved = 0.0
                break
    if moved:
        warnings.warn(f"mixing: the fit has not converged after {len(steps)} steps; a rate still changes by "
                      f"{moved:.2g} a step on average", stacklevel=2)
    got = exact * total
    if missed := {k: (x / total, g) for k, x, g in zip(names, got, goal, strict=True) if abs(x / total - g) > REPORTED}:
        warnings.warn("mixing: shares miss their targets: " + ", ".join(
            f"{k} has {x:.4f} of {g:.4f}" for k, (x, g) in missed.items()), stacklevel=2)
    return steps


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], max_rows: int = MAX_ROWS) -> DataFrame:
    """``doc_id, n_tokens, p_<domain>..., rate`` of every document."""
    domains = fit_domains(docs, labelled, max_rows)
    members = stored(membership(docs, domains), "mixing-members")
    steps = fit_rates(members, domains.names, targets)
    return members.select("doc_id", "n_tokens", *[F.get("p", k).alias(f"p_{x}") for k, x in enumerate(domains.names)],
                          _rate(F.col("p"), steps).alias("rate"))


def resample(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], max_rows: int = MAX_ROWS,
             gains: str | None = None) -> DataFrame:
    """The columns of ``docs``, each row as often as its rate says.

    With ``gains``, that domain gets what the others lose, and every text that
    is likelier of it than of any other domain is there at least once.

    The whole part of a rate gives copies for sure, the rest one more by a
    hash of doc_id and text, so the result is the same at every run.
    """
    domains = fit_domains(docs, labelled, max_rows)
    members = stored(membership(docs, domains).drop("doc_id"), "mixing-members")
    steps = fit_rates(members, domains.names, targets, gains=gains)

    def rate_of(p: Column) -> Column:
        if gains not in domains.names:
            return _rate(p, steps)
        its_own = F.get(p, domains.names.index(gains)) >= F.array_max(p)
        return F.greatest(_rate(p, steps), F.when(its_own, 1.0).otherwise(0.0))

    rate = let(domains.posteriors(_words(whole())), rate_of)
    chance = F.pmod(F.xxhash64(F.lit("mixing"), F.col("doc_id"), F.col("text")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    copies = let(rate, lambda r: F.floor(r) + F.when(chance < r - F.floor(r), 1).otherwise(0))
    columns = docs.columns
    taken = docs.withColumn("_copies", copies.cast("int")).where("_copies > 0")
    return taken.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(*columns)


def domain_labels(labels: DataFrame) -> DataFrame:
    """The labelled table that the registered query uses: ``doc_id, domain``."""
    return labels.select("doc_id", F.expr(DOMAIN).alias("domain"))
