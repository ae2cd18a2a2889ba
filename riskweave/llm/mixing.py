"""Mixing documents to target weights of soft domains, in DataFrame operations only.

A classifier learned from the labelled table gives each document a posterior over domains.
Nonnegative document rates are then fitted by projected-gradient least squares, so that the
expected tokens of each domain reach their target. The state of a step is one number for
each domain; the rates follow from it on the executors.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import WHITE, row_columns, with_row
from riskweave.session import materialize

DOMAINS = ("clean", "low_quality", "toxic")
TARGETS = {"clean": 0.94, "low_quality": 0.03, "toxic": 0.03}


def domain_of(quality: Column, toxic: Column) -> Column:
    """Domain number of a labelled row; null where the labels do not tell."""
    return F.when(toxic == 1, 2).when(quality == 0, 1).when((quality == 1) & (toxic == 0), 0)


def words_of(text: Column) -> Column:
    """Words between ASCII white space; null and empty texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"[{WHITE}]+"), lambda w: w != "")


def features(words: Column) -> Column:
    """Hashes of the words without final punctuation, of their last two characters, and of texts
    that say the same over and over."""
    whole = F.transform(words, lambda w: F.xxhash64(F.rtrim(w, F.lit(".,;:!?"))))
    ends = F.transform(words, lambda w: F.xxhash64(F.right(w, F.lit(2)), F.lit("end")))
    again = F.size(F.array_distinct(words)) * 5 < F.size(words)
    return F.concat(whole, ends, F.when(again, F.array(F.xxhash64(F.lit("again")))).otherwise(F.array().cast("array<long>")))


class Classifier:
    """Naive Bayes over the numbers of marks that a text holds of each domain but the first.

    `marks` has the features that mark a domain, `odds` the log probability of none, one, two,
    or more marks of each such domain, given the domain. `taught` has the labelled rows of each.
    """

    def __init__(self, log_prior: list[float], marks: list[list[int]], odds: list[list[list[float]]], taught: list[int]):
        self.log_prior, self.marks, self.odds, self.taught = log_prior, marks, odds, taught

    def posteriors(self, counted: DataFrame, *keep: str) -> DataFrame:
        """Columns `keep` and p, the array of domain probabilities, from a column `words`."""
        # Each step is its own projection, so no array is computed more than once.
        marked = counted.select(*keep, features(F.col("words")).alias("f")).select(
            *keep, *[held(F.col("f"), m).alias(f"m{k}") for k, m in enumerate(self.marks)]
        )
        scores = []
        for domain, prior in enumerate(self.log_prior):
            score = F.lit(prior)
            for k, by_domain in enumerate(self.odds):
                score = score + F.element_at(F.array(*map(F.lit, by_domain[domain])), F.col(f"m{k}") + 1)
            scores.append(score)
        powers = marked.select(*keep, F.array(*scores).alias("s")).select(*keep, F.transform("s", F.exp).alias("e"))
        total = F.aggregate("e", F.lit(0.0), lambda a, b: a + b)
        return powers.select(*keep, "e", total.alias("total")).select(*keep, F.transform("e", lambda v: v / F.col("total")).alias("p"))


#: Numbers of marks told apart: none, one, two, three and more.
BINS = 4


def held(found: Column, marks: list[int]) -> Column:
    """Number of the `marks` among the features of a text, up to the last bin."""
    constant = F.split(F.lit(",".join(map(str, marks))), ",").cast("array<bigint>") if marks else F.array().cast("array<bigint>")
    return F.least(F.size(F.array_intersect(found, constant)), F.lit(BINS - 1))


def fit_classifier(docs: DataFrame, labels: DataFrame, fit_rows: int = 20_000, share: float = 0.01, times: float = 12.0,
                   domains: int = len(DOMAINS)) -> Classifier:
    """Learn marks and their odds from labelled texts.

    Learned from at most `fit_rows` labelled rows, taken in the order of a hash of their id,
    so the sample does not depend on where rows lie. A mark of a domain is in at least `share`
    of its texts, three at least, and `times` as frequent there as in the first domain; there
    are no more than 1 / `share` times the features of a mean text. A domain without labelled
    rows gets no document; without any labelled row all domains are alike.
    """
    known = labels.select("doc_id", domain_of(F.col("quality"), F.col("toxic")).alias("domain")).where("domain is not null and doc_id is not null")
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id", "domain").limit(fit_rows)
    # At most fit_rows ids and numbers are sent to all tasks; only their texts are split.
    used = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("domain", words_of(F.col("text")).alias("words"))
    used = materialize(used.select("domain", F.array_distinct(features(F.col("words"))).alias("f")), "mixing-fit")
    totals = {r["domain"]: r["n"] for r in used.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    counts = [totals.get(k, 0) for k in range(domains)]
    hits = [F.sum((F.col("domain") == k).cast("long")).alias(f"n{k}") for k in range(domains)]
    seen = materialize(used.select("domain", F.explode("f").alias("f")).groupBy("f").agg(*hits), "mixing-features")
    marks = []
    for k in range(1, domains):
        rate = (F.col(f"n{k}") + 0.5) / (counts[k] + 1) / ((F.col("n0") + 0.5) / (counts[0] + 1))
        found = seen.where((F.col(f"n{k}") >= max(3.0, share * counts[k])) & (rate >= times)).select("f").collect()
        marks.append(sorted(r["f"] for r in found))
    told = used.groupBy("domain", *[held(F.col("f"), m).alias(f"m{k}") for k, m in enumerate(marks)]).agg(F.count(F.lit(1)).alias("n")).collect()
    odds = []
    for k in range(domains - 1):
        table = [[0.5] * BINS for _ in range(domains)]
        for r in told:
            table[r["domain"]][r[f"m{k}"]] += r["n"]
        odds.append([[math.log(v / sum(row)) for v in row] for row in table])
    prior = [math.log((n + 1) / (sum(counts) + domains)) if n or not any(counts) else -math.inf for n in counts]
    return Classifier(prior, marks, odds, counts)


def memberships(docs: DataFrame, classifier: Classifier, *keep: str) -> DataFrame:
    """Columns `keep`, tokens (words of the text) and p, the posterior over domains."""
    counted = docs.select(*keep, words_of(F.col("text")).alias("words"))
    counted = counted.select(*keep, "words", F.size("words").cast("long").alias("tokens"))
    return classifier.posteriors(counted, *keep, "tokens")


def _inverse(square: list[list[float]]) -> list[list[float]]:
    """Inverse of a small symmetric matrix with a little added to its diagonal."""
    n = len(square)
    ridge = 1e-9 + 1e-6 * sum(square[i][i] for i in range(n)) / n
    rows = [[square[i][j] + ridge * (i == j) for j in range(n)] + [float(i == j) for j in range(n)] for i in range(n)]
    for i in range(n):
        rows[i] = [v / rows[i][i] for v in rows[i]]
        for j in range(n):
            if j != i:
                rows[j] = [v - rows[j][i] * u for v, u in zip(rows[j], rows[i])]
    return [r[n:] for r in rows]


def largest(have: list[float], targets: list[float]) -> tuple[list[float], float]:
    """Amounts to aim at that keep the first domain whole and repeat none, and their sum.

    The targets of the other domains are upper bounds of their shares: a domain below its
    bound stays whole too, and the bounds of the others hold in the total that is left. All
    stays as it is where the first domain is absent, as no total then keeps the bounds.
    """
    if have[0] <= 1e-9:
        return list(have), sum(have)
    if targets[0] <= 0:
        raise ValueError("the first domain has no target; name a total")
    bound = [t / sum(targets) for t in targets]
    thinned, whole = sorted(range(1, len(have)), key=lambda i: have[i] / bound[i] if bound[i] > 0 else math.inf), have[0]
    while True:
        total = whole / (1 - sum(bound[i] for i in thinned))
        if not thinned or have[thinned[0]] >= bound[thinned[0]] * total:
            break
        whole += have[thinned.pop(0)]
    return [bound[i] * total if i in thinned else h for i, h in enumerate(have)], total


def fit_rates(members: DataFrame, targets: list[float], total: float | None = None, close: float = 1e-6, most: int = 400,
              stretch: int = 4, cap: float | None = None) -> tuple[DataFrame, float]:
    """`members` (written: tokens, p, ...) with `rate`, and the total of expected tokens aimed at.

    Minimises the squared gap between expected domain tokens and their targets over rates of
    at least 0, and at most `cap` if it is given, from rates of 1. The gap is measured in the metric of the token-weighted
    second moments of the posteriors, in which a gradient step of length one is exact where
    no rate falls below 0. Without `total` the first domain stays whole and the targets of the
    others are upper bounds, see `largest`. Steps go on until no domain's share of all tokens moves by more than `close`; targets are then met
    as far as nonnegative rates can. Raises where `most` steps do not settle. Each step is one
    aggregate over the small written table, whose rates are written after every `stretch` steps.
    """
    k = len(targets)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    moments = [F.sum(F.col("tokens") * F.col("p")[i] * F.col("p")[j]).alias(f"m{i}_{j}") for i, j in pairs]
    sums = [F.sum(F.col("tokens") * F.col("p")[i]).alias(f"s{i}") for i in range(k)]
    base = members.agg(F.sum("tokens").alias("n"), *sums, *moments).first()
    all_tokens = float(base["n"] or 0)
    if not all_tokens:
        return members.withColumn("rate", F.lit(1.0)), 0.0
    have = [base[f"s{i}"] / all_tokens for i in range(k)]
    metric = _inverse([[base[f"m{min(i, j)}_{max(i, j)}"] / all_tokens for j in range(k)] for i in range(k)])
    if total is None:
        aim, total = largest(have, targets)
        total *= all_tokens
    else:
        aim = [t * total / all_tokens for t in targets]
    one = F.lit(1.0)
    state, rate, before = members.withColumns({"rate": one, "before": one}), F.col("rate"), F.col("before")
    share, last, run, worst = have, have, 0, None
    for step in range(1, most + 1):
        # Momentum: the step starts ahead of the rates; it begins anew when the gap grows.
        ahead = run / (run + 3)
        gap = [s + ahead * (s - t) - a for s, t, a in zip(share, last, aim)]
        push = [sum(m * g for m, g in zip(row, gap)) for row in metric]
        pull = sum((F.col("p")[i] * push[i] for i in range(1, k)), F.col("p")[0] * push[0])
        stepped = F.greatest(F.lit(0.0), rate + ahead * (rate - before) - pull)
        rate, before = stepped if cap is None else F.least(F.lit(cap), stepped), rate
        if step % stretch == 0:
            state = materialize(state.withColumns({"rate": rate, "before": before}), "mixing-rates")
            rate, before = F.col("rate"), F.col("before")
        sums = state.agg(*[F.sum(F.col("tokens") * F.col("p")[i] * rate).alias(f"s{i}") for i in range(k)]).first()
        last, share = share, [sums[f"s{i}"] / all_tokens for i in range(k)]
        left = [s - a for s, a in zip(share, aim)]
        size = sum(x * sum(m * y for m, y in zip(row, left)) for x, row in zip(left, metric))
        moved = max(abs(a - b) for a, b in zip(share, last))
        if moved < close and size < close * close or moved < close / 10:
            return state.withColumn("rate", rate).drop("before"), total
        run, worst = (0 if worst is not None and size > worst else run + 1), size
    raise RuntimeError("rates did not settle; raise `most`")


def mix(docs: DataFrame, labels: DataFrame, *keep: str, targets: dict[str, float] = TARGETS, total: float | None = None,
        cap: float | None = None, **fit) -> DataFrame:
    """Columns `keep` (default doc_id), tokens, p (array in the order of DOMAINS) and rate of every row of `docs`.

    Null and empty texts have no tokens and the prior as posterior. Null ids and ids without
    labels take part like all others; only labelled ids teach. Repeated rows are rated alike.
    Where no label teaches the first domain, and no `total` is named, every rate is 1.
    """
    keep = keep or ("doc_id",)
    classifier = fit_classifier(docs, labels, **fit)
    members = materialize(memberships(docs, classifier, *keep), "mixing-members")
    if total is None and not classifier.taught[0]:
        return members.withColumn("rate", F.lit(1.0))
    # A rate follows from the posterior alone, and a posterior from the numbers of marks: the
    # rates are fitted on one row for each, at most BINS to the number of marked domains.
    alike = materialize(members.groupBy("p").agg(F.sum("tokens").alias("tokens")), "mixing-posteriors")
    fitted = fit_rates(alike, [targets[d] for d in DOMAINS], total, cap=cap)[0]
    rates = materialize(fitted.select("p", "rate"), "mixing-fitted")
    return members.join(F.broadcast(rates), "p").select(*members.columns, "rate")


def often(snap: float, repeat: bool) -> Column:
    """Expected number of times that a rated row is drawn."""
    rate = F.when((F.col("rate") >= 1 - snap) & (F.col("rate") < 1) & (F.col("p")[0] > 0.5), 1.0).otherwise(F.col("rate"))
    return rate if repeat else F.least(rate, F.lit(1.0))


def draw(docs: DataFrame, labels: DataFrame, snap: float = 0.1, repeat: bool = False, seed: int = 7, **how) -> DataFrame:
    """Rows of `docs`, each as often as its rate says: the whole part, and once more with the
    probability of the rest, drawn from a hash of id and row. A likely clean row whose rate is
    less than `snap` under 1 is drawn once. Without `repeat`, as fits a corpus freed from
    duplicates, rates are fitted between 0 and 1. Columns are those of `docs`. Texts are written
    once, beside their posterior, and not moved."""
    held = with_row(docs, doc_id=F.col("doc_id"), text=F.col("text"), uid=F.monotonically_increasing_id())
    rated = mix(held, labels, "row", "doc_id", "uid", cap=None if repeat else 1.0, **how)
    chance = F.pmod(F.xxhash64("doc_id", "uid", F.lit(seed)), F.lit(1 << 24)) / float(1 << 24)
    drawn = rated.select("row", F.floor(often(snap, repeat) + chance).cast("int").alias("times"))
    drawn = drawn.where("times > 0").select("row", F.explode(F.array_repeat(F.lit(0), F.col("times"))).alias("i"))
    return row_columns(drawn, docs.columns)
