import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.llm import labelled, mixing, quality, toxicity
from riskweave.llm.queries import QUERIES
from riskweave.session import materialize, open_stages

SF = "/root/testdata/sf0.01"


def held_out(spark, name, label, sf=SF):
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", label)
    rows = QUERIES[name](spark, sf).join(labels, "doc_id").where("held_out").collect()
    return np.array([r.score for r in rows]), np.array([r[label] for r in rows]), np.array([r.predicted for r in rows])


def auc(score, y):
    return np.mean([(a > b) + (a == b) / 2 for a in score[y == 1] for b in score[y == 0]])


def test_quality_of_held_out_documents(spark):
    score, y, predicted = held_out(spark, "op2_quality", "quality")
    assert len(y) > 50 and auc(score, y) > 0.97 and (predicted == y).mean() > 0.95 and set(predicted) == {0, 1}


def test_toxicity_of_held_out_documents(spark):
    score, y, predicted = held_out(spark, "op6_toxicity", "toxic", "/root/testdata/sf0.1")
    assert auc(score, y) > 0.85 and predicted[y == 0].mean() < 0.05 and predicted[y == 1].mean() > 0.6


def test_labels_and_other_columns_are_no_inputs(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    for classify, parts, held in ((quality.classify, 5, 0), (toxicity.classify, 4, 2)):
        column = "quality" if classify is quality.classify else "toxic"
        from riskweave.llm.common import fold

        hidden = labels.withColumn(column, F.when(fold(F.col("doc_id"), parts) == held, 1 - F.col(column)).otherwise(F.col(column)))
        a = {r.doc_id: r.score for r in classify(docs, labels).collect()}
        b = {r.doc_id: r.score for r in classify(docs.withColumns({"lang": F.lit("x"), "source": F.lit(None)}), hidden).collect()}
        assert a == b


def test_dual_descent_reaches_the_optimum():
    rng = np.random.default_rng(0)
    rows = [np.unique(rng.integers(0, 30, 8)) for _ in range(60)]
    y = (np.array([r.sum() for r in rows]) > 110).astype(int)
    values, cost = rng.normal(1, 0.2, 30), 0.5
    w = quality.dual_descent(rows, values, y, cost, rounds=2000, close=1e-9)
    x = np.zeros((60, 31))
    for i, r in enumerate(rows):
        x[i, r] = values[r] / np.linalg.norm(values[r])
    x[:, 30] = 1
    sign = np.where(y == 1, 1, -1)

    def loss(w):
        return w @ w / 2 + cost * np.maximum(0, 1 - sign * (x @ w)).sum()

    best = loss(w)
    # No small move in any of many directions makes the primal loss smaller.
    assert all(loss(w + s * d) >= best - 1e-9 for d in rng.normal(size=(400, 31)) for s in (1e-2, 1e-3, -1e-3))


def test_log_ratios_and_feature_sets():
    rows, y = [np.array([0, 1]), np.array([1]), np.array([2])], np.array([1, 1, 0])
    p, q = np.array([2, 3, 1]) / 6, np.array([1, 1, 2]) / 4
    assert quality.log_ratios(rows, y, 3) == pytest.approx(np.log(p / q))
    texts = [b"One one ONE!! x", b"", b"One one ONE!! x", b"a a a a"]
    offsets = np.cumsum([0] + [len(t) for t in texts])
    owner, found = quality.features(np.frombuffer(b"".join(texts), dtype=np.uint8), offsets, 17)
    parts = [set(found[owner == i]) for i in range(4)]
    assert parts[0] == parts[2] and not parts[1] and parts[3] and len(found) == sum(map(len, parts))


def test_curve_and_steps():
    rng = np.random.default_rng(1)
    x = rng.normal(size=2000)
    y = (rng.random(2000) < 1 / (1 + np.exp(-(2 * x + 0.5)))).astype(int)
    a, b = labelled.platt(x, y)
    assert abs(a - 2) < 0.3 and abs(b - 0.5) < 0.2
    cuts, levels = toxicity.calibrate(np.round(x, 1), y)
    assert (np.diff(levels) > 0).all() and (np.diff(cuts) > 0).all() and 0 < levels.min() and levels.max() < 1


def test_single_classes_and_no_labels(spark):
    docs = spark.createDataFrame([(i, f"some words {i}") for i in range(8)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one = docs.select("doc_id", F.lit(1).alias("quality"), F.lit(1).alias("toxic"))
    for labels in (none, one):
        for got in (quality.classify(docs, labels), toxicity.classify(docs, labels)):
            assert all(0 <= r.score <= 1 for r in got.collect())


def plain_rates(tokens, p, targets, total):
    """The same least squares on arrays, by small steps to the end."""
    rate, weight = np.ones(len(tokens)), tokens / tokens.sum()
    metric = np.linalg.inv((p * weight[:, None]).T @ p)
    for _ in range(20000):
        rate = np.maximum(0, rate - 0.1 * p @ (metric @ ((weight * rate) @ p - targets * total / tokens.sum())))
    return rate


def test_rates_against_arrays(spark):
    rng = np.random.default_rng(2)
    tokens, p = rng.integers(1, 500, 300), rng.dirichlet([0.5, 0.3, 0.2], 300)
    rows = [(i, int(t), [float(v) for v in q]) for i, (t, q) in enumerate(zip(tokens, p))]
    members = materialize(spark.createDataFrame(rows, "doc_id long, tokens long, p array<double>"))
    for targets, total in (([0.8, 0.15, 0.05], None), ([0.34, 0.33, 0.33], float(tokens.sum() * 1.2)), ([0.9, 0.08, 0.02], None)):
        fitted, aim = mixing.fit_rates(members, targets, total)
        rate = np.array([r.rate for r in fitted.orderBy("doc_id").collect()])
        met, want = (tokens * rate) @ p, np.array(targets) * aim
        assert (rate >= 0).all() and met == pytest.approx(want, abs=1e-5 * tokens.sum())
        # A feasible answer by small plain steps leaves the documents about as they were, too.
        plain = plain_rates(tokens, p, np.array(targets), aim)
        assert abs(rate - 1) @ tokens < 1.1 * abs(plain - 1) @ tokens


def test_posteriors_and_targets_on_documents(spark):
    sf = "/root/testdata/sf0.1"
    got = QUERIES["op8_mixing"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id", "left").collect()
    p = np.array([[r.p_clean, r.p_low_quality, r.p_toxic] for r in got])
    assert p.sum(axis=1) == pytest.approx(np.ones(len(got)))
    known = [(r, q) for r, q in zip(got, p) if r.quality is not None]
    truth = np.array([2 if r.toxic else 1 - r.quality for r, _ in known])
    assert (np.array([q.argmax() for _, q in known]) == truth).mean() > 0.9
    mass = np.array([r.tokens * r.rate for r in got]) @ p
    assert mass / mass.sum() == pytest.approx(np.array([mixing.TARGETS[d] for d in mixing.DOMAINS]), abs=2e-3)


def test_draw_follows_rates(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    drawn = mixing.draw(docs, labels)
    assert drawn.columns == docs.columns and drawn.count() == drawn.select("doc_id").distinct().count()
    many = mixing.draw(docs, labels, repeat=True, total=3e6)
    assert many.groupBy("doc_id").count().agg(F.max("count")).first()[0] > 1


def labelled_texts(spark, clean, low, toxic):
    """As many texts of each domain of sf0.01 as asked for, and their labels; one clean text in five has none."""
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    both = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").join(labels, "doc_id")
    both = both.withColumn("domain", mixing.domain_of(F.col("quality"), F.col("toxic"))).where("domain is not null")
    parts = [both.where(F.col("domain") == k).orderBy("doc_id").limit(n) for k, n in enumerate((clean, low, toxic))]
    held = materialize(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    return held, held.where("domain > 0 or doc_id % 5 > 0").select("doc_id", "quality", "toxic")


def test_amounts_keep_the_first_domain_whole():
    t = [0.94, 0.03, 0.03]
    assert mixing.largest([0.5, 0.3, 0.2], t) == (pytest.approx([0.5, 0.03 * 0.5 / 0.94, 0.03 * 0.5 / 0.94]), pytest.approx(0.5 / 0.94))
    assert mixing.largest([0.98, 0.019, 0.001], t) == (pytest.approx([0.98, 0.019, 0.001]), pytest.approx(1))
    aim, total = mixing.largest([0.6, 0.399, 0.001], t)
    assert aim == pytest.approx([0.6, 0.03 * total, 0.001]) and sum(aim) == pytest.approx(total)
    assert mixing.largest([0.9, 0.1, 0.0], t)[0][::2] == [0.9, 0.0]
    assert mixing.largest([0.0, 0.6, 0.4], t)[0] == [0.0, 0.6, 0.4]


@pytest.mark.parametrize("clean, low, toxic", [(250, 40, 1), (250, 1, 30), (250, 40, 0), (250, 2, 1)])
def test_a_rare_or_absent_domain_leaves_clean_documents_whole(spark, clean, low, toxic):
    docs, labels = labelled_texts(spark, clean, low, toxic)
    rated = mixing.mix(docs, labels, "doc_id", "domain").collect()
    mine = [r for r in rated if r.domain == 0]
    assert len(mine) == docs.where("domain = 0").count() > 100
    assert sum(r.tokens * min(1, r.rate) for r in mine) > 0.9 * sum(r.tokens for r in mine)


def test_without_labels_of_clean_documents_all_stay(spark):
    docs, labels = labelled_texts(spark, 60, 10, 10)
    for taught in (labels.limit(0), labels.where("toxic = 1")):
        assert {r.rate for r in mixing.mix(docs, taught).collect()} == {1.0}
    only = mixing.mix(docs, labels.where("quality = 1 and toxic = 0").limit(5)).collect()
    assert [r.rate for r in only] == pytest.approx([1.0] * len(only))


def test_drawn_shares_of_a_junk_heavy_input(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet").join(labels, "doc_id")
    docs = docs.withColumn("domain", mixing.domain_of(F.col("quality"), F.col("toxic"))).where("domain > 0 or domain = 0 and doc_id % 4 = 0")
    docs = materialize(docs.select("doc_id", "text", "domain"))
    rated = mixing.mix(docs, labels, "doc_id", "domain", cap=1.0).withColumn("often", mixing.often(0.1, False)).collect()
    mass = np.array([r.tokens * r.often for r in rated]) @ np.array([r.p for r in rated])
    assert mass / mass.sum() == pytest.approx(np.array([mixing.TARGETS[d] for d in mixing.DOMAINS]), abs=5e-3)
    assert not any(r.often == 0 for r in rated)
    drawn = mixing.draw(docs, labels).groupBy("domain").count().collect()
    count = {r.domain: r["count"] for r in drawn}
    assert count[0] == sum(r.domain == 0 for r in rated) and count[1] > 0 and count[2] > 0


def test_rows_of_one_posterior_are_rated_by_their_sum(spark):
    docs, labels = labelled_texts(spark, 250, 40, 30)
    classifier = mixing.fit_classifier(docs, labels)
    members = materialize(mixing.memberships(docs, classifier, "doc_id"))
    each = mixing.fit_rates(members, [mixing.TARGETS[d] for d in mixing.DOMAINS])[0]
    want = {r.doc_id: r.rate for r in each.collect()}
    got = {r.doc_id: r.rate for r in mixing.mix(docs, labels).collect()}
    assert len(got) == docs.count() and got == pytest.approx(want, abs=1e-9)


def test_drawn_texts_are_written_once_and_not_moved(spark):
    docs, labels = labelled_texts(spark, 250, 40, 30)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        before = set(open_stages())
        drawn = mixing.draw(docs, labels)
        assert drawn.count() > 0 and "Exchange hashpartitioning" not in drawn._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    written = [spark.read.parquet(p).schema.simpleString() for p in open_stages() if p not in before]
    assert sum(s.count("text:string") for s in written) == 1
