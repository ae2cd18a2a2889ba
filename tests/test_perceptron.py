"""The perceptron's gradients by finite differences, and its training by the same steps on arrays."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.functions.hashing import hash_order
from riskweave.ml import perceptron as p

NAMES = ["a", "b", "c"]


def test_gradients_equal_finite_differences():
    rng = np.random.default_rng(1)
    sizes = [3, 5, 4, 1]
    x, y, w = rng.normal(size=(20, 3)), rng.integers(0, 2, 20).astype(float), p.initial([3, 5, 4, 1], 7)
    loss, gradient = p.loss_gradient(w, sizes, x, y)
    for i in range(len(w)):
        step = np.zeros(len(w))
        step[i] = 1e-6
        up, down = (p.loss_gradient(w + s, sizes, x, y)[0] for s in (step, -step))
        assert gradient[i] == pytest.approx((up - down) / 2e-6, abs=1e-4)
    assert len(p.weight_mask(sizes)) == len(w) and p.weight_mask(sizes).sum() == 3 * 5 + 5 * 4 + 4


def on_arrays(df, hidden, batches, epochs, patience, seed=42):
    digits = lambda s: F.conv(F.substring(hash_order("id", seed=s), 1, 8), 16, 10).cast("long")
    data = df.withColumns({"u": digits(13) % (p.PRIME - 1) + 1, "held": digits(11) < int(0.1 * (1 << 32))}).toPandas()
    x, y, u, held = data[NAMES].to_numpy(), data["y"].to_numpy(float), data["u"].to_numpy(), data["held"].to_numpy()
    sizes = [len(NAMES), *hidden, 1]
    w, mask = p.initial(sizes, seed), p.weight_mask(sizes)
    adam, best, score, stale, history = p.Adam(len(w), 0.01), w, -1.0, 0, []
    for epoch in range(epochs):
        for b in range(batches):
            use = ~held & (p.batch_of(u, epoch, batches) == b)
            if use.any():
                w = adam.step(w, (p.loss_gradient(w, sizes, x[use], y[use])[1] + 0.001 * mask * w) / use.sum())
        now = ((p.forward(w, sizes, x[held])[-1][:, 0] > 0) == (y[held] == 1)).mean()
        history.append(now)
        stale = stale + 1 if now < score + 1e-4 else 0
        if now > score:
            score, best = now, w
        if stale >= patience:
            break
    return best, history


@pytest.mark.parametrize("batch, epochs, patience", [(90, 4, 10), (1000, 12, 2)])
def test_training_takes_the_steps_of_an_array_version(spark, batch, epochs, patience):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 3))
    y = (x[:, 0] * x[:, 1] > 0).astype(int)
    df = spark.createDataFrame([(i, *map(float, r), int(t)) for i, (r, t) in enumerate(zip(x, y))], "id long, a double, b double, c double, y int").repartition(3)
    model = p.fit_perceptron(df, NAMES, "y", "id", hidden=(6, 4), rate=0.01, batch=batch, epochs=epochs, patience=patience)
    want, history = on_arrays(df, (6, 4), max(1, round(180 / batch)), epochs, patience)
    assert model.history == pytest.approx(history) and np.allclose(model.parameters, want, atol=1e-9)
    scores = model.transform(df.withColumn("a", F.when(F.col("id") > 0, F.col("a")))).select("score").toPandas()["score"]
    assert scores.between(0, 1).all() and len(scores) == 200


def test_no_rows(spark):
    df = spark.createDataFrame([], "id long, a double, b double, c double, y int")
    model = p.fit_perceptron(df, NAMES, "y", "id", hidden=(2,))
    assert model.history == [] and np.allclose(model.parameters, p.initial([3, 2, 1], 42))


def test_one_gradient_reaches_the_driver(spark):
    """Whatever the number of tasks, their sums come as one packet, added part by part."""
    rng, groups = np.random.default_rng(2), 4
    sums = [rng.normal(size=50) * 10.0 ** rng.integers(-8, 8) for _ in range(14)]
    packets = spark.createDataFrame([(i % groups, i, bytearray(g.tobytes()), 1.0, 2, 3, 1) for i, g in enumerate(sums)], p.SCHEMA).repartition(5)
    got = p._added(packets, groups).collect()
    want = np.sum([np.sum(sums[k::groups], axis=0) for k in range(groups)], axis=0)
    assert len(got) == 1 and got[0].gradient == want.tobytes() and (got[0].loss, got[0].rows, got[0].seen, got[0].told) == (14.0, 28, 42, 14)
