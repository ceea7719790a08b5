"""Isotonic calibration against pooled rates, and hulls that merge."""

import random

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from basketry.operators import isotonic, models
from basketry.session import work_dir


def pooled(data):
    """Rate per score by pooling neighbours that fall."""
    blocks = []
    for score in sorted({p for p, _ in data}):
        ys = [y for p, y in data if p == score]
        blocks.append([sum(ys), len(ys), [score]])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s, n, scores = blocks.pop()
            blocks[-1] = [blocks[-1][0] + s, blocks[-1][1] + n, blocks[-1][2] + scores]
    return [(scores[0], scores[-1], s / n) for s, n, scores in blocks]


def sample(rows, seed, kinds=200):
    rng = random.Random(seed)
    out = []
    for _ in range(rows):
        p = rng.randrange(kinds) / kinds
        out.append((p, int(rng.random() < 0.2 + 0.5 * p * p)))
    return out


def scored(spark, data):
    df = spark.createDataFrame([(i, float(p), int(y)) for i, (p, y) in enumerate(data)], "id int, p double, y int")
    return df.withColumn("probability", array_to_vector(F.array(1 - F.col("p"), F.col("p")))).repartition(7)


@pytest.mark.parametrize("seed,kinds", [(1, 200), (2, 7), (3, 100_000)])
def test_steps_equal_pooled_rates(spark, seed, kinds):
    data = sample(3000, seed, kinds)
    found = isotonic.isotonic_steps(scored(spark, data), "p", "y")
    want = pooled(data)
    assert [s[:2] for s in found] == [s[:2] for s in want]
    assert [s[2] for s in found] == pytest.approx([s[2] for s in want])


def test_hull_of_parts_is_the_hull():
    rng = random.Random(4)
    for _ in range(200):
        steps = [(rng.randrange(1, 4), rng.randrange(3)) for _ in range(rng.randrange(1, 40))]
        points = [(int(n), int(s), float(i)) for i, (n, s) in enumerate(np.cumsum(steps, axis=0))]
        whole = isotonic.lower_hull(points)
        rng.shuffle(points)
        cut = rng.randrange(len(points) + 1)
        assert isotonic.lower_hull(isotonic.lower_hull(points[:cut]) + isotonic.lower_hull(points[cut:])) == whole


def test_a_rising_rate_keeps_every_score(spark):
    """The rate never falls, so no two scores are pooled."""
    data = [(k / 30, int(j < k)) for k in range(31) for j in range(30)]
    found = isotonic.isotonic_steps(scored(spark, data), "p", "y")
    assert [s[0] for s in found] == [s[1] for s in found] == [k / 30 for k in range(31)]


def test_model_interpolates_and_clips(spark):
    model = PipelineModel(stages=[isotonic.IsotonicCalibration(steps="[[0.2, 0.3, 0.1], [0.5, 0.5, 0.6]]")])
    path = work_dir(spark, "isotonic")
    model.write().save(path)
    data = [(0.0, 0), (0.25, 0), (0.4, 0), (0.5, 0), (0.9, 0)]
    out = models.score(PipelineModel.load(path), scored(spark, data)).orderBy("p").collect()
    assert [r["prob"] for r in out] == pytest.approx([0.1, 0.1, 0.35, 0.6, 0.6])


def test_no_rows_and_one_row(spark):
    assert isotonic.isotonic_steps(scored(spark, [(0.5, 1)]).limit(0), "p", "y") == []
    assert isotonic.isotonic_steps(scored(spark, [(0.5, 1)]), "p", "y") == [(0.5, 0.5, 1.0)]
