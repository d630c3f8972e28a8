import random

import pytest
from quillon.operators import ranking


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(8)
    data = [(rng.choice([0.5, 0.5, 0.25, rng.random()]), i) for i in range(700)]
    return sorted(data, key=lambda x: (-x[0], x[1])), spark.createDataFrame([*data, (None, 900)], "score double, pos long").repartition(5)


def read(df):
    return sorted(((r["score"], r["pos"]) for r in df.collect()), key=lambda x: (-x[0], x[1]))


@pytest.mark.parametrize("offset", [0, 1, 199, 350, 699])
def test_pages_by_cursor(rows, offset):
    want, df = rows
    start = ranking.page_start(df.filter("score is not null"), "score", "pos", offset)
    assert start == want[offset]
    got = read(ranking.page_from(df, "score", "pos", start, 20))
    assert got == want[offset : offset + 20]
    assert read(ranking.page_from(df, "score", "pos", got[-1], 20, after=True)) == want[offset + 20 : offset + 40]


def test_ends_and_limits(rows):
    want, df = rows
    assert ranking.page_start(df.filter("score is not null"), "score", "pos", 700) is None
    assert read(ranking.page_from(df, "score", "pos", None, 5)) == want[:5]
    with pytest.raises(ValueError):
        ranking.page_from(df, "score", "pos", None, 201)
    plan = ranking.page_from(df, "score", "pos", want[10], 5)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan
