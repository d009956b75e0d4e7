import random

import pytest
from pyspark.sql import functions as F

from docflux.llm import mixing as X


def sizes(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, source string, n_tokens bigint")
    return df.withColumn("position", F.shiftrightunsigned(F.xxhash64(F.lit(0), F.col("doc_id")), 64 - X.BITS * X.LEVELS))


PLANS = [("p", "a", 0.5, 1), ("p", "b", 0.3, 3), ("p", "c", 0.2, 4), ("q", "a", 0.1, 1), ("q", "b", 0.9, 2), ("r", "a", 0.6, 1), ("r", "none", 0.4, 5), ("s", "none", 1.0, 2), ("t", "b", 1.0, 0)]


@pytest.fixture(scope="module")
def mixed(spark):
    rng = random.Random(2)
    rows = [(i, s, 0 if i % 17 == 0 else rng.randint(1, 400)) for i, s in enumerate(["a"] * 400 + ["b"] * 150 + ["c"] * 60)]
    sized = sizes(spark, rows).cache()
    plan = X.budgets(sized, spark.createDataFrame(PLANS, "mix_plan string, source string, target_share double, max_repeats int"))
    drawn = X.draw(sized, plan)
    return rows, sized, plan.collect(), [r.asDict() for r in drawn.collect()], [r.asDict() for r in X.report(drawn, plan).collect()]


def test_draws_equal_brute_force(mixed):
    rows, sized, plan, drawn, _ = mixed
    position = {r["doc_id"]: r["position"] for r in sized.collect()}
    for p in plan:
        docs = sorted((position[i], i, n) for i, s, n in rows if s == p["source"])
        total, want = 0, {}
        for _, i, n in docs:  # in order of position, until the document that brings the sum nearest to the rest
            inside = p["rest"] > 0 and p["passes"] < p["max_repeats"] and (total + n <= p["rest"] or (total <= p["rest"] and total + n - p["rest"] < p["rest"] - total))
            total = total + n if inside else float("inf")
            if p["passes"] + inside:
                want[i] = p["passes"] + inside
        got = {r["doc_id"]: r["repeats"] for r in drawn if (r["mix_plan"], r["source"]) == (p["mix_plan"], p["source"])}
        assert got == want


def test_shares_meet_their_targets(mixed):
    *_, report = mixed
    shares = {(r["mix_plan"], r["source"]): r for r in report}
    for (plan, source), r in shares.items():
        assert r["repeats_used"] <= r["max_repeats"]
        if plan in "pq":
            assert abs(r["actual_share"] - r["target_share"]) < 0.02
    assert shares["r", "a"]["actual_share"] == 1.0 and shares["r", "none"]["tokens"] == 0
    assert shares["s", "none"]["actual_share"] == 0.0 and shares["t", "b"]["tokens"] == 0


def test_empty_and_null_inputs(spark):
    sized = sizes(spark, [(1, "a", 0), (2, "a", 0)])
    targets = spark.createDataFrame([("p", "a", None, None), (None, "a", 0.5, 1), ("p", None, 0.5, 1)], "mix_plan string, source string, target_share double, max_repeats int")
    plan = X.budgets(sized, targets)
    assert [(r["mix_plan"], r["source"], r["budget"]) for r in plan.collect()] == [("p", "a", 0.0)]
    assert X.draw(sized, plan).count() == 0
    assert X.draw(sized, X.budgets(sized, targets.limit(0))).count() == 0


def test_documents_of_unlisted_sources_stay_out(spark):
    docs = spark.createDataFrame([(1, "a", "one two"), (2, "b", "x"), (3, None, "y"), (4, "a", None), (5, "a", "")], "doc_id bigint, source string, text string")
    targets = spark.createDataFrame([("p", "a", 1.0, 1)], "mix_plan string, source string, target_share double, max_repeats int")
    got = {r["doc_id"]: r["n_tokens"] for r in X.sized_documents(docs, targets).collect()}
    assert set(got) == {1, 4, 5} and got[4] == got[5] == 0 and got[1] == 2
