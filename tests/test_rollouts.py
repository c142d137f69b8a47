import math
import statistics
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from quillspark.functions import rewards as R
from quillspark.operators import rollouts as O

ROLLOUT = "prompt_id int, gen_id int, completion array<struct<role string, content string>>, answer string"


def rewards(spark, rows):
    return spark.createDataFrame(rows, "prompt_id int, reward double")


def advantages(df):
    return sorted(
        [(r.prompt_id, None if r.advantage is None else round(r.advantage, 6)) for r in df.collect()],
        key=repr,
    )


def test_group_advantage(spark):
    df = rewards(spark, [(1, 1.0), (1, 3.0), (2, 5.0), (2, 5.0), (3, 4.0)])
    got = advantages(O.group_advantage(df))
    assert got == sorted([(1, -0.707057), (1, 0.707057), (2, 0.0), (2, 0.0), (3, None)], key=repr)


def test_group_advantage_with_a_group_of_a_third_of_all_rows(spark):
    rows = [(None if i % 3 == 0 else i % 50, float(i * i % 17)) for i in range(3000)]
    got = O.group_advantage(rewards(spark, rows))
    groups = defaultdict(list)
    for key, value in rows:
        groups[key].append(value)
    want = [
        (k, (v - statistics.fmean(groups[k])) / (statistics.stdev(groups[k]) + 1e-4)) for k, v in rows
    ]
    assert got.columns == ["prompt_id", "reward", "advantage"]
    assert advantages(got) == sorted([(k, round(v, 6)) for k, v in want], key=repr)


def test_sampled_rewards_are_drawn_once(spark):
    df = spark.range(40).select((F.col("id") % 2).cast("int").alias("prompt_id"), F.rand().alias("reward"))
    means = O.group_advantage(df).groupBy("prompt_id").agg(F.avg("advantage").alias("m")).collect()
    assert len(means) == 2 and all(abs(r.m) < 1e-6 for r in means)


def test_misspelt_weights_and_no_generations_are_refused(spark):
    df = spark.createDataFrame([(1, 0, [("assistant", "4")], "4")], ROLLOUT)
    with pytest.raises(ValueError, match="numerik"):
        O.score(df, weights={"numerik": 2.0})
    with pytest.raises(ValueError):
        O.fan_out(spark.range(3), 0)


def test_fan_out(spark):
    df = O.fan_out(spark.range(3))
    assert df.count() == 18 and {r.gen_id for r in df.collect()} == set(range(6))
    assert O.fan_out(spark.range(3), 2).count() == 6


def test_scoring_is_one_narrow_projection(spark):
    df = spark.createDataFrame([(1, 0, [("assistant", "4")], "4")], ROLLOUT)
    plan = O.score(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_weights_and_names(spark):
    df = spark.createDataFrame([(1, 0, [("assistant", "4")], "4")], ROLLOUT)
    row = O.score(df, weights={"numeric": 2.0, "correctness": 0.5}).first()
    assert row.numeric == 0.5 and row.correctness == 2.0 and row.reward == 2.0


def test_rewards_bind_columns_by_name(spark):
    df = spark.createDataFrame([(1, 0, [("assistant", "abc")], "4")], ROLLOUT).withColumn(
        "prompt", F.array(F.struct(F.lit("user").alias("role"), F.lit("hello").alias("content")))
    )
    seen = []

    def everything(prompts, completions, **columns):
        seen.append(sorted(columns))
        return F.lit(1.0)

    def lengths(prompts, completions, answer, **columns):
        assert sorted(columns) == ["gen_id", "prompt_id"]
        return [
            float(len(p[0]["content"]) + len(c[0]["content"]) + len(a))
            for p, c, a in zip(prompts, completions, answer)
        ]

    def only_answer(answer):
        return [float(a) for a in answer]

    row = O.score(
        df,
        {
            "everything": everything,
            "lengths": O.python_reward(lengths),
            "only_answer": O.python_reward(only_answer),
        },
    ).first()
    assert seen == [["answer", "gen_id", "prompt_id"]]
    assert (row.lengths, row.only_answer, row.reward) == (9.0, 4.0, 14.0)


def test_missing_reward_column_is_reported(spark):
    df = spark.createDataFrame([(1,)], "prompt_id int")
    with pytest.raises(ValueError, match="answer"):
        O.score(df, {"correctness": R.correctness_reward})


def test_inspect_shows_the_first_generation(spark):
    rows = [(p, g, [("assistant", f"<answer>{p}{g}</answer>")], "a") for p in (1, 2) for g in (0, 1)]
    df = spark.createDataFrame(rows, ROLLOUT).withColumn(
        "prompt",
        F.array(
            F.struct(F.lit("system").alias("role"), F.lit("s").alias("content")),
            F.struct(F.lit("user").alias("role"), F.concat(F.lit("q"), "prompt_id").alias("content")),
        ),
    )
    shown = O.inspect_batches(df).orderBy("question").collect()
    assert [tuple(r) for r in shown] == [
        ("q1", "a", "<answer>10</answer>", "10"),
        ("q2", "a", "<answer>20</answer>", "20"),
    ]


def test_advantage_never_infinite(spark):
    got = O.group_advantage(rewards(spark, [(1, 2.0)] * 6)).collect()
    assert all(r.advantage == 0.0 and math.isfinite(r.advantage) for r in got)


def test_scorers_on_arrow_arrays(spark):
    import pyarrow.compute as pc

    df = spark.createDataFrame([(1, 0, [("assistant", "4")], "4"), (1, 1, [], "abc")], ROLLOUT)
    rewards_ = {"long": O.python_reward(lambda answer: pc.cast(pc.utf8_length(answer), "double"), arrow=True)}
    assert sorted(r.reward for r in O.score(df, rewards_).collect()) == [1.0, 3.0]
    short = {"short": O.python_reward(lambda answer: [])}
    with pytest.raises(Exception, match="rewards for"):
        O.score(df, short).collect()
