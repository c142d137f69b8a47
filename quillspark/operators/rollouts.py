"""Rollout tables: fan-out, scoring with user-extensible rewards, group-relative advantage."""

from __future__ import annotations

import inspect
from collections.abc import Callable, Mapping
from functools import reduce
from operator import add

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions.rewards import REWARDS, completion_text, extract_xml_answer
from quillspark.session import store

# Completions per prompt and the constant added to the group deviation.
GENERATIONS = 6
ADVANTAGE_EPSILON = 1e-4

RewardFunction = Callable[..., Column]


def fan_out(df: DataFrame, generations: int = GENERATIONS) -> DataFrame:
    """One row per prompt and generation number ``gen_id``, from 0."""
    if generations < 1:
        raise ValueError("a prompt needs at least one generation")
    return df.withColumn("gen_id", F.explode(F.sequence(F.lit(0), F.lit(generations - 1))))


def score(
    df: DataFrame,
    rewards: Mapping[str, RewardFunction] | None = None,
    weights: Mapping[str, float] | None = None,
    prompts: str = "prompt",
    completions: str = "completion",
) -> DataFrame:
    """Add one column per reward and their weighted sum ``reward``; a single narrow projection.

    Reward parameters are bound by name: ``prompts``, ``completions``, else a column of ``df``.
    A reward with ``**columns`` receives every remaining column.
    """
    rewards = REWARDS if rewards is None else rewards
    weights = weights or {}
    if unknown := set(weights) - set(rewards):
        raise ValueError(f"weights for rewards that are not given: {sorted(unknown)}")
    available = {name: F.col(name) for name in df.columns if name not in (prompts, completions)}
    if prompts in df.columns:
        available["prompts"] = F.col(prompts)
    if completions in df.columns:
        available["completions"] = F.col(completions)
    scored = df.withColumns(
        {name: _bind(fn, available).cast("double") for name, fn in rewards.items()}
    )
    terms = [F.col(name) * F.lit(float(weights.get(name, 1.0))) for name in rewards]
    return scored.withColumn("reward", reduce(add, terms))


def _bind(fn: RewardFunction, available: Mapping[str, Column]) -> Column:
    parameters = inspect.signature(fn).parameters.values()
    named = [p.name for p in parameters if p.kind is not p.VAR_KEYWORD]
    optional = {p.name for p in parameters if p.default is not p.empty}
    missing = [n for n in named if n not in available and n not in optional]
    if missing:
        raise ValueError(f"reward {fn.__name__} needs columns that are absent: {missing}")
    arguments = {n: available[n] for n in named if n in available}
    if any(p.kind is p.VAR_KEYWORD for p in parameters):
        arguments = {**available, **arguments}
    return fn(**arguments)


def python_reward(fn: Callable[..., list[float]], arrow: bool = False) -> RewardFunction:
    """Make an opaque scorer on Python lists (``arrow``: on Arrow arrays) usable as a reward column.

    Only the columns the scorer names travel to Python (all of them if it takes ``**columns``).
    """

    def column(**columns: Column) -> Column:
        names = list(columns)

        @F.arrow_udf("double")
        def run(*arrays: pa.Array) -> pa.Array:
            given = arrays if arrow else [a.to_pylist() for a in arrays]
            made = fn(**dict(zip(names, given)))
            values = made if isinstance(made, pa.Array) else pa.array(made, pa.float64())
            if len(values) != len(arrays[0]):
                raise ValueError(f"{len(values)} rewards for {len(arrays[0])} completions")
            return values

        return run(*columns.values())

    column.__name__ = getattr(fn, "__name__", "reward")
    column.__signature__ = inspect.signature(fn)
    return column


def group_advantage(
    df: DataFrame,
    group: str = "prompt_id",
    reward: str = "reward",
    epsilon: float = ADVANTAGE_EPSILON,
) -> DataFrame:
    """Add ``advantage`` = (reward - group mean) / (group sample deviation + epsilon).

    A group of one has no deviation and gets null; null groups are one group. The scored rows
    are stored first, so sampled rewards are drawn once and the statistics belong to them. Means
    and deviations are combined on the map side and joined back, so no group meets in one task:
    a join partition that a large group fills is split at run time.
    """
    rows = store(df, "scored")
    totals = rows.groupBy(F.col(group).alias("_group")).agg(
        F.avg(reward).alias("_mean"), F.stddev_samp(reward).alias("_deviation")
    )
    joined = rows.join(totals, F.col(group).eqNullSafe(F.col("_group")))
    advantage = (F.col(reward) - F.col("_mean")) / (F.col("_deviation") + epsilon)
    return joined.withColumn("advantage", advantage).select(*df.columns, "advantage")


def inspect_batches(
    df: DataFrame, prompts: str = "prompt", completions: str = "completion"
) -> DataFrame:
    """First generation of every prompt with its question, answer, response and extraction."""
    response = completion_text(F.col(completions))
    return df.where(F.col("gen_id") == 0).select(
        F.element_at(F.col(prompts), -1)["content"].alias("question"),
        F.col("answer"),
        response.alias("response"),
        extract_xml_answer(response).alias("extracted"),
    )
