"""Group-relative advantages of a stream of scored rollouts."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from quillspark.operators.rollouts import ADVANTAGE_EPSILON, GENERATIONS

STATE = "gens array<bigint>, rewards array<double>"


def stream_advantage(
    scored: DataFrame,
    time: str,
    generations: int | str = GENERATIONS,
    late: str = "10 minutes",
    wait_ms: int = 600_000,
    group: str = "prompt_id",
    gen: str = "gen_id",
    reward: str = "reward",
    epsilon: float = ADVANTAGE_EPSILON,
) -> DataFrame:
    """Rows (group, gen, reward, advantage, complete) of every group once it is complete.

    A group waits in keyed state until ``generations`` rewards are in (a number, or the column
    that says how many its group has) and is then emitted and forgotten. One that stays short is
    emitted with ``complete`` false when the watermark (``late`` behind the latest ``time``) has
    passed the latest time of its rows by ``wait_ms``. A generation that comes again while its group
    waits, as sources that deliver at least once do, counts once. Advantages are those of
    group_advantage over the rows that are in: null for a single row. State is bounded by the
    groups that are open, each with fewer than ``generations`` rows.
    """
    keep = [group, gen, reward, time] + ([generations] if isinstance(generations, str) else [])
    rows = scored.select(*dict.fromkeys(keep), F.unix_millis(time).alias("_ms")).withWatermark(time, late)
    types = dict(scored.dtypes)
    output = f"{group} {types[group]}, {gen} bigint, {reward} double, advantage double, complete boolean"

    def emitted(key: tuple, gens: list, rewards: list, complete: bool) -> pd.DataFrame:
        values = pd.Series(rewards, dtype="float64")
        deviation = values.std(ddof=1) if len(values) > 1 else float("nan")
        advantage = (values - values.mean()) / (deviation + epsilon)
        return pd.DataFrame(
            {
                group: [key[0]] * len(values),
                gen: gens,
                reward: values,
                "advantage": advantage.astype(object).where(advantage.notna(), None),
                "complete": complete,
            }
        )

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        gens, rewards = map(list, state.get) if state.exists else ([], [])
        if state.hasTimedOut:
            state.remove()
            yield emitted(key, gens, rewards, False)
            return
        latest, wanted = 0, generations
        for batch in batches:
            latest = max(latest, int(batch["_ms"].max()))
            if isinstance(generations, str):
                wanted = int(batch[generations].iloc[0])
            for number, value in zip(batch[gen], batch[reward]):
                if number not in gens:
                    gens.append(int(number))
                    rewards.append(float(value))
        if len(gens) >= wanted:
            if state.exists:
                state.remove()
            yield emitted(key, gens, rewards, True)
        else:
            state.update((gens, rewards))
            state.setTimeoutTimestamp(max(latest, state.getCurrentWatermarkMs()) + wait_ms)

    timeout = GroupStateTimeout.EventTimeTimeout
    return rows.groupBy(group).applyInPandasWithState(step, output, STATE, "append", timeout)
