from collections import defaultdict

from pyspark.sql import functions as F

from quillspark.operators import batching as B


def token_rows(spark, n):
    return spark.range(n).select(
        F.col("id"),
        F.transform(F.sequence(F.lit(1), F.col("id") % 5 + 1), lambda x: x.cast("int")).alias("input_ids"),
    )


def batches(df):
    groups = defaultdict(list)
    for r in df.collect():
        groups[r.shard, r.batch].append(r)
    return groups


def test_batches_are_full_but_the_last_of_a_shard(spark):
    groups = batches(B.assign_batches(token_rows(spark, 500), "id", 4, shards=7, accumulation=3))
    last = {}
    for shard, batch in groups:
        last[shard] = max(last.get(shard, 0), batch)
    assert len(last) == 7
    for (shard, batch), rows in groups.items():
        assert len(rows) == 4 or batch == last[shard]
        assert {r.step for r in rows} == {batch // 3}
    for shard, top in last.items():
        assert {b for s, b in groups if s == shard} == set(range(top + 1))
        ids = [r.id for b in range(top + 1) for r in sorted(groups[shard, b], key=lambda r: r.id)]
        assert ids == sorted(ids)
    assert sum(map(len, groups.values())) == 500


def test_shards_follow_the_rows(spark):
    def shards(n):
        return B.assign_batches(spark.range(n), "id", 2).select("shard").distinct().count()

    assert [shards(n) for n in (1, 1000, 1001, 4500)] == [1, 1, 2, 5]
    assert B.assign_batches(spark.range(0), "id", 2).count() == 0


def test_effective_batch_of_pretraining():
    assert B.CPT_BATCH * B.CPT_ACCUMULATION * B.CPT_DEVICES == 128


def test_padding_reaches_the_longest_row_of_each_batch_only(spark):
    rows = B.assign_batches(token_rows(spark, 100), "id", 4, shards=3)
    rows = rows.withColumn("labels", F.col("input_ids")).withColumn("real", F.size("input_ids"))
    for group in batches(B.pad_batches(rows, 9, labels="labels")).values():
        longest = max(r.real for r in group)
        for r in group:
            assert r.length == longest
            missing = longest - r.real
            real = list(range(1, r.real + 1))
            assert r.input_ids == real + [9] * missing
            assert r.attention_mask == [1] * r.real + [0] * missing
            assert r.labels == real + [-100] * missing


def test_two_rows_of_one_batch(spark):
    df = spark.createDataFrame([(1, [7, 8, 9]), (2, [1, 2, 3, 4, 5])], "id int, input_ids array<int>")
    padded = B.pad_batches(B.assign_batches(df, "id", 2, shards=1), 0).orderBy("id").collect()
    assert [r.input_ids for r in padded] == [[7, 8, 9, 0, 0], [1, 2, 3, 4, 5]]
    assert padded[0].attention_mask == [1, 1, 1, 0, 0]


def test_batching_and_padding_share_one_shuffle(spark):
    df = B.pad_batches(B.assign_batches(token_rows(spark, 100), "id", 4, shards=3), 0)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_fixed_padding(spark):
    df = spark.createDataFrame([([1, 2, 3],), ([1],)], "input_ids array<int>")
    rows = B.pad_fixed(df, 0, 2, labels="input_ids").collect()
    assert [tuple(r) for r in rows] == [([1, 2], [1, 1], [1, 2]), ([1, 0], [1, 0], [1, -100])]


def test_one_prompt_with_most_rows_spreads_over_the_shards(spark):
    rows = spark.range(4000).select(F.lit(1).alias("prompt_id"), F.col("id").alias("gen_id"))
    batched = B.assign_batches(rows, ["prompt_id", "gen_id"], 4, shards=8)
    counts = batched.groupBy("shard").count().collect()
    assert len(counts) == 8 and all(400 < r["count"] < 600 for r in counts)


def test_shards_are_even_for_any_key(spark):
    for key in (F.col("id"), F.col("id") * 64, F.concat(F.lit("doc-"), "id")):
        rows = spark.range(8000).select(key.alias("key"))
        counts = rows.groupBy(B.shard_of(["key"], 8).alias("s")).count().collect()
        assert len(counts) == 8 and all(800 < r["count"] < 1200 for r in counts)
