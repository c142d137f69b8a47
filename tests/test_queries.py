import pytest

from __spark_entry__ import entry, queries
from check_oracles import compare, connect
from quillspark.plans.oracles import ORACLES
from quillspark.plans.queries import QUERIES
from quillspark.session import shared_folder

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(TABLES)


def test_every_query_has_an_oracle():
    assert set(QUERIES) - set(ORACLES) == {"prompts_sampled"}  # see test_sampling
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", ORACLES)
def test_query_matches_its_sql(spark, connection, name):
    assert compare(spark, connection, TABLES, name) is None


def test_decoded_text_is_the_text(spark):
    decoded = QUERIES["decode_joined"](spark, TABLES)
    documents = spark.read.parquet(f"{TABLES}/documents.parquet").select("doc_id", "text")
    assert decoded.exceptAll(documents).count() == documents.exceptAll(decoded).count() == 0


def test_entry(spark):
    df = entry(spark)
    assert df.count() == spark.read.parquet(f"{TABLES}/conversations.parquet").count()
    assert df.columns == entry(spark).columns


class Session:
    """As much of a session as shared_folder looks at."""

    def __init__(self, master, configured=None, checkpoint=None):
        self.conf = {"spark.checkpoint.dir": configured} if configured else {}
        self.sparkContext = self
        self.master, self.getCheckpointDir = master, lambda: checkpoint


def test_shared_folder():
    assert shared_folder(Session("yarn", "hdfs:/a", "hdfs:/b")) == "hdfs:/a"
    assert shared_folder(Session("yarn", None, "hdfs:/b")) == "hdfs:/b"
    assert shared_folder(Session("local[8]")) == shared_folder(Session("local"))
    for master in ("yarn", "spark://h:1", "local-cluster[3,2,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_folder(Session(master))


NARROW = [
    "chat_render_generation",
    "sft_text",
    "sft_text_compat",
    "sft_rejected",
    "rl_prompt",
    "hash_answer",
    "reward_total",
    "reward_custom",
    "rollout_fanout",
    "inspect_rollouts",
    "map_callback",
    "prompts_filter",
    "prompts_render",
    "prompts_quarantine",
    "prompts_predict",
]


def plan_of(spark, name):
    return QUERIES[name](spark, TABLES)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NARROW)
def test_row_wise_queries_never_shuffle(spark, name):
    assert "Exchange" not in plan_of(spark, name)


@pytest.mark.parametrize("name", ["encode_joined", "decode_joined", "group_advantage", "batch_pad"])
def test_no_query_forms_a_product(spark, name):
    plan = plan_of(spark, name)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scans_read_only_the_columns_they_use(spark):
    assert "ReadSchema: struct<doc_id:bigint>" in plan_of(spark, "batch_assign")
    plan = plan_of(spark, "sft_text")
    assert "IsNotNull(text)" in plan.split("PushedFilters")[1]
