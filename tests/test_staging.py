from tunetables.operators import staging as G


class Session:
    def __init__(self, master, conf):
        class Context:
            applicationId = "app"

            def getCheckpointDir(self):
                return None

        self.sparkContext, self.conf = Context(), conf
        self.sparkContext.master = master


def test_root_comes_from_the_session():
    named = {"spark.checkpoint.dir": "hdfs://shared/dir/"}
    assert G.checkpoint_root(Session("spark://host:1", named)) == "hdfs://shared/dir/"
    assert G.stage_path(Session("local[2]", named), "x").startswith("hdfs://shared/dir/x-")


def test_written_table(spark):
    out = G.materialise(spark.range(5), "x")
    assert sorted(r.id for r in out.collect()) == list(range(5))
    assert all("/x-" in f for f in out.inputFiles())


def test_the_warehouse_serves_without_a_setting():
    root = G.checkpoint_root(Session("spark://host:1", {"spark.sql.warehouse.dir": "hdfs://wh/"}))
    assert root == "hdfs://wh/_staged"


def test_spread(spark, sf):
    df = spark.read.parquet(f"{sf}/region.parquet")
    assert G.spread(df).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
