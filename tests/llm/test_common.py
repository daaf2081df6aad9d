import os

from lumenrec.llm import common, quality
from tests.llm.helpers import docs, edge_rows, records


def test_intermediate_tables_stay_until_released(spark):
    common.release()
    folder = common.shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    out = quality.quality_rules(docs(spark, edge_rows()))
    first = records(out, "doc_id", "kept")
    made = set(os.listdir(folder)) - before
    assert made and records(out, "doc_id", "kept") == first          # read again from the written tables
    assert common.release() == len(made) == len(common.Scratch._made) + len(made)
    assert set(os.listdir(folder)) == before
    assert common.release() == 0


def test_a_cluster_without_shared_folder_is_an_error():
    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default):
                return default

    try:
        common.shared_dir(Session())
    except RuntimeError as e:
        assert "spark.checkpoint.dir" in str(e)
    else:
        raise AssertionError
