import pytest
from pyspark.sql import functions as F

from pitpanel.functions import stages
from pitpanel.plans.roles import Roles


def test_every_supplier_has_a_code_of_its_own(spark, tmp_path):
    ids = [*range(1200), 999_999, *range(1_000_000, 1_000_500), 123_456_789]
    rows = [(i, f"s{i}", 1.0, 0) for i in ids]
    spark.createDataFrame(rows, "s_suppkey long, s_name string, s_acctbal double, s_nationkey long").write.parquet(
        str(tmp_path / "supplier.parquet")
    )
    codes = Roles(spark, str(tmp_path)).codes
    assert codes.select(F.count_distinct("thscode")).first()[0] == len(ids)
    assert codes.where("s_suppkey = 7").first().thscode == "000007.SZ"


def test_staging_needs_a_shared_folder_on_a_cluster():
    class Conf:
        def get(self, key, default):
            return default

    class Session:
        conf = Conf()
        sparkContext = type("Context", (), {"master": "yarn"})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        stages.shared_folder(Session())
