"""Results do not depend on the partitioning (SURVEY §5 invariant (3))."""

import pytest

import __spark_entry__ as E
from conftest import SF_MID

QUERIES = E.queries()
NAMES = ["l3_sample_n", "l5_stratified_split", "l7_oversample", "l9_inject_nulls", "m4_knn", "t3_first_seen_codes",
         "c10_row_index", "e8_roc_curve", "w1_w5_event_series", "k3_silhouette_exact", "a14_box_stats",
         "m10_gaussian_nb"]


def _rows(spark, name, parts):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        df = QUERIES[name](spark, SF_MID).repartition(parts)
        return sorted(map(tuple, df.collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


@pytest.mark.parametrize("name", NAMES)
def test_same_result_under_other_partitionings(spark, name):
    assert _rows(spark, name, 3) == _rows(spark, name, 17)
