"""The survey read from small order tables, and what its steps leave on disk."""

import os
import time
from datetime import datetime

from pyspark.sql import functions as F

from catalog import standins as S
from shoalcast.session import cut_lineage


def order_tables(spark, folder):
    orders = [(1, 7, "F", 9000.0, datetime(1996, 1, 2), "1-URGENT"), (2, 8, "O", 100.0, datetime(1996, 2, 3), "3-MEDIUM"), (3, 7, "P", 50.0, datetime(1996, 2, 3), "5-LOW")]
    lines = [
        (key, part, 1, number, float(n), 10.0 * n, 0.06, 0.02, "R", "O", datetime(1996, 3, n))
        for key, number, part, n in [(1, 1, 1, 1), (1, 1, 2, 2), (1, 1, 2, 3), (1, 2, 1, 4), (2, 1, 2, 5), (3, 1, 9, 6), (3, 1, 9, 7)]
    ]
    names = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    spark.createDataFrame(lines, names).write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string").write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame([(1, "Brand#11", "SMALL", 12), (2, "Brand#12", "LARGE", 47)], "p_partkey long, p_brand string, p_type string, p_size int").write.parquet(f"{folder}/part.parquet")
    return str(folder)


def test_numbered_lines_give_the_records_and_groups_of_the_line_items(spark, rows, tmp_path):
    folder = order_tables(spark, tmp_path)
    numbered = cut_lineage(S.numbered_lines(spark, folder))
    records = S.survey_records(spark, folder, numbered)
    assert rows(records) == rows(S.survey_records(spark, folder))
    # Lines without a part count as occurrences, too.
    assert rows(records.select("uuid")) == [("1",), ("1-2",), ("1-3",), ("2",), ("3",), ("3-2",)]
    answers = cut_lineage(S.line_answers(spark, folder, numbered))
    assert rows(S.survey_groups(spark, folder, answers)) == rows(S.survey_groups(spark, folder))


def test_records_are_dealt_before_their_answers_are_spelled_out(spark, tmp_path):
    folder = order_tables(spark, tmp_path)
    plan = S.survey_records(spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("RepartitionByExpression", 1)
    assert "trip_group_boat_reg_no" in above and "trip_group" not in below


def test_a_written_table_leaves_no_shuffle_files(spark):
    folder = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()

    def shuffles():
        return {f for top in folder for _, _, files in os.walk(top) for f in files if f.startswith("shuffle_")}

    before = shuffles()
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    held = spark.conf.get(key)
    written = cut_lineage(spark.range(5000).repartition(7, F.col("id") % 7).groupBy((F.col("id") % 3).alias("k")).count())
    assert {tuple(r) for r in written.collect()} == {(0, 1667), (1, 1667), (2, 1666)}
    for _ in range(50):
        if not (left := shuffles() - before):
            break
        time.sleep(0.1)
    assert not left and spark.conf.get(key) == held
