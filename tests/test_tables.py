"""Row ids hold whatever the split of files; ranks are global."""

import pytest
from pyspark.sql import functions as F

from loomwright.functions.tables import FILE_ROW_BITS, _on_all_machines, plain_scan, with_rank, with_row_ids


def test_row_ids_hold_for_other_splits(spark, tmp_path):
    spark.range(5000).selectExpr("id", "repeat(cast(id as string), 50) as text").repartition(7).write.parquet(f"{tmp_path}/t")
    docs = spark.read.parquet(f"{tmp_path}/t").where("id % 3 != 0")
    seen = []
    for parts in ("2", "40"):
        spark.conf.set("spark.sql.files.minPartitionNum", parts)
        try:
            table = with_row_ids(docs, "rid")
            seen.append((table.rdd.getNumPartitions(), {r.id: r.rid for r in table.collect()}))
        finally:
            spark.conf.unset("spark.sql.files.minPartitionNum")
    assert seen[0][0] != seen[1][0] and seen[0][1] == seen[1][1]
    assert len(set(seen[0][1].values())) == len(seen[0][1]) == docs.count()


def test_row_ids_of_any_plan(spark, sf):
    parquet = spark.read.parquet(f"{sf}/documents.parquet")
    assert plain_scan(parquet.where("doc_id > 3").select("doc_id"))
    for other in (parquet.where(F.rand() < 2), parquet.select("doc_id", F.explode(F.array(F.lit(1), F.lit(2))).alias("k")), parquet.union(parquet), parquet.crossJoin(spark.range(2)), spark.range(10)):
        assert not plain_scan(other)
        ids = [r.rid for r in with_row_ids(other, "rid").collect()]
        assert len(ids) == len(set(ids)) == other.count()
    odd = parquet.selectExpr("doc_id as `a.b`", "1 as rid_path", "2 as `x y`")
    assert with_row_ids(odd, "rid").columns == ["a.b", "rid_path", "x y", "rid"]
    assert with_row_ids(parquet.limit(0), "rid").count() == 0


def test_ranks(spark):
    table = spark.range(1000).selectExpr("(id * 7919) % 1000 as v", "1 as _part", "2 as _start")
    rows = with_rank(table, [F.col("v")], "r", 0)
    assert rows.columns == ["v", "_part", "_start", "r"]
    assert all(r.v == r.r for r in rows.collect())


def test_row_ids_move_no_rows_and_take_odd_paths(spark, tmp_path):
    odd = f"{tmp_path}/a b%20c"
    spark.range(60).selectExpr("id", "concat('k %/=é ', id % 3) as `p q`").write.partitionBy("p q").parquet(odd)
    table = spark.read.parquet(odd)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = with_row_ids(table, "rid")
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan
        ids = [r.rid for r in found.collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(set(ids)) == 60 and len({i >> FILE_ROW_BITS for i in ids}) == len(table.inputFiles())


@pytest.mark.parametrize("folder,shared", [("file:/tmp/w", False), ("/tmp/w", False), ("hdfs://n/w", True), ("s3a://b/w", True)])
def test_machine_local_folders_are_refused(folder, shared):
    if shared:
        assert _on_all_machines(folder) == folder
    else:
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            _on_all_machines(folder)
