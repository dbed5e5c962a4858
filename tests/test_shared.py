from gridlark.sources.shared import discard, materialize, shared_folder
from gridlark.sources.versions import folders


def test_tables_are_removed_and_nothing_else(spark, tmp_path):
    before = set(folders(spark, shared_folder(spark), "table-"))
    table = materialize(spark.range(100).repartition(3))
    other = str(tmp_path / "table-mine")
    spark.range(5).write.parquet(other)
    mine = spark.read.parquet(other)
    assert len(set(folders(spark, shared_folder(spark), "table-")) - before) == 1
    assert table.count() == 100
    discard(mine), discard(table.where("id < 5")), discard(spark.range(3))
    assert set(folders(spark, shared_folder(spark), "table-")) == before and mine.count() == 5
