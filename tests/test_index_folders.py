from pyspark.sql import functions as F

from ledgerloom.operators import search as S


def test_folders_of_statistics_do_not_grow_with_labels(spark, tmp_path):
    rows = spark.range(10_000).select(F.concat(F.lit("label n"), "id").alias("label"), F.lit("f").alias("form"), F.lit("p").alias("publisher"), F.lit(2000).alias("year"), F.lit(1).alias("vnd"))
    S.store_index(S.label_stats(rows, "label", "form", "publisher", "year", "vnd"), str(tmp_path))
    assert len(list((tmp_path / "stats").glob("part=*"))) == 1
    index = S.open_index(spark, str(tmp_path))
    assert [r["label"] for r in S.find_stored(index, "label n9999").collect()] == ["label n9999"] and index[1].filter("token = 'label'").count() == 10_000
