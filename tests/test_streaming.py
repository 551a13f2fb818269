from pyspark.sql import functions as F

from webglean.operators.pages import read_articles
from webglean.sources.tables import as_responses
from webglean.streaming.articles import stream_articles


def test_arriving_snapshots_give_the_same_articles(spark, tmp_path):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("url", "html")
    source = str(tmp_path / "pages")
    pages.filter(F.col("url") < "https").write.parquet(source)
    columns = ["url", "title", "text"]
    stream = stream_articles(spark, source, "url string, html string").select(*columns)
    query = stream.writeStream.format("memory").queryName("articles").option("checkpointLocation", str(tmp_path / "cp")).start()
    try:
        query.processAllAvailable()
        pages.filter(F.col("url") >= "https").write.mode("append").parquet(source)
        query.processAllAvailable()
        got = spark.table("articles").collect()
    finally:
        query.stop()
    expected = read_articles(as_responses(pages)).select(*columns).collect()
    assert sorted(got) == sorted(expected) and len(got) == pages.count()
