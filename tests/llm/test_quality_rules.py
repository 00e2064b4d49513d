"""The target of the quality rules covers every trusted text."""

from pyspark.sql import functions as F

from skyledger.llm import quality_rules


def test_all_trusted_texts_count(spark):
    """With every text trusted, target and raw corpus are the same, however many texts."""
    words = F.transform(F.sequence(F.lit(1), F.lit(20)), lambda i: F.concat(F.lit("w"), F.col("doc_id") * i))
    docs = spark.range(60_000).select(F.col("id").alias("doc_id"), F.array_join(words, " ").alias("text"))
    labels = docs.select("doc_id", F.lit(1).alias("quality")).union(docs.select("doc_id", F.lit(0)))
    rules = quality_rules.fit(docs, labels)
    assert not rules.ratio.any() and rules.threshold == 0
