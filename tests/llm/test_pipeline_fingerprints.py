"""The near-duplicate stage of the pipeline looks for candidates by fingerprints too, and verifies them."""

from pyspark.sql import functions as F

from souk.llm import jaccard, simhash


def test_classes_of_fingerprints_are_compared(spark):
    base = " ".join(f"w{k * k % 977}" for k in range(400))
    other = " ".join(f"v{k * k % 983}" for k in range(400))
    df = spark.createDataFrame([(0, base), (1, f"{base} end"), (2, other), (3, base)], "row long, text string")
    found = jaccard.sketches(df.select("row", F.col("row").alias("id"), "text"))
    key = {r.row: r.key for r in found.collect()}
    firsts = found.where("row < 3").select("key", "row", F.slice("bands", 1, 0).alias("bands"))  # no bands
    assert jaccard.links(firsts, df).count() == 0
    classes = simhash.near_duplicates(df, "row", "text", jaccard.SIZE)
    assert {r.component_id for r in classes.where("doc_id < 2").collect()} == {0}
    all_in_one = found.select("key", F.lit(0).alias("class"))
    own = found.join(classes.withColumnRenamed("doc_id", "row"), "row").select("key", F.col("component_id").alias("class"))
    for given in (own, all_in_one):  # members that are not similar are not linked
        got = {frozenset((r.a, r.b)) for r in jaccard.links(firsts, df, classes=given).collect()}
        assert got == {frozenset((key[0], key[1]))}


def test_the_stage_takes_all_rows_through_fingerprints(spark, monkeypatch):
    seen = []
    real = simhash.near_duplicates

    def recorded(docs, id_col, text_col, size):
        seen.append((docs.count(), size))
        return real(docs, id_col, text_col, size)

    monkeypatch.setattr(simhash, "near_duplicates", recorded)
    rows = [(k, " ".join(f"t{k % 5}x{j}" for j in range(60))) for k in range(20)]
    kept = jaccard.one_of_each_group(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id for r in kept.collect()} == set(range(5)) and seen == [(20, jaccard.SIZE)]
