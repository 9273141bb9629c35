"""How the derived movie tables are stored."""

from marquee.plans import derived


def test_summed_line_items_are_shuffled_once(spark, tmp_path, monkeypatch):
    rows = spark.range(400).selectExpr(
        "id div 4 AS l_orderkey", "id % 7 AS l_suppkey", "CAST(id AS DECIMAL(15,2)) AS l_extendedprice", "CAST(0.01 AS DECIMAL(15,2)) AS l_tax",
        "CAST(0.02 AS DECIMAL(15,2)) AS l_discount", "CAST(1 + id % 50 AS DECIMAL(15,2)) AS l_quantity", "'O' AS l_linestatus")
    rows.write.parquet(str(tmp_path / "lineitem.parquet"))
    plans, write = [], derived.materialize

    def seen(df, *args):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, *args)

    monkeypatch.setattr(derived, "materialize", seen)
    assert derived.tmdb(spark, str(tmp_path)).selectExpr("count(*)", "count(DISTINCT tmdb_id)", "sum(vote_count)").first() == (100, 100, 100 * 240 + sum(range(100)))
    assert len(plans) == 1 and plans[0].count("Exchange ") == 1
