import pytest
from pyspark.sql import functions as F

from tableferry.operators.choose_key import DISTINCT_ERROR, TOP_ERROR, choose_distribution, key_facts
from tests.helpers import plan


def wide(spark, n=50_000):
    i = F.col("id")
    return spark.range(0, n, 1, 4).select(i.alias("unique"), (i % 1000).alias("even"), F.when(i % 3 == 0, 5).otherwise(i).alias("hot"), (i % 4).cast("string").alias("few"),
                                          F.when(i % 10 != 0, i).alias("holes"), F.lit(None).cast("int").alias("nothing"))


def test_sketches_are_within_their_errors_and_one_pass(spark):
    df = wide(spark)
    facts = key_facts(df, df.columns)
    got = {r.column_name: r for r in facts.collect()}
    for c in df.columns:
        exact = df.agg(F.countDistinct(c)).first()[0]
        assert abs(got[c].n_distinct - exact) <= 5 * DISTINCT_ERROR * exact
        top = df.where(F.col(c).isNotNull()).groupBy(c).count().agg(F.max("count")).first()[0] or 0
        assert abs(got[c].top_rows - top) <= TOP_ERROR * 50_000 + 1
    assert got["holes"].n_null == 5000 and got["nothing"].n_null == 50_000
    # Map tasks send one row.
    text = plan(key_facts(df, df.columns))
    assert text.count("Exchange") == 1 and "partial_approx_count_distinct" in text


def test_the_choice_and_its_reasons(spark):
    df = wide(spark)
    chosen, told = choose_distribution(df, df.columns, 16)
    reasons = {r.column_name: r.reason for r in told.collect()}
    assert chosen == "unique" and reasons["unique"] is None and reasons["even"] is None
    assert "one value" in reasons["hot"] and reasons["few"] and "no value" in reasons["holes"] and "no value" in reasons["nothing"]
    # A primary key of one column comes first, of two it has no say.
    assert choose_distribution(df, df.columns, 16, ["even"])[0] == "even"
    assert choose_distribution(df, df.columns, 16, ["even", "hot"])[0] == "unique"
    assert choose_distribution(df, ["few", "hot"], 16)[0] is None


def test_empty_tables_and_wrong_columns(spark):
    chosen, told = choose_distribution(wide(spark, 0), ["unique"], 4)
    assert chosen is None and told.first().reason == "the table is empty"
    with pytest.raises(ValueError, match="can't distribute"):
        key_facts(spark.sql("select array(1) as a"), ["a"])
    with pytest.raises(ValueError, match="no candidates"):
        key_facts(wide(spark, 1), [])
