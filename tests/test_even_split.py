import datetime as dt
import random
import uuid
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tableferry.sources import jdbc
from tableferry.sources.even_split import at_least, before, between, conditions, even_conditions, even_cuts
from tableferry.specs import LoadSpec
from tests.test_sources import SOURCE


def asked(spark, df):
    name, queries = "v_" + uuid.uuid4().hex, []
    df.cache().createOrReplaceTempView(name)

    def ask(query):
        queries.append(query)
        return [tuple(r) for r in spark.sql(query).collect()]

    return ask, name, queries


def sizes(df, found):
    counts = df.agg(*[F.count_if(F.expr(c)).alias(f"c{i}") for i, c in enumerate(found)], F.count("*")).first()
    return list(counts)[:-1], counts[-1]


KEYS = {
    "numbers": ("k int", lambda r: (int(r.paretovariate(0.7)) % 10**9,)),
    "text": ("k string", lambda r: (r.choice(["", "a", "é", "日本", "it's", "order-00000", "order-1"]) + str(r.randint(0, 300)),)),
    "days": ("k date", lambda r: (dt.date(2024, 1, 1) + dt.timedelta(days=min(r.randint(0, 400), r.randint(0, 400))),)),
    "times": ("k timestamp_ntz", lambda r: (dt.datetime(2024, 1, 1) + dt.timedelta(seconds=r.randint(0, 10**6)),)),
    "decimals": ("k decimal(12,3)", lambda r: (Decimal(r.randint(-10**6, 10**6)) / 1000,)),
    "composite": ("a string, b int, c string", lambda r: (r.choice(["x"] * 8 + ["y", None]), r.choice([7] * 5 + list(range(40)) + [None]), r.choice([None, *map(str, range(500))]))),
    "nulls": ("k int", lambda r: (r.choice([None, None, None, r.randint(0, 99)]),)),
}


@pytest.mark.parametrize("kind", KEYS)
def test_each_row_is_in_one_range_and_ranges_are_even(spark, kind):
    schema, make = KEYS[kind]
    rng = random.Random(kind)
    df = spark.createDataFrame([make(rng) for _ in range(4000)], schema)
    ask, name, queries = asked(spark, df)
    found = even_conditions(ask, name, df.columns, 8)
    counts, total = sizes(df, found)
    assert sum(counts) == total == 4000
    once = df.where(sum((F.when(F.expr(c), 1).otherwise(0) for c in found), F.lit(0)) == 1).count()
    assert once == 4000 and len(found) <= 8
    # What no column tells apart can't be parted: a whole key's rows, and rows without a value.
    alike = df.groupBy(*df.columns).count().agg(F.max("count")).first()[0]
    first = df.where(F.col(df.columns[0]).isNull()).count()
    assert max(counts) <= max(2 * total / 8, alike + total / 8, first + total / 8)
    assert len(queries) <= 60


def test_frequent_values_are_parted_by_the_next_column(spark):
    df = spark.range(6000).select(F.lit("same").alias("a"), (F.col("id") % 2).alias("b"), F.col("id").alias("c"))
    ask, name, _ = asked(spark, df)
    cuts = even_cuts(ask, name, ["a", "b", "c"], 6)
    assert {len(c) for c in cuts} == {3}
    counts, _ = sizes(df, conditions(["a", "b", "c"], cuts))
    assert len(counts) == 6 and max(counts) <= 2000


def test_empty_and_tiny_tables(spark):
    for rows, partitions in (([], 4), ([(1,)], 4), ([(1,), (1,)], 1), ([(None,)], 3)):
        df = spark.createDataFrame(rows, "k int")
        ask, name, _ = asked(spark, df)
        found = even_conditions(ask, name, ["k"], partitions)
        assert sum(sizes(df, found)[0]) == len(rows)
    with pytest.raises(ValueError, match="columns to split by"):
        even_cuts(lambda q: [(1,)], "t", [], 2)


def test_conditions_are_the_sources_own_sql():
    assert at_least(["a", "b"], ("x", 3), "postgres") == """("a" > 'x' or ("a" = 'x' and "b" >= 3))"""
    assert before(["a"], ("it's",), "mysql") == "(`a` < 'it''s' or `a` is null)"
    assert conditions(["a"], []) == ["1=1"]


def test_values_between():
    assert between(0, 8, 4) == [2, 4, 6, 8] and between(3, 4, 8) == [4] and between(5, 5, 8) == []
    found = between("apple", "apricot", 8)
    assert found == sorted(found) and all("apple" < x <= "apricot" for x in found) and found[-1] == "apricot"
    with pytest.raises(ValueError, match="no values"):
        between(b"a", b"b", 4)


def test_a_source_that_orders_otherwise_is_an_error(spark):
    """As if it ignored case: the counts between candidates are not those of the whole."""
    df = spark.createDataFrame([(x,) for x in "aBcDeFgHiJkL" * 20], "k string")
    ask, name, _ = asked(spark, df)

    def other(query):
        rows = ask(query)
        return [(part, n - 1, low, high) for part, n, low, high in rows] if "case when" in query else rows

    with pytest.raises(ValueError, match="orders k otherwise"):
        even_cuts(other, name, ["k"], 4)


def test_the_conditions_reach_the_reader(monkeypatch):
    from tests.test_sources import Recorder

    class Counting(Recorder):
        def collect(self):
            query = self.seen["query"]
            if query.startswith("select part"):
                return [(i, 12, 1 + 12 * i, 12 + 12 * i) for i in range(8)]
            return [(96, 1, 96)] if "min(" in query else [(96,)]

    recorder = Counting()
    got = jdbc.read_evenly(recorder, SOURCE, "orders", ["id"], source_where="a = 1", load=LoadSpec(read_partitions=2))
    assert got["dbtable"] == "(select * from orders where a = 1) filtered_rows"
    assert len(got["predicates"]) == 2 and got["predicates"][1].startswith("`id` >= ")
