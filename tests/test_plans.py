"""Plans, statistics, schema on read, and what a cache saves."""

import pytest
from pyspark.sql import functions as F

from jobmart.operators import joins, plans
from jobmart.plans.queries import QUERIES
from jobmart.plans.queries.base import table
from jobmart.plans.queries.joining import CBO_SQL
from jobmart.scratch import counting_reads, persisted
from jobmart.session import CBO_CONF
from jobmart.sources import readers


def test_scans_tell_filters_and_columns(spark, folder):
    df = table(spark, folder, "orders").filter("o_orderkey > 5 AND o_orderstatus = 'F'").groupBy("o_orderpriority").count()
    scans = [n for n in plans.plan_nodes(df) if n.operator.startswith("Scan")]
    assert len(scans) == 1 and set(scans[0].columns) == {"o_orderkey", "o_orderpriority", "o_orderstatus"}
    assert any("GreaterThan(o_orderkey,5)" in p for p in scans[0].pushed)
    assert plans.guard(df, scans[0].columns, filtered=True) is df
    with pytest.raises(ValueError, match="o_orderstatus"):
        plans.guard(df, ["o_orderkey", "o_orderpriority"])
    with pytest.raises(ValueError, match="no pushed filter"):
        plans.guard(table(spark, folder, "part").select("p_size"), filtered=True)


def test_pairing_joins_are_objected_to(spark, folder):
    nation = table(spark, folder, "nation")
    assert plans.objections(nation.crossJoin(table(spark, folder, "region"))) and not plans.objections(nation.join(nation, "n_nationkey"))


@pytest.mark.parametrize("name", ["salary_by_city", "count_by_level", "dedup_latest", "join_three_way", "skill_demand_supply", "certificates_by_role"])
def test_headline_plans_read_what_they_need(spark, folder, name):
    df = QUERIES[name](spark, folder)
    assert not plans.objections(df)
    whole = {t: len(table(spark, folder, t).columns) for t in ("orders", "customer", "lineitem", "supplier", "part")}
    scans = [n for n in plans.plan_nodes(df) if n.operator.startswith("Scan")]
    assert scans and all(len(n.columns) < max(whole.values()) for n in scans)


def test_statistics_change_the_join_order(spark, folder):
    given = {name: table(spark, folder, name) for name in ("lineitem", "part", "supplier")}
    order = lambda df: [n for n in ("part", "supplier") if n in df._jdf.queryExecution().optimizedPlan().toString()]  # noqa: E731,F841

    def depth(df, column):
        """Joins above the scan of a column's table: the deeper, the earlier it is joined."""
        lines = df._jdf.queryExecution().optimizedPlan().toString().split("\n")
        at = next(i for i, line in enumerate(lines) if "Relation" in line and column in line)
        return len(lines[at]) - len(lines[at].lstrip(" :+-"))

    before = {k: spark.conf.get(k, None) for k in CBO_CONF}
    with joins.analysed_tables(spark, **given) as names:
        plain = spark.sql(CBO_SQL.format(**names))
        assert depth(plain, "p_partkey") > depth(plain, "s_suppkey")
        with joins.settings(spark, CBO_CONF):
            chosen = spark.sql(CBO_SQL.format(**names))
            assert depth(chosen, "s_suppkey") >= depth(chosen, "p_partkey")
            assert sorted(map(tuple, chosen.collect())) == sorted(map(tuple, plain.collect()))
    assert {k: spark.conf.get(k, None) for k in CBO_CONF} == before
    assert not any(t.name.startswith("jobmart_lineitem_") for t in spark.catalog.listTables())


def test_settings_are_restored_after_an_error(spark):
    key, unset = "spark.sql.shuffle.partitions", "spark.sql.cbo.enabled"
    old = spark.conf.get(key)
    with pytest.raises(RuntimeError), joins.settings(spark, {key: "3", unset: "true"}):
        assert spark.conf.get(key) == "3"
        raise RuntimeError
    assert spark.conf.get(key) == old and spark.conf.get(unset) == "false"


def test_variant_records_of_any_shape(spark, tmp_path):
    lines = ['{"a": 1, "b": "x", "it\'s": true}', '{"a": 2.5, "n": {"deep": [1, 2]}}', "broken {", '{"a": null, "nothing": null}', "[1]", "3", ""]
    (tmp_path / "in.json").write_text("\n".join(lines))
    rows = readers.read_json_variant(spark, str(tmp_path / "in.json"))
    one = rows.filter(F.schema_of_variant("payload").startswith("OBJECT"))
    got = readers.variant_columns(one).collect()
    assert [None if r["a"] is None else float(r["a"]) for r in got] == [1.0, 2.5, None]
    assert got[0]["b"] == "x" and got[0]["it's"] is True and list(got[1]["n"]["deep"]) == [1, 2] and got[2]["nothing"] is None
    assert readers.variant_columns(rows.limit(0)).columns == []
    given = readers.variant_columns(rows, readers.T.StructType().add("a", "double").add("z", "string"))
    assert [r["a"] for r in given.collect()][:2] == [1.0, 2.5] and given.columns == ["a", "z"]


def test_a_cached_table_is_read_once(spark):
    counted, counter = counting_reads(spark.range(100).withColumn("k", F.col("id") % 3))
    counted.count()
    counted.groupBy("k").count().collect()
    assert counter.value == 200
    counted, counter = counting_reads(spark.range(100).withColumn("k", F.col("id") % 3))
    with persisted(counted) as cached:
        cached.count()
        cached.groupBy("k").count().collect()
    assert counter.value == 100
