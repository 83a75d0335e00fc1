import random
import time

import pytest
from pyspark.sql import functions as F

from jobmart import rules, schemas
from jobmart.operators import analytics, dedup, governance, joins, quality, shape
from jobmart.plans.queries import QUERIES


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def adverts(spark, rows):
    return spark.createDataFrame(rows, "url string, company string, title string, location_raw string, posted string").withColumn(
        "posted_date", F.to_date("posted")
    )


def test_latest_advert_is_kept_whatever_the_layout(spark):
    rows = [(f"u{i}", "A  co" if i % 2 else " a CO ", "Dev", "HN", f"2025-01-{i % 28 + 1:02d}") for i in range(200)]
    expected = [("u111",)]  # newest day, then the smallest url as text
    for parts in (1, 7):
        kept = dedup.keep_latest(adverts(spark, rows).repartition(parts)).select("url")
        assert [tuple(r) for r in kept.collect()] == expected


def test_keep_first_limits_groups_before_the_shuffle(spark, folder):
    text = plan(QUERIES["dedup_latest"](spark, folder))
    before_shuffle = text[text.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_url_duplicates_with_map_columns(spark):
    df = spark.createDataFrame([("u", {"a": "1"}), ("u", {"a": "1"}), (None, None)], "url string, m map<string,string>")
    assert dedup.drop_duplicate_urls(df).count() == 2


def test_row_key_falls_back_to_hash(spark):
    df = spark.createDataFrame([(None, "c", "t", "l"), ("u", "c", "t", "l")], "url string, company string, title string, location_raw string")
    assert [len(r["row_key"]) for r in dedup.with_row_key(df).collect()] == [64, 1]
    parts = spark.createDataFrame([(None, "A", None, "B"), (None, "A", "B", None), (None, "A", "B", "")], "url string, company string, title string, location_raw string")
    assert len({r["row_key"] for r in dedup.with_row_key(parts).collect()}) == 3


def test_dimension_has_one_row_per_key(spark):
    df = spark.createDataFrame([("a", None, "x"), ("a", "1", "y"), ("a", None, None), (None, "1", "1"), ("b", None, None)], "k string, p string, q string")
    got = dedup.one_row_per_key(df, "k").orderBy("k").collect()
    assert [tuple(r) for r in got] == [("a", "1", "y"), ("b", None, None)]


def test_audit_of_an_empty_table(spark):
    df = spark.createDataFrame([], "k string")
    assert tuple(dedup.dedup_audit(df, [F.col("k")]).first()) == (0, 0, 0)


def test_broadcast_only_within_the_limit(spark, folder):
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    customer = spark.read.parquet(f"{folder}/customer.parquet")
    on = F.col("o_custkey") == F.col("c_custkey")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan(joins.join_small(orders, customer, on))
        assert "SortMergeJoin" in plan(joins.join_small(orders, customer, on, limit=100))
        assert "SortMergeJoin" in plan(joins.join_large(orders, customer, on))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_three_way_join_with_statistics(spark):
    tables = {
        "candidate": spark.range(1, 1000).select("id", F.concat(F.lit("c"), "id").alias("name"), (F.col("id") % 10).alias("skill_id")),
        "skill": spark.range(1, 20).select((F.col("id") % 10).alias("skill_id"), (F.col("id") % 2).alias("is_hot")),
        "band": spark.createDataFrame([(0, "Intern"), (1, "Junior"), (2, "Senior")], "is_hot bigint, level string"),
    }
    for name, df in tables.items():
        df.write.mode("overwrite").saveAsTable(f"t3_{name}")
    joins.collect_statistics(spark, *(f"t3_{n}" for n in tables))
    old = {k: spark.conf.get(k) for k in joins.CBO_CONF}
    joins.enable_cost_based_join_order(spark)
    try:
        joined = joins.three_way_sql(
            spark, columns="f.name, b.level", fact="t3_candidate", first="t3_skill", fact_first="skill_id",
            first_key="skill_id", second="t3_band", second_owner="a", owner_second="is_hot", second_key="is_hot",
        )
        assert joined.count() == 1899
        chained = joins.join_three(
            spark.table("t3_candidate"), spark.table("t3_skill"), spark.table("t3_band"), "skill_id", "is_hot"
        )
        assert chained.count() == 1899
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_bucketed_tables_join_without_a_shuffle(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("b_left", "b_right"):
            joins.bucketed_table(spark.range(100).select("id", F.lit(name).alias(name)), name, "id", 4)
        joined = joins.join_large(spark.table("b_left"), spark.table("b_right"), "id")
        assert joined.count() == 100
        assert "Exchange hashpartitioning(id" not in plan(joined)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def random_sets(pick, ids, hot):
    """Id → skills; two thirds of the sets have the hot skill, many are equal."""
    sets = {}
    for i in range(ids):
        skills = {f"s{pick.randrange(25)}" for _ in range(pick.randrange(1, 7))}
        sets[i] = skills | ({hot} if pick.random() < 0.66 else set())
    return sets


@pytest.mark.parametrize("score", [0.3, 0.5, 0.75, 1.0])
def test_matches_equal_brute_force(spark, score):
    pick = random.Random(5)
    jobs, resumes = random_sets(pick, 120, "hot"), random_sets(pick, 90, "hot")
    jobs[1000] = {f"s{i}" for i in range(25)}  # a large set, banded sizes
    resumes[1000] = {f"s{i}" for i in range(20)}
    frame = lambda sets: spark.createDataFrame([(i, s) for i, skills in sets.items() for s in skills], "id int, skill string")
    got = joins.skillset_matches(frame(jobs), frame(resumes), "id", "id", score).collect()
    rows = {(frozenset(r["job_skills"]), frozenset(r["resume_skills"])): (r["n_jobs"], r["n_resumes"], r["n_shared"]) for r in got}
    assert len(rows) == len(got)
    expected = {}
    job_sets, resume_sets = [frozenset(s) for s in jobs.values()], [frozenset(s) for s in resumes.values()]
    for a in set(job_sets):
        for b in set(resume_sets):
            if len(a & b) / len(a | b) >= score - 1e-9:
                expected[a, b] = (job_sets.count(a), resume_sets.count(b), len(a & b))
    assert rows == expected


def test_a_skill_of_most_sets_is_not_joined_in_one_place(spark):
    """Two thirds of the sets share a skill; a set and its candidates are told by rarer ones."""
    rows = spark.range(6000).select("id", F.explode(F.array(
        F.concat(F.lit("s"), (F.col("id") % 1500).cast("string")), F.concat(F.lit("t"), (F.col("id") % 700).cast("string")),
        F.when(F.col("id") % 3 > 0, "hot"))).alias("skill")).filter("skill IS NOT NULL")
    got = joins.skillset_matches(rows, rows, "id", "id", 1.0)
    distinct = rows.groupBy("id").agg(F.sort_array(F.collect_set("skill")).alias("s")).groupBy("s").count()
    assert got.count() == distinct.count() and got.agg(F.sum("n_jobs")).first()[0] == 6000
    assert "hot" not in {r["skill"] for r in joins._with_frequency(rows, rows.groupBy("skill").agg(F.count("*").alias("n")), 16000).filter("n < 3").collect()}


def test_unseen_urls(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",)], "url string")
    seen = spark.createDataFrame([("a",), ("a",)], "url string")
    assert [r[0] for r in joins.unseen(df, seen).collect()] == ["b", "b"]


def test_salary_reports_agree(spark, folder):
    """Summing before the join gives what joining first gives."""
    orders = spark.read.parquet(f"{folder}/orders.parquet").withColumnRenamed("o_totalprice", "salary_mid")
    customer = spark.read.parquet(f"{folder}/customer.parquet")
    direct = analytics.salary_by(
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).withColumnRenamed("c_mktsegment", "city"), ["city"]
    )
    early = analytics.salary_by_dimension(orders, "o_custkey", customer, "c_custkey", F.col("c_mktsegment"), "city")
    assert direct.collect() == early.collect()


def test_top_k_does_not_sort_everything(spark, folder):
    assert "TakeOrderedAndProject" in plan(QUERIES["top_companies"](spark, folder))


def test_trend_period_reaches_the_scan(spark, folder):
    text = plan(QUERIES["hiring_trend_monthly"](spark, folder))
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text


def test_scans_read_only_what_they_need(spark, folder):
    text = plan(QUERIES["count_by_level"](spark, folder))
    assert "ReadSchema: struct<o_orderkey:bigint>" in text


NO_UDF = ["salary_parse_units", "salary_parse_display", "province_map", "level_maps", "date_normalise", "company_recover"]


@pytest.mark.parametrize("name", NO_UDF)
def test_normalisers_stay_in_the_jvm(spark, folder, name):
    text = plan(QUERIES[name](spark, folder))
    assert "EvalPython" not in text and "InArrow" not in text


def test_skills_pass_once_in_arrow_batches(spark, folder):
    """The automaton needs Python; one batched evaluation for all keywords, never row by row."""
    text = plan(QUERIES["skills_extract"](spark, folder))
    assert text.count("ArrowEvalPython") == 1 and "BatchEvalPython" not in text


QUIET = [n for n in QUERIES if not n.startswith(("stream", "sink", "salary_model", "advert_class", "materialise", "word_list", "star_fact"))]


def test_no_query_uses_a_cross_join_or_row_udf(spark, folder):
    for name in QUIET:
        text = plan(QUERIES[name](spark, folder))
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
            assert bad not in text, (name, bad)


def test_null_profile_and_coverage(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a bigint, b bigint")
    assert [tuple(r) for r in quality.null_profile(df, ["a", "b"]).collect()] == [("a", 2, 1, 0.5), ("b", 2, 2, 1.0)]
    assert tuple(quality.salary_coverage(df, "a", "b").first()) == (2, 1, 1)
    assert quality.null_profile(df.limit(0), ["a"]).first()["null_share"] is None


def test_observation_counts_during_the_write(spark):
    df, seen = quality.observe(spark.createDataFrame([("x", None), (None, "y")], "title string, posted_raw string"), "obs")
    df.write.format("noop").mode("overwrite").save()
    assert seen.get == {"n_rows": 2, "null_title": 1, "null_posted_raw": 1}


def test_row_policies(spark):
    df = spark.createDataFrame([("a", "Thương lượng"), ("b", None), ("c", "5 tr")], "title string, salary_raw string")
    finance = governance.RolePolicy(tables=["t"], filters={"t": "salary_raw <> 'Thương lượng' AND salary_raw IS NOT NULL"})
    reader = governance.RolePolicy(tables=["t"], filters={"t": "title = 'a'"}, columns={"t": ["title"]})
    open_role = governance.RolePolicy(tables=["t"])
    titles = lambda policies: sorted(r["title"] for r in governance.apply_row_policy(df, "t", policies).collect())
    assert titles([finance]) == ["c"]
    assert titles([finance, reader]) == ["a", "c"]
    assert titles([finance, open_role]) == ["a", "b", "c"]
    assert governance.apply_row_policy(df, "t", [reader]).columns == ["title"]
    with pytest.raises(PermissionError):
        governance.apply_row_policy(df, "other", [finance])
    governance.secured_view(df, "v", "t", [open_role])
    assert spark.table("v").count() == 3
    assert [r["title"] for r in governance.capped_result(spark.table("v"), 2, ["title"]).collect()] == ["a", "b"]
    assert titles([open_role, finance]) == ["a", "b", "c"]
    both = {r["title"]: r["salary_raw"] for r in governance.apply_row_policy(df, "t", [finance, reader]).collect()}
    assert both == {"a": None, "c": "5 tr"}  # the reader's row does not show the column that only finance sees
    restricted = governance.apply_row_policy(df, "t", [open_role], ["salary_raw IS NOT NULL", "title <> 'c'"])
    assert [r["title"] for r in restricted.collect()] == ["a"]


def test_harmonised_columns(spark):
    df = spark.createDataFrame([("HN", 1, 3)], "`Địa chỉ` string, luong_min bigint, luong_max bigint")
    same = shape.harmonise_columns(df, derive={"salary_mid": shape.salary_midpoint("luong_min", "luong_max")})
    assert same.select("city", "salary_mid").first() == ("HN", 2.0)
    assert shape.harmonise_columns(df.select("luong_min")).columns == ["luong_min"]


def test_display_names_and_defaults(spark):
    df = spark.createDataFrame([(None, "t", None)], "company string, title string, benefits array<string>")
    shown = shape.to_display(shape.with_empty_arrays(shape.with_text_defaults(df), ["benefits"]))
    assert shown.columns == ["Tên công ty", "Vị trí công việc", "Phúc lợi"]
    assert tuple(shown.first()) == ("Không rõ", "t", [])


def test_struct_and_map_fields(spark):
    struct = spark.createDataFrame([(("n", "t"),)], "d struct<company_name: string, `Company type`: string>")
    row = shape.map_fields(struct, "d", schemas.COMPANY_FIELDS).first()
    assert (row["company"], row["company_type"], row["country"]) == ("n", "t", None)
    as_map = spark.createDataFrame([({"Company size": "5"},)], "d map<string,string>")
    assert shape.map_fields(as_map, "d", schemas.COMPANY_FIELDS).first()["company_size"] == "5"


def test_required_columns(spark):
    df = spark.createDataFrame([("p", "t", "d", None), (None, "t", "d", "5")], "location_raw string, title string, posted_raw string, salary_raw string")
    assert shape.require(df).count() == 1
    assert set(rules.REQUIRED) == {"location_raw", "title", "posted_raw"}


def test_small_sets_that_share_one_skill_by_chance_are_no_candidates(spark):
    """Candidates of the skill match, small and large sets mixed: all that reach the score, few others."""
    picks = random.Random(5)
    sizes = [1, 2, 3, 4, 4, 4, 5, 7, 15, 16, 20, 40]
    sets = [(i, "job" if i % 2 else "resume", sorted(picks.sample(range(60 if i % 12 > 7 else 40), sizes[i % 12]))) for i in range(600)]
    for i in range(0, 200, 2):  # partners with some skills changed
        sets[i] = (i, "resume", sorted({*sets[i + 1][2][i % 3:], 100 + i}))
    for score in (0.3, 0.5, 0.8, 1.0):
        rows = spark.createDataFrame([(side, i, skills) for i, side, skills in sets], "side string, set_id long, skills array<int>")
        found = {tuple(r) for r in joins.candidate_sets(rows, score).collect()}
        jaccard = lambda a, b: len(a & b) / len(a | b)
        by_id = {i: set(skills) for i, _, skills in sets}
        jobs, resumes = ([i for i, side, _ in sets if side == name] for name in ("job", "resume"))
        assert {(a, b) for a in jobs for b in resumes if jaccard(by_id[a], by_id[b]) >= score} <= found
        if score == 0.5:
            alone = [(a, b) for a, b in found if len(by_id[a]) == len(by_id[b]) == 4 and len(by_id[a] & by_id[b]) < 2]
            assert not alone


@pytest.mark.parametrize("score", [0.2, 0.5, 0.9])
def test_candidates_in_rounds_and_with_common_skills(spark, score):
    """Skills of many sets come last in the common order; pairs of skills are joined in several rounds."""
    picks = random.Random(7)
    some = lambda: sorted({*picks.sample(range(6), picks.randint(0, 3)), *picks.sample(range(6, 90), picks.choice([1, 2, 3, 6, 14, 33]))})
    sets = {(side, i): some() for side in ("job", "resume") for i in range(150)}
    sets |= {("resume", i): sets["job", i][i % 2:] + [100 + i] * (i % 3 == 0) for i in range(100)}
    rows = spark.createDataFrame([(side, i, skills) for (side, i), skills in sets.items()], "side string, set_id long, skills array<int>")
    found = [tuple(r) for r in joins.candidate_sets(rows, score, common_above=20, pairs_at_once=4000).collect()]
    assert len(found) == len(set(found))
    share = lambda a, b: len({*a} & {*b}) / len({*a} | {*b})
    reached = {(a, b) for a in range(150) for b in range(150) if sets["job", a] and share(sets["job", a], sets["resume", b]) >= score}
    assert reached and reached <= set(found)
    assert not joins.candidate_sets(rows.filter("side = 'job'"), score).collect()


def test_common_skills_are_last_rarest_first(spark):
    rows = spark.createDataFrame(
        [("job", i, ["a", "b", "m"] if i < 6 else ["a", "x"]) for i in range(9)] + [("resume", 0, ["x", "y"])],
        "side string, set_id long, skills array<string>")
    got = {(r["side"], r["set_id"]): r["skills"] for r in joins._common_last(rows, 3).collect()}
    assert (got["job", 0], got["job", 8], got["resume", 0]) == (["b", "m", "a"], ["x", "a"], ["y", "x"])


def test_skill_match_deletes_the_shuffles_of_its_steps(spark, folder):
    """Shuffle files of a step go when its table is written."""
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        found = disk.getAllFiles()
        return {name for name in (found.apply(i).getName() for i in range(found.size())) if name.startswith("shuffle_")}

    before = files()
    matches = QUERIES["job_resume_match"](spark, folder)
    until = time.time() + 30
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before
    assert matches.count() > 0
