"""What a task holds or makes does not grow with the input."""

from __future__ import annotations

from pyspark.sql import functions as F

from crewlens.functions.skills import qualifying_pairs
from crewlens.operators import experience
from crewlens.operators.experience import experience_totals, position_ratings, prior_experience
from crewlens.plans.page_checks import sanitized_pages
from crewlens.plans.qualification import first_five_qualification
from fieldlens import tables
from fieldlens.queries import AS_OF, QUERIES
from fieldlens.tables import lens


def largest_task(df):
    return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]


def applications_by_rows(spark, sf_dir, monkeypatch):
    """The applications, as adaptive execution deals them and dealt by rows."""
    plain = lens(spark, sf_dir)["applications"]
    monkeypatch.setattr(tables, "FEW_JOINED_ROWS", 0)
    monkeypatch.setattr(tables, "JOINED_ROWS", 500)
    return plain, lens(spark, sf_dir)["applications"]


def test_applications_are_joined_in_tasks_of_few_rows(spark, sf_dir, monkeypatch):
    plain, dealt = applications_by_rows(spark, sf_dir, monkeypatch)
    monkeypatch.setattr(tables, "FEW_JOINED_ROWS", 10**9)
    assert largest_task(dealt) < 1_500 < largest_task(plain)
    assert dealt.exceptAll(plain).isEmpty() and plain.exceptAll(dealt).isEmpty()


def test_distinct_gigs_stay_in_those_tasks(spark, sf_dir, monkeypatch):
    """Nothing deals the join's rows into fewer tasks again before the gigs are told apart."""
    _, dealt = applications_by_rows(spark, sf_dir, monkeypatch)
    gigs = dealt.select("gig_id").distinct()
    assert largest_task(gigs) < 500
    assert gigs.count() == tables.base(spark, sf_dir, "lineitem").select("l_orderkey").distinct().count()


def test_customers_too_many_to_broadcast_leave_those_tasks_as_they_are(spark, sf_dir, monkeypatch):
    """The applications are not dealt by customer, in tasks sized by bytes."""
    plain, _ = applications_by_rows(spark, sf_dir, monkeypatch)
    monkeypatch.setattr(tables, "FEW_CUSTOMERS", 0)
    dealt = lens(spark, sf_dir)["applications"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "3000")  # the nations alone
    try:
        assert largest_task(dealt) < 1_500
        assert dealt.exceptAll(plain).isEmpty() and plain.exceptAll(dealt).isEmpty()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def customers(spark, folder, n):
    spark.range(n).selectExpr(
        "id AS c_custkey", "concat('Customer#', id) AS c_name", "CAST(id % 25 AS INT) AS c_nationkey",
        "0D AS c_acctbal", "'BUILDING' AS c_mktsegment",
    ).coalesce(1).write.parquet(f"{folder}/customer.parquet")


def test_pages_of_a_small_file_are_made_by_many_tasks(spark, tmp_path):
    customers(spark, tmp_path, 50_001)
    pages = lens(spark, str(tmp_path))["markup"]
    sizes = [r["count"] for r in pages.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 50_001 and len(sizes) == 3 and max(sizes) < 20_000


def test_each_array_is_emptied_once(spark):
    html = "a const REVIEW_ROWS = [[1,\n[2]]; b const REVIEW_ROWS = [3]; const OUTREACH_ROWS = []; ñ"
    pages = sanitized_pages(spark.createDataFrame([(1, html)], "page_id int, html string"), "html", "page_id")
    assert pages.first()["page"] == (
        "a const REVIEW_ROWS = []; b const REVIEW_ROWS = [3]; const OUTREACH_ROWS = []; ñ"
    )
    plan = pages._jdf.queryExecution().optimizedPlan().toString()
    # looked for once a step, not at each place that uses the step's page
    assert "regexp" not in plan and plan.count("locate(const REVIEW_ROWS = [") <= 6


def applications(spark, n):
    return spark.range(n).select(
        F.col("id").alias("shift_id"), (F.col("id") % 5).alias("pro_id"), F.lit(1).cast("bigint").alias("location_id"),
        F.expr("TIMESTAMP_NTZ '2024-01-02 00:00:00'").alias("start_time"), F.lit("dishwasher").alias("skill_key"),
    )


def history(spark):
    rows = [(p, p, 1, r, "dishwasher") for p in range(5) for r in (4.0,)] + [(0, 9, 1, 7.0, "dishwasher")]
    return spark.createDataFrame(
        rows, "gigster_id bigint, gig_id bigint, location_id bigint, rating double, skill_key string"
    ).withColumn("start_time", F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'"))


def test_ratings_look_up_their_own_skill_alone(spark):
    found = position_ratings(applications(spark, 10), history(spark), qualifying_pairs(spark))
    assert {(float(r[2]), r[3]) for r in found.collect()} == {(4.0, 1)}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "_scope" not in plan and "shifts_today" not in plan


def test_lookups_are_made_in_tasks_of_few_applications(spark):
    found = prior_experience(applications(spark, 200_001), history(spark), qualifying_pairs(spark))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Repartition 5" in plan
    counts = found.groupBy("pro_id", "prior_paid_qualifying_skill_shifts").count().collect()
    assert {(r[0], r[1]) for r in counts} == {(0, 2), (1, 1), (2, 1), (3, 1), (4, 1)}


def test_timed_rows_are_dealt_by_their_number(spark, monkeypatch):
    """Not by the shuffle partitions, of which the tests have four."""
    conf, pairs = applications(spark, 20_000), qualifying_pairs(spark)
    plain = experience_totals(conf, history(spark), pairs, worked=6)
    monkeypatch.setattr(experience, "FEW_TIMED_ROWS", 0)
    monkeypatch.setattr(experience, "TIMED_ROWS", 10_000)
    dealt = experience_totals(conf, history(spark), pairs, worked=6)
    assert largest_task(dealt) < 1_500 < largest_task(plain)
    assert dealt.exceptAll(plain).isEmpty() and plain.exceptAll(dealt).isEmpty()


def shuffled_rows(plan):
    """Rows that the exchanges of a plan that has run have written; a reused one counts once."""
    kind = plan.getClass().getSimpleName()
    if kind == "ReusedExchangeExec":
        return 0
    own = plan.metrics().apply("shuffleRecordsWritten").value() if kind == "ShuffleExchangeExec" else 0
    children = plan.children()
    return own + sum(shuffled_rows(children.apply(i)) for i in range(children.size()))


def test_an_application_is_not_shuffled_for_each_skill_and_scope(spark):
    """Once for the lookups, its totals and the result each, and never with each skill and scope."""
    conf, pairs = applications(spark, 3_000), qualifying_pairs(spark)
    accepted = pairs.filter("skill_key = 'dishwasher'").count()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = prior_experience(conf, history(spark), pairs)
        assert found.count() == 3_000
        found = prior_experience(conf, history(spark), pairs)
        found.collect()
        rows = shuffled_rows(found._jdf.queryExecution().executedPlan())
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert accepted > 1 and 9_000 <= rows < 10_000


def test_confirmed_applications_are_written_once(spark, sf_dir):
    """For the evidence and for the earlier experience; neither reads the applications for them again."""
    plan = QUERIES["experience_flags"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    # confirmed applications are told by their latest confirmation, history by its latest rating
    assert "confirmation_timestamp" not in plan and "rating_timestamp" in plan


def test_joins_do_not_deal_the_dealt_rows_anew(spark, sf_dir, monkeypatch):
    """Sides dealt to fewer partitions than the shuffle has would be."""
    monkeypatch.setattr(tables, "FEW_JOINED_ROWS", 0)
    plan = lens(spark, sf_dir)["applications"]._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [l_orderkey" in plan
    assert all(line.rstrip().endswith(", 4") for line in plan.splitlines() if "RepartitionByExpression" in line)


def test_history_is_not_dealt_by_pro(spark, sf_dir):
    """The candidates' pros are a small file, which is broadcast to the tasks of the latest rows."""
    report = first_five_qualification(lens(spark, sf_dir), AS_OF, 6_000)
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "/pros]" in plan and "SortMergeJoin [gigster_id" not in plan
    assert any("BroadcastHashJoin [gigster_id" in line and "LeftSemi" in line for line in plan.splitlines())
