"""Every registered query against its SQL, plus the shape of the plans."""

import re

import pytest

from __spark_entry__ import entry
from compare import compare, duck
from corpusflow.plans.oracle import ORACLE
from corpusflow.plans.queries import QUERIES


def queries():
    return QUERIES


def oracle_sql():
    return ORACLE


@pytest.fixture(scope="module")
def con(small_dir):
    return duck(small_dir)


def test_registries_agree():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_matches_sql(spark, con, small_dir, name):
    assert compare(spark, con, name, small_dir) == ""


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["example_id", "text"] and df.count() > 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(queries()))
def test_plans_stay_native(spark, small_dir, name):
    plan = plan_of(queries()[name](spark, small_dir))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "Arrow"):
        assert word not in plan, word


@pytest.mark.parametrize(
    "name",
    ["chat_prompt", "md_sections", "section_examples", "code_pairs", "path_filters", "weighted_keep",
     "template_choice", "source_attributes", "strip_text", "line_prefix", "decode_text", "log_metrics"],
)
def test_row_local_queries_do_not_shuffle(spark, small_dir, name):
    assert "Exchange hashpartitioning" not in plan_of(queries()[name](spark, small_dir))


def test_filters_and_columns_reach_the_scan(spark, small_dir):
    plan = plan_of(queries()["field_filter"](spark, small_dir))
    assert "EqualTo(lang,en)" in plan and "EqualTo(quality,1)" in plan
    assert re.search(r"ReadSchema: struct<doc_id:bigint,lang:string>", plan)
    plan = plan_of(queries()["cap_per_source"](spark, small_dir))
    assert "text" not in "".join(re.findall(r"ReadSchema: (\S+)", plan))


def test_costly_expressions_run_once(spark, small_dir):
    df = queries()["code_units_all"](spark, small_dir)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    # The lexer once, the other extraction is of heads that the regex can't follow. Aggregates: the
    # scan by a counter (one in another), the one by a stack (and the brackets of a line), two that
    # look for stray brackets, one for heads.
    assert plan.count("(?s)//") == 1 and plan.count("regexp_extract_all(") == 2 and plan.count("aggregate(") == 2 + 3 + 2 + 1
    df = queries()["md_sections"](spark, small_dir)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(") == 1


def test_counts_build_no_text(spark, small_dir):
    """Columns that a count doesn't need are gone from its plan."""
    for name in ("code_unit_stats", "corpus_stats"):
        plan = queries()[name](spark, small_dir)._jdf.queryExecution().optimizedPlan().toString()
        # The unit's code and body are made of `text`; what stays is the cut-out for the signature.
        assert not [c for c in ("body", "text", "doc_comment", "question") if f"AS {c}#" in plan], name
    from corpusflow.operators import examples
    from corpusflow.plans import queries as q

    made = examples.unit_examples(q._units(spark, small_dir), q.CONFIG).groupBy("origin").count()
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "conversations" not in plan and "What does the" not in plan


def test_module_lookup_moves_no_contents(spark):
    from pyspark.sql import functions as F

    from corpusflow.operators import modules

    files = spark.range(100).select(
        F.lit("s").alias("source"), F.format_string("d%d/e/f.go", F.col("id") % 9).alias("path"), F.lit("text").alias("content")
    )
    manifests = spark.createDataFrame([("s", "d1", "m1"), ("s", "d1/e", "m2"), ("s", "", "root"), ("t", "d2", "no")], "source string, dir string, module string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        placed = modules.attach_modules(files, manifests)
        # The exchanges that are left belong to the map of manifests; files meet no join.
        assert "Join" not in plan_of(placed)
        got = {r.path: r.module_path for r in placed.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got["d1/e/f.go"] == "m2" and got["d2/e/f.go"] == "root/d2/e" and len(got) == 9


def test_many_manifests_give_the_same_modules(spark, monkeypatch):
    from corpusflow.operators import modules

    files = spark.createDataFrame([("s", p) for p in ("a/b/c.go", "a/x.go", "y.go", "q/r/s.go")], "source string, path string")
    manifests = spark.createDataFrame([("s", "a", "ma"), ("s", "q/r", "mq")], "source string, dir string, module string")
    mapped = sorted(modules.attach_modules(files, manifests).collect())
    monkeypatch.setattr(modules, "MOST_MAPPED", 0)
    assert sorted(modules.attach_modules(files, manifests).select("source", "path", "module_path").collect()) == sorted(
        (r.source, r.path, r.module_path) for r in mapped
    )
