"""Data-quality suites."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetmart.operators import quality as Q
from fleetmart.plans.catalog.base import load, long, query, shown, shown_sql

REGEX = Q.Expectation("expect_column_values_to_match_regex", {"column": "name", "regex": "^[a-zA-Z ]*$"})
BETWEEN = Q.Expectation("expect_column_values_to_be_between", {"column": "value", "min_value": 5, "max_value": 120})
NOT_NULL = Q.Expectation("expect_column_values_to_not_be_null", {"column": "name"})
UNIQUE = Q.Expectation("expect_column_values_to_be_unique", {"column": "code"})
IN_SET = Q.Expectation("expect_column_values_to_be_in_set", {"column": "kind", "value_set": ["click", "view", "signup"]})
MEAN = Q.Expectation("expect_column_mean_to_be_between", {"column": "value", "min_value": 10, "max_value": 1000})
JSON = Q.Expectation("expect_column_values_to_be_json_parseable", {"column": "doc"})
OF_TYPE = Q.Expectation("expect_column_values_to_be_of_type", {"column": "value", "type": "double"})
ALL = [REGEX, BETWEEN, NOT_NULL, UNIQUE, IN_SET, MEAN, JSON, OF_TYPE]

_SOURCE_SQL = """src AS (SELECT event_id, user_id, event_type AS kind, value, CASE WHEN event_id % 6 = 0 THEN NULL WHEN event_id % 5 = 0 THEN concat('e', CAST(event_id AS VARCHAR)) ELSE event_type END AS name,
  event_id - event_id % 2 * CASE WHEN event_id % 10 = 1 THEN 1 ELSE 0 END AS code, CASE WHEN event_id % 11 = 0 THEN concat('{', props) ELSE props END AS doc FROM events)"""


def source(spark, sf_dir):
    n = F.col("event_id")
    return load(spark, sf_dir, "events").select(
        n, "user_id", F.col("event_type").alias("kind"), "value",
        F.when(n % 6 == 0, None).when(n % 5 == 0, F.concat(F.lit("e"), n.cast("string"))).otherwise(F.col("event_type")).alias("name"),
        F.when(n % 10 == 1, n - 1).otherwise(n).alias("code"),
        F.when(n % 11 == 0, F.concat(F.lit("{"), F.col("props"))).otherwise(F.col("props")).alias("doc"),
    )


# predicate of a failing row, per expectation
_BAD = {
    "dq_regex": (REGEX, "name IS NOT NULL AND NOT regexp_matches(name, '^[a-zA-Z ]*$')"),
    "dq_between": (BETWEEN, "NOT (value BETWEEN 5 AND 120)"),
    "dq_not_null": (NOT_NULL, "name IS NULL"),
    "dq_unique": (UNIQUE, "code IN (SELECT code FROM src GROUP BY code HAVING count(*) > 1)"),
    "dq_in_set": (IN_SET, "kind NOT IN ('click', 'view', 'signup')"),
    "dq_json": (JSON, "NOT json_valid(doc)"),
}


def _metric_sql(e: Q.Expectation, bad: str, ok: str = "bad = 0", observed: str = "CAST(NULL AS DOUBLE)") -> str:
    present = "n" if e.function.endswith("not_be_null") else "n - missing"
    return f"""SELECT '{e.column}' AS "column", '{e.function}' AS expectation_type, CAST({ok} AS INTEGER) AS expectation_success, CAST(n AS BIGINT) AS element_count,
  CAST(missing AS BIGINT) AS missing_count, CAST(bad AS BIGINT) AS unexpected_count, {shown_sql(f'coalesce(bad * 100.0 / nullif({present}, 0), 0)')} AS unexpected_percent, {shown_sql(observed)} AS observed_value
FROM (SELECT count(*) AS n, count(*) FILTER (WHERE {e.column} IS NULL) AS missing, count(*) FILTER (WHERE {bad}) AS bad, avg(value) AS mean FROM src)"""


def metric_rows(df, suite):
    out = Q.metrics(df, suite, "run-1", "2024-07-18 22:23:50")
    return out.select(
        "column", "expectation_type", F.col("expectation_success").cast("int").alias("expectation_success"), "element_count", "missing_count", "unexpected_count",
        shown(F.col("unexpected_percent")).alias("unexpected_percent"), shown(F.col("observed_value")).alias("observed_value"),
    )


def _register(name: str, e: Q.Expectation, bad: str) -> None:
    @query(name, f"WITH {_SOURCE_SQL}, bad AS (SELECT event_id FROM src WHERE {bad}) SELECT CAST(event_id AS BIGINT) AS event_id FROM bad")
    def _(spark, sf_dir):
        suite = Q.Suite("events", ["event_id"], [e])
        return Q.flagged(source(spark, sf_dir), suite).filter("_bad0").select(long(F.col("event_id")).alias("event_id"))


for _name, (_e, _bad) in _BAD.items():
    _register(_name, _e, _bad)


@query("dq_mean_between", f"WITH {_SOURCE_SQL} {_metric_sql(MEAN, 'FALSE', 'mean BETWEEN 10 AND 1000', 'mean')}")
def _(spark, sf_dir):
    return metric_rows(source(spark, sf_dir), Q.Suite("events", ["event_id"], [MEAN]))


@query(
    "dq_metrics",
    f"WITH {_SOURCE_SQL} " + " UNION ALL ".join(
        [_metric_sql(e, bad) for e, bad in _BAD.values()] + [_metric_sql(MEAN, "FALSE", "mean BETWEEN 10 AND 1000", "mean"), _metric_sql(OF_TYPE, "FALSE", "TRUE")]
    ),
)
def _(spark, sf_dir):
    return metric_rows(source(spark, sf_dir), Q.Suite("events", ["event_id"], ALL))


_TAG_SUITE = Q.Suite("events", ["user_id", "kind"], [REGEX, BETWEEN, IN_SET])
_FLAGS = [(e.function, f"max(CASE WHEN {b} THEN 1 ELSE 0 END)") for e, b in (_BAD["dq_regex"], _BAD["dq_between"], _BAD["dq_in_set"])]
_TAGS_SQL = f"""{_SOURCE_SQL}, k AS (SELECT CASE WHEN user_id % 9 = 0 THEN NULL ELSE user_id END AS uid, * FROM src),
f AS (SELECT uid, kind, {', '.join(f'{x} AS f{i}' for i, (_, x) in enumerate(_FLAGS))} FROM k GROUP BY uid, kind),
t AS (SELECT k.event_id, f0, f1, f2 FROM k JOIN f ON k.uid IS NOT DISTINCT FROM f.uid AND k.kind = f.kind)"""


def tagged(spark, sf_dir):
    df = source(spark, sf_dir).withColumn("user_id", F.when(F.col("user_id") % 9 != 0, F.col("user_id")))
    return Q.tag_rows(df, _TAG_SUITE, "run-1")


@query(
    "dq_tag_rows",
    f"""WITH {_TAGS_SQL} SELECT CAST(event_id AS BIGINT) AS event_id, 'run-1' AS run_name, CAST(max(f0 + f1 + f2) OVER () = 0 AS INTEGER) AS run_success, CAST(f0 + f1 + f2 = 0 AS INTEGER) AS run_row_success,
  array_to_string(list_sort(list_filter([{', '.join(f"CASE WHEN f{i} = 1 THEN '{n}' END" for i, (n, _) in enumerate(_FLAGS))}], lambda x: x IS NOT NULL)), ',') AS failed FROM t""",
)
def _(spark, sf_dir):
    tag = F.col("dq_validations")
    return tagged(spark, sf_dir).select(
        long(F.col("event_id")).alias("event_id"), tag["run_name"].alias("run_name"), tag["run_success"].cast("int").alias("run_success"), tag["run_row_success"].cast("int").alias("run_row_success"),
        F.array_join(tag["dq_failure_details"]["expectation_type"], ",").alias("failed"),
    )


@query(
    "dq_result_explode",
    f"""WITH {_TAGS_SQL} {' UNION ALL '.join(f"SELECT CAST(event_id AS BIGINT) AS event_id, '{n}' AS expectation_type FROM t WHERE f{i} = 1" for i, (n, _) in enumerate(_FLAGS))}""",
)
def _(spark, sf_dir):
    return Q.failures(tagged(spark, sf_dir), ["event_id"]).withColumn("event_id", long(F.col("event_id")))
