"""Data-quality suite: every check of a suite in one aggregation of the data.

A check is a description: which columns it needs and two aggregate expressions,
the number of failing rows and the number of rows it looked at. A suite turns
all its checks into one ``agg`` over the data and unfolds the single result row
into one row per check, so the data is read once, not once per check. Checks
that count distinct values go into a second aggregation, because the plan Spark
makes for them would multiply the rows of the cheap ones.
"""

from dataclasses import dataclass, field
from typing import Callable

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Row
from pyspark.sql import functions as F

from barworks.functions.dates import safe_date
from barworks.functions.numeric import guarded_ratio, is_missing, round_stable, safe_double
from barworks.schemas import BAR_KEY, PRICES

WARN, CRITICAL = "WARN", "CRITICAL"

RESULT_COLUMNS = ["suite", "check_no", "check_name", "severity", "passed", "failed_rows", "checked_rows", "failed_pct", "detail"]


@dataclass(frozen=True)
class Check:
    name: str
    severity: str
    columns: tuple
    # (column -> Spark type) -> dict of aggregate expressions: failed, checked and,
    # optionally, passed and detail.
    measures: Callable = field(compare=False)
    distinct: bool = False


def _rows():
    return F.count(F.lit(1))


def not_null(column, severity=CRITICAL):
    """No nulls; NaN counts as null."""
    return Check(f"not_null({column})", severity, (column,), lambda types: {
        "failed": F.count_if(is_missing(column, types[column])),
        "checked": _rows(),
    })


def unique(columns, severity=CRITICAL, name=None):
    """No value (or combination) twice; nulls are equal to each other.

    Counted as rows minus distinct structs: the struct keeps nulls countable.
    """
    columns = (columns,) if isinstance(columns, str) else tuple(columns)
    return Check(name or f"unique({'+'.join(columns)})", severity, columns, lambda types: {
        "failed": _rows() - F.count_distinct(F.struct(*columns)),
        "checked": _rows(),
    }, distinct=True)


def in_range(column, min_val=None, max_val=None, severity=CRITICAL):
    """Values inside inclusive bounds; missing values are not looked at."""
    def measures(types):
        text = types[column] == "string"
        value = safe_double(column) if text else F.col(column)
        present = ~is_missing(value, "double" if text else types[column])
        failed = F.lit(0).cast("bigint")
        if min_val is not None:
            failed = failed + F.count_if(present & (value < F.lit(min_val)))
        if max_val is not None:
            failed = failed + F.count_if(present & (value > F.lit(max_val)))
        return {"failed": failed, "checked": F.count_if(present)}
    return Check(f"in_range({column}, {min_val}..{max_val})", severity, (column,), measures)


def row_count_between(min_rows=1, max_rows=None, severity=CRITICAL):
    def measures(types):
        ok = _rows() >= F.lit(min_rows)
        if max_rows is not None:
            ok = ok & (_rows() <= F.lit(max_rows))
        return {"failed": F.when(ok, 0).otherwise(1).cast("bigint"), "checked": _rows(), "passed": ok}
    return Check(f"row_count({min_rows}..{max_rows})", severity, (), measures)


def freshness(date_column, as_of, max_age_days=3, severity=WARN):
    """The latest parsable date is at most ``max_age_days`` before ``as_of``."""
    def measures(types):
        latest = F.max(safe_date(date_column))
        age = F.datediff(F.lit(as_of).cast("date"), latest)
        ok = F.coalesce(age <= F.lit(max_age_days), F.lit(False))
        return {
            "failed": F.when(ok, 0).otherwise(1).cast("bigint"),
            "checked": F.count(safe_date(date_column)),
            "passed": ok,
            "detail": F.concat_ws(", ", F.concat(F.lit("latest "), latest.cast("string")),
                                  F.concat(F.lit("age days "), age.cast("string"))),
        }
    return Check(f"freshness({date_column}, {max_age_days}d)", severity, (date_column,), measures)


def schema_match(expected, severity=CRITICAL):
    """All expected columns are present; more are welcome."""
    def measures(types):
        missing = sorted(c for c in expected if c not in types)
        return {
            "failed": F.lit(len(missing)).cast("bigint"),
            "checked": F.lit(len(expected)).cast("bigint"),
            "detail": F.lit(f"missing columns: {', '.join(missing)}" if missing else ""),
        }
    return Check(f"schema_match({len(expected)} cols)", severity, (), measures)


def custom_check(name, predicate, severity=CRITICAL, columns=()):
    """Any Boolean aggregate expression, for example ``F.max("d") < F.lit(day)``."""
    return Check(name, severity, tuple(columns), lambda types: {
        "failed": F.when(F.coalesce(predicate, F.lit(False)), 0).otherwise(1).cast("bigint"),
        "checked": _rows(),
        "passed": F.coalesce(predicate, F.lit(False)),
    })


def _result_struct(df, suite, number, check, types, probe):
    """One check as a struct of its result columns.

    A check that cannot be planned on this frame (a column is missing or, with
    ``probe``, an expression turns out not to fit) is a failed check, not a
    failed suite.
    """
    found, problem = {}, None
    absent = [c for c in check.columns if c not in types]
    if absent:
        problem = f"column not found: {', '.join(absent)}"
    else:
        found = check.measures(types)
        if probe:
            try:
                df.agg(*[e.alias(k) for k, e in found.items()])
            except AnalysisException as exc:
                found, problem = {}, f"check could not run: {exc.getCondition()}"
    none = F.lit(0).cast("bigint")
    failed, checked = found.get("failed", none), found.get("checked", none)
    passed = F.lit(False) if problem else found.get("passed", failed == 0)
    detail = F.lit(problem) if problem else found.get("detail", F.lit(""))
    share = F.coalesce(round_stable(guarded_ratio(failed, checked) * 100, 1), F.lit(0.0))
    return F.struct(
        F.lit(suite).alias("suite"), F.lit(number).cast("bigint").alias("check_no"),
        F.lit(check.name).alias("check_name"), F.lit(check.severity).alias("severity"),
        passed.alias("passed"), failed.cast("bigint").alias("failed_rows"),
        checked.cast("bigint").alias("checked_rows"),
        share.cast("double").alias("failed_pct"), detail.alias("detail"),
    )


def run_suite(df, checks, suite="quality"):
    """One row per check, as a lazy DataFrame."""
    try:
        return _plan_suite(df, checks, suite, probe=False)
    except AnalysisException:
        return _plan_suite(df, checks, suite, probe=True)


def _plan_suite(df, checks, suite, probe):
    types = dict(df.dtypes)
    parts = []
    for wants_distinct in (False, True):
        structs = [_result_struct(df, suite, n, c, types, probe)
                   for n, c in enumerate(checks, start=1) if c.distinct is wants_distinct]
        if structs:
            parts.append(df.agg(F.array(*structs).alias("r")).select(F.inline("r")))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def bar_suite(min_rows=1, max_rows=None, as_of=None, freshness_days=None):
    """The standard checks of a bar batch (11, plus freshness where asked for).

    The names are fixed values. ``max_rows`` guards against a runaway extract
    where the caller knows a bound; by default a batch may have any size.
    """
    checks = [not_null(c) for c in ("symbol", "trade_date", "close_price")]
    checks += [in_range(c, min_val=0) for c in (*PRICES, "volume")]
    checks.append(row_count_between(min_rows, max_rows))
    checks.append(unique(BAR_KEY, WARN, name="unique(symbol+exchange+date)"))
    checks.append(schema_match([*BAR_KEY, *PRICES, "volume"], WARN))
    if freshness_days is not None:
        checks.append(freshness("trade_date", as_of, freshness_days))
    return checks


def suite_summary(results):
    """Per suite: checks passed, failed, critical failures, and the verdict."""
    critical = ~F.col("passed") & (F.col("severity") == CRITICAL)
    return results.groupBy("suite").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("passed")).alias("passed"),
        F.count_if(~F.col("passed")).alias("failed"),
        F.count_if(critical).alias("critical"),
    ).withColumn("status", F.when(F.col("critical") == 0, "PASSED").otherwise("FAILED"))


class QualityGateError(RuntimeError):
    def __init__(self, failed):
        super().__init__(f"critical quality checks failed: {', '.join(failed)}")
        self.failed = failed


def _collect(df, checks, suite):
    """Result rows of a suite. If its one job fails on some value (an expression
    that raises), each check runs alone and only the culprits fail."""
    try:
        return run_suite(df, checks, suite).collect()
    except PySparkException:
        rows = []
        for number, check in enumerate(checks, start=1):
            try:
                row = run_suite(df, [check], suite).first().asDict()
            except PySparkException as exc:
                row = dict(suite=suite, check_name=check.name, severity=check.severity, passed=False,
                           failed_rows=0, checked_rows=0, failed_pct=0.0,
                           detail=f"check raised {exc.getCondition() or type(exc).__name__}")
            rows.append(Row(**{**row, "check_no": number}))
        return rows


def enforce(df, checks, suite="quality"):
    """Run a suite (one action) and raise if a CRITICAL check failed.

    Returns the result rows, one per check. An empty batch passes unchecked, as
    there is nothing to reject. The data itself is never touched.
    """
    probe = row_count_between(0, None, WARN)
    rows = _collect(df, [*checks, probe], suite)
    size = next(r for r in rows if r["check_name"] == probe.name and r["check_no"] == len(checks) + 1)
    if size["checked_rows"] == 0:
        return []
    results = sorted((r for r in rows if r["check_no"] <= len(checks)), key=lambda r: r["check_no"])
    failed = [r["check_name"] for r in results if not r["passed"] and r["severity"] == CRITICAL]
    if failed:
        raise QualityGateError(failed)
    return results
