"""Threshold checks as data, their report, verdict and score."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tallyhouse.functions.frames import side_by_side
from tallyhouse.functions.retail import HIGH_QUANTITY, amount_is_off
from tallyhouse.functions.stamps import hours_between, ntz
from tallyhouse.functions.stats import mean
from tallyhouse.operators.integrity import CHECKED_DIMENSIONS, orphan_counts
from tallyhouse.operators.script_checks import ROW_KEYS

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Check:
    """One rule: what to measure, and when the measured row passes.

    A check measures either aggregates over one table (``table`` and
    ``aggregates``), which are then computed together with the other checks on
    that table, or any one-row frame (``row``). With ``own_scan`` the aggregates
    are computed apart: beside a distinct count, every other measure would travel
    with each distinct key. ``passes`` gets the measures and the threshold; a null
    answer is a failure.
    """

    category: str
    name: str
    description: str
    threshold: float
    critical: bool
    passes: Callable[[Callable[[str], Column], Column], Column]
    table: str = ""
    aggregates: Mapping[str, Column] = field(default_factory=dict)
    own_scan: bool = False
    row: Callable[[Tables], DataFrame] | None = None

    def packed(self) -> Column:
        """The aggregates as one struct column named after the check."""
        return F.struct(*[c.alias(n) for n, c in self.aggregates.items()]).alias(self.name)

    def measured(self, tables: Tables) -> DataFrame:
        """One row with one struct column that holds the measures."""
        if self.row is None:
            return tables[self.table].agg(self.packed())
        measures = self.row(tables)
        return measures.select(F.struct(*measures.columns).alias(self.name))

    def verdict(self) -> Column:
        answer = self.passes(lambda name: F.col(f"{self.name}.{name}"), F.lit(float(self.threshold)))
        return F.coalesce(answer, F.lit(False))


def _share(*counts: Column, of: Column) -> Column:
    total = counts[0]
    for count in counts[1:]:
        total = total + count
    return F.try_divide(total.cast("double"), of.cast("double"))


def _warehouse_counts(tables: Tables) -> DataFrame:
    named = {"raw": "raw_count", "fact": "fact_count"}
    named |= {"dim_customer": "customer_count", "dim_product": "product_count"}
    return side_by_side(
        *[tables[table].agg(F.count("*").alias(name)) for table, name in named.items()]
    )


def default_checks(as_of: datetime) -> tuple[Check, ...]:
    """The seven checks of the catalogue.

    Names, descriptions, thresholds and criticality are fixed values of the rule set.
    """
    amount = F.col("total_amount")
    return (
        Check(
            "raw_data_checks",
            "null_critical_fields",
            "Check for nulls in critical fields",
            0.05,
            True,
            lambda m, limit: _share(
                m("null_customer_id"),
                m("null_stock_code"),
                m("null_invoice_date"),
                of=m("total_rows") * 3,
            )
            <= limit,
            "raw",
            {
                "total_rows": F.count("*"),
                "null_customer_id": F.count_if(F.col("customer_id").isNull()),
                "null_stock_code": F.count_if(F.col("stock_code").isNull()),
                "null_invoice_date": F.count_if(F.col("invoice_date").isNull()),
            },
        ),
        Check(
            "raw_data_checks",
            "duplicate_records",
            "Check for duplicate records",
            0.01,
            False,
            lambda m, limit: (m("total_records") == 0)
            | (
                _share(m("total_records") - m("unique_combinations"), of=m("total_records"))
                <= limit
            ),
            "raw",
            {
                "total_records": F.count("*"),
                "unique_combinations": F.count_distinct(F.struct(*ROW_KEYS)),
            },
            own_scan=True,
        ),
        Check(
            "raw_data_checks",
            "data_range_validation",
            "Validate data ranges",
            0.1,
            False,
            lambda m, limit: _share(
                m("invalid_price"), m("suspicious_quantity"), of=m("total_rows")
            )
            <= limit,
            "raw",
            {
                "total_rows": F.count("*"),
                "invalid_price": F.count_if(F.col("price") <= 0),
                "suspicious_quantity": F.count_if(F.col("quantity") > HIGH_QUANTITY),
                "zero_quantity": F.count_if(F.col("quantity") == 0),
            },
        ),
        Check(
            "warehouse_checks",
            "referential_integrity",
            "Check referential integrity",
            0,
            True,
            lambda m, limit: (m("orphaned_products") <= limit)
            & (m("orphaned_customers") <= limit)
            & (m("orphaned_times") <= limit),
            row=lambda tables: orphan_counts(tables["fact"], tables, CHECKED_DIMENSIONS),
        ),
        Check(
            "warehouse_checks",
            "business_logic",
            "Validate business calculations",
            0,
            True,
            lambda m, limit: (m("calculation_errors") <= limit)
            & (m("negative_non_returns") <= limit),
            "fact",
            {
                "total_sales": F.count("*"),
                "calculation_errors": F.count_if(
                    amount_is_off(amount, F.col("quantity"), F.col("unit_price"))
                ),
                "avg_transaction_value": mean(F.sum(amount), F.count(amount)),
                "negative_non_returns": F.count_if((amount < 0) & ~F.col("is_return")),
            },
        ),
        Check(
            "performance_checks",
            "data_freshness",
            "Check data freshness",
            48,
            False,
            lambda m, limit: m("hours_since_last_load") <= limit,
            "raw",
            {
                "last_loaded": F.max("created_at"),
                "hours_since_last_load": hours_between(F.max("created_at"), ntz(as_of)),
            },
        ),
        Check(
            "performance_checks",
            "row_count_validation",
            "Validate expected row counts",
            0.95,
            True,
            lambda m, limit: _share(m("fact_count"), of=m("raw_count")) >= limit,
            row=_warehouse_counts,
        ),
    )


REPORT_SCHEMA = T.StructType(
    [
        T.StructField("category", T.StringType()),
        T.StructField("check_name", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("results", T.MapType(T.StringType(), T.StringType())),
        T.StructField("passed", T.BooleanType()),
        T.StructField("critical", T.BooleanType()),
        T.StructField("threshold", T.DoubleType()),
        T.StructField("error", T.StringType()),
    ]
)


def _failed(check: Check, error: Exception) -> tuple:
    return (
        check.category,
        check.name,
        check.description,
        {},
        False,
        check.critical,
        float(check.threshold),
        str(error),
    )


def _entry(check: Check, columns: list[str]) -> Column:
    values: list[Column] = []
    for name in columns:
        values += [F.lit(name), F.col(f"{check.name}.{name}").cast("string")]
    return F.struct(
        F.lit(check.category).alias("category"),
        F.lit(check.name).alias("check_name"),
        F.lit(check.description).alias("description"),
        F.create_map(*values).alias("results"),
        check.verdict().alias("passed"),
        F.lit(check.critical).alias("critical"),
        F.lit(float(check.threshold)).alias("threshold"),
        F.lit(None).cast("string").alias("error"),
    )


def run_check(check: Check, tables: Tables) -> DataFrame:
    """One check as one row: its measures as columns, then the verdict."""
    return check.measured(tables).select(
        F.lit(check.name).alias("check_name"),
        f"{check.name}.*",
        check.verdict().alias("passed"),
        F.lit(check.critical).alias("critical"),
        F.lit(float(check.threshold)).alias("threshold"),
    )


def checks_report(
    spark: SparkSession, tables: Tables, checks: Sequence[Check]
) -> DataFrame:
    """One row per check, all measured by one plan; checks on one table share a scan.

    A check that cannot be planned (a missing table or column) becomes a failed
    row with the error text and leaves the others alone.
    """
    sound, broken = [], []
    for check in checks:
        try:
            shape = check.measured(tables)
            shape.select(check.verdict())
            sound.append((check, shape.schema[check.name].dataType.names, shape))
        except Exception as error:  # any planning error is the check's result
            broken.append(_failed(check, error))

    fused: dict[str, list[Column]] = {}
    rows = []
    for check, _, shape in sound:
        if check.row is None and not check.own_scan:
            fused.setdefault(check.table, []).append(check.packed())
        else:
            rows.append(shape)
    rows += [tables[table].agg(*packed) for table, packed in fused.items()]

    report = spark.createDataFrame(broken, REPORT_SCHEMA) if broken or not rows else None
    if rows:
        entries = F.array(*[_entry(check, names) for check, names, _ in sound])
        good = side_by_side(*rows).select(F.inline(entries))
        report = good if report is None else good.unionByName(report)
    return report


def checks_report_isolated(
    spark: SparkSession, tables: Tables, checks: Sequence[Check]
) -> DataFrame:
    """The rows of :func:`checks_report`, where a failure while a check runs costs that check only.

    All checks run in one plan. If that fails, its halves are run, and so on down to the checks that break: the
    sound ones stay fused. One row per check comes back to the driver, which is bounded by the catalogue.
    """
    found = {row[1]: row for row in _isolated(spark, tables, list(checks))}
    return spark.createDataFrame([found[check.name] for check in checks], REPORT_SCHEMA)


def _isolated(spark: SparkSession, tables: Tables, checks: list[Check]) -> list[tuple]:
    try:
        return [tuple(row) for row in checks_report(spark, tables, checks).collect()]
    except Exception as error:  # any runtime error is the result of the check that breaks
        if len(checks) == 1:
            return [_failed(checks[0], error)]
    half = len(checks) // 2
    return _isolated(spark, tables, checks[:half]) + _isolated(spark, tables, checks[half:])


def report_lines(report: DataFrame) -> DataFrame:
    """The report with the measures of a check as one text, ``name=value`` in order of names."""
    told = F.transform(
        F.array_sort(F.map_keys("results")),
        lambda name: F.concat(name, F.lit("="), F.coalesce(F.element_at("results", name), F.lit("null"))),
    )
    return report.withColumn("results", F.array_join(told, ", "))


def run_named(
    spark: SparkSession, name: str, tables: Tables, checks: Sequence[Check]
) -> DataFrame:
    """Report of one check by name; a name outside the catalogue is a failed check."""
    found = [check for check in checks if check.name == name]
    if found:
        return checks_report(spark, tables, found)
    unknown = Check("unknown", name, "Unknown check", 0.0, False, lambda m, limit: F.lit(False))
    row = _failed(unknown, ValueError(f"Unknown check: {name}"))
    return spark.createDataFrame([row], REPORT_SCHEMA)


def checks_summary(report: DataFrame) -> DataFrame:
    """One row of totals with the overall status."""
    passed = F.col("passed")
    critical = F.count_if(~passed & F.col("critical"))
    return report.agg(
        F.count("*").alias("total_checks"),
        F.count_if(passed).alias("passed_checks"),
        F.count_if(~passed).alias("failed_checks"),
        critical.alias("critical_failures"),
        F.when(critical > 0, "CRITICAL_FAILURE")
        .when(F.count_if(~passed) > 0, "WARNING")
        .otherwise("PASS")
        .alias("overall_status"),
    )


def quality_score(summary: DataFrame) -> DataFrame:
    share = F.try_divide(
        F.col("passed_checks").cast("decimal(20,0)") * 100, F.col("total_checks")
    )
    score = F.coalesce(F.round(share, 1).cast("double"), F.lit(0.0))
    return summary.select(score.alias("quality_score"), "*")


def quality_dashboard(report: DataFrame, metrics: DataFrame) -> DataFrame:
    """One row: score, status and totals of the checks next to the key metrics."""
    return side_by_side(quality_score(checks_summary(report)), metrics)


def failed_checks(report: DataFrame) -> DataFrame:
    return report.where(~F.col("passed")).select(
        "category", F.col("check_name").alias("name"), "description", "critical"
    )
