"""Data-quality suites and post-build tests.

A suite is a list of ``Expectation``s. ``run_suite`` compiles every
value-level expectation of a suite into **one** ``df.agg(...)`` (one scan, one
tiny final aggregate), evaluates schema-level expectations from the schema,
and returns one row per expectation as a DataFrame built from that single
aggregate row on the executors. Only ``gate`` brings rows to the driver, and
those are bounded by the number of expectations.

Semantics follow the raw-file expectations of the reference:

* not_null(mostly): non-null / total >= mostly; an empty batch passes.
* in_set: NULLs are ignored; (non-null in set) / non-null >= mostly.
* unique_proportion(min, max): distinct / non-null within [min, max].
* in_type_list: the column's Spark type name is in the list.
* columns_match_set: exact column set, any order.
* a column that the batch lacks fails its expectation (unexpected: every row).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the reference: the expectation type names of its suites.
NOT_NULL = "expect_column_values_to_not_be_null"
IN_SET = "expect_column_values_to_be_in_set"
UNIQUE_PROPORTION = "expect_column_proportion_of_unique_values_to_be_between"
IN_TYPE_LIST = "expect_column_values_to_be_in_type_list"
COLUMNS_MATCH_SET = "expect_table_columns_to_match_set"

RESULT_SCHEMA = T.StructType([
    T.StructField("expectation_index", T.IntegerType(), False),
    T.StructField("expectation_type", T.StringType(), False),
    T.StructField("column", T.StringType(), True),
    T.StructField("element_count", T.LongType(), True),
    T.StructField("unexpected_count", T.LongType(), True),
    T.StructField("observed_value", T.DoubleType(), True),
    T.StructField("success", T.BooleanType(), False),
])


class QualityGateError(RuntimeError):
    """Raised by ``gate`` when a suite fails; the load must not proceed."""


@dataclass(frozen=True)
class Expectation:
    type: str
    kwargs: dict = field(default_factory=dict)

    @property
    def column(self):
        return self.kwargs.get("column")


def not_null(column: str, mostly: float = 1.0) -> Expectation:
    return Expectation(NOT_NULL, {"column": column, "mostly": mostly})


def in_set(column: str, values, mostly: float = 1.0) -> Expectation:
    return Expectation(IN_SET, {"column": column, "value_set": list(values), "mostly": mostly})


def unique_proportion(column: str, min_value: float | None = None, max_value: float | None = None) -> Expectation:
    return Expectation(UNIQUE_PROPORTION, {"column": column, "min_value": min_value, "max_value": max_value})


def in_type_list(column: str, types) -> Expectation:
    return Expectation(IN_TYPE_LIST, {"column": column, "type_list": list(types)})


def columns_match_set(columns) -> Expectation:
    return Expectation(COLUMNS_MATCH_SET, {"column_set": list(columns)})


def from_json_suite(doc: dict) -> list[Expectation]:
    """Build a suite from the JSON document form (``{"expectations": [...]}``)."""
    return [Expectation(e["expectation_type"], dict(e.get("kwargs", {}))) for e in doc["expectations"]]


def _type_names(dt: T.DataType) -> set[str]:
    name = type(dt).__name__
    return {name, f"{name}()", dt.simpleString(), dt.simpleString().upper()}


def _ratio(num: Column, den: Column) -> Column:
    return F.when(den > 0, num.cast("double") / den.cast("double"))


def _suite_aggregates(columns, suite: list[Expectation], distinct: bool | None = None) -> list[Column]:
    """Aggregates of a suite; ``distinct`` selects only those with (True) or without (False) a distinct count."""
    plain: list[Column] = [F.count(F.lit(1)).alias("__total")]
    counted: list[Column] = []
    for n, e in enumerate(suite):
        c = e.column
        if c is not None and c not in columns:
            continue
        if e.type in (NOT_NULL, IN_SET, UNIQUE_PROPORTION):
            plain.append(F.count(F.col(c)).alias(f"__nn{n}"))
        if e.type == IN_SET:
            plain.append(F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(e.kwargs["value_set"])).alias(f"__bad{n}"))
        if e.type == UNIQUE_PROPORTION:
            counted.append(F.count_distinct(F.col(c)).alias(f"__nd{n}"))
    return plain + counted if distinct is None else counted if distinct else plain


def run_suite(df: DataFrame, suite: list[Expectation]) -> DataFrame:
    """Evaluate a suite in one scan; one result row per expectation."""
    return _suite_rows(df.agg(*_suite_aggregates(df.columns, suite)), df.schema, suite)


class ObservedSuite:
    """A suite whose counts are taken while the batch is written elsewhere (``DataFrame.observe``).

    ``watch(df)`` gives the same rows with the counts attached; write those, then ask for ``rows`` and
    ``result``. Distinct counts cannot be observed: a suite that has some takes them from ``stored``, the batch as
    written, in one aggregate. Use an object for one write only.
    """

    def __init__(self, suite: list[Expectation]):
        self.suite, self._seen = suite, Observation()

    def watch(self, df: DataFrame, fields=None) -> DataFrame:
        """``fields(df)`` gives the columns that the suite speaks of, if they are not those of ``df``."""
        named = fields(df) if fields else df
        self.schema, self.columns = named.schema, named.columns
        aggregates = _suite_aggregates(self.columns, self.suite, distinct=False)
        if fields is None:
            return df.observe(self._seen, *aggregates)
        return fields(df, keep=True).observe(self._seen, *aggregates).select(*df.columns)

    @property
    def rows(self) -> int:
        """Rows written (waits for the write)."""
        return self._seen.get["__total"]

    def result(self, stored: DataFrame) -> DataFrame:
        """One result row per expectation, equal to ``run_suite`` on the written batch."""
        row = dict(self._seen.get)
        distinct = _suite_aggregates(self.columns, self.suite, distinct=True)
        if distinct:
            row |= stored.agg(*distinct).first().asDict()
        schema = T.StructType([T.StructField(k, T.LongType()) for k in row])
        return _suite_rows(stored.sparkSession.createDataFrame([tuple(row.values())], schema), self.schema, self.suite)


def _suite_rows(stats: DataFrame, schema: T.StructType, suite: list[Expectation]) -> DataFrame:
    """One result row per expectation from the one row of aggregates."""
    columns = schema.names
    rows = []
    total = F.col("__total")
    for n, e in enumerate(suite):
        c = e.column
        if e.type in (NOT_NULL, IN_SET, UNIQUE_PROPORTION) and c not in columns:
            unexpected, observed, elements, success = total, F.lit(None), total, F.lit(False)
        elif e.type == NOT_NULL:
            nn = F.col(f"__nn{n}")
            unexpected = total - nn
            observed = _ratio(nn, total)
            success = (total == 0) | (observed >= F.lit(float(e.kwargs.get("mostly", 1.0))))
            elements = total
        elif e.type == IN_SET:
            nn = F.col(f"__nn{n}")
            unexpected = F.col(f"__bad{n}")
            observed = _ratio(nn - unexpected, nn)
            success = (nn == 0) | (observed >= F.lit(float(e.kwargs.get("mostly", 1.0))))
            elements = total
        elif e.type == UNIQUE_PROPORTION:
            nn = F.col(f"__nn{n}")
            observed = _ratio(F.col(f"__nd{n}"), nn)
            lo, hi = e.kwargs.get("min_value"), e.kwargs.get("max_value")
            success = F.lit(True)
            if lo is not None:
                success = success & (observed >= F.lit(float(lo)))
            if hi is not None:
                success = success & (observed <= F.lit(float(hi)))
            success = F.coalesce(success, F.lit(False))
            unexpected = F.lit(None).cast("long")
            elements = total
        elif e.type == IN_TYPE_LIST:
            dt = schema[c].dataType if c in columns else None
            ok = dt is not None and bool(_type_names(dt) & set(e.kwargs["type_list"]))
            unexpected, observed, elements = F.lit(None).cast("long"), F.lit(None).cast("double"), F.lit(None)
            success = F.lit(ok)
        elif e.type == COLUMNS_MATCH_SET:
            ok = set(columns) == set(e.kwargs["column_set"])
            unexpected, observed, elements = F.lit(None).cast("long"), F.lit(None).cast("double"), F.lit(None)
            success = F.lit(ok)
        else:
            raise ValueError(f"unsupported expectation {e.type}")
        rows.append(F.struct(
            F.lit(n).alias("expectation_index"),
            F.lit(e.type).alias("expectation_type"),
            F.lit(c).cast("string").alias("column"),
            elements.cast("long").alias("element_count"),
            unexpected.cast("long").alias("unexpected_count"),
            observed.cast("double").alias("observed_value"),
            success.alias("success"),
        ))
    out = stats.select(F.explode(F.array(*rows)).alias("__r")).select("__r.*")
    return out


def gate(result: DataFrame, suite_name: str = "suite") -> DataFrame:
    """Raise ``QualityGateError`` if any expectation failed; else return the result.

    Collects at most one row per expectation (the failing ones).
    """
    failed = result.filter(~F.col("success")).select("expectation_index", "expectation_type", "column").collect()
    if failed:
        raise QualityGateError(f"{suite_name}: {len(failed)} expectation(s) failed: "
                               + ", ".join(f"#{r[0]} {r[1]}({r[2]})" for r in failed))
    return result


def store_result(result: DataFrame, root: str, suite_name: str, ds: str) -> DataFrame:
    """Write a suite's result rows under ``<root>/<suite>/ds=<ds>`` (Q9) and return them read back.

    A rerun of the day replaces its rows. Stored before the gate, so a failed day leaves its evidence.
    """
    path = f"{root.rstrip('/')}/{suite_name}/ds={ds}"
    result.coalesce(1).write.mode("overwrite").parquet(path)
    return result.sparkSession.read.schema(result.schema).parquet(path)


# ------------------------------------------------------------------ dbt tests (Q6-Q8)

def failing_nulls(df: DataFrame, column: str) -> DataFrame:
    """``not_null`` test: the failing rows."""
    return df.filter(F.col(column).isNull())


def accepted_values(df: DataFrame, column: str, values) -> DataFrame:
    """``accepted_values`` test: offending values with their counts; NULL passes."""
    return (df.filter(~F.col(column).isin(list(values)))
            .groupBy(F.col(column).alias("value_field"))
            .agg(F.count(F.lit(1)).alias("n_records")))


def failing_rows(df: DataFrame, predicate) -> DataFrame:
    """Singular test: rows matching ``predicate`` (a NULL predicate does not fail)."""
    p = F.expr(predicate) if isinstance(predicate, str) else predicate
    return df.filter(p)


def passes(test_result: DataFrame) -> bool:
    """A test passes when it returns no rows (checked without counting)."""
    return test_result.isEmpty()
