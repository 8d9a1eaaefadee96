"""Declarative data tests: unique, not_null, accepted_values, relationships.

A test reports the number of failing records:

* ``unique``           number of distinct non-NULL values that occur more than once
* ``not_null``         number of NULL rows
* ``accepted_values``  number of non-NULL rows whose value is not in the list
* ``relationships``    number of non-NULL child values missing in the parent

Tests are fused per table: columns with a ``unique`` test are unpivoted to
``(column, value)`` pairs and counted with one ``groupBy`` (partial
aggregation map-side), and all their tests are conditional sums over those
counts; the remaining not_null / accepted_values tests of the table are
conditional sums in one global aggregate -- at most two scans and one
row-level shuffle per table, however many tests it has.

Every table is a job of its own (``run_checks`` runs several side by side): a table
whose tests cannot run does not stop the others.  Tests that need no grouping
can also be counted while a table is written (``watched`` gives the aggregates for
``observe``, ``from_watched`` reads their values), which leaves only the unique
and relationship tests to read it again.

Output schema: ``(model string, column_name string, test string, failures bigint)``;
``failures`` is NULL where a test could not run.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor, as_completed
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from vaultline.functions.keys import pack_key, unpack_key


@dataclass(frozen=True)
class Check:
    model: str
    column: str
    test: str  # unique | not_null | accepted_values | relationships
    values: tuple = ()
    to_model: str | None = None
    to_field: str | None = None


def _row(model: str, column: str, test: str, failures: Column) -> Column:
    return F.struct(
        F.lit(model).alias("model"),
        F.lit(column).alias("column_name"),
        F.lit(test).alias("test"),
        failures.cast("bigint").alias("failures"),
    )


def _failure_term(c: Check, value: Column, weight: Column) -> Column:
    if c.test == "not_null":
        return F.when(value.isNull(), weight)
    allowed = [str(x) for x in c.values]
    return F.when(value.isNotNull() & ~value.cast("string").isin(*allowed), weight)


def _column_tests(df: DataFrame, checks: Sequence[Check]) -> DataFrame | None:
    """All unique / not_null / accepted_values tests of one table.

    Columns with a ``unique`` test are unpivoted to ``(column, value-as-text)``
    pairs and counted per pair (one shuffle, partial aggregation map-side);
    their other tests are conditional sums over those counts.  Columns with
    only ``not_null`` / ``accepted_values`` tests need no value grouping: they
    are conditional sums in one global aggregate (no shuffle of rows).
    """
    col_tests = [c for c in checks if c.test in ("unique", "not_null", "accepted_values")]
    if not col_tests:
        return None
    uniq_cols = list(dict.fromkeys(c.column for c in col_tests if c.test == "unique"))
    grouped = [c for c in col_tests if c.column in uniq_cols]
    plain = [c for c in col_tests if c.column not in uniq_cols]
    parts = []
    if grouped:
        if len(uniq_cols) == 1:
            # One key column (every hub and link): group by it directly, so a
            # table bucketed by that key is checked without a shuffle.
            col = uniq_cols[0]
            counts = df.groupBy(F.col(col)).agg(F.count(F.lit(1)).alias("n")).select(
                F.lit(col).alias("c"), F.col(col).cast("string").alias("v"), "n")
        else:
            pairs = df.select(
                F.explode(F.array(*[
                    F.struct(F.lit(c).alias("c"), pack_key(F.col(c).cast("string")).alias("v"))
                    for c in uniq_cols
                ])).alias("p")
            ).select("p.c", "p.v")
            counts = pairs.groupBy("c", "v").agg(F.count(F.lit(1)).alias("n")).select(
                "c", unpack_key("v").alias("v"), "n")
        sums = []
        for i, c in enumerate(grouped):
            this = F.col("c") == c.column
            if c.test == "unique":
                term = F.when(this & F.col("v").isNotNull() & (F.col("n") > 1), F.lit(1))
            else:
                term = F.when(this, _failure_term(c, F.col("v"), F.col("n")))
            sums.append(F.sum(F.coalesce(term, F.lit(0))).alias(f"_t{i}"))
        parts.append((grouped, counts.agg(*sums)))
    if plain:
        sums = [
            F.sum(F.coalesce(_failure_term(c, F.col(c.column), F.lit(1)), F.lit(0))).alias(f"_t{i}")
            for i, c in enumerate(plain)
        ]
        parts.append((plain, df.agg(*sums)))
    out = None
    for tests, totals in parts:
        rows = F.array(*[
            _row(c.model, c.column, c.test, F.coalesce(F.col(f"_t{i}"), F.lit(0)))
            for i, c in enumerate(tests)
        ])
        part = totals.select(F.explode(rows).alias("r")).select("r.*")
        out = part if out is None else out.unionByName(part)
    return out


def _relationship_tests(
    df: DataFrame, checks: Sequence[Check], resolve: Callable[[str], DataFrame]
) -> list[DataFrame]:
    out = []
    for c in checks:
        if c.test != "relationships":
            continue
        parent = resolve(c.to_model)
        # Hash keys of both sides are compared, and moved, as their bytes.
        texts = all(isinstance(f.schema[k].dataType, StringType) for f, k in ((df, c.column), (parent, c.to_field)))
        value = pack_key if texts else F.col
        parent = parent.select(value(c.to_field).alias("_p"))
        missing = (
            df.filter(F.col(c.column).isNotNull())
            .select(value(c.column).alias("_c"))
            .join(parent, F.col("_c") == F.col("_p"), "left_anti")
        )
        out.append(
            missing.agg(F.count(F.lit(1)).alias("failures")).select(
                F.lit(c.model).alias("model"),
                F.lit(c.column).alias("column_name"),
                F.lit("relationships").alias("test"),
                F.col("failures").cast("bigint").alias("failures"),
            )
        )
    return out


REPORT = "model string, column_name string, test string, failures bigint"
Row = tuple[str, str, str, int | None]


def table_report(df: DataFrame, checks: Sequence[Check], resolve: Callable[[str], DataFrame]) -> DataFrame:
    """The report of one table's tests (lazy)."""
    parts = [p for p in (_column_tests(df, checks),) if p is not None] + _relationship_tests(df, checks, resolve)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def watched(checks: Sequence[Check]) -> dict[str, Column]:
    """Aggregates for ``observe`` that count the row-wise tests of a table."""
    return {
        f"{c.test}_{i}": F.sum(F.coalesce(_failure_term(c, F.col(c.column), F.lit(1)), F.lit(0))).cast("bigint")
        for i, c in enumerate(checks) if c.test in ("not_null", "accepted_values")
    }


def from_watched(checks: Sequence[Check], values: Mapping[str, int]) -> tuple[list[Row], list[Check]]:
    """(rows of the tests counted by ``watched``, tests still to run)."""
    rows, rest = [], []
    for i, c in enumerate(checks):
        name = f"{c.test}_{i}"
        if name in values:
            rows.append((c.model, c.column, c.test, int(values[name] or 0)))
        else:
            rest.append(c)
    return rows, rest


def reports(
    checks: Sequence[Check],
    resolve: Callable[[str], DataFrame],
    seen: Mapping[str, Mapping[str, int]] | None = None,
    workers: int = 8,
) -> Iterator[tuple[str, list[Row]]]:
    """(model, report rows) per table, as its job ends.  ``seen`` holds the
    observed values of tables written with ``watched``."""
    by_model: dict[str, list[Check]] = {}
    for c in checks:
        by_model.setdefault(c.model, []).append(c)

    def run(model: str, cs: list[Check]) -> list[Row]:
        rows, rest = from_watched(cs, (seen or {}).get(model, {}))
        if rest:
            # One row per declared test.
            df = resolve(model)
            rows += [tuple(r) for r in table_report(df, rest, resolve).collect()]
            # Spark deletes shuffle files once their plan is collected: a finished
            # table's go before the next tables have written theirs.
            df.sparkSession.sparkContext._jvm.System.gc()
        return rows

    with ThreadPoolExecutor(max_workers=max(1, min(workers, len(by_model)))) as pool:
        jobs = {pool.submit(run, m, cs): m for m, cs in by_model.items()}
        for job in as_completed(jobs):
            model = jobs[job]
            try:
                yield model, job.result()
            except Exception:
                logging.getLogger(__name__).exception("tests of %s could not run", model)
                yield model, [(c.model, c.column, c.test, None) for c in by_model[model]]


def run_checks(
    spark: SparkSession,
    checks: Sequence[Check],
    resolve: Callable[[str], DataFrame],
    tests: Sequence[str] | None = None,
    workers: int = 3,
) -> DataFrame:
    """Run ``checks`` (optionally only some test kinds), a job per table, and
    return the report in the order of declaration."""
    wanted = [c for c in checks if tests is None or c.test in tests]
    found = [r for _, rows in reports(wanted, resolve, workers=workers) for r in rows]
    place = {(c.model, c.column, c.test): i for i, c in enumerate(wanted)}
    return spark.createDataFrame(sorted(found, key=lambda r: place[r[:3]]), REPORT)
