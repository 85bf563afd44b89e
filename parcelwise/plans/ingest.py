"""Raw orders to cleaned orders, quality report, star tables and KPI views."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, functions as F

from ..operators import clean as cleaning, kpi, quality, star
from ..session import fit_partitions
from ..sources import tables, versions
from ..sources.orders_csv import Orders

MONTHLY_VIEW = "vw_monthly_risk_by_region"
DEPARTMENT_VIEW = "vw_department_kpis"
MONTHLY_STATES, PRODUCT_STATES = "kpi_monthly_risk", "kpi_product_months"
FACT, MONTH = "fact_orders", "year_month"
COPIES = "_copies"


@dataclass(frozen=True)
class Ingested:
    clean: DataFrame
    report: DataFrame
    rows_in: int
    duplicates: int
    dropped_columns: list[str]
    rejected_rows: int = 0


def kpi_states(fact: DataFrame) -> dict[str, DataFrame]:
    """What the KPI views are made of, by month: rows of one month need its facts only."""
    return {MONTHLY_STATES: kpi.monthly_risk_by_region(fact), PRODUCT_STATES: kpi.product_months(fact)}


def publish_star(clean: DataFrame, folder: str) -> None:
    """Write the five tables and the KPIs' states to the catalog, each in one step; facts and
    states in one part per month."""
    spark = clean.sparkSession
    for name, df in star.star_tables(clean).items():
        tables.publish_table(df, name, folder, [MONTH] if name == FACT else None)
    for name, df in kpi_states(versions.current(spark, FACT, folder)).items():
        tables.publish_table(df, name, folder, [MONTH], dealt=name == PRODUCT_STATES)


def refresh_star(clean: DataFrame, months: list[str | None], folder: str) -> None:
    """Bring whole months into the published tables: ``clean`` has all rows of ``months``.

    Facts and KPI states of these months are replaced, the files of other months stay as
    they are. Dimensions get the combinations they lack and are left alone if there are
    none. The tables equal those published from all rows at once. Each table changes in one
    step, and running the same months again changes nothing.
    """
    spark = clean.sparkSession
    found = star.star_tables(clean)
    fact = found.pop(FACT)
    for name, df in found.items():
        known = versions.current(spark, name, folder)
        new = df if known is None else df.subtract(known)
        if known is None or not new.isEmpty():
            versions.publish(new if known is None else known.unionByName(new), name, folder)
    versions.replace_parts(fact, FACT, folder, MONTH, months)
    wanted = F.col(MONTH).isin([m for m in months if m is not None])
    if None in months:
        wanted = wanted | F.col(MONTH).isNull()
    for name, df in kpi_states(versions.current(spark, FACT, folder).filter(wanted)).items():
        versions.replace_parts(df, name, folder, MONTH, months)


def publish_kpis(spark) -> None:
    """Define the two KPI views over the published states; again after each refresh."""
    states = tables.read_published(spark, PRODUCT_STATES)
    products = tables.read_published(spark, "dim_product")
    tables.publish_view(tables.read_published(spark, MONTHLY_STATES), MONTHLY_VIEW)
    tables.publish_view(kpi.departments_of(states, products), DEPARTMENT_VIEW)


def ingest(
    raw: DataFrame | Orders, home: str, min_rows: int = quality.MIN_ROWS
) -> Ingested:
    """Run the whole step below the shared folder ``home``. With ``read_orders`` as input, the
    rows it rejects are kept in ``home/rejected`` and counted.

    The deduplicated rows are stored once; null shares, the quality report and all
    tables are read from that copy. Failed checks are reported and stop nothing.
    Shuffle partitions are raised to the size of the raw files, and the stored copy is
    deleted at the end.
    """
    rows, rejected = (raw.rows, raw.rejected) if isinstance(raw, Orders) else (raw, None)
    fit_partitions(rows)
    refused = 0
    if rejected is not None:
        path = f"{home.rstrip('/')}/rejected"
        tables.write_parquet(rejected, path)
        refused = rows.sparkSession.read.schema(rejected.schema).parquet(path).count()
    with tables.scratch(rows.sparkSession):
        return replace(_ingest(rows, home, min_rows), rejected_rows=refused)


def _ingest(raw: DataFrame, home: str, min_rows: int) -> Ingested:
    tidied = tables.stage(cleaning.tidy_rows(raw, copies=COPIES), "tidy")
    rows_in, rows_kept = tidied.agg(
        F.coalesce(F.sum(COPIES), F.lit(0)), F.count("*")
    ).first()
    tidied = tidied.drop(COPIES)
    dropped = cleaning.sparse_columns(tidied)
    path = f"{home.rstrip('/')}/clean"
    kept = tidied.drop(*dropped)
    tables.write_clean_parquet(kept, path)
    spark = raw.sparkSession
    clean = spark.read.schema(kept.schema).parquet(path)
    publish_star(clean, f"{home.rstrip('/')}/star")
    publish_kpis(spark)
    return Ingested(
        clean=clean,
        report=quality.dq_report(clean, min_rows),
        rows_in=rows_in,
        duplicates=rows_in - rows_kept,
        dropped_columns=dropped,
    )
