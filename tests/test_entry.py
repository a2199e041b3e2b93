"""Driver contract and a DuckDB oracle sample on the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF0

TABLES = "region nation customer supplier part orders lineitem events pages".split()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "customer_lifetime_value" in df.columns


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def _norm(v):
    if isinstance(v, float):
        return round(v, 9)
    if v is not None and type(v).__name__ == "Decimal":
        return round(float(v), 9)
    return v.isoformat() if hasattr(v, "isoformat") else v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


SAMPLE = ["rev_by_churn", "clv_segment", "rfm_status", "price_deciles", "loc_gap_bottom", "rpt_sales_temp_year",
          "rpt_markdown_year_store", "hc_bed_util_trend_bottom", "cost_per_booking", "lead_owner_enrich",
          "unwrap_envelope", "scd2_snapshot", "upsert_partial", "csv_null_tokens"]


@pytest.mark.parametrize("key", SAMPLE)
def test_oracle_sample(spark, key):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0}/{t}.parquet')")
    sdf = E.queries()[key](spark, SF0)
    res = con.execute(E.oracle_sql()[key])
    dcols = [d[0].lower() for d in res.description]
    assert sorted(c.lower() for c in sdf.columns) == sorted(dcols)
    assert _rows([c.lower() for c in sdf.columns], [tuple(r) for r in sdf.collect()]) == _rows(dcols, res.fetchall())
