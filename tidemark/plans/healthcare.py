"""Nurse staffing / occupancy reports.

Top / bottom lists are TakeOrdered on a unique tie-break; the daily rows of
the selected providers come from a left-semi join (never a collected list).
Division by zero beds gives NULL (pandas gives inf); NULL rates are skipped by
the mean.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import exact_sum, mean_of, safe_ratio
from tidemark.operators.ranking import rows_of_top_groups, top_k
from tidemark.plans.registry import register
from tidemark.plans.views import v_prov, v_staff

REPORT_YEAR = 2024


def state_averages(staff: DataFrame) -> DataFrame:
    """Per state plus a NATION row (the ROLLUP grand total)."""
    g = staff.rollup("state").agg(
        safe_ratio(exact_sum("total_nurse_hrs"), F.sum("mds_census"))
        .alias("total_nurse_staffing_hrs_per_resident_per_day"),
        F.grouping("state").alias("_g"))
    return g.select(F.when(F.col("_g") == 1, F.lit("NATION")).otherwise(F.col("state")).alias("state_or_nation"),
                    "total_nurse_staffing_hrs_per_resident_per_day")


def nhppd_by_state(staff):
    return (state_averages(staff).filter(F.col("state_or_nation") != "NATION")
            .orderBy(F.col("total_nurse_staffing_hrs_per_resident_per_day").desc_nulls_last(), "state_or_nation"))


def hours_by(staff, key):
    return staff.groupBy(key).agg(exact_sum("total_nurse_hrs").alias("total_nurse_hrs"))


def hours_by_month(staff):
    g = hours_by(staff, "month")
    return g.select(F.date_format(F.make_date(F.lit(REPORT_YEAR), F.col("month"), F.lit(1)), "MMMM")
                    .alias("month_name"), "month", "total_nurse_hrs").orderBy("month")


def with_date(df, month_col="month"):
    return df.withColumn("date", F.make_date(F.lit(REPORT_YEAR), F.col(month_col), F.col("day")))


def provider_staffing(staff, prov):
    """staff LEFT JOIN provider info on the name; clashing ``month`` becomes month_x / month_y."""
    s = staff.withColumnRenamed("month", "month_x")
    p = prov.withColumnRenamed("month", "month_y")
    j = s.join(p, on="provider_name", how="left")
    return j.withColumn("bed_utilization_rate",
                        safe_ratio("mds_census", "number_of_certified_beds") * 100)


def bed_util_by_provider(ps):
    return ps.groupBy("provider_name").agg(mean_of("bed_utilization_rate", 6).alias("bed_utilization_rate"))


def census_by_provider(ps):
    return ps.groupBy("provider_name").agg(F.avg("mds_census").alias("mds_census"))


def _staff(s, sf):
    return v_staff(s, sf)


def _ps(s, sf):
    return provider_staffing(v_staff(s, sf), v_prov(s, sf))


def _top(df, col, desc):
    return top_k(df, col, 10, desc=desc, tiebreak=["provider_name"])


def hours_trend(s, sf, desc):
    st = _staff(s, sf)
    top = _top(hours_by(st, "provider_name"), "total_nurse_hrs", desc)
    d = with_date(rows_of_top_groups(st, top, ["provider_name"]))
    return d.select("provider_name", "date", "state", "mds_census", "total_nurse_hrs").orderBy("provider_name", "date")


def util_trend(s, sf, desc):
    ps = _ps(s, sf)
    top = _top(bed_util_by_provider(ps), "bed_utilization_rate", desc)
    d = with_date(rows_of_top_groups(ps, top, ["provider_name"]), "month_x")
    return d.select("provider_name", "date", "bed_utilization_rate").orderBy("provider_name", "date")


def patients_trend(s, sf, desc):
    ps = _ps(s, sf)
    top = _top(census_by_provider(ps), "mds_census", desc)
    d = with_date(rows_of_top_groups(ps, top, ["provider_name"]), "month_x")
    return d.select("provider_name", "date", "mds_census").orderBy("provider_name", "date")


def staff_vs_load(staff):
    g = staff.groupBy("provider_name").agg(
        safe_ratio(exact_sum("total_nurse_hrs"), F.sum("mds_census")).alias("hours_per_resident"))
    return top_k(g, "hours_per_resident", 10, desc=False, tiebreak=["provider_name"])


def staff_occupancy_corr(ps):
    return ps.groupBy("state").agg(
        F.round(F.corr("total_nurse_hrs", "mds_census"), 6).alias("corr_hours_census"),
        F.round(F.corr("total_nurse_hrs", "bed_utilization_rate"), 6).alias("corr_hours_util"),
        F.round(F.corr("total_nurse_hrs", "score"), 6).alias("corr_hours_readmission"))


# ------------------------------------------------------------------ oracle text
VS = """v_staff AS (SELECT 'Provider ' || CAST(user_id AS VARCHAR) AS provider_name,
  'ST' || CAST(user_id % 17 AS VARCHAR) AS state, CAST(4 + event_id % 3 AS INTEGER) AS month,
  CAST(day(ts) AS INTEGER) AS day, CAST(event_id % 120 AS INTEGER) AS mds_census, value AS total_nurse_hrs
  FROM events WHERE 'Provider ' || CAST(user_id AS VARCHAR) NOT IN ('Provider 7', 'Provider 11'))"""
VP = """v_prov AS (SELECT 'Provider ' || CAST(c_custkey AS VARCHAR) AS provider_name,
  CAST(c_custkey % 150 AS INTEGER) AS number_of_certified_beds, CAST(4 + c_custkey % 3 AS INTEGER) AS month_y,
  c_acctbal AS score FROM customer)"""
VPS = """v_ps AS (SELECT s.provider_name, s.state, s.month AS month_x, s.day, s.mds_census, s.total_nurse_hrs,
  p.number_of_certified_beds, p.month_y, p.score,
  CASE WHEN p.number_of_certified_beds = 0 THEN NULL
       ELSE CAST(s.mds_census AS DOUBLE) / CAST(p.number_of_certified_beds AS DOUBLE) * 100 END AS bed_utilization_rate
  FROM v_staff s LEFT JOIN v_prov p ON s.provider_name = p.provider_name)"""
HRS = "CAST(SUM(CAST(total_nurse_hrs AS DECIMAL(28,10))) AS DOUBLE)"
RATE = ("CASE WHEN SUM(mds_census) = 0 THEN NULL ELSE "
        f"{HRS} / CAST(SUM(mds_census) AS DOUBLE) END")


def W(*p):
    return "WITH " + ", ".join(p) + "\n"


def _topsql(inner, col, desc):
    d = "DESC" if desc else "ASC"
    return (f"SELECT *, CAST(row_number() OVER (ORDER BY {col} {d} NULLS LAST, provider_name) AS INTEGER) AS rank "
            f"FROM ({inner}) QUALIFY rank <= 10")


HRS_BY_PROV = f"SELECT provider_name, {HRS} AS total_nurse_hrs FROM v_staff GROUP BY provider_name"
UTIL_BY_PROV = ("SELECT provider_name, CAST(SUM(CAST(bed_utilization_rate AS DECIMAL(18,6))) AS DOUBLE) / "
                "NULLIF(COUNT(bed_utilization_rate), 0) AS bed_utilization_rate FROM v_ps GROUP BY provider_name")
CENSUS_BY_PROV = "SELECT provider_name, AVG(mds_census) AS mds_census FROM v_ps GROUP BY provider_name"

ORACLES = {
    "hc_nhppd_state": W(VS) + f"SELECT state AS state_or_nation, {RATE} AS "
    "total_nurse_staffing_hrs_per_resident_per_day FROM v_staff GROUP BY state",
    "hc_hours_state": W(VS) + f"SELECT state, {HRS} AS total_nurse_hrs FROM v_staff GROUP BY state",
    "hc_hours_month": W(VS) + f"SELECT monthname(make_date(2024, month, 1)) AS month_name, month, {HRS} "
    "AS total_nurse_hrs FROM v_staff GROUP BY month",
    "hc_hours_provider_top": W(VS) + _topsql(HRS_BY_PROV, "total_nurse_hrs", True),
    "hc_hours_provider_bottom": W(VS) + _topsql(HRS_BY_PROV, "total_nurse_hrs", False),
    "hc_bed_util_top": W(VS, VP, VPS) + _topsql(UTIL_BY_PROV, "bed_utilization_rate", True),
    "hc_bed_util_bottom": W(VS, VP, VPS) + _topsql(UTIL_BY_PROV, "bed_utilization_rate", False),
    "hc_readmission_top": W(VP) + "SELECT provider_name, score, CAST(row_number() OVER (ORDER BY score DESC NULLS LAST, "
    "provider_name) AS INTEGER) AS rank FROM v_prov QUALIFY rank <= 10",
    "hc_staff_vs_load": W(VS) + _topsql(f"SELECT provider_name, {RATE} AS hours_per_resident FROM v_staff "
                                        "GROUP BY provider_name", "hours_per_resident", False),
    "hc_staff_occupancy_corr": W(VS, VP, VPS) + "SELECT state, ROUND(corr(total_nurse_hrs, mds_census), 6) AS "
    "corr_hours_census, ROUND(corr(total_nurse_hrs, bed_utilization_rate), 6) AS corr_hours_util, ROUND(corr(total_nurse_hrs, score), 6) AS corr_hours_readmission FROM v_ps "
    "GROUP BY state",
}
for _desc, _sfx in ((True, "top"), (False, "bottom")):
    _top_h = _topsql(HRS_BY_PROV, "total_nurse_hrs", _desc)
    ORACLES[f"hc_hours_trend_{_sfx}"] = W(VS) + (
        "SELECT provider_name, make_date(2024, month, day) AS date, state, mds_census, total_nurse_hrs "
        f"FROM v_staff WHERE provider_name IN (SELECT provider_name FROM ({_top_h}))")
    _top_u = _topsql(UTIL_BY_PROV, "bed_utilization_rate", _desc)
    ORACLES[f"hc_bed_util_trend_{_sfx}"] = W(VS, VP, VPS) + (
        "SELECT provider_name, make_date(2024, month_x, day) AS date, bed_utilization_rate FROM v_ps "
        f"WHERE provider_name IN (SELECT provider_name FROM ({_top_u}))")
    _top_c = _topsql(CENSUS_BY_PROV, "mds_census", _desc)
    ORACLES[f"hc_patients_trend_{_sfx}"] = W(VS, VP, VPS) + (
        "SELECT provider_name, make_date(2024, month_x, day) AS date, mds_census FROM v_ps "
        f"WHERE provider_name IN (SELECT provider_name FROM ({_top_c}))")
ORACLES["left_join_suffix"] = W(VS, VP, VPS) + "SELECT * FROM v_ps"

_Q = {
    "hc_nhppd_state": lambda s, sf: nhppd_by_state(_staff(s, sf)),
    "hc_hours_state": lambda s, sf: hours_by(_staff(s, sf), "state").orderBy(F.col("total_nurse_hrs").desc()),
    "hc_hours_month": lambda s, sf: hours_by_month(_staff(s, sf)),
    "hc_hours_provider_top": lambda s, sf: _top(hours_by(_staff(s, sf), "provider_name"), "total_nurse_hrs", True),
    "hc_hours_provider_bottom": lambda s, sf: _top(hours_by(_staff(s, sf), "provider_name"), "total_nurse_hrs",
                                                   False),
    "hc_hours_trend_top": lambda s, sf: hours_trend(s, sf, True),
    "hc_hours_trend_bottom": lambda s, sf: hours_trend(s, sf, False),
    "hc_bed_util_top": lambda s, sf: _top(bed_util_by_provider(_ps(s, sf)), "bed_utilization_rate", True),
    "hc_bed_util_bottom": lambda s, sf: _top(bed_util_by_provider(_ps(s, sf)), "bed_utilization_rate", False),
    "hc_bed_util_trend_top": lambda s, sf: util_trend(s, sf, True),
    "hc_bed_util_trend_bottom": lambda s, sf: util_trend(s, sf, False),
    "hc_patients_trend_top": lambda s, sf: patients_trend(s, sf, True),
    "hc_patients_trend_bottom": lambda s, sf: patients_trend(s, sf, False),
    "hc_readmission_top": lambda s, sf: top_k(v_prov(s, sf).select("provider_name", "score"), "score", 10,
                                              desc=True, tiebreak=["provider_name"]),
    "hc_staff_vs_load": lambda s, sf: staff_vs_load(_staff(s, sf)),
    "hc_staff_occupancy_corr": lambda s, sf: staff_occupancy_corr(_ps(s, sf)),
    "left_join_suffix": lambda s, sf: _ps(s, sf),
}
for _k, _f in _Q.items():
    register(_k, ORACLES[_k])(_f)
