from __future__ import annotations

from tidemark.catalog.registry import query
from tidemark.plans import staff as s

CHARTS = {
    "churn_by_area_course": ("area", "realizo_cursos"),
    "churn_by_level_course": ("nivel", "realizo_cursos"),
    "churn_by_area_salary": ("area", "salario_versus_competencia"),
    "churn_by_level_salary": ("nivel", "salario_versus_competencia"),
    "churn_by_area_level": ("area", "nivel"),
    "churn_by_manager_course": ("manager", "realizo_cursos"),
    "churn_by_manager_tenure": ("manager", "antiguedad"),
}


def _features(w):
    return s.churn_features(w.staff, w.salary_ranges, w.managers)


@query("churn_features", "SELECT * EXCLUDE (row_key), row_key AS \"Id\" FROM v_staff")
def _(w):
    return s.churn_features(w.staff, w.salary_ranges, w.managers, keep=("Id",))


def _register_chart(key: str, by: str, hue: str) -> None:
    sql = f"""
        SELECT c.{by}, c.{hue}, c.cases, CAST(t.cases AS BIGINT) AS total_cases
        FROM (SELECT {by}, {hue}, count(*) AS cases FROM v_staff GROUP BY ALL) c
             JOIN (SELECT {by}, count(*) AS cases FROM v_staff GROUP BY ALL) t USING ({by})
        WHERE {hue} IS NOT NULL"""

    @query(key, sql)
    def _(w):
        return s.churn_counts(_features(w), by, hue)


for _key, (_by, _hue) in CHARTS.items():
    _register_chart(_key, _by, _hue)


@query(
    "mean_tenure_by_area",
    """SELECT area, sum(antiguedad) / count(*) AS mean_days,
              (SELECT sum(antiguedad) / count(*) FROM v_staff) AS overall_mean_days
       FROM v_staff GROUP BY area""",
)
def _(w):
    return s.mean_tenure_by_area(_features(w))


@query(
    "top_managers_share",
    """SELECT CAST(sum(cases) AS BIGINT) AS top_cases,
              (SELECT count(*) FROM v_staff) AS total_cases,
              sum(cases) / (SELECT CAST(count(*) AS DOUBLE) FROM v_staff) AS share
       FROM (SELECT manager, count(*) AS cases FROM v_staff WHERE manager IS NOT NULL
             GROUP BY manager ORDER BY cases DESC, manager LIMIT 3)""",
)
def _(w):
    return s.top_managers_share(_features(w))
