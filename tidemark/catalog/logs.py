from __future__ import annotations

from tidemark.catalog.registry import query
from tidemark.plans import logs


@query(
    "same_ip_across_months",
    """SELECT m.id, m.first_name AS first_name_may, m.last_name AS last_name_may,
              a.first_name AS first_name_april, a.last_name AS last_name_april,
              m.ip AS ip_address
       FROM v_logs_may m LEFT JOIN v_logs_april a ON a.ip = m.ip WHERE a.ip IS NOT NULL""",
)
def _(w):
    return logs.same_ip_across_months(w.logs_may, w.logs_april)
