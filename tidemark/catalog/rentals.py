from __future__ import annotations

from tidemark.catalog.registry import query
from tidemark.plans import rentals as r


def _clean(w):
    return r.car_rental_clean(w.rentals_raw, w.states_raw, excluded="S7")


@query("car_rental_clean", "SELECT * FROM v_rentals")
def _(w):
    return _clean(w)


@query(
    "eco_rentals_rated",
    """SELECT count(*) AS rentals FROM v_rentals
       WHERE rating >= 4 AND (fueltype = 'hybrid' OR fueltype = 'electric')""",
)
def _(w):
    return r.eco_rentals_rated(_clean(w))


@query(
    "bottom5_states",
    """SELECT state_name, count(*) AS rentals FROM v_rentals
       GROUP BY state_name ORDER BY rentals, state_name LIMIT 5""",
)
def _(w):
    return r.bottom_states(_clean(w))


@query(
    "top10_models",
    """SELECT make, model, count(*) AS rentals FROM v_rentals
       GROUP BY make, model ORDER BY rentals DESC, make, model LIMIT 10""",
)
def _(w):
    return r.top_models(_clean(w))


@query(
    "rentals_by_year",
    """SELECT year, count(*) AS rentals FROM v_rentals
       WHERE year >= 2010 AND year <= 2015 GROUP BY year""",
)
def _(w):
    return r.rentals_by_year(_clean(w))


@query(
    "top_eco_cities",
    """SELECT city, count(*) AS rentals FROM v_rentals
       WHERE fueltype IN ('electric', 'hybrid')
       GROUP BY city ORDER BY rentals DESC, city LIMIT 5""",
)
def _(w):
    return r.top_eco_cities(_clean(w))


@query(
    "reviews_by_fuel",
    """SELECT fueltype, CAST(sum(reviewcount) AS DOUBLE) / count(reviewcount) AS average,
              CAST(sum(reviewcount) AS BIGINT) AS total
       FROM v_rentals GROUP BY fueltype""",
)
def _(w):
    return r.reviews_by_fuel(_clean(w))
