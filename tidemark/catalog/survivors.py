from __future__ import annotations

from tidemark.catalog.registry import query
from tidemark.plans import survivors as s


@query(
    "titanic_clean",
    """SELECT passenger_id AS "PassengerId", survived AS "Survived", pclass AS "Pclass",
              name AS "Name", sex AS "Sex", age AS "Age", ticket AS "Ticket", fare AS "Fare",
              cabin AS "Cabin", embarked AS "Embarked",
              CAST(CASE WHEN sex = 'female'
                   THEN (SELECT avg(exact_age) FROM v_passengers WHERE sex = 'female')
                   ELSE (SELECT avg(exact_age) FROM v_passengers WHERE sex = 'male') END
                   AS FLOAT) AS avg_age_by_gender
       FROM v_passengers""",
)
def _(w):
    return s.titanic_clean(w.passengers)


@query(
    "survivors_by_sex",
    """SELECT sex AS "Sex", count(*) AS survivors FROM v_passengers
       WHERE survived = 1 GROUP BY sex""",
)
def _(w):
    return s.survivors_by(s.titanic_clean(w.passengers), "Sex")


@query(
    "survivors_by_class",
    """SELECT pclass AS "Pclass", count(*) AS survivors FROM v_passengers
       WHERE survived = 1 GROUP BY pclass""",
)
def _(w):
    return s.survivors_by(s.titanic_clean(w.passengers), "Pclass")


@query(
    "oldest_survivor",
    """SELECT passenger_id AS "PassengerId", survived AS "Survived", age AS "Age"
       FROM v_passengers WHERE survived = 1 ORDER BY age DESC NULLS LAST, passenger_id LIMIT 1""",
)
def _(w):
    return s.oldest_survivor(s.titanic_clean(w.passengers))


@query(
    "youngest_survivors",
    """SELECT passenger_id AS "PassengerId", survived AS "Survived", age AS "Age"
       FROM v_passengers WHERE survived = 1 AND age IS NOT NULL""",
)
def _(w):
    return s.youngest_survivors(s.titanic_clean(w.passengers))
