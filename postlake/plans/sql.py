"""The SQL questions as Spark SQL text over the views ``posts``,
``countries`` and ``users`` (see :func:`postlake.sinks.register_views`).

Written as CTEs to the plans of :mod:`postlake.plans.questions` (a test counts
their exchanges and joins): every side but posts is summarised per ``ind``
before the join, so a hot key costs its post rows times its few distinct
values, and every ``row_number`` has tie-breakers.

Values are bound as named parameters, never formatted into the text, and the
library's rules are SQL functions of the session's catalogue
(:func:`register_functions`), which the optimiser inlines: plans and pushed-down
filters are those of the expressions themselves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from postlake.functions import age_group_sql


def _per_key(table: str, expr: str, name: str, where: str = "") -> str:
    cond = "ind IS NOT NULL" + (f" AND {where}" if where else "")
    return (f"SELECT ind, {expr} AS {name}, count(*) AS w FROM {table} "
            f"WHERE {cond} GROUP BY ind, {expr}")


_POSTS = "SELECT ind, category FROM posts WHERE ind IS NOT NULL"


def _year_range(column: str) -> str:
    return (f"{column} >= make_timestamp_ntz(:lo, 1, 1, 0, 0, 0) "
            f"AND {column} < make_timestamp_ntz(:hi + 1, 1, 1, 0, 0, 0)")


#: SQL functions by name: parameters, result and body.
FUNCTIONS = {"age_group": ("age INT", "STRING", age_group_sql("age"))}


def register_functions(spark: SparkSession) -> None:
    """Put the library's rules into the session's catalogue as SQL functions."""
    for name, (parameters, result, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}")


def category_counts_by_country() -> str:
    return f"""
WITH g AS ({_per_key('countries', 'country', 'country')}),
     p AS ({_POSTS})
SELECT g.country, p.category, sum(g.w) AS n
FROM g JOIN p ON g.ind = p.ind
GROUP BY g.country, p.category
ORDER BY n DESC, country, category"""


def top_category_by_country() -> str:
    return f"""
WITH counts AS ({category_counts_by_country()})
SELECT country, category, n FROM (
  SELECT *, row_number() OVER (PARTITION BY country ORDER BY n DESC, category) AS rn FROM counts) ranked
WHERE rn = 1"""


def posts_per_category_year() -> str:
    years = _per_key("countries", "year(timestamp)", "post_year", _year_range("timestamp"))
    return f"""
WITH g AS ({years}),
     p AS ({_POSTS})
SELECT g.post_year, p.category, sum(g.w) AS n
FROM g JOIN p ON g.ind = p.ind
GROUP BY g.post_year, p.category"""


def top_category_by_year() -> str:
    return f"""
WITH counts AS ({posts_per_category_year()})
SELECT post_year, category, n FROM (
  SELECT *, row_number() OVER (PARTITION BY post_year ORDER BY n DESC, category) AS rn FROM counts) ranked
WHERE rn = 1"""


def top_user_by_country() -> str:
    return """
WITH places AS (SELECT DISTINCT ind, country FROM countries WHERE ind IS NOT NULL),
     tagged AS (
       SELECT ind, follower_count, true AS has_post, false AS has_user FROM posts
       UNION ALL
       SELECT ind, CAST(NULL AS INT), false, true FROM users),
     best AS (
       SELECT ind, max(follower_count) AS follower_count FROM tagged
       WHERE ind IS NOT NULL GROUP BY ind HAVING bool_or(has_post) AND bool_or(has_user)),
     cands AS (SELECT * FROM places JOIN best USING (ind)),
     winners AS (
       SELECT country, ind, follower_count FROM (
         SELECT *, row_number() OVER (PARTITION BY country
                                      ORDER BY follower_count DESC NULLS LAST, ind) AS rn
         FROM cands) ranked
       WHERE rn = 1),
     named AS (
       SELECT w.country, u.user_name, w.follower_count,
              row_number() OVER (PARTITION BY w.country ORDER BY u.user_name) AS rn
       FROM winners w JOIN users u ON w.ind = u.ind)
SELECT country, user_name, follower_count FROM named WHERE rn = 1"""


def top_country_by_followers() -> str:
    return f"""
SELECT * FROM ({top_user_by_country()}) top
ORDER BY follower_count DESC NULLS LAST, country
LIMIT 1"""


def top_category_by_age_group() -> str:
    return f"""
WITH bands AS ({_per_key('users', 'age_group(age)', 'age_group')}),
     p AS ({_POSTS}),
     category_count AS (
       SELECT b.age_group, p.category, sum(b.w) AS category_count
       FROM bands b JOIN p ON b.ind = p.ind
       GROUP BY b.age_group, p.category)
SELECT age_group, category, category_count FROM (
  SELECT *, row_number() OVER (PARTITION BY age_group ORDER BY category_count DESC, category) AS rn
  FROM category_count) ranked
WHERE rn = 1"""


SQL_QUESTIONS = {
    "category_counts_by_country": category_counts_by_country,
    "top_category_by_country": top_category_by_country,
    "posts_per_category_year": posts_per_category_year,
    "top_category_by_year": top_category_by_year,
    "top_user_by_country": top_user_by_country,
    "top_country_by_followers": top_country_by_followers,
    "top_category_by_age_group": top_category_by_age_group,
}


#: Named parameters of a question and their defaults.
PARAMETERS = {name: {"lo": 2018, "hi": 2022} for name in ("posts_per_category_year", "top_category_by_year")}


def run_sql_question(spark: SparkSession, name: str, **params) -> DataFrame:
    """Run one question over the registered views, ``params`` bound by name."""
    known = PARAMETERS.get(name, {})
    if unknown := set(params) - set(known):
        raise TypeError(f"{name} has no parameter {sorted(unknown)}")
    register_functions(spark)
    return spark.sql(SQL_QUESTIONS[name](), args={**known, **params})
