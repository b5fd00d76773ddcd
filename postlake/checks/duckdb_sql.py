"""DuckDB SQL for every query in ``postlake.plans.registry.QUERIES``.

Written in the plainest form (the text-to-int rule of the native follower count
repeats its patterns; pytest checks that rule against Spark's own cast): the
questions run over the full joins with ``count(*)``, ``row_number`` and
``quantile_disc``.  The views ``orders``, ``customer``, ``nation`` and
``documents`` are the test-data tables.  Types are cast to what the Spark side
returns (``year`` -> INTEGER, counts BIGINT).
"""

from __future__ import annotations

# The placeholder texts upstream writes for missing data.
_SENTINELS = {
    "description": "No description available Story format",
    "follower_count": "User Info Error",
    "image_src": "Image src error.",
    "is_image_or_video": "multi-video(story page format)",
    "poster_name": "User Info Error",
    "tag_list": "N,o, ,T,a,g,s, ,A,v,a,i,l,a,b,l,e",
    "title": "No Title Data Available",
}

RAW_CTES = r"""
base AS (
  SELECT o_orderkey AS k, o_custkey AS ck, o_orderpriority AS cat, o_orderdate AS d, c_name, n_name
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
src AS (SELECT * FROM base UNION ALL SELECT * FROM base WHERE k % 50 = 0),
raw_posts AS (
  SELECT k AS "index", 'post-' || k AS unique_id,
    CASE WHEN k % 11 = 0 THEN 'No Title Data Available' WHEN k % 13 = 0 THEN '' ELSE 'title ' || k END AS title,
    CASE WHEN k % 7 = 0 THEN 'No description available Story format' WHEN k % 12 = 0 THEN '' ELSE 'about ' || k END AS description,
    CASE WHEN k % 17 = 0 THEN 'User Info Error' ELSE c_name END AS poster_name,
    CASE k % 10 WHEN 0 THEN 'User Info Error' WHEN 1 THEN '' WHEN 2 THEN (k % 997) || 'k'
      WHEN 3 THEN (k % 9 + 1) || 'M' WHEN 4 THEN (k % 9) || '.5k' WHEN 5 THEN 'n/a' WHEN 6 THEN NULL
      ELSE CAST(k * 37 % 100000 AS VARCHAR) END AS follower_count,
    CASE WHEN k % 19 = 0 THEN 'N,o, ,T,a,g,s, ,A,v,a,i,l,a,b,l,e' ELSE cat || ',x' END AS tag_list,
    CASE WHEN k % 23 = 0 THEN 'multi-video(story page format)' WHEN k % 2 = 0 THEN 'image' ELSE 'video' END AS is_image_or_video,
    CASE WHEN k % 29 = 0 THEN 'Image src error.' ELSE 'https://img.example.com/' || k END AS image_src,
    CAST(k % 2 AS INTEGER) AS downloaded, 'Local save in /data/' || cat AS save_location, cat AS category
  FROM src),
raw_geo AS (
  SELECT k AS ind, CASE WHEN k % 37 = 0 THEN CAST(CAST(d + INTERVAL '21' YEAR AS DATE) AS VARCHAR) || 'T22:30:00-05:00'
      ELSE CAST(d + INTERVAL '21' YEAR AS VARCHAR) END AS "timestamp",
    CAST(k * 7919 % 18001 AS DOUBLE) / 100 - 90 AS latitude,
    CAST(k * 104729 % 36001 AS DOUBLE) / 100 - 180 AS longitude, n_name AS country
  FROM src),
raw_users AS (
  SELECT k AS ind, CASE WHEN k % 31 = 0 THEN NULL ELSE substring(c_name, 1, 8) END AS first_name,
    substring(c_name, 10, 9) AS last_name,
    CAST(CASE WHEN ck % 41 = 0 THEN NULL ELSE 10 + ck % 60 END AS INTEGER) AS age,
    CASE WHEN k % 43 = 0 THEN CAST(CAST(joined AS DATE) AS VARCHAR) || 'T00:30:00+09:00'
      ELSE CAST(joined AS VARCHAR) END AS date_joined
  FROM (SELECT *, CASE k % 3 WHEN 0 THEN d + INTERVAL '17' YEAR WHEN 1 THEN d + INTERVAL '18' YEAR
      ELSE d + INTERVAL '19' YEAR END AS joined FROM src) j)"""


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _tolerant_int(x: str) -> str:
    whole = rf"regexp_extract({x}, '^\s*([+-]?[0-9]*)', 1)"
    return (rf"CASE WHEN regexp_matches({x}, '^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]*)\s*$') THEN "
            rf"CASE WHEN regexp_matches({whole}, '[0-9]') THEN TRY_CAST({whole} AS INTEGER) ELSE 0 END END")


def _expand(x: str) -> str:
    return (f"CASE WHEN suffix({x}, 'k') THEN left({x}, length({x}) - 1) || '000' "
            f"WHEN suffix({x}, 'M') THEN left({x}, length({x}) - 1) || '000000' ELSE {x} END")


def _scaled(x: str) -> str:
    number = (f"TRY_CAST(CASE WHEN suffix({x}, 'k') OR suffix({x}, 'M') THEN left({x}, length({x}) - 1) ELSE {x} END "
              "AS DECIMAL(24, 9))")
    return (f"TRY_CAST(trunc({number} * CASE WHEN suffix({x}, 'k') THEN 1000 WHEN suffix({x}, 'M') THEN 1000000 "
            "ELSE 1 END) AS INTEGER)")


def _timestamp(x: str) -> str:
    """Text to a wall clock in UTC: an offset at the end is subtracted by hand."""
    wall = f"TRY_CAST(left({x}, length({x}) - 6) AS TIMESTAMP)"
    minutes = f"CAST(left(right({x}, 5), 2) AS INTEGER) * 60 + CAST(right({x}, 2) AS INTEGER)"
    return (f"CASE WHEN regexp_matches({x}, '[+][0-9][0-9]:[0-9][0-9]$') THEN {wall} - to_minutes({minutes}) "
            f"WHEN regexp_matches({x}, 'T.*-[0-9][0-9]:[0-9][0-9]$') THEN {wall} + to_minutes({minutes}) "
            f"ELSE TRY_CAST({x} AS TIMESTAMP) END")


def _nulled(name: str) -> str:
    return f"CASE WHEN {name} IN ({_lit(_SENTINELS[name])}, '') THEN NULL ELSE {name} END"


CLEAN_CTES = RAW_CTES + f""",
clean_posts AS (
  SELECT "index" AS ind, unique_id, {_nulled('title')} AS title, {_nulled('description')} AS description,
    {_tolerant_int(_expand(_nulled('follower_count')))} AS follower_count,
    {_nulled('poster_name')} AS poster_name, {_nulled('tag_list')} AS tag_list,
    {_nulled('is_image_or_video')} AS is_image_or_video, {_nulled('image_src')} AS image_src,
    replace(save_location, 'Local save in ', '') AS save_location, category
  FROM raw_posts),
clean_geo AS (
  SELECT ind, country, [latitude, longitude] AS coordinates, {_timestamp('"timestamp"')} AS "timestamp"
  FROM raw_geo),
clean_users AS (
  SELECT ind, concat_ws(' ', first_name, last_name) AS user_name, age,
    {_timestamp('date_joined')} AS date_joined
  FROM raw_users),
banded AS (
  SELECT ind, age, CASE WHEN age BETWEEN 18 AND 24 THEN '18-24' WHEN age BETWEEN 25 AND 35 THEN '25-35'
    WHEN age BETWEEN 36 AND 50 THEN '36-50' ELSE '50+' END AS age_group, date_joined
  FROM clean_users)"""


def _with(body: str, ctes: str = CLEAN_CTES) -> str:
    return f"WITH {ctes.strip()}\n{body.strip()}"


_GP = "clean_geo g JOIN clean_posts p ON g.ind = p.ind"
_GPU = _GP + " JOIN clean_users u ON g.ind = u.ind"
_UP = "banded u JOIN clean_posts p ON u.ind = p.ind"
_YEAR_JOINED = "CAST(year(u.date_joined) AS INTEGER)"
_IN_2015_2020 = "WHERE year(u.date_joined) BETWEEN 2015 AND 2020"

_A1 = f"SELECT g.country, p.category, count(*) AS n FROM {_GP} GROUP BY g.country, p.category"
_A2 = (f"SELECT CAST(year(g.\"timestamp\") AS INTEGER) AS post_year, p.category, count(*) AS n FROM {_GP} "
       "WHERE year(g.\"timestamp\") BETWEEN 2018 AND 2022 GROUP BY 1, 2")
_A3 = f"SELECT u.age_group, p.category, count(*) AS category_count FROM {_UP} GROUP BY 1, 2"
_W1 = (f"SELECT country, user_name, follower_count FROM (SELECT g.country, u.user_name, p.follower_count, "
       f"row_number() OVER (PARTITION BY g.country ORDER BY p.follower_count DESC NULLS LAST, g.ind, u.user_name) AS rn "
       f"FROM {_GPU}) t WHERE rn = 1")


def _top(inner: str, part: str, order: str) -> str:
    return (f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {part} ORDER BY {order}) AS rn "
            f"FROM ({inner}) c) t WHERE rn = 1")


def _median(groups: str, where: str = "") -> str:
    return (f"SELECT {groups}, quantile_disc(p.follower_count, 0.5) AS median_follower_count "
            f"FROM {_UP} {where} GROUP BY ALL")


def _raw_cols(table: str) -> str:
    return _with(f"SELECT * FROM {table}", RAW_CTES)


def _follower(expr) -> str:
    return _with(f'SELECT "index" AS ind, {expr("follower_count")} AS follower_count FROM raw_posts', RAW_CTES)


ORACLE: dict[str, str] = {
    "clean_posts": _with("SELECT * FROM clean_posts"),
    "clean_geo": _with("SELECT * FROM clean_geo"),
    "clean_users": _with("SELECT * FROM clean_users"),
    "follower_count_native": _follower(lambda c: _tolerant_int(_expand(c))),
    "follower_count_scaled": _follower(_scaled),
    "follower_count_udf": _follower(lambda c: _tolerant_int(_expand(c))),
    "age_bands": _with("SELECT ind, age, age_group FROM banded"),
    "scan_csv": ("SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, "
                 "CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment FROM customer"),
    "lookup_value": "SELECT c_name FROM customer WHERE c_custkey = 7 LIMIT 1",
    "percent_encode": "SELECT doc_id, url_encode(text) AS encoded FROM documents",
    "scan_json_posts": _raw_cols("raw_posts"),
    "scan_json_geo": _raw_cols("raw_geo"),
    "scan_json_users": _raw_cols("raw_users"),
    "envelope_records": _raw_cols("raw_posts"),
    "envelope_data": _raw_cols("raw_geo"),
    "envelope_packed": _raw_cols("raw_users"),
    "json_decode_posts": _raw_cols("raw_posts"),
    "json_decode_geo": _raw_cols("raw_geo"),
    "json_decode_users": _raw_cols("raw_users"),
    "join_geo_posts": _with(f'SELECT g.ind, g.country, g."timestamp", p.category, p.follower_count FROM {_GP}'),
    "join_three_way": _with(f"SELECT g.ind, g.country, u.user_name, p.category, p.follower_count FROM {_GPU}"),
    "join_users_posts": _with("SELECT u.ind, u.user_name, u.age, u.date_joined, p.category, p.follower_count "
                              "FROM clean_users u JOIN clean_posts p ON u.ind = p.ind"),
    "category_counts_by_country": _with(_A1),
    "top_category_by_country": _with(_top(_A1, "country", "n DESC, category")),
    "posts_per_category_year": _with(_A2),
    "top_category_by_year": _with(_top(_A2, "post_year", "n DESC, category")),
    "top_user_by_country": _with(_W1),
    "top_country_by_followers": _with(_W1 + " ORDER BY follower_count DESC NULLS LAST, country LIMIT 1"),
    "category_counts_by_age_group": _with(_A3),
    "top_category_by_age_group": _with(_top(_A3, "age_group", "category_count DESC, category")),
    "median_followers_by_age_group": _with(_median("u.age_group")),
    "users_joined_by_year": _with(f"SELECT {_YEAR_JOINED} AS year_joined, count(*) AS number_users_joined "
                                  "FROM clean_users u GROUP BY 1"),
    "median_followers_by_join_year": _with(_median(f"{_YEAR_JOINED} AS year_joined")),
    "median_followers_by_age_group_year": _with(_median(f"u.age_group, {_YEAR_JOINED} AS year_joined")),
    "users_joined_2015_2020": _with(f"SELECT {_YEAR_JOINED} AS year_joined, count(*) AS number_users_joined "
                                    f"FROM clean_users u {_IN_2015_2020} GROUP BY 1"),
    "median_followers_2015_2020": _with(_median(f"{_YEAR_JOINED} AS year_joined", _IN_2015_2020)),
    "median_followers_age_2015_2020": _with(_median(f"u.age_group, {_YEAR_JOINED} AS year_joined", _IN_2015_2020)),
    "stream_posts": _with("SELECT * FROM clean_posts"),
    "stream_geo": _with("SELECT * FROM clean_geo"),
    "stream_users": _with("SELECT * FROM clean_users"),
}

ORACLE["stream_fanout"] = _with("""
SELECT 'posts' AS kind, ind, category AS label, follower_count AS number FROM clean_posts
UNION ALL SELECT 'geo', ind, country, CAST(year("timestamp") AS INTEGER) FROM clean_geo
UNION ALL SELECT 'users', ind, user_name, age FROM clean_users""")

# The exact median has a rank error of 0; the stored sketches may be off by 1 % of a group's rows.
ORACLE["median_followers_sketch"] = _with(f"""
SELECT 'age_group' AS grouping, u.age_group, CAST(NULL AS INTEGER) AS year_joined, count(p.follower_count) AS n_rows,
  true AS within_1_percent FROM {_UP} GROUP BY u.age_group
UNION ALL SELECT 'year_joined', NULL, {_YEAR_JOINED}, count(p.follower_count), true FROM {_UP} GROUP BY 3
UNION ALL SELECT 'age_group,year_joined', u.age_group, {_YEAR_JOINED}, count(p.follower_count), true FROM {_UP} GROUP BY 2, 3""")

# The SQL-text forms answer the same questions.
for _name in ("category_counts_by_country", "top_category_by_country", "posts_per_category_year",
              "top_category_by_year", "top_user_by_country", "top_country_by_followers",
              "top_category_by_age_group"):
    ORACLE[f"sql_{_name}"] = ORACLE[_name]


def _json_record(table: str, cols: list[str]) -> str:
    """One JSON object per row, NULL fields left out (as Spark's ``to_json``)."""
    fields = ", ".join(f"""CASE WHEN "{c}" IS NOT NULL THEN '"{c}":' || to_json("{c}") END""" for c in cols)
    return _with(f"SELECT '{{' || concat_ws(',', {fields}) || '}}' AS value FROM {table}", RAW_CTES)


ORACLE["records_out_posts"] = _json_record("raw_posts", [
    "index", "unique_id", "title", "description", "poster_name", "follower_count", "tag_list",
    "is_image_or_video", "image_src", "downloaded", "save_location", "category"])
ORACLE["records_out_geo"] = _json_record("raw_geo", ["ind", "timestamp", "latitude", "longitude", "country"])
ORACLE["records_out_users"] = _json_record("raw_users", ["ind", "first_name", "last_name", "age", "date_joined"])

_POST_COLUMNS = ["index", "unique_id", "title", "description", "poster_name", "follower_count", "tag_list",
                 "is_image_or_video", "image_src", "downloaded", "save_location", "category"]


def _record_cte(table: str, cols: list[str]) -> str:
    fields = ", ".join(f"""CASE WHEN "{c}" IS NOT NULL THEN '"{c}":' || to_json("{c}") END""" for c in cols)
    return f"rec AS (SELECT *, '{{' || concat_ws(',', {fields}) || '}}' AS value FROM {table})"


_DAMAGE = """CASE WHEN "index" % 47 = 0 THEN 'not_json' WHEN "index" % 53 = 0 THEN 'bad_field' WHEN "index" % 59 = 0 THEN 'empty'
  WHEN "index" % 61 = 0 THEN 'not_object' WHEN "index" % 67 = 0 THEN 'no_key' END"""
ORACLE["quarantine_good"] = _with(f"SELECT * FROM raw_posts WHERE {_DAMAGE} IS NULL", RAW_CTES)
ORACLE["quarantine_bad"] = _with(f"""
SELECT CASE reason WHEN 'not_json' THEN left(value, length(value) - 5)
    WHEN 'bad_field' THEN regexp_replace(value, '"downloaded":[0-9]+', '"downloaded":"maybe"')
    WHEN 'empty' THEN '' WHEN 'not_object' THEN '[1,2]' ELSE regexp_replace(value, '"index":[0-9]+,', '') END AS record,
  reason, CASE WHEN reason = 'bad_field' THEN 'downloaded' END AS bad_fields
FROM (SELECT *, {_DAMAGE} AS reason FROM rec) WHERE reason IS NOT NULL""",
                                 RAW_CTES + ",\n" + _record_cte("raw_posts", _POST_COLUMNS))
ORACLE["stream_quarantine_good"] = ORACLE["quarantine_good"]
ORACLE["stream_quarantine_bad"] = ORACLE["quarantine_bad"]


def _drift(topic: str, table: str, cols: list[str], added: str, field: str, found: str, retyped: str, dropped: str = "") -> str:
    """Rows of one topic: conditions for its added, retyped and dropped fields."""
    missing = "\nUNION ALL ".join(
        f"""SELECT '{topic}', '{c}', 'missing', NULL, count(*) FROM {table} WHERE "{c}" IS NULL{dropped if c == "latitude" else ""}
HAVING count(*) > 0""" for c in cols)
    name, kind, test = (added.split(":") if added else ("", "", ""))
    first = f"SELECT '{topic}' AS topic, '{name}' AS field, 'added' AS status, '{kind}' AS found, count(*) AS n FROM {table} WHERE {test}\nUNION ALL " if added else ""
    return (f"{first}SELECT '{topic}' AS topic, '{field}' AS field, 'retyped' AS status, '{found}' AS found, count(*) AS n FROM {table} WHERE {retyped}\n"
            f"UNION ALL {missing}")


ORACLE["schema_drift"] = _with("\nUNION ALL ".join([
    _drift("posts", "raw_posts", _POST_COLUMNS, 'lang:STRING:"index" % 7 = 0', "downloaded", "STRING", '"index" % 9 = 0 AND "index" % 7 <> 0'),
    _drift("geo", "raw_geo", ["ind", "timestamp", "latitude", "longitude", "country"], "", "longitude", "ARRAY",
           "ind % 5 = 0 AND ind % 8 <> 0", " OR ind % 8 = 0"),
    _drift("users", "raw_users", ["ind", "first_name", "last_name", "age", "date_joined"], "tags:OBJECT:ind % 6 = 0", "ind", "DECIMAL",
           "ind % 11 = 0 AND ind % 6 <> 0")]), RAW_CTES)

ORACLE["incremental_counts"] = _with(f"""
SELECT 'country' AS question, country AS label, category, n FROM ({_A1}) a
UNION ALL SELECT 'year', CAST(post_year AS VARCHAR), category, n FROM ({_A2}) b
UNION ALL SELECT 'age', age_group, category, category_count FROM ({_A3}) c
UNION ALL SELECT 'joined', CAST({_YEAR_JOINED} AS VARCHAR), NULL, count(*) FROM clean_users u GROUP BY 2""")
