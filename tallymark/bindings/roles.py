"""Inputs for the operators, derived from the test tables.

Plain SQL that Spark and the checking engine both read; ``<name>`` is a table or
another role. Nulls, empty strings, zero totals and mixed case are made from keys,
since the tables have none.
"""

ROLES = {
    # school feature rows, one per customer
    "golden": """
        SELECT c_custkey AS school_id,
               CASE WHEN c_custkey % 3 = 0 THEN lower(c_name) ELSE c_name END AS school_name,
               CAST(c_custkey AS STRING) AS ncessch,
               CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_acctbal / 110e0 + 9e0 END AS math_high_pct,
               CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_acctbal / 120e0 + 9e0 END AS math_low_pct,
               CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE CAST(c_custkey * 3 % 40 AS DOUBLE) / 4e0 END AS pct_hhi_150k_200k,
               CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE CAST(c_custkey * 7 % 90 AS DOUBLE) / 8e0 END AS pct_hhi_220k_plus,
               CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 29 = 0 THEN 0e0
                    ELSE CAST(c_custkey % 55 + 1 AS DOUBLE) END AS teachers_fte,
               CAST(c_custkey * 31 % 1500 + 20 AS DOUBLE) AS enrollment,
               CAST(c_custkey * 13 % 400 AS INT) AS grade_eight_enrollment,
               CAST(c_custkey * 17 % 300 AS INT) AS math_counts,
               CAST(c_custkey * 19 % 300 AS INT) AS read_counts,
               CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE CAST(c_custkey * 17 % 1000 AS DOUBLE) / 10e0 END AS read_high_pct,
               CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE CAST(c_custkey * 11 % 160 AS DOUBLE) / 8e0 + 1e0 END AS avg_natwalkind,
               CAST(c_custkey * 5 % 900 AS INT) AS total_10_14,
               CAST(c_custkey % 9 AS INT) AS schools_in_zip,
               c_mktsegment AS school_type
        FROM <customer>""",
    # school feature rows with every column a model is trained on
    "features": """
        SELECT *, CASE WHEN school_id % 31 = 0 THEN NULL ELSE CAST(school_id * 23 % 900 AS DOUBLE) / 11e0 END AS read_low_pct,
               CAST(school_id * 5 % 330 AS DOUBLE) / 16e0 AS pct_10_14, CAST(school_id * 37 % 9000 + 100 AS DOUBLE) AS total_pop,
               CASE WHEN school_id % 37 = 0 THEN NULL ELSE CAST(school_id * 41 % 700 AS DOUBLE) END AS hhi_150k_200k,
               CAST(school_id * 43 % 800 AS DOUBLE) AS hhi_220k_plus, CAST(school_id % 3 + 1 AS INT) AS dupe_rank
        FROM <golden>""",
    # directory entries: several per school name and year, all text
    "directory": """
        SELECT CASE WHEN o_orderkey % 2 = 0 THEN upper(c_name) ELSE c_name END AS school_name,
               CAST(o_orderkey AS STRING) AS ncessch,
               CASE WHEN o_custkey % 37 = 0 THEN '' WHEN o_custkey % 41 = 0 THEN NULL ELSE n_name END AS state_location,
               CASE WHEN o_custkey % 31 = 0 THEN '' ELSE CAST(c_nationkey * 100 + o_custkey % 5 AS STRING) END AS county_code,
               lpad(CAST(o_custkey % 997 AS STRING), 5, '0') AS zip_location,
               concat('City ', CAST(o_custkey % 50 AS STRING)) AS city_location,
               CASE WHEN o_orderkey % 43 = 0 THEN '' WHEN o_orderkey % 47 = 0 THEN 'n/a'
                    ELSE CAST(CAST(o_custkey * 37 % 1440 AS DOUBLE) / 8e0 - 90e0 AS STRING) END AS latitude,
               CASE WHEN o_orderkey % 53 = 0 THEN '200.5'
                    ELSE CAST(CAST(o_custkey * 91 % 2880 AS DOUBLE) / 8e0 - 180e0 AS STRING) END AS longitude,
               CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(year(o_orderdate) AS STRING) END AS year_json,
               o_orderstatus AS school_status,
               c_mktsegment AS school_type,
               CASE WHEN o_orderkey % 10 = 0 THEN '' ELSE CAST(o_orderkey * 31 % 1500 AS STRING) END AS enrollment,
               CASE WHEN o_orderkey % 12 = 0 THEN NULL ELSE CAST(CAST(o_orderkey % 400 AS DOUBLE) / 8e0 AS STRING) END AS teachers_fte
        FROM <orders> JOIN <customer> ON o_custkey = c_custkey JOIN <nation> ON c_nationkey = n_nationkey""",
    # typed assessment results, one per line item
    "scores": """
        SELECT l_orderkey, l_linenumber, CAST(year(o_orderdate) AS INT) AS year,
               CASE WHEN l_orderkey % 50 = 0 THEN NULL ELSE o_orderpriority END AS race,
               l_returnflag AS sex,
               CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_quantity END AS math_prof_mid,
               CASE WHEN l_orderkey % 9 = 0 THEN NULL ELSE l_extendedprice / 1024e0 END AS read_prof_mid,
               l_quantity + 5e0 AS math_prof_high, l_quantity - 5e0 AS math_prof_low,
               l_extendedprice * 0.00097123e0 + 5e0 AS read_prof_high, l_extendedprice * 0.00097123e0 - 5e0 AS read_prof_low,
               CASE WHEN l_orderkey % 8 = 0 THEN NULL ELSE CAST(l_linenumber * 10 AS BIGINT) END AS math_valid,
               CAST(l_suppkey % 90 AS BIGINT) AS read_valid
        FROM <lineitem> JOIN <orders> ON l_orderkey = o_orderkey""",
    # assessment results as text, the way they are landed
    "scores_text": """
        SELECT concat('LEA ', CAST(l_suppkey AS STRING)) AS lea_name,
               CAST(l_orderkey AS STRING) AS ncessch, CAST(l_linenumber AS STRING) AS line,
               CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE CAST(year(l_shipdate) AS STRING) END AS year_json,
               l_linestatus AS econ_disadvantaged, l_returnflag AS race, l_linestatus AS sex,
               CAST(l_linenumber AS STRING) AS math_test_num_valid,
               CAST(l_quantity AS STRING) AS math_test_pct_prof_high,
               CASE WHEN l_orderkey % 3 = 0 THEN 'PS' ELSE CAST(l_quantity - 2e0 AS STRING) END AS math_test_pct_prof_low,
               CAST(l_quantity - 1e0 AS STRING) AS math_test_pct_prof_midpt,
               CAST(l_linenumber + 3 AS STRING) AS read_test_num_valid,
               CAST(l_discount AS STRING) AS read_test_pct_prof_high,
               CASE WHEN l_orderkey % 5 = 0 THEN '' ELSE CAST(l_tax AS STRING) END AS read_test_pct_prof_low,
               CAST(l_tax AS STRING) AS read_test_pct_prof_midpt
        FROM <lineitem>""",
    # census counts per zip code
    "census": """
        SELECT reverse(lpad(CAST(p_partkey AS STRING), 9, '0')) AS zip_code, CAST(2021 AS INT) AS year,
               CASE WHEN p_partkey % 20 = 0 THEN 0 ELSE CAST(floor(p_retailprice) AS INT) * 7 + p_size END AS total_pop,
               CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE CAST(p_partkey * 13 % 120 AS INT) END AS hhi_150k_200k,
               CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE CAST(p_partkey * 29 % 200 AS INT) END AS hhi_220k_plus,
               CASE WHEN p_partkey % 15 = 0 THEN 0 ELSE p_size * 3 END AS males_10_14,
               CASE WHEN p_partkey % 15 = 0 THEN 0 ELSE p_size * 2 + 10 END AS females_10_14,
               CASE WHEN p_partkey % 15 = 0 THEN 0 WHEN p_partkey % 4 = 0 THEN NULL ELSE p_size END AS white_males_10_14,
               CASE WHEN p_partkey % 15 = 0 THEN 0 ELSE CAST(p_size - p_size % 3 AS INT) END AS black_males_10_14,
               CASE WHEN p_partkey % 15 = 0 THEN 0 ELSE CAST(p_size % 7 AS INT) END AS hispanic_males_10_14,
               CASE WHEN p_partkey % 15 = 0 THEN 0 ELSE p_size END AS white_females_10_14,
               CASE WHEN p_partkey % 15 = 0 THEN 0 ELSE CAST(p_size % 5 AS INT) END AS black_females_10_14,
               CASE WHEN p_partkey % 15 = 0 THEN 0 WHEN p_partkey % 5 = 0 THEN NULL ELSE CAST(p_size % 11 AS INT) END AS hispanic_females_10_14,
               p_type AS data_source
        FROM <part>""",
    # census rows under their source codes
    "census_coded": """
        SELECT concat('ZCTA5 ', CAST(p_partkey + 10000 AS STRING)) AS label,
               CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE CAST(floor(p_retailprice) AS INT) END AS B01003_001E,
               CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE CAST(p_size AS INT) END AS B19001_016E,
               CAST(p_size * 2 AS INT) AS B19001_017E
        FROM <part>""",
    # raw JSON records per endpoint
    "raw": """
        SELECT event_id, event_type AS endpoint, CAST(2020 + event_id % 3 AS INT) AS year,
               concat('{"user":', CAST(user_id AS STRING), ',"score":', CAST(value AS STRING),
                      ',"year":', CAST(2020 + event_id % 3 AS STRING),
                      ',"a-b":"x', CAST(event_id % 5 AS STRING), '","a_b":', CAST(user_id % 7 AS STRING),
                      CASE WHEN event_id % 4 = 0 THEN ',"note":null'
                           WHEN event_id % 4 = 1 THEN ',"note":{"k":1,"deep":[1,2]}' ELSE '' END, '}') AS data_json
        FROM <events>""",
    # usage log: authorize and record rows
    "usage_log": """
        SELECT event_id, ts, CAST(CAST(ts AS DATE) AS STRING) AS day, user_id AS session_id,
               CASE WHEN event_id % 2 = 0 THEN 'authorize' ELSE 'record' END AS kind,
               CAST(floor(value * 10e0) AS BIGINT) AS tokens,
               CAST(floor(value * 10e0) * 3e0 / 1000000e0 AS DECIMAL(18, 6)) AS cost_usd
        FROM <events>""",
    # points on an exact grid of eighths
    "points": """
        SELECT c_custkey AS point_id, CAST(c_custkey * 91 % 2880 AS DOUBLE) / 8e0 - 180e0 AS longitude,
               CAST(c_custkey * 37 % 1440 AS DOUBLE) / 8e0 - 90e0 AS latitude
        FROM <customer>""",
    # corner of each nation's box
    "corners": """
        SELECT n_nationkey, n_name, CAST(-180 + (n_nationkey % 5) * 72 AS INT) AS x,
               CAST(-90 + ((n_nationkey - n_nationkey % 5) * 36) / 5 AS INT) AS y
        FROM <nation>""",
    # a box with a hole per nation
    "state_shapes": """
        SELECT n_name AS name, lpad(CAST(n_nationkey AS STRING), 2, '0') AS state_fips,
               lpad(CAST(n_nationkey AS STRING), 2, '0') AS geoid,
               concat('POLYGON ((', x, ' ', y, ', ', x + 70, ' ', y, ', ', x + 70, ' ', y + 36, ', ', x, ' ', y + 36,
                      ', ', x, ' ', y, '), (', x + 10, ' ', y + 5, ', ', x + 20, ' ', y + 5, ', ', x + 20, ' ', y + 15,
                      ', ', x + 10, ' ', y + 15, ', ', x + 10, ' ', y + 5, '))') AS geometry
        FROM <corners>""",
    # two separate boxes per nation
    "county_shapes": """
        SELECT concat('County ', n_nationkey) AS name, lpad(CAST(n_nationkey AS STRING), 2, '0') AS state_fips,
               lpad(CAST(n_nationkey * 3 AS STRING), 3, '0') AS county_fips,
               lpad(CAST(n_nationkey * 1000 + n_nationkey * 3 AS STRING), 5, '0') AS geoid,
               concat('MULTIPOLYGON (((', x, ' ', y, ', ', x + 20, ' ', y, ', ', x + 20, ' ', y + 30, ', ', x, ' ', y + 30,
                      ', ', x, ' ', y, ')), ((', x + 30, ' ', y, ', ', x + 60, ' ', y, ', ', x + 60, ' ', y + 20,
                      ', ', x + 30, ' ', y + 20, ', ', x + 30, ' ', y, ')))') AS geometry
        FROM <corners>""",
    # a triangle per supplier; they overlap
    "zip_corners": """
        SELECT s_suppkey, CAST(s_suppkey * 53 % 340 - 180 AS INT) AS x, CAST(s_suppkey * 29 % 160 - 90 AS INT) AS y,
               CAST(4 + s_suppkey % 7 AS INT) AS w
        FROM <supplier>""",
    "zip_shapes": """
        SELECT lpad(CAST(s_suppkey AS STRING), 9, '0') AS geoid,
               concat('POLYGON ((', x, ' ', y, ', ', x + w, ' ', y, ', ', x, ' ', y + w, ', ', x, ' ', y, '))') AS geometry
        FROM <zip_corners>""",
}
