"""The queries again as SQL over the same tables."""

from __future__ import annotations

import re

from tidewatch import constants as K
from workload import views as V

D_ASOF, D_LAST, D_FIRST = (f"DATE '{d}'" for d in (V.AS_OF, V.LAST, V.FIRST))


def quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def case_map(col: str, mapping, default: str | None = None) -> str:
    whens = " ".join(
        f"WHEN {quoted([k])} THEN {quoted([v])}" for k, v in mapping.items())
    return f"CASE {col} {whens} ELSE {default or col} END"


def yearweek(day: str) -> str:
    return f"strftime({day}, '%G-W%V')"


def week(day: str) -> str:
    return f"CAST(date_trunc('week', {day}) AS DATE)"


def key_of(name: str) -> str:
    return f"""translate(lower({name}), ' .,''’`-()&/*', '')"""


def title(name: str) -> str:
    keep = quoted(K.LOWERCASE_WORDS)
    return (f"array_to_string(list_transform(string_split({name}, ' '), lambda w: "
            f"CASE WHEN w IN ({keep}) THEN w ELSE upper(w[1:1]) || lower(w[2:]) END), ' ')")


def capital(name: str) -> str:
    return f"(upper({name}[1:1]) || {name}[2:])"


def titlecased(name: str) -> str:
    fixed = case_map(title(name), K.COUNTRY_FIXES_TITLECASED)
    return f"CASE WHEN {name} ILIKE '%usa%' THEN 'United States' ELSE {fixed} END"


def plain(name: str) -> str:
    after = case_map(capital(name), K.COUNTRY_FIXES_AFTER_CAPITAL)
    return (f"CASE WHEN {name} IN ('USA', 'Usa') THEN 'United States' ELSE {after} END")


ACC = "concat_ws('-', l_orderkey, l_linenumber, l_partkey)"
CODE = "'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0')"
RAW = f"([{quoted(V.SPELLINGS)}])[n_nationkey + 1]"
BRAND_MATCH = ("(pango_lineage IN ('Brand#1','Brand#3','Brand#4','Brand#5','Brand#7') "
               "OR starts_with(pango_lineage, 'Brand#2'))")
GAP = "NULLIF({b}, 0)"


def div(a: str, b: str) -> str:
    return f"(({a}) / NULLIF(CAST({b} AS DOUBLE), 0))"


def half_up(x: str, n: int) -> str:
    """Round the decimal value of a double, halves away from zero."""
    return f"CAST(round(CAST({x} AS DECIMAL(30, 9)), {n}) AS DOUBLE)"


def threshold(n: str) -> str:
    return f"(CASE WHEN {n} = 0 THEN 100.0 ELSE 100.0 * (1.0 - pow(1.0 - 0.95, 1.0 / {n})) END)"


VIEWS = {
    "nations": f"""
        SELECT n_nationkey, n_name AS country, r_name AS region, {CODE} AS code
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "order_places": """
        SELECT o_orderkey, CAST(o_orderdate AS DATE) AS collection_date, o_totalprice,
               n_nationkey, country, region, code, c_mktsegment AS division
        FROM orders JOIN customer ON o_custkey = c_custkey
        JOIN nations ON c_nationkey = n_nationkey""",
    "line_list": f"""
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {ACC} AS accession_id,
               CAST(l_shipdate AS DATE) AS submission_date, p_brand AS pango_lineage,
               order_places.*
        FROM lineitem JOIN order_places ON l_orderkey = o_orderkey
        JOIN part ON l_partkey = p_partkey""",
    "clean_list": """
        SELECT accession_id, country, region, collection_date AS collect_date,
               submission_date AS submit_date, pango_lineage,
               submission_date - collection_date AS lag_days
        FROM line_list""",
    "metadata": f"""
        SELECT 'hCoV-19/' || accession_id AS virus_name, accession_id,
               CASE WHEN l_linenumber = 7 THEN left(CAST(collection_date AS VARCHAR), 7)
                    ELSE CAST(collection_date AS VARCHAR) END AS collected,
               region || ' / ' || {RAW} ||
               CASE WHEN l_linenumber = 6 THEN '' ELSE ' / ' || division END AS location,
               CAST(submission_date AS VARCHAR) AS submitted,
               CAST(floor(price) AS BIGINT) AS len,
               CASE WHEN tax <> 0.08 THEN tax END AS n_content,
               CASE WHEN disc <> 0.1 THEN disc * 4 END AS gc,
               CASE WHEN status = 'F' THEN 'Human' ELSE 'Other' END AS host,
               pango_lineage
        FROM (SELECT lineitem.l_linenumber, {ACC} AS accession_id, l_extendedprice AS price,
                     l_tax AS tax, l_discount AS disc, l_linestatus AS status,
                     CAST(l_shipdate AS DATE) AS submission_date, p_brand AS pango_lineage,
                     order_places.*
              FROM lineitem JOIN order_places ON l_orderkey = o_orderkey
              JOIN part ON l_partkey = p_partkey)""",
    "exclusion_list": f"""
        SELECT DISTINCT 'hCoV-19/' || {ACC} AS name FROM lineitem
        WHERE l_returnflag = 'R' AND l_linenumber <= 3""",
    "flagged": """
        SELECT m.*, x.name IS NOT NULL AS excluded,
               NOT coalesce(length(collected) = 10 AND collected > '1996-01-01'
                            AND collected <= '2001-08-02', false) AS abnormal_date,
               NOT coalesce(length(collected) = 10 AND collected >= '1996-01-01'
                            AND collected <= '2001-08-02', false) AS abnormal_date_inclusive,
               NOT coalesce(len > 20000 AND (n_content < 0.02 OR n_content IS NULL)
                            AND host = 'Human', false) AS suspect_sequence,
               NOT coalesce(gc > 0.25 AND gc < 0.4, false) AS abnormal_gc_content
        FROM metadata m LEFT JOIN exclusion_list x ON m.virus_name = x.name""",
    "clean_full": f"""
        SELECT collected AS collection_date_text, accession_id, pango_lineage,
               location AS location_text, trim(split_part(location, '/', 1)) AS region,
               {titlecased("trim(split_part(location, '/', 2))")} AS country,
               trim(split_part(location, '/', 3)) AS division, collect_date, submit_date,
               submit_date - collect_date AS lag_days,
               {yearweek('collect_date')} AS collect_yearweek,
               {week('collect_date')} AS collect_weekstartdate,
               {yearweek('submit_date')} AS submit_yearweek,
               {week('submit_date')} AS submit_weekstartdate,
               excluded, abnormal_date, suspect_sequence, abnormal_gc_content,
               excluded OR abnormal_date OR suspect_sequence OR abnormal_gc_content
                 AS any_abnormal
        FROM (SELECT *, CAST(CASE WHEN length(collected) = 7 THEN collected || '-01'
                             ELSE collected END AS DATE) AS collect_date,
                     CAST(submitted AS DATE) AS submit_date FROM flagged)""",
    "name_codes": f"""
        SELECT name_key, min(code) AS code FROM (
          SELECT {key_of('name')} AS name_key, code FROM (VALUES
            {", ".join(f"({quoted([k])}, {quoted([v])})" for k, v in
                       K.LINE_LIST_CODE_OVERRIDES.items())}, ('Denmark', 'DNK')) o(name, code)
          UNION ALL
          SELECT {key_of('name')}, code FROM (
            SELECT {plain(RAW)} AS name, upper(left({plain(RAW)}, 3)) AS code FROM nation)
          WHERE name NOT IN ('Kosovo', 'Timor', 'Denmark'))
        GROUP BY name_key""",
    "written_names": f"""
        SELECT n_nationkey, p.name, p.code, p.english FROM nation JOIN (VALUES
          (0, 'United States of America', 'USA', 'United States'), (1, 'Puerto Rico', 'PRI', 'Puerto Rico'),
          (2, 'U.S. Virgin Islands', 'VIR', 'U.S. Virgin Islands'), (3, 'Czechia', 'CZE', 'Czechia'),
          (4, 'Antigua & Barbuda', 'ATG', 'Antigua & Barbuda'), (5, 'Dem. Rep. Congo', 'COD', 'Congo - Kinshasa'),
          (6, 'Congo (Brazzaville)', 'COG', 'Congo - Brazzaville'), (7, 'Faeroe Islands', 'FRO', 'Faroe Islands'),
          (8, 'Guinea Bissau', 'GNB', 'Guinea-Bissau'), (9, 'Niger', 'NER', 'Niger'),
          (10, 'Bosnia', 'BIH', 'Bosnia & Herzegovina'), (11, 'UK', 'GBR', 'United Kingdom'),
          (12, 'Bahamas, The', 'BHS', 'Bahamas'), (13, 'Côte d’Ivoire', 'CIV', 'Côte d’Ivoire'),
          (14, 'Republic of Korea', 'KOR', 'South Korea'), (15, 'Iran (Islamic Republic of)', 'IRN', 'Iran'),
          (16, 'Laos', 'LAO', 'Laos'), (17, 'Syria', 'SYR', 'Syria'), (18, 'Russian Federation', 'RUS', 'Russia'),
          (19, 'Cape Verde', 'CPV', 'Cape Verde'), (20, 'Burma', 'MMR', 'Myanmar (Burma)'),
          (21, 'Swaziland', 'SWZ', 'Eswatini'), (22, 'Macedonia', 'MKD', 'North Macedonia'),
          (23, 'Réunion (France)', 'REU', 'Réunion'), (24, 'Nowhere Land', NULL, NULL)) p(k, name, code, english)
        ON n_nationkey = k""",
    "populations": """
        SELECT c_nationkey, CAST(count(*) * 1000 AS DOUBLE) AS population
        FROM customer GROUP BY 1""",
    "case_daily": """
        SELECT n_nationkey, country, code, region, collection_date AS date, count(*) AS n,
               CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) AS BIGINT) AS vax,
               CAST(sum(CAST(floor(o_totalprice / 2) AS BIGINT)) AS BIGINT) AS full_vax
        FROM order_places GROUP BY ALL""",
    "case_rows": f"""
        SELECT date, country AS location, code AS iso_code, region AS continent, population,
               n, vax, full_vax
        FROM case_daily JOIN populations ON n_nationkey = c_nationkey
        UNION ALL
        SELECT date, region, {case_map('region', V.REGION_CODES)}, NULL, 5000000.0,
               sum(n), sum(vax), sum(full_vax) FROM case_daily GROUP BY date, region
        UNION ALL
        SELECT date, 'World', 'OWID_WRL', NULL, 5000000.0, sum(n), sum(vax), sum(full_vax)
        FROM case_daily GROUP BY date""",
    "case_cum": """
        SELECT *, CAST(sum(n) OVER w AS BIGINT) AS total, sum(vax) OVER w AS cv,
               sum(full_vax) OVER w AS cf, dayofyear(date) % 7 <> 0 AS seen
        FROM case_rows WINDOW w AS (PARTITION BY iso_code ORDER BY date)""",
    "cases": f"""
        SELECT iso_code, continent, location, date, CAST(total AS DOUBLE) AS total_cases,
               CAST(n AS DOUBLE) AS new_cases,
               round(CAST(n AS DOUBLE) / 7, 3) AS new_cases_smoothed,
               CAST(floor(total / 50) AS DOUBLE) AS total_deaths,
               CAST(n % 3 AS DOUBLE) AS new_deaths, population,
               CASE WHEN seen THEN CAST(cv AS DOUBLE) END AS people_vaccinated,
               CASE WHEN seen THEN CAST(cf AS DOUBLE) END AS people_fully_vaccinated,
               CASE WHEN seen THEN {half_up('CAST(cv AS DOUBLE) / (population / 100)', 2)} END
                 AS people_vaccinated_per_hundred,
               CASE WHEN seen THEN {half_up('CAST(cf AS DOUBLE) / (population / 100)', 2)} END
                 AS people_fully_vaccinated_per_hundred
        FROM case_cum""",
    "case_filled": """
        SELECT *, row_number() OVER w AS rn,
               coalesce(last_value(people_vaccinated IGNORE NULLS) OVER w, 0) AS f1,
               coalesce(last_value(people_fully_vaccinated IGNORE NULLS) OVER w, 0) AS f2
        FROM cases WINDOW w AS (PARTITION BY iso_code ORDER BY date
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "case_loaded": """
        SELECT date, location, iso_code, continent, new_cases, new_cases_smoothed, population,
               people_vaccinated, people_fully_vaccinated,
               f1 - lag(f1) OVER w AS new_people_vaccinated,
               f2 - lag(f2) OVER w AS new_people_fully_vaccinated
        FROM case_filled WHERE NOT starts_with(iso_code, 'OWID')
        WINDOW w AS (PARTITION BY iso_code ORDER BY date)""",
    "who": """
        SELECT country AS entity, region AS who_region FROM nations WHERE n_nationkey < 24""",
    "calendar": f"""
        SELECT CAST(unnest(generate_series({D_FIRST}, {D_LAST}, INTERVAL 1 DAY)) AS DATE)
          AS date""",
    "family_counts": """
        SELECT code, collection_date, count(*) AS n_new_sequences,
               count(*) FILTER (pango_lineage = 'Brand#1') AS fam_1,
               count(*) FILTER (contains(pango_lineage, 'Brand#2')) AS fam_2,
               count(*) FILTER (contains(pango_lineage, 'Brand#4')
                                OR contains(pango_lineage, 'Brand#5')) AS fam_4_5
        FROM line_list GROUP BY 1, 2""",
    "merged": """
        SELECT k.code AS country_code, calendar.date, location, continent,
               coalesce(new_cases, 0) AS new_cases,
               coalesce(new_cases_smoothed, 0) AS new_cases_smoothed, population,
               people_vaccinated, people_fully_vaccinated,
               coalesce(n_new_sequences, 0) AS n_new_sequences,
               coalesce(fam_1, 0) AS fam_1, coalesce(fam_2, 0) AS fam_2,
               coalesce(fam_4_5, 0) AS fam_4_5,
               coalesce(n_new_sequences - fam_1 - fam_2 - fam_4_5, 0) AS other
        FROM (SELECT DISTINCT code FROM order_places) k CROSS JOIN calendar
        LEFT JOIN cases c ON c.iso_code = k.code AND c.date = calendar.date
        LEFT JOIN family_counts f ON f.code = k.code AND f.collection_date = calendar.date""",
    "rolling": """
        SELECT *, sum(new_cases) OVER w30 AS rolling_cases_last_30_days,
               sum(new_cases) OVER w7 AS rolling_cases_last_7_days,
               CAST(sum(n_new_sequences) OVER w30 AS BIGINT) AS rolling_seq_last_30_days,
               CAST(sum(n_new_sequences) OVER w7 AS BIGINT) AS rolling_seq_last_7_days,
               CAST(sum(fam_2) OVER w7 AS BIGINT) AS rolling_family_last_7_days
        FROM merged
        WINDOW w30 AS (PARTITION BY country_code ORDER BY date
                       ROWS BETWEEN 29 PRECEDING AND CURRENT ROW),
               w7 AS (PARTITION BY country_code ORDER BY date
                      ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
    "dense": """
        SELECT k.code, calendar.date, coalesce(n, 0) AS n
        FROM (SELECT DISTINCT code FROM line_list) k CROSS JOIN calendar
        LEFT JOIN (SELECT code, collection_date AS date, count(*) AS n FROM line_list
                   GROUP BY 1, 2) USING (code, date)""",
    "last_30": """
        SELECT date, count(submission_date) AS n FROM calendar
        LEFT JOIN line_list ON collection_date BETWEEN date - 29 AND date
             AND submission_date <= date
        GROUP BY date""",
    "thirty": """
        SELECT date, n, n_lag_30, n / NULLIF(CAST(n_lag_30 AS DOUBLE), 0) AS r
        FROM (SELECT date, n, lag(n, 30) OVER (ORDER BY date) AS n_lag_30 FROM last_30)""",
    "testing_daily": """
        SELECT n_nationkey, country, code, region, submission_date AS time, count(*) AS n
        FROM line_list GROUP BY ALL""",
    "testing_cum": """
        SELECT *, sum(n) OVER (PARTITION BY code ORDER BY time) AS cum,
               population / 100000 AS pop_100k
        FROM testing_daily JOIN populations ON n_nationkey = c_nationkey""",
    "regions_as_countries": """
        SELECT NULL AS code, 'Greater ' || region AS country, time, n, 0 AS n_nationkey,
               sum(n) OVER (PARTITION BY region ORDER BY time) AS cum, 50 AS pop_100k
        FROM (SELECT region, time, sum(n) AS n FROM testing_daily GROUP BY 1, 2)""",
    "tests": """
        SELECT code, country, time AS date, pop_100k, CAST(n AS DOUBLE) AS new_tests_all,
               CAST(cum AS DOUBLE) / pop_100k AS cap_cum_tests, CAST(cum AS DOUBLE) AS cum_tests,
               floor(CAST(cum * CASE WHEN n_nationkey % 5 = 0 THEN 200 ELSE 30 END AS DOUBLE)
                     / 100) AS cum_cases
        FROM (SELECT code, country, time, n, n_nationkey, cum, pop_100k FROM testing_cum
              UNION ALL
              SELECT code, country, time, n, n_nationkey, cum, pop_100k FROM regions_as_countries)""",
    "tests_dense": f"""
        SELECT k.code, d.date, country, coalesce(new_tests_all, 0) AS new_tests_all,
               coalesce(new_tests_all, 0) / pop_100k AS rate, cap_cum_tests, cum_tests, cum_cases
        FROM (SELECT DISTINCT code FROM tests) k
        CROSS JOIN (SELECT CAST(unnest(generate_series((SELECT min(date) FROM tests), {D_LAST},
                    INTERVAL 1 DAY)) AS DATE) AS date) d
        LEFT JOIN tests ON tests.code IS NOT DISTINCT FROM k.code AND tests.date = d.date""",
    "tests_avg": """
        SELECT *, CASE WHEN count(rate) OVER w = 30 THEN round(sum(rate) OVER w / 30.0, 2) END
                    AS mean_30
        FROM tests_dense WINDOW w AS (PARTITION BY code ORDER BY date, country
                                      ROWS BETWEEN 14 PRECEDING AND 15 FOLLOWING)""",
    "test_metrics": f"""
        SELECT code, CASE WHEN m >= 0 THEN m END AS max_new_tests_cap_avg, cap_cum_tests,
               CASE WHEN tpr BETWEEN 0 AND 1 THEN tpr END AS cum_tpr,
               tests_in_last_7_days, tests_in_last_30_days
        FROM (SELECT code, max(mean_30) AS m, max(cap_cum_tests) AS cap_cum_tests,
                     max(cum_cases) / NULLIF(max(cum_tests), 0) AS tpr,
                     coalesce(sum(new_tests_all) FILTER (date BETWEEN {D_LAST} - 6 AND {D_LAST}),
                              0) AS tests_in_last_7_days,
                     coalesce(sum(new_tests_all) FILTER (date BETWEEN {D_LAST} - 29 AND {D_LAST}),
                              0) AS tests_in_last_30_days
              FROM tests_avg GROUP BY code)""",
    "recent_sums": f"""
        SELECT country_code,
               coalesce(sum(new_cases) FILTER (month), 0) AS cases_in_last_30_days,
               CAST(coalesce(sum(n_new_sequences) FILTER (month), 0) AS BIGINT)
                 AS sequences_in_last_30_days,
               max(population) FILTER (month) AS population_size,
               coalesce(sum(new_cases) FILTER (wk), 0) AS cases_7,
               max(population) FILTER (wk) AS population_7,
               CAST(coalesce(sum(n_new_sequences) FILTER (wk), 0) AS BIGINT) AS seq_7,
               CAST(sum(n_new_sequences) AS BIGINT) AS n_sequences,
               CAST(coalesce(sum(n_new_sequences) FILTER (before), 0) AS BIGINT) AS seq_before,
               CAST(coalesce(sum(fam_2) FILTER (wk), 0) AS BIGINT) AS fam_2_7,
               CAST(sum(fam_2) AS BIGINT) AS fam_2_all,
               CAST(coalesce(sum(fam_2) FILTER (before), 0) AS BIGINT) AS fam_2_before,
               CAST(coalesce(sum(fam_4_5) FILTER (wk), 0) AS BIGINT) AS fam_4_5_7,
               CAST(sum(fam_4_5) AS BIGINT) AS fam_4_5_all,
               CAST(coalesce(sum(fam_4_5) FILTER (before), 0) AS BIGINT) AS fam_4_5_before
        FROM (SELECT *, date BETWEEN {D_LAST} - 29 AND {D_LAST} AS month,
                     date BETWEEN {D_LAST} - 6 AND {D_LAST} AS wk,
                     date BETWEEN {D_LAST} - 13 AND {D_LAST} - 7 AS before FROM merged)
        GROUP BY country_code""",
    "recent": f"""
        SELECT *,
          {div('100000.0 * cases_in_last_30_days', 'population_size')}
            AS cases_per_100k_last_30_days,
          {div('100.0 * sequences_in_last_30_days', 'cases_in_last_30_days')}
            AS percent_of_cases_sequenced_last_30_days,
          {div('100000.0 * sequences_in_last_30_days', 'population_size')}
            AS per_capita_seq_rate_in_last_30_days,
          {threshold('sequences_in_last_30_days')} AS max_prevalence_variant_pct,
          round({div('100000.0 * cases_7', 'population_7')}, 1) AS cases_per_100k_last_7_days
        FROM recent_sums""",
    "with_tests": f"""
        SELECT *, positivity_7 AS positivity_in_last_7_days,
               positivity_30 AS positivity_in_last_30_days
        FROM (SELECT *, {div('cases_per_100k_last_7_days', 't7')} AS positivity_7,
                     {div('cases_per_100k_last_30_days', 't30')} AS positivity_30
              FROM (SELECT *,
                      {div('100000.0 * tests_in_last_7_days', 'population_size')} AS t7,
                      {div('100000.0 * tests_in_last_30_days', 'population_size')} AS t30
                    FROM recent LEFT JOIN test_metrics ON country_code = code))""",
    "shapes": """
        SELECT n_nationkey, CASE WHEN n_nationkey % 6 <> 0
                 THEN 'POLYGON ' || CAST(n_nationkey AS VARCHAR) END AS geometry,
               CASE WHEN n_nationkey % 6 <> 0 THEN country END AS name, code AS country_code,
               n_nationkey * 1.5::DOUBLE AS latitude, n_nationkey * -2.25::DOUBLE AS longitude
        FROM nations""",
    "feed": """
        SELECT country, code, submission_date, count(*) AS n FROM line_list GROUP BY 1, 2, 3""",
    "snaps": f"""
        SELECT CAST(date_trunc('hour', ts - INTERVAL {V.SNAPSHOT_SHIFT} DAY) AS TIMESTAMP)
                 AS timestamp,
               'N' || lpad(CAST(user_id % 25 AS VARCHAR), 2, '0') AS code,
               CAST(sum(CAST(trunc(value) AS BIGINT)) FILTER (event_type <> 'error') AS BIGINT)
                 AS confirmed,
               CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT)
                 AS probable
        FROM events GROUP BY 1, 2""",
    "reconciled": """
        SELECT coalesce(a.code, b.code) AS code, cum_seq, confirmed, probable,
               greatest(cum_seq, confirmed) AS max_cases
        FROM (SELECT code, CAST(sum(n) AS BIGINT) AS cum_seq FROM feed GROUP BY 1) a
        FULL JOIN (SELECT DISTINCT code, confirmed, probable FROM snaps
                   WHERE confirmed IS NOT NULL AND timestamp =
                     (SELECT max(timestamp) FROM snaps WHERE confirmed IS NOT NULL)) b
          ON a.code = b.code""",
    "snap_clock": """
        SELECT *, CAST(timestamp AS DATE) AS date,
               hour(timestamp) + minute(timestamp) / 60.0::DOUBLE AS clock FROM snaps""",
    "snap_first": """
        SELECT * FROM (SELECT *, clock - 13.0 AS time_diff FROM snap_clock
                       WHERE confirmed IS NOT NULL)
        QUALIFY rank() OVER (PARTITION BY date ORDER BY time_diff) = 1""",
    "feed_cum": """
        SELECT * FROM (SELECT *, CAST(sum(n) OVER (PARTITION BY code ORDER BY submission_date, country)
                              AS BIGINT) AS cum_seq FROM feed) WHERE cum_seq <> 0""",
    "rec_daily": """
        SELECT date, count(*) AS n_countries_all,
               CAST(sum(greatest(cum_seq, confirmed)) AS BIGINT) AS n_cases_all,
               CAST(coalesce(sum(confirmed), 0) AS BIGINT) AS n_cases_confirmed,
               CAST(coalesce(sum(cum_seq), 0) AS BIGINT) AS n_seq
        FROM (SELECT submission_date AS date, code, cum_seq FROM feed_cum)
        FULL JOIN (SELECT date, code, confirmed FROM snap_first) USING (date, code)
        GROUP BY date""",
    "global_sums": """
        SELECT date, sum(rolling_cases_last_7_days) AS rolling_cases_last_7_days,
               sum(rolling_cases_last_30_days) AS rolling_cases_last_30_days,
               CAST(sum(n_new_sequences) AS BIGINT) AS n_new_sequences,
               sum(new_cases) AS n_new_cases
        FROM rolling GROUP BY date""",
    "global_all": """
        SELECT *, CASE WHEN count(*) OVER w = 7 THEN round(sum(n_new_cases) OVER w / 7.0, 2) END
                    AS new_cases_7d_avg,
               CASE WHEN count(*) OVER w = 7 THEN
                 round(CAST(sum(n_new_sequences) OVER w AS DOUBLE) / 7.0, 2) END
                    AS new_seq_7d_avg,
               lag(rolling_cases_last_7_days, 7) OVER (ORDER BY date) AS rolling_cases_lag_7,
               lag(rolling_cases_last_30_days, 30) OVER (ORDER BY date) AS rolling_cases_lag_30
        FROM global_sums
        WINDOW w AS (ORDER BY date ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)""",
    "by_day": """
        SELECT date, r.* EXCLUDE (date), g.* EXCLUDE (date), n AS cases_seq_last_30_days,
               n_lag_30 AS cases_seq_last_30_days_lag_30
        FROM rec_daily r FULL JOIN global_all g USING (date) LEFT JOIN thirty USING (date)""",
    "weekly_flows": """
        SELECT CAST(date_trunc('week', l_shipdate) AS DATE) AS week_start,
               CAST(date_trunc('week', l_shipdate) AS DATE) + 6 AS week_end,
               CAST(l_suppkey AS INTEGER) AS i, CAST(l_partkey AS INTEGER) AS j,
               sum(l_quantity) AS w
        FROM lineitem GROUP BY ALL""",
    "states": """
        SELECT country, n, c, med, round(100.0::DOUBLE * n / c, 3) AS pct FROM (
          SELECT country, count(*) AS n,
                 CAST(trunc(quantile_cont(submission_date - collection_date, 0.5)) AS INTEGER)
                   AS med
          FROM line_list GROUP BY 1)
        JOIN (SELECT country, count(*) AS c FROM order_places GROUP BY 1) USING (country)""",
    "pages_cells": """
        SELECT doc_id, list_transform(string_split(text, ' '), lambda w, i:
          CASE WHEN w = 'und' THEN 'total (worldwide)'
               WHEN (i - 1) % 7 = 1 OR (i - 1) % 7 = 3
               THEN CAST(length(w) AS VARCHAR) || ',' ||
                    lpad(CAST((i - 1) % 1000 AS VARCHAR), 3, '0') ELSE w END) AS cells
        FROM documents""",
    "page_stops": """
        SELECT doc_id, cells, CASE WHEN list_position(cells, 'total (worldwide)') > 0
                 THEN list_position(cells, 'total (worldwide)') - 1 ELSE len(cells) END AS stop
        FROM pages_cells""",
    "tracker": """
        SELECT doc_id, row, cells[row * 7 + 8] AS location,
               TRY_CAST(replace(cells[row * 7 + 9], ',', '') AS BIGINT) AS confirmed,
               TRY_CAST(replace(cells[row * 7 + 11], ',', '') AS BIGINT) AS probable
        FROM (SELECT *, CAST(unnest(range(0, CAST(greatest(floor((stop - 7) / 7), 0) AS BIGINT)))
                AS INTEGER) AS row FROM page_stops)""",
    "board": f"""
        SELECT country, iso_code, who_region, omicron_variant, new_cases AS new_covid_cases,
               new_deaths, total_cases AS total_covid_cases, total_deaths, date
        FROM (SELECT country, count(*) AS omicron_variant FROM line_list GROUP BY 1)
        JOIN (SELECT location AS country, * EXCLUDE (location) FROM cases
              WHERE date = DATE '2001-07-02'
                AND location IN ({quoted(f'NATION_{i}' for i in range(1, 21))})) USING (country)
        JOIN (SELECT entity AS country, who_region FROM who) USING (country)""",
    "cube_long": f"""
        SELECT collect_date, country, label, count(accession_id) AS n FROM (
          SELECT collect_date, country, accession_id,
                 CASE WHEN {BRAND_MATCH} THEN pango_lineage ELSE 'Other lineages' END AS label
          FROM clean_list)
        GROUP BY ALL""",
    "regional_clean": f"""
        SELECT clean_list.*, region AS continent, who_region, {week('collect_date')} AS wk
        FROM clean_list LEFT JOIN (SELECT entity, who_region FROM who) ON country = entity""",
    "regional_cases": """
        SELECT cases.*, who_region FROM cases LEFT JOIN who ON location = entity
        WHERE NOT starts_with(iso_code, 'OWID')""",
}

LAG = """count({x}) AS seq_count, quantile_cont({x}, 0.5) AS lagdays_median,
         min({x}) AS lagdays_min, max({x}) AS lagdays_max,
         quantile_cont({x}, 0.25) AS lagdays_q1, quantile_cont({x}, 0.75) AS lagdays_q3"""
LAG_SQL = LAG.format(x="lag_days").replace(
    "count(lag_days)", "count(lag_days)").replace(
    "quantile_cont(lag_days,", "quantile_cont(CAST(lag_days AS DOUBLE),")
PIVOT = ["Brand#1", "Brand#2", *(f"Brand#{i}" for i in range(20, 26)), "Brand#3", "Brand#4", "Brand#5",
         "Brand#7"]


def pivot_columns(alias=lambda x: f'"{x}"') -> str:
    out = [f'CAST(sum(n) AS BIGINT) AS {alias("All lineages")}']
    for label in [*PIVOT, "Other lineages"]:
        out.append(f"CAST(sum(n) FILTER (label = '{label}') AS BIGINT) AS {alias(label)}")
    return ", ".join(out)


RECENT_COLUMNS = """country_code, cases_in_last_30_days, sequences_in_last_30_days,
    population_size, round(cases_per_100k_last_30_days, 6) AS cases_per_100k_last_30_days,
    round(percent_of_cases_sequenced_last_30_days, 6)
      AS percent_of_cases_sequenced_last_30_days,
    round(per_capita_seq_rate_in_last_30_days, 6) AS per_capita_seq_rate_in_last_30_days,
    round(max_prevalence_variant_pct, 6) AS max_prevalence_variant_pct,
    cases_per_100k_last_7_days"""
TEST_COLUMNS = """round(max_new_tests_cap_avg, 6) AS max_new_tests_cap_avg,
    round(cap_cum_tests, 6) AS cap_cum_tests, round(cum_tpr, 6) AS cum_tpr,
    tests_in_last_7_days, tests_in_last_30_days"""


def share(fam: str) -> str:
    return f"round({div(f'100.0 * {fam}_before', 'seq_before')}, 2)"


def number(x: str) -> str:
    return f"regexp_replace(CAST({x} AS VARCHAR), '\\.0$', '')"


def family_summary(fam: str) -> str:
    s = share(fam)
    return f"""
        SELECT geometry, latitude, longitude, name AS "Name", n_lineage,
               NULLIF(n_lineage, 0) AS n_lineage_na,
               CASE WHEN country IS NULL THEN NULL WHEN n_lineage > 0 THEN 'Yes' ELSE 'No' END
                 AS lineage_detected,
               cases_per_100k_last_7_days,
               round(pct, 6) AS percent_of_cases_sequenced_last_30_days,
               coalesce(round(pct, 2), 0.0) AS rounded_pct_cases_seq,
               NULLIF(round(pct, 2), 0) AS pct_cases_seq_w_na,
               coalesce(sequences_in_last_30_days, 0) AS sequences_in_last_30_days,
               share AS pct_seq_last_week,
               CASE WHEN n_lineage > 0 THEN coalesce(share, 0.0) END AS pct_dots,
               CASE WHEN total_seq_last_week = 0
                    THEN 'No sequences were submitted from last week'
                    WHEN total_seq_last_week < 100 THEN {number('share')} || ' %*'
                    WHEN total_seq_last_week >= 100 THEN {number('share')} || ' %' END
                 AS pct_panel,
               total_seq_last_week, s.country_code
        FROM shapes s LEFT JOIN (
          SELECT country_code AS country, {fam}_all AS n_lineage, {s} AS share,
                 percent_of_cases_sequenced_last_30_days AS pct, cases_per_100k_last_7_days,
                 sequences_in_last_30_days, seq_before AS total_seq_last_week
          FROM recent) r ON r.country = s.country_code AND s.geometry IS NOT NULL"""


def gates(rows) -> str:
    """(name, observed SQL, op, limit, source SQL) to gate rows."""
    return " UNION ALL ".join(
        f"SELECT '{name}' AS gate, CAST(o AS DOUBLE) AS observed, "
        f"CAST({limit} AS DOUBLE) AS threshold, coalesce(o {op} {limit}, false) AS passed "
        f"FROM (SELECT {seen} AS o FROM {source})"
        for name, seen, op, limit, source in rows)


def summary_gate_rows(fam: str, extra) -> str:
    src = f"({family_summary(fam)})"
    of = lambda c, who: f"max({c}) FILTER (country_code = '{who}')"
    rows = [
        ("home_cases_per_100k", of("cases_per_100k_last_7_days", V.HOME), ">", 50, src),
        ("home_pct_sequenced",
         of("percent_of_cases_sequenced_last_30_days", V.HOME), ">", 0.0001, src),
        ("home_lineage_count", of("n_lineage", V.HOME), ">", 40, src),
        ("countries_above_100_pct", "count(*) FILTER (pct_dots > 100)", "=", 0, src),
        ("missing_columns", "max(0)", "=", 0, src),
        ("reported_case_values",
         f"count(cases_per_100k_last_7_days) FILTER (country_code = '{V.HOME}')", ">", 0, src),
        *[(n, of(c, who), ">", lim, src) for n, c, who, lim in extra],
    ]
    return f"SELECT gate, round(observed, 6) AS observed, threshold, passed FROM ({gates(rows)})"


def by_place(source: str, key: str, measures: str) -> str:
    parts = [
        f"SELECT {key}, continent, NULL AS who_region, {measures}, "
        f"continent AS aggregate_location FROM {source} WHERE continent IS NOT NULL "
        f"GROUP BY {key}, continent",
        f"SELECT {key}, NULL, who_region, {measures}, 'WHO Region: ' || who_region "
        f"FROM {source} WHERE who_region IS NOT NULL GROUP BY {key}, who_region",
        f"SELECT {key}, NULL, NULL, {measures}, 'Global' FROM {source} GROUP BY {key}",
    ]
    return " UNION ALL ".join(parts)


LABEL_SQL = """CASE WHEN tpr < 0.002 AND x >= 95 THEN 'minimal recent COVID cases'
    WHEN x >= 95 THEN 'not estimated, insufficient recent sequencing'
    WHEN x <= 0.01 THEN '<0.01{s}' ELSE {n} || '{s}' END"""


def label(x: str, tpr: str, suffix: str = "") -> str:
    return (LABEL_SQL.replace("{s}", suffix).replace("{n}", number("x"))
            .replace("tpr", tpr).replace(" x ", f" {x} ").replace("(x ", f"({x} ")
            .replace("(x AS", f"({x} AS"))


WIDE_MEASURES = [
    "All lineages", *PIVOT, "Other lineages", "new_cases", "new_cases_smoothed",
    "new_people_vaccinated", "new_people_fully_vaccinated", "population"]


def wide_sql() -> str:
    """Country rows and regional rows of the wide table, cut at the last submission."""
    ints = {"All lineages", *PIVOT, "Other lineages"}
    sums = ", ".join(
        f'CAST(coalesce(sum("{m}"), 0) AS {"BIGINT" if m in ints else "DOUBLE"}) AS "{m}"'
        for m in WIDE_MEASURES)
    cols = ", ".join(f'"{m}"' for m in WIDE_MEASURES)
    return f"""
      , seq_wide AS (SELECT collect_date, country, {pivot_columns()} FROM cube_long
                     GROUP BY 1, 2),
      places AS (SELECT location, max(continent) AS continent, max(population) AS population
                 FROM case_loaded GROUP BY 1),
      wide AS (
        SELECT collect_date, country, s.* EXCLUDE (collect_date, country), new_cases,
               new_cases_smoothed, new_people_vaccinated, new_people_fully_vaccinated,
               places.location, places.continent, places.population, who_region
        FROM seq_wide s FULL JOIN (
          SELECT date AS collect_date, location AS country, new_cases, new_cases_smoothed,
                 new_people_vaccinated, new_people_fully_vaccinated FROM case_loaded)
          USING (collect_date, country)
        LEFT JOIN places ON places.location = country
        LEFT JOIN who ON who.entity = places.location),
      lags AS (SELECT collect_date, country, {LAG_SQL} FROM clean_list GROUP BY 1, 2),
      all_rows AS (
        SELECT collect_date, country, location, continent, who_region, {cols},
               NULL AS aggregate_location FROM wide
        UNION ALL
        SELECT collect_date, NULL, NULL, continent, who_region, {cols}, aggregate_location
        FROM ({by_place('wide', 'collect_date', sums)}))
      SELECT collect_date AS seq_collect_date, country AS seq_country,
             {yearweek('collect_date')} AS seq_collect_yearweek,
             {week('collect_date')} AS seq_collect_weekstartdate,
             collect_date AS case_date, location AS case_location,
             continent AS case_continent, who_region, population AS case_population,
             {", ".join(f'"{m}"' for m in WIDE_MEASURES[:len(PIVOT) + 2])}, new_cases AS case_new_cases,
             round(new_cases_smoothed, 6) AS case_new_cases_smoothed,
             new_people_vaccinated AS case_new_people_vaccinated,
             new_people_fully_vaccinated AS case_new_people_fully_vaccinated,
             aggregate_location, seq_count, lagdays_median AS seq_lagdays_median,
             lagdays_min AS seq_lagdays_min, lagdays_max AS seq_lagdays_max,
             lagdays_q1 AS seq_lagdays_q1, lagdays_q3 AS seq_lagdays_q3
      FROM all_rows LEFT JOIN lags USING (collect_date, country)
      WHERE collect_date <= (SELECT max(submit_date) FROM clean_list)"""


ORDER_DAYS = "(SELECT *, CAST(o_orderdate AS DATE) AS day FROM orders)"
MEAN_N = "(SELECT *, CASE WHEN dayofyear(date) % 50 <> 0 THEN n END AS m FROM dense)"


def around(width: int) -> str:
    back, ahead = (width - 1) // 2, width // 2
    w = (f"OVER (PARTITION BY code ORDER BY date ROWS BETWEEN {back} PRECEDING "
         f"AND {ahead} FOLLOWING)")
    return (f"CASE WHEN count(m) {w} = {width} THEN "
            f"round(CAST(sum(m) {w} AS DOUBLE) / {width}.0, 2) END")


def nearest(source: str, diff: str) -> str:
    return (f"SELECT * FROM (SELECT *, {diff} AS time_diff FROM {source}) "
            "QUALIFY rank() OVER (PARTITION BY date ORDER BY time_diff) = 1")


def topline_sql() -> str:
    today, before = D_ASOF, f"{D_ASOF} - 6"
    at = lambda c, d: f"max({c}) FILTER (date = {d})"
    pct = lambda a, b, n: f"round({div(f'100.0 * ({a})', b)}, {n})"
    comma = lambda x: f"format('{{:,}}', CAST({x} AS BIGINT))"

    def counted(c, metric):
        now, old = at(c, today), at(c, before)
        return (f"SELECT '{metric}' AS metric, CAST({now} AS DOUBLE) AS n, "
                f"CAST({now} - {old} AS DOUBLE) AS change, "
                f"{pct(f'{now} - {old}', old, 1)} AS pctchange, 'Last week' AS since, "
                "0 AS kind FROM by_day")

    labels = K.TOPLINE_LABELS
    rows = [
        counted("n_cases_all", labels["omicroncases"][0]),
        counted("n_countries_all", labels["countries"][0]),
        f"""SELECT '{labels["global_cases"][0]}', rolling_cases_last_7_days,
            rolling_cases_last_7_days - rolling_cases_lag_7,
            {pct('rolling_cases_last_7_days - rolling_cases_lag_7', 'rolling_cases_lag_7', 1)},
            'Last week', 0 FROM by_day WHERE date = {D_LAST}""",
        f"""SELECT '{labels["pct_cases_seq"][0]}', s, round(s - p, 6),
            {pct('round(s - p, 6)', 'p', 1)}, '30 days ago', 1
            FROM (SELECT {pct('cases_seq_last_30_days', 'rolling_cases_last_30_days', 2)} AS s,
                  {pct('cases_seq_last_30_days_lag_30', 'rolling_cases_lag_30', 2)} AS p
                  FROM by_day WHERE date = {D_LAST})""",
    ]
    shown = lambda c: (f"CASE WHEN kind = 1 THEN {number(c)} || ' %' ELSE {comma(c)} END")
    plus = lambda t, x: f"CASE WHEN {x} > 0 THEN '+ ' || {t} ELSE {t} END"
    percent_text = f"({number('pctchange')} || ' %')"
    return f"""SELECT metric AS "Metric", {shown('n')} AS "Value",
        {plus(f"({shown('change')})", 'change')} AS "Change (#)",
        {plus(percent_text, 'pctchange')} AS "Change (%)", since AS "Change from"
        FROM ({" UNION ALL ".join(rows)})"""


def carousel_sql() -> str:
    at = lambda c, d: f"max({c}) FILTER (date = DATE '{d}')"
    diff = lambda c: f"{at(c, '2001-08-01')} - {at(c, '2001-07-31')}"
    seen = {
        "n_cases_all": at("n_cases_all", "2001-08-01"),
        "n_countries_all": at("n_countries_all", "2001-08-01"),
        "n_seq": at("n_seq", "2001-08-01"), "daily_inc_all_cases": diff("n_cases_all"),
        "daily_inc_countries": diff("n_countries_all"), "daily_inc_seq": diff("n_seq"),
    }
    return " UNION ALL ".join(
        f"""SELECT max(date) AS "Submission Date", '{text}' AS "Metric", '{source}' AS "Source",
            CAST({seen[c]} AS BIGINT) AS "Total", {order} AS "order" FROM rec_daily"""
        for c, (text, source, order) in K.CAROUSEL_ROWS.items())


QUERIES = {
    "line_list_flags": """
        SELECT accession_id, abnormal_date, abnormal_date_inclusive, suspect_sequence,
               abnormal_gc_content,
               abnormal_date OR suspect_sequence OR abnormal_gc_content AS any_abnormal
        FROM flagged""",
    "exclusion_flag": f"""
        SELECT l_returnflag, l_linestatus, x.name IS NOT NULL AS excluded, count(*) AS n
        FROM lineitem LEFT JOIN exclusion_list x ON 'hCoV-19/' || {ACC} = x.name
        GROUP BY 1, 2, 3""",
    "exclusion_names": "SELECT name FROM exclusion_list",
    "location_parts": f"""
        SELECT o_orderkey, p[1] AS continent, p[2] AS country, p[3] AS division,
               p[4] AS location, region AS region_part, c AS country_part, '' AS missing_part,
               {title('c')} AS title_cased, {capital('c')} AS capitalised,
               {titlecased('c')} AS country_titlecased, {plain('c')} AS country_plain,
               CASE WHEN division = 'HOUSEHOLD' THEN 'District of Columbia' ELSE division END
                 AS division_fixed
        FROM (SELECT o_orderkey, region, division, {RAW} AS c,
              regexp_split_to_array(region || ' / ' || {RAW} || '/ ' || division
                                    || ' /site/extra', ' / | /|/ |/') AS p
              FROM order_places)""",
    "iso_weeks": f"""
        SELECT o_orderkey, {yearweek('day')} AS yearweek, {week('day')} AS weekstart,
               isodow(day) = 7 AS sunday,
               CASE WHEN o_orderkey % 3 = 0 THEN CAST(date_trunc('month', day) AS DATE)
                    WHEN o_orderkey % 3 = 1 THEN day END AS lenient,
               CASE WHEN o_orderkey % 3 = 1 THEN day END AS strict
        FROM {ORDER_DAYS}""",
    "time_of_day": """
        SELECT event_id, hour(ts) + minute(ts) / 60.0::DOUBLE AS hours,
               strftime(ts, '%Y-%m-%d-%H') AS stamp FROM events""",
    "clean_line_list": "SELECT * FROM clean_full",
    "clean_line_list_normal_rows": """
        SELECT country, collect_yearweek, count(*) AS n, max(lag_days) AS max_lag
        FROM clean_full WHERE NOT any_abnormal GROUP BY 1, 2""",
    "coded_line_list": f"""
        SELECT code, country, division, collection_date, count(*) AS n,
               count(place) AS n_places
        FROM (SELECT {plain('p[2]')} AS country, p[3] AS division, p[4] AS place,
                     CASE WHEN length(collected) = 10 THEN CAST(collected AS DATE) END
                       AS collection_date
              FROM (SELECT regexp_split_to_array(location, ' / | /|/ |/') AS p, collected
                    FROM metadata))
        JOIN name_codes ON {key_of('country')} = name_key
        WHERE collection_date BETWEEN {D_FIRST} AND {D_ASOF}
        GROUP BY 1, 2, 3, 4""",
    "country_crosswalk": f"""
        SELECT c.country, n, code
        FROM (SELECT '  ' || upper({plain(RAW)}) AS country, count(*) AS n
              FROM order_places GROUP BY 1) c
        LEFT JOIN name_codes ON {key_of('c.country')} = name_key""",
    "coded_written_names": f"""
        SELECT w.code, name AS country, count(*) AS n, max(CAST(l_shipdate AS DATE)) AS last_submission
        FROM lineitem JOIN order_places ON l_orderkey = o_orderkey JOIN written_names w USING (n_nationkey)
        WHERE w.code IS NOT NULL AND collection_date BETWEEN {D_FIRST} AND {D_ASOF}
        GROUP BY 1, 2""",
    "unmatched_written_names": """
        SELECT name AS country, count(*) AS n_rows FROM order_places JOIN written_names USING (n_nationkey)
        WHERE written_names.code IS NULL GROUP BY 1""",
    "names_of_codes": """
        SELECT name AS country, count(*) AS n, written_names.code, english AS country_name
        FROM order_places JOIN written_names USING (n_nationkey) GROUP BY 1, 3, 4""",
    "coded_share_gate": """
        SELECT 'coded_share' AS gate, round(x, 6) AS observed, 0.95::DOUBLE AS threshold, x >= 0.95 AS passed
        FROM (SELECT count(written_names.code) / count(*) AS x
              FROM order_places JOIN written_names USING (n_nationkey))""",
    "continents_by_code": """
        SELECT country_code, date, r.continent, new_cases FROM merged
        LEFT JOIN (SELECT iso_code, min(continent) AS continent FROM cases GROUP BY 1) r
        ON country_code = r.iso_code""",
    "unmatched_names": f"""
        SELECT country, n_rows FROM (SELECT {plain(RAW)} AS country, count(*) AS n_rows
              FROM order_places GROUP BY 1)
        LEFT JOIN name_codes ON {key_of('country')} = name_key WHERE code IS NULL""",
    "feed_lines": """
        SELECT country, region || ' / ' || country AS location, collection_date,
               count(*) AS n, max(submission_date) AS last_submission
        FROM line_list GROUP BY country, region, collection_date""",
    "lineage_counts_with_totals": f"""
        SELECT collect_date, {yearweek('collect_date')} AS collect_yearweek,
               {week('collect_date')} AS collect_weekstartdate, country, pango_lineage, n,
               CASE WHEN pango_lineage IS NULL THEN 'All lineages'
                    WHEN {BRAND_MATCH} THEN pango_lineage ELSE 'Other lineages' END
                 AS key_lineages
        FROM (SELECT collect_date, country, pango_lineage, count(accession_id) AS n
              FROM clean_list GROUP BY 1, 2, 3
              UNION ALL
              SELECT collect_date, country, NULL, count(accession_id)
              FROM clean_list GROUP BY 1, 2)""",
    "lineage_counts_by_day": f"""
        SELECT collect_date, {yearweek('collect_date')} AS collect_yearweek,
               {week('collect_date')} AS collect_weekstartdate, country, pango_lineage,
               count(accession_id) AS n
        FROM clean_list GROUP BY collect_date, country, pango_lineage""",
    "lineage_totals_by_day": f"""
        SELECT collect_date, {yearweek('collect_date')} AS collect_yearweek,
               {week('collect_date')} AS collect_weekstartdate, country,
               count(accession_id) AS n
        FROM clean_list GROUP BY collect_date, country""",
    "key_lineages": f"""
        SELECT p_partkey, CASE WHEN pango_lineage IN ('Brand#4', 'Brand#5') THEN 'Brand#4/5'
                 WHEN {BRAND_MATCH} THEN pango_lineage ELSE 'Other lineages' END AS label,
               {BRAND_MATCH} AS matched,
               CASE WHEN pango_lineage = 'Brand#1' THEN 'who_first'
                    WHEN starts_with(pango_lineage, 'Brand#2') THEN 'who_second'
                    WHEN pango_lineage IN ('Brand#3', 'Brand#4', 'Brand#5') THEN 'who_third'
                    ELSE 'who_other' END AS group_name
        FROM (SELECT p_partkey, p_brand AS pango_lineage FROM part)""",
    "lineage_conditional": """
        SELECT *, n_new_sequences - fam_1 - fam_2 - fam_4_5 AS other FROM family_counts""",
    "country_day_counts": """
        SELECT code, collection_date, count(*) AS n_new_sequences FROM line_list
        GROUP BY 1, 2""",
    "submission_day_counts": """
        SELECT country, submission_date, count(*) AS n FROM line_list GROUP BY 1, 2""",
    "lineage_pivot": f"""
        SELECT collect_date, country, {pivot_columns()} FROM cube_long GROUP BY 1, 2""",
    "lineage_columns": """
        SELECT collect_date, country, label AS variable, n AS value FROM cube_long
        UNION ALL
        SELECT collect_date, country, 'All lineages', CAST(sum(n) AS BIGINT) FROM cube_long GROUP BY 1, 2""",
    "variant_groups": """
        SELECT collect_date, country,
               count(*) FILTER (pango_lineage = 'Brand#1') AS who_first,
               count(*) FILTER (starts_with(pango_lineage, 'Brand#2')) AS who_second,
               count(*) FILTER (pango_lineage IN ('Brand#3', 'Brand#4', 'Brand#5'))
                 AS who_third,
               count(*) FILTER (pango_lineage NOT IN ('Brand#1', 'Brand#3', 'Brand#4', 'Brand#5')
                 AND NOT starts_with(pango_lineage, 'Brand#2')) AS who_other
        FROM clean_list GROUP BY 1, 2""",
    "distinct_lineages": """
        SELECT region, count(DISTINCT pango_lineage) AS n_lineages,
               count(DISTINCT country) AS n_countries,
               bool_or(pango_lineage = 'Brand#2') AS present
        FROM line_list GROUP BY 1""",
    "lineage_check": """
        SELECT count(*) FILTER (pango_lineage = 'Brand#2' AND country = 'NATION_0') AS n_0,
               count(*) FILTER (pango_lineage = 'Brand#2' AND country = 'NATION_16') AS n_1,
               bool_or(pango_lineage = 'Brand#2') AS present,
               count(DISTINCT pango_lineage) AS n_lineages
        FROM line_list""",
    "lineage_extract": """
        SELECT accession_id, country, collection_date, submission_date, pango_lineage
        FROM line_list WHERE pango_lineage = 'Brand#2'""",
    "densified_series": "SELECT code, date AS collection_date, n FROM dense",
    "observed_grid": """
        SELECT country, submission_date, n
        FROM (SELECT DISTINCT country FROM line_list)
        CROSS JOIN (SELECT DISTINCT submission_date FROM line_list)
        LEFT JOIN (SELECT country, submission_date, count(*) AS n FROM line_list GROUP BY 1, 2)
          USING (country, submission_date)""",
    "submission_grid": """
        SELECT country, submission_date, n, code
        FROM (SELECT DISTINCT country, code FROM line_list)
        CROSS JOIN (SELECT DISTINCT submission_date FROM line_list)
        LEFT JOIN (SELECT country, submission_date, count(*) AS n FROM line_list GROUP BY 1, 2)
          USING (country, submission_date)""",
    "case_series": """
        SELECT date AS case_date, location AS case_location, iso_code AS case_iso_code,
               continent AS case_continent, new_cases AS case_new_cases,
               new_cases_smoothed AS case_new_cases_smoothed, population AS case_population,
               people_vaccinated AS case_people_vaccinated,
               people_fully_vaccinated AS case_people_fully_vaccinated,
               g1 - lag(g1) OVER w AS case_new_people_vaccinated,
               g2 - lag(g2) OVER w AS case_new_people_fully_vaccinated
        FROM (SELECT *, coalesce(last_value(people_vaccinated IGNORE NULLS) OVER v, 0) AS g1,
                     coalesce(last_value(people_fully_vaccinated IGNORE NULLS) OVER v, 0) AS g2
              FROM cases WHERE date >= DATE '1995-02-01' AND NOT starts_with(iso_code, 'OWID')
              WINDOW v AS (PARTITION BY iso_code ORDER BY date
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
        WINDOW w AS (PARTITION BY iso_code ORDER BY date)""",
    "case_codes_filtered": """
        SELECT iso_code, count(*) AS n_days, max(date) AS last_day FROM cases
        WHERE iso_code NOT IN ('OWID_ASI', 'OWID_EUR', 'N01') GROUP BY 1""",
    "case_merge_full": """
        SELECT collect_date, country, n, new_cases
        FROM (SELECT collect_date, country, count(accession_id) AS n FROM clean_list
              GROUP BY 1, 2)
        FULL JOIN (SELECT date + 1 AS collect_date, location AS country, new_cases FROM cases
                   WHERE new_cases > 1) USING (collect_date, country)""",
    "case_merge_left": """
        SELECT iso_code, date, new_cases, n_new_sequences
        FROM (SELECT * FROM cases WHERE NOT starts_with(iso_code, 'OWID'))
        LEFT JOIN (SELECT code AS iso_code, collection_date AS date,
                          count(*) AS n_new_sequences FROM line_list GROUP BY 1, 2)
          USING (iso_code, date)""",
    "region_join": """
        SELECT country, collect_date, n, who_region
        FROM (SELECT country, collect_date, count(*) AS n FROM clean_list GROUP BY 1, 2)
        LEFT JOIN who ON country = entity""",
    "lag_stats": f"SELECT collect_date, country, {LAG_SQL} FROM clean_list GROUP BY 1, 2",
    "regional_lag_stats": by_place(
        "(SELECT wk AS collect_weekstartdate, * FROM regional_clean)",
        "collect_weekstartdate", LAG_SQL),
    "region_rollup": by_place(
        f"(SELECT {week('date')} AS week, * FROM regional_cases)", "week",
        "coalesce(sum(new_cases), 0) AS new_cases, "
        "coalesce(sum(people_vaccinated), 0) AS people_vaccinated, "
        "coalesce(sum(population), 0) AS population"),
    "weekly_rollup": f"""
        SELECT location, {week('date')} AS weekstart, {yearweek('date')} AS yearweek,
               coalesce(sum(new_cases), 0) AS new_cases,
               coalesce(sum(people_vaccinated), 0) AS people_vaccinated,
               max(population) AS population, max(who_region) AS who_region,
               max(continent) AS continent
        FROM regional_cases GROUP BY 1, 2, 3""",
    "country_day_wide": wide_sql(),
    "merged_series": "SELECT * FROM merged",
    "ratio_columns": f"""
        SELECT country_code, date, n_new_sequences, new_cases, population,
               round({div('CAST(n_new_sequences AS DOUBLE)', 'new_cases')}, 6)
                 AS sequences_over_new_cases,
               round(new_cases / (population / 1e6), 6) AS new_cases_per_mil
        FROM merged""",
    "rolling_sums": f"""
        SELECT country_code, date, rolling_cases_last_30_days, rolling_cases_last_7_days,
               rolling_seq_last_30_days, rolling_seq_last_7_days, rolling_family_last_7_days,
               round({div('100.0::DOUBLE * rolling_seq_last_30_days',
                          'rolling_cases_last_30_days')}, 6)
                 AS percent_of_cases_seq_last_30_days,
               round({div('100.0::DOUBLE * rolling_family_last_7_days',
                          'rolling_seq_last_7_days')}, 2) AS rolling_pct_of_seq
        FROM rolling""",
    "centred_mean": f"""
        SELECT code, date, {around(7)} AS mean_7, {around(30)} AS mean_30 FROM {MEAN_N}""",
    "lag_ratio": """
        SELECT code, date, n, n_lag_7, round(n / NULLIF(CAST(n_lag_7 AS DOUBLE), 0), 6) AS r
        FROM (SELECT *, lag(n, 7) OVER (PARTITION BY code ORDER BY date) AS n_lag_7
              FROM dense)""",
    "fill_then_diff": """
        SELECT iso_code, date, people_vaccinated,
               f1 - lag(f1) OVER (PARTITION BY iso_code ORDER BY date)
                 AS new_people_vaccinated
        FROM case_filled""",
    "running_total": "SELECT country, code, submission_date, n, cum_seq FROM feed_cum",
    "latest_snapshot": """
        SELECT *, 'place ' || code AS location FROM snaps
        WHERE timestamp = (SELECT max(timestamp) FROM snaps)""",
    "nearest_snapshot": f"""
        SELECT date, code, confirmed, timestamp, time_diff
        FROM ({nearest('snap_clock', 'abs(clock - 13.0)')})""",
    "nearest_event": f"""
        SELECT event_id, date FROM ({nearest(
            "(SELECT event_id, CAST(ts AS DATE) AS date, "
            "hour(ts) + minute(ts) / 60.0::DOUBLE AS clock FROM events)",
            'abs(clock - 13.0)')})""",
    "earliest_snapshot": f"""
        SELECT date, code, confirmed, timestamp, time_diff
        FROM ({nearest('snap_clock', 'clock - 13.0')})""",
    "two_day_change": f"""
        SELECT {D_LAST} AS date, max(o) FILTER (day = {D_LAST}) AS n_orders,
               max(c) FILTER (day = {D_LAST}) AS n_customers,
               max(o) FILTER (day = {D_LAST}) - max(o) FILTER (day = {D_LAST} - 6)
                 AS change_orders,
               max(c) FILTER (day = {D_LAST}) - max(c) FILTER (day = {D_LAST} - 6)
                 AS change_customers
        FROM (SELECT day, count(*) AS o, count(DISTINCT o_custkey) AS c
              FROM {ORDER_DAYS} GROUP BY day)""",
    "metadata_files": """
        SELECT location, collected, count(*) AS n, CAST(sum(len) AS BIGINT) AS total_length,
               count(n_content) AS n_content, max(submitted) AS last_submission
        FROM metadata GROUP BY 1, 2""",
    "case_files": "SELECT iso_code, date, new_cases FROM cases",
    "submission_files": """
        SELECT region || ' / ' || country AS location, submission_date, count(*) AS n,
               count(DISTINCT pango_lineage) AS n_lineages
        FROM line_list GROUP BY 1, 2""",
    "geometry_files": """
        SELECT geometry, name AS "Name", country_code FROM shapes WHERE geometry IS NOT NULL""",
    "country_files": """
        SELECT n_name AS country, n_nationkey * 1.5::DOUBLE AS longitude,
               CAST(n_nationkey * 1000 AS BIGINT) AS population_2019,
               CASE WHEN n_nationkey = 12 THEN 'NA' ELSE lpad(CAST(n_nationkey AS VARCHAR), 2, '0') END AS x2_letter_iso_code,
               'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS x3_letter_iso_code
        FROM nation""",
    "csv_sink": "SELECT country, code, submission_date, n FROM feed",
    "snapshot_master": """
        SELECT code, 'place ' || code AS location, confirmed, probable, timestamp,
               CAST(timestamp AS DATE) AS snapshot_day, strftime(timestamp, '%Y-%m-%d-%H') AS snapshot_hour
        FROM snaps""",
    "seq_kept_up": """
        SELECT country, date, n, lag(n, 30) OVER w AS n_lag_30,
               round(n / NULLIF(CAST(lag(n, 30) OVER w AS DOUBLE), 0), 6) AS r
        FROM (SELECT k.country, date, count(l.country) AS n
              FROM (SELECT DISTINCT country FROM line_list) k CROSS JOIN calendar
              LEFT JOIN line_list l ON l.country = k.country
                   AND l.collection_date BETWEEN date - 29 AND date AND l.submission_date <= date
              GROUP BY 1, 2)
        WINDOW w AS (PARTITION BY country ORDER BY date)""",
    "seq_last_30": "SELECT date, n, n_lag_30, round(r, 6) AS r FROM thirty",
    "seq_last_30_by_country": """
        SELECT k.code, date, count(l.code) AS n
        FROM (SELECT DISTINCT code FROM line_list) k CROSS JOIN calendar
        LEFT JOIN line_list l ON l.code = k.code
             AND l.collection_date BETWEEN date - 29 AND date AND l.submission_date <= date
        GROUP BY 1, 2""",
    "submission_aware_series": f"""
        SELECT code, date, n_seq_last_30_d, new_cases, population, rolling_cases_last_30_days,
               round({div('100.0::DOUBLE * n_seq_last_30_d', 'rolling_cases_last_30_days')}, 6)
                 AS pct_cases_seq_last_30_days
        FROM (SELECT code, date, n_seq_last_30_d, m.new_cases, m.population,
                     sum(m.new_cases) OVER (PARTITION BY code ORDER BY date
                       ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)
                       AS rolling_cases_last_30_days
              FROM (SELECT k.code, date, count(l.code) AS n_seq_last_30_d
                    FROM (VALUES {", ".join(f"('{c}')" for c in V.SERIES_CODES)}) k(code)
                    CROSS JOIN (SELECT date FROM calendar WHERE date >= DATE '1999-11-01')
                    LEFT JOIN line_list l ON l.code = k.code
                         AND l.collection_date BETWEEN date - 29 AND date
                         AND l.submission_date <= date
                    GROUP BY 1, 2)
              LEFT JOIN (SELECT country_code AS code, date, new_cases, population FROM merged) m
                USING (code, date))
        WHERE date >= DATE '1999-12-01'""",
    "seq_refresh": "SELECT date, n, n_lag_30, round(r, 6) AS r FROM thirty",
    "testing_metrics": f"SELECT code, {TEST_COLUMNS} FROM test_metrics",
    "recent_metrics": f"""
        SELECT {RECENT_COLUMNS}, fam_2_all AS n_lineage, n_sequences,
               seq_before AS total_seq_last_week,
               round({div('100.0 * fam_2_7', 'seq_7')}, 2) AS pct_lineage_last_7_days,
               round({div('100.0 * fam_2_all', 'n_sequences')}, 2) AS pct_lineage_all_time,
               {share('fam_2')} AS pct_seq_last_week
        FROM recent""",
    "recent_with_testing": f"""
        SELECT {RECENT_COLUMNS}, {TEST_COLUMNS},
               round(t7, 6) AS tests_per_100k_in_last_7_days,
               round(t30, 6) AS tests_per_100k_in_last_30_days,
               round(positivity_7, 6) AS positivity_in_last_7_days,
               round(positivity_30, 6) AS positivity_in_last_30_days
        FROM with_tests""",
    "country_summary": f"SELECT * EXCLUDE (country_code) FROM ({family_summary('fam_2')})",
    "country_summary_second_family":
        f"SELECT * EXCLUDE (country_code) FROM ({family_summary('fam_4_5')})",
    "summary_gates": summary_gate_rows("fam_4_5", [
        ("neighbour_sequences_last_week", "total_seq_last_week", V.NEIGHBOUR, 10)]),
    "summary_gates_with_share": summary_gate_rows("fam_2", [
        ("home_lineage_share", "pct_dots", V.HOME, 50)]),
    "line_list_gates": gates([
        ("line_list_age_days", f"{D_ASOF} - max(submission_date)", "<=", 7, "line_list"),
        ("codes_minus_names", "count(DISTINCT code) - count(DISTINCT country)", "=", 0,
         "line_list"),
        ("rows", "count(*)", ">", 0, "line_list")]),
    "series_gates": gates([
        ("case_minus_sequence_countries",
         "count(DISTINCT country_code) - count(DISTINCT country_code) "
         "FILTER (n_new_sequences > 0)", ">", 0, "merged"),
        ("last_sequence_age_days",
         f"{D_ASOF} - max(date) FILTER (n_new_sequences > 0)", "<=", 10, "merged"),
        ("last_sequence_age_days",
         f"{D_ASOF} - max(date) FILTER (n_new_sequences > 0)", "<=", 4, "merged"),
        ("series_age_days", f"{D_ASOF} - max(date)", "=", 1, "merged")]),
    "snapshot_gate": gates([
        ("snapshot_age_days", f"{D_ASOF} - max(CAST(timestamp AS DATE))", "=", 0, "snaps")]),
    "threshold_labels": f"""
        SELECT country_code, x AS max_prevalence_variant_pct, round(log10(raw), 6)
                 AS log10_max_prevalence_variant_pct,
               {label('x', 'cum_tpr')} AS max_prevalence_variant_pct_flags,
               {label('x', 'cum_tpr', '%')} AS max_prevalence_variant_pct_w_pct
        FROM (SELECT country_code, cum_tpr, max_prevalence_variant_pct AS raw,
                     greatest(round(max_prevalence_variant_pct, 2), 0.01) AS x
              FROM with_tests)""",
    "detection_threshold": f"""
        SELECT c_custkey, n, round(raw, 6) AS threshold, {label('x', 'tpr')} AS label,
               {label('x', 'tpr', '%')} AS label_pct,
               CASE WHEN n > 0 THEN 'Yes' ELSE 'No' END AS seen, NULLIF(n, 0) AS n_na,
               CASE WHEN n * 7 = 0 THEN 'No sequences were submitted from last week'
                    WHEN n * 7 < 100 THEN {number('round(tpr, 3)')} || ' %*'
                    ELSE {number('round(tpr, 3)')} || ' %' END AS panel
        FROM (SELECT *, greatest(round(raw, 2), 0.01) AS x, n / 1000.0::DOUBLE AS tpr
              FROM (SELECT c_custkey, count(o_orderkey) AS n,
                           {threshold('count(o_orderkey)')} AS raw
                    FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1))""",
    "reconcile_sources": "SELECT code, cum_seq, confirmed, probable, max_cases FROM reconciled",
    "reconcile_totals": """
        SELECT CAST(coalesce(sum(max_cases), 0) AS BIGINT) AS n_total_cases,
               count(max_cases) AS n_countries_w_cases,
               CAST(coalesce(sum(confirmed), 0) AS BIGINT) AS n_confirmed_cases,
               CAST(coalesce(sum(max_cases), 0) - coalesce(sum(confirmed), 0) AS BIGINT)
                 AS diff_total_and_confirmed,
               CAST(coalesce(sum(cum_seq), 0) AS BIGINT) AS n_seq,
               count(cum_seq) AS n_seq_countries
        FROM reconciled""",
    "reconciled_summary": """
        SELECT s.geometry, latitude, longitude, name AS "Name", r.max_cases, r.max_cases_na,
               r.cum_seq, r.cum_seq_na, r.cases_per_100k_last_7_days
        FROM shapes s LEFT JOIN (
          SELECT country_code, coalesce(max_cases, 0) AS max_cases, max_cases AS max_cases_na,
                 coalesce(cum_seq, 0) AS cum_seq, cum_seq AS cum_seq_na,
                 cases_per_100k_last_7_days
          FROM recent LEFT JOIN reconciled ON country_code = code) r
          ON s.country_code = r.country_code AND s.geometry IS NOT NULL""",
    "snapshots_by_day": f"""
        SELECT date, count(*) AS n_countries_confirmed,
               CAST(sum(confirmed) AS BIGINT) AS n_cases_confirmed
        FROM ({nearest('(SELECT * FROM snap_clock WHERE confirmed IS NOT NULL)',
                       'abs(clock - 13.0)')}) GROUP BY 1""",
    "feed_by_day": """
        SELECT submission_date, count(*) AS n_countries_seq,
               CAST(sum(cum_seq) AS BIGINT) AS n_seq FROM feed_cum GROUP BY 1""",
    "reconcile_daily": "SELECT * FROM rec_daily",
    "global_daily": "SELECT * FROM global_all",
    "global_daily_90": f"""
        SELECT *, CASE WHEN count(*) OVER w = 7 THEN round(sum(n_new_cases) OVER w / 7.0, 2) END
                    AS new_cases_7d_avg,
               CASE WHEN count(*) OVER w = 7 THEN
                 round(CAST(sum(n_new_sequences) OVER w AS DOUBLE) / 7.0, 2) END
                    AS new_seq_7d_avg,
               lag(rolling_cases_last_7_days, 7) OVER (ORDER BY date) AS rolling_cases_lag_7,
               lag(rolling_cases_last_30_days, 30) OVER (ORDER BY date) AS rolling_cases_lag_30
        FROM (SELECT * FROM global_sums WHERE date >= {D_LAST} - 89)
        WINDOW w AS (ORDER BY date ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)""",
    "topline_series": f"""
        SELECT global_all.*, n AS cases_seq_last_30_days,
               n_lag_30 AS cases_seq_last_30_days_lag_30,
               round({div('100.0::DOUBLE * n', 'rolling_cases_last_30_days')}, 1)
                 AS pct_cases_seq_30_day_window
        FROM global_all FULL JOIN thirty USING (date)""",
    "global_series": "SELECT * FROM by_day",
    "topline_table": topline_sql(),
    "cumulative_vaccination": f"""
        SELECT location, date, v AS people_vaccinated,
               {half_up('v / (population / 100.0)', 2)} AS people_vaccinated_per_hundred,
               u AS people_fully_vaccinated,
               {half_up('u / (population / 100.0)', 2)} AS people_fully_vaccinated_per_hundred
        FROM (SELECT *, sum(new_people_vaccinated) OVER w AS v,
                     sum(new_people_fully_vaccinated) OVER w AS u
              FROM case_loaded WINDOW w AS (PARTITION BY location ORDER BY date))""",
    "reported_vaccination": f"""
        SELECT {case_map('iso_code', K.REGION_OF_AGGREGATE_CODE, 'NULL')} AS aggregate_location,
               date, {week('date')} AS collect_weekstartdate, people_vaccinated_per_hundred,
               people_fully_vaccinated_per_hundred
        FROM cases WHERE starts_with(iso_code, 'OWID') AND isodow(date) = 7""",
    "reported_vaccination_daily": f"""
        SELECT {case_map('iso_code', K.REGION_OF_AGGREGATE_CODE, 'NULL')} AS aggregate_location,
               date, {week('date')} AS collect_weekstartdate, people_vaccinated_per_hundred,
               people_fully_vaccinated_per_hundred
        FROM cases WHERE starts_with(iso_code, 'OWID')""",
    "vaccination_overwrite": f"""
        SELECT w.aggregate_location, w.collect_weekstartdate,
               CASE WHEN w.aggregate_location IN (SELECT aggregate_location FROM rep)
                    THEN r.a ELSE w.a END AS people_vaccinated_per_hundred,
               CASE WHEN w.aggregate_location IN (SELECT aggregate_location FROM rep)
                    THEN r.b ELSE w.b END AS people_fully_vaccinated_per_hundred
        FROM (SELECT {title("lower(coalesce(continent, location))")} AS aggregate_location,
                     {week('date')} AS collect_weekstartdate,
                     max(people_vaccinated_per_hundred) AS a,
                     max(people_fully_vaccinated_per_hundred) AS b FROM cases GROUP BY 1, 2) w
        LEFT JOIN rep r USING (aggregate_location, collect_weekstartdate)""",
    "tracker_table": "SELECT doc_id, row, location, confirmed, probable FROM tracker",
    "capture_snapshot": f"""
        SELECT code, date, count(*) AS n_rows, CAST(sum(confirmed) AS BIGINT) AS confirmed,
               CAST(sum(probable) AS BIGINT) AS probable
        FROM (SELECT *, CAST(TIMESTAMP '2001-01-01' + to_hours(doc_id) AS DATE) AS date,
                     {key_of('location')} AS k FROM tracker)
        LEFT JOIN (SELECT name_key, min(code) AS code FROM (
            SELECT {key_of('name')} AS name_key, upper(left(name, 3)) AS code FROM (
              SELECT unnest(regexp_split_to_array(text, '\\s+')) AS name FROM benchmark)
            WHERE name <> '') WHERE name_key <> '' GROUP BY 1) ON k = name_key
        GROUP BY 1, 2""",
    "dashboard_extract": "SELECT * FROM board",
    "dashboard_by_region": """
        SELECT date, who_region, CAST(sum(omicron_variant) AS BIGINT) AS omicron_variant
        FROM board GROUP BY 1, 2""",
    "dashboard_top": "SELECT * FROM board ORDER BY omicron_variant DESC, country LIMIT 4",
    "dashboard_geometry": """
        SELECT board.*, geometry FROM board LEFT JOIN shapes ON iso_code = country_code""",
    "literal_counts": """
        SELECT country, omicron_variant, cases
        FROM (VALUES ('NATION_3', 9), ('NATION_7', 4), ('Elsewhere', 2))
             l(country, omicron_variant)
        JOIN (SELECT location AS country, sum(new_cases) AS cases FROM cases GROUP BY 1)
          USING (country)""",
    "map_attributes": """
        SELECT r.country_code, greatest(round(max_prevalence_variant_pct, 2), 0.01)
                 AS max_prevalence_variant_pct,
               round(log10(max_prevalence_variant_pct), 6) AS log10_max_prevalence_variant_pct,
               p.country AS "NAME", p.region AS "REGION", coalesce(s.cum_seq, 0) AS cum_seq,
               s.cum_seq AS cum_seq_na
        FROM recent r LEFT JOIN nations p ON r.country_code = p.code
        LEFT JOIN (SELECT country, CAST(sum(n) AS BIGINT) AS cum_seq FROM feed GROUP BY 1) s
          ON s.country = p.country""",
    "map_polygons": """
        SELECT CAST(c_nationkey AS VARCHAR) AS id, c_acctbal AS long, c_custkey AS vertex,
               code, p.country AS "NAME", p.region AS "REGION",
               r.sequences_in_last_30_days, s.cum_seq
        FROM customer JOIN nations p ON c_nationkey = n_nationkey
        LEFT JOIN recent r ON r.country_code = p.code
        LEFT JOIN (SELECT country, CAST(sum(n) AS BIGINT) AS cum_seq FROM feed GROUP BY 1) s
          ON s.country = p.country""",
    "flow_table": "SELECT * FROM weekly_flows",
    "flow_diagonal": """
        SELECT * FROM weekly_flows WHERE i = j AND i IN (
          SELECT i FROM (SELECT DISTINCT i FROM weekly_flows)
          ORDER BY md5('7:' || CAST(i AS VARCHAR)), i LIMIT 50)""",
    "state_melt": """
        SELECT country AS "State", variable, value FROM (
          SELECT country, 'Genomes shared' AS variable, CAST(n AS DOUBLE) AS value FROM states
          UNION ALL SELECT country, 'Reported COVID-19 cases', c FROM states
          UNION ALL SELECT country, '% of cases sequenced and shared', pct FROM states
          UNION ALL SELECT country, 'Median days to deposition', med FROM states)""",
    "state_clean_names": """
        SELECT country AS state, format('{:,}', n) AS genomes_shared,
               format('{:,}', c) AS reported_covid_19_cases,
               pct AS percent_of_cases_sequenced_and_shared,
               med AS median_days_to_deposition FROM states""",
    "snake_names": """
        SELECT country AS us_state, format('{:,}', n) AS genomes_shared,
               format('{:,}', c) AS "reported_covid-19_cases",
               med AS median_days_to_deposition FROM states""",
    "topline_carousel": carousel_sql(),
    "metrics_by_type": """
        SELECT 'items' AS type, CAST(count(*) AS DOUBLE) AS n,
               CAST(count(*) FILTER (l_returnflag = 'R') AS DOUBLE) AS change FROM lineitem
        UNION ALL
        SELECT 'orders', count(DISTINCT l_orderkey), max(l_linenumber) FROM lineitem""",
    "trailing_windows": f"""
        SELECT day, count(*) AS n, count(*) FILTER (day >= {D_LAST} - 6) AS n_week,
               count(*) FILTER (day >= {D_LAST} - 29) AS n_month
        FROM {ORDER_DAYS} WHERE day BETWEEN {D_LAST} - 89 AND {D_LAST} GROUP BY 1""",
    "days_picked": f"""
        SELECT o_orderkey, day FROM {ORDER_DAYS} WHERE day IN ({D_LAST}, {D_LAST} - 6)""",
    "calendar_bounds": f"""
        SELECT o_orderkey, day FROM {ORDER_DAYS}
        WHERE day BETWEEN DATE '1999-01-01' AND DATE '1999-12-31'""",
    "up_to_latest": """
        SELECT CAST(l_shipdate AS DATE) AS day, count(*) AS n FROM lineitem
        GROUP BY 1 HAVING day <= (SELECT max(CAST(o_orderdate AS DATE)) FROM orders)""",
    "sundays_only": f"SELECT o_orderkey, day FROM {ORDER_DAYS} WHERE isodow(day) = 7",
    "null_rows_removed": """
        SELECT iso_code, date, continent, people_vaccinated FROM cases
        WHERE continent IS NOT NULL AND people_vaccinated IS NOT NULL""",
    "sampled_keys": """
        SELECT o_custkey, o_orderkey FROM orders WHERE o_custkey IN (
          SELECT o_custkey FROM (SELECT DISTINCT o_custkey FROM orders)
          ORDER BY md5('3:' || CAST(o_custkey AS VARCHAR)), o_custkey LIMIT 20)""",
    "columns_reshaped": """
        SELECT country AS seq_country, count(lag_days) AS seq_n,
               quantile_cont(CAST(lag_days AS DOUBLE), 0.5) AS lagdays_median,
               min(lag_days) AS lagdays_min, max(lag_days) AS lagdays_max
        FROM clean_list GROUP BY 1""",
    "rows_bound": """
        SELECT c_name AS name, c_acctbal AS balance, NULL AS nation FROM customer
        UNION ALL SELECT s_name, NULL, s_nationkey FROM supplier""",
    "distinct_rows": """
        SELECT DISTINCT CAST(ts AS DATE) AS day, event_type, user_id FROM events""",
    "first_per_key": """
        SELECT user_id, ts, event_id, event_type FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1""",
    "sorted_series": "SELECT country, code, submission_date, n FROM feed",
}

VIEWS["rep"] = f"""
    SELECT {case_map('iso_code', K.REGION_OF_AGGREGATE_CODE, 'NULL')} AS aggregate_location,
           {week('date')} AS collect_weekstartdate, people_vaccinated_per_hundred AS a,
           people_fully_vaccinated_per_hundred AS b
    FROM cases WHERE starts_with(iso_code, 'OWID') AND isodow(date) = 7"""


def needed(body: str) -> list[str]:
    """View names the text depends on, dependencies first."""
    out: list[str] = []

    def visit(text: str) -> None:
        for name, sql_text in VIEWS.items():
            if name not in out and re.search(rf"\b{name}\b", text):
                visit(sql_text)
                if name not in out:
                    out.append(name)

    visit(body)
    return out


def full(body: str) -> str:
    names = needed(body)
    if not names:
        return body
    head = "WITH " + ", ".join(f"{n} AS ({VIEWS[n]})" for n in names)
    tail = body.strip()
    return f"{head} {tail}" if tail.startswith(",") else f"{head} {tail}"


def sql() -> dict[str, str]:
    return {name: full(body) for name, body in QUERIES.items()}
