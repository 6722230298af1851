"""SQL for DuckDB, one query per registered check, written apart from the library.

The views join every table of a role at once, whichever columns a query uses.
"""

from __future__ import annotations

from tallyfield.sources.schemas import INCIDENTS

INCIDENT = """
incident AS (
  SELECT e.event_id AS ID, e.ts AS Start_Time, n.n_name AS State, e.user_id AS Zipcode,
         e.user_id AS City, e.event_type AS Street, e.event_type AS Weather_Condition,
         e.value AS Visibility, e.event_type = 'error' AS Stop,
         e.event_type = 'purchase' AS Traffic_Signal,
         CAST(json_extract_string(e.props, '$.k') AS INTEGER) % 4 + 1 AS Severity
  FROM events e
  JOIN customer c ON e.user_id = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

PERSON = """
person AS (
  SELECT l.l_orderkey AS SERIALNO, c.c_nationkey AS ST, CAST(l.l_quantity AS INTEGER) AS AGEP,
         l.l_quantity AS WKHP, l.l_quantity AS JWMNP,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) AS WAGP,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) AS PINCP,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) AS POVPIP,
         CAST(round((1 + l.l_tax) * 1000000) AS INTEGER) AS ADJINC,
         CASE l.l_returnflag WHEN 'A' THEN 1 WHEN 'R' THEN 2 WHEN 'N' THEN 3 END AS SEX,
         CASE l.l_linestatus WHEN 'O' THEN 1 ELSE 2 END AS NATIVITY,
         CASE l.l_linestatus WHEN 'O' THEN 1 ELSE 2 END AS WRK,
         l.l_linenumber AS NOP, p.p_size AS SCHL, p.p_brand AS OCCP,
         CASE p.p_type WHEN 'ECONOMY' THEN 1 WHEN 'LARGE' THEN 2 WHEN 'MEDIUM' THEN 3
              WHEN 'PROMO' THEN 4 WHEN 'SMALL' THEN 5 WHEN 'STANDARD' THEN 6 ELSE 0 END AS INDP,
         CAST(left(o.o_orderpriority, 1) AS INTEGER) AS MAR,
         CASE o.o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN 2 WHEN 'P' THEN 3 END AS ESR,
         CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 1 WHEN 'BUILDING' THEN 2
              WHEN 'FURNITURE' THEN 3 WHEN 'HOUSEHOLD' THEN 4 WHEN 'MACHINERY' THEN 5 END AS RAC1P
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN part p ON l.l_partkey = p.p_partkey)"""

COVERAGE = """
coverage AS (
  SELECT n.n_name AS StateAbbr, s.s_name AS ProviderName, l.l_quantity AS MaxAdDown,
         CASE l.l_returnflag WHEN 'A' THEN 0 ELSE 1 END AS Consumer,
         CASE l.l_linestatus WHEN 'O' THEN 1 ELSE 0 END AS Business
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey)"""

STATE = "state AS (SELECT n_nationkey AS ST, n_name AS StateAbbr FROM nation)"


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts) + "\n"


def _mean(column: str) -> str:
    """Exact mean of a decimal column."""
    return f"CAST(sum({column}) AS DOUBLE) / count({column})"


def _round2(value: str) -> str:
    """Half up on the decimal digits, as Spark rounds."""
    return f"CAST(round(CAST({value} AS DECIMAL(38,10)), 2) AS DOUBLE)"


SPEED = "speed AS (SELECT StateAbbr, avg(MaxAdDown) AS mean FROM coverage GROUP BY ALL)"

SQL: dict[str, str] = {}

SQL["a1_peak_hours_by_state"] = _with(INCIDENT) + """
SELECT State, Hour, incident_count, rank FROM (
  SELECT State, CAST(hour(Start_Time) AS INTEGER) AS Hour, count(*) AS incident_count,
         CAST(rank() OVER (PARTITION BY State ORDER BY count(*) DESC) AS INTEGER) AS rank
  FROM incident GROUP BY 1, 2)
WHERE rank <= 3"""

SQL["a2_weekend_share_by_state"] = _with(INCIDENT) + """
SELECT State,
       CAST(count(*) FILTER (WHERE dayofweek(Start_Time) IN (0, 6)) AS DOUBLE)
         / count(*) * 100 AS weekend_percentage
FROM incident GROUP BY State"""

SQL["a3_nearby_incident_pairs"] = _with(INCIDENT) + """
SELECT a.Zipcode, a.ID AS Accident_A_ID, a.Street AS Accident_A_Street,
       b.ID AS Accident_B_ID, b.Street AS Accident_B_Street
FROM incident a JOIN incident b
  ON a.Zipcode = b.Zipcode AND a.Street <> b.Street AND a.ID < b.ID
 AND abs(epoch_us(a.Start_Time) // 1000000 - epoch_us(b.Start_Time) // 1000000) < 86400"""

SQL["a4_low_visibility_share_by_state"] = _with(INCIDENT) + """
SELECT State,
       CAST(count(*) FILTER (WHERE Visibility < 5) AS DOUBLE)
         / count(*) * 100 AS low_visibility_percentage
FROM incident WHERE Visibility IS NOT NULL GROUP BY State"""

SQL["a5_cities_with_both_conditions"] = _with(INCIDENT) + """
SELECT DISTINCT City, State FROM (
  SELECT City, State, CAST(Start_Time AS DATE) AS day
  FROM incident GROUP BY ALL
  HAVING bool_or(Weather_Condition LIKE '%err%') AND bool_or(Weather_Condition LIKE '%sign%'))"""

SQL["a6_stop_and_signal_counts"] = _with(INCIDENT) + """
SELECT count(*) FILTER (WHERE Stop) AS stop_sign_accidents,
       count(*) FILTER (WHERE Traffic_Signal) AS traffic_signal_accidents
FROM incident"""

SQL["d1_poverty_by_marital_status"] = _with(PERSON) + f"""
SELECT Marital_Status, NOP, {_round2('mean')} AS avg_poverty_ratio,
       CAST(rank() OVER (PARTITION BY Marital_Status ORDER BY mean DESC) AS INTEGER) AS rank
FROM (
  SELECT CASE MAR WHEN 1 THEN 'Married' WHEN 2 THEN 'Widowed' WHEN 3 THEN 'Divorced'
              WHEN 4 THEN 'Separated' WHEN 5 THEN 'Never married' ELSE 'Unknown' END
           AS Marital_Status, NOP, {_mean('POVPIP')} AS mean
  FROM person GROUP BY MAR, NOP)"""

SQL["d2_poverty_by_group"] = _with(PERSON) + f"""
SELECT CASE SEX WHEN 1 THEN 'Male' WHEN 2 THEN 'Female' ELSE 'Unknown' END AS SEX_Label,
       CASE RAC1P WHEN 1 THEN 'White' WHEN 2 THEN 'Black or African American'
            WHEN 3 THEN 'American Indian or Alaska Native' WHEN 4 THEN 'Asian'
            WHEN 5 THEN 'Native Hawaiian or Pacific Islander' ELSE 'Unknown' END AS RAC1P_Label,
       CASE ESR WHEN 1 THEN 'Employed - at work' WHEN 2 THEN 'Employed - not at work'
            WHEN 3 THEN 'Unemployed' ELSE 'Unknown' END AS ESR_Label,
       {_round2(_mean('POVPIP'))} AS avg_poverty_ratio
FROM person GROUP BY 1, 2, 3"""

SQL["d3_income_by_industry_and_nativity"] = _with(PERSON) + f"""
SELECT INDP, NATIVITY, avg_income,
       CAST(rank() OVER (PARTITION BY INDP ORDER BY avg_income DESC) AS INTEGER) AS rank
FROM (SELECT INDP, NATIVITY, {_round2(_mean('PINCP'))} AS avg_income FROM person GROUP BY ALL)"""

SQL["d4_income_per_hour_by_industry"] = _with(PERSON) + f"""
SELECT INDP, avg_income, avg_hours, {_round2('avg_income / avg_hours')} AS income_per_hour
FROM (SELECT INDP, {_mean('WAGP')} AS avg_income, {_mean('WKHP')} AS avg_hours
      FROM person WHERE WAGP IS NOT NULL AND WKHP > 0 GROUP BY INDP)"""

SQL["d5_bad_weather_rate_by_age"] = _with(INCIDENT, PERSON, STATE) + f"""
, population AS (
  SELECT StateAbbr AS State,
         CASE WHEN AGEP < 25 THEN '18-24' WHEN AGEP < 40 THEN '25-39'
              WHEN AGEP < 60 THEN '40-59' ELSE '60+' END AS Age_Group, count(*) AS n
  FROM person JOIN state USING (ST) GROUP BY 1, 2),
bad AS (
  SELECT State, Weather_Condition, count(*) AS n FROM incident
  WHERE regexp_matches(Weather_Condition, 'err|click', 'i') GROUP BY ALL)
SELECT State, Age_Group, Weather_Condition,
       {_round2('CAST(bad.n AS DOUBLE) / population.n * 1000')} AS Accidents_per_1000_people
FROM bad JOIN population USING (State)"""

SQL["d6_incident_rate_by_sex"] = _with(INCIDENT, PERSON, STATE) + f"""
, population AS (
  SELECT StateAbbr AS State, SEX, count(*) AS n FROM person JOIN state USING (ST) GROUP BY 1, 2),
crashes AS (SELECT State, count(*) AS n FROM incident GROUP BY State),
rates AS (
  SELECT State,
         CASE SEX WHEN 1 THEN 'Male' WHEN 2 THEN 'Female' ELSE 'Unknown' END AS Sex_Label,
         {_round2('CAST(crashes.n AS DOUBLE) / population.n * 1000')} AS Accidents_per_1000
  FROM crashes JOIN population USING (State))
SELECT * FROM (
  SELECT *, CAST(rank() OVER (PARTITION BY Sex_Label ORDER BY Accidents_per_1000 DESC)
                 AS INTEGER) AS Rank FROM rates)
WHERE Rank <= 10"""

SQL["x1_severity_by_visibility"] = _with(INCIDENT) + """
SELECT CASE WHEN Visibility < 1 THEN 'Low (<1 mi)' WHEN Visibility < 5 THEN 'Moderate (1-5 mi)'
            ELSE 'High (>5 mi)' END AS Visibility_Category,
       avg(Severity) AS Avg_Severity, count(*) AS Accident_Count
FROM incident WHERE Visibility IS NOT NULL GROUP BY 1"""

SQL["x2_risk_index_by_state"] = _with(INCIDENT) + """
SELECT State, avg(Severity) AS Avg_Severity, count(*) AS Accident_Count,
       avg(Severity) + CAST(count(*) AS DOUBLE) / 10000 AS Risk_Index
FROM incident GROUP BY State"""

SQL["x3_education_and_severity"] = _with(INCIDENT, PERSON, STATE) + """
SELECT State, Avg_Education, Avg_Severity
FROM (SELECT State, avg(Severity) AS Avg_Severity FROM incident GROUP BY State)
JOIN (SELECT StateAbbr AS State, avg(SCHL) AS Avg_Education
      FROM person JOIN state USING (ST) GROUP BY 1) USING (State)"""

SQL["x4_long_hours_and_incidents"] = _with(INCIDENT, PERSON, STATE) + """
SELECT State, Total_Accidents, Avg_Work_Hours
FROM (SELECT State, count(*) AS Total_Accidents FROM incident GROUP BY State)
JOIN (SELECT StateAbbr AS State, avg(WKHP) AS Avg_Work_Hours
      FROM person JOIN state USING (ST) GROUP BY 1) USING (State)
WHERE Avg_Work_Hours > 25.4"""

SQL["x5_top_weather_by_state"] = _with(INCIDENT) + """
SELECT * FROM (
  SELECT State, Weather_Condition, count(*) AS Weather_Count,
         CAST(rank() OVER (PARTITION BY State ORDER BY count(*) DESC) AS INTEGER) AS Weather_Rank
  FROM incident GROUP BY 1, 2)
WHERE Weather_Rank <= 3"""

SQL["x6_young_income_rank"] = _with(PERSON, STATE) + """
SELECT StateAbbr, AGEP, Adjusted_Income,
       rank() OVER (PARTITION BY StateAbbr ORDER BY Adjusted_Income DESC NULLS LAST)
         AS Income_Rank_in_State
FROM (SELECT StateAbbr, AGEP,
             CAST(PINCP AS DOUBLE) * CAST(ADJINC AS DOUBLE) / 1000000 AS Adjusted_Income
      FROM person JOIN state USING (ST) WHERE AGEP < 40)"""

SQL["n1_average_salary_by_speed"] = _with(PERSON, COVERAGE, STATE, SPEED) + f"""
SELECT CASE WHEN mean > 25.4 THEN 'fast_internet' ELSE 'slow_internet' END AS speed_tier,
       {_mean('WAGP')} AS average_salary
FROM person JOIN state USING (ST) JOIN speed USING (StateAbbr)
WHERE WAGP > 0 GROUP BY 1"""

SQL["n2_top_professions_by_education"] = _with(PERSON) + f"""
SELECT * FROM (
  SELECT SCHL, OCCP, avg_income,
         CAST(rank() OVER (PARTITION BY SCHL ORDER BY avg_income DESC) AS INTEGER) AS rank
  FROM (SELECT SCHL, OCCP, {_mean('PINCP')} AS avg_income
        FROM person WHERE PINCP > 0 AND OCCP IS NOT NULL GROUP BY ALL))
WHERE rank <= 3"""

SQL["n3_commute_time_by_business_coverage"] = _with(PERSON, COVERAGE, STATE) + """
, business AS (SELECT StateAbbr, avg(Business) AS mean FROM coverage GROUP BY ALL)
SELECT CASE WHEN mean > 0.5 THEN 'high_biz_internet' ELSE 'low_biz_internet' END AS internet_tier,
       avg(JWMNP) AS average_commute_time
FROM person JOIN state USING (ST) JOIN business USING (StateAbbr)
WHERE WRK = 1 AND JWMNP > 0 GROUP BY 1"""

SQL["n4_income_against_peers"] = _with(PERSON) + f"""
, adult AS (
  SELECT *, CASE WHEN AGEP BETWEEN 18 AND 25 THEN '18-25' WHEN AGEP BETWEEN 26 AND 35 THEN '26-35'
                 WHEN AGEP BETWEEN 36 AND 45 THEN '36-45' WHEN AGEP BETWEEN 46 AND 55 THEN '46-55'
                 WHEN AGEP >= 56 THEN '56+' END AS age_group
  FROM person WHERE PINCP > 0 AND AGEP >= 18),
peers AS (SELECT ST, age_group, {_mean('PINCP')} AS avg_group_income FROM adult GROUP BY ALL)
SELECT SERIALNO, ST, age_group, CAST(PINCP AS DOUBLE) AS PINCP, avg_group_income,
       CAST(PINCP AS DOUBLE) - avg_group_income AS income_deviation
FROM adult JOIN peers USING (ST, age_group)"""

SQL["n5_providers_and_income"] = _with(PERSON, COVERAGE, STATE) + f"""
SELECT ST, StateAbbr, avg_income, provider_count
FROM (SELECT ST, {_mean('PINCP')} AS avg_income FROM person WHERE PINCP > 0 GROUP BY ST)
JOIN state USING (ST)
JOIN (SELECT StateAbbr, count(DISTINCT ProviderName) AS provider_count
      FROM coverage GROUP BY ALL) USING (StateAbbr)"""

SQL["n6_income_and_speed_gaps"] = _with(PERSON, COVERAGE, STATE) + """
SELECT StateAbbr, ST, income_gap, speed_gap
FROM (SELECT ST, CAST(quantile_disc(PINCP, 0.9) - quantile_disc(PINCP, 0.1) AS DOUBLE)
        AS income_gap FROM person WHERE PINCP > 0 GROUP BY ST)
JOIN state USING (ST)
JOIN (SELECT StateAbbr, quantile_disc(MaxAdDown, 0.9) - quantile_disc(MaxAdDown, 0.1) AS speed_gap
      FROM coverage WHERE MaxAdDown > 0 GROUP BY ALL) USING (StateAbbr)"""

SQL["n7_top_providers_by_state"] = _with(COVERAGE) + """
, provider AS (
  SELECT StateAbbr, ProviderName, avg(MaxAdDown) AS avg_down_mbps,
         CAST(sum(Consumer) AS BIGINT) AS consumers FROM coverage GROUP BY ALL),
total AS (SELECT StateAbbr, sum(consumers) AS n FROM provider GROUP BY ALL),
ranked AS (
  SELECT StateAbbr, ProviderName, avg_down_mbps, consumers,
         CAST(consumers AS DOUBLE) / CAST(n AS DOUBLE) AS share,
         CAST(row_number() OVER (PARTITION BY StateAbbr ORDER BY
           CAST(consumers AS DOUBLE) / CAST(n AS DOUBLE) DESC, avg_down_mbps DESC, ProviderName)
           AS INTEGER) AS rank_in_state
  FROM provider JOIN total USING (StateAbbr) WHERE consumers >= 10)
SELECT *, sum(share) OVER (PARTITION BY StateAbbr ORDER BY rank_in_state
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cumulative_share
FROM ranked WHERE rank_in_state <= 3"""

SQL["n8_digital_resilience_index"] = _with(PERSON, COVERAGE, STATE) + """
, speed AS (SELECT StateAbbr, avg(MaxAdDown) AS avg_speed FROM coverage GROUP BY ALL),
income AS (
  SELECT StateAbbr, CAST(quantile_disc(WAGP, 0.5) AS DOUBLE) AS median_income
  FROM person JOIN state USING (ST) WHERE AGEP BETWEEN 25 AND 64 AND WAGP > 0 GROUP BY ALL),
education AS (
  SELECT StateAbbr, CAST(count(*) FILTER (WHERE SCHL < 21) AS DOUBLE) / count(*) AS low_edu_share
  FROM person JOIN state USING (ST) WHERE AGEP BETWEEN 25 AND 64 GROUP BY ALL),
base AS (
  SELECT *, min(avg_speed) OVER () AS s0, max(avg_speed) OVER () AS s1,
         min(median_income) OVER () AS i0, max(median_income) OVER () AS i1,
         min(low_edu_share) OVER () AS e0, max(low_edu_share) OVER () AS e1
  FROM speed JOIN income USING (StateAbbr) JOIN education USING (StateAbbr)),
scored AS (
  SELECT StateAbbr, avg_speed, median_income, low_edu_share,
         CAST(0.4 AS DOUBLE) * CASE WHEN s1 = s0 THEN 0.5 ELSE (avg_speed - s0) / (s1 - s0) END
         + CAST(0.3 AS DOUBLE)
             * CASE WHEN i1 = i0 THEN 0.5 ELSE (median_income - i0) / (i1 - i0) END
         + CAST(0.3 AS DOUBLE)
             * (1 - CASE WHEN e1 = e0 THEN 0.5 ELSE (low_edu_share - e0) / (e1 - e0) END)
           AS digital_resilience_index
  FROM base)
SELECT *, CAST(dense_rank() OVER (ORDER BY digital_resilience_index DESC) AS INTEGER) AS rank
FROM scored"""

SQL["n9_gender_pay_gap"] = _with(PERSON, COVERAGE, STATE, SPEED) + f"""
, gaps AS (
  SELECT StateAbbr, CASE WHEN mean > 25.4 THEN 'fast_internet' ELSE 'slow_internet' END
           AS speed_tier,
         {_mean('CASE WHEN SEX = 1 THEN WAGP END')} AS male_avg,
         {_mean('CASE WHEN SEX = 2 THEN WAGP END')} AS female_avg, count(*) AS total_n
  FROM person JOIN state USING (ST) JOIN speed USING (StateAbbr)
  WHERE WAGP > 0 AND AGEP BETWEEN 25 AND 64 AND SEX IN (1, 2) GROUP BY 1, 2)
SELECT StateAbbr, speed_tier, male_avg, female_avg, male_avg - female_avg AS gender_gap, total_n,
       CAST(dense_rank() OVER (PARTITION BY speed_tier
              ORDER BY male_avg - female_avg DESC NULLS LAST) AS INTEGER) AS rank_in_tier
FROM gaps WHERE total_n >= 600"""

SQL["n10_provider_national_champions"] = _with(COVERAGE) + """
, provider AS (
  SELECT StateAbbr, ProviderName, sum(Consumer) AS consumers FROM coverage GROUP BY ALL),
share AS (
  SELECT StateAbbr, ProviderName,
         CAST(consumers AS DOUBLE)
           / CAST(sum(consumers) OVER (PARTITION BY StateAbbr) AS DOUBLE) AS share
  FROM provider),
leader AS (
  SELECT * FROM share
  QUALIFY dense_rank() OVER (PARTITION BY StateAbbr ORDER BY share DESC) = 1)
SELECT ProviderName, count(DISTINCT StateAbbr) AS states_as_no1,
       round(avg(share), 9) AS avg_top_share,
       string_agg(StateAbbr, ',' ORDER BY StateAbbr) AS states_list
FROM leader WHERE share >= CAST(0.016 AS DOUBLE) GROUP BY ProviderName"""

SQL["n11_subthreshold_pool_by_provider"] = _with(COVERAGE) + """
, provider AS (
  SELECT StateAbbr, ProviderName, CAST(sum(Consumer) AS BIGINT) AS provider_cons,
         CAST(sum(CASE WHEN MaxAdDown < 25 THEN Consumer ELSE 0 END) AS BIGINT) AS subx_consumers
  FROM coverage GROUP BY ALL HAVING sum(Consumer) > 0),
share AS (
  SELECT StateAbbr, ProviderName, subx_consumers, provider_cons,
         CAST(subx_consumers AS DOUBLE) / CAST(provider_cons AS DOUBLE) AS subx_share,
         CAST(provider_cons AS DOUBLE)
           / CAST(sum(provider_cons) OVER (PARTITION BY StateAbbr) AS DOUBLE) AS state_share
  FROM provider)
SELECT *, CAST(dense_rank() OVER (PARTITION BY StateAbbr ORDER BY subx_consumers DESC) AS INTEGER)
         AS rank_in_state
FROM share WHERE state_share >= CAST(0.01 AS DOUBLE)"""

SQL["n12_affordability_gap_states"] = _with(PERSON, COVERAGE, STATE) + """
, speed AS (SELECT StateAbbr, avg(MaxAdDown) AS state_avg_mbps FROM coverage GROUP BY ALL),
income AS (
  SELECT StateAbbr, CAST(quantile_disc(WAGP, 0.5) AS DOUBLE) AS median_wagp,
         count(*) AS adult_pop
  FROM person JOIN state USING (ST) WHERE WAGP > 0 AND AGEP BETWEEN 25 AND 64 GROUP BY ALL),
base AS (SELECT * FROM speed JOIN income USING (StateAbbr)),
median AS (
  SELECT quantile_disc(state_avg_mbps, 0.5) AS s, quantile_disc(median_wagp, 0.5) AS i FROM base),
scored AS (
  SELECT StateAbbr, state_avg_mbps, median_wagp, adult_pop,
         (state_avg_mbps - s) / s * ln(1 + adult_pop) AS score
  FROM base, median WHERE state_avg_mbps > s AND median_wagp < i)
SELECT StateAbbr, state_avg_mbps, median_wagp, adult_pop,
       round(score, 9) AS affordability_gap_score,
       CAST(dense_rank() OVER (ORDER BY score DESC) AS INTEGER) AS rank
FROM scored"""


def _profile(view: str, columns: list[str]) -> str:
    names = {"Visibility": "Visibility(mi)"}
    return "\nUNION ALL\n".join(
        f"SELECT '{names.get(c, c)}' AS column_name, count({c}) AS n, round({_mean(c)}, 6) AS mean, "
        f"round(stddev_samp({c}), 6) AS stddev, CAST(min({c}) AS DOUBLE) AS min, "
        f"CAST(max({c}) AS DOUBLE) AS max FROM {view}"
        for c in columns
    )


SQL["profile_persons"] = _with(PERSON) + _profile(
    "person",
    ["SERIALNO", "AGEP", "WKHP", "JWMNP", "WAGP", "PINCP", "POVPIP", "ADJINC", "SEX", "NATIVITY",
     "WRK", "NOP", "SCHL", "INDP", "MAR", "ESR", "RAC1P", "ST"],
)
SQL["profile_incidents"] = _with(INCIDENT) + _profile(
    "incident", ["ID", "Severity", "Zipcode", "City", "Visibility"]
)
SQL["profile_coverage"] = _with(COVERAGE) + _profile(
    "coverage", ["MaxAdDown", "Consumer", "Business"]
)
SQL["dataset_sizes"] = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS dataset, count(*) AS n_rows, (SELECT CAST(count(*) AS INTEGER) FROM "
    f"information_schema.columns WHERE table_name = '{t}') AS n_columns FROM {t}"
    for t in ("events", "lineitem", "orders", "customer")
)
SQL["parsed_times_and_numbers"] = """
SELECT ID, CAST(Start_Time AS VARCHAR) AS Start_Time, k FROM (
  SELECT event_id AS ID, date_trunc('second', ts) AS Start_Time,
         TRY_CAST(CASE WHEN event_type = 'error' THEN event_type
                       ELSE json_extract_string(props, '$.k') END AS DOUBLE) AS k
  FROM events)"""
SQL["union_of_parties"] = """
SELECT state, count(*) AS n, CAST(sum(CAST(balance AS DECIMAL(18,2))) AS DOUBLE) AS balance
FROM (SELECT c_nationkey AS state, c_acctbal AS balance FROM customer
      UNION ALL SELECT s_nationkey, s_acctbal FROM supplier)
GROUP BY state"""

# Lines with a bad cell, and with a field too many or too few.
_BAD = {"Severity": (50, 7), "Visibility(mi)": (60, 11), "Stop": (40, 3)}
_MISSHAPEN = "event_id % 90 = 5 OR event_id % 80 = 9"
_SHORT = "event_id % 80 = 9"


def _rejects(columns: list[str]) -> str:
    bad = {c: f"event_id % {n} = {r}" for c, (n, r) in _BAD.items()}
    counts = {
        **{c: f"count(*) FILTER (WHERE {bad.get(c, 'false')})" for c in columns},
        "(rows)": "count(*)",
        "(rejected rows)": f"count(*) FILTER (WHERE {' OR '.join(bad.values())} OR {_MISSHAPEN})",
        "(misshapen rows)": f"count(*) FILTER (WHERE {_MISSHAPEN})",
    }
    return "\nUNION ALL\n".join(f"SELECT '{c}' AS column_name, {n} AS n FROM events" for c, n in counts.items())


SQL["csv_rejects"] = _rejects(INCIDENTS.names)
SQL["csv_read_back"] = f"""
SELECT Weather_Condition, count(*) AS n, count(*) FILTER (WHERE whole) AS n_whole,
       CAST(sum(severity) AS BIGINT) AS severity, CAST(sum(visibility) AS DOUBLE) AS visibility,
       count(*) FILTER (WHERE stop) AS stops,
       CAST(sum(chars) AS BIGINT) AS description_chars, max(start) AS last_start
FROM (
  SELECT CASE WHEN NOT {_SHORT} THEN event_type END AS Weather_Condition,
         NOT ({' OR '.join(f'event_id % {n} = {r}' for n, r in _BAD.values())} OR {_MISSHAPEN}) AS whole,
         CASE WHEN event_id % 50 <> 7 THEN event_id % 4 + 1 END AS severity,
         CASE WHEN NOT {_SHORT} AND event_id % 60 <> 11 THEN CAST(value AS DECIMAL(12,2)) END AS visibility,
         NOT {_SHORT} AND event_id % 40 <> 3 AND event_type = 'error' AS stop,
         CASE WHEN NOT {_SHORT} THEN length(props) END AS chars,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS start
  FROM events) GROUP BY ALL"""

_WORKING = " AND AGEP BETWEEN 25 AND 64"
SQL["n7_providers_with_min_share"] = SQL["n7_top_providers_by_state"].replace(
    "WHERE consumers >= 10", "WHERE consumers >= 10 AND CAST(consumers AS DOUBLE) / CAST(n AS DOUBLE) >= CAST(0.012 AS DOUBLE)"
)
SQL["n9_gender_pay_gap_all_ages"] = SQL["n9_gender_pay_gap"].replace(_WORKING, "")
SQL["n12_affordability_gap_all_ages"] = SQL["n12_affordability_gap_states"].replace(_WORKING, "")


def _with_gaps(name: str, *columns: str) -> str:
    """The same over persons of whom every seventh has NULL in the columns."""
    gaps = ", ".join(f"CASE WHEN SERIALNO % 7 <> 0 THEN {c} END AS {c}" for c in columns)
    person = PERSON.strip()
    query = SQL[name].replace("FROM person", "FROM gap")
    return query.replace(person, f"{person},\ngap AS (SELECT * REPLACE ({gaps}) FROM person)")


SQL["d2_poverty_by_group_with_nulls"] = _with_gaps("d2_poverty_by_group", "ESR", "POVPIP").replace(
    "FROM gap", "FROM gap WHERE POVPIP IS NOT NULL"  # a group without any ratio is no group
)
SQL["x6_young_income_rank_with_nulls"] = _with_gaps("x6_young_income_rank", "PINCP")
SQL["n4_income_against_peers_with_nulls"] = _with_gaps("n4_income_against_peers", "ST").replace(
    "SELECT SERIALNO, ST, age_group,", "SELECT SERIALNO, adult.ST, adult.age_group,"
).replace(
    "JOIN peers USING (ST, age_group)",
    "JOIN peers ON adult.ST IS NOT DISTINCT FROM peers.ST AND adult.age_group = peers.age_group",
)
