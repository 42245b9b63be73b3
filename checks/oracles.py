"""The same results in DuckDB SQL over the same tables.

Rounding goes through the shortest decimal text, as DuckDB rounds doubles in
binary and Spark rounds their decimal form.
"""

from checks.tables import (
    BEYOND_32_BITS,
    DISEASE,
    EARLY,
    FIRST_NATION_OFF_THE_MAP,
    FIRST_TEST_YEAR,
    LATE,
    NO_POPULATION_NATION,
    ZERO_POPULATION_NATION,
)


def _round(value: str, digits: int) -> str:
    return (
        f"CAST(round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38,20)), {digits}) AS DOUBLE)"
    )


_LINES = """
lines AS (
  SELECT *, p_brand AS Disease, n_name AS Nation, CAST(year(o_orderdate) AS INTEGER) AS Year,
         CASE l_returnflag WHEN 'A' THEN 'Male' WHEN 'N' THEN 'Female' ELSE 'Total' END AS Sex
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN part ON l_partkey = p_partkey)"""

_RATE = f"""CASE WHEN Population > 0
  THEN {_round("CAST(Count AS DOUBLE) / CAST(Population AS DOUBLE) * 100000", 3)}
  ELSE CAST(0 AS DOUBLE) END"""

_CASES = f"""WITH {_LINES},
pop AS (
  SELECT n_name AS County,
         CASE n_nationkey WHEN {ZERO_POPULATION_NATION} THEN 0
              WHEN {NO_POPULATION_NATION} THEN NULL
              ELSE 1000 * count(c_custkey) END AS Population
  FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey
  GROUP BY n_name, n_nationkey),
county AS (
  SELECT b.Disease, b.Nation AS County, b.Year, b.Sex, b.Count,
         CAST(p.Population AS BIGINT) AS Population
  FROM (SELECT Disease, Nation, Year, Sex, CAST(sum(l_quantity) AS BIGINT) AS Count
        FROM lines GROUP BY ALL) b
  JOIN pop p ON b.Nation = p.County),
both_levels AS (
  SELECT * FROM county
  UNION ALL
  SELECT Disease, 'California', Year, Sex, CAST(sum(Count) AS BIGINT),
         CAST(sum(Population) AS BIGINT)
  FROM county GROUP BY Disease, Year, Sex),
f AS (SELECT *, {_RATE} AS Recalculated_Rate FROM both_levels),
V AS (SELECT * FROM f WHERE County <> 'California')"""

_BRAND_NUMBER = "CAST(substr(Disease, 7) AS INTEGER)"


def _banded(source):
    return f"""
guess AS (
  SELECT *, Recalculated_Rate * ({_BRAND_NUMBER} % 5) / 20 - 1 AS prediction FROM {source}),
rounded AS (
  SELECT *, CASE WHEN prediction < 0 THEN CAST(0 AS DOUBLE)
                 ELSE {_round("prediction", 2)} END AS Predicted_Rate FROM guess),
banded AS (
  SELECT * EXCLUDE (prediction),
         CASE WHEN Predicted_Rate <= 5 THEN 'Basse Priorite'
              WHEN Predicted_Rate <= 50 THEN 'Moyenne Priorite'
              ELSE 'Haute Priorite' END AS Priority_Level
  FROM rounded)"""


_BANDED = f"{_CASES}, {_banded('V')}"

_RISK = f"""{_BANDED},
risk_means AS (
  SELECT Disease, Year, County, avg(Predicted_Rate) AS mean_predicted,
         avg(Population) AS mean_population, avg(Recalculated_Rate) AS mean_observed,
         CAST(sum(Count) AS BIGINT) AS Cases
  FROM banded GROUP BY Disease, Year, County),
risk AS (
  SELECT Disease, Year, County, {_round("mean_predicted", 6)} AS Predicted_Rate,
         {_round("mean_population", 6)} AS Population,
         {_round("mean_observed", 6)} AS Observed_Rate, Cases,
         CASE WHEN mean_predicted <= 5 THEN 'Basse Priorite'
              WHEN mean_predicted <= 50 THEN 'Moyenne Priorite'
              ELSE 'Haute Priorite' END AS Priority_Level
  FROM risk_means)"""

_RAW = f"""WITH {_LINES},
raw AS (
  SELECT CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS Id, Disease,
         CASE l_linenumber WHEN 6 THEN 'California' WHEN 5 THEN NULL ELSE Nation END AS County,
         Year, Sex,
         CASE l_linenumber WHEN 2 THEN NULL
              WHEN 7 THEN CAST(l_quantity AS BIGINT) + {BEYOND_32_BITS}
              ELSE CAST(l_quantity AS BIGINT) END AS Count,
         CASE l_linenumber WHEN 3 THEN 0 WHEN 4 THEN NULL
              ELSE CAST(p_size * 1000 AS BIGINT) END AS Population,
         CASE WHEN l_linenumber <> 2 THEN l_extendedprice END AS Rate,
         CASE WHEN l_linenumber <> 3 THEN l_discount END AS CI_lower,
         CASE WHEN l_linenumber <> 4 THEN l_tax END AS CI_upper
  FROM lines)"""

_CLEANED = f"""{_RAW},
filled AS (
  SELECT Id, Disease, County, Year, Sex, coalesce(Count, 0) AS Count, Population,
         coalesce(Rate, 0) AS Rate, coalesce(CI_lower, 0) AS CI_lower,
         coalesce(CI_upper, 0) AS CI_upper
  FROM raw),
cleaned AS (SELECT *, {_RATE} AS Recalculated_Rate FROM filled)"""

_GRID = f"""
grid AS (
  SELECT County, Disease, Year, Population
  FROM (SELECT County, avg(Population) AS Population FROM V GROUP BY County)
       JOIN (SELECT DISTINCT County, Disease FROM V) USING (County),
       (SELECT CAST(last + step AS INTEGER) AS Year
        FROM (SELECT max(Year) AS last FROM V WHERE Year < {FIRST_TEST_YEAR}), range(1, 6) AS steps(step)))"""

_RANKS = f"""
ranks AS (
  SELECT category, value, n, row_number() OVER (PARTITION BY category ORDER BY n DESC, value) - 1 AS rank
  FROM (SELECT category, value, count(*) AS n
        FROM (SELECT unnest(['Disease', 'County', 'Sex']) AS category,
                     unnest([Disease, County, Sex]) AS value
              FROM V WHERE Year < {FIRST_TEST_YEAR} AND Population IS NOT NULL)
        GROUP BY category, value))"""


def _totals(key, rate="Avg_Rate", where="TRUE"):
    return f"""SELECT {key}, CAST(sum(Count) AS BIGINT) AS Total_Cases,
       {_round("avg(Recalculated_Rate)", 2)} AS {rate}
FROM V WHERE {where} GROUP BY {key}"""


def _chart(key):
    return f"""SELECT {key}, CAST(sum(Count) AS BIGINT) AS Cas_Totaux,
       {_round("avg(Recalculated_Rate)", 6)} AS Taux_Moyen FROM V GROUP BY {key}"""


_E, _L = (f"Cases_{first}_{last}" for first, last in (EARLY, LATE))

ORACLES = {
    "preprocess": f"""{_CLEANED}
SELECT *, CASE WHEN Year >= {FIRST_TEST_YEAR} THEN 'test' ELSE 'train' END AS dataset
FROM cleaned WHERE County <> 'California'""",
    "clean_csv_round_trip": f"""{_CLEANED}
SELECT *, CASE WHEN Year >= {FIRST_TEST_YEAR} THEN 'test' ELSE 'train' END AS dataset,
       CASE WHEN County = 'California' THEN 'state' ELSE 'county' END AS level
FROM cleaned WHERE County IS NOT NULL""",
    "numbered_rows": f"""{_RAW},
texts AS (SELECT Disease, County, CAST(Year AS VARCHAR) AS Year, Sex,
                 CAST(Population AS VARCHAR) AS Population FROM raw)
SELECT *, row_number() OVER (PARTITION BY Disease, County, Year, Sex, Population) AS copy FROM texts""",
    "clean_by_name": f"""{_CLEANED}
SELECT *, CASE WHEN Id % 20 >= 10 THEN 'second' END AS Origin FROM cleaned""",
    "rejected_lines": f"""{_RAW}
SELECT CASE WHEN Id % 10 IN (2, 4) THEN 'rejected' WHEN County IS NULL THEN 'unassigned'
            WHEN County = 'California' THEN 'state' ELSE 'county' END AS level,
       CASE Id % 10 WHEN 2 THEN 3 WHEN 4 THEN 11 END AS n_fields, count(*) AS n_rows
FROM raw GROUP BY ALL""",
    "input_report": """WITH columns(name, kind) AS (VALUES
  ('Disease', 'string'), ('County', 'string'), ('Year', 'int'), ('Sex', 'string'),
  ('Count', 'bigint'), ('Population', 'bigint'), ('Rate', 'double'), ('CI.lower', 'double'),
  ('CI.upper', 'double'), ('Id', 'bigint'), ('Recalculated_Rate', 'double')),
raw_sets AS (
  SELECT dataset, name, dataset <> 'absent' AS path_found,
         dataset = 'whole' OR (dataset = 'lacking' AND name NOT IN ('Rate', 'CI.upper')) AS usable
  FROM columns, (VALUES ('whole'), ('lacking'), ('absent')) AS sets(dataset)
  WHERE name NOT IN ('Id', 'Recalculated_Rate'))
SELECT dataset, name AS column, path_found, CASE WHEN usable THEN 'string' END AS found_type,
       'string' AS expected_type, usable FROM raw_sets
UNION ALL
SELECT 'cleaned', replace(name, '.', '_'), TRUE, CASE name WHEN 'Count' THEN 'double' ELSE kind END,
       kind, name <> 'Count' FROM columns""",
    "predictions_csv": f"""{_CLEANED}, {_banded("cleaned")}
SELECT * EXCLUDE (Rate, CI_lower, CI_upper) FROM banded WHERE County <> 'California'""",
    "clean_table": f"{_CLEANED} SELECT * FROM cleaned",
    "clean_rates": f"{_CASES} SELECT * FROM V",
    "raw_row_report": f"""{_RAW}
SELECT CASE WHEN Year >= {FIRST_TEST_YEAR} THEN 'test' ELSE 'train' END AS dataset,
       CASE WHEN County IS NULL THEN 'unassigned' WHEN County = 'California' THEN 'state'
            ELSE 'county' END AS level,
       count(*) AS n_rows
FROM raw GROUP BY ALL""",
    "split_counts": f"""{_CASES}
SELECT CASE WHEN County = 'California' THEN 'state' ELSE 'county' END AS level,
       count(*) AS n_rows FROM f GROUP BY ALL""",
    "state_rows": f"{_CASES} SELECT * FROM f WHERE County = 'California'",
    "uncleaned_fallback": f"""{_RAW}
SELECT CAST(Id AS VARCHAR) || CASE WHEN Id % 10 = 1 THEN '.0' ELSE '' END AS _c0,
       * EXCLUDE (Id), Rate AS Recalculated_Rate,
       Rate AS Predicted_Rate, 'Basse Priorite' AS Priority_Level
FROM raw WHERE County IS DISTINCT FROM 'California'""",
    "global_filter": f"""{_CASES} SELECT * FROM V
WHERE Disease = '{DISEASE}' AND Sex = 'Male' AND Year BETWEEN 1996 AND 1998""",
    "full_union": f"""{_CASES}
SELECT *, 'train' AS dataset FROM V WHERE Year < {FIRST_TEST_YEAR}
UNION ALL SELECT *, 'test' AS dataset FROM V WHERE Year >= {FIRST_TEST_YEAR}""",
    "disease_options": f"{_CASES} SELECT DISTINCT Disease FROM V",
    "year_bounds": f"{_CASES} SELECT min(Year) AS min_year, max(Year) AS max_year FROM V",
    "year_options": f"""{_CASES}
SELECT Year FROM V WHERE Year >= {FIRST_TEST_YEAR}
UNION
SELECT CAST(last + step AS INTEGER) AS Year
FROM (SELECT max(Year) AS last FROM V WHERE Year < {FIRST_TEST_YEAR}), range(1, 6) AS steps(step)""",
    "preview": f"{_CASES} SELECT * FROM V ORDER BY Disease, County, Year, Sex LIMIT 100",
    "top_diseases": f"""{_CASES} {_totals("Disease", "Avg_Prevalence_Rate")}
ORDER BY Total_Cases DESC, Disease LIMIT 15""",
    "top_diseases_two_sexes": f"""{_CASES}
{_totals("Disease", "Avg_Prevalence_Rate", "Sex IN ('Male', 'Female')")}
ORDER BY Total_Cases DESC, Disease LIMIT 10""",
    "yearly_trends": f"{_CASES} {_totals('Year')}",
    "yearly_trends_one": _CASES + _totals("Year", where=f"Disease = '{DISEASE}'"),
    "sex_distribution": f"""{_CASES},
t AS ({_totals("Sex", where="Sex IN ('Male', 'Female')")})
SELECT *, {_round("Total_Cases / (SELECT sum(Total_Cases) FROM t) * 100", 2)} AS Percentage
FROM t""",
    "county_hotspots": f"""{_CASES} {_totals("County", where=f"Disease = '{DISEASE}'")}
ORDER BY Avg_Rate DESC, County LIMIT 10""",
    "disease_growth": f"""{_CASES},
e AS (SELECT Disease, CAST(sum(Count) AS BIGINT) AS {_E} FROM V
      WHERE Year BETWEEN {EARLY[0]} AND {EARLY[1]} GROUP BY Disease),
l AS (SELECT Disease, CAST(sum(Count) AS BIGINT) AS {_L} FROM V
      WHERE Year BETWEEN {LATE[0]} AND {LATE[1]} GROUP BY Disease)
SELECT Disease, {_E}, {_L}, {_L} - {_E} AS Absolute_Increase,
       {_round(f"({_L} - {_E}) / CAST(CASE WHEN {_E} > 0 THEN {_E} ELSE 1 END AS DOUBLE) * 100", 2)}
         AS Percentage_Growth
FROM e JOIN l USING (Disease)""",
    "key_figures": f"""{_CASES}
SELECT CAST(sum(Count) AS BIGINT) AS Total_Cases,
       {_round("avg(Recalculated_Rate)", 6)} AS Avg_Rate,
       (SELECT County FROM V GROUP BY County ORDER BY sum(Count) DESC, County LIMIT 1) AS Top_County,
       (SELECT Disease FROM V GROUP BY Disease ORDER BY sum(Count) DESC, Disease LIMIT 1) AS Top_Disease
FROM V""",
    "key_figures_one": f"""{_CASES},
chosen AS (SELECT * FROM V WHERE Disease = '{DISEASE}' AND Year BETWEEN {LATE[0]} AND {LATE[1]})
SELECT CAST(sum(Count) AS BIGINT) AS Total_Cases,
       {_round("avg(Recalculated_Rate)", 6)} AS Avg_Rate,
       (SELECT County FROM chosen GROUP BY County ORDER BY sum(Count) DESC, County LIMIT 1)
         AS Top_County,
       '{DISEASE}' AS Top_Disease
FROM chosen""",
    "max_rate_row": f"""{_CASES} SELECT * FROM V
ORDER BY Recalculated_Rate DESC, Disease, County, Year, Sex LIMIT 1""",
    "disease_chart": f"{_CASES} {_chart('Disease')} ORDER BY Cas_Totaux DESC, Disease LIMIT 10",
    "sex_chart": f"""{_CASES} SELECT Sex, CAST(sum(Count) AS BIGINT) AS Count FROM V
WHERE Sex IN ('Male', 'Female') GROUP BY Sex""",
    "yearly_chart": f"{_CASES} {_chart('Year')}",
    "year_growth": f"""{_CASES},
y AS (SELECT Year, CAST(sum(Count) AS BIGINT) AS cases FROM V GROUP BY Year),
ends AS (
  SELECT a.Year AS first_year, b.Year AS last_year, a.cases AS first_cases, b.cases AS last_cases
  FROM y a, y b
  WHERE a.Year = (SELECT min(Year) FROM y) AND b.Year = (SELECT max(Year) FROM y))
SELECT *, {_round("CASE WHEN first_cases > 0 THEN (last_cases - first_cases) / first_cases * 100.0 ELSE 0 END", 6)} AS growth,
       CASE WHEN last_cases > first_cases AND first_cases > 0
            THEN 'augmentation' ELSE 'baisse' END AS trend
FROM ends""",
    "screen_summary": f"""{_CASES}
SELECT CASE GROUPING(Disease, County, Sex, Year) WHEN 15 THEN 'All' WHEN 7 THEN 'Disease'
            WHEN 11 THEN 'County' WHEN 13 THEN 'Sex' ELSE 'Year' END AS level,
       Disease, County, Sex, Year, count(*) AS n_rows, CAST(sum(Count) AS BIGINT) AS cases,
       {_round("sum(Recalculated_Rate)", 3)} AS rate_sum, count(Recalculated_Rate) AS rate_n,
       CAST(sum(Population) AS BIGINT) AS population_sum, count(Population) AS population_n
FROM V GROUP BY GROUPING SETS ((), (Disease), (County), (Sex), (Year))""",
    "summary_charts": f"""{_CASES},
y AS (SELECT Year, CAST(sum(Count) AS BIGINT) AS cases FROM V GROUP BY Year),
ends AS (SELECT min(Year) AS first_year, max(Year) AS last_year, min_by(cases, Year) AS first_cases,
                max_by(cases, Year) AS last_cases FROM y),
growth AS (SELECT *, CASE WHEN first_cases > 0 THEN (last_cases - first_cases) / first_cases * 100.0
                          ELSE 0 END AS growth FROM ends),
told AS (
  SELECT 'figures' AS screen,
         (SELECT County FROM V GROUP BY County ORDER BY sum(Count) DESC, County LIMIT 1) || ' / ' ||
         (SELECT Disease FROM V GROUP BY Disease ORDER BY sum(Count) DESC, Disease LIMIT 1) AS name,
         sum(Count) AS cases, avg(Recalculated_Rate) AS rate FROM V
  UNION ALL
  (SELECT 'highest', concat_ws(' / ', Disease, County, Year, Sex), Count, Recalculated_Rate FROM V
   ORDER BY Recalculated_Rate DESC, Disease, County, Year, Sex LIMIT 1)
  UNION ALL
  (SELECT 'Disease', Disease, sum(Count) AS total, avg(Recalculated_Rate) FROM V GROUP BY Disease
   ORDER BY total DESC, Disease LIMIT 10)
  UNION ALL
  SELECT 'Year', CAST(Year AS VARCHAR), sum(Count), avg(Recalculated_Rate) FROM V GROUP BY Year
  UNION ALL
  SELECT 'Sex', Sex, sum(Count), NULL FROM V WHERE Sex IN ('Male', 'Female') GROUP BY Sex
  UNION ALL
  SELECT 'growth', concat_ws(' / ', first_year, last_year,
           CASE WHEN growth > 0 THEN 'augmentation' ELSE 'baisse' END), last_cases, growth FROM growth)
SELECT screen, name, CAST(cases AS BIGINT) AS cases, {_round("CAST(rate AS DOUBLE)", 6)} AS rate FROM told""",
    "map_layer": f"""{_CASES},
m AS (
  SELECT County, CAST(sum(Count) AS BIGINT) AS Total_Count, avg(Recalculated_Rate) AS mean_rate,
         avg(Population) AS mean_population
  FROM V GROUP BY County),
placed AS (
  SELECT m.*, 30 + n_nationkey * 0.5::DOUBLE AS latitude, -120 + n_nationkey * 0.25::DOUBLE AS longitude
  FROM m JOIN nation ON County = n_name WHERE n_nationkey < {FIRST_NATION_OFF_THE_MAP}),
shares AS (
  SELECT *, mean_rate / (SELECT CASE WHEN max(mean_rate) > 0 THEN max(mean_rate) ELSE 1 END FROM placed)
              AS share FROM placed)
SELECT County, Total_Count, {_round("mean_rate", 6)} AS Mean_Rate,
       {_round("mean_population", 6)} AS Population, latitude, longitude,
       {_round("share * 30000 + 5000", 4)} AS height,
       CAST(trunc(least(255, share * 2 * 255)) AS INTEGER) AS red,
       CASE WHEN share > 0.5 THEN CAST(trunc(least(255, (2 - share * 2) * 255)) AS INTEGER)
            ELSE 255 END AS green,
       50 AS blue, 180 AS alpha
FROM shares""",
    "priority_bands": f"{_BANDED} SELECT * FROM banded",
    "stand_in_metrics": f"""{_CASES},
guess AS (SELECT Recalculated_Rate AS y,
                 Recalculated_Rate * ({_BRAND_NUMBER} % 5) / 20 - 1 AS p FROM V),
center AS (SELECT avg(y) AS mean_y FROM guess)
SELECT count(*) AS n_rows, {_round("sqrt(avg((y - p) * (y - p)))", 6)} AS rmse,
       {_round("1 - sum((y - p) * (y - p)) / sum((y - mean_y) * (y - mean_y))", 6)} AS r2
FROM guess, center""",
    "county_risk": f"{_RISK} SELECT * FROM risk",
    "risk_ranking": f"""{_RISK}
SELECT Disease, Year, County, Observed_Rate, Predicted_Rate, Priority_Level FROM risk""",
    "priority_counts": f"""{_RISK}
SELECT Disease, Year,
       count(*) FILTER (WHERE Priority_Level = 'Haute Priorite') AS n_high,
       count(*) FILTER (WHERE Priority_Level = 'Moyenne Priorite') AS n_medium,
       count(*) FILTER (WHERE Priority_Level = 'Basse Priorite') AS n_low
FROM risk GROUP BY Disease, Year""",
    "recommendations": f"""{_RISK},
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY Disease, Year, Priority_Level
                                    ORDER BY Predicted_Rate DESC, County) AS INTEGER) AS Rank
  FROM risk),
pairs AS (
  SELECT Disease, Year, bool_or(Priority_Level = 'Haute Priorite') AS any_high,
         bool_or(Priority_Level = 'Moyenne Priorite') AS any_medium
  FROM risk GROUP BY Disease, Year)
SELECT Disease, Year, County, Predicted_Rate, Priority_Level, Rank, 'critical' AS action
FROM ranked WHERE Priority_Level = 'Haute Priorite' AND Rank <= 5
UNION ALL
SELECT Disease, Year, County, Predicted_Rate, Priority_Level, Rank, 'reinforced'
FROM ranked JOIN pairs USING (Disease, Year)
WHERE NOT any_high AND Priority_Level = 'Moyenne Priorite' AND Rank <= 3
UNION ALL
SELECT Disease, Year, NULL, NULL, NULL, NULL, 'none'
FROM pairs WHERE NOT any_high AND NOT any_medium""",
    "forecast_grid": f"""{_CASES}, {_GRID}
SELECT County, Disease, Year, {_round("Population", 6)} AS Population FROM grid""",
    "prediction_lookup": f"{_BANDED} SELECT * FROM banded WHERE Disease = '{DISEASE}' AND Year = 2000",
    "predictions_for": f"""{_BANDED}, {_GRID}
SELECT Disease, County, Year, Sex, Count, CAST(Population AS DOUBLE) AS Population,
       Recalculated_Rate, Predicted_Rate, Priority_Level
FROM banded WHERE Year >= {FIRST_TEST_YEAR}
UNION ALL
SELECT Disease, County, Year, NULL, NULL, {_round("Population", 6)}, NULL,
       {_round("Population / 10000", 6)}, NULL
FROM grid WHERE Year NOT IN (SELECT Year FROM V WHERE Year >= {FIRST_TEST_YEAR})""",
    "rf_predictions": f"""{_CASES}
SELECT *, Population IS NOT NULL AS scored, TRUE AS within_range, TRUE AS band_agrees
FROM V WHERE Year >= {FIRST_TEST_YEAR}""",
    "category_ranks": f"""{_CASES}, {_RANKS} SELECT * FROM ranks""",
    "feature_vectors": f"""{_CASES}, {_RANKS},
sizes AS (SELECT category, count(*) AS size FROM ranks GROUP BY category),
starts AS (
  SELECT max(size) FILTER (category = 'Disease') AS diseases,
         max(size) FILTER (category = 'County') AS counties, sum(size) AS labels FROM sizes)
SELECT V.Disease, V.County, V.Year, V.Sex, CAST(labels + 2 AS INTEGER) AS n_slots,
       concat_ws(' ', '0:' || Year, (1 + d.rank) || ':1', (1 + diseases + c.rank) || ':1',
         (1 + diseases + counties + s.rank) || ':1',
         CASE WHEN Population IS NULL THEN CAST(labels + 1 AS BIGINT) || ':NaN'
              WHEN Population <> 0 THEN CAST(labels + 1 AS BIGINT) || ':' || Population END) AS slots
FROM V CROSS JOIN starts
LEFT JOIN ranks d ON d.category = 'Disease' AND d.value = V.Disease
LEFT JOIN ranks c ON c.category = 'County' AND c.value = V.County
LEFT JOIN ranks s ON s.category = 'Sex' AND s.value = V.Sex""",
    "out_of_fold_means": f"""{_CASES},
learnt AS (SELECT *, Year % 5 AS fold, CAST(Recalculated_Rate AS DOUBLE) AS rate
           FROM V WHERE Population IS NOT NULL),
long AS (SELECT 'Disease' AS category, Disease AS value, fold, rate FROM learnt
         UNION ALL SELECT 'County', County, fold, rate FROM learnt),
folds AS (SELECT DISTINCT category, value, fold FROM long
          UNION ALL SELECT DISTINCT category, value, NULL FROM long),
sums AS (
  SELECT f.category, f.value, f.fold, coalesce(sum(rate), 0) AS total, count(rate) AS n
  FROM folds f LEFT JOIN long l
    ON l.category = f.category AND l.value = f.value AND l.fold IS DISTINCT FROM f.fold
  GROUP BY ALL)
SELECT category, value, CAST(fold AS BIGINT) AS fold,
       {_round("(total + (SELECT avg(rate) FROM learnt) * 10) / (n + 10)", 4)} AS mean
FROM sums""",
    "rf_ranked_metrics": f"""{_CASES}
SELECT count(*) AS n_rows, TRUE AS as_good FROM V
WHERE Year >= {FIRST_TEST_YEAR} AND Population IS NOT NULL""",
    "rf_metrics": f"""{_CASES}
SELECT count(*) FILTER (WHERE Year >= {FIRST_TEST_YEAR} AND Population IS NOT NULL) AS n_rows,
       count(*) FILTER (WHERE Year < {FIRST_TEST_YEAR} AND Population IS NOT NULL) AS n_train,
       count(*) FILTER (WHERE Year < {FIRST_TEST_YEAR} AND Population IS NULL) AS n_left_out,
       TRUE AS rmse_possible, TRUE AS r2_possible
FROM V""",
    "model_round_trip": f"""{_CASES}
SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_different
FROM V WHERE Year >= {FIRST_TEST_YEAR}""",
    "forecast_scores": f"""{_CASES}, {_GRID}
SELECT County, Disease, Year, {_round("Population", 6)} AS Population,
       Population IS NOT NULL AS scored, TRUE AS within_range
FROM grid""",
}
ORACLES["stage_report"] = ORACLES["raw_row_report"]
ORACLES["summary_map"] = ORACLES["map_layer"]
ORACLES["summary_preview"] = ORACLES["preview"]
