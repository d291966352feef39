"""DuckDB SQL for the same results, for comparison only.

Written apart from the Spark plans: the fill runs over all rows instead of
distinct ones, the survivor's counts come from grouped subqueries instead of
form, and the reports count single events instead of rolled-up ones.
"""

from itertools import combinations

# Fixed values, the same as in the raw inputs.
_SPELLINGS = (
    "['M','F','male','FEMALE','mal','femal','mle','emmle','fmale','unknown',"
    "NULL,NULL,'Male]','female#','mael','eml','fmle','amle','feml','x']"
)
_AS_OF = "DATE '2024-06-30'"
_AGE = f"CAST(year({_AS_OF}) - CAST(TRY_CAST(year_of_birth AS DOUBLE) AS INTEGER) AS INTEGER)"


def _similarity(word: str, target: str) -> str:
    branches = []
    for size in range(len(target), 0, -1):
        pattern = "|".join(".*".join(part) for part in combinations(target, size))
        branches.append(f"WHEN regexp_matches({word}, '{pattern}', 's') THEN {size}")
    common = f"CASE {' '.join(branches)} ELSE 0 END"
    return f"round(200.0 * ({common}) / (length({word}) + {len(target)}))"


def _gender(raw: str) -> str:
    word = f"lower({raw})"
    return (
        f"CASE WHEN {word} = 'f' OR contains({word}, 'fe') THEN 'female' "
        f"WHEN {word} = 'm' OR contains({word}, 'ma') THEN 'male' "
        f"WHEN {_similarity(word, 'male')} >= 70 THEN 'male' "
        f"WHEN {_similarity(word, 'female')} >= 70 THEN 'female' END"
    )


_RAW_CRM = f"""crm_raw AS (
  SELECT CASE WHEN o_orderkey % 101 = 0 THEN NULL
              WHEN o_custkey % 10 = 0 THEN 'C' || o_custkey ELSE CAST(o_custkey AS VARCHAR) END AS msisdn,
         ({_SPELLINGS})[CAST(o_orderkey % 20 AS INTEGER) + 1] AS gender,
         CASE WHEN o_orderkey % 7 <> 0
              THEN (1945 + (o_custkey + o_orderkey % 2) % 60)
                || CASE WHEN o_custkey % 17 = 0 THEN '.0' ELSE '' END END AS year_of_birth,
         CASE WHEN o_orderkey % 53 = 0 THEN NULL
              WHEN o_orderkey % 59 = 0 THEN 'BARRED'
              WHEN o_custkey % 4 = 0 THEN ['ACTIVE','SUSPEND','IDLE'][CAST(o_orderkey % 3 AS INTEGER) + 1]
              WHEN o_custkey % 4 = 1 THEN CASE WHEN o_orderkey % 3 = 0 THEN 'IDLE' ELSE 'SUSPEND' END
              WHEN o_custkey % 4 = 2 THEN CASE WHEN o_orderkey % 5 = 0 THEN 'ACTIVE' ELSE 'SUSPEND' END
              ELSE ['DEACTIVE','IDLE','SUSPEND','SUSPEND'][CAST(o_orderkey % 4 AS INTEGER) + 1]
         END AS system_status,
         CASE WHEN o_orderkey % 31 = 0 THEN NULL
              WHEN o_orderkey % 2 = 0 THEN 'Prepaid' ELSE 'Postpaid' END AS mobile_type,
         CASE WHEN o_orderkey % 37 <> 0 THEN 'Tier_' || (o_orderkey % 3 + 1) END AS value_segment
  FROM orders)"""

_RAW_DEVICE = """device_raw AS (
  SELECT CASE WHEN o_orderkey % 103 = 0 THEN NULL
              WHEN o_custkey % 10 = 1 THEN 'D' || o_custkey ELSE CAST(o_custkey AS VARCHAR) END AS msisdn,
         CAST(l_partkey AS VARCHAR) AS imei_tac,
         CASE WHEN l_linenumber % 3 <> 0 THEN p_brand END AS brand_name,
         p_name AS model_name,
         CASE WHEN l_linenumber % 4 <> 0 THEN p_type END AS os_name,
         CASE WHEN l_linenumber % 2 <> 0 THEN 'V_' || p_type END AS os_vendor
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""

_RAW_REVENUE = """revenue AS (
  SELECT CASE WHEN event_id % 89 = 0 THEN NULL
              WHEN event_id % 97 = 0 THEN 'U' || user_id ELSE CAST(user_id AS VARCHAR) END AS msisdn,
         CAST(22 + date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) // 7 AS INTEGER) AS week_number,
         CAST(CAST(value AS DECIMAL(16,2)) + [0.00499, 0.005, 0.00501, 0.004999, 0.0050000001, 0.0049999999,
              CAST(event_id % 100 AS DECIMAL(10,0)) * 0.0001 + 0.000001,
              CAST(event_id % 100 AS DECIMAL(10,0)) * 0.0001 + 0.000001][CAST(event_id % 8 AS INTEGER) + 1]
              AS DECIMAL(28,10)) AS revenue_usd
  FROM events)"""

# The records of the text files and what becomes of them.
_RECORDS = """records AS (
  SELECT 'crm' AS source, msisdn || ',male' AS text, CASE WHEN msisdn LIKE '%77' THEN 'fields' ELSE 'used' END AS cause
  FROM crm_raw
  UNION ALL SELECT 'device', msisdn || ',a,b,c,d,e,f', CASE WHEN msisdn LIKE '%77' THEN 'fields' ELSE 'used' END
  FROM device_raw
  UNION ALL SELECT 'revenue',
    CASE WHEN msisdn LIKE '%77' THEN msisdn
         WHEN msisdn LIKE '%88' THEN msisdn || ',w' || week_number || ',n/a'
         WHEN msisdn LIKE '%7' THEN msisdn || ',w' || week_number || ',' || revenue_usd
         ELSE msisdn || ',' || week_number || ',n/a' END,
    CASE WHEN msisdn LIKE '%77' THEN 'fields' WHEN msisdn LIKE '%88' THEN 'week_number, revenue_usd'
         WHEN msisdn LIKE '%7' THEN 'week_number' WHEN msisdn LIKE '%8' THEN 'revenue_usd' ELSE 'used' END
  FROM revenue)"""

_CRM = f"""crm_words AS (
  SELECT msisdn, {_gender('gender')} AS gender,
         coalesce(CAST(year_of_birth AS VARCHAR), 'Not Available') AS year_of_birth,
         system_status, mobile_type, value_segment
  FROM crm_raw),
crm_filled AS (
  SELECT *, coalesce(
           last_value(gender IGNORE NULLS) OVER (
             PARTITION BY msisdn ORDER BY year_of_birth NULLS LAST, gender NULLS LAST
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
           first_value(gender IGNORE NULLS) OVER (
             PARTITION BY msisdn ORDER BY year_of_birth NULLS LAST, gender NULLS LAST
             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
           'Not Available') AS filled_gender
  FROM crm_words),
crm_rows AS (
  SELECT DISTINCT msisdn, filled_gender AS gender, year_of_birth, system_status, mobile_type, value_segment
  FROM crm_filled),
per_subscriber AS (
  SELECT msisdn, count(*) AS n_rows,
         count(*) FILTER (system_status = 'DEACTIVE') AS n_deactive,
         count(*) FILTER (system_status = 'ACTIVE') AS n_active,
         count(*) FILTER (system_status = 'IDLE') AS all_idle
  FROM crm_rows GROUP BY msisdn),
per_group AS (
  SELECT msisdn, year_of_birth, mobile_type, gender,
         count(*) FILTER (system_status IN ('ACTIVE', 'SUSPEND', 'IDLE')) AS group_live,
         count(*) FILTER (system_status = 'ACTIVE') AS group_active,
         count(*) FILTER (system_status = 'IDLE') AS group_idle
  FROM crm_rows GROUP BY ALL),
crm_alone AS (
  SELECT g.msisdn, sum(group_active) AS n_alone_active
  FROM per_group g JOIN per_subscriber s ON g.msisdn IS NOT DISTINCT FROM s.msisdn
  WHERE group_live = 1 OR group_live = n_rows GROUP BY g.msisdn),
crm_counted AS (
  SELECT r.*, g.group_live, g.group_active, g.group_idle, s.n_rows, s.n_deactive, s.n_active,
         CASE WHEN s.n_active = 0 THEN s.all_idle ELSE 0 END AS n_idle,
         CAST(g.group_live = 1 OR g.group_live = s.n_rows AS INTEGER) AS alone,
         CAST(coalesce(a.n_alone_active, 0) AS BIGINT) AS n_alone_active
  FROM crm_rows r
  JOIN per_subscriber s ON r.msisdn IS NOT DISTINCT FROM s.msisdn
  JOIN per_group g ON r.msisdn IS NOT DISTINCT FROM g.msisdn AND r.year_of_birth = g.year_of_birth
       AND r.mobile_type IS NOT DISTINCT FROM g.mobile_type AND r.gender = g.gender
  LEFT JOIN crm_alone a ON r.msisdn IS NOT DISTINCT FROM a.msisdn),
whole_group AS (
  SELECT *, CASE WHEN n_rows = group_live THEN 1 ELSE group_live END AS mark FROM crm_counted),
outranked AS (
  SELECT * REPLACE (CASE
      WHEN mark = 1 AND group_active = 0 AND n_active > 0 AND n_deactive = 0 THEN -1
      WHEN mark = 1 AND group_active = 0 AND n_active = 0 AND n_idle > 0 AND group_idle = 0 THEN -1
      ELSE mark END AS mark)
  FROM whole_group),
spoken_for AS (
  SELECT *, count(*) FILTER (mark = 1 AND system_status = 'ACTIVE') OVER (PARTITION BY msisdn) AS taken
  FROM outranked),
promoted AS (
  SELECT * REPLACE (CASE
      WHEN n_active > 0 AND group_active > 0 AND taken = 0 THEN 1
      WHEN n_active = 0 AND n_idle > 0 AND system_status = 'IDLE' AND group_idle > 0 THEN 1
      WHEN n_active = 0 AND n_idle = 0 AND system_status = 'SUSPEND' AND group_idle = 0 THEN 1
      ELSE mark END AS mark)
  FROM spoken_for WHERE mark <> -1),
crm_kept AS (
  SELECT msisdn, gender, year_of_birth, system_status, mobile_type, value_segment FROM promoted
  WHERE (system_status = 'DEACTIVE' AND n_deactive > 0)
     OR (system_status = 'ACTIVE' AND n_deactive = 0 AND mark = 1)
     OR (system_status = 'ACTIVE' AND n_deactive = 0 AND group_active > 0 AND taken = 0)
     OR (system_status = 'IDLE' AND n_deactive = 0 AND mark = 1 AND group_active = 0 AND n_active = 0)
     OR (system_status = 'SUSPEND' AND n_deactive = 0 AND mark = 1 AND group_active = 0 AND group_idle = 0)),
crm AS (
  SELECT * FROM crm_kept QUALIFY row_number() OVER (
    PARTITION BY msisdn ORDER BY system_status NULLS LAST, year_of_birth NULLS LAST,
    mobile_type NULLS LAST, gender NULLS LAST, value_segment NULLS LAST) = 1)"""

_DEVICE = """device_counted AS (
  SELECT coalesce(msisdn, 'Not Available') AS msisdn, imei_tac, brand_name, model_name, os_name, os_vendor,
         CAST(msisdn IS NULL AS INTEGER) + CAST(imei_tac IS NULL AS INTEGER)
            + CAST(brand_name IS NULL AS INTEGER) + CAST(model_name IS NULL AS INTEGER)
            + CAST(os_name IS NULL AS INTEGER) + CAST(os_vendor IS NULL AS INTEGER) AS no_of_nulls
  FROM device_raw),
device_first AS (
  SELECT msisdn, imei_tac, brand_name, model_name, os_name, os_vendor FROM device_counted
  QUALIFY row_number() OVER (
    PARTITION BY msisdn ORDER BY no_of_nulls, imei_tac NULLS LAST, brand_name NULLS LAST,
    model_name NULLS LAST, os_name NULLS LAST, os_vendor NULLS LAST) = 1),
device AS (
  SELECT msisdn, coalesce(imei_tac, 'Not Available') AS imei_tac,
         coalesce(brand_name, 'Not Available') AS brand_name,
         coalesce(model_name, 'Not Available') AS model_name,
         coalesce(os_name, 'Not Available') AS os_name, coalesce(os_vendor, 'Not Available') AS os_vendor
  FROM device_first)"""

_FACT = f"""subscriber AS (SELECT * FROM crm FULL JOIN device USING (msisdn)),
fact AS (
  SELECT *, round(revenue_usd, 2) AS cents,
         {_AGE} AS age
  FROM subscriber JOIN revenue USING (msisdn)),
aged AS (SELECT *, (age - age % 10) || '-' || (age - age % 10 + 9) AS age_group FROM fact)"""

_MALE_FEMALE = (
    "CAST(sum(CASE WHEN gender = 'male' THEN cents ELSE 0 END) AS DOUBLE) AS male_revenue, "
    "CAST(sum(CASE WHEN gender = 'female' THEN cents ELSE 0 END) AS DOUBLE) AS female_revenue"
)
_SUM = "CAST(sum(cents) AS DOUBLE)"
_COUNT = "count(*) AS total_customers"
_ACTIVE = "FROM fact WHERE system_status = 'ACTIVE'"
_RANGE = (
    "CAST(max(cents) AS DOUBLE) AS highest_revenue_generated, "
    "CAST(min(cents) AS DOUBLE) AS lowest_revenue_generated"
)

_MARTS = {
    "total_devices": "SELECT count(DISTINCT imei_tac) AS total_devices FROM fact",
    "devices_by_week": "SELECT week_number, count(*) AS total_devices FROM fact GROUP BY ALL ORDER BY 1",
    "active_devices": f"SELECT count(DISTINCT imei_tac) AS total_active_devices {_ACTIVE}",
    "active_devices_by_week":
        f"SELECT week_number, count(*) AS total_active_devices {_ACTIVE} GROUP BY ALL ORDER BY 1",
    "total_customers": f"SELECT {_COUNT} FROM fact",
    "customers_by_week": f"SELECT week_number, {_COUNT} FROM fact GROUP BY ALL ORDER BY 1",
    "active_customers": f"SELECT count(*) AS total_active_customers {_ACTIVE}",
    "active_customers_by_week":
        f"SELECT week_number, count(*) AS total_active_customers {_ACTIVE} GROUP BY ALL ORDER BY 1",
    "revenue_by_gender": f"SELECT {_MALE_FEMALE} FROM fact",
    "revenue_by_gender_week": f"SELECT week_number, {_MALE_FEMALE} FROM fact GROUP BY ALL",
    "revenue_by_age": f"SELECT age, age_group, {_SUM} AS revenue FROM aged GROUP BY ALL",
    "revenue_by_age_week": f"SELECT week_number, age, age_group, {_SUM} AS revenue FROM aged GROUP BY ALL",
    "revenue_by_segment_age":
        f"SELECT value_segment, age, age_group, {_SUM} AS total FROM aged GROUP BY ALL",
    "revenue_by_segment_age_week":
        f"SELECT value_segment, week_number, age, age_group, {_SUM} AS total FROM aged GROUP BY ALL",
    "revenue_by_age_band": f"SELECT age_group, {_SUM} AS revenue FROM aged GROUP BY ALL",
    "revenue_by_age_band_week": f"SELECT week_number, age_group, {_SUM} AS revenue FROM aged GROUP BY ALL",
    "revenue_by_segment_age_band_week":
        f"SELECT value_segment, week_number, age_group, {_SUM} AS total FROM aged GROUP BY ALL",
    "revenue_range_by_brand_week": f"SELECT week_number, brand_name, {_RANGE} FROM fact GROUP BY ALL",
    "revenue_range_by_os_week": f"SELECT week_number, os_name, {_RANGE} FROM fact GROUP BY ALL",
    "brand_by_age_band": f"SELECT age_group, brand_name, {_COUNT} FROM aged GROUP BY ALL",
    "os_by_age_band": f"SELECT age_group, os_name, {_COUNT} FROM aged GROUP BY ALL",
}
for _name, _column in (
    ("mobile_type", "mobile_type"), ("brand", "brand_name"), ("os", "os_name"), ("os_vendor", "os_vendor")
):
    _MARTS[f"revenue_by_{_name}"] = f"SELECT {_column}, {_SUM} AS revenue FROM fact GROUP BY ALL"
    _MARTS[f"revenue_by_{_name}_week"] = (
        f"SELECT week_number, {_column}, {_SUM} AS revenue FROM fact GROUP BY ALL"
    )
    if _name != "os_vendor":
        _MARTS[f"customers_by_{_name}"] = f"SELECT {_column}, {_COUNT} FROM fact GROUP BY ALL"
        _MARTS[f"customers_by_{_name}_week"] = (
            f"SELECT week_number, {_column}, {_COUNT} FROM fact GROUP BY ALL"
        )

# Table, key columns and measures of each report, for the export's long form.
_LONG = {
    "total_devices": ("total_devices", "", "total_devices"),
    "devices_by_week": ("total_devices_weekwise", "week_number", "total_devices"),
    "active_devices": ("total_active_devices", "", "total_active_devices"),
    "active_devices_by_week": ("total_active_devices_weekwise", "week_number", "total_active_devices"),
    "total_customers": ("total_customers", "", "total_customers"),
    "customers_by_week": ("total_customers_weekwise", "week_number", "total_customers"),
    "active_customers": ("total_customers_active", "", "total_active_customers"),
    "active_customers_by_week": ("total_active_customers_weekwise", "week_number", "total_active_customers"),
    "revenue_by_gender": ("total_revenue_male_female", "", "male_revenue,female_revenue"),
    "revenue_by_gender_week":
        ("total_revenue_male_female_weekwise", "week_number", "male_revenue,female_revenue"),
    "revenue_by_age": ("total_revenue_age", "age", "revenue"),
    "revenue_by_age_week": ("total_revenue_age_weekwise", "week_number,age", "revenue"),
    "revenue_by_segment_age": ("total_revenue_by_age_value_segment", "value_segment,age", "total"),
    "revenue_by_segment_age_week":
        ("total_revenue_by_age_value_segment_weekwise", "value_segment,week_number,age", "total"),
    "revenue_by_age_band": ("total_revenue_age_band", "age_group", "revenue"),
    "revenue_by_age_band_week": ("total_revenue_age_band_weekwise", "week_number,age_group", "revenue"),
    "revenue_by_segment_age_band_week":
        ("total_revenue_by_age_band_value_segment_weekwise", "value_segment,week_number,age_group", "total"),
    "revenue_by_mobile_type": ("total_revenue_by_mobile_type", "mobile_type", "revenue"),
    "revenue_by_mobile_type_week":
        ("total_revenue_by_mobile_type_weekwise", "week_number,mobile_type", "revenue"),
    "revenue_by_brand": ("total_revenue_by_brand_name", "brand_name", "revenue"),
    "revenue_by_brand_week": ("total_revenue_by_brand_name_weekwise", "week_number,brand_name", "revenue"),
    "revenue_by_os": ("total_revenue_by_os_name", "os_name", "revenue"),
    "revenue_by_os_week": ("total_revenue_by_os_name_weekwise", "week_number,os_name", "revenue"),
    "revenue_by_os_vendor": ("total_revenue_by_os_vender", "os_vendor", "revenue"),
    "revenue_by_os_vendor_week": ("total_revenue_by_os_vender_weekwise", "week_number,os_vendor", "revenue"),
    "customers_by_os": ("total_customers_by_os_name", "os_name", "total_customers"),
    "customers_by_os_week": ("total_customers_by_os_name_weekwise", "week_number,os_name", "total_customers"),
    "customers_by_brand": ("total_customers_by_brand_name", "brand_name", "total_customers"),
    "customers_by_brand_week":
        ("total_customers_by_brand_name_weekwise", "week_number,brand_name", "total_customers"),
    "customers_by_mobile_type": ("total_customers_by_mobile_type", "mobile_type", "total_customers"),
    "customers_by_mobile_type_week":
        ("total_customers_by_mobile_type_weekwise", "week_number,mobile_type", "total_customers"),
    "revenue_range_by_brand_week":
        ("highest_lowest_revenue_by_brand_name_weekwise", "week_number,brand_name",
         "highest_revenue_generated,lowest_revenue_generated"),
    "revenue_range_by_os_week":
        ("highest_lowest_revenue_by_os_name_weekwise", "week_number,os_name",
         "highest_revenue_generated,lowest_revenue_generated"),
    "brand_by_age_band": ("distrbution_brand_name_by_age", "age_group,brand_name", "total_customers"),
    "os_by_age_band": ("distrbution_os_name_by_age", "age_group,os_name", "total_customers"),
}


def _long_form() -> str:
    parts = []
    for name, (table, keys, measures) in _LONG.items():
        keys = keys + ",age_group" if "age" in keys.split(",") else keys
        labels = [f"coalesce(CAST({key} AS VARCHAR), '-')" for key in keys.split(",") if key]
        label = " || '|' || ".join(labels) or "''"
        for measure in measures.split(","):
            parts.append(
                f"SELECT '{table}' AS table_name, {label} AS group_label, '{measure}' AS measure, "
                f"CAST({measure} AS DOUBLE) AS value FROM ({_MARTS[name].replace(' ORDER BY 1', '')})"
            )
    return " UNION ALL ".join(parts)


def _with(*steps: str) -> str:
    return "WITH " + ",\n".join(steps) + "\n"


def oracle_sql() -> dict[str, str]:
    crm = _with(_RAW_CRM, _CRM)
    device = _with(_RAW_DEVICE, _DEVICE)
    full = _with(_RAW_CRM, _CRM, _RAW_DEVICE, _DEVICE, _RAW_REVENUE, _FACT)
    revenue = _with(_RAW_REVENUE)
    in_double = "SELECT msisdn, week_number, CAST(revenue_usd AS DOUBLE) AS revenue_usd FROM revenue"
    decoded = (
        in_double + " UNION ALL SELECT CAST(NULL AS VARCHAR), CAST(NULL AS INTEGER), CAST(NULL AS DOUBLE) "
        "FROM (SELECT DISTINCT week_number FROM revenue)"
    )
    facts = (
        "SELECT msisdn, gender, year_of_birth, system_status, mobile_type, value_segment, imei_tac, "
        "brand_name, model_name, os_name, os_vendor, week_number, CAST(revenue_usd AS DOUBLE) AS revenue_usd "
        "FROM fact"
    )
    named = {
        "scan_crm": _with(_RAW_CRM) + "SELECT * FROM crm_raw",
        "scan_device": _with(_RAW_DEVICE) + "SELECT * FROM device_raw",
        "scan_revenue": revenue + in_double,
        "scan_rejects": _with(_RAW_CRM, _RAW_DEVICE, _RAW_REVENUE, _RECORDS) + """
        SELECT source, CASE WHEN cause <> 'used' THEN text END AS text, cause, count(*) AS n FROM records GROUP BY 1, 2, 3""",
        "collection_merged": crm + """
        SELECT msisdn, CASE WHEN low THEN gender END AS gender,
            CASE WHEN NOT low OR regexp_full_match(year_of_birth, '[0-9]+') THEN year_of_birth END AS year_of_birth,
            mobile_type, length(msisdn) AS n_chars,
            CASE WHEN NOT low THEN value_segment END AS value_segment,
            CASE WHEN NOT low THEN system_status END AS system_status
        FROM (SELECT *, coalesce(right(msisdn, 1) < '5', false) AS low FROM crm)""",
        "crm_clean_added": crm + "SELECT * FROM crm",
        "device_clean_added": device + "SELECT * FROM device",
        "collection_roundtrip": crm + "SELECT * FROM crm",
        "gender_normalize": _with(_RAW_CRM)
        + f"SELECT gender AS raw_gender, {_gender('gender')} AS gender, count(*) AS n_rows "
        "FROM crm_raw GROUP BY crm_raw.gender",
        "gender_function": _with(_RAW_CRM) + f"SELECT msisdn, {_gender('gender')} AS gender FROM crm_raw",
        "clean_null_labels": _with(_RAW_CRM)
        + "SELECT msisdn, coalesce(gender, 'Not Available') AS gender, "
        "coalesce(CAST(year_of_birth AS VARCHAR), 'Not Available') AS year_of_birth FROM crm_raw",
        "gender_fill": crm + "SELECT DISTINCT * FROM crm_filled",
        "crm_dedupe": crm + "SELECT * FROM crm_rows",
        "crm_window_counts": crm + "SELECT * FROM crm_counted",
        "crm_survivor": crm + "SELECT * FROM crm_kept",
        "crm_clean": crm + "SELECT * FROM crm",
        "device_null_count": device + "SELECT * FROM device_counted",
        "device_survivor": device + "SELECT * FROM device_first",
        "device_clean": device + "SELECT * FROM device",
        "crm_device_full": full + "SELECT * FROM subscriber",
        "subscriber_week": full + facts,
        "subscriber_activity": full
        + "SELECT msisdn, week_number, gender, year_of_birth, system_status, mobile_type, value_segment, "
        "imei_tac, brand_name, model_name, os_name, os_vendor, count(*) AS events, "
        "CAST(sum(cents) AS DOUBLE) AS revenue, CAST(max(cents) AS DOUBLE) AS highest, "
        "CAST(min(cents) AS DOUBLE) AS lowest FROM fact GROUP BY ALL",
        "age_band": crm
        + ", aged AS (SELECT msisdn, year_of_birth, "
        f"{_AGE} AS age FROM crm) "
        "SELECT *, (age - age % 10) || '-' || (age - age % 10 + 9) AS age_group FROM aged",
        "publish_week_json": revenue
        + """SELECT '{' || coalesce('"msisdn":"' || msisdn || '",', '') || '"week_number":' || week_number
        || ',"revenue_usd":' || revenue_usd || '}' AS value FROM revenue WHERE week_number = 22""",
        "decode_payload": revenue + decoded,
        "stream_decode": revenue + decoded,
        "stream_enrich": full + facts,
        "stream_by_batch": full + facts,
        # In the first week only customers are known, and their device columns are empty.
        "stream_refreshed": full + facts + " WHERE week_number <> 22 UNION ALL "
        "SELECT msisdn, gender, year_of_birth, system_status, mobile_type, value_segment, NULL, NULL, NULL, "
        "NULL, NULL, week_number, CAST(revenue_usd AS DOUBLE) FROM crm JOIN revenue USING (msisdn) "
        "WHERE week_number = 22",
        "replay_weeks": full + facts,
        "replay_resent_week": full + facts,
        "stream_rejects": revenue
        + """SELECT 'week ' || week_number AS text, 'unreadable' AS cause FROM revenue GROUP BY week_number
        UNION ALL SELECT '{"week_number":' || week_number || ',"revenue_usd":' || revenue_usd || '}', 'no key'
        FROM revenue WHERE msisdn IS NULL""",
        "replay_next_week": revenue + in_double + " WHERE week_number IN (22, 23)",
        "guarded_load": device + "SELECT * FROM device",
        "export_marts": full + _long_form(),
        "marts_after_new_week": full + _long_form(),
    }
    named.update({name: full + sql for name, sql in _MARTS.items()})
    return named
