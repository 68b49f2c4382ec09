"""SQL text of the stand-in tables, one entry per common table expression."""

from __future__ import annotations

from sitelens.sources import stand_in as s


def _list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


TABLES: dict[str, str] = {
    "places": """
        SELECT n_nationkey, n_name AS city, r_name AS state
        FROM nation, region WHERE n_regionkey = r_regionkey""",
    "sizes": """
        SELECT (SELECT count(*) FROM supplier) AS sites, (SELECT count(*) FROM part) AS docs""",
    "facilities": """
        SELECT s_suppkey AS facility_id, s_name AS facility_name,
               ['hospital', 'urgent_care', 'clinic', 'clinic'][s_suppkey % 4 + 1] AS facility_type,
               if(s_suppkey % 3 = 0, 'owned', 'partner') AS ownership, city, state,
               CAST(10000 + s_suppkey * 13 % 97 AS VARCHAR) AS zip,
               (3000 + s_nationkey * 50 + s_suppkey % 7) / 100 AS latitude,
               (s_nationkey * 70 - 12000 + s_suppkey % 11) / 100 AS longitude,
               ['surgery,cardiology,er,oncology', 'er,imaging', 'primary_care,labs,behavioral',
                'primary_care,labs,behavioral'][s_suppkey % 4 + 1] AS service_lines,
               if(s_suppkey % 4 = 0, 100 + s_suppkey % 50 * 5, NULL) AS total_beds,
               if(s_suppkey % 4 = 0, 4 + s_suppkey % 8, NULL) AS total_ors,
               (800 + s_suppkey % 400) / 1000 AS cost_index
        FROM supplier, places WHERE s_nationkey = n_nationkey""",
    "members": f"""
        SELECT c_custkey AS member_id,
               {_list(s.FIRST_NAMES)}[c_custkey * 7 % 24 + 1] AS first_name,
               {_list(s.LAST_NAMES)}[(c_custkey * 11 + if(c_custkey % 10 = 9, 0, c_custkey // 600)) % 30 + 1]
                   AS last_name,
               DATE '1960-01-01' + CAST(c_custkey % 200 AS INTEGER) AS dob,
               ['F', 'M'][c_custkey % 2 + 1] AS gender,
               concat(c_custkey + 100, ' Oak St') AS address_line1, city, state,
               CAST(10000 + c_custkey * 13 % 97 AS VARCHAR) AS zip,
               (3000 + c_nationkey * 50 + c_custkey % 13 * 2) / 100 AS latitude,
               (c_nationkey * 70 - 12000 + c_custkey % 17 * 2) / 100 AS longitude,
               c_custkey % docs AS primary_pcp_provider_id, c_mktsegment AS plan_id,
               if(c_custkey % 20 >= 7, c_custkey % 50, NULL) AS employer_id,
               DATE '1995-01-01' + CAST(c_custkey * 37 % 2600 AS INTEGER) AS enrollment_date,
               if(c_custkey % 20 = 0, DATE '1995-01-01'
                    + CAST(c_custkey * 37 % 2600 + 30 + c_custkey % 1500 AS INTEGER), NULL) AS termination_date
        FROM customer, places, sizes WHERE c_nationkey = n_nationkey""",
    "patients": """
        SELECT concat('P', member_id) AS patient_id,
               CASE member_id % 20 WHEN 4 THEN upper(first_name) || ' '
                    WHEN 5 THEN replace(first_name, 'o', 'ó') ELSE first_name END AS first_name,
               CASE member_id % 20
                    WHEN 0 THEN last_name[1] || last_name[3] || last_name[2] || last_name[4:]
                    WHEN 1 THEN last_name || '-reyes' ELSE last_name END AS last_name,
               dob + if(member_id % 20 = 3, 1, 0) AS dob, gender,
               if(member_id % 12 = 0, 'Moved ', '') || address_line1 AS address_line1, city,
               CASE WHEN member_id % 20 = 2 THEN NULL WHEN member_id % 20 IN (6, 7) THEN '00000'
                    ELSE zip END AS zip,
               primary_pcp_provider_id AS primary_provider_id, member_id AS true_member_id
        FROM members WHERE member_id % 8 < 7
        UNION ALL
        SELECT concat('D', member_id), first_name || 'a', last_name, dob, gender,
               concat(member_id + 700, ' Elm Rd'), 'ELSEWHERE', zip, (member_id + 1) % docs, NULL
        FROM members, sizes WHERE member_id % 8 = 7 AND member_id % 3 = 0""",
    "providers": f"""
        SELECT p_partkey AS provider_id, {_list(s.SPECIALTIES)}[p_partkey % 4 + 1] AS specialty,
               p_partkey % sites AS primary_facility_id, p_size % 2 = 0 AS accepting_new_patients
        FROM part, sizes""",
    "claims": f"""
        SELECT o_custkey AS member_id, l_suppkey AS facility_id, l_partkey AS provider_id,
               CAST(l_shipdate AS DATE) AS service_date,
               {_list(s.SERVICE_LINES)}[l_partkey % 8 + 1] AS service_line, network_status,
               CAST(l_extendedprice AS DECIMAL(8,2)) AS allowed_amount,
               CAST(floor(l_extendedprice * CAST(paid_share AS DOUBLE) * (1 - l_discount) * 100) / 100
                    AS DECIMAL(8,2)) AS plan_paid,
               CAST(l_shipdate AS DATE) + CAST(30 + l_orderkey % 75 AS INTEGER) AS processed_date
        FROM (SELECT *, CASE WHEN l_suppkey % 3 = 0 THEN 'owned' WHEN l_returnflag = 'R'
                             THEN 'out_of_network' ELSE 'in_network_partner' END AS network_status,
                     CASE network_status WHEN 'owned' THEN 0.44 WHEN 'out_of_network' THEN 0.8
                             ELSE 0.624 END AS paid_share
              FROM lineitem)
        JOIN orders ON o_orderkey = l_orderkey""",
    "appointments": f"""
        SELECT event_id AS appointment_id, user_id AS member_id, event_id * 7 % docs AS provider_id,
               event_id % sites AS facility_id, ts - INTERVAL {s.EVENT_SHIFT_DAYS} DAY AS scheduled_dt_local,
               {_list(s.SPECIALTIES)}[if(event_id % 10 = 0, event_id, event_id * 7 % docs) % 4 + 1] AS specialty,
               CASE event_type WHEN 'purchase' THEN 'completed' WHEN 'view' THEN 'booked'
                    WHEN 'error' THEN 'no_show' WHEN 'click' THEN 'cancelled_by_patient'
                    WHEN 'signup' THEN 'cancelled_by_provider' ELSE event_type END AS status,
               CAST(ts - INTERVAL {s.EVENT_SHIFT_DAYS} DAY AS DATE) - CAST(event_id % 60 AS INTEGER) AS booked_at
        FROM events, sizes""",
    "encounters": """
        SELECT o_orderkey AS encounter_id, concat('P', o_custkey) AS patient_id,
               o_orderkey % sites AS facility_id,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'ed' WHEN '2-HIGH' THEN 'inpatient'
                    ELSE 'ambulatory' END AS encounter_class, o_orderdate AS admission_dt
        FROM orders, sizes""",
    "or_schedule": """
        SELECT l_suppkey AS facility_id, l_linenumber AS or_room,
               l_shipdate + to_hours(l_orderkey % 10) AS scheduled_start_dt_local,
               l_shipdate + to_hours(l_orderkey % 10) + to_minutes(CAST(l_quantity * 5 AS BIGINT))
                   + to_seconds(l_partkey % 60) AS scheduled_end_dt_local,
               if(l_tax = 0, NULL, l_shipdate + to_hours(l_orderkey % 10)) AS actual_start_dt_local
        FROM lineitem WHERE l_suppkey % 4 = 0""",
    "bed_census": f"""
        SELECT census_date, facility_id, unit, total_beds,
               total_beds * (50 + (dayofyear(census_date) + facility_id) % 10) // 100 AS occupied_beds_midnight,
               (30 + day(census_date) % 5) / 10 AS avg_los_days
        FROM (SELECT facility_id, CAST(d AS DATE) AS census_date, unit,
                     if(unit = 'ICU', f.total_beds // 5, f.total_beds - f.total_beds // 5) AS total_beds
              FROM facilities f,
                   generate_series(TIMESTAMP '{s.SPAN.lo}', TIMESTAMP '{s.SPAN.hi}', INTERVAL 1 DAY) g(d),
                   (VALUES ('ICU'), ('MED')) u(unit)
              WHERE facility_type = 'hospital')""",
    "observations": """
        SELECT concat('P', user_id) AS patient_id, event_type AS observation_loinc,
               upper(event_type) AS observation_name, value AS value_numeric, ts AS observation_dt,
               CASE WHEN k % 10 = 0 THEN NULL ELSE ['N', '', 'H'][k % 3 + 1] END AS abnormal_flag
        FROM (SELECT *, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k FROM events)""",
    "referrals": """
        SELECT o_orderkey AS referral_id, o_custkey AS member_id,
               if(o_orderkey % 9 < 2, NULL, o_orderkey % sites) AS referred_to_facility_id,
               CAST(o_orderdate AS DATE) AS issued_dt,
               if(o_orderkey % 2 = 1, NULL, CAST(o_orderdate AS DATE) + 7) AS scheduled_dt,
               if(o_orderkey % 4 = 0, CAST(o_orderdate AS DATE) + 14, NULL) AS completed_dt
        FROM orders, sizes""",
    "conditions": f"""
        SELECT o_orderkey AS condition_id, concat('P', o_custkey) AS patient_id,
               {_list(s.CONDITIONS)}[(o_orderkey + o_custkey) % 5 + 1] AS condition_name,
               CAST(o_orderdate AS DATE) AS onset_date
        FROM orders""",
    "procedures": """
        SELECT o_orderkey AS procedure_id, if(o_orderkey % 50 = 0, NULL, concat('P', o_custkey)) AS patient_id,
               o_orderkey AS encounter_id, CAST(99201 + o_orderkey % 80 AS VARCHAR) AS cpt_code,
               CAST(o_orderdate AS DATE) + CAST(o_orderkey % 3 AS INTEGER) AS performed_dt
        FROM orders WHERE o_orderkey % 3 = 0""",
    "plans": "SELECT DISTINCT c_mktsegment AS plan_id FROM customer",
    "employers": "SELECT DISTINCT c_custkey % 50 AS employer_id FROM customer",
    "programs": "SELECT DISTINCT concat('PROG-', c_custkey % 6) AS program_id FROM customer",
    "rx_claims": """
        SELECT o_orderkey AS rx_claim_id, o_custkey AS member_id,
               CAST(o_orderdate AS DATE) + 3 AS fill_date FROM orders""",
    "eligibility": """
        SELECT member_id AS eligibility_id, member_id, plan_id, enrollment_date AS effective_date,
               termination_date AS end_date FROM members""",
    "enrollments": """
        SELECT c_custkey AS enrollment_id, c_custkey AS member_id,
               concat('PROG-', c_custkey % 6) AS program_id,
               if(c_custkey % 4 = 0, 'completed', 'active') AS status
        FROM customer WHERE c_custkey % 3 = 0""",
}
