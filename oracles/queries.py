"""SQL for the registered queries, over the stand-in tables and marts."""

from __future__ import annotations

from oracles.assemble import with_tables
from oracles.marts import HI, LO, TODAY, active, contest, crosswalk, during, late_links, links, miles
from sitelens.plans import catalog as c


def texts(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def array(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


NAMED, CORRIDOR, TWO, FOCUS = texts(c.NAMED), texts(c.CORRIDOR), texts(c.TWO), f"'{c.FOCUS}'"

PATIENTS_SWAP = "CASE WHEN length({c}) < 4 THEN {c} ELSE {c}[1] || {c}[3] || {c}[2] || {c}[4:] END"
LAST_TYPO, FIRST_TYPO = PATIENTS_SWAP.format(c="last_name"), PATIENTS_SWAP.format(c="first_name")
SHIFTED = "CASE WHEN day(dob) > 12 THEN dob + 1 ELSE make_date(year(dob), day(dob), month(dob)) END"


def damaged(source: str) -> str:
    """``source`` once per corruption, in SQL."""
    variants = [
        ("lastname_typo", "first_name", LAST_TYPO, "dob", "zip"),
        ("firstname_typo", FIRST_TYPO, "last_name", "dob", "zip"),
        ("married_name", "first_name", "last_name || '-REYES'", "dob", "zip"),
        ("dob_day_transposed", "first_name", "last_name", SHIFTED, "zip"),
        ("zip_missing", "first_name", "last_name", "dob", "NULL"),
        ("typo_and_zip_missing", "first_name", LAST_TYPO, "dob", "NULL"),
    ]
    return " UNION ALL ".join(
        f"SELECT '{label}' AS corruption, patient_id, {fn} AS first_name, {ln} AS last_name, {dob} AS dob, "
        f"gender, CAST({zipped} AS VARCHAR) AS zip FROM {source}"
        for label, fn, ln, dob, zipped in variants
    )


# columns of each table, in order; a trailing * marks day-valued ones
COLUMNS = {
    "facilities": "facility_id facility_name facility_type ownership city state zip latitude longitude "
    "service_lines total_beds total_ors cost_index",
    "members": "member_id first_name last_name dob* gender address_line1 city state zip latitude longitude "
    "primary_pcp_provider_id plan_id employer_id enrollment_date* termination_date*",
    "patients": "patient_id first_name last_name dob* gender address_line1 city zip primary_provider_id "
    "true_member_id",
    "providers": "provider_id specialty primary_facility_id accepting_new_patients",
    "claims": "member_id facility_id provider_id service_date* service_line network_status allowed_amount "
    "plan_paid processed_date*",
    "appointments": "appointment_id member_id provider_id facility_id scheduled_dt_local* specialty status "
    "booked_at*",
    "encounters": "encounter_id patient_id facility_id encounter_class admission_dt*",
    "or_schedule": "facility_id or_room scheduled_start_dt_local* scheduled_end_dt_local* "
    "actual_start_dt_local*",
    "bed_census": "census_date* facility_id unit total_beds occupied_beds_midnight avg_los_days",
    "referrals": "referral_id member_id referred_to_facility_id issued_dt* scheduled_dt* completed_dt*",
    "conditions": "condition_id patient_id condition_name onset_date*",
    "procedures": "procedure_id patient_id encounter_id cpt_code performed_dt*",
    "plans": "plan_id",
    "employers": "employer_id",
    "programs": "program_id",
    "isochrones": "facility_id isochrone_minutes polygon_wkt",
    "observations": "patient_id observation_loinc observation_name value_numeric observation_dt* abnormal_flag",
    "identity_xwalk": "patient_id member_id match_method match_confidence",
    "facility_metrics": "facility_id facility_name facility_type ownership city state zip latitude longitude "
    "service_lines total_beds total_ors cost_index providers_based providers_accepting panel_total panel_active "
    "appts_scheduled appts_completed appts_no_show appts_cancelled pct_no_show pct_completed encounters "
    "encounters_inpatient encounters_ed or_cases or_cancelled or_rooms_used or_operating_days or_booked_minutes "
    "or_utilization_pct bed_occupancy_pct avg_los_days claims allowed_amount plan_paid appts_per_provider_based "
    "appts_per_panel_member",
    "market_summary": "city state members_total members_active owned_clinics owned_hospitals owned_urgent_care "
    "owned_facilities partner_facilities owned_beds owned_ors providers_based_owned appts_completed_at_facilities_here "
    "claims allowed_musd plan_paid_musd pct_allowed_owned pct_allowed_in_market acute_claims acute_allowed_musd "
    "pct_acute_in_market median_miles_to_acute pct_acute_over_30mi nonowned_acute_plan_paid_musd "
    "acute_if_owned_plan_paid_musd recapture_plan_paid_musd",
    "market_flows": "member_city member_state care_city service_line is_acute network_status ownership in_market claims "
    "allowed_musd plan_paid_musd if_owned_plan_paid_musd",
    "observations_monthly": "patient_id observation_month* observation_loinc observation_name n_observations "
    "avg_value_numeric n_abnormal",
    "rx_claims": "rx_claim_id member_id fill_date*",
    "eligibility": "eligibility_id member_id plan_id effective_date* end_date*",
    "enrollments": "enrollment_id member_id program_id status",
}


# where the SQL names a table or mart otherwise than the job does
SOURCES = {
    "identity_xwalk": "xwalk",
    "facility_metrics": "fm",
    "market_summary": "ms",
    "market_flows": "mf",
    "observations_monthly": "obs_month",
    "isochrones": "(SELECT s_suppkey AS facility_id, m AS isochrone_minutes, '' AS polygon_wkt "
    "FROM supplier, (VALUES (15), (30), (45)) t(m))",
}


def column_rows(tables, where: dict[str, str] | None = None) -> str:
    parts = []
    for t in tables:
        for i, col in enumerate(COLUMNS[t].split()):
            name = col.rstrip("*")
            day = f"CAST({{}}({name}) AS DATE)" if col.endswith("*") else "CAST(NULL AS DATE)"
            parts.append(
                f"SELECT '{t}' AS table_name, {i + 1}::BIGINT AS position, '{name}' AS column_name, "
                f"count(*) AS row_count, count(*) - count({name}) AS null_count, "
                f"{day.format('min')} AS first_day, {day.format('max')} AS last_day "
                f"FROM {SOURCES.get(t, t)} {(where or {}).get(t, '')}"
            )
    return " UNION ALL ".join(parts)


PATHS = [
    # referencing table and column, name used by the job, referenced table, column, name, declared share
    ("claims", "member_id", "payer_claims", "members", "member_id", "payer_members", 0),
    ("claims", "facility_id", "payer_claims", "facilities", "facility_id", "ops_facilities", 0),
    ("claims", "provider_id", "payer_claims", "providers", "provider_id", "ops_providers", 0),
    ("encounters", "patient_id", "ehr_encounters", "patients", "patient_id", "ehr_patients", 0),
    ("encounters", "facility_id", "ehr_encounters", "facilities", "facility_id", "ops_facilities", 0),
    ("procedures", "patient_id", "ehr_procedures", "patients", "patient_id", "ehr_patients", 0),
    ("conditions", "patient_id", "ehr_conditions", "patients", "patient_id", "ehr_patients", 0),
    ("appointments", "member_id", "ops_appointments", "members", "member_id", "payer_members", 0),
    ("appointments", "facility_id", "ops_appointments", "facilities", "facility_id", "ops_facilities", 0),
    ("appointments", "provider_id", "ops_appointments", "providers", "provider_id", "ops_providers", 0),
    ("referrals", "member_id", "ops_referrals", "members", "member_id", "payer_members", 0),
    ("referrals", "referred_to_facility_id", "ops_referrals", "facilities", "facility_id", "ops_facilities", 22),
    ("or_schedule", "facility_id", "ops_or_schedule", "facilities", "facility_id", "ops_facilities", 0),
    ("bed_census", "facility_id", "ops_bed_census_daily", "facilities", "facility_id", "ops_facilities", 0),
    ("providers", "primary_facility_id", "ops_providers", "facilities", "facility_id", "ops_facilities", 0),
    ("rx_claims", "member_id", "pharmacy_rx_claims", "members", "member_id", "payer_members", 0),
    ("eligibility", "member_id", "payer_member_eligibility_history", "members", "member_id", "payer_members", 0),
    ("members", "plan_id", "payer_members", "plans", "plan_id", "payer_plans", 0),
    ("members", "employer_id", "payer_members", "employers", "employer_id", "payer_employers", 35),
    ("enrollments", "member_id", "outreach_program_enrollments", "members", "member_id", "payer_members", 0),
    ("enrollments", "program_id", "outreach_program_enrollments", "programs", "program_id", "outreach_wellness_programs", 0),
    ("(SELECT s_suppkey AS facility_id FROM supplier, range(3))", "facility_id", "external_drive_time_isochrones", "facilities", "facility_id", "ops_facilities", 0),
    ("xwalk", "patient_id", "identity_xwalk", "patients", "patient_id", "ehr_patients", 0),
    ("xwalk", "member_id", "identity_xwalk", "members", "member_id", "payer_members", 0),
]


def path_rows() -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}.{col}' AS referencing, '{rname}.{rcol}' AS referenced, count(*) AS n_rows, "
        f"count_if(a.{col} IS NULL) AS n_null, count_if(a.{col} IS NOT NULL AND NOT EXISTS "
        f"(FROM {right} b WHERE b.{rcol} = a.{col})) AS orphans, {share}::DOUBLE AS declared_null_pct FROM {left} a"
        for left, col, name, right, rcol, rname, share in PATHS
    )


CLINICS = f"""(
    SELECT f.city, f.facility_id, panel, providers, completed, scheduled, encounters,
           round(100 * missed / scheduled, 1) AS pct_no_show, round(completed / providers, 1) AS per_provider,
           round(completed / nullif(panel, 0), 3) AS per_panel_member
    FROM facilities f,
    LATERAL (SELECT count(*) AS providers FROM providers WHERE primary_facility_id = f.facility_id),
    LATERAL (SELECT count(*) AS panel FROM members m, providers p WHERE m.primary_pcp_provider_id = p.provider_id
             AND p.primary_facility_id = f.facility_id),
    LATERAL (SELECT count(*) AS scheduled, count_if(status = 'completed') AS completed,
                    count_if(status = 'no_show') AS missed FROM appointments a WHERE a.facility_id = f.facility_id),
    LATERAL (SELECT count(*) AS encounters FROM encounters e
             WHERE e.facility_id = f.facility_id AND {during('admission_dt')})
    WHERE ownership = 'owned' AND facility_type = 'clinic' AND least(providers, scheduled, encounters) > 0)"""

TO_ANCHOR = f"""(
    SELECT m.city, {miles('m.latitude', 'm.longitude', 'c.lat', 'c.lon')} AS mi
    FROM members m, (SELECT avg(latitude) AS lat, avg(longitude) AS lon FROM facilities
                     WHERE ownership = 'owned' AND city = {FOCUS}) c
    WHERE {active('m')})"""

AGREE = f"""(
    SELECT match_method, count(*) AS n,
           avg(if(lower(trim(p.address_line1)) = lower(trim(m.address_line1)), 100.0::DOUBLE, 0)) AS address,
           avg(if(p.city = m.city, 100.0::DOUBLE, 0)) AS city,
           avg(if(p.primary_provider_id = m.primary_pcp_provider_id, 100.0::DOUBLE, 0)) AS pcp
    FROM (SELECT patient_id, member_id, match_method FROM xwalk
          UNION ALL
          SELECT patient_id, member_id, 'random_control' FROM
            (SELECT patient_id, row_number() OVER (ORDER BY md5(patient_id), patient_id) AS i FROM patients)
            JOIN (SELECT member_id, row_number() OVER (ORDER BY md5(CAST(member_id AS VARCHAR)), member_id) AS i
                  FROM members) USING (i)) x
    JOIN patients p USING (patient_id) JOIN members m USING (member_id) GROUP BY match_method)"""

TRUTH = f"""(
    SELECT p.*, x.member_id FROM patients p JOIN xwalk x USING (patient_id) WHERE match_method = 'exact')"""

OUT = "sum(if(place <> home, allowed_amount, 0))::DOUBLE"
ALL = "sum(allowed_amount)::DOUBLE"

BANNED = "list_filter(" + array(c.PHRASES) + ", lambda p: contains(lower(text), lower(p)))"
PICKED = f"""(
    SELECT conv_id, turn, arg_min(e, (-n, pos, e)) FILTER (n > 0) AS recommendation
    FROM (SELECT conv_id, turn, e, (length(text) - length(replace(text, e, ''))) // length(e) AS n,
                 instr(text, e) AS pos
          FROM conversations, unnest({array(c.ENTITIES)}) u(e))
    GROUP BY conv_id, turn)"""


def flags() -> str:
    return ", ".join(
        "(" + " OR ".join(f"contains(lower(text), lower('{w}'))" for w in words) + f") AS {name}"
        for name, words in c.MARKERS.items()
    )


def names_entity(col: str) -> str:
    return "(" + " OR ".join(f"contains({col}, '{e}')" for e in c.DOCUMENT_ENTITIES) + ")"


PARTED = f"""(SELECT doc_id, blocks,
                     list_filter(blocks, lambda b: NOT (b[1] IN ('A', 'E', 'I', 'O', 'U') AND {names_entity('b')})) AS kept
              FROM (SELECT doc_id, string_split(regexp_replace(text, '\\n([AEIOU])', chr(1) || '\\1', 'g'), chr(1)) AS blocks
                    FROM documents))"""

BODIES: dict[str, str] = {f"table_{t}": f"FROM {t}" for t in c.TABLES}

# --- functions -----------------------------------------------------------------------
BODIES |= {
    "normalized_names": """SELECT patient_id, strip_accents(lower(trim(first_name))) AS fn,
        strip_accents(lower(trim(last_name))) AS ln FROM patients""",
    "accents_stripped": "SELECT doc_id, md5(strip_accents(text)) AS stripped_md5 FROM documents",
    "name_similarity": """SELECT patient_id, round(jaro_winkler_similarity(p.first_name || ' ' || p.last_name,
        m.first_name || ' ' || m.last_name), 6) AS similarity
        FROM patients p, members m WHERE m.member_id = p.true_member_id""",
    "phrase_similarity": """SELECT a.conv_id, a.turn,
        round(jaro_winkler_similarity(lower(a.text), lower(b.text)), 6) AS similarity
        FROM conversations a JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1""",
    "home_to_care_miles": """SELECT home AS member_city, place AS care_city, count(*) AS claims,
        round(min(miles), 6) AS nearest, round(max(miles), 6) AS farthest FROM placed_claims GROUP BY ALL""",
    "or_case_minutes": """SELECT facility_id, or_room,
        date_diff('minute', scheduled_start_dt_local, scheduled_end_dt_local) AS minutes FROM or_schedule""",
    "birth_date_swaps": """SELECT member_id, if(day(dob) <= 12, make_date(year(dob), day(dob), month(dob)), NULL)
        AS swapped FROM members""",
}

# --- marts ---------------------------------------------------------------------------
BODIES |= {
    "facility_metrics": "SELECT * FROM fm",
    "market_summary": "SELECT * FROM ms",
    "market_flows": "SELECT * FROM mf",
    "identity_crosswalk": "SELECT * REPLACE (round(match_confidence, 6) AS match_confidence) FROM xwalk",
    "build_metadata": "SELECT TIMESTAMP '{at}' AS built_at, *, date_diff('day', max_event_date, DATE '{day}')"
    " AS days_behind_today FROM ({rows})".format(
        at=c.BUILT_AT,
        day=c.BUILT_AT.date(),
        rows=" UNION ALL ".join(
            f"SELECT 'raw.{name}' AS source_table, count(*) AS row_count, "
            + (f"'{event}' AS event_column, CAST(max({event}) AS DATE)" if event else "CAST(NULL AS VARCHAR) AS event_column, CAST(NULL AS DATE)")
            + f" AS max_event_date, '{landing}' AS incremental_column FROM {table}"
            for name, table, event, landing in [
                ("payer_claims", "claims", "service_date", "processed_date"),
                ("ehr_encounters", "encounters", "admission_dt", "admission_dt"),
                ("ops_appointments", "appointments", "scheduled_dt_local", "booked_at"),
                ("ops_referrals", "referrals", "issued_dt", "issued_dt"),
                ("ops_or_schedule", "or_schedule", "scheduled_start_dt_local", "scheduled_start_dt_local"),
                ("pharmacy_rx_claims", "rx_claims", "fill_date", "fill_date"),
                ("payer_members", "members", None, "updated_at"),
            ]
        ),
    ),
    "observations_monthly": "SELECT * REPLACE (round(avg_value_numeric, 6) AS avg_value_numeric) FROM obs_month",
    "site_staffing": """SELECT primary_facility_id AS facility_id, count(*) AS providers_based,
        count_if(accepting_new_patients) AS providers_accepting FROM providers GROUP BY ALL""",
    "site_panel": f"""SELECT primary_facility_id AS facility_id, count(m.member_id) AS panel_total,
        count_if(m.member_id IS NOT NULL AND {active('m')}) AS panel_active
        FROM providers p LEFT JOIN members m ON m.primary_pcp_provider_id = p.provider_id GROUP BY ALL""",
    "site_appointments": "SELECT facility_id, appts_scheduled, appts_completed, appts_no_show, appts_cancelled "
    "FROM fm WHERE appts_scheduled > 0",
    "site_encounters": "SELECT facility_id, encounters, encounters_inpatient, encounters_ed FROM fm WHERE encounters > 0",
    "site_operating_rooms": "SELECT facility_id, or_cases, or_cancelled, or_rooms_used, or_operating_days, "
    "or_booked_minutes FROM fm WHERE or_cases > 0",
    "site_bed_use": f"""SELECT facility_id, round(avg(100 * occupied_beds_midnight / nullif(total_beds, 0)), 6)
        AS bed_occupancy_pct, round(avg(avg_los_days), 6) AS avg_los_days
        FROM bed_census WHERE {during('census_date')} GROUP BY facility_id""",
    "site_claims": "SELECT facility_id, claims, allowed_amount, plan_paid FROM fm WHERE claims > 0",
    "market_members": "SELECT city, state, members_total, members_active FROM ms",
    "market_footprint": """SELECT city, count_if(own AND facility_type = 'clinic') AS owned_clinics,
        count_if(own AND facility_type = 'hospital') AS owned_hospitals,
        count_if(own AND facility_type = 'urgent_care') AS owned_urgent_care, count_if(own) AS owned_facilities,
        count_if(ownership = 'partner') AS partner_facilities,
        CAST(sum(if(own, providers_based, NULL)) AS BIGINT) AS providers_based_owned,
        CAST(sum(appts_completed) AS BIGINT) AS appts_completed,
        CAST(sum(if(own, total_beds, NULL)) AS BIGINT) AS owned_beds,
        CAST(sum(if(own, total_ors, NULL)) AS BIGINT) AS owned_ors
        FROM (SELECT *, ownership = 'owned' AS own FROM fm) GROUP BY city""",
    "owned_paid_ratio": "SELECT line AS service_line, round(share, 6) AS owned_ratio FROM owned_share",
    "acute_distance": "SELECT home AS city, round(quantile_cont(miles, 0.5), 6) AS median_miles "
    "FROM year_claims WHERE acute GROUP BY home",
}

# --- siting --------------------------------------------------------------------------
BODIES |= {
    "market_access": f"""SELECT city, members_total, members_active, owned_hospitals, owned_urgent_care,
        owned_clinics, pct_acute_in_market, median_miles_to_acute, pct_acute_over_30mi,
        round(100 - pct_allowed_in_market, 1) AS pct_dollars_out_of_market, allowed_musd,
        recapture_plan_paid_musd FROM ms WHERE city IN {NAMED}""",
    "out_of_market_dollars": f"""SELECT basis, round({ALL} / 1e6 / years, 1) AS allowed_musd,
        round({OUT} / 1e6 / years, 1) AS out_of_market_musd, round(100 * {OUT} / {ALL}, 1) AS pct_out_of_market
        FROM placed_claims, (VALUES ('trailing 12 months', 1, {LO}), ('3-year total / 3', 3, DATE '1900-01-01'))
        AS b(basis, years, since) WHERE home = {FOCUS} AND service_date >= since GROUP BY basis, years""",
    "owned_share_by_market": f"""SELECT home AS city, round(100 * sum(if(ownership = 'owned', allowed_amount, 0))::DOUBLE
        / {ALL}, 1) AS pct_allowed_owned FROM placed_claims GROUP BY home HAVING count(*) > {c.MIN_CLAIMS}""",
    "corridor_totals": f"""SELECT CAST(sum(members_active) AS BIGINT) AS corridor_active_members,
        round(sum(recapture_plan_paid_musd), 1) AS corridor_recapture_plan_paid_musd FROM ms WHERE city IN {CORRIDOR}""",
    "corridor_catchment": f"""SELECT city, count(*) AS active_members, round(quantile_cont(mi, 0.5), 1) AS median_miles_to_site,
        round(100 * count_if(mi <= 30) / count(*), 1) AS pct_within_30mi,
        round(100 * count_if(mi <= 45) / count(*), 1) AS pct_within_45mi
        FROM {TO_ANCHOR} WHERE city IN {CORRIDOR} GROUP BY city""",
    "capacity_sizing": f"""SELECT label, CAST(sum(members_active) AS BIGINT) AS members,
        round((SELECT sum(total_beds) FROM fm WHERE ownership = 'owned') * sum(members_active)
              / (SELECT sum(members_active) FROM ms), 0) AS beds_network_ratio,
        round((SELECT total_beds FROM fm WHERE facility_id = {c.ANCHOR_SITE}) * sum(members_active)
              / (SELECT a.members_active FROM ms a, fm b WHERE a.city = b.city AND b.facility_id = {c.ANCHOR_SITE}), 0)
              AS beds_anchor_ratio,
        round((SELECT sum(total_ors) FROM fm WHERE ownership = 'owned') * sum(members_active)
              / (SELECT sum(members_active) FROM ms), 1) AS ors_network_ratio
        FROM ms JOIN (VALUES {", ".join(f"('{a}', '{b}')" for a, b in c.CATCHMENTS)}) AS v(label, town) ON town = city
        GROUP BY label""",
    "share_served_in_corridor": f"""SELECT service_line, round(sum(allowed_musd), 1) AS allowed_musd,
        round(100 * sum(if(care_city IN {CORRIDOR}, allowed_musd, NULL)) / sum(allowed_musd), 1)
        AS pct_served_in_corridor FROM mf WHERE member_city IN {CORRIDOR} GROUP BY service_line""",
    "recapture_by_line": f"""SELECT service_line, round(sum(plan_paid_musd - if_owned_plan_paid_musd), 1)
        AS recapture_plan_paid_musd FROM mf WHERE ownership = 'partner' AND member_city IN {CORRIDOR} GROUP BY ALL""",
    "facility_benchmark": f"""SELECT facility_id, fm.city, total_beds, total_ors, or_utilization_pct,
        bed_occupancy_pct, members_active AS market_active_members
        FROM fm, ms WHERE fm.city = ms.city AND facility_id = {c.ANCHOR_SITE}""",
    "utilization_range": """SELECT min(or_utilization_pct) AS or_util_min, max(or_utilization_pct) AS or_util_max,
        min(bed_occupancy_pct) AS bed_occ_min, max(bed_occupancy_pct) AS bed_occ_max
        FROM fm WHERE facility_type = 'hospital' AND ownership = 'owned'""",
    "paid_share_by_status": f"""SELECT network_status, round(avg(allowed_amount), 0) AS avg_allowed,
        round(avg(plan_paid::DOUBLE / nullif(allowed_amount, 0)), 3) AS plan_paid_ratio
        FROM claims WHERE service_date >= {LO} GROUP BY network_status""",
    "top_recapture": """SELECT city, recapture_plan_paid_musd FROM ms
        ORDER BY recapture_plan_paid_musd DESC NULLS LAST, city LIMIT 5""",
    "reachable_catchment": f"""SELECT count_if(city = {FOCUS}) AS anchor_members,
        count_if(city = 'NATION_8') AS neighbour_members,
        count_if(city = 'NATION_8' AND mi <= 45) AS neighbour_reachable,
        count_if(city = {FOCUS} OR mi <= 45) AS reachable_members
        FROM {TO_ANCHOR} WHERE city IN ({FOCUS}, 'NATION_8')""",
    "sizing_anchors": f"""SELECT round(beds * {c.CATCHMENT} / book, 4) AS network_beds,
        round(ors * {c.CATCHMENT} / book, 4) AS network_ors, round(own_beds * {c.CATCHMENT} / own_book, 4)
        AS anchor_site_beds
        FROM (SELECT sum(total_beds) AS beds, sum(total_ors) AS ors FROM fm WHERE ownership = 'owned'),
        (SELECT sum(members_active) AS book FROM ms),
        (SELECT total_beds AS own_beds, members_active AS own_book FROM fm JOIN ms USING (city)
         WHERE facility_id = {c.ANCHOR_SITE})""",
    "active_member_acute_miles": f"""SELECT home AS city, count(*) AS n, round(quantile_cont(miles, 0.5), 6) AS median_miles
        FROM placed_claims WHERE acute AND member_active AND service_date >= {LO}
        GROUP BY home HAVING count(*) > {c.MIN_CLAIMS}""",
    "market_ranking_mart": f"""SELECT city, members_active, owned_hospitals, median_miles_to_acute,
        recapture_plan_paid_musd FROM ms WHERE members_active > {c.MIN_ACTIVE}
        ORDER BY median_miles_to_acute DESC NULLS LAST, city LIMIT 10""",
    "market_ranking_raw": f"""SELECT home AS city, (SELECT count(*) FROM members m WHERE m.city = home) AS members,
        round(quantile_cont(miles, 0.5), 6) AS median_miles FROM year_claims WHERE acute AND not_ended
        GROUP BY home HAVING count(*) > {c.MIN_ACTIVE} ORDER BY median_miles DESC, home LIMIT 10""",
    "leakage_mart": f"""SELECT city, pct_acute_in_market, nonowned_acute_plan_paid_musd
        FROM ms WHERE members_active > {c.MIN_ACTIVE}""",
    "leakage_raw": f"""SELECT home AS city, round(100 * count_if(place = home) / count(*), 6) AS pct_in_market,
        round(sum(if(ownership = 'owned', NULL, plan_paid))::DOUBLE / 1e6, 6) AS nonowned_paid_musd
        FROM year_claims WHERE acute GROUP BY home HAVING count(*) > {c.MIN_ACTIVE}""",
    "out_of_network_split": """SELECT member_city,
        round(100 * sum(if(in_market, 0, allowed_musd)) / sum(allowed_musd), 1) AS pct_out_of_market,
        round(100 * sum(if(in_market OR ownership <> 'owned', 0, allowed_musd))
              / nullif(sum(if(in_market, NULL, allowed_musd)), 0), 1) AS pct_of_leaving_at_owned,
        round(100 * sum(if(network_status = 'out_of_network', allowed_musd, 0)) / sum(allowed_musd), 1)
        AS pct_out_of_network FROM mf GROUP BY member_city""",
    "covered_leakage": f"""SELECT home AS member_city, service_line, count(*) AS claims,
        round({ALL} / 1e6, 4) AS allowed_musd,
        round(sum(if(ownership = 'owned', 0, allowed_amount))::DOUBLE / 1e6, 4) AS leaked_musd,
        round(100 * sum(if(ownership = 'owned', 0, allowed_amount))::DOUBLE / {ALL}, 2) AS pct_leaked
        FROM year_claims y WHERE EXISTS (FROM facilities f WHERE f.ownership = 'owned' AND f.city = y.home
             AND list_contains(string_split(f.service_lines, ','), y.service_line))
        GROUP BY home, service_line""",
}

# --- utilization ---------------------------------------------------------------------
BODIES |= {
    "clinic_facts": f"FROM {CLINICS}",
    "throughput_dispersion": f"""SELECT count(*) AS n_clinics, min(completed) AS min_completed,
        max(completed) AS max_completed, round(stddev_samp(completed), 0) AS sd,
        round(100 * stddev_samp(completed) / avg(completed), 2) AS cv_pct,
        round(max(completed) / min(completed), 3) AS max_min_ratio FROM {CLINICS}""",
    "encounter_dispersion": f"""SELECT round(100 * stddev_samp(encounters) / avg(encounters), 2) AS cv_pct,
        round(max(encounters) / min(encounters), 3) AS max_min_ratio FROM {CLINICS}""",
    "size_matched_pair": f"SELECT * FROM {CLINICS} WHERE facility_id IN {c.PAIR}",
    "denominator_sensitivity": f"""SELECT city, count(*) AS clinics, round(avg(completed), 0) AS per_clinic,
        round(sum(completed) / sum(providers), 1) AS per_provider,
        round(sum(completed) / sum(panel), 3) AS per_panel_member FROM {CLINICS} WHERE city IN {NAMED} GROUP BY city""",
    "owned_composition": f"""SELECT city, count_if(facility_type = 'clinic') AS clinics,
        count_if(facility_type = 'hospital') AS hospitals, count_if(facility_type = 'urgent_care') AS urgent_care
        FROM facilities WHERE city IN {NAMED} AND ownership = 'owned' GROUP BY city""",
    "top_destinations": f"""SELECT member_city, care_city, ownership, claims FROM (
        SELECT home AS member_city, place AS care_city, ownership, count(*) AS claims,
               row_number() OVER (PARTITION BY home ORDER BY count(*) DESC, place, ownership) AS r
        FROM placed_claims WHERE home IN {TWO} GROUP BY home, place, ownership) WHERE r < 7""",
    "market_leakage": f"""SELECT home AS member_city, round({ALL} / 1e6, 1) AS total_musd,
        round({OUT} / 1e6, 1) AS out_of_market_musd, round(100 * {OUT} / {ALL}, 1) AS pct_out_of_market
        FROM placed_claims WHERE home IN {TWO} GROUP BY home""",
    "claims_by_site_type": f"""SELECT home AS member_city, facility_type, place = home AS in_market, count(*) AS claims,
        round({ALL} / 1e6, 1) AS musd, round({ALL} / count(*), 0) AS avg_allowed
        FROM placed_claims WHERE home IN {TWO} GROUP BY ALL""",
    "unfiltered_denominator": f"""SELECT city, round(sum(done) / count(*), 4) AS per_clinic_all,
        round(sum(if(ownership = 'owned', done, NULL)) / nullif(count_if(ownership = 'owned'), 0), 4) AS per_clinic_owned
        FROM (SELECT f.*, (SELECT count(*) FROM appointments a WHERE a.facility_id = f.facility_id
                           AND status = 'completed') AS done FROM facilities f)
        WHERE facility_type = 'clinic' AND city IN {NAMED} GROUP BY city""",
    "member_counts": f"SELECT city, count(*) AS members FROM members WHERE city IN {TWO} GROUP BY city",
    "link_coverage": """SELECT count(*) AS links, round(100 * count(*) / (SELECT count(*) FROM patients), 4)
        AS pct_linked FROM xwalk""",
    "staffing_extremes": """SELECT (SELECT facility_id FROM fm WHERE ownership = 'owned' AND facility_type = 'clinic'
            ORDER BY providers_based DESC, facility_id LIMIT 1) AS most_staffed,
        max(providers_based) AS most_providers, round(avg(providers_based), 4) AS typical_providers
        FROM fm WHERE ownership = 'owned' AND facility_type = 'clinic'""",
    "period_coverage": "SELECT source, a AS observed_from, b AS observed_to, CASE WHEN a <= DATE '2000-01-01' AND "
    "b >= DATE '2001-01-14' THEN 'covered' WHEN a < DATE '2001-01-15' AND b >= DATE '2000-01-01' THEN "
    "'partly covered' ELSE 'outside window' END AS coverage, if(a < DATE '2001-01-15' AND b >= DATE '2000-01-01', n, "
    "NULL) AS rows_in_period FROM ("
    + " UNION ALL ".join(
        f"SELECT '{t}' AS source, CAST(min({d}) AS DATE) AS a, CAST(max({d}) AS DATE) AS b, "
        f"count_if({d} >= DATE '2000-01-01' AND {d} < DATE '2001-01-15') AS n FROM {t}"
        for t, d in [("claims", "service_date"), ("appointments", "scheduled_dt_local"), ("referrals", "issued_dt")]
    )
    + ")",
    "clinic_comparison_mart": f"""SELECT city, round(avg(appts_completed), 6) AS avg_completed FROM fm
        WHERE ownership = 'owned' AND facility_type = 'clinic' AND city IN {NAMED} GROUP BY city""",
    "clinic_comparison_raw": f"""SELECT city, round(count_if(status = 'completed') / count(DISTINCT facility_id), 6)
        AS avg_completed FROM appointments JOIN facilities USING (facility_id)
        WHERE facility_type = 'clinic' AND ownership = 'owned' AND city IN {NAMED}
        AND {during('scheduled_dt_local')} GROUP BY city""",
    "compare_facilities": f"SELECT * FROM fm WHERE facility_id IN {c.PAIR}",
    "market_profile": f"SELECT * FROM ms WHERE city = {FOCUS}",
    "realized_completion": """SELECT facility_id, count(*) AS due,
        round(100 * count_if(status = 'completed') / count(*), 2) AS pct_realized
        FROM appointments WHERE scheduled_dt_local < TIMESTAMP '2001-01-15' GROUP BY facility_id""",
    "referral_funnel": """SELECT count(*) AS issued, count(scheduled_dt) AS scheduled, count(completed_dt) AS completed,
        round(100 * count(completed_dt) / count(*), 2) AS pct_completed,
        count_if(referred_to_facility_id IS NULL) AS undirected FROM referrals""",
    "booking_lead_time": """SELECT facility_id, round(avg(d), 4) AS avg_lead_days, max(d) AS max_lead_days
        FROM (SELECT facility_id, date_diff('day', booked_at, CAST(scheduled_dt_local AS DATE)) AS d FROM appointments)
        GROUP BY facility_id""",
}

# --- people --------------------------------------------------------------------------
BODIES |= {
    "member_360": f"""SELECT m.member_id, x.patient_id, x.match_method, m.gender,
        date_sub('year', m.dob, {TODAY}) AS age, m.city, m.state, m.plan_id, m.employer_id,
        {active('m')} AS is_active, p.primary_facility_id AS pcp_facility_id,
        (SELECT count(*) FROM enrollments e WHERE e.member_id = m.member_id) AS enrollments,
        (SELECT count(*) FROM enrollments e WHERE e.member_id = m.member_id AND status = 'completed')
            AS enrollments_completed
        FROM members m LEFT JOIN xwalk x ON x.member_id = m.member_id
        LEFT JOIN providers p ON p.provider_id = m.primary_pcp_provider_id""",
    "member_months": f"""SELECT CAST(t AS DATE) AS month, count(DISTINCT member_id) AS members_covered
        FROM generate_series(TIMESTAMP '2000-06-01', TIMESTAMP '2001-05-01', INTERVAL 1 MONTH) g(t), eligibility
        WHERE effective_date < t + INTERVAL 1 MONTH AND effective_date < {HI}
          AND (end_date IS NULL OR (end_date >= t AND end_date >= {LO})) GROUP BY t""",
    "condition_prevalence": f"""SELECT condition_name, count(DISTINCT member_id) AS members, any_value(total) AS linked_members,
        round(100 * count(DISTINCT member_id) / any_value(total), 2) AS pct_of_linked
        FROM (SELECT patient_id, member_id, count(*) OVER () AS total FROM xwalk JOIN members USING (member_id)
              WHERE city = {FOCUS}) JOIN conditions USING (patient_id) GROUP BY condition_name""",
    "age_mix": f"""SELECT city, count(*) AS members, round(avg(date_sub('year', dob, {TODAY})), 4) AS mean_age,
        round(100 * count_if(date_sub('year', dob, {TODAY}) >= 41) / count(*), 4) AS pct_older FROM members GROUP BY city""",
    "drive_time_access": """SELECT f.facility_id, r::BIGINT AS isochrone_minutes, count(*) AS members_within
        FROM facilities f, (VALUES (15), (30), (45)) v(r), members m
        WHERE m.longitude >= f.longitude - r * 0.02 - 1e-9 AND m.longitude < f.longitude + r * 0.02 - 1e-9
          AND m.latitude >= f.latitude - r * 0.02 - 1e-9 AND m.latitude < f.latitude + r * 0.02 - 1e-9
        GROUP BY ALL""",
}

BODIES |= {
    "crosswalk_with_address": "SELECT * REPLACE (round(match_confidence, 6) AS match_confidence) FROM ("
    + crosswalk("patients", extra="address_line1")
    + ")",
    "crosswalk_with_date_variants": f"""SELECT patient_id, member_id, match_method,
        round(match_confidence, 6) AS match_confidence
        FROM (SELECT * FROM base UNION ALL {contest(late_links())})""",
}

# --- quality -------------------------------------------------------------------------
EVERY = [*c.PROFILED, *c.MARTS]
BODIES |= {
    "join_path_orphans": f"SELECT referencing, referenced, n_rows, orphans FROM ({path_rows()})",
    "join_path_null_rates": f"""SELECT referencing, referenced, n_rows, n_null, declared_null_pct,
        round(coalesce(100 * n_null / nullif(n_rows, 0), 0), 4) AS null_pct,
        abs(coalesce(100 * n_null / nullif(n_rows, 0), 0) - declared_null_pct) <= 2 AS null_rate_ok FROM ({path_rows()})""",
    "table_profile": column_rows(EVERY),
    "first_date_ranges": f"""SELECT DISTINCT ON (table_name) table_name, column_name, first_day, last_day
        FROM ({column_rows(EVERY)}) WHERE first_day IS NOT NULL ORDER BY table_name, position""",
    "profile_drift": f"""SELECT coalesce(a.table_name, b.table_name) AS table_name,
        coalesce(a.column_name, b.column_name) AS column_name,
        CASE WHEN a.table_name IS NULL THEN 'added' WHEN b.table_name IS NULL THEN 'removed' ELSE 'changed' END AS drift,
        a.row_count AS rows_before, b.row_count AS rows_now
        FROM ({column_rows(["claims"], {"claims": "WHERE processed_date <= DATE '2001-01-01'"})}) a
        FULL JOIN ({column_rows(["claims", "referrals"])}) b
          ON (a.table_name, a.column_name) = (b.table_name, b.column_name)
        WHERE (a.row_count, a.null_count, a.first_day, a.last_day)
              IS DISTINCT FROM (b.row_count, b.null_count, b.first_day, b.last_day)""",
    "table_emptiness": " UNION ALL ".join(f"SELECT '{t}' AS table_name, EXISTS (FROM {SOURCES.get(t, t)}) AS has_rows" for t in EVERY),
    "crosswalk_invariants": """SELECT 'patients_linked_twice' AS "check",
          (SELECT count(*) - count(DISTINCT patient_id) FROM xwalk)::DOUBLE AS value
        UNION ALL SELECT 'members_linked_twice', (SELECT count(*) - count(DISTINCT member_id) FROM xwalk)
        UNION ALL SELECT 'coverage_pct', (SELECT round(100 * (SELECT count(*) FROM xwalk) / count(*), 4) FROM patients)
        UNION ALL SELECT 'certain_links_below_one',
          (SELECT count(*) FROM xwalk WHERE match_method <> 'fuzzy' AND match_confidence < 1)
        UNION ALL SELECT 'fuzzy_links_below_threshold',
          (SELECT count(*) FROM xwalk WHERE match_method = 'fuzzy' AND match_confidence < 0.92)
        UNION ALL SELECT 'links_of_unknown_method',
          (SELECT count(*) FROM xwalk WHERE match_method NOT IN ('exact', 'exact_tiebreak', 'fuzzy'))""",
    "links_by_method": """SELECT match_method, count(*) AS links, round(min(match_confidence), 6) AS lowest,
        round(max(match_confidence), 6) AS highest FROM xwalk GROUP BY match_method""",
    "observed_windows": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{d}' AS event_column, CAST(min({d}) AS DATE) AS first_day, "
        f"CAST(max({d}) AS DATE) AS last_day FROM {t}"
        for name, t, d in [
            ("payer_claims", "claims", "service_date"),
            ("ehr_encounters", "encounters", "admission_dt"),
            ("ops_appointments", "appointments", "scheduled_dt_local"),
            ("ops_referrals", "referrals", "issued_dt"),
            ("ops_or_schedule", "or_schedule", "scheduled_start_dt_local"),
            ("pharmacy_rx_claims", "rx_claims", "fill_date"),
        ]
    ),
    "assignment_signal": """SELECT count(*) AS appointments,
        round(avg(if(primary_facility_id = facility_id, 100.0::DOUBLE, 0)), 4) AS pct_at_home_site,
        round(avg(if(a.specialty = p.specialty, 100.0::DOUBLE, 0)), 4) AS pct_own_specialty
        FROM appointments a JOIN providers p USING (provider_id)""",
    "providers_per_site": "SELECT facility_id, count(DISTINCT provider_id) AS distinct_providers FROM appointments GROUP BY 1",
    "sites_per_provider": """SELECT provider_id, count(DISTINCT facility_id) AS sites, count(DISTINCT city) AS cities,
        count(DISTINCT state) AS states FROM appointments JOIN facilities USING (facility_id) GROUP BY provider_id""",
    "mart_reconciliation": f"""SELECT "check", mart_value::DOUBLE AS mart_value, source_value::DOUBLE AS source_value,
        abs(mart_value - source_value) <= 0.01 AS ok FROM (
        SELECT 'appointments_completed' AS "check", (SELECT sum(appts_completed) FROM fm)::DOUBLE AS mart_value,
          (SELECT count(*) FROM appointments WHERE status = 'completed' AND {during('scheduled_dt_local')})::DOUBLE AS source_value
        UNION ALL SELECT 'claims', (SELECT sum(claims) FROM fm), (SELECT count(*) FROM claims WHERE {during('service_date')})
        UNION ALL SELECT 'allowed_amount', (SELECT round(sum(allowed_amount), 2) FROM fm),
          (SELECT sum(allowed_amount) FROM claims WHERE {during('service_date')})
        UNION ALL SELECT 'members', (SELECT sum(members_total) FROM ms), (SELECT count(*) FROM members)
        UNION ALL SELECT 'owned_facilities', (SELECT sum(owned_facilities) FROM ms),
          (SELECT count(*) FROM fm WHERE ownership = 'owned')
        UNION ALL SELECT 'providers', (SELECT sum(providers_based) FROM fm), (SELECT count(*) FROM providers)
        UNION ALL SELECT 'flows_allowed_musd', (SELECT round(sum(allowed_musd), 1) FROM mf),
          (SELECT round(sum(allowed_amount)::DOUBLE / 1e6, 1) FROM year_claims))""",
    "mart_grain": """SELECT 'facility_metrics' AS mart, count(*) AS n_rows, count(DISTINCT facility_id) AS distinct_keys,
          count_if(facility_id IS NULL) AS null_keys, n_rows = distinct_keys AS "unique" FROM fm
        UNION ALL SELECT 'market_summary', count(*) AS n, count(DISTINCT city) AS d, count_if(city IS NULL), n = d FROM ms
        UNION ALL SELECT 'market_flows', count(*) AS n, count(DISTINCT (member_city, care_city, service_line, network_status)) AS d,
          count_if(coalesce(member_city, care_city, service_line, network_status) IS NULL), n = d FROM mf
        UNION ALL SELECT 'identity_xwalk', count(*) AS n, count(DISTINCT (patient_id, member_id)) AS d, 0, n = d FROM xwalk""",
    "claim_key_grain": """SELECT 'claims' AS mart, count(*) AS n_rows, count(DISTINCT (member_id, facility_id, service_date))
        AS distinct_keys, 0::BIGINT AS null_keys, n_rows = distinct_keys AS "unique" FROM claims""",
    "duplicate_claim_days": """SELECT member_id, service_date, count(*) AS n FROM claims
        GROUP BY member_id, service_date HAVING n >= 2""",
    "flows_against_summary": """SELECT coalesce(city, member_city) AS city, round(a, 4) AS flow_allowed_musd, allowed_musd, round(r, 4) AS flow_recapture_musd,
        recapture_plan_paid_musd, member_city IS NOT NULL AND city IS NOT NULL
          AND coalesce(abs(a - allowed_musd) <= 0.15, a IS NULL AND allowed_musd IS NULL)
          AND coalesce(abs(r - recapture_plan_paid_musd) <= 0.15, r IS NULL AND recapture_plan_paid_musd IS NULL) AS ok
        FROM ms FULL JOIN (SELECT member_city, sum(allowed_musd) AS a, sum(if(is_acute AND ownership <> 'owned',
            plan_paid_musd - if_owned_plan_paid_musd, NULL)) AS r FROM mf GROUP BY member_city) ON member_city = city""",
    "claims_lag": """SELECT count(*) AS n, round(quantile_cont(d, 0.1), 4) AS p10_days, round(quantile_cont(d, 0.5), 4)
        AS median_days, round(quantile_cont(d, 0.9), 4) AS p90_days, max(d) AS max_days
        FROM (SELECT date_diff('day', service_date, processed_date) AS d FROM claims WHERE processed_date IS NOT NULL)""",
    "uniformity": f"""SELECT 'owned_share_spread_pp' AS monitor, (SELECT round(max(pct_allowed_owned) - min(pct_allowed_owned), 4)
          FROM ms WHERE members_active > {c.MIN_ACTIVE}) AS value
        UNION ALL SELECT 'clinic_completed_cv_pct', (SELECT round(100 * stddev_samp(appts_completed) / avg(appts_completed), 4)
          FROM fm WHERE ownership = 'owned' AND facility_type = 'clinic')
        UNION ALL SELECT 'clinic_completed_max_min', (SELECT round(max(appts_completed) / min(appts_completed), 4)
          FROM fm WHERE ownership = 'owned' AND facility_type = 'clinic')
        UNION ALL SELECT 'or_utilization_spread_pp', (SELECT round(max(or_utilization_pct) - min(or_utilization_pct), 4)
          FROM fm WHERE ownership = 'owned' AND facility_type = 'hospital')
        UNION ALL SELECT 'bed_occupancy_spread_pp', (SELECT round(max(bed_occupancy_pct) - min(bed_occupancy_pct), 4)
          FROM fm WHERE ownership = 'owned' AND facility_type = 'hospital')""",
    "conclusion_bands": f"""SELECT "check", round(v, 6) AS value, lo::DOUBLE AS lo, hi::DOUBLE AS hi,
        coalesce(round(v, 6) >= lo AND round(v, 6) <= hi, false) AS ok FROM (
        SELECT 'bed_occupancy_mean' AS "check", (SELECT avg(bed_occupancy_pct) FROM fm)::DOUBLE AS v, 53 AS lo, 54 AS hi
        UNION ALL SELECT 'owned_clinic_share_pct',
          (SELECT 100 * count_if(ownership = 'owned' AND facility_type = 'clinic') / count(*) FROM fm), 16, 20.5
        UNION ALL SELECT 'no_show_mean', (SELECT avg(pct_no_show) FROM fm), 19.5, 20.5
        UNION ALL SELECT 'owned_share_mean', (SELECT avg(pct_allowed_owned) FROM ms), 33, 38
        UNION ALL SELECT 'owned_share_spread_pp', (SELECT max(pct_allowed_owned) - min(pct_allowed_owned) FROM ms), 0, 12
        UNION ALL SELECT 'farthest_market_miles', (SELECT max(median_miles_to_acute) FROM ms), 650, 870
        UNION ALL SELECT 'recaptured_share', (SELECT sum(recapture_plan_paid_musd) / sum(nonowned_acute_plan_paid_musd) FROM ms), 0.345, 0.37
        UNION ALL SELECT 'corridor_recapture_pct', (SELECT 100 * sum(recapture_plan_paid_musd) FILTER (city IN {CORRIDOR})
          / sum(recapture_plan_paid_musd) FROM ms), 5, 15)""",
    "landed_since": """SELECT service_line, count(*) AS claims, min(service_date) AS oldest_service FROM claims
        WHERE processed_date >= DATE '2001-05-01' OR processed_date IS NULL GROUP BY service_line""",
    "restated_months": """SELECT m AS service_month, count(k) AS claims, round(coalesce(sum(paid), 0), 2)::DOUBLE AS amount
        FROM touched LEFT JOIN now ON date_trunc('month', day) = m GROUP BY m""",
    "allowed_quantiles": """SELECT service_line, round(quantile_cont(a, 0.1), 4) AS p10, round(quantile_cont(a, 0.5), 4) AS p50,
        round(quantile_cont(a, 0.9), 4) AS p90
        FROM (SELECT service_line, allowed_amount::DOUBLE AS a FROM claims) GROUP BY service_line""",
}
BODIES["metadata_counts"] = (
    "SELECT source_table, row_count AS recorded, row_count AS actual, true AS ok, "
    "incremental_column IS DISTINCT FROM event_column AS lands_after_event FROM (" + BODIES["build_metadata"] + ")"
)
BODIES["stale_builds"] = BODIES["build_metadata"]

# --- measurement and screening -------------------------------------------------------
BODIES |= {
    "heldout_agreement": f"""SELECT match_method, n, round(address, 6) AS address, round(city, 6) AS city,
        round(pcp, 6) AS pcp FROM {AGREE}""",
    "link_precision": f"""SELECT links, fuzzy_links, round(100 * a, 4) AS pct_by_address, round(100 * b, 4) AS pct_by_city,
        round(100 * p, 4) AS pct_by_pcp, round(100 * (a + b + p) / 3, 4) AS fuzzy_precision_pct,
        round(fuzzy_links * (1 - (a + b + p) / 3), 4) AS estimated_wrong,
        round(100 * (links - fuzzy_links * (1 - (a + b + p) / 3)) / links, 4) AS crosswalk_precision_pct
        FROM (SELECT coalesce(any_value(f.n), 0) AS fuzzy_links, (SELECT count(*) FROM xwalk) AS links,
                any_value((f.address - r.address) / nullif(e.address - r.address, 0)) AS a,
                any_value((f.city - r.city) / nullif(e.city - r.city, 0)) AS b,
                any_value((f.pcp - r.pcp) / nullif(e.pcp - r.pcp, 0)) AS p
              FROM agree r, agree e LEFT JOIN agree f ON f.match_method = 'fuzzy'
              WHERE r.match_method = 'random_control' AND e.match_method = 'exact')""",
    "corrupted_records": damaged("patients"),
    "link_recall": f"""SELECT corruption, count(*) AS n, count(found.member_id) AS matched,
        count(*) FILTER (found.member_id = sample.member_id) AS correct,
        round(count(*) FILTER (found.member_id = sample.member_id) / count(*), 6) AS recall,
        count(*) FILTER (found.member_id <> sample.member_id) AS wrong
        FROM sample CROSS JOIN (SELECT DISTINCT corruption FROM worse) LEFT JOIN found USING (corruption, patient_id)
        GROUP BY corruption""",
    "banned_phrases": f"""SELECT conv_id, turn, if(len({BANNED}) = 0, NULL, {BANNED}[1]) AS banned,
        len({BANNED}) = 0 AS passed FROM conversations""",
    "phrase_counts": f"""SELECT phrase, count(*) AS answers FROM conversations, unnest({array(c.PHRASES)}) u(phrase)
        WHERE contains(lower(text), lower(phrase)) GROUP BY phrase""",
    "pass_rates": f"""SELECT role, count_if(len({BANNED}) = 0) AS passed, count(*) AS total,
        round(100 * count_if(len({BANNED}) = 0) / count(*), 4) AS pct_passed FROM conversations GROUP BY role""",
    "answer_classes": f"""SELECT conv_id, turn, recommendation, {flags()}
        FROM conversations JOIN {PICKED} USING (conv_id, turn)""",
    "answer_consensus": f"""SELECT recommendation AS consensus, count(*) AS votes,
        round(count(*) / (SELECT count(*) FROM conversations), 4) AS rate FROM {PICKED}
        WHERE recommendation IS NOT NULL GROUP BY recommendation ORDER BY votes DESC, recommendation LIMIT 1""",
    "destained_documents": f"""SELECT doc_id, len(blocks)::BIGINT AS n_blocks, (len(blocks) - len(kept))::BIGINT AS removed_blocks,
        md5(coalesce(array_to_string(kept, chr(10)), '')) AS cleaned_md5,
        len(list_filter(string_split(coalesce(array_to_string(kept, chr(10)), ''), chr(10)),
            lambda l: {names_entity('l')}))::BIGINT AS residual_lines
        FROM {PARTED}""",
}

BODIES["residual_mentions"] = f"""
    SELECT doc_id, 'removed_block' AS kind, i AS position, trim(string_split(blocks[i], chr(10))[1]) AS text
    FROM (SELECT doc_id, blocks, unnest(range(1, len(blocks) + 1)) AS i FROM {PARTED})
    WHERE blocks[i][1] IN ('A', 'E', 'I', 'O', 'U') AND {names_entity('blocks[i]')}
    UNION ALL
    SELECT doc_id, 'residual_line', i, trim(lines[i])
    FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM (
          SELECT doc_id, string_split(coalesce(array_to_string(kept, chr(10)), ''), chr(10)) AS lines FROM {PARTED}))
    WHERE {names_entity('lines[i]')}"""

LOCAL = {
    # extra expressions of single queries, after the shared ones
    "crosswalk_with_date_variants": f"claimed AS MATERIALIZED (FROM {links('patients')}), "
    f"base AS MATERIALIZED ({contest('claimed')})",
    "restated_months": """versions AS (
          SELECT rx_claim_id AS k, fill_date AS day, if(k % 17 <> 0, fill_date + CAST(k % 75 AS INTEGER), NULL) AS landed,
            (member_id % 100 + 1)::DOUBLE AS paid, 1 AS version FROM rx_claims
          UNION ALL
          SELECT rx_claim_id AS k,
            CASE WHEN date_trunc('month', fill_date) = DATE '1995-04-01' THEN fill_date - 40
                 WHEN k % 3 = 0 THEN fill_date - 150 ELSE fill_date END,
            CASE WHEN date_trunc('month', fill_date) = DATE '1995-04-01' OR k % 7 <> 0
                 THEN if(k % 2 = 0, DATE '1998-07-01', DATE '1998-07-09') END,
            (member_id % 100 + 1) / 2.0, 2
          FROM rx_claims WHERE k % 5 = 0 OR date_trunc('month', fill_date) = DATE '1995-04-01'),
        now AS (SELECT * FROM versions QUALIFY row_number() OVER (PARTITION BY k ORDER BY landed DESC NULLS LAST, version DESC) = 1),
        touched AS (SELECT DISTINCT date_trunc('month', day)::DATE AS m FROM versions
          WHERE k IN (SELECT k FROM versions WHERE landed >= DATE '1998-07-01' OR landed IS NULL))""",
    "link_precision": f"agree AS MATERIALIZED (FROM {AGREE})",
    "link_recall": f"sample AS MATERIALIZED (FROM {TRUTH}), worse AS MATERIALIZED ({damaged('sample')}), "
    f"found AS MATERIALIZED ({crosswalk('worse', 'corruption')})",
    "variant_link_recall": f"sample AS MATERIALIZED (FROM {TRUTH}), worse AS MATERIALIZED ({damaged('sample')}), "
    f"claimed AS MATERIALIZED (FROM {links('worse', 'corruption')}), "
    f"base AS MATERIALIZED ({contest('claimed', 'corruption')}), "
    f"found AS MATERIALIZED (SELECT * FROM base UNION ALL {contest(late_links('worse', 'corruption'), 'corruption')})",
}
BODIES["variant_link_recall"] = BODIES["link_recall"]


def sql() -> dict[str, str]:
    return {name: with_tables(body, LOCAL.get(name)) for name, body in BODIES.items()}
