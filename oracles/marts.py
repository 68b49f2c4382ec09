"""SQL text of the marts, written from their definitions over the stand-in tables."""

from __future__ import annotations

from sitelens.sources.stand_in import AS_OF, SPAN

LO, HI, TODAY = f"DATE '{SPAN.lo}'", f"DATE '{SPAN.hi}'", f"DATE '{AS_OF}'"
ACUTE = "('surgery', 'cardiology', 'er', 'oncology')"


def during(col: str) -> str:
    return f"({col} >= {LO} AND {col} < {HI})"


def active(alias: str = "") -> str:
    a = f"{alias}." if alias else ""
    return f"({a}enrollment_date <= {TODAY} AND coalesce({a}termination_date, DATE '9999-01-01') > {TODAY})"


def miles(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"7918 * asin(sqrt(sin(radians({lat2} - {lat1}) / 2) ^ 2 + cos(radians({lat1})) "
        f"* cos(radians({lat2})) * sin(radians({lon2} - {lon1}) / 2) ^ 2))"
    )


def links(patients: str, scope: str = "", extra: str = "") -> str:
    """Nested query of every link before the one-to-one contest; ``scope`` separates runs."""
    sc = f"{scope}, " if scope else ""
    also = f", lower(trim({extra})) AS extra" if extra else ""

    def people(key: str, table: str) -> str:
        return f"""SELECT {key}, strip_accents(lower(trim(first_name))) AS fn,
                     strip_accents(lower(trim(last_name))) AS ln, dob, gender, zip{also} FROM {table}"""

    def same_run(a: str, b: str) -> str:
        return f"AND {a}.{scope} = {b}.{scope}" if scope else ""

    return f"""(
            WITH who AS MATERIALIZED ({people(sc + "patient_id", patients)}),
            whom AS MATERIALIZED ({people("member_id", "members")}),
            same_key AS MATERIALIZED (
              SELECT who.*, whom.member_id, whom.zip AS other_zip, whom.gender AS other_gender
              FROM who JOIN whom ON who.fn = whom.fn AND who.ln = whom.ln AND who.dob = whom.dob),
            settled AS MATERIALIZED (
              SELECT {sc}patient_id, min(member_id) AS member_id, 'exact' AS match_method
              FROM same_key GROUP BY ALL HAVING count(*) = 1
              UNION ALL
              SELECT {sc}patient_id,
                     arg_min(member_id, CASE WHEN gender = other_gender THEN 0
                          WHEN gender <> other_gender THEN 1 ELSE 2 END * 1000000000000 + member_id),
                     'exact_tiebreak'
              FROM same_key k WHERE zip = other_zip AND 1 < (SELECT count(*) FROM same_key o
                   WHERE o.patient_id = k.patient_id {same_run("o", "k")})
              GROUP BY ALL),
            alike AS MATERIALIZED (
              SELECT {"who." + scope + ", " if scope else ""}who.patient_id, whom.member_id,
                     jaro_winkler_similarity(concat(who.fn, ' ', who.ln), concat(whom.fn, ' ', whom.ln)) AS s
              FROM who JOIN whom ON who.dob = whom.dob AND who.gender = whom.gender
               AND (who.ln = whom.ln OR who.zip = whom.zip {"OR who.extra = whom.extra" if extra else ""})
              WHERE NOT EXISTS (FROM settled z WHERE z.patient_id = who.patient_id {same_run("z", "who")})
                AND who.fn IS NOT NULL AND who.ln IS NOT NULL)
            SELECT *, 1.0::DOUBLE AS match_confidence FROM settled
            UNION ALL
            (SELECT DISTINCT ON ({sc}patient_id) {sc}patient_id, member_id, 'fuzzy', s FROM alike
             WHERE s >= 0.92 ORDER BY s DESC, member_id))"""


def contest(claimed: str, scope: str = "") -> str:
    sc = f"{scope}, " if scope else ""
    return f"""
        SELECT {sc}patient_id, member_id, match_method, match_confidence FROM (
          SELECT *, row_number() OVER (PARTITION BY {sc}member_id
                 ORDER BY match_confidence DESC, match_method, patient_id) AS place FROM {claimed})
        WHERE place = 1"""


def crosswalk(patients: str, scope: str = "", extra: str = "") -> str:
    return contest(links(patients, scope, extra), scope)


def late_links(patients: str = "patients", scope: str = "") -> str:
    """Similar names under a neighbouring or swapped birth date, among who is still free."""
    sc = f"{scope}, " if scope else ""
    run = f"AND {{}}.{scope} = {{}}.{scope}" if scope else ""
    runs = f", (SELECT DISTINCT {scope} FROM {patients})" if scope else ""
    return f"""(
        WITH free_p AS (SELECT *, strip_accents(lower(trim(first_name))) AS fn,
                               strip_accents(lower(trim(last_name))) AS ln FROM {patients} p
                        WHERE NOT EXISTS (FROM claimed x WHERE x.patient_id = p.patient_id {run.format("x", "p")})),
        free_m AS (SELECT *, strip_accents(lower(trim(first_name))) AS fn,
                          strip_accents(lower(trim(last_name))) AS ln FROM (SELECT * FROM members {runs}) m
                   WHERE NOT EXISTS (FROM base x WHERE x.member_id = m.member_id {run.format("x", "m")})),
        near AS (SELECT {"p." + scope + ", " if scope else ""}p.patient_id, m.member_id,
                        jaro_winkler_similarity(p.fn || ' ' || p.ln, m.fn || ' ' || m.ln) AS s,
                        if(p.ln = m.ln OR p.zip = m.zip, 0.96, 0.98) AS gate
                 FROM free_p p JOIN free_m m ON p.gender = m.gender {run.format("p", "m")}
                  AND (p.ln = m.ln OR p.zip = m.zip OR p.fn = m.fn)
                 WHERE p.dob <> m.dob AND (abs(p.dob - m.dob) = 1 OR (day(p.dob) <= 12
                       AND day(m.dob) = month(p.dob) AND month(m.dob) = day(p.dob) AND year(m.dob) = year(p.dob))))
        SELECT DISTINCT ON ({sc}patient_id) {sc}patient_id, member_id, 'fuzzy_dob' AS match_method, s AS match_confidence
        FROM near WHERE s >= gate ORDER BY s DESC, member_id)"""


MARTS: dict[str, str] = {
    "xwalk": crosswalk("patients"),
    "fm": f"""
        SELECT f.*, staff AS providers_based, open_staff AS providers_accepting,
               panel_total, panel_active, sched AS appts_scheduled, done AS appts_completed,
               missed AS appts_no_show, dropped AS appts_cancelled,
               round(100.0 * missed / nullif(sched, 0), 1) AS pct_no_show,
               round(100.0 * done / nullif(sched, 0), 1) AS pct_completed,
               enc AS encounters, enc_in AS encounters_inpatient, enc_ed AS encounters_ed,
               if(cases = 0, NULL, cases) AS or_cases, if(cases = 0, NULL, stopped) AS or_cancelled,
               if(cases = 0, NULL, rooms) AS or_rooms_used, if(cases = 0, NULL, open_days) AS or_operating_days,
               booked AS or_booked_minutes,
               round(100.0 * booked / nullif(rooms * open_days * 600, 0), 1) AS or_utilization_pct,
               round(occupancy, 1) AS bed_occupancy_pct, round(los, 2) AS avg_los_days,
               n_claims AS claims, allowed AS allowed_amount, paid AS plan_paid,
               round(done / nullif(staff, 0), 1) AS appts_per_provider_based,
               round(done / nullif(panel_active, 0), 3) AS appts_per_panel_member
        FROM facilities f,
        LATERAL (SELECT count(*) AS staff, count_if(accepting_new_patients) AS open_staff
                 FROM providers WHERE primary_facility_id = f.facility_id),
        LATERAL (SELECT count(*) AS panel_total, count_if({active('m')}) AS panel_active
                 FROM members m, providers p
                 WHERE m.primary_pcp_provider_id = p.provider_id AND p.primary_facility_id = f.facility_id),
        LATERAL (SELECT count(*) AS sched, count_if(status = 'completed') AS done,
                        count_if(status = 'no_show') AS missed, count_if(status[:9] = 'cancelled') AS dropped
                 FROM appointments a
                 WHERE a.facility_id = f.facility_id AND {during('scheduled_dt_local')}),
        LATERAL (SELECT count(*) AS enc, count_if(encounter_class = 'inpatient') AS enc_in,
                        count_if(encounter_class = 'ed') AS enc_ed
                 FROM encounters e WHERE e.facility_id = f.facility_id AND {during('admission_dt')}),
        LATERAL (SELECT count(*) AS cases, count_if(actual_start_dt_local IS NULL) AS stopped,
                        count(DISTINCT or_room) AS rooms,
                        count(DISTINCT CAST(scheduled_start_dt_local AS DATE)) AS open_days,
                        CAST(sum(if(actual_start_dt_local IS NULL, NULL, date_diff('minute',
                            scheduled_start_dt_local, scheduled_end_dt_local))) AS BIGINT) AS booked
                 FROM or_schedule o
                 WHERE o.facility_id = f.facility_id AND {during('scheduled_start_dt_local')}),
        LATERAL (SELECT avg(100 * b.occupied_beds_midnight / nullif(b.total_beds, 0)) AS occupancy,
                        avg(b.avg_los_days) AS los
                 FROM bed_census b WHERE b.facility_id = f.facility_id AND {during('census_date')}),
        LATERAL (SELECT count(*) AS n_claims, CAST(coalesce(sum(allowed_amount), 0) AS DOUBLE) AS allowed,
                        CAST(coalesce(sum(c.plan_paid), 0) AS DOUBLE) AS paid
                 FROM claims c WHERE c.facility_id = f.facility_id AND {during('service_date')})""",
    "owned_share": f"""
        SELECT service_line AS line, avg(CAST(plan_paid AS DOUBLE) / nullif(CAST(allowed_amount AS DOUBLE), 0)) AS share
        FROM claims WHERE network_status = 'owned' AND {during('service_date')} GROUP BY ALL""",
    "placed_claims": f"""
        SELECT m.city AS home, m.state AS home_state, f.city AS place, f.ownership, f.facility_type, c.*,
               c.service_line IN {ACUTE} AS acute, {active('m')} AS member_active,
               m.termination_date IS NULL OR m.termination_date > {TODAY} AS not_ended,
               {miles('m.latitude', 'm.longitude', 'f.latitude', 'f.longitude')} AS miles
        FROM claims c, members m, facilities f
        WHERE m.member_id = c.member_id AND f.facility_id = c.facility_id""",
    "year_claims": f"SELECT * FROM placed_claims WHERE {during('service_date')}",
    "ms": f"""
        WITH pop AS (SELECT city, min(state) AS state, count(*) AS n, count_if({active()}) AS n_active
                     FROM members GROUP BY city),
        sites AS (SELECT city, sum(if(own AND facility_type = 'clinic', 1, 0)) AS clinics,
                         sum(if(own AND facility_type = 'hospital', 1, 0)) AS hospitals,
                         sum(if(own AND facility_type = 'urgent_care', 1, 0)) AS urgent,
                         sum(if(own, 1, 0)) AS owned, sum(if(own, 0, 1)) AS partner,
                         sum(if(own, providers_based, NULL)) AS staff, sum(appts_completed) AS done,
                         sum(if(own, total_beds, NULL)) AS beds, sum(if(own, total_ors, NULL)) AS ors
                  FROM (SELECT *, ownership = 'owned' AS own FROM fm) GROUP BY city),
        spend AS (SELECT home, count(*) AS n, CAST(sum(allowed_amount) AS DOUBLE) AS al,
                         CAST(sum(plan_paid) AS DOUBLE) AS pd,
                         CAST(sum(if(ownership = 'owned', allowed_amount, 0)) AS DOUBLE) AS al_own,
                         CAST(sum(if(place = home, allowed_amount, 0)) AS DOUBLE) AS al_home
                  FROM year_claims GROUP BY home),
        hosp AS (SELECT home, count(*) AS n, CAST(sum(allowed_amount) AS DOUBLE) AS al,
                        sum(if(place = home, 1, 0)) AS n_home, quantile_cont(miles, 0.5) AS med,
                        sum(if(miles > 30, 1, 0)) AS n_far,
                        CAST(sum(if(ownership = 'owned', NULL, plan_paid)) AS DOUBLE) / 1e6 AS lost,
                        sum(if(ownership = 'owned', NULL, CAST(allowed_amount AS DOUBLE) * share)) / 1e6 AS kept
                 FROM year_claims LEFT JOIN owned_share ON line = service_line WHERE acute GROUP BY home)
        SELECT pop.city, pop.state, pop.n AS members_total, n_active AS members_active,
               coalesce(clinics, 0)::BIGINT AS owned_clinics, coalesce(hospitals, 0)::BIGINT AS owned_hospitals,
               coalesce(urgent, 0)::BIGINT AS owned_urgent_care, coalesce(owned, 0)::BIGINT AS owned_facilities,
               coalesce(partner, 0)::BIGINT AS partner_facilities, beds::BIGINT AS owned_beds,
               ors::BIGINT AS owned_ors, coalesce(staff, 0)::BIGINT AS providers_based_owned,
               coalesce(done, 0)::BIGINT AS appts_completed_at_facilities_here, spend.n AS claims,
               round(spend.al / 1e6, 1) AS allowed_musd, round(pd / 1e6, 1) AS plan_paid_musd,
               round(100 * al_own / spend.al, 1) AS pct_allowed_owned,
               round(100 * al_home / spend.al, 1) AS pct_allowed_in_market,
               hosp.n AS acute_claims, round(hosp.al / 1e6, 1) AS acute_allowed_musd,
               round(100 * n_home / hosp.n, 1) AS pct_acute_in_market, round(med, 1) AS median_miles_to_acute,
               round(100 * n_far / hosp.n, 1) AS pct_acute_over_30mi,
               round(lost, 1) AS nonowned_acute_plan_paid_musd, round(kept, 1) AS acute_if_owned_plan_paid_musd,
               round(lost - kept, 1) AS recapture_plan_paid_musd
        FROM pop LEFT JOIN sites ON sites.city = pop.city LEFT JOIN spend ON spend.home = pop.city
        LEFT JOIN hosp ON hosp.home = pop.city""",
    "mf": """
        SELECT home AS member_city, min(home_state) AS member_state, place AS care_city, service_line,
               bool_or(acute) AS is_acute, network_status, min(ownership) AS ownership,
               home = place AS in_market, count(*) AS claims,
               round(CAST(sum(allowed_amount) AS DOUBLE) / 1e6, 4) AS allowed_musd,
               round(CAST(sum(plan_paid) AS DOUBLE) / 1e6, 4) AS plan_paid_musd,
               round(CAST(sum(allowed_amount) AS DOUBLE) * min(share) / 1e6, 4) AS if_owned_plan_paid_musd
        FROM year_claims JOIN owned_share ON line = service_line
        GROUP BY home, place, service_line, network_status""",
    "obs_month": """
        SELECT patient_id, CAST(date_trunc('month', observation_dt) AS DATE) AS observation_month,
               observation_loinc, max(observation_name) AS observation_name, count(*) AS n_observations,
               avg(value_numeric) AS avg_value_numeric,
               count_if(coalesce(abnormal_flag, '') NOT IN ('', 'N')) AS n_abnormal
        FROM observations GROUP BY ALL""",
}
