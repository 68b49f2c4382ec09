"""The source tables as DataFrames, read with declared schemas.

Layer names follow the source: ``payer.claims`` is table ``payer_claims`` and view
``raw_payer_claims``.  Parquet columns missing from a schema are not read; a column
of another type fails the read instead of being cast.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sitelens.functions.scale import has_at_most
from sitelens.functions.temporal import Span, in_span

# fixed values: column names and types of the source tables
SCHEMAS: dict[str, str] = {
    "payer_members": "member_id string, first_name string, last_name string, dob date, gender string, "
    "address_line1 string, address_line2 string, city string, state string, zip string, "
    "latitude decimal(8,6), longitude decimal(9,6), primary_phone string, secondary_phone string, "
    "email string, preferred_language string, sms_consent boolean, tcpa_window_start_local time(6), "
    "tcpa_window_end_local time(6), primary_pcp_provider_id string, plan_id string, employer_id string, "
    "enrollment_channel string, enrollment_date date, termination_date date, created_at timestamp, "
    "updated_at timestamp",
    "payer_claims": "claim_id string, member_id string, provider_id string, facility_id string, "
    "service_date date, place_of_service_code string, procedure_code string, "
    "procedure_description string, primary_dx_code string, secondary_dx_codes string, "
    "service_line string, billed_amount decimal(7,2), allowed_amount decimal(7,2), "
    "plan_paid decimal(7,2), member_paid decimal(7,2), claim_status string, network_status string, "
    "submitted_date date, processed_date date",
    "payer_plans": "plan_id string, plan_name string, tier string, network_type string, "
    "deductible_individual decimal(6,2), deductible_family decimal(7,2), oop_max_individual decimal(6,2), "
    "oop_max_family decimal(7,2), market string, effective_year bigint",
    "payer_employers": "employer_id string, employer_name string, employee_count_band string, "
    "primary_state string, industry_sic string",
    "payer_member_eligibility_history": "eligibility_id bigint, member_id string, plan_id string, "
    "effective_date date, end_date date, coverage_type string",
    "ehr_patients": "patient_id string, mrn string, first_name string, last_name string, dob date, "
    "gender string, address_line1 string, city string, state string, zip string, "
    "primary_provider_id string",
    "ehr_encounters": "encounter_id string, patient_id string, facility_id string, provider_id string, "
    "encounter_class string, admission_dt timestamp_ntz, discharge_dt timestamp_ntz, "
    "length_of_stay_days decimal(3,1), primary_dx_code string, chief_complaint string",
    "ehr_conditions": "condition_id bigint, patient_id string, icd10_code string, condition_name string, "
    "onset_date date, resolved_date date, status string",
    "ehr_medications": "medication_id bigint, patient_id string, rxnorm_code string, "
    "medication_name string, dose string, start_date date, end_date date, prescriber_id string",
    "ehr_procedures": "procedure_id bigint, patient_id string, encounter_id string, cpt_code string, "
    "procedure_name string, performed_dt timestamp, performing_provider_id string",
    "ehr_observations_monthly": "patient_id string, observation_month date, observation_loinc string, "
    "observation_name string, n_observations bigint, avg_value_numeric decimal(7,4), n_abnormal bigint",
    "ops_facilities": "facility_id string, facility_name string, facility_type string, ownership string, "
    "address_line1 string, city string, state string, zip string, latitude decimal(8,6), "
    "longitude decimal(9,6), service_lines string, total_beds bigint, total_ors bigint, "
    "cost_index decimal(4,3)",
    "ops_providers": "provider_id string, npi string, first_name string, last_name string, "
    "specialty string, primary_facility_id string, accepting_new_patients boolean",
    "ops_appointments": "appointment_id string, member_id string, provider_id string, facility_id string, "
    "scheduled_dt_local timestamp_ntz, duration_minutes bigint, appointment_type string, "
    "specialty string, status string, booked_at timestamp",
    "ops_or_schedule": "or_case_id string, facility_id string, or_room string, "
    "scheduled_start_dt_local timestamp_ntz, scheduled_end_dt_local timestamp_ntz, "
    "actual_start_dt_local timestamp_ntz, actual_end_dt_local timestamp_ntz, cpt_code string, "
    "surgeon_id string, anesthesiologist_id string, case_class string, status string",
    "ops_bed_census_daily": "census_date date, facility_id string, unit string, total_beds bigint, "
    "occupied_beds_midnight bigint, peak_occupied_beds bigint, avg_los_days decimal(2,1)",
    "ops_referrals": "referral_id string, member_id string, referring_provider_id string, "
    "referred_to_provider_id string, referred_to_facility_id string, specialty string, status string, "
    "issued_dt timestamp, scheduled_dt timestamp, completed_dt timestamp, urgency string",
    "pharmacy_rx_claims": "rx_claim_id string, member_id string, ndc_code string, drug_name string, "
    "days_supply bigint, quantity decimal(5,2), fill_date date, prescriber_npi string, "
    "pharmacy_id string, total_cost decimal(6,2), plan_paid decimal(6,2), member_paid decimal(6,2)",
    "outreach_program_enrollments": "enrollment_id string, member_id string, program_id string, "
    "enrollment_dt timestamp, status string, completion_dt timestamp, source string",
    "outreach_wellness_programs": "program_id string, program_name string, description string, "
    "eligibility_rules string, modality string, expected_cost_offset_per_completion decimal(6,2)",
    "external_census_tract_demographics": "census_tract_geoid string, state string, county_name string, "
    "population bigint, median_household_income decimal(8,2), polygon_wkt string",
    "external_competitor_facilities": "external_facility_id string, facility_name string, "
    "facility_type string, system_owner string, address_line1 string, city string, state string, "
    "zip string, latitude decimal(8,6), longitude decimal(9,6), specialties_offered string, "
    "total_beds bigint",
    "external_drive_time_isochrones": "facility_id string, isochrone_minutes bigint, polygon_wkt string, "
    "computed_at timestamp",
}


class Network:
    """Source tables by name, with a size-checked view of the facility dimension."""

    # event columns that a window may prune on
    EVENT = {
        "payer_claims": "service_date",
        "ops_appointments": "scheduled_dt_local",
        "ehr_encounters": "admission_dt",
        "ops_or_schedule": "scheduled_start_dt_local",
        "ops_bed_census_daily": "census_date",
        "ops_referrals": "issued_dt",
    }

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._small: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        raise NotImplementedError

    def within(self, name: str, span: Span) -> DataFrame:
        """Rows of ``name`` whose event date lies in ``span``; the filter reaches the scan."""
        df = self.table(name)
        column = self.EVENT[name]
        return df.filter(in_span(F.col(column), span, df.schema[column].dataType))

    def small(self, name: str) -> DataFrame:
        """``name`` with a broadcast hint if, and only if, its counted size allows it."""
        if name not in self._small:
            fits = has_at_most(self.rows_behind(name))
            self._small[name] = F.broadcast(self.table(name)) if fits else self.table(name)
        return self._small[name]

    def rows_behind(self, name: str) -> DataFrame:
        """What to count to bound the size of ``name``."""
        return self.table(name)


class ParquetNetwork(Network):
    """One parquet folder (or file) per table under ``root``, read with declared schemas."""

    def __init__(self, spark: SparkSession, root: str, schemas: Mapping[str, str | StructType] = SCHEMAS):
        super().__init__(spark)
        self.root, self.schemas = root.rstrip("/"), schemas

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(self.schemas[name]).parquet(f"{self.root}/{name}.parquet")

    def register_views(self, names: Iterable[str] | None = None) -> None:
        for name in names or self.schemas:
            self.table(name).createOrReplaceTempView(f"raw_{name}")
