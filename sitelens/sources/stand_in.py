"""Domain tables derived from the generated star-schema files, for tests and the bench.

Every derivation is integer arithmetic on keys, so that the oracle SQL can state the
same table in its own words.  Event-date windows are applied to the base columns
before any join, the way a parquet scan of the real tables would prune.
"""

from __future__ import annotations

from datetime import date, timedelta
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelens.functions.temporal import Span, in_span
from sitelens.sources.network import Network

SPAN = Span(date(2000, 6, 1), date(2001, 6, 1))
AS_OF = date(2001, 6, 1)
EVENT_SHIFT_DAYS = 8400

# fixed values: name pools, code lists and paid shares of the stand-in
FIRST_NAMES = [
    "Maria", "Jose", "Ana", "Luis", "Carmen", "Juan", "Rosa", "Pedro",
    "Elena", "Carlos", "Lucia", "Miguel", "Sofia", "Jorge", "Teresa", "Diego",
    "Laura", "Pablo", "Marta", "Andres", "Clara", "Hugo", "Nora", "Ivan",
]
LAST_NAMES = [
    "Garcia", "Lopez", "Martinez", "Gonzalez", "Rodriguez", "Hernandez",
    "Perez", "Sanchez", "Ramirez", "Torres", "Flores", "Rivera",
    "Gomez", "Diaz", "Cruz", "Morales", "Ortiz", "Gutierrez",
    "Chavez", "Ramos", "Mendoza", "Alvarez", "Castillo", "Vasquez",
    "Romero", "Herrera", "Medina", "Aguilar", "Vargas", "Jimenez",
]
SERVICE_LINES = [
    "surgery", "cardiology", "er", "oncology",
    "imaging", "primary_care", "labs", "behavioral",
]
SPECIALTIES = ["cardiology", "family_medicine", "orthopedics", "dermatology"]
CONDITIONS = [
    "essential hypertension", "obesity", "low back pain",
    "nicotine dependence", "type 2 diabetes",
]
PAID_SHARE = {"owned": 0.44, "out_of_network": 0.80, "in_network_partner": 0.624}
STATUS = {
    "purchase": "completed",
    "view": "booked",
    "error": "no_show",
    "click": "cancelled_by_patient",
    "signup": "cancelled_by_provider",
}


# fixed values: columns of the generated files that the derivations read
BASE = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def pick(options: list[str], index: Column) -> Column:
    return F.get(F.split(F.lit(",".join(options)), ","), index.cast("int"))


def money(col: Column) -> Column:
    return col.cast("decimal(8,2)")


class StandIn(Network):
    NAMES = (
        "ops_facilities", "payer_members", "ehr_patients", "ops_providers", "payer_plans",
        "payer_employers", "outreach_wellness_programs", "external_drive_time_isochrones",
        "payer_claims", "ops_appointments", "ehr_encounters", "ops_or_schedule",
        "ops_bed_census_daily", "ehr_observations", "ops_referrals", "ehr_conditions", "ehr_procedures",
        "pharmacy_rx_claims", "payer_member_eligibility_history", "outreach_program_enrollments",
        "answers", "documents",
    )

    def __init__(self, spark: SparkSession, folder: str):
        super().__init__(spark)
        self.folder = folder.rstrip("/")
        self._built: dict[tuple[str, Span | None], DataFrame] = {}

    def base(self, name: str) -> DataFrame:
        return self.spark.read.schema(BASE[name]).parquet(f"{self.folder}/{name}.parquet")

    def _count(self, name: str) -> Column:
        return self.base(name).agg(F.count("*").alias("n")).scalar()

    @cached_property
    def _site_count(self) -> Column:
        return self._count("supplier")

    @cached_property
    def _provider_count(self) -> Column:
        return self._count("part")

    def table(self, name: str) -> DataFrame:
        return self._derived(name, None)

    def within(self, name: str, span: Span) -> DataFrame:
        if name == "ops_bed_census_daily":
            return super().within(name, span)
        if name == "ops_appointments":
            shift = timedelta(days=EVENT_SHIFT_DAYS)
            span = Span(span.lo + shift, span.hi + shift)
        return self._derived(name, span)

    def _derived(self, name: str, span: Span | None) -> DataFrame:
        if (name, span) not in self._built:
            derive = getattr(self, f"_{name}")
            self._built[name, span] = derive(span) if span else derive()
        return self._built[name, span]

    def rows_behind(self, name: str) -> DataFrame:
        # one facility per supplier: no need to place them to count them
        return self.base("supplier") if name == "ops_facilities" else self.table(name)

    # --- dimensions -------------------------------------------------------

    def _placed(self, df: DataFrame, nation_key: str) -> DataFrame:
        """``df`` with city and state; both lookups are small files Spark broadcasts by size."""
        nation = self.base("nation").selectExpr("n_nationkey", "n_name AS city", "n_regionkey")
        region = self.base("region").selectExpr("r_regionkey", "r_name AS state")
        return df.join(nation, F.col(nation_key) == F.col("n_nationkey")).join(
            region, F.col("n_regionkey") == F.col("r_regionkey")
        )

    def _ops_facilities(self) -> DataFrame:
        k, n = F.col("s_suppkey"), F.col("s_nationkey")
        site = self._placed(self.base("supplier"), "s_nationkey")
        kind = (
            F.when(k % 4 == 0, "hospital").when(k % 4 == 1, "urgent_care").otherwise("clinic")
        )
        hospital = k % 4 == 0
        return site.select(
            k.alias("facility_id"),
            F.col("s_name").alias("facility_name"),
            kind.alias("facility_type"),
            F.when(k % 3 == 0, "owned").otherwise("partner").alias("ownership"),
            "city",
            "state",
            (k * 13 % 97 + 10000).cast("string").alias("zip"),
            ((n * 50 + 3000 + k % 7) / 100).alias("latitude"),
            ((n * 70 - 12000 + k % 11) / 100).alias("longitude"),
            F.when(hospital, "surgery,cardiology,er,oncology")
            .when(k % 4 == 1, "er,imaging")
            .otherwise("primary_care,labs,behavioral")
            .alias("service_lines"),
            F.when(hospital, k % 50 * 5 + 100).alias("total_beds"),
            F.when(hospital, k % 8 + 4).alias("total_ors"),
            ((k % 400 + 800) / 1000).alias("cost_index"),
        )

    def _payer_members(self) -> DataFrame:
        k, n = F.col("c_custkey"), F.col("c_nationkey")
        people = self._placed(self.base("customer"), "c_nationkey")
        family = k * 11 + F.when(k % 10 == 9, 0).otherwise(F.floor(k / 600))
        enrolled = F.date_add(F.lit(date(1995, 1, 1)), (k * 37 % 2600).cast("int"))
        return people.select(
            k.alias("member_id"),
            pick(FIRST_NAMES, k * 7 % 24).alias("first_name"),
            pick(LAST_NAMES, family % 30).alias("last_name"),
            F.date_add(F.lit(date(1960, 1, 1)), (k % 200).cast("int")).alias("dob"),
            F.when(k % 2 == 0, "F").otherwise("M").alias("gender"),
            F.concat((k + 100).cast("string"), F.lit(" Oak St")).alias("address_line1"),
            "city",
            "state",
            (k * 13 % 97 + 10000).cast("string").alias("zip"),
            ((n * 50 + 3000 + k % 13 * 2) / 100).alias("latitude"),
            ((n * 70 - 12000 + k % 17 * 2) / 100).alias("longitude"),
            (k % self._provider_count).alias("primary_pcp_provider_id"),
            F.col("c_mktsegment").alias("plan_id"),
            F.when(k % 20 >= 7, k % 50).alias("employer_id"),
            enrolled.alias("enrollment_date"),
            F.when(
                k % 20 == 0, F.date_add(enrolled, (k % 1500 + 30).cast("int"))
            ).alias("termination_date"),
        )

    def _ehr_patients(self) -> DataFrame:
        k = F.col("member_id")
        case = k % 20
        first, last = F.col("first_name"), F.col("last_name")
        swapped = F.concat(
            F.substring(last, 1, 1),
            F.substring(last, 3, 1),
            F.substring(last, 2, 1),
            F.expr("substring(last_name, 4)"),
        )
        members = self.table("payer_members")
        real = members.filter(k % 8 != 7).select(
            F.concat(F.lit("P"), k.cast("string")).alias("patient_id"),
            F.when(case == 4, F.concat(F.upper(first), F.lit(" ")))
            .when(case == 5, F.replace(first, F.lit("o"), F.lit("ó")))
            .otherwise(first)
            .alias("first_name"),
            F.when(case == 0, swapped)
            .when(case == 1, F.concat(last, F.lit("-reyes")))
            .otherwise(last)
            .alias("last_name"),
            F.when(case == 3, F.date_add("dob", 1)).otherwise(F.col("dob")).alias("dob"),
            "gender",
            F.when(k % 12 == 0, F.concat(F.lit("Moved "), "address_line1"))
            .otherwise(F.col("address_line1"))
            .alias("address_line1"),
            "city",
            F.when(case == 2, F.lit(None))
            .when(case.isin(6, 7), "00000")
            .otherwise(F.col("zip"))
            .alias("zip"),
            F.col("primary_pcp_provider_id").alias("primary_provider_id"),
            k.alias("true_member_id"),
        )
        decoys = members.filter((k % 8 == 7) & (k % 3 == 0)).select(
            F.concat(F.lit("D"), k.cast("string")).alias("patient_id"),
            F.concat(first, F.lit("a")).alias("first_name"),
            "last_name",
            "dob",
            "gender",
            F.concat((k + 700).cast("string"), F.lit(" Elm Rd")).alias("address_line1"),
            F.lit("ELSEWHERE").alias("city"),
            "zip",
            ((k + 1) % self._provider_count).alias("primary_provider_id"),
            F.lit(None).cast("bigint").alias("true_member_id"),
        )
        return real.unionByName(decoys)

    def _ops_providers(self) -> DataFrame:
        k = F.col("p_partkey")
        return self.base("part").select(
            k.alias("provider_id"),
            pick(SPECIALTIES, k % 4).alias("specialty"),
            (k % self._site_count).alias("primary_facility_id"),
            (F.col("p_size") % 2 == 0).alias("accepting_new_patients"),
        )

    def _payer_plans(self) -> DataFrame:
        return self.base("customer").select(F.col("c_mktsegment").alias("plan_id")).distinct()

    def _payer_employers(self) -> DataFrame:
        return (
            self.base("customer").select((F.col("c_custkey") % 50).alias("employer_id")).distinct()
        )

    def _outreach_wellness_programs(self) -> DataFrame:
        program = F.concat(F.lit("PROG-"), (F.col("c_custkey") % 6).cast("string"))
        return self.base("customer").select(program.alias("program_id")).distinct()

    def _external_drive_time_isochrones(self) -> DataFrame:
        """A square of 0.02 degrees per minute around each site, as text polygons."""
        reach = F.col("isochrone_minutes") * 2
        sites = self.base("supplier").select(
            F.col("s_suppkey").alias("facility_id"),
            (F.col("s_nationkey") * 50 + 3000 + F.col("s_suppkey") % 7).alias("y"),
            (F.col("s_nationkey") * 70 - 12000 + F.col("s_suppkey") % 11).alias("x"),
            F.explode(F.array(F.lit(15), F.lit(30), F.lit(45))).alias("isochrone_minutes"),
        )

        def corner(dx: int, dy: int) -> Column:
            return F.concat_ws(
                " ",
                ((F.col("x") + reach * dx) / 100).cast("string"),
                ((F.col("y") + reach * dy) / 100).cast("string"),
            )

        ring = F.concat_ws(", ", corner(-1, -1), corner(1, -1), corner(1, 1), corner(-1, 1), corner(-1, -1))
        return sites.select(
            "facility_id",
            F.col("isochrone_minutes").cast("long").alias("isochrone_minutes"),
            F.concat(F.lit("POLYGON (("), ring, F.lit("))")).alias("polygon_wkt"),
        )

    # --- facts ------------------------------------------------------------

    def _payer_claims(self, span: Span | None = None) -> DataFrame:
        items = self.base("lineitem")
        if span:
            items = items.filter(in_span(F.col("l_shipdate"), span, "timestamp_ntz"))
        orders = self.base("orders").select("o_orderkey", "o_custkey")
        status = (
            F.when(F.col("l_suppkey") % 3 == 0, "owned")
            .when(F.col("l_returnflag") == "R", "out_of_network")
            .otherwise("in_network_partner")
        )
        share = F.when(status == "owned", PAID_SHARE["owned"])
        for name in ("out_of_network", "in_network_partner"):
            share = share.when(status == name, PAID_SHARE[name])
        paid = F.col("l_extendedprice") * share * (1 - F.col("l_discount"))
        served = F.to_date("l_shipdate")
        return items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
            F.col("o_custkey").alias("member_id"),
            F.col("l_suppkey").alias("facility_id"),
            F.col("l_partkey").alias("provider_id"),
            served.alias("service_date"),
            pick(SERVICE_LINES, F.col("l_partkey") % 8).alias("service_line"),
            status.alias("network_status"),
            money(F.col("l_extendedprice")).alias("allowed_amount"),
            money(F.floor(paid * 100) / 100).alias("plan_paid"),
            F.date_add(served, (F.col("l_orderkey") % 75 + 30).cast("int")).alias("processed_date"),
        )

    def _ops_appointments(self, span: Span | None = None) -> DataFrame:
        k = F.col("event_id")
        events = self.base("events")
        if span:
            events = events.filter(in_span(F.col("ts"), span, "timestamp_ntz"))
        at = F.col("ts") - F.expr(f"INTERVAL '{EVENT_SHIFT_DAYS}' DAY")
        status = F.col("event_type")
        for event, label in STATUS.items():
            status = F.when(F.col("event_type") == event, label).otherwise(status)
        provider = k * 7 % self._provider_count
        return events.select(
            k.alias("appointment_id"),
            F.col("user_id").alias("member_id"),
            provider.alias("provider_id"),
            (k % self._site_count).alias("facility_id"),
            at.alias("scheduled_dt_local"),
            pick(SPECIALTIES, F.when(k % 10 == 0, k % 4).otherwise(provider % 4)).alias("specialty"),
            status.alias("status"),
            F.date_add(F.to_date(at), -(k % 60).cast("int")).alias("booked_at"),
        )

    def _ehr_encounters(self, span: Span | None = None) -> DataFrame:
        visits = self._orders_in(span)
        kind = (
            F.when(F.col("o_orderpriority") == "1-URGENT", "ed")
            .when(F.col("o_orderpriority") == "2-HIGH", "inpatient")
            .otherwise("ambulatory")
        )
        return visits.select(
            F.col("o_orderkey").alias("encounter_id"),
            F.concat(F.lit("P"), F.col("o_custkey").cast("string")).alias("patient_id"),
            (F.col("o_orderkey") % self._site_count).alias("facility_id"),
            kind.alias("encounter_class"),
            F.col("o_orderdate").alias("admission_dt"),
        )

    def _orders_in(self, span: Span | None) -> DataFrame:
        orders = self.base("orders")
        if span is None:
            return orders
        return orders.filter(in_span(F.col("o_orderdate"), span, "timestamp_ntz"))

    def _ops_or_schedule(self, span: Span | None = None) -> DataFrame:
        items = self.base("lineitem").filter(F.col("l_suppkey") % 4 == 0)
        if span:
            items = items.filter(in_span(F.col("l_shipdate"), span, "timestamp_ntz"))
        start = F.col("l_shipdate") + F.make_dt_interval(hours=(F.col("l_orderkey") % 10).cast("int"))
        end = start + F.make_dt_interval(
            mins=(F.col("l_quantity") * 5).cast("int"),
            secs=(F.col("l_partkey") % 60).cast("decimal(18,6)"),
        )
        return items.select(
            F.col("l_suppkey").alias("facility_id"),
            F.col("l_linenumber").alias("or_room"),
            start.alias("scheduled_start_dt_local"),
            end.alias("scheduled_end_dt_local"),
            F.when(F.col("l_tax") != 0, start).alias("actual_start_dt_local"),
        )

    def _ops_bed_census_daily(self) -> DataFrame:
        k = F.col("facility_id")
        beds = F.when(F.col("unit") == "ICU", F.floor(F.col("site_beds") / 5)).otherwise(
            F.col("site_beds") - F.floor(F.col("site_beds") / 5)
        )
        return (
            self.table("ops_facilities")
            .filter(F.col("facility_type") == "hospital")
            .select(
                k,
                F.col("total_beds").alias("site_beds"),
                F.explode(F.sequence(F.lit(SPAN.lo), F.lit(SPAN.hi))).alias("census_date"),
            )
            .withColumn("unit", F.explode(F.array(F.lit("ICU"), F.lit("MED"))))
            .withColumn("total_beds", beds.cast("long"))
            .select(
                "census_date",
                "facility_id",
                "unit",
                "total_beds",
                F.floor(
                    F.col("total_beds") * (50 + (F.dayofyear("census_date") + k) % 10) / 100
                ).alias("occupied_beds_midnight"),
                ((30 + F.dayofmonth("census_date") % 5) / 10).alias("avg_los_days"),
            )
        )

    def _ehr_observations(self) -> DataFrame:
        """Row-grain observations; the monthly rollup is the table the network keeps."""
        k = F.get_json_object("props", "$.k").cast("int")
        flag = (
            F.when(k % 10 == 0, F.lit(None))
            .when(k % 3 == 0, "N")
            .when(k % 3 == 1, "")
            .otherwise("H")
        )
        return self.base("events").select(
            F.concat(F.lit("P"), F.col("user_id").cast("string")).alias("patient_id"),
            F.col("event_type").alias("observation_loinc"),
            F.upper("event_type").alias("observation_name"),
            F.col("value").alias("value_numeric"),
            F.col("ts").alias("observation_dt"),
            flag.alias("abnormal_flag"),
        )

    def _ops_referrals(self, span: Span | None = None) -> DataFrame:
        k = F.col("o_orderkey")
        issued = F.to_date("o_orderdate")
        return self._orders_in(span).select(
            k.alias("referral_id"),
            F.col("o_custkey").alias("member_id"),
            F.when(k % 9 >= 2, k % self._site_count).alias("referred_to_facility_id"),
            issued.alias("issued_dt"),
            F.when(k % 2 == 0, F.date_add(issued, 7)).alias("scheduled_dt"),
            F.when(k % 4 == 0, F.date_add(issued, 14)).alias("completed_dt"),
        )

    def _ehr_conditions(self) -> DataFrame:
        k = F.col("o_orderkey")
        return self.base("orders").select(
            k.alias("condition_id"),
            F.concat(F.lit("P"), F.col("o_custkey").cast("string")).alias("patient_id"),
            pick(CONDITIONS, (k + F.col("o_custkey")) % 5).alias("condition_name"),
            F.to_date("o_orderdate").alias("onset_date"),
        )

    def _ehr_procedures(self) -> DataFrame:
        """One for every third encounter; some name a patient that is not on file."""
        k = F.col("o_orderkey")
        return self.base("orders").filter(k % 3 == 0).select(
            k.alias("procedure_id"),
            F.when(k % 50 != 0, F.concat(F.lit("P"), F.col("o_custkey").cast("string"))).alias("patient_id"),
            k.alias("encounter_id"),
            (k % 80 + 99201).cast("string").alias("cpt_code"),
            F.date_add(F.to_date("o_orderdate"), (k % 3).cast("int")).alias("performed_dt"),
        )

    def _pharmacy_rx_claims(self) -> DataFrame:
        return self.base("orders").select(
            F.col("o_orderkey").alias("rx_claim_id"),
            F.col("o_custkey").alias("member_id"),
            F.date_add(F.to_date("o_orderdate"), 3).alias("fill_date"),
        )

    def _payer_member_eligibility_history(self) -> DataFrame:
        return self.table("payer_members").select(
            F.col("member_id").alias("eligibility_id"),
            "member_id",
            "plan_id",
            F.col("enrollment_date").alias("effective_date"),
            F.col("termination_date").alias("end_date"),
        )

    def _outreach_program_enrollments(self) -> DataFrame:
        k = F.col("c_custkey")
        return self.base("customer").filter(k % 3 == 0).select(
            k.alias("enrollment_id"),
            k.alias("member_id"),
            F.concat(F.lit("PROG-"), (k % 6).cast("string")).alias("program_id"),
            F.when(k % 4 == 0, "completed").otherwise("active").alias("status"),
        )

    # texts, screened as written answers and as documents

    def _answers(self) -> DataFrame:
        return self.base("conversations")

    def _documents(self) -> DataFrame:
        return self.base("documents")
