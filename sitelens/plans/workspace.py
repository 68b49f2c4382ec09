"""A network, a window and a date: everything a query needs to build on."""

from __future__ import annotations

from datetime import date, datetime
from functools import cached_property

from pyspark.sql import DataFrame

from sitelens.functions.scale import staged
from sitelens.functions.temporal import Span
from sitelens.operators import facility, freshness, identity, market
from sitelens.sources.network import Network


class Workspace:
    """Marts are built on first use and shared by the queries of one workspace."""

    def __init__(self, net: Network, span: Span, as_of: date, published: dict[str, DataFrame] | None = None):
        self.net, self.span, self.as_of = net, span, as_of
        self.published = dict(published or {})

    def use(self, name: str, written: DataFrame) -> None:
        """Read a mart from where it was written from now on."""
        self.published[name] = written
        self.__dict__.pop(name, None)

    def settle(self, *names: str) -> None:
        """Write marts that the query at hand reads several times, and read those."""
        for name in names:
            if name not in self.published:
                self.use(name, staged(getattr(self, name)))

    def table(self, name: str) -> DataFrame:
        return self.net.table(name)

    def windowed(self, name: str) -> DataFrame:
        return self.net.within(name, self.span)

    def small(self, name: str) -> DataFrame:
        return self.net.small(name)

    @cached_property
    def facility_metrics(self) -> DataFrame:
        return self.published.get("facility_metrics") or facility.facility_metrics(
            self.table("ops_facilities"),
            self.table("ops_providers"),
            self.table("payer_members"),
            self.windowed("ops_appointments"),
            self.windowed("ehr_encounters"),
            self.windowed("ops_or_schedule"),
            self.windowed("ops_bed_census_daily"),
            self.windowed("payer_claims"),
            self.span,
            self.as_of,
        )

    @cached_property
    def site_capacity(self) -> DataFrame:
        """Facilities with the two volumes that the market footprint sums up; other sources are not read."""
        if "facility_metrics" in self.published:
            return self.published["facility_metrics"]
        volumes = facility.site_volumes(
            [
                facility.staffing(self.table("ops_providers")),
                facility.appointment_volume(self.windowed("ops_appointments"), self.span),
            ]
        )
        return self.table("ops_facilities").join(volumes, "facility_id", "left").fillna(0, ["providers_based", "appts_completed"])

    @cached_property
    def located_year(self) -> DataFrame:
        """Windowed claims per member, site and line with both ends placed."""
        return self.published.get("located_year") or market.located_claims(
            self.windowed("payer_claims"), self.table("payer_members"), self.small("ops_facilities"), self.span
        )

    @cached_property
    def market_summary(self) -> DataFrame:
        return self.published.get("market_summary") or market.market_summary(
            self.site_capacity,
            self.small("ops_facilities"),
            self.table("payer_members"),
            self.windowed("payer_claims"),
            self.span,
            self.as_of,
            self.published.get("located_year"),
        )

    @cached_property
    def market_flows(self) -> DataFrame:
        return self.published.get("market_flows") or market.market_flows(
            self.small("ops_facilities"),
            self.table("payer_members"),
            self.windowed("payer_claims"),
            self.span,
            self.published.get("located_year"),
        )

    @cached_property
    def identity_xwalk(self) -> DataFrame:
        return self.published.get("identity_xwalk") or identity.identity_xwalk(
            self.table("ehr_patients"), self.table("payer_members")
        )

    # fixed values: event and landing columns per source
    EVENTS = [
        ("payer_claims", "service_date", "processed_date"),
        ("ehr_encounters", "admission_dt", "admission_dt"),
        ("ops_appointments", "scheduled_dt_local", "booked_at"),
        ("ops_referrals", "issued_dt", "issued_dt"),
        ("ops_or_schedule", "scheduled_start_dt_local", "scheduled_start_dt_local"),
        ("pharmacy_rx_claims", "fill_date", "fill_date"),
        ("payer_members", None, "updated_at"),
    ]

    def sources(self) -> list[freshness.Source]:
        return [freshness.Source(n, self.table(n), e, l) for n, e, l in self.EVENTS]

    def build_metadata(self, built_at: datetime | None = None) -> DataFrame:
        return freshness.build_metadata(self.sources(), built_at or freshness.as_datetime(self.as_of))
