"""Full refreshes: bronze, silver, KPI tables, roll-ups.

Each layer is written once and read back, so that the KPI tables start from
the stored silver table instead of running cleaning and joins again for each,
and a lost executor costs a retry of one stage, not of the whole lineage.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import changes, curated, flight, hotel, kpi_flight, kpi_hotel, reports, rollups
from ..operators.kpi import Kpi, in_one_pass, part
from ..session import scratch_path, shuffles_freed
from ..sinks.tables import Store, replace_snapshot, stamped
from ..sources.files import audit


#: A source, or what makes it out of the sources before it, as stored.
Source = DataFrame | Callable[[dict[str, DataFrame]], DataFrame]


@dataclass
class Refresh:
    """What a run did: rows per table written, and the changes found before."""

    rows: dict[str, int] = field(default_factory=dict)
    detected: list[dict] = field(default_factory=list)

    def __getitem__(self, table: str) -> int:
        return self.rows[table]


def _bronze(
    store: Store, sources: dict[str, Source], moment: Column, run: Refresh, origins: dict[str, str] | None, compare_content: bool
) -> None:
    """Store the sources, and note what is new in each.

    A source's rows are counted by its own write, and the stored table's from its
    files' footers (no column is read), so nothing is scanned for the counts. Comparing contents reads
    both sides, before the stored one is replaced.
    """
    done = []
    for name, df in sources.items():
        if callable(df):
            df = df({n: store.read(f"bronze_{n}").drop(*hotel.AUDIT) for n in sources if n in done})
        done.append(name)
        table = f"bronze_{name}"
        stored = store.read(table) if store.exists(table) else None
        gap = None
        if compare_content and stored is not None:
            gap = changes.content_gap(name, df, stored.drop(*hotel.AUDIT)).first().asDict()
        before = None if stored is None else stored.count()
        n = run.rows[table] = store.write(audit(df, (origins or {}).get(name, name), moment), table)
        counted = {"source": name, "in_source": n, "in_bronze": before, "new_rows": None if before is None else n - before}
        run.detected.append(gap or counted)


def _gold(store: Store, silver: DataFrame, kpis: dict[str, Kpi], moment: Column, run: Refresh, summed: Sequence[str] = ()) -> None:
    """All KPI tables from one scan of silver: its grouping sets are stored once, small as they are, and cut into tables."""
    path = scratch_path(store.spark, "kpis")
    cube = in_one_pass(silver, kpis, summed)
    with shuffles_freed(store.spark):
        cube.write.parquet(path)
    stored = store.spark.read.schema(cube.schema).parquet(path)
    for name, kpi in kpis.items():
        run.rows[f"gold_{name}"] = store.write(stamped(part(stored, silver, name, kpi), moment), f"gold_{name}")


def refresh_hotel(
    spark: SparkSession,
    sources: dict[str, Source],
    store: Store,
    moment: Column | None = None,
    compare_content: bool = False,
    origins: dict[str, str] | None = None,
) -> Refresh:
    """``sources``: bookings, guests, packages. Rebuilds even if nothing is new.

    Guests that are profiles of these bookings are best given as a function of the stored
    sources (``lambda stored: profiles.guests(stored["bookings"])``): the bookings' source is read once then.

    ``origins`` names where each source came from (a path, a database table).
    """
    moment = F.current_timestamp() if moment is None else moment
    run = Refresh()
    _bronze(store, sources, moment, run, origins, compare_content)
    bronze = {n: store.read(f"bronze_{n}").drop(*hotel.AUDIT) for n in sources}
    silver = hotel.silver(bronze["bookings"], bronze["guests"], bronze["packages"], moment=moment, whole=True)
    run.rows["silver_bookings"] = store.write(silver, "silver_bookings")
    _gold(store, hotel.completed(store.read("silver_bookings")), kpi_hotel.kpis(), moment, run, kpi_hotel.SUMMED)
    return run


def hotel_boards(store: Store) -> dict[str, DataFrame]:
    """Roll-ups over the stored KPI tables."""
    gold = {n: store.read(f"gold_{n}") for n in kpi_hotel.TABLES}
    return {
        "monthly_meal_revenue": rollups.monthly_meal_revenue(gold["revenue_by_package"]),
        "monthly_conversion": rollups.monthly_conversion(gold["premium_conversion"]),
        "loyalty": rollups.loyalty(gold["revenue_by_loyalty"]),
        "segment_adr": rollups.segment_adr(gold["revenue_by_segment"]),
        "room": rollups.room(gold["revenue_by_room"]),
        "upsell": rollups.upsell(gold["upsell_opportunity"]),
        "kpi": rollups.kpi_hotel_stored(gold["premium_conversion"], gold["upsell_opportunity"]),
    }


def refresh_flight(
    spark: SparkSession,
    sources: dict[str, DataFrame],
    store: Store,
    moment: Column | None = None,
    compare_content: bool = False,
    origins: dict[str, str] | None = None,
) -> Refresh:
    """``sources``: flights, passengers, routes."""
    moment = F.current_timestamp() if moment is None else moment
    run = Refresh()
    _bronze(store, sources, moment, run, origins, compare_content)
    bronze = {n: store.read(f"bronze_{n}").drop(*hotel.AUDIT) for n in sources}
    silver = flight.silver(bronze["flights"], bronze["passengers"], bronze["routes"], moment=moment)
    run.rows["silver_flights"] = store.write(silver, "silver_flights")
    _gold(store, store.read("silver_flights"), kpi_flight.kpis(), moment, run)
    return run


def flight_boards(store: Store) -> dict[str, DataFrame]:
    gold = {n: store.read(f"gold_{n}") for n in kpi_flight.TABLES}
    segment, no_show = gold["satisfaction_by_segment"], gold["noshow_by_booking_pattern"]
    return {
        "kpi": rollups.kpi_flight_stored(segment, no_show),
        "tier": rollups.flight_tier(segment),
        "band": rollups.band_share(kpi_flight.band_counts(store.read("silver_flights"))),
        "noshow_bucket": rollups.noshow_bucket(no_show),
        "checkin": rollups.checkin(gold["friction_by_checkin"]),
        "delay": rollups.delay(gold["delay_impact"]),
        "class": rollups.seat_class(segment),
        "top_routes": rollups.top_routes(gold["satisfaction_by_route"]),
        "bottom_routes": rollups.bottom_routes(gold["satisfaction_by_route"]),
    }


def refresh_reports(
    spark: SparkSession, bookings: DataFrame, feedback: DataFrame, store: Store, snapshot_date: Column, generated_at: Column
) -> Refresh:
    """Curated tables, the two snapshot tables and their JSON export.

    ``store`` must have a root: snapshots replace their own date partition, and
    so do the exports.
    """
    run = Refresh()
    run.rows["curated_bookings"] = store.write(curated.with_booking_id(curated.bookings(bookings)), "curated_bookings")
    run.rows["curated_feedback"] = store.write(curated.feedback(feedback), "curated_feedback")
    stays, voices = store.read("curated_bookings"), store.read("curated_feedback")
    snapshots = {
        "premium_revenue": (reports.premium_snapshot(stays, snapshot_date), reports.premium_json),
        "satisfaction": (reports.satisfaction_snapshot(stays, voices, snapshot_date), reports.satisfaction_json),
    }
    for name, (snapshot, to_json) in snapshots.items():
        run.rows[name] = replace_snapshot(snapshot, f"{store.root}/{name}")
        current = spark.read.format(store.fmt).load(f"{store.root}/{name}").filter(F.col("snapshot_date") == snapshot_date)
        export = to_json(current, generated_at).withColumn("snapshot_date", snapshot_date)
        run.rows[f"{name}_json"] = replace_snapshot(export, f"{store.root}/json_export/{name}")
    return run
