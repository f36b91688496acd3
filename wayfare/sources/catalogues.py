"""The two fixed package catalogues: code constants, so their size is bounded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# ---------------------------------------------------------------------------
# Package catalogue, 17 rows.
# id, name, meal, room, base price, spa, transfer, hotel, premium
# ---------------------------------------------------------------------------
PACKAGES = (
    ("PKG-R-BB-A", "Resort Starter BB", "BB", "A", 85.0, 0, 0, "Resort Hotel", 0),
    ("PKG-R-BB-D", "Resort Classic BB", "BB", "D", 115.0, 0, 0, "Resort Hotel", 0),
    ("PKG-R-HB-D", "Resort Comfort HB", "HB", "D", 145.0, 0, 0, "Resort Hotel", 0),
    ("PKG-R-HB-F", "Resort Premium HB", "HB", "F", 185.0, 1, 0, "Resort Hotel", 1),
    ("PKG-R-HB-G", "Resort Deluxe HB", "HB", "G", 210.0, 1, 0, "Resort Hotel", 1),
    ("PKG-R-FB-F", "Resort Premium FB", "FB", "F", 230.0, 1, 1, "Resort Hotel", 1),
    ("PKG-R-FB-G", "Resort Deluxe FB", "FB", "G", 260.0, 1, 1, "Resort Hotel", 1),
    ("PKG-R-FB-H", "Resort Signature FB", "FB", "H", 310.0, 1, 1, "Resort Hotel", 1),
    ("PKG-C-BB-A", "City Starter BB", "BB", "A", 90.0, 0, 0, "City Hotel", 0),
    ("PKG-C-BB-D", "City Classic BB", "BB", "D", 120.0, 0, 0, "City Hotel", 0),
    ("PKG-C-HB-D", "City Comfort HB", "HB", "D", 155.0, 0, 0, "City Hotel", 0),
    ("PKG-C-HB-E", "City Business HB", "HB", "E", 170.0, 0, 1, "City Hotel", 0),
    ("PKG-C-HB-F", "City Premium HB", "HB", "F", 200.0, 1, 0, "City Hotel", 1),
    ("PKG-C-HB-G", "City Deluxe HB", "HB", "G", 225.0, 1, 0, "City Hotel", 1),
    ("PKG-C-FB-F", "City Premium FB", "FB", "F", 245.0, 1, 1, "City Hotel", 1),
    ("PKG-C-FB-G", "City Deluxe FB", "FB", "G", 275.0, 1, 1, "City Hotel", 1),
    ("PKG-C-FB-H", "City Signature FB", "FB", "H", 320.0, 1, 1, "City Hotel", 1),
)
PACKAGES_SCHEMA = (
    "package_id string, package_name string, meal_type string, room_type string, base_price double, "
    "includes_spa bigint, includes_transfer bigint, hotel_type string, is_premium bigint"
)
# Package catalogue with margins, 8 rows.
# id, name, base price, margin, breakfast, spa, transfer, minimum nights
MARGINS = (
    ("PKG001", "Standard Room", 0.0, 0.22, "N", "N", "N", 1),
    ("PKG002", "Breakfast Included", 25.0, 0.35, "Y", "N", "N", 1),
    ("PKG003", "Half Board", 60.0, 0.40, "Y", "N", "N", 2),
    ("PKG004", "Full Board", 95.0, 0.42, "Y", "N", "N", 2),
    ("PKG005", "Premium All-Inclusive", 180.0, 0.55, "Y", "Y", "Y", 3),
    ("PKG006", "Spa & Wellness", 75.0, 0.50, "N", "Y", "N", 2),
    ("PKG007", "Business Traveler", 45.0, 0.38, "Y", "N", "Y", 1),
    ("PKG008", "Romantic Getaway", 120.0, 0.48, "Y", "Y", "N", 2),
)
MARGINS_SCHEMA = (
    "pkg_id string, package_name string, base_price_eur double, margin_pct double, "
    "includes_breakfast string, includes_spa string, includes_transfer string, min_nights int"
)
# ---------------------------------------------------------------------------


def _literal(spark: SparkSession, rows: tuple, schema: str) -> DataFrame:
    """The rows as an inline SQL table: the optimizer sees its few bytes."""
    def text(v):
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else f"{v}D" if isinstance(v, float) else str(v)

    names = [field.split()[0] for field in schema.split(", ")]
    values = ", ".join("(" + ", ".join(map(text, row)) + ")" for row in rows)
    casts = ", ".join(f"CAST({f.split()[0]} AS {f.split()[1]}) AS {f.split()[0]}" for f in schema.split(", "))
    return spark.sql(f"SELECT {casts} FROM VALUES {values} AS t({', '.join(names)})")


def packages(spark: SparkSession) -> DataFrame:
    return _literal(spark, PACKAGES, PACKAGES_SCHEMA)


def margin_catalogue(spark: SparkSession) -> DataFrame:
    return _literal(spark, MARGINS, MARGINS_SCHEMA)
