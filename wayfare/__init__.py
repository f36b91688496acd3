"""Travel analytics on Spark: raw bookings and flights to KPI tables."""
