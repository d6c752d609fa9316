"""Column → Column functions (all native Spark expressions, no Python UDFs)."""

from .classify import (active_days, emission_factor, named_title, route_title, service_days,
                       title_or_ends, traction, train_class, transport_type, weekly_frequency)
from .geo import country_of_name, country_of_point, haversine_km
from .numeric import round_half_up, to_number
from .text import agency_id_of, clean_country, fold, is_valid_numeric, route_id_of
from .timeparse import day_night, strip, time_parts, time_to_seconds, to_int

__all__ = [
    "active_days", "emission_factor", "named_title", "route_title", "service_days", "title_or_ends",
    "traction", "train_class", "transport_type", "weekly_frequency", "country_of_name", "country_of_point", "haversine_km",
    "round_half_up", "to_number", "fold", "agency_id_of", "clean_country", "is_valid_numeric", "route_id_of",
    "day_night", "strip", "time_parts", "time_to_seconds", "to_int",
]
