"""Column-expression helpers (all JVM-side built-ins; no UDFs)."""

from metrolens.functions.geo import EARTH_RADIUS_KM, haversine_m  # noqa: F401
from metrolens.functions.numeric import (  # noqa: F401
    corr_safe, corr_verdict, half_up_div, not_nan, rounded_avg, units,
)
