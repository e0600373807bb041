"""DataFrame operators on annual panels. None of them changes session settings."""

from yearloom.operators.aggregate import (
    clean_readings,
    country_averages,
    country_temperatures,
    null_counts,
    yearly_temperatures,
    yearly_total,
)
from yearloom.operators.fill import fill_flagged, leap_year_fill
from yearloom.operators.joins import (
    continent_lookup,
    country_panel,
    fits_broadcast,
    global_panel,
    skew_safe_join,
    with_continent,
)
from yearloom.operators.names import (
    ambiguous_names,
    match_key,
    reconciled_panel,
    unmatched_names,
)
from yearloom.operators.order import in_order
from yearloom.operators.questions import (
    largest_emitters,
    rank_polluters,
    temperature_anomalies,
    worst_anomalies,
    worst_of_widened,
)
from yearloom.operators.rank import (
    countries_only,
    country_series,
    country_temperature_series,
    emissions_temperature_curve,
    hottest_countries,
    top_emitters,
    top_observations,
    top_rows,
    without_continents,
)
from yearloom.operators.reshape import lengthen, widen
from yearloom.operators.shape import (
    after_year,
    country_emissions,
    drop_entities,
    from_year,
    keep_entities,
    with_compact_names,
    with_storable_names,
)

__all__ = [
    "after_year",
    "ambiguous_names",
    "clean_readings",
    "continent_lookup",
    "countries_only",
    "country_averages",
    "country_emissions",
    "country_panel",
    "country_series",
    "country_temperature_series",
    "country_temperatures",
    "drop_entities",
    "emissions_temperature_curve",
    "fill_flagged",
    "fits_broadcast",
    "from_year",
    "global_panel",
    "hottest_countries",
    "in_order",
    "keep_entities",
    "largest_emitters",
    "leap_year_fill",
    "lengthen",
    "match_key",
    "null_counts",
    "rank_polluters",
    "reconciled_panel",
    "skew_safe_join",
    "temperature_anomalies",
    "top_emitters",
    "top_observations",
    "top_rows",
    "unmatched_names",
    "widen",
    "with_compact_names",
    "with_continent",
    "with_storable_names",
    "without_continents",
    "worst_anomalies",
    "worst_of_widened",
    "yearly_temperatures",
    "yearly_total",
]
