"""Inputs and outputs: star-schema mapping, generator, table IO."""

from cartwheel.sources.star import STAR_TABLES, load_star, transactions_from_star  # noqa: F401
from cartwheel.sources.generator import generate_transactions  # noqa: F401
from cartwheel.sources.tables import (  # noqa: F401
    append_table,
    records_to_frame,
    read_table,
    table_exists,
    write_table,
)
