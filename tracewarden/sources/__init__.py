"""Reading raw and clean tables, checking contracts, writing outputs."""
