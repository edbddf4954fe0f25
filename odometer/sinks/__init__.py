"""Writers: lake tables, CSV feeds, alert logs, gauge text."""
