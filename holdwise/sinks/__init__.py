"""K1, K2: saving tables into layers."""

from holdwise.sinks.tables import drop_table, materialize, replace_partitions, save_prices, save_table

__all__ = ["drop_table", "materialize", "replace_partitions", "save_prices", "save_table"]
