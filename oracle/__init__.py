"""DuckDB SQL that states every registered query a second time, for the correctness check."""
