"""DuckDB SQL that computes the registered queries a second, independent way."""
