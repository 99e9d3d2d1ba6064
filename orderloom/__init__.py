"""Retail order analytics as plain Spark jobs: raw files to audited tables, a
joined order-line table, quality gate, business aggregates and an event stream."""
