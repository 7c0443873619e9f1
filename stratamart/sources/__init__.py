"""Reading deliveries, idempotent loads, warehouse tables, result files."""
