"""Column expressions: dates, numbers, shipment attributes, display text."""
