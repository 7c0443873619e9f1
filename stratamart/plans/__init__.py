"""Layer by layer: raw text to typed tables, dimensions, fact, marts and reports."""
