"""DataFrame -> DataFrame operators (cleaning, SCD2, screening, scoring,
warehouse keys and dimensions, data-quality reports)."""
