"""Writers: evolving tables, layout, quarantine."""
