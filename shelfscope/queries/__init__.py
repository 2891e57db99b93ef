"""Query registrations, one module per SURVEY area."""
