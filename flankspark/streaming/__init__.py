"""Work that goes on as samples arrive."""
