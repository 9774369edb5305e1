"""The warehouse: raw tables, dimensions, facts, reports and the job template."""
