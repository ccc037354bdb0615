"""End-to-end compositions (``flows``), registered queries (``queries``) and
their DuckDB statements (``oracle``)."""
