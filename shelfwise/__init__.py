"""shelfwise: retail stock and attendance analytics as Spark DataFrame jobs.

Layout
------
sources/    declared schemas, CSV load/export, table materialisation, stand-in feeds
functions/  small column helpers (PostgreSQL null order, exact decimals, intervals, sized broadcast)
operators/  DataFrame -> DataFrame operators (movement, pricing, insights, analyses, attendance, quality)
plans/      composition of the operators into the full insights build, query registry, DuckDB oracles
streaming/  file-stream ingest of snapshot CSV drops
"""

__version__ = "0.1.0"
