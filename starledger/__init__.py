"""starledger: retail-sales profiling, cleaning, constraint checks, KPIs and
order intake over a customers / products / orders star, as Spark jobs.

Every operator is a function ``DataFrame(s) -> DataFrame``; nothing is
collected to the driver inside an operator. Money is held as integer cents
(``*_cents`` columns, exact ``bigint`` sums) and turned into ``double`` only in
the last projection of a query.
"""

__version__ = "0.1.0"
