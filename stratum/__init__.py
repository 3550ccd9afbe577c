"""stratum: a contract-driven medallion toolkit on PySpark.

Raw delimited files packed in archives are carried through a bronze, silver,
quality and gold lake.  Every step is a DataFrame / SQL transformation that
Catalyst can optimise; Python runs on executors only inside the archive reader.

Layout
------
``functions``  Column expressions: cleaning, typed parsing, keys, rates.
``sources``    archive scan, lake layout, readers and writers.
``operators``  silver typing, the quality rule engine, generic validations,
               dimensions, facts, marts and publishing.
``plans``      the end-to-end pipeline and adapters over the test tables.
"""

from stratum.contracts import Contract, Treatment  # noqa: F401
from stratum.session import build_session, checkpoint_dir  # noqa: F401

__all__ = ["Contract", "Treatment", "build_session", "checkpoint_dir"]
