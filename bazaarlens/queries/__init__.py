"""Registered queries. Importing this package fills the registry."""

from bazaarlens.queries import (  # noqa: F401
    q01_sources,
    q02_cleaning,
    q03_star,
    q04_relational,
    q05_functions,
    q06_business,
    q07_explore,
    q08_quality,
    q09_learning,
    q10_text,
    q11_app,
    q12_streams,
    q13_contracts,
    q14_stats,
)
