"""strata: layered data refinement on Spark.

Bronze tables go through declarative data-quality rules, failing rows are split
off into a reviewable quarantine, the rest is cleaned and deduplicated, then
kept as type-2 history; monitoring rows, views and health alerts describe every
run.  Everything is a DataFrame expression so Catalyst can plan and distribute
each step.

Layout:
    sources/    schemas of the service tables, environment and rule configs,
                table read/write/publish, derived inputs from the test tables
    functions/  column-level building blocks: validators, cleaning ops, hashing
    operators/  DataFrame -> DataFrame operators: rules, dedup, quarantine,
                scd2, surrogate keys, gold analytics, compare
    plans/      jobs (bronze->silver, silver->gold, config-driven runs),
                monitoring views and health, registered queries + oracles
    streaming/  micro-batch adapter that runs the same quality job per batch
"""

from strata.session import build_session, checkpoint_dir  # noqa: F401

__version__ = "0.1.0"
