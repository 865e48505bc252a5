"""Run the daily pipeline (six seeded configs) on derived bronze inputs.

    python scripts/run_daily.py <sf_dir> <out_root> [environment]
"""

from __future__ import annotations

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.plans import daily, jobs  # noqa: E402
from strata.session import build_session  # noqa: E402


def main() -> None:
    sf_dir, root = sys.argv[1], sys.argv[2]
    env = sys.argv[3] if len(sys.argv) > 3 else "dev"
    spark = build_session("local[*]")
    from strata.sources import config, derived, io
    size = io.input_bytes(spark, [f"{sf_dir}/{t}.parquet" for t in ("orders", "customer", "supplier", "lineitem")])
    config.apply_session_settings(spark, env, size)
    out = daily.run_daily(spark, daily.bronze_sources(spark, sf_dir), root, jobs.Run.start(env))
    print(json.dumps({"results": [{k: v for k, v in r.items() if k != "trace"} for r in out["results"]],
                      "alerts": len(out["alerts"])}, default=str))


if __name__ == "__main__":
    main()
