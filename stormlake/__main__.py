"""Command line for the stage jobs.

    python -m stormlake raw-to-silver RAW SILVER
    python -m stormlake silver-to-gold SILVER GOLD
    python -m stormlake report SILVER OUT        # trend/count tables as Parquet
    python -m stormlake train GOLD RUNS [--trials N]

The session comes from the environment (spark-submit / cluster defaults);
``--master`` is only for local runs.
"""

from __future__ import annotations

import argparse
import time

from stormlake.plans import jobs
from stormlake.session import get_spark
from stormlake.sources.files import write_parquet


def main() -> None:
    ap = argparse.ArgumentParser(prog="stormlake")
    ap.add_argument("--master", default=None)
    sub = ap.add_subparsers(dest="cmd", required=True)
    for name, a, b in [("raw-to-silver", "raw", "silver"), ("silver-to-gold", "silver", "gold"),
                       ("report", "silver", "out"), ("train", "gold", "runs")]:
        p = sub.add_parser(name)
        p.add_argument(a)
        p.add_argument(b)
        if name == "train":
            p.add_argument("--trials", type=int, default=50)
    a = ap.parse_args()
    spark = get_spark(a.master)
    t0 = time.time()
    if a.cmd == "raw-to-silver":
        print(jobs.raw_to_silver(spark, a.raw, a.silver))
    elif a.cmd == "silver-to-gold":
        print(jobs.silver_to_gold(spark, a.silver, a.gold))
    elif a.cmd == "report":
        for name, df in jobs.disaster_report(spark, a.silver).items():
            write_parquet(df, f"{a.out}/{name}")
    elif a.cmd == "train":
        jobs.train_models(spark, a.gold, a.runs, n_trials=a.trials)
    print(f"Execution Time: {time.time() - t0:.2f} seconds")


if __name__ == "__main__":
    main()
