"""Command line for the file-to-file jobs.

    python -m strata full --root s3a://bucket/city [--landing-lines] [--publish-to URI]
    python -m strata bronze|silver|gold|train --root PATH

Table locations follow ``strata.plans.medallion.Layout``. The session comes from the launcher
(``spark-submit`` configuration); ``--master`` is for local runs.
"""

from __future__ import annotations

import argparse
import json

from strata import schemas
from strata.operators import quality
from strata.plans import medallion
from strata.session import get_session
from strata.sources import landing


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="strata")
    ap.add_argument("job", choices=["bronze", "silver", "gold", "train", "full"])
    ap.add_argument("--root", required=True, help="folder or URI holding landing/, bronze/, silver/, gold/")
    ap.add_argument("--master", default=None)
    ap.add_argument("--landing-lines", action="store_true",
                    help="landing files hold JSON lines, as the publish fallback writes them "
                         "(always so for the 'topic=' folders; otherwise one object per file)")
    ap.add_argument("--landing-pattern", default="topic={topic}",
                    help="folder of one topic below landing/ ('{topic}' for one-object-per-file folders)")
    ap.add_argument("--publish-to", default=None, help="copy silver and gold below this URI (K9)")
    ap.add_argument("--no-train", action="store_true")
    ap.add_argument("--no-export", action="store_true")
    args = ap.parse_args(argv)

    spark = get_session(args.master)
    layout = medallion.Layout(args.root.rstrip("/"), landing_pattern=args.landing_pattern)
    multi_line = not (args.landing_lines or args.landing_pattern.startswith("topic="))
    bronze = [medallion.bronze_frame(landing.empty(spark, s)).schema
              for s in (schemas.TRAFFIC_SCHEMA, schemas.WEATHER_SCHEMA)]
    if args.job == "full":
        log = medallion.medallion_run(spark, layout, multi_line=multi_line, train=not args.no_train,
                                      export=not args.no_export, publish_to=args.publish_to)
    elif args.job == "bronze":
        log = [medallion.bronze_job(spark, layout.landing(layout.traffic_topic), layout.bronze(layout.traffic_topic),
                                    schemas.TRAFFIC_SCHEMA, multi_line=multi_line),
               medallion.bronze_job(spark, layout.landing(layout.weather_topic), layout.bronze(layout.weather_topic),
                                    schemas.WEATHER_SCHEMA, multi_line=multi_line)]
    elif args.job == "silver":
        log = [medallion.silver_job(spark, layout.bronze(layout.traffic_topic), layout.silver_traffic,
                                    quality.traffic_rules(), schema=bronze[0]),
               medallion.silver_job(spark, layout.bronze(layout.weather_topic), layout.silver_weather,
                                    quality.weather_rules(), schema=bronze[1])]
    elif args.job == "gold":
        log = [medallion.gold_job(spark, layout.silver_traffic, layout.silver_weather, layout.mart, layout.analytics)]
    else:
        log = [medallion.training_job(spark, layout.analytics, layout.mart, layout.models)]
    for entry in log:
        print(json.dumps(entry, default=str))


if __name__ == "__main__":
    main()
