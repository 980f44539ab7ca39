"""Stream job: spark-submit jobs/run_stream.py --queue-dir DIR --output DIR [--duration S | --available]"""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from fluxmill import constants as C  # noqa: E402
from fluxmill.plans import stream_job  # noqa: E402
from fluxmill.sources.event_files import EVENT_GLOB  # noqa: E402


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--queue-dir", default="queue_buffer/", help="directory of JSON event files")
    parser.add_argument("--output", default="streaming_results/")
    parser.add_argument("--window", type=int, default=C.WINDOW_SEC, help="window size in seconds")
    parser.add_argument("--max-lag", type=int, default=C.MAX_LAG_SEC, help="seconds a late event is accepted")
    parser.add_argument("--duration", type=int, default=180, help="seconds to run, 0 for ever")
    parser.add_argument("--interval", default="10 seconds", help="time between micro-batches")
    parser.add_argument("--available", action="store_true", help="process what is there, then stop")
    parser.add_argument("--load-test", action="store_true", help="report each load_<rate> directory")
    parser.add_argument("--glob", default=EVENT_GLOB, help="names of event files")
    parser.add_argument("--files-per-trigger", type=int, default=None, help="bound on files per micro-batch")
    parser.add_argument("--dedup", type=int, default=None, help="drop replays seen within this many seconds")
    parser.add_argument("--consume", action="store_true", help="delete event files once processed")
    parser.add_argument("--live", action="store_true", help="also keep open windows; not with --dedup or --consume")
    parser.add_argument("--sketches", action="store_true", help="sketches of users and latencies instead of all of them")
    parser.add_argument("--recent", type=int, default=None, help="latest latencies that count in the summary (default: all)")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("event-windows").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    reading = {"glob": args.glob, "files_per_trigger": args.files_per_trigger, "consume": args.consume}
    if args.load_test:
        stream_job.run_load_test(spark, args.queue_dir, args.output, **reading).show(truncate=False)
        return
    run = stream_job.StreamRun(
        args.queue_dir,
        args.output,
        window_sec=args.window,
        max_lag_sec=args.max_lag,
        dedup_sec=args.dedup,
        live_windows=args.live,
        exact=not args.sketches,
        recent_rows=args.recent,
        **reading,
    )
    if args.available:
        stream_job.run_available(spark, run)
    else:
        stream_job.run_for(spark, run, args.duration, args.interval)
    stream_job.summary(spark, run).show(truncate=False)


if __name__ == "__main__":
    main()
