"""Write closed days of a raw folder again into few files."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from parcelle.jobs import common
from parcelle.sources import compaction


def main(argv: Sequence[str] | None = None) -> list[dt.date]:
    args = common.parser(__doc__)
    args.add_argument("--raw-files", required=True, help="folder of raw envelopes, by day")
    args.add_argument("--before", type=dt.date.fromisoformat, help="days before this one, by UTC; yesterday if not given")
    given = args.parse_args(argv)
    spark = common.session(given, "close-raw-days")
    yesterday = dt.datetime.now(dt.timezone.utc).date() - dt.timedelta(days=1)
    return compaction.close_days(spark, given.raw_files, given.before or yesterday)


if __name__ == "__main__":
    main()
