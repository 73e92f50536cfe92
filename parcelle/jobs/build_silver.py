"""Add the fresh listings of one source to the unified table, and print counts of what was read and written."""

from __future__ import annotations

import json
from collections.abc import Sequence

from parcelle import fixed_values as V
from parcelle.jobs import common
from parcelle.operators.audits import Audit
from parcelle.plans.silver import SILVER_PLANS
from parcelle.session import sized_shuffles
from parcelle.sources import compaction, labels, latest, tables


def main(argv: Sequence[str] | None = None) -> None:
    args = common.parser(__doc__)
    args.add_argument("--source", choices=V.SITES, required=True)
    args.add_argument("--raw-files", help="folder of raw envelopes to read instead of the table")
    args.add_argument("--window-mins", type=int, default=V.WINDOW_MINUTES, help="0 for all rows")
    args.add_argument(
        "--mode", choices=(tables.APPEND, tables.MERGE), default=tables.APPEND,
        help="merge leaves out versions that are there already",
    )
    args.add_argument("--labels", action="store_true", help="make columns of labels that the unified table has none for")
    args.add_argument("--latest", action="store_true", help="bring the table of newest rows up to date, too")
    args.add_argument("--rebalance", action="store_true", help="even file sizes, for backfills")
    given = args.parse_args(argv)
    spark = common.session(given, f"{given.source}-build-silver")
    if given.raw_files:
        raw = compaction.scan_raw(spark, given.raw_files, given.window_mins)
    else:
        raw = tables.scan(spark, common.raw_table(given, given.source), given.window_mins)
    audit = Audit()
    more = ()
    if given.labels:
        more = labels.follow(raw, given.source, labels.create_label_table(spark, given.catalog, given.provider), common.silver_table(given))
    listings = SILVER_PLANS[given.source](raw, audit=audit, more=more)
    with sized_shuffles(raw):
        tables.write_silver(listings, common.silver_table(given), given.mode, given.provider, given.rebalance, audit)
        if given.latest:
            latest.merge(SILVER_PLANS[given.source](raw), latest.create_latest_table(spark, given.catalog))
    print(json.dumps(audit.report()))


if __name__ == "__main__":
    main()
