"""Create the raw tables of some sources and the unified table.

    python -m parcelle.jobs.create_tables --sources <site> ... --silver
"""

from __future__ import annotations

from collections.abc import Sequence

from parcelle.jobs import common
from parcelle.sources import tables


def main(argv: Sequence[str] | None = None) -> list[str]:
    args = common.parser(__doc__)
    args.add_argument("--sources", nargs="*", default=[], help="sources to make a raw table for")
    args.add_argument("--silver", action="store_true", help="make the unified table, too")
    given = args.parse_args(argv)
    spark = common.session(given, "create-tables")
    created = tables.create_raw_tables(spark, given.sources, given.catalog, given.provider)
    if given.silver:
        created.append(tables.create_silver_table(spark, given.catalog, given.provider))
    for name in created:
        print(name)
        tables.describe(spark, name).show(100, truncate=False)
        tables.properties(spark, name).show(truncate=False)
    return created


if __name__ == "__main__":
    main()
