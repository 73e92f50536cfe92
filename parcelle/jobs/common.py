"""Arguments shared by the jobs."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from parcelle import fixed_values as V
from parcelle.session import build_session, iceberg_conf
from parcelle.sources.tables import ICEBERG, PROVIDERS, table_name


def parser(about: str) -> argparse.ArgumentParser:
    args = argparse.ArgumentParser(description=about)
    args.add_argument("--catalog", help="catalog of the tables; the session's own if not given")
    args.add_argument("--catalog-uri", help="address of a REST lake catalog to set up")
    args.add_argument("--warehouse", help="warehouse location of that catalog")
    args.add_argument("--provider", choices=PROVIDERS, default=ICEBERG)
    args.add_argument("--master", help="for local runs; spark-submit sets it otherwise")
    return args


def session(args: argparse.Namespace, app_name: str) -> SparkSession:
    """A session with the catalog, if its address is given. Credentials for the store are
    settings of spark-submit and never arguments."""
    conf = {}
    if args.catalog and args.catalog_uri:
        conf = iceberg_conf(args.catalog, args.catalog_uri, args.warehouse or "")
    return build_session(app_name, args.master, conf)


def raw_table(args: argparse.Namespace, site: str) -> str:
    return table_name(args.catalog, V.RAW_NAMESPACE, site)


def silver_table(args: argparse.Namespace) -> str:
    return table_name(args.catalog, V.SILVER_NAMESPACE, V.SILVER_TABLE)
