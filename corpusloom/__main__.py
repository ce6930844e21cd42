"""``python -m corpusloom STORE``: a scheduled run over a snapshot store; ``--init DIR`` starts the store from the tables of a directory."""

from __future__ import annotations

import argparse
import dataclasses
import os
import sys

from corpusloom.config import PipelineConfig
from corpusloom.operators.crawl_state import SnapshotStore
from corpusloom.plans.pipeline import Pipeline
from corpusloom.session import get_session
from corpusloom.sources.providers import HttpFetcher, HttpNotifier, TableFetcher
from corpusloom.sources.tables import read_table


def main(args: list[str]) -> int:
    parser = argparse.ArgumentParser(prog="corpusloom", description=__doc__)
    parser.add_argument("store", help="folder of the snapshot store")
    parser.add_argument("--init", help="directory with pages.parquet and chunks.parquet to start from")
    parser.add_argument("--answers", help="Parquet (url, status, reason, body) that answers requests instead of the network")
    parser.add_argument("--batch-size", type=int)
    parser.add_argument("--batch-count", type=int)
    parser.add_argument("--force", action="store_true", help="process unchanged pages too")
    parser.add_argument("--index", help="address of a page whose links are enqueued first")
    known = parser.parse_args(args)
    config = PipelineConfig.from_env(dict(os.environ))
    given = {"batch_size": known.batch_size, "batch_count": known.batch_count, "force_update_all": known.force or None}
    config = dataclasses.replace(config, **{k: v for k, v in given.items() if v is not None})
    spark = get_session()
    store = SnapshotStore(spark, known.store)
    if known.init:
        store.write(pages=read_table(spark, known.init, "pages"), chunks=read_table(spark, known.init, "chunks"))
    fetcher = TableFetcher(spark.read.parquet(known.answers)) if known.answers else HttpFetcher(config.headers)
    notifier = HttpNotifier(os.environ.get("STATS_ADDRESS"), os.environ.get("ALERT_ADDRESS"))
    try:
        results = Pipeline(spark, store, fetcher, config, notifier=notifier).run(index_url=known.index)
    except Exception as e:
        notifier.alert(f"Run failed: {e}")
        raise
    for r in results:
        print(r)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
