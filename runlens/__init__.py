"""runlens: broker-run analytics for exchange trade lists on Spark.

Main entry points (all lazy DataFrame transformations):

* runs:      ``with_run_ids``, ``run_summary``, ``run_summary_sides``, ``run_detail``
* reports:   ``top_runs``, ``top_runs_sides``, ``compare_symbol``, ``compare_all``
* enrich:    ``add_symbol``, ``add_pc_change``, ``flag_known``, ``backfill_companies``
* ingest:    ``parse_trade_pages``, ``parse_price_pages``, ``parse_company_pages``, ``split_bad``,
             ``with_trade_ids``, ``prices_table``
* storage:   ``runlens.sources.store`` (loads, day delete, refresh, reports)
* streaming: ``runlens.streaming.pages_stream.start_page_stream``
"""

from .operators.compare import compare_all, compare_symbol
from .operators.enrich import add_pc_change, add_symbol, backfill_companies, flag_known
from .operators.ingest import (parse_company_pages, parse_price_pages, parse_trade_pages, prices_table,
                               split_bad, with_trade_ids)
from .operators.runs import run_detail, run_summary, run_summary_sides, with_run_ids
from .operators.top_runs import top_runs, top_runs_sides

__all__ = [
    "with_run_ids", "run_summary", "run_summary_sides", "run_detail",
    "top_runs", "top_runs_sides", "compare_symbol", "compare_all",
    "add_symbol", "add_pc_change", "flag_known", "backfill_companies",
    "parse_trade_pages", "parse_price_pages", "parse_company_pages", "split_bad", "with_trade_ids",
    "prices_table",
]
