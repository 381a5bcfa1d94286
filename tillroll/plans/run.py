"""Run a set of reports over one sales input and write them to a sink.

The raw derivation of the sale lines (a text parse, or a star join) is done
once: the lines are written as a year-partitioned parquet table under the
shared folder, and every report reads that table. This is the batch job that
replaces running one program per report.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame

from tillroll.plans.lattice import NODE_OF, answer, store_lattice
from tillroll.plans.reports import REPORTS
from tillroll.schema import DEFAULT_EXCLUDED_YEAR
from tillroll.session import remove_path, shared_dir
from tillroll.sources.fact import read_sales_fact, write_sales_fact
from tillroll.sources.sink import run_timestamp, utc, with_row_ids, write_report


def run_id_of(run_ts: dt.datetime) -> str:
    """Folder-safe id of a run timestamp, e.g. ``20261202T171500123``."""
    return utc(run_ts).strftime("%Y%m%dT%H%M%S%f")[:-3]


def sink_options(options: dict[str, str] | None, report: str) -> dict[str, str]:
    """Writer options of one report: ``{report}`` in a value stands for its name, e.g.
    ``{"collection": "{report}"}``."""
    return {k: v.replace("{report}", report) for k, v in (options or {}).items()}


def run_all(
    sales: DataFrame,
    sink_root: str | None,
    names: list[str] | None = None,
    excluded_year: str = DEFAULT_EXCLUDED_YEAR,
    fact_path: str | None = None,
    fmt: str = "parquet",
    run_ts: dt.datetime | None = None,
    parallelism: int = 1,
    options: dict[str, str] | None = None,
    keep_fact: bool = False,
    limits: dict[str, int] | None = None,
    lattice: bool = False,
    row_id: str | None = None,
) -> dict[str, str | None]:
    """Write the fact once, run each named report over it, and write each to
    ``sink_root/<name>/run_id=<id>``. Returns ``{name: target}``.

    ``sink_root=None`` is for formats that are addressed by ``options`` alone, such
    as a document store: each report is appended to its own collection (see
    :func:`sink_options`), as the source jobs do, and nothing is ever
    overwritten there. ``row_id`` names a field for ids that a retried task or run makes
    again (:func:`with_row_ids`), for stores that replace documents by id.

    A fact at the default path is removed once all reports are written, unless
    ``keep_fact`` says otherwise; a failed run leaves it, and a path given by the
    caller is never removed. ``limits`` cuts named rankings to their first rows.

    ``lattice=True`` answers the sum reports that ``plans.lattice`` covers from stored
    aggregates: three scans of the fact instead of one for each of 17 reports. The
    aggregates lie beside the fact and are removed with it.

    Runs accumulate side by side (reading ``sink_root/<name>`` gives every run,
    with ``TimeStamp`` and ``run_id`` columns). Each run writes its own folder
    in overwrite mode, so re-running a failed run with the same ``run_ts``
    replaces what it had written instead of adding a second copy.

    ``parallelism > 1`` submits that many report jobs at once from driver
    threads (Spark schedules concurrent jobs of one session), so the tail of
    one report's last stage overlaps with the next reports instead of leaving
    executors idle. Each report is still one distributed job; nothing is
    collected.
    """
    spark = sales.sparkSession
    ts = run_ts or run_timestamp()
    run_id = run_id_of(ts)
    # The fact of a run lives at a path derived from its id: a retried run
    # overwrites its own copy instead of leaving another one behind.
    path = write_sales_fact(sales, fact_path or f"{shared_dir(spark).rstrip('/')}/sales_fact-{run_id}")
    fact = read_sales_fact(spark, path)
    targets = {
        name: sink_root and f"{sink_root.rstrip('/')}/{name}/run_id={run_id}" for name in names or list(REPORTS)
    }

    nodes = f"{path.rstrip('/')}-lattice"
    stored = [name for name in targets if lattice and name in NODE_OF]
    if stored:
        store_lattice(fact, nodes, [NODE_OF[name] for name in stored])

    def one(name: str) -> None:
        report = answer(spark, nodes, name, excluded_year) if name in stored else REPORTS[name].run(fact, excluded_year)
        if limits and name in limits:
            report = report.limit(limits[name])
        if row_id:
            report = with_row_ids(report, f"{name}/{run_id}", row_id)
        mode = "overwrite" if targets[name] else "append"
        write_report(report, targets[name], ts, fmt=fmt, mode=mode, options=sink_options(options, name))

    if parallelism <= 1:
        for name in targets:
            one(name)
    else:
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            for future in [pool.submit(one, name) for name in targets]:
                future.result()
    if fact_path is None and not keep_fact:
        remove_path(spark, path)
        remove_path(spark, nodes)
    return targets
