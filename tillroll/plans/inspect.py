"""Plan checks: the physical plan text of a report and what it shuffles."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """``df.explain(mode)`` as a string."""
    buffer = io.StringIO()
    with contextlib.redirect_stdout(buffer):
        df.explain(mode)
    return buffer.getvalue()


def plan_summary(df: DataFrame) -> dict[str, int]:
    """Counts of the operators that decide cost at scale, from the initial
    (pre-AQE) physical plan: shuffles, broadcasts, joins, sorts, scans."""
    tree = plan_text(df, "formatted").split("\n\n", 1)[0]
    names = re.findall(r"[+-]- ([A-Za-z]+)|^([A-Za-z]+) \(", tree, flags=re.MULTILINE)
    ops = [a or b for a, b in names]
    return {
        "exchanges": sum(op == "Exchange" for op in ops),
        "broadcasts": sum(op == "BroadcastExchange" for op in ops),
        "joins": sum(op.endswith("Join") for op in ops),
        "sorts": sum(op == "Sort" for op in ops),
        "scans": len(re.findall(r"Scan parquet", tree)),
    }


def scan_digest(df: DataFrame) -> list[dict[str, str]]:
    """Per parquet scan of the plan: pushed filters, partition filters, read schema."""
    text = plan_text(df, "formatted")
    scans = []
    for block in text.split("\n\n"):
        block = block.strip()
        if "Scan parquet" not in block.split("\n", 1)[0]:
            continue
        entry = {}
        for line in block.splitlines():
            for key in ("PushedFilters", "PartitionFilters", "ReadSchema"):
                if line.startswith(key + ":"):
                    entry[key] = line.split(":", 1)[1].strip()
        scans.append(entry)
    return scans
