"""Print trimmed physical plans of the key queries (tree + scans + exchanges).

Usage: python tools/explain_plans.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import io
import os
import re
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KEYS = ("stg_live_timetable", "fact_movements", "dim_quay", "dim_service_journey", "dim_line",
        "src_xml_journey_pattern_stops", "src_zip_members", "test_unique")
KEEP = re.compile(r"^(\(\d+\) (Scan|Exchange|BroadcastExchange|WindowGroupLimit|HashAggregate|MapInPandas)|"
                  r"(PushedFilters|PartitionFilters|ReadSchema|Arguments: (hash|range|Single|RoundRobin)))")


def trimmed(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    tree, _, details = text.partition("\n\n\n")
    keep = [ln for ln in details.splitlines() if KEEP.match(ln.strip())]
    keep = [re.sub(r"file:\S+?(/kollektiv-[a-z_]+)-[0-9a-f]+", r"<scratch>\1", ln) for ln in keep]
    return tree.strip() + "\n\n" + "\n".join(keep)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from kollektiv.registry import QUERIES
    from kollektiv.session import build_session
    spark = build_session("local[8]", shuffle_partitions=8)
    print("# Physical plans of key queries\n")
    print(f"Generated by `tools/explain_plans.py` at `{sf_dir}` (AQE initial plans; `local[8]`).\n")
    for k in KEYS:
        print(f"## {k}\n\n```\n{trimmed(QUERIES[k](spark, sf_dir))}\n```\n")


if __name__ == "__main__":
    main()
