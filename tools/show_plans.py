"""Write the final adaptive plan trees of the headline queries, every join in its shuffle form.

    python tools/show_plans.py [sf_dir] > docs/plans.md

Broadcasts are switched off so the plans have the shape they take on large inputs.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from enrollspark.plans.extract import sort_records  # noqa: E402
from enrollspark.plans.queries import QUERIES  # noqa: E402
from enrollspark.session import local_session  # noqa: E402

KEEP = re.compile(
    r"(Exchange|Join|Aggregate|Window|WindowGroupLimit|Generate|Union|Sort |Expand|ReusedExchange|FileScan|AQEShuffleRead)"
)


def tree(df) -> str:
    df.collect()
    p = df._jdf.queryExecution().executedPlan().toString()
    final = p.split("== Initial Plan ==")[0]
    lines = []
    for line in final.splitlines():
        if KEEP.search(line):
            line = re.sub(r"#\d+L?", "", line)
            line = re.sub(r"\[plan_id=\d+\]", "", line)
            line = re.sub(r"(FileScan \w+) \[[^\]]*\].*?(PushedFilters: \[[^\]]*\])?.*?(ReadSchema: \S+)?$",
                          lambda m: " ".join(x for x in m.groups() if x), line)
            lines.append(line.rstrip()[:180])
    return "\n".join(lines)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    print("# Final plans with every join as a shuffle join\n")
    print(f"Generated by `tools/show_plans.py {sf}`; node ids and plan ids removed, long lines cut.\n")
    shown = {
        "extract_records, ordered parts": sort_records(QUERIES["extract_records"](spark, sf)),
        "state_after_change": QUERIES["state_after_change"](spark, sf),
        "latest_registration": QUERIES["latest_registration"](spark, sf),
        "cob_top5": QUERIES["cob_top5"](spark, sf),
        "state_scaffold": QUERIES["state_scaffold"](spark, sf),
    }
    for name, df in shown.items():
        print(f"## {name}\n\n```\n{tree(df)}\n```\n")


if __name__ == "__main__":
    main()
