"""Write PLANS.md: the physical operator tree of each headline query.

    python tests/plan_report.py /root/testdata/sf0.01 > PLANS.md
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from bench import HEADLINE  # noqa: E402
from farebox.plans.catalog import REGISTRY  # noqa: E402
from farebox.session import get_spark  # noqa: E402
from plan_text import plan_of  # noqa: E402


def tree(plan: str) -> str:
    lines = []
    for line in plan.splitlines()[1:]:
        if not line.strip():
            break
        lines.append(line)
    return "\n".join(lines)


def main(sf_dir: str) -> None:
    spark = get_spark(master="local[4]")
    print("# Physical plans of the headline queries\n")
    print(f"Generated by `tests/plan_report.py` on `{sf_dir}` (initial adaptive plans; AQE may still")
    print("switch joins to broadcast or coalesce partitions at run time).\n")
    for name in HEADLINE:
        if name.startswith("stream_"):
            continue
        print(f"## {name}\n\n```\n{tree(plan_of(REGISTRY[name][0](spark, sf_dir)))}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
