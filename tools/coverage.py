"""Print the SURVEY section-2 operator ids covered by each registered query."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rankforge.plans.registry import load_all  # noqa: E402

TEST_ONLY = {
    "S2": "tests (createDataFrame fixtures)",
    "S3": "sources/sinks.py write_version; tests/test_sources.py",
    "S11": "sources/tables.py read_interactions_csv/read_items_csv; tests/test_operators.py",
    "S12": "sources/generate.py modulo_interactions; tests/test_sources.py",
    "S13": "sources/generate.py random_interactions; tests/test_sources.py",
}


def main():
    reg = load_all()
    by_op = {}
    for k, q in reg.items():
        for op in filter(None, q.ops.split(",")):
            by_op.setdefault(op, []).append((k, "SQL" if q.sql else "rows"))
    order = lambda o: (o[0], int("".join(ch for ch in o[1:] if ch.isdigit())))
    print("| Op | Queries (check) |")
    print("|---|---|")
    for op in sorted(set(by_op) | set(TEST_ONLY), key=order):
        if op in by_op:
            print(f"| {op} | " + ", ".join(f"`{k}` ({c})" for k, c in by_op[op]) + " |")
        else:
            print(f"| {op} | {TEST_ONLY[op]} |")


if __name__ == "__main__":
    main()
