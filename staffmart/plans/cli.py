"""Command line for the jobs, e.g. with ``spark-submit``::

    spark-submit --py-files staffmart.zip staffmart/plans/cli.py silver positions \\
        --src raw/positions.csv --out lake/silver/positions
    spark-submit --conf spark.staffmart.pseudonym.secret=... \\
        staffmart/plans/cli.py silver employees --src raw/employees.csv \\
        --out lake/silver/employees --vault lake/vault/employees \\
        --as-of 2024-01-01
    spark-submit staffmart/plans/cli.py gold --postal lake/silver/postal \\
        --employees lake/silver/employees --positions lake/silver/positions --out lake/gold
    spark-submit --conf spark.staffmart.pseudonym.secret=... staffmart/plans/cli.py all \\
        --input raw/ --output lake/ --as-of 2024-01-01

All paths are arguments (no working-directory assumptions); the token
secret comes from the Spark conf, never from a file next to the job.
"""

from __future__ import annotations

import argparse
import os
import sys
from datetime import date

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from staffmart.functions.tokens import key_from_conf  # noqa: E402
from staffmart.plans import jobs  # noqa: E402
from staffmart.session import get_session  # noqa: E402

ENTITIES = ["positions", "postal", "customers", "employees", "levels", "pq"]


def parse(argv: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="staffmart")
    sub = p.add_subparsers(dest="command", required=True)
    s = sub.add_parser("silver")
    s.add_argument("entity", choices=ENTITIES)
    s.add_argument("--src", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--vault")
    s.add_argument("--quarantine")
    s.add_argument("--as-of", default=None, help="reference date, default today")
    s.add_argument("--merge", action="store_true", help="employees: merge a drop into the kept tables")
    s.add_argument("--stitch", action="store_true", help="customers: join lines that were broken in two")
    s.add_argument("--lenient", action="store_true", help="write passing rows when a rule fails")
    g = sub.add_parser("gold")
    for name in ("postal", "employees", "positions", "out"):
        g.add_argument(f"--{name}", required=name != "employees")
    g.add_argument("--states", help="kept partial states: gold is made from them")
    u = sub.add_parser("states", help="make the partial states of all or some months again")
    u.add_argument("--employees", required=True)
    u.add_argument("--states", required=True)
    u.add_argument("--months", help="such as 2024-01,2024-02; default all")
    a = sub.add_parser("all", help="the silver job of each entity, then gold")
    a.add_argument("--entities", default=",".join(jobs.INPUT_FILES), help="comma-separated")
    a.add_argument("--no-gold", action="store_true")
    a.add_argument("--input", required=True)
    a.add_argument("--output", required=True)
    a.add_argument("--as-of", default=None)
    a.add_argument("--lenient", action="store_true")
    return p.parse_args(argv)


def main(argv: list[str] | None = None) -> int:
    args = parse(sys.argv[1:] if argv is None else argv)
    spark = get_session("staffmart")
    if args.command == "gold":
        if args.states:
            jobs.gold_from_states(spark, args.postal, args.positions, args.states, args.out)
        else:
            jobs.gold(spark, args.postal, args.employees, args.positions, args.out)
        return 0
    if args.command == "states":
        months = [tuple(map(int, m.split("-"))) for m in args.months.split(",")] if args.months else None
        jobs.update_states(spark, args.employees, args.states, months)
        return 0
    as_of = args.as_of or date.today().isoformat()
    strict = not args.lenient
    if args.command == "all":
        key = key_from_conf(spark)
        jobs.run_all(spark, args.input, args.output, as_of, key, strict,
                     entities=args.entities.split(","), with_gold=not args.no_gold)
        return 0
    e = args.entity
    if e == "positions":
        jobs.silver_positions(spark, args.src, args.out, quarantine=args.quarantine)
    elif e == "postal":
        jobs.silver_postal(spark, args.src, args.out, quarantine=args.quarantine)
    elif e == "customers":
        jobs.silver_customers(spark, args.src, args.out, quarantine=args.quarantine, strict=strict,
                              stitch=args.stitch)
    elif e == "levels":
        jobs.silver_levels(spark, args.src, args.out, quarantine=args.quarantine)
    elif e == "employees":
        jobs.silver_employees(spark, args.src, args.out, args.vault, as_of, key_from_conf(spark),
                              quarantine=args.quarantine, strict=strict, merge=args.merge)
    elif e == "pq":
        jobs.silver_pq(spark, args.src, args.out, args.vault, key_from_conf(spark),
                       quarantine=args.quarantine)
    return 0


if __name__ == "__main__":
    sys.exit(main())
