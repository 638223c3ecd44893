"""Write docs/PLANS.md: the physical plans of the heavy models without broadcasts.

usage: python tools/write_plans.py [SF_DIR]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from larchmart.operators import quality as Q  # noqa: E402
from larchmart.plans import models as M  # noqa: E402
from larchmart.plans.registry import wh  # noqa: E402
from larchmart.session import local_session  # noqa: E402

HEAD = """# Physical plans at scale

Written by `tools/write_plans.py` with `spark.sql.autoBroadcastJoinThreshold=-1` and AQE off, so
the plans show the shuffles used when no side is small enough to broadcast (at 100 TB). With AQE
on, Spark also coalesces partitions, splits skewed join partitions, and broadcasts a side only
when it is measured below the threshold.
"""


def tree(df) -> str:
    """The operator tree of a plan, without the numbers of expressions."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("simple")
    text = re.sub(r"#\d+L?|, \[plan_id=\d+\]|file:[^\s,\]]*", "", out.getvalue())
    return "\n".join(line[:180].rstrip() for line in text.strip().splitlines())


def main() -> None:
    spark = local_session(8, 8, "plans")
    w = wh(spark, sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001")
    for model in ("stg_order_items", "stg_orders", "stg_products", "stg_sessions", "dim_customers", "dim_products", "dim_date", "fct_orders", "fct_daily_sales"):
        w.table(model)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    t = w.table
    catalog = M.keyed_products(t("stg_products"), t("dim_products"))
    margins = M.int_order_margins(t("stg_order_items"), t("stg_orders"), catalog)
    check = next(c for c in Q.declared_checks(w.cfg) if c.model == "fct_orders" and c.kind == "relationships")
    plans = {
        "fct_orders (from staging and dimensions)": M.fct_orders(margins, t("dim_customers"), w.cfg),
        "fct_sessions": M.fct_sessions(M.int_sessions(t("stg_sessions"), t("stg_orders")), t("dim_customers"), w.cfg),
        "fct_daily_sales": M.fct_daily_sales(t("fct_orders")),
        "customer order rollup (customer 360 input)": M.customer_orders(M.customer_order_lines(t("fct_orders"), t("dim_customers"))),
        "q2 top-10 states": w.q2(),
        "relationships check fct_orders.customer_key": Q.relationship_check(t("fct_orders"), t("dim_customers"), check),
    }
    with open(f"{ROOT}/docs/PLANS.md", "w") as f:
        f.write(HEAD + "".join(f"\n## {name}\n\n```\n{tree(df)}\n```\n" for name, df in plans.items()))


if __name__ == "__main__":
    main()
