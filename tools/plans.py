"""Write ``explain("formatted")`` plans of the headline steps to docs/plans/.

Broadcast joins are disabled while explaining, so the plans show the
strategies a large input gets (sort-merge joins, bucketed scans, exchanges).

usage: python tools/plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main(argv):
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from souk.plans import analytics as A
    from souk.plans import fact as FP
    from souk.plans import mart as MP
    from souk.plans import mart_checks as MC
    from souk.plans.cleaning import gen2_specs
    from souk.operators.clean import clean
    from souk.plans.warehouse import warehouse
    from souk.session import local_session

    # small buckets so the documented plans show the multi-bucket ranking shape at this size
    spark = local_session(8)
    w = warehouse(spark, sf)
    w.build_all()
    fact, mart = w.fact(), w.mart()
    cleaned = {t: w.cleaned(t) for t in ("orders", "customers", "category_translation")}
    ref = MP.reference_date(fact).first()[0]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plans = {
        "clean_orders": clean(w.raw("orders"), gen2_specs()["orders"], groups=w.row_groups("orders")).cleaned,
        "row_groups_order_items": w.raw("order_items").groupBy(*w.raw("order_items").columns).count(),
        "fact_join": FP.build_fact(cleaned, w.threshold(), w.order_aggs(), w.dims()),
        "last_location": MP.last_location(fact, w.customer_agg()),
        "customer_agg": MP.customer_agg(fact, ref),
        "rfm_scores": MP.with_rfm(w.customer_agg()),
        "revenue_deciles": A.revenue_deciles(mart),
        "pareto_bands": A.pareto_bands(w.spend_ranking()),
        "cohort_retention_matrix": A.cohort_retention_matrix(w.active_months()),
        "segment_top_customers": A.segment_top_customers(mart),
        "monthly_trend": A.monthly_trend(fact),
        "check_order_consistency": MC.order_consistency(w),
    }
    out_dir = os.path.join(ROOT, "docs", "plans")
    os.makedirs(out_dir, exist_ok=True)
    for name, df in plans.items():
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        with open(os.path.join(out_dir, f"{name}.txt"), "w") as fh:
            fh.write(buf.getvalue())
        print(name, len(buf.getvalue()))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
