"""Fit the small committed models of ``learnlog/models`` on a scale factor.

usage: python tools/export_models.py [sf_dir]

Their scores have SQL oracles, so a committed model changes only on purpose.
"""

from __future__ import annotations

import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


def main() -> None:
    from pyspark.sql import functions as F

    from learnlog.functions.ensemble import Ensemble
    from learnlog.operators.model import GBTConfig, train_gbt
    from learnlog.plans import causal, static_score, tail_split
    from learnlog.plans.q_state import train_valid
    from learnlog.operators import splits as sp
    from learnlog.session import local_session
    from learnlog.sources import fixtures as fx

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, memory="8g")
    small = GBTConfig(max_iter=6, max_depth=3, max_bins=32, validation_tol=0.0)
    lg, q, lectures = fx.interactions(spark, sf), fx.questions(spark, sf), fx.lectures(spark, sf)
    split = sp.ordered_split(lg.filter(F.col("content_type_id") == 0))
    stats = static_score.static_stats(split.filter("split = 'train'"), q)
    tables = {
        "causal": (causal.filled_plan_a(*train_valid(spark, sf)), causal.PLAN_A),
        "static": (static_score.featurise(split, stats).withColumn("is_valid", F.col("split") == "valid"), static_score.FEATURES),
        "lecture": (tail_split.split_features(lg, q, lectures), tail_split.FEATURES),
    }
    for name, (table, features) in tables.items():
        model = train_gbt(table, features, cfg=small)
        path = ROOT / "learnlog" / "models" / f"{name}.json"
        path.parent.mkdir(exist_ok=True)
        path.write_text(Ensemble.of_model(model, features).to_json())
        print(path, path.stat().st_size)


if __name__ == "__main__":
    main()
