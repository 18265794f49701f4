"""The daily batch: stage once, build the marts from the stored staging models, then test them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame

from tillstream.functions.times import AsOf
from tillstream.operators import checks
from tillstream.plans import marts, staging
from tillstream.schemas import STATUSES
from tillstream.sources.stores import materialize

NOT_NULL = {
    "stg_transactions": ["txn_id", "user_id", "amount", "timestamp", "merchant_id", "status"],
    "stg_anomalies": ["txn_id", "user_id", "z_score"],
    "fct_daily_revenue": ["txn_date", "merchant_category", "total_revenue", "txn_count"],
    "dim_merchants": ["merchant_id", "lifetime_revenue"],
    "fct_merchant_rollup": ["merchant_id", "recent_revenue"],
    "fct_anomaly_summary": ["anomaly_date", "anomaly_count"],
}
UNIQUE = {
    "stg_transactions": "txn_id",
    "stg_anomalies": "txn_id",
    "dim_merchants": "merchant_id",
    "fct_merchant_rollup": "merchant_id",
}


def build_models(
    raw_transactions: DataFrame, raw_anomalies: DataFrame, path: str, as_of: AsOf, tiebreak: Sequence[str] = ()
) -> dict[str, DataFrame]:
    """All models as Parquet below `path`, with a temporary view each. Every row is de-duplicated
    once; the marts read the result. Models that do not read each other are written at the same time, so
    the last tasks of one leave no core idle."""

    def stored(models: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
        with ThreadPoolExecutor(len(models)) as pool:
            writes = {}
            for name, df in models.items():
                # Each write gets a copy of its own of this thread's job properties.
                write = inheritable_thread_target(df.sparkSession)(materialize)
                writes[name] = pool.submit(write, df, name, f"{path}/{name}")
        return {name: write.result() for name, write in writes.items()}

    staged = stored(
        {
            "stg_transactions": staging.stg_transactions(raw_transactions, tiebreak),
            "stg_anomalies": staging.stg_anomalies(raw_anomalies),
        }
    )
    txns, flagged = staged["stg_transactions"], staged["stg_anomalies"]
    built = stored(
        {
            "fct_daily_revenue": marts.fct_daily_revenue(txns),
            "dim_merchants": marts.dim_merchants(txns, flagged),
            "fct_merchant_rollup": marts.fct_merchant_rollup(txns, as_of),
            "fct_anomaly_summary": marts.fct_anomaly_summary(flagged),
        }
    )
    return staged | built


def check_models(models: dict[str, DataFrame]) -> DataFrame:
    """Results of the 24 declared tests; null checks take one pass per model."""
    known = checks.accepted_values(models["stg_transactions"], "status", STATUSES)
    singles = [checks.Check("accepted_values_stg_transactions_status", known)]
    singles += [checks.Check(f"unique_{m}_{c}", checks.unique(models[m], c)) for m, c in UNIQUE.items()]
    results = checks.run_checks(singles)
    for model, columns in NOT_NULL.items():
        results = results.unionAll(checks.not_null_results(model, models[model], columns))
    return results
